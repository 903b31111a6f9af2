"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Words (a run of the space mark and what follows) never share a merge, since no piece has the mark behind another
character; each distinct word of a task is encoded once. The symbols of many words lie in one flat array. Each round
looks up the rank of every neighbouring pair, takes the best rank of each word, merges all its leftmost disjoint
occurrences at once and compacts the array, until no word has a pair left. Merging several occurrences at once
equals merging them one by one unless a merge makes a pair of the same or a better rank; such a word merges only its
leftmost occurrence in that round, and if more than ``LONG`` symbols are left of it (long runs of one mark), it leaves the
rounds and is finished pair by pair from an ordered list of its pairs, so no word takes quadratic time. Characters
without a piece become byte pieces.

Defined cases: null or empty text gives no ids and decodes to an empty text; repeated rows get a row each; an empty
table gives an empty result; other columns are ignored. Models with a character map or other prefix rules than
``add_dummy_prefix`` are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat

MARK = "▁"
CACHE_WORDS = 500_000
#: Symbols of a word up to which merges that depend on their order are made in rounds.
LONG = 128
NONE = np.int64(1) << 40

class Model:
    """Lookup arrays of a BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as f:
            raw = f.read()
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(raw)
        norm = spec.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not spec.trainer_spec.byte_fallback:
            raise ValueError("only identity normalisation with a dummy prefix and byte fallback is supported")
        sp = SentencePieceProcessor(model_proto=raw)
        size = sp.get_piece_size()
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(size)]
        piece = [sp.id_to_piece(i) for i in range(size)]
        of = {p: i for i, p in enumerate(piece) if not special[i]}
        if any(MARK in p.lstrip(MARK) for p in of) or any(sp.is_unused(i) for i in range(size)):
            raise ValueError("a piece has the space mark inside, or pieces are unused")
        self.byte = np.zeros(256, dtype=np.int64)
        for i in range(size):
            if sp.is_byte(i):
                self.byte[int(piece[i][3:5], 16)] = i
        # single characters, also those that only longer pieces have (ids from ``size`` on)
        chars = sorted({c for p in of for c in p})
        extra = {c: size + k for k, c in enumerate(c for c in chars if c not in of)}
        self.size = size
        symbol = of | extra
        self.char_code = np.array([ord(c) for c in chars], dtype=np.int64)
        self.char_id = np.array([symbol[c] for c in chars], dtype=np.int64)
        score = np.array([-sp.get_score(i) for i in range(size)])
        rank = np.unique(score, return_inverse=True)[1]
        self.wide = size + len(extra) + 1
        keys, into = [], []
        for p, i in of.items():
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * self.wide + b)
                    into.append(i)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.key = np.array(keys, dtype=np.int64)[order]
        self.into = np.array(into, dtype=np.int64)[order]
        self.rank = rank[self.into].astype(np.int64)
        # what may not be part of a longer piece splits words further
        self.split = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+" if not any("\n" in p for p in of) else f"{MARK}*[^{MARK}]+|{MARK}+")
        shown = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else spec.trainer_spec.unk_surface.encode() if sp.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(piece)]
        self.surface = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.surface_len = np.array([len(x) for x in shown], dtype=np.int64)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        digits = [b"%d," % i for i in range(size)]
        self.number = np.frombuffer(b"".join(digits), dtype=np.uint8)
        self.number_len = np.array([len(x) for x in digits], dtype=np.int64)
        self.number_at = np.cumsum(self.number_len) - self.number_len

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; no merge: NONE."""
        key = a * self.wide + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = (self.key[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.rank[at], NONE), self.into[at]


def model(path: str) -> Model:
    """The model of a file, read once per process."""
    kept = flat.process_store()
    if (key := f"pieces {path}") not in kept:
        kept[key] = Model(path)
    return kept[key]


def encoder(path: str) -> Encoder:
    """An encoder whose store of words lasts for the tasks of a process."""
    kept = flat.process_store()
    if (key := f"pieces encoder {path}") not in kept:
        kept[key] = Encoder(path)
    return kept[key]


def one_by_one(m: Model, sym: np.ndarray, rank: np.ndarray, into: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of one word after all merges, best rank first and then leftmost, and the places where they begin."""
    n = len(sym)
    at = np.flatnonzero(rank != NONE)
    todo = list(zip(rank[at].tolist(), at.tolist(), sym[at].tolist(), sym[at + 1].tolist(), into[at].tolist(), strict=True))
    heapq.heapify(todo)
    s, right, left = sym.tolist(), [*range(1, n), -1], [-1, *range(n - 1)]
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def push(i: int) -> None:
        pair = s[i], s[right[i]]
        if pair not in known:
            r, t = m.pair(np.array(pair[:1]), np.array(pair[1:]))
            known[pair] = int(r[0]), int(t[0])
        r, t = known[pair]
        if r != NONE:
            heapq.heappush(todo, (r, i, *pair, t))

    gone = bytearray(n)
    while todo:
        _, i, a, b, t = heapq.heappop(todo)
        j = right[i]
        if gone[i] or j < 0 or s[i] != a or s[j] != b:
            continue  # one of the two has been merged since
        s[i], gone[j], right[i] = t, 1, right[j]
        if right[j] >= 0:
            left[right[j]] = i
            push(i)
        if left[i] >= 0:
            push(left[i])
    stay = np.flatnonzero(np.frombuffer(bytes(gone), dtype=np.uint8) == 0)
    return np.array(s, dtype=np.int64)[stay], stay


def merge(m: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and how many each has."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    count = np.array([len(w) for w in words], dtype=np.int64)
    at = np.minimum(np.searchsorted(m.char_code, code), len(m.char_code) - 1)
    sym = np.where(m.char_code[at] == code, m.char_id[at], -1 - code)  # below 0: a character without a piece
    word = np.repeat(np.arange(len(words)), count)
    pos = np.arange(len(sym))
    # of the pair of each symbol and the next one: rank, and what it merges to
    rank, into = np.full(len(sym), NONE), np.zeros(len(sym), dtype=np.int64)
    inner = np.flatnonzero(word[1:] == word[:-1])
    rank[inner], into[inner] = m.pair(sym[inner], sym[inner + 1])
    done_word, done_sym, done_pos = [], [], []
    while len(sym):
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(np.append(start, len(sym)))
        best = np.minimum.reduceat(rank, start)
        over = np.repeat(best == NONE, size)
        if over.any():
            done_word.append(word[over])
            done_sym.append(sym[over])
            done_pos.append(pos[over])
            live = ~over
            sym, word, pos, rank, into = sym[live], word[live], pos[live], rank[live], into[live]
            best, size = best[best != NONE], size[best != NONE]
            if not len(sym):
                break
        best_of = np.repeat(best, size)
        where = np.flatnonzero(rank == best_of)
        # of overlapping occurrences every second one, from the left
        fresh = np.concatenate([[True], np.diff(where) > 1])
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))
        where = where[(np.arange(len(where)) - head) % 2 == 0]
        leftmost = np.concatenate([[True], word[where[1:]] != word[where[:-1]]])

        def merged(where, sym=sym, word=word, pos=pos, rank=rank, into=into, best_of=best_of):
            """The arrays after merging, and the words where a merge made a pair of no worse rank."""
            after = sym.copy()
            after[where] = into[where]
            live = np.ones(len(sym), dtype=bool)
            live[where + 1] = False
            at = np.cumsum(live)[where] - 1  # of the merged symbols
            sym, word, pos, rank, into, best_of = (x[live] for x in (after, word, pos, rank, into, best_of))
            touched = np.unique(np.concatenate([at, np.maximum(at - 1, 0)]))
            rank[touched], into[touched] = NONE, 0
            touched = touched[touched + 1 < len(sym)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched], into[touched] = m.pair(sym[touched], sym[touched + 1])
            return (sym, word, pos, rank, into), word[touched[rank[touched] <= best_of[touched]]]

        state, poor = merged(where)
        if len(poor) and not leftmost.all():
            hit = np.zeros(len(words), dtype=bool)
            hit[poor] = True
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            far = hit[word[heads]] & (size > LONG)
            if far.any():
                for a, z in zip(heads[far].tolist(), (heads + size)[far].tolist(), strict=True):
                    got, places = one_by_one(m, sym[a:z], rank[a:z], into[a:z])
                    done_word.append(np.full(len(got), word[a]))
                    done_sym.append(got)
                    done_pos.append(pos[a:z][places])
                live = np.repeat(~far, size)
                sym, word, pos, rank, into = sym[live], word[live], pos[live], rank[live], into[live]
                continue
            state, _ = merged(where[leftmost | ~hit[word[where]]])
        sym, word, pos, rank, into = state
    if not done_sym:
        return np.zeros(0, np.int64), count
    sym, pos = np.concatenate(done_sym), np.concatenate(done_pos)
    word = np.concatenate(done_word)
    order = np.argsort(pos)
    sym, word = sym[order], word[order]
    # characters without a piece: one byte piece per byte
    bare = (sym < 0) | (sym >= m.size)
    if bare.any():
        codes = np.where(sym < 0, -1 - sym, 0)
        back = dict(zip(m.char_id[m.char_id >= m.size].tolist(), m.char_code[m.char_id >= m.size].tolist(), strict=True))
        as_bytes = [chr(back.get(s, c)).encode("utf-8", "surrogatepass") for s, c in zip(sym[bare].tolist(), codes[bare].tolist(), strict=True)]
        times = np.ones(len(sym), dtype=np.int64)
        times[bare] = [len(x) for x in as_bytes]
        spread = np.repeat(bare, times)
        sym, word = np.repeat(sym, times), np.repeat(word, times)
        sym[spread] = m.byte[np.frombuffer(b"".join(as_bytes), dtype=np.uint8)]
    return sym, np.bincount(word, minlength=len(words))


class Encoder:
    """Whole texts to ids; the words that were seen before come from a store of bounded size."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.m, self.limit = model(path), cache_words
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text begins, with the end."""
        split = self.m.split.findall
        words = [split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        flat_words = [w for ws in words for w in ws]
        fresh = set(flat_words).difference(self.known)
        if len(self.known) + len(fresh) > self.limit:
            self._clear()
            fresh = set(flat_words)
        if fresh:
            fresh = list(fresh)
            ids, n = merge(self.m, fresh)
            self.known.update(zip(fresh, range(len(self.count), len(self.count) + len(fresh)), strict=True))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(n) - n])
            self.flat, self.count = np.concatenate([self.flat, ids]), np.concatenate([self.count, n])
        at = np.fromiter(map(self.known.__getitem__, flat_words), dtype=np.int64, count=len(flat_words))
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        ids, ends = gather(self.flat, self.start[at], self.count[at])
        return ids, np.concatenate([[0], ends])[bounds]


def gather(flat_values: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of an array one after the other, and where each ends."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return flat_values[np.arange(total) + np.repeat(start - (ends - count), count)], ends


def decode(m: Model, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of ids cut at ``bounds``: surfaces joined, without the space that encoding puts in front."""
    raw, ends = gather(m.surface, m.surface_at[ids], m.surface_len[ids])
    raw, cut = raw.tobytes(), np.concatenate([[0], ends])[bounds].tolist()
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return [t[1:] if t.startswith(" ") else t for t in texts]


def _encoded(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        enc = encoder(path)
        for b in flat.slices(batches):
            ids, bounds = enc.ids([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))], schema=schema)

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, ids."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_encoded(path), "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Per row of ``rows`` (doc_id, ids): doc_id, text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        m = model(path)
        for b in batches:
            ids = [np.array(x or [], dtype=np.int64) for x in b.column("ids").to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            texts = decode(m, np.concatenate([*ids, np.zeros(0, np.int64)]), bounds)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], schema=schema)

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches):
        enc = encoder(path)
        m = enc.m
        for b in flat.slices(batches):
            ids, bounds = enc.ids([t or "" for t in b.column("text").to_pylist()])
            listed, ends = gather(m.number, m.number_at[ids], m.number_len[ids])
            listed, cut = listed.tobytes(), np.concatenate([[0], ends])[bounds].tolist()
            first = [sha(listed[a : max(a, z - 1)]) for a, z in zip(cut[:-1], cut[1:], strict=True)]
            back = [sha(t.encode()) for t in decode(m, ids, bounds)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(first, pa.string()), pa.array(back, pa.string())], schema=schema)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
