"""Token counts by byte-pair merging over a heap and a linked list; no identifiers are emitted.

A text is cut at special strings (one token each), brought to NFC, lowered and split into words as the vocabulary file
says. A word is its UTF-8 bytes, the last one marked as a word end. All adjacent pairs that a rule merges stand in a heap
by (rank, place); the lowest is popped, the pair becomes one symbol in a doubly linked list, and the pairs that it forms with
its neighbours are pushed. An entry whose pair has changed since is passed over. The count of a word is its bytes less its
merges: n bytes take n log n steps, also in a run of one character. Counts of short words are kept in a store of bounded
size per process, so a frequent word is merged once.

Defined cases: null or empty text has no bytes and no tokens; a text of white space has no tokens; repeated rows get a row
each; a null doc_id stays null; an empty table gives an empty result; other columns are ignored. Files with other rules than
NFC, white space, lower case, the word split below and byte symbols with a word end are refused. Equal to the library on
every code point but twelve that Unicode hasn't assigned (0x32808 and the like in higher planes).
"""

from __future__ import annotations

import json
import re
import unicodedata
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .packing import _byte_of

KEPT_WORDS, KEPT_LENGTH, LIST_CHARS = 400_000, 64, 1 << 20
# The split rule of the vocabulary file, and what it comes to for lowered ASCII.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+")
# Letters of Unicode 16 and their lower case, which the library's tables have and those of Python may not have.
NEWER = {"\ua7cb": "\u0264", "\ua7dc": "\u019b"}
PLACE, SYMBOL = 32, 16


class Merges:
    """First symbols of bytes and the rules (left, right) -> (rank, merged) of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], (spec.get("normalizer") or {}).get("normalizers", [])
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        as_known = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
        as_known &= [c["type"] for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": SPLIT} and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        as_known &= model["type"] == "BPE" and bool(model.get("end_of_word_suffix")) and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        as_known &= max(model["vocab"].values()) < 1 << SYMBOL
        as_known &= not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", []))
        if not as_known:
            raise ValueError("only lower-case word-end byte-pair vocabularies are supported")
        vocab, end, byte = model["vocab"], model["end_of_word_suffix"], _byte_of()
        self.inner, self.last = [0] * 256, [0] * 256
        for c, b in byte.items():
            self.inner[b], self.last[b] = vocab[c], vocab[c + end]
        self.pair: dict[int, tuple[int, int]] = {}
        for rank, rule in enumerate(model["merges"]):
            a, b = rule.split(" ") if isinstance(rule, str) else rule
            self.pair[vocab[a] << SYMBOL | vocab[b]] = rank << PLACE, vocab[a + b]
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None


def merged(symbols: list[int], pair: dict[int, tuple[int, int]]) -> int:
    """How many merges the symbols allow, lowest rank first, leftmost among equals; ``symbols`` is used up."""
    n, find = len(symbols), pair.get
    heap, left, i = [], symbols[0], 0
    for right in symbols[1:]:
        hit = find(left << SYMBOL | right)
        if hit is not None:
            heap.append(hit[0] | i)
        left = right
        i += 1
    if not heap:
        return 0
    heapify(heap)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    mask, done = (1 << PLACE) - 1, 0
    while heap:
        top = heappop(heap)
        i = top & mask
        j = after[i]
        left = symbols[i]
        if left < 0 or j >= n:
            continue
        hit = find(left << SYMBOL | symbols[j])
        if hit is None or hit[0] != top - i:  # the pair has changed since
            continue
        done += 1
        symbols[i] = left = hit[1]
        symbols[j] = -1
        after[i] = j = after[j]
        if j < n:
            before[j] = i
            hit = find(left << SYMBOL | symbols[j])
            if hit is not None:
                heappush(heap, hit[0] | i)
        j = before[i]
        if j >= 0:
            hit = find(symbols[j] << SYMBOL | left)
            if hit is not None:
                heappush(heap, hit[0] | j)
    return done


class Counter(dict):
    """Tokens of words. Short ones are kept in two generations of ``KEPT_WORDS``, so that frequent ones stay."""

    def __init__(self, path: str):
        import regex

        self.rules, self.words, self.older = Merges(path), regex.compile(WORDS), {}

    def __missing__(self, word: str) -> int:
        n = self.older.get(word)
        if n is None:
            raw = word.encode("utf-8", "surrogatepass")
            symbols = [*map(self.rules.inner.__getitem__, raw)]
            symbols[-1] = self.rules.last[raw[-1]]
            n = len(raw) - merged(symbols, self.rules.pair)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = n
        return n

    def _plain(self, text: str) -> int:
        # white space only parts words, so runs of it needn't be replaced; each letter is lowered for itself
        if text.isascii():
            low, split = text.lower(), ASCII_WORDS
        else:
            low, split = unicodedata.normalize("NFC", text).replace("Σ", "σ"), self.words
            for upper, lower in NEWER.items():
                low = low.replace(upper, lower)
            low = low.lower()
        if len(low) > LIST_CHARS:
            return sum(self[m.group()] for m in split.finditer(low))
        return sum(map(self.__getitem__, split.findall(low)))

    def count(self, text: str) -> int:
        total, at = 0, 0
        if self.rules.special:
            for m in self.rules.special.finditer(text):
                total += self._plain(text[at : m.start()]) + 1
                at = m.end()
        return total + self._plain(text[at:] if at else text)


def counter(path: str) -> Counter:
    """The counter of a file, one per process."""
    kept = flat.process_store()
    if (key := f"token counts {path}") not in kept:
        kept[key] = Counter(path)
    return kept[key]


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        count = counter(path).count
        for b in flat.slices(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            _, ends = flat.buffers(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ends[1:] - ends[:-1], pa.int64()), pa.array([count(t) for t in texts], pa.int64())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
