"""Hierarchical multi-length packing of tokenised documents.

Documents are tokenised and closed by an end id. Full long windows of a document stand alone; what is left of it is
routed to the tier (context size) that just holds it. Each tier is packed from the longest down: a piece opens a
window of its tier and the gap behind it is filled from shorter tiers, the last filler being cut where the window
ends and its rest routed anew. So every window is full at a power of two and nothing is padded; only the last
leftovers of a task are cut into powers of two. Windows are dealt to step groups, longest first: as sizes are powers of
two, groups fill up exactly, and windows that fill none wait for the next ones. So every step group but the last of a
task has the same number of tokens, ``STEP_TOKENS`` (a multiple of the longest size).

Work is per task over a stream of documents with a pool of bounded size, so there is no shuffle, and no document set
is held whole. Task retries give the same rows, since ids come from the partition number and a counter.

Defined cases: null or empty text is one piece, the end id alone; documents longer than a window are cut; repeated
rows are packed each; an empty table gives no row; other columns are ignored. Special strings of the vocabulary in a
text become their special ids, as the tokenizers library does by default.
"""

from __future__ import annotations

import json
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat

TIERS = (1024, 512, 256, 128)
POOL_TOKENS = 1 << 19
STEP_TOKENS = 32 * 1024
# Fixed value: the split rule of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

def _byte_of() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 as itself, the others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str):
    """text -> numpy ids, from a byte-level BPE file in the tokenizers library's format; one per process."""
    kept = flat.process_store()
    if (key := f"packing {path}") not in kept:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        bpe = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        kept[key] = bpe, list(special)
    bpe, special = kept[key]

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(bpe.encode(text, allowed_special="all"), dtype=np.uint32)
        return bpe.encode_to_numpy(text).astype(np.uint32)

    return encode


class Packer:
    """Pools of pieces by tier; a piece is (doc number, start, ids). ``out`` takes finished windows."""

    def __init__(self, tiers=TIERS, pool_tokens: int = POOL_TOKENS):
        self.tiers, self.limit = tuple(sorted(tiers, reverse=True)), pool_tokens
        self.pools = {w: deque() for w in self.tiers}
        self.held = 0
        self.out: list[tuple[int, list]] = []

    def _pool(self, piece, front: bool = False) -> None:
        w = next((w for w in reversed(self.tiers) if len(piece[2]) <= w), self.tiers[0])
        (self.pools[w].appendleft if front else self.pools[w].append)(piece)
        self.held += len(piece[2])

    def add(self, doc: int, ids: np.ndarray) -> None:
        top, at = self.tiers[0], 0
        while len(ids) - at >= top:
            self.out.append((top, [(doc, at, ids[at : at + top])]))
            at += top
        if at < len(ids):
            self._pool((doc, at, ids[at:]))
        if self.held >= self.limit:
            self.drain()

    def _next(self, below: int):
        """A filler: from the longest shorter tier that has one, else from the tier itself."""
        for w in (*[w for w in self.tiers if w < below], below):
            if self.pools[w]:
                piece = self.pools[w].popleft()
                self.held -= len(piece[2])
                return piece
        return None

    def drain(self, last: bool = False) -> None:
        for w in self.tiers:
            while self.pools[w]:
                window, gap = [], w
                while gap and (p := self._next(w) if window else self.pools[w].popleft()) is not None:
                    if not window:
                        self.held -= len(p[2])
                    doc, start, ids = p
                    window.append((doc, start, ids[:gap]))
                    if len(ids) > gap:
                        self._pool((doc, start + gap, ids[gap:]), front=True)
                    gap -= len(window[-1][2])
                if not gap:
                    self.out.append((w, window))
                    continue
                if last:
                    self._powers(window, w - gap)
                else:
                    for p in reversed(window):
                        self._pool(p, front=True)
                break  # what is left fills no window of this tier

    def _powers(self, window: list, n: int) -> None:
        pieces = deque(window)
        for w in (1 << b for b in range(n.bit_length() - 1, -1, -1)):
            if not n & w:
                continue
            part, gap = [], w
            while gap:
                doc, start, ids = pieces.popleft()
                part.append((doc, start, ids[:gap]))
                if len(ids) > gap:
                    pieces.appendleft((doc, start + gap, ids[gap:]))
                gap -= len(part[-1][2])
            self.out.append((w, part))


def _pack(path: str, tiers, pool_tokens: int, end_id: int, step_tokens: int, with_ids: bool):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group"]
    schema = pa.schema([(n, pa.int64()) for n in names] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches):
        encode, packer = encoder(path), Packer(tiers, pool_tokens)
        base = TaskContext.get().partitionId() << 33
        ids_of: dict[int, tuple] = {}
        made = tokens = doc = 0
        waiting: list = []  # windows of a step group that isn't full
        tail = np.array([end_id], dtype=np.uint32)

        def rows(last: bool = False):
            nonlocal made, tokens, waiting
            windows = sorted(waiting + packer.out, key=lambda x: -x[0])  # longest first, so that steps fill up exactly
            full, held = 0, 0
            for i, (w, _) in enumerate(windows, 1):
                held += w
                if held % step_tokens == 0:
                    full = i
            full = len(windows) if last else full
            windows, waiting, packer.out = windows[:full], windows[full:], []
            got = []
            for w, parts in windows:
                at = 0
                for d, start, ids in parts:
                    doc_id, n = ids_of[d]
                    got.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, base + made, at, w, base + tokens // step_tokens, ids))
                    at += len(ids)
                made, tokens = made + 1, tokens + w
            if got:
                cols = list(zip(*got, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in cols[:9]] + ([pa.array([x.astype(np.int32) for x in cols[9]], pa.list_(pa.int32()))] if with_ids else [])
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        for b in flat.slices(batches):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.concatenate([encode(text or ""), tail])
                ids_of[doc] = doc_id, len(ids)
                packer.add(doc, ids)
                doc += 1
            yield from rows()
            live = {p[0] for pool in packer.pools.values() for p in pool} | {p[0] for _, parts in waiting for p in parts}
            ids_of = {d: ids_of[d] for d in live}
        packer.drain()
        packer.drain(last=True)
        yield from rows(last=True)

    kinds = ", ".join(f"{n} long" for n in names) + (", ids array<int>" if with_ids else "")
    return run, kinds


def pack(docs: DataFrame, path: str, tiers=TIERS, end_id: int = 0, pool_tokens: int = POOL_TOKENS, step_tokens: int = STEP_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window
    (tokens of the sequence), step_group, and ids where asked for. ``tiers`` are powers of two, ``step_tokens`` a multiple
    of the longest."""
    if any(w & (w - 1) for w in tiers) or step_tokens % max(tiers):
        raise ValueError("tiers must be powers of two, and step_tokens a multiple of the longest")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run, kinds = _pack(path, tuple(tiers), pool_tokens, end_id, step_tokens, with_ids)
    return docs.mapInArrow(run, kinds)
