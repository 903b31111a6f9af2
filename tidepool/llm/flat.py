"""Flat byte arrays for Arrow string columns: words, hashes and n-grams of many texts at once.

Words are maximal runs of bytes other than space and 0x09-0x0D; A-Z are lowered. Nothing here loops over
rows: a text column is one byte buffer with offsets, and every step is a numpy pass over it. Callers feed
slices of bounded size (:func:`slices`), so memory doesn't depend on the Arrow batch.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INV = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 2 << 20


class _Cache(dict):
    """Per process; travels empty when a function that uses it is sent to an executor."""

    def __reduce__(self):
        return _Cache, ()


def process_store() -> dict:
    """One dictionary per process: task functions travel with a copy of this module, so its own globals don't last."""
    return sys.modules.setdefault("_tidepool_process", types.ModuleType("_tidepool_process")).__dict__


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = _Cache()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        def table(b: int) -> np.ndarray:
            out = np.ones(1, dtype=U)
            step = b
            while len(out) < size:
                out = np.concatenate([out, out * U(step)])
                step = step * step % (1 << 64)
            return out
        _powers.clear()
        _powers[size] = table(BASE), table(INV)
    return _powers[size]


@dataclass
class Words:
    """Words of several texts, in order. ``first``: index of each text's first word, with one more entry."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(batches, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about ``limit`` bytes of text or a single row."""
    for b in batches:
        if b.num_rows == 0:
            continue
        _, offs = buffers(b.column(b.schema.get_field_index(text)))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


def lower(raw: np.ndarray) -> np.ndarray:
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def span_hash(low: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte ranges (not empty), all from one running polynomial sum."""
    pw, inv = _pow(len(low) + 1)
    total = np.zeros(len(low) + 1, dtype=U)
    np.cumsum((low.astype(U) + U(1)) * pw[: len(low)], out=total[1:])
    h = (total[end] - total[start]) * inv[start]
    return mix(h ^ mix((end - start).astype(U) + U(seed * 2 + 1)))


def words(col: pa.Array) -> Words:
    raw, offs = buffers(col)
    low = lower(raw)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    inside = ~space
    begin = inside.copy()
    begin[1:] &= space[:-1]
    stop = inside.copy()
    stop[:-1] &= space[1:]
    edge = np.unique(offs[(offs > 0) & (offs < len(low))])
    begin[edge] |= inside[edge]
    stop[edge - 1] |= inside[edge - 1]
    start = np.flatnonzero(begin)
    end = np.flatnonzero(stop) + 1
    first = np.searchsorted(start, offs).astype(np.int64)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    h = span_hash(low, start, end) if len(start) else np.zeros(0, U)
    return Words(low, start, end, doc, first, h)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of every run of k words; a text with fewer words gives its whole sequence, one without none."""
    n = w.count
    total = len(w.hash)
    place = np.arange(total) - np.repeat(w.first[:-1], n)
    left = np.repeat(n, n) - place
    at = np.flatnonzero(left >= k)
    h = np.zeros(len(at), dtype=U)
    for i in range(k):
        h = h * U(BASE) + w.hash[at + i]
    doc, h = w.doc[at], mix(h ^ U(k))
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        hs = np.zeros(len(short), dtype=U)
        for i in range(k - 1):
            on = n[short] > i
            nxt = w.hash[np.minimum(w.first[short] + i, max(total - 1, 0))]
            hs = np.where(on, hs * U(BASE) + nxt, hs)
        doc = np.concatenate([doc, short])
        h = np.concatenate([h, mix(hs ^ (n[short].astype(U) << U(40)))])
    return doc, h


def distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, hash), sorted by both."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    if len(h):
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        doc, h = doc[keep], h[keep]
    return doc, h


def strings(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    b = low.tobytes()
    return [b[s:e].decode("utf-8", "replace") for s, e in zip(start.tolist(), end.tolist(), strict=True)]
