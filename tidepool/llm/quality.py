"""Document quality by a factorisation machine.

Inputs of a text are its distinct hashed words, structure statistics and the length metadata, each statistic as one
of a few quantile bins. The score is the logistic of a bias, a weight per input, and low-rank interactions of all
pairs of inputs, which the identity sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)
gives in linear time. The machine is fitted by AdaGrad on the driver on a bounded sample of labelled rows; inputs and
scores of all documents are computed on the executors. The driver holds two bytes for each distinct word of a sampled
text, and makes indices and values of one step's texts at a time.

Defined cases: null or empty text has no words and the bins of zero statistics; without labels of both classes the
score is the base rate (0 without any label); repeated rows get a row each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .labelled import SAMPLE_ROWS, filtered, remainder, sample
from .scratch import cut, drop

WORDS = 1 << 15
BINS = 16
STATS = 20
RANK = 6
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#$%&*@^~|<>{}[]\\/=+_", dtype=np.uint8)] = True


def inputs(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics by text, and (doc, bucket) of its distinct words."""
    raw, offs = flat.buffers(col)
    w = flat.words(col)
    n = len(offs) - 1
    size, count = np.diff(offs).astype(float), w.count.astype(float)
    some, chars = np.maximum(count, 1), np.maximum(size, 1)

    def per(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[offs[1:]] - total[offs[:-1]]).astype(float)

    upper, lower_ = per((raw >= 65) & (raw <= 90)), per((raw >= 97) & (raw <= 122))
    letters = np.maximum(upper + lower_, 1)
    by_word = lambda v: np.bincount(w.doc, weights=v, minlength=n)
    length = (w.end - w.start).astype(float)
    doc, token = flat.distinct(w.doc, w.hash)
    kinds = np.bincount(doc, minlength=n).astype(float)
    if len(w.hash):
        order = np.lexsort((w.hash, w.doc))
        edge = np.flatnonzero(np.concatenate([[True], (np.diff(w.doc[order]) != 0) | (w.hash[order][1:] != w.hash[order][:-1]), [True]]))
        top = np.zeros(n)
        np.maximum.at(top, w.doc[order][edge[:-1]], np.diff(edge))
        last = w.low[w.end - 1]
        longest = np.zeros(n)
        np.maximum.at(longest, w.doc, length)
    else:
        top, longest, last = np.zeros(n), np.zeros(n), np.zeros(0, np.uint8)
    # lines, and those that an earlier line of the text repeats
    cuts = np.unique(np.concatenate([offs, np.flatnonzero(raw == 10) + 1])) if len(raw) else offs[:1]
    s, e = cuts[:-1], cuts[1:]
    e = e - ((e > s) & (raw[np.maximum(e - 1, 0)] == 10)) if len(s) else e
    s, e = s[e > s], e[e > s]
    line_doc = np.searchsorted(offs, s, "right") - 1
    lines = np.bincount(line_doc, minlength=n).astype(float)
    line_kinds = np.bincount(flat.distinct(line_doc, flat.span_hash(raw, s, e))[0], minlength=n) if len(s) else np.zeros(n)
    two = w.hash[:-1] * flat.U(flat.BASE) + w.hash[1:]
    inside = w.doc[:-1] == w.doc[1:]
    pairs = np.bincount(w.doc[:-1][inside], minlength=n).astype(float)
    pair_kinds = np.bincount(flat.distinct(w.doc[:-1][inside], two[inside])[0], minlength=n)
    stats = np.column_stack([
        np.log1p(count), np.log1p(size), by_word(length) / some, np.log1p(longest), upper / letters, per(SYMBOLS[raw]) / chars,
        per((raw >= 48) & (raw <= 57)) / chars, per((raw == 33) | (raw == 63)) / chars, per((raw == 46) | (raw == 44)) / chars, per(raw >= 128) / chars,
        kinds / some, top / some, np.log1p(lines), 1 - line_kinds / np.maximum(lines, 1), count / np.maximum(lines, 1), 1 - pair_kinds / np.maximum(pairs, 1),
        by_word(SYMBOLS[last]) / some, by_word((last == 33) | (last == 63)) / some, by_word((last == 46) | (last == 44)) / some, by_word(length <= 3) / some,
    ])
    return stats, doc, (token % flat.U(WORDS)).astype(np.int64)


def bins(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bin of each statistic of each text."""
    return np.column_stack([np.searchsorted(edges[j], stats[:, j], "left") for j in range(STATS)]).astype(np.int16)


def rows(count: np.ndarray, bucket: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, input, value) sorted by doc, of texts with ``count`` buckets each: words weigh 1 together, statistics 1 each."""
    n = len(count)
    doc, ends = np.repeat(np.arange(n), count), np.cumsum(count + STATS)
    words, stats = np.arange(len(doc)) + STATS * doc, ends[:, None] - STATS + np.arange(STATS)
    i, v = np.empty(len(doc) + n * STATS, dtype=np.int64), np.empty(len(doc) + n * STATS)
    i[words], v[words] = bucket, (1 / np.sqrt(np.maximum(count, 1)))[doc]
    i[stats], v[stats] = WORDS + np.arange(STATS) * BINS + code, 0.5
    return np.repeat(np.arange(n), count + STATS), i, v


class Machine:
    """Bias, weights and factors; log loss."""

    def __init__(self, seed: int = 5):
        size = WORDS + STATS * BINS
        self.bias = 0.0
        self.w = np.zeros(size)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (size, RANK))

    def margin(self, d: np.ndarray, i: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.bias) + np.bincount(d, weights=self.w[i] * x, minlength=n)
        for f in range(RANK):
            vx = self.v[i, f] * x
            out += 0.5 * (np.bincount(d, weights=vx, minlength=n) ** 2 - np.bincount(d, weights=vx * vx, minlength=n))
        return out

    def fit(self, count, words, code, y, epochs: int = 12, batch: int = 256, steps: int = 500, rate: float = 0.08, l2: float = 2e-3) -> Machine:
        """At least ``epochs`` passes and ``steps`` steps over texts with ``count`` buckets each, in ``words``, and their bins."""
        n = len(y)
        epochs = max(epochs, -(-steps // max(1, n // batch)))
        first = np.cumsum(count) - count
        p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(p0 / (1 - p0)))
        gw, gv = np.full(len(self.w), 1e-3), np.full(self.v.shape, 1e-3)
        rng = np.random.default_rng(11)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(n), max(1, n // batch)):
                size, ends = count[part], len(part)
                at = np.repeat(first[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
                dd, ii, xx = rows(size, words[at], code[part])
                err = 1 / (1 + np.exp(-np.clip(self.margin(dd, ii, xx, ends), -30, 30))) - y[part]
                used, inv = np.unique(ii, return_inverse=True)
                e = err[dd] * xx
                g = np.bincount(inv, weights=e) / ends + l2 * self.w[used] / ends
                gw[used] += g * g
                self.w[used] -= rate * g / np.sqrt(gw[used])
                step = np.empty((len(used), RANK))
                for f in range(RANK):
                    vf = self.v[ii, f]
                    s = np.bincount(dd, weights=vf * xx, minlength=ends)
                    step[:, f] = np.bincount(inv, weights=e * (s[dd] - vf * xx)) / ends
                step += l2 * self.v[used] / ends
                gv[used] += step * step
                self.v[used] -= rate * step / np.sqrt(gv[used])
                self.bias -= rate * float(err.mean())
        return self


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """(bin edges, machine state), or (None, base rate) where only one class has labels."""
    train = cut(sample(docs, labels, "quality", sample_rows), "train")
    kind = pa.schema([("y", pa.int32()), ("stats", pa.list_(pa.float64())), ("words", pa.list_(pa.int16()))])

    def extract(batches):
        for b in flat.slices(batches):
            stats, doc, bucket = inputs(b.column("text"))
            ends = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * STATS), pa.array(stats.ravel())), pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int16)))], schema=kind)

    got = train.orderBy("doc_id").mapInArrow(extract, "y int, stats array<double>, words array<smallint>").toArrow()
    drop(train)
    y = got.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return None, float(y.mean()) if len(y) else 0.0
    stats = got.column("stats").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, STATS)
    words = got.column("words").combine_chunks()
    del got
    count = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    m = Machine().fit(count, words.flatten().to_numpy(zero_copy_only=False), bins(stats, edges), y)
    return edges, (m.bias, m.w.astype(np.float32), m.v.astype(np.float32))


def _scores(model):
    """A function of a text column that gives its scores."""
    edges, state = model.value
    if edges is None:
        return lambda col: np.full(len(col), state)
    m = Machine.__new__(Machine)
    m.bias, m.w, m.v = state

    def score(col: pa.Array) -> np.ndarray:
        stats, doc, bucket = inputs(col)
        return 1 / (1 + np.exp(-np.clip(m.margin(*rows(np.bincount(doc, minlength=len(col)), bucket, bins(stats, edges)), len(col)), -30, 30)))

    return score


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= threshold)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample_rows))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        score = _scores(model)
        for b in flat.slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score(b.column("text")), pa.float64())], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_only(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``threshold``; without any label all rows."""
    fitted = fit(docs, labels, sample_rows)
    if fitted[0] is None:
        return docs
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    return filtered(docs, lambda: _scores(model), lambda s: s >= threshold)
