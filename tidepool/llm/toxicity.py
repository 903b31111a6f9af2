"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of two lexicons (whole words, five-byte word stems), how near their hits stand
to a second-person word, capitals, punctuation, and obfuscation (digits or symbols inside words, hits that appear
only after undoing look-alike characters, stretched letters). The lexicons are learned on the training sample: words
and stems whose toxic share is far above the base rate by the log-likelihood ratio. Trees are fitted on a bounded
sample on the driver, the margins of a held part of it calibrated by pool-adjacent-violators; features and scores of
all documents are computed on the executors.

Defined cases: null or empty text has zero features and the score that the model gives them; without labels of both
classes the score is the base rate (0 without any label); repeated rows each get a row; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .labelled import SAMPLE_ROWS, filtered, remainder, sample
from .scratch import cut, drop

# Second-person words of the four languages.
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes", "vosotros", "tus"]
# Look-alike characters and the letters they stand for.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
NEAR = 5
STEM = 5
FEATURES = 19


def _letters(low: np.ndarray) -> np.ndarray:
    return ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128)


def _runs(mask: np.ndarray, offs: np.ndarray):
    """Start, end and text of every run of ``mask`` within a text."""
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    edge = np.unique(offs[(offs > 0) & (offs < len(mask))])
    begin[edge] |= mask[edge]
    stop = mask.copy()
    stop[:-1] &= ~mask[1:]
    stop[edge - 1] |= mask[edge - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def tokens(col: pa.Array):
    """Lowered bytes, offsets, and (doc, word hash, stem hash) of the letter runs of each text."""
    raw, offs = flat.buffers(col)
    low = flat.lower(raw)
    start, end, doc = _runs(_letters(low), offs)
    if not len(start):
        return raw, low, offs, start, end, doc, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    word = flat.span_hash(low, start, end)
    stem = np.where(end - start >= STEM, flat.span_hash(low, start, np.minimum(start + STEM, end), 1), np.uint64(0))
    return raw, low, offs, start, end, doc, word, stem


def _has(sorted_set: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_set) or not len(x):
        return np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_set, x), len(sorted_set) - 1)
    return sorted_set[at] == x


def _vocabulary(words: list[str]) -> np.ndarray:
    low, offs = flat.buffers(pa.array(words))
    return np.sort(flat.span_hash(low, offs[:-1], offs[1:]))


def features(col: pa.Array, lexicon: np.ndarray, stems: np.ndarray, persons: np.ndarray) -> np.ndarray:
    raw, low, offs, start, end, doc, word, stem = tokens(col)
    n = len(offs) - 1
    size = np.maximum(np.diff(offs), 1).astype(float)
    per = lambda d, w=None: np.bincount(d, weights=w, minlength=n).astype(float)
    words = np.maximum(per(doc), 1)
    hit = _has(lexicon, word)
    by_stem = _has(stems, stem) & (stem != 0)
    any_hit = hit | by_stem
    you = _has(persons, word)
    # distance in words from each hit to the nearest second-person word of the same text
    at, yous = np.flatnonzero(any_hit), np.flatnonzero(you)
    near = np.zeros(len(at), dtype=bool)
    if len(yous) and len(at):
        k = np.searchsorted(yous, at)
        for side in (np.maximum(k - 1, 0), np.minimum(k, len(yous) - 1)):
            j = yous[side]
            near |= (np.abs(j - at) <= NEAR) & (doc[j] == doc[at])
    table = np.arange(256, dtype=np.uint8)
    for a, b in LOOKALIKE.items():
        table[ord(a)] = ord(b)
    wide = _letters(low) | np.isin(low, np.frombuffer("".join(LOOKALIKE).encode(), np.uint8))
    s2, e2, d2 = _runs(wide, offs)
    masked = np.zeros(n)
    if len(s2):
        digits = np.concatenate([[0], np.cumsum((low >= 48) & (low <= 57))])
        odd = np.concatenate([[0], np.cumsum(wide & (table != np.arange(256))[low])])
        alpha = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
        mixed = (odd[e2] > odd[s2]) & (alpha[e2] > alpha[s2])
        digit_mixed = per(d2[mixed & (digits[e2] > digits[s2])])
        if mixed.any():
            plain = flat.span_hash(table[low], s2[mixed], e2[mixed])
            masked = per(d2[mixed][_has(lexicon, plain)])
        mixed_n = per(d2[mixed])
    else:
        digit_mixed = mixed_n = np.zeros(n)
    where = np.searchsorted(offs, np.arange(1, len(low)), "right") - 1 if len(low) else np.zeros(0, int)
    run3 = np.flatnonzero((low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & (low[2:] >= 97) & (low[2:] <= 122)) if len(low) > 2 else np.zeros(0, int)
    at_doc = lambda mask: per(np.searchsorted(offs, np.flatnonzero(mask), "right") - 1)
    del where
    upper = at_doc((raw >= 65) & (raw <= 90))
    letters = np.maximum(at_doc((low >= 97) & (low <= 122)), 1)
    punct = at_doc((low > 32) & (low < 128) & ~_letters(low))
    bang = at_doc((raw == 33) | (raw == 63))
    ups = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90))])
    shout = per(doc, ((ups[end] - ups[start]) >= np.maximum(end - start, 2)).astype(float)) if len(start) else np.zeros(n)
    hits, stem_hits = per(doc[hit]), per(doc[by_stem])
    return np.column_stack([
        np.log1p(words), np.log1p(hits), hits / words, np.log1p(stem_hits), stem_hits / words, np.log1p(per(doc[any_hit])), per(doc[any_hit]) / words,
        per(doc[at[near]]), per(doc[at[near]]) / np.maximum(per(doc[any_hit]), 1), per(doc[you]) / words,
        upper / letters, shout / words, punct / size, bang / size, mixed_n / words, digit_mixed / words, masked, masked / words,
        per(np.searchsorted(offs, run3, "right") - 1) / words if len(run3) else np.zeros(n),
    ])


def _counts(batches):
    """Documents with each word or stem, by class, summed over a task."""
    schema = pa.schema([("kind", pa.int32()), ("token", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])
    for b in flat.slices(batches):
        *_, doc, word, stem = tokens(b.column("text"))
        y = b.column("y").to_numpy(zero_copy_only=False).astype(bool)
        for kind, h in ((0, word), (1, stem)):
            d, t = flat.distinct(doc[h != 0], h[h != 0])
            u, inv = np.unique(t, return_inverse=True)
            pos = np.bincount(inv, weights=y[d], minlength=len(u)).astype(np.int64) if len(u) else np.zeros(0, np.int64)
            alln = np.bincount(inv, minlength=len(u)).astype(np.int64) if len(u) else np.zeros(0, np.int64)
            on = pos > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.full(on.sum(), kind, np.int32)), pa.array(u[on].view(np.int64)), pa.array(pos[on]), pa.array((alln - pos)[on])], schema=schema)


def _clean_counts(wanted):
    schema = pa.schema([("kind", pa.int32()), ("token", pa.int64()), ("clean", pa.int64())])

    def run(batches):
        for b in flat.slices(batches):
            *_, doc, word, stem = tokens(b.column("text"))
            y = b.column("y").to_numpy(zero_copy_only=False).astype(bool)
            for kind, h in ((0, word), (1, stem)):
                on = _has(wanted[kind], h) & ~y[doc] if len(doc) else np.zeros(0, bool)
                d, t = flat.distinct(doc[on], h[on])
                u, c = np.unique(t, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int32)), pa.array(u.view(np.int64)), pa.array(c.astype(np.int64))], schema=schema)

    return run


def learn_lexicons(rows: DataFrame, positives: int, negatives: int, most: int = 4_000, ratio: float = 30.0):
    """Words and stems far more frequent in toxic texts: 2 * log-likelihood ratio >= ``ratio``, the best ``most`` of each."""
    spark_rows = rows.select("text", "y")
    base = positives / (positives + negatives)
    # a token needs this many toxic texts to reach the ratio even without one clean text
    least = max(3, int(np.ceil(ratio / (2 * np.log(1 / base)))))
    toxic = spark_rows.where("y = 1").mapInArrow(_counts, "kind int, token long, toxic long, clean long").groupBy("kind", "token").agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= least)
    top = toxic.orderBy(F.desc("toxic"), "kind", "token").limit(20 * most).collect()
    seen = [dict(), dict()]
    for r in top:
        seen[r.kind][r.token] = [r.toxic, 0]
    wanted = [np.sort(np.array(list(s), dtype=np.int64).view(np.uint64)) for s in seen]
    for r in spark_rows.where("y = 0").mapInArrow(_clean_counts(wanted), "kind int, token long, clean long").groupBy("kind", "token").agg(F.sum("clean").alias("clean")).collect():
        seen[r.kind][r.token][1] = r.clean
    out = []
    for s in seen:
        token = np.array(list(s), dtype=np.int64).view(np.uint64)
        c = np.array(list(s.values()), dtype=float).reshape(-1, 2)
        k, n = c[:, 0], c.sum(axis=1)
        p = np.clip(k / np.maximum(n, 1), 1e-9, 1 - 1e-9)
        g = 2 * (k * np.log(p / base) + (n - k) * np.log((1 - p) / (1 - base)))
        good = (g >= ratio) & (p >= min(0.9, 4 * base))
        order = np.argsort(-g[good], kind="stable")[:most]
        out.append(np.sort(token[good][order]))
    return out


class Trees:
    """Boosted trees of fixed depth on binned features, for log loss; flat arrays, so they're cheap to ship."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, l2: float = 1.0, least: int = 5):
        self.rounds, self.depth, self.rate, self.bins, self.l2, self.least = rounds, depth, rate, bins, l2, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        edges = [np.unique(np.concatenate([e, [0.0]])) for e in edges]
        code = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
        width = max(len(e) for e in edges) + 1
        p0 = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(p0 / (1 - p0)))
        m = np.full(len(y), self.start)
        nodes = (1 << self.depth) - 1
        self.feature = np.zeros((self.rounds, nodes), np.int32)
        self.cut = np.full((self.rounds, nodes), np.inf)
        self.value = np.zeros((self.rounds, nodes + 1))
        for r in range(self.rounds):
            p = 1 / (1 + np.exp(-m))
            g, h = y - p, p * (1 - p) + 1e-9
            at = np.zeros(len(y), dtype=np.int64)
            for level in range(self.depth):
                here = 1 << level
                best = np.full(here, 1e-6)
                feat, where = np.zeros(here, np.int32), np.full(here, -1)
                for j in range(x.shape[1]):
                    key = at * width + code[:, j]
                    gs, hs, ns = (np.bincount(key, weights=w, minlength=here * width).reshape(here, width) for w in (g, h, None))
                    gl, hl, nl = gs.cumsum(1), hs.cumsum(1), ns.cumsum(1)
                    gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
                    gain = gl**2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt**2 / (ht + self.l2)
                    gain[(nl < self.least) | (nt - nl < self.least)] = -1
                    gain = gain[:, : len(edges[j])]
                    k = gain.argmax(1)
                    v = gain[np.arange(here), k]
                    better = v > best
                    best[better], feat[better], where[better] = v[better], j, k[better]
                for i in range(here):
                    if where[i] >= 0:
                        self.feature[r, here - 1 + i] = feat[i]
                        self.cut[r, here - 1 + i] = edges[feat[i]][where[i]]
                f = self.feature[r, here - 1 + at]
                at = 2 * at + (x[np.arange(len(y)), f] > self.cut[r, here - 1 + at])
            gs, hs = (np.bincount(at, weights=w, minlength=nodes + 1) for w in (g, h))
            self.value[r] = self.rate * gs / (hs + self.l2)
            m += self.value[r][at]
        return self

    @classmethod
    def of(cls, state: dict) -> Trees:
        out = cls()
        vars(out).update(state)
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        m = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for r in range(self.rounds):
            at = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                node = (1 << level) - 1 + at
                at = 2 * at + (x[rows, self.feature[r, node]] > self.cut[r, node])
            m += self.value[r][at]
        return m


def isotonic(m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: margins and the non-decreasing rates between which scores are interpolated."""
    order = np.argsort(m, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(m[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([b, 1.0, a, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, hi = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = hi
    at, rate = [], []
    for s, n, lo, hi in blocks:
        r = (s + 0.05) / (n + 0.1)
        at += [lo, hi]
        rate += [r, r]
    return np.array(at), np.maximum.accumulate(np.array(rate))


def _scores(model):
    """A function of a text column that gives its scores."""
    lexicon, stems, persons, state, at, rate, base = model.value
    trees = None if state is None else Trees.of(state)

    def score(col: pa.Array) -> np.ndarray:
        if trees is None:
            return np.full(len(col), base)
        m = trees.margin(features(col, lexicon, stems, persons))
        # the margin itself breaks the ties inside a calibrated step
        return 0.98 * np.interp(m, at, rate) + 0.02 / (1 + np.exp(-m))

    return score


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS):
    """Lexicons, trees and calibration from at most ``rows`` labelled training documents."""
    train = cut(sample(docs, labels, "toxic", rows), "train")
    counts = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    persons = _vocabulary(SECOND_PERSON)
    pos, neg = counts.get(1, 0), counts.get(0, 0)
    empty = np.zeros(0, np.uint64)
    if not pos or not neg:
        return empty, empty, persons, None, None, None, float(pos > 0)
    lexicon, stems = learn_lexicons(train, pos, neg)

    def extract(batches):
        schema = pa.schema([("y", pa.int32()), ("part", pa.int32()), ("x", pa.list_(pa.float64()))])
        for b in flat.slices(batches):
            x = features(b.column("text"), lexicon, stems, persons)
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("part"), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * FEATURES, pa.array(x.ravel()))], schema=schema)

    got = train.orderBy("doc_id").mapInArrow(extract, "y int, part int, x array<double>").toArrow()
    drop(train)
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
    y, part = (got.column(c).to_numpy().astype(float) for c in ("y", "part"))
    held = part == 0
    fitted = [~held, held] if min(y[~held].sum(), (1 - y[~held]).sum(), y[held].sum(), (1 - y[held]).sum()) > 0 else [y > -1, y > -1]
    trees = Trees().fit(x[fitted[0]], y[fitted[0]])
    at, rate = isotonic(trees.margin(x[fitted[1]]), y[fitted[1]])
    return lexicon, stems, persons, vars(trees), at, rate, pos / (pos + neg)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= threshold)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        score = _scores(model)
        for b in flat.slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score(b.column("text")), pa.float64())], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    return filtered(docs, lambda: _scores(model), lambda s: s < threshold)
