"""Language-model scores by a probabilistic suffix tree over words.

Tokens are the words of a text (A-Z lowered) and one end. A context is up to ``depth`` preceding symbols, a start mark
among them. Candidates are contexts that make up at least ``p_min`` of the training positions, by default
``SHARE`` over the cube root of the training bytes, so the number of contexts grows with the corpus, by one rule at
every size, and what is broadcast stays within memory (7e-8 at 100 TB: 29 million a depth at most). A candidate is kept as
a state if its next-symbol distribution diverges from that of its longest suffix: the leave-one-out log-likelihood
gain over the suffix (an unbiased form of n * KL divergence, safe for rare symbols) must reach ``gain`` nats. A token is
scored by the longest kept suffix of what precedes it. Distributions are smoothed towards the next shorter state by
P(x|s) = (n(s,x) + T(s) P(x|parent)) / (n(s) + T(s)), T(s) the number of different symbols seen after s, down to the root
(c + 0.1) / (N + 0.1 (V + 1)); they sum to 1 over the vocabulary and one unknown symbol.

Flow: (1) every task counts its contexts in bounded memory (lossy counting) and reports the frequent ones; a context with
``p_min`` of all positions has half of that among the reports, so at most 2 / p_min candidates a depth are broadcast.
(2) Next-symbol counts of the candidates and the root are pre-aggregated by slice and dealt by the next symbol, so that
all contexts of a symbol meet and n(s,x), P(x|parent) and the gains need no further join. The counts grow with the
corpus and are never broadcast. (3) The tokens of all documents are dealt by the same rule to the counts, scored, and
summed by document. Slices and parts are packed arrays of bounded size.

Defined cases: null or empty text is the end alone; a token never seen has the unknown symbol's probability; repeated
rows get a row each; without training rows N and V are 0; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .labelled import remainder
from .scratch import cut

U = np.uint64
START, END = U(0x51A7), U(0xE4D)
SLICE = 1 << 20
MERGE = 400_000
#: Entries of one packed row of counts, unless one symbol has more; training tokens that one scoring group may hold.
ROW, GROUP = 1 << 17, 4_000_000
DEPTH, GAIN = 3, 12.0
#: The least share of a context times the cube root of the training bytes: 4e-6 at half a gigabyte.
SHARE = 3.2e-3
ALPHA = 0.1
NO_ID = np.iinfo(np.int64).min


def symbols(col: pa.Array, depth: int):
    """(text, next symbol, context hashes by depth with 0 where there is none) of every token."""
    w = flat.words(col)
    texts = len(w.first) - 1
    begin = w.first[:-1] + np.arange(texts)
    size = w.count + 1
    doc = np.repeat(np.arange(texts), size)
    n = len(w.hash) + texts
    ends, begins = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    ends[begin + size - 1] = True
    begins[begin] = True
    x, before = np.full(n, END), np.full(n, START)
    x[~ends] = w.hash
    before[~begins] = w.hash
    place = np.arange(n) - np.repeat(begin, size)
    contexts = []
    h = np.zeros(n, dtype=U)
    for k in range(depth):
        older = np.concatenate([np.zeros(min(k, n), U), before[: max(n - k, 0)]])
        h = np.where(place >= k, flat.mix(h * U(flat.BASE) + older + U(k + 1)), U(0))
        contexts.append(h)
    return doc, x, contexts


def _candidates(depth: int, p_min: float, parts: int):
    """Lossy counting: a task's count of a context falls short by half of ``p_min`` of the task's tokens at most."""
    schema = pa.schema([("part", pa.int32()), ("h", pa.binary()), ("parent", pa.binary()), ("n", pa.binary()), ("tokens", pa.int64())])
    eps = p_min / 4

    def run(batches):
        kept = [(np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.float32)) for _ in range(depth)]
        tokens = 0
        for b in flat.slices(batches, limit=SLICE):
            _, x, contexts = symbols(b.column("text"), depth)
            before, tokens = eps * tokens, tokens + len(x)
            for k in range(depth):
                on = contexts[k] != 0
                h, first, n = np.unique(contexts[k][on], return_index=True, return_counts=True)
                parent = contexts[k - 1][on][first] if k else np.zeros(len(h), dtype=U)
                old = kept[k]
                at = np.minimum(np.searchsorted(old[0], h), max(len(old[0]) - 1, 0))
                known = old[0][at] == h if len(old[0]) else np.zeros(len(h), dtype=bool)
                old[2][at[known]] += n[known]
                # what came in late may have been missed so often before; what can't be frequent goes
                stay, fresh = old[2] + old[3] > eps * tokens, ~known & (n + before > eps * tokens)
                merged = [np.concatenate([o[stay], v[fresh]]) for o, v in zip(old, (h, parent, n, np.full(len(h), before, np.float32)), strict=True)]
                order = np.argsort(merged[0])
                kept[k] = tuple(m[order] for m in merged)
        h, parent, n = (np.concatenate([k[i][k[2] >= eps * tokens] for k in kept]) for i in range(3))
        order = np.argsort(h)
        h, parent, n = h[order], parent[order], n[order].astype(np.int64)
        rows = list(_packed(_part(h, parts), [h, parent, n]))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[1][i] for r in rows], pa.binary()) for i in range(3)], pa.array([0] * len(rows), pa.int64())], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), *[pa.array([b""], pa.binary())] * 3, pa.array([tokens], pa.int64())], schema=schema)

    return run, "part int, h binary, parent binary, n binary, tokens long"


def _frequent(least: float):
    """Of one part's reports, the contexts that are frequent together."""

    def run(table: pa.Table) -> pa.Table:
        h, parent, n = _unpack(table, h=np.uint64, parent=np.uint64, n=np.int64)
        h, first, inv = np.unique(h, return_index=True, return_inverse=True)
        on = np.bincount(inv, weights=n, minlength=len(h)) >= least
        return pa.table({"h": h[on].view(np.int64), "parent": parent[first][on].view(np.int64)})

    return run


class States:
    """Contexts by their sorted hashes; state 0 is the root. ``parent`` is a state of lower depth."""

    def __init__(self, h: np.ndarray, parent: np.ndarray):
        order = np.argsort(h)
        self.h = h[order]
        self.sieve = np.zeros(1 << 22, dtype=bool)
        self.sieve[(self.h >> U(42)).astype(np.int64)] = True
        at = np.searchsorted(self.h, parent[order]) if len(h) else np.zeros(0, np.int64)
        self.parent = np.concatenate([[0], np.where(parent[order] == 0, 0, at + 1)]).astype(np.int32)

    @classmethod
    def again(cls, plain: tuple) -> States:
        """From plain arrays, as broadcasts carry them."""
        out = cls.__new__(cls)
        out.h, out.sieve, out.parent = plain
        return out

    def plain(self) -> tuple:
        return self.h, self.sieve, self.parent

    def of(self, contexts: list[np.ndarray]) -> list[np.ndarray]:
        """State of each token's context by depth, 0 where it has none."""
        out, live = [], None
        for h in contexts:
            s = np.zeros(len(h), dtype=np.int32)
            at = np.flatnonzero(self.sieve[(h >> U(42)).astype(np.int64)] & (h != 0)) if live is None else live[self.sieve[(h[live] >> U(42)).astype(np.int64)] & (h[live] != 0)]
            if len(self.h) and len(at):
                i = np.minimum(np.searchsorted(self.h, h[at]), len(self.h) - 1)
                hit = self.h[i] == h[at]
                at, i = at[hit], i[hit]
                s[at] = i + 1
            else:
                at = at[:0]
            out.append(s)
            live = at
        return out


def _part(x: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of the (mixed) symbol hash, so rows sorted by symbol are sorted by part."""
    return ((x >> U(32)) * U(parts) >> U(32)).astype(np.int32)


def _packed(part: np.ndarray, columns: list[np.ndarray]):
    edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
    for a, z in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield int(part[a]), [c[a:z].tobytes() for c in columns]


def _counts(depth: int, parts: int, shared):
    """Rows (part, x, s, n): packed next-symbol counts of one slice."""
    schema = pa.schema([("part", pa.int32()), ("x", pa.binary()), ("s", pa.binary()), ("n", pa.binary())])

    def run(batches):
        states = States.again(shared.value)
        for b in flat.slices(batches, limit=SLICE):
            _, x, contexts = symbols(b.column("text"), depth)
            found = states.of(contexts)
            s = np.concatenate([np.zeros(len(x), np.int32), *[f[f > 0] for f in found]])
            x = np.concatenate([x, *[x[f > 0] for f in found]])
            x, s, n = _summed(x, s, np.ones(len(x), np.int64))
            rows = list(_packed(_part(x, parts), [x, s, n]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[1][i] for r in rows], pa.binary()) for i in range(3)]], schema=schema)

    return run, "part int, x binary, s binary, n binary"


def _summed(x: np.ndarray, s: np.ndarray, n: np.ndarray):
    order = np.lexsort((s, x))
    x, s, n = x[order], s[order], n[order]
    if not len(x):
        return x, s, n
    edge = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (s[1:] != s[:-1])]))
    return x[edge], s[edge], np.add.reduceat(n, edge).astype(np.int64)


def _unpack(table: pa.Table, **kinds) -> list[np.ndarray]:
    """The packed values of all rows, column by column, one after the other."""
    out = []
    for c, kind in kinds.items():
        views = []
        for chunk in table.column(c).chunks:
            if len(chunk):
                offs = np.frombuffer(chunk.buffers()[1], dtype=np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
                views.append(np.frombuffer(chunk.buffers()[2], dtype=np.uint8)[offs[0] : offs[-1]] if chunk.buffers()[2] is not None else np.zeros(0, np.uint8))
        raw = views[0] if len(views) == 1 else np.concatenate([*views, np.zeros(0, np.uint8)])
        out.append((raw if raw.ctypes.data % 8 == 0 else raw.copy()).view(kind))
    return out


def _merge_counts(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part's rows, merged bit by bit, so that memory holds little more than the result; written as rows of whole
    symbols and about ``ROW`` entries."""
    held, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64))], 0
    merged = lambda rows: [_summed(*(np.concatenate(c) for c in zip(*rows, strict=True)))]
    for b in batches:
        for i in range(b.num_rows):
            held.append(_unpack(pa.table(b.slice(i, 1)), x=np.uint64, s=np.int32, n=np.int64))
            size += len(held[-1][0])
            if size >= max(MERGE, len(held[0][0])):
                held, size = merged(held), 0
    x, s, n = merged(held)[0]
    begin = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(1, np.int64)
    cuts = np.unique(np.concatenate([begin[np.searchsorted(begin, np.arange(0, len(x), ROW), "right") - 1], [0, len(x)]])).tolist()
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        yield pa.RecordBatch.from_pydict({"part": pa.array([key[0].as_py()], pa.int32()), "x": [x[a:z].tobytes()], "s": [s[a:z].tobytes()], "n": [n[a:z].tobytes()]})


def _totals(batches):
    """Rows (s, n, t): positions and different symbols of each context in one row of counts; s is -1 - part for the
    part's tokens."""
    schema = pa.schema([("s", pa.int32()), ("n", pa.int64()), ("t", pa.int64())])
    for b in batches:
        for i in range(b.num_rows):
            _, s, n = _unpack(pa.table(b.slice(i, 1)), x=np.uint64, s=np.int32, n=np.int64)
            u, inv = np.unique(s, return_inverse=True)
            u = np.append(u, -1 - b.column("part")[i].as_py()).astype(np.int32)
            n, t = np.append(np.bincount(inv, weights=n), n[s == 0].sum()), np.append(np.bincount(inv), 0)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n.astype(np.int64)), pa.array(t.astype(np.int64))], schema=schema)


class Table:
    """Counts of one part: lookup of n(s, x) by the symbol's place and the state."""

    def __init__(self, x: np.ndarray, s: np.ndarray, n: np.ndarray, size: int):
        self.symbol = np.unique(x)
        self.size = size
        self.key = np.searchsorted(self.symbol, x) * size + s
        self.n = n

    def place(self, x: np.ndarray) -> np.ndarray:
        if not len(self.symbol):
            return np.full(len(x), -1)
        at = np.minimum(np.searchsorted(self.symbol, x), len(self.symbol) - 1)
        return np.where(self.symbol[at] == x, at, -1)

    def count(self, place: np.ndarray, s: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(place))
        key = place * self.size + s
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (place >= 0), self.n[at], 0).astype(float)


def chance(table: Table, place: np.ndarray, s: np.ndarray, m) -> np.ndarray:
    """P(x|s) down the chain of parents, root first."""
    total, kinds, parent, tokens, vocabulary, depth = m
    chain = [s]
    for _ in range(depth):
        chain.append(parent[chain[-1]])
    p = (table.count(place, np.zeros(len(place), np.int32)) + ALPHA) / (tokens + ALPHA * (vocabulary + 1))
    for at in reversed(chain[:-1]):
        on = np.flatnonzero(at > 0)
        a = at[on]
        # a state whose parent is the root stands in the chain more than once only as 0
        p[on] = (table.count(place[on], a) + kinds[a] * p[on]) / (total[a] + kinds[a])
    return p


def _gains(shared):
    schema = pa.schema([("s", pa.int32()), ("gain", pa.float64())])

    def run(batches):
        m = shared.value
        total, kinds, parent, *_ = m
        for b in batches:
            for i in range(b.num_rows):
                x, s, n = _unpack(pa.table(b.slice(i, 1)), x=np.uint64, s=np.int32, n=np.int64)
                table = Table(x, s, n, len(total))
                on = np.flatnonzero(s > 0)
                s, n, place = s[on], n[on].astype(float), (table.key[on] // len(total))
                p = chance(table, place, parent[s], m)
                gain = n * np.log((n - 1 + kinds[s] * p) / (total[s] - 1 + kinds[s]) / p)
                u, inv = np.unique(s, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.bincount(inv, weights=gain).astype(float))], schema=schema)

    return run


def _ids(col: pa.Array) -> np.ndarray:
    return col.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _events(depth: int, parts: int, shared):
    """Rows (part, sub, slice, x, run, s, d, ids): tokens of one slice by next symbol; d counts the slice's rows. Parts
    with many tokens are dealt to several groups by slice. A slice's ids travel with its first row."""
    schema = pa.schema([("part", pa.int32()), ("sub", pa.int32()), ("slice", pa.int64()), *[(c, pa.binary()) for c in ("x", "s", "d", "run", "ids")]])

    def run(batches):
        states, longest, subs = States.again(shared.value[0]), *shared.value[1:]
        number = TaskContext.get().partitionId() << 32
        for b in flat.slices(batches, limit=SLICE):
            doc, x, contexts = symbols(b.column("text"), depth)
            s = np.zeros(len(x), dtype=np.int32)
            for f in states.of(contexts):
                s = np.where(f > 0, f, s)
            s = longest[s]
            order = np.argsort(x, kind="stable")
            x, s, d = x[order], s[order], doc[order].astype(np.int32)
            part = _part(x, parts)
            edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            new = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            first, times = np.searchsorted(new, edge), np.diff(np.append(new, len(x))).astype(np.int32)
            out = []
            for i, (a, z) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
                runs = slice(first[i], first[i + 1])
                out.append((x[new[runs]].tobytes(), s[a:z].tobytes(), d[a:z].tobytes(), times[runs].tobytes(), b"" if i else _ids(b.column("doc_id")).tobytes()))
            at = part[edge[:-1]]
            sub = (flat.mix(np.full(len(at), number, U)) % subs[at].astype(U)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sub), pa.array(np.full(len(at), number)), *[pa.array(c, pa.binary()) for c in zip(*out, strict=True)]], schema=schema)
            number += 1

    return run, "part int, sub int, slice long, x binary, s binary, d binary, run binary, ids binary"


SCORES = "slice long, ids binary, d binary, known binary, sums binary"


def _score(shared):
    """Sums by document of one group of events: d (place in the slice), tokens and known tokens, base score and score."""
    schema = pa.schema([("slice", pa.int64()), *[(c, pa.binary()) for c in ("ids", "d", "known", "sums")]])

    def run(events: pa.Table, counts: pa.Table) -> pa.Table:
        m = shared.value
        total, _, _, tokens, vocabulary, _ = m
        # a part's rows are ranges of symbols
        order = sorted(range(counts.num_rows), key=lambda i: int.from_bytes(counts.column("x")[i].as_buffer()[:8], "little"))
        own = [_unpack(counts.slice(i, 1), x=np.uint64, s=np.int32, n=np.int64) for i in order]
        table = Table(*(np.concatenate([np.zeros(0, t), *(c[j] for c in own)]) for j, t in enumerate((np.uint64, np.int32, np.int64))), len(total))
        out = []
        for i in range(events.num_rows):
            row = events.slice(i, 1)
            x, s, d, times = _unpack(row, x=np.uint64, s=np.int32, d=np.int32, run=np.int32)
            place = np.repeat(table.place(x), times)
            root = table.count(place, np.zeros(len(place), np.int32))
            rows, at = np.unique(d, return_inverse=True)
            add = lambda v: np.bincount(at, weights=v, minlength=len(rows))  # noqa: B023, E731
            base = np.log10((root + ALPHA) / (tokens + ALPHA * (vocabulary + 1)))
            score = np.log10(chance(table, place, s, m))
            known = np.stack([np.bincount(at, minlength=len(rows)), add(root > 0)]).astype(np.int32)
            out.append((row.column("slice")[0].as_py(), row.column("ids")[0].as_py(), rows.astype(np.int32).tobytes(), known.tobytes(), np.stack([add(base), add(score)]).tobytes()))
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def _sum_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of one slice, their sums over all parts added up."""
    ids = np.zeros(0, np.int64)
    known, sums = np.zeros((2, 0), np.int64), np.zeros((2, 0))
    for b in batches:
        for i in range(b.num_rows):
            row = pa.table(b.slice(i, 1))
            own, d, k, v = _unpack(row, ids=np.int64, d=np.int32, known=np.int32, sums=np.float64)
            ids = own if len(own) else ids
            if len(d) and (more := d[-1] + 1 - sums.shape[1]) > 0:
                known, sums = np.pad(known, ((0, 0), (0, more))), np.pad(sums, ((0, 0), (0, more)))
            known[:, d] += k.reshape(2, -1)
            sums[:, d] += v.reshape(2, -1)
    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids), "n_tokens": pa.array(known[0]), "n_known": pa.array(known[1]), "base_score": pa.array(sums[0]), "score": pa.array(sums[1])})


def score(docs: DataFrame, depth: int = DEPTH, p_min: float | None = None, gain: float = GAIN, group: int = GROUP) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(doc_id as text) mod 10 is not 0 train the model."""
    spark = docs.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = texts.where(remainder(10) != 0)
    if p_min is None:
        size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        p_min = SHARE / max(size, 1) ** (1 / 3)
    run, kinds = _candidates(depth, p_min, parts)
    reports = cut(train.mapInArrow(run, kinds), "reports")
    tokens = reports.agg(F.sum("tokens")).first()[0] or 0
    frequent = reports.where("part >= 0").groupBy("part").applyInArrow(_frequent(p_min / 2 * tokens), "h long, parent long").toArrow()
    states = States(*[frequent.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("h", "parent")])
    size = len(states.h) + 1

    shared = spark.sparkContext.broadcast(states.plain())
    run, kinds = _counts(depth, parts, shared)
    counts = train.mapInArrow(run, kinds).groupBy("part").applyInArrow(_merge_counts, "part int, x binary, s binary, n binary")
    counts = cut(counts, "counts")
    got = counts.mapInArrow(_totals, "s int, n long, t long").groupBy("s").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    total, types = np.zeros(size), np.zeros(size)
    at, n, t = (got.column(c).to_numpy() for c in ("s", "n", "t"))
    total[at[at >= 0]], types[at[at >= 0]] = n[at >= 0], t[at >= 0]
    subs = np.ones(parts, np.int32)
    subs[-1 - at[at < 0]] += (n[at < 0] // group).astype(np.int32)
    vocabulary = int(types[0])
    m = spark.sparkContext.broadcast((total, types, states.parent, tokens, vocabulary, depth))
    gained = np.zeros(size)
    got = counts.mapInArrow(_gains(m), "s int, gain double").groupBy("s").agg(F.sum("gain").alias("gain")).toArrow()
    gained[got.column("s").to_numpy()] = got.column("gain").to_numpy()
    kept = (gained >= gain) & (total >= p_min * tokens)
    kept[0] = True
    # the longest kept state among a context and its suffixes
    longest = np.arange(size, dtype=np.int32)
    for _ in range(depth):
        longest = np.where(kept[longest], longest, states.parent[longest]).astype(np.int32)
    above = longest[states.parent]
    m2 = spark.sparkContext.broadcast((total, types, above, tokens, vocabulary, depth))
    tree = spark.sparkContext.broadcast((states.plain(), longest, subs))
    run, kinds = _events(depth, parts, tree)
    events = texts.mapInArrow(run, kinds).groupBy("part", "sub")
    # every group of a part gets the part's counts
    copies = F.explode(F.sequence(F.lit(0), F.element_at(F.lit(subs.tolist()), F.col("part") + 1) - 1))
    scored = events.cogroup(counts.withColumn("sub", copies).groupBy("part", "sub")).applyInArrow(_score(m2), SCORES)
    out = scored.groupBy("slice").applyInArrow(_sum_slice, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    out = out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
    return out.select("doc_id", (remainder(10) == 0).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
