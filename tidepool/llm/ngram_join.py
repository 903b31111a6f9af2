"""N-gram Jaccard join with several global token orders.

Two sets with Jaccard similarity >= t must share a token inside both prefixes (the first ``n - ceil(t*n) + 1``
tokens) under *any* total order of tokens, and L tokens if both prefixes are longer by L - 1. The first order puts rare shingles first, by counts of a sketch over all
texts (``COUNTERS`` hashed counters, so common shingles and passages never sit in a prefix unless nothing else is left);
it generates candidates by a join on prefix tokens. The other orders are hashes with other seeds. A candidate must pass the
prefix filter of every order: up to the token where the shorter prefix ends, the common tokens are known; behind it at
most the smaller rest can be common; together they must reach the overlap that t asks for. Only pairs in the
intersection of all filters have their texts compared. The orders change the work only, never the result.

Flow: (1) one pass over the texts makes set digests, sizes and the sketch; equal sets become one node. (2) One pass
emits the (longer) prefix tokens under the first order with their places, grouped by token (frequent tokens salted);
nodes of which fewer than L are shared with any other node go. (3) One pass keeps text and other prefixes of the nodes that share a token with another one, by node. (4) Star pairs, each node
against the node of its group that has the token earliest, are filtered, verified and contracted to components; in
large groups ``rounds`` more such steps compare what is still apart with a few members of the group's largest component.
(5) Groups that still hold several components yield the pairs across components, and only those that the places allow:
where a token is the first common one, what stands before it in either set is not common. They are filtered and
verified too. A pair inside a known component can't change the result, so a group of n near copies costs about n
checks, while no link between different texts is lost.

Defined cases: null or empty text has an empty set, is linked with nothing and is its own component; fewer words
than ``k`` form one shingle; equal sets are always linked; rows of one doc_id are one document, whatever their texts,
and share the component; rows without a doc_id link others, but have no id to give; an empty table gives an empty
result; other columns are ignored. Sets are compared as 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import flat
from .graph import components
from .scratch import cut, drop

SALTS = 64
SOME = 8
COUNTERS, BLOCK = 1 << 22, 1 << 16
#: A token is salted if its counter holds so many more than twice the usual counter.
HOT = 4096
MERGE_WAYS = 256


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100 + 1


def longer(n, percent: int, least):
    """Tokens that two linked sets of ``n`` or more share in prefixes made longer by one less; ``least`` is the minimum
    of two values, of numbers or of columns."""
    return least((n * percent + 99) // 100, 2 + n // 25) if least is np.minimum else least(F.floor((n * percent + 99) / 100), 2 + F.floor(n / 25))


def _order_key(h: np.ndarray, seed: int) -> np.ndarray:
    """Place in a hash order; one to one."""
    return flat.mix(h ^ np.uint64(0xD1B54A32D192ED03 * (seed + 1) % (1 << 64)))


def _counter(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(42)).astype(np.int64)


def _digests(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One 64-bit digest per set, independent of order, never 0 for a set with members."""
    if not len(h):
        return np.zeros(len(n), dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(n)])
    some = np.flatnonzero(n > 0)
    s = np.add.reduceat(flat.mix(h ^ np.uint64(0xA5A5)), first[some])
    x = np.bitwise_xor.reduceat(flat.mix(h ^ np.uint64(0x5A5A5A)), first[some])
    out = np.zeros(len(n), dtype=np.uint64)
    out[some] = flat.mix(s ^ flat.mix(x ^ n[some].astype(np.uint64)))
    return out.view(np.int64)


def _sets(col: pa.Array, k: int):
    """(text, hash) of the distinct shingles, sorted by both, and the set sizes."""
    doc, h = flat.distinct(*flat.shingles(flat.words(col), k))
    return doc, h, np.bincount(doc, minlength=len(col)).astype(np.int64)


def _survey(k: int):
    """Rows (doc_id, copy, n, node) of texts, and rows (block, way, counts) with this task's sketch."""
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("block", pa.int32()), ("way", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for b in flat.slices(batches):
            _, h, n = _sets(b.column("text"), k)
            at, c = np.unique(_counter(h), return_counts=True)
            counts[at] += c.astype(np.uint32)
            nulls = [pa.nulls(b.num_rows, f.type) for f in list(schema)[4:]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("copy"), pa.array(n), pa.array(_digests(h, n)), *nulls], schema=schema)
        way = TaskContext.get().partitionId() % MERGE_WAYS
        for i in range(COUNTERS // BLOCK):
            part = counts[i * BLOCK : (i + 1) * BLOCK]
            if part.any():
                raw = pa.compress(part.tobytes(), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in list(schema)[:4]], pa.array([i], pa.int32()), pa.array([way], pa.int32()), pa.array([raw], pa.binary())], schema=schema)

    return run, "doc_id long, copy long, n long, node long, block int, way int, counts binary"


def _added(table: pa.Table) -> pa.Table:
    """The sum of one group's counts; sums stay at the largest value that fits."""
    total = np.zeros(BLOCK, dtype=np.uint64)
    for raw in table.column("counts"):
        total += np.frombuffer(pa.decompress(raw.as_buffer(), BLOCK * 4, codec="zstd"), dtype=np.uint32)
    total = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return pa.table({"block": table.column("block")[:1], "counts": pa.array([pa.compress(total.tobytes(), codec="zstd", asbytes=True)], pa.binary())})


def _levels(survey: DataFrame) -> tuple[np.ndarray, int]:
    """Every counter's level (8 a doubling), and the level from which a token counts as frequent."""
    kind = "block int, counts binary"
    merged = survey.where("block is not null").groupBy("block", "way").applyInArrow(_added, kind).groupBy("block").applyInArrow(_added, kind)
    total = np.zeros(COUNTERS, dtype=np.uint32)
    for r in merged.collect():  # COUNTERS / BLOCK rows, whatever the input
        total[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(pa.decompress(bytes(r.counts), BLOCK * 4, codec="zstd", asbytes=True), dtype=np.uint32)
    level = lambda c: np.rint(8 * np.log2(1.0 + c)).clip(0, 255)
    return level(total).astype(np.uint8), int(level(2.0 * np.median(total) + HOT))


def _postings(k: int, percent: int, shared):
    schema = pa.schema([("token", pa.int64()), ("salt", pa.int32()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32())])

    def run(batches):
        levels, hot = shared.value
        done: set[int] = set()
        for b in flat.slices(batches):
            doc, h, n = _sets(b.column("text"), k)
            node = _digests(h, n)
            fresh = np.zeros(b.num_rows, dtype=bool)
            for i, d in enumerate(node.tolist()):  # a copy seen by this task needs no second posting
                if d not in done:
                    done.add(d)
                    fresh[i] = n[i] > 0
            on = fresh[doc]
            if not on.any():
                continue
            ids = np.flatnonzero(fresh)
            doc, h, n, node = np.searchsorted(ids, doc[on]), h[on], n[ids], node[ids]
            level = levels[_counter(h)]
            order = np.lexsort(((level.astype(np.uint64) << np.uint64(56)) | (_order_key(h, 0) >> np.uint64(8)), doc))
            place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            keep = place < np.repeat(prefix_size(n, percent) + longer(n, percent, np.minimum) - 1, n)
            order, place = order[keep], place[keep]
            h, doc = h[order], doc[order]
            own = node[doc]
            salt = np.where(level[order] >= hot, flat.mix(own.view(np.uint64)) % np.uint64(SALTS) + np.uint64(1), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(salt), pa.array(own), pa.array(n[doc].astype(np.int32)), pa.array(place.astype(np.int32))], schema=schema)

    return run, "token long, salt int, node long, n int, place int"


def _signed(k: int, percent: int, orders: int):
    """Rows (node, n, p1.., text): the prefix under every further order, as ordered keys."""
    names = [f"p{i}" for i in range(1, orders)]
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), *[(p, pa.list_(pa.int64())) for p in names], ("text", pa.string())])

    def run(batches):
        for b in flat.slices(batches):
            doc, h, n = _sets(b.column("text"), k)
            length = np.minimum(prefix_size(n, percent), n)
            keep = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n) < np.repeat(length, n)
            ends = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))
            lists = []
            for seed in range(1, orders):
                key = (_order_key(h, seed) ^ np.uint64(1 << 63)).view(np.int64)  # signed in the same order
                lists.append(pa.ListArray.from_arrays(ends, pa.array(key[np.lexsort((key, doc))][keep])))
            yield pa.RecordBatch.from_arrays([pa.array(_digests(h, n)), pa.array(n), *lists, b.column("text")], schema=schema)

    return run, "node long, n long" + "".join(f", {p} array<long>" for p in names) + ", text string"


def _shared_count(a, b, rows: int) -> np.ndarray:
    """Number of equal (row, hash) of two lists of distinct pairs, by row."""
    key = np.concatenate([flat.mix(h ^ flat.mix(d.astype(np.uint64))) for d, h in (a, b)])
    row = np.concatenate([a[0], b[0]])
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    same = np.flatnonzero(key[1:] == key[:-1])
    return np.bincount(row[same], minlength=rows)


def passes(n: tuple[Column, Column], prefix: tuple[Column, Column], percent: int) -> Column:
    """Whether two sets can have the overlap asked for, from their prefixes under one order."""
    end = F.least(F.element_at(prefix[0], -1), F.element_at(prefix[1], -1))
    rest = [n[i] - F.size(F.filter(prefix[i], lambda x: x <= end)) for i in (0, 1)]
    return (F.size(F.array_intersect(*prefix)) + F.least(*rest)) * (100 + percent) >= (n[0] + n[1]) * percent


def _verify(k: int, percent: int):
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def run(batches):
        for b in flat.slices(flat.slices(batches, "text_x"), "text_y"):
            sets = [flat.distinct(*flat.shingles(flat.words(b.column(c)), k)) for c in ("text_x", "text_y")]
            size = [np.bincount(d, minlength=b.num_rows).astype(np.int64) for d, _ in sets]
            both = _shared_count(*sets, b.num_rows)
            good = (np.minimum(*size) > 0) & (100 * both >= percent * (size[0] + size[1] - both))
            yield pa.RecordBatch.from_arrays([b.column("x").filter(pa.array(good)), b.column("y").filter(pa.array(good))], schema=schema)

    return run, "x long, y long"


def with_ids(docs: DataFrame, ids: DataFrame, on: list[str], bound: int = 1_000_000) -> DataFrame:
    """``docs`` that have a row in ``ids`` (a written table): the ids are broadcast up to ``bound`` rows, else shuffled."""
    few = ids.count() <= bound
    return docs.join(F.broadcast(ids) if few else ids.hint("shuffle_hash"), on, "left_semi")


def _possible(xn, xp, yn, yp, percent: int) -> Column:
    """Whether sets of these sizes, whose first common token stands at these places, can have the overlap."""
    return (1 + F.least(xn - xp - 1, yn - yp - 1)) * (100 + percent) >= (xn + yn) * percent


def ngram_join(docs: DataFrame, k: int = 5, percent: int = 80, orders: int = 3, rounds: int = 2) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Two texts are linked when 100 * |A & B| >= percent * |A | B| over their distinct ``k``-word shingles; component_id
    is the smallest doc_id reachable by links. ``orders`` and ``rounds`` change the work only.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("copy", F.xxhash64("text"))
    run, kind = _survey(k)
    survey = cut(docs.mapInArrow(run, kind), "survey")
    members = survey.where("block is null").select("doc_id", "copy", F.col("n").alias("n_shingles"), "node")
    shared = spark.sparkContext.broadcast(_levels(survey))

    run, kind = _postings(k, percent, shared)
    by = Window.partitionBy("token", "salt")
    once = docs.mapInArrow(run, kind).repartition("token", "salt").withColumn("before", F.lag("node").over(by.orderBy("node"))).where("before is null or before <> node")
    # rows of a token that one node alone has can't make a pair; salted groups are kept for the second level
    together = once.withColumn("size", F.count("*").over(by)).where("salt > 0 or size > 1").select("token", "salt", "node", "n", "place")
    least = longer(F.floor((F.col("n") * percent + 99) / 100), percent, F.least)
    enough = together.withColumn("met", F.count("*").over(Window.partitionBy("node"))).where(F.col("met") >= least)
    # a pivot has the token earliest in the order: what can be linked to any member can be linked to it. One is among
    # all members, one among those of nearly the same size
    first, alike = F.min(F.struct("place", "node", "n")), Window.partitionBy("token", "salt", "class")
    groups = enough.withColumn("size", F.count("*").over(by)).withColumn("lo", first.over(by)).withColumn("hi", F.max(F.struct("place", "node", "n")).over(by))
    # two nodes alone with a token that can't be the first common one of a linked pair: by far the most of chance meetings
    two = _possible(F.col("lo.n"), F.col("lo.place"), F.col("hi.n"), F.col("hi.place"), percent)
    groups = groups.where("salt > 0 or size > 1").where((F.col("salt") > 0) | (F.col("size") > 2) | two).withColumn("class", F.floor(F.log("n") * 20))
    groups = groups.withColumn("near", first.over(alike)).select("token", "salt", "node", "n", "place", "lo", "near")
    groups = cut(groups, "groups")

    # text and further prefixes of every node that shares a token, from one of its rows
    wanted = cut(groups.select("node").distinct(), "wanted")
    rows = members.where("n_shingles > 0").join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), "copy")).alias("row"))
    rows = cut(rows.select("row.id", "row.copy").distinct(), "rows")
    run, kind = _signed(k, percent, orders)
    sides = cut(with_ids(docs.withColumn("id", F.coalesce("doc_id", F.lit(0))), rows, ["id", "copy"]).mapInArrow(run, kind), "sides")
    if sides.count() > rows.count():  # rows that are there twice
        sides = cut(sides.dropDuplicates(["node"]), "sides")
    drop(wanted, rows)

    def star(of: DataFrame, center: str) -> DataFrame:
        fits = _possible(F.col("n"), F.col("place"), F.col(f"{center}.n"), F.col(f"{center}.place"), percent)
        return of.where(fits).select(F.col("node").alias("x"), F.col(f"{center}.node").alias("y"))

    heads = groups.where("salt > 0 and node = lo.node").select("token", "node", "n", "place")
    tops = heads.groupBy("token").agg(F.min(F.struct("place", "node", "n")).alias("lo"))
    stars = star(groups, "lo").unionByName(star(groups, "near")).unionByName(star(heads.join(tops, "token"), "lo"))

    def checked(pairs: DataFrame) -> DataFrame | None:
        """Those of the pairs that are linked: first the filters of the further orders, then the texts."""
        pairs = pairs.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        met = cut(pairs, "met")
        few = lambda of: cut(of.select(F.col("x").alias("node")).union(of.select(F.col("y").alias("node"))).distinct(), "ids")
        ids = few(met)
        signs = with_ids(sides.select("node", F.struct("n", *[f"p{j}" for j in range(1, orders)]).alias("of")), ids, ["node"])
        side = lambda c: signs.select(F.col("node").alias(c), F.col("of").alias(f"of_{c}"))
        pairs = met.join(side("x"), "x").join(side("y"), "y")
        for j in range(1, orders):
            pairs = pairs.where(passes((F.col("of_x.n"), F.col("of_y.n")), (F.col(f"of_x.p{j}"), F.col(f"of_y.p{j}")), percent))
        pairs = cut(pairs.select("x", "y"), "pairs")
        drop(met, ids)
        if pairs.isEmpty():
            drop(pairs)
            return None
        ids = few(pairs)
        texts = with_ids(sides.select("node", "text"), ids, ["node"])
        text = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
        run, kind = _verify(k, percent)
        links = cut(pairs.join(text("x"), "x").join(text("y"), "y").select("x", "y", "text_x", "text_y").mapInArrow(run, kind), "links")
        drop(pairs, ids)
        return None if links.isEmpty() else links

    comp, known = None, None

    def contract(links: DataFrame | None) -> None:
        """Add links to the components so far."""
        nonlocal comp, known
        if links is None:
            return
        known = None
        if comp is None:
            comp = components(links, "x", "y")
        else:
            old = comp
            own = lambda c: old.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
            ends = links.join(own("x"), "x", "left").join(own("y"), "y", "left").select("x", "y", F.coalesce("cx", "x").alias("cx"), F.coalesce("cy", "y").alias("cy"))
            ends = cut(ends, "ends")
            over = components(ends, "cx", "cy").select(F.col("node").alias("component"), F.col("component").alias("now"))
            every = old.unionByName(ends.select(F.col("x").alias("node"), F.col("cx").alias("component"))).unionByName(ends.select(F.col("y").alias("node"), F.col("cy").alias("component"))).distinct()
            comp = cut(every.join(over, "component", "left").select("node", F.coalesce("now", "component").alias("component")), "components")
            drop(old, ends)
        drop(links)

    def across(some: int | None, turn: int = 0) -> DataFrame:
        """Pairs of a group between its largest component and the others, and among the others; with ``some`` only
        between the others and about so many members of the largest one."""
        nonlocal known
        if known is None:
            known = groups.select("token", "node", "n", "place")
            if comp is None:
                known = known.withColumn("c", F.col("node"))
            else:  # nodes without a link are their own component
                known = known.join(comp, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
            known = cut(known, "known")
        size = known.groupBy("token", "c").agg(F.count("*").alias("m"))
        mixed = size.groupBy("token").agg(F.max_by("c", F.struct("m", "c")).alias("main"), F.max("m").alias("mains"), F.count("*").alias("cs"), F.sum("m").alias("all")).where("cs > 1")
        if some:
            mixed = mixed.where(F.col("all") > 4 * some)
        rest = known.join(cut(mixed.select("token", "main", "mains"), "mixed"), "token")
        left = rest.where("c <> main").select("token", F.col("node").alias("x"), F.col("n").alias("xn"), F.col("place").alias("xp"), F.col("c").alias("xc"))
        if some:
            rest = rest.where((F.col("c") == F.col("main")) & (F.pmod(F.xxhash64(F.lit(turn), "node"), F.ceil(F.col("mains") / some)) == 0))
        right = rest.select(F.col("token").alias("t"), F.col("node").alias("y"), F.col("n").alias("yn"), F.col("place").alias("yp"), F.col("c").alias("yc"), "main")
        apart = (F.col("xc") != F.col("yc")) & ((F.col("yc") == F.col("main")) | (F.col("x") < F.col("y")))
        return left.join(right, (F.col("token") == F.col("t")) & apart & _possible(*(F.col(c) for c in ("xn", "xp", "yn", "yp")), percent)).select("x", "y")

    contract(checked(stars))
    for turn in range(rounds):
        contract(checked(across(SOME, turn)))
    contract(checked(across(None)))
    drop(groups, sides, known)

    # the nodes of one document belong together; a component is named by its smallest doc_id
    several = members.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y")
    ties = members.where("n_shingles > 0").join(several, "doc_id").select(F.col("node").alias("x"), "y").where("x <> y")
    if not several.isEmpty():
        contract(cut(ties, "ties"))
    named = members.where("n_shingles > 0")
    if comp is None:
        named = named.withColumn("c", F.col("node"))
    else:
        named = named.join(comp, "node", "left").withColumn("c", F.coalesce("component", "node"))
    named = cut(named.select("node", "doc_id", "c").distinct(), "named")
    name = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    final = cut(named.groupBy("node").agg(F.first("c").alias("c")).join(name, "c").select("node", "component_id"), "final")
    drop(named)
    out = members.join(final, "node", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    if not several.isEmpty():  # an empty row of a document whose other row has links
        least = out.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("least"))
        out = out.join(least, "doc_id", "left").withColumn("component_id", F.coalesce("least", "component_id"))
    return out.select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, **params) -> DataFrame:
    """One row of each group of linked rows of ``docs``, with all columns: the one whose doc_id is the component's.

    Rows with the same doc_id are one document, of which the row with the smallest text stays; rows without a doc_id
    are kept."""
    joined = ngram_join(docs, k, percent, **params)
    kept = cut(joined.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows")), "kept")
    ids = kept.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"))
    once = docs.join(ids, "doc_id", "left_semi").select(*docs.columns)
    if not kept.where("rows > 1").isEmpty():
        w = Window.partitionBy("doc_id").orderBy("text")
        once = once.withColumn("_place", F.row_number().over(w)).where("_place = 1").select(*docs.columns)
    return once.unionByName(docs.where("doc_id is null"))
