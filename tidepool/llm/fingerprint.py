"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, with built-in functions only.

A text is cut into paragraphs at line ends, and behind every word whose hash together with the next word's says so (one
in ``WORDS`` on average). So the cuts depend on the words around them alone: an insertion changes the paragraph it
stands in, and none behind it. A paragraph's digest is a 64-bit hash. A sketch is 4 ** level shards of 128 cells; a
digest goes to one shard, and there to one cell in each of four regions, the same at every level, so the sum of the
shards with the same remainder is the sketch of a lower level. A cell has a count, the exclusive-or of its digests and that of their checks. Two versions of a text are
compared by subtracting their sketches cell by cell (one aggregate over the cells of both, with opposite signs), so
that common paragraphs vanish, and peeling the rest: a cell
that holds a single digest (its check agrees) gives it away, and the digest is taken out of its other cells, until
all cells are empty. Where peeling gets stuck, sketches with four times as many shards are tried.
Likeness is 1 - differing digests / all digests of both versions (2 |A & B| / (|A| + |B|)), 1 for two empty texts.

A returned fingerprint is the sketch at the level of its own number of digests, at most ``OWN`` a shard on average, so
that it can be peeled alone: any two strings give their likeness and the digests in which they differ, by subtraction at
the lower level of both, or from the digests of each where one is too small for the other. (Two digests of a shard with
the same four cells, about one pair in a million, keep a string from being peeled alone.)

:func:`edits` needs the next document in descending order of doc_id: rows are dealt to ranges of doc_id by quantiles
of the ids, each range gets a copy of the head of the range below (after the last: the first), and a window in each
range looks one row ahead. Only one row per range goes to the driver.

Defined cases: null text is empty; an empty text has an empty sketch; a repeated paragraph counts once, order and
repetition show in the fingerprint by the text's hash in front; repeated doc_ids follow each other in order of their
texts' hashes; a single document is its own next; an empty table gives an empty result; other columns are ignored.
If no size up to eight shards a digest peels (chance below 1e-6 a pair), the digests themselves are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut

WORDS = 16
REGIONS, BITS = 4, 5
WIDTH = 1 << BITS
#: Digests a shard that a returned sketch holds at most on average.
OWN = 24
#: Stands behind words that end a paragraph, between cutting and splitting.
END = "\u0001"
#: Digests of both versions that the first try allows for in a shard. Peeling takes time with the square of a shard.
FILL = 24
#: Tasks a shuffle partition where digests become cells, which take some thirty times their space.
SPREAD = 4


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs."""
    def marked(words: Column) -> Column:
        def word(w: Column, i: Column) -> Column:
            after = F.get(words, i + 1)
            ends = after.isNotNull() & ((F.xxhash64(w, after).bitwiseAND(F.lit(WORDS - 1)) == 0) | F.contains(w, F.lit("\n")))
            return F.when(ends, F.concat(w, F.lit(END))).otherwise(w)

        return F.array_join(F.transform(words, word), "")

    words = F.regexp_extract_all(text, F.lit(r"\S+\s*|\s+"), F.lit(0))
    parts = F.split(F.transform(F.array(words), marked)[0], END)
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p))))


def level(digests_a_shard: Column) -> Column:
    """The least level with as many shards."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(digests_a_shard, F.lit(1))) / 2)).cast("int")


def _check(k: Column) -> Column:
    return F.xxhash64(k, F.lit(77))


def _spots(k: Column) -> Column:
    """A digest's cell in each region."""
    turned = F.xxhash64(k, F.lit(5))
    return F.array(*[F.shiftrightunsigned(turned, BITS * r).bitwiseAND(F.lit(WIDTH - 1)).cast("int") + r * WIDTH for r in range(REGIONS)])


def sketch(signed: DataFrame, by: list[str]) -> DataFrame:
    """Cells (i, c, k, h) of each shard of each group ``by``, without empty ones, from rows with ``k``, ``sign`` and the
    try's ``level``. Versions of opposite sign are thereby subtracted. Partitioned by a part of ``by``, it has no shuffle."""
    shards = F.pow(F.lit(4.0), F.col("level")).cast("bigint")
    put = signed.withColumn("shard", F.pmod(F.shiftrightunsigned("k", 20), shards)).withColumn("h", _check(F.col("k")))
    put = put.select(*by, "level", "shard", "sign", "k", "h", F.explode(_spots(F.col("k"))).alias("i"))
    cells = put.groupBy(*by, "level", "shard", "i").agg(F.sum("sign").cast("int").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))
    return cells.where("c <> 0 or k <> 0 or h <> 0")


def peel(cells: Column) -> Column:
    """The digests (c, k) of one shard's difference with their sign (1: only in the first version); null where it's stuck."""
    start = F.struct(cells.alias("cells"), F.array().cast("array<struct<c:int,k:bigint>>").alias("found"), F.lit(False).alias("over"))
    pure = lambda x: (F.abs(x["c"]) == 1) & (x["h"] == _check(x["k"]))

    def step(state: Column, _: Column) -> Column:
        def take(p: Column) -> Column:
            out = lambda x: F.struct(x["i"].alias("i"), (x["c"] - p["c"]).alias("c"), x["k"].bitwiseXOR(p["k"]).alias("k"), x["h"].bitwiseXOR(p["h"]).alias("h"))
            left = F.transform(F.array(_spots(p["k"])), lambda spots: F.transform(state["cells"], lambda x: F.when(F.array_contains(spots, x["i"]), out(x)).otherwise(x)))[0]
            left = F.filter(left, lambda x: (x["c"] != 0) | (x["k"] != 0) | (x["h"] != 0))
            more = F.struct(left.alias("cells"), F.array_append(state["found"], F.struct(p["c"].alias("c"), p["k"].alias("k"))).alias("found"), F.lit(False).alias("over"))
            return F.when(p.isNull(), F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(True).alias("over"))).otherwise(more)

        first = F.get(F.filter(state["cells"], pure), F.lit(0))
        return F.when(state["over"], state).otherwise(F.transform(F.array(first), take)[0])

    return F.aggregate(F.sequence(F.lit(0), F.size(cells)), start, step, lambda s: F.when(F.size(s["cells"]) == 0, s["found"]))


def differences(pairs: DataFrame, by: list[str], listed: bool = True) -> DataFrame:
    """``by`` and diff, the signed digests by which arrays x and y of ``pairs`` (a written table) differ, from sketches of
    growing size; without ``listed`` only their number d."""
    total = F.size("x") + F.size("y")
    first = pairs.select(*by, "x", "y", level(total / FILL).alias("level"), level(total * 8).alias("last"))
    todo, done, tries = first, [], 0
    tasks = SPREAD * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    result = lambda diff: [diff.alias("diff")] if listed else [F.size(diff).alias("d")]
    while True:
        rows = todo.repartition(tasks, by[0])
        signed = F.concat(F.transform("x", lambda k: F.struct(F.lit(1).alias("sign"), k.alias("k"))), F.transform("y", lambda k: F.struct(F.lit(-1).alias("sign"), k.alias("k"))))
        cells = sketch(rows.select(*by, "level", F.explode(signed).alias("e")).select(*by, "level", "e.sign", "e.k"), by)
        shard = cells.groupBy(*by, "level", "shard").agg(F.collect_list(F.struct("i", "c", "k", "h")).alias("cells"))
        peeled = shard.select(*by, peel(F.col("cells")).alias("found"))
        # pairs without a row here have no differing digest
        got = cut(peeled.groupBy(*by).agg(F.count_if(F.col("found").isNull()).alias("stuck"), *result(F.flatten(F.collect_list("found")))), "tried")
        done.append(got.where("stuck = 0").drop("stuck"))
        tries += 1
        stuck = first.join(got.where("stuck > 0").select(*by), by).withColumn("level", F.col("level") + tries)
        signed_rest = lambda x, y, c: F.transform(F.array_except(x, y), lambda k: F.struct(F.lit(c).alias("c"), k.alias("k")))
        done.append(stuck.where("level > last").select(*by, *result(F.concat(signed_rest("x", "y", 1), signed_rest("y", "x", -1)))))
        todo = stuck.where("level <= last")
        if todo.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    none = F.array().cast("array<struct<c:int,k:bigint>>")
    return pairs.select(*by).join(out, by, "left").select(*by, F.coalesce("diff", none).alias("diff")) if listed else out


def written(cells: Column, text_hash: Column, size: Column) -> Column:
    """A fingerprint: the text's hash in hex, its number of digests and level, and its sketch's cells (shard, cell, count,
    digests and checks in hex)."""
    shown = F.transform(F.array_sort(cells), lambda x: F.concat_ws(":", x["shard"].cast("string"), x["i"].cast("string"), x["c"].cast("string"), F.lower(F.hex(x["k"])), F.lower(F.hex(x["h"]))))
    return F.concat_ws("-", F.lower(F.hex(text_hash)), size.cast("string"), level(size / OWN).cast("string"), F.concat_ws(",", shown))


def next_text(docs: DataFrame, ranges: int) -> DataFrame:
    """``docs`` (doc_id, text) with the text of the next row in descending doc_id as ``next``."""
    docs = docs.withColumn("tie", F.xxhash64("text"))
    cuts = docs.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.5 / ranges) if ranges > 1 else []
    cuts = sorted({int(c) for c in cuts})
    where = F.size(F.filter(F.array(*[F.lit(c).cast("bigint") for c in cuts]), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0)
    dealt = docs.withColumn("range", where)
    heads = dealt.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("head")).select("range", "head.doc_id", "head.tie").orderBy(F.desc("range")).collect()
    marked = dealt.withColumn("copy", F.lit(0))
    if heads:
        spark = docs.sparkSession
        # the head of each range is the next row of the range above it
        above = [heads[i - 1].range for i in range(len(heads))]
        small = spark.createDataFrame([(h.range, h.doc_id, h.tie, a) for h, a in zip(heads, above, strict=True)], "range int, doc_id long, tie long, above int")
        copies = dealt.join(F.broadcast(small), ["range", "doc_id", "tie"]).dropDuplicates(["range"])
        marked = marked.unionByName(copies.select("doc_id", "text", "tie", F.col("above").alias("range"), F.lit(1).alias("copy")))
    w = Window.partitionBy("range").orderBy("copy", F.desc("doc_id"), F.desc("tie"))
    return marked.withColumn("next", F.lead("text").over(w)).where("copy = 0").select("doc_id", "text", "next")


def edits(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has its last third of code points replaced by the first as many of the next document."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = next_text(rows, ranges).withColumn("n", F.length("text"))
    third = F.floor(F.col("n") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n") - third), F.substring("next", F.lit(1), third)))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.xxhash64("text").alias("text_hash"), F.xxhash64("edited").alias("edited_hash"), digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("b"), digests(F.col("next")).alias("c"),
    )
    base = cut(rows, "base")
    pairs = base.select("row", "a", F.explode(F.array(F.struct(F.lit(0).alias("pair"), F.col("b").alias("y")), F.struct(F.lit(1).alias("pair"), F.col("c").alias("y")))).alias("p"))
    diffs = differences(pairs.select("row", "p.pair", F.col("a").alias("x"), "p.y"), ["row", "pair"], listed=False)
    size = diffs.groupBy("row").agg(F.sum(F.when(F.col("pair") == 0, F.col("d"))).alias("d0"), F.sum(F.when(F.col("pair") == 1, F.col("d"))).alias("d1"))
    dealt = base.repartition(SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions")), "row")
    alone = dealt.select("row", F.explode(F.array(F.struct(F.lit(0).alias("version"), F.col("a").alias("x")), F.struct(F.lit(1).alias("version"), F.col("b").alias("x")))).alias("v"))
    cells = sketch(alone.select("row", "v.version", level(F.size("v.x") / OWN).alias("level"), F.lit(1).alias("sign"), F.explode("v.x").alias("k")), ["row", "version"])
    cells = cells.groupBy("row").agg(*[F.collect_list(F.when(F.col("version") == v, F.struct("shard", "i", "c", "k", "h"))).alias(n) for v, n in ((0, "cells_a"), (1, "cells_b"))])
    like = lambda d, x, y: F.when(F.size(x) + F.size(y) == 0, F.lit(1.0)).otherwise(1.0 - F.coalesce(F.col(d), F.lit(0)) / (F.size(x) + F.size(y)))
    empty = F.array().cast("array<struct<shard:bigint,i:int,c:int,k:bigint,h:bigint>>")
    out = dealt.join(cells, "row", "left").join(size, "row", "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256",
        written(F.coalesce("cells_a", empty), F.col("text_hash"), F.size("a")).alias("fingerprint"), written(F.coalesce("cells_b", empty), F.col("edited_hash"), F.size("b")).alias("edited_fingerprint"),
        like("d0", "a", "b").alias("near_edited"), like("d1", "a", "c").alias("near_next"),
    )
