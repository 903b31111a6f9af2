"""Merkle manifest of a dataset: a tree for each language, a tree over their roots, a proof for every row.

A leaf is the digest of a row's fields. Per group (language) the leaves stand in order of doc_id; while there are several nodes,
every ``fanout`` consecutive ones (the last run may have fewer, even one) become the digest of their hex digests. The roots of
the groups, in order of the groups, are the leaves of one more tree, whose root is the manifest's.

Flow: (1) one pass over the rows makes leaves; from here on a row is some hundred bytes. (2) They are dealt by ranges of (group,
doc_id), sorted and written with their place in the range, and counts by range give every leaf its place in the group; no
window runs over a group. (3) Blocks of ``fanout ** DEPTH`` leaves, aligned in the group, are hashed level by level: the block is
one contiguous matrix of 64-byte hex digests, a level is that matrix reshaped to rows of ``fanout`` digests. Their roots are the
leaves of the next tier, again in blocks, until one node of the group is left (two tiers to 16 million leaves, three to 68
billion). (4) From the top down each block gets the siblings between it and the root. (5) Every block of leaves meets its one
list of upper siblings; siblings inside come from index arithmetic on the levels, and all rows are folded together.

A block is never more than 4,096 rows, whatever share of all rows a language has.

Defined cases: a null field counts as ``-``; groups are in bytewise order, null first; a null doc_id comes first; rows of one
doc_id are in order of their leaves, repeated rows get a leaf and a proof each; one row is its own subroot and root, with the
digest of nothing as proof; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut, drop

DEPTH = 12
HEX = 64
PATH = "array<struct<left:string,right:string>>"
UP = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def field(c: Column) -> Column:
    """A value as bytes of known length, or ``-``."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))).cast("binary"), 256))


def matrix(raw: bytes) -> np.ndarray:
    """Digests, one after the other, as rows of hex digits."""
    return np.frombuffer(raw.hex().encode(), dtype=np.uint8).reshape(-1, HEX)


def hashed(rows: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """Hex digest of each row of a contiguous matrix, or of its first ``ends`` bytes."""
    raw, width = memoryview(rows.tobytes()), rows.shape[1]
    stop = [width] * len(rows) if ends is None else ends.tolist()
    return matrix(b"".join([sha256(raw[i * width : i * width + e]).digest() for i, e in enumerate(stop)]))


def level_up(nodes: np.ndarray, fanout: int) -> np.ndarray:
    full = len(nodes) // fanout * fanout
    up = hashed(nodes[:full].reshape(-1, fanout * HEX))
    return up if full == len(nodes) else np.concatenate([up, hashed(nodes[full:].reshape(1, -1))])


def levels(nodes: np.ndarray, fanout: int, depth: int | None) -> list[np.ndarray]:
    """A block's levels from the leaves to its root: ``depth`` steps, or with None as many as it takes to have one node."""
    out = [nodes]
    while len(out) - 1 < depth if depth is not None else len(out[-1]) > 1:
        out.append(level_up(out[-1], fanout))
    return out


def runs(nodes: np.ndarray, at: np.ndarray, fanout: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For nodes ``at`` of a level: their runs (rows of ``fanout`` digests), the place in the run, and the run's length."""
    start = at // fanout * fanout
    index = np.minimum(start[:, None] + np.arange(fanout), len(nodes) - 1)
    return nodes[index], at - start, np.minimum(fanout, len(nodes) - start)


def _as_depth(t: pa.Table, depth: int) -> int | None:
    """A group of one block ends where one node is left; blocks of a larger group have all levels."""
    return None if t.column("blocks")[0].as_py() == 1 else depth


def _sorted(t: pa.Table) -> pa.Table:
    return t.sort_by("place").combine_chunks()


def _bytes(t: pa.Table, name: str) -> bytes:
    return b"".join(t.column(name).to_pylist())


def _roots(fanout: int, depth: int):
    """Rows (g, block, blocks, place, node) of one block: its root."""

    def run(t: pa.Table) -> pa.Table:
        t = _sorted(t)
        top = levels(matrix(_bytes(t, "node")), fanout, _as_depth(t, depth))[-1]
        return pa.table({"g": t.column("g")[:1], "place": t.column("block")[:1], "node": pa.array([bytes.fromhex(top[0].tobytes().decode())], pa.binary())})

    return run


def _text(digests: np.ndarray) -> str:
    return digests.tobytes().decode()


def _paths(fanout: int, depth: int):
    """Rows of one block, and the block's row in the tier above: place, and the siblings up to the root."""

    def run(t: pa.Table, above: pa.Table) -> pa.Table:
        t = _sorted(t)
        up = above.column("up")[0].as_py()
        at, n = np.arange(t.num_rows), t.num_rows
        own: list[list] = [[] for _ in range(n)]
        tree = levels(matrix(_bytes(t, "node")), fanout, _as_depth(t, depth))
        for nodes in tree[:-1]:
            near, slot, size = runs(nodes, at, fanout)
            for i in range(n):
                own[i].append({"left": _text(near[i, : slot[i]]), "right": _text(near[i, slot[i] + 1 : size[i]])})
            at = at // fanout
        return pa.table({"g": t.column("g"), "place": t.column("place"), "up": pa.array([o + up for o in own], UP)})

    return run


def _proofs(fanout: int, depth: int):
    """Leaves of one block, and its upper siblings: the result's rows."""

    def run(t: pa.Table, above: pa.Table) -> pa.Table:
        t = _sorted(t)
        n = t.num_rows
        up, subroot, root = (above.column(c)[0].as_py() for c in ("up", "subroot", "root"))
        leaves = matrix(_bytes(t, "node"))
        value = matrix(b"".join([x if x is not None else y for x, y in zip(t.column("tampered").to_pylist(), t.column("node").to_pylist(), strict=True)]))
        at, proof, has = np.arange(n), [], []
        for nodes in levels(leaves, fanout, _as_depth(t, depth))[:-1]:
            near, slot, size = runs(nodes, at, fanout)
            others = np.arange(fanout - 1)[None, :]
            others = others + (others >= slot[:, None])
            proof.append(near[np.arange(n)[:, None], others])
            has.append(others < size[:, None])
            near[np.arange(n), slot] = value
            value = hashed(near.reshape(n, -1), size * HEX)
            at = at // fanout
        rest = "".join(u["left"] + u["right"] for u in up).encode()
        for u in up:
            left, right = (np.frombuffer(u[k].encode(), dtype=np.uint8) for k in ("left", "right"))
            value = hashed(np.concatenate([np.broadcast_to(left, (n, len(left))), value, np.broadcast_to(right, (n, len(right)))], axis=1))
        siblings = np.concatenate(proof, axis=1) if proof else np.zeros((n, 0, HEX), np.uint8)
        whole = np.concatenate(has, axis=1) if has else np.zeros((n, 0), bool)
        digests = [sha256((s if w.all() else s[w]).tobytes() + rest).hexdigest() for s, w in zip(siblings, whole, strict=True)]
        folded = [_text(v) for v in value]
        return pa.table({
            "doc_id": t.column("doc_id"), "leaf": pa.array([_text(v) for v in leaves], pa.string()), "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array(digests, pa.string()), "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_()),
        })

    return run


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``place`` in their group ``g`` by ``order``, and the group's ``size``. Equal rows may lie in several ranges."""
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("g", *order, "_tie").sortWithinPartitions("g", *order, "_tie").drop("_tie")
    mono = F.monotonically_increasing_id()
    dealt = cut(spread.withColumn("_mono", mono).withColumns({"part": F.shiftright("_mono", 33), "seq": F.col("_mono").bitwiseAND((1 << 33) - 1)}).drop("_mono"), "dealt")
    per = cut(dealt.groupBy("g", "part").agg(F.min("seq").alias("low"), F.count("*").alias("n")), "ranges")
    # one row for each range that a group has rows in
    upto = F.sum("n").over(Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    per = per.withColumn("shift", upto - F.col("n") - F.col("low")).withColumn("size", F.sum("n").over(Window.partitionBy("g")))
    return dealt.join(per.select("g", "part", "shift", "size"), ["g", "part"]).withColumn("place", F.col("seq") + F.col("shift")).drop("seq", "shift", "part")


def blocked(rows: DataFrame, fanout: int, depth: int) -> DataFrame:
    """``rows`` (g, place, size, ..) with their block and the group's number of blocks."""
    width = fanout**depth
    return rows.withColumns({"block": F.floor(F.col("place") / width), "blocks": F.ceil(F.col("size") / width)})


def climb(leaves: DataFrame, fanout: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of all groups above ``leaves`` (blocked rows), each blocked and written, and the groups' roots (g, node)."""
    tiers, done, here = [], None, leaves
    while True:
        up = here.groupBy("g", "block", "blocks").applyInArrow(_roots(fanout, depth), "g string, place long, node binary")
        sizes = here.where("place = 0").select("g", F.col("blocks").alias("size"))
        up = cut(up.join(sizes, "g"), "tier")
        top = up.where("size = 1").select("g", "node")
        done = top if done is None else done.unionByName(top)
        here = blocked(up.where("size > 1"), fanout, depth)
        if here.isEmpty():
            return tiers, done
        tiers.append(here)


def descend(tiers: list[DataFrame], top: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Siblings up to the manifest's root of the nodes of the lowest tier: (g, place, up); ``top`` has (g, up) of the groups."""
    above = top.select("g", F.lit(0).cast("long").alias("place"), "up")
    for tier in reversed(tiers):
        # the block of a node is its place one tier up; groups without this tier hang from the top itself
        lower = tier.groupBy("g", "block").cogroup(above.groupBy("g", "place")).applyInArrow(_when_both(_paths(fanout, depth)), f"g string, place long, up {PATH}")
        above = cut(lower.unionByName(above.join(tier.select("g").distinct(), "g", "left_anti")), "paths")
    return above


def _when_both(f):
    """``f`` for groups that both sides have; nothing for others."""

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows:
            return f(a, b)
        return pa.table({"g": pa.array([], pa.string()), "place": pa.array([], pa.int64()), "up": pa.array([], UP)})

    return run


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, fanout: int = 2, tamper: int = 7, depth: int = DEPTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows where ``tamper`` divides crc32 of the decimal doc_id are verified with one character more in n_chars; all digests but
    folded_root are those of the true rows."""
    cols = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
    docs = docs.select(*[F.col(c).cast(kind).alias(c) for c, kind in cols.items()])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper == 0
    made = lambda n: leaf(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    group = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))
    rows = cut(docs.select(group.alias("g"), "doc_id", made(F.col("n_chars")).alias("node"), F.when(hit & F.col("n_chars").isNotNull(), made(F.col("n_chars") + 1)).alias("tampered")), "leaves")
    leaves = placed(rows, ["doc_id", "node"])
    leaves = cut(blocked(leaves, fanout, depth), "placed")
    drop(rows)
    tiers, roots = climb(leaves, fanout, depth)

    # the tree over the groups: the same, with the groups' roots as leaves of one group
    over = placed(roots.select(F.lit("").alias("g"), F.col("g").alias("own"), "node"), ["own"])
    over = cut(blocked(over, fanout, depth), "groups")
    higher, crown = climb(over, fanout, depth)
    start = crown.select("g", F.array().cast(PATH).alias("up"))
    paths = descend([over, *higher], start, fanout, depth)
    root = crown.select(F.lower(F.hex("node")).alias("root"))
    top = over.join(paths.drop("g"), "place").select(F.col("own").alias("g"), "up", F.lower(F.hex("node")).alias("subroot"))
    top = cut(top.join(F.broadcast(root)), "tops")  # one row
    # upper siblings of every block of leaves
    up = descend(tiers, top.select("g", "up"), fanout, depth).withColumnRenamed("place", "block").join(top.select("g", "subroot", "root"), "g")
    return leaves.groupBy("g", "block").cogroup(up.groupBy("g", "block")).applyInArrow(_proofs(fanout, depth), RESULT)
