"""Embedding near-duplicates by collision-counting projections.

Every vector is projected on many seeded random directions. A pair collides on a projection if the other's value lies
within ``half`` of the query's own value: a window centred at the query, found by binary search in the sorted
projection. The window and the number of collisions asked for come from the wanted recall: for a pair exactly at the
similarity bound, each difference of projections is a normal variable of known width, so the binomial quantile of the
count is known. Pairs that pass the count are verified by their cosine in double precision.

Labels of at most four blocks are one cell. In larger ones pairs meet in cells: a group of further projections, cut at
every ``4 * half`` with a random shift, gives each vector one cell, and there are so many groups that a pair at the bound
shares a cell in one of them. The number of projections in a group follows the label's rows, so that cells stay small, and
groups times cell size grows far slower than the label. Window counts and cells lose half of 1 - ``recall`` each at most.
A pair that shares several cells counts in the first one. Cells with many rows are cut into blocks, and every block of
queries meets every block of candidates, so that one task never holds more than two blocks. There every projection of the
candidates is sorted, each query's window is a range of each sorted projection, and the ranges add one to the candidates
that they hold. A block emits, per query, the sum of its links and one edge to the smallest vector of its block component,
never the pairs themselves. Equal vectors are one vector with a weight.

Defined cases: rows whose label is null or whose vector is null, empty, zero or has null or non-finite components
link with nothing and are their own component; vectors of other lengths or labels are never compared; repeated
vec_ids keep their rows and share a component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .scratch import cut, drop

BLOCK = 2048
PROJECTIONS = 24


def calibrate(bound: float, projections: int = PROJECTIONS, recall: float = 0.99999) -> tuple[float, int]:
    """Half width of the window, and the collisions asked for, so that a pair at the bound passes the count but for half
    of what may be lost."""
    sigmas = 2.5
    p = math.erf(sigmas / math.sqrt(2))
    least, below = 0, 0.0
    for k in range(projections + 1):  # the largest count that loses no more
        below += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if below > (1 - recall) / 2:
            least = k
            break
    return sigmas * math.sqrt(2 - 2 * bound), least


def shared_cell(wide: float, apart: float) -> float:
    """Chance that two values whose difference is normal with deviation ``apart`` share a cell of this width."""
    t = wide / apart
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def grouping(rows: int, bound: float, half: float, recall: float, block: int = BLOCK) -> tuple[int, int]:
    """Projections in a group, and groups, for a label of so many rows: unrelated vectors leave cells of a quarter of a
    block, and a pair at the bound misses all groups with half of what may be lost at most."""
    near, far = shared_cell(4 * half, math.sqrt(2 - 2 * bound)), shared_cell(4 * half, math.sqrt(2))
    size = max(1, math.ceil(math.log(4 * rows / block) / -math.log(far)))
    return size, math.ceil(math.log((1 - recall) / 2) / math.log(1 - near**size))


def directions(dim: int, projections: int, seed: int = 20_240) -> np.ndarray:
    return np.random.default_rng(seed + dim).standard_normal((dim, projections))


def _keys(unit: np.ndarray, size: int, groups: int, wide: float) -> np.ndarray:
    """One 64-bit cell for each unit vector and group."""
    at = unit @ directions(unit.shape[1], size * groups, 77) + np.random.default_rng(7).random(size * groups) * wide
    cell = np.floor(at / wide).astype(np.int64).reshape(len(unit), groups, size)
    return (cell * np.random.default_rng(8).integers(1, 1 << 62, size)).sum(axis=2)  # wraps around


def _cells(half: float):
    """Rows (node, vector) to (grp, cell, node, vector): one for each group; labels without groups have the cell alone."""

    def run(frames):
        for f in frames:
            out = []
            for (dim, size, groups), part in f.groupby(["dim", "size", "groups"]):
                x = np.stack(part.vector.to_numpy()).astype(np.float64)
                x /= np.linalg.norm(x, axis=1)[:, None]
                keys = _keys(x, size, groups, 4 * half) if groups else np.zeros((len(x), 1), np.int64)
                for g in range(keys.shape[1]):
                    name = [f"{a}|{dim}|{k}" for a, k in zip(part.label, keys[:, g].tolist(), strict=True)]
                    out.append(pd.DataFrame({"grp": np.int32(g), "cell": name, "size": size, "groups": groups, "node": part.node, "weight": part.weight, "vector": part.vector}))
            if out:
                yield pd.concat(out)

    return run


def _least_of_component(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member index of each index's component under the pairs (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        if (before == root).all():
            break
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root


def _block(projections: int, bound: float, half: float, least: int):
    """Links between the queries and the candidates of one pair of blocks."""

    def run(key, f: pd.DataFrame) -> pd.DataFrame:
        grp = int(key[0])
        q, c = f[f["query"]], f[~f["query"]]
        none = pd.DataFrame({"node": [], "links": [], "to": []}).astype("int64")
        if not len(q) or not len(c):
            return none
        qx, cx = (np.stack(t.vector.to_numpy()).astype(np.float64) for t in (q, c))
        dirs = directions(qx.shape[1], projections)
        qn, cn = np.linalg.norm(qx, axis=1), np.linalg.norm(cx, axis=1)
        qp, cp = (qx / qn[:, None]) @ dirs, (cx / cn[:, None]) @ dirs
        cnode, cw, qnode = c.node.to_numpy(), c.weight.to_numpy(), q.node.to_numpy()
        order = np.argsort(cp, axis=0, kind="stable")
        windows = []
        for j in range(projections):
            sorted_ = cp[order[:, j], j]
            left, right = (np.searchsorted(sorted_, qp[:, j] + side, how).tolist() for side, how in ((-half, "left"), (half, "right")))
            windows.append((np.ascontiguousarray(order[:, j]), left, right))
        # a pair that shares an earlier cell counts there
        before = [_keys(x / n[:, None], int(f["size"].iloc[0]), int(f["groups"].iloc[0]), 4 * half)[:, :grp] for x, n in ((qx, qn), (cx, cn))] if grp else None
        got_a, got_b = [], []
        for i in range(len(q)):
            hit = np.zeros(len(c), dtype=np.int16)
            for at, left, right in windows:
                hit[at[left[i] : right[i]]] += 1
            b = np.flatnonzero((hit >= least) & (cnode != qnode[i]))
            if grp and len(b):
                b = b[(before[1][b] != before[0][i]).all(axis=1)]
            if len(b):
                good = cx[b] @ qx[i] / (qn[i] * cn[b]) >= bound
                got_b.append(b[good])
                got_a.append(np.full(good.sum(), i))
        if not got_a or not sum(map(len, got_a)):
            return none
        a, b = np.concatenate(got_a), np.concatenate(got_b)
        links = np.bincount(a, weights=cw[b], minlength=len(qnode)).astype(np.int64)
        ids, inv = np.unique(np.concatenate([qnode, cnode]), return_inverse=True)
        root = _least_of_component(inv[a], inv[len(qnode) + b], len(ids))
        count = pd.Series(links, index=qnode)
        count = count[count > 0]
        touched = np.flatnonzero(root != np.arange(len(ids)))
        return pd.concat([
            pd.DataFrame({"node": count.index.to_numpy(), "links": count.to_numpy(), "to": count.index.to_numpy()}),
            pd.DataFrame({"node": ids[touched], "links": 0, "to": ids[root[touched]]}),
        ]).astype("int64")

    return run


def near_dedup(rows: DataFrame, bound: float = 0.98, recall: float = 0.99999, projections: int = PROJECTIONS, block: int = BLOCK) -> DataFrame:
    """Per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id, kept (vec_id = component_id)."""
    half, least = calibrate(bound, projections, recall)
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label"))
    odd = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = F.forall("vector", lambda v: v == 0)
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("vector") > 0) & ~odd & ~zero, F.lit(False))
    # equal vectors of a label are one node, named by its smallest vec_id; -0.0 counts as 0.0
    plain = F.transform("vector", lambda v: v + F.lit(0.0))
    base = base.withColumn("same", F.when(usable, F.sha2(F.concat_ws("|", F.col("label"), F.concat_ws(",", plain.cast("array<string>"))), 256)))
    nodes = base.where("same is not null").groupBy("same").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("vector").alias("vector"), F.first("label").alias("label"))
    nodes = cut(nodes, "nodes")
    # groups of projections by powers of two of the label's rows
    dims = nodes.withColumn("dim", F.size("vector"))
    sizes = dims.groupBy("label", "dim").agg(F.ceil(F.log2(F.count("*"))).cast("int").alias("bits"))
    shape = {b: grouping(1 << b, bound, half, recall, block) if 1 << b > 4 * block else (0, 0) for b in range(48)}
    of = lambda i: F.element_at(F.lit([shape[b][i] for b in range(48)]), F.col("bits") + 1)
    dims = dims.join(sizes, ["label", "dim"]).withColumn("size", of(0)).withColumn("groups", of(1))
    kind = "grp int, cell string, size int, groups int, node long, weight long, vector array<double>"
    cells = cut(dims.select("node", "weight", "label", "dim", "size", "groups", "vector").mapInPandas(_cells(half), kind), "cells")
    counted = cells.groupBy("grp", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("cuts"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    dealt = cells.join(counted, ["grp", "cell"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    every, same_cols = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)), ["size", "groups", "node", "weight", "vector"]
    queries = dealt.select("grp", "cell", "part", every.alias("other"), F.lit(True).alias("query"), *same_cols)
    wanted = dealt.select("grp", "cell", every.alias("p"), F.col("part").alias("other"), *same_cols).select("grp", "cell", F.col("p").alias("part"), "other", F.lit(False).alias("query"), *same_cols)
    found = queries.unionByName(wanted).groupBy("grp", "cell", "part", "other").applyInPandas(_block(projections, bound, half, least), "node long, links long, to long")
    found = cut(found, "found")
    drop(cells)
    comp = components(found.where("node <> to").select("node", "to"), "node", "to")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = nodes.select("same", "node", "weight").join(degree, "node", "left").join(comp, "node", "left").select("same", F.coalesce("links", F.lit(0)).alias("links"), "weight", F.coalesce("component", "node").alias("component"))
    out = base.select("vec_id", "same").join(of, "same", "left")
    out = out.select("vec_id", F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
