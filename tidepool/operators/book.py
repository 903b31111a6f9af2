"""Order-book snapshots: distance bands, imbalance, order-book imbalance, micro-price, changes, wall persistence.

Input: canonical snapshots (inst_id, ts, mid, bids, asks) with typed levels. Snapshots without a mid are skipped.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, times
from .chains import starts
from .scale import parts_for, previous, running, spread
from .written import written

BANDS = (10, 25, 50, 100, 200, 500)
ROWS_A_TASK = 600_000
WALLS = {"BTC-USDT-SWAP": 300_000, "ETH-USDT-SWAP": 150_000}


def band_of(price: Column, mid: Column, bands=BANDS) -> Column:
    """Index of the first band whose bound in basis points is no less than the distance; null beyond the last."""
    far = F.abs(price - mid).cast("decimal(20,4)") * 10_000
    out = F.lit(None).cast("int")
    for i in reversed(range(len(bands))):
        out = F.when(far <= mid * bands[i], i).otherwise(out)
    return out


def _half_even(x: Column, digits: int) -> Column:
    """Ties are ties of the exact quotient, so the double's last digits go first; an empty side pair gives 0."""
    return F.coalesce(money.half_even(F.round(x, digits + 8), digits), F.lit(0.0))


def _imbalance(b: Column, a: Column) -> Column:
    b, a = b.cast("double"), a.cast("double")
    return _half_even(F.try_divide(b - a, b + a), 2)


def _with_contracts(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """``rows`` with ct_val. Contracts (one row an instrument) go to the rows: dealt by instrument, an instrument's rows would all be one task's."""
    return rows.join(F.broadcast(meta.select("inst_id", "ct_val")), "inst_id")


def buckets(snapshots: DataFrame, meta: DataFrame, bands=BANDS) -> DataFrame:
    """Per snapshot: notional and base by band and side (arrays), imbalance by band, obi, micro_price, best levels."""
    rows = _with_contracts(snapshots.where("mid is not null"), meta)

    # every level's distance is worked out once, and the bounds once a snapshot
    rows = rows.withColumn("_bounds", F.array(*[F.col("mid") * b for b in bands]))

    def side(levels: str, keep) -> Column:
        near = F.transform(F.filter(levels, lambda x: keep(x["price"])), lambda x: F.struct((F.abs(x["price"] - F.col("mid")).cast("decimal(20,4)") * 10_000).alias("far"), (x["qty"] * F.col("ct_val")).cast("decimal(20,8)").alias("base"), x["price"].alias("price")))
        return F.transform(near, lambda x: F.struct(F.array_position(F.transform("_bounds", lambda b: x["far"] <= b), F.lit(True)).cast("int").alias("place"), x["base"].alias("base"), (x["base"] * x["price"]).cast(money.NOTIONAL).alias("notional")))

    rows = rows.withColumn("_b", side("bids", lambda p: p <= F.col("mid"))).withColumn("_a", side("asks", lambda p: p >= F.col("mid")))
    kinds = {"notional": "decimal(30,8)", "base": "decimal(28,8)"}
    within = lambda c, i, f, kind: F.aggregate(F.filter(c, lambda x: x["place"] == i + 1), F.lit(0).cast(kind), lambda a, x: (a + x[f]).cast(kind))
    for name, c in (("bid", "_b"), ("ask", "_a")):
        rows = rows.withColumns({f"{name}_{f}": F.array(*[within(c, i, f, kind) for i in range(len(bands))]) for f, kind in kinds.items()})
    best = lambda levels, f: F.coalesce(F.get(F.col(levels), F.lit(0))[f], F.lit(0).cast(money.PRICE))
    rows = rows.withColumns({"best_bid": best("bids", "price"), "best_bid_qty": best("bids", "qty"), "best_ask": best("asks", "price"), "best_ask_qty": best("asks", "qty")})
    vb, va = F.col("best_bid_qty").cast("double"), F.col("best_ask_qty").cast("double")
    pb, pa_ = F.col("best_bid").cast("double"), F.col("best_ask").cast("double")
    return rows.withColumns({
        "obi": _half_even(F.try_divide(vb - va, vb + va), 4),
        "micro_price": F.round(F.coalesce(F.try_divide(vb * pa_ + va * pb, vb + va), (pb + pa_) / 2), 6),
        "imbalance": F.zip_with("bid_notional", "ask_notional", _imbalance),
    }).drop("_b", "_a", "_bounds", "bids", "asks", "ct_val")


def level_buckets(snapshots: DataFrame, levels: DataFrame, meta: DataFrame, key: str, bands=BANDS, parts: int | None = None) -> DataFrame:
    """``buckets`` of levels that are rows (``key``, side, price, qty) rather than arrays: the snapshots' columns (one row a ``key``),
    notional and base by band and side, imbalance by band. Joins and sums in compiled code, in ``parts`` tasks. A band's bound is
    worked out once a snapshot and cut to the last digit of a price, so levels are compared as longs; of a task's share the
    snapshots are looked up by hash where ``parts`` keeps them few."""
    bound = lambda b: F.floor((F.col("mid").cast(money.PRICE) * b).cast("decimal(32,4)") * F.lit("0.0001").cast("decimal(4,4)"), F.lit(4))
    farthest = F.lit("9999999999999.9999").cast("decimal(17,4)")  # of a distance of two prices
    heads = _with_contracts(snapshots.where("mid is not null"), meta).withColumns({f"_bound_{i}": F.least(bound(b), farthest).cast("decimal(17,4)") for i, b in enumerate(bands)})
    heads, levels = spread(heads, parts, key), spread(levels.select(key, "side", "price", "qty"), parts, key)
    rows = levels.join(heads.hint("shuffle_hash") if parts else heads, key, "right")
    kept = F.when(F.col("side") == "bid", F.col("price") <= F.col("mid")).otherwise(F.col("price") >= F.col("mid"))
    place = F.lit(None).cast("int")
    for i in reversed(range(len(bands))):
        place = F.when(F.abs(F.col("price") - F.col("mid")) <= F.col(f"_bound_{i}"), i).otherwise(place)
    rows = rows.withColumns({"_place": F.when(kept, place), "_base": (F.col("qty") * F.col("ct_val")).cast("decimal(20,8)")})
    rows = rows.withColumns({"_cell": F.when(F.col("side") == "bid", F.col("_place")).otherwise(F.col("_place") + len(bands)), "_notional": (F.col("_base") * F.col("price")).cast(money.NOTIONAL)})
    kinds = {"notional": "decimal(30,8)", "base": "decimal(28,8)"}
    cells = [(s, f, i, at * len(bands) + i) for at, s in enumerate(("bid", "ask")) for f in kinds for i in range(len(bands))]
    sums = rows.groupBy(*snapshots.columns).agg(*[F.sum(F.when(F.col("_cell") == cell, F.col(f"_{f}"))).alias(f"_{s}_{f}_{i}") for s, f, i, cell in cells])
    filled = lambda s, f, i: F.coalesce(F.col(f"_{s}_{f}_{i}").cast(kinds[f]), F.lit(0).cast(kinds[f]))
    arrays = [F.array(*[filled(s, f, i) for i in range(len(bands))]).alias(f"{s}_{f}") for s in ("bid", "ask") for f in kinds]
    return sums.select(*snapshots.columns, *arrays, F.array(*[_imbalance(filled("bid", "notional", i), filled("ask", "notional", i)) for i in range(len(bands))]).alias("imbalance"))


def by_band(bucket_rows: DataFrame, bands=BANDS) -> DataFrame:
    """Long form: one row per snapshot, side and band."""
    cells = [x for s in ("bid", "ask") for i in range(len(bands)) for x in (F.lit(s), F.lit(i), F.get(F.col(f"{s}_notional"), F.lit(i)), F.get(F.col(f"{s}_base"), F.lit(i)))]
    return bucket_rows.select("inst_id", "ts", F.stack(F.lit(2 * len(bands)), *cells).alias("side", "band", "notional", "base"))


def changes(long_rows: DataFrame, least: float = 100_000, share: float = 0.10, parts: int | None = None) -> DataFrame:
    """Change of notional against the previous snapshot (0 before the first), and whether it is significant; in ``parts`` tasks."""
    keys = ["inst_id", "side", "band"]
    rows = long_rows.withColumn("_day", times.day(F.col("ts")))
    w = Window.partitionBy(*keys, "_day").orderBy("ts")
    last = rows.groupBy(*keys, "_day").agg(F.max_by("notional", "ts").alias("_last"))
    last = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_day"))).drop("_last")
    rows = spread(rows, parts, *keys, "_day").withColumn("_in", F.lag("notional").over(w)).join(last, [*keys, "_day"])
    return _changed(rows, F.coalesce("_in", "_carry", F.lit(0).cast("decimal(30,8)")), least, share).drop("_day", "_in", "_carry")


def _changed(rows: DataFrame, before: Column, least: float, share: float) -> DataFrame:
    delta = F.col("notional") - before
    big = (F.abs(delta) > F.lit(least).cast("decimal(20,2)")) | ((before > 0) & (F.abs(delta).cast("double") > share * before.cast("double")))
    return rows.withColumn("delta", delta).withColumn("significant", big)


def bucket_changes(bucket_rows: DataFrame, least: float = 100_000, share: float = 0.10, parts: int | None = None) -> DataFrame:
    """``changes`` of all bands at once: the row before is looked up by snapshot, and only then the bands become rows (inst_id, ts,
    side, band, notional, delta, significant). The snapshots are written once, as they are read twice."""
    names = [f"{s}_notional" for s in ("bid", "ask")]
    rows = written(bucket_rows.select("inst_id", "ts", *names), "buckets")
    rows = previous(rows, ["inst_id"], times.day(F.col("ts")), ["ts"], F.struct(*names), "_before", parts)
    cells = [x for s, n in zip(("bid", "ask"), names, strict=True) for i in range(len(BANDS)) for x in (F.lit(s), F.lit(i), F.get(F.col(n), F.lit(i)), F.get(F.col("_before")[n], F.lit(i)))]
    rows = rows.select("inst_id", "ts", F.stack(F.lit(2 * len(BANDS)), *cells).alias("side", "band", "notional", "_in"))
    return _changed(rows, F.coalesce("_in", F.lit(0).cast("decimal(30,8)")), least, share).drop("_in")


def _born(us: Column) -> Column:
    return us - F.pmod(us, F.lit(1_000_000))


def _whole(start: Column, since: Column, rest_s: int, longest_s: int) -> Column:
    """Whole seconds of age of the row at ``us``, if it isn't the start and they count."""
    age = F.col("us") - _born(since)
    return F.when(since.isNotNull() & ~start & age.between(rest_s * 1_000_000, longest_s * 1_000_000), F.floor(age / 1_000_000))


def _enough(amounts: list[str], thresholds: dict[str, float] | None) -> Column:
    """Bit k is set if the k-th amount is enough for the instrument."""
    least = F.element_at(F.create_map(*[F.lit(x) for k, v in (thresholds or WALLS).items() for x in (k, float(v))]), F.col("inst_id")).cast("decimal(20,2)")
    bits = [F.when(F.col(c) >= least, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, c in enumerate(amounts)]
    return functools.reduce(lambda a, b: a + b, bits)


def _has(bits: Column, k: int) -> Column:
    return F.getbit(bits, F.lit(k)) == 1


def _streaks(rows: DataFrame, keys: list[str], amounts: list[str], thresholds: dict[str, float] | None, parts: int | None) -> DataFrame:
    """``rows`` with us, _day and, for each amount that is enough, ``_from_<k>``: where its streak of enough began. They are dealt once,
    by day, whatever the number of amounts, and written; a streak's start comes from a window over the day and one row a day of
    those before, which is broadcast if ``parts`` is given."""
    rows = rows.withColumns({"us": times.micros(F.col("ts")), "_day": times.day(F.col("ts")), "_bits": _enough(amounts, thresholds)})
    day = Window.partitionBy(*keys, "_day").orderBy("us")
    # the first row of a day may go on with the streak of the day before, so it is left to the days
    rows = spread(rows, parts, *keys, "_day").withColumn("_new", F.col("_bits").bitwiseAND(F.bitwise_not(F.lag("_bits").over(day))))
    so_far = day.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_in_{k}": F.when(_has(F.col("_bits"), k), F.max(F.when(_has(F.col("_new"), k), F.col("us"))).over(so_far)) for k in range(len(amounts))}).drop("_new")
    rows = written(rows, "bands")
    days = rows.groupBy(*keys, "_day").agg(F.min("us").alias("_first"), F.min_by("_bits", "us").alias("_opens"), F.max_by("_bits", "us").alias("_ends"), *[F.max(f"_in_{k}").alias(f"_in_{k}") for k in range(len(amounts))])
    by_day = Window.partitionBy(*keys).orderBy("_day")
    days = days.withColumn("_starts", F.col("_opens").bitwiseAND(F.bitwise_not(F.coalesce(F.lag("_ends").over(by_day), F.lit(0).cast("long")))))
    new = {k: F.when(_has(F.col("_starts"), k), F.col("_first")) for k in range(len(amounts))}
    old = {k: F.max(F.greatest(f"_in_{k}", new[k])).over(by_day.rowsBetween(Window.unboundedPreceding, -1)) for k in new}
    days = days.select(*keys, "_day", *[F.greatest(new[k], old[k]).alias(f"_old_{k}") for k in new])
    marked = rows.join(F.broadcast(days) if parts else days, [*keys, "_day"])
    marked = marked.withColumns({f"_from_{k}": F.when(_has(F.col("_bits"), k), F.greatest(f"_in_{k}", f"_old_{k}")) for k in new})
    return marked.drop("_bits", *[f"{c}_{k}" for c in ("_in", "_old") for k in new])


def _aged(marked: DataFrame, long: DataFrame, keys: list[str], columns: list[str], rest_s: int, longest_s: int, width_s: int | None, parts: int | None) -> DataFrame:
    """``columns`` of ``marked`` (keys, us, _day, _from) with wall_age and wall_active. In the streaks ``long`` (keys, _from), those
    that outlast ``longest_s``, the births follow from each other."""
    longest = longest_s * 1_000_000
    lasts = not long.isEmpty()
    plain = marked.join(long, [*keys, "_from"], "left_anti") if lasts else marked
    out = plain.withColumn("wall_age", _whole(F.col("us") == F.col("_from"), F.col("_from"), rest_s, longest_s)).select(*columns, "wall_age")
    if lasts:
        lasting = written(marked.join(long, [*keys, "_from"], "left_semi"), "lasting")
        parts = parts or parts_for(lasting.count(), ROWS_A_TASK)
        kept = running(lasting.withColumn("series", F.to_json(F.struct(*keys, "_from"))), ["series"], "_day", ["us"], {"_n": F.lit(1).cast("long")}, parts=parts)
        at = F.col("us") - F.col("_from")
        again = starts(kept.select("series", (F.col("_n") - 1).alias("place"), at.alias("at"), at.alias("end"), F.greatest(at, _born(F.col("us")) + longest - F.col("_from")).alias("limit")), longest, skip=1, width=width_s and width_s * 1_000_000)
        births = kept.withColumn("place", F.col("_n") - 1).join(again, ["series", "place"], "left_semi").select(*keys, "us", F.lit(True).alias("_start"))
        lived = running(lasting.join(births, [*keys, "us"], "left"), keys, "_day", ["us"], maxima={"_born": F.when(F.col("_start"), F.col("us"))}, parts=parts)
        out = out.unionByName(lived.withColumn("wall_age", _whole(F.col("_start").isNotNull(), F.col("_born"), rest_s, longest_s)).select(*columns, "wall_age"))
    return out.withColumn("wall_active", F.col("wall_age").isNotNull())


def walls(long_rows: DataFrame, thresholds: dict[str, float] | None = None, rest_s: int = 30, longest_s: int = 3600, width_s: int | None = None, parts: int | None = None) -> DataFrame:
    """``long_rows`` with wall_age (whole seconds, null if none) and wall_active.

    A wall is born (in whole seconds) at the first snapshot with enough notional, active from ``rest_s`` to ``longest_s``
    seconds of age, then starts anew with the next snapshot; too little notional ends it. Rows are dealt once, by day
    (``_streaks``). In streaks longer than ``longest_s`` the births follow from each other (``chains.starts``), in blocks of
    ``width_s`` seconds; a streak may last for years. One row per instrument, side, band and time."""
    keys = ["inst_id", "side", "band"]
    marked = _streaks(long_rows, keys, ["notional"], thresholds, parts).withColumnRenamed("_from_0", "_from")
    long = written(marked.where(F.col("us") - F.col("_from") > longest_s * 1_000_000).select(*keys, "_from").distinct(), "streaks")
    return _aged(marked, long, keys, long_rows.columns, rest_s, longest_s, width_s, parts)


def _cells(bands) -> list[tuple[str, int]]:
    return [(s, i) for s in ("bid", "ask") for i in bands]


def _amounts(bucket_rows: DataFrame, cells: list[tuple[str, int]]) -> DataFrame:
    return bucket_rows.select("inst_id", "ts", *[F.get(F.col(f"{s}_notional"), F.lit(i)).alias(f"_n_{k}") for k, (s, i) in enumerate(cells)])


def bucket_walls(bucket_rows: DataFrame, thresholds: dict[str, float] | None = None, rest_s: int = 30, longest_s: int = 3600, width_s: int | None = None, parts: int | None = None, bands=range(len(BANDS))) -> DataFrame:
    """``walls`` of the ``bands`` of bucket rows (inst_id, ts, side, band, notional, wall_age, wall_active): a snapshot stays one row
    until all its streaks' starts are known, and only then its bands become rows."""
    cells, keys = _cells(bands), ["inst_id", "side", "band"]
    marked = _streaks(_amounts(bucket_rows, cells), ["inst_id"], [f"_n_{k}" for k in range(len(cells))], thresholds, parts)
    flat = [x for k, (s, i) in enumerate(cells) for x in (F.lit(s), F.lit(i), F.col(f"_n_{k}"), F.col(f"_from_{k}"))]
    stacked = lambda df: df.select("inst_id", "ts", "us", "_day", F.stack(F.lit(len(cells)), *flat).alias("side", "band", "notional", "_from"))
    rows = stacked(marked)
    long = written(rows.where(F.col("us") - F.col("_from") > longest_s * 1_000_000).select(*keys, "_from").distinct(), "streaks")
    return _aged(rows, long, keys, ["inst_id", "ts", "side", "band", "notional"], rest_s, longest_s, width_s, parts)


def last_walls(bucket_rows: DataFrame, thresholds: dict[str, float] | None = None, rest_s: int = 30, longest_s: int = 3600, width_s: int | None = None, parts: int | None = None) -> DataFrame:
    """The rows of ``bucket_walls``, without notional, of each instrument's last snapshot. Only the streaks that it stands in matter, and they
    begin behind the last snapshot without enough: two sums by instrument over what is enough (one number a snapshot, written
    once), no window."""
    cells, keys = _cells(range(len(BANDS))), ["inst_id", "side", "band"]
    rows = _amounts(bucket_rows, cells)
    rows = written(rows.select("inst_id", "ts", times.micros(F.col("ts")).alias("us"), _enough([f"_n_{k}" for k in range(len(cells))], thresholds).alias("_bits")), "marks")
    ends = rows.groupBy("inst_id").agg(F.max("us").alias("_last"), *[F.max(F.when(~_has(F.col("_bits"), k), F.col("us"))).alias(f"_bad_{k}") for k in range(len(cells))])
    live = rows.join(F.broadcast(ends), "inst_id").where((F.col("us") > F.least(*[F.coalesce(f"_bad_{k}", F.col("us") - 1) for k in range(len(cells))])) | (F.col("us") == F.col("_last")))
    flat = [x for k, (s, i) in enumerate(cells) for x in (F.lit(s), F.lit(i), F.coalesce(F.col("us") > F.col(f"_bad_{k}"), F.lit(True)))]
    live = live.select("inst_id", "ts", "us", "_last", F.stack(F.lit(len(cells)), *flat).alias("side", "band", "_live")).where(F.col("_live") | (F.col("us") == F.col("_last")))
    live = written(live, "live")
    began = live.where("_live").groupBy(*keys).agg(F.min("us").alias("_from"), F.max("_last").alias("_last"))
    marked = live.where("_live").drop("_last", "_live").join(began.select(*keys, "_from"), keys).withColumn("_day", times.day(F.col("ts")))
    marked = marked.unionByName(live.where(~F.col("_live")).select("inst_id", "ts", "us", "side", "band", F.lit(None).cast("long").alias("_from"), times.day(F.col("ts")).alias("_day")))
    long = written(began.where(F.col("_last") - F.col("_from") > longest_s * 1_000_000).select(*keys, "_from"), "streaks")
    aged = _aged(marked, long, keys, ["inst_id", "ts", "us", "side", "band"], rest_s, longest_s, width_s, parts)
    return aged.join(F.broadcast(ends.select("inst_id", "_last")), "inst_id").where(F.col("us") == F.col("_last")).drop("us", "_last")


def with_wall_ages(rows: DataFrame, walls: DataFrame) -> DataFrame:
    """Bucket rows with arrays bid_wall_age and ask_wall_age by band."""
    ages = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("band", "wall_age")))), lambda x: x["wall_age"])
    return rows.join(walls.groupBy("inst_id", "ts").agg(*[ages(s).alias(f"{s}_wall_age") for s in ("bid", "ask")]), ["inst_id", "ts"], "left")


def sequence_gaps(snapshots: DataFrame) -> DataFrame:
    """Snapshots whose prevSeqId isn't the sequence number before them; a series' first one has no gap."""
    rows = previous(snapshots, ["inst_id"], times.day(F.col("ts")), ["ts", "seqId"], F.col("seqId"), "_before")
    return rows.withColumn("gap_detected", F.coalesce(F.col("_before") != F.col("prevSeqId"), F.lit(False))).drop("_before")


def depth_weighted(snapshots: DataFrame, alpha: float = 0.1, depth: int = 400) -> DataFrame:
    """``snapshots`` with depth_obi: imbalance of the sizes of the best ``depth`` levels a side, level i (from 1) with the weight
    exp(-alpha i); 0 for a book without levels."""
    def total(levels: str) -> Column:
        sizes = F.transform(F.slice(F.coalesce(F.col(levels), F.array().cast(f"array<struct<price:{money.PRICE},qty:{money.QTY}>>")), 1, depth), lambda x, i: x["qty"].cast("double") * F.exp(-alpha * (i + 1)))
        return F.aggregate(sizes, F.lit(0.0), lambda a, x: a + x)

    rows = snapshots.withColumns({"_b": total("bids"), "_a": total("asks")})
    return rows.withColumn("depth_obi", F.round(F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.col("_b") + F.col("_a")), F.lit(0.0)), 6)).drop("_b", "_a")


def order_flow(bucket_rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Order-flow imbalance of the best levels against the snapshot before (0 for an instrument's first): size that came
    at the same or a better price less size that went, bids less asks. In ``parts`` tasks."""
    best = F.struct("best_bid", "best_bid_qty", "best_ask", "best_ask_qty")
    rows = previous(bucket_rows, ["inst_id"], times.day(F.col("ts")), ["ts"], best, "_before", parts)
    b = F.col("_before")
    size = lambda on, q: F.when(on, q.cast("decimal(24,4)")).otherwise(F.lit(0).cast("decimal(24,4)"))
    bids = size(F.col("best_bid") >= b["best_bid"], F.col("best_bid_qty")) - size(F.col("best_bid") <= b["best_bid"], b["best_bid_qty"])
    asks = size(F.col("best_ask") <= b["best_ask"], F.col("best_ask_qty")) - size(F.col("best_ask") >= b["best_ask"], b["best_ask_qty"])
    return rows.withColumn("ofi", F.when(b.isNull(), F.lit(0).cast("decimal(26,4)")).otherwise(bids - asks)).drop("_before")


def order_flow_bars(flow: DataFrame, seconds: int = 10) -> DataFrame:
    """Order-flow imbalance summed over windows of ``seconds``: inst_id, window_start, ofi, snapshots."""
    us = times.micros(F.col("ts"))
    start = F.timestamp_micros(us - F.pmod(us, F.lit(seconds * 1_000_000)))
    return flow.groupBy("inst_id", start.alias("window_start")).agg(F.sum("ofi").alias("ofi"), F.count("*").alias("snapshots"))
