"""The driver's tables in the shape of market data: trades from events, book snapshots from orders and their lines."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money
from ..operators.scale import parts_for, spread
from ..operators.written import shared_path
from ..sources.market import with_money

BTC, ETH = "BTC-USDT-SWAP", "ETH-USDT-SWAP"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instrument(parity) -> F.col:
    return F.when(parity % 2 == 0, BTC).otherwise(ETH)


def contract(inst) -> F.col:
    return F.when(inst == BTC, F.lit("0.01")).otherwise(F.lit("0.1")).cast(money.CONTRACT)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical trades: click and purchase buy, view and error sell, signup is neither."""
    e = table(spark, sf_dir, "events")
    inst = instrument(F.col("user_id"))
    side = F.when(F.col("event_type").isin("click", "purchase"), "buy").when(F.col("event_type").isin("view", "error"), "sell").otherwise("other")
    rows = e.select(
        inst.alias("inst_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("trade_id"), side.alias("side"),
        (F.col("value").cast(money.PRICE) + 100).cast(money.PRICE).alias("price"), (F.get_json_object("props", "$.k").cast("int") + 1).cast(money.QTY).alias("qty"), contract(inst).alias("ct_val"),
    )
    return with_money(rows)


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as strings, as a feed delivers them; every tenth size has an empty price."""
    t = trades(spark, sf_dir)
    text = lambda c: F.col(c).cast("string")
    return t.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp_utc"), F.lit("okx").alias("exchange"), F.lit("perp").alias("market"), F.col("inst_id").alias("instId"), F.lit(None).cast("string").alias("symbol_canon"),
        text("trade_id").alias("trade_id"), "side", F.when(F.col("qty") % 10 == 0, "").otherwise(text("price")).alias("price"), text("qty").alias("qty_contracts"), text("ct_val").alias("ctVal"), F.lit("1").alias("ctMult"), F.lit("linear").alias("ctType"),
    )


def meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(BTC, "0.01", "0.1"), (ETH, "0.1", "0.01")], "inst_id string, c string, t string").select("inst_id", F.col("c").cast(money.CONTRACT).alias("ct_val"), F.lit(1).cast(money.CONTRACT).alias("ct_mult"), F.lit("linear").alias("ct_type"), F.col("t").cast("decimal(16,8)").alias("tick"))


#: Orders of one task. The number of tasks follows the tables, so the rows of a task don't.
ORDERS_A_TASK = 20_000


#: The same where a snapshot is one row of sums: fewer and larger pieces between the two deals of ``t7_walls``.
SUMS_A_TASK = 100_000


def book_parts(spark: SparkSession, sf_dir: str, each: int = ORDERS_A_TASK) -> int:
    return parts_for(table(spark, sf_dir, "orders").count(), each, int(spark.conf.get("spark.sql.shuffle.partitions")))


def snapshots(spark: SparkSession, sf_dir: str, mid: int = 1000) -> DataFrame:
    """One an order, two seconds apart: seq, inst_id, ts, mid."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("seq"), instrument(k).alias("inst_id"), F.timestamp_seconds(F.lit(1_704_067_200) + k * 2).alias("ts"), F.lit(mid).cast(money.PRICE).alias("mid"))


def levels(spark: SparkSession, sf_dir: str, mid: int = 1000) -> DataFrame:
    """The lines of the orders as levels up to five percent from ``mid``: seq, side, price, off, qty."""
    side = F.when(F.col("l_returnflag") == "R", "bid").when(F.col("l_returnflag") == "A", "ask").when(F.col("l_linestatus") == "O", "bid").otherwise("ask")
    off = (F.col("l_discount").cast("decimal(6,4)") * F.lit(Decimal(mid) / 2)).cast("decimal(12,4)")
    level = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("seq"), side.alias("side"), off.alias("off"), F.col("l_quantity").cast(money.QTY).alias("qty"))
    return level.select("seq", "side", F.when(F.col("side") == "bid", mid - F.col("off")).otherwise(mid + F.col("off")).cast(money.PRICE).alias("price"), "off", "qty")


def book(spark: SparkSession, sf_dir: str, mid: int = 1000) -> DataFrame:
    """The snapshots with their levels, best first."""
    parts = book_parts(spark, sf_dir)
    level = spread(levels(spark, sf_dir, mid), parts, "seq")
    sides = level.groupBy("seq").agg(*[F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("off", F.negative("qty").alias("less"), "price", "qty")))).alias(f"{s}s") for s in ("bid", "ask")])
    typed = lambda c: F.transform(F.coalesce(F.col(c), F.array().cast("array<struct<off:decimal(12,4),less:decimal(16,4),price:decimal(16,4),qty:decimal(16,4)>>")), lambda x: F.struct(x["price"].alias("price"), x["qty"].alias("qty")))
    return spread(snapshots(spark, sf_dir, mid), parts, "seq").join(sides, "seq", "left").select("seq", "inst_id", "ts", "mid", typed("bids").alias("bids"), typed("asks").alias("asks"))


def as_lines(rows: DataFrame, name: str, bad_every: int = 0) -> str:
    """The folder, shared by all executors, of JSON lines written from ``rows``; every so many lines one is cut short."""
    path, line = shared_path(rows.sparkSession, name), F.to_json(F.struct(*rows.columns))
    if bad_every:
        line = F.when(F.pmod(F.xxhash64(*rows.columns), F.lit(bad_every)) == 0, F.left(line, F.length(line) - 2)).otherwise(line)
    rows.select(line.alias("value")).write.text(path)
    return path


def raw_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book snapshots as a feed delivers them: levels as arrays of text, in one of three fields; every seventh has no mid."""
    b = book(spark, sf_dir)
    texts = lambda c: F.transform(c, lambda x: F.array(x["price"].cast("string"), x["qty"].cast("string"), F.lit("0"), F.lit("1")))
    kind = F.col("seq") % 3
    field = lambda side, k: F.when(kind == k, texts(f"{side}s"))
    return b.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp_utc"), F.col("inst_id").alias("instId"), F.when(F.col("seq") % 7 > 0, F.col("mid").cast("string")).otherwise("").alias("mid_price"), F.col("seq").alias("seqId"),
        *[c for side in ("bid", "ask") for c in (field(side, 0).alias(f"{side}s"), field(side, 1).alias(f"{side}s_top200"), field(side, 2).alias(f"{side}s_top400"))],
    )
