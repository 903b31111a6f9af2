"""Market-data sources: JSON lines of trades, books, contracts and derivative points, typed and validated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money, times
from . import schemas

BAD = "_corrupt_record"
REQUIRED = ["ts", "trade_id", "price", "qty", "side", "inst_id"]


def read_lines(spark: SparkSession, path: str, schema: str, fail_fast: bool = False) -> DataFrame:
    """JSON lines below ``path`` (also .gz). Blank lines are skipped; bad ones are kept in ``_corrupt_record``, or fail."""
    reader = spark.read.schema(schema if fail_fast else f"{schema}, {BAD} string").option("recursiveFileLookup", "true").option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
    return reader.json(path) if fail_fast else reader.option("columnNameOfCorruptRecord", BAD).json(path)


def _number(c: str, kind: str) -> Column:
    return F.col(c).try_cast(kind)


def canonical_perps(raw: DataFrame) -> DataFrame:
    """Raw derivative trades as canonical rows: inst_id, ts, trade_id, side, price, qty, ct_val, notional, pv."""
    return with_money(raw.select(
        F.col("instId").alias("inst_id"), F.try_to_timestamp("timestamp_utc").alias("ts"), _number("trade_id", "long").alias("trade_id"), "side",
        _number("price", money.PRICE).alias("price"), _number("qty_contracts", money.QTY).alias("qty"), _number("ctVal", money.CONTRACT).alias("ct_val"),
    ))


def canonical_spot(raw: DataFrame) -> DataFrame:
    """Raw spot trades as canonical rows; the contract value is 1."""
    return with_money(raw.select(
        F.col("symbol").alias("inst_id"), F.try_to_timestamp("timestamp_utc").alias("ts"), _number("trade_id", "long").alias("trade_id"), "side",
        _number("price", money.PRICE).alias("price"), _number("size", money.QTY).alias("qty"), F.lit(1).cast(money.CONTRACT).alias("ct_val"),
    ))


def with_money(trades: DataFrame) -> DataFrame:
    out = trades.withColumn("notional", money.notional(F.col("qty"), F.col("ct_val"), F.col("price")))
    return out.withColumn("pv", money.weighted(F.col("price"), F.col("notional")))


def split_valid(trades: DataFrame, instruments: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): required fields present and not empty, instrument allowed; quarantined rows have a ``reason``."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"missing {c}")) for c in REQUIRED if c in trades.columns]))
    foreign = F.when(~F.col("inst_id").isin(instruments), F.array(F.lit("instrument not allowed"))).otherwise(F.array()) if instruments else F.array()
    marked = trades.withColumn("reason", F.concat_ws(", ", F.concat(missing, foreign.cast("array<string>"))))
    return marked.where("reason = ''").drop("reason"), marked.where("reason <> ''")


def after(trades: DataFrame, ts, trade_id: int) -> DataFrame:
    """Rows behind the cursor (ts, trade_id), ids compared as numbers."""
    return trades.where(F.struct("ts", "trade_id") > F.struct(F.lit(ts).cast("timestamp").alias("ts"), F.lit(trade_id).cast("long").alias("trade_id")))


def since(df: DataFrame, ts: str, as_of, span: str) -> DataFrame:
    """Rows of the last ``span`` (90s, 240m, 24h, 7d) up to ``as_of``, both ends included."""
    end = F.lit(as_of).cast("timestamp")
    return df.where(F.col(ts).between(times.shifted(end, -times.duration(span)), end))


def symbol(inst_id: Column) -> Column:
    return F.replace(inst_id, F.lit("-USDT-SWAP"), F.lit("/USDT"))


def contracts(raw: DataFrame) -> DataFrame:
    """Contract metadata from either layout: the normalised block, else the raw one, else flat fields."""
    pick = lambda c: F.coalesce(*[F.nullif(F.col(p + c), F.lit("")) for p in ("normalized.", "raw.", "")])
    return raw.select(pick("instId").alias("inst_id"), pick("ctVal").try_cast(money.CONTRACT).alias("ct_val"), pick("ctMult").try_cast(money.CONTRACT).alias("ct_mult"), pick("ctType").alias("ct_type"), pick("tickSz").try_cast("decimal(16,8)").alias("tick"), pick("lotSz").try_cast("decimal(16,8)").alias("lot"))


def enrich(trades: DataFrame, meta: DataFrame, exchange: str = "okx", market: str = "perp") -> DataFrame:
    """Trades with their contract's fields and constants; trades of unknown instruments go. ``meta`` has a row per
    instrument and is left to the optimiser to broadcast by its size."""
    known = meta.where("ct_val is not null and ct_type is not null").select("inst_id", "ct_val", "ct_mult", "ct_type")
    return trades.drop("ct_val", "ct_mult", "ct_type").join(known, "inst_id").withColumns({"exchange": F.lit(exchange), "market": F.lit(market), "symbol_canon": symbol(F.col("inst_id"))})


def book_snapshots(raw: DataFrame) -> DataFrame:
    """Book rows with typed levels; a side is its top-200 field, else the plain one, else the top-400 one, empty skipped."""

    def side(name: str) -> Column:
        fields = [F.when(F.size(c) > 0, F.col(c)) for c in (f"{name}_top200", name, f"{name}_top400") if c in raw.columns]
        levels = F.filter(F.coalesce(*fields, F.array().cast(schemas.LEVELS)), lambda x: F.size(x) >= 2)
        typed = F.transform(levels, lambda x: F.struct(x[0].try_cast(money.PRICE).alias("price"), x[1].try_cast(money.QTY).alias("qty")))
        return F.filter(typed, lambda x: x["price"].isNotNull() & x["qty"].isNotNull())

    return raw.select(F.col("instId").alias("inst_id"), F.try_to_timestamp("timestamp_utc").alias("ts"), F.nullif("mid_price", F.lit("")).try_cast(money.PRICE).alias("mid"), side("bids").alias("bids"), side("asks").alias("asks"), *[c for c in ("seqId", "prevSeqId") if c in raw.columns])


def derivative_points(raw: DataFrame, wanted: str) -> DataFrame:
    """One row per point of one symbol's history, with its time from unix seconds; the same time counts once."""
    points = raw.where(F.col("symbol") == wanted).select("symbol", F.explode("history").alias("p")).select("symbol", F.timestamp_seconds("p.t").alias("ts"), "p.*")
    return points.dropDuplicates(["symbol", "ts"])
