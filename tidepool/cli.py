"""Command line: run a registered query over a folder of tables, or a market job over JSON lines.

    python -m tidepool.cli query a1_candles_1h --data DIR [--out PATH]
    python -m tidepool.cli candles --trades PATH --out PATH [--timeframe 1h] [--inst BTC-USDT-SWAP] [--spot]
    python -m tidepool.cli wicks --trades PATH --contracts PATH --out PATH
    python -m tidepool.cli hidden --trades PATH --as-of TS [--age-min 20] [--age-max 40] [--min-touched 10]
    python -m tidepool.cli buckets --book PATH --contracts PATH --out PATH [--as-of TS --since 240m]
    python -m tidepool.cli confluence --trades PATH --book PATH --contracts PATH --as-of TS [--out PATH]
    python -m tidepool.cli dashboard --trades PATH --book PATH --contracts PATH --as-of TS
    python -m tidepool.cli tag --input PATH --out PATH [--max-chars 200000]
    python -m tidepool.cli poll --recorded DIR --symbols BTC,ETH --out PATH --checkpoint PATH [--every 60s] [--to SECONDS] [--once]
    python -m tidepool.cli self-test

Jobs of minute rows append only new keys, so a second run adds nothing; the others replace their table or, without
``--out``, show it. ``--since`` (90s, 240m, 24h, 7d) keeps input of that span before ``--as-of``.
"""

from __future__ import annotations

import argparse
import json
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import times
from .operators import bars, book, confluence, health, keyed, topics, volume, vwap, wicks
from .sources import market, poller, schemas, sinks

MINUTE_JOBS = ("candles", "cvd", "vwap", "volume")
STATE_JOBS = ("wicks", "hidden", "buckets", "confluence", "dashboard")


def recent(df: DataFrame, a: argparse.Namespace) -> DataFrame:
    if a.since and not a.as_of:
        raise SystemExit("--since needs --as-of")
    return market.since(df, "ts", a.as_of, a.since) if a.since else df


def trades_of(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    raw = market.read_lines(spark, a.trades, schemas.TRADES_SPOT if a.spot else schemas.TRADES_PERPS)
    good, _ = market.split_valid((market.canonical_spot if a.spot else market.canonical_perps)(raw), a.inst)
    return recent(keyed.unique_trades(good), a)


def buckets_of(spark: SparkSession, a: argparse.Namespace, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bucket rows and their walls."""
    snapshots = keyed.unique_snapshots(market.book_snapshots(market.read_lines(spark, a.book, schemas.BOOK)), ["seqId"])
    rows = book.buckets(recent(snapshots, a), meta)
    return rows, book.walls(book.by_band(rows))


def states_of(trades: DataFrame, meta: DataFrame | None) -> DataFrame:
    ladder = bars.all_timeframes(bars.candles(trades, "1m"))
    return wicks.lifecycle(wicks.detect(ladder), ladder, meta)


def state_job(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    meta = market.contracts(spark.read.schema(schemas.INSTRUMENTS).option("recursiveFileLookup", "true").option("multiLine", "true").json(a.contracts)) if a.contracts else None
    if a.job == "buckets":
        return buckets_of(spark, a, meta)[0]
    trades = trades_of(spark, a)
    states = states_of(trades, meta)
    if a.job == "wicks":
        return states
    if a.job == "hidden":
        return wicks.hidden(states.where(F.col("timeframe") == a.timeframe), a.as_of, a.age_min, a.age_max, a.min_touched)
    signals, flow, prices = volume.signals(bars.volume_bars(trades)), bars.cvd(trades), vwap.vwap(trades)
    rows, walls = buckets_of(spark, a, meta)
    if a.job == "dashboard":
        return health.five_components(a.as_of, meta, states, signals, walls, flow, prices)
    timed = lambda df: df.withColumnRenamed("window_start", "ts")
    return confluence.score(states, a.as_of, timed(signals), book.with_wall_ages(rows, walls), timed(flow), timed(prices))


def tag_job(spark: SparkSession, source: str, out: str, max_chars: int, vocabulary: dict[str, list[str]] | None = None) -> None:
    """Tagged records in chunks, their manifest, and its lists of chunks and failed files."""
    files = topics.read_corpus(spark, source)
    records = topics.with_ids(topics.messages(files))
    topics.chunked(topics.tag(records, vocabulary), ["source_file", "message_index"], max_chars).write.mode("overwrite").parquet(f"{out}/records")
    kept = spark.read.parquet(f"{out}/records")
    sinks.chunks(kept.withColumn("place", F.col("message_index")), f"{out}/chunks")
    sinks.snapshot(topics.manifest(files, records, kept), f"{out}/manifest", "json")
    sinks.snapshot(topics.chunk_list(kept), f"{out}/output_chunks", "json")
    sinks.snapshot(topics.failed_files(files), f"{out}/failed_files", "json")


def poll_job(spark: SparkSession, a: argparse.Namespace) -> None:
    """Append new points of the polled series, by symbol and series: one poll with ``--once``, else one every so often."""
    spark.dataSource.register(poller.Poller)
    given = {"recorded": a.recorded, "symbols": a.symbols, "lookback": str(a.lookback), "since": a.since, "to": a.to}
    polled = spark.readStream.format("tidepool-poller").options(**{k: v for k, v in given.items() if v}).load()
    out = poller.points(polled).writeStream.format("parquet").partitionBy("symbol", "series").option("path", a.out).option("checkpointLocation", a.checkpoint)
    out.trigger(**({"availableNow": True} if a.once else {"processingTime": f"{times.duration(a.every) // 1_000_000} seconds"})).start().awaitTermination()


def self_test(spark: SparkSession) -> None:
    """The text job over a few messages of its own: records are kept and dropped, chunks hold what the manifest says."""
    texts = ["I want to take the long way over the hills", "I can help you with that!", "My task is to finish the project plan", "Let us go over the task", "Irrelevant noise 123456", "Tell me about the house"]
    with tempfile.TemporaryDirectory() as folder:
        source, out = Path(folder, "in"), f"file://{folder}/out"
        source.mkdir()
        (source / "test.jsonl").write_text("\n".join(json.dumps({"role": "user", "content": t}) for t in texts))
        tag_job(spark, f"file://{source}", out, max_chars=500)
        m = spark.read.json(f"{out}/manifest").first()
        listed = spark.read.json(f"{out}/output_chunks").agg(F.count("*").alias("chunks"), F.sum("record_count").alias("records")).first()
        written_rows = spark.read.json(f"{out}/chunks").count()
    if not (m.kept == 5 and m.dropped == 1 and m.failed == 0 and listed.chunks == m.chunks > 1 and listed.records == written_rows == 5):
        raise SystemExit(f"self-test failed: {m.asDict()}")
    print(f"self-test passed: {m.kept} kept, {m.dropped} dropped, {m.chunks} chunks")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidepool")
    sub = p.add_subparsers(dest="job", required=True)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    q.add_argument("--out")
    for job in (*MINUTE_JOBS, *STATE_JOBS):
        j = sub.add_parser(job)
        j.add_argument("--trades", required=job != "buckets")
        j.add_argument("--out", required=job in MINUTE_JOBS)
        j.add_argument("--inst", action="append")
        j.add_argument("--timeframe", default="1m")
        j.add_argument("--spot", action="store_true")
        j.add_argument("--as-of", required=job in ("hidden", "confluence", "dashboard"))
        j.add_argument("--since")
        if job in MINUTE_JOBS:
            j.add_argument("--anchor")
        else:
            j.add_argument("--contracts", required=job in ("buckets", "confluence", "dashboard"))
            j.add_argument("--book", required=job in ("buckets", "confluence", "dashboard"))
        if job == "hidden":
            for name, value in (("--age-min", 20), ("--age-max", 40), ("--min-touched", 10)):
                j.add_argument(name, type=int, default=value)
    sub.add_parser("self-test")
    w = sub.add_parser("poll")
    for name in ("--recorded", "--symbols", "--out", "--checkpoint"):
        w.add_argument(name, required=True)
    w.add_argument("--lookback", type=int, default=3600)
    w.add_argument("--every", default="60s")
    for name in ("--since", "--to"):
        w.add_argument(name)
    w.add_argument("--once", action="store_true")
    t = sub.add_parser("tag")
    t.add_argument("--input", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--max-chars", type=int, default=200_000)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tidepool").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.job == "poll":
        poll_job(spark, a)
        return
    if a.job == "self-test":
        self_test(spark)
        return
    if a.job == "tag":
        tag_job(spark, a.input, a.out, a.max_chars)
        return
    if a.job in MINUTE_JOBS:
        trades = trades_of(spark, a)
        out = {
            "candles": lambda: bars.candles(trades, a.timeframe),
            "cvd": lambda: bars.cvd(trades, a.timeframe),
            "volume": lambda: bars.volume_bars(trades, a.timeframe),
            "vwap": lambda: vwap.vwap(trades, anchor=a.anchor),
        }[a.job]()
        sinks.append_new(out.withColumn("date", F.to_date("window_start")), a.out, ["inst_id", "window_start"])
        return
    if a.job == "query":
        from .plans.catalog import QUERIES

        df = QUERIES[a.name](spark, a.data)
    else:
        df = state_job(spark, a)
    sinks.snapshot(df, a.out) if a.out else df.show(50, truncate=False)


if __name__ == "__main__":
    main()
