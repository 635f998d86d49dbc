"""Command line: the exchange's jobs for spark-submit (``python -m bourse <job> ...``).

  match          batch: orders (parquet/json/csv with the ORDER columns) -> trades + leftovers
  validate       batch: bulk-order CSV + instrument CSV -> accepted order messages + rejects
  stream-ingest  stream: bulk-order CSV folder + instrument CSV -> keyed order messages + rejects per batch
  stream-match   stream: order messages (JSON files or Kafka) -> trades + leftovers + rejects per batch, and metrics
  stream-sma     stream: trade messages -> top-N average buy price (complete mode)
  stream-profit  stream: trade messages -> top-N profit (complete mode)
  stream-windows stream: trade messages -> SMA and profit of every window, upserted in update mode (two queries)

Streaming jobs are supervised: the first query that fails stops the others and ends the job with its cause.
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from bourse import schemas
from bourse.functions.codec import decode, decode_wire_orders, quarantine
from bourse.functions.columns import DEFAULT_SLIDE, DEFAULT_WATERMARK, DEFAULT_WINDOW, PROFIT_TOP_N, SMA_TOP_N
from bourse.operators.book import assign_windows
from bourse.operators.matching import match_orders
from bourse.operators.orders import validate
from bourse.session import prepare
from bourse.sources.files import bulk_order_stream, json_dir_stream, read_bulk_orders, read_instruments
from bourse.sources.kafka import kafka_options, kafka_stream
from bourse.streaming.jobs import (
    profit_top_stream,
    run_ingest,
    run_matcher,
    run_ranking,
    run_window_upserts,
    sma_top_stream,
)
from bourse.streaming.sinks import publish_orders
from bourse.streaming.supervise import log_progress, supervise


def _read_orders(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schemas.ORDER).parquet(path)
    if fmt == "json":
        return decode_wire_orders(spark.read.text(path))
    return spark.read.schema(schemas.ORDER).option("header", True).csv(path)


def _kafka(args) -> dict[str, str]:
    return kafka_options(args.bootstrap, args.security_protocol, args.sasl_mechanism, args.username, args.password)


def _message_stream(spark: SparkSession, args) -> DataFrame:
    """Raw ``value`` messages from Kafka topic(s) or a landing folder of JSON lines."""
    if args.topic:
        frames = [kafka_stream(spark, t, _kafka(args), args.starting_offsets) for t in args.topic]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out.selectExpr("CAST(value AS STRING) AS value")
    return spark.readStream.format("text").load(args.input)


def _window_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--window", default=DEFAULT_WINDOW)
    p.add_argument("--slide", default=DEFAULT_SLIDE)


def _stream_args(p: argparse.ArgumentParser, source: bool = True) -> None:
    if source:
        p.add_argument("--input", help="landing folder of JSON-lines messages")
        p.add_argument("--topic", action="append", help="Kafka topic (repeat to union several)")
    p.add_argument("--bootstrap")
    p.add_argument("--security-protocol")
    p.add_argument("--sasl-mechanism")
    p.add_argument("--username")
    p.add_argument("--password")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--trigger", choices=["continuous-batches", "available-now"], default="continuous-batches")
    p.add_argument("--interval", help="start a micro-batch every such time, e.g. '5 seconds'")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="bourse")
    sub = ap.add_subparsers(dest="job", required=True)

    m = sub.add_parser("match")
    m.add_argument("--orders", required=True)
    m.add_argument("--format", choices=["parquet", "json", "csv"], default="parquet")
    m.add_argument("--out", required=True)
    _window_args(m)

    v = sub.add_parser("validate")
    v.add_argument("--orders", required=True, help="bulk-order CSV")
    v.add_argument("--instruments", required=True, help="instrument CSV")
    v.add_argument("--as-of", help="ISO time; default now")
    v.add_argument("--out", required=True)

    si = sub.add_parser("stream-ingest")
    _stream_args(si, source=False)
    si.add_argument("--orders", required=True, help="landing folder of bulk-order CSV files")
    si.add_argument("--instruments", required=True, help="instrument CSV")
    si.add_argument("--as-of", help="ISO time; default the time each batch starts")
    si.add_argument("--out", required=True)
    si.add_argument("--orders-topic", help="also publish the accepted orders to this Kafka topic")

    sm = sub.add_parser("stream-match")
    _stream_args(sm)
    _window_args(sm)
    sm.add_argument("--watermark", default=DEFAULT_WATERMARK)
    sm.add_argument("--emit", choices=["on_close", "on_update"], default="on_close")
    sm.add_argument("--as-of", default="window_end", help="'window_end' or 'now'")
    sm.add_argument("--policy", choices=["independent", "depleting"], default="independent")
    sm.add_argument("--out", required=True)
    sm.add_argument("--reorder-dir")
    sm.add_argument("--trades-topic", help="also publish trades to this Kafka topic")
    sm.add_argument("--reorder-topic", help="also publish leftovers as order messages to this Kafka topic")

    for name, n in (("stream-sma", SMA_TOP_N), ("stream-profit", PROFIT_TOP_N)):
        r = sub.add_parser(name)
        _stream_args(r)
        _window_args(r)
        r.add_argument("--top", type=int, default=n)
        r.add_argument("--sink", choices=["console", "snapshot", "memory", "kafka"], default="console")
        r.add_argument("--out-topic", help="topic of the kafka sink")
        r.add_argument("--out", help="snapshot folder")

    w = sub.add_parser("stream-windows")
    _stream_args(w)
    _window_args(w)
    w.add_argument("--watermark", default=DEFAULT_WATERMARK)
    w.add_argument("--out", required=True)
    return ap


def run(argv: list[str] | None = None, spark: SparkSession | None = None):
    """Run a batch job, or start a streaming job and return its query (a list if it has several)."""
    ap = parser()
    args = ap.parse_args(argv)
    if args.job == "stream-ingest":
        if args.orders_topic and not args.bootstrap:
            ap.error("publishing to a topic needs --bootstrap")
    elif args.job.startswith("stream"):
        if not (args.input or args.topic):
            ap.error("give --input (landing folder) or --topic")
        if args.topic and not args.bootstrap:
            ap.error("--topic needs --bootstrap")
        if getattr(args, "sink", None) == "snapshot" and not args.out:
            ap.error("--sink snapshot needs --out")
        if getattr(args, "sink", None) == "kafka" and not (args.out_topic and args.bootstrap):
            ap.error("--sink kafka needs --out-topic and --bootstrap")
        if (getattr(args, "trades_topic", None) or getattr(args, "reorder_topic", None)) and not args.bootstrap:
            ap.error("publishing to a topic needs --bootstrap")
    spark = prepare(spark or SparkSession.builder.appName(f"bourse-{args.job}").getOrCreate())
    trigger = {"availableNow": True} if getattr(args, "trigger", None) == "available-now" else None
    if trigger is None and getattr(args, "interval", None):
        trigger = {"processingTime": args.interval}

    if args.job == "match":
        good, bad = quarantine(_read_orders(spark, args.orders, args.format))
        m = match_orders(assign_windows(good, "order_time", args.window, args.slide), materialize=True)
        m.trades.write.mode("overwrite").parquet(f"{args.out}/trades")
        m.remaining.write.mode("overwrite").parquet(f"{args.out}/remaining")
        bad.write.mode("overwrite").parquet(f"{args.out}/rejected")
        return None
    if args.job == "validate":
        as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        acc, rej = validate(read_bulk_orders(spark, args.orders), read_instruments(spark, args.instruments), as_of)
        publish_orders(acc, path=f"{args.out}/orders")
        rej.write.mode("overwrite").parquet(f"{args.out}/rejected")
        return None
    if args.job == "stream-ingest":
        kafka = {"options": _kafka(args), "topic": args.orders_topic} if args.orders_topic else None
        as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else "now"
        orders, listed = bulk_order_stream(spark, args.orders), read_instruments(spark, args.instruments)
        return run_ingest(orders, listed, args.out, args.checkpoint, as_of, kafka=kafka, trigger=trigger)
    if args.job == "stream-match":
        orders = decode_wire_orders(_message_stream(spark, args))
        if args.reorder_dir:
            orders = orders.unionByName(json_dir_stream(spark, f"{args.reorder_dir}/*"))
        kafka = None
        if args.trades_topic or args.reorder_topic:
            kafka = {"options": _kafka(args), "trades_topic": args.trades_topic, "reorder_topic": args.reorder_topic}
        name = f"stream_match_{uuid.uuid4().hex[:8]}"
        log_progress(spark, f"{args.out}/metrics", name)
        return run_matcher(
            orders, args.out, args.checkpoint, args.window, args.slide, args.watermark,
            as_of=args.as_of, emit=args.emit, reorder_dir=args.reorder_dir, kafka=kafka, trigger=trigger,
            query_name=name, policy=args.policy, rejects=f"{args.out}/rejected",
        )
    trades = decode(_message_stream(spark, args), schemas.TRADE)
    if args.job == "stream-windows":
        return [
            run_window_upserts(
                trades, f"{args.out}/{measure}", f"{args.checkpoint}/{measure}", measure, args.window, args.slide, args.watermark, trigger=trigger
            )
            for measure in ("sma", "profit")
        ]
    ranking = (sma_top_stream if args.job == "stream-sma" else profit_top_stream)(trades, args.window, args.slide, args.top)
    options = {**_kafka(args), "topic": args.out_topic} if args.sink == "kafka" else {}
    return run_ranking(ranking, args.sink, args.checkpoint, path=args.out, trigger=trigger,
                       query_name=args.job.replace("-", "_"), **options)


def main() -> None:
    started = run()
    if started is not None:
        supervise(SparkSession.active(), started if isinstance(started, list) else [started])
