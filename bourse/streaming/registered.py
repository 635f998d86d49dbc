"""Registered streaming queries: the driver tables replayed as file streams.

Rows are landed in time order as parquet slices under the shared checkpoint
folder, read back with ``readStream`` (``availableNow``), run through the
streaming jobs, and the sink output is returned as a DataFrame.  Their oracle
is the batch SQL of the same computation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse import schemas
from bourse.plans import oracle
from bourse.plans.catalog import M2_AS_OF, dec6, m1_orders, m3_trades, ntz
from bourse.functions.codec import encode_wire_orders
from bourse.operators.orders import validate
from bourse.session import folder_names, prepare, scratch_path
from bourse.sources.files import bulk_order_stream, json_dir_stream, message_dir_stream
from bourse.sources.tables import (
    M1_SLIDE,
    M1_WINDOW,
    M3_SLIDE,
    M3_WINDOW,
    instruments_from_parts,
    orders_from_lineitem,
    read_table,
)
from bourse.functions.columns import SMA_TOP_N
from bourse.operators.analytics import top_n
from bourse.streaming.jobs import (
    closed_window_averages,
    feedback_trades,
    last_emission,
    profit_top_stream,
    ranking_messages,
    run_closed_windows,
    run_feedback,
    run_ingest,
    run_matcher,
    run_ranking,
    run_rejects,
    run_window_upserts,
    sma_top_stream,
    window_table,
)
from bourse.streaming.snapshots import read_snapshot
from bourse.streaming.supervise import log_progress, read_metrics

SLICES = 4


def land_in_time_order(spark: SparkSession, df: DataFrame, time_col: str, name: str, slices: int = SLICES) -> str:
    """Write ``df`` as ``slices`` consecutive time ranges, oldest first, so file arrival follows event time.

    A slice has as many files as ``df`` has partitions, see ``_stream``.
    """
    base = scratch_path(spark, name)
    files = df.rdd.getNumPartitions()
    lo, hi = df.agg(F.min(time_col), F.max(time_col)).first()
    step = (hi - lo) / slices
    for i in range(slices):
        start, end = lo + step * i, lo + step * (i + 1)
        cond = (F.col(time_col) >= F.lit(start)) & (
            (F.col(time_col) < F.lit(end)) if i < slices - 1 else F.col(time_col) <= F.lit(hi)
        )
        _land(df.where(cond), f"{base}/in/s{i:03d}", files)
    return base


def _files(spark: SparkSession, folder: str) -> int:
    return sum(n.startswith("part-") for n in folder_names(spark, folder))


def _land(rows: DataFrame, folder: str, files: int, wire: bool = False) -> None:
    """Write ``rows`` as exactly ``files`` files, empty ones at the end if need be; ``wire``: orders as JSON messages."""
    spark = rows.sparkSession

    def write(part: DataFrame) -> None:
        if wire:
            encode_wire_orders(part).select("value").write.mode("append").option("compression", "gzip").text(folder)
        else:
            part.write.mode("append").parquet(folder)

    write(rows.repartition(files) if files > 1 else rows.coalesce(1))
    for _ in range(files - _files(spark, folder)):
        write(spark.createDataFrame([], rows.schema).coalesce(1))


def _end_of_stream(spark: SparkSession, base: str, orders: DataFrame, name: str = "zz-end", days: int = 200) -> None:
    """One marker order far past the last event: it moves the watermark so every real window closes.

    It sits alone in its own book (a sell with no buyer), so it never shows in any output.
    """
    last = orders.agg(F.max("order_time").alias("t"))
    marker = last.select(
        F.lit("end-of-stream").alias("order_id"),
        F.lit("end-of-stream").alias("instrument"),
        F.lit("Sell").alias("buy_sell"),
        F.lit(1.0).alias("price"),
        F.lit(1).alias("volume"),
        (F.col("t") + F.expr("INTERVAL 400 DAYS")).alias("expiry"),
        (F.col("t") + F.expr(f"INTERVAL {days} DAYS")).alias("order_time"),
        (F.col("t") + F.expr(f"INTERVAL {days} DAYS")).alias("initial_order_time"),
    )
    _land(marker, f"{base}/in/{name}", _files(spark, f"{base}/in/s000"))


def _stream(spark: SparkSession, base: str, schema, files_per_batch: int = 16) -> DataFrame:
    """The landed slices as a stream: about ``files_per_batch`` files in a micro-batch, but whole slices.

    However large the table, the number of micro-batches is that of the slices at most, and no slice's rows come
    after its own last time has moved the watermark.
    """
    slice_files = max(1, _files(spark, f"{base}/in/s000"))
    batch = slice_files * max(1, files_per_batch // slice_files)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", batch).parquet(f"{base}/in/*")


def _matcher_run(spark: SparkSession, sf_dir: str, emit: str = "on_close", files_per_batch: int = 16, **how) -> str:
    orders = m1_orders(spark, sf_dir)
    base = land_in_time_order(spark, orders, "order_time", "s-orders")
    _end_of_stream(spark, base, orders)
    _run_match(spark, base, emit, files_per_batch, **how).awaitTermination()
    return base


def _run_match(spark: SparkSession, base: str, emit: str, files_per_batch: int, **how):
    return run_matcher(
        _stream(spark, base, schemas.ORDER, files_per_batch),
        out_dir=f"{base}/out",
        checkpoint=f"{base}/checkpoint",
        window=M1_WINDOW,
        slide=M1_SLIDE,
        emit=emit,
        trigger={"availableNow": True},
        **how,
    )


def s_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late data: after every window has closed, the oldest slice arrives again under new ids.

    One marker batch sits between the watermark jump and the late rows (Spark
    applies a moved watermark from the batch after next), so every late row is
    dropped and the trades equal the batch result.  ``late_rows`` is the number dropped, as
    the metrics table has it: once for each of an order's two windows.
    """
    orders = m1_orders(spark, sf_dir)
    base = land_in_time_order(spark, orders, "order_time", "s-late")
    _end_of_stream(spark, base, orders)
    _end_of_stream(spark, base, orders, name="zz-end-2", days=201)
    first = spark.read.parquet(f"{base}/in/s000")
    late = first.withColumn("order_id", F.concat(F.lit("late-"), "order_id"))
    _land(late, f"{base}/in/zzz-late", _files(spark, f"{base}/in/s000"))
    name = f"late-{base.rsplit('-', 1)[-1]}"
    log = log_progress(spark, f"{base}/metrics", name)
    q = run_matcher(
        _stream(spark, base, schemas.ORDER, files_per_batch=1),
        out_dir=f"{base}/out",
        checkpoint=f"{base}/checkpoint",
        window=M1_WINDOW,
        slide=M1_SLIDE,
        trigger={"availableNow": True},
        query_name=name,
    )
    q.awaitTermination()
    log.close()
    dropped = read_metrics(spark, f"{base}/metrics").agg(F.sum("late_rows").alias("late_rows")).first().late_rows
    t = spark.read.parquet(f"{base}/out/trades").drop("batch_id").withColumn("late_rows", F.lit(dropped))
    return ntz(t, "w_start", "w_end", "execution_time")


def s_match_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode: books are re-matched whenever they change; the last emission of each book is final."""
    base = _matcher_run(spark, sf_dir, emit="on_update", files_per_batch=2, compact_every=2)
    return ntz(last_emission(spark, f"{base}/out"), "w_start", "w_end", "execution_time")


def s_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of an order stream that the quarantine rejects."""
    base = land_in_time_order(spark, m1_orders(spark, sf_dir), "order_time", "s-rejects")
    q = run_rejects(_stream(spark, base, schemas.ORDER), f"{base}/rejected", f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.schema("order_id string, instrument string, buy_sell string, volume int, reject_reason string")
    return out.parquet(f"{base}/rejected")


def s_wire_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages as JSON lines, read as a file stream, decoded and matched; times have whole seconds on that wire."""
    orders = m1_orders(spark, sf_dir)
    base = land_in_time_order(spark, orders, "order_time", "s-wire")
    _end_of_stream(spark, base, orders)
    files = _files(spark, f"{base}/in/s000")
    for part in [f"s{i:03d}" for i in range(SLICES)] + ["zz-end"]:
        _land(spark.read.parquet(f"{base}/in/{part}"), f"{base}/wire/{part}", files, wire=True)
    q = run_matcher(
        json_dir_stream(spark, f"{base}/wire/*", max_files_per_trigger=files),  # a slice in a micro-batch
        out_dir=f"{base}/out",
        checkpoint=f"{base}/checkpoint",
        window=M1_WINDOW,
        slide=M1_SLIDE,
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    t = spark.read.parquet(f"{base}/out/trades").drop("batch_id")
    return ntz(t, "w_start", "w_end", "execution_time")


def _ranking_messages(spark: SparkSession, sf_dir: str, build, schema: str) -> DataFrame:
    out = _ranking_run(spark, sf_dir, lambda t: ranking_messages(build(t, M3_WINDOW, M3_SLIDE)))
    rows = out.select("key", F.from_json("value", schema).alias("r")).select("key", "r.*")
    measures = [c for c in rows.columns if c.endswith(("price", "profit"))]
    return dec6(ntz(rows, "w_start_time", "w_end_time"), *measures)


def s_sma_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SMA ranking as key/value messages, read back."""
    return _ranking_messages(
        spark, sf_dir, sma_top_stream, "instrument string, sma_price double, w_start_time timestamp, w_end_time timestamp"
    )


def s_profit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profit ranking as key/value messages, read back."""
    return _ranking_messages(
        spark, sf_dir, profit_top_stream,
        "instrument string, profit double, closing_sma_price double, opening_sma_price double, "
        "w_start_time timestamp, w_end_time timestamp",
    )


def s_match_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _matcher_run(spark, sf_dir)
    t = spark.read.parquet(f"{base}/out/trades").drop("batch_id")
    return ntz(t, "w_start", "w_end", "execution_time")


def s_remaining_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _matcher_run(spark, sf_dir)
    r = spark.read.parquet(f"{base}/out/remaining").drop("batch_id")
    return ntz(r, "w_start", "w_end", "order_time", "initial_order_time", "expiry")


def _ranking_run(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    trades = m3_trades(spark, sf_dir)
    base = land_in_time_order(spark, trades, "execution_time", "s-trades")
    ranking = build(_stream(spark, base, schemas.TRADE))
    q = run_ranking(ranking, "snapshot", checkpoint=f"{base}/checkpoint", path=f"{base}/out",
                    trigger={"availableNow": True})
    q.awaitTermination()
    return read_snapshot(spark, f"{base}/out")


def s_sma_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window's SMA, upserted in update mode as it changes."""
    trades = m3_trades(spark, sf_dir)
    base = land_in_time_order(spark, trades, "execution_time", "s-upsert")
    q = run_window_upserts(
        _stream(spark, base, schemas.TRADE, files_per_batch=2), f"{base}/table", f"{base}/checkpoint", "sma", M3_WINDOW, M3_SLIDE,
        # slices hold a quarter of the time range each: nothing in this replay is late
        watermark="3650 days", compact_every=2, trigger={"availableNow": True},
    )
    q.awaitTermination()
    return dec6(ntz(window_table(spark, f"{base}/table").current(), "w_start_time", "w_end_time"), "sma_price")


def s_profit_upsert_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best profit, ranked from the keyed table of an update-mode stream."""
    trades = m3_trades(spark, sf_dir)
    base = land_in_time_order(spark, trades, "execution_time", "s-upsert")
    q = run_window_upserts(
        _stream(spark, base, schemas.TRADE, files_per_batch=2), f"{base}/table", f"{base}/checkpoint", "profit", M3_WINDOW, M3_SLIDE,
        watermark="3650 days", compact_every=2, trigger={"availableNow": True},
    )
    q.awaitTermination()
    top = top_n(window_table(spark, f"{base}/table", "profit").current(), 10, "profit")
    return dec6(ntz(top, "w_start_time", "w_end_time"), "profit", "closing_sma_price", "opening_sma_price")


def _bulk_csv(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame, str]:
    """M2's orders landed as bulk-order CSV files and read as a stream, its instruments, and the folder."""
    base = scratch_path(prepare(spark), name)
    orders = orders_from_lineitem(read_table(spark, sf_dir, "lineitem")).select(*[f.name for f in schemas.BULK_ORDER.fields])
    orders.write.option("header", True).csv(f"{base}/in")
    return bulk_order_stream(spark, f"{base}/in"), instruments_from_parts(read_table(spark, sf_dir, "part")), base


def s_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation of a stream against a table beyond the broadcast bound (forced to one row): reasons and accepted rows."""
    orders, listed, base = _bulk_csv(spark, sf_dir, "s-validate")
    for name, part in zip(("accepted", "rejected"), validate(orders, listed, M2_AS_OF, broadcast_max_rows=1), strict=True):
        reason = part if name == "rejected" else part.withColumn("reject_reason", F.lit(None).cast("string"))
        rows = reason.select("order_id", "instrument", "buy_sell", "price", "volume", "reject_reason")
        sink = rows.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint-{name}")
        sink.trigger(availableNow=True).start(f"{base}/{name}").awaitTermination()
    schema = "order_id string, instrument string, buy_sell string, price double, volume int, reject_reason string"
    return spark.read.schema(schema).parquet(f"{base}/accepted", f"{base}/rejected")


def s_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order entry end to end: CSV stream, validation (bound forced to one row), keyed messages, read back as a stream."""
    orders, listed, base = _bulk_csv(spark, sf_dir, "s-ingest")
    run_ingest(
        orders, listed, f"{base}/out", f"{base}/checkpoint", as_of=M2_AS_OF, broadcast_max_rows=1, trigger={"availableNow": True}
    ).awaitTermination()
    messages = message_dir_stream(spark, f"{base}/out/orders")
    sink = messages.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint-read")
    sink.trigger(availableNow=True).start(f"{base}/read").awaitTermination()
    back = spark.read.schema("key string, value string").parquet(f"{base}/read")
    rows = back.select("key", F.from_json("value", schemas.ORDER).alias("o")).select("key", "o.*")
    return ntz(rows, "expiry", "order_time", "initial_order_time")


def s_match_one_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades and rejects of one query: how many rows of each, per instrument."""
    base = scratch_path(prepare(spark), "s-one")
    run = _matcher_run(spark, sf_dir, rejects=f"{base}/rejected")
    trades = spark.read.parquet(f"{run}/out/trades").groupBy("instrument").agg(F.count(F.lit(1)).alias("trades"))
    rejected = spark.read.parquet(f"{base}/rejected").groupBy("instrument", "reject_reason").agg(F.count(F.lit(1)).alias("rejected"))
    return rejected.join(trades, "instrument", "full").select("instrument", "reject_reason", "rejected", "trades")


def s_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leftovers fed back until nothing is left: the trades of every round."""
    base = land_in_time_order(spark, m1_orders(spark, sf_dir), "order_time", "s-feedback")
    rounds = run_feedback(
        _stream(spark, base, schemas.ORDER), f"{base}/out", f"{base}/checkpoint", window=M1_WINDOW, slide=M1_SLIDE, watermark="3650 days"
    )
    return ntz(feedback_trades(spark, f"{base}/out", rounds), "w_start", "w_end", "execution_time")


class _Fault(Exception):
    pass


def _fail_once():
    """Raises the first time it is called: the batch's outputs are there, its commit is not."""
    calls = []

    def fault(batch_id: int) -> None:
        calls.append(batch_id)
        if len(calls) == 1:
            raise _Fault(f"stopped before the commit of batch {batch_id}")

    return fault


def _recovered(spark: SparkSession, sf_dir: str, emit: str, files_per_batch: int) -> str:
    orders = m1_orders(spark, sf_dir)
    base = land_in_time_order(spark, orders, "order_time", "s-recovered")
    _end_of_stream(spark, base, orders)
    first = _run_match(spark, base, emit, files_per_batch, before_commit=_fail_once())
    try:
        first.awaitTermination()
    except Exception:  # noqa: BLE001  checked below
        pass
    if first.exception() is None:
        raise RuntimeError("the first run was to fail before its first commit")
    _run_match(spark, base, emit, files_per_batch).awaitTermination()
    return base


def s_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matcher that fails between a batch's outputs and its commit, started again."""
    base = _recovered(spark, sf_dir, "on_close", 16)
    return ntz(spark.read.parquet(f"{base}/out/trades").drop("batch_id"), "w_start", "w_end", "execution_time")


def s_recovered_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in update mode: the order table holds each order once."""
    base = _recovered(spark, sf_dir, "on_update", 2)
    return ntz(last_emission(spark, f"{base}/out"), "w_start", "w_end", "execution_time")


def s_sma_closed_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded-state SMA: closed windows appended to a table, top 4 read from the table."""
    trades = m3_trades(spark, sf_dir)
    base = land_in_time_order(spark, trades, "execution_time", "s-closed")
    last = trades.agg(F.max("execution_time").alias("t")).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.TRADE.fields if f.name != "execution_time"],
        (F.col("t") + F.expr("INTERVAL 400 DAYS")).alias("execution_time"),
    ).select(*schemas.TRADE_COLS)
    _land(last, f"{base}/in/zz-end", _files(spark, f"{base}/in/s000"))  # end-of-stream marker: closes every real window
    agg = closed_window_averages(_stream(spark, base, schemas.TRADE), "sma", M3_WINDOW, M3_SLIDE, "1 day")
    q = run_closed_windows(agg, f"{base}/out", f"{base}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    table = spark.read.parquet(f"{base}/out")
    return dec6(ntz(top_n(table, SMA_TOP_N, "sma_price"), "w_start_time", "w_end_time"), "sma_price")


def s_sma_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _ranking_run(spark, sf_dir, lambda t: sma_top_stream(t, M3_WINDOW, M3_SLIDE))
    return dec6(ntz(out, "w_start_time", "w_end_time"), "sma_price")


def s_profit_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _ranking_run(spark, sf_dir, lambda t: profit_top_stream(t, M3_WINDOW, M3_SLIDE))
    return dec6(ntz(out, "w_start_time", "w_end_time"), "profit", "closing_sma_price", "opening_sma_price")


STREAM_QUERIES = {
    "s_match_append": s_match_append,
    "s_remaining_append": s_remaining_append,
    "s_match_update": s_match_update,
    "s_late_drop": s_late_drop,
    "s_rejects": s_rejects,
    "s_wire_match": s_wire_match,
    "s_sma_messages": s_sma_messages,
    "s_profit_messages": s_profit_messages,
    "s_sma_complete": s_sma_complete,
    "s_sma_closed_top": s_sma_closed_top,
    "s_profit_complete": s_profit_complete,
    "s_sma_upsert": s_sma_upsert,
    "s_profit_upsert_top": s_profit_upsert_top,
    "s_validate": s_validate,
    "s_ingest": s_ingest,
    "s_match_one_read": s_match_one_read,
    "s_feedback": s_feedback,
    "s_recovered": s_recovered,
    "s_recovered_update": s_recovered_update,
}


def _stream_oracle() -> dict[str, str]:
    q = oracle.oracle_queries()
    m3 = oracle._with(oracle.M3_TRADES)
    key = "instrument || '_' || CAST(w_start_time AS VARCHAR) || '_' || CAST(w_end_time AS VARCHAR) AS key"
    # the wire of new orders has whole seconds
    seconds = "date_trunc('second', ts)"
    wire = oracle.M1_ORDERS.replace("ts + to_hours", f"{seconds} + to_hours").replace(
        "ts AS order_time", f"{seconds} AS order_time").replace("ts AS initial_order_time", f"{seconds} AS initial_order_time")
    m1 = oracle._with(*oracle.MATCH_CTES)
    profit = oracle._profit_sql("t3", "15 DAY", "30 DAY")
    # the oldest of the four slices, by whose good orders the late rows are counted
    late = """SELECT *, (SELECT CAST(2 * count(*) AS BIGINT) FROM good, (SELECT min(order_time) AS lo, max(order_time) AS hi FROM m1)
  WHERE order_time < lo + (hi - lo) / 4) AS late_rows FROM trades"""
    return {
        "s_sma_upsert": m3 + oracle._sma_sql("t3", "15 DAY", "30 DAY"),
        "s_profit_upsert_top": m3 + f"""{profit} ORDER BY w_start_time DESC,
AVG(per_volume_buy_price) - AVG(per_volume_sell_price) DESC NULLS LAST, instrument LIMIT 10""",
        "s_validate": oracle._with(oracle.M2_ORDERS) + "SELECT order_id, instrument, buy_sell, price, volume, reject_reason FROM v2",
        "s_ingest": oracle._with(oracle.M2_ORDERS) + """
SELECT order_id, instrument, buy_sell, price, volume, expiry, TIMESTAMP '1995-06-17 00:00:00' AS order_time,
  TIMESTAMP '1995-06-17 00:00:00' AS initial_order_time, order_id || '_803347200' AS key
FROM v2 WHERE reject_reason IS NULL""",
        "s_match_one_read": m1 + """
SELECT coalesce(x.instrument, t.instrument) AS instrument, reject_reason, rejected, trades
FROM (SELECT instrument, CASE WHEN volume IS NULL THEN 'missing_volume' ELSE 'non_positive_volume' END AS reject_reason, count(*) AS rejected
  FROM m1 WHERE volume IS NULL OR volume <= 0 GROUP BY ALL) x
FULL JOIN (SELECT instrument, count(*) AS trades FROM trades GROUP BY ALL) t ON x.instrument = t.instrument""",
        "s_feedback": oracle.feedback_rounds(4),
        "s_recovered": q["q_match_trades"],
        "s_recovered_update": q["q_match_trades"],
        "s_rejects": q["q_quarantine"],
        "s_wire_match": oracle._with(wire, oracle.M1_GOOD, oracle.M1_WINDOWED, oracle.M1_MATCH) + "SELECT * FROM trades",
        "s_sma_messages": m3 + f"""SELECT {key}, * FROM ({oracle._sma_sql('t3', '15 DAY', '30 DAY')})
ORDER BY w_start_time DESC, sma_price DESC NULLS LAST, instrument LIMIT 4""",
        "s_profit_messages": m3 + f"""SELECT {key}, * FROM ({oracle._profit_sql('t3', '15 DAY', '30 DAY')})
ORDER BY w_start_time DESC, profit DESC NULLS LAST, instrument LIMIT 1""",
        "s_match_append": q["q_match_trades"],
        "s_remaining_append": q["q_remaining"],
        "s_match_update": q["q_match_trades"],
        "s_late_drop": m1 + late,
        "s_sma_complete": m3 + f"""SELECT * FROM ({oracle._sma_sql('t3', '15 DAY', '30 DAY')})
ORDER BY w_start_time DESC, sma_price DESC NULLS LAST, instrument LIMIT 4""",
        "s_sma_closed_top": m3 + f"""SELECT * FROM ({oracle._sma_sql('t3', '15 DAY', '30 DAY')})
ORDER BY w_start_time DESC, sma_price DESC NULLS LAST, instrument LIMIT 4""",
        "s_profit_complete": m3 + f"""SELECT * FROM ({oracle._profit_sql('t3', '15 DAY', '30 DAY')})
ORDER BY w_start_time DESC, profit DESC NULLS LAST, instrument LIMIT 1""",
    }


STREAM_ORACLE = _stream_oracle()

