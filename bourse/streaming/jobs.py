"""Streaming jobs: order matching, live SMA / profit rankings, closed-window analytics.

Matching needs every order of a book.  By default a book is matched once, when
the watermark passes its window end: until then each order waits in Spark's
state store as its own state row (keyed by window and the order itself), so a
hot book is spread over all state partitions instead of sitting in one row.
When the window closes the aggregation releases the book's orders in append
mode and ``foreachBatch`` runs the batch matcher on them: one code path for
batch and stream, no Python in the data path.  In update mode
(``emit="on_update"``) each micro-batch re-matches the books that changed,
reading their orders from a window-partitioned order table that drops the windows the
watermark has closed.  Rejected rows can leave from the same query.

Rankings run in complete mode (state for every window, as the reference).  Two variants
bound the state by a watermark: one appends final windows to a table, the other upserts every
change of a window into a keyed table as it happens.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bourse import schemas
from bourse.functions.codec import decode_wire_orders, encode, encode_reorders, encode_wire_orders, quarantine
from bourse.functions.columns import (
    DEFAULT_SLIDE,
    DEFAULT_WATERMARK,
    DEFAULT_WINDOW,
    PROFIT_TOP_N,
    SMA_TOP_N,
    TRADE_KEY,
)
from bourse.operators.analytics import profit, sma, top_n
from bourse.operators.matching import match_prepared, prepare_book_orders
from bourse.operators.orders import carry_forward, validate
from bourse.plans.sizing import DEFAULT_BROADCAST_MAX_ROWS
from bourse.session import path_exists, read_small_file, write_small_file
from bourse.streaming.sinks import BOUNDED_STATE, start, write_kafka
from bourse.streaming.snapshots import KeyedTable

# Copies of one order are released as one state row with a count.  Counts up
# to this size are expanded in place; larger ones are split into chunks that
# are spread over the cluster first, so no task expands a huge copy group.
COPY_CHUNK = 4096


def release_closed_books(
    orders: DataFrame,
    window: str = DEFAULT_WINDOW,
    slide: str = DEFAULT_SLIDE,
    watermark: str = DEFAULT_WATERMARK,
) -> DataFrame:
    """Orders of each (window, instrument) book, released once the window has closed.

    Streaming aggregation keyed by (window, all order fields) with a copy
    count; run it in append mode.  Late orders (older than the watermark) are
    dropped by Spark.
    """
    # the watermark rides on a copy of order_time: a stream may group by only
    # one event-time column (the window), order_time itself stays a plain key
    w = orders.withColumn("_event_time", F.col("order_time")).withWatermark("_event_time", watermark)
    keys = [F.window("_event_time", window, slide).alias("window")] + [F.col(c) for c in schemas.ORDER_COLS]
    return w.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


# Windows of one micro-batch that are pruned one by one in update mode.
MAX_WINDOW_KEYS = 1000
# Rows of a file of the order table, so that its files follow the rows, not the state partitions times the windows.
ORDERS_PER_FILE = 1 << 18


def last_emission(spark: SparkSession, out_dir: str, output: str = "trades") -> DataFrame:
    """Update mode: the rows of each book's last emission, for readers of ``{out_dir}/trades`` or ``remaining``.

    ``{out_dir}/emitted`` lists the books of every micro-batch, also those that came out without rows.
    """
    book = ["w_start", "w_end", "instrument"]
    last = spark.read.parquet(f"{out_dir}/emitted").groupBy(*book).agg(F.max("batch_id").alias("batch_id"))
    return spark.read.parquet(f"{out_dir}/{output}").join(last, book + ["batch_id"], "left_semi").drop("batch_id")


def expand_copies(df: DataFrame, count_col: str = "copies", chunk: int = COPY_CHUNK) -> DataFrame:
    """Turn (row, count) back into ``count`` rows without one task expanding a huge count."""
    rest = [c for c in df.columns if c != count_col]
    small = df.where(F.col(count_col) <= chunk).select(*rest, F.explode(F.sequence(F.lit(1), F.col(count_col))).alias("_i"))
    big = (
        df.where(F.col(count_col) > chunk)
        .select(*rest, count_col, F.explode(F.sequence(F.lit(0), F.floor((F.col(count_col) - 1) / chunk))).alias("_part"))
        .repartition(*[F.col(c) for c in rest], F.col("_part"))
        .select(
            *rest,
            F.explode(F.sequence(F.lit(1), F.least(F.lit(chunk), F.col(count_col) - F.col("_part") * chunk))).alias("_i"),
        )
    )
    return small.unionByName(big).drop("_i")


def match_released(released: DataFrame, as_of="window_end", policy: str = "independent"):
    """Batch matcher over a micro-batch of released books, or None if no book closed.

    ``released`` is persisted by the caller, so the stateful part of the
    streaming plan runs once.  The two branches of ``expand_copies`` would not both find the
    persisted rows, so large copy counts go through a checkpoint first.
    """
    if released.where(F.col("copies") > COPY_CHUNK).isEmpty():
        each = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_i")
        single = released.select("window", *schemas.ORDER_COLS, each)
    else:
        single = expand_copies(released.checkpoint())
    orders_w = single.select(
        F.col("window.start").alias("w_start"), F.col("window.end").alias("w_end"), *schemas.ORDER_COLS
    )
    prepared = prepare_book_orders(orders_w, as_of)
    if prepared.isEmpty():
        return None
    # both outputs are written, so the matched rows are materialized once
    return match_prepared(prepared, as_of=as_of, materialize=True, policy=policy)


ORDER_TABLE = T.StructType(
    [T.StructField("w_start", T.TimestampType()), T.StructField("w_end", T.TimestampType()), *schemas.ORDER.fields,
     T.StructField("copies", T.LongType()), T.StructField("w_key", T.LongType())]
)
ORDER_KEY = ["w_key", "w_start", "w_end", *schemas.ORDER_COLS]
# The watermark in force for a batch comes from the batches before the last one.
WATERMARK_LAG = 2


def order_table(spark: SparkSession, out_dir: str, compact_every: int = 10) -> KeyedTable:
    """Update mode's table of the orders seen in windows that are still open, partitioned by window start."""
    return KeyedTable(spark, f"{out_dir}/books", ORDER_TABLE, ORDER_KEY, compact_every, partition_by=["w_key"])


def _latest_times(written: DataFrame, note: dict) -> dict:
    """The commit note: the latest order time (epoch microseconds) up to each of the last batches."""
    seen = note.get("latest", [])
    here = written.agg(F.max(F.unix_micros("order_time"))).first()[0]
    latest = max((t for t in (here, *seen[-1:]) if t is not None), default=None)
    return {"latest": [*seen, latest][-1 - WATERMARK_LAG :]}


def _open_orders(table: KeyedTable, watermark: str) -> Callable[[DataFrame], DataFrame]:
    """What compaction keeps: one row per order, of windows that no further row can reach."""
    latest = table.state()["note"].get("latest", [])

    def keep(rows: DataFrame) -> DataFrame:
        if len(latest) > WATERMARK_LAG and latest[0] is not None:
            closed = F.timestamp_micros(F.lit(latest[0])) - F.expr(f"INTERVAL {watermark}")
            rows = rows.where(F.col("w_end") > closed)
        return rows.groupBy(*ORDER_KEY).agg(F.max("copies").alias("copies"))

    return keep


def _books_touched(batch: DataFrame, table: KeyedTable, batch_id: int) -> tuple[DataFrame | None, DataFrame]:
    """Update mode: every order seen so far of the books that changed in this micro-batch, and those books.

    New or changed orders are committed once as a version of the order table;
    the changed books are read back from the window partitions they
    live in.  A batch that runs again finds its version committed.
    """
    spark = batch.sparkSession
    rows = batch.select(
        F.col("window.start").alias("w_start"),
        F.col("window.end").alias("w_end"),
        *schemas.ORDER_COLS,
        "copies",
        F.unix_seconds(F.col("window.start")).alias("w_key"),
    )
    files = max(1, math.ceil(batch.count() / ORDERS_PER_FILE))
    table.upsert(rows.repartitionByRange(files, "w_key", "instrument", "order_id"), batch_id, _latest_times)
    new = table.read_versions([2 * batch_id])
    touched = new.select("w_start", "w_end", "instrument").distinct()
    keys = [r.w_key for r in new.select("w_key").distinct().limit(MAX_WINDOW_KEYS + 1).collect()]
    if not keys:
        return None, touched
    if table.state()["versions"] == [2 * batch_id]:
        # all that was seen is this batch, which has an order once
        seen = new.select("w_start", "w_end", *schemas.ORDER_COLS, "copies")
    else:
        # partition pruning: exactly the windows this batch touched, or their range if they are very many
        pruned = F.col("w_key").isin(keys)
        if len(keys) > MAX_WINDOW_KEYS:
            pruned = F.col("w_key").between(*new.agg(F.min("w_key"), F.max("w_key")).first())
        seen = (
            table.read()
            .where(pruned)
            .join(touched, ["w_start", "w_end", "instrument"], "left_semi")
            .groupBy("w_start", "w_end", *schemas.ORDER_COLS)
            .agg(F.max("copies").alias("copies"))
        )
    # as in match_released: without large counts the rows are gone over once
    if table.read().where(F.col("copies") > COPY_CHUNK).isEmpty():
        one_by_one = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_i")
        return seen.select(*[c for c in seen.columns if c != "copies"], one_by_one).drop("_i"), touched
    return expand_copies(seen), touched


def run_matcher(
    orders: DataFrame,
    out_dir: str,
    checkpoint: str,
    window: str = DEFAULT_WINDOW,
    slide: str = DEFAULT_SLIDE,
    watermark: str = DEFAULT_WATERMARK,
    as_of="window_end",
    emit: str = "on_close",
    reorder_dir: str | None = None,
    kafka: dict | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    policy: str = "independent",
    rejects: str | None = None,
    compact_every: int = 10,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Match a decoded order stream; write trades and leftovers per micro-batch.

    ``orders``: streaming ORDER rows (new orders, optionally unioned with the
    re-order stream).  Rows that break the quarantine rules take no part; with ``rejects`` they
    leave from this same query, with their reason, to ``{rejects}/batch_id=N``.  Output:
    ``{out_dir}/trades/batch_id=N`` and ``{out_dir}/remaining/batch_id=N``
    (parquet, overwritten if a batch is retried, so the write is idempotent).
    With ``reorder_dir`` the leftovers are also written as order messages
    (JSON lines) for the re-order stream, closing the feedback loop.  With
    ``kafka={"options": {...}, "trades_topic": ..., "reorder_topic": ...}``
    both outputs are also published as key/value JSON messages.

    ``emit="on_close"`` (default): each book is matched once, when the
    watermark passes its window end.  ``emit="on_update"``: every micro-batch
    re-matches, in full, each book that received orders in that batch (still
    open books included), as the reference's update output mode does; the
    orders seen so far are kept in ``order_table(spark, out_dir)``.  Every ``compact_every``
    batches its versions are merged and the windows that the watermark has closed are dropped.

    ``policy``: see ``match_orders``.  ``before_commit(batch_id)`` runs after a batch's outputs are
    written and before Spark commits the batch (tests stop the query there).
    """
    if emit not in ("on_close", "on_update"):
        raise ValueError(f"emit must be 'on_close' or 'on_update', not {emit!r}")
    spark = orders.sparkSession
    good, bad = quarantine(orders)
    released = release_closed_books(good, window, slide, watermark)
    if rejects:
        # a branch without state in the same query: one set of offsets, one commit
        no_window = F.lit(None).cast(released.schema["window"].dataType).alias("window")
        refused = bad.select(no_window, *schemas.ORDER_COLS, F.lit(1).cast("long").alias("copies"), "reject_reason")
        released = released.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(refused)
    if emit == "on_update":
        table = order_table(spark, out_dir, compact_every)
        table.must_belong_to(checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the stateful plan runs once, whatever reads its rows
        try:
            if rejects:
                refused = batch.where(F.col("reject_reason").isNotNull()).select(*schemas.ORDER_COLS, "reject_reason")
                refused.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
                write_books(batch.where(F.col("reject_reason").isNull()).drop("reject_reason"), batch_id)
            else:
                write_books(batch, batch_id)
        finally:
            batch.unpersist()
        if emit == "on_update":
            table.compact(batch_id, _open_orders(table, watermark))
        if before_commit:
            before_commit(batch_id)

    def write_books(batch: DataFrame, batch_id: int) -> None:
        if emit == "on_update":
            books, touched = _books_touched(batch, table, batch_id)
            m = None
            if books is not None:
                m = match_prepared(prepare_book_orders(books, as_of), as_of, materialize=True, policy=policy)
                touched.write.mode("overwrite").parquet(f"{out_dir}/emitted/batch_id={batch_id}")
        else:
            m = match_released(batch, as_of, policy)
        if m is None:  # no book to (re)match in this micro-batch
            return
        m.trades.write.mode("overwrite").parquet(f"{out_dir}/trades/batch_id={batch_id}")
        rem_path = f"{out_dir}/remaining/batch_id={batch_id}"
        m.remaining.write.mode("overwrite").parquet(rem_path)
        if reorder_dir or kafka:
            rem = batch.sparkSession.read.parquet(rem_path)
        if reorder_dir:
            # a retried batch must not show its leftovers again under new file names
            target = f"{reorder_dir}/batch_{batch_id}"
            if not path_exists(batch.sparkSession, f"{target}/_SUCCESS"):
                encode_reorders(carry_forward(rem)).select("value").write.mode("overwrite").text(target)
        if kafka:
            trades = batch.sparkSession.read.parquet(f"{out_dir}/trades/batch_id={batch_id}")
            if kafka.get("trades_topic"):
                write_kafka(encode(trades, TRADE_KEY), kafka["trades_topic"], kafka["options"])
            if kafka.get("reorder_topic"):
                write_kafka(encode_reorders(carry_forward(rem)), kafka["reorder_topic"], kafka["options"])

    return start(
        released,
        "foreach_batch",
        checkpoint=checkpoint,
        output_mode="update" if emit == "on_update" else "append",
        foreach_batch=write_batch,
        trigger=trigger,
        query_name=query_name,
        state=BOUNDED_STATE,
    )


def run_ingest(
    orders: DataFrame,
    instruments: DataFrame,
    path: str,
    checkpoint: str,
    as_of="now",
    kafka: dict | None = None,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    trigger: dict | None = None,
    query_name: str | None = None,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Order entry as a stream: validate incoming orders, send the accepted ones on as keyed order messages.

    ``orders``: a stream of BULK_ORDER rows.  Accepted orders go to ``{path}/orders/batch_id=N`` as ``key``
    and ``value`` (read them with ``sources.message_dir_stream``) and, with
    ``kafka={"options": {...}, "topic": ...}``, to a topic; the others to ``{path}/rejected/batch_id=N``
    with their reason.  A batch is validated as a table, so the hot instruments of its
    own rows are counted and spread.  ``as_of="now"`` is the time its batch starts.
    """
    spark = orders.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/orders/batch_id={batch_id}"
        # readers of the messages may have seen a finished batch: it is not written again under new file names
        if not path_exists(spark, f"{target}/_SUCCESS"):
            when = spark.sql("SELECT current_timestamp()").first()[0] if as_of == "now" else as_of
            batch = batch.persist()
            try:
                accepted, rejected = validate(batch, instruments, when, broadcast_max_rows)
                rejected.write.mode("overwrite").parquet(f"{path}/rejected/batch_id={batch_id}")
                encode_wire_orders(accepted).write.mode("overwrite").parquet(target)
            finally:
                batch.unpersist()
        if kafka:
            write_kafka(spark.read.parquet(target), kafka["topic"], kafka["options"])
        if before_commit:
            before_commit(batch_id)

    return start(orders, "foreach_batch", checkpoint=checkpoint, foreach_batch=write_batch, trigger=trigger, query_name=query_name)


def run_feedback(
    orders: DataFrame,
    out_dir: str,
    checkpoint: str,
    as_of="window_end",
    max_rounds: int = 100,
    **matcher,
) -> int:
    """The feedback loop to its end: leftovers come back as orders of the next round; returns the number of rounds.

    Round 0 matches the stream ``orders``; every further round is a stream over the order messages that the round
    before left behind.  A round runs in update mode until its input is used up, so each book's last
    emission is its result: ``{out_dir}/round=R``.  ``as_of`` is the time orders must still be live at, and
    at which leftovers come back: one value for all rounds, a list with one per round, or a function of the round.
    The loop ends when a round leaves nothing, when a round of leftovers makes no trade, when the list is used up
    or after ``max_rounds``.

    A round that has ended leaves a note; a loop that was stopped goes on where it was when it
    is started again with the same folders.  ``matcher``: further arguments of ``run_matcher``.
    """
    spark = orders.sparkSession
    times = list(as_of) if isinstance(as_of, (list, tuple)) else None
    rounds = min(max_rounds, len(times)) if times is not None else max_rounds
    for r in range(rounds):
        out = f"{out_dir}/round={r}"
        done = f"{out_dir}/_rounds/{r}"
        if not path_exists(spark, done):
            source = orders if r == 0 else decode_wire_orders(spark.readStream.format("text").load(f"{out_dir}/reorders/round={r}"))
            at = times[r] if times is not None else as_of(r) if callable(as_of) else as_of
            q = run_matcher(source, out, f"{checkpoint}/round={r}", as_of=at, emit="on_update", trigger={"availableNow": True}, **matcher)
            q.awaitTermination()
            counts = {"trades": 0, "left": 0}
            if path_exists(spark, f"{out}/emitted"):
                left = last_emission(spark, out, "remaining")
                encode_reorders(carry_forward(left)).select("value").write.mode("overwrite").text(f"{out_dir}/reorders/round={r + 1}")
                counts = {"trades": last_emission(spark, out, "trades").count(), "left": left.count()}
            write_small_file(spark, done, json.dumps(counts))
        counts = json.loads(read_small_file(spark, done))
        if not counts["left"] or (r and not counts["trades"]):
            return r + 1
    return rounds


def feedback_trades(spark: SparkSession, out_dir: str, rounds: int, output: str = "trades") -> DataFrame:
    """The trades (or ``remaining``) of every round of ``run_feedback``, with their ``round``."""
    found = [r for r in range(rounds) if path_exists(spark, f"{out_dir}/round={r}/emitted")]
    parts = [last_emission(spark, f"{out_dir}/round={r}", output).withColumn("round", F.lit(r)) for r in found]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_rejects(
    orders: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, query_name: str | None = None
) -> StreamingQuery:
    """Append the rows that the quarantine rejects, with their ``reject_reason``, to a table (exactly once)."""
    _, bad = quarantine(orders)
    return start(bad, "parquet", checkpoint=checkpoint, output_mode="append", path=path, trigger=trigger, query_name=query_name)


RANKING_KEY = ["instrument", "w_start_time", "w_end_time"]


def ranking_messages(ranking: DataFrame) -> DataFrame:
    """Ranking rows as messages: key ``<instrument>_<window start>_<window end>``, JSON value."""
    return encode(ranking, RANKING_KEY)


def sma_top_stream(
    trades: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE, n: int = SMA_TOP_N
) -> DataFrame:
    """Top-n average buy price rows over a trade stream (complete output mode; state is kept for all windows)."""
    return top_n(sma(trades, window, slide), n, "sma_price")


def profit_top_stream(
    trades: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE, n: int = PROFIT_TOP_N
) -> DataFrame:
    """Top-n profit rows over a trade stream (complete output mode)."""
    return top_n(profit(trades, window, slide), n, "profit")


def run_ranking(
    ranking: DataFrame,
    fmt: str,
    checkpoint: str,
    path: str | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    **options,
) -> StreamingQuery:
    """Start a ranking stream in complete mode (console / memory / kafka / a parquet snapshot at ``path``).

    For ``kafka`` (pass ``topic`` and the ``kafka.*`` options) rows become key/value messages.
    """
    if fmt == "kafka" and "value" not in ranking.columns:
        ranking = ranking_messages(ranking)
    return start(
        ranking, fmt, checkpoint=checkpoint, output_mode="complete", path=path, trigger=trigger,
        query_name=query_name, **options,
    )


def closed_window_averages(
    trades: DataFrame,
    measure: str = "sma",
    window: str = DEFAULT_WINDOW,
    slide: str = DEFAULT_SLIDE,
    watermark: str = DEFAULT_WATERMARK,
) -> DataFrame:
    """SMA or profit rows of windows the watermark has closed (append mode; bounded state).

    The bounded counterpart of the complete-mode rankings: each window is
    emitted once, when final, and its state is dropped.  Write it to a table
    and rank with ``top_n(spark.read.parquet(path), n, ...)``.
    """
    t = trades.withWatermark("execution_time", watermark)
    return sma(t, window, slide) if measure == "sma" else profit(t, window, slide)


def run_closed_windows(agg: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append closed-window rows to a parquet table at ``path`` (exactly once via the file sink log)."""
    return start(agg, "parquet", checkpoint=checkpoint, output_mode="append", path=path, trigger=trigger)


def window_table(spark: SparkSession, path: str, measure: str = "sma", compact_every: int = 10) -> KeyedTable:
    """The keyed table that ``run_window_upserts`` writes; ``current()`` has the latest row of every (instrument, window)."""
    return KeyedTable(spark, path, schemas.SMA if measure == "sma" else schemas.PROFIT, RANKING_KEY, compact_every)


def run_window_upserts(
    trades: DataFrame,
    path: str,
    checkpoint: str,
    measure: str = "sma",
    window: str = DEFAULT_WINDOW,
    slide: str = DEFAULT_SLIDE,
    watermark: str = DEFAULT_WATERMARK,
    compact_every: int = 10,
    trigger: dict | None = None,
    query_name: str | None = None,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Live SMA or profit rows of every window in update mode, upserted into a keyed table.

    Each micro-batch sends only the windows that it changed; the watermark drops their state once they are closed,
    while the table keeps their last row.  Rank with ``top_n(window_table(...).current(), n, ...)``: a reader
    sees open windows too, and always the table as one whole batch left it.
    """
    table = window_table(trades.sparkSession, path, measure, compact_every)
    table.must_belong_to(checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id)
        table.compact(batch_id)
        if before_commit:
            before_commit(batch_id)

    return start(
        closed_window_averages(trades, measure, window, slide, watermark),
        "foreach_batch",
        checkpoint=checkpoint,
        output_mode="update",
        foreach_batch=write_batch,
        trigger=trigger,
        query_name=query_name,
    )
