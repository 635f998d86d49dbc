"""Event-time windows and order-book views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.functions.columns import DEFAULT_SLIDE, DEFAULT_WINDOW
from bourse.plans.skew import ranked_within_groups

BOOK_ENTRY = ["order_time", "order_id", "price", "volume", "buy_sell", "expiry", "initial_order_time"]


def assign_windows(
    orders: DataFrame, time_col: str = "order_time", window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE
) -> DataFrame:
    """Attach the sliding event-time window(s) of each row as ``w_start`` / ``w_end``.

    With slide < window a row lands in ``window / slide`` windows (an Expand,
    no shuffle).  Rows with a null time get no window and drop out.
    """
    w = F.window(time_col, window, slide)
    return orders.withColumn("_w", w).select(
        F.col("_w.start").alias("w_start"), F.col("_w.end").alias("w_end"), *orders.columns
    )


def flatten_window(df: DataFrame, col: str = "window") -> DataFrame:
    """``window`` struct -> ``w_start``, ``w_end`` columns."""
    rest = [c for c in df.columns if c != col]
    return df.select(F.col(f"{col}.start").alias("w_start"), F.col(f"{col}.end").alias("w_end"), *rest)


BOOK = ["w_start", "w_end", "instrument"]
DEFAULT_PAGE_SIZE = 10_000


def order_book(orders_w: DataFrame, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """The book of each (window, instrument) as arrays of order structs, in pages.

    Entries are in arrival order (order_time, order_id, ...).  Page ``p`` of a
    book holds entries ``p * page_size`` to ``(p + 1) * page_size - 1``, so no
    row (and no task) ever holds more than ``page_size`` entries.  When every
    book fits one page this is a plain grouped collect; otherwise arrival
    ranks are computed across tasks by range partitioning.  The matcher does
    not use this view; ``price_ladder`` is the aggregate view of a book.
    """
    entry = F.struct(*[F.col(c) for c in BOOK_ENTRY])
    biggest = orders_w.groupBy(*BOOK).count().agg(F.max("count")).first()[0] or 0
    if biggest <= page_size:
        paged = orders_w.withColumn("page", F.lit(0).cast("long"))
    else:
        parts = int(orders_w.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranked = ranked_within_groups(
            orders_w.withColumn("_one", F.lit(1)).withColumn("_uid", F.monotonically_increasing_id()),
            BOOK,
            [F.col(c) for c in BOOK_ENTRY] + [F.col("_uid")],
            "_one",
            parts,
        )
        paged = ranked.withColumn("page", F.floor((F.col("run_sum") - 1) / page_size).cast("long"))
    return paged.groupBy(*BOOK, "page").agg(
        F.sort_array(F.collect_list(entry)).alias("book"),
        F.count(F.lit(1)).alias("n_orders"),
    )


def price_ladder(orders_w: DataFrame) -> DataFrame:
    """Aggregated book: total volume and order count per (window, instrument, side, price level)."""
    return orders_w.groupBy("w_start", "w_end", "instrument", "buy_sell", "price").agg(
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("n_orders"),
    )
