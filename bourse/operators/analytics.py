"""Trade analytics: windowed average prices, profit, top-N ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.functions.columns import DEFAULT_SLIDE, DEFAULT_WINDOW


def _windowed(trades: DataFrame, window: str, slide: str, time_col: str):
    return trades.groupBy("instrument", F.window(time_col, window, slide).alias("window"))


def sma(
    trades: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE, time_col: str = "execution_time"
) -> DataFrame:
    """Average buy unit price per (instrument, sliding window); each trade counts once, unweighted."""
    return _windowed(trades, window, slide, time_col).agg(
        F.avg("per_volume_buy_price").alias("sma_price")
    ).select(
        "instrument",
        "sma_price",
        F.col("window.start").alias("w_start_time"),
        F.col("window.end").alias("w_end_time"),
    )


def profit(
    trades: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE, time_col: str = "execution_time"
) -> DataFrame:
    """closing (avg buy unit price) - opening (avg sell unit price) per (instrument, sliding window)."""
    agg = _windowed(trades, window, slide, time_col).agg(
        F.avg("per_volume_sell_price").alias("opening_sma_price"),
        F.avg("per_volume_buy_price").alias("closing_sma_price"),
    )
    return agg.select(
        "instrument",
        (F.col("closing_sma_price") - F.col("opening_sma_price")).alias("profit"),
        "closing_sma_price",
        "opening_sma_price",
        F.col("window.start").alias("w_start_time"),
        F.col("window.end").alias("w_end_time"),
    )


def top_n(df: DataFrame, n: int, measure: str, window_col: str = "w_start_time") -> DataFrame:
    """Newest window first, then the measure descending (nulls last), instrument as tie-break.

    The limit is over the whole result, not per window: when the newest
    window has fewer than ``n`` rows the rest come from older windows.
    Planned as a single TakeOrderedAndProject (per-partition top-n, then merge).
    """
    return df.orderBy(
        F.col(window_col).desc(), F.col(measure).desc_nulls_last(), F.col("instrument").asc()
    ).limit(n)
