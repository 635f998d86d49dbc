"""Order matching with shared sell volume (``policy="depleting"``).

Same books, eligibility and arrival order as ``matching.py``, but a unit that a
sell has sold is gone: buys are served in arrival order, each walks the live sells in
arrival order, skips sells above its own total price and takes from what is left of
each.  A trade reports ``buy price / volume still wanted`` and ``sell price / volume
the sell still had``.  Leftovers are every buy and every sell with volume left.

Here a buy depends on all buys before it, so the work goes in rounds over
tables.  A round takes the next ``buys_per_round`` buys of every book and the open
sells they can reach, serves them in turn, and lowers the sells' volumes for the next
round; books up to that size need one round.  What a task holds is bounded by the
round, not by the book:

* Together the buys of a round take at most ``W``, the sum of their volumes.  A buy of price
  ``p`` therefore never goes past the sell where the open volume at or below ``p``
  reaches ``W``.
* The prices of the round's buys are cut into at most ``BANDS`` bands.  For each band one running
  sum over the open sells, at or below the band's lowest price, gives the last arrival
  that the band can reach; a sell is sent only if a band that may buy it reaches it.

Serving in turn needs the first open sell at or below a price, again and again.  Arrow hands each
round's rows of a book to a small helper with a tree of minimum prices over the sells in
arrival order: a trade costs two walks of that tree.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.functions.columns import BUY, SELL
from bourse.plans.skew import ranked_within_groups
from bourse.session import scratch_path

GROUP = ["w_start", "w_end", "instrument"]
ARRIVAL = ["order_time", "order_id", "price", "volume", "expiry", "initial_order_time", "uid"]
BUYS_PER_ROUND = 20_000
BANDS = 32
# Books with more orders than this get their arrival ranks across tasks.
RANKS_PER_TASK = 1_000_000
FILL = "b_uid long, s_uid long, want long, had long, trade_volume long"


def serve_in_turn(buys: list[tuple[float, int]], sells: list[tuple[float, int]]) -> list[tuple[int, int, int, int]]:
    """``(buy, sell, volume wanted before, volume the sell had before)`` of each trade.

    ``buys`` and ``sells`` are (total price, volume) in arrival order; results refer to their positions.
    """
    size = 1
    while size < len(sells):
        size *= 2
    gone = float("inf")
    least = [gone] * (2 * size)
    left = []
    for i, (price, volume) in enumerate(sells):
        least[size + i] = price
        left.append(volume)
    for node in range(size - 1, 0, -1):
        least[node] = min(least[2 * node], least[2 * node + 1])
    out = []
    for b, (price, want) in enumerate(buys):
        while want > 0 and least[1] <= price:
            node = 1
            while node < size:  # the first sell at or below the price
                node *= 2
                if least[node] > price:
                    node += 1
            s = node - size
            out.append((b, s, want, left[s]))
            taken = min(want, left[s])
            want -= taken
            left[s] -= taken
            if not left[s]:
                least[node] = gone
                while node > 1:
                    node //= 2
                    least[node] = min(least[2 * node], least[2 * node + 1])
    return out


def _serve(table: pa.Table) -> pa.Table:
    """One book's rows of a round: its buys and the sells that they can reach."""
    table = table.sort_by("place")
    is_buy = table.column("is_buy").to_numpy()
    sides = []
    for mask in (is_buy, ~is_buy):
        side = table.filter(pa.array(mask))
        orders = list(zip(side.column("price").to_pylist(), side.column("volume").to_pylist(), strict=True))
        sides.append((side.column("uid").to_pylist(), orders))
    (buy_ids, buys), (sell_ids, sells) = sides
    trades = serve_in_turn(buys, sells)
    rows = [(buy_ids[b], sell_ids[s], want, had, min(want, had)) for b, s, want, had in trades]
    names = ["b_uid", "s_uid", "want", "had", "trade_volume"]
    return pa.table([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 5)], names=names)


def _places(side: DataFrame, biggest: int) -> DataFrame:
    """``place``: arrival rank within the book, from 0."""
    order = [F.col(c) for c in ARRIVAL]
    if biggest <= RANKS_PER_TASK:
        return side.withColumn("place", F.row_number().over(Window.partitionBy(*GROUP).orderBy(*order)).cast("long") - 1)
    parts = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = ranked_within_groups(side.withColumn("_one", F.lit(1)), GROUP, order, "_one", parts)
    return ranked.withColumn("place", F.col("run_sum") - 1).drop("_one", "run_sum", "group_sum")


def _reachable(buys: DataFrame, sells: DataFrame, bands: int, sells_per_task: int) -> DataFrame:
    """The open sells that the buys of a round can reach (module docstring).

    Books with at most ``sells_per_task`` eligible open sells send them all.
    """
    # one small row per book: what its round wants, and up to ``bands`` of its buys' prices, lowest first
    cuts = F.array_sort(F.array_distinct(F.percentile_approx("price", F.array(*[F.lit(i / bands) for i in range(bands)]), F.lit(10 * bands))))
    books = buys.groupBy(*GROUP).agg(F.sum("volume").alias("wanted"), F.max("price").alias("top"), F.min("price").alias("low"), cuts.alias("cuts"))
    books = books.withColumn("cuts", F.array_sort(F.array_distinct(F.concat(F.array("low"), "cuts"))))
    eligible = sells.join(books, GROUP).where(F.col("price") <= F.col("top"))
    sizes = eligible.groupBy(*GROUP).agg((F.count(F.lit(1)) > sells_per_task).alias("is_large"))
    eligible = eligible.join(sizes, GROUP)
    plain = ["uid", "price", "volume", "place", *GROUP]
    small = eligible.where(~F.col("is_large")).select(*plain)
    large = eligible.where("is_large")
    if large.isEmpty():
        return small
    # the open volume at or below each band's lowest price, up to and without this sell
    upto = Window.partitionBy(*GROUP).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sums = F.array(*[
        F.coalesce(F.sum(F.when(F.col("price") <= F.try_element_at("cuts", F.lit(i + 1)), F.col("volume"))).over(upto), F.lit(0))
        for i in range(bands + 1)
    ])
    # band i holds the buys from cuts[i] up to (not including) cuts[i + 1]; it may buy sells below its upper end
    may_buy = F.transform(
        "cuts", lambda c, i: F.coalesce(F.col("price") < F.try_element_at("cuts", i + 2), F.lit(True)) & (F.try_element_at("sums", i + 1) < F.col("wanted"))
    )
    return small.unionByName(large.withColumn("sums", sums).where(F.exists(may_buy, lambda x: x)).select(*plain))


def match_depleting(
    o: DataFrame,
    exec_time: Column | datetime | None,
    stamp: Column,
    buys_per_round: int = BUYS_PER_ROUND,
    sells_per_task: int = 5 * BUYS_PER_ROUND,
    bands: int = BANDS,
    reprice: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(trades, remaining)`` of the output of ``matching.prepare_book_orders``.

    Every round's fills are written to a table in the shared folder, so a
    lost executor costs at most the round it was in.
    """
    spark = o.sparkSession
    o = o.withColumn("volume", F.col("volume").cast("long"))
    buys, sells = o.where(F.col("buy_sell") == BUY), o.where(F.col("buy_sell") == SELL)
    biggest = o.groupBy(*GROUP).count().agg(F.max("count")).first()[0] or 0
    narrow = [*GROUP, "uid", "price", "volume", "place"]
    queue = _places(buys, biggest).select(*narrow).withColumn("round", F.floor(F.col("place") / buys_per_round)).checkpoint()
    open_sells = _places(sells, biggest).select(*narrow).checkpoint()
    rounds = (queue.agg(F.max("round")).first()[0] or 0) + 1
    path = scratch_path(spark, "fills")
    for r in range(rounds):
        now = queue.where(F.col("round") == r).drop("round")
        if rounds > 1:
            now = now.checkpoint()
        reach = _reachable(now, open_sells, bands, sells_per_task)
        both = now.withColumn("is_buy", F.lit(True)).unionByName(reach.withColumn("is_buy", F.lit(False)))
        filled = both.groupBy(*GROUP).applyInArrow(_serve, FILL)
        filled.write.parquet(f"{path}/round={r}")
        if r + 1 < rounds:
            sold = spark.read.schema(FILL).parquet(f"{path}/round={r}").groupBy(F.col("s_uid").alias("uid")).agg(F.sum("trade_volume").alias("sold"))
            open_sells = (
                open_sells.join(sold, "uid", "left")
                .withColumn("volume", F.col("volume") - F.coalesce("sold", F.lit(0)))
                .where("volume > 0")
                .select(*narrow)
                .checkpoint()
            )
    return _outputs(buys, sells, spark.read.schema(FILL).parquet(*[f"{path}/round={r}" for r in range(rounds)]), exec_time, stamp, reprice)


def _outputs(buys: DataFrame, sells: DataFrame, fills: DataFrame, exec_time, stamp: Column, reprice: bool) -> tuple[DataFrame, DataFrame]:
    def side(df: DataFrame, p: str) -> DataFrame:
        keep = [F.col(c).alias(p + c) for c in ("uid", "order_id", "price", "order_time")]
        return df.select(*(GROUP if p == "b_" else []), *keep)

    hits = fills.join(side(buys, "b_"), "b_uid").join(side(sells, "s_"), "s_uid")
    when = F.greatest("b_order_time", "s_order_time") if exec_time is None else exec_time
    trades = hits.select(
        *GROUP,
        F.col("b_order_id").alias("buy_order_id"),
        (F.col("b_price") / F.col("want")).alias("per_volume_buy_price"),
        F.col("s_order_id").alias("sell_order_id"),
        (F.col("s_price") / F.col("had")).alias("per_volume_sell_price"),
        F.col("trade_volume").cast("int").alias("trade_volume"),
        when.cast("timestamp").alias("execution_time"),
    )
    done = fills.select(F.explode(F.array("b_uid", "s_uid")).alias("uid"), "trade_volume").groupBy("uid").agg(F.sum("trade_volume").alias("done"))
    left = F.col("volume") - F.coalesce("done", F.lit(0))
    rest = buys.unionByName(sells).join(done, "uid", "left").withColumn("left", left).where("left > 0")
    price = F.col("price") * F.col("left") / F.col("volume") if reprice else F.col("price")
    remaining = rest.select(
        *GROUP,
        "order_id",
        F.col("left").cast("int").alias("volume"),
        price.alias("price"),
        "buy_sell",
        stamp.alias("order_time"),
        "initial_order_time",
        "expiry",
    )
    return trades, remaining
