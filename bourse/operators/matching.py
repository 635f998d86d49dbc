"""Order matching inside each (window, instrument) book.

Rule (same results as the reference matcher): every live buy, independently
of the other buys, walks the live sells of its book in arrival order, skips
sells whose total price is above its own total price, and takes
``min(sell volume, volume still wanted)`` from each until it is full.  Sells
are not depleted across buys.  Each trade reports the buy unit price as
``buy price / volume still wanted before the trade`` and the sell unit price
as ``sell price / sell volume``.  Leftovers: a buy with volume still wanted,
and, per trade, the sell's unmatched rest (a sell that never traded is not
a leftover).

How it runs without pairing every buy with every sell of a book
---------------------------------------------------------------
Only the first ``V`` eligible sells (in arrival order) can trade with a buy of
volume ``V``, since each sell brings at least one unit.  Eligibility is a
price prefix: the sells priced at or below the buy.  So:

1. Price ladder.  Distinct sell and buy price levels of each book are ranked
   (one row per price level, not per order): each distinct sell price gets an
   index ``d``, each buy the count ``c`` of sell price levels at or below it.
   Eligible sells of a buy are exactly those with ``d < c``.
2. Dyadic nodes.  Level ``l`` groups sell price indexes into blocks of
   ``2**l``.  The prefix ``[0, c)`` is the union of one block per set bit of
   ``c`` (at most ``log2`` of the number of price levels).
3. Buys fall into volume classes, class ``j`` up to ``2**j``.  Of a block,
   class ``j`` needs the entries whose earlier block mates bring less than
   ``2**j`` units: at most ``2**j`` entries.  They are listed once for each
   class that has buys in the book.  While all volumes are small, a rank cut
   that Spark plans as a partial limit before the shuffle comes first.
4. Each buy joins its blocks by its class and keeps the entries whose earlier
   block mates bring less than its own volume: all of a block is eligible for the buy, so
   a sell behind ``V`` units of its block is never reached.  A running sum
   over these candidates in arrival order follows.  Every sell that can trade
   (and every sell before it) is among the candidates, and any dropped sell
   sits behind kept ones worth at least ``V``, so the running sum is exact.

Work is ``O((sum of buy volumes + sells) * log(price levels))`` rows at most,
instead of ``buys * sells`` per book; a large buy costs what it needs itself.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.functions.codec import reject_reason
from bourse.functions.columns import BUY, SELL, time_literal_or_col
from bourse.operators.depleting import match_depleting
from bourse.plans.skew import ROWS_PER_TASK, ranked_within_groups, salted_join
from bourse.session import drop_unused_files

GROUP = ["w_start", "w_end", "instrument"]
# arrival order inside a book; ``uid`` separates otherwise identical copies
ARRIVAL = ["order_time", "order_id", "price", "volume", "expiry", "initial_order_time", "uid"]
ORDER_BODY = ["order_id", "buy_sell", "price", "volume", "expiry", "order_time", "initial_order_time", "uid"]

WINDOW_GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
# Books up to this many orders get their price ranks from one window over the
# book's orders.  Larger books rank distinct price levels and join them back on
# (book, price), so no step holds a whole book in one task.
BOOK_ROWS_PER_TASK = 50_000
# Books with more orders than this also rank their price ladder by range
# partitioning instead of one window task per book.
LADDER_ROWS_PER_TASK = 1_000_000
# A sell is listed once per level of its book before the first cut, some ten times.  Tasks are dealt by
# this many orders there: by their shuffled bytes AQE would take them for small.
ORDERS_PER_TASK = 50_000
# Candidates (a buy with a sell that it may reach) that one task sorts, by the estimate in ``_reach``.
CANDIDATES_PER_TASK = 1 << 19


class Match(NamedTuple):
    trades: DataFrame
    remaining: DataFrame


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*GROUP, *[F.col(c).alias(prefix + c) for c in ORDER_BODY])


def _as_of_col(as_of) -> Column:
    if isinstance(as_of, str) and as_of == "window_end":
        return F.col("w_end")
    return time_literal_or_col(as_of)


def prepare_book_orders(orders_w: DataFrame, as_of="window_end", stable_ids: bool = True) -> DataFrame:
    """Live orders of each book with a row identity ``uid``.

    ``orders_w`` carries ``w_start``/``w_end`` (see ``book.assign_windows``).
    Rows that ``quarantine`` would reject take no part, whatever the book's size.
    The identity is taken once and the rows are checkpointed to the shared
    checkpoint folder, so every branch of the plan (trades, leftovers) and any
    recomputation after a lost executor see the same ids.
    """
    if "w_start" not in orders_w.columns and "window" in orders_w.columns:
        orders_w = orders_w.select(
            F.col("window.start").alias("w_start"), F.col("window.end").alias("w_end"), "*"
        ).drop("window")
    # the matcher's exactness rests on these rules (no null keys or prices, volumes of 1 or more)
    o = orders_w.where(reject_reason().isNull()).where(F.col("expiry") > _as_of_col(as_of))
    o = o.withColumn("initial_order_time", F.coalesce("initial_order_time", "order_time"))
    o = o.select(*GROUP, *[c for c in ORDER_BODY if c != "uid"]).withColumn("uid", F.monotonically_increasing_id())
    if stable_ids:
        o = o.checkpoint(eager=True)
    return o


def _price_ladder_ranks(buys: DataFrame, sells: DataFrame, distributed: bool, parts: int) -> DataFrame:
    """Per book and price level: sell price index ``d``, buy prefix count ``c``, levels count ``n_sell_levels``.

    One row per distinct price level (pre-aggregated before any shuffle).  For
    ordinary books a window per book ranks the levels; with ``distributed`` the
    levels are range-partitioned so a book with a huge ladder spans many tasks.
    """
    levels = (
        sells.select(*GROUP, F.col("s_price").alias("price"), F.lit(1).alias("is_sell"))
        .unionByName(buys.select(*GROUP, F.col("b_price").alias("price"), F.lit(0).alias("is_sell")))
        .distinct()
    )
    # sells before buys at an equal price: a buy at price p is eligible for sells at p
    order = [F.col("price").asc(), F.col("is_sell").desc()]
    if distributed:
        r = ranked_within_groups(levels, GROUP, order, "is_sell", parts)
        return r.select(
            *GROUP, "price", "is_sell", F.col("run_sum").alias("n_at_or_below"), F.col("group_sum").alias("n_sell_levels")
        )
    up_to = Window.partitionBy(*GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*GROUP)
    return levels.select(
        *GROUP,
        "price",
        "is_sell",
        F.sum("is_sell").over(up_to).alias("n_at_or_below"),
        F.sum("is_sell").over(whole).alias("n_sell_levels"),
    )


def _volume_class(volume: str) -> Column:
    """The smallest j with volume <= 2^j."""
    return F.when(F.col(volume) <= 1, 0).otherwise(F.length(F.bin(F.col(volume) - 1))).cast("int")


def _class_bit(volume: str) -> Column:
    """2^j of the volume class j: the classes of a book are the bits of one number."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), _volume_class(volume))


def _ranks_in_one_pass(o: DataFrame, tasks: int = 0) -> tuple[DataFrame, DataFrame]:
    """Price ladder ranks for books that fit one task: a single window over each book's orders, dealt to ``tasks`` tasks if given.

    Orders sorted by (price, sells first); a sell whose price differs from the
    previous row's starts a new sell price level; the running count of level
    starts is ``d + 1`` on a sell row and ``c`` on a buy row.
    """
    is_sell = (F.col("buy_sell") == SELL).cast("int")
    o = o.repartition(tasks, *GROUP) if tasks else o
    by_price = Window.partitionBy(*GROUP).orderBy(F.col("price"), F.col("_is_sell").desc(), F.col("uid"))
    prev_price = F.lag("price").over(by_price)
    starts = (F.col("_is_sell") == 1) & (prev_price.isNull() | (prev_price != F.col("price")))
    ranked = (
        o.withColumn("_is_sell", is_sell)
        .withColumn("_start", starts.cast("int"))
        .withColumn("_n", F.sum("_start").over(by_price.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("n_sell_levels", F.sum("_start").over(Window.partitionBy(*GROUP)))
        .withColumn("classes", F.bit_or(F.when(F.col("_is_sell") == 0, _class_bit("volume"))).over(Window.partitionBy(*GROUP)))
    )
    sells = ranked.where(F.col("_is_sell") == 1).select(
        *GROUP, *[F.col(c).alias("s_" + c) for c in ORDER_BODY], (F.col("_n") - 1).alias("d"), "n_sell_levels", "classes"
    )
    buys = ranked.where(F.col("_is_sell") == 0).select(
        *GROUP, *[F.col(c).alias("b_" + c) for c in ORDER_BODY], F.col("_n").alias("c"), "n_sell_levels"
    )
    return sells, buys


def _reach() -> Column:
    """About how many candidates a book has, from its buys, sells and their volumes: a buy lists, in each of its blocks,
    as many sells of mean volume as fill it and one more; all pairs at most."""
    full = F.col("buy_volume") * F.col("sells") / F.greatest(F.col("sell_volume"), F.lit(1))
    return F.least((F.col("buys") + full) * F.log2(F.col("sells") + 1), F.col("buys").cast("double") * F.col("sells"))


def _levels(n_sell_levels: Column) -> Column:
    # number of dyadic levels = bit length of the number of sell price levels
    return F.sequence(F.lit(0), F.length(F.bin(n_sell_levels)) - 1)


def match_orders(
    orders_w: DataFrame,
    as_of="window_end",
    exec_time=None,
    stable_ids: bool = True,
    hot_rows: int = ROWS_PER_TASK,
    ladder_rows: int = LADDER_ROWS_PER_TASK,
    book_rows: int = BOOK_ROWS_PER_TASK,
    materialize: bool = False,
    policy: str = "independent",
    reprice: bool = False,
) -> Match:
    """Match the books of ``orders_w`` (ORDER rows with ``w_start``/``w_end``).

    ``as_of``: time an order must still be live at (strictly before expiry) and
    the ``order_time`` stamped on leftovers; ``"window_end"`` (default) uses
    each book's window end, else a datetime, Column or ``"now"``.
    ``exec_time``: execution time of trades; default the later of the two
    order times (deterministic replay), or a datetime / Column / ``"now"``.

    Returns ``Match(trades, remaining)``; both keep ``w_start``/``w_end`` so
    copies of a trade in overlapping sliding windows can be told apart.

    ``stable_ids``: checkpoint the id-stamped orders (default).  It may be
    turned off when ``orders_w`` comes straight from a file scan with no
    shuffle before it: the ids are then recomputed identically in every
    branch of the plan and after a lost executor (the input is then read and
    parsed again by each job instead of written once).
    ``materialize``: checkpoint the matched rows once; use it when both
    outputs are written, so the matching does not run twice.
    ``book_rows``: books up to this size get their price ranks from one
    window over the book's orders.
    ``ladder_rows``: books with more orders than this rank their price ladder
    with range partitioning.  ``hot_rows``: join keys (a price level, a block)
    with more rows than this are salted over several tasks.
    ``policy``: ``"independent"`` (default; every buy sees every sell at full volume) or
    ``"depleting"`` (sold volume is gone, see ``depleting.py``; ids must be stable then).
    ``reprice``: leftovers carry the share of the total price that their volume is, so their
    unit price stays; by default they keep the whole total price.
    """
    o = prepare_book_orders(orders_w, as_of, stable_ids or policy == "depleting")
    return match_prepared(o, as_of, exec_time, hot_rows, ladder_rows, book_rows, materialize, policy, reprice)


def match_prepared(
    o: DataFrame,
    as_of="window_end",
    exec_time=None,
    hot_rows: int = ROWS_PER_TASK,
    ladder_rows: int = LADDER_ROWS_PER_TASK,
    book_rows: int = BOOK_ROWS_PER_TASK,
    materialize: bool = False,
    policy: str = "independent",
    reprice: bool = False,
) -> Match:
    """``match_orders`` on the output of ``prepare_book_orders`` (live orders with ids).

    ``materialize``: checkpoint the matched rows once, so writing both outputs
    does not run the matching twice.
    """
    if policy == "depleting":
        when = None if exec_time is None else time_literal_or_col(exec_time)
        return Match(*match_depleting(o, when, _as_of_col(as_of).cast("timestamp"), reprice=reprice))
    if policy != "independent":
        raise ValueError(f"policy must be 'independent' or 'depleting', not {policy!r}")
    spark = o.sparkSession
    buys = _prefixed(o.where(F.col("buy_sell") == BUY), "b_")
    sells = _prefixed(o.where(F.col("buy_sell") == SELL), "s_")

    # one small job: the largest buy volume and the largest book (picks the ladder strategy), orders and candidates
    buy_volume, sell_volume = (F.when(F.col("buy_sell") == side, F.col("volume").cast("double")) for side in (BUY, SELL))
    stats = (
        o.groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("buy_sell") == BUY, F.col("volume"))).alias("k"),
            F.count(buy_volume).alias("buys"), F.sum(buy_volume).alias("buy_volume"),
            F.count(sell_volume).alias("sells"), F.sum(sell_volume).alias("sell_volume"),
        )
        .agg(F.max("n").alias("n"), F.max("k").alias("k"), F.sum("n").alias("rows"), F.sum(_reach()).alias("reach"))
        .first()
    )
    k = stats.k or 0
    biggest_book = stats.n or 0
    tasks = math.ceil((stats.rows or 0) / ORDERS_PER_TASK)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks)
    # a few tasks are dealt well by AQE, which goes by the cores
    tasks = tasks if tasks > spark.sparkContext.defaultParallelism else 0
    pairing = max(tasks, math.ceil((stats.reach or 0) / CANDIDATES_PER_TASK))
    pairing = pairing if pairing > spark.sparkContext.defaultParallelism else 0
    # rows that are sorted across tasks are written out whole: beyond one task per ladder, orders are numbers there
    numbered = biggest_book > ladder_rows

    def join(big: DataFrame, small: DataFrame, keys: list[str], spread: str, tasks: int = 0, counted: DataFrame | None = None) -> DataFrame:
        # every join key lies inside one book, so no key can be hot unless a book is
        if biggest_book > hot_rows:
            return salted_join(big, small, keys, F.col(spread), rows_per_task=hot_rows, merge=True, counted=counted)
        if tasks:
            big, small = big.repartition(tasks, *keys), small.repartition(tasks, *keys)
        return big.join(small, keys)

    if biggest_book > book_rows:
        ladder = _price_ladder_ranks(buys, sells, biggest_book > ladder_rows, parts)
        sell_levels = ladder.where("is_sell = 1").select(
            *GROUP, F.col("price").alias("s_price"), (F.col("n_at_or_below") - 1).alias("d"), "n_sell_levels"
        )
        buy_levels = ladder.where("is_sell = 0").select(
            *GROUP, F.col("price").alias("b_price"), F.col("n_at_or_below").alias("c"), "n_sell_levels"
        )
        # the volume classes that a book's buys have (see below) come to its sells with their price level
        classes = buys.groupBy(*GROUP).agg(F.bit_or(_class_bit("b_volume")).alias("classes"))
        sell_levels = join(sell_levels, classes, GROUP, "s_price")
        placed = sells
        if numbered:
            # a sell's place in its book stands for its arrival
            arrival = [F.col("s_" + c) for c in ARRIVAL]
            ranked = ranked_within_groups(
                sells.withColumn("_one", F.lit(1)), GROUP, arrival, "_one", parts, ["s_uid", "s_price", "s_volume"]
            )
            placed = ranked.withColumnRenamed("run_sum", "s_place")
        sells_d = join(placed, sell_levels, GROUP + ["s_price"], "s_uid", tasks, sells)
        buys_c = join(buys, buy_levels, GROUP + ["b_price"], "b_uid", tasks)
    else:
        sells_d, buys_c = _ranks_in_one_pass(o, 0 if numbered else tasks)
        if numbered:
            in_book = Window.partitionBy(*GROUP).orderBy(*[F.col("s_" + c) for c in ARRIVAL])
            sells_d = sells_d.withColumn("s_place", F.row_number().over(in_book))

    # a buy of volume V has class j, the smallest with V <= 2^j.  Only block entries with fewer than
    # 2^j units before them can matter to it, so it is joined to those alone; what large buys need
    # is paid for by large buys
    if biggest_book <= book_rows:
        sells_d = sells_d.where(F.col("classes").isNotNull())
    if numbered:
        s_arrival, b_body = [F.col("s_place")], [F.col("b_uid"), F.col("b_volume")]
        sells_d = sells_d.select(*GROUP, "s_uid", "s_volume", "s_place", "d", "n_sell_levels", "classes")
    else:
        s_arrival, b_body = [F.col("s_" + c) for c in ARRIVAL], [F.col("b_" + c) for c in ORDER_BODY]
    if tasks and biggest_book > book_rows:
        # neighbours in price share blocks, so the cut below finds much of a block in one task
        part_of_level = F.expr(f"pmod(s_uid, {math.ceil(biggest_book / ROWS_PER_TASK)})")
        sells_d = sells_d.repartition(tasks, *[F.col(c) for c in GROUP], F.expr("shiftright(d, 8)"), part_of_level)
    sell_nodes = (
        sells_d
        .withColumn("lvl", F.explode(_levels(F.col("n_sell_levels"))))
        .withColumn("node", F.expr("shiftright(d, lvl)"))
        .where(F.col("node") < F.expr("shiftright(n_sell_levels, lvl)"))
        .drop("d", "n_sell_levels")
    )
    block = GROUP + ["lvl", "node"]
    in_block = Window.partitionBy(*block).orderBy(*s_arrival)
    cut = sell_nodes
    if k <= int(spark.conf.get(WINDOW_GROUP_LIMIT_CONF, "1000")):
        # a rank cut that is planned as a partial limit before the shuffle: each sell brings a unit at least
        cut = cut.withColumn("rk", F.row_number().over(in_block)).where(F.col("rk") <= F.lit(k)).drop("rk")
    if numbered:
        # the top block of a huge book is summed across tasks
        ranked = ranked_within_groups(cut, block, s_arrival, "s_volume", parts, ["s_uid", "s_volume", "s_place", "classes"])
        block_sums = ranked.withColumn("block_prev", F.col("run_sum") - F.col("s_volume")).drop("run_sum")
    else:
        block_sums = cut.withColumn(
            "block_prev",
            F.coalesce(F.sum("s_volume").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
    # at most 2^j entries of a block are in class j
    block_top = block_sums.withColumn(
        "cls", F.explode(F.expr("filter(sequence(0, 31), j -> (classes & shiftleft(1L, j)) != 0 AND shiftleft(1L, j) > block_prev)"))
    ).drop("classes")

    buy_nodes = (
        buys_c
        .where(F.col("c") > 0)
        .withColumn("lvl", F.explode(_levels(F.col("n_sell_levels"))))
        .where(F.expr("shiftright(c, lvl) & 1") == 1)
        .withColumn("node", F.expr("shiftright(c, lvl) - 1"))
        .select(*GROUP, "lvl", "node", _volume_class("b_volume").alias("cls"), *b_body)
    )

    def candidates(wanted: DataFrame, blocks: DataFrame) -> DataFrame:
        # a block near the top of a big book is wanted by many buys: salted join
        # only sells whose earlier block mates bring less than the buy's volume can be reached
        return join(wanted, blocks, block + ["cls"], "b_uid", pairing).where(F.col("block_prev") < F.col("b_volume"))

    # where orders are numbers, a buy's says its book too
    buy = ["b_uid"] if numbered else GROUP + ["b_uid"]
    per_buy = Window.partitionBy(*buy).orderBy(*s_arrival)

    def in_one_task(c: DataFrame) -> DataFrame:
        c = c.repartition(pairing, *buy) if pairing else c
        return c.withColumn(
            "prev", F.coalesce(F.sum("s_volume").over(per_buy.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ).withColumn("is_last", F.lead(F.lit(1)).over(per_buy).isNull())

    if biggest_book > hot_rows and k > hot_rows:
        # a buy that may take more than hot_rows sells is summed across tasks; the classes on either side of
        # hot_rows part the blocks' entries too
        large = candidates(buy_nodes.where(F.col("b_volume") > hot_rows), block_top.where(F.col("cls") >= hot_rows.bit_length()))
        spent = [*block, *buy, "cls", "block_prev", *["s_place"] * numbered]
        fields = [c for c in large.columns if c not in spent]
        large = ranked_within_groups(large, buy, s_arrival, "s_volume", parts, [*fields, "group_sum"])
        large = large.withColumn("prev", F.col("run_sum") - F.col("s_volume"))
        large = large.withColumn("is_last", F.col("run_sum") == F.col("group_sum")).drop("run_sum", "group_sum")
        most = max(hot_rows - 1, 0).bit_length()
        small = candidates(buy_nodes.where(F.col("b_volume") <= hot_rows), block_top.where(F.col("cls") <= most))
        cand = in_one_task(small).select(*large.columns).unionByName(large)
    else:
        cand = in_one_task(candidates(buy_nodes, block_top))
    hits = cand.where(F.col("prev") < F.col("b_volume")).withColumn(
        "want", (F.col("b_volume") - F.col("prev")).cast("int")
    ).withColumn("trade_volume", F.least(F.col("s_volume"), F.col("want")))
    if numbered:
        # what trades is settled: the orders' fields come back
        found = hits.select("b_uid", "s_uid", "want", "trade_volume", "is_last").checkpoint(eager=True)
        hits = cand = small = large = ranked = block_top = block_sums = cut = None  # nothing reads their files any more
        drop_unused_files(spark)
        hits = join(found, sells.drop(*GROUP), ["s_uid"], "b_uid", counted=found)
        hits = join(hits, buys, ["b_uid"], "s_uid", counted=found)
    if materialize:
        hits = hits.checkpoint(eager=True)
        if tasks:
            cand = small = large = ranked = block_top = block_sums = cut = None  # what they moved is done with
            drop_unused_files(spark)

    if exec_time is None:
        exec_col = F.greatest(F.col("b_order_time"), F.col("s_order_time"))
    else:
        exec_col = time_literal_or_col(exec_time)
    trades = hits.select(
        *GROUP,
        F.col("b_order_id").alias("buy_order_id"),
        (F.col("b_price") / F.col("want")).alias("per_volume_buy_price"),
        F.col("s_order_id").alias("sell_order_id"),
        (F.col("s_price") / F.col("s_volume")).alias("per_volume_sell_price"),
        F.col("trade_volume").cast("int").alias("trade_volume"),
        exec_col.cast("timestamp").alias("execution_time"),
    )

    stamp = _as_of_col(as_of).cast("timestamp")

    def rest(side: str, p: str, volume: Column) -> Column:
        price = F.col(p + "price") * volume / F.col(p + "volume") if reprice else F.col(p + "price")
        return F.struct(
            F.col(p + "order_id").alias("order_id"),
            volume.cast("int").alias("volume"),
            price.alias("price"),
            F.lit(side).alias("buy_sell"),
            stamp.alias("order_time"),
            F.col(p + "initial_order_time").alias("initial_order_time"),
            F.col(p + "expiry").alias("expiry"),
        )

    # one pass over the matched rows: each row may leave the sell's unmatched
    # rest, and a buy's last candidate shows what the buy still wants
    sell_left = F.when(F.col("s_volume") > F.col("trade_volume"), rest(SELL, "s_", F.col("s_volume") - F.col("trade_volume")))
    buy_left = F.when(
        F.col("is_last") & (F.col("want") > F.col("s_volume")), rest(BUY, "b_", F.col("want") - F.col("s_volume"))
    )
    from_hits = hits.select(*GROUP, F.inline(F.array_compact(F.array(sell_left, buy_left))))
    # a buy with no sell price level at or below its own (c = 0) has no candidate and keeps it all
    unmatched = buys_c.where(F.col("c") == 0).select(*GROUP, F.inline(F.array(rest(BUY, "b_", F.col("b_volume")))))
    return Match(trades, from_hits.unionByName(unmatched))


def reference_view(match: Match) -> Match:
    """The reference's flat output shape: trades and leftovers without the window columns.

    Rows of one order in two overlapping windows become indistinguishable here,
    which is why ``match_orders`` keeps the window by default.
    """
    return Match(match.trades.drop("w_start", "w_end"), match.remaining.drop("w_start", "w_end"))
