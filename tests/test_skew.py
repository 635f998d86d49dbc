"""Sums across tasks and salted joins: exact, and moving no row more often than they must."""

from collections import Counter

from pyspark.sql import functions as F

from bourse.operators import assign_windows, match_orders, matching
from bourse.plans.skew import ranked_within_groups, salted_join
from tests.helpers import frame, order

ROWS = [(g, i, (i * 7) % 5) for g, n in (("a", 60), (None, 40), ("b", 1), ("c", 0)) for i in range(n)]


def test_sums_across_tasks_are_exact_and_no_reader_moves_the_rows_again(spark):
    df = spark.createDataFrame(ROWS, "g string, i int, v int").repartition(3)
    want, totals, run = [], Counter(), Counter()
    for g, _, v in ROWS:
        totals[g] += v
    for g, i, v in ROWS:
        run[g] += v
        want.append((g, i, v, run[g], totals[g]))
    got = ranked_within_groups(df, ["g"], [F.col("i")], "v", 5)
    key = lambda r: (r[0] or "", r[1])
    assert sorted((tuple(r) for r in got.select("g", "i", "v", "run_sum", "group_sum").collect()), key=key) == sorted(want, key=key)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    few = ranked_within_groups(df, ["g"], [F.col("i")], "v", 5, ["i"])
    assert few.columns == ["g", "i", "run_sum"]
    assert sorted((tuple(r) for r in few.collect()), key=key) == sorted(((g, i, s) for g, i, _, s, _ in want), key=key)


def test_hot_keys_may_be_counted_on_a_cheaper_frame(spark):
    big = spark.createDataFrame([(1 if i < 90 else i, i) for i in range(100)], "k int, i int")
    small = spark.createDataFrame([(k, -k) for k in (1, 95, 99, 500)], "k int, x int")
    want = sorted((k, i, -k) for k, i in [(1, i) for i in range(90)] + [(95, 95), (99, 99)])
    for counted in (None, big.select("k")):
        got = salted_join(big, small, ["k"], F.col("i"), rows_per_task=4, counted=counted)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_each_side_of_hot_rows_moves_its_own_block_entries_only(spark, monkeypatch):
    """The buys summed across tasks and the others each join the entries of their own volume classes."""
    seen = []
    whole = matching.salted_join

    def watched(big, small, keys, *how, **named):
        if "cls" in keys:
            seen.append(({r.cls for r in big.select("cls").collect()}, {r.cls for r in small.select("cls").collect()}))
        return whole(big, small, keys, *how, **named)

    monkeypatch.setattr(matching, "salted_join", watched)
    orders = [order(f"s{i}", "Sell", 10 + i % 3, 1 + i % 2, i) for i in range(60)]
    orders += [order(f"b{i}", "Buy", 11 + i % 3, 1 + i, 100 + i) for i in range(20)]
    books = assign_windows(frame(spark, orders), "order_time", "1 hour", "1 hour")
    want = sorted(tuple(r) for r in match_orders(books).trades.collect())
    assert sorted(tuple(r) for r in match_orders(books, book_rows=0, ladder_rows=0, hot_rows=4).trades.collect()) == want
    large, small = seen
    assert min(large[0] | large[1]) == 3 and max(small[0] | small[1]) == 2
