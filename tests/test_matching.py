import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from bourse.operators import assign_windows, match_orders, matching
from tests.helpers import T0, arrival_key, brute_match, frame, order


def _run(spark, orders, window="1 hour", slide="1 hour", **kw):
    m = match_orders(assign_windows(frame(spark, orders), window=window, slide=slide), **kw)
    trades = [
        (r.buy_order_id, r.per_volume_buy_price, r.sell_order_id, r.per_volume_sell_price, r.trade_volume)
        for r in m.trades.collect()
    ]
    rest = [(r.order_id, r.volume, r.price, r.buy_sell) for r in m.remaining.collect()]
    return trades, rest, m


def test_g1_golden(spark):
    orders = [
        order("b1", "Buy", 10, 5, 0),
        order("s1", "Sell", 8, 3, 1),
        order("s2", "Sell", 9, 3, 2),
        order("b2", "Buy", 9, 4, 3),
        order("s3", "Sell", 20, 2, 4),
        order("b3", "Buy", 5, 7, 5),
    ]
    trades, rest, m = _run(spark, orders)
    assert sorted(trades) == sorted(
        [
            ("b1", 2.0, "s1", 8 / 3, 3),
            ("b1", 5.0, "s2", 3.0, 2),
            ("b2", 2.25, "s1", 8 / 3, 3),
            ("b2", 9.0, "s2", 3.0, 1),
        ]
    )
    assert sorted(rest) == sorted([("b3", 7, 5.0, "Buy"), ("s2", 1, 9.0, "Sell"), ("s2", 2, 9.0, "Sell")])
    # leftovers re-enter at the window end, keep the first arrival time
    r = m.remaining.where("order_id = 'b3'").first()
    assert r.order_time == dt.datetime(2024, 1, 1, 23, 0) and r.initial_order_time == T0 + dt.timedelta(seconds=5)


def test_g2_expiry_and_side(spark):
    as_of_end = dt.datetime(2024, 1, 1, 23, 0)
    orders = [
        order("b1", "Buy", 10, 5, 0),
        order("s1", "Sell", 8, 3, 1, expiry=T0),
        order("s2", "Sell", 9, 2, 2),
        order("b2", "Buy", 9, 4, 3, expiry=T0),
        order("x", "buy", 99, 1, 4),
        order("s9", "Sell", 1, 1, 5, expiry=as_of_end),  # expiry == as_of: not live
    ]
    trades, rest, _ = _run(spark, orders)
    assert trades == [("b1", 2.0, "s2", 4.5, 2)]
    assert rest == [("b1", 3, 10.0, "Buy")]


def test_exec_time_and_literal_as_of(spark):
    orders = [order("b1", "Buy", 10, 5, 0), order("s1", "Sell", 8, 3, 30)]
    as_of = T0 + dt.timedelta(minutes=10)
    m = match_orders(assign_windows(frame(spark, orders), window="1 hour", slide="1 hour"), as_of=as_of)
    t = m.trades.first()
    assert t.execution_time == T0 + dt.timedelta(seconds=30)
    assert m.remaining.first().order_time == as_of


def _random_books(seed, n_books, max_orders, price_levels=None, max_vol=40, copies=0.0):
    rnd = random.Random(seed)
    out = []
    t = 0
    for b in range(n_books):
        inst = f"I{b % 3}"
        n = rnd.randint(1, max_orders)
        for i in range(n):
            t += rnd.randint(0, 2)
            side = "Buy" if rnd.random() < 0.5 else "Sell"
            if price_levels:
                price = float(rnd.randint(1, price_levels))
            else:
                price = round(rnd.uniform(1, 100), 2)
            o = order(f"{inst}-{b}-{i}", side, price, rnd.randint(1, max_vol), t, inst, expiry_h=rnd.choice([5, 5, 5, 0]))
            out.append(o)
            if rnd.random() < copies:
                out.append(o)
    return out


def _expected(orders, window_s=3600):
    books = {}
    for o in orders:
        start = T0.replace(minute=0, second=0) + dt.timedelta(
            seconds=((o.order_time - T0.replace(minute=0, second=0)).total_seconds() // window_s) * window_s
        )
        books.setdefault((start, o.instrument), []).append(o)
    trades, rest = [], []
    for (start, _), book in books.items():
        as_of = start + dt.timedelta(seconds=window_s)
        t, r = brute_match(sorted(book, key=arrival_key), as_of)
        trades += t
        rest += r
    return trades, rest


def _close(a, b):
    def key(rows):
        return Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)

    return key(a) == key(b)


def test_matches_rule_on_random_books(spark):
    for seed, kw in [
        (1, dict(n_books=40, max_orders=30)),
        (2, dict(n_books=8, max_orders=300, price_levels=7)),  # many ties in price
        (3, dict(n_books=4, max_orders=500, max_vol=5)),  # deep trees, small buys
        (4, dict(n_books=10, max_orders=60, copies=0.3)),  # identical copies
    ]:
        orders = _random_books(seed, **kw)
        want_t, want_r = _expected(orders)
        got_t, got_r, _ = _run(spark, orders)
        assert _close(got_t, want_t), f"trades differ for seed {seed}"
        assert _close(got_r, want_r), f"leftovers differ for seed {seed}"


def test_invariants(spark):
    orders = _random_books(7, n_books=6, max_orders=200)
    _, _, m = _run(spark, orders)
    t = m.trades
    assert t.where("trade_volume < 1").count() == 0
    # no buy overfilled: filled <= volume
    vol = {o.order_id: o.volume for o in orders if o.buy_sell == "Buy"}
    filled = {r.buy_order_id: r.f for r in t.groupBy("buy_order_id").agg(F.sum("trade_volume").alias("f")).collect()}
    for oid, f in filled.items():
        assert f <= vol[oid]
    # filled + leftover = volume, for every live buy
    left = {r.order_id: r.volume for r in m.remaining.where("buy_sell = 'Buy'").collect()}
    live = {o.order_id for o in orders if o.buy_sell == "Buy" and o.expiry > T0 + dt.timedelta(hours=1)}
    for oid in live:
        assert filled.get(oid, 0) + left.get(oid, 0) == vol[oid]


def test_plan_has_no_pair_join(spark):
    import contextlib
    import io

    orders = _random_books(5, n_books=3, max_orders=20)
    m = match_orders(assign_windows(frame(spark, orders), window="1 hour", slide="1 hour"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        m.trades.explain()
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan


def test_skew_paths_give_the_same_result(spark):
    """Force the spread paths: finer-keyed shuffles, range-partitioned ladder, salted joins."""
    for seed, kw, paths in [
        (21, dict(n_books=3, max_orders=300, price_levels=5), dict(book_rows=0, ladder_rows=0, hot_rows=3)),
        (22, dict(n_books=5, max_orders=120, copies=0.2), dict(book_rows=0, ladder_rows=0, hot_rows=3)),
        (23, dict(n_books=6, max_orders=150), dict(book_rows=0)),
    ]:
        orders = _random_books(seed, **kw)
        want_t, want_r = _expected(orders)
        got_t, got_r, _ = _run(spark, orders, **paths)
        assert _close(got_t, want_t), f"trades differ for seed {seed}"
        assert _close(got_r, want_r), f"leftovers differ for seed {seed}"


def test_as_of_now_expires_history(spark):
    orders = [order("b1", "Buy", 10, 5, 0), order("s1", "Sell", 8, 3, 1)]
    m = match_orders(assign_windows(frame(spark, orders), window="1 hour", slide="1 hour"), as_of="now")
    assert m.trades.count() == 0 and m.remaining.count() == 0


def test_materialized_match_equals_lazy(spark):
    orders = _random_books(31, n_books=5, max_orders=60)
    lazy_t, lazy_r, _ = _run(spark, orders)
    mat_t, mat_r, _ = _run(spark, orders, materialize=True)
    assert _close(lazy_t, mat_t) and _close(lazy_r, mat_r)


def test_large_buy_volume_above_group_limit_threshold(spark):
    orders = [order("big", "Buy", 1e6, 5000, 0)] + [order(f"s{i:03d}", "Sell", 100.0 + i, 60, 1 + i) for i in range(100)]
    want_t, want_r = _expected(orders)
    got_t, got_r, _ = _run(spark, orders)
    assert len(got_t) == 84 and sum(t[4] for t in got_t) == 5000
    assert _close(got_t, want_t) and _close(got_r, want_r)


def test_orders_not_shuffled_bytes_deal_the_tasks(spark, monkeypatch):
    """The rows that a task lists once per price level follow ORDERS_PER_TASK, whatever AQE makes of their bytes."""
    rows = [order(f"{s}{i}", s, 10 + i % 7, 1 + i % 5, i, instrument=f"I{i % 40}") for i in range(800) for s in ("Buy", "Sell")]
    books = assign_windows(frame(spark, rows), "order_time", "1 hour", "1 hour")
    want = sorted(tuple(r) for r in match_orders(books).trades.collect())
    monkeypatch.setattr(matching, "ORDERS_PER_TASK", 50)
    m = match_orders(books)
    assert sorted(tuple(r) for r in m.trades.collect()) == want
    assert "REPARTITION_BY_NUM" in m.trades._jdf.queryExecution().executedPlan().toString()


def test_candidates_deal_the_tasks_of_their_sums(spark, monkeypatch):
    """Few orders may have many candidates: the tasks that sort them are as many as these ask for, in both tiers."""
    rows = [order(f"{s}{i}", s, 10 + i % 7, 1 + i % 5, i, instrument=f"I{i % 40}") for i in range(800) for s in ("Buy", "Sell")]
    books = assign_windows(frame(spark, rows), "order_time", "1 hour", "1 hour")
    want = sorted(tuple(r) for r in match_orders(books).trades.collect())
    monkeypatch.setattr(matching, "CANDIDATES_PER_TASK", 100)
    for tier in ({}, {"book_rows": 0}):
        m = match_orders(books, **tier)
        assert sorted(tuple(r) for r in m.trades.collect()) == want
        assert m.trades.rdd.getNumPartitions() > 40  # 1,600 orders are one task


def test_rows_sorted_across_tasks_are_numbers(spark, monkeypatch):
    """Beyond one task per ladder, what is summed across tasks holds no order texts, and small buys cut it first."""
    seen = []
    whole = matching.ranked_within_groups

    def watched(df, group, *how):
        seen.append((group, df.columns, df.count()))
        return whole(df, group, *how)

    monkeypatch.setattr(matching, "ranked_within_groups", watched)
    rows = [order(f"s{i}", "Sell", 10, 1, i) for i in range(400)] + [order(f"b{i}", "Buy", 11, 3, 500 + i) for i in range(5)]
    books = assign_windows(frame(spark, rows), "order_time", "1 hour", "1 hour")
    want = sorted(tuple(r) for r in match_orders(books).trades.collect())
    assert sorted(tuple(r) for r in match_orders(books, book_rows=0, ladder_rows=0, hot_rows=2).trades.collect()) == want
    levels, blocks, sums = [x for x in seen if "price" in x[1]], [x for x in seen if "lvl" in x[0]], [x for x in seen if "b_uid" in x[0]]
    assert levels and blocks and sums
    assert all("s_order_id" not in x[1] and "b_order_id" not in x[1] for x in blocks + sums)
    assert all(x[2] <= 3 for x in blocks)  # one price: one block, of which three sells can trade
