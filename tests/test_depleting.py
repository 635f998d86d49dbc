"""Matching with shared sell volume: goldens, the plain rule, rounds and a hot book."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from bourse.functions.columns import time_literal_or_col
from bourse.operators import assign_windows, match_orders
from bourse.operators.depleting import match_depleting, serve_in_turn
from bourse.operators.matching import prepare_book_orders
from tests.helpers import T0, arrival_key, frame, order

HOUR = dt.timedelta(hours=1)


def plain(book, as_of):
    """The rule, one book in arrival order: (trades, leftovers)."""
    live = [o for o in book if o.expiry > as_of]
    left = {id(o): o.volume for o in live}
    trades = []
    for b in (o for o in live if o.buy_sell == "Buy"):
        for s in (o for o in live if o.buy_sell == "Sell"):
            if left[id(b)] and left[id(s)] and s.price <= b.price:
                q = min(left[id(b)], left[id(s)])
                trades.append((b.order_id, b.price / left[id(b)], s.order_id, s.price / left[id(s)], q))
                left[id(b)] -= q
                left[id(s)] -= q
    return sorted(trades), sorted((o.order_id, left[id(o)], o.price, o.buy_sell) for o in live if left[id(o)])


def rows(trades, remaining):
    t = [(r.buy_order_id, r.per_volume_buy_price, r.sell_order_id, r.per_volume_sell_price, r.trade_volume) for r in trades.collect()]
    return sorted(t), sorted((r.order_id, r.volume, r.price, r.buy_sell) for r in remaining.collect())


def books(orders):
    """The orders as plain copies, so that repeated orders are objects of their own, by hour and instrument."""
    out = {}
    for o in orders:
        start = o.order_time.replace(minute=0, second=0)
        out.setdefault((start, o.instrument), []).append(o._replace())
    return out


def expected(orders):
    trades, rest = [], []
    for (start, _), book in books(orders).items():
        t, r = plain(sorted(book, key=arrival_key), start + HOUR)
        trades += t
        rest += r
    return sorted(trades), sorted(rest)


def run(spark, orders, **rounds):
    o = prepare_book_orders(assign_windows(frame(spark, orders), window="1 hour", slide="1 hour"))
    return rows(*match_depleting(o, None, F.col("w_end"), **rounds))


def random_book(seed, n, levels=None, instruments=2, volume=40):
    rnd = random.Random(seed)
    price = (lambda: float(rnd.randint(1, levels))) if levels else (lambda: round(rnd.uniform(1, 100), 2))
    out = []
    for i in range(n):
        t = rnd.randint(0, 3500)
        o = order(f"o{i}", rnd.choice(["Buy", "Sell"]), price(), rnd.randint(1, volume), t, f"I{rnd.randrange(instruments)}", expiry_h=rnd.choice([5, 5, 5, 0]))
        out += [o] * rnd.choice([1, 1, 1, 2])
    return out


def test_g1_golden(spark):
    orders = [
        order("b1", "Buy", 10, 5, 0), order("s1", "Sell", 8, 3, 1), order("s2", "Sell", 9, 3, 2),
        order("b2", "Buy", 9, 4, 3), order("s3", "Sell", 20, 2, 4), order("b3", "Buy", 5, 7, 5),
    ]
    m = match_orders(assign_windows(frame(spark, orders), window="1 hour", slide="1 hour"), policy="depleting")
    trades, rest = rows(*m)
    assert [(b, s, q) for b, _, s, _, q in trades] == [("b1", "s1", 3), ("b1", "s2", 2), ("b2", "s2", 1)]
    assert trades[2][1] == 9 / 4 and trades[2][3] == 9.0  # b2 wants 4, s2 has 1 left
    assert rest == [("b2", 3, 9.0, "Buy"), ("b3", 7, 5.0, "Buy"), ("s3", 2, 20.0, "Sell")]
    left = m.remaining.where("order_id = 'b3'").first()
    assert left.order_time == T0 + HOUR and left.initial_order_time == T0 + dt.timedelta(seconds=5)


@pytest.mark.parametrize(
    ("seed", "n", "levels", "rounds"),
    [
        (1, 300, None, {}),
        (2, 300, 5, {"buys_per_round": 7}),
        (3, 300, None, {"buys_per_round": 16, "sells_per_task": 4, "bands": 3}),
        (4, 60, 4, {"buys_per_round": 3, "sells_per_task": 0, "bands": 1}),
    ],
)
def test_equals_the_plain_rule(spark, seed, n, levels, rounds):
    orders = random_book(seed, n, levels)
    assert run(spark, orders, **rounds) == expected(orders)


def test_hot_book_in_rounds(spark):
    """One book with most orders: no round sends more sells of it than the round can reach."""
    orders = random_book(9, 4000, instruments=1, volume=30) + random_book(10, 50, instruments=5)
    assert run(spark, orders, buys_per_round=500, sells_per_task=100, bands=16) == expected(orders)


def test_reach_is_a_part_of_a_large_book(spark):
    from bourse.operators.depleting import GROUP, _places, _reachable

    orders = [o for o in random_book(12, 6000, instruments=1) if o.expiry > T0 + HOUR]
    o = prepare_book_orders(assign_windows(frame(spark, orders), window="1 hour", slide="1 hour"))
    side = {s: _places(o.where(F.col("buy_sell") == s), 1).select(*GROUP, "uid", "price", "volume", "place") for s in ("Buy", "Sell")}
    first = side["Buy"].where("place < 100")
    sent, all_ = _reachable(first, side["Sell"], 32, 100).count(), side["Sell"].count()
    assert 0 < sent < all_ / 3


def test_serving_a_large_book_is_fast():
    rnd = random.Random(3)
    buys = [(rnd.uniform(1, 100), rnd.randint(1, 50)) for _ in range(50_000)]
    sells = [(rnd.uniform(1, 100), rnd.randint(1, 50)) for _ in range(50_000)]
    began = time.time()
    out = serve_in_turn(buys, sells)
    assert len(out) > 50_000 and time.time() - began < 30
    assert serve_in_turn([], sells) == [] and serve_in_turn(buys, []) == []


def test_policy_names_and_times(spark):
    w = assign_windows(frame(spark, [order("b1", "Buy", 10, 5, 0), order("s1", "Sell", 8, 3, 9)]), window="1 hour", slide="1 hour")
    with pytest.raises(ValueError, match="policy"):
        match_orders(w, policy="pro rata")
    at = T0 + dt.timedelta(minutes=5)
    m = match_orders(w, as_of=at, exec_time=at, policy="depleting", reprice=True)
    assert m.trades.first().execution_time == at
    left = m.remaining.first()
    assert (left.order_id, left.volume, left.price, left.order_time) == ("b1", 2, 4.0, at)
    none = match_orders(w, as_of=time_literal_or_col("now"), policy="depleting")
    assert none.trades.count() == 0 and none.remaining.count() == 0
