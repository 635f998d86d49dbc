"""Small in-code fixtures and a plain-Python statement of the matching rule."""

from __future__ import annotations

import datetime as dt
from collections import namedtuple

from bourse import schemas

T0 = dt.datetime(2024, 1, 1, 22, 0, 0)
Order = namedtuple("Order", "order_id instrument buy_sell price volume expiry order_time initial_order_time")


def order(oid, side, price, volume, t=0, instrument="A", expiry_h=5, expiry=None):
    ot = T0 + dt.timedelta(seconds=t)
    return Order(oid, instrument, side, float(price), volume, expiry or (T0 + dt.timedelta(hours=expiry_h)), ot, ot)


def frame(spark, orders):
    return spark.createDataFrame([tuple(o) for o in orders], schemas.ORDER)


def brute_match(book, as_of):
    """The matching rule, one book, orders given in arrival order."""
    buys = [o for o in book if o.buy_sell == "Buy" and o.expiry > as_of]
    sells = [o for o in book if o.buy_sell == "Sell" and o.expiry > as_of]
    trades, rest = [], []
    for b in buys:
        want = b.volume
        for s in sells:
            if want == 0:
                break
            if s.price <= b.price:
                q = min(want, s.volume)
                trades.append((b.order_id, b.price / want, s.order_id, s.price / s.volume, q))
                if s.volume > q:
                    rest.append((s.order_id, s.volume - q, s.price, "Sell"))
                want -= q
        if want > 0:
            rest.append((b.order_id, want, b.price, "Buy"))
    return trades, rest


def arrival_key(o):
    return (o.order_time, o.order_id, o.price, o.volume, o.expiry, o.initial_order_time)
