"""Hypothesis: random small books (ties in price and time, copies, expired orders) against the rule."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import T0, order
from tests.test_matching import _close, _expected, _run

side = st.sampled_from(["Buy", "Sell"])
book_order = st.tuples(
    side,
    st.integers(min_value=1, max_value=6),  # total price (few levels: many ties)
    st.integers(min_value=1, max_value=6),  # volume
    st.integers(min_value=0, max_value=5),  # second of arrival (ties in time)
    st.booleans(),  # expired at the window end
)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(book_order, min_size=1, max_size=14), st.booleans())
def test_random_books_follow_the_rule(spark, rows, spread):
    orders = [
        order(f"o{i}", s, p, v, t, "A", expiry=T0 + dt.timedelta(minutes=30) if expired else None)
        for i, (s, p, v, t, expired) in enumerate(rows)
    ]
    want_t, want_r = _expected(orders)
    paths = dict(book_rows=0, ladder_rows=0, hot_rows=2) if spread else {}
    got_t, got_r, _ = _run(spark, orders, **paths)
    assert _close(got_t, want_t)
    assert _close(got_r, want_r)
