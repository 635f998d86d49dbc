from bourse.operators.analytics import profit, sma, top_n
from bourse.operators.book import assign_windows, flatten_window, order_book, price_ladder
from bourse.operators.matching import Match, match_orders, reference_view
from bourse.operators.orders import carry_forward, live, split_sides, union_orders, validate

__all__ = [
    "profit",
    "sma",
    "top_n",
    "assign_windows",
    "flatten_window",
    "order_book",
    "price_ladder",
    "Match",
    "match_orders",
    "reference_view",
    "carry_forward",
    "live",
    "split_sides",
    "union_orders",
    "validate",
]
