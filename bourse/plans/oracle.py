"""Equivalent ANSI SQL (DuckDB dialect) for each registered batch query.

Tables ``events lineitem part ...`` are views over the same parquet files.
The matcher oracle is the plain statement of the rule: join every buy with
every eligible sell of its book and take a running sum in arrival order.
"""

from __future__ import annotations

# events -> orders (M1)
M1_ORDERS = """
m1 AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id,
         event_id AS uid,
         'INSTR' || CAST(user_id % 20 AS VARCHAR) AS instrument,
         CASE WHEN event_id % 2 = 0 THEN 'Buy' ELSE 'Sell' END AS buy_sell,
         CAST(CAST(value + CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE 0.0 END AS DECIMAL(18,2)) AS DOUBLE) AS price,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS volume,
         ts + to_hours(CAST(6 + (event_id % 5) * 6 AS BIGINT)) AS expiry,
         ts AS order_time,
         ts AS initial_order_time
  FROM events
)"""

M1_GOOD = """
good AS (
  SELECT * FROM m1
  WHERE order_id IS NOT NULL AND instrument IS NOT NULL AND buy_sell IS NOT NULL AND price IS NOT NULL
    AND volume IS NOT NULL AND expiry IS NOT NULL AND order_time IS NOT NULL
    AND NOT isnan(price) AND volume > 0 AND buy_sell IN ('Buy', 'Sell')
)"""

# M1 and one order per instrument that wants far more than its book holds
M1_WHALES = M1_ORDERS.replace("m1 AS (", "m0 AS (") + """,
m1 AS (
  SELECT * FROM m0 UNION ALL
  SELECT 'whale-' || instrument, -1 - row_number() OVER (ORDER BY instrument), instrument, 'Buy', 1000000.0, 50000000,
         max(order_time) + INTERVAL 30 HOUR, max(order_time), max(order_time)
  FROM m0 GROUP BY instrument
)"""

# sliding window 1 day every 12 hours (epoch-aligned): each order lands in two windows
M1_WINDOWED = """
ow AS (
  SELECT w_start, w_start + INTERVAL 1 DAY AS w_end, * EXCLUDE (w_start, k)
  FROM (
    SELECT *, time_bucket(INTERVAL 12 HOUR, order_time, TIMESTAMP '1970-01-01') - k * INTERVAL 12 HOUR AS w_start
    FROM (SELECT *, unnest([0, 1]) AS k FROM good)
  )
)"""

M1_MATCH = """
lv AS (SELECT * FROM ow WHERE expiry > w_end),
b AS (SELECT * FROM lv WHERE buy_sell = 'Buy'),
s AS (SELECT * FROM lv WHERE buy_sell = 'Sell'),
p AS (
  SELECT b.w_start, b.w_end, b.instrument,
         b.uid AS b_uid, b.order_id AS b_id, b.price AS b_price, b.volume AS b_volume, b.order_time AS b_ot,
         s.order_id AS s_id, s.price AS s_price, s.volume AS s_volume, s.order_time AS s_ot,
         s.expiry AS s_expiry, s.initial_order_time AS s_init,
         COALESCE(SUM(s.volume) OVER (
           PARTITION BY b.w_start, b.instrument, b.uid
           ORDER BY s.order_time, s.order_id, s.price, s.volume, s.expiry, s.initial_order_time, s.uid
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev
  FROM b JOIN s ON b.w_start = s.w_start AND b.instrument = s.instrument AND s.price <= b.price
),
hits AS (
  SELECT *, CAST(b_volume - prev AS BIGINT) AS want, CAST(LEAST(s_volume, b_volume - prev) AS INTEGER) AS tv
  FROM p WHERE prev < b_volume
),
trades AS (
  SELECT w_start, w_end, instrument,
         b_id AS buy_order_id, b_price / want AS per_volume_buy_price,
         s_id AS sell_order_id, s_price / s_volume AS per_volume_sell_price,
         tv AS trade_volume, GREATEST(b_ot, s_ot) AS execution_time
  FROM hits
),
filled AS (SELECT w_start, instrument, b_uid, SUM(tv) AS filled FROM hits GROUP BY ALL),
remaining AS (
  SELECT b.w_start, b.w_end, b.instrument, b.order_id, CAST(b.volume - COALESCE(f.filled, 0) AS INTEGER) AS volume,
         b.price, 'Buy' AS buy_sell, b.w_end AS order_time, b.initial_order_time, b.expiry
  FROM b LEFT JOIN filled f ON b.w_start = f.w_start AND b.instrument = f.instrument AND b.uid = f.b_uid
  WHERE b.volume - COALESCE(f.filled, 0) > 0
  UNION ALL
  SELECT w_start, w_end, instrument, s_id, CAST(s_volume - tv AS INTEGER), s_price, 'Sell', w_end, s_init, s_expiry
  FROM hits WHERE s_volume > tv
)"""


# sold volume is gone: book by book, buy after buy, with the list of what each sell has left
M1_DEPLETING = """
lv AS (SELECT * FROM ow WHERE expiry > w_end),
q AS (
  SELECT *, row_number() OVER (PARTITION BY w_start, instrument
    ORDER BY order_time, order_id, price, volume, expiry, initial_order_time, uid) AS j
  FROM lv WHERE buy_sell = 'Buy'
),
sl AS (
  SELECT w_start, instrument,
         list({'id': order_id, 'price': price, 'ot': order_time} ORDER BY order_time, order_id, price, volume, expiry, initial_order_time, uid) AS sells,
         list(CAST(volume AS BIGINT) ORDER BY order_time, order_id, price, volume, expiry, initial_order_time, uid) AS volumes
  FROM lv WHERE buy_sell = 'Sell' GROUP BY w_start, instrument
),
turns AS (
  SELECT w_start, instrument, CAST(0 AS BIGINT) AS j, sells, volumes AS had, list_transform(volumes, lambda v: CAST(0 AS BIGINT)) AS taken FROM sl
  UNION ALL
  SELECT w_start, instrument, j, sells, had,
         list_transform(seen, lambda v, i: greatest(0, least(v, wanted - CAST(coalesce(list_sum(seen[1:i - 1]), 0) AS BIGINT)))) AS taken
  FROM (
    SELECT w_start, instrument, j, sells, had, wanted,
           list_transform(had, lambda v, i: CASE WHEN sells[i].price <= price THEN v ELSE 0 END) AS seen
    FROM (
      SELECT t.w_start, t.instrument, t.j + 1 AS j, t.sells, q.price, CAST(q.volume AS BIGINT) AS wanted,
             list_transform(t.had, lambda v, i: v - t.taken[i]) AS had
      FROM turns t JOIN q ON q.w_start = t.w_start AND q.instrument = t.instrument AND q.j = t.j + 1
    )
  )
),
cells AS (
  SELECT w_start, instrument, j, unnest(sells) AS s, unnest(had) AS s_had, unnest(taken) AS tv, unnest(range(1, len(had) + 1)) AS i
  FROM turns WHERE j > 0
),
hits AS (
  SELECT q.w_start, q.w_end, q.instrument, q.uid AS b_uid, q.order_id AS b_id, q.price AS b_price, q.order_time AS b_ot, s, s_had, c.i,
         CAST(tv AS INTEGER) AS tv, q.volume - coalesce(sum(tv) OVER (PARTITION BY q.w_start, q.instrument, q.j ORDER BY c.i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS want
  FROM cells c JOIN q ON q.w_start = c.w_start AND q.instrument = c.instrument AND q.j = c.j WHERE tv > 0
),
trades AS (
  SELECT w_start, w_end, instrument, b_id AS buy_order_id, b_price / want AS per_volume_buy_price, s.id AS sell_order_id,
         s.price / s_had AS per_volume_sell_price, tv AS trade_volume, greatest(b_ot, s.ot) AS execution_time
  FROM hits
),
fb AS (SELECT b_uid, w_start, sum(tv) AS done FROM hits GROUP BY ALL),
fs AS (SELECT w_start, instrument, s.id AS s_id, sum(tv) AS done FROM hits GROUP BY ALL),
remaining AS (
  SELECT lv.w_start, lv.w_end, lv.instrument, lv.order_id, CAST(lv.volume - coalesce(fb.done, fs.done, 0) AS INTEGER) AS volume,
         lv.price, lv.buy_sell, lv.w_end AS order_time, lv.initial_order_time, lv.expiry
  FROM lv LEFT JOIN fb ON lv.buy_sell = 'Buy' AND fb.b_uid = lv.uid AND fb.w_start = lv.w_start
    LEFT JOIN fs ON lv.buy_sell = 'Sell' AND fs.s_id = lv.order_id AND fs.w_start = lv.w_start AND fs.instrument = lv.instrument
  WHERE lv.volume - coalesce(fb.done, fs.done, 0) > 0
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


MATCH_CTES = (M1_ORDERS, M1_GOOD, M1_WINDOWED, M1_MATCH)

# lineitem -> trades (M3)
M3_TRADES = """
t3 AS (
  SELECT 'SUPP' || CAST(l_suppkey AS VARCHAR) AS instrument,
         'B' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS buy_order_id,
         l_extendedprice / l_quantity AS per_volume_buy_price,
         'S' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sell_order_id,
         l_extendedprice / l_quantity * (1 - l_discount) AS per_volume_sell_price,
         CAST(l_quantity AS INTEGER) AS trade_volume,
         l_shipdate AS execution_time
  FROM lineitem
)"""


def _sliding(src: str, time_col: str, slide: str, size: str, n: int) -> str:
    """Rows of ``src`` repeated once per sliding window they fall in (epoch aligned)."""
    ks = ", ".join(str(i) for i in range(n))
    return f"""
SELECT w_start AS w_start_time, w_start + INTERVAL {size} AS w_end_time, * EXCLUDE (w_start, k)
FROM (
  SELECT *, time_bucket(INTERVAL {slide}, {time_col}, TIMESTAMP '1970-01-01') - k * INTERVAL {slide} AS w_start
  FROM (SELECT instrument, per_volume_buy_price, per_volume_sell_price, execution_time, unnest([{ks}]) AS k
        FROM {src})
)"""


def _r6(expr: str) -> str:
    """Round a double half-up to 9 then 6 decimals, from its shortest text form (as Spark casts doubles)."""
    return f"CAST(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(18,9)) AS DECIMAL(18,6))"


def _sma_sql(src: str, slide: str, size: str) -> str:
    return f"""
SELECT instrument, {_r6('AVG(per_volume_buy_price)')} AS sma_price, w_start_time, w_end_time
FROM ({_sliding(src, 'execution_time', slide, size, 2)}) GROUP BY instrument, w_start_time, w_end_time"""


def _profit_sql(src: str, slide: str, size: str) -> str:
    return f"""
SELECT instrument,
       {_r6('AVG(per_volume_buy_price) - AVG(per_volume_sell_price)')} AS profit,
       {_r6('AVG(per_volume_buy_price)')} AS closing_sma_price,
       {_r6('AVG(per_volume_sell_price)')} AS opening_sma_price,
       w_start_time, w_end_time
FROM ({_sliding(src, 'execution_time', slide, size, 2)}) GROUP BY instrument, w_start_time, w_end_time"""


M2_ORDERS = """
o2 AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) || CASE WHEN l_linenumber = 7 THEN '-X' ELSE '' END AS instrument,
         CASE WHEN l_linenumber % 2 = 1 THEN 'Buy' ELSE 'Sell' END AS buy_sell,
         l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS volume, l_shipdate AS expiry
  FROM lineitem
),
inst AS (
  SELECT CAST(p_partkey AS VARCHAR) AS instrument, min_by(p_retailprice, p_retailprice) AS mkt_price, 1 AS mkt_volume
  FROM part GROUP BY 1
),
v2 AS (
  SELECT o2.*, CASE
      WHEN inst.mkt_price IS NULL THEN 'invalid_instrument'
      WHEN o2.price IS NULL OR isnan(o2.price) OR o2.volume IS NULL OR o2.expiry IS NULL OR o2.volume <= 0
        THEN 'malformed'
      WHEN TIMESTAMP '1995-06-17 00:00:00' > o2.expiry THEN 'expired'
      WHEN round(CAST(o2.price / o2.volume AS DECIMAL(18,6)), 2)
           < round(CAST(inst.mkt_price / inst.mkt_volume AS DECIMAL(18,6)), 2) THEN 'below_market'
    END AS reject_reason
  FROM o2 LEFT JOIN inst ON o2.instrument = inst.instrument
)"""


def feedback_rounds(rounds: int) -> str:
    """Explicit rounds: the leftovers of a round are the orders of the next; trades of all rounds with their round."""
    ctes, out = [M1_ORDERS, M1_GOOD], []
    for r in range(rounds):
        body = (M1_WINDOWED + "," + M1_MATCH).replace("FROM good)", f"FROM good_{r})")
        for name in ("ow", "lv", "b", "s", "p", "hits", "trades", "filled", "remaining"):
            for before, after in ((f"\n{name} AS (", f"\n{name}_{r} AS ("), (f"FROM {name} ", f"FROM {name}_{r} "), (f"JOIN {name} ", f"JOIN {name}_{r} "),
                                  (f"FROM {name}\n", f"FROM {name}_{r}\n")):
                body = body.replace(before, after)
        body = body.replace(f"FROM b_{r} JOIN s_{r} ON", f"FROM b_{r} b JOIN s_{r} s ON").replace(
            f"FROM b_{r} LEFT JOIN filled_{r} f ON", f"FROM b_{r} b LEFT JOIN filled_{r} f ON")
        fields = "order_id, instrument, buy_sell, price, volume, expiry, order_time, initial_order_time"
        good = f"\ngood_{r} AS (SELECT * FROM good)" if r == 0 else (
            f"\ngood_{r} AS MATERIALIZED (SELECT {fields}, row_number() OVER (ORDER BY {fields}) AS uid FROM remaining_{r - 1})")
        ctes += [good, body]
        out.append(f"SELECT *, {r} AS round FROM trades_{r}")
    return _with(*ctes) + " UNION ALL ".join(out)


def oracle_queries() -> dict[str, str]:
    m = _with(*MATCH_CTES)
    q: dict[str, str] = {}
    q["q_decode_orders"] = _with(M1_ORDERS) + """
SELECT order_id, instrument, buy_sell, price, volume,
       date_trunc('second', expiry) AS expiry,
       date_trunc('second', order_time) AS order_time,
       date_trunc('second', initial_order_time) AS initial_order_time
FROM m1"""
    q["q_quarantine"] = _with(M1_ORDERS) + """
SELECT order_id, instrument, buy_sell, volume,
       CASE WHEN volume IS NULL THEN 'missing_volume' ELSE 'non_positive_volume' END AS reject_reason
FROM m1 WHERE volume IS NULL OR volume <= 0"""
    q["q_envelope_roundtrip"] = _with(M3_TRADES) + "SELECT * FROM t3"
    q["q_order_id"] = _with(M1_ORDERS) + """
SELECT order_id,
       buy_sell || '-' || instrument || '-' || CAST(CAST(floor(epoch_us(order_time) / 1000) AS BIGINT) AS VARCHAR) AS wire_order_id,
       order_id || '_' || CAST(CAST(floor(epoch_us(order_time) / 1000000) AS BIGINT) AS VARCHAR) AS producer_key
FROM m1"""
    q["q_message_key"] = _with(M3_TRADES) + """
SELECT buy_order_id, buy_order_id || '_' || sell_order_id || '_' || CAST(execution_time AS VARCHAR) AS trade_key
FROM t3"""
    q["q_validate_accept"] = _with(M2_ORDERS) + """
SELECT order_id, instrument, price, volume, expiry, buy_sell,
       strftime(expiry, '%Y-%m-%d %H:%M:%S') AS expiry_text,
       TIMESTAMP '1995-06-17 00:00:00' AS order_time, TIMESTAMP '1995-06-17 00:00:00' AS initial_order_time
FROM v2 WHERE reject_reason IS NULL"""
    q["q_validate_csv"] = q["q_validate_accept"]
    q["q_validate_reject"] = _with(M2_ORDERS) + """
SELECT order_id, instrument, buy_sell, reject_reason FROM v2 WHERE reject_reason IS NOT NULL"""
    q["q_live_orders"] = _with(M1_ORDERS, M1_GOOD, M1_WINDOWED) + """
SELECT w_start, w_end, instrument, order_id, buy_sell, price, volume, expiry
FROM ow WHERE expiry > w_end AND buy_sell IN ('Buy', 'Sell')"""
    q["q_order_book"] = _with(M1_ORDERS, M1_GOOD, M1_WINDOWED) + """
SELECT w_start, w_end, instrument, page, COUNT(*) AS n_orders,
       string_agg(order_id, ',' ORDER BY order_time, order_id, price, volume, buy_sell, expiry, initial_order_time)
         AS order_ids,
       CAST(SUM(volume) AS BIGINT) AS book_volume
FROM (
  SELECT *, CAST((row_number() OVER (PARTITION BY w_start, w_end, instrument
                  ORDER BY order_time, order_id, price, volume, buy_sell, expiry, initial_order_time) - 1)
                 // 10000 AS BIGINT) AS page
  FROM ow
) GROUP BY w_start, w_end, instrument, page"""
    q["q_price_ladder"] = _with(M1_ORDERS, M1_GOOD, M1_WINDOWED) + """
SELECT w_start, w_end, instrument, buy_sell, price, CAST(SUM(volume) AS BIGINT) AS total_volume, COUNT(*) AS n_orders
FROM ow GROUP BY w_start, w_end, instrument, buy_sell, price"""
    q["q_match_trades"] = m + "SELECT * FROM trades"
    q["q_remaining"] = m + "SELECT * FROM remaining"
    q["q_trade_keys"] = m + """
SELECT instrument, buy_order_id, sell_order_id, trade_volume,
       buy_order_id || '_' || sell_order_id || '_' || CAST(execution_time AS VARCHAR) AS trade_key
FROM trades"""
    q["q_carry_forward"] = m + """
SELECT order_id, instrument, buy_sell, price, volume, expiry, order_time, initial_order_time FROM remaining"""
    q["q_union_orders"] = m + """
SELECT order_id, instrument, buy_sell, price, volume, expiry, order_time, initial_order_time FROM good
UNION ALL
SELECT order_id, instrument, buy_sell, price, volume, expiry, order_time, initial_order_time FROM remaining"""
    sma_m1 = _sma_sql("trades", "12 HOUR", "1 DAY")
    profit_m1 = _profit_sql("trades", "12 HOUR", "1 DAY")
    q["q_sma"] = m + sma_m1
    # ranked on the averages themselves, rounded afterwards
    q["q_sma_top"] = m + sma_m1 + " ORDER BY w_start_time DESC, AVG(per_volume_buy_price) DESC NULLS LAST, instrument LIMIT 4"
    q["q_profit"] = m + profit_m1
    by_profit = "ORDER BY w_start_time DESC, AVG(per_volume_buy_price) - AVG(per_volume_sell_price) DESC NULLS LAST, instrument"
    q["q_profit_top"] = m + f"{profit_m1} {by_profit} LIMIT 1"
    q["q_sma_lineitem"] = _with(M3_TRADES) + _sma_sql("t3", "15 DAY", "30 DAY")
    p3 = _profit_sql("t3", "15 DAY", "30 DAY")
    q["q_profit_lineitem_top"] = _with(M3_TRADES) + f"{p3} {by_profit} LIMIT 10"
    few = "(SELECT * REPLACE (CASE WHEN CAST(substr(instrument, 5) AS INTEGER) % 5 = 1 THEN per_volume_buy_price END AS per_volume_buy_price) FROM t3)"
    q["q_sma_nulls_last"] = _with(M3_TRADES) + _sma_sql(few, "15 DAY", "30 DAY") + """
ORDER BY w_start_time DESC, AVG(per_volume_buy_price) DESC NULLS LAST, instrument LIMIT 12"""
    # every tier of the matcher gives the trades of the plain rule
    q["q_match_ladder"] = q["q_match_trades"]
    q["q_match_salted"] = q["q_match_trades"]
    q["q_match_whale"] = _with(M1_WHALES, M1_GOOD, M1_WINDOWED, M1_MATCH) + "SELECT * FROM trades"
    depleting = "WITH RECURSIVE " + ",".join((M1_ORDERS, M1_GOOD, M1_WINDOWED, M1_DEPLETING)) + "\n"
    q["q_match_depleting"] = depleting + "SELECT * FROM trades"
    q["q_remaining_depleting"] = depleting + "SELECT * FROM remaining"
    whole = M1_MATCH.replace("         b.price, 'Buy'", "         b.price * (b.volume - COALESCE(f.filled, 0)) / b.volume AS price, 'Buy'").replace(
        "s_price, 'Sell'", "s_price * (s_volume - tv) / s_volume, 'Sell'")
    q["q_remaining_repriced"] = _with(M1_ORDERS, M1_GOOD, M1_WINDOWED, whole) + "SELECT * FROM remaining"
    q["q_match_explode"] = m + """
SELECT instrument, buy_order_id, sell_order_id, trade_volume, per_volume_buy_price, per_volume_sell_price, execution_time
FROM trades"""
    q["q_order_book_paged"] = _with(M1_ORDERS, M1_GOOD, M1_WINDOWED) + """
SELECT w_start, w_end, instrument, page, COUNT(*) AS n_orders,
       string_agg(order_id || '/' || CAST(CAST(round(price * 100) AS BIGINT) AS VARCHAR) || '/' || CAST(volume AS VARCHAR) || '/'
                  || buy_sell || '/' || CAST(CAST(floor(epoch(expiry)) AS BIGINT) AS VARCHAR),
                  ',' ORDER BY order_time, order_id, price, volume, buy_sell, expiry, initial_order_time) AS entries
FROM (
  SELECT *, CAST((row_number() OVER (PARTITION BY w_start, w_end, instrument
                  ORDER BY order_time, order_id, price, volume, buy_sell, expiry, initial_order_time) - 1)
                 // 16 AS BIGINT) AS page
  FROM ow
) GROUP BY w_start, w_end, instrument, page"""
    iso = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"
    q["q_reorder_wire"] = m + f"""
SELECT order_id || '_' || CAST(order_time AS VARCHAR) AS key,
       '{{"order_id":"' || order_id || '","instrument":"' || instrument || '","buy_sell":"' || buy_sell || '","price":'
       || CAST(price AS VARCHAR) || ',"volume":' || CAST(volume AS VARCHAR) || ',"expiry":"' || {iso.format('expiry')}
       || '","order_time":"' || {iso.format('order_time')} || '","initial_order_time":"' || {iso.format('initial_order_time')}
       || '"}}' AS value
FROM remaining"""
    return q
