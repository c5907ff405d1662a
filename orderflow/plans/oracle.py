"""Independent SQL (DuckDB dialect) for every registered batch query.

Written from the semantics, not from the Spark plans: sessions by ``lag``
and running sums, the fold by a recursive CTE, the as-of join by
``ASOF JOIN``.  Money is compared in exact cents, as in the Spark forms.
"""

from __future__ import annotations

from orderflow import schemas as S

# ---- adapters (same mappings as orderflow.sources.fixtures) -----------------
PRODUCT_CASE = ("CASE event_id % 3 WHEN 0 THEN 'JUMPERS' WHEN 1 THEN 'UNDERPANTS' "
                "ELSE 'STOCKINGS' END")

ORD = f"""ord AS (
  SELECT CAST(event_id AS VARCHAR) AS id, user_id AS customerId, 'CREATED' AS state,
    {PRODUCT_CASE} AS product, CAST(1 + event_id % 5 AS INTEGER) AS quantity, value AS price,
    ts, event_id AS seq
  FROM events)"""

PAY = """pay AS (
  SELECT 'P' || CAST(event_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS orderId, 'CZK' AS ccy,
    value * (1 + event_id % 5) AS amount,
    ts + INTERVAL '1' SECOND * ((event_id * 37) % 241 - 120) AS ts
  FROM events)"""

CUST = """cust AS (
  SELECT c_custkey + 1 AS id, split_part(c_name, '#', 1) AS firstName,
    split_part(c_name, '#', 2) AS lastName,
    'c' || CAST(c_custkey + 1 AS VARCHAR) || '@example.com' AS email,
    'Nation ' || CAST(c_nationkey AS VARCHAR) AS address,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'platinum' WHEN 'BUILDING' THEN 'gold'
      WHEN 'FURNITURE' THEN 'silver' ELSE 'bronze' END AS level
  FROM customer)"""

RAW = """raw AS (
  SELECT id, customerId,
    CASE WHEN seq % 7 = 3 THEN 'VALIDATED' WHEN seq % 11 = 5 THEN 'FAILED' WHEN seq % 13 = 6 THEN 'SHIPPED'
      ELSE 'CREATED' END AS state,
    CASE WHEN seq % 23 <> 8 THEN product END AS product,
    CASE WHEN seq % 17 = 2 THEN -quantity ELSE quantity END AS quantity,
    CASE WHEN seq % 19 = 4 THEN -price ELSE price END AS price, ts, seq
  FROM ord)"""

BURST = """burst AS (
  SELECT * REPLACE (date_trunc('day', ts) + INTERVAL '1' SECOND * (seq % 40) AS ts) FROM ord)"""

LINES = """lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
      || CAST(l_partkey AS VARCHAR) AS id,
    l_partkey AS product, CAST(l_quantity AS INTEGER) AS quantity, l_shipdate AS ts,
    l_orderkey * 8 + l_linenumber AS seq
  FROM lineitem)"""

PINV = """pinv AS (SELECT p_partkey AS product, CAST(p_size * 20 AS INTEGER) AS stock FROM part)"""

INVCH = f"""invch AS (
  SELECT {PRODUCT_CASE} AS product, CAST(event_id % 50 AS INTEGER) AS stock, ts, event_id AS seq
  FROM events WHERE event_type = 'signup')"""

VALS = """vals AS (
  SELECT CAST(CAST((event_id - event_id % 3) / 3 AS BIGINT) AS VARCHAR) AS orderId,
    CASE event_id % 3 WHEN 0 THEN 'ORDER_DETAILS_CHECK' WHEN 1 THEN 'FRAUD_CHECK'
      ELSE 'INVENTORY_CHECK' END AS checkType,
    CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS validationResult,
    ts, event_id AS seq
  FROM events)"""

VORD = """vord AS (
  SELECT CAST(k AS VARCHAR) AS id, arg_min(user_id, event_id) AS customerId, 'CREATED' AS state,
    CASE k % 3 WHEN 0 THEN 'JUMPERS' WHEN 1 THEN 'UNDERPANTS' ELSE 'STOCKINGS' END AS product,
    CAST(sum(1 + event_id % 5) AS INTEGER) AS quantity, max(value) AS price,
    arg_min(ts, event_id) AS ts, min(event_id) AS seq
  FROM (SELECT *, CAST((event_id - event_id % 3) / 3 AS BIGINT) AS k FROM events) GROUP BY k)"""

VERSIONS = """ver AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'CREATED' AS state, user_id AS customerId, ts, event_id * 2 AS seq FROM events
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'VALIDATED' END, user_id,
    ts + INTERVAL '1' MILLISECOND * (event_id * 7919 % 4001), event_id * 2 + 1 FROM events)"""

REQUESTS = f"""req AS (
  SELECT 'R' || event_id AS request, CASE WHEN event_id % 10 = 9 THEN 'no-' ELSE '' END || event_id AS id,
    event_id % 2 = 0 AS terminal_only, ts + INTERVAL '1' MILLISECOND * (event_id * 104729 % 3001 - 1000) AS ts,
    ts + INTERVAL '1' MILLISECOND * (event_id * 104729 % 3001 - 1000)
      + INTERVAL '1' MICROSECOND * {S.REQUEST_WAIT_US} AS until
  FROM events)"""

OSTATES = """ostates AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS customerId,
    CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'VALIDATED' ELSE 'CREATED' END AS state,
    o_orderdate AS ts, o_orderkey AS seq
  FROM orders)"""

CHLOG = """chlog AS (
  SELECT user_id AS k, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v,
    ts, event_id AS seq
  FROM events)"""


def _us(spec: str) -> int:
    from orderflow.functions.expressions import interval_micros
    return interval_micros(spec)


# ---- building blocks ----------------------------------------------------------

def fraud_totals_cte(gap: str) -> str:
    g = _us(gap)
    return f"""fo AS (
  SELECT id, customerId, ts, seq, CAST(price AS DECIMAL(28,10)) * quantity AS vc
  FROM ord WHERE state = 'CREATED'),
fb AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL
      OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {g} THEN 1 ELSE 0 END AS brk
  FROM fo WINDOW w AS (PARTITION BY customerId ORDER BY ts, seq)),
fs AS (
  SELECT *, SUM(brk) OVER (PARTITION BY customerId ORDER BY ts, seq
      ROWS UNBOUNDED PRECEDING) AS sid FROM fb),
ft AS (
  SELECT id, customerId, ts, seq, sid,
    MIN(ts) OVER (PARTITION BY customerId, sid) AS session_start, vc,
    SUM(vc) OVER (PARTITION BY customerId, sid ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS tc
  FROM fs)"""


def fraud_totals_sql(gap: str) -> str:
    return f"""WITH {ORD}, {fraud_totals_cte(gap)}
SELECT id, customerId, ts, seq, session_start, CAST(vc AS DOUBLE) AS order_value,
  CAST(tc AS DOUBLE) AS total
FROM ft"""


def fraud_verdicts_select(limit: float) -> str:
    return f"""SELECT id AS orderId, 'FRAUD_CHECK' AS checkType,
  CASE WHEN tc >= {limit} THEN 'FAIL' ELSE 'PASS' END AS validationResult,
  ts + INTERVAL '2' SECOND AS ts, seq * 3 + 1 AS seq
FROM ft"""


def fraud_check_sql(gap: str, limit: float) -> str:
    return f"WITH {ORD}, {fraud_totals_cte(gap)}\n{fraud_verdicts_select(limit)}"


def fraud_summary_sql(gap: str) -> str:
    return f"""WITH {ORD}, {fraud_totals_cte(gap)}
SELECT customerId, session_start, MAX(ts) AS session_end, COUNT(*) AS orders,
  CAST(SUM(vc) AS DOUBLE) AS total
FROM ft GROUP BY customerId, session_start"""


DETAILS_SELECT = """SELECT id AS orderId, 'ORDER_DETAILS_CHECK' AS checkType,
  CASE WHEN quantity < 0 OR price < 0 OR product IS NULL THEN 'FAIL' ELSE 'PASS' END
    AS validationResult,
  ts + INTERVAL '1' SECOND AS ts, seq * 3 AS seq
FROM ord WHERE state = 'CREATED'"""
RAW_DETAILS = DETAILS_SELECT.replace("FROM ord", "FROM raw")


def fold_cte(src: str) -> str:
    """Greedy reservation fold over ``src(id, product, quantity, stock, ts, seq)`` (recursive)."""
    return f"""fx AS (
  SELECT *, row_number() OVER (PARTITION BY product ORDER BY ts, seq) AS rn FROM {src}),
fold AS (
  SELECT id, product, quantity, stock, ts, seq, rn,
    CASE WHEN stock - 0 - quantity >= 0 THEN 'PASS' ELSE 'FAIL' END AS validationResult,
    CAST(CASE WHEN stock - 0 - quantity >= 0 THEN quantity ELSE 0 END AS BIGINT) AS reserved
  FROM fx WHERE rn = 1
  UNION ALL
  SELECT x.id, x.product, x.quantity, x.stock, x.ts, x.seq, x.rn,
    CASE WHEN x.stock - f.reserved - x.quantity >= 0 THEN 'PASS' ELSE 'FAIL' END,
    CASE WHEN x.stock - f.reserved - x.quantity >= 0 THEN f.reserved + x.quantity
      ELSE f.reserved END
  FROM fold f JOIN fx x ON x.product = f.product AND x.rn = f.rn + 1)"""


LINE_STOCK = """lstock AS (
  SELECT l.id, l.product, l.quantity, p.stock, l.ts, l.seq
  FROM lines l JOIN pinv p ON l.product = p.product)"""

ASOF_STOCK = """astock AS (
  SELECT o.id, o.customerId, o.product, o.quantity, i.stock, o.ts, o.seq
  FROM ord o ASOF JOIN invch i ON o.product = i.product AND o.ts >= i.ts
  WHERE o.state = 'CREATED')"""


def pass_counts_cte(src: str, gap: str, n_rules: int) -> str:
    g = _us(gap)
    return f"""vb AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL
      OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {g} THEN 1 ELSE 0 END AS brk
  FROM {src} WINDOW w AS (PARTITION BY orderId ORDER BY ts, seq)),
vs AS (
  SELECT *, SUM(brk) OVER (PARTITION BY orderId ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS sid
  FROM vb),
vr AS (
  SELECT *, SUM(CASE WHEN validationResult = 'PASS' THEN 1 ELSE 0 END)
      OVER (PARTITION BY orderId, sid ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS run_pass
  FROM vs),
pc AS (
  SELECT orderId, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS verdicts,
    CAST(MAX(run_pass) AS BIGINT) AS passes,
    MIN(CASE WHEN run_pass >= {n_rules} THEN ts END) AS reach_ts
  FROM vr GROUP BY orderId, sid)"""


def validated_cte(orders: str, window: str, n_rules: int) -> str:
    w = _us(window)
    return f"""okv AS (
  SELECT o.id, o.customerId, 'VALIDATED' AS state, o.product, o.quantity, o.price, c.session_start
  FROM pc c JOIN {orders} o ON c.orderId = o.id
  WHERE c.passes >= {n_rules} AND o.state = 'CREATED'
    AND epoch_us(o.ts) >= epoch_us(c.reach_ts) - {w}
    AND epoch_us(o.ts) <= epoch_us(c.session_end) + {w})"""


def failed_cte(src: str, orders: str, window: str) -> str:
    w = _us(window)
    return f"""fj AS (
  SELECT o.id, o.customerId, o.product, o.quantity, o.price,
    row_number() OVER (PARTITION BY o.id ORDER BY v.ts, v.seq, o.ts, o.seq) AS rn
  FROM {src} v JOIN {orders} o ON v.orderId = o.id
  WHERE v.validationResult = 'FAIL' AND o.state = 'CREATED'
    AND epoch_us(v.ts) BETWEEN epoch_us(o.ts) - {w} AND epoch_us(o.ts) + {w}),
bad AS (SELECT id, customerId, 'FAILED' AS state, product, quantity, price FROM fj WHERE rn = 1)"""


def own_verdicts_cte() -> str:
    """Union of the three own checks on the event orders."""
    return f"""{fraud_totals_cte(S.FRAUD_SESSION_GAP)},
{ASOF_STOCK},
{fold_cte('astock')},
allv AS (
  {DETAILS_SELECT}
  UNION ALL
  {fraud_verdicts_select(S.FRAUD_LIMIT)}
  UNION ALL
  SELECT id AS orderId, 'INVENTORY_CHECK' AS checkType, validationResult,
    ts + INTERVAL '3' SECOND AS ts, seq * 3 + 2 AS seq FROM fold)"""


ENRICHED = """enr AS (
  SELECT c.id AS customerId, c.firstName, c.lastName, c.level, o.product, o.quantity, o.price, o.ts
  FROM ord o LEFT JOIN cust c ON o.customerId = c.id)"""


def tumbling_sql(window: str, min_count: int, burst: bool = False) -> str:
    w = _us(window)
    rows = f"{BURST}, {ENRICHED.replace('FROM ord o', 'FROM burst o')}" if burst else ENRICHED
    return f"""WITH {ORD}, {CUST}, {rows},
tb AS (SELECT *, epoch_us(ts) - (epoch_us(ts) % {w}) AS wus FROM enr WHERE customerId IS NOT NULL)
SELECT customerId, lastName, firstName, make_timestamp(wus) AS window_start,
  make_timestamp(wus + {w}) AS window_end, COUNT(*) AS counts
FROM tb GROUP BY customerId, lastName, firstName, wus HAVING COUNT(*) > {min_count}"""


def latest_sql(cte: str, src: str, key: str, cols: str, value: str | None = None) -> str:
    cond = f" AND {value} IS NOT NULL" if value else ""
    return f"""WITH {cte}, lt AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY seq DESC) AS rn FROM {src})
SELECT {cols} FROM lt WHERE rn = 1{cond}"""


def lookup_sql(terminal_only: bool) -> str:
    hit = "l.id IS NOT NULL" + (" AND l.state IN ('VALIDATED', 'FAILED')" if terminal_only else "")
    return f"""WITH {PAY}, {OSTATES}, lt AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM ostates),
lv AS (SELECT id, state, customerId FROM lt WHERE rn = 1),
req AS (SELECT DISTINCT CAST(2 * CAST(orderId AS BIGINT) AS VARCHAR) AS id FROM pay)
SELECT r.id, ({hit}) AS answered, CASE WHEN {hit} THEN l.state END AS state,
  CAST(CASE WHEN {hit} THEN l.customerId END AS VARCHAR) AS customerId
FROM req r LEFT JOIN lv l ON r.id = l.id"""


ORDER_COLS = "id, customerId, state, product, quantity, price"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["orders_created"] = f"""WITH {ORD}, {RAW}
SELECT id, customerId, state, product, quantity, price, ts, seq FROM raw WHERE state = 'CREATED'"""
    q["orders_typed_enum"] = f"""WITH {ORD}, {RAW}
SELECT id, state, coalesce(product, '-') AS product,
  CASE state WHEN 'CREATED' THEN 0 WHEN 'VALIDATED' THEN 1 WHEN 'FAILED' THEN 2
    WHEN 'SHIPPED' THEN 3 END AS state_ordinal,
  CASE product WHEN 'JUMPERS' THEN 0 WHEN 'UNDERPANTS' THEN 1 WHEN 'STOCKINGS' THEN 2 ELSE -1 END
    AS product_ordinal
FROM raw"""
    q["details_check"] = f"WITH {ORD}, {RAW}\n{RAW_DETAILS}"
    q["fraud_session_totals"] = fraud_totals_sql("1 hour")
    q["fraud_session_totals_12h"] = fraud_totals_sql("12 hours")
    q["fraud_check"] = fraud_check_sql("1 hour", 2000)
    q["fraud_check_12h_1000"] = fraud_check_sql("12 hours", 1000)
    q["fraud_check_1h_500"] = fraud_check_sql("1 hour", 500)
    q["fraud_session_summary"] = fraud_summary_sql("1 hour")
    q["inventory_join"] = f"""WITH {LINES}, {PINV}
SELECT l.id, l.product, l.quantity, p.stock FROM lines l JOIN pinv p ON l.product = p.product"""
    q["inventory_asof"] = f"""WITH {ORD}, {INVCH}, {ASOF_STOCK}
SELECT id, product, quantity, stock, ts FROM astock"""
    q["inventory_check"] = f"""WITH RECURSIVE {LINES}, {PINV}, {LINE_STOCK}, {fold_cte('lstock')}
SELECT id, product, quantity, stock, validationResult, reserved FROM fold"""
    q["inventory_check_asof"] = f"""WITH RECURSIVE {ORD}, {INVCH}, {ASOF_STOCK}, {fold_cte('astock')}
SELECT id, product, quantity, stock, validationResult, reserved FROM fold"""
    q["reserved_stock"] = f"""WITH RECURSIVE {LINES}, {PINV}, {LINE_STOCK}, {fold_cte('lstock')}
SELECT product, MAX(stock) AS stock,
  CAST(SUM(CASE WHEN validationResult = 'PASS' THEN quantity ELSE 0 END) AS BIGINT) AS reserved,
  COUNT(*) FILTER (WHERE validationResult = 'PASS') AS passed,
  COUNT(*) FILTER (WHERE validationResult = 'FAIL') AS failed
FROM fold GROUP BY product"""
    q["reserved_stock_state"] = f"""WITH RECURSIVE {LINES}, {PINV}, {LINE_STOCK}, {fold_cte('lstock')}
SELECT product, MAX(reserved) AS reserved FROM fold GROUP BY product"""
    q["stuck_orders"] = f"""WITH {ORD}, {INVCH}
SELECT o.id, o.customerId, o.product, o.quantity, o.ts FROM ord o
WHERE o.state = 'CREATED'
  AND NOT EXISTS (SELECT 1 FROM invch i WHERE i.product = o.product AND i.ts <= o.ts)"""
    q["reserved_asof_state"] = f"""WITH RECURSIVE {ORD}, {INVCH}, {ASOF_STOCK}, {fold_cte('astock')}
SELECT product, MAX(reserved) AS reserved FROM fold GROUP BY product"""
    q["order_requests"] = f"""WITH {VERSIONS}, {REQUESTS},
cand AS (SELECT r.*, v.state, v.customerId, v.ts AS vts, v.seq AS vseq, v.ts <= r.ts AS before,
    NOT r.terminal_only OR v.state IN ('VALIDATED', 'FAILED') AS wanted
  FROM req r JOIN ver v ON v.id = r.id AND v.ts <= r.until),
held AS (SELECT * FROM cand WHERE before QUALIFY row_number() OVER (PARTITION BY request ORDER BY vts DESC, vseq DESC) = 1),
later AS (SELECT * FROM cand WHERE NOT before AND wanted
  QUALIFY row_number() OVER (PARTITION BY request ORDER BY vts, vseq) = 1)
SELECT r.request, r.id, r.ts AS asked_ts,
  CASE WHEN h.wanted THEN 'ANSWERED' WHEN l.request IS NOT NULL THEN 'LATE' ELSE 'TIMEOUT' END AS outcome,
  CASE WHEN h.wanted THEN r.ts WHEN l.request IS NOT NULL THEN l.vts ELSE r.until END AS answered_ts,
  CASE WHEN h.wanted THEN h.state ELSE l.state END AS state,
  CAST(CASE WHEN h.wanted THEN h.customerId ELSE l.customerId END AS VARCHAR) AS customerId
FROM req r LEFT JOIN held h ON h.request = r.request LEFT JOIN later l ON l.request = r.request"""
    q["verdict_updates"] = f"""WITH {VALS}, {pass_counts_cte('vals', S.VALIDATION_SESSION_GAP, 3)}
SELECT orderId, MIN(ts) OVER (PARTITION BY orderId, sid) AS session_start, ts AS session_end,
  COUNT(*) OVER w AS verdicts, CAST(run_pass AS BIGINT) AS passes,
  MIN(CASE WHEN run_pass >= 3 THEN ts END) OVER w AS reach_ts
FROM vr WINDOW w AS (PARTITION BY orderId, sid ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)"""
    q["validations_union"] = f"""WITH RECURSIVE {ORD}, {INVCH}, {own_verdicts_cte()}
SELECT orderId, checkType, validationResult, ts, seq FROM allv"""
    q["validation_pass_counts"] = f"""WITH {VALS}, {pass_counts_cte('vals', S.VALIDATION_SESSION_GAP, 3)}
SELECT orderId, session_start, session_end, verdicts, passes, reach_ts FROM pc"""
    q["orders_validated"] = f"""WITH {VALS}, {VORD},
{pass_counts_cte('vals', S.VALIDATION_SESSION_GAP, 3)},
{validated_cte('vord', S.VALIDATION_JOIN_WINDOW, 3)}
SELECT {ORDER_COLS}, session_start FROM okv"""
    q["orders_failed"] = f"""WITH {VALS}, {VORD}, {failed_cte('vals', 'vord', S.VALIDATION_JOIN_WINDOW)}
SELECT {ORDER_COLS} FROM bad"""
    q["order_states"] = f"""WITH {VALS}, {VORD},
{pass_counts_cte('vals', S.VALIDATION_SESSION_GAP, 3)},
{validated_cte('vord', S.VALIDATION_JOIN_WINDOW, 3)},
{failed_cte('vals', 'vord', S.VALIDATION_JOIN_WINDOW)}
SELECT {ORDER_COLS} FROM vord
UNION ALL SELECT {ORDER_COLS} FROM okv
UNION ALL SELECT {ORDER_COLS} FROM bad"""
    q["order_outcomes"] = f"""WITH RECURSIVE {ORD}, {INVCH}, {own_verdicts_cte()},
{pass_counts_cte('allv', S.VALIDATION_SESSION_GAP, 3)},
{validated_cte('ord', S.VALIDATION_JOIN_WINDOW, 3)},
{failed_cte('allv', 'ord', S.VALIDATION_JOIN_WINDOW)}
SELECT {ORDER_COLS} FROM okv
UNION ALL SELECT {ORDER_COLS} FROM bad"""
    q["orders_latest"] = latest_sql(OSTATES, "ostates", "id", "id, customerId, state, ts")
    q["orders_latest_tombstones"] = latest_sql(CHLOG, "chlog", "k", "k, v, ts, seq", value="v")
    q["order_lookup"] = lookup_sql(False)
    q["order_lookup_validated"] = lookup_sql(True)
    q["orders_payments"] = f"""WITH {ORD}, {PAY}
SELECT o.id AS orderId, p.id AS paymentId, o.customerId, o.state, o.product, o.quantity, o.price,
  p.ccy, p.amount, o.ts AS order_ts, p.ts AS payment_ts
FROM ord o JOIN pay p ON o.id = p.orderId
  AND p.ts BETWEEN o.ts - INTERVAL '1' MINUTE AND o.ts + INTERVAL '1' MINUTE"""
    q["notifications"] = f"""WITH {ORD}, {PAY}, {CUST}
SELECT o.id AS orderId, p.id AS paymentId, o.customerId, o.state, o.product, o.quantity, o.price,
  p.ccy, p.amount, c.firstName, c.lastName, c.email, c.level
FROM ord o JOIN pay p ON o.id = p.orderId
  AND p.ts BETWEEN o.ts - INTERVAL '1' MINUTE AND o.ts + INTERVAL '1' MINUTE
JOIN cust c ON o.customerId = c.id"""
    q["orders_by_level"] = f"""WITH {ORD}, {CUST}
SELECT o.id, o.customerId, c.level AS customerLevel FROM ord o JOIN cust c ON o.customerId = c.id"""
    q["orders_by_level_versions"] = f"""WITH {ORD}, {CUST},
half AS (SELECT (max(event_id) + 1) // 2 AS h FROM events)
SELECT o.id, o.customerId, CASE WHEN o.seq >= h AND c.id % 3 = 0 THEN 'platinum' ELSE c.level END AS customerLevel
FROM ord o JOIN cust c ON o.customerId = c.id, half"""
    q["level_routing_counts"] = f"""WITH {ORD}, {CUST}
SELECT c.level AS customerLevel, COUNT(*) AS orders
FROM ord o JOIN cust c ON o.customerId = c.id GROUP BY c.level"""
    # nullable ids are compared as text (see catalog.nullable_id_as_text)
    q["orders_enriched_sql"] = f"""WITH {ORD}, {CUST}, {ENRICHED}
SELECT CAST(customerId AS VARCHAR) AS customerId, firstName, lastName, level, product, quantity,
  price FROM enr"""
    q["fraud_orders_tumbling"] = tumbling_sql(S.FRAUD_TUMBLING_WINDOW, S.FRAUD_MIN_COUNT, burst=True)
    q["fraud_orders_tumbling_1h"] = tumbling_sql("1 hour", S.FRAUD_MIN_COUNT)
    q["fraud_orders_tumbling_1d"] = tumbling_sql("1 day", S.FRAUD_MIN_COUNT)
    q["fraud_orders_limit"] = f"""WITH {ORD}, {CUST}, {ENRICHED},
tb AS (SELECT *, epoch_us(ts) - (epoch_us(ts) % {_us('1 day')}) AS wus FROM enr
  WHERE customerId IS NOT NULL),
fr AS (SELECT customerId, lastName, firstName, wus, COUNT(*) AS counts FROM tb
  GROUP BY customerId, lastName, firstName, wus HAVING COUNT(*) > {S.FRAUD_MIN_COUNT})
SELECT customerId, lastName, firstName, counts FROM fr
ORDER BY counts DESC, customerId, wus LIMIT {S.FRAUD_PULL_LIMIT}"""
    q["product_by_count"] = f"""WITH {ORD}
SELECT product, COUNT(*) AS doc_count FROM ord GROUP BY product
ORDER BY doc_count DESC, product LIMIT {S.TOP_PRODUCTS}"""
    q["product_by_count_lines"] = f"""WITH {LINES}
SELECT product, COUNT(*) AS doc_count FROM lines GROUP BY product
ORDER BY doc_count DESC, product LIMIT {S.TOP_PRODUCTS}"""
    q["search_documents"] = f"""WITH {ORD}
SELECT id, customerId, state, product, quantity, CAST(trunc(price) AS INTEGER) AS price FROM ord"""
    q["customers_incremental"] = f"""WITH {CUST}
SELECT id AS key, id, firstName, lastName, email, address, level FROM cust"""
    q["customers_incremental_source"] = q["customers_incremental"]
    q["details_rejections"] = f"""WITH {ORD}, {RAW}, v AS ({RAW_DETAILS})
SELECT v.orderId, v.checkType, v.validationResult,
  CASE WHEN v.validationResult = 'FAIL' THEN CAST(raw.customerId AS VARCHAR) END AS rejectedCustomer
FROM v JOIN raw ON raw.id = v.orderId"""
    q["customers_delimited"] = f"""WITH {CUST}
SELECT id, firstName, lastName, email, address, level FROM cust"""
    q["topic_sample"] = f"""WITH {ORD}
SELECT id, customerId, state, product, quantity, price, ts, seq FROM ord ORDER BY seq LIMIT 5"""
    q["submit_orders"] = f"""WITH {ORD}
SELECT id, '{S.ORDER_LOCATION_PREFIX}' || id AS location FROM ord"""
    # outcomes of the channel: the last writer of an order wins
    channel = f"""WITH {VALS}, {VORD},
{pass_counts_cte('vals', S.VALIDATION_SESSION_GAP, 3)},
{validated_cte('vord', S.VALIDATION_JOIN_WINDOW, 3)},
{failed_cte('vals', 'vord', S.VALIDATION_JOIN_WINDOW)},
ch AS (SELECT {ORDER_COLS}, 0 AS s FROM vord UNION ALL SELECT {ORDER_COLS}, 1 FROM okv
  UNION ALL SELECT {ORDER_COLS}, 2 FROM bad),
cl AS (SELECT {ORDER_COLS} FROM ch QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC) = 1)"""
    q["orders_channel_latest"] = f"{channel}\nSELECT {ORDER_COLS} FROM cl"
    q["orders_channel_lookup"] = f"""{channel},
asked AS (SELECT id FROM cl UNION ALL SELECT 'no-' || id FROM cl)
SELECT a.id, coalesce(cl.state IN ('VALIDATED', 'FAILED'), false) AS answered,
  CASE WHEN cl.state IN ('VALIDATED', 'FAILED') THEN cl.state END AS state,
  CASE WHEN cl.state IN ('VALIDATED', 'FAILED') THEN CAST(cl.customerId AS VARCHAR) END AS customerId
FROM asked a LEFT JOIN cl ON a.id = cl.id"""
    q["orders_enriched_sql_changelog"] = f"""WITH {ORD}, {CUST},
cl AS (SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN 'platinum' ELSE level END AS level) FROM cust)
SELECT c.id AS customerId, c.firstName, c.lastName, c.level, o.product, o.quantity, o.price
FROM ord o JOIN cl c ON o.customerId = c.id"""
    q["orders_with_position"] = """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'orders.parquet' AS source_file,
  row_number() OVER () - 1 AS source_offset FROM orders"""
    return q
