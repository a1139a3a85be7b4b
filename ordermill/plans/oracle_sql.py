"""DuckDB SQL for every registered query (the correctness oracle).

The SQL reads the same test tables (pre-registered as views) and states each
model, merge, report and check in plain SQL with its own column lists, text
patterns, error texts and check order; only the run parameters (clocks,
cutoffs, window) are shared with the code under test.
"""

from __future__ import annotations

from ordermill.plans.model import (AS_OF, BATCH_RUN_CLOCK, DEDUP_WINDOW_S, EVENTS_FIRST_RUN,
                                   FIRST_LOAD_CUTOFF, FIRST_RUN_CLOCK, LATENESS_S, WINDOW_S)

# The order contract as the SQL states it.
ORDER_COLUMNS = ("order_id customer_id product_id region_id campaign_id order_date quantity unit_price discount "
                 "shipping_cost payment_method delivery_days returned_flag order_status warehouse_region "
                 "customer_rating customer_city customer_state").split()
STG_ORDER_COLUMNS = ORDER_COLUMNS + ["source_system", "loaded_at"]
ORDER_TRIMMED = "payment_method order_status warehouse_region customer_city customer_state".split()
# Numbers in the order they are checked, with their kind.
NUMBERS = {"customer_id": "integer", "product_id": "integer", "region_id": "integer", "campaign_id": "whole",
           "quantity": "integer", "unit_price": "number", "discount": "number", "shipping_cost": "number",
           "delivery_days": "integer", "returned_flag": "integer", "customer_rating": "integer"}
DIGITS = "[0-9]+(_[0-9]+)*"
INTEGER = rf"^\s*[-+]?{DIGITS}\s*$"
NUMBER = rf"^\s*[-+]?({DIGITS}(\.({DIGITS})?)?|\.{DIGITS})([eE][-+]?{DIGITS})?\s*$"
NOT_FINITE = r"^\s*[-+]?(inf|infinity|nan)\s*$"
DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
EVENT_TIME = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\.[0-9]{1,6}Z$"
# Stand-in lists.
HUBS = ["North Hub", "South Hub", "East Hub", "West Hub"]
CAMPAIGN_LIST = [(i, f"Campaign {i}", ["Low", "Medium", "High"][i % 3]) for i in range(1, 10)]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ts(v) -> str:
    return f"TIMESTAMP '{v.isoformat(sep=' ')}'"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


_X = "(CAST(quantity AS DOUBLE) * unit_price * (1.0::DOUBLE - discount / 100.0::DOUBLE))"
REVENUE = f"CASE WHEN abs({_X}) < 1e13 THEN sign({_X}) * floor(abs({_X}) * 100 + 0.5) / 100 ELSE {_X} END"


P70 = f"CAST({2 ** 70} AS HUGEINT)"


def _exact(c: str, k: int, n: str) -> str:
    """round(sum / n, k) over the exact sum: whole parts and 2^-70ths add up as integers
    (enough for values of at least 2^-18, or 0), NaN and the infinities apart."""
    i = f"SUM(CASE WHEN isfinite({c}) THEN CAST(trunc({c}) AS HUGEINT) END)"
    f = f"SUM(CASE WHEN isfinite({c}) THEN CAST(({c} - trunc({c})) * {2.0 ** 70!r} AS HUGEINT) END)"
    bad = f"""CASE WHEN bool_or(isnan({c})) OR (bool_or({c} = 'inf'::DOUBLE) AND bool_or({c} = '-inf'::DOUBLE)) THEN 'nan'::DOUBLE
      WHEN bool_or({c} = 'inf'::DOUBLE) THEN 'inf'::DOUBLE WHEN bool_or({c} = '-inf'::DOUBLE) THEN '-inf'::DOUBLE END"""
    sums = f"{{'i': {i}, 'f': {f}, 'n': CAST({n} AS HUGEINT), 'bad': {bad}}}"
    rest = f"((x.f % {P70} + {P70}) % {P70})"
    floor = f"(x.i + (x.f - {rest}) // {P70})"
    size = (f"{{'a': CASE WHEN x.w >= 0 THEN x.w WHEN x.r > 0 THEN -x.w - 1 ELSE -x.w END, "
            f"'b': CASE WHEN x.w >= 0 OR x.r = 0 THEN x.r ELSE {P70} - x.r END, 'n': x.n, 'minus': x.w < 0}}")
    two = 2 * 10 ** k
    units = f"((x.a * {two} + x.n + (x.b * {two}) // {P70}) // (2 * x.n))"
    top = "(x.a // x.n)"
    more = "(x.a % x.n <> 0 OR x.b > 0)"
    big = "CASE " + " ".join(
        f"WHEN {top} < CAST({2 ** (61 + d)} AS HUGEINT) THEN CAST(CAST(2 * ({top} // {2 ** d}) + CAST({more} "
        f"OR {top} % {2 ** d} <> 0 AS INT) AS BIGINT) AS DOUBLE) * {2 ** d} / 2" for d in (0, 8, 16, 24)) + " END"
    value = (f"CASE WHEN {top} >= CAST({2 ** 54} AS HUGEINT) THEN {big} "
             f"ELSE CAST({units} // {10 ** k} || '.' || lpad(CAST({units} % {10 ** k} AS VARCHAR), {k}, '0') AS DOUBLE) END")

    def bind(of: str, use: str) -> str:
        return f"list_transform([{of}], lambda x: {use})[1]"
    signed = bind(size, f"CASE WHEN x.minus THEN -({value}) ELSE {value} END")
    whole = bind(f"{{'w': {floor}, 'r': {rest}, 'n': x.n}}", signed)
    return bind(sums, f"CASE WHEN x.bad IS NOT NULL THEN x.bad WHEN x.n > 0 AND x.i IS NOT NULL THEN {whole} END")


def sum_exact(c: str, k: int = 2) -> str:
    return _exact(c, k, "CASE WHEN COUNT(" + c + ") > 0 THEN 1 END")


def avg_exact(c: str, k: int) -> str:
    return _exact(c, k, f"COUNT({c})")


def round_div(num: str, den: str) -> str:
    n, d = f"({num})", f"NULLIF({den}, 0)"
    return (f"(CASE WHEN {n} >= 0 THEN (2 * {n} + {d}) // (2 * {d}) "
            f"ELSE -((-2 * {n} + {d}) // (2 * {d})) END)")


def ratio_round(num: str, den: str, k: int, factor: int) -> str:
    n = f"CAST({num} AS HUGEINT) * {factor * 10 ** k}"
    return f"CAST({round_div(n, f'CAST({den} AS HUGEINT)')} AS DOUBLE) / {10 ** k}"


def strict_long(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {q(INTEGER)}) THEN TRY_CAST(replace({c}, '_', '') AS BIGINT) END"


def strict_double(c: str) -> str:
    return (f"CASE WHEN regexp_matches({c}, {q(NUMBER)}) OR regexp_matches({c}, {q(NOT_FINITE)}, 'i') "
            f"THEN TRY_CAST(replace({c}, '_', '') AS DOUBLE) END")


def lenient_long(c: str) -> str:
    return f"TRY_CAST(trunc({strict_double(c)}) AS BIGINT)"


def strict_date(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {q(DATE)}) THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) END"


def strict_event_ts(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {q(EVENT_TIME)}) THEN try_strptime({c}, '%Y-%m-%dT%H:%M:%S.%fZ') END"


TYPED = {"integer": strict_long, "whole": lenient_long, "number": strict_double}


def stg_orders(src: str, tag: str) -> str:
    cols = []
    for c in STG_ORDER_COLUMNS:
        if c == "source_system":
            cols.append(f"'{tag}' AS source_system")
        elif c == "loaded_at":
            cols.append("ingestion_timestamp AS loaded_at")
        elif c in ORDER_TRIMMED:
            cols.append(f"{trim(c)} AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM {src}"


def int_orders(batch: str, stream: str) -> str:
    rest = [c for c in STG_ORDER_COLUMNS if c not in ("order_id", "loaded_at", "source_system")]
    order = ", ".join(["loaded_at DESC NULLS LAST", "source_system"] + rest)
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id "
            f"ORDER BY {order}) AS _rn FROM (SELECT * FROM {batch} UNION ALL SELECT * FROM {stream})) "
            f"WHERE _rn = 1")


def fact(src: str) -> str:
    return (f"SELECT order_id, customer_id AS customer_key, product_id AS product_key, "
            f"campaign_id AS campaign_key, region_id, order_date, "
            f"strftime(order_date, '%d-%b-%Y') AS order_date_formatted, quantity, unit_price, "
            f"discount, shipping_cost, {REVENUE} AS revenue, payment_method, delivery_days, "
            f"returned_flag, order_status, warehouse_region, customer_rating, source_system, "
            f"loaded_at FROM {src}")


def validated(src: str, stream: bool) -> str:
    """Validation reason chain over text rows (mirrors the operator's order)."""
    texts = ORDER_COLUMNS + (["event_timestamp"] if stream else [])
    raw = "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in ORDER_COLUMNS) + ")"
    nulls = ", ".join(f"NULLIF({c}, '') AS {c}" for c in texts)
    typed = {c: TYPED[kind](c) for c, kind in NUMBERS.items()} | {"order_date": strict_date("order_date")}
    if stream:
        typed["event_timestamp"] = strict_event_ts("event_timestamp")
    # concat_ws skips nulls: the names of the missing fields, comma separated
    names = "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} IS NULL THEN {q(repr(c))} END"
                                           for c in ORDER_COLUMNS if c != "campaign_id") + ")"
    checks = [f"CASE WHEN {names} <> '' THEN 'missing required field(s): [' || {names} || ']' END"]
    for c, kind in NUMBERS.items():
        noun = "integer" if kind == "integer" else "number"
        checks.append(f"CASE WHEN {c} IS NOT NULL AND __t_{c} IS NULL THEN 'invalid {noun} for {c}' END")
        if c == "quantity":
            checks.append("CASE WHEN __t_quantity <= 0 THEN 'quantity must be positive' END")
    checks.append("CASE WHEN order_date IS NOT NULL AND __t_order_date IS NULL "
                  "THEN 'invalid order_date: expected %Y-%m-%d' END")
    if stream:
        checks.append("CASE WHEN __t_event_timestamp IS NULL "
                      "THEN 'invalid event_timestamp: expected %Y-%m-%dT%H:%M:%S.%fZ' END")
        lat = "(epoch_us(_arrival_ts) - epoch_us(__t_event_timestamp))"
        limit = WINDOW_S + LATENESS_S
        checks.append(f"CASE WHEN {lat} > {limit * 1_000_000} THEN 'event arrived too late to process: ' || "
                      f"CAST({lat} // 1000000 AS VARCHAR) || 's after event_timestamp, exceeds max allowed lateness "
                      f"of {limit}s (window={WINDOW_S}s + allowed_lateness={LATENESS_S}s) -- would otherwise be "
                      f"silently dropped by the window' END")
    typed_sql = ", ".join(f"{e} AS __t_{c}" for c, e in typed.items())
    return (f"SELECT *, COALESCE({', '.join(checks)}) AS error_reason FROM ("
            f"SELECT *, {typed_sql} FROM (SELECT * REPLACE ({nulls}) FROM ("
            f"SELECT *, {raw} AS raw_row FROM {src}) a) b) c")


def good_batch(src: str, clock) -> str:
    typed = {c: f"__t_{c}" for c in [*NUMBERS, "order_date"]}
    cols = [f"{typed.get(c, c)} AS {c}" for c in ORDER_COLUMNS]
    return f"SELECT {', '.join(cols)}, 'batch' AS source_system, {ts(clock)} AS ingestion_timestamp FROM {src}"


def error_rows(src: str, source: str, clock_sql: str) -> str:
    raw = "substring(raw_row, 1, 2000)" if source == "stream" else "raw_row"
    return (f"SELECT md5(raw_row) AS error_id, {raw} AS raw_row, substring(error_reason, 1, 500) "
            f"AS error_reason, '{source}' AS source_system, {clock_sql} AS logged_at FROM {src} "
            f"WHERE error_reason IS NOT NULL")


HUB_LIST = "[" + ", ".join(q(h) for h in HUBS) + "]"
CAMPAIGN_VALUES = ", ".join(f"({i}, {q(n)}, {q(p)})" for i, n, p in CAMPAIGN_LIST)

EV_TEXT = f"""SELECT CAST(user_id % 10 AS VARCHAR) || '-' || event_type AS order_id,
  CAST(user_id AS VARCHAR) AS customer_id, CAST(event_id AS VARCHAR) AS product_id,
  CAST(user_id % 25 AS VARCHAR) AS region_id,
  CASE WHEN event_id % 10 <> 0 THEN CAST(event_id % 10 AS VARCHAR) || '.0' END AS campaign_id,
  strftime(ts, '%Y-%-m-%-d') AS order_date,
  CASE WHEN event_id % 97 = 0 THEN 'N/A' WHEN event_id % 101 = 0 THEN '0'
       ELSE CAST(event_id % 5 + 1 AS VARCHAR) END AS quantity,
  CAST(event_id % 900 + 100 AS VARCHAR) || '.' || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') AS unit_price,
  CAST(event_id % 11 AS VARCHAR) AS discount,
  CAST(user_id % 50 AS VARCHAR) || '.5' AS shipping_cost,
  ' ' || event_type || ' ' AS payment_method,
  CAST(event_id % 7 + 1 AS VARCHAR) AS delivery_days,
  CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS returned_flag,
  CASE WHEN event_type = 'error' THEN 'Returned' ELSE 'Delivered' END AS order_status,
  {HUB_LIST}[user_id % 4 + 1] AS warehouse_region,
  CAST(event_id % 5 + 1 AS VARCHAR) AS customer_rating,
  'City-' || CAST(user_id % 30 AS VARCHAR) AS customer_city,
  'State-' || CAST(user_id % 8 AS VARCHAR) AS customer_state,
  event_id AS _pos, CAST(ts AS TIMESTAMP) AS _event_ts,
  CAST(ts AS TIMESTAMP) + to_seconds((event_id * 37) % 600) AS _arrival_ts,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp
FROM events"""

CTES = {
    "raw_orders_all": """SELECT 'ORD' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
  CAST(o.o_custkey AS BIGINT) AS customer_id, CAST(l.l_partkey AS BIGINT) AS product_id,
  CAST(c.c_nationkey AS BIGINT) AS region_id,
  CAST(CASE WHEN l.l_suppkey % 10 <> 0 THEN l.l_suppkey % 10 END AS BIGINT) AS campaign_id,
  CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_quantity AS BIGINT) AS quantity,
  l.l_extendedprice AS unit_price, round(l.l_discount * 100) AS discount,
  round(l.l_tax * 100, 2) AS shipping_cost, ' ' || o.o_orderpriority || ' ' AS payment_method,
  CAST(l.l_linenumber % 7 + 1 AS BIGINT) AS delivery_days,
  CAST(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS returned_flag,
  o.o_orderstatus AS order_status, r.r_name AS warehouse_region,
  CAST(l.l_linenumber % 5 + 1 AS BIGINT) AS customer_rating, n.n_name AS customer_city,
  r.r_name AS customer_state,
  CASE WHEN l.l_linestatus = 'F' THEN 'batch' ELSE 'stream' END AS source_system,
  CAST(l.l_shipdate AS TIMESTAMP) + to_seconds(l.l_suppkey) AS event_timestamp,
  CAST(l.l_shipdate AS TIMESTAMP) + to_seconds(l.l_suppkey) + to_microseconds(l.l_partkey) AS ingestion_timestamp,
  l.l_linestatus AS _linestatus
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "raw_orders_batch": "SELECT * EXCLUDE (event_timestamp, _linestatus) FROM raw_orders_all WHERE _linestatus = 'F'",
    "raw_orders_stream": "SELECT * EXCLUDE (_linestatus) FROM raw_orders_all WHERE _linestatus = 'O'",
    "stg_batch": stg_orders("raw_orders_batch", "batch"),
    "stg_stream": stg_orders("raw_orders_stream", "stream"),
    "int_orders": int_orders("stg_batch", "stg_stream"),
    "fact": fact("int_orders"),
    "first_batch": stg_orders(f"(SELECT * FROM raw_orders_batch WHERE ingestion_timestamp < {ts(FIRST_LOAD_CUTOFF)})", "batch"),
    "first_stream": stg_orders(f"(SELECT * FROM raw_orders_stream WHERE ingestion_timestamp < {ts(FIRST_LOAD_CUTOFF)})", "stream"),
    "first_fact": fact(f"({int_orders('first_batch', 'first_stream')})"),
    "inc_new": "SELECT * FROM fact WHERE loaded_at > (SELECT max(loaded_at) FROM first_fact)",
    "raw_customers": """SELECT CAST(c.c_custkey AS BIGINT) AS customer_id, ' ' || c.c_name || ' ' AS customer_name,
  CAST(NULL AS VARCHAR) AS age_group, CAST(NULL AS VARCHAR) AS gender, n.n_name AS city, r.r_name AS state,
  c.c_mktsegment AS membership_type, CAST(NULL AS VARCHAR) AS customer_segment,
  CAST(NULL AS VARCHAR) AS annual_income_group, CAST(NULL AS DATE) AS signup_date,
  CAST(NULL AS TIMESTAMP) AS ingestion_timestamp
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "stg_customers": f"""SELECT customer_id, {trim('customer_name')} AS customer_name, age_group, gender,
  {trim('city')} AS city, {trim('state')} AS state, membership_type, customer_segment, annual_income_group,
  signup_date FROM raw_customers""",
    "dim_customer": """SELECT customer_id AS customer_key, customer_name, age_group, gender, city, state,
  membership_type, customer_segment, annual_income_group, signup_date FROM stg_customers""",
    "raw_products": """SELECT CAST(p_partkey AS BIGINT) AS product_id, p_type AS category,
  CAST(p_size AS VARCHAR) AS subcategory, p_brand AS brand, CAST(NULL AS VARCHAR) AS season_tag,
  p_retailprice AS mrp, CAST(NULL AS DOUBLE) AS profit_margin_pct, CAST(NULL AS VARCHAR) AS supplier_name,
  CAST(NULL AS BIGINT) AS stock_level, CAST(NULL AS TIMESTAMP) AS ingestion_timestamp FROM part""",
    "stg_products": f"""SELECT product_id, {trim('category')} AS category, {trim('subcategory')} AS subcategory,
  {trim('brand')} AS brand, season_tag, mrp AS list_price, profit_margin_pct,
  {trim('supplier_name')} AS supplier_name, stock_level FROM raw_products""",
    "dim_product": """SELECT product_id AS product_key, category, subcategory, brand, season_tag, list_price,
  profit_margin_pct, supplier_name, stock_level FROM stg_products""",
    "campaign_list": f"SELECT * FROM (VALUES {CAMPAIGN_VALUES}) v(campaign_id, campaign_name, expected_performance)",
    "raw_campaigns": """SELECT i.campaign_id, ' ' || l.campaign_name AS campaign_name, l.expected_performance,
  CAST(NULL AS TIMESTAMP) AS ingestion_timestamp
FROM (SELECT DISTINCT CAST(s_suppkey % 10 AS BIGINT) AS campaign_id FROM supplier WHERE s_suppkey % 10 <> 0) i
LEFT JOIN campaign_list l ON i.campaign_id = l.campaign_id""",
    "stg_campaigns": f"SELECT campaign_id, {trim('campaign_name')} AS campaign_name, expected_performance FROM raw_campaigns",
    "dim_campaign": "SELECT campaign_id AS campaign_key, campaign_name, expected_performance FROM stg_campaigns",
    "date_bounds": "SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders",
    "date_spine": """SELECT CAST(d AS DATE) AS full_date FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP),
  CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM date_bounds)""",
    "dim_date": """SELECT full_date AS date_key, CAST(year(full_date) AS BIGINT) AS year,
  CAST(month(full_date) AS BIGINT) AS month, CAST(day(full_date) AS BIGINT) AS day,
  CAST(quarter(full_date) AS BIGINT) AS quarter, CAST(dayofweek(full_date) + 1 AS BIGINT) AS day_of_week,
  dayname(full_date) AS day_name, monthname(full_date) AS month_name FROM date_spine""",
    "ev_text": EV_TEXT,
    "v_batch": validated("ev_text", stream=False),
    "v_stream": validated("ev_text", stream=True),
    "batch_errors": error_rows("v_batch", "batch", ts(BATCH_RUN_CLOCK)),
    "stream_errors": error_rows("v_stream", "stream", "_arrival_ts"),
    "stream_error_ids": """SELECT DISTINCT order_id FROM v_stream WHERE error_reason IS NOT NULL
  AND order_id IS NOT NULL AND order_id <> ''""",
    "fact_p": "SELECT f.*, p.category FROM fact f JOIN dim_product p ON f.product_key = p.product_key",
}


def with_ctes(body: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in CTES.items()) + "\n" + body


def _latest(where: str) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id "
            f"ORDER BY ingestion_timestamp DESC) AS _rn FROM raw_orders_batch WHERE {where}) WHERE _rn = 1")


def _counts(parts: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(f"SELECT {q(n)} AS table_name, COUNT(*) AS row_count FROM {t}" for n, t in parts)


# Keys of the star schema, what must not be null, and what points where.
STAR_KEYS = {"fact_orders": "order_id", "dim_customer": "customer_key", "dim_product": "product_key",
             "dim_campaign": "campaign_key", "dim_date": "date_key"}
NOT_NULL = [*STAR_KEYS.items(), ("fact_orders", "customer_key"), ("fact_orders", "product_key"),
            ("fact_orders", "revenue")]
POINTERS = {"customer_key": "dim_customer", "product_key": "dim_product", "campaign_key": "dim_campaign"}


def _quality(names: dict) -> str:
    """The suite over the tables or CTEs that ``names`` gives for the models."""
    def part(table, col, test, body):
        return f"SELECT '{table}' AS table_name, '{col}' AS column_name, '{test}' AS test, COUNT(*) AS failures FROM {body}"
    parts = [part(t, c, "not_null", f"{names[t]} WHERE {c} IS NULL") for t, c in NOT_NULL]
    parts += [part(t, c, "unique", f"(SELECT {c} FROM {names[t]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")
              for t, c in STAR_KEYS.items()]
    parts += [part("fact_orders", c, "relationships", f"{names['fact_orders']} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {names[d]} y WHERE y.{c} = x.{c})") for c, d in POINTERS.items()]
    return "\nUNION ALL\n".join(parts)


def _broken(table: str, key: str, null_at: str, twice_at: str) -> str:
    once = f"SELECT {key} FROM {table}"
    return (f"SELECT CASE WHEN NOT ({null_at}) THEN {key} END AS {key} FROM "
            f"({once} UNION ALL {once} WHERE {twice_at})")


BROKEN = {
    "b_fact": """SELECT CASE WHEN product_key % 101 <> 0 THEN order_id END AS order_id,
  CASE product_key % 103 WHEN 1 THEN NULL WHEN 2 THEN customer_key + 1000000000000 ELSE customer_key END AS customer_key,
  CASE customer_key % 107 WHEN 3 THEN NULL WHEN 4 THEN -product_key ELSE product_key END AS product_key,
  CASE WHEN product_key % 109 = 5 THEN 99 ELSE campaign_key END AS campaign_key,
  CASE WHEN customer_key % 113 <> 6 THEN revenue END AS revenue
FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE product_key % 127 = 7)""",
    "b_customer": _broken("dim_customer", "customer_key", "customer_key % 131 = 1", "customer_key % 137 = 2"),
    "b_product": _broken("dim_product", "product_key", "product_key % 131 = 1", "product_key % 137 = 2"),
    "b_campaign": _broken("dim_campaign", "campaign_key", "campaign_key = 5", "campaign_key = 3"),
    "b_date": _broken("dim_date", "date_key", "day(date_key) = 31", "day(date_key) = 29"),
}

FAULTY_TEXT = """SELECT * REPLACE (
  CASE WHEN _pos % 13 = 1 THEN '' ELSE order_id END AS order_id,
  CASE WHEN _pos % 13 = 1 THEN '' WHEN _pos % 17 <> 2 THEN customer_id END AS customer_id,
  CASE WHEN _pos % 19 = 3 THEN '2024-02-30' WHEN _pos % 23 = 4 THEN '30/05/2024' ELSE order_date END AS order_date,
  CASE WHEN _pos % 29 = 5 THEN '12,5' WHEN _pos % 31 = 6 THEN '1_000.5e0' ELSE unit_price END AS unit_price,
  CASE WHEN _pos % 37 = 7 THEN 'x' ELSE campaign_id END AS campaign_id,
  CASE WHEN _pos % 41 = 8 THEN '4.5' ELSE customer_rating END AS customer_rating,
  CASE WHEN _pos % 43 = 9 THEN repeat('long ', 500) ELSE customer_city END AS customer_city,
  CASE WHEN _pos % 43 = 9 THEN '-1' WHEN _pos % 47 = 10 THEN ' +1_0 ' WHEN _pos % 53 = 11 THEN '1__0'
       ELSE quantity END AS quantity) FROM ev_text"""
WIDE = """SELECT * REPLACE (discount + CASE WHEN product_id % 50 = 7 THEN CAST(0.123456 AS DOUBLE)
  WHEN product_id % 97 = 11 THEN CAST(1000.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS discount) FROM int_orders"""
ODD_PRICES = """SELECT * REPLACE (CASE
  WHEN warehouse_region = 'AMERICA' AND product_id % 20 = 3 THEN CAST(1e18 AS DOUBLE)
  WHEN warehouse_region = 'AMERICA' AND product_id % 20 = 4 THEN CAST(-1e18 AS DOUBLE)
  WHEN warehouse_region = 'AFRICA' AND product_id % 100 = 5 THEN CAST(1e13 AS DOUBLE)
  WHEN warehouse_region = 'ASIA' AND product_id % 50 = 7 THEN CAST('nan' AS DOUBLE)
  WHEN warehouse_region IN ('EUROPE', 'ASIA') AND product_id % 50 = 9 THEN CAST('inf' AS DOUBLE)
  WHEN warehouse_region = 'MIDDLE EAST' AND product_id % 50 = 11 THEN CAST('-inf' AS DOUBLE)
  WHEN warehouse_region = 'MIDDLE EAST' AND customer_id % 2 = 0 AND product_id % 50 = 12 THEN CAST('inf' AS DOUBLE)
  ELSE unit_price END AS unit_price) FROM int_orders"""
MANY_IDS = "SELECT * REPLACE (order_id || '-' || CAST(_pos % 500 AS VARCHAR) AS order_id) FROM ev_text"


def whole(c: str) -> str:
    """Integer text, or a float that is a whole number."""
    d = strict_double(c)
    return f"COALESCE({strict_long(c)}, CASE WHEN {d} = floor({d}) THEN TRY_CAST({d} AS BIGINT) END)"


def _products(key: str) -> str:
    """Coerced product text rows under a rule for the text of the key."""
    return f"""SELECT * FROM (SELECT {whole('product_id')} AS product_id,
  category, subcategory, brand, season_tag, {strict_double('mrp')} AS mrp,
  {strict_double('profit_margin_pct')} AS profit_margin_pct, supplier_name, {whole('stock_level')} AS stock_level
FROM (SELECT CASE WHEN p_partkey % 199 = 7 THEN '' ELSE {key} END AS product_id,
  p_type AS category, CAST(p_size AS VARCHAR) AS subcategory, p_brand AS brand, CAST(NULL AS VARCHAR) AS season_tag,
  CASE WHEN p_partkey % 50 = 3 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS mrp,
  CAST(p_size AS VARCHAR) || '.5' AS profit_margin_pct, CAST(NULL AS VARCHAR) AS supplier_name,
  CASE WHEN p_partkey % 31 = 0 THEN 'many' ELSE CAST(p_partkey % 500 AS VARCHAR) END AS stock_level
FROM part) p) WHERE product_id IS NOT NULL"""


_AS_OF = f"DATE '{AS_OF.isoformat()}'"
_GOOD_BATCH = good_batch("v_batch WHERE error_reason IS NULL", BATCH_RUN_CLOCK)

def _sales_summary(fact_p: str) -> str:
    return f"""SELECT category, warehouse_region, COUNT(DISTINCT order_id) AS total_orders,
  {sum_exact('revenue')} AS total_revenue, {avg_exact('revenue', 2)} AS avg_order_value,
  {ratio_round('SUM(returned_flag)', 'COUNT(*)', 2, 100)} AS return_rate_pct,
  {ratio_round('SUM(delivery_days)', 'COUNT(delivery_days)', 1, 1)} AS avg_delivery_days
FROM {fact_p} GROUP BY category, warehouse_region"""


def _over_time(fact: str) -> str:
    return f"""SELECT order_date, COUNT(DISTINCT order_id) AS order_count,
  {sum_exact('revenue')} AS total_revenue FROM {fact} GROUP BY order_date"""


BODIES = {
    "stg_orders_batch": "SELECT * FROM stg_batch",
    "stg_orders_stream": "SELECT * FROM stg_stream",
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_products": "SELECT * FROM stg_products",
    "stg_campaigns": "SELECT * FROM stg_campaigns",
    "int_orders_unioned": "SELECT * FROM int_orders",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": "SELECT * FROM dim_product",
    "dim_campaign": "SELECT * FROM dim_campaign",
    "dim_date": "SELECT * FROM dim_date",
    "fact_orders": "SELECT * FROM fact",
    "fact_orders_incremental": """SELECT * FROM first_fact f WHERE NOT EXISTS
  (SELECT 1 FROM inc_new n WHERE n.order_id = f.order_id)
UNION ALL SELECT * FROM inc_new""",
    "rpt_sales_summary": _sales_summary("fact_p"),
    "revenue_by_category_90d": f"""SELECT category, COUNT(DISTINCT order_id) AS order_count,
  {sum_exact('revenue')} AS total_revenue FROM fact_p
WHERE order_date >= CAST({_AS_OF} - INTERVAL 90 DAY AS DATE) GROUP BY category ORDER BY total_revenue DESC""",
    "top_customers": f"""SELECT c.customer_name, c.membership_type, COUNT(DISTINCT f.order_id) AS order_count,
  {sum_exact('f.revenue')} AS lifetime_revenue
FROM fact f JOIN dim_customer c ON f.customer_key = c.customer_key
GROUP BY c.customer_name, c.membership_type
ORDER BY lifetime_revenue DESC, c.customer_name, c.membership_type LIMIT 10""",
    "campaign_effectiveness": f"""SELECT COALESCE(c.campaign_name, 'No Campaign (Organic)') AS campaign_name,
  COUNT(DISTINCT f.order_id) AS order_count, {sum_exact('f.revenue')} AS total_revenue,
  {avg_exact('f.discount', 2)} AS avg_discount_pct
FROM fact f LEFT JOIN dim_campaign c ON f.campaign_key = c.campaign_key
GROUP BY COALESCE(c.campaign_name, 'No Campaign (Organic)') ORDER BY total_revenue DESC""",
    "return_rate_by_region": f"""SELECT warehouse_region, COUNT(*) AS total_orders,
  CAST(SUM(returned_flag) AS BIGINT) AS returned_orders,
  {ratio_round('SUM(returned_flag)', 'COUNT(*)', 2, 100)} AS return_rate_pct
FROM fact GROUP BY warehouse_region ORDER BY return_rate_pct DESC""",
    "source_volume": f"""SELECT source_system, COUNT(*) AS order_count, {sum_exact('revenue')} AS total_revenue
FROM fact GROUP BY source_system""",
    "kpi_scorecard": f"""SELECT {sum_exact('revenue')} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders,
  {ratio_round('SUM(delivery_days)', 'COUNT(delivery_days)', 1, 1)} AS avg_delivery_days, {avg_exact('revenue', 2)} AS avg_order_value FROM fact_p""",
    "revenue_over_time": _over_time("fact"),
    "orders_by_category": "SELECT category, COUNT(DISTINCT order_id) AS total_orders FROM fact_p GROUP BY category",
    "revenue_by_category": f"""SELECT category, COUNT(DISTINCT order_id) AS order_count,
  {sum_exact('revenue')} AS total_revenue FROM fact_p GROUP BY category""",
    "table_counts": _counts([("orders_batch", "raw_orders_batch"), ("orders_stream", "raw_orders_stream"),
                             ("orders_batch_errors", "batch_errors"), ("orders_stream_errors", "stream_errors"),
                             ("customers", "raw_customers"), ("products", "raw_products"),
                             ("campaigns", "raw_campaigns"), ("int_orders_unioned", "int_orders"),
                             ("fact_orders", "fact")]),
    "duplicate_order_ids": "SELECT order_id, COUNT(*) AS cnt FROM int_orders GROUP BY order_id HAVING COUNT(*) > 1",
    "duplicate_copies": """SELECT s.order_id, d.copies, s.ingestion_timestamp, s.event_timestamp
FROM raw_orders_stream s JOIN (SELECT order_id, COUNT(*) AS copies FROM raw_orders_stream
  GROUP BY order_id HAVING COUNT(*) > 1) d ON s.order_id = d.order_id""",
    "reconcile_stream": """SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id
  ORDER BY ingestion_timestamp) AS _rn FROM raw_orders_stream) WHERE _rn = 1""",
    "validate_good": _GOOD_BATCH,
    "validate_bad": "SELECT * FROM batch_errors",
    "validation_counts": """SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE error_reason IS NULL) AS good_rows,
  COUNT(*) FILTER (WHERE error_reason IS NOT NULL) AS bad_rows FROM v_batch""",
    "dedup_last_wins": good_batch("""(SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY order_id ORDER BY _pos DESC) AS _rn FROM v_batch WHERE error_reason IS NULL) WHERE _rn = 1)""",
                                  BATCH_RUN_CLOCK),
    "dedup_first_in_window": f"""SELECT order_id, window_start, window_start + to_seconds({DEDUP_WINDOW_S}) AS window_end,
  event_timestamp, ingestion_timestamp, customer_id, quantity, unit_price FROM (
  SELECT order_id, time_bucket(to_seconds({DEDUP_WINDOW_S}), __t_event_timestamp) AS window_start,
    __t_event_timestamp AS event_timestamp, _arrival_ts AS ingestion_timestamp,
    __t_customer_id AS customer_id, __t_quantity AS quantity, __t_unit_price AS unit_price,
    row_number() OVER (PARTITION BY time_bucket(to_seconds({DEDUP_WINDOW_S}), __t_event_timestamp), order_id
      ORDER BY _arrival_ts, _pos) AS _rn
  FROM v_stream WHERE error_reason IS NULL) WHERE _rn = 1""",
    "late_events": """SELECT order_id, __t_event_timestamp AS event_timestamp, _arrival_ts AS arrival_ts,
  (epoch_us(_arrival_ts) - epoch_us(__t_event_timestamp)) // 1000000 AS lateness_seconds, error_reason
FROM v_stream WHERE error_reason LIKE 'event arrived too late%'""",
    "upsert_orders": f"""WITH tgt AS ({_latest(f'ingestion_timestamp < {ts(FIRST_LOAD_CUTOFF)}')}),
src AS ({_latest(f'ingestion_timestamp >= {ts(FIRST_LOAD_CUTOFF)}')})
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.order_id = t.order_id)
UNION ALL SELECT * FROM src""",
    "insert_only_errors": f"""WITH first_run AS ({error_rows(f"(SELECT * FROM v_batch WHERE _event_ts < {ts(EVENTS_FIRST_RUN)})", "batch", ts(FIRST_RUN_CLOCK))}),
rerun AS ({error_rows("v_batch", "batch", ts(BATCH_RUN_CLOCK))})
SELECT * FROM first_run UNION ALL
SELECT * FROM rerun r WHERE NOT EXISTS (SELECT 1 FROM first_run f WHERE f.error_id = r.error_id)""",
    "replay_pending_ids": f"""SELECT r.order_id, r.ingestion_timestamp FROM raw_orders_stream r
WHERE NOT EXISTS (SELECT 1 FROM (SELECT order_id FROM raw_orders_stream
  WHERE ingestion_timestamp < {ts(FIRST_LOAD_CUTOFF)} UNION SELECT order_id FROM stream_error_ids) s
  WHERE s.order_id = r.order_id)""",
    "error_order_ids": "SELECT order_id FROM stream_error_ids",
    "row_policy_view": "SELECT * FROM fact WHERE warehouse_region = 'AMERICA'",
    "masked_view": "SELECT * REPLACE (CAST(NULL AS DOUBLE) AS revenue, CAST(NULL AS DOUBLE) AS unit_price) FROM fact",
    "row_and_mask_view": """SELECT * REPLACE (CAST(NULL AS DOUBLE) AS revenue, CAST(NULL AS DOUBLE) AS unit_price)
FROM fact WHERE warehouse_region = 'AMERICA'""",
    "coerce_dimension": _products("CAST(p_partkey AS VARCHAR)"),
    "quality_suite": _quality({t: t.replace("fact_orders", "fact") for t in STAR_KEYS}),
    "validate_faults": f"SELECT * FROM ({error_rows('v_faulty', 'stream', ts(BATCH_RUN_CLOCK))})",
    "validate_odd_good": good_batch("v_faulty WHERE error_reason IS NULL", BATCH_RUN_CLOCK),
    "duplicate_raw_order_ids": "SELECT order_id, COUNT(*) AS cnt FROM ev_text GROUP BY order_id HAVING COUNT(*) > 1",
    "replay_pending_events": f"""SELECT order_id, customer_id, _event_ts FROM v_many
WHERE order_id NOT IN (SELECT order_id FROM v_many WHERE error_reason IS NOT NULL
  OR __t_event_timestamp < {ts(EVENTS_FIRST_RUN)})""",
    "fact_wide_discounts": "SELECT * FROM wide_fact",
    "campaigns_wide_discounts": f"""SELECT COALESCE(c.campaign_name, 'No Campaign (Organic)') AS campaign_name,
  COUNT(DISTINCT f.order_id) AS order_count, {sum_exact('f.revenue')} AS total_revenue,
  {avg_exact('f.discount', 2)} AS avg_discount_pct
FROM wide_fact f LEFT JOIN dim_campaign c ON f.campaign_key = c.campaign_key GROUP BY 1""",
    "sales_summary_odd_prices": _sales_summary("(SELECT f.*, p.category FROM odd_fact f JOIN dim_product p USING (product_key))"),
    "revenue_over_time_odd_prices": _over_time("odd_fact"),
    "coerce_wide_keys": _products("""CASE WHEN p_partkey % 11 = 4 THEN CAST(p_partkey + 9007199254740992 AS VARCHAR)
  WHEN p_partkey % 13 = 5 THEN CAST(p_partkey AS VARCHAR) || '.0' ELSE CAST(p_partkey AS VARCHAR) END"""),
    "quality_suite_faults": _quality({"fact_orders": "b_fact", "dim_customer": "b_customer", "dim_product": "b_product",
                                      "dim_campaign": "b_campaign", "dim_date": "b_date"}),
}

CTES |= BROKEN | {
    "wide_orders": WIDE, "wide_fact": fact("wide_orders"),
    "odd_orders": ODD_PRICES, "odd_fact": fact("odd_orders"),
    "ev_faulty": FAULTY_TEXT, "v_faulty": validated("ev_faulty", stream=False),
    "ev_many": MANY_IDS, "v_many": validated("ev_many", stream=True),
}


def _compose(body: str) -> str:
    # A body that starts its own WITH gets the model CTEs prepended to it.
    if body.lstrip().upper().startswith("WITH "):
        return with_ctes("").rstrip() + ",\n" + body.lstrip()[5:]
    return with_ctes(body)


ORACLE_SQL = {name: _compose(body) for name, body in BODIES.items()}
