"""Independent SQL for every registered query, over the same wholesale tables.

Written from the metric definitions, not from the DataFrame code: money is
DECIMAL here and whole cents there, and rankings are plain windows here.
"""

from __future__ import annotations

# The retail tables as common table expressions.
_STAR = """
places AS (
  SELECT n_nationkey, n_name AS nation, r_name AS region
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'Customer' AS first_name, substr(c_name, 10) AS last_name,
    CASE WHEN c_custkey % 97 = 0 THEN concat('customer.', substr(c_name, 10))
         ELSE concat('customer.', substr(c_name, 10), '@example.com') END AS email,
    region, 'Synthetic' AS country, nation AS city,
    COALESCE((SELECT CAST(MIN(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey),
             DATE '1995-01-01') AS signup_date,
    c_mktsegment AS segment
  FROM customer LEFT JOIN places ON c_nationkey = n_nationkey),
part_cost AS (
  SELECT *, CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2))
    * CAST(0.60 + 0.05 * (p_size % 5) AS DECIMAL(4,2)), 2) AS DOUBLE) AS unit_cost FROM part),
prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
    concat(p_type, '-', CAST(p_size % 5 AS VARCHAR)) AS sub_category, unit_cost,
    p_retailprice AS unit_price, p_brand AS brand,
    CAST(ROUND(CAST((p_retailprice - unit_cost) / p_retailprice * 100 AS DECIMAL(28,10)), 2) AS DOUBLE) AS margin_pct,
    CAST(unit_cost AS DECIMAL(18,2)) AS cost
  FROM part_cost),
lines AS (
  SELECT *, CAST(l_discount AS DECIMAL(4,2)) * 3 AS cut,
    ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)) * 3), 2) AS exact_net
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN places ON c_nationkey = n_nationkey),
txn AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS transaction_id,
    CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
    CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
    CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice / l_quantity AS unit_price,
    CAST(cut AS DOUBLE) AS discount, CAST(exact_net AS DOUBLE) AS net_revenue, region,
    CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(exact_net AS DECIMAL(18,2)) AS net, CAST(cut AS DECIMAL(18,6)) AS cut,
    CAST(ceil(month(o_orderdate) / 3.0) AS INTEGER) AS quarter,
    strftime(o_orderdate, '%Y-%m') AS ym
  FROM lines),
tp AS (
  SELECT txn.*, prod.category, prod.sub_category, prod.product_name, prod.brand,
    txn.net - prod.cost * txn.quantity AS gp
  FROM txn JOIN prod USING (product_id))"""

_RAW = """
rawc AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, 'Customer' AS first_name, substr(c_name, 10) AS last_name,
    CASE WHEN c_custkey % 13 = 0 THEN 'NA'
      WHEN c_acctbal >= 0 THEN ' Customer.' || substr(c_name, 10) || '@Example.COM ' END AS email,
    ' ' || lower(region) || ' ' AS region, 'Synthetic' AS country, nation AS city,
    CASE o_orderpriority WHEN '5-LOW' THEN '2021-13-45' WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y/%m/%d')
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS signup_date,
    ' ' || c_mktsegment AS segment, o_orderkey AS seq,
    -- what cleaning must make of the texts
    CASE WHEN c_custkey % 13 <> 0 AND c_acctbal >= 0 THEN 'customer.' || substr(c_name, 10) || '@example.com' END AS mail,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS day
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN places ON c_nationkey = n_nationkey),
cleanc0 AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY seq) AS nth FROM rawc),
cleanc AS (
  SELECT customer_id, first_name, last_name, mail AS email,
    CASE trim(region) WHEN 'africa' THEN 'Africa' WHEN 'asia' THEN 'Asia' WHEN 'middle east' THEN 'Middle East'
      ELSE 'Unknown' END AS region,
    country, city, day AS signup_date,
    CASE WHEN trim(segment) IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') THEN trim(segment) ELSE 'BUILDING' END AS segment
  FROM cleanc0 WHERE nth = 1 AND mail IS NOT NULL AND day IS NOT NULL),
rawp AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_brand <> 'Brand#2' THEN p_name END AS product_name,
    p_type AS category, concat(p_type, '-', CAST(p_size % 5 AS VARCHAR)) AS sub_category,
    CASE p_size WHEN 1 THEN 'n/a' WHEN 3 THEN 'NaN'
      ELSE CAST(CAST(p_retailprice * 0.7 AS DECIMAL(18,2)) AS VARCHAR) END AS unit_cost,
    CASE p_size WHEN 2 THEN '0' WHEN 4 THEN 'NaN' WHEN 5 THEN 'about 900'
      ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
    p_brand AS brand, p_size
  FROM part),
nump AS (
  SELECT * EXCLUDE (p_size) REPLACE (CASE WHEN p_size NOT IN (1, 3) THEN CAST(unit_cost AS DOUBLE) END AS unit_cost,
    CASE WHEN p_size NOT IN (4, 5) THEN CAST(unit_price AS DOUBLE) END AS unit_price) FROM rawp),
pricedp AS (SELECT * FROM nump WHERE unit_price > 0 AND unit_cost > 0),
namedp AS (SELECT * FROM pricedp WHERE product_name IS NOT NULL),
capsp AS (SELECT quantile_cont(unit_cost, 0.999) AS cost_cap, quantile_cont(unit_price, 0.999) AS price_cap FROM namedp),
cappedp AS (
  SELECT * REPLACE (LEAST(unit_cost, cost_cap) AS unit_cost, LEAST(unit_price, price_cap) AS unit_price)
  FROM namedp CROSS JOIN capsp),
rawt AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(l_partkey AS VARCHAR) AS product_id,
    CASE o_orderpriority WHEN '5-LOW' THEN 'not a date' WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y/%m/%d')
      WHEN '2-HIGH' THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    CASE WHEN l_returnflag <> 'N' THEN strftime(l_shipdate, '%Y-%m-%d') END AS ship_date,
    CASE l_tax WHEN 0.07 THEN 'x' WHEN 0.06 THEN CAST(CAST(l_quantity AS INT) - 3 AS VARCHAR) || '.0'
      WHEN 0.05 THEN CAST(CAST(l_quantity AS INT) - 3 AS VARCHAR) || '.5' WHEN 0.04 THEN 'N/A'
      ELSE CAST(CAST(l_quantity AS INT) - 3 AS VARCHAR) END AS quantity,
    CAST(CAST(ROUND(CAST(l_extendedprice / l_quantity AS DECIMAL(28,10)), 2) AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
    CASE WHEN l_tax = 0.01 THEN 'NaN' WHEN l_tax = 0.02 THEN 'much'
      WHEN l_linestatus = 'F' THEN CAST(CAST(l_discount AS DECIMAL(4,2)) * 15 - 0.10 AS VARCHAR) END AS discount,
    region, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(month(o_orderdate) AS VARCHAR) AS month,
    l_partkey, l_suppkey, CAST(l_quantity AS INT) AS units,
    -- what cleaning must make of the texts
    CASE WHEN l_tax NOT IN (0.04, 0.05, 0.07) THEN CAST(l_quantity AS INT) - 3 END AS q,
    CAST(ROUND(CAST(l_extendedprice / l_quantity AS DECIMAL(28,10)), 2) AS DOUBLE) AS p,
    CASE WHEN l_tax NOT IN (0.01, 0.02) AND l_linestatus = 'F'
      THEN CAST(CAST(l_discount AS DECIMAL(4,2)) * 15 - 0.10 AS DOUBLE) END AS d,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS oday,
    CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS sday, l_tax AS tax
  FROM lines),
numt AS (SELECT * FROM rawt)"""


def _clean(source: str, order: str, ids: str = "transaction_id") -> str:
    """Transactions of ``source`` deduplicated by ``order`` and cleaned, before the reference checks."""
    return f"""(
  SELECT {ids} AS transaction_id, customer_id, product_id, oday AS order_date,
    CASE WHEN sday < oday THEN oday ELSE sday END AS ship_date,
    q AS quantity, p AS unit_price, CASE WHEN d IS NULL OR d < 0 THEN 0.0::DOUBLE WHEN d > 1 THEN 1.0::DOUBLE ELSE d END AS discount, region
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {ids} ORDER BY {order}) AS nth FROM {source})
  WHERE nth = 1 AND q > 0 AND p IS NOT NULL AND oday IS NOT NULL)"""


def _R(x: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _per(a: str, b: str, digits: int = 2) -> str:
    return _R(f"{_D(a)} / NULLIF({_D(b)}, 0)", digits)


def _pct(a: str, b: str, digits: int = 2) -> str:
    return _R(f"{_D(a)} / NULLIF({_D(b)}, 0) * 100", digits)


def _grow(cur: str, prev: str) -> str:
    return _pct(f"({cur} - {prev})", prev)


def _q(select: str, raw: bool = False, **ctes: str) -> str:
    parts = [_STAR] + ([_RAW] if raw else []) + [f"{n} AS ({b})" for n, b in ctes.items()]
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select.strip()


_REV, _GP = "SUM(net)", "SUM(gp)"
_ORD, _CUS = "COUNT(DISTINCT transaction_id)", "COUNT(DISTINCT customer_id)"
_MARGIN = _pct(_GP, _REV)
_DISC = _R("CAST(SUM(cut) AS DOUBLE) / NULLIF(COUNT(cut), 0) * 100")
_NET_TABLE = """transaction_id, customer_id, product_id, order_date, ship_date, quantity, unit_price, discount,
  net_revenue, region, year, month"""
_WITH_NET = f"""*, {_R('unit_price * quantity * (1 - discount)')} AS net_revenue,
  CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month"""
_ARRIVAL = "l_partkey, l_suppkey, units"
_CONTENT = ", ".join(
    f"{c} NULLS FIRST"
    for c in "customer_id product_id order_date ship_date quantity unit_price discount region year month".split()
)
_ASIA4 = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')"
_SEG3 = "('BUILDING', 'HOUSEHOLD', 'MACHINERY')"
_BUCKET = """CASE WHEN discount = 0 THEN '0% — No discount' WHEN discount <= 0.05 THEN '1–5%'
  WHEN discount <= 0.10 THEN '6–10%' WHEN discount <= 0.20 THEN '11–20%' ELSE '> 20%' END"""

_PER_CUSTOMER = """
  SELECT customer_id, SUM(net) AS rev, COUNT(*) AS n, COUNT(DISTINCT transaction_id) AS orders,
    MIN(order_date) AS first_order, MAX(order_date) AS last_order,
    date_diff('day', MIN(order_date), MAX(order_date)) AS span
  FROM txn GROUP BY customer_id"""
_LABEL = """CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
  WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
  WHEN r_score >= 4 AND f_score <= 2 THEN 'Recent Customers'
  WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'At Risk'
  WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost' ELSE 'Potential Loyalists' END"""
_RFM0 = """
  SELECT *, CAST(date_diff('day', last_order, (SELECT MAX(order_date) FROM txn)) AS INTEGER) AS recency_days,
    orders AS frequency, CAST(rev AS DOUBLE) AS monetary FROM pc"""


def _rfm(best_last: bool) -> dict[str, str]:
    worst, best = ("DESC", "ASC") if best_last else ("ASC", "DESC")
    return {
        "pc": _PER_CUSTOMER,
        "rfm0": _RFM0,
        "rfm1": f"""
  SELECT *, NTILE(5) OVER (ORDER BY recency_days {worst}, customer_id) AS r_score,
    NTILE(5) OVER (ORDER BY orders {best}, customer_id) AS f_score,
    NTILE(5) OVER (ORDER BY rev {best}, customer_id) AS m_score FROM rfm0""",
        "rfm": f"""
  SELECT customer_id, recency_days, frequency, monetary, rev, span, r_score, f_score, m_score,
    r_score + f_score + m_score AS rfm_total, {_LABEL} AS rfm_segment FROM rfm1""",
    }


_RFM_COLS = "recency_days, frequency, monetary, r_score, f_score, m_score, rfm_total, rfm_segment"


def _check(name: str, violations: str, label: str, source: str) -> str:
    return f"""SELECT '{name}' AS check_name, v = 0 AS passed, CAST(v AS BIGINT) AS violations,
  '{label}=' || CAST(v AS VARCHAR) AS details FROM (SELECT {violations} AS v FROM {source})"""


def _not_empty(t: str, source: str) -> str:
    return f"""SELECT '{t}: not empty' AS check_name, n > 0 AS passed, CAST(CASE WHEN n = 0 THEN 1 ELSE 0 END AS BIGINT)
  AS violations, 'rows=' || n AS details FROM (SELECT COUNT(*) AS n FROM {source})"""


def _nulls(t: str, c: str, source: str, limit: float = 0.0) -> str:
    return f"""SELECT '{t}.{c}: null rate ≤ {limit:.0%}' AS check_name, rate <= {limit} AS passed,
  CAST(CASE WHEN rate > {limit} THEN v ELSE 0 END AS BIGINT) AS violations,
  'null_rate=' || CAST(CAST(rate * 100 AS DECIMAL(9,4)) AS VARCHAR) || '%' AS details
  FROM (SELECT COUNT(*) - COUNT({c}) AS v, CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) AS rate FROM {source})"""


def _domain(t: str, c: str, valid: str, source: str) -> str:
    bad = f"COUNT(*) FILTER (WHERE {c} IS NULL OR {c} NOT IN {valid})"
    return _check(f"{t}.{c}: domain valid", bad, "invalid_count", source)


def _range(t: str, c: str, low: float | None, high: float | None, source: str) -> str:
    bad = [f"x < {low}"] * (low is not None) + [f"x > {high}"] * (high is not None) + ["x IS NULL"]
    inner = f"(SELECT TRY_CAST({c} AS DOUBLE) AS x FROM {source})"
    return _check(
        f"{t}.{c}: range [{low}, {high}]", f"COUNT(*) FILTER (WHERE {' OR '.join(bad)})", "violations", inner
    )


def _unique(t: str, c: str, source: str) -> str:
    return _check(f"{t}.{c}: unique", f"COUNT(*) - COUNT(DISTINCT {c})", "duplicates", source)


def _refer(t: str, c: str, parent: str, source: str, parent_source: str) -> str:
    return _check(
        f"{t}.{c} → {parent}: referential integrity",
        f"COUNT(*) FILTER (WHERE {c} IS NULL OR {c} NOT IN (SELECT {c} FROM {parent_source}))",
        "orphan_rows",
        source,
    )


def _dates(t: str, source: str) -> str:
    return _check(
        f"{t}: order_date ≤ ship_date", "COUNT(*) FILTER (WHERE ship_date < order_date)", "violations", source
    )


def _mean(t: str, c: str, low: float, high: float, source: str) -> str:
    return f"""SELECT '{t}.{c}: mean in [{low:.2f}, {high:.2f}]' AS check_name, m BETWEEN {low} AND {high} AS passed,
  CAST(CASE WHEN m BETWEEN {low} AND {high} THEN 0 ELSE 1 END AS BIGINT) AS violations,
  'mean=' || CAST(CAST(m AS DECIMAL(18,4)) AS VARCHAR) AS details
  FROM (SELECT CAST(SUM(CAST({c} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({c}) AS m FROM {source})"""


def _all(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


_CHECK_C = _all(
    _not_empty("customers", "cust"),
    *[_nulls("customers", c, "cust") for c in ("customer_id", "email", "region", "signup_date")],
    _domain("customers", "region", _ASIA4, "cust"),
    _domain("customers", "segment", _SEG3, "cust"),
    _unique("customers", "customer_id", "cust"),
)
_CHECK_P = _all(
    _not_empty("products", "prod"),
    *[_nulls("products", c, "prod") for c in ("product_id", "product_name", "category", "unit_price", "unit_cost")],
    _range("products", "unit_price", 0.01, None, "prod"),
    _range("products", "unit_cost", 0.01, None, "prod"),
    _range("products", "margin_pct", -10.0, 99.0, "prod"),
    _unique("products", "product_id", "prod"),
)
_CHECK_T = _all(
    _not_empty("transactions", "txn"),
    *[
        _nulls("transactions", c, "txn")
        for c in ("transaction_id", "customer_id", "product_id", "order_date", "quantity", "unit_price")
    ],
    _range("transactions", "quantity", 1, None, "txn"),
    _range("transactions", "unit_price", 0.01, None, "txn"),
    _range("transactions", "discount", 0.0, 1.0, "txn"),
    _range("transactions", "net_revenue", 0.0, None, "txn"),
    _domain("transactions", "region", _ASIA4, "txn"),
    _dates("transactions", "txn"),
    _mean("transactions", "discount", 0.0, 0.25, "txn"),
    _mean("transactions", "quantity", 1.0, 4.0, "txn"),
    _unique("transactions", "transaction_id", "txn"),
    _refer("transactions", "customer_id", "customers", "txn", "cust"),
    _refer("transactions", "product_id", "products", "txn", "prod"),
)


def _rows(*pairs: tuple[str, str, str]) -> str:
    """(check_name, violations) rows from (name, condition, source)."""
    return _all(
        *[
            f"SELECT '{n}' AS check_name, COUNT(*) FILTER (WHERE {cond}) AS violations FROM {source}"
            for n, cond, source in pairs
        ]
    )


def _profile(name: str, source: str, types: dict[str, str]) -> str:
    return _all(
        *[
            f"""SELECT '{name}' AS table_name, '{c}' AS "column", '{t}' AS dtype, COUNT(*) - COUNT({c}) AS null_count,
  {_R(f"CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) * 100")} AS null_pct,
  COUNT(DISTINCT {c}) AS "unique" FROM {source}"""
            for c, t in types.items()
        ]
    )


_M = "SELECT year, month, SUM(net) AS rev FROM txn GROUP BY year, month"
_MR = "SELECT year, month, region, SUM(net) AS rev FROM txn GROUP BY year, month, region"
_RY = "SELECT region, year, SUM(net) AS rev FROM txn GROUP BY region, year"
_QY = "SELECT year, quarter, SUM(net) AS rev FROM txn GROUP BY year, quarter"
_YM = "CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0')"
_ENDS = """
  SELECT region, MIN(year) AS first_year, MAX(year) AS last_year, arg_min(rev, year) AS a, arg_max(rev, year) AS b,
    MAX(year) - MIN(year) AS n_years FROM ry GROUP BY region"""
_CAGR = f"CASE WHEN n_years > 0 AND a > 0 AND b >= 0 THEN {_R('(pow(CAST(b AS DOUBLE) / CAST(a AS DOUBLE), 1.0 / n_years) - 1) * 100')} END"
_BAND = "CASE WHEN {x} > {high} THEN 'green' WHEN {x} >= {low} THEN 'amber' WHEN {x} < {low} THEN 'red' END"


def _long(*rows: tuple[str, str, str, str, str]) -> str:
    return _all(
        *[
            f"SELECT '{m}' AS metric, {k} AS key, CAST({v} AS DOUBLE) AS value, CAST({t} AS VARCHAR) AS text {rest}"
            for m, k, v, t, rest in rows
        ]
    )


_SOLD = """
  SELECT product_id, product_name, category, sub_category, brand, COUNT(DISTINCT transaction_id) AS orders,
    CAST(SUM(quantity) AS BIGINT) AS units, SUM(net) AS rev, SUM(gp) AS gp, SUM(cut) AS cut_sum, COUNT(cut) AS cut_n
  FROM tp GROUP BY ALL"""
_TOP = f"""
  SELECT *, RANK() OVER (ORDER BY rev DESC) AS revenue_rank,
    ROW_NUMBER() OVER (ORDER BY rev DESC, product_id) AS place FROM sold"""

ORACLE: dict[str, str] = {
    # sources, sinks, catalog
    "read_raw_csv": _q(
        "SELECT * REPLACE (CAST(signup_date AS VARCHAR) AS signup_date) FROM cust"
    ),
    "read_parquet_table": _q("SELECT * FROM cust"),
    "source_views": _q(
        "SELECT segment, category, COUNT(*) AS transactions FROM tp JOIN cust USING (customer_id) GROUP BY ALL"
    ),
    "write_parquet_table": _q("SELECT * EXCLUDE (cost) FROM prod"),
    "write_partitioned": _q(f"SELECT {_NET_TABLE} FROM txn"),
    "incremental_load": _q(
        f"SELECT {_NET_TABLE} FROM final",
        raw=True,
        keyed="SELECT * REPLACE (transaction_id || '-' || product_id AS transaction_id) FROM numt",
        shipped="SELECT * FROM keyed WHERE ship_date IS NOT NULL",
        b1=f"SELECT * FROM {_clean('shipped', _ARRIVAL)}",
        b2=f"SELECT * FROM {_clean('keyed', _ARRIVAL)}",
        loaded="SELECT * FROM b1 UNION ALL SELECT * FROM b2 WHERE transaction_id NOT IN (SELECT transaction_id FROM b1)",
        final=f"SELECT {_WITH_NET} FROM loaded",
    ),
    "incremental_stream": _q(
        f"SELECT {_NET_TABLE} FROM final",
        raw=True,
        b1=f"SELECT * FROM {_clean('numt', _CONTENT)}",
        final=f"SELECT {_WITH_NET} FROM b1",
    ),
    "create_database": _q(
        f"""SELECT region, {_D(_REV)} AS revenue, {_ORD} AS orders, {_CUS} AS customers,
  {_per(_REV, _ORD)} AS aov FROM txn GROUP BY region"""
    ),
    "create_external_tables": _q(
        _all(
            *[
                f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {c}"
                for t, c in (("customers", "cust"), ("products", "prod"), ("sales_transactions", "txn"))
            ]
        )
    ),
    "repair_partitions": _q("SELECT DISTINCT 'year=' || year || '/month=' || month AS partition FROM txn"),
    "row_level_filter": _q(
        f"""SELECT region, year, month, {_D(_REV)} AS monthly_revenue, {_ORD} AS orders FROM txn
WHERE region IN (SELECT region FROM places WHERE nation = 'NATION_3') GROUP BY region, year, month"""
    ),
    "scoped_filter": _q(
        f"""SELECT t.region, t.year, t.month, {_D('SUM(t.net)')} AS monthly_revenue,
  COUNT(DISTINCT t.transaction_id) AS orders
FROM tp t JOIN cust c ON t.customer_id = c.customer_id JOIN rfm ON rfm.customer_id = t.customer_id
WHERE t.year IN (1998, 1999, 2000) AND t.region IN ('ASIA', 'EUROPE') AND t.category IN ('PROMO', 'SMALL', 'LARGE')
  AND c.segment IN ('BUILDING', 'FURNITURE', 'MACHINERY') AND year(c.signup_date) = 1995
  AND rfm_segment IN ('Champions', 'Loyal Customers', 'Lost')
  AND t.order_date BETWEEN DATE '1998-03-01' AND DATE '2000-10-31'
GROUP BY t.region, t.year, t.month""",
        **_rfm(True),
    ),
    # cleaning
    "dedupe_by_key": _q(
        f"""SELECT transaction_id, product_id, quantity FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY transaction_id ORDER BY {_ARRIVAL}) AS nth FROM rawt) WHERE nth = 1""",
        raw=True,
    ),
    "drop_missing": _q("SELECT seq AS order_key, customer_id, email FROM rawc WHERE email IS NOT NULL", raw=True),
    "coerce_dates": _q(
        """SELECT transaction_id, product_id, oday AS order_date, sday AS ship_date FROM rawt
  WHERE oday IS NOT NULL""",
        raw=True,
    ),
    "coerce_numbers": _q(
        "SELECT transaction_id, product_id, p AS unit_price, d AS discount, q AS quantity FROM numt", raw=True
    ),
    "standardise_region": _q(
        """SELECT seq AS order_key, CASE trim(region) WHEN 'africa' THEN 'Africa' WHEN 'asia' THEN 'Asia'
  WHEN 'middle east' THEN 'Middle East' ELSE 'Unknown' END AS region FROM rawc""",
        raw=True,
    ),
    "standardise_segment": _q(
        f"""SELECT seq AS order_key, CASE WHEN trim(segment) IN {_SEG3} THEN trim(segment) ELSE 'BUILDING' END
  AS segment FROM rawc""",
        raw=True,
    ),
    "normalise_email": _q("SELECT seq AS order_key, lower(trim(email)) AS email FROM rawc", raw=True),
    "drop_bad_prices": _q("SELECT product_id, unit_cost, unit_price FROM pricedp", raw=True),
    "cap_outliers": _q(
        """SELECT product_id, round(LEAST(unit_cost, (SELECT quantile_cont(unit_cost, 0.999) FROM pricedp)), 6) AS unit_cost,
  round(LEAST(unit_price, (SELECT quantile_cont(unit_price, 0.999) FROM pricedp)), 6) AS unit_price FROM pricedp""",
        raw=True,
    ),
    "derive_margin_pct": _q("SELECT product_id, margin_pct FROM prod"),
    "drop_orphans": _q(
        "SELECT transaction_id, customer_id, product_id FROM txn WHERE quantity % 17 <> 0 AND quantity % 19 <> 0"
    ),
    "filter_positive_quantity": _q(
        "SELECT transaction_id, product_id, q AS quantity FROM numt WHERE q > 0", raw=True
    ),
    "clip_discount": _q(
        """SELECT transaction_id, product_id, CASE WHEN d IS NULL OR d < 0 THEN 0.0::DOUBLE WHEN d > 1 THEN 1.0::DOUBLE
  ELSE d END AS discount FROM numt""",
        raw=True,
    ),
    "fix_ship_date": _q(
        "SELECT transaction_id, order_date, GREATEST(ship_date, order_date) AS ship_date FROM txn"
    ),
    "derive_net_revenue": _q(
        f"SELECT transaction_id, {_R('unit_price * quantity * (1 - discount)')} AS net_revenue FROM txn"
    ),
    "derive_partitions": _q("SELECT transaction_id, year, month FROM txn"),
    "clean_customers": _q("SELECT * FROM cleanc", raw=True),
    "clean_products": _q(
        f"""SELECT product_id, product_name, category, sub_category, round(unit_cost, 6) AS unit_cost,
  round(unit_price, 6) AS unit_price, brand, {_R('(unit_price - unit_cost) / unit_price * 100')} AS margin_pct FROM cappedp""",
        raw=True,
    ),
    "clean_transactions": _q(
        f"""SELECT {_NET_TABLE} FROM final WHERE customer_id IN (SELECT customer_id FROM cleanc)
  AND product_id IN (SELECT product_id FROM cappedp)""",
        raw=True,
        b1=f"SELECT * FROM {_clean('numt', _ARRIVAL)}",
        final=f"SELECT {_WITH_NET} FROM b1",
    ),
    "cleaning_audit": _q(
        _all(
            *[
                f"SELECT '{t}' AS table_name, '{step}' AS step, {expr} AS rows FROM {source}"
                for t, step, expr, source in (
                    ("customers", "loaded", "COUNT(*)", "rawc"),
                    ("customers", "after_dedupe", "COUNT(*)", "c1"),
                    ("customers", "with_keys", "COUNT(email)", "c1"),
                    ("customers", "bad_signup_date", "COUNT(*) FILTER (WHERE email IS NOT NULL AND day IS NULL)", "c1"),
                    (
                        "customers",
                        "region_replaced",
                        "COUNT(*) FILTER (WHERE good AND trim(region) NOT IN ('africa', 'asia', 'middle east'))",
                        "c1",
                    ),
                    (
                        "customers",
                        "segment_replaced",
                        f"COUNT(*) FILTER (WHERE good AND trim(segment) NOT IN {_SEG3})",
                        "c1",
                    ),
                    ("customers", "final", "COUNT(*)", "cleanc"),
                    ("products", "loaded", "COUNT(*)", "rawp"),
                    ("products", "after_dedupe", "COUNT(*)", "rawp"),
                    ("products", "unreadable_unit_cost", "COUNT(*) FILTER (WHERE FALSE)", "rawp"),
                    ("products", "unreadable_unit_price", "COUNT(*) FILTER (WHERE p_size = 5)", "rawp"),
                    ("products", "with_keys", "COUNT(product_name)", "rawp"),
                    (
                        "products",
                        "bad_price",
                        "COUNT(product_name) - COUNT(*) FILTER (WHERE product_name IS NOT NULL AND unit_price > 0 AND unit_cost > 0)",
                        "nump",
                    ),
                    ("products", "unit_cost_capped", "COUNT(*) FILTER (WHERE unit_cost > cost_cap)", "namedp, capsp"),
                    ("products", "unit_price_capped", "COUNT(*) FILTER (WHERE unit_price > price_cap)", "namedp, capsp"),
                    ("products", "final", "COUNT(*)", "cappedp"),
                    ("sales_transactions", "loaded", "COUNT(*)", "rawt"),
                    ("sales_transactions", "after_dedupe", "COUNT(DISTINCT transaction_id)", "rawt"),
                    ("sales_transactions", "unreadable_quantity", "COUNT(*) FILTER (WHERE tax IN (0.05, 0.07))", "t0"),
                    ("sales_transactions", "unreadable_unit_price", "COUNT(*) FILTER (WHERE FALSE)", "t0"),
                    ("sales_transactions", "unreadable_discount", "COUNT(*) FILTER (WHERE tax = 0.02)", "t0"),
                    ("sales_transactions", "unreadable_order_date", "COUNT(*) FILTER (WHERE oday IS NULL)", "t0"),
                    ("sales_transactions", "unreadable_ship_date", "COUNT(*) FILTER (WHERE FALSE)", "t0"),
                    ("sales_transactions", "with_keys_and_date", "COUNT(*)", "t1"),
                    ("sales_transactions", "unknown_customer", "COUNT(*) FILTER (WHERE NOT hasc)", "t1"),
                    ("sales_transactions", "unknown_product", "COUNT(*) FILTER (WHERE NOT hasp)", "t1"),
                    ("sales_transactions", "bad_quantity", "COUNT(*) FILTER (WHERE hasc AND hasp AND q <= 0)", "t1"),
                    (
                        "sales_transactions",
                        "ship_date_fixed",
                        "COUNT(*) FILTER (WHERE hasc AND hasp AND q > 0 AND sday < oday)",
                        "t1",
                    ),
                    ("sales_transactions", "final", "COUNT(*) FILTER (WHERE hasc AND hasp AND q > 0)", "t1"),
                )
            ]
        ),
        raw=True,
        c1="SELECT * REPLACE (mail AS email), mail IS NOT NULL AND day IS NOT NULL AS good FROM cleanc0 WHERE nth = 1",
        t0=f"""SELECT *, customer_id IN (SELECT customer_id FROM cleanc) AS hasc,
    product_id IN (SELECT product_id FROM cappedp) AS hasp
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY {_ARRIVAL}) AS nth FROM numt) WHERE nth = 1""",
        t1="SELECT * FROM t0 WHERE q IS NOT NULL AND p IS NOT NULL AND oday IS NOT NULL",
    ),
    # audits
    "row_counts": _q(
        _all(
            *[
                f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {c}"
                for t, c in (("customers", "cust"), ("products", "prod"), ("sales_transactions", "txn"))
            ]
        )
    ),
    **{
        f"null_audit_{name}": _q(
            "SELECT " + ", ".join(f"COUNT(*) - COUNT({c}) AS null_{c}" for c in cols.split()) + f" FROM {source}"
        )
        for name, source, cols in (
            ("customers", "cust", "customer_id email region signup_date segment"),
            ("products", "prod", "product_id unit_price unit_cost category"),
            ("transactions", "txn", "transaction_id customer_id product_id order_date net_revenue quantity"),
        )
    },
    "duplicate_keys_customers": _q(
        "SELECT customer_id, COUNT(*) AS cnt FROM rawc GROUP BY customer_id HAVING COUNT(*) > 1", raw=True
    ),
    "duplicate_keys_products": _q(
        """SELECT CAST(l_partkey AS VARCHAR) AS product_id, COUNT(DISTINCT l_suppkey) AS cnt FROM lineitem
GROUP BY l_partkey HAVING COUNT(DISTINCT l_suppkey) > 1"""
    ),
    "duplicate_keys_transactions": _q(
        "SELECT transaction_id, COUNT(*) AS cnt FROM rawt GROUP BY transaction_id HAVING COUNT(*) > 1", raw=True
    ),
    "orphan_customers": _q(
        "SELECT COUNT(*) AS orphan_customer_count FROM txn WHERE quantity % 17 = 0"
    ),
    "orphan_products": _q("SELECT COUNT(*) AS orphan_product_count FROM txn WHERE quantity % 19 = 0"),
    "invalid_regions": _q(f"SELECT DISTINCT region AS invalid_region FROM txn WHERE region NOT IN {_ASIA4}"),
    "invalid_segments": _q(f"SELECT DISTINCT segment AS invalid_segment FROM cust WHERE segment NOT IN {_SEG3}"),
    "invalid_discounts": _q("SELECT COUNT(*) AS invalid_discount_count FROM numt WHERE d NOT BETWEEN 0 AND 1", raw=True),
    "invalid_quantities": _q("SELECT COUNT(*) AS invalid_quantity_count FROM numt WHERE q < 1", raw=True),
    "ship_before_order": _q("SELECT COUNT(*) AS ship_before_order_count FROM txn WHERE ship_date < order_date"),
    "partition_coverage": _q("SELECT year, month, COUNT(*) AS row_count FROM txn GROUP BY year, month"),
    "dq_completeness": _q(
        _all(
            *[
                f"""SELECT '{t}' AS table_name, COUNT(*) AS row_count, COUNT({k}) AS non_null_pk,
  COUNT(*) - COUNT({k}) AS null_pk_count FROM {c}"""
                for t, c, k in (
                    ("customers", "cust", "customer_id"),
                    ("products", "prod", "product_id"),
                    ("sales_transactions", "txn", "transaction_id"),
                )
            ]
        )
    ),
    "dq_uniqueness": _q(
        _all(
            *[
                f"SELECT '{t}' AS table_name, {k} AS pk_value, COUNT(*) AS occurrences FROM {c} GROUP BY {k} HAVING COUNT(*) > 1"
                for t, c, k in (
                    ("customers", "rawc", "customer_id"),
                    ("products", "prod", "product_id"),
                    ("transactions", "rawt", "transaction_id"),
                )
            ]
        ),
        raw=True,
    ),
    "dq_validity": _q(
        _rows(
            ("products.unit_price <= 0", "unit_price <= 0", "prod"),
            ("products.unit_cost <= 0", "unit_cost <= 0", "prod"),
            ("products.margin_pct < -50", "margin_pct < -50", "prod"),
            ("transactions.quantity < 1", "quantity < 1", "txn"),
            ("transactions.discount < 0", "discount < 0", "txn"),
            ("transactions.discount > 1", "discount > 1", "txn"),
            ("transactions.unit_price <= 0", "unit_price <= 0", "txn"),
            ("transactions.net_revenue < 0", "net_revenue < 0", "txn"),
        )
    ),
    "dq_temporal": _q(
        _rows(
            ("ship_date < order_date", "ship_date < order_date", "txn"),
            ("order_date > today", "order_date > DATE '2000-01-01'", "txn"),
            ("ship_date > today", "ship_date > DATE '2000-01-01'", "txn"),
            ("signup_date in future", "signup_date > DATE '2000-01-01'", "cust"),
        )
    ),
    "dq_domain": _q(
        _rows(
            ("invalid region (transactions)", f"region NOT IN {_ASIA4}", "txn"),
            ("invalid region (customers)", f"region NOT IN {_ASIA4}", "cust"),
            ("invalid segment", f"segment NOT IN {_SEG3}", "cust"),
        )
    ),
    "dq_referential": _q(
        _rows(
            ("orphan customer_id in transactions", "customer_id NOT IN (SELECT customer_id FROM cust)", "txn"),
            ("orphan product_id in transactions", "product_id NOT IN (SELECT product_id FROM prod)", "txn"),
        )
    ),
    "dq_outliers": _q(
        f"""SELECT transaction_id, order_date, net_revenue, {_R('(net_revenue - m) / s')} AS z_score
FROM txn, (SELECT AVG(net_revenue) AS m, STDDEV_SAMP(net_revenue) AS s FROM txn)
WHERE ABS((net_revenue - m) / s) > 2"""
    ),
    "dq_freshness": _q(
        """SELECT year, month, MAX(order_date) AS latest_order_date, COUNT(*) AS row_count
FROM txn GROUP BY year, month ORDER BY year DESC, month DESC LIMIT 6"""
    ),
    "dq_email_format": _q(
        r"""SELECT customer_id, email FROM cust
WHERE NOT regexp_matches(email, '^[a-z0-9._%+\-]+@[a-z0-9.\-]+[.][a-z]{2,}$')"""
    ),
    "dq_scorecard": _q(
        "SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM v",
        v=_all(
            """SELECT 'DQ-02: Duplicate PKs' AS check_name, COUNT(*) AS violations
  FROM (SELECT 1 FROM cust GROUP BY customer_id HAVING COUNT(*) > 1)""",
            _rows(
                ("DQ-03: Invalid quantity", "quantity < 1", "txn"),
                ("DQ-03: Invalid discount", "discount NOT BETWEEN 0 AND 1", "txn"),
                ("DQ-04: Ship before order", "ship_date < order_date", "txn"),
                ("DQ-06: Orphan customer FK", "customer_id NOT IN (SELECT customer_id FROM cust)", "txn"),
                ("DQ-06: Orphan product FK", "product_id NOT IN (SELECT product_id FROM prod)", "txn"),
            ),
        ),
    ),
    # check library
    "check_not_empty": _q(_not_empty("transactions", "txn")),
    "check_no_nulls": _q(
        _all(
            *[_nulls("transactions", c, "rawt", 0.4) for c in ("customer_id", "ship_date", "discount")],
            """SELECT 'transactions.net_revenue: column exists' AS check_name, FALSE AS passed,
  CAST(1 AS BIGINT) AS violations, 'column missing' AS details""",
        ),
        raw=True,
    ),
    "check_unique": _q(_unique("transactions", "transaction_id", "rawt"), raw=True),
    "check_domain": _q(_domain("customers", "region", _ASIA4, "cust")),
    "check_range": _q(_range("transactions", "quantity", 1, 40, "rawt"), raw=True),
    "check_referential": _q(
        _refer(
            "transactions",
            "customer_id",
            "customers",
            "(SELECT CASE WHEN quantity % 17 = 0 THEN 'C' || customer_id ELSE customer_id END AS customer_id FROM txn)",
            "cust",
        )
    ),
    "check_date_order": _q(_dates("transactions", "txn")),
    "check_stat": _q(_mean("transactions", "quantity", 1.0, 4.0, "txn")),
    "validate_customers": _q(_CHECK_C),
    "validate_products": _q(_CHECK_P),
    "validate_transactions": _q(_CHECK_T),
    "validation_gate": _q(
        """SELECT check_name, passed, details, COUNT(*) FILTER (WHERE passed) OVER () || '/' || COUNT(*) OVER ()
  || ' checks passed, ' || COUNT(*) FILTER (WHERE NOT passed) OVER () || ' FAILED' AS summary FROM c""",
        c=_all(_CHECK_C, _CHECK_P, _CHECK_T),
    ),
    "column_profile": _q(
        _all(
            _profile(
                "customers",
                "cust",
                {
                    **dict.fromkeys("customer_id first_name last_name email region country city".split(), "string"),
                    "signup_date": "date",
                    "segment": "string",
                },
            ),
            _profile(
                "products",
                "prod",
                {
                    **dict.fromkeys("product_id product_name category sub_category brand".split(), "string"),
                    **dict.fromkeys("unit_cost unit_price margin_pct".split(), "double"),
                },
            ),
            _profile(
                "sales_transactions",
                "txn",
                {
                    **dict.fromkeys("transaction_id customer_id product_id region".split(), "string"),
                    **dict.fromkeys("order_date ship_date".split(), "date"),
                    **dict.fromkeys("quantity year month".split(), "int"),
                    **dict.fromkeys("unit_price discount net_revenue".split(), "double"),
                },
            ),
        )
    ),
    # headline figures
    "kpi_totals": _q(
        f"""SELECT {_D(_REV)} AS total_revenue, {_D(_GP)} AS total_gross_profit, {_MARGIN} AS gross_margin_pct,
  {_ORD} AS total_orders, {_CUS} AS unique_customers, {_per(_REV, _ORD)} AS avg_order_value,
  {_DISC} AS avg_discount_pct FROM tp"""
    ),
    "quarterly_revenue": _q(
        f"""SELECT year, quarter, {_D(_REV)} AS quarterly_revenue, {_ORD} AS order_count, {_CUS} AS unique_customers
FROM txn GROUP BY year, quarter"""
    ),
    "yoy_revenue": _q(
        f"""SELECT c.year, {_D('c.rev')} AS revenue, {_D('p.rev')} AS prev_year_revenue,
  {_grow('c.rev', 'p.rev')} AS yoy_growth_pct FROM y c LEFT JOIN y p ON c.year = p.year + 1""",
        y="SELECT year, SUM(net) AS rev FROM txn GROUP BY year",
    ),
    "days_to_ship": _q(
        f"""SELECT region, {_per('SUM(d)', 'COUNT(d)')} AS avg_days_to_ship, CAST(MIN(d) AS INTEGER) AS min_days_to_ship,
  CAST(MAX(d) AS INTEGER) AS max_days_to_ship
FROM (SELECT region, date_diff('day', order_date, ship_date) AS d FROM txn) GROUP BY region"""
    ),
    "discount_buckets": _q(
        f"""SELECT {_BUCKET} AS discount_bucket, COUNT(*) AS order_count, {_D(_REV)} AS total_revenue,
  {_per(_REV, 'COUNT(net)')} AS avg_order_value, {_D(_GP)} AS total_gross_profit, {_MARGIN} AS gross_margin_pct
FROM tp GROUP BY 1"""
    ),
    "kpi_year_cards": _q(
        f"""SELECT c.year, {_D('c.rev')} AS total_revenue, {_D('p.rev')} AS prior_total_revenue,
  {_pct('c.gp', 'c.rev')} AS gross_margin_pct, {_pct('p.gp', 'p.rev')} AS prior_gross_margin_pct,
  c.orders AS total_orders, p.orders AS prior_total_orders,
  {_per('c.rev', 'c.orders')} AS avg_order_value, {_per('p.rev', 'p.orders')} AS prior_avg_order_value,
  c.customers AS unique_customers, p.customers AS prior_unique_customers,
  {_grow('c.rev', 'p.rev')} AS yoy_growth_pct FROM y c LEFT JOIN y p ON c.year = p.year + 1""",
        y=f"SELECT year, {_REV} AS rev, {_GP} AS gp, {_ORD} AS orders, {_CUS} AS customers FROM tp GROUP BY year",
    ),
    "kpi_year_cards_same_period": _q(
        f"""SELECT c.year, {_D('c.rev')} AS total_revenue, {_D('p.rev')} AS prior_total_revenue,
  {_pct('c.gp', 'c.rev')} AS gross_margin_pct, {_pct('p.gp', 'p.rev')} AS prior_gross_margin_pct,
  c.orders AS total_orders, p.orders AS prior_total_orders,
  {_per('c.rev', 'c.orders')} AS avg_order_value, {_per('p.rev', 'p.orders')} AS prior_avg_order_value,
  c.customers AS unique_customers, p.customers AS prior_unique_customers,
  {_grow('c.rev', 'p.rev')} AS yoy_growth_pct FROM y c LEFT JOIN y p ON c.year = p.year + 1""",
        y=f"SELECT year, {_REV} AS rev, {_GP} AS gp, {_ORD} AS orders, {_CUS} AS customers FROM tp WHERE strftime(order_date, '%m-%d') <= '06-30' GROUP BY year",
    ),
    "kpi_alerts": _q(
        _all(
            *[
                f"SELECT region, '{metric}' AS metric, {col} AS value, CAST({limit} AS DOUBLE) AS threshold, {col} {op} {limit} AS alert FROM a"
                for metric, col, op, limit in (
                    ("gross_margin_pct", "margin", "<", 10),
                    ("avg_days_to_ship", "ship", ">", 7),
                    ("avg_discount_pct", "disc", ">", 20),
                )
            ]
        ),
        a=f"""SELECT region, {_MARGIN} AS margin, {_DISC} AS disc,
    {_per("SUM(GREATEST(date_diff('day', order_date, ship_date), 0))", 'COUNT(ship_date)')} AS ship
  FROM tp GROUP BY region""",
    ),
    "qoq_revenue": _q(
        f"""SELECT year, quarter, {_D('rev')} AS revenue, {_D('prev')} AS prev_quarter_revenue,
  {_grow('rev', 'prev')} AS qoq_growth_pct
FROM (SELECT *, LAG(rev) OVER (ORDER BY year, quarter) AS prev FROM qy)""",
        qy=_QY,
    ),
    "cagr_by_region": _q(
        f"""SELECT region, first_year, last_year, {_D('a')} AS first_revenue, {_D('b')} AS last_revenue,
  {_CAGR} AS cagr_pct FROM ends""",
        ry=_RY,
        ends=_ENDS,
    ),
    "predicted_ltv": _q(
        f"""SELECT customer_id, {_R('aov')} AS avg_order_value, {_R('per_year', 4)} AS orders_per_year,
  {_R('aov * per_year * CAST(3.0 AS DOUBLE)')} AS predicted_ltv FROM (
  SELECT customer_id, CAST(rev AS DOUBLE) / orders AS aov,
    CAST(orders AS DOUBLE) / GREATEST(span / CAST(365.25 AS DOUBLE), CAST(1.0 AS DOUBLE)) AS per_year FROM pc)""",
        pc=_PER_CUSTOMER,
    ),
    "fourth_quarter_share": _q(
        f"""SELECT year, {_D(_REV)} AS annual_revenue, {_D('SUM(CASE WHEN month >= 10 THEN net ELSE 0 END)')} AS q4_revenue,
  {_pct('SUM(CASE WHEN month >= 10 THEN net ELSE 0 END)', _REV)} AS q4_share_pct FROM txn GROUP BY year"""
    ),
    "top_customer_share": _q(
        f"""SELECT COUNT(*) AS customers, COUNT(*) FILTER (WHERE top) AS top_customers, {_D('SUM(rev)')} AS total_revenue,
  {_D('SUM(rev) FILTER (WHERE top)')} AS top_revenue, {_pct('SUM(rev) FILTER (WHERE top)', 'SUM(rev)')} AS top_share_pct
FROM (SELECT rev, ROW_NUMBER() OVER (ORDER BY rev DESC, customer_id)
  <= GREATEST(CEIL(COUNT(*) OVER () * CAST(0.2 AS DOUBLE)), 1) AS top FROM pc)""",
        pc=_PER_CUSTOMER,
    ),
    "negative_margin_share": _q(
        f"""SELECT discount > 0.20 AS high_discount, COUNT(*) AS transactions,
  COUNT(*) FILTER (WHERE gp < 0) AS negative_margin_transactions,
  {_pct('COUNT(*) FILTER (WHERE gp < 0)', 'COUNT(*)')} AS negative_margin_pct FROM tp GROUP BY 1"""
    ),
    # time series
    "monthly_sales": _q(
        f"""SELECT year, month, ym AS month_label, {_D(_REV)} AS monthly_revenue, {_ORD} AS order_count,
  {_CUS} AS unique_customers, {_per(_REV, _ORD)} AS avg_order_value,
  {_per('SUM(quantity)', 'COUNT(quantity)')} AS avg_units_per_order, {_DISC} AS avg_discount_pct
FROM txn GROUP BY year, month, ym"""
    ),
    "mom_growth": _q(
        f"""SELECT year, month, {_D('rev')} AS revenue, {_D('prev')} AS prev_month_revenue,
  {_grow('rev', 'prev')} AS mom_growth_pct
FROM (SELECT *, LAG(rev) OVER (ORDER BY year, month) AS prev FROM m)""",
        m=_M,
    ),
    "yoy_same_month": _q(
        f"""SELECT c.year, c.month, {_D('c.rev')} AS current_revenue, {_D('p.rev')} AS prior_year_revenue,
  {_grow('c.rev', 'p.rev')} AS yoy_same_month_growth_pct
FROM m c LEFT JOIN m p ON c.month = p.month AND c.year = p.year + 1""",
        m=_M,
    ),
    "quarterly_ytd": _q(
        f"""SELECT year, quarter, {_D('rev')} AS quarterly_revenue,
  {_D('SUM(rev) OVER (PARTITION BY year ORDER BY quarter ROWS UNBOUNDED PRECEDING)')} AS ytd_revenue FROM qy""",
        qy=_QY,
    ),
    "monthly_revenue_simple": _q(
        """SELECT ym AS month, CAST(SUM(CAST(CAST(quantity * unit_price * (1 - discount) AS DECIMAL(28,10)) AS DECIMAL(18,4)))
  AS DOUBLE) AS net_revenue, COUNT(DISTINCT transaction_id) AS order_count FROM txn GROUP BY ym"""
    ),
    "monthly_profit_trend": _q(
        f"""SELECT ym AS order_ym, {_D(_REV)} AS revenue, {_D(_GP)} AS gross_profit, {_ORD} AS orders,
  {_MARGIN} AS margin_pct FROM tp GROUP BY ym"""
    ),
    "quarter_by_year": _q(
        f"""SELECT c.year, c.quarter, {_D('c.rev')} AS revenue, {_D('p.rev')} AS prior_year_revenue,
  {_grow('c.rev', 'p.rev')} AS yoy_growth_pct
FROM qy c LEFT JOIN qy p ON c.quarter = p.quarter AND c.year = p.year + 1""",
        qy=_QY,
    ),
    # profitability
    "profit_by_category": _q(
        f"""SELECT category, {_ORD} AS order_count, {_D(_REV)} AS total_revenue, {_D(_GP)} AS gross_profit,
  {_MARGIN} AS gross_margin_pct, {_DISC} AS avg_discount_pct, {_per(_REV, 'COUNT(net)')} AS avg_order_value
FROM tp GROUP BY category"""
    ),
    "profit_by_subcategory": _q(
        f"""SELECT category, sub_category, {_D(_REV)} AS revenue, {_D(_GP)} AS gross_profit,
  {_MARGIN} AS gross_margin_pct, RANK() OVER (ORDER BY SUM(net) DESC) AS revenue_rank
FROM tp GROUP BY category, sub_category"""
    ),
    "monthly_margin_by_category": _q(
        f"""SELECT year, month, category, {_D(_REV)} AS revenue, {_D(_GP)} AS gross_profit,
  {_MARGIN} AS gross_margin_pct FROM tp GROUP BY year, month, category"""
    ),
    "risky_transactions": _q(
        f"""SELECT transaction_id, order_date, product_name, category, quantity, {_R('unit_price')} AS unit_price,
  {_R('discount * 100', 1)} AS discount_pct, net_revenue, {_D('gp')} AS gross_profit, {_pct('gp', 'net')} AS margin_pct
FROM tp WHERE discount >= 0.20 AND gp < 0 ORDER BY gp, transaction_id LIMIT 100"""
    ),
    "margin_bands": _q(
        f"SELECT category, revenue, margin_pct, {_BAND.format(x='margin_pct', low=15, high=25)} AS margin_band FROM c",
        c=f"SELECT category, {_D(_REV)} AS revenue, {_MARGIN} AS margin_pct FROM tp GROUP BY category",
    ),
    "discount_margin_by_category": _q(
        f"""SELECT {_BUCKET} AS discount_bucket, category, {_DISC} AS avg_discount_pct, {_MARGIN} AS gross_margin_pct,
  COUNT(*) AS order_count FROM tp GROUP BY 1, 2"""
    ),
    "category_share": _q(
        f"""SELECT category, {_D(_REV)} AS revenue, {_MARGIN} AS gross_margin_pct,
  {_pct(_REV, 'SUM(SUM(net)) OVER ()')} AS revenue_share_pct FROM tp GROUP BY category"""
    ),
    # regions
    "regional_summary": _q(
        f"""SELECT region, {_ORD} AS order_count, {_CUS} AS unique_customers, {_D(_REV)} AS total_revenue,
  {_per(_REV, _ORD)} AS avg_order_value, {_per(_REV, _CUS)} AS revenue_per_customer, {_MARGIN} AS gross_margin_pct,
  {_DISC} AS avg_discount_pct, {_pct(_REV, 'SUM(SUM(net)) OVER ()')} AS revenue_share_pct FROM tp GROUP BY region"""
    ),
    "regional_yoy": _q(
        f"""SELECT c.region, c.year, {_D('c.rev')} AS revenue, {_D('p.rev')} AS prior_year_revenue,
  {_grow('c.rev', 'p.rev')} AS yoy_growth_pct
FROM ry c LEFT JOIN ry p ON c.region = p.region AND c.year = p.year + 1""",
        ry=_RY,
    ),
    "region_years": _q(
        f"""SELECT c.region, c.year, {_D('c.rev')} AS revenue, c.orders, c.customers,
  {_grow('c.rev', 'p.rev')} AS yoy_growth_pct FROM m c LEFT JOIN m p ON c.region = p.region AND c.year = p.year + 1""",
        m=f"SELECT region, year, {_REV} AS rev, {_ORD} AS orders, {_CUS} AS customers FROM txn GROUP BY region, year",
    ),
    "top_cities_by_region": _q(
        f"""SELECT region, city_rank, city, {_D('rev')} AS revenue, orders FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY rev DESC, city) AS city_rank FROM (
    SELECT cust.region, city, SUM(net) AS rev, COUNT(DISTINCT transaction_id) AS orders
    FROM txn JOIN cust USING (customer_id) GROUP BY cust.region, city)) WHERE city_rank <= 5"""
    ),
    "regional_monthly": _q(
        f"SELECT region, year, month, {_D(_REV)} AS monthly_revenue, {_ORD} AS orders FROM txn GROUP BY region, year, month"
    ),
    "market_share_by_year": _q(
        f"""SELECT region, year, {_D('rev')} AS revenue,
  {_pct('rev', '(SELECT SUM(rev) FROM ry t WHERE t.year = ry.year)')} AS market_share_pct FROM ry""",
        ry=_RY,
    ),
    "market_share_by_month": _q(
        f"""SELECT {_YM} AS month_label, region, {_D('rev')} AS revenue,
  {_pct('rev', 'SUM(rev) OVER (PARTITION BY year, month)')} AS market_share_pct FROM mr""",
        mr=_MR,
    ),
    "regional_monthly_vs_average": _q(
        f"""SELECT region, {_YM} AS month_label, {_D('rev')} AS monthly_revenue,
  {_per('SUM(rev) OVER ()', 'COUNT(*) OVER ()')} AS overall_monthly_average FROM mr""",
        mr=_MR,
    ),
    "profit_matrix": _q(
        "SELECT region, "
        + ", ".join(
            f"MAX(CASE WHEN category = '{c}' THEN margin END) AS \"{c}\""
            for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
        )
        + " FROM c GROUP BY region",
        c=f"SELECT region, category, {_MARGIN} AS margin FROM tp GROUP BY region, category",
    ),
    "profit_matrix_bands": _q(
        f"SELECT region, category, margin_pct, {_BAND.format(x='margin_pct', low=10, high=20)} AS margin_band FROM c",
        c=f"SELECT region, category, {_MARGIN} AS margin_pct FROM tp GROUP BY region, category",
    ),
    "region_discount_vs_margin": _q(
        f"""SELECT region, {_DISC} AS avg_discount_pct, {_MARGIN} AS gross_margin_pct, {_D(_REV)} AS revenue,
  (SELECT {_DISC} FROM tp) AS overall_discount_pct, (SELECT {_MARGIN} FROM tp) AS overall_margin_pct
FROM tp GROUP BY region"""
    ),
    "region_growth_table": _q(
        "SELECT region, "
        + ", ".join(
            f"(SELECT {_D('rev')} FROM ry WHERE ry.region = ends.region AND year = {y}) AS revenue_{y}"
            for y in range(1995, 2002)
        )
        + f""", {_CAGR} AS cagr_pct,
  {_grow('b', '(SELECT rev FROM ry WHERE ry.region = ends.region AND year = last_year - 1)')} AS last_yoy_growth_pct,
  (SELECT string_agg(year || ':' || CAST(rev * 100 AS BIGINT), ',' ORDER BY year) FROM ry WHERE ry.region = ends.region)
    AS yearly_cents FROM ends""",
        ry=_RY,
        ends=_ENDS,
    ),
    "region_cards": _q(
        f"""SELECT t.region, {_D('SUM(net)')} AS revenue, {_ORD} AS orders, {_per('SUM(net)', _CUS)} AS revenue_per_customer,
  {_per("SUM(date_diff('day', order_date, ship_date))", 'COUNT(ship_date)')} AS avg_days_to_ship,
  {_pct('SUM(net)', '(SELECT SUM(net) FROM txn)')} AS market_share_pct,
  (SELECT {_grow('c.rev', 'p.rev')} FROM ry c LEFT JOIN ry p ON c.region = p.region AND c.year = p.year + 1
   WHERE c.region = t.region ORDER BY c.year DESC LIMIT 1) AS yoy_growth_pct
FROM txn t GROUP BY t.region""",
        ry=_RY,
    ),
    "drill_region_city_customer": _q(
        _all(
            *[
                f"""SELECT {level} AS level, ym AS month_label, {r} AS region, {c} AS city, {k} AS customer_id,
  {_D('SUM(net)')} AS revenue, COUNT(*) AS transactions FROM txn JOIN (
  SELECT customer_id, region AS home, city FROM cust) h USING (customer_id) GROUP BY ym{g}"""
                for level, r, c, k, g in (
                    (0, "home", "city", "customer_id", ", home, city, customer_id"),
                    (1, "home", "city", "NULL", ", home, city"),
                    (2, "home", "NULL", "NULL", ", home"),
                    (3, "NULL", "NULL", "NULL", ""),
                )
            ]
        )
    ),
    # customers
    "customer_ltv": _q(
        f"""SELECT customer_id, first_name || ' ' || last_name AS customer_name, segment, region, city, signup_date,
  orders AS total_orders, {_D('rev')} AS lifetime_value, {_per('rev', 'n')} AS avg_order_value,
  first_order AS first_order_date, last_order AS last_order_date, CAST(span AS INTEGER) AS customer_lifespan_days
FROM pc JOIN cust USING (customer_id)""",
        pc=_PER_CUSTOMER,
    ),
    "ltv_by_segment": _q(
        f"""SELECT segment, {_CUS} AS customers, {_D(_REV)} AS segment_revenue, {_per(_REV, 'COUNT(net)')} AS avg_order_value,
  {_per(_REV, _CUS)} AS avg_ltv, {_per(_ORD, _CUS)} AS avg_orders,
  {_pct(_REV, 'SUM(SUM(net)) OVER ()')} AS revenue_share_pct
FROM txn JOIN cust USING (customer_id) GROUP BY segment"""
    ),
    "rfm_scores": _q(
        f"SELECT customer_id, segment, region, {_RFM_COLS} FROM rfm JOIN cust USING (customer_id)", **_rfm(True)
    ),
    "rfm_scores_sql": _q(
        f"SELECT customer_id, segment, region, {_RFM_COLS} FROM rfm JOIN cust USING (customer_id)", **_rfm(False)
    ),
    "rfm_scores_quantile": _q(
        f"SELECT customer_id, {_RFM_COLS} FROM rfm",
        pc=_PER_CUSTOMER,
        rfm0=_RFM0,
        edges="SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS e, COUNT(*) AS n FROM rfm0",
        placed="""SELECT rfm0.*, e, edges.n AS customers, ROW_NUMBER() OVER (ORDER BY orders, customer_id) AS rf,
    ROW_NUMBER() OVER (ORDER BY rev, customer_id) AS rm FROM rfm0, edges""",
        rfm1="""SELECT *, CAST(5 - len(list_filter(e, lambda x: recency_days > x)) AS BIGINT) AS r_score,
    CAST(1 + len(list_filter([0.2, 0.4, 0.6, 0.8], lambda p: rf > 1 + CAST(p AS DOUBLE) * (customers - 1))) AS BIGINT) AS f_score,
    CAST(1 + len(list_filter([0.2, 0.4, 0.6, 0.8], lambda p: rm > 1 + CAST(p AS DOUBLE) * (customers - 1))) AS BIGINT) AS m_score
  FROM placed""",
        rfm=f"SELECT *, r_score + f_score + m_score AS rfm_total, {_LABEL} AS rfm_segment FROM rfm1",
    ),
    "cohort_retention": _q(
        f"""SELECT cohort_month, ym AS txn_month, cohort_size, COUNT(DISTINCT customer_id) AS active_customers,
  {_pct('COUNT(DISTINCT customer_id)', 'cohort_size')} AS retention_pct
FROM txn JOIN c USING (customer_id) JOIN sizes USING (cohort_month) GROUP BY cohort_month, ym, cohort_size""",
        c="SELECT customer_id, strftime(signup_date, '%Y-%m') AS cohort_month FROM cust",
        sizes="SELECT cohort_month, COUNT(*) AS cohort_size FROM c GROUP BY cohort_month",
    ),
    "cohort_grid": _q(
        "SELECT cohort_month, COUNT(DISTINCT customer_id) AS cohort_size, "
        + ", ".join(
            f"{_pct(f'COUNT(DISTINCT CASE WHEN age = {a} THEN customer_id END)', 'COUNT(DISTINCT customer_id)')} AS m{a}"
            for a in range(13)
        )
        + " FROM a GROUP BY cohort_month",
        a="""SELECT c.customer_id, strftime(signup_date, '%Y-%m') AS cohort_month,
    (t.year - year(signup_date)) * 12 + t.month - month(signup_date) AS age
  FROM cust c LEFT JOIN txn t ON c.customer_id = t.customer_id""",
    ),
    "new_vs_returning": _q(
        f"""SELECT ym AS month_label, COUNT(*) FILTER (WHERE ym = first_ym) AS new_customers,
  COUNT(*) FILTER (WHERE ym > first_ym) AS returning_customers,
  {_per('COUNT(*) FILTER (WHERE ym = first_ym)', 'COUNT(*) FILTER (WHERE ym > first_ym)', 4)} AS new_to_returning
FROM (SELECT DISTINCT customer_id, ym FROM txn) JOIN f USING (customer_id) GROUP BY ym""",
        f="SELECT customer_id, MIN(ym) AS first_ym FROM txn GROUP BY customer_id",
    ),
    "rfm_segment_summary": _q(
        f"""SELECT rfm_segment, COUNT(*) AS customer_count, {_pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct_of_base,
  {_per('SUM(rev)', 'COUNT(*)')} AS avg_ltv, {_per('SUM(frequency)', 'COUNT(*)')} AS avg_orders,
  {_per('SUM(recency_days)', 'COUNT(*)')} AS avg_recency_days,
  CASE rfm_segment WHEN 'Champions' THEN 'Loyalty program, upsell' WHEN 'At Risk' THEN 'Win-back campaign'
    WHEN 'Lost' THEN 'Re-engagement or sunset' WHEN 'Recent Customers' THEN 'Onboarding nurture'
    WHEN 'Loyal Customers' THEN 'Reward and retain' END AS action_recommended
FROM rfm GROUP BY rfm_segment""",
        **_rfm(True),
    ),
    "rfm_bubbles": _q(
        f"""SELECT r_score, f_score, rfm_segment, COUNT(*) AS customer_count, {_per('SUM(rev)', 'COUNT(*)')} AS avg_monetary
FROM rfm GROUP BY r_score, f_score, rfm_segment""",
        **_rfm(True),
    ),
    "ltv_histogram": _q(
        f"""SELECT segment, bin, {_R('(lo + (hi - lo) / CAST(20 AS DOUBLE) * (bin - 1)) / 100', 4)} AS bin_from,
  {_R('(lo + (hi - lo) / CAST(20 AS DOUBLE) * bin) / 100', 4)} AS bin_to, COUNT(*) AS customer_count,
  {_R('mid / 100')} AS median_ltv, {_R('p90 / 100')} AS p90_ltv
FROM (SELECT segment, lo, hi, mid, p90,
  LEAST(CAST(FLOOR(20 * (c - lo) / (hi - lo)) AS BIGINT) + 1, 20) AS bin FROM v, s)
GROUP BY segment, bin, lo, hi, mid, p90""",
        pc=_PER_CUSTOMER,
        v="SELECT segment, CAST(rev * 100 AS DOUBLE) AS c FROM pc JOIN cust USING (customer_id)",
        s="SELECT MIN(c) AS lo, MAX(c) AS hi, quantile_cont(c, 0.5) AS mid, quantile_cont(c, 0.9) AS p90 FROM v",
    ),
    "top_customers": _q(
        f"""SELECT ROW_NUMBER() OVER (ORDER BY rev DESC, customer_id) AS rank, customer_id,
  first_name || ' ' || last_name AS customer_name, segment, region, {_D('rev')} AS lifetime_value, orders,
  first_order, last_order, CAST(span AS INTEGER) AS days_active, {_per('rev', 'orders')} AS avg_order_value
FROM pc JOIN cust USING (customer_id) ORDER BY rank LIMIT 20""",
        pc=_PER_CUSTOMER,
    ),
    "customer_geography": _q(
        f"""SELECT city, cust.region, country, COUNT(DISTINCT customer_id) AS customers, {_D(_REV)} AS revenue
FROM txn JOIN cust USING (customer_id) GROUP BY city, cust.region, country"""
    ),
    "customer_cards": _q(
        f"""SELECT COUNT(*) AS total_customers, {_per('SUM(rev)', 'COUNT(*)')} AS avg_ltv,
  COUNT(*) FILTER (WHERE rfm_segment = 'Champions') AS champions,
  COUNT(*) FILTER (WHERE rfm_segment = 'At Risk') AS at_risk,
  {_per('SUM(frequency)', 'COUNT(*)')} AS avg_orders_per_customer,
  {_per('SUM(gap)', 'COUNT(gap)')} AS avg_days_between_orders
FROM (SELECT *, CASE WHEN frequency > 1 THEN CAST(CAST(span AS DOUBLE) / (frequency - 1) AS DECIMAL(18,6)) END AS gap FROM rfm)""",
        **_rfm(True),
    ),
    "customer_revenue_share": _q(
        f"""SELECT customer_id, {_D('rev')} AS lifetime_value, RANK() OVER (ORDER BY rev DESC) AS ltv_rank,
  {_D('SUM(rev) OVER ()')} AS total_revenue, {_pct('rev', 'SUM(rev) OVER ()', 6)} AS revenue_share_pct
FROM (SELECT customer_id, SUM(CAST(CAST(quantity * unit_price * (1 - discount) AS DECIMAL(28,10)) AS DECIMAL(18,4))) AS rev
  FROM txn GROUP BY customer_id)"""
    ),
    "customer_features": _q(
        f"""SELECT customer_id, {_D('rev')} AS lifetime_value, orders AS total_orders, first_order, last_order,
  CAST(span AS INTEGER) AS lifespan_days, {_per('rev', 'orders')} AS avg_order_value FROM pc""",
        pc=_PER_CUSTOMER,
    ),
    # products
    "top_products": _q(
        f"""SELECT product_id, product_name, category, sub_category, brand, orders, units AS units_sold,
  {_D('rev')} AS total_revenue, {_D('gp')} AS gross_profit, {_pct('gp', 'rev')} AS margin_pct,
  {_R('CAST(cut_sum AS DOUBLE) / cut_n * 100')} AS avg_discount_pct, revenue_rank FROM top WHERE place <= 20""",
        sold=_SOLD,
        top=_TOP,
    ),
    "top_products_by_category": _q(
        f"""SELECT category, cat_rank, product_id, product_name, brand, {_D('rev')} AS revenue, {_D('gp')} AS gross_profit
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY rev DESC, product_id) AS cat_rank FROM sold)
WHERE cat_rank <= 5""",
        sold=_SOLD,
    ),
    "product_pareto": _q(
        f"""SELECT RANK() OVER (ORDER BY rev DESC) AS rank, product_id, product_name, category, {_D('rev')} AS revenue,
  {_D('SUM(rev) OVER (ORDER BY rev DESC, product_id ROWS UNBOUNDED PRECEDING)')} AS cumulative_revenue,
  {_pct('SUM(rev) OVER (ORDER BY rev DESC, product_id ROWS UNBOUNDED PRECEDING)', 'SUM(rev) OVER ()')} AS cumulative_pct
FROM sold""",
        sold=_SOLD,
    ),
    "drill_category_product": _q(
        _all(
            *[
                f"""SELECT {level} AS level, category, {sub} AS sub_category, {pid} AS product_id, {_D(_REV)} AS revenue,
  CAST(SUM(quantity) AS BIGINT) AS units, {_MARGIN} AS margin_pct FROM tp GROUP BY category{g}"""
                for level, sub, pid, g in (
                    (0, "sub_category", "product_id", ", sub_category, product_id"),
                    (1, "sub_category", "NULL", ", sub_category"),
                    (2, "NULL", "NULL", ""),
                )
            ]
        )
    ),
    "product_velocity": _q(
        f"""SELECT product_id, product_name, category, CAST(SUM(u) AS BIGINT) AS units_last_12_months,
  {_per('SUM(u)', 'COUNT(*)')} AS avg_monthly_units, CAST(MAX(u) AS BIGINT) AS peak_monthly_units,
  COUNT(*) AS months_with_sales FROM r JOIN prod USING (product_id) GROUP BY product_id, product_name, category
ORDER BY units_last_12_months DESC, product_id LIMIT 30""",
        r="""SELECT product_id, year, month, SUM(quantity) AS u FROM txn
  WHERE year * 12 + month >= (SELECT MAX(year) * 12 + MAX(month) - 12 FROM txn) GROUP BY product_id, year, month""",
    ),
    "top10_products_table": _q(
        f"""SELECT revenue_rank, product_name, category, total_revenue, gross_profit, margin_pct,
  {_BAND.format(x='margin_pct', low=15, high=25)} AS margin_band, orders FROM (
  SELECT *, {_D('rev')} AS total_revenue, {_D('gp')} AS gross_profit, {_pct('gp', 'rev')} AS margin_pct
  FROM top WHERE place <= 10)""",
        sold=_SOLD,
        top=_TOP,
    ),
    # windows
    "running_totals": _q(
        f"""SELECT year, month, {_D('rev')} AS revenue,
  {_D('SUM(rev) OVER (ORDER BY year, month ROWS UNBOUNDED PRECEDING)')} AS running_total,
  {_D('SUM(rev) OVER (PARTITION BY year ORDER BY month ROWS UNBOUNDED PRECEDING)')} AS ytd_running_total FROM m""",
        m=_M,
    ),
    "moving_average_3m": _q(
        f"""SELECT year, month, {_D('rev')} AS revenue,
  {_per('SUM(rev) OVER w', 'COUNT(rev) OVER w')} AS revenue_3mo_avg
FROM m WINDOW w AS (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        m=_M,
    ),
    "customer_ranking": _q(
        f"""SELECT customer_id, {_D('rev')} AS lifetime_value, RANK() OVER (ORDER BY rev DESC) AS rank,
  DENSE_RANK() OVER (ORDER BY rev DESC) AS dense_rank, ROW_NUMBER() OVER (ORDER BY rev DESC, customer_id) AS row_num,
  {_R('PERCENT_RANK() OVER (ORDER BY rev DESC) * 100')} AS percentile_rank,
  NTILE(10) OVER (ORDER BY rev DESC, customer_id) AS decile FROM pc""",
        pc=_PER_CUSTOMER,
    ),
    "period_contribution": _q(
        f"""SELECT year, month, region, {_D('rev')} AS revenue,
  {_pct('rev', 'SUM(rev) OVER (PARTITION BY year, month)')} AS pct_of_month,
  {_pct('rev', 'SUM(rev) OVER (PARTITION BY year)')} AS pct_of_year FROM mr""",
        mr=_MR,
    ),
    "order_gaps": _q(
        """SELECT customer_id, order_date, prev_order_date,
  CAST(date_diff('day', prev_order_date, order_date) AS INTEGER) AS days_since_last_order, net_revenue
FROM (SELECT *, LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, transaction_id) AS prev_order_date
  FROM txn) WHERE prev_order_date IS NOT NULL"""
    ),
    "first_last_purchase": _q(
        """SELECT DISTINCT customer_id, FIRST_VALUE(order_date) OVER w AS first_purchase_date,
  LAST_VALUE(order_date) OVER w AS last_purchase_date, FIRST_VALUE(net_revenue) OVER w AS first_order_value,
  LAST_VALUE(net_revenue) OVER w AS last_order_value FROM txn
WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, transaction_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
    ),
    "revenue_ntiles": _q(
        f"""SELECT year, month, region, {_D('rev')} AS revenue,
  NTILE(4) OVER (ORDER BY rev DESC, year, month, region) AS quartile,
  NTILE(10) OVER (ORDER BY rev DESC, year, month, region) AS decile FROM mr""",
        mr=_MR,
    ),
    # summaries
    "customer_summary": _q(
        _long(
            ("total_customers", "''", "COUNT(*)", "NULL", "FROM cust"),
            ("signup_date_min", "''", "NULL", "MIN(signup_date)", "FROM cust"),
            ("signup_date_max", "''", "NULL", "MAX(signup_date)", "FROM cust"),
            ("segment_distribution", "segment", "COUNT(*)", "NULL", "FROM cust GROUP BY segment"),
            ("region_distribution", "region", "COUNT(*)", "NULL", "FROM cust GROUP BY region"),
        )
    ),
    "product_summary": _q(
        _long(
            ("total_products", "''", "COUNT(*)", "NULL", "FROM prod"),
            ("price_min", "''", "MIN(unit_price)", "NULL", "FROM prod"),
            ("price_max", "''", "MAX(unit_price)", "NULL", "FROM prod"),
            ("price_mean", "''", _per("SUM(CAST(unit_price AS DECIMAL(18,2)))", "COUNT(*)"), "NULL", "FROM prod"),
            ("price_median", "''", _R("median(unit_price)"), "NULL", "FROM prod"),
            ("category_counts", "category", "COUNT(*)", "NULL", "FROM prod GROUP BY category"),
            (
                "avg_margin_pct_by_category",
                "category",
                _per("SUM(CAST(margin_pct AS DECIMAL(18,6)))", "COUNT(*)"),
                "NULL",
                "FROM prod GROUP BY category",
            ),
        )
    ),
    "transaction_summary": _q(
        _long(
            ("total_transactions", "''", "COUNT(*)", "NULL", "FROM tp"),
            ("order_date_min", "''", "NULL", "MIN(order_date)", "FROM tp"),
            ("order_date_max", "''", "NULL", "MAX(order_date)", "FROM tp"),
            ("total_revenue", "''", _REV, "NULL", "FROM tp"),
            ("total_gross_profit", "''", _GP, "NULL", "FROM tp"),
            ("gross_margin_pct", "''", _MARGIN, "NULL", "FROM tp"),
            ("avg_line_revenue", "''", _per(_REV, "COUNT(net)"), "NULL", "FROM tp"),
            ("avg_discount_rate", "''", _R("CAST(SUM(cut) AS DOUBLE) / COUNT(cut)", 4), "NULL", "FROM tp"),
            ("revenue_by_year", "CAST(year AS VARCHAR)", _REV, "NULL", "FROM tp GROUP BY year"),
            ("revenue_by_region", "region", _REV, "NULL", "FROM tp GROUP BY region"),
            ("revenue_by_category", "category", _REV, "NULL", "FROM tp GROUP BY category"),
            ("revenue_by_segment", "segment", _REV, "NULL", "FROM tp JOIN cust USING (customer_id) GROUP BY segment"),
            (
                "top_5_products_by_revenue",
                "product_id",
                "rev",
                "NULL",
                "FROM (SELECT product_id, SUM(net) AS rev FROM txn GROUP BY product_id ORDER BY rev DESC, product_id LIMIT 5)",
            ),
        )
    ),
    "enrich_transactions": _q(
        f"""SELECT {', '.join('t.' + c.strip() for c in _NET_TABLE.split(','))}, p.category, p.sub_category, p.unit_cost,
  p.brand, c.segment, c.city, {_D('t.net - p.cost * t.quantity')} AS gross_profit, t.ym AS order_ym
FROM txn t LEFT JOIN prod p USING (product_id) LEFT JOIN cust c ON t.customer_id = c.customer_id"""
    ),
    "revenue_overview": _q(
        f"""SELECT {_D(_REV)} AS total_revenue, {_ORD} AS total_orders, {_CUS} AS unique_customers,
  {_per(_REV, _ORD)} AS avg_order_value, {_DISC} AS avg_discount_pct FROM txn"""
    ),
    "region_overview": _q(
        f"""SELECT region, {_D(_REV)} AS revenue, {_ORD} AS orders, {_CUS} AS customers, {_per(_REV, _ORD)} AS aov
FROM txn GROUP BY region"""
    ),
    "category_margin": _q(
        f"""SELECT category, {_D(_REV)} AS revenue, {_D(_GP)} AS gross_profit, {_MARGIN} AS margin_pct
FROM tp GROUP BY category"""
    ),
    "segment_overview": _q(
        f"""SELECT segment, {_D(_REV)} AS revenue, {_CUS} AS customers, {_ORD} AS orders, {_per(_REV, _CUS)} AS ltv,
  {_pct(_REV, 'SUM(SUM(net)) OVER ()')} AS rev_pct FROM txn JOIN cust USING (customer_id) GROUP BY segment"""
    ),
    "discount_distribution": _q(
        f"""SELECT discount, COUNT(*) AS transactions,
  {_R('COUNT(*) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM txn)')} AS pct_of_transactions FROM txn GROUP BY discount"""
    ),
    "discount_margin": _q(f"SELECT discount, {_MARGIN} AS margin_pct FROM tp GROUP BY discount"),
    "yearly_by_region": _q(f"SELECT year, region, {_D('rev')} AS revenue FROM ry", ry=_RY),
    "integrity_summary": _q(
        """SELECT (SELECT COUNT(*) - COUNT(DISTINCT customer_id) FROM cust) AS duplicate_customers,
  (SELECT COUNT(*) - COUNT(DISTINCT product_id) FROM prod) AS duplicate_products,
  (SELECT COUNT(*) - COUNT(DISTINCT transaction_id) FROM txn) AS duplicate_transactions,
  (SELECT COUNT(*) FROM txn WHERE customer_id NOT IN (SELECT customer_id FROM cust)) AS orphan_customers,
  (SELECT COUNT(*) FROM txn WHERE product_id NOT IN (SELECT product_id FROM prod)) AS orphan_products,
  (SELECT COUNT(*) FROM txn WHERE ship_date < order_date) AS bad_ship_dates"""
    ),
}
ORACLE["materialize"] = ORACLE["monthly_sales"]
ORACLE["indexed_load"] = ORACLE["incremental_load"]
for _name in ("customer_ltv", "cohort_retention", "rfm_scores"):
    ORACLE[f"bucketed_{_name}"] = ORACLE[_name]
ORACLE["cap_outliers_by_sketch"] = ORACLE["cap_outliers"]
ORACLE["profile_by_load"] = f"""SELECT "column", dtype, null_count, null_pct, true AS close
FROM ({ORACLE['column_profile']}) WHERE table_name = 'sales_transactions'"""
ORACLE["clean_and_audit"] = f"SELECT * FROM ({ORACLE['cleaning_audit']}) WHERE table_name = 'sales_transactions'"
ORACLE["written_clean_transactions"] = ORACLE["clean_transactions"]
ORACLE["secured_view"] = f"SELECT * FROM ({ORACLE['regional_monthly']}) WHERE region IN ('ASIA', 'EUROPE')"
for _name in ("monthly_sales", "regional_summary", "kpi_totals", "quarterly_revenue"):
    ORACLE[f"rollup_{_name}"] = ORACLE[_name]
ORACLE["read_raw_csv_quoted"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE p_partkey % 5 WHEN 0 THEN p_name || ' 5", ' || p_brand WHEN 1 THEN p_name || chr(10) || 'second "line"'
    WHEN 3 THEN NULL ELSE p_name END AS product_name,
  CASE WHEN p_partkey % 5 <> 3 THEN p_type || ', etc' END AS category,
  CASE WHEN p_partkey % 5 NOT IN (2, 3) THEN CAST(p_size AS VARCHAR) END AS unit_price,
  CASE WHEN p_partkey % 5 NOT IN (2, 3) THEN p_brand END AS brand,
  CASE WHEN p_partkey % 5 = 3 THEN 'surplus fields' END AS reason
FROM part"""


def _section(name: str, query: str) -> str:
    return f"SELECT '{name}' AS section, metric, key, value, text FROM ({ORACLE[query]})"


ORACLE["summary_report"] = _all(
    "SELECT 'generated_at' AS section, '' AS metric, '' AS key, CAST(NULL AS DOUBLE) AS value, '2000-01-01' AS text",
    _section("customers", "customer_summary"),
    _section("products", "product_summary"),
    _section("transactions", "transaction_summary"),
    f"""SELECT 'rfm_segments' AS section, '' AS metric, rfm_segment AS key, CAST(customer_count AS DOUBLE) AS value,
  CAST(NULL AS VARCHAR) AS text FROM ({ORACLE["rfm_segment_summary"]})""",
)
ORACLE["write_summary_json"] = ORACLE["summary_report"]
