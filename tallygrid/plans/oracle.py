"""SQL forms of the logical tables, for checking the queries in another engine."""

from __future__ import annotations

LOGICAL_TABLES = """
WITH sales AS (
  SELECT 'T' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS transaction_id,
         l_partkey::varchar AS product_id, p_name AS product_name, p_type AS category,
         l_quantity::int AS quantity,
         ((2 * round(l_extendedprice * 100)::bigint + l_quantity::bigint)
           // (2 * l_quantity::bigint))::double / 100 AS unit_price,
         l_extendedprice AS total_amount,
         o_custkey::varchar AS customer_id, c_name AS customer_name,
         o_orderdate::date AS sale_date, r_name AS region, s_name AS salesperson,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
), employees AS (
  SELECT c_custkey AS id, c_name AS name, (18 + c_custkey % 55)::int AS age,
         n_name AS city, c_acctbal AS salary, c_mktsegment AS department,
         strftime(date '2016-01-01' + ((c_custkey * 37) % 2400)::int, '%Y-%m-%d') AS hire_date,
         CASE WHEN c_custkey % 25 = 0 THEN 'Inactive' ELSE 'Active' END AS status
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
), emp AS (
  SELECT * FROM employees WHERE id > 0
), raw_emp AS (
  SELECT id, '  ' || name || ' ' AS name, age, city,
         CASE WHEN id % 53 <> 0 THEN salary END AS salary,
         CASE WHEN id % 3 = 0 THEN lower(department) ELSE department END AS department,
         CASE WHEN id % 41 = 0 THEN 'unknown' ELSE hire_date END AS hire_date,
         CASE WHEN id % 7 = 0 THEN upper(status) ELSE status END AS status
  FROM employees
), docs AS (
  SELECT 'D' || transaction_id AS _id, transaction_id,
         CASE WHEN l_partkey % 17 <> 0 THEN product_name END AS product_name,
         CASE WHEN l_partkey % 17 <> 0 THEN category END AS category,
         CASE WHEN l_orderkey % 19 <> 0 THEN quantity END AS quantity,
         CASE WHEN l_orderkey % 19 <> 0 THEN unit_price END AS unit_price,
         CASE WHEN l_orderkey % 19 <> 0 THEN total_amount END AS total_amount,
         customer_id, customer_name, sale_date,
         CASE WHEN l_orderkey % 13 <> 0 AND l_orderkey % 11 <> 0 THEN region END AS region,
         salesperson
  FROM sales
), cust AS (
  SELECT 'K' || CASE WHEN c_acctbal < 0 THEN 'X' ELSE '' END || c_custkey AS _id,
         CASE WHEN c_acctbal < 0 THEN 'X' ELSE '' END || c_custkey AS customer_id, c_name AS name,
         'c' || (CASE WHEN c_custkey % 97 = 1 THEN c_custkey - c_custkey % 194
                 ELSE c_custkey END) || '@example.com' AS email,
         CASE c_custkey % 4 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver'
              WHEN 2 THEN 'Gold' ELSE 'Platinum' END AS loyalty_tier,
         c_acctbal AS total_spent, (c_custkey % 50)::int AS total_orders
  FROM customer
  UNION ALL
  SELECT 'KS' || s_suppkey, 'S' || s_suppkey, s_name, 'S' || s_suppkey || '@example.com',
         'Bronze', 0::double, 0 FROM supplier
)
"""


def over(body: str) -> str:
    """A query text that can use the logical tables; ``WITH`` bodies may add more."""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"{LOGICAL_TABLES.strip()}, {body[5:]}"
    return f"{LOGICAL_TABLES.strip()}\n{body}"


def total(c: str) -> str:
    return f"sum({c}::decimal(18,2))::double"


def mean(c: str) -> str:
    return f"(sum({c}::decimal(18,2))::double / count({c}))"


def int_mean(c: str) -> str:
    return f"(sum({c})::double / count({c}))"


def deviation(c: str) -> str:
    """Sample standard deviation from exact sums of millionths, in whole numbers up to the
    last division. A whole number becomes a double by halves of 53 bits, so as to be rounded once."""
    x, n = f"round({c} * 1000000)::hugeint", f"count({c})"
    total, squares = f"sum({x})::hugeint", f"sum({x} * {x})::hugeint"
    near = f"floor({total}::double / {n})::hugeint"
    left = f"({total} - {near} * {n})"
    bulk = f"({squares} - {near} * ({total} + {left}))"
    half = "9007199254740992"
    wide = f"(({bulk} // {half})::double * {half}.0::double + ({bulk} % {half})::double)"
    spread = f"({wide} - {left}::double * {left}::double / {n})"
    return f"CASE WHEN {n} > 1 THEN sqrt({spread} / ({n} - 1)) / 1000000.0::double END"
