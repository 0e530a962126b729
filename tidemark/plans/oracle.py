"""The registered queries in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

# Inputs shared by several queries, as common table expressions.

PRIORITY = """panel AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         o_orderpriority AS entity,
         CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS INTEGER) AS entity_id,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100
           / count(o_totalprice) AS value
  FROM orders GROUP BY 1, 2, 3)"""

BENCHMARK = """bench AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100
           / count(o_totalprice) AS benchmark
  FROM orders GROUP BY 1)"""

BRAND = """panel AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS entity_id,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100
           / count(l_extendedprice) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""

CUSTOMER = """panel AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         o_custkey AS entity,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS value
  FROM orders GROUP BY 1, 2)"""

FLAG = """flag AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         l_returnflag || l_linestatus AS entity,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS value
  FROM lineitem GROUP BY 1, 2)"""

EVENT = """event AS (
  SELECT CAST(ts AS DATE) AS date, event_type AS entity,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS value
  FROM events GROUP BY 1, 2)"""


def _mean(rule: str) -> str:
    return (
        "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE " + rule + ") AS DOUBLE)"
        " / 100 / nullif(count(o_totalprice) FILTER (WHERE " + rule + "), 0)"
    )


WIDE = f"""wide AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         {_mean("o_orderpriority = '1-URGENT'")} AS p1,
         {_mean("o_orderpriority = '2-HIGH'")} AS p2,
         {_mean("o_orderpriority = '3-MEDIUM'")} AS p3,
         {_mean("o_orderpriority = '4-NOT SPECIFIED'")} AS p4,
         {_mean("o_orderpriority = '5-LOW'")} AS p5,
         {_mean("true")} AS idx
  FROM orders GROUP BY 1)"""

DIM = """dim(entity_id, entity_name) AS (
  VALUES (1, '1-URGENT'), (2, '2-HIGH'), (3, '3-MEDIUM'), (4, '4-NOT SPECIFIED'), (5, '5-LOW'))"""

DIRTY = """raw AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw_date,
         CASE WHEN o_orderkey % 89 = 0 THEN CAST(-o_totalprice AS VARCHAR)
              WHEN o_orderkey % 83 = 0 THEN NULL
              WHEN o_orderkey % 79 = 0 THEN 'x'
              ELSE CAST(o_totalprice AS VARCHAR) END AS raw_price,
         o_orderkey
  FROM orders),
typed AS (
  SELECT o_orderkey, raw_date, raw_price,
         try_cast(raw_date AS DATE) AS day, try_cast(raw_price AS DOUBLE) AS price
  FROM raw),
dated AS (SELECT * FROM typed WHERE day IS NOT NULL),
firsts AS (
  SELECT *
  FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY o_orderkey) AS rn FROM dated)
  WHERE rn = 1),
silver AS (SELECT * FROM firsts WHERE price IS NULL OR price >= 0)"""

SHIPMENTS = """raw AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'n/a'
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ship_date,
         CAST(CAST(round(l_extendedprice * (1 - l_discount), 4) AS DECIMAL(18, 4)) AS VARCHAR) AS net,
         CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE CAST(l_quantity AS VARCHAR) END AS qty,
         CASE WHEN l_orderkey % 89 = 0 THEN CAST(-l_extendedprice AS VARCHAR)
              WHEN l_orderkey % 79 = 0 THEN 'x'
              ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
         CAST(l_tax AS VARCHAR) AS tax_text,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem),
typed AS (
  SELECT try_cast(ship_date AS DATE) AS day, try_cast(net AS DOUBLE) AS idx,
         try_cast(qty AS DOUBLE) AS quantity, try_cast(price AS DOUBLE) AS extended_price,
         try_cast(tax_text AS DOUBLE) AS tax, qty, price, tax_text,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM raw),
firsts AS (
  SELECT *, row_number() OVER (
           PARTITION BY day
           ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    qty NULLS FIRST, price NULLS FIRST, tax_text NULLS FIRST) AS rn
  FROM typed WHERE day IS NOT NULL),
silver AS (
  SELECT day, idx, quantity, extended_price, tax,
         CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month
  FROM firsts
  WHERE rn = 1 AND (idx IS NULL OR idx >= 0) AND (quantity IS NULL OR quantity >= 0)
    AND (extended_price IS NULL OR extended_price >= 0) AND (tax IS NULL OR tax >= 0)),
monthly AS (
  SELECT day, year, month, 1 AS entity_id, quantity AS value FROM silver WHERE quantity IS NOT NULL
  UNION ALL
  SELECT day, year, month, 2, extended_price FROM silver WHERE extended_price IS NOT NULL
  UNION ALL
  SELECT day, year, month, 3, tax FROM silver WHERE tax IS NOT NULL),
dim(entity_id, entity_name) AS (VALUES (1, 'Quantity'), (2, 'Extended price'), (3, 'Tax')),
lagged AS (
  SELECT *, lag(value) OVER (PARTITION BY entity_id ORDER BY day) AS prev FROM monthly),
moves AS (
  SELECT day, year, month, entity_id, value, (value - prev) / nullif(prev, 0) * 100 AS change_pct
  FROM lagged WHERE prev IS NOT NULL AND prev <> 0)"""


def _moves(key: str) -> str:
    """Changes of the CTE ``panel`` along ``key``."""
    return f"""lagged AS (
  SELECT *, lag(value) OVER (PARTITION BY {key} ORDER BY date) AS prev FROM panel),
moves AS (
  SELECT date, {key}, value, (value - prev) / nullif(prev, 0) * 100 AS change_pct
  FROM lagged WHERE prev IS NOT NULL AND prev <> 0)"""


def _corr(x: str, y: str) -> str:
    return (
        f"covar_pop({x}, {y}) / nullif(stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END)"
        f" * stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END), 0)"
    )


def _clip(value: str) -> str:
    return f"CASE WHEN {value} > 1 THEN 1.0 WHEN {value} < -1 THEN -1.0 ELSE {value} END"


def _matrix(key: str = "entity_id") -> str:
    return f"""names AS (SELECT DISTINCT {key} FROM panel),
pairs AS (
  SELECT a.{key} AS entity_a, b.{key} AS entity_b, {_corr('a.value', 'b.value')} AS c,
         count(*) AS n
  FROM panel a JOIN panel b USING (date) GROUP BY 1, 2)
SELECT x.{key} AS entity_a, y.{key} AS entity_b, round({_clip('c')}, 6) AS corr,
       coalesce(n, 0) AS n
FROM names x CROSS JOIN names y LEFT JOIN pairs ON entity_a = x.{key} AND entity_b = y.{key}"""


OUTLIERS = """scored AS (
  SELECT *, avg(change_pct) OVER (PARTITION BY {key}) AS mean_change,
         stddev_samp(change_pct) OVER (PARTITION BY {key}) AS sd_change
  FROM moves)
SELECT date, {key}, value, round(change_pct, 6) AS change_pct,
       round(mean_change, 6) AS mean_change, round(sd_change, 6) AS sd_change
FROM scored WHERE sd_change > 0 AND abs(change_pct - mean_change) > 3 * sd_change"""

ORACLE: dict[str, str] = {}

# --- Bronze ---------------------------------------------------------------------------

ORACLE["profile_shape"] = """
SELECT count(*) AS n_rows,
       (SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns
        WHERE table_name = 'orders') AS n_columns,
       (SELECT 'struct<' || string_agg(column_name || ':' || CASE
                 WHEN data_type = 'VARCHAR' THEN 'string'
                 WHEN data_type = 'TIMESTAMP' THEN 'timestamp_ntz'
                 WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp'
                 WHEN data_type = 'INTEGER' THEN 'int' ELSE lower(data_type) END,
               ',' ORDER BY ordinal_position) || '>'
        FROM information_schema.columns WHERE table_name = 'orders') AS schema
FROM orders"""

ORACLE["normalise_names"] = f"""
WITH {SHIPMENTS}
SELECT ship_date AS "Ship_Date", net AS "Net_Price_index", qty AS "Quantity", price AS "Extended_Price_USD",
       tax_text AS "Tax", CAST(l_orderkey AS VARCHAR) AS "Order_Key",
       CAST(l_linenumber AS VARCHAR) AS "Line_Number", CAST(l_partkey AS VARCHAR) AS "Part_Key",
       CAST(l_suppkey AS VARCHAR) AS "Supplier_Key"
FROM raw"""

ORACLE["ingest_stamp"] = """
SELECT *, 'given:orders' AS _source, true AS is_stamped FROM orders"""

ORACLE["rename_audit"] = f"WITH {SHIPMENTS} " + " UNION ALL ".join(
    f"""SELECT {position} AS position, '{original}' AS original, '{technical}' AS technical,
        count({column}) AS n_values FROM raw"""
    for position, original, technical, column in [
        (0, "Ship Date", "Ship_Date", "ship_date"),
        (1, "Net Price (index)", "Net_Price_index", "net"),
        (3, "Extended Price, USD", "Extended_Price_USD", "price"),
        (4, "Tax %", "Tax", "tax_text"),
        (5, "Order Key", "Order_Key", "l_orderkey"),
        (6, "Line Number", "Line_Number", "l_linenumber"),
        (7, "Part Key", "Part_Key", "l_partkey"),
        (8, "Supplier Key", "Supplier_Key", "l_suppkey"),
    ]
)

# --- Silver ---------------------------------------------------------------------------

ORACLE["conform_select"] = """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price
FROM orders"""

ORACLE["parse_date_lenient"] = f"WITH {DIRTY} SELECT o_orderkey, raw_date, day FROM typed"

ORACLE["cast_numeric_lenient"] = f"WITH {DIRTY} SELECT o_orderkey, price FROM typed"

ORACLE["calendar_parts"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders"""

ORACLE["clean_dates"] = f"WITH {DIRTY} SELECT day, price, o_orderkey FROM dated"

ORACLE["domain_nonnegative"] = f"""
WITH {DIRTY} SELECT day, price, o_orderkey FROM typed WHERE price IS NULL OR price >= 0"""

FIRST_LINES = """first_lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM (SELECT *, row_number() OVER (
          PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                   l_returnflag, l_linestatus, l_shipdate) AS rn
        FROM lineitem)
  WHERE rn = 1)"""

ORACLE["dedup_keep_first"] = f"WITH {FIRST_LINES} SELECT * FROM first_lines"

ORACLE["clean_rules"] = f"WITH {DIRTY} SELECT day, price, o_orderkey FROM silver"

ORACLE["clean_survivors"] = f"""
WITH {DIRTY} SELECT day AS raw_date, price AS raw_price FROM silver"""

ORACLE["clean_funnel"] = f"""
WITH {DIRTY},
n AS (SELECT (SELECT count(*) FROM typed) AS a, (SELECT count(*) FROM dated) AS b,
             (SELECT count(*) FROM firsts) AS c, (SELECT count(*) FROM silver) AS d)
SELECT 1 AS step, 'valid_date' AS rule, a AS rows_in, a - b AS rows_dropped, b AS rows_out FROM n
UNION ALL SELECT 2, 'first_per_date', b, b - c, c FROM n
UNION ALL SELECT 3, 'non_negative', c, c - d, d FROM n"""

# --- Gold -----------------------------------------------------------------------------

ORACLE["dim_entity"] = """
SELECT row_number() OVER (ORDER BY c_name) AS entity_id, c_name AS entity_name
FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL)"""

ORACLE["unpivot_long"] = f"""
WITH {WIDE}
SELECT date, CAST(substr(col, 2) AS INTEGER) AS entity, value
FROM (SELECT * EXCLUDE (idx) FROM wide) UNPIVOT (value FOR col IN (p1, p2, p3, p4, p5))"""

ORACLE["pivot_wide"] = f"""
WITH {PRIORITY}
SELECT date, {', '.join(f'max(value) FILTER (WHERE entity_id = {k}) AS p{k}' for k in range(1, 6))}
FROM panel GROUP BY date"""

ORACLE["join_dim"] = f"""
WITH {PRIORITY}, {DIM}
SELECT entity_id, panel.date, panel.value, entity_name FROM panel JOIN dim USING (entity_id)"""

ORACLE["union_sources"] = f"""
WITH {FLAG}, {EVENT} SELECT date, entity, value FROM flag
UNION ALL BY NAME SELECT value, entity, date FROM event"""

ORACLE["benchmark_align"] = f"""
WITH {PRIORITY}, {BENCHMARK}
SELECT date, entity, value, benchmark FROM panel LEFT JOIN bench USING (date)"""

ORACLE["annual_stats"] = f"""
WITH {PRIORITY}
SELECT CAST(year(date) AS INTEGER) AS year, entity, round(avg(value), 4) AS mean_value,
       min(value) AS min_value, max(value) AS max_value,
       round(stddev_samp(value), 4) AS sd_value
FROM panel GROUP BY 1, 2"""

ORACLE["mom_change"] = f"""
WITH {PRIORITY}, {_moves('entity')}
SELECT date, entity, value, round(change_pct, 6) AS change_pct FROM moves"""

ORACLE["mom_change_customer"] = f"""
WITH {CUSTOMER}, {_moves('entity')}
SELECT date, entity, value, round(change_pct, 6) AS change_pct FROM moves"""

ORACLE["daily_change_event"] = f"""
WITH {EVENT}, panel AS (SELECT * FROM event), {_moves('entity')}
SELECT date, entity, value, round(change_pct, 6) AS change_pct FROM moves"""

ORACLE["preview_ordered"] = f"""
WITH {PRIORITY} SELECT date, entity, value FROM panel ORDER BY date, entity LIMIT 10"""

# --- Answers --------------------------------------------------------------------------

ORACLE["evolution_selected"] = f"""
WITH {PRIORITY}, {DIM}
SELECT date, entity_name, value FROM panel JOIN dim USING (entity_id)
WHERE entity_name IN ('1-URGENT', '2-HIGH') ORDER BY date, entity_name"""

ORACLE["volatility_overall"] = f"""
WITH {PRIORITY}, {_moves('entity')}
SELECT entity, round(stddev_samp(change_pct), 6) AS volatility
FROM moves GROUP BY entity ORDER BY volatility DESC, entity"""

YEARLY = """yearly AS (
  SELECT CAST(year(date) AS INTEGER) AS year, entity, stddev_samp(change_pct) AS volatility
  FROM moves GROUP BY 1, 2)"""

ORACLE["volatility_by_year"] = f"""
WITH {PRIORITY}, {_moves('entity')}, {YEARLY}
SELECT year, entity, round(volatility, 6) AS volatility FROM yearly
WHERE entity IN ('1-URGENT', '2-HIGH')"""

ORACLE["volatility_peak_year"] = f"""
WITH {PRIORITY}, {_moves('entity')}, {YEARLY},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY volatility DESC NULLS LAST, year) AS rn
  FROM yearly)
SELECT entity, CASE WHEN volatility > 0 THEN year END AS peak_year,
       round(volatility, 6) AS peak_volatility
FROM ranked WHERE rn = 1"""

ORACLE["top_moves"] = f"""
WITH {BRAND}, {_moves('entity_id')},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY change_pct DESC, date, entity_id) AS up,
         row_number() OVER (ORDER BY change_pct, date, entity_id) AS down
  FROM moves)
SELECT date, entity_id, value, round(change_pct, 6) AS change_pct, 'rise' AS direction,
       CAST(up AS INTEGER) AS rank
FROM ranked WHERE up <= 5
UNION ALL
SELECT date, entity_id, value, round(change_pct, 6), 'fall', CAST(down AS INTEGER)
FROM ranked WHERE down <= 5"""

ORACLE["top_moves_per_entity"] = f"""
WITH {BRAND}, {_moves('entity_id')},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY change_pct DESC, date) AS up,
         row_number() OVER (PARTITION BY entity_id ORDER BY change_pct, date) AS down
  FROM moves)
SELECT date, entity_id, value, round(change_pct, 6) AS change_pct, 'rise' AS direction,
       CAST(up AS INTEGER) AS rank
FROM ranked WHERE up <= 3
UNION ALL
SELECT date, entity_id, value, round(change_pct, 6), 'fall', CAST(down AS INTEGER)
FROM ranked WHERE down <= 3"""

ORACLE["outliers_3sigma"] = (
    f"WITH {BRAND}, {_moves('entity_id')}, {OUTLIERS.format(key='entity_id')}"
)

ORACLE["outliers_customer"] = (
    f"WITH {CUSTOMER}, {_moves('entity')}, {OUTLIERS.format(key='entity')}"
)

ORACLE["rebase_100"] = f"""
WITH {PRIORITY},
based AS (
  SELECT *, first_value(value) OVER (PARTITION BY entity ORDER BY date) AS base FROM panel)
SELECT date, entity, value, round(value / nullif(base, 0) * 100, 6) AS index_100 FROM based"""

ORACLE["growth_period"] = f"""
WITH {PRIORITY},
ends AS (
  SELECT entity, arg_min(value, date) AS first_value, arg_max(value, date) AS last_value
  FROM panel GROUP BY entity)
SELECT entity, first_value, last_value,
       round((last_value - first_value) / nullif(first_value, 0) * 100, 6) AS growth_pct
FROM ends"""

ORACLE["correlation_matrix"] = f"WITH {PRIORITY}, {_matrix()}"

ORACLE["correlation_matrix_brand"] = f"WITH {BRAND}, {_matrix()}"

ORACLE["correlation_sparse"] = f"""
WITH panel AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         CAST(year(o_orderdate) * 10 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS INTEGER)
           AS entity_id,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100
           / count(o_totalprice) AS value
  FROM orders GROUP BY 1, 2),
{_matrix()}"""

ORACLE["correlation_benchmark"] = f"""
WITH {PRIORITY}, {BENCHMARK},
related AS (
  SELECT entity, {_corr('value', 'benchmark')} AS c, count(benchmark) AS n
  FROM panel LEFT JOIN bench USING (date) GROUP BY entity)
SELECT entity, round({_clip('c')}, 6) AS corr, n FROM related"""

# --- Quality --------------------------------------------------------------------------

ORACLE["quality_completeness"] = f"WITH {WIDE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_missing,
        round((count(*) - count({c})) / nullif(count(*), 0) * 100, 4) AS missing_pct FROM wide"""
    for c in ("p1", "p2", "p3", "p4", "p5", "idx")
)

ORACLE["quality_nulls_stage"] = f"""
WITH {DIRTY}
SELECT 'input' AS stage, 'raw_date' AS "column",
       count(*) FILTER (WHERE raw_date IS NULL) AS n_missing,
       count(*) FILTER (WHERE raw_date IS NOT NULL AND day IS NULL) AS n_unparseable FROM typed
UNION ALL
SELECT 'input', 'raw_price', count(*) FILTER (WHERE raw_price IS NULL),
       count(*) FILTER (WHERE raw_price IS NOT NULL AND price IS NULL) FROM typed
UNION ALL
SELECT 'output', 'raw_date', count(*) FILTER (WHERE day IS NULL), CAST(0 AS BIGINT) FROM silver
UNION ALL
SELECT 'output', 'raw_price', count(*) FILTER (WHERE price IS NULL), CAST(0 AS BIGINT)
FROM silver"""

ORACLE["quality_consistency"] = f"""
WITH {DIRTY},
n AS (
  SELECT count(*) AS rows_in, count(*) FILTER (WHERE raw_date IS NULL) AS absent_dates,
         count(*) FILTER (WHERE raw_date IS NOT NULL AND day IS NULL) AS unreadable_dates,
         (SELECT count(*) FROM silver) AS rows_out
  FROM typed)
SELECT *, rows_in - rows_out AS rows_discarded FROM n"""

ORACLE["quality_uniqueness"] = f"""
WITH {FIRST_LINES},
sizes AS (
  SELECT 'input' AS stage, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
  UNION ALL
  SELECT 'output', count(*) FROM first_lines GROUP BY l_orderkey, l_linenumber)
SELECT stage, CAST(sum(n) AS BIGINT) AS n_rows, count(*) FILTER (WHERE n > 1) AS duplicated_keys,
       CAST(sum(n - 1) AS BIGINT) AS surplus_rows
FROM sizes GROUP BY stage"""

ORACLE["quality_accuracy"] = """
SELECT 'input' AS stage, 'c_acctbal' AS "column",
       count(*) FILTER (WHERE c_acctbal < 0) AS n_negative FROM customer
UNION ALL
SELECT 'output', 'c_acctbal', count(*) FILTER (WHERE c_acctbal < 0)
FROM customer WHERE c_acctbal IS NULL OR c_acctbal >= 0
UNION ALL
SELECT 'input', 's_acctbal', count(*) FILTER (WHERE s_acctbal < 0) FROM supplier
UNION ALL
SELECT 'output', 's_acctbal', count(*) FILTER (WHERE s_acctbal < 0)
FROM supplier WHERE s_acctbal IS NULL OR s_acctbal >= 0"""

ORACLE["quality_coverage"] = """
SELECT CAST(min(l_shipdate) AS DATE) AS first_date, CAST(max(l_shipdate) AS DATE) AS last_date
FROM lineitem"""

ORACLE["quality_report"] = f"""
WITH {DIRTY},
sizes AS (SELECT day, count(*) AS n FROM typed GROUP BY day),
lagged AS (
  SELECT day, price, lag(price) OVER (ORDER BY day) AS prev FROM silver WHERE price IS NOT NULL),
moves AS (SELECT (price - prev) / nullif(prev, 0) * 100 AS c FROM lagged WHERE prev <> 0),
flagged AS (
  SELECT count(*) AS n FROM moves, (SELECT avg(c) AS m, stddev_samp(c) AS s FROM moves)
  WHERE s > 0 AND abs(c - m) > 3 * s),
i AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE raw_date IS NULL) AS d0,
         count(*) FILTER (WHERE raw_date IS NOT NULL AND day IS NULL) AS d1,
         count(*) FILTER (WHERE raw_price IS NULL) AS p0,
         count(*) FILTER (WHERE raw_price IS NOT NULL AND price IS NULL) AS p1,
         count(*) FILTER (WHERE price < 0) AS neg
  FROM typed),
o AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE day IS NULL) AS d0,
         count(*) FILTER (WHERE price IS NULL) AS p0,
         count(*) FILTER (WHERE price < 0) AS neg, min(day) AS lo, max(day) AS hi
  FROM silver),
u AS (SELECT count(*) FILTER (WHERE n > 1) AS dup, sum(n - 1) AS surplus FROM sizes),
uo AS (SELECT count(*) FILTER (WHERE n > 1) AS dup, sum(n - 1) AS surplus
       FROM (SELECT day, count(*) AS n FROM silver GROUP BY day)),
rows(dimension, stage, "column", metric, value, day) AS (
  SELECT 'completeness', 'input', 'raw_date', 'missing', CAST(d0 AS DOUBLE), NULL::DATE FROM i
  UNION ALL SELECT 'completeness', 'input', 'raw_date', 'unparseable', d1, NULL FROM i
  UNION ALL SELECT 'completeness', 'input', 'raw_price', 'missing', p0, NULL FROM i
  UNION ALL SELECT 'completeness', 'input', 'raw_price', 'unparseable', p1, NULL FROM i
  UNION ALL SELECT 'completeness', 'output', 'raw_date', 'missing', d0, NULL FROM o
  UNION ALL SELECT 'completeness', 'output', 'raw_date', 'missing_pct',
                   CAST(d0 AS DOUBLE) / nullif(n, 0) * 100, NULL FROM o
  UNION ALL SELECT 'completeness', 'output', 'raw_price', 'missing', p0, NULL FROM o
  UNION ALL SELECT 'completeness', 'output', 'raw_price', 'missing_pct',
                   CAST(p0 AS DOUBLE) / nullif(n, 0) * 100, NULL FROM o
  UNION ALL SELECT 'consistency', 'input', NULL, 'rows', n, NULL FROM i
  UNION ALL SELECT 'consistency', 'output', NULL, 'rows', n, NULL FROM o
  UNION ALL SELECT 'consistency', 'output', NULL, 'rows_discarded', i.n - o.n, NULL FROM i, o
  UNION ALL SELECT 'uniqueness', 'input', 'raw_date', 'duplicated_keys', dup, NULL FROM u
  UNION ALL SELECT 'uniqueness', 'input', 'raw_date', 'surplus_rows', surplus, NULL FROM u
  UNION ALL SELECT 'uniqueness', 'output', 'raw_date', 'duplicated_keys', dup, NULL FROM uo
  UNION ALL SELECT 'uniqueness', 'output', 'raw_date', 'surplus_rows', surplus, NULL FROM uo
  UNION ALL SELECT 'coverage', 'output', 'raw_date', 'first', NULL, lo FROM o
  UNION ALL SELECT 'coverage', 'output', 'raw_date', 'last', NULL, hi FROM o
  UNION ALL SELECT 'accuracy', 'input', 'raw_price', 'negative', neg, NULL FROM i
  UNION ALL SELECT 'accuracy', 'output', 'raw_price', 'negative', neg, NULL FROM o
  UNION ALL SELECT 'outliers', 'output', NULL, 'beyond_sigmas', n, NULL FROM flagged)
SELECT dimension, stage, "column", metric, round(value, 4) AS value, day FROM rows"""

# --- Raw file to answers --------------------------------------------------------------

ORACLE["silver_table"] = f"""
WITH {SHIPMENTS} SELECT day, idx, quantity, extended_price, tax, year, month FROM silver"""

ORACLE["gold_monthly"] = f"""
WITH {SHIPMENTS} SELECT day, year, month, entity_id, value FROM monthly"""

ORACLE["gold_annual"] = f"""
WITH {SHIPMENTS}
SELECT year, entity_id, round(avg(value), 4) AS mean_value, min(value) AS min_value,
       max(value) AS max_value, round(stddev_samp(value), 4) AS sd_value
FROM monthly GROUP BY 1, 2"""

ORACLE["gold_change"] = f"""
WITH {SHIPMENTS}
SELECT day, year, month, entity_id, value, round(change_pct, 6) AS change_pct FROM moves"""

ORACLE["answer_evolution"] = f"""
WITH {SHIPMENTS}
SELECT day, entity_name, value FROM monthly JOIN dim USING (entity_id)
WHERE entity_name IN ('Quantity', 'Extended price') ORDER BY day, entity_name"""

SHIPMENT_PAIRS = f"""pairs AS (
  SELECT a.entity_id AS ia, b.entity_id AS ib, {_corr('a.value', 'b.value')} AS c, count(*) AS n
  FROM monthly a JOIN monthly b USING (day) GROUP BY 1, 2),
named_pairs AS (
  SELECT x.entity_name AS name_a, y.entity_name AS name_b, {_clip('c')} AS corr, n
  FROM pairs JOIN dim x ON x.entity_id = ia JOIN dim y ON y.entity_id = ib)"""

ORACLE["answer_correlation"] = f"""
WITH {SHIPMENTS}, {SHIPMENT_PAIRS}
SELECT name_a, name_b, round(corr, 6) AS corr, n FROM named_pairs"""

ORACLE["answer_volatility"] = f"""
WITH {SHIPMENTS}
SELECT entity_name, round(stddev_samp(change_pct), 4) AS volatility
FROM moves JOIN dim USING (entity_id) GROUP BY entity_name ORDER BY volatility DESC, entity_name"""

SHIPMENT_YEARLY = """yearly AS (
  SELECT year, entity_name, stddev_samp(change_pct) AS volatility
  FROM moves JOIN dim USING (entity_id) GROUP BY 1, 2)"""

ORACLE["answer_volatility_by_year"] = f"""
WITH {SHIPMENTS}, {SHIPMENT_YEARLY}
SELECT year, entity_name, round(volatility, 4) AS volatility FROM yearly
WHERE entity_name IN ('Quantity', 'Extended price')"""

ORACLE["answer_volatility_peak"] = f"""
WITH {SHIPMENTS}, {SHIPMENT_YEARLY},
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY entity_name ORDER BY volatility DESC NULLS LAST, year) AS rn
  FROM yearly)
SELECT entity_name, CASE WHEN volatility > 0 THEN year END AS peak_year,
       round(volatility, 4) AS peak_volatility
FROM ranked WHERE rn = 1"""

ORACLE["answer_correlation_wide"] = f"""
WITH {SHIPMENTS}, {SHIPMENT_PAIRS}
SELECT name_a,
       round(max(corr) FILTER (WHERE name_b = 'Quantity'), 6) AS "Quantity",
       round(max(corr) FILTER (WHERE name_b = 'Extended price'), 6) AS "Extended price",
       round(max(corr) FILTER (WHERE name_b = 'Tax'), 6) AS "Tax"
FROM named_pairs GROUP BY name_a"""

ORACLE["answer_outliers"] = f"""
WITH {SHIPMENTS},
scored AS (
  SELECT *, avg(change_pct) OVER (PARTITION BY entity_id) AS m,
         stddev_samp(change_pct) OVER (PARTITION BY entity_id) AS s
  FROM moves)
SELECT day, entity_name, value, round(change_pct, 6) AS change_pct
FROM scored JOIN dim USING (entity_id) WHERE s > 0 AND abs(change_pct - m) > 3 * s"""

ORACLE["answer_extremes"] = f"""
WITH {SHIPMENTS},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY change_pct DESC, day, entity_id) AS up,
         row_number() OVER (ORDER BY change_pct, day, entity_id) AS down
  FROM moves)
SELECT 'rise' AS direction, CAST(up AS INTEGER) AS rank, day, entity_name,
       round(change_pct, 4) AS change_pct
FROM ranked JOIN dim USING (entity_id) WHERE up <= 10
UNION ALL
SELECT 'fall', CAST(down AS INTEGER), day, entity_name, round(change_pct, 4)
FROM ranked JOIN dim USING (entity_id) WHERE down <= 10"""

ORACLE["answer_rebased"] = f"""
WITH {SHIPMENTS},
series AS (
  SELECT day, entity_name, value FROM monthly JOIN dim USING (entity_id)
  WHERE entity_name IN ('Quantity', 'Extended price')
  UNION ALL SELECT day, 'idx', idx FROM silver WHERE idx IS NOT NULL),
based AS (
  SELECT *, first_value(value) OVER (PARTITION BY entity_name ORDER BY day) AS base FROM series)
SELECT day, entity_name, value, round(value / nullif(base, 0) * 100, 6) AS index_100 FROM based"""

ORACLE["load_silver"] = ORACLE["silver_table"]

ORACLE["load_funnel"] = f"""
WITH {SHIPMENTS},
n AS (SELECT (SELECT count(*) FROM typed) AS a,
             (SELECT count(*) FROM typed WHERE day IS NOT NULL) AS b,
             (SELECT count(*) FROM firsts WHERE rn = 1) AS c, (SELECT count(*) FROM silver) AS d)
SELECT 1 AS step, 'valid_date' AS rule, a AS rows_in, a - b AS rows_dropped, b AS rows_out FROM n
UNION ALL SELECT 2, 'first_per_date', b, b - c, c FROM n
UNION ALL SELECT 3, 'non_negative', c, c - d, d FROM n"""

ORACLE["analysis_report"] = f"""
WITH {SHIPMENTS}, {SHIPMENT_PAIRS},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY change_pct DESC, day, entity_id) AS up,
         row_number() OVER (ORDER BY change_pct, day, entity_id) AS down
  FROM moves),
related AS (
  SELECT entity_id, {_corr('value', 'idx')} AS c
  FROM monthly LEFT JOIN (SELECT day, idx FROM silver) USING (day) GROUP BY entity_id),
ends AS (
  SELECT entity_id, arg_min(value, day) AS f, arg_max(value, day) AS l
  FROM monthly GROUP BY entity_id),
report(metric, entity, other, day, value) AS (
  SELECT 'correlation', name_a, name_b, NULL::DATE, corr FROM named_pairs WHERE name_a < name_b
  UNION ALL SELECT 'volatility', entity_name, NULL, NULL, stddev_samp(change_pct)
            FROM moves JOIN dim USING (entity_id) GROUP BY entity_name
  UNION ALL SELECT 'rise', entity_name, NULL, day, change_pct
            FROM ranked JOIN dim USING (entity_id) WHERE up <= 5
  UNION ALL SELECT 'fall', entity_name, NULL, day, change_pct
            FROM ranked JOIN dim USING (entity_id) WHERE down <= 5
  UNION ALL SELECT 'benchmark_correlation', entity_name, NULL, NULL, {_clip('c')}
            FROM related JOIN dim USING (entity_id)
  UNION ALL SELECT 'growth', entity_name, NULL, NULL, (l - f) / nullif(f, 0) * 100
            FROM ends JOIN dim USING (entity_id))
SELECT metric, entity, other, day, round(value, 4) AS value FROM report"""

# --- Tables written by jobs -----------------------------------------------------------

ORACLE["csv_text"] = ORACLE["normalise_names"].replace(
    "\nFROM raw", ", CAST(NULL AS VARCHAR) AS _corrupt_record\nFROM raw"
)

ORACLE["csv_multiline"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS key,
       CASE o_orderkey % 6
         WHEN 0 THEN o_orderpriority || chr(10) || 'second "line", ' || o_orderstatus
         WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN chr(10) || chr(10)
         WHEN 4 THEN o_orderpriority || ', x' ELSE o_orderpriority END AS a_note,
       CAST(NULL AS VARCHAR) AS _corrupt_record
FROM orders"""

ORACLE["csv_malformed"] = """
WITH cells AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS key,
         CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS cents,
         o_orderkey % 7 = 0 AS longer, o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0 AS shorter
  FROM orders)
SELECT key, CASE WHEN NOT shorter THEN cents END AS cents,
       CASE WHEN longer THEN key || ',' || cents || ',EXTRA' WHEN shorter THEN key END
         AS _corrupt_record
FROM cells"""

FILES_FIRST = SHIPMENTS.replace(
    "ORDER BY l_orderkey,", "ORDER BY CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END, l_orderkey,"
)
ORACLE["load_files_first"] = f"""
WITH {FILES_FIRST} SELECT day, idx, quantity, extended_price, tax, year, month FROM silver"""

ORACLE["analysis_document"] = f"""
WITH {SHIPMENTS}, {SHIPMENT_PAIRS},
related AS (
  SELECT entity_name, {_corr('value', 'idx')} AS c
  FROM monthly LEFT JOIN (SELECT day, idx FROM silver) USING (day) JOIN dim USING (entity_id)
  GROUP BY entity_name),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY change_pct DESC, day, entity_id) AS up,
         row_number() OVER (ORDER BY change_pct, day, entity_id) AS down
  FROM moves),
swings AS (
  SELECT entity_name, stddev_samp(change_pct) AS sd
  FROM moves JOIN dim USING (entity_id) GROUP BY entity_name),
ends AS (
  SELECT entity_name, (arg_max(value, day) - arg_min(value, day)) / arg_min(value, day) * 100 AS g
  FROM monthly JOIN dim USING (entity_id) GROUP BY entity_name)
SELECT
  (SELECT round(corr, 3) FROM named_pairs WHERE name_a = 'Extended price' AND name_b = 'Quantity')
    AS "correlation_Extended_price_Quantity",
  {', '.join(f"""(SELECT {value} FROM ranked JOIN dim USING (entity_id) WHERE {order} = {place})
                 AS "{side}_{place}_{name}" """
             for side, order in (('rises', 'up'), ('falls', 'down')) for place in range(1, 6)
             for name, value in (('day', 'day'), ('entity_name', 'entity_name'),
                                 ('change_pct', 'round(change_pct, 4)')))},
  {', '.join(f"""(SELECT round(sd, 2) FROM swings WHERE entity_name = '{n}') AS "volatility_{n.replace(' ', '_')}" """
             for n in ('Quantity', 'Extended price', 'Tax'))},
  {', '.join(f"""(SELECT round({_clip('c')}, 3) FROM related WHERE entity_name = '{n}')
                 AS "benchmark_{n.replace(' ', '_')}", (SELECT round(g, 1) FROM ends WHERE entity_name = '{n}')
                 AS "growth_{n.replace(' ', '_')}" """ for n in ('Quantity', 'Extended price'))}"""


def _document_counts() -> str:
    raw = {"day": "ship_date", "idx": "net", "quantity": "qty", "extended_price": "price", "tax": "tax_text"}
    parts = []
    for name in raw:
        column = "day" if name == "day" else name
        parts.append(f"""(SELECT count(*) FROM typed WHERE {column} IS NULL) -
          (SELECT count(*) FROM raw_texts WHERE {raw[name]} IS NOT NULL AND {column} IS NULL)
          AS "missing_in_{name}" """)
        parts.append(f"""(SELECT count(*) FROM silver WHERE {column} IS NULL) AS "missing_out_{name}" """)
        if name != "day":
            parts.append(f"""(SELECT count(*) FROM typed WHERE {name} < 0) AS "negative_{name}" """)
    return ", ".join(parts)


ORACLE["quality_document"] = f"""
WITH {SHIPMENTS},
raw_texts AS (
  SELECT *, try_cast(ship_date AS DATE) AS day, try_cast(net AS DOUBLE) AS idx,
         try_cast(qty AS DOUBLE) AS quantity, try_cast(price AS DOUBLE) AS extended_price,
         try_cast(tax_text AS DOUBLE) AS tax
  FROM raw),
sizes AS (SELECT day, count(*) AS n FROM typed GROUP BY day)
SELECT {_document_counts()},
  (SELECT count(*) FROM silver WHERE day IS NULL) AS "missing_out_year",
  (SELECT count(*) FROM silver WHERE day IS NULL) AS "missing_out_month",
  (SELECT min(day) FROM silver) AS "coverage_first", (SELECT max(day) FROM silver) AS "coverage_last",
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM sizes) AS surplus,
  (SELECT count(*) FROM typed WHERE day IS NULL) AS undated,
  (SELECT count(*) FROM typed) AS rows_in, (SELECT count(*) FROM silver) AS rows_out"""
ORACLE["json_report"] = ORACLE["analysis_report"]
ORACLE["job_change"] = ORACLE["gold_change"]
ORACLE["refresh_change"] = ORACLE["gold_change"]

# --- Projections ------------------------------------------------------------------------

NUMBERED = """numbered AS (
  SELECT *, CAST(year(date) * 12 + month(date) - 1 AS INTEGER) AS period FROM panel WHERE value IS NOT NULL)"""


def _line(key: str, horizon: int, unit: str, rows: str, date: str = "date") -> str:
    """The least-squares line of the CTE ``rows`` with period numbers ``period``."""
    return f"""fit AS (
  SELECT {key}, count(*) AS n, max({date}) AS last_date, max(period) AS last_at, avg(period) AS mean_at,
         avg(value) AS mean, regr_sxx(value, period) AS sxx, regr_syy(value, period) AS syy,
         regr_sxy(value, period) AS sxy
  FROM {rows} GROUP BY {key}),
sloped AS (SELECT *, sxy / nullif(sxx, 0) AS slope FROM fit),
spread AS (
  SELECT *, CASE WHEN n > 2 THEN sqrt(greatest(syy - slope * sxy, 0) / (n - 2)) END AS residual_sd
  FROM sloped),
ahead AS (
  SELECT *, CAST(unnest(range(1, {horizon + 1})) AS INTEGER) AS step FROM spread),
projected AS (
  SELECT {key}, step, CAST(last_date + to_{unit}s(step) AS DATE) AS {date}, n, slope, residual_sd,
         mean + slope * (last_at + step - mean_at) AS projected,
         1.96 * residual_sd * sqrt(1 + 1.0 / n + pow(last_at + step - mean_at, 2) / nullif(sxx, 0)) AS margin
  FROM ahead)"""


ORACLE["projection_trend"] = f"""
WITH {BRAND}, {NUMBERED}, {_line("entity_id", 6, "month", "numbered")}
SELECT entity_id, step, date, n, round(slope, 4) AS slope, round(residual_sd, 4) AS residual_sd,
       round(projected, 4) AS projected, round(projected - margin, 4) AS low,
       round(projected + margin, 4) AS high
FROM projected"""

ORACLE["answer_projection"] = f"""
WITH {SHIPMENTS},
numbered AS (
  SELECT day, entity_name, value, CAST(date_diff('day', DATE '1970-01-01', day) AS INTEGER) AS period
  FROM monthly JOIN dim USING (entity_id) WHERE entity_name IN ('Quantity', 'Extended price')),
{_line("entity_name", 5, "day", "numbered", "day")}
SELECT entity_name, step, day, n, round(slope, 4) AS slope, round(residual_sd, 4) AS residual_sd,
       round(projected, 4) AS projected, round(projected - margin, 4) AS low,
       round(projected + margin, 4) AS high
FROM projected"""

ORACLE["seasonal_change"] = f"""
WITH {CUSTOMER}, {NUMBERED}
SELECT a.date, a.entity, a.value, b.value AS season_value,
       round((a.value - b.value) / nullif(b.value, 0) * 100, 6) AS season_change_pct
FROM numbered a LEFT JOIN numbered b ON a.entity = b.entity AND a.period = b.period + 12"""

ORACLE["projection_seasonal"] = f"""
WITH {BRAND}, {NUMBERED},
drifts AS (
  SELECT a.entity_id, avg(a.value - b.value) AS drift
  FROM numbered a JOIN numbered b ON a.entity_id = b.entity_id AND a.period = b.period + 12 GROUP BY 1),
lasts AS (SELECT entity_id, max(period) AS last_at FROM numbered GROUP BY 1),
ahead AS (
  SELECT entity_id, CAST(unnest(range(1, 19)) AS INTEGER) AS step, last_at FROM lasts)
SELECT h.entity_id, step, CAST(date + to_months(12 * ((step + 11) // 12)) AS DATE) AS date,
       date AS based_on, value AS projected,
       round(value + ((step + 11) // 12) * coalesce(drift, 0), 4) AS projected_drift
FROM ahead h JOIN numbered p ON p.entity_id = h.entity_id AND p.period = last_at + step - 12 * ((step + 11) // 12)
LEFT JOIN drifts d ON d.entity_id = h.entity_id"""

_TRIED = " UNION ALL ".join(
    f"""SELECT o.entity_id, '{method}' AS method, {step} AS step, {projected} AS projected, f.value AS actual
  FROM known o JOIN numbered f ON f.entity_id = o.entity_id AND f.period = o.period + {step} {joined}"""
    for step in (1, 2, 3)
    for method, projected, joined in (
        ("trend", f"mean + slope * (o.period + {step} - mean_at)", ""),
        ("seasonal", "s.value", f"JOIN numbered s ON s.entity_id = o.entity_id AND s.period = o.period + {step} - 12"),
    )
)
ORACLE["projection_backtest"] = f"""
WITH {BRAND}, {NUMBERED},
known AS (
  SELECT a.entity_id, a.period, count(*) AS n, avg(b.value) AS mean, avg(b.period) AS mean_at,
         regr_slope(b.value, b.period) AS slope
  FROM numbered a JOIN numbered b ON a.entity_id = b.entity_id AND b.period <= a.period
  GROUP BY 1, 2 HAVING count(*) >= 24),
tried AS ({_TRIED})
SELECT entity_id, method, step, count(*) AS n, round(avg(abs(projected - actual)), 4) AS mae,
       round(sqrt(avg(pow(projected - actual, 2))), 4) AS rmse,
       round(avg(abs(projected - actual) / nullif(abs(actual), 0)) * 100, 4) AS mape,
       round(avg(projected - actual), 4) AS bias
FROM tried WHERE projected IS NOT NULL GROUP BY 1, 2, 3"""

# --- Prices with volumes ------------------------------------------------------------------

MATCHED = """prices AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_partkey AS entity,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
           / nullif(CAST(sum(CAST(round(l_quantity * 100) AS BIGINT)) AS DOUBLE), 0) AS price
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
volumes AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_partkey AS entity,
         CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS DOUBLE) AS volume
  FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2),
matched AS (
  SELECT coalesce(p.date, v.date) AS date, coalesce(p.entity, v.entity) AS entity, price, volume,
         CASE WHEN price IS NULL THEN 'volume_only' WHEN volume IS NULL THEN 'price_only'
              ELSE 'both' END AS side
  FROM prices p FULL OUTER JOIN volumes v ON p.date = v.date AND p.entity = v.entity)"""

_INDEX = """
SELECT date, count(*) FILTER (WHERE side = 'both') AS n_entities,
       sum(volume) FILTER (WHERE side = 'both') AS volume,
       round(sum(price * volume) FILTER (WHERE side = 'both'), 2) AS turnover,
       round(sum(price * volume) FILTER (WHERE side = 'both')
             / nullif(sum(volume) FILTER (WHERE side = 'both'), 0), 6) AS unit_value,
       round(sum(price * volume) FILTER (WHERE side = 'both' AND base IS NOT NULL)
             / nullif(sum(base * volume) FILTER (WHERE side = 'both'), 0) * 100, 6) AS index_100,
       round(sum(volume) FILTER (WHERE side = 'both') / nullif(sum(volume), 0) * 100, 6) AS matched_pct
FROM based GROUP BY date"""

ORACLE["price_volume"] = f"""
WITH {MATCHED},
based AS (SELECT m.*, p_retailprice AS base FROM matched m LEFT JOIN part ON p_partkey = entity)
{_INDEX}"""

ORACLE["price_volume_own_base"] = f"""
WITH {MATCHED},
firsts AS (SELECT entity, arg_min(price, date) AS base FROM matched WHERE side = 'both' GROUP BY 1),
based AS (SELECT m.*, base FROM matched m LEFT JOIN firsts USING (entity))
{_INDEX}"""

ORACLE["price_volume_unmatched"] = f"""
WITH {MATCHED},
alls AS (SELECT date, sum(volume) AS every FROM matched GROUP BY 1)
SELECT date, side, count(*) AS n_entities, sum(volume) AS volume,
       round(sum(volume) / nullif(max(every), 0) * 100, 6) AS volume_pct
FROM matched JOIN alls USING (date) WHERE side <> 'both' GROUP BY 1, 2"""

# --- Loads and events that arrive -----------------------------------------------------------

THREE_LOADS = SHIPMENTS.replace(
    "ORDER BY l_orderkey,", "ORDER BY least((l_linenumber - 1) // 2, 2), l_orderkey,"
).replace(
    "tax, qty, price, tax_text,", "tax, ship_date, net, qty, price, tax_text,"
)

_TEXTS = {"idx": "net", "quantity": "qty", "extended_price": "price", "tax": "tax_text"}


def _loads_report() -> str:
    raw = {"day": "ship_date", **_TEXTS}
    rows = [
        ("consistency", "input", None, "rows", "(SELECT count(*) FROM typed)", None),
        ("consistency", "output", None, "rows", "(SELECT count(*) FROM silver)", None),
        ("consistency", "output", None, "rows_discarded",
         "(SELECT count(*) FROM typed) - (SELECT count(*) FROM silver)", None),
        ("coverage", "output", "day", "first", None, "(SELECT min(day) FROM silver)"),
        ("coverage", "output", "day", "last", None, "(SELECT max(day) FROM silver)"),
        ("outliers", "output", None, "beyond_sigmas", "(SELECT count(*) FROM flagged)", None),
    ]
    for stage, table in (("input", "typed"), ("output", "silver")):
        sizes = f"(SELECT count(*) AS n FROM {table} GROUP BY day)"
        rows += [
            ("uniqueness", stage, "day", "duplicated_keys", f"(SELECT count(*) FROM {sizes} WHERE n > 1)", None),
            ("uniqueness", stage, "day", "surplus_rows", f"(SELECT sum(n - 1) FROM {sizes})", None),
        ]
    for name, text in raw.items():
        gone = f"(SELECT count(*) FROM silver WHERE {name} IS NULL)"
        rows += [
            ("completeness", "input", name, "missing", f"(SELECT count(*) FROM typed WHERE {text} IS NULL)", None),
            ("completeness", "input", name, "unparseable",
             f"(SELECT count(*) FROM typed WHERE {text} IS NOT NULL AND {name} IS NULL)", None),
            ("completeness", "output", name, "missing", gone, None),
            ("completeness", "output", name, "missing_pct",
             f"CAST({gone} AS DOUBLE) / nullif((SELECT count(*) FROM silver), 0) * 100", None),
        ]
        if name != "day":
            rows += [
                ("accuracy", stage, name, "negative", f"(SELECT count(*) FROM {table} WHERE {name} < 0)", None)
                for stage, table in (("input", "typed"), ("output", "silver"))
            ]
    return " UNION ALL ".join(
        f"""SELECT '{dimension}' AS dimension, '{stage}' AS stage,
       CAST({f"'{column}'" if column else "NULL"} AS VARCHAR) AS "column", '{metric}' AS metric,
       round(CAST({value or "NULL"} AS DOUBLE), 4) AS value, CAST({day or "NULL"} AS DATE) AS day"""
        for dimension, stage, column, metric, value, day in rows
    )


ORACLE["refresh_quality"] = f"""
WITH {THREE_LOADS},
scored AS (
  SELECT *, avg(change_pct) OVER (PARTITION BY entity_id) AS m,
         stddev_samp(change_pct) OVER (PARTITION BY entity_id) AS s
  FROM moves),
flagged AS (SELECT * FROM scored WHERE s > 0 AND abs(change_pct - m) > 3 * s)
{_loads_report()}"""

ORACLE["refresh_correlation"] = f"""
WITH {THREE_LOADS},
series AS (
  SELECT day, entity_id, value FROM monthly
  UNION ALL SELECT day, -1, idx FROM silver WHERE idx IS NOT NULL),
pairs AS (
  SELECT a.entity_id AS entity_a, b.entity_id AS entity_b, {_corr('a.value', 'b.value')} AS c, count(*) AS n
  FROM series a JOIN series b USING (day) WHERE a.entity_id <> -1 GROUP BY 1, 2)
SELECT entity_a, entity_b, round({_clip('c')}, 9) AS corr, n FROM pairs"""

ORACLE["event_windows"] = """
WITH arrived AS (
  SELECT CAST(ts AS DATE) AS day, event_type AS kind, ts, CAST(round(value * 100) AS BIGINT) AS units,
         CASE WHEN event_id % 50 = 0 THEN 2 WHEN day(ts) BETWEEN 11 AND 20 THEN 0
              WHEN day(ts) <= 10 THEN 1 ELSE 2 END AS turn
  FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL),
turns AS (SELECT turn, max(ts) AS latest FROM arrived GROUP BY turn),
marks AS (
  SELECT turn, max(latest) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL 1 DAY AS watermark
  FROM turns)
SELECT day, kind, count(*) AS n, CAST(sum(units) AS DOUBLE) / 100 AS total,
       count(*) FILTER (WHERE day + INTERVAL 1 DAY <= watermark) AS n_late,
       day + INTERVAL 1 DAY <= (SELECT max(watermark) FROM marks) AS is_closed
FROM arrived JOIN marks USING (turn) GROUP BY day, kind"""
