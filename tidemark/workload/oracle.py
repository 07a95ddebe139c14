"""The same views and queries in plain SQL, for an independent engine."""

from __future__ import annotations

import re

LOADED = "TIMESTAMP '2024-02-01 12:30:45'"
AS_OF = "TIMESTAMP '2001-01-01 00:00:00'"
BATCH = "TIMESTAMP '2000-01-01 00:00:00'"
EOT = "TIMESTAMP '9999-12-31 23:59:59.999999'"

KEY = "o_custkey * 100000 + date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE))"
LAYER = "CASE o_orderstatus WHEN 'F' THEN 'silver' WHEN 'O' THEN 'gold' ELSE 'n/a' END"
RANK = "substr(o_orderpriority, 1, 1)"


def _versions(orders: str) -> str:
    return f"""
    SELECT {KEY} AS customer_key, o_custkey AS customer_id, buying_group,
           o_orderdate AS valid_from,
           coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), {EOT}) AS valid_to
    FROM (SELECT o_custkey, o_orderdate, arg_max(o_orderpriority, o_orderkey) AS buying_group
          FROM {orders} GROUP BY ALL)"""


def _snake(text: str) -> str:
    return f"regexp_replace(regexp_replace(lower({text}), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g')"


def _landing(schema: str, name: str) -> str:
    raw = (
        f"(CASE lower(trim({schema})) WHEN 'dimension' THEN 'dim_' WHEN 'fact' THEN 'fact_' "
        f"ELSE {_snake(schema)} || '_' END || {_snake(name)})"
    )
    return f"CASE WHEN regexp_matches({raw}, '^[0-9]') THEN 't_' || {raw} ELSE {raw} END"


def _bad_path(path: str) -> str:
    return f"NOT regexp_matches({path}, '^[^/]+/(silver|gold)/[^/]+\\.sql$')"


VIEWS = {
    "v_city": f"""
    SELECT n_nationkey AS city_key, n_nationkey AS city_id, n_name AS city_name, r_name AS state_province,
           r_name AS country,
           (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS latest_population,
           TIMESTAMP '1990-01-01' AS valid_from, {EOT} AS valid_to
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_item": f"""
    SELECT p_partkey AS stock_item_key, p_partkey AS stock_item_id, p_name AS stock_item_name, p_brand AS brand,
           CAST(p_size AS VARCHAR) AS size, CAST(p_size % 15 AS INTEGER) AS lead_time_days,
           TIMESTAMP '1990-01-01' AS valid_from, {EOT} AS valid_to
    FROM part""",
    "v_versions": _versions("orders"),
    "v_customer": """
    SELECT customer_key, customer_id, c_name AS customer_name, c_name AS bill_to_customer_id,
           c_mktsegment AS category, buying_group AS buying_group_id, c_nationkey AS city_id,
           valid_from, valid_to
    FROM v_versions JOIN customer ON customer_id = c_custkey""",
    "v_sale": f"""
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sale_key,
           {KEY} AS customer_key, l_partkey AS stock_item_key, l_suppkey AS salesperson_id,
           CAST(o_orderdate AS DATE) AS invoice_date_key, CAST(l_quantity AS BIGINT) AS quantity,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(5,2))
                * CAST(1 + CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(5,2)) AS DECIMAL(18,2)) AS total_including_tax,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(5,2))
                * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS profit,
           l_orderkey AS invoice_id, o_custkey AS customer_id, l_shipdate AS modified, l_returnflag AS package
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_fact": """
    SELECT s.sale_key, s.invoice_date_key, s.customer_key, s.stock_item_key, s.quantity, s.unit_price,
           s.total_including_tax, s.profit, s.invoice_id AS wwi_invoice_id, s.customer_id AS wwi_customer_id,
           s.stock_item_key AS wwi_stock_item_id
    FROM v_sale s
    JOIN (SELECT customer_key FROM v_customer) c ON s.customer_key = c.customer_key
    JOIN part ON p_partkey = s.stock_item_key""",
    "v_daily": """
    SELECT invoice_date_key AS sale_date, stock_item_key, p_partkey AS stock_item_id, p_name AS stock_item_name,
           sum(quantity) AS quantity_sold, sum(total_including_tax) AS gross_revenue,
           sum(profit) AS profit, count(*) AS transaction_count
    FROM v_fact JOIN part ON p_partkey = stock_item_key GROUP BY 1, 2, 3, 4""",
    "v_holding": """
    SELECT l_partkey AS stock_item_key, CAST(l_quantity AS BIGINT) AS quantity_on_hand,
           CAST(l_quantity AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) AS quantity_allocated,
           concat_ws('-', l_orderkey, l_linenumber, l_suppkey) AS bin_location,
           CAST(l_linenumber AS BIGINT) AS last_stocktake_quantity,
           l_extendedprice AS last_cost_price, l_suppkey AS reorder_level,
           CAST(l_quantity AS BIGINT) * 2 AS target_stock_level, l_shipdate AS edited
    FROM lineitem""",
    "v_current": f"""
    SELECT c.customer_key, c.customer_id, c.customer_name, c.bill_to_customer_id, c.category,
           c.buying_group_id, c.city_id, ci.city_name, ci.state_province, ci.country
    FROM v_customer c LEFT JOIN v_city ci ON c.city_id = ci.city_id WHERE c.valid_to = {EOT}""",
    "v_names": """
    SELECT CASE p_type WHEN 'STANDARD' THEN 'Dimension' WHEN 'PROMO' THEN 'Fact' ELSE p_brand END AS source_schema,
           p_name || '.' || p_brand || '- ' || p_partkey AS source_name, *
    FROM part""",
    "v_inventory": f"""
    SELECT CASE WHEN p_type = 'ECONOMY' THEN 'proc' ELSE 'table' END AS object_type,
           CASE WHEN p_type <> 'ECONOMY' THEN {_landing("source_schema", "source_name")} END AS landing_name,
           p_size > 45 AS skip, p_retailprice
    FROM v_names""",
    "v_bronze": "SELECT landing_name AS table_name FROM v_inventory "
    "WHERE landing_name IS NOT NULL AND p_retailprice >= 950",
    "v_backlog": f"""
    SELECT 'item-' || o_orderkey AS item_id, 'Load.Order' || o_orderkey AS legacy_proc, {LAYER} AS target_layer,
           CASE year(o_orderdate) WHEN 1995 THEN 'jobs/converted/mart_' || o_custkey || '.sql' WHEN 1996 THEN ''
                ELSE 'jobs/' || {LAYER} || '/mart_' || o_custkey || '.sql' END AS target_path,
           CASE {RANK} WHEN '1' THEN 'pending' WHEN '2' THEN 'in_progress' WHEN '3' THEN 'converted'
                WHEN '4' THEN 'blocked' ELSE 'done' END AS status
    FROM orders""",
    "v_record": f"""
    SELECT 'item-' || o_orderkey AS record_id,
           CASE WHEN year(o_orderdate) = 1998 THEN 'item-x' ELSE 'item-' || o_orderkey END AS item_id,
           'Load.Order' || o_orderkey AS legacy_proc,
           'jobs/' || CASE WHEN year(o_orderdate) = 1997 THEN 'bronze' ELSE {LAYER} END
                   || '/mart_' || o_custkey || '.sql' AS target_path,
           CASE {RANK} WHEN '1' THEN 'final' WHEN '2' THEN 'review' WHEN '3' THEN 'draft' WHEN '4' THEN 'blocked'
                ELSE 'unknown' END AS status,
           CASE WHEN year(o_orderdate) <> 1999 THEN 'ok' END AS notes, year(o_orderdate) = 2000 AS extra,
           o_totalprice >= 100000 AS filed
    FROM orders""",
    "v_violation": f"""
    SELECT record_id, 1 AS pos, 'target_path: pattern' AS violation FROM v_record WHERE {_bad_path("target_path")}
    UNION ALL SELECT record_id, 2, 'status: not allowed' FROM v_record WHERE status = 'unknown'
    UNION ALL SELECT record_id, 3, 'notes: missing' FROM v_record WHERE notes IS NULL
    UNION ALL SELECT record_id, 4, 'unknown: extra' FROM v_record WHERE extra""",
    "v_target": """
    SELECT 'jobs/' || layer || '/mart_' || c_custkey || '.sql' AS target_path
    FROM customer, (VALUES ('silver'), ('gold')) AS l(layer) WHERE c_acctbal >= 0""",
    "v_joined": """
    SELECT b.item_id, b.legacy_proc AS b_proc, b.target_path AS b_path, r.*, t.target_path IS NOT NULL AS deployed,
           (SELECT string_agg(violation, '; ' ORDER BY pos) FROM v_violation x WHERE x.record_id = r.record_id) AS bad
    FROM (SELECT * FROM v_backlog WHERE status <> 'done' AND target_layer <> 'n/a') b
    LEFT JOIN (SELECT record_id, item_id AS r_item, legacy_proc AS r_proc, target_path AS r_path, status AS r_status,
                      notes AS r_notes FROM v_record WHERE filed) r ON r.record_id = b.item_id
    LEFT JOIN v_target t ON t.target_path = r.r_path""",
    "v_state": """
    SELECT *, CASE WHEN record_id IS NULL THEN 'missing' WHEN bad IS NOT NULL THEN 'invalid'
                   WHEN r_item <> item_id THEN 'mismatch'
                   WHEN r_status <> 'blocked' AND NOT deployed THEN 'absent'
                   WHEN r_status = 'blocked' THEN 'blocked' ELSE 'converted' END AS outcome
    FROM v_joined""",
    "v_merged": """
    SELECT item_id, CASE WHEN outcome IN ('blocked', 'converted') THEN r_proc ELSE b_proc END AS legacy_proc,
           CASE WHEN outcome = 'converted' THEN 'converted' ELSE 'blocked' END AS status,
           CASE WHEN outcome IN ('blocked', 'converted') THEN r_status END AS map_status,
           CASE WHEN outcome = 'missing' THEN b_path ELSE r_path END AS target_path,
           CASE outcome WHEN 'missing' THEN 'missing convert result file'
                WHEN 'invalid' THEN 'invalid convert result: ' || bad
                WHEN 'mismatch' THEN 'result item_id ' || r_item || ' != backlog ' || item_id
                WHEN 'absent' THEN 'target_path missing on disk: ' || r_path
                ELSE coalesce(r_notes, '') END AS notes,
           outcome = 'missing' AS missing
    FROM v_state""",
    "v_map": f"""
    SELECT 'Load.Order' || o_orderkey AS legacy_proc,
           CASE {RANK} WHEN '1' THEN 'final' WHEN '2' THEN 'draft' ELSE 'blocked' END AS status,
           'jobs/gold/mart_' || o_custkey || '.sql' AS target_path
    FROM orders WHERE o_totalprice >= 100000""",
    "v_gate_backlog": """
    SELECT item_id, legacy_proc, target_path,
           CASE WHEN CAST(substr(item_id, 6) AS BIGINT) % 11 <> 0 THEN status END AS status,
           CASE WHEN CAST(substr(item_id, 6) AS BIGINT) % 13 <> 0 THEN target_layer END AS target_layer FROM v_backlog""",
    "v_catalog": """
    SELECT CASE p_size % 9 WHEN 0 THEN 'SYS' WHEN 1 THEN 'information_schema' ELSE p_brand END AS source_schema,
           p_name || ' ' || p_partkey AS source_name FROM part
    WHERE p_size >= 5 AND p_size % 9 > 1""",
    "v_counted": f"""
    SELECT o_custkey, 'run-' || {RANK} AS run_id, count(*) AS e, count(*) FILTER (o_orderstatus <> 'P') AS a,
           max(o_orderdate) AS ts FROM orders GROUP BY 1, 2""",
    "v_reconcile": """
    SELECT CASE WHEN e >= 3 THEN 'bronze_vs_source:' ELSE 'fixture_' END || 'customer_' || o_custkey AS check_id,
           'bronze.customer_' || o_custkey AS table_name, CAST(e AS VARCHAR) AS expected,
           CAST(a AS VARCHAR) AS actual, CAST(a - e AS VARCHAR) AS delta,
           CASE WHEN a = e THEN 'pass' ELSE 'fail' END AS result, run_id, ts FROM v_counted""",
    "v_gate_inventory": """
    SELECT object_type, landing_name, coalesce(CASE WHEN CAST(floor(p_retailprice) AS BIGINT) % 7 <> 0 THEN skip END, false) AS skip FROM v_inventory""",
    "v_gate_reconcile": """
    SELECT check_id, expected, actual, CASE WHEN result = 'pass' THEN 'pass' WHEN expected <> '1' THEN 'fail'
           WHEN check_id LIKE '%7' THEN 'passed' END AS result, run_id FROM v_reconcile
    UNION ALL SELECT 'bronze_vs_source:' || landing_name, '1', '1', 'pass', 'run-1' FROM v_inventory
    WHERE landing_name IS NOT NULL AND p_retailprice >= 930""",
    "v_expect": """
    SELECT p_type || '_' || p_partkey AS fixture_name,
           CASE WHEN p_type = 'ECONOMY' THEN 'silver' ELSE 'gold' END || '.item_' || p_partkey AS target_table,
           'row_count' AS metric, CASE WHEN p_type <> 'SMALL' THEN CAST(p_size AS BIGINT) END AS expected,
           CASE WHEN p_brand = 'Brand#3' THEN 'gte' ELSE 'exact_when_expected_set' END AS compare,
           p_name AS notes, p_partkey FROM part""",
    "v_events": """
    SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS agent, 'completed' AS event,
           CAST(event_id AS VARCHAR) AS tool, props AS detail, ts FROM events""",
    "v_gate_events": """
    SELECT 'run-' || (user_id % 5 + 1) AS run_id,
           CASE event_type WHEN 'view' THEN 'coordinator' WHEN 'click' THEN 'assess' WHEN 'error' THEN 'convert'
                WHEN 'purchase' THEN 'test' ELSE 'observer' END AS agent FROM events""",
    "v_runs": """
    SELECT CAST(c_custkey AS VARCHAR) AS run_id,
           (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P'
              AND o_orderpriority = '1-URGENT') AS procs,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'no client' END AS reason FROM customer""",
    "v_loads": f"""
    SELECT DISTINCT {KEY} AS lineage_key, o_orderdate AS started, 'Customer ' || o_custkey AS table_name,
           CASE WHEN o_orderdate < TIMESTAMP '2001-06-01' THEN o_orderdate END AS completed,
           o_orderdate < TIMESTAMP '2001-06-01' AS was_successful, o_orderdate AS cutoff_time FROM orders""",
    "v_opened": f"""
    SELECT * FROM v_loads
    UNION ALL SELECT (SELECT max(lineage_key) + 1 FROM v_loads), {LOADED}, 'Customer 7', NULL, false, {AS_OF}""",
    "v_blockers": f"""
    SELECT 'bronze_missing:' || landing_name AS id, 'not landed: ' || landing_name AS message,
           CAST(NULL AS VARCHAR) AS backlog_item_id
    FROM v_gate_inventory WHERE object_type = 'table' AND NOT skip
      AND landing_name NOT IN (SELECT table_name FROM v_bronze)
    UNION ALL SELECT 'reconcile_fail:' || check_id, 'expected ' || expected || ', actual ' || actual, NULL
    FROM v_gate_reconcile WHERE run_id = 'run-1' AND result IS DISTINCT FROM 'pass'
    UNION ALL SELECT 'reconcile_fail:bronze_vs_source:' || landing_name, 'not compared: ' || landing_name, NULL
    FROM v_gate_inventory WHERE object_type = 'table' AND NOT skip
      AND 'bronze_vs_source:' || landing_name NOT IN (SELECT check_id FROM v_gate_reconcile WHERE run_id = 'run-1')
    UNION ALL SELECT 'events_missing:' || agent, 'no event from ' || agent, NULL
    FROM (VALUES ('coordinator'), ('assess'), ('convert'), ('test'), ('gate')) AS a(agent)
    WHERE agent NOT IN (SELECT agent FROM v_gate_events WHERE run_id = 'run-1')
    UNION ALL SELECT 'convert_missing:' || item_id, 'no conversion record or file', item_id
    FROM v_gate_backlog b WHERE coalesce(status, '') <> 'blocked' AND coalesce(target_layer, '') <> 'n/a'
      AND NOT (legacy_proc IN (SELECT legacy_proc FROM v_map WHERE status IN ('draft', 'review', 'final'))
               AND target_path IN (SELECT target_path FROM v_target))""",
}


def _with_views(sql: str) -> str:
    """Prefix the views a statement uses, in declaration order."""
    needed: set[str] = set()
    frontier = [sql]
    while frontier:
        for name in re.findall(r"\bv_[a-z_]+\b", frontier.pop()):
            if name in VIEWS and name not in needed:
                needed.add(name)
                frontier.append(VIEWS[name])
    parts = [f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def _asof(stage_id: str, dim: str, key: str, dim_id: str) -> str:
    return f"""coalesce((SELECT arg_min(d.{key}, d.valid_from) FROM {dim} d WHERE d.{dim_id} = s.{stage_id}
               AND s.modified > d.valid_from AND s.modified <= d.valid_to), 0)"""


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
_LANDED = {"orders": "o_orderstatus <> 'P'", "lineitem": "l_tax > 0"}

STATEMENTS = {
    "landing_names": f"SELECT source_schema, source_name, {_landing('source_schema', 'source_name')} AS landing_name FROM v_names",
    "landing_collisions": f"""
    SELECT landing_name, count(*) AS tables
    FROM (SELECT {_landing('source_schema', 'p_name')} AS landing_name FROM v_names
          WHERE p_type <> 'ECONOMY' AND p_size <= 45)
    GROUP BY 1 HAVING count(*) > 1""",
    "bronze_land": f"""
    SELECT *, {LOADED} AS _bronze_loaded_at, 'azure_sql' AS _source_system,
           'bronze-all-20240201123045' AS _batch_id FROM orders""",
    "load_control": " UNION ALL ".join(
        f"SELECT 'bronze.{t}' AS table_name, 'bronze-all-20240201123045' AS batch_id, count(*) AS row_count, "
        f"{LOADED} AS started_at, {LOADED} AS ended_at, 'ok' AS status FROM {t}"
        for t in _TABLES
    ),
    "extracted_changes": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1999-12-31' AND o_orderdate <= {AS_OF}",
    "dim_city": "SELECT * FROM v_city",
    "dim_stock_item": "SELECT * FROM v_item",
    "dim_date": """
    SELECT CAST(d AS DATE) AS date_key, CAST(day(d) AS INTEGER) AS day_number, dayname(d) AS day_name,
           monthname(d) AS month_name, CAST(year(d) AS INTEGER) AS calendar_year,
           CAST(month(d) AS INTEGER) AS calendar_month_number, CAST(quarter(d) AS INTEGER) AS calendar_quarter
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""",
    "dim_customer_scd2": f"""
    SELECT *, valid_to IS NULL OR CAST(valid_to AS DATE) = DATE '9999-12-31' AS is_current
    FROM v_customer WHERE valid_from <= {AS_OF}""",
    "customer_quarantine": f"""
    SELECT customer_key AS "Customer Key", customer_id AS "WWI Customer ID", customer_name AS "Customer",
           bill_to_customer_id AS "Bill To Customer", category AS "Category", buying_group_id AS "Buying Group",
           city_id AS "City", valid_from AS "Valid From", valid_to AS "Valid To"
    FROM v_customer WHERE valid_from > {AS_OF}""",
    "city_ci_counts": "SELECT lower(c_mktsegment) AS customer_name, count(*) AS customers FROM customer GROUP BY 1",
    "fact_sale": """
    SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(profit AS DOUBLE) AS profit,
                      CAST(total_including_tax AS DOUBLE) AS total_including_tax) FROM v_fact""",
    "fact_sale_orphan": """
    SELECT s.sale_key, s.customer_key, s.stock_item_key,
           CASE WHEN c.customer_key IS NULL AND p_partkey IS NULL THEN 'customer_and_stock_unmatched'
                WHEN c.customer_key IS NULL THEN 'customer_unmatched' ELSE 'stock_unmatched' END AS orphan_reason
    FROM v_sale s
    LEFT JOIN (SELECT customer_key FROM v_customer WHERE category <> 'BUILDING') c ON s.customer_key = c.customer_key
    LEFT JOIN part ON p_partkey = s.stock_item_key AND p_size <= 45
    WHERE c.customer_key IS NULL OR p_partkey IS NULL""",
    "mart_daily_sales": """
    SELECT * REPLACE (CAST(quantity_sold AS BIGINT) AS quantity_sold, CAST(gross_revenue AS DOUBLE) AS gross_revenue,
                      CAST(profit AS DOUBLE) AS profit) FROM v_daily""",
    "mart_stock_movements": """
    SELECT i.stock_item_key, stock_item_id, stock_item_name, brand, size, lead_time_days, quantity_on_hand,
           quantity_allocated, quantity_on_hand - quantity_allocated AS quantity_available
    FROM v_item i LEFT JOIN
      (SELECT *, row_number() OVER (PARTITION BY stock_item_key ORDER BY edited DESC, bin_location DESC) AS rn
       FROM v_holding) h ON i.stock_item_key = h.stock_item_key AND rn = 1""",
    "mart_customer_current": "SELECT * FROM v_current",
    "mart_city_dimension": "SELECT * FROM v_city",
    "mart_stock_holding": f"""
    SELECT stock_item_key, quantity_on_hand, bin_location, last_stocktake_quantity, last_cost_price,
           reorder_level, target_stock_level, {AS_OF} AS as_of_ts FROM v_holding""",
    "metric_by_date": """
    SELECT invoice_date_key AS invoice_date, count(*) AS transaction_count,
           CAST(sum(quantity) AS BIGINT) AS quantity_sold, CAST(sum(total_including_tax) AS DOUBLE) AS gross_revenue,
           CAST(sum(profit) AS DOUBLE) AS profit FROM v_fact GROUP BY 1""",
    "metric_by_customer": """
    SELECT customer_key, stock_item_key, count(*) AS transaction_count, CAST(sum(quantity) AS BIGINT) AS quantity_sold
    FROM v_fact GROUP BY 1, 2""",
    "metric_total": """
    SELECT count(*) AS transaction_count, CAST(sum(quantity) AS BIGINT) AS quantity_sold,
           CAST(sum(total_including_tax) AS DOUBLE) AS gross_revenue FROM v_fact""",
    "top_items": """
    SELECT stock_item_name, CAST(sum(gross_revenue) AS DOUBLE) AS gross_revenue, CAST(sum(profit) AS DOUBLE) AS profit,
           CAST(sum(quantity_sold) AS BIGINT) AS quantity_sold
    FROM v_daily WHERE stock_item_name IS NOT NULL GROUP BY 1
    ORDER BY sum(gross_revenue) DESC, stock_item_name LIMIT 10""",
    "customers_by_country": "SELECT country, count(*) AS customers FROM v_current WHERE country IS NOT NULL GROUP BY 1",
    "fact_sample": "SELECT sale_key, quantity FROM v_sale ORDER BY sale_key LIMIT 1000",
    "asof_keys": f"""
    SELECT sale_key, c_nationkey AS city_key, {_asof("customer_id", "v_versions", "customer_key", "customer_id")} AS customer_key,
           {_asof("stock_item_key", "v_versions", "customer_key", "customer_id")} AS bill_to_customer_key,
           stock_item_key,
           CASE WHEN modified > TIMESTAMP '1996-06-01'
                 AND (s_acctbal >= 5000 OR modified <= TIMESTAMP '2000-01-01') THEN s_suppkey + 1 ELSE 0 END
             AS salesperson_key
    FROM v_sale s JOIN customer ON c_custkey = customer_id LEFT JOIN supplier ON s_suppkey = salesperson_id""",
    "asof_keys_sliced": f"""
    SELECT sale_key, {_asof("customer_id", "v_versions", "customer_key", "customer_id")} AS customer_key
    FROM v_sale s""",
    "latest_keys": """
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(key, 0) AS customer_key
    FROM lineitem LEFT JOIN
      (SELECT customer_id, arg_max(customer_key, valid_to) AS key FROM v_versions GROUP BY 1) ON customer_id = l_partkey""",
    "scd2_apply": f"""
    , old_v AS ({_versions(f"(SELECT * FROM orders WHERE o_orderdate < {BATCH})")}),
      new_v AS ({_versions(f"(SELECT * FROM orders WHERE o_orderdate >= {BATCH})")}),
      first_change AS (SELECT customer_id, min(valid_from) AS changed FROM new_v GROUP BY 1)
    SELECT customer_key, o.customer_id, buying_group, valid_from,
           CASE WHEN valid_to = {EOT} AND changed IS NOT NULL THEN changed ELSE valid_to END AS valid_to, CAST(1 AS BIGINT) AS lineage_key
    FROM old_v o LEFT JOIN first_change f ON o.customer_id = f.customer_id
    UNION ALL SELECT NULL, customer_id, buying_group, valid_from, valid_to, 2 FROM new_v""",
    "dimension_segments": f"""
    , old_v AS ({_versions(f"(SELECT * FROM orders WHERE o_orderdate < {BATCH})")}),
      new_v AS ({_versions(f"(SELECT * FROM orders WHERE o_orderdate >= {BATCH})")}),
      first_change AS (SELECT customer_id, min(valid_from) AS changed FROM new_v GROUP BY 1),
      written AS (
        SELECT coalesce(changed, valid_to) AS valid_to FROM old_v o LEFT JOIN first_change f ON o.customer_id = f.customer_id
        WHERE valid_to = {EOT} UNION ALL SELECT valid_to FROM new_v)
    SELECT CASE WHEN valid_to = {EOT} THEN 'open' ELSE strftime(valid_to, '%Y-%m') END AS segment, count(*) AS rows
    FROM written GROUP BY 1""",
    "reaching_versions": f"""
    , all_v AS ({_versions("orders")})
    SELECT customer_id, valid_from, valid_to, CASE WHEN valid_to = {EOT} THEN 'open' ELSE strftime(valid_to, '%Y-%m') END AS segment
    FROM all_v WHERE valid_to = {EOT} OR strftime(valid_to, '%Y-%m') >= strftime({BATCH}, '%Y-%m')""",
    "assigned_keys": """
    SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_seq FROM orders""",
    "fact_upsert": """
    , resent AS (SELECT * FROM v_sale WHERE invoice_date_key >= DATE '2000-01-01' AND package <> 'R')
    SELECT sale_key, invoice_id, quantity, package, CAST(1 AS BIGINT) AS lineage_key FROM v_sale
    WHERE invoice_id NOT IN (SELECT invoice_id FROM resent)
    UNION ALL SELECT sale_key, invoice_id, quantity + 1, package, 2 FROM resent""",
    "touched_partitions": """
    SELECT DISTINCT invoice_date_key FROM v_sale
    WHERE invoice_id IN (SELECT invoice_id FROM v_sale WHERE invoice_date_key >= DATE '2000-01-01')""",
    "snapshot_replace": """
    SELECT CASE WHEN p_size <= 45 THEN stock_item_key ELSE 0 END AS stock_item_key, quantity_on_hand, bin_location,
           target_stock_level, CAST(2 AS BIGINT) AS lineage_key
    FROM v_holding LEFT JOIN part ON p_partkey = stock_item_key""",
    "lineage_open_close": f"""
    SELECT * EXCLUDE (hit) REPLACE (
      CASE WHEN hit THEN {LOADED} ELSE completed END AS completed, was_successful OR hit AS was_successful)
    FROM (SELECT *, lineage_key = (SELECT max(lineage_key) FROM v_opened WHERE table_name = 'Customer 7'
            AND completed IS NULL) AS hit FROM v_opened)""",
    "etl_cutoffs": f"""
    SELECT 'Customer ' || c_custkey AS table_name,
           CASE WHEN c_custkey = 7 THEN {AS_OF} ELSE TIMESTAMP '1990-01-01' END AS cutoff_time FROM customer""",
    "replace_run": """
    SELECT check_id, table_name, expected,
           CASE WHEN fix THEN expected ELSE actual END AS actual, CASE WHEN fix THEN '0' ELSE delta END AS delta,
           CASE WHEN fix THEN 'pass' ELSE result END AS result, run_id, ts
    FROM (SELECT *, run_id = 'run-1' AND check_id LIKE 'fixture_%' AS fix FROM v_reconcile)""",
    "upsert": """
    , source AS (SELECT 'Load.Order' || l_orderkey AS legacy_proc, 'jobs/gold/' || l_suppkey || '.sql' AS target_path,
                        CASE WHEN l_linestatus = 'O' THEN 'final' ELSE 'review' END AS status, l_shipdate AS updated_at,
                        row_number() OVER (PARTITION BY l_orderkey
                          ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
                 FROM lineitem)
    SELECT legacy_proc, target_path, status, updated_at FROM source WHERE rn = 1
    UNION ALL SELECT 'Load.Order' || o_orderkey, o_orderpriority, 'draft', o_orderdate FROM orders
    WHERE 'Load.Order' || o_orderkey NOT IN (SELECT legacy_proc FROM source)""",
    "perturbed_expectations": """
    SELECT fixture_name, target_table, metric,
           CASE WHEN hit THEN coalesce(expected, 0) + 1000000 ELSE expected END AS expected,
           CASE WHEN hit THEN 'gte' ELSE compare END AS compare,
           CASE WHEN hit THEN '[INJECTED-FAULT] was expected=' || coalesce(CAST(expected AS VARCHAR), 'NULL')
             || ' compare=' || compare || ' | ' || notes ELSE notes END AS notes
    FROM (SELECT *, fixture_name LIKE 'SMALL%' AS hit FROM v_expect)""",
    "restored_expectations": "SELECT fixture_name, target_table, metric, expected, compare, notes FROM v_expect",
    "run_events": f"""
    SELECT run_id, 'coordinator' AS agent, 'started' AS event, CAST(NULL AS VARCHAR) AS tool,
           'ensure_run_events' AS detail, {LOADED} AS ts FROM v_runs
    UNION ALL SELECT run_id, 'convert', 'skipped', NULL, coalesce(reason, 'no backlog / routines skipped'), {LOADED}
    FROM v_runs WHERE procs = 0 OR reason IS NOT NULL""",
    "inventory_counts": "SELECT object_type, count(*) AS n FROM v_inventory WHERE NOT skip GROUP BY 1",
    "inventory_thresholds": """
    SELECT t AS tables_total, p AS procs_total, l AS tables_live, t > 200 AS requires_confirm, t >= 10 AS accepts_tables,
           p >= 5 AS accepts_procs
    FROM (SELECT count(*) FILTER (object_type = 'table') AS t, count(*) FILTER (object_type <> 'table') AS p,
                 count(*) FILTER (object_type = 'table' AND NOT skip) AS l FROM v_inventory)""",
    "reconcile_status": "SELECT result, count(*) AS checks FROM v_reconcile GROUP BY 1",
    "reconcile_summary": """
    SELECT 'run-1' AS run_id, count(*) FILTER (result = 'pass') AS passed, count(*) FILTER (result = 'fail') AS failed,
           count(*) AS total FROM v_reconcile WHERE run_id = 'run-1'""",
    "failed_checks": """
    SELECT check_id, table_name, expected, actual, delta, run_id, ts FROM v_reconcile WHERE result = 'fail'
    ORDER BY ts DESC, check_id, run_id LIMIT 20""",
    "list_checks": """
    SELECT check_id, table_name, expected, actual, delta, result FROM v_reconcile WHERE run_id = 'run-1'""",
    "backlog_status": "SELECT status, count(*) AS items FROM v_backlog GROUP BY 1",
    "event_summary": """
    SELECT count(*) AS total_events, count(DISTINCT run_id) AS runs, count(DISTINCT agent) AS agents FROM v_events""",
    "events_by_agent": "SELECT agent, count(*) AS events FROM v_events GROUP BY 1",
    "events_over_time": """
    SELECT date_trunc('minute', ts) AS minute, agent, count(*) AS events FROM v_events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS GROUP BY 1, 2""",
    "latest_events": """
    SELECT * FROM v_events ORDER BY ts DESC, run_id, agent, event, tool, detail LIMIT 100""",
    "run_timeline": "SELECT agent, event, detail, ts FROM v_events WHERE run_id = '8'",
    "lineage": """
    SELECT * FROM (
      SELECT CASE WHEN l_returnflag = 'R' THEN 'old' ELSE 'wh' END || '.bronze.part_' || l_partkey AS source_table_full_name,
             CASE WHEN l_linestatus = 'O' THEN 'wh.silver.supplier_' ELSE 'ext.supplier_' END || l_suppkey
               AS target_table_full_name, l_shipdate AS event_time FROM lineitem)
    WHERE source_table_full_name LIKE 'wh.%' OR target_table_full_name LIKE 'wh.%'
    ORDER BY event_time DESC, source_table_full_name, target_table_full_name LIMIT 50""",
    "merged_results": "SELECT *, CAST(substr(item_id, 6) AS BIGINT) AS position FROM v_merged",
    "conversion_map": """
    SELECT legacy_proc, target_path, status FROM v_map
    UNION ALL SELECT target_path, target_path, map_status
    FROM (SELECT *, row_number() OVER (PARTITION BY target_path ORDER BY CAST(substr(item_id, 6) AS BIGINT) DESC) AS rn
          FROM v_merged WHERE map_status IS NOT NULL) WHERE rn = 1""",
    "backlog_item_violations": """
    SELECT o_orderkey AS record_id, 'legacy_proc: type' AS violation FROM orders WHERE o_orderkey % 7 = 0
    UNION ALL SELECT o_orderkey, 'classification: not allowed' FROM orders WHERE o_orderpriority LIKE '5%'
    UNION ALL SELECT o_orderkey, 'target_path: type' FROM orders
    UNION ALL SELECT o_orderkey, 'priority: missing' FROM orders WHERE o_orderstatus = 'P'""",
    "context_violations": """
    SELECT c_custkey AS record_id, 'run_id: pattern' AS violation FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT c_custkey, 'source_type: not allowed' FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, 'foreign_catalog: too short' FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT c_custkey, 'scoped_tables[]: type' FROM customer WHERE c_custkey % 4 = 0
    UNION ALL SELECT c_custkey, 'max_retries: above 5' FROM customer WHERE c_custkey % 8 > 5""",
    "reconcile_report_violations": """
    SELECT o_orderkey AS record_id, CASE o_orderkey % 8 WHEN 0 THEN 'checks[]: type'
             WHEN 1 THEN 'checks[].result: not allowed' WHEN 2 THEN 'checks[].check_id: type'
             WHEN 3 THEN 'checks[].expected: type' WHEN 4 THEN 'checks[].delta: missing'
             ELSE 'checks[]: unknown' END AS violation FROM orders WHERE o_orderkey % 8 < 6
    UNION ALL SELECT o_orderkey, 'summary.total: below 1' FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, 'summary.unknown: more' FROM orders WHERE o_orderkey % 5 = 0""",
    "manifest_violations": """
    SELECT p_partkey AS record_id, 'blockers[]: type' AS violation FROM part WHERE p_partkey % 6 = 0
    UNION ALL SELECT p_partkey, 'blockers[].id: type' FROM part WHERE p_partkey % 6 = 1
    UNION ALL SELECT p_partkey, 'blockers[].message: type' FROM part WHERE p_partkey % 6 = 1
    UNION ALL SELECT p_partkey, 'blockers[].message: missing' FROM part WHERE p_partkey % 6 = 2
    UNION ALL SELECT p_partkey, 'converted_artifacts[]: type' FROM part WHERE p_partkey % 5 = 0
    UNION ALL SELECT p_partkey, 'converted_artifacts[].status: not allowed' FROM part WHERE p_partkey % 5 = 1
    UNION ALL SELECT p_partkey, 'attempt: below 0' FROM part WHERE p_size < 3
    UNION ALL SELECT p_partkey, 'summary.tables_total: type' FROM part WHERE p_partkey % 7 = 0""",
    "undated_customers": """
    SELECT customer_key, customer_id FROM v_customer WHERE buying_group_id = '5-LOW'""",
    "changes_since_cutoff": f"""
    SELECT * FROM orders WHERE o_orderdate > {AS_OF} AND o_orderdate <= {LOADED}""",
    "discovered_tables": f"""
    SELECT 'table' AS object_type, source_schema, source_name, {_landing("source_schema", "source_name")} AS landing_name,
           false AS skip FROM v_catalog""",
    "federation_smoke": """
    SELECT 'federation_smoke_ok' AS check_name, (SELECT count(*) FROM v_catalog) AS foreign_base_tables,
           (SELECT count(DISTINCT n_nationkey % 6) FROM nation WHERE n_nationkey % 6 < 5) = 5 AS managed_schemas_ok""",
    "gate_hero": f"""
    SELECT 'run-1' AS run_id, (SELECT CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END FROM v_blockers) AS gate,
           CAST(count(*) FILTER (object_type = 'table' AND NOT skip
             AND landing_name IN (SELECT table_name FROM v_bronze)) AS INTEGER) AS tables_landed,
           CAST(count(*) FILTER (object_type = 'table' AND NOT skip) AS INTEGER) AS tables_total,
           (SELECT CAST(count(*) AS INTEGER) FROM v_gate_backlog WHERE status = 'converted') AS procs_converted,
           CAST(count(*) FILTER (object_type <> 'table' AND NOT skip) AS INTEGER) AS procs_total,
           {LOADED} AS updated_at FROM v_gate_inventory""",
    "convert_summary": """
    SELECT count(*) FILTER (status = 'converted') AS converted, count(*) FILTER (status = 'blocked') AS blocked,
           count(*) FILTER (missing) AS missing_results, count(*) AS total FROM v_merged""",
    "merged_backlog": """
    SELECT b.item_id, b.legacy_proc, b.target_layer,
           CASE WHEN m.status = 'converted' THEN m.target_path ELSE b.target_path END AS target_path,
           coalesce(m.status, b.status) AS status
    FROM v_backlog b LEFT JOIN v_merged m ON b.item_id = m.item_id""",
    "backlog_violations": f"""
    , live AS (SELECT * FROM v_backlog WHERE status <> 'done' AND target_layer <> 'n/a'),
      users AS (SELECT target_path, count(*) AS n FROM live WHERE target_path <> '' GROUP BY 1 HAVING count(*) > 1)
    SELECT item_id, 'missing_path' AS rule, target_path, CAST(1 AS BIGINT) AS users FROM live WHERE target_path = ''
    UNION ALL SELECT item_id, 'retired_folder', target_path, 1 FROM live WHERE contains(target_path, 'converted/')
    UNION ALL SELECT item_id, 'path_pattern', target_path, 1 FROM live
    WHERE target_path <> '' AND {_bad_path("target_path")}
    UNION ALL SELECT item_id, 'duplicate_path', l.target_path, n FROM live l JOIN users u ON l.target_path = u.target_path""",
    "unwired_targets": """
    SELECT DISTINCT target_path FROM v_backlog
    WHERE status <> 'blocked' AND target_layer <> 'n/a' AND target_path <> ''
      AND target_path NOT IN (SELECT 'jobs/gold/mart_' || c_custkey || '.sql' FROM customer WHERE c_mktsegment <> 'BUILDING')""",
    "record_violations": "SELECT record_id, violation FROM v_violation",
    "check_not_null": " UNION ALL ".join(
        f"SELECT 'not_null:orders.{c}' AS check_id, count(*) AS violations, "
        f"CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS result FROM orders WHERE {bad}"
        for c, bad in (
            ("o_orderkey", "o_orderkey IS NULL"),
            ("o_orderpriority", "o_orderpriority = '5-LOW'"),
            ("o_orderstatus", "o_orderstatus = 'P'"),
        )
    ),
    "check_unique": """
    SELECT 'primary_key:fact_sale' AS check_id, count(*) AS violations,
           CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS result
    FROM (SELECT sale_key FROM v_sale GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'primary_key:lineitem', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
    FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""",
    "check_fk": """
    SELECT 'foreign_key:fact_sale.customer_key' AS check_id, count(*) AS violations,
           CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS result
    FROM v_sale WHERE customer_key NOT IN (SELECT customer_key FROM v_customer WHERE category <> 'BUILDING')
    UNION ALL SELECT 'foreign_key:fact_sale.stock_item_key', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
    FROM v_sale WHERE stock_item_key NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)""",
    "reconcile_counts": """
    SELECT 'bronze_vs_source:' || t AS check_id, 'bronze.' || t AS table_name, CAST(e AS VARCHAR) AS expected,
           CAST(a AS VARCHAR) AS actual, CAST(a - e AS VARCHAR) AS delta,
           CASE WHEN a = e THEN 'pass' ELSE 'fail' END AS result, 'run-1' AS run_id, """
    + LOADED
    + " AS ts FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS t, count(*) AS e, count(*) FILTER ({_LANDED.get(t, 'true')}) AS a FROM {t}"
        for t in _TABLES
    )
    + ")",
    "expectations": f"""
    SELECT 'fixture_' || fixture_name AS check_id, target_table AS table_name, CAST(expected AS VARCHAR) AS expected,
           CAST(n AS VARCHAR) AS actual, CAST(n - coalesce(expected, 0) AS VARCHAR) AS delta,
           CASE WHEN expected IS NULL OR (compare = 'gte' AND n >= expected) OR n = expected
                THEN 'pass' ELSE 'fail' END AS result, 'run-1' AS run_id, {LOADED} AS ts
    FROM v_expect LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON target_table = 'gold.item_' || l_partkey""",
    "source_smoke": "SELECT 'source_ok' AS check_name, "
    + ", ".join(f"(SELECT count(*) FROM {t}) AS {t}_rows" for t in _TABLES),
    "gate_blockers": "SELECT * FROM v_blockers",
    "gate_verdict": """
    SELECT 'run-1' AS run_id, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS gate, count(*) AS blockers
    FROM v_blockers""",
    "blocked_items": """
    SELECT 'convert_blocked:' || item_id AS id, 'blocked after conversion' AS message, item_id AS backlog_item_id
    FROM v_backlog WHERE status = 'blocked'""",
    "run_summary": """
    SELECT (SELECT count(*) FROM v_backlog) AS backlog_total,
           (SELECT count(*) FROM v_backlog WHERE status IN ('converted', 'done')) AS backlog_converted,
           (SELECT count(*) FROM v_inventory WHERE object_type = 'table' AND NOT skip) AS tables_total,
           (SELECT count(*) FROM v_inventory WHERE object_type = 'table' AND NOT skip
              AND landing_name IN (SELECT table_name FROM v_bronze)) AS tables_landed,
           (SELECT count(*) FROM v_inventory WHERE object_type <> 'table' AND NOT skip) AS procs_total,
           (SELECT count(*) FROM v_backlog WHERE status = 'converted') AS procs_converted,
           (SELECT count(*) FROM v_reconcile WHERE run_id = 'run-1' AND result = 'pass') AS reconcile_passed,
           (SELECT count(*) FROM v_reconcile WHERE run_id = 'run-1' AND result = 'fail') AS reconcile_failed,
           (SELECT count(*) FROM v_gate_events WHERE run_id = 'run-1') AS agent_events_recorded""",
}


def _statement(sql: str) -> str:
    text = sql.strip()
    if not text.startswith(","):
        return _with_views(text)
    # The statement brings further views of its own.
    full = _with_views(text)
    if full.startswith("WITH"):
        return full
    return f"WITH {text[1:].strip()}"


ORACLE = {name: _statement(sql) for name, sql in STATEMENTS.items()}
