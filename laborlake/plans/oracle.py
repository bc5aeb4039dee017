"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on the driver tables as DuckDB views. Column names and types
follow the Spark results: SUM of INT is cast to BIGINT (DuckDB gives HUGEINT),
shares are DOUBLE, month is ``strftime('%Y-%m')``.
"""

from __future__ import annotations

_FACTS = """
facts AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         c.c_name, c.c_mktsegment, r.r_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

_FLAG = "CASE WHEN {h} > 100 THEN 'HIGH' WHEN {h} > 50 THEN 'MEDIUM' ELSE 'LOW' END"
_HOURS = "CAST(floor(o_totalprice / 2500) AS INTEGER)"

_CONTENT = f"""
content_events AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS content_id,
         c_name AS title,
         upper(trim(c_mktsegment)) AS category,
         upper(trim(r_name)) AS region,
         trim(o_orderpriority) AS department,
         {_HOURS} AS labor_hours,
         {_FLAG.format(h=_HOURS)} AS labor_flag,
         o_orderstatus AS event_type,
         o_orderdate AS event_timestamp,
         'silver' AS pipeline_layer,
         '1.0.0' AS pipeline_version,
         o_orderdate AS processed_at
  FROM facts
)"""

_RAW = f"""
raw_events AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS content_id,
         c_name AS title,
         lower(c_mktsegment) AS category,
         ' ' || lower(r_name) || ' ' AS region,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS department,
         {_HOURS} AS labor_hours,
         o_orderdate AS ts,
         o_orderstatus AS event_type,
         CAST(0 AS BIGINT) AS ingest_seq
  FROM facts
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR),
         '  ' || c_name || '  ',
         lower(c_mktsegment),
         ' ' || lower(r_name) || ' ',
         o_orderpriority,
         {_HOURS},
         o_orderdate + l.l_linenumber * INTERVAL 1 DAY,
         'content_updated',
         CAST(l.l_linenumber AS BIGINT)
  FROM facts JOIN lineitem l ON l.l_orderkey = facts.o_orderkey
)"""

# keep-first per content_id: ingest order, then every column (nulls first) as tie-break
_FIRST = """
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY content_id
      ORDER BY ingest_seq NULLS FIRST, title NULLS FIRST, category NULLS FIRST, region NULLS FIRST,
               department NULLS FIRST, labor_hours NULLS FIRST, ts NULLS FIRST, event_type NULLS FIRST) AS rn
    FROM raw_events) t
  WHERE rn = 1
)"""

_LABOR = """
labor_logs AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS employee_id,
         l_linestatus AS department,
         CAST(l_orderkey AS VARCHAR) AS project_id,
         CAST(l_quantity AS DOUBLE) AS hours_logged,
         strftime(l_shipdate, '%G-W%V') AS week,
         l_returnflag AS role
  FROM lineitem
)"""

_SILVER_FROM_RAW = f"""
silver_raw AS (
  SELECT content_id,
         trim(title) AS title,
         upper(trim(category)) AS category,
         upper(trim(region)) AS region,
         trim(department) AS department,
         labor_hours,
         {_FLAG.format(h='labor_hours')} AS labor_flag,
         trim(event_type) AS event_type,
         ts AS event_timestamp,
         'silver' AS pipeline_layer,
         '1.0.0' AS pipeline_version,
         ts AS processed_at
  FROM firsts
  WHERE content_id IS NOT NULL AND department IS NOT NULL
)"""

_X1 = f"""
x1 AS (
  SELECT content_id,
         trim(title) AS title,
         upper(trim(category)) AS category,
         upper(trim(region)) AS region,
         trim(department) AS department,
         labor_hours,
         event_type,
         ts AS event_timestamp,
         {_FLAG.format(h='labor_hours')} AS labor_flag,
         'silver' AS pipeline_layer
  FROM firsts
)"""


# V7 rule names in alphabetical order (the Spark side sorts the violation list).
_RULE_LIST = [
    ("category_length", "length(category) > 50"),
    ("content_id_length", "length(content_id) > 50"),
    ("content_id_not_null", "content_id IS NULL"),
    ("department_length", "length(department) > 100"),
    ("department_not_null", "department IS NULL"),
    ("event_type_length", "length(event_type) > 50"),
    ("labor_flag_in_set", "labor_flag NOT IN ('HIGH', 'MEDIUM', 'LOW')"),
    ("labor_flag_length", "length(labor_flag) > 10"),
    ("labor_hours_positive", "labor_hours <= 0"),
    ("pipeline_layer_length", "length(pipeline_layer) > 10"),
    ("pipeline_version_length", "length(pipeline_version) > 10"),
    ("primary_key_unique", "content_id IS NOT NULL AND COUNT(*) OVER (PARTITION BY content_id) > 1"),
    ("region_length", "length(region) > 20"),
    ("title_length", "length(title) > 255"),
    ("title_not_null", "title IS NULL"),
]
_RULES = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _RULE_LIST)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_C = _with(_FACTS, _CONTENT)
_R = _with(_FACTS, _RAW)
_S = _with(_FACTS, _RAW, _FIRST, _SILVER_FROM_RAW)
_X = _with(_FACTS, _RAW, _FIRST, _X1)

_TAGGED = f""",
tagged AS (SELECT *, concat_ws(',', {_RULES}) AS violation FROM silver_raw)"""

# A page holds 100 records, in the order of their line items.
_PAGED = """
WITH labor AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS employee_id, l_linestatus AS department, CAST(l_orderkey AS VARCHAR) AS project_id,
         CAST(l_quantity AS DOUBLE) AS hours_logged, strftime(l_shipdate, '%G-W%V') AS week, l_returnflag AS role,
         l_orderkey, l_linenumber
  FROM lineitem
), paged AS (
  SELECT CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber, employee_id, department, project_id,
                                           hours_logged, week, role) - 1) // 100 + 1 AS INTEGER) AS page,
         employee_id, department, project_id, hours_logged, week, role
  FROM labor
)
"""

_A1 = """
SELECT department, region,
       CAST(SUM(labor_hours) AS BIGINT) AS total_labor_hours,
       AVG(labor_hours) AS avg_labor_hours,
       COUNT(content_id) AS total_projects,
       MAX(labor_hours) AS max_labor_hours
FROM {src} GROUP BY department, region ORDER BY total_labor_hours DESC"""

_A3 = """
SELECT department,
       COUNT(content_id) AS total_projects,
       CAST(SUM(labor_hours) AS BIGINT) AS total_hours,
       ROUND(AVG(labor_hours), 2) AS avg_hours,
       CAST(SUM(CASE WHEN labor_flag = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_effort
FROM {src} WHERE department IS NOT NULL GROUP BY department ORDER BY department"""

ORACLE_SQL: dict[str, str] = {
    "report_labor_by_department": _C + """
SELECT department, region,
       COUNT(content_id) AS total_projects,
       CAST(SUM(labor_hours) AS BIGINT) AS total_labor_hours,
       ROUND(AVG(labor_hours), 2) AS avg_labor_hours,
       MAX(labor_hours) AS max_labor_hours,
       CAST(SUM(CASE WHEN labor_flag = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_effort_projects
FROM content_events GROUP BY department, region ORDER BY total_labor_hours DESC""",
    "report_category_region_volume": _C + """
SELECT category, region, COUNT(content_id) AS total_titles,
       CAST(SUM(labor_hours) AS BIGINT) AS total_labor_hours
FROM content_events GROUP BY category, region ORDER BY category, total_titles DESC""",
    "report_labor_flag_distribution": _C + """
SELECT labor_flag, COUNT(*) AS count,
       ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percentage
FROM content_events GROUP BY labor_flag ORDER BY count DESC""",
    "report_monthly_throughput": _C + """
SELECT strftime(processed_at, '%Y-%m') AS month, COUNT(content_id) AS records_processed,
       CAST(SUM(labor_hours) AS BIGINT) AS total_hours
FROM content_events GROUP BY 1 ORDER BY month""",
    "report_top_effort": _C + """
SELECT content_id, title, department, labor_hours, labor_flag, region
FROM content_events ORDER BY labor_hours DESC, content_id ASC LIMIT 5""",
    "report_above_avg_departments": _C + """
SELECT department, ROUND(AVG(labor_hours), 2) AS avg_hours
FROM content_events GROUP BY department
HAVING AVG(labor_hours) > (SELECT AVG(labor_hours) FROM content_events)
ORDER BY avg_hours DESC""",
    "report_hours_variance": _with(_FACTS, _CONTENT, _LABOR) + """
SELECT c.content_id, c.title, c.department, c.labor_hours AS event_labor_hours,
       SUM(l.hours_logged) AS actual_logged_hours,
       c.labor_hours - SUM(l.hours_logged) AS variance
FROM content_events c LEFT JOIN labor_logs l ON c.content_id = l.project_id
GROUP BY c.content_id, c.title, c.department, c.labor_hours
ORDER BY variance DESC""",
    "validation_report_counts": _R + """
SELECT COUNT(*) AS total_rows,
       CAST(COUNT(*) - COUNT(DISTINCT content_id)
            - CASE WHEN COUNT_IF(content_id IS NULL) > 0 THEN 1 ELSE 0 END AS BIGINT) AS duplicate_count,
       COUNT_IF(labor_hours <= 0) AS invalid_labor,
       COUNT_IF(content_id IS NULL) AS null_content_id,
       COUNT_IF(title IS NULL) AS null_title,
       COUNT_IF(category IS NULL) AS null_category,
       COUNT_IF(department IS NULL) AS null_department,
       COUNT_IF(labor_hours IS NULL) AS null_labor_hours,
       COUNT_IF(region IS NULL) AS null_region,
       (COUNT_IF(content_id IS NULL) + COUNT_IF(department IS NULL)) = 0 AS passed,
       CAST((CASE WHEN COUNT(*) - COUNT(DISTINCT content_id) > 0 THEN 1 ELSE 0 END)
          + (CASE WHEN COUNT_IF(labor_hours <= 0) > 0 THEN 1 ELSE 0 END) AS INTEGER) AS warning_count
FROM raw_events""",
    "silver_content_events": _S + "SELECT * FROM silver_raw",
    "spark_transform_events": _X + "SELECT * FROM x1",
    "gold_department_region": _C + _A1.format(src="content_events"),
    "gold_category": _C + """
SELECT category, COUNT(content_id) AS total_titles, CAST(SUM(labor_hours) AS BIGINT) AS total_labor_hours,
       AVG(labor_hours) AS avg_labor_hours
FROM content_events GROUP BY category ORDER BY total_titles DESC""",
    "gold_department_summary": _C + _A3.format(src="content_events"),
    "gold_category_summary": _C + """
SELECT category, COUNT(content_id) AS total_titles, CAST(SUM(labor_hours) AS BIGINT) AS total_hours,
       ROUND(AVG(labor_hours), 2) AS avg_hours
FROM content_events WHERE category IS NOT NULL GROUP BY category ORDER BY category""",
    "gold_department_total": _C + """
SELECT department, CAST(SUM(labor_hours) AS BIGINT) AS total_labor_hours
FROM content_events WHERE department IS NOT NULL GROUP BY department""",
    "x1_labor_by_department": _X + _A1.format(src="x1"),
    "x1_department_summary": _X + _A3.format(src="x1"),
    "constraint_quarantine": _S + f"""
SELECT content_id, labor_hours, labor_flag, violation FROM (
  SELECT content_id, labor_hours, labor_flag, concat_ws(',', {_RULES}) AS violation FROM silver_raw) t
WHERE violation <> ''""",
    "constraint_accepted": _S + f"""
SELECT * EXCLUDE (violation) FROM (SELECT *, concat_ws(',', {_RULES}) AS violation FROM silver_raw) t
WHERE violation = ''""",
    "gold_department_labor_summary": _C + """
SELECT department, region, COUNT(content_id) AS total_projects,
       CAST(SUM(labor_hours) AS BIGINT) AS total_labor_hours, AVG(labor_hours) AS avg_labor_hours,
       CAST(SUM(CASE WHEN labor_flag = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_effort_count
FROM content_events WHERE department IS NOT NULL GROUP BY department, region""",
    "csv_folder_ingest": _C + """
SELECT content_id, title, category, department, labor_hours, region,
       CASE WHEN event_type = 'F' THEN NULL ELSE CAST(year(event_timestamp) AS BIGINT) END AS release_year
FROM content_events""",
    "api_pages_flatten": _PAGED + "SELECT * FROM paged",
    "pages_stop_empty": _PAGED + "SELECT * FROM paged WHERE page < greatest(2, (SELECT count(*) FROM lineitem) // 200)",
    "pages_stop_falsy": _PAGED + "SELECT * FROM paged WHERE page < greatest(2, (SELECT count(*) FROM lineitem) // 200)",
    "pages_stop_missing": _PAGED + "SELECT * FROM paged WHERE page < greatest(2, (SELECT count(*) FROM lineitem) // 200)",
    "csv_quoted_fields": """
SELECT o_orderkey AS id, 'He said "' || o_orderpriority || '", ok' AS said,
       CASE WHEN o_orderkey % 3 = 0 THEN 'line one' || chr(10) || 'line ' || o_orderkey ELSE o_orderstatus END AS note
FROM orders""",
    "csv_bad_rows": """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 3 THEN 'a' || chr(10) || 'a' ELSE 'a' END AS x,
       CASE WHEN o_orderkey % 5 <> 1 THEN 'b' END AS y
FROM orders WHERE o_orderkey % 5 IN (1, 3, 4)""",
    "csv_export_roundtrip": _C + """
SELECT content_id,
       'He said "' || title || CASE WHEN event_type = 'F' THEN '",' || chr(10) || 'ok' ELSE '", ok' END AS title,
       category, region, department, labor_hours, labor_flag
FROM content_events""",
    "labor_log_keys": "SELECT COUNT(*) AS row_count, COUNT(*) AS key_count, CAST(1 AS BIGINT) AS first_key, COUNT(*) AS last_key FROM lineitem",
    "csv_blank_lines": "SELECT o_orderkey AS id, o_orderpriority AS priority FROM orders",
    # A byte that begins nothing becomes one replacement sign; so does the lead byte before an ASCII one.
    "csv_bad_bytes": """
SELECT 'k' || (o_orderkey // 4) || CASE o_orderkey % 4 WHEN 0 THEN chr(65533) WHEN 1 THEN chr(65533) || '(' ELSE chr(233) END AS key,
       o_orderkey AS id, o_orderkey % 4 < 2 AS bad_encoding
FROM orders""",
    "csv_large_files": """
SELECT o_orderkey AS id, repeat(o_orderpriority || ', "so"' || chr(10), 12) || o_orderstatus AS note, '5" pipe' AS size
FROM orders""",
    "warehouse_defaults": _C + """
SELECT 'silver.content_events_clean' AS name, COUNT(*) AS row_count, COUNT(*) AS with_defaults FROM content_events
UNION ALL SELECT 'gold.department_labor_summary', COUNT(DISTINCT (department, region)), COUNT(DISTINCT (department, region)) FROM content_events
UNION ALL SELECT 'gold.category_summary', COUNT(DISTINCT category), COUNT(DISTINCT category) FROM content_events""",
    "stream_exact_first": _X + "SELECT * FROM x1",
    # Raw events, odd hours, broken JSON and messages without a key; the last two are dead letters of a stream.
    "stream_run_events": _R + """
SELECT 'Extract' AS stage, 'SUCCESS' AS status,
       CAST((SELECT COUNT(*) FROM raw_events) + (SELECT COUNT(*) FROM orders WHERE o_orderkey % 50 IN (1, 2))
            + 2 * (SELECT COUNT(*) FROM events) AS BIGINT) AS rows
UNION ALL SELECT 'DeadLetters', 'SUCCESS', CAST(2 * (SELECT COUNT(*) FROM events) AS BIGINT)""",
    "increments_gold": _S + _A1.format(
        src="(SELECT * FROM silver_raw WHERE labor_hours > 0 OR labor_hours IS NULL) accepted"),
    "run_strict_gate": _R + """
SELECT 'ERROR' AS event_type, 'Validate' AS stage, 'FAILED' AS status, CAST(0 AS INTEGER) AS published,
       'Validation failed. Critical null values: {''content_id'': 0, ''department'': ' || COUNT_IF(department IS NULL) || '}' AS message
FROM raw_events
UNION ALL
SELECT 'ERROR', 'Validate', 'FAILED', 0, 'Validation failed. Missing columns: [''content_id'', ''department'']'""",
    "labor_logs_quarantine": """
SELECT CASE WHEN l_linenumber <> 2 THEN CAST(l_suppkey AS VARCHAR) END AS employee_id,
       CAST(l_orderkey AS VARCHAR) AS project_id,
       CASE WHEN l_linenumber = 4 THEN -CAST(l_quantity AS DOUBLE) ELSE CAST(l_quantity AS DOUBLE) END AS hours_logged,
       CASE l_linenumber WHEN 2 THEN 'employee_id_not_null' WHEN 3 THEN 'department_length'
                         WHEN 4 THEN 'hours_logged_non_negative' END AS violation
FROM lineitem WHERE l_linenumber IN (2, 3) OR (l_linenumber = 4 AND l_quantity > 0)""",
    "labor_logs_table": _with(_LABOR) + """
SELECT employee_id, department, project_id, hours_logged, week, role
FROM labor_logs WHERE employee_id IS NOT NULL AND NOT (hours_logged < 0)
  AND coalesce(length(employee_id) <= 20, true) AND coalesce(length(project_id) <= 50, true)
  AND coalesce(length(department) <= 100, true) AND coalesce(length(role) <= 100, true)
  AND coalesce(length(week) <= 10, true)""",
    "silver_roundtrip_by_region": _C + "SELECT * FROM content_events",
    "topic_decode_events": _R + """
SELECT content_id, title, category, region, department, labor_hours,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, event_type
FROM raw_events""",
    "topic_dead_letters": "SELECT props AS value FROM events",
    "lake_inventory": _with(_FACTS, _CONTENT, _RAW) + """
SELECT 'bronze' AS layer, 'content_events' AS dataset, COUNT(*) AS row_count FROM raw_events
UNION ALL SELECT 'silver', 'content_events_clean', COUNT(*) FROM content_events
UNION ALL SELECT 'gold', 'department_summary', COUNT(DISTINCT department) FROM content_events
UNION ALL SELECT 'gold', 'category_summary', COUNT(DISTINCT category) FROM content_events""",
    "topic_first_delivery": _S + "SELECT * FROM silver_raw",
    "stream_mixed_batches": _S + "SELECT * FROM silver_raw",
    "stream_bronze_silver": _S + "SELECT * FROM silver_raw",
    "stream_silver_dedup": _X + "SELECT * FROM x1",
    "run_department_summary": _S + _A3.format(
        src="(SELECT * FROM silver_raw WHERE labor_hours > 0 OR labor_hours IS NULL) accepted"),
    # start, five stages and checks, end; a warning per kind of finding, an error for critical nulls
    "run_event_counts": _R + """,
counts AS (
  SELECT CAST(COUNT(*) > COUNT(DISTINCT content_id) AS BIGINT) + CAST(COUNT_IF(labor_hours <= 0) > 0 AS BIGINT) AS w,
         CAST(COUNT_IF(content_id IS NULL OR department IS NULL) > 0 AS BIGINT) AS e
  FROM raw_events)
SELECT 'content_etl' AS pipeline, 7 + w + e AS total_events, e AS errors, w AS warnings FROM counts""",
    "run_stage_rows": _S + f"""{_TAGGED}
SELECT 'Extract' AS stage, 'SUCCESS' AS status, COUNT(*) AS rows FROM raw_events
UNION ALL SELECT 'Validate', CASE WHEN COUNT_IF(department IS NULL) > 0 THEN 'FAILED' ELSE 'PASSED' END,
                 COUNT(*) - COUNT(DISTINCT content_id) FROM raw_events
UNION ALL SELECT 'Quarantine', 'SUCCESS', COUNT(*) FROM tagged WHERE violation <> ''
UNION ALL SELECT 'Transform', 'SUCCESS', COUNT(*) FROM tagged WHERE violation = ''
UNION ALL SELECT 'Load', 'SUCCESS', COUNT(*) FROM tagged WHERE violation = ''""",
    "run_topic_dead_letters": "SELECT '{bad ' || event_id AS value FROM events",
    "run_null_keys": "SELECT COUNT(*) AS null_keys, 'FAILED' AS validation FROM events",
    "run_quarantine": _S + f"""{_TAGGED}
SELECT content_id, labor_hours, CAST(NULL AS VARCHAR) AS labor_hours_text, violation FROM tagged WHERE violation <> ''
UNION ALL SELECT 'X' || o_orderkey, NULL, 'ten', 'labor_hours_type' FROM orders WHERE o_orderkey % 50 = 1
UNION ALL SELECT 'Y' || o_orderkey, NULL, '100.5', 'labor_hours_type' FROM orders WHERE o_orderkey % 50 = 2""",
    "run_two_sources": _with(_FACTS, _CONTENT, _RAW) + """
SELECT 'kafka' AS source_system, COUNT(*) AS row_count, COUNT(DISTINCT content_id) AS keys,
       CAST(SUM(labor_hours) AS BIGINT) AS hours, CAST(NULL AS BIGINT) AS years FROM raw_events
UNION ALL
SELECT 'file', COUNT(*), COUNT(DISTINCT content_id), CAST(SUM(labor_hours) AS BIGINT),
       CAST(SUM(year(event_timestamp)) AS BIGINT) FROM content_events""",
    "run_hours_variance": _with(_FACTS, _RAW, _FIRST, _SILVER_FROM_RAW, _LABOR) + f"""{_TAGGED}
SELECT c.content_id, c.title, c.department, c.labor_hours AS event_labor_hours,
       SUM(l.hours_logged) AS actual_logged_hours, c.labor_hours - SUM(l.hours_logged) AS variance
FROM (SELECT * FROM tagged WHERE violation = '') c LEFT JOIN labor_logs l ON c.content_id = l.project_id
GROUP BY c.content_id, c.title, c.department, c.labor_hours""",
    "warehouse_row_counts": _S + f"""{_TAGGED}
SELECT 'bronze.content_events_raw' AS name, COUNT(*) AS row_count FROM raw_events
UNION ALL SELECT 'silver.content_events_clean', COUNT(*) FROM tagged WHERE violation = ''
UNION ALL SELECT 'gold.department_labor_summary', COUNT(DISTINCT (department, region)) FROM tagged WHERE violation = ''
UNION ALL SELECT 'gold.category_summary', COUNT(DISTINCT category) FROM tagged WHERE violation = ''""",
    "run_event_summary": """
SELECT 'RUN_' || CAST(user_id AS VARCHAR) AS run_id, 'content_etl' AS pipeline, COUNT(*) AS total_events,
       COUNT_IF(upper(event_type) = 'ERROR') AS errors, COUNT_IF(upper(event_type) = 'WARNING') AS warnings
FROM events GROUP BY user_id""",
    "gold_category_summary_table": _C + """
SELECT category, COUNT(content_id) AS total_titles, CAST(SUM(labor_hours) AS BIGINT) AS total_labor_hours,
       AVG(labor_hours) AS avg_labor_hours
FROM content_events WHERE category IS NOT NULL GROUP BY category""",
}

# The reports over the warehouse tables answer the same questions.
for _n, _k in [("labor_by_department", "report_labor_by_department"),
               ("category_region_volume", "report_category_region_volume"),
               ("labor_flag_distribution", "report_labor_flag_distribution"),
               ("monthly_throughput", "report_monthly_throughput"),
               ("top_effort", "report_top_effort"),
               ("above_avg_departments", "report_above_avg_departments"),
               ("hours_variance", "report_hours_variance")]:
    ORACLE_SQL[f"sql_report_{_n}"] = ORACLE_SQL[_k]

ORACLE_SQL["variance_bucketed"] = ORACLE_SQL["report_hours_variance"]
ORACLE_SQL["increments_report"] = ORACLE_SQL["validation_report_counts"]
