"""Independent SQL for every query, in DuckDB's dialect over the given tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LINES = """
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS invoice_no,
         CAST(l_partkey AS VARCHAR) AS stock_code,
         p_name || ', "' || p_type || '"' AS description,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity
                   WHEN l_linenumber = 7 THEN NULL
                   ELSE l_quantity END AS INTEGER) AS quantity,
         CAST(o_orderdate AS TIMESTAMP) AS invoice_ts,
         CASE WHEN p_size = 1 THEN 0.0::DOUBLE
              WHEN p_size = 2 THEN NULL
              ELSE p_retailprice END AS price,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         nullif(n_name, 'NATION_7') AS country,
         'Year ' || CAST(year(o_orderdate) AS VARCHAR) || '-'
                 || CAST(year(o_orderdate) + 1 AS VARCHAR) AS source_sheet
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
),
-- "+ 0.0" turns the -0.0 of a returned free line into 0.0, the value Spark's round gives
priced AS (SELECT *, round(quantity * price, 2) + 0.0 AS revenue FROM lines),
clean AS (
  SELECT * FROM priced
  WHERE quantity IS NOT NULL AND price IS NOT NULL AND country IS NOT NULL
    AND quantity > 0 AND price > 0
)
"""

_COUNTRY = """
  SELECT country, count(*) AS orders, round(sum(revenue), 2) AS total_revenue,
         round(avg(revenue), 2) AS avg_revenue
  FROM clean GROUP BY country
  ORDER BY total_revenue DESC, country LIMIT 10
"""

_MONTH = """
  SELECT source_sheet, strftime(invoice_ts, '%Y-%m') AS invoice_month,
         count(*) AS orders, round(sum(revenue), 2) AS monthly_revenue
  FROM clean GROUP BY 1, 2
  ORDER BY source_sheet, invoice_month
"""

ORACLES["raw_row_count"] = f"WITH {_LINES} SELECT count(*) AS row_count FROM lines"
ORACLES["clean_row_count"] = f"WITH {_LINES} SELECT count(*) AS row_count FROM clean"
ORACLES["normalize_columns"] = f"""
WITH {_LINES}
SELECT * REPLACE (CASE WHEN price IS NOT NULL THEN invoice_ts END AS invoice_ts) FROM priced
"""
ORACLES["clean_lines"] = f"WITH {_LINES} SELECT * FROM clean"
ORACLES["line_revenue"] = f"""
WITH {_LINES} SELECT invoice_no, stock_code, price, revenue FROM priced
"""
ORACLES["country_revenue"] = f"WITH {_LINES} {_COUNTRY}"
_EXACT = """
exact AS (SELECT country, source_sheet, invoice_ts, CAST(revenue AS DECIMAL(18, 2)) AS revenue FROM clean)
"""
ORACLES["country_revenue_exact"] = f"""
WITH {_LINES}, {_EXACT}
SELECT country, count(*) AS orders, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       round(CAST(sum(revenue) AS DOUBLE) / count(revenue), 2) AS avg_revenue
FROM exact GROUP BY country ORDER BY total_revenue DESC, country LIMIT 10
"""
_BOTH = """
top AS (SELECT country AS name, orders, total_revenue AS revenue FROM ({country})),
months AS (SELECT invoice_month AS name, orders, monthly_revenue AS revenue FROM ({month} LIMIT 12)),
both_questions AS (SELECT 'country' AS question, * FROM top UNION ALL SELECT 'month', * FROM months)
"""
ORACLES["layouts_compared"] = f"""
WITH {_LINES}, {_BOTH.format(country=_COUNTRY, month=_MONTH)}
SELECT layout, question, name, orders, revenue
FROM both_questions CROSS JOIN (VALUES ('by key'), ('even'), ('clustered')) AS layouts(layout)
"""
ORACLES["monthly_revenue"] = f"WITH {_LINES} {_MONTH} LIMIT 12"
ORACLES["monthly_revenue_all"] = f"WITH {_LINES} {_MONTH}"
ORACLES["csv_infer_roundtrip"] = ORACLES["clean_lines"]
ORACLES["csv_schema_roundtrip"] = ORACLES["clean_lines"]
ORACLES["csv_once_roundtrip"] = ORACLES["clean_lines"]
ORACLES["csv_rejects"] = f"""
WITH {_LINES},
failed AS (
  SELECT CASE WHEN quantity IS NULL OR country IS NULL THEN 'Quantity' END AS q,
         CASE WHEN price IS NULL THEN 'InvoiceDate' END AS d, CASE WHEN price IS NULL THEN 'Price' END AS p
  FROM lines
),
named AS (SELECT concat_ws(', ', q, d, p) AS columns FROM failed)
SELECT 'rejected' AS what, columns, count(*) AS lines FROM named WHERE columns <> '' GROUP BY columns
UNION ALL SELECT 'all rows', '', count(*) FROM lines
UNION ALL SELECT 'with quantity and price', '', count(*) FROM failed WHERE q IS NULL AND p IS NULL
"""
ORACLES["kept_country_revenue"] = ORACLES["country_revenue"]
ORACLES["kept_monthly_revenue"] = ORACLES["monthly_revenue_all"]
ORACLES["bucketed_country_revenue"] = ORACLES["country_revenue"]
ORACLES["layout_by_country"] = ORACLES["country_revenue"]

ORACLES["cell_ref_index"] = """
WITH lettered AS (
  SELECT p_partkey, chr(CAST(65 + p_partkey % 26 AS INTEGER)) AS a, chr(65 + p_size % 26) AS b,
         chr(CAST(65 + (p_partkey + p_size) % 26 AS INTEGER)) AS c, p_size
  FROM part
),
refs AS (
  SELECT p_partkey, CASE WHEN p_size <= 16 THEN a WHEN p_size <= 33 THEN a || b
                         ELSE a || b || c END || CAST(p_partkey + 1 AS VARCHAR) AS ref
  FROM lettered
),
cut AS (SELECT *, regexp_extract(ref, '^[A-Z]+') AS l FROM refs)
SELECT p_partkey, ref, CAST(CASE length(l)
    WHEN 1 THEN ascii(l) - 65
    WHEN 2 THEN 26 * (ascii(l) - 64) + ascii(l[2]) - 65
    ELSE 676 * (ascii(l) - 64) + 26 * (ascii(l[2]) - 64) + ascii(l[3]) - 65 END AS INTEGER) AS col
FROM cut
"""

ORACLES["shared_strings"] = """
SELECT 'orders-' || status AS workbook, c_custkey AS idx, c_name AS text
FROM customer CROSS JOIN (VALUES ('F'), ('O'), ('P')) AS books(status)
"""

ORACLES["date_styles"] = """
SELECT 'styles-' || p_brand AS workbook, CAST(p_partkey AS INTEGER) AS s
FROM part AS style
WHERE p_size IN (14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47)
   OR EXISTS (SELECT 1 FROM part AS format
              WHERE format.p_brand = style.p_brand AND format.p_size = style.p_size
                AND format.p_type = 'PROMO')
"""

ORACLES["serial_to_timestamp"] = """
WITH serials AS (
  SELECT event_id, epoch_us(ts) / 86400000000.0::DOUBLE + 25569.0::DOUBLE AS serial FROM events
)
SELECT event_id, TIMESTAMP '1899-12-30 00:00:00'
       + to_days(CAST(floor(serial) AS INTEGER))
       + to_microseconds(CAST(round_even((serial - floor(serial)) * 86400000000.0::DOUBLE, 0) AS BIGINT)) AS ts
FROM serials
"""

# The serial keeps a time only to about a microsecond, so the text is made from
# the serial again and not from the event's own time.
ORACLES["serial_to_text"] = f"""
WITH moments AS ({ORACLES["serial_to_timestamp"]})
SELECT event_id,
       CASE WHEN strftime(ts, '%H:%M:%S') = '00:00:00' THEN strftime(ts, '%Y-%m-%d')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS moment,
       strftime(ts, '%Y-%m-%d') AS day
FROM moments
"""

_ORDER_ROWS = """
order_rows AS (
  SELECT 'orders-' || o_orderstatus AS workbook, year(o_orderdate) - 1994 AS sheet_no,
         o_orderkey + 2 AS row_no, o_orderkey, o_orderpriority,
         CAST(o_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE c_name END AS customer,
         strftime(o_orderdate, '%Y-%m-%d') AS order_date,
         CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS total,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS priority,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'beyond the header' ELSE '' END AS beyond
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)
"""

_BETWEEN = ", ".join(f"'' AS c{i}" for i in range(5, 26))

ORACLES["cells_to_rows"] = f"""
WITH {_ORDER_ROWS},
heads AS (SELECT DISTINCT workbook, sheet_no FROM order_rows)
SELECT workbook, 'xl/worksheets/sheet' || CAST(sheet_no AS VARCHAR) || '.xml' AS part, row_no,
       order_id AS c0, customer AS c1, order_date AS c2, total AS c3, priority AS c4, {_BETWEEN}, beyond AS c26
FROM order_rows
UNION ALL
SELECT workbook, 'xl/worksheets/sheet' || CAST(sheet_no AS VARCHAR) || '.xml', 1,
       'order_id' || again, 'customer' || again, 'order_date' || again, 'total' || again,
       'priority' || again, {_BETWEEN}, ''
FROM (SELECT *, CASE WHEN sheet_no = 1 THEN '' ELSE ' again' END AS again FROM heads)
"""

ORACLES["ragged_rows"] = """
SELECT p_partkey, words[1] AS c0, coalesce(words[2], '') AS c1, coalesce(words[3], '') AS c2
FROM (SELECT p_partkey,
             string_split(CASE WHEN p_size > 25 THEN p_name || ' ' || p_type || ' ' || p_brand
                               ELSE p_name END, ' ') AS words
      FROM part)
"""

ORACLES["sheet_catalog"] = """
SELECT DISTINCT 'orders-' || o_orderstatus AS workbook,
       CAST(year(o_orderdate) - 1994 AS INTEGER) AS sheet_no,
       'Year ' || CAST(year(o_orderdate) AS VARCHAR) AS name,
       'xl/worksheets/sheet' || CAST(year(o_orderdate) - 1994 AS VARCHAR) || '.xml' AS part
FROM orders
"""

ORACLES["sheet_union"] = f"""
WITH {_ORDER_ROWS}
SELECT order_id, customer, order_date, total, priority,
       'Year ' || CAST(sheet_no + 1994 AS VARCHAR) AS "SourceSheet",
       workbook, CAST(sheet_no AS INTEGER) AS sheet_no, row_no
FROM order_rows
"""

ORACLES["sheet_union_by_name"] = ORACLES["sheet_union"]

ORACLES["workbook_decode"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS total, o_orderpriority AS priority,
       CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus || ' inline' END AS remark,
       'Month ' || strftime(o_orderdate, '%m') AS "SourceSheet",
       'orders-' || o_orderstatus || '-' || strftime(o_orderdate, '%Y') || '-' || CAST(o_orderkey // 20000 AS VARCHAR) AS workbook
FROM orders
"""

ORACLES["workbook_unpacked"] = ORACLES["workbook_decode"]

ORACLES["workbook_month_scan"] = """
SELECT 'orders-' || o_orderstatus || '-' || strftime(o_orderdate, '%Y') || '-' || CAST(o_orderkey // 20000 AS VARCHAR) AS workbook,
       CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS total
FROM orders WHERE month(o_orderdate) = 2
"""

_ACTIONS = """
actions AS (
  SELECT CASE WHEN user_id IN (3, 7) AND event_id // 1000 < 2 THEN CAST(user_id AS VARCHAR)
              ELSE CAST(user_id AS VARCHAR) || '-' || CAST(event_id // 1000 AS VARCHAR) END AS run_label,
         'run-' || run_label AS file, event_id // 1000 AS document_no,
         CAST(row_number() OVER (PARTITION BY user_id, event_id // 1000 ORDER BY ts, event_id) - 1
              AS INTEGER) AS pos,
         CASE event_type WHEN 'view' THEN 'count input rows'
                         WHEN 'click' THEN 'materialize cached dataframe'
                         WHEN 'purchase' THEN 'top countries by revenue'
                         WHEN 'signup' THEN 'monthly revenue by source sheet'
                         ELSE 'other' END AS label,
         value AS duration_sec, event_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type
  FROM events
),
measures AS (
  SELECT file, document_no, run_label,
         round_even(sum(duration_sec), 3) AS time_total_sec,
         round_even(coalesce(
           nullif(arg_min(duration_sec, pos) FILTER (WHERE label = 'materialize cached dataframe'), 0),
           arg_min(duration_sec, pos) FILTER (WHERE label = 'count input rows'), 0), 3)
           AS time_preprocess_sec,
         round_even(coalesce(sum(duration_sec) FILTER (
           WHERE label NOT IN ('count input rows', 'materialize cached dataframe')), 0), 3)
           AS time_work_sec,
         round_even(arg_max(CASE WHEN event_type = 'error' THEN 0.0::DOUBLE
                            ELSE CAST(k AS DOUBLE) + CAST(k AS DOUBLE) / 10 END, pos), 2)
           AS ram_consumption_mb
  FROM actions GROUP BY file, document_no, run_label
)
"""

ORACLES["run_actions_flat"] = f"""
WITH {_ACTIONS}
SELECT run_label, pos, label, duration_sec, event_id AS job_id FROM actions
"""

ORACLES["run_documents_by_glob"] = """
SELECT 'block-' || CAST(event_id // 1000 AS VARCHAR) AS run_label, count(*) AS n_actions,
       round_even(sum(value), 3) AS time_total_sec
FROM events GROUP BY 1
"""

ORACLES["run_stage_tasks"] = f"""
WITH {_ACTIONS}
SELECT file, run_label, pos, label, event_id AS job_id, 2 * event_id AS stage_id,
       'scan' AS stage_name, CAST(k % 12 + 1 AS BIGINT) AS num_tasks
FROM actions
UNION ALL
SELECT file, run_label, pos, label, event_id, 2 * event_id + 1, 'result', CAST(1 AS BIGINT)
FROM actions
"""

for _query, _measure in {
    "run_prep_time": "time_preprocess_sec",
    "run_work_time": "time_work_sec",
    "run_ram": "ram_consumption_mb",
}.items():
    ORACLES[_query] = f"WITH {_ACTIONS} SELECT file, run_label, {_measure} FROM measures"

_RANK = """
CASE run_label WHEN '7' THEN 0 WHEN '3' THEN 1 WHEN '11' THEN 2 WHEN '5' THEN 3 WHEN '2' THEN 4
               ELSE 999 END
"""

ORACLES["run_order"] = f"""
SELECT run_label, CAST({_RANK} AS INTEGER) AS run_rank
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS run_label FROM events)
ORDER BY run_rank, run_label
"""

ORACLES["run_summary"] = f"""
WITH {_ACTIONS},
latest AS (SELECT run_label, max(document_no) AS document_no FROM measures GROUP BY run_label)
SELECT run_label, time_total_sec, time_preprocess_sec, time_work_sec, ram_consumption_mb
FROM measures JOIN latest USING (run_label, document_no)
ORDER BY {_RANK}, run_label
"""

ORACLES["run_summary_written"] = ORACLES["run_summary"]
ORACLES["run_summary_followed"] = ORACLES["run_summary"]
ORACLES["run_documents_by_label"] = f"""
WITH {_ACTIONS}
SELECT run_label, document_no, count(*) AS row_count FROM actions GROUP BY run_label, document_no
"""

ORACLES["run_executor_memory"] = """
WITH status AS (
  SELECT event_id, 434031820 AS max_bytes,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
used AS (
  SELECT event_id, 0 AS position, '10.0.0.1:7001' AS executor, max_bytes,
         k * 131072 + event_id % 997 AS used_bytes FROM status
  UNION ALL
  SELECT event_id, 1, '10.0.0.2:7001', max_bytes, k * 10007 FROM status
)
SELECT event_id, position, executor,
       round_even(max_bytes / 1048576.0::DOUBLE, 2) AS max_mb,
       round_even(used_bytes / 1048576.0::DOUBLE, 2) AS used_mb,
       round_even((max_bytes - used_bytes) / 1048576.0::DOUBLE, 2) AS remaining_mb
FROM used
"""

ORACLES["run_document_json"] = f"""
WITH {_LINES},
top AS ({_COUNTRY}),
months AS ({_MONTH} LIMIT 12),
samples AS (
  SELECT 'country' AS sample, row_number() OVER (ORDER BY total_revenue DESC, country) - 1 AS position,
         country AS name, orders, total_revenue AS revenue FROM top
  UNION ALL
  SELECT 'month', row_number() OVER (ORDER BY source_sheet, invoice_month) - 1,
         invoice_month, orders, monthly_revenue FROM months
)
SELECT 'retail' AS run_label, (SELECT count(*) FROM lines) AS row_count,
       sample, CAST(position AS INTEGER) AS position, name, orders, revenue
FROM samples
"""
