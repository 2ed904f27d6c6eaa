"""Independent DuckDB SQL for every registered query that SQL can express.

The texts run on DuckDB over views named after the driver tables. They are
written from the operator contracts, not generated from the Spark plans.
"""

from __future__ import annotations

FEED = """
SELECT CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN '   '
            ELSE concat(' ORD-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) END AS order_id,
       CASE WHEN l_partkey % 97 = 0 THEN '   ' ELSE concat('CUST-', CAST(o_custkey AS VARCHAR), ' ') END AS customer_id,
       concat(' SKU-', CAST(l_partkey AS VARCHAR)) AS product_id,
       CASE WHEN l_linenumber % 3 = 0 THEN concat(' ', lower(n_name), ' ') ELSE n_name END AS country,
       CASE WHEN l_partkey % 89 = 0 THEN 0 WHEN l_partkey % 107 = 0 THEN NULL
            ELSE CAST(l_quantity AS INTEGER) END AS quantity,
       CASE WHEN l_partkey % 83 = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS unit_price,
       CASE WHEN l_partkey % 109 = 0 THEN NULL ELSE l_shipdate END AS order_ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

NORMALISED = f"""
SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, trim(product_id) AS product_id,
       upper(trim(country)) AS country, quantity, unit_price, order_ts
FROM ({FEED}) f
"""

VALID = f"""
SELECT * FROM ({NORMALISED}) n
WHERE order_id IS NOT NULL AND order_id <> '' AND customer_id IS NOT NULL AND customer_id <> ''
  AND quantity > 0 AND unit_price > 0
"""

DERIVED = f"""
SELECT *, round(quantity * unit_price, 2) AS gross_amount, CAST(order_ts AS DATE) AS order_date
FROM ({VALID}) v
"""

CLEAN = f"""
SELECT order_id, customer_id, product_id, country, quantity, unit_price, order_ts, gross_amount, order_date
FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
            ORDER BY order_ts DESC NULLS LAST, product_id NULLS FIRST, quantity NULLS FIRST,
                     unit_price NULLS FIRST, customer_id NULLS FIRST, country NULLS FIRST) AS rn
  FROM ({DERIVED}) d) w
WHERE rn = 1
"""

GOLD = f"""
SELECT order_date, country,
       count(DISTINCT order_id) AS order_count,
       count(DISTINCT customer_id) AS customer_count,
       CAST(sum(CAST(round(gross_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS gross_revenue,
       CAST((2 * abs(sum(CAST(round(gross_amount * 100) AS BIGINT))) + count(gross_amount))
            // (2 * count(gross_amount)) AS DOUBLE) / 100
         * sign(sum(CAST(round(gross_amount * 100) AS BIGINT))) AS avg_order_value
FROM ({CLEAN}) c
GROUP BY order_date, country
"""

ORACLES: dict[str, str] = {
    "daily_country_sales": GOLD + "\nORDER BY order_date NULLS FIRST, country NULLS FIRST",
    "normalise_orders": NORMALISED,
    "valid_orders": VALID,
    "derive_amount": DERIVED,
    "clean_orders": CLEAN,
}


# --------------------------------------------------------------------------- helpers


def _q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


PROFILE = f"""
SELECT input_rows, output_rows, null_key_rows, duplicate_key_rows, rejected_rows,
       CAST(printf('%.4f', rate) AS DOUBLE) AS rejection_rate, rate
FROM (
  SELECT i.n AS input_rows, o.n AS output_rows, i.nulls AS null_key_rows,
         o.n - o.k AS duplicate_key_rows,
         greatest(i.n - o.n, 0) AS rejected_rows,
         CASE WHEN i.n = 0 THEN 0.0 ELSE greatest(i.n - o.n, 0) / i.n END AS rate
  FROM (SELECT count(*) AS n, count(*) FILTER (WHERE order_id IS NULL) AS nulls FROM ({FEED}) f) i,
       (SELECT count(*) AS n,
               count(DISTINCT order_id) + coalesce(max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END), 0) AS k
        FROM ({CLEAN}) c) o
) p
"""

# The four credential patterns, in order of application.
CREDENTIALS = (
    ("access_token", r"(?i)\b(dapi[0-9a-f]{32,})"),
    ("git_token", r"(?i)\b(gh[pousr]_[A-Za-z0-9]{20,})"),
    ("api_key", r"(?i)\b(sk-[A-Za-z0-9\-_]{20,})"),
    ("key_value", r"(?i)(password|passwd|secret|token|api[_-]?key)\s*[:=]\s*\S+"),
)

# Line rules. RE2 has no look-ahead; the first rule's "not an expression"
# condition can't change a match, since an expression's first character is
# none of those that must follow.
LINE_RULES = (
    (
        "hard_coded_secret",
        r"(?i)(password|token|api[_-]?key|client[_-]?secret)\s*:\s*[\"']?[A-Za-z0-9/+_\-]{8,}",
        "possible hard-coded secret — use ${{ secrets.* }}",
    ),
    ("moving_ref", r"uses:\s*([^\s@]+)@(main|master)\s*$", "action pinned to a moving ref — pin to a version tag"),
)
CORPUS_RULES = LINE_RULES + (("credential_assignment", CREDENTIALS[3][1], "credential assigned in plain text"),)

# Root keys of block-style workflow texts.
TRIGGER = r"(?m)^(on|On|ON|yes|Yes|YES|true|True|TRUE|\"on\"|'on')[ \t]*:([ \t]|$)"
PERMISSIONS = r"(?m)^(permissions|\"permissions\"|'permissions')[ \t]*:([ \t]|$)"
JOBS = r"(?m)^(jobs|\"jobs\"|'jobs')[ \t]*:([ \t]+[^\s#]|[ \t]*(#[^\n]*)?\r?\n([ \t]*(#[^\n]*)?\r?\n)*([ \t]+[^\s#]|-[ \t]))"
NO_JOBS = (
    r"(?m)^(jobs|\"jobs\"|'jobs')[ \t]*:[ \t]+(\{[ \t]*\}|\[[ \t]*\]|null|Null|NULL|~|\"\"|''|"
    r"false|False|FALSE|no|No|NO|off|Off|OFF|0)[ \t]*(#[^\n]*)?\r?$"
)
INDENT = r"\A([ \t]*(#[^\n]*)?\r?\n|(---|%)[^\n]*\n)*( +)[^\s#]"

# One line per document and rule group, chosen by the id; the document follows.
WORKFLOWS = """
SELECT doc_id,
  CASE doc_id % 7 WHEN 0 THEN 'on: push' || chr(10) WHEN 1 THEN '"on":' || chr(10) || '  push:' || chr(10)
    WHEN 2 THEN 'true: push' || chr(10) WHEN 3 THEN '# on: push' || chr(10) WHEN 4 THEN 'once: push' || chr(10)
    WHEN 5 THEN chr(39) || 'on' || chr(39) || ': [push]' || chr(10) ELSE '' END
  || CASE doc_id % 5 WHEN 0 THEN 'permissions: read-all' || chr(10)
    WHEN 1 THEN '"permissions":' || chr(10) || '  contents: read' || chr(10)
    WHEN 2 THEN '  permissions: x' || chr(10) WHEN 3 THEN 'permission: x' || chr(10) ELSE '' END
  || CASE doc_id % 11 WHEN 0 THEN 'jobs:' || chr(10) || '  a:' || chr(10) || '    steps: x' || chr(10)
    WHEN 1 THEN 'jobs: {}' || chr(10) WHEN 2 THEN 'jobs:' || chr(10) WHEN 3 THEN chr(39) || 'jobs' || chr(39) || ': {a: b}' || chr(10)
    WHEN 4 THEN 'jobs: null # none' || chr(10) WHEN 5 THEN 'jobs:' || chr(10) || '- a' || chr(10)
    WHEN 6 THEN 'jobs: x' || chr(10) ELSE '' END
  || CASE doc_id % 13 WHEN 0 THEN 'run: dapi' || h || chr(10) WHEN 1 THEN 'run: dapi' || substr(h, 1, 20) || chr(10)
    WHEN 2 THEN 'run: GHP_' || h || chr(10) WHEN 3 THEN 'run: gho_' || d || chr(10)
    WHEN 4 THEN 'run: sk-' || h || '_' || chr(10) WHEN 5 THEN 'run: sk-' || d || chr(10)
    WHEN 6 THEN 'run: Password = ' || h || chr(10) ELSE '' END
  || CASE doc_id % 6 WHEN 0 THEN '  token: ' || h || chr(10) WHEN 1 THEN '  token: ${{ secrets.TOKEN }}' || chr(10)
    WHEN 2 THEN '  client_secret: ' || chr(39) || h || chr(39) || chr(10) WHEN 3 THEN '  api-key: short' || chr(10) ELSE '' END
  || CASE doc_id % 4 WHEN 0 THEN '  uses: org/action' || d || '@main' || chr(10)
    WHEN 1 THEN '  uses: org/action@v' || d || chr(10) WHEN 2 THEN '  uses: org/action@master  ' || chr(10) ELSE '' END
  || coalesce(text, '') AS text
FROM (SELECT *, md5(CAST(doc_id AS VARCHAR)) AS h, lpad(CAST(doc_id AS VARCHAR), 6, '0') AS d FROM documents) x
"""

VERDICT = f"""
SELECT env, max_rejection_rate, fail_on_violation, all_rejected, duplicates_survived, rate_exceeded,
       NOT (all_rejected OR duplicates_survived OR rate_exceeded) AS passed,
       CASE WHEN NOT (all_rejected OR duplicates_survived OR rate_exceeded) THEN 'pass'
            WHEN fail_on_violation THEN 'fail' ELSE 'warn' END AS action,
       CASE WHEN all_rejected OR duplicates_survived OR rate_exceeded THEN
         'Data quality violations: ' || concat_ws('; ',
            CASE WHEN all_rejected THEN 'all source rows were rejected' END,
            CASE WHEN duplicates_survived THEN printf('%d duplicate business keys survived cleansing', duplicate_key_rows) END,
            CASE WHEN rate_exceeded THEN printf('rejection rate %.2f%% exceeds threshold %.2f%%', rate * 100, max_rejection_rate * 100) END)
       END AS message
FROM (
  SELECT s.env, s.max_rejection_rate, s.fail_on_violation, p.duplicate_key_rows, p.rate,
         (p.output_rows = 0 AND p.input_rows > 0) AS all_rejected,
         (p.duplicate_key_rows > 0) AS duplicates_survived,
         (p.rate > s.max_rejection_rate) AS rate_exceeded
  FROM ({PROFILE}) p,
       (SELECT 'qa' AS env, CAST(0.20 AS DOUBLE) AS max_rejection_rate, false AS fail_on_violation
        UNION ALL SELECT 'prod', CAST(0.05 AS DOUBLE), true) s
) v
"""

LINEITEM_DEDUP = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                     l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
                     l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
  FROM lineitem) t
WHERE rn = 1
"""

DUPLICATE_KEYS = """
SELECT l_orderkey, l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

_RAW = "order_id, customer_id, product_id, country, quantity, unit_price, order_ts"

TABLE_DIFF = f"""
SELECT {_RAW}, CAST(sum(w) AS BIGINT) AS copies FROM (
  SELECT {_RAW}, 1 AS w FROM ({NORMALISED}) n
  UNION ALL
  SELECT {_RAW}, -1 AS w FROM ({CLEAN}) c) u
GROUP BY {_RAW}
HAVING sum(w) > 0
"""

ROW_COUNTS = f"""
SELECT 'qa.bronze.orders_raw' AS table_name, count(*) AS row_count, count(*) > 0 AS populated FROM ({FEED}) f
UNION ALL
SELECT 'qa.silver.orders_clean', count(*), count(*) > 0 FROM ({CLEAN}) c
UNION ALL
SELECT 'qa.gold.daily_country_sales', count(*), count(*) > 0 FROM ({GOLD}) g
"""

MIN_REVENUE = f"""
SELECT min(gross_revenue) AS min_revenue, min(gross_revenue) >= 0 AS revenue_ok FROM ({GOLD}) g
"""

BRONZE_AUDIT = """
SELECT *, 'lineitem.parquet' AS _source_file, 'B-001' AS _batch_id FROM lineitem
"""

STAGE_METRICS = f"""
SELECT 'bronze' AS stage,
       'ETL_METRICS ' || to_json({{'stage': 'bronze', 'table': 'qa.bronze.orders_raw', 'rows': count(*),
                                   'batch_id': 'B-001'}}) AS line
FROM ({FEED}) f
UNION ALL
SELECT 'silver',
       'ETL_METRICS ' || to_json({{'stage': 'silver', 'table': 'qa.silver.orders_clean', 'batch_id': 'B-001',
                                   'input_rows': input_rows, 'output_rows': output_rows,
                                   'null_key_rows': null_key_rows, 'duplicate_key_rows': duplicate_key_rows,
                                   'rejected_rows': rejected_rows, 'rejection_rate': rejection_rate}})
FROM ({PROFILE}) p
UNION ALL
SELECT 'gold',
       'ETL_METRICS ' || to_json({{'stage': 'gold', 'table': 'qa.gold.daily_country_sales', 'rows': count(*),
                                   'batch_id': 'B-001'}})
FROM ({GOLD}) g
"""

LOG = """
SELECT event_id AS line_id,
       CASE WHEN event_id % 7 = 0 THEN concat('starting task ', event_type)
            WHEN event_id % 11 = 0 THEN 'ETL_METRICS not-json'
            ELSE concat('[INFO] ETL_METRICS {"stage": "', event_type, '", "event_id": ', CAST(event_id AS VARCHAR),
                        ', "input": ', props, '}') END AS line
FROM events
"""

METRIC_PAYLOADS = f"""
SELECT line_id, payload FROM (
  SELECT line_id, trim(substr(line, instr(line, 'ETL_METRICS ') + 12)) AS payload
  FROM ({LOG}) l WHERE contains(line, 'ETL_METRICS ')) p
WHERE CASE WHEN json_valid(payload) THEN json_type(CAST(payload AS JSON)) = 'OBJECT' ELSE false END
"""

EXTRACT_METRICS = f"""
SELECT line_id, payload, json_extract_string(payload, '$.stage') AS stage,
       CAST(len(json_keys(payload)) AS BIGINT) AS n_keys
FROM ({METRIC_PAYLOADS}) m
"""

METRICS_LONG = f"""
SELECT line_id, k AS key, json_extract_string(payload, '$."' || k || '"') AS value
FROM (SELECT line_id, payload, unnest(json_keys(payload)) AS k FROM ({METRIC_PAYLOADS}) m) u
"""

METRICS_WIDE = f"""
SELECT line_id,
       coalesce(json_extract_string(payload, '$.event_id'), '') AS event_id,
       coalesce(json_extract_string(payload, '$.input'), '') AS input,
       coalesce(json_extract_string(payload, '$.stage'), '') AS stage
FROM ({METRIC_PAYLOADS}) m
"""


_RARE = f"""
SELECT line_id, CASE WHEN line_id % 499 = 3 AND line LIKE '%}}' THEN substring(line, 1, length(line) - 1) || ', "retry": ' || CAST(line_id % 5 AS VARCHAR) || '}}' ELSE line END AS line
FROM ({LOG}) l
"""

METRICS_WIDE_RARE_KEY = f"""
SELECT line_id,
       coalesce(json_extract_string(payload, '$.event_id'), '') AS event_id,
       coalesce(json_extract_string(payload, '$.input'), '') AS input,
       coalesce(json_extract_string(payload, '$.retry'), '') AS retry,
       coalesce(json_extract_string(payload, '$.stage'), '') AS stage
FROM ({METRIC_PAYLOADS.replace(LOG, _RARE)}) m
"""


METRICS_REPORT = f"""
SELECT (SELECT count(*) FROM ({LOG}) l) AS log_lines,
       count(*) AS metric_lines,
       (SELECT count(DISTINCT k) FROM (SELECT unnest(json_keys(payload)) AS k FROM ({METRIC_PAYLOADS}) m2) u) AS metric_keys,
       CASE WHEN count(*) = 0 THEN '_No ETL_METRICS emitted by this run._' END AS note
FROM ({METRIC_PAYLOADS}) m
"""


def _redacted(expr: str) -> str:
    for _, pattern in CREDENTIALS:
        expr = f"regexp_replace({expr}, {_q(pattern)}, '***REDACTED***', 'g')"
    return expr


def _redact_text(docs: str) -> str:
    return f"""
SELECT doc_id, r AS redacted_text, r <> text AS redacted
FROM (SELECT doc_id, text, {_redacted('text')} AS r FROM ({docs}) s) d
"""


def _redaction_counts(docs: str, by: str) -> str:
    stages = [f"SELECT {by}, text AS s0 FROM ({docs}) d"]
    names = [n for n, _ in CREDENTIALS]
    for i, (_, pattern) in enumerate(CREDENTIALS):
        stages.append(
            f"SELECT *, len(regexp_extract_all(s{i}, {_q(pattern)})) AS c{i}, "
            f"regexp_replace(s{i}, {_q(pattern)}, '***REDACTED***', 'g') AS s{i + 1} FROM ({stages[-1]}) x{i}"
        )
    total = " + ".join(f"c{i}" for i in range(len(names)))
    sums = ", ".join(f"CAST(sum(c{i}) AS BIGINT) AS {n}_hits" for i, n in enumerate(names))
    return f"""
SELECT {by}, count(*) AS documents, count(*) FILTER (WHERE {total} > 0) AS redacted_documents, {sums}
FROM ({stages[-1]}) s
GROUP BY {by}
"""


def _rule_scan(docs: str, rules: tuple) -> str:
    lines = f"""
SELECT doc_id, CAST(i AS INTEGER) AS line_no, arr[i] AS line
FROM (SELECT doc_id, arr, unnest(range(1, len(arr) + 1)) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS arr FROM ({docs}) d) a) b
"""
    parts = [
        f"SELECT doc_id, line_no, {_q(name)} AS rule, {_q(message)} AS message FROM ({lines}) l "
        f"WHERE regexp_matches(line, {_q(rx)})"
        for name, rx, message in rules
    ]
    return "\nUNION ALL\n".join(parts)


def _required_markers(docs: str) -> str:
    indent = f"regexp_extract(text, {_q(INDENT)}, 4)"
    root = f"SELECT doc_id, CASE WHEN {indent} = '' THEN text ELSE regexp_replace(text, '(?m)^' || {indent}, '', 'g') END AS text FROM ({docs}) s"
    jobs = f"(regexp_matches(text, {_q(JOBS)}) AND NOT regexp_matches(text, {_q(NO_JOBS)}))"
    return f"""
SELECT doc_id, 'missing_trigger' AS rule, 'missing trigger (`on:`)' AS message FROM ({root}) d
WHERE NOT regexp_matches(text, {_q(TRIGGER)})
UNION ALL
SELECT doc_id, 'missing_permissions', 'no top-level `permissions:` block (least privilege)' FROM ({root}) d
WHERE NOT regexp_matches(text, {_q(PERMISSIONS)})
UNION ALL
SELECT doc_id, 'missing_jobs', 'no jobs defined' FROM ({root}) d WHERE NOT {jobs}
"""


def _rule_findings(docs: str, rules: tuple) -> str:
    return f"""
SELECT doc_id, line_no, rule, message FROM ({_rule_scan(docs, rules)}) r
UNION ALL
SELECT doc_id, CAST(NULL AS INTEGER) AS line_no, rule, message FROM ({_required_markers(docs)}) m
"""


def _findings_verdict(docs: str) -> str:
    return f"""
SELECT (SELECT count(*) FROM ({docs}) n) AS documents,
       count(*) AS findings,
       count(DISTINCT doc_id) AS documents_with_findings,
       count(*) = 0 AS passed
FROM ({_rule_findings(docs, CORPUS_RULES)}) f
"""


def _clip_text(docs: str) -> str:
    return f"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars,
       substring(r, 1, 24000) AS prompt_head,
       substring(text, 1, 20000) AS diff_head,
       length(text) > 20000 AS diff_truncated,
       right(r, 8000) AS log_tail
FROM (SELECT doc_id, text, {_redacted('text')} AS r FROM ({docs}) s) d
"""


METRIC_KEYS = f"SELECT DISTINCT unnest(json_keys(payload)) AS key FROM ({METRIC_PAYLOADS}) m"

LOG_FILE_METRICS = f"SELECT payload, json_extract_string(payload, '$.stage') AS stage FROM ({METRIC_PAYLOADS}) m"

# A file ends with a line break, which ends its last line.
FILE_FINDINGS = f"""
SELECT m.doc_id, m.rule, m.message, n.n_lines FROM ({_required_markers(WORKFLOWS)}) m
JOIN (SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines FROM ({WORKFLOWS}) w) n USING (doc_id)
"""

LOG_LINE_NUMBERS = f"""
SELECT CAST(floor(line_id / 50000) AS BIGINT) AS part, row_number() OVER (PARTITION BY floor(line_id / 50000) ORDER BY line_id) AS line_no, line
FROM ({LOG}) l
"""

_REJECTED = """
SELECT 'l_linenumber' AS "column", 'first' AS value, l_orderkey FROM lineitem WHERE (l_orderkey + l_linenumber) % 61 = 0
UNION ALL
SELECT 'l_quantity', 'q' || CAST((l_orderkey + l_linenumber) % 10 AS VARCHAR), l_orderkey FROM lineitem WHERE (l_orderkey + l_linenumber) % 37 = 0
UNION ALL
SELECT 'l_shipdate', 'someday', l_orderkey FROM lineitem WHERE (l_orderkey + l_linenumber) % 53 = 0
"""

REJECTED_FIELDS = _REJECTED

CSV_REJECTIONS = f"""
SELECT c AS "column", count(value) AS rejected, min(value) AS example
FROM (VALUES ('l_orderkey'), ('l_linenumber'), ('l_quantity'), ('l_shipdate'), ('l_returnflag')) n(c)
LEFT JOIN ({_REJECTED}) r ON r."column" = c
GROUP BY c
"""

_ORDER_ONLY = f"SELECT regexp_extract(order_id, '^ORD-([0-9]+)', 1) AS k FROM ({VALID}) v"

GATE_RULES = f"""
SELECT env, CAST(0.05 AS DOUBLE) AS max_rejection_rate, env <> 'repeated' AS fail_on_violation,
       input_rows, output_rows, null_key_rows, duplicate_key_rows, greatest(input_rows - output_rows, 0) AS rejected_rows,
       env = 'rejected' AS all_rejected, env = 'repeated' AS duplicates_survived, env = 'rejected' AS rate_exceeded,
       env = 'kept' AS passed,
       CASE env WHEN 'kept' THEN 'pass' WHEN 'repeated' THEN 'warn' ELSE 'fail' END AS action,
       CASE env
         WHEN 'repeated' THEN printf('Data quality violations: %d duplicate business keys survived cleansing', duplicate_key_rows)
         WHEN 'rejected' THEN 'Data quality violations: all source rows were rejected; rejection rate 100.00% exceeds threshold 5.00%'
       END AS message
FROM (
  SELECT 'repeated' AS env, count(*) AS input_rows, count(*) AS output_rows, CAST(0 AS BIGINT) AS null_key_rows,
         count(*) - count(DISTINCT k) AS duplicate_key_rows FROM ({_ORDER_ONLY}) a
  UNION ALL
  SELECT 'rejected', count(*), 0, count(*) FILTER (WHERE order_id IS NULL), 0 FROM ({FEED}) f
  UNION ALL
  SELECT 'kept', count(*), count(*), 0, count(*) - count(DISTINCT order_id) FROM ({CLEAN}) b
) p
"""


def all_oracles() -> dict[str, str]:
    oracles = dict(ORACLES)
    docs = "SELECT * FROM documents"
    oracles.update(
        {
            "dedupe_latest": LINEITEM_DEDUP,
            "quality_profile": f"SELECT * EXCLUDE (rate) FROM ({PROFILE}) p",
            "quality_verdict": VERDICT,
            "duplicate_keys": DUPLICATE_KEYS,
            "table_diff": TABLE_DIFF,
            "table_row_counts": ROW_COUNTS,
            "min_revenue": MIN_REVENUE,
            "bronze_audit": BRONZE_AUDIT,
            "csv_ingest": FEED,
            "layer_roundtrip": CLEAN,
            "medallion_e2e": GOLD,
            "stream_ingest": FEED,
            "stage_metrics": STAGE_METRICS,
            "redact_text": _redact_text(docs),
            "redaction_counts": _redaction_counts(docs, "lang, source"),
            "extract_metrics": EXTRACT_METRICS,
            "metrics_long": METRICS_LONG,
            "metrics_wide": METRICS_WIDE,
            "metrics_wide_rare_key": METRICS_WIDE_RARE_KEY,
            "metrics_report": METRICS_REPORT,
            "log_line_numbers": LOG_LINE_NUMBERS,
            "stage_metrics_table": f"SELECT 'B-001' AS batch_id, * FROM ({STAGE_METRICS}) s UNION ALL SELECT 'B-002', * FROM ({STAGE_METRICS}) g WHERE stage = 'gold'",
            "csv_rejections": CSV_REJECTIONS,
            "csv_rejected_fields": REJECTED_FIELDS,
            "rule_scan": _rule_scan(docs, CORPUS_RULES),
            "required_markers": _required_markers(docs),
            "rule_findings": _rule_findings(docs, CORPUS_RULES),
            "findings_verdict": _findings_verdict(docs),
            "clip_text": _clip_text(docs),
            "metric_keys": METRIC_KEYS,
            "log_file_metrics": LOG_FILE_METRICS,
            "workflow_redaction": _redact_text(WORKFLOWS),
            "workflow_redaction_counts": _redaction_counts(f"SELECT *, doc_id % 3 AS part FROM ({WORKFLOWS}) w", "part"),
            "workflow_findings": _rule_findings(WORKFLOWS, LINE_RULES),
            "workflow_file_findings": FILE_FINDINGS,
            "quality_gate_rules": GATE_RULES,
        }
    )
    return oracles
