"""DuckDB SQL building blocks for the oracles (text only; nothing runs here).

The oracles restate each operator's semantics in plain SQL over the same
derived inputs; they share the fixture derivations but not the operators.
"""

from __future__ import annotations

from stratum.plans import fixtures as fx
from stratum.operators.staging import SURVEY_FIELDS

TS_AS_OF = f"TIMESTAMP '{fx.AS_OF}'"
TS_PREVIOUS = f"TIMESTAMP '{fx.PREVIOUS_AS_OF}'"

RAW_EVENTS = fx.sql_select(fx.RAW_FROM_EVENTS, "events")
RAW_ORDERS = fx.sql_select(fx.RAW_FROM_ORDERS, "orders")
BEFORE = fx.sql_select(fx.ORDER_COLUMNS, "orders", fx.BEFORE_FILTER)
AFTER = fx.sql_select(fx.AFTER_COLUMNS, "orders", fx.AFTER_FILTER)


def json_number(text: str, key: str) -> str:
    return (f"try_cast(try_cast(CASE WHEN json_valid({text}) THEN json_extract_string({text}, '$.{key}') END "
            f"AS decimal(38,0)) AS bigint)")


def score_columns(text: str = "engagement_survey") -> str:
    return ",\n  ".join(f"{json_number(text, key)} AS {name}" for name, key in SURVEY_FIELDS.items())


def staged(raw_sql: str, source_object: str = "bronze.employee_data_parquet",
           run_id: str | None = fx.RUN_ID, ts: str = TS_AS_OF, process_type: str | None = None) -> str:
    extra = f",\n  '{run_id}' AS etl_run_id" if run_id is not None else ""
    if process_type is not None:
        extra += f",\n  '{process_type}' AS etl_process_type"
    return (f"SELECT r.*,\n  {score_columns()},\n  {ts} AS staged_at,\n  '{source_object}' AS source_object"
            f"{extra}\nFROM ({raw_sql}) r")


def avg_exact(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / count({x})"


def to_number(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,0)) AS BIGINT)"


def survey_mart(staged_sql: str, run_id: str | None = fx.RUN_ID,
                source_object: str = "silver.employee_data_stg", process_type: str | None = None) -> str:
    avgs = ",\n  ".join(f"{avg_exact(f'nullif({name}, 0)')} AS avg_{name}" for name in SURVEY_FIELDS)
    extra = f",\n  '{run_id}' AS etl_run_id" if run_id is not None else ""
    if process_type is not None:
        extra += f",\n  '{process_type}' AS etl_process_type"
    return (f"SELECT department,\n  {avgs},\n  count(*) AS num_responses,\n  {TS_AS_OF} AS materialized_at,\n"
            f"  '{source_object}' AS source_object{extra}\nFROM ({staged_sql}) s\nGROUP BY department")


def demographics_mart(staged_sql: str, run_id: str | None = fx.RUN_ID,
                      source_object: str = "silver.employee_data_stg", process_type: str | None = None) -> str:
    extra = f",\n  '{run_id}' AS etl_run_id" if run_id is not None else ""
    if process_type is not None:
        extra += f",\n  '{process_type}' AS etl_process_type"
    return f"""SELECT department,
  count(*) AS num_employees,
  {avg_exact(to_number('age'))} AS avg_age,
  {avg_exact(to_number('length_of_service'))} AS avg_length_of_service,
  CAST(sum(CASE WHEN upper(gender) = 'MALE' THEN 1 ELSE 0 END) AS BIGINT) AS num_male,
  CAST(sum(CASE WHEN upper(gender) = 'FEMALE' THEN 1 ELSE 0 END) AS BIGINT) AS num_female,
  CAST(sum(CASE WHEN upper(gender) NOT IN ('MALE', 'FEMALE') THEN 1 ELSE 0 END) AS BIGINT) AS num_other_gender,
  {TS_AS_OF} AS materialized_at,
  '{source_object}' AS source_object{extra}
FROM ({staged_sql}) s
GROUP BY department"""


def json_text(pairs: list[tuple[str, str]]) -> str:
    """JSON object text with NULL-valued keys dropped, in the given key order,
    formatted as Spark's to_json writes it (no spaces)."""
    parts = []
    for key, expr in pairs:
        value = expr[4:] if expr.startswith("RAW:") else f"to_json({expr})"
        parts.append(f"coalesce('\"{key}\":' || {value}, '')")
    # join non-empty parts with commas
    joined = " || ".join(f"coalesce(nullif({p}, '') || ',', '')" for p in parts)
    return f"('{{' || rtrim({joined}, ',') || '}}')"


VALUE_COLS = [c for c in fx.ORDER_COLUMNS if c != "o_orderkey"]


def _distinct(a: str, b: str) -> str:
    return " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in VALUE_COLS)


# Keyed change feed (orders keys are unique): deleted/changed before rows,
# inserted/changed after rows; both halves of a change flagged as updates.
def diff(before: str, after: str) -> str:
    return f"""WITH b AS ({before}), a AS ({after})
SELECT b.*, 'DELETE' AS _action, (a.o_orderkey IS NOT NULL) AS _is_update
FROM b LEFT JOIN a ON b.o_orderkey = a.o_orderkey
WHERE a.o_orderkey IS NULL OR {_distinct('b', 'a')}
UNION ALL
SELECT a.*, 'INSERT' AS _action, (b.o_orderkey IS NOT NULL) AS _is_update
FROM a LEFT JOIN b ON a.o_orderkey = b.o_orderkey
WHERE b.o_orderkey IS NULL OR {_distinct('a', 'b')}"""


DIFF = diff(BEFORE, AFTER)

TARGET = (f"SELECT *, {TS_PREVIOUS} AS staged_at, 'bronze.employee_data_parquet' AS source_object, "
          f"'{fx.PREVIOUS_RUN_ID}' AS etl_run_id FROM ({BEFORE}) b0")

MERGE_CTES = f"""WITH t AS ({TARGET}),
f AS ({DIFF}),
src AS (SELECT * FROM f WHERE NOT (_action = 'DELETE' AND _is_update)),
u AS (SELECT * FROM src WHERE _action = 'INSERT' AND _is_update),
kept AS (
  SELECT t.o_orderkey,
    {', '.join(f'CASE WHEN u.o_orderkey IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}' for c in VALUE_COLS)},
    CASE WHEN u.o_orderkey IS NOT NULL THEN {TS_AS_OF} ELSE t.staged_at END AS staged_at,
    CASE WHEN u.o_orderkey IS NOT NULL THEN 'bronze.employee_data_parquet_stream' ELSE t.source_object END AS source_object,
    CASE WHEN u.o_orderkey IS NOT NULL THEN '{fx.RUN_ID}' ELSE t.etl_run_id END AS etl_run_id,
    (u.o_orderkey IS NOT NULL) AS was_updated
  FROM t LEFT JOIN u ON t.o_orderkey = u.o_orderkey
  WHERE NOT EXISTS (SELECT 1 FROM src d WHERE d._action = 'DELETE' AND d.o_orderkey = t.o_orderkey)
),
ins AS (
  SELECT s.o_orderkey, {', '.join('s.' + c for c in VALUE_COLS)},
    {TS_AS_OF} AS staged_at, 'bronze.employee_data_parquet_stream' AS source_object, '{fx.RUN_ID}' AS etl_run_id
  FROM src s
  WHERE s._action = 'INSERT' AND NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
)"""

MERGED = MERGE_CTES + """
SELECT * EXCLUDE (was_updated) FROM kept UNION ALL SELECT * FROM ins"""

MERGE_COUNTS = MERGE_CTES + """
SELECT (SELECT count(*) FROM ins) AS rows_inserted,
       (SELECT count(*) FROM kept WHERE was_updated) AS rows_updated,
       (SELECT count(*) FROM t) - (SELECT count(*) FROM kept) AS rows_deleted"""


# ------------------------------------------------------------- run logs ---
from stratum.plans import logs as _logs  # noqa: E402

_STARTED = json_text([("component", "'ELT_Pipeline'"), ("run_id", "run_id"), ("pipeline", "pipeline"),
                      ("stage", "stage"), ("status", "'STARTED'"), ("source", "source"), ("target", "target"),
                      ("procedure", "procedure")])
_FINISHED = json_text([("component", "'ELT_Pipeline'"), ("run_id", "run_id"), ("pipeline", "pipeline"),
                       ("stage", "stage"), ("status", "status"),
                       ("duration_seconds", "CASE WHEN status <> 'FAILED' THEN datediff('second', started_at, ended_at) END"),
                       ("result", "CASE WHEN status <> 'FAILED' THEN result END"),
                       ("error_code", "CASE WHEN status = 'FAILED' THEN CAST(error_code AS BIGINT) END"),
                       ("error_message", "CASE WHEN status = 'FAILED' THEN error_message END"),
                       ("procedure", "procedure")])
_SCOPE = json_text([("name", "procedure")])

PIPELINE_EVENTS = f"""WITH runs AS ({_logs.RUNS_SQL})
SELECT started_at AS timestamp, 'LOG' AS record_type, 'INFO' AS severity, {_SCOPE} AS scope, {_STARTED} AS value FROM runs
UNION ALL
SELECT ended_at, 'LOG', CASE WHEN status = 'FAILED' THEN 'ERROR' ELSE 'INFO' END, {_SCOPE}, {_FINISHED} FROM runs
UNION ALL
SELECT started_at, 'SPAN', 'INFO', {_SCOPE}, CAST(NULL AS VARCHAR) FROM runs"""


def log_field(key: str, text: str = "value") -> str:
    return f"CASE WHEN json_valid({text}) THEN json_extract_string({text}, '$.{key}') END"


PARSED_LOG = f"""SELECT timestamp, record_type,
  {log_field('name', 'scope')} AS scope_name,
  {log_field('run_id')} AS run_id, {log_field('pipeline')} AS pipeline, {log_field('stage')} AS stage,
  {log_field('event')} AS event, {log_field('status')} AS status, {log_field('task_name')} AS task_name,
  try_cast(try_cast({log_field('duration_seconds')} AS DECIMAL(38,0)) AS BIGINT) AS duration_seconds,
  {log_field('source')} AS source_object, {log_field('target')} AS target_object,
  {log_field('error_message')} AS error_message
FROM ({PIPELINE_EVENTS}) e"""


def json_ts(col: str) -> str:
    """A timestamp as Spark's to_json writes it."""
    return f"RAW:('\"' || strftime({col}, '%Y-%m-%dT%H:%M:%S.%g') || '\"')"


def issue_row(issues_sql: str, *, check_name: str, layer: str, table_name: str,
              sample: list[tuple[str, str]], array_key: str, ts: str = TS_AS_OF, limit: int = 10,
              ts_keys: tuple[str, ...] = ()) -> str:
    """Oracle of quality.issue_report: count + up to `limit` smallest sample objects.

    `sample` = [(json key, SQL expr)]; keys in `ts_keys` are timestamps."""
    cols = ", ".join(f"{expr} AS {key}" for key, expr in sample)
    order = ", ".join(f"{key} ASC NULLS FIRST" for key, _ in sample)
    item = json_text([(k, json_ts(k) if k in ts_keys else k) for k, _ in sample])
    return f"""WITH issues AS ({issues_sql}),
picked AS (SELECT * FROM (SELECT {cols} FROM issues) z ORDER BY {order} LIMIT {limit})
SELECT '{check_name}' AS check_name, '{layer}' AS layer, '{table_name}' AS table_name,
  (SELECT count(*) FROM issues) AS issue_count,
  '{{"{array_key}":[' || coalesce((SELECT string_agg({item}, ',' ORDER BY {order}) FROM picked), '') || ']}}'
    AS sample_details,
  {ts} AS checked_at"""
