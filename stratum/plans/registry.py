"""The registered queries: one per operator of the inventory, each paired
with a DuckDB oracle where the result is expressible in SQL.

Every query reads whole driver tables (or data Spark derives from them);
`as_of` and run ids are fixed literals so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.json_fields import with_json_number_fields
from stratum.operators import marts, staging
from stratum.plans import fixtures as fx
from stratum.plans import oracle_sql as o

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def staged_events(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    kw.setdefault("as_of", fx.AS_OF)
    kw.setdefault("run_id", fx.RUN_ID)
    return staging.stage_rows(fx.raw_from_events(spark, sf_dir), **kw)


def staged_orders(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    kw.setdefault("as_of", fx.AS_OF)
    kw.setdefault("run_id", fx.RUN_ID)
    return staging.stage_rows(fx.raw_from_orders(spark, sf_dir), **kw)


# ---------------------------------------------------------------- staging ---

@register("json_number_fields", f"""SELECT employee_number,
  {o.score_columns()}
FROM ({o.RAW_EVENTS}) r""")
def q_json_number_fields(spark, sf_dir):
    raw = fx.raw_from_events(spark, sf_dir).select("employee_number", "engagement_survey")
    return with_json_number_fields(raw, "engagement_survey", staging.SURVEY_FIELDS).drop("engagement_survey")


@register("stage_rows", o.staged(o.RAW_EVENTS))
def q_stage_rows(spark, sf_dir):
    return staged_events(spark, sf_dir)


# ------------------------------------------------------------------ marts ---

@register("survey_results", o.survey_mart(o.staged(o.RAW_EVENTS)))
def q_survey_results(spark, sf_dir):
    return marts.survey_results(staged_events(spark, sf_dir), as_of=fx.AS_OF, run_id=fx.RUN_ID)


@register("demographics", o.demographics_mart(o.staged(o.RAW_ORDERS)))
def q_demographics(spark, sf_dir):
    return marts.demographics(staged_orders(spark, sf_dir), as_of=fx.AS_OF, run_id=fx.RUN_ID)


@register("row_count", f"SELECT count(*) AS silver_row_count FROM ({o.RAW_EVENTS}) r")
def q_row_count(spark, sf_dir):
    return marts.row_count(staged_events(spark, sf_dir), "silver_row_count")


LATEST_COLUMNS = ["employee_number", "employee_name", "department", "satisfaction_score",
                  "work_life_balance_score", "career_growth_score", "communication_score",
                  "teamwork_score", "staged_at", "etl_run_id"]


@register("latest_k", f"""SELECT {', '.join(LATEST_COLUMNS)}
FROM ({o.staged(fx.sql_select(fx.RAW_FROM_EVENTS + ['ts AS r_ts'], 'events'), ts='r.r_ts')}) s
ORDER BY staged_at DESC, employee_number
LIMIT 20""")
def q_latest_k(spark, sf_dir):
    raw = fx.table(spark, sf_dir, "events").selectExpr(*fx.RAW_FROM_EVENTS, "ts AS r_ts")
    staged = staging.stage_rows(raw, as_of=fx.AS_OF, run_id=fx.RUN_ID).withColumn("staged_at", F.col("r_ts"))
    return marts.latest_k(staged, "staged_at", 20, tie_break=["employee_number"], columns=LATEST_COLUMNS)


@register("scan", "SELECT * FROM events")
def q_scan(spark, sf_dir):
    return fx.table(spark, sf_dir, "events")


# ---------------------------------------------------- change feed + MERGE ---

from stratum.operators import changes, merge  # noqa: E402
from stratum.functions.scalars import ts_literal  # noqa: E402


def orders_feed(spark, sf_dir):
    return changes.snapshot_diff(fx.orders_before(spark, sf_dir), fx.orders_after(spark, sf_dir), "o_orderkey")


def stored_feed(feed):
    """The change feed as a table (what a table stream is): computed once, read by MERGE."""
    from stratum.session import work_dir as _wd
    from stratum.sources.tables import materialize
    return materialize(feed, _wd(feed.sparkSession, "feed"))


def orders_target(spark, sf_dir):
    return fx.orders_before(spark, sf_dir).withColumns(
        staging.lineage_stamps(fx.PREVIOUS_AS_OF, staging.RAW_TABLE, fx.PREVIOUS_RUN_ID))


def stream_stamps():
    return staging.lineage_stamps(fx.AS_OF, staging.RAW_STREAM, fx.RUN_ID)


@register("snapshot_diff", o.DIFF)
def q_snapshot_diff(spark, sf_dir):
    return orders_feed(spark, sf_dir)


@register("has_changes", f"SELECT count(*) > 0 AS has_changes FROM ({o.DIFF}) f")
def q_has_changes(spark, sf_dir):
    return changes.has_changes(orders_feed(spark, sf_dir))


@register("merge_changes", o.MERGED)
def q_merge_changes(spark, sf_dir):
    return merge.merge_changes(orders_target(spark, sf_dir), stored_feed(orders_feed(spark, sf_dir)), "o_orderkey",
                               stamps=stream_stamps())


@register("merge_counts", o.MERGE_COUNTS)
def q_merge_counts(spark, sf_dir):
    return merge.merge_counts(orders_target(spark, sf_dir), stored_feed(orders_feed(spark, sf_dir)), "o_orderkey")


@register("update_where_in", f"""WITH r AS ({o.RAW_ORDERS})
SELECT * REPLACE (CASE WHEN employee_number = (SELECT min(employee_number) FROM r) THEN NULL
                       ELSE employee_number END AS employee_number)
FROM r""")
def q_update_where_in(spark, sf_dir):
    return merge.update_where_in(fx.raw_from_orders(spark, sf_dir), "employee_number", None, "employee_number")


_BUILDING = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"


@register("update_where_listed", f"""SELECT * REPLACE (CASE WHEN o_custkey IN ({_BUILDING}) THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
FROM ({fx.sql_select(fx.ORDERS_WITH_ORPHANS, 'orders')}) x""")
def q_update_where_listed(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").selectExpr(*fx.ORDERS_WITH_ORPHANS)
    building = fx.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return merge.update_where_in(orders, "o_orderstatus", "X", "o_custkey", keys=building, keys_col="c_custkey")


@register("semi_in", f"""SELECT * FROM ({fx.sql_select(fx.ORDERS_WITH_ORPHANS, 'orders')}) x
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_semi_in(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").selectExpr(*fx.ORDERS_WITH_ORPHANS)
    building = fx.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return merge.semi_in(orders, "o_custkey", building, "c_custkey")


# Snapshots stored in parts of 4,096 consecutive keys: only parts whose digests differ are compared.

def _stored_snapshots(spark, sf_dir):
    from stratum.session import work_dir as _wd
    from stratum.sources.snapshots import SnapshotStore
    before, after = fx.orders_before(spark, sf_dir), fx.orders_after(spark, sf_dir)
    store = SnapshotStore(spark, _wd(spark, "snapshots"), before.schema, "o_orderkey", width=4096, n_parts=64)
    store.publish(before, 1)
    store.publish(after, 2)
    return store


@register("stored_diff", o.DIFF)
def q_stored_diff(spark, sf_dir):
    return _stored_snapshots(spark, sf_dir).diff(1, 2)


@register("stored_has_changes", f"SELECT count(*) > 0 AS has_changes FROM ({o.DIFF}) f")
def q_stored_has_changes(spark, sf_dir):
    return _stored_snapshots(spark, sf_dir).has_changes(1, 2)


# A log of two change sets, one after the other: to the "after" table, then on to today's orders.
_TODAY = fx.sql_select(fx.ORDER_COLUMNS, "orders")


@register("net_changes", f"""WITH log AS (
  SELECT *, 1 AS _seq FROM ({o.diff(o.BEFORE, o.AFTER)}) x UNION ALL SELECT *, 2 AS _seq FROM ({o.diff(o.AFTER, _TODAY)}) y),
src AS (SELECT * FROM log WHERE NOT (_action = 'DELETE' AND _is_update)),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _seq DESC) AS back,
        count(*) FILTER (WHERE _action = 'DELETE' OR _is_update) OVER (PARTITION BY o_orderkey) AS n FROM src)
SELECT * EXCLUDE (_seq, _is_update, back, n), _action = 'INSERT' AND n > 0 AS _is_update FROM r WHERE back = 1""")
def q_net_changes(spark, sf_dir):
    after = fx.orders_after(spark, sf_dir)
    first = changes.snapshot_diff(fx.orders_before(spark, sf_dir), after, "o_orderkey").withColumn("_seq", F.lit(1))
    then = changes.snapshot_diff(after, fx.table(spark, sf_dir, "orders").select(*fx.ORDER_COLUMNS), "o_orderkey").withColumn("_seq", F.lit(2))
    return changes.net_changes(first.unionByName(then), "o_orderkey", "_seq")


# ------------------------------------------------------ refreshed marts ---

from stratum.operators import refresh  # noqa: E402

DT_SOURCE = staging.STAGED_REFRESHED


def _dt_demographics(spark, sf_dir):
    before, after = fx.orders_before(spark, sf_dir), fx.orders_after(spark, sf_dir)
    feed = changes.snapshot_diff(before, after, "o_orderkey")  # read once: no need to store it
    measures = refresh.demographics_measures()
    state = refresh.mart_state(before.selectExpr(*fx.RAW_FROM_ORDERS), ["department"], measures)
    delta_rows = feed.selectExpr(*fx.RAW_FROM_ORDERS, "_action")
    state = refresh.refresh_mart(state, delta_rows, changes.signed_weight(feed), ["department"], measures)
    return refresh.finalize(state, ["department"], measures,
                            marts.mart_stamps(fx.AS_OF, None, DT_SOURCE, "dt_refresh"))


def _dt_survey(spark, sf_dir):
    before, after = fx.events_before(spark, sf_dir), fx.events_after(spark, sf_dir)
    feed = changes.snapshot_diff(before, after, "event_id")  # read once: no need to store it
    measures = refresh.survey_measures()
    stage = lambda raw: staging.stage_rows(raw, as_of=fx.AS_OF, process_type="dt_refresh")
    from stratum.sources.tables import spread_input
    state = refresh.mart_state(stage(spread_input(before).selectExpr(*fx.RAW_FROM_EVENTS)), ["department"], measures)
    delta_rows = stage(feed.selectExpr(*fx.RAW_FROM_EVENTS, "_action"))
    state = refresh.refresh_mart(state, delta_rows, changes.signed_weight(feed), ["department"], measures)
    return refresh.finalize(state, ["department"], measures,
                            marts.mart_stamps(fx.AS_OF, None, DT_SOURCE, "dt_refresh"))


_AFTER_ORDERS_RAW = fx.sql_select(fx.RAW_FROM_ORDERS, f"({o.AFTER}) a")
_AFTER_EVENTS_RAW = fx.sql_select(
    fx.RAW_FROM_EVENTS, f"({fx.sql_select(fx.EVENTS_AFTER_COLUMNS, 'events', fx.EVENTS_AFTER_FILTER)}) a")

register("dt_demographics", o.demographics_mart(o.staged(_AFTER_ORDERS_RAW), run_id=None,
                                                source_object=DT_SOURCE, process_type="dt_refresh"))(_dt_demographics)
register("dt_survey", o.survey_mart(o.staged(_AFTER_EVENTS_RAW), run_id=None,
                                    source_object=DT_SOURCE, process_type="dt_refresh"))(_dt_survey)


# The same marts as stateful streams: two refreshes, each by a stream of its own over the same checkpoint.

def _streamed_mart(spark, before, after, key, measures, staged):
    from stratum.session import work_dir as _wd
    from stratum.streaming.mart_stream import MartStream
    root, first = _wd(spark, "mart_stream"), staged(before).withColumn("_w", F.lit(1))
    stream = lambda: MartStream(spark, root, f"{root}/feed", first.drop("_w").schema, ["department"], measures)
    stream().append(first)
    stream().refresh()
    feed = changes.snapshot_diff(before, after, key)
    stream().append(staged(feed).withColumn("_w", changes.signed_weight(feed)))
    stream().refresh()
    return stream().mart(marts.mart_stamps(fx.AS_OF, None, DT_SOURCE, "dt_refresh"))


@register("dt_demographics_stream", o.demographics_mart(o.staged(_AFTER_ORDERS_RAW), run_id=None,
                                                        source_object=DT_SOURCE, process_type="dt_refresh"))
def q_dt_demographics_stream(spark, sf_dir):
    staged = lambda rows: rows.selectExpr(*fx.RAW_FROM_ORDERS, *[c for c in rows.columns if c == "_action"])
    return _streamed_mart(spark, fx.orders_before(spark, sf_dir), fx.orders_after(spark, sf_dir), "o_orderkey",
                          refresh.demographics_measures(), staged)


@register("dt_survey_stream", o.survey_mart(o.staged(_AFTER_EVENTS_RAW), run_id=None,
                                            source_object=DT_SOURCE, process_type="dt_refresh"))
def q_dt_survey_stream(spark, sf_dir):
    def staged(rows):
        raw = rows.selectExpr(*fx.RAW_FROM_EVENTS, *[c for c in rows.columns if c == "_action"])
        return staging.stage_rows(raw, as_of=fx.AS_OF, process_type="dt_refresh")
    return _streamed_mart(spark, fx.events_before(spark, sf_dir), fx.events_after(spark, sf_dir), "event_id",
                          refresh.survey_measures(), staged)


# ------------------------------------------------------------- run logs ---

from stratum.operators import observe  # noqa: E402
from stratum.plans import logs  # noqa: E402


def pipeline_events(spark, sf_dir):
    return observe.event_rows(logs.runs(spark, sf_dir), include_spans=True)


@register("event_rows", o.PIPELINE_EVENTS)
def q_event_rows(spark, sf_dir):
    return pipeline_events(spark, sf_dir)


@register("event_recent", f"""SELECT * FROM ({o.PIPELINE_EVENTS}) e
WHERE record_type IN ('EVENT', 'LOG', 'INFO')
ORDER BY timestamp DESC, value ASC NULLS LAST, scope ASC NULLS LAST, severity ASC NULLS LAST,
  record_type ASC NULLS LAST
LIMIT 50""")
def q_event_recent(spark, sf_dir):
    return observe.event_recent(pipeline_events(spark, sf_dir))


@register("event_extract", f"""SELECT * EXCLUDE (record_type) FROM ({o.PARSED_LOG}) p
WHERE record_type = 'LOG' AND pipeline = 'streams_tasks_elt'
ORDER BY timestamp DESC, run_id ASC NULLS LAST, status ASC NULLS LAST, stage ASC NULLS LAST
LIMIT 20""")
def q_event_extract(spark, sf_dir):
    return observe.event_extract(pipeline_events(spark, sf_dir))


@register("event_summary", f"""SELECT stage AS pipeline_stage, status, count(*) AS execution_count,
  {o.avg_exact('duration_seconds')} AS avg_duration_seconds
FROM ({o.PARSED_LOG}) p
WHERE record_type = 'LOG' AND pipeline = 'streams_tasks_elt' AND status IS NOT NULL
  AND timestamp >= {o.TS_AS_OF} - INTERVAL 7 DAY
GROUP BY stage, status""")
def q_event_summary(spark, sf_dir):
    return observe.event_summary(pipeline_events(spark, sf_dir), fx.AS_OF, days=7)


TASK_NAMES = ("T_SILVER_FROM_BRONZE_STREAM", "T_GOLD_REFRESH_AFTER_SILVER")


@register("run_history", f"""SELECT * FROM (
  SELECT * FROM ({logs.TASK_HISTORY_SQL}) h
  WHERE scheduled_time >= {o.TS_AS_OF} - INTERVAL 2 HOUR
  ORDER BY scheduled_time DESC, name ASC NULLS LAST LIMIT 50) x
WHERE database_name = 'ELT_DB' AND schema_name = 'TASKS' AND name IN {TASK_NAMES}""")
def q_run_history(spark, sf_dir):
    where = ((F.col("database_name") == "ELT_DB") & (F.col("schema_name") == "TASKS")
             & F.col("name").isin(*TASK_NAMES))
    return observe.run_history(logs.task_history(spark, sf_dir), fx.AS_OF, hours=2, limit=50, where=where)


@register("refresh_history", f"""SELECT name, data_timestamp, state, state_code, state_message, refresh_action,
  query_id, statistics
FROM ({logs.REFRESH_HISTORY_SQL}) h
WHERE name LIKE 'DT_%' AND data_timestamp >= {o.TS_AS_OF} - INTERVAL 6 DAY""")
def q_refresh_history(spark, sf_dir):
    return observe.refresh_history(logs.dt_refresh_history(spark, sf_dir), fx.AS_OF, days=6)


def _stat(key):
    return f"try_cast(try_cast({o.log_field(key, 'statistics')} AS DECIMAL(38,0)) AS BIGINT)"


@register("refresh_summary", f"""SELECT name, count(*) AS total_refreshes,
  CAST(sum(CASE WHEN state = 'SUCCEEDED' THEN 1 ELSE 0 END) AS BIGINT) AS successful_refreshes,
  CAST(sum(CASE WHEN state = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_refreshes,
  CAST(sum({_stat('numInsertedRows')}) AS BIGINT) AS total_rows_inserted,
  CAST(sum({_stat('numDeletedRows')}) AS BIGINT) AS total_rows_deleted,
  CAST(sum({_stat('numCopiedRows')}) AS BIGINT) AS total_rows_copied
FROM ({logs.REFRESH_HISTORY_SQL}) h
WHERE name LIKE 'DT_%' AND data_timestamp >= {o.TS_AS_OF} - INTERVAL 1 DAY
GROUP BY name""")
def q_refresh_summary(spark, sf_dir):
    return observe.refresh_summary(logs.dt_refresh_history(spark, sf_dir), fx.AS_OF, days=1)


@register("history_like", f"""SELECT name, schema_name, count(*) AS refresh_count, CAST(300 AS BIGINT) AS target_lag_sec
FROM ({logs.REFRESH_HISTORY_SQL}) h WHERE name LIKE 'DT_%' GROUP BY name, schema_name""")
def q_history_like(spark, sf_dir):
    return observe.table_listing(logs.dt_refresh_history(spark, sf_dir), pattern="DT_%")


@register("freshness", f"""SELECT name,
  max(CASE WHEN state = 'SUCCEEDED' THEN data_timestamp END) AS latest_data_timestamp,
  arg_max(schema_name, struct_pack(t := data_timestamp, q := query_id)) AS schema_name,
  arg_max(state, struct_pack(t := data_timestamp, q := query_id)) AS last_completed_refresh_state,
  arg_max(state_code, struct_pack(t := data_timestamp, q := query_id)) AS last_completed_refresh_state_code,
  arg_max_null(state_message, struct_pack(t := data_timestamp, q := query_id)) AS last_completed_refresh_state_message,
  CAST(sum(CASE WHEN datediff('second', data_timestamp, refresh_end_time) <= 300 THEN 1 ELSE 0 END) AS DOUBLE)
    / count(*) AS time_within_target_lag_ratio,
  max(datediff('second', data_timestamp, refresh_end_time)) AS maximum_lag_sec,
  CAST(300 AS BIGINT) AS target_lag_sec
FROM ({logs.REFRESH_HISTORY_SQL}) h WHERE name LIKE 'DT_%' GROUP BY name""")
def q_freshness(spark, sf_dir):
    return refresh.freshness(logs.dt_refresh_history(spark, sf_dir), target_lag_sec=300)


def _duck_step_msg():
    secs = "datediff('second', started_at, ended_at)"
    return (f"CASE WHEN error_message IS NOT NULL THEN 'ERROR: Failed to build ' || table_name || ' - ' || error_message "
            f"ELSE 'SUCCESS: Built ' || table_name || ' with ' || CAST(row_count AS VARCHAR) || ' rows in ' || "
            f"CAST({secs} AS VARCHAR) || ' seconds' END")


@register("run_summary", f"""WITH s AS (SELECT *, {_duck_step_msg()} AS result FROM ({logs.STEPS_SQL}) x),
r AS (SELECT run_id, min(started_at) AS run_started_at, max(ended_at) AS run_end,
        CAST(sum(CASE WHEN result LIKE 'ERROR:%' THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
        max(CASE WHEN step = 'DEMOGRAPHICS TABLE' THEN result END) AS t0,
        max(CASE WHEN step = 'SURVEY TABLE' THEN result END) AS t1
      FROM s GROUP BY run_id)
SELECT run_id, run_started_at, datediff('second', run_started_at, run_end) AS total_seconds, error_count,
  CASE WHEN error_count > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  '=== GOLD LAYER BUILD SUMMARY ===' || chr(10) || 'Total execution time: ' ||
  CAST(datediff('second', run_started_at, run_end) AS VARCHAR) || ' seconds' || chr(10) ||
  'Errors encountered: ' || CAST(error_count AS VARCHAR) || chr(10) || chr(10) ||
  'DEMOGRAPHICS TABLE: ' || coalesce(t0, '') || chr(10) || 'SURVEY TABLE: ' || coalesce(t1, '') AS summary
FROM r""")
def q_run_summary(spark, sf_dir):
    return observe.run_summary(logs.build_steps(spark, sf_dir), logs.STEP_LABELS)


# ----------------------------------------------------------- data quality ---

from stratum.operators import quality  # noqa: E402
from stratum.sources import tables  # noqa: E402
from stratum.session import work_dir  # noqa: E402

SCORES = list(staging.SURVEY_FIELDS)
RANGE_SAMPLE = [("employee_number", "employee_number"), ("department", "department"),
                ("satisfaction", "satisfaction_score"), ("work_life", "work_life_balance_score"),
                ("career", "career_growth_score"), ("communication", "communication_score"),
                ("teamwork", "teamwork_score"), ("staged_at", "staged_at"),
                ("source_object", "source_object"), ("etl_run_id", "etl_run_id")]
NULL_SAMPLE = [("employee_name", "employee_name")]
CHECK_AS_OF_2 = "2024-01-31 00:01:00"


def _null_check(raw, as_of):
    return quality.null_check(raw, "employee_number", sample=NULL_SAMPLE, check_name="null_employee_number",
                              layer="bronze", table_name=staging.RAW_TABLE, as_of=as_of)


def _range_check(staged, as_of):
    return quality.range_check(staged, SCORES, sample=RANGE_SAMPLE, check_name="invalid_survey_range",
                               layer="silver", table_name=staging.STAGED_TABLE, as_of=as_of)


_RANGE_BAD = " OR ".join(f"coalesce({c}, 0) NOT BETWEEN 1 AND 5" for c in SCORES)
_STAGED_EVENTS = o.staged(o.RAW_EVENTS)


def _null_oracle(raw_sql, ts=o.TS_AS_OF):
    return o.issue_row(f"SELECT * FROM ({raw_sql}) r WHERE employee_number IS NULL", check_name="null_employee_number",
                       layer="bronze", table_name=staging.RAW_TABLE, sample=NULL_SAMPLE, array_key="sample_rows", ts=ts)


def _range_oracle(staged_sql, ts=o.TS_AS_OF):
    return o.issue_row(f"SELECT * FROM ({staged_sql}) s WHERE {_RANGE_BAD}", check_name="invalid_survey_range",
                       layer="silver", table_name=staging.STAGED_TABLE, sample=RANGE_SAMPLE, array_key="bad_rows",
                       ts=ts, ts_keys=("staged_at",))


@register("null_check", _null_oracle(o.RAW_ORDERS))
def q_null_check(spark, sf_dir):
    return _null_check(fx.raw_from_orders(spark, sf_dir), fx.AS_OF)


register("range_check", _range_oracle(_STAGED_EVENTS))(
    lambda spark, sf_dir: _range_check(staged_events(spark, sf_dir, filtered=True), fx.AS_OF))

# Fault injection (made deterministic): score 99 on the smallest
# staged key, NULL key on the smallest raw key; then the checks run again.
_INJ_STAGED = (f"SELECT * REPLACE (CASE WHEN employee_number = (SELECT min(employee_number) FROM ({_STAGED_EVENTS}) m) "
               f"THEN 99 ELSE satisfaction_score END AS satisfaction_score) FROM ({_STAGED_EVENTS}) s")
_INJ_RAW = (f"SELECT * REPLACE (CASE WHEN employee_number = (SELECT min(employee_number) FROM ({o.RAW_ORDERS}) m) "
            f"THEN NULL ELSE employee_number END AS employee_number) FROM ({o.RAW_ORDERS}) r")
_TS2 = f"TIMESTAMP '{CHECK_AS_OF_2}'"


def _injected_checks(spark, sf_dir):
    raw = merge.update_where_in(fx.raw_from_orders(spark, sf_dir), "employee_number", None, "employee_number")
    staged = merge.update_where_in(staged_events(spark, sf_dir, filtered=True), "satisfaction_score", 99, "employee_number")
    return _null_check(raw, CHECK_AS_OF_2).unionByName(_range_check(staged, CHECK_AS_OF_2))


def _all_checks(spark, sf_dir):
    first = _null_check(fx.raw_from_orders(spark, sf_dir), fx.AS_OF).unionByName(
        _range_check(staged_events(spark, sf_dir, filtered=True), fx.AS_OF))
    return first.unionByName(_injected_checks(spark, sf_dir))


def _union(*sqls: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({q}) u{i}" for i, q in enumerate(sqls))


_INJECTED_RESULTS = _union(_null_oracle(_INJ_RAW, _TS2), _range_oracle(_INJ_STAGED, _TS2))
_ALL_RESULTS = _union(_null_oracle(o.RAW_ORDERS), _range_oracle(_STAGED_EVENTS), _INJECTED_RESULTS)


@register("dq_injected", _INJECTED_RESULTS)
def q_dq_injected(spark, sf_dir):
    return _injected_checks(spark, sf_dir)


@register("dq_results", f"""SELECT * FROM ({_ALL_RESULTS}) x ORDER BY checked_at DESC, check_name, table_name LIMIT 50""")
def q_dq_results(spark, sf_dir):
    path = work_dir(spark, "data_quality_results")
    for part in (_null_check(fx.raw_from_orders(spark, sf_dir), fx.AS_OF),
                 _range_check(staged_events(spark, sf_dir, filtered=True), fx.AS_OF), _injected_checks(spark, sf_dir)):
        tables.append_rows(part.select(*quality.RESULT_COLUMNS), path)
    return quality.latest_results(tables.read_table(spark, path), 50)


@register("dq_trend", f"""SELECT check_name, table_name, CAST(checked_at AS DATE) AS check_date, count(*) AS runs,
  CAST(sum(issue_count) AS BIGINT) AS total_issues, max(issue_count) AS max_issues
FROM ({_ALL_RESULTS}) x GROUP BY ALL""")
def q_dq_trend(spark, sf_dir):
    return quality.dq_trend(_all_checks(spark, sf_dir))


_SCORE_CHECKS = {f"{c}_out_of_range": f"coalesce({c}, 0) NOT BETWEEN 1 AND 5" for c in SCORES}
_SCORE_CHECKS["null_employee_number"] = "employee_number IS NULL"
_SCORE_CHECKS["null_department"] = "department IS NULL"


@register("quality_score", "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS check_name, '{staging.STAGED_TABLE}' AS table_name, count(*) AS rows_checked,
  count(*) FILTER (WHERE {cond}) AS issue_count,
  CAST(count(*) - count(*) FILTER (WHERE {cond}) AS DOUBLE) / count(*) AS quality_score
FROM ({_STAGED_EVENTS}) s""" for name, cond in _SCORE_CHECKS.items()))
def q_quality_score(spark, sf_dir):
    checks = {name: F.expr(cond) for name, cond in _SCORE_CHECKS.items()}
    return quality.quality_score(staged_events(spark, sf_dir), checks, table_name=staging.STAGED_TABLE)


_ORPHANS = fx.sql_select(fx.ORDERS_WITH_ORPHANS, "orders")
REF_SAMPLE = [("o_orderkey", "o_orderkey"), ("o_custkey", "o_custkey")]


@register("ref_check", o.issue_row(
    f"SELECT * FROM ({_ORPHANS}) x WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)",
    check_name="orphan_o_custkey", layer="bronze", table_name="orders", sample=REF_SAMPLE, array_key="sample_rows"))
def q_ref_check(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").selectExpr(*fx.ORDERS_WITH_ORPHANS)
    return quality.ref_check(orders, "o_custkey", fx.table(spark, sf_dir, "customer"), "c_custkey",
                             sample=REF_SAMPLE, check_name="orphan_o_custkey", layer="bronze",
                             table_name="orders", as_of=fx.AS_OF)


# Every check of a table in one scan. Orders: references, NULL keys and prices; staged rows: keys and scores.
PRICE_SAMPLE = [("o_totalprice", "o_totalprice"), ("o_orderkey", "o_orderkey")]
_ORDER_RULES = [("orphan_o_custkey", "o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)", REF_SAMPLE, "sample_rows"),
                ("null_o_custkey", "o_custkey IS NULL", REF_SAMPLE[:1], "sample_rows"),
                ("price_out_of_range", "o_totalprice NOT BETWEEN 1000 AND 300000", PRICE_SAMPLE, "bad_rows")]
KEY_SAMPLE = [("employee_number", "employee_number"), ("department", "department")]
_STAGED_RULES = [("invalid_survey_range", _RANGE_BAD, RANGE_SAMPLE, "bad_rows"),
                 ("null_satisfaction_score", "satisfaction_score IS NULL", KEY_SAMPLE, "sample_rows"),
                 ("null_employee_number", "employee_number IS NULL", KEY_SAMPLE, "sample_rows")]


def _suite_oracle(rows_sql, rules, layer, table_name):
    return _union(*[f"""SELECT *, (SELECT count(*) FROM ({rows_sql}) a) AS rows_checked FROM ({o.issue_row(
        f"SELECT * FROM ({rows_sql}) x WHERE {cond}", check_name=name, layer=layer, table_name=table_name, sample=sample,
        array_key=key, ts_keys=("staged_at",))}) r""" for name, cond, sample, key in rules])


@register("check_suite_orders", _suite_oracle(_ORPHANS, _ORDER_RULES, "bronze", "orders"))
def q_check_suite_orders(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").selectExpr(*fx.ORDERS_WITH_ORPHANS)
    flagged = quality.with_reference(orders, "o_custkey", fx.table(spark, sf_dir, "customer"), "c_custkey", "orphan")
    failed = {"orphan_o_custkey": F.col("orphan"), "null_o_custkey": F.col("o_custkey").isNull(),
              "price_out_of_range": quality.out_of_range(F.col("o_totalprice"), 1000, 300000)}
    checks = [quality.Check(name, failed[name], sample, key, "bronze", "orders") for name, _, sample, key in _ORDER_RULES]
    return quality.check_suite(flagged, checks, as_of=fx.AS_OF)


def _staged_suite(spark, sf_dir):
    failed = {"invalid_survey_range": quality.any_of([quality.out_of_range(F.col(c)) for c in SCORES]),
              "null_satisfaction_score": F.col("satisfaction_score").isNull(), "null_employee_number": F.col("employee_number").isNull()}
    checks = [quality.Check(name, failed[name], sample, key, "silver", staging.STAGED_TABLE) for name, _, sample, key in _STAGED_RULES]
    return quality.check_suite(staged_events(spark, sf_dir, filtered=True), checks, as_of=fx.AS_OF)


_STAGED_SUITE = _suite_oracle(_STAGED_EVENTS, _STAGED_RULES, "silver", staging.STAGED_TABLE)


@register("check_suite_staged", _STAGED_SUITE)
def q_check_suite_staged(spark, sf_dir):
    return _staged_suite(spark, sf_dir)


@register("suite_score", f"""SELECT check_name, table_name, rows_checked, issue_count,
  CAST(rows_checked - issue_count AS DOUBLE) / rows_checked AS quality_score FROM ({_STAGED_SUITE}) z""")
def q_suite_score(spark, sf_dir):
    return quality.suite_score(_staged_suite(spark, sf_dir))


# Reject rules: unparseable survey text; any score wider than 100.
_REJECT_SQL = {
    "invalid_survey_json": "engagement_survey IS NOT NULL AND NOT json_valid(engagement_survey)",
    "score_overflow": " OR ".join(f"coalesce({c}, 0) > 100" for c in SCORES),
}


@register("quarantine", f"""SELECT employee_number, department, engagement_survey, reject_reason FROM (
  SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _REJECT_SQL.items())}) AS reject_reason
  FROM ({_STAGED_EVENTS}) s) x
WHERE reject_reason <> ''""")
def q_quarantine(spark, sf_dir):
    rules = {"invalid_survey_json": F.col("engagement_survey").isNotNull()
             & F.try_parse_json(F.col("engagement_survey")).isNull(),
             "score_overflow": quality.any_of([F.coalesce(F.col(c), F.lit(0)) > 100 for c in SCORES])}
    _, rejected = quality.quarantine(staged_events(spark, sf_dir, filtered=True), rules)
    return rejected.select("employee_number", "department", "engagement_survey", "reject_reason")


# ------------------------------------------------ sources, sinks, streams ---

from stratum.sources import files  # noqa: E402
from stratum.streaming import ingest  # noqa: E402

FILE_PATTERN = "employee_data_part_*.parquet"


def _landing_frame(spark, sf_dir, odd_case: bool = True):
    """Raw rows as a source system delivers them: mixed-case column names, one
    column missing (hours_absent), one extra, and an upload group 1..5 (one per
    department)."""
    raw = fx.raw_from_events(spark, sf_dir)
    cols = [F.col(c).alias((c.upper() if i % 2 == 0 else c.title()) if odd_case else c)
            for i, c in enumerate(raw.columns) if c != "hours_absent"]
    return raw.select(*cols, F.lit("ignored").alias("EXTRA_COL"),
                      F.expr(fx.UPLOAD_GROUP).cast("int").alias("__slice"))


def _land(spark, sf_dir, landing, slices, prefix="employee_data_part", fmt="parquet", columns=None, one_file=False):
    """`columns` reorders or renames the delivered columns; `one_file` puts each slice into one file."""
    df = _landing_frame(spark, sf_dir).filter(F.col("__slice").isin(*slices))
    df = columns(df) if columns else df
    df = df.repartition("__slice") if one_file else df
    return files.land_files(spark, df, "__slice", landing, prefix, fmt=fmt,
                            options={"header": "true"} if fmt == "csv" else None)


def _raw_schema(spark, sf_dir):
    return fx.raw_from_events(spark, sf_dir).schema


_RAW_NO_HOURS = o.RAW_EVENTS.replace("value / 4 AS hours_absent", "CAST(NULL AS DOUBLE) AS hours_absent")


@register("load_parquet_by_name", _RAW_NO_HOURS)
def q_load_parquet_by_name(spark, sf_dir):
    landing = work_dir(spark, "landing")
    _land(spark, sf_dir, landing, [1, 2, 3, 4, 5])
    _land(spark, sf_dir, landing, [1], prefix="employee_archive")  # must not match the pattern
    return files.load_by_name(spark, landing, _raw_schema(spark, sf_dir), pattern=FILE_PATTERN)


@register("load_csv", _RAW_NO_HOURS)
def q_load_csv(spark, sf_dir):
    landing = work_dir(spark, "landing_csv")
    _land(spark, sf_dir, landing, [1, 2, 3, 4, 5], fmt="csv")
    return files.load_by_name(spark, landing, _raw_schema(spark, sf_dir), fmt="csv",
                              pattern="employee_data_part_*.csv")


@register("load_json", _RAW_NO_HOURS)
def q_load_json(spark, sf_dir):
    landing = work_dir(spark, "landing_json")
    _land(spark, sf_dir, landing, [1, 2, 3, 4, 5], fmt="json")
    return files.load_by_name(spark, landing, _raw_schema(spark, sf_dir), fmt="json",
                              pattern="employee_data_part_*.json")


def _swapped(df):
    """Another delivery of the same columns: last to first, in lower case, one more extra column."""
    return df.select(*[F.col(c).alias(c.lower()) for c in reversed(df.columns)], F.lit(0).alias("batch_no"))


@register("load_csv_headers", _RAW_NO_HOURS)
def q_load_csv_headers(spark, sf_dir):
    """Files of one load whose columns stand in different orders."""
    landing = work_dir(spark, "landing_csv")
    _land(spark, sf_dir, landing, [1, 2, 3], fmt="csv")
    _land(spark, sf_dir, landing, [4, 5], fmt="csv", columns=_swapped)
    return files.load_by_name(spark, landing, _raw_schema(spark, sf_dir), fmt="csv", pattern="employee_data_part_*.csv")


def _ingest_two(spark, sf_dir, fmt):
    root, landing, schema = work_dir(spark, "pipe"), work_dir(spark, "landing"), _raw_schema(spark, sf_dir)
    for run_id, slices, columns in ((fx.PREVIOUS_RUN_ID, [1, 2, 3], None), (fx.RUN_ID, [4, 5], _swapped)):
        _land(spark, sf_dir, landing, slices, fmt=fmt, columns=columns)
        ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/_ckpt", schema, run_id=run_id, fmt=fmt,
                                pattern=f"employee_data_part_*.{fmt}")
    return ingest.read_raw(spark, f"{root}/raw", schema).drop(ingest.FILE_COL)


_INGESTED = f"SELECT *, CASE WHEN {fx.UPLOAD_GROUP} <= 3 THEN '{fx.PREVIOUS_RUN_ID}' ELSE '{fx.RUN_ID}' END AS _run_id FROM ({_RAW_NO_HOURS}) r"


@register("ingest_csv_by_name", _INGESTED)
def q_ingest_csv_by_name(spark, sf_dir):
    return _ingest_two(spark, sf_dir, "csv")


@register("ingest_json_by_name", _INGESTED)
def q_ingest_json_by_name(spark, sf_dir):
    return _ingest_two(spark, sf_dir, "json")


@register("ingest_new_files", f"SELECT * FROM ({_RAW_NO_HOURS}) r WHERE {fx.UPLOAD_GROUP} IN (4, 5)")
def q_ingest_new_files(spark, sf_dir):
    """Two pipe refreshes: the second loads only the two files landed in between."""
    root, landing = work_dir(spark, "pipe"), work_dir(spark, "landing")
    schema = _raw_schema(spark, sf_dir)
    args = dict(schema=schema, pattern=FILE_PATTERN)
    _land(spark, sf_dir, landing, [1, 2, 3])
    ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/_ckpt", run_id=fx.PREVIOUS_RUN_ID, **args)
    _land(spark, sf_dir, landing, [4, 5])
    second = ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/_ckpt", run_id=fx.RUN_ID, **args)
    return second.drop(ingest.FILE_COL, ingest.RUN_COL)


@register("load_history", f"""SELECT '{staging.RAW_TABLE}' AS table_name,
  'employee_data_part_' || lpad(CAST({fx.UPLOAD_GROUP} AS VARCHAR), 2, '0') || '_0.parquet' AS file_name, count(*) AS row_count, 'LOADED' AS status,
  CASE WHEN {fx.UPLOAD_GROUP} <= 3 THEN TIMESTAMP '2024-01-30 23:55:00' ELSE {o.TS_AS_OF} END AS last_load_time
FROM ({o.RAW_EVENTS}) r GROUP BY ALL""")
def q_load_history(spark, sf_dir):
    """Per-file load log of two refreshes, read back for the last 10 minutes."""
    return ingest.recent_loads(_load_two_refreshes(spark, sf_dir), fx.AS_OF, minutes=10)


def _load_two_refreshes(spark, sf_dir):
    root, landing = work_dir(spark, "pipe"), work_dir(spark, "landing")
    schema = _raw_schema(spark, sf_dir)
    hist = f"{root}/_load_history"
    for run_id, as_of, slices in ((fx.PREVIOUS_RUN_ID, "2024-01-30 23:55:00", [1, 2, 3]),
                                  (fx.RUN_ID, fx.AS_OF, [4, 5])):
        _land(spark, sf_dir, landing, slices, one_file=True)
        rows = ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/_ckpt", schema,
                                       run_id=run_id, pattern=FILE_PATTERN)
        tables.append_rows(ingest.load_history(rows, table_name=staging.RAW_TABLE, as_of=as_of), hist)
    return tables.read_table(spark, hist)


@register("load_history_by_slice", f"""SELECT '{staging.RAW_TABLE}' AS table_name,
  lpad(CAST({fx.UPLOAD_GROUP} AS VARCHAR), 2, '0') AS file_group,
  CASE WHEN {fx.UPLOAD_GROUP} <= 3 THEN TIMESTAMP '2024-01-30 23:55:00' ELSE {o.TS_AS_OF} END AS last_load_time,
  count(*) AS row_count
FROM ({o.RAW_EVENTS}) r GROUP BY ALL""")
def q_load_history_by_slice(spark, sf_dir):
    """Rows loaded per landed file group in the last 10 minutes (the per-file history
    rolled up to the name prefix each upload used)."""
    recent = ingest.recent_loads(_load_two_refreshes(spark, sf_dir), fx.AS_OF, minutes=10)
    group = F.regexp_extract(F.col("file_name"), r"employee_data_part_(\d+)_", 1)
    return (recent.groupBy("table_name", group.alias("file_group"), "last_load_time")
            .agg(F.sum("row_count").alias("row_count")))


def _pipeline_runs(spark, sf_dir):
    root, landing = work_dir(spark, "elt"), work_dir(spark, "landing")
    p = ingest.IncrementalPipeline(spark, root, landing, _raw_schema(spark, sf_dir), pattern=FILE_PATTERN)
    _land(spark, sf_dir, landing, [1, 2, 3])
    p.run(fx.PREVIOUS_RUN_ID, fx.PREVIOUS_AS_OF)
    _land(spark, sf_dir, landing, [4, 5])
    p.run(fx.RUN_ID, fx.AS_OF)
    p.run("run-0002", "2024-01-31 00:05:00")  # nothing new: the gate keeps version 2
    return p


_STREAM_STAGED_ALL = o.staged(_RAW_NO_HOURS, source_object=staging.RAW_STREAM)


@register("incremental_run", o.survey_mart(_STREAM_STAGED_ALL))
def q_incremental_run(spark, sf_dir):
    return _pipeline_runs(spark, sf_dir).mart("survey_results")


_CONSUMED = " UNION ALL ".join(f"""SELECT *, '{name}' AS consumer, {version} AS _v FROM ({_RAW_NO_HOURS}) r"""
                               for name, version in (("each_run", f"CASE WHEN {fx.UPLOAD_GROUP} <= 3 THEN 1 ELSE 2 END"), ("late", "1")))


@register("feed_consumers", _CONSUMED)
def q_feed_consumers(spark, sf_dir):
    """One consumer takes each run as it comes, another both at once: each has every row, once."""
    from stratum.streaming.consumers import Consumer, write_version
    root, landing, schema = work_dir(spark, "consumers"), work_dir(spark, "landing"), _raw_schema(spark, sf_dir)
    each, late = (Consumer(spark, root, name, f"{root}/raw", schema) for name in ("each_run", "late"))
    take = lambda c, name: c.consume(lambda rows, v: write_version(rows, f"{root}/{name}/rows", v))
    for run_id, slices in ((fx.PREVIOUS_RUN_ID, [1, 2, 3]), (fx.RUN_ID, [4, 5])):
        _land(spark, sf_dir, landing, slices)
        ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/_ckpt", schema, run_id=run_id, pattern=FILE_PATTERN)
        take(each, "each_run")
    take(late, "late")
    take(each, "each_run")  # nothing left
    read = lambda name: spark.read.parquet(f"{root}/{name}/rows").withColumn("consumer", F.lit(name)).withColumn("_v", F.col("_v").cast("int"))
    return read("each_run").unionByName(read("late"))


def _change_runs(spark, sf_dir):
    """Two runs over change files: all rows as they stood as inserts, then what changed since."""
    from stratum.streaming.change_runs import ChangePipeline
    root, landing = work_dir(spark, "elt_changes"), work_dir(spark, "landing_changes")
    before = tables.spread_few_splits(fx.events_before(spark, sf_dir)).selectExpr(*fx.RAW_FROM_EVENTS)
    after = tables.spread_few_splits(fx.events_after(spark, sf_dir)).selectExpr(*fx.RAW_FROM_EVENTS)
    group = F.expr(fx.UPLOAD_GROUP).cast("int").alias("__slice")
    p = ChangePipeline(spark, root, landing, before.schema, pattern=FILE_PATTERN, n_buckets=32)
    first = changes.appended_rows(before).select("*", F.lit(1).cast("bigint").alias("_seq"), group)
    files.land_files(spark, first, "__slice", landing, "employee_data_part_a")
    p.run(fx.PREVIOUS_RUN_ID, fx.PREVIOUS_AS_OF)
    feed = changes.snapshot_diff(before, after, "employee_number").select("*", F.lit(2).cast("bigint").alias("_seq"), group)
    files.land_files(spark, feed, "__slice", landing, "employee_data_part_b")
    p.run(fx.RUN_ID, fx.AS_OF)
    return p


_BEFORE_EVENTS_RAW = fx.sql_select(
    fx.RAW_FROM_EVENTS, f"({fx.sql_select(fx.EVENT_COLUMNS, 'events', fx.EVENTS_BEFORE_FILTER)}) b")
_RAW_NAMES = [e.rsplit(" AS ", 1)[1] for e in fx.RAW_FROM_EVENTS]
_SAME = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in _RAW_NAMES)


@register("incremental_changes", f"""WITH b AS ({_BEFORE_EVENTS_RAW}), a AS ({_AFTER_EVENTS_RAW}),
r AS (SELECT a.*, b.employee_number IS NOT NULL AND {_SAME} AS kept FROM a LEFT JOIN b ON a.employee_number = b.employee_number)
SELECT * EXCLUDE (kept), {o.score_columns()}, CASE WHEN kept THEN {o.TS_PREVIOUS} ELSE {o.TS_AS_OF} END AS staged_at,
  '{staging.RAW_STREAM}' AS source_object, CASE WHEN kept THEN '{fx.PREVIOUS_RUN_ID}' ELSE '{fx.RUN_ID}' END AS etl_run_id FROM r""")
def q_incremental_changes(spark, sf_dir):
    return _change_runs(spark, sf_dir).staged()


@register("incremental_changes_mart", o.survey_mart(o.staged(_AFTER_EVENTS_RAW)))
def q_incremental_changes_mart(spark, sf_dir):
    return _change_runs(spark, sf_dir).mart("survey_results")


@register("dt_stage", o.staged(_RAW_NO_HOURS, run_id=None, process_type="dt_refresh"))
def q_dt_stage(spark, sf_dir):
    root, landing = work_dir(spark, "dt"), work_dir(spark, "landing")
    schema = _raw_schema(spark, sf_dir)
    _land(spark, sf_dir, landing, [1, 2, 3])
    ingest.staged_stream(spark, landing, schema, f"{root}/stg", f"{root}/_ckpt", pattern=FILE_PATTERN, as_of=fx.AS_OF)
    _land(spark, sf_dir, landing, [4, 5])
    return ingest.staged_stream(spark, landing, schema, f"{root}/stg", f"{root}/_ckpt",
                                pattern=FILE_PATTERN, as_of=fx.AS_OF)


# ------------------------------------------------------------ table writes ---

@register("replace_table", o.demographics_mart(o.staged(o.RAW_ORDERS)))
def q_replace_table(spark, sf_dir):
    path = work_dir(spark, "demographics")
    tables.replace_table(marts.demographics(staged_orders(spark, sf_dir), as_of=fx.PREVIOUS_AS_OF,
                                            run_id=fx.PREVIOUS_RUN_ID), path)
    return tables.replace_table(marts.demographics(staged_orders(spark, sf_dir), as_of=fx.AS_OF,
                                                   run_id=fx.RUN_ID), path)


@register("survey_via_temp", o.survey_mart(o.staged(o.RAW_EVENTS)))
def q_survey_via_temp(spark, sf_dir):
    """CREATE TEMP TABLE AS, then CREATE OR REPLACE TABLE AS SELECT * FROM it: the step is stored, and read again."""
    tmp = tables.materialize(marts.survey_results(staged_events(spark, sf_dir), as_of=fx.AS_OF, run_id=fx.RUN_ID), work_dir(spark, "survey_temp"))
    return tables.replace_table(tmp, work_dir(spark, "survey_results"))


@register("survey_via_view", o.survey_mart(o.staged(o.RAW_EVENTS)))
def q_survey_via_view(spark, sf_dir):
    marts.survey_results(staged_events(spark, sf_dir), as_of=fx.AS_OF, run_id=fx.RUN_ID) \
        .createOrReplaceTempView("v_survey_results_by_department")
    return spark.table("v_survey_results_by_department")


_ADDED = [(name, "bigint", None) for name in staging.SURVEY_FIELDS] + [
    ("staged_at", "timestamp_ntz", None), ("source_object", "string", staging.RAW_TABLE),
    ("etl_run_id", "string", None)]


@register("evolve_schema", f"""SELECT r.*, {', '.join(f'CAST(NULL AS BIGINT) AS {n}' for n in staging.SURVEY_FIELDS)},
  CAST(NULL AS TIMESTAMP) AS staged_at, '{staging.RAW_TABLE}' AS source_object, CAST(NULL AS VARCHAR) AS etl_run_id
FROM ({o.RAW_EVENTS}) r""")
def q_evolve_schema(spark, sf_dir):
    return staging.evolve_schema(fx.raw_from_events(spark, sf_dir), _ADDED)


@register("append_select", o.staged(o.RAW_EVENTS))
def q_append_select(spark, sf_dir):
    """CREATE TABLE LIKE + ADD COLUMNs, then INSERT INTO (cols) SELECT leaving
    source_object to its default."""
    path = work_dir(spark, "employee_data_stg")
    raw = fx.raw_from_events(spark, sf_dir)
    target = staging.empty_like(raw, _ADDED)
    tables.replace_table(target, path)
    listed = staging.stage_rows(raw, as_of=fx.AS_OF, run_id=fx.RUN_ID).drop("source_object")
    tables.append_rows(staging.conform(listed, target.schema, {"source_object": staging.RAW_TABLE}), path)
    return tables.read_table(spark, path)


@register("flatten_json", f"""SELECT e.employee_number, j.key AS key, json_extract_string(j.value, '$') AS value
FROM ({o.RAW_EVENTS}) e, json_each(e.engagement_survey) j
WHERE json_valid(e.engagement_survey)""")
def q_flatten_json(spark, sf_dir):
    from stratum.functions.json_fields import flatten_object
    return flatten_object(fx.raw_from_events(spark, sf_dir), "engagement_survey", keep=["employee_number"])


# A JSON array per event: numbers, text, null and a nested object; every 11th is an object instead.
_ARRAY_TEXT = ("CASE WHEN event_id % 11 = 0 THEN '{\"a\": 1}' ELSE concat('[', cast(user_id AS string), ',\"', event_type, "
               "'\",null,{\"u\":', cast(user_id AS string), '}]') END AS items")


@register("flatten_array", f"""SELECT event_id, CAST(j.key AS INTEGER) AS pos, json_extract_string(j.value, '$') AS value
FROM (SELECT event_id, {_ARRAY_TEXT} FROM events) e, json_each(e.items) j
WHERE json_type(e.items) = 'ARRAY'""")
def q_flatten_array(spark, sf_dir):
    from stratum.functions.json_fields import flatten_array
    return flatten_array(fx.table(spark, sf_dir, "events").selectExpr("event_id", _ARRAY_TEXT), "items", keep=["event_id"])


# Nested JSON per event, to four levels; every 11th single-quoted, every 13th with text after the value.
_NESTED_TEXT = ("CASE WHEN event_id % 11 = 0 THEN '{''a'': 1}' WHEN event_id % 13 = 0 THEN '{\"a\": 1} x' ELSE "
                "concat('{\"user\": {\"id\": ', cast(user_id AS string), ', \"tags\": [\"', event_type, '\", null, {\"n\": [', "
                "cast(event_id % 7 AS string), ', true]}]}, \"none\": {}, \"list\": [[1, 2], []]}') END AS nested")


@register("flatten_deep", f"""SELECT event_id, j.fullkey AS path, CASE WHEN j.key SIMILAR TO '[0-9]+' THEN CAST(j.key AS INTEGER) END AS pos,
  CASE WHEN NOT j.key SIMILAR TO '[0-9]+' THEN j.key END AS key, json_extract_string(j.value, '$') AS value,
  j.type IN ('OBJECT', 'ARRAY') AS is_nested
FROM (SELECT event_id, {_NESTED_TEXT} FROM events) e, json_tree(e.nested) j WHERE json_valid(e.nested) AND j.key IS NOT NULL""")
def q_flatten_deep(spark, sf_dir):
    from stratum.functions.variants import flatten_deep
    return flatten_deep(fx.table(spark, sf_dir, "events").selectExpr("event_id", _NESTED_TEXT), "nested", keep=["event_id"])


# The survey and the run log as VARIANT tables: parsed once at the load, read by path.

def _stored_variants(df, json_col, name):
    from stratum.functions.variants import with_variant
    return tables.materialize(with_variant(df, json_col, f"{json_col}_v"), work_dir(df.sparkSession, name))


@register("variant_stage", f"SELECT * EXCLUDE (engagement_survey) FROM ({o.staged(o.RAW_EVENTS)}) s")
def q_variant_stage(spark, sf_dir):
    from stratum.functions.variants import with_variant_numbers
    raw = _stored_variants(fx.raw_from_events(spark, sf_dir), "engagement_survey", "raw_variant")
    staged = with_variant_numbers(raw, "engagement_survey_v", staging.SURVEY_FIELDS).drop("engagement_survey_v")
    return staged.withColumns(staging.lineage_stamps(fx.AS_OF, staging.RAW_TABLE, fx.RUN_ID))


def _variant_log(spark, sf_dir):
    log = pipeline_events(spark, sf_dir)
    return _stored_variants(_stored_variants(log, "value", "log_variant"), "scope", "log_variant")


@register("variant_event_extract", ORACLES["event_extract"])
def q_variant_event_extract(spark, sf_dir):
    return observe.event_extract(observe.variant_log(_variant_log(spark, sf_dir)), parsed=True)


@register("variant_refresh_summary", ORACLES["refresh_summary"])
def q_variant_refresh_summary(spark, sf_dir):
    history = _stored_variants(logs.dt_refresh_history(spark, sf_dir), "statistics", "history_variant")
    return observe.refresh_summary(history, fx.AS_OF, days=1, statistics="statistics_v")


# Scores of up to 38 digits (every 5th event 25, every 7th 32 and negative; every 11th has 40, which no NUMBER holds).
_WIDE_SCORE = ("CASE WHEN event_id % 5 = 0 THEN concat('9', lpad(cast(event_id AS string), 24, '7')) "
               "WHEN event_id % 7 = 0 THEN concat('-3', lpad(cast(event_id AS string), 31, '1')) "
               "WHEN event_id % 11 = 0 THEN lpad(cast(event_id AS string), 40, '1') ELSE cast(event_id % 6 AS string) END")
_WIDE_TEXT = (f"concat('{{\"satisfaction_score\": \"', {_WIDE_SCORE}, '\", \"teamwork_score\": \"', cast(user_id AS string), "
              "'00000000000000000000\"}') AS engagement_survey")
_WIDE_COLUMNS = ["event_id AS employee_number", "event_type AS department", _WIDE_TEXT]
_WIDE_FIELDS = {n: n for n in ("satisfaction_score", "teamwork_score")}
_WIDE_STAGED = f"""SELECT r.*, {', '.join(f"try_cast(json_extract_string(engagement_survey, '$.{n}') AS DECIMAL(38,0)) AS {n}" for n in _WIDE_FIELDS)}
FROM ({fx.sql_select(_WIDE_COLUMNS, 'events')}) r"""


def _wide_staged(spark, sf_dir, filtered=False):
    from stratum.functions.json_fields import WIDE
    raw = fx.table(spark, sf_dir, "events", spread=True).selectExpr(*_WIDE_COLUMNS)
    return with_json_number_fields(raw, "engagement_survey", _WIDE_FIELDS, filtered=filtered, number=WIDE)


@register("wide_stage", f"SELECT employee_number, CAST(satisfaction_score AS VARCHAR) AS satisfaction_score, CAST(teamwork_score AS VARCHAR) AS teamwork_score FROM ({_WIDE_STAGED}) s")
def q_wide_stage(spark, sf_dir):
    return _wide_staged(spark, sf_dir).select("employee_number", *[F.col(n).cast("string").alias(n) for n in _WIDE_FIELDS])


@register("wide_totals", f"""SELECT department, count(*) AS num_responses,
  {', '.join(f"CAST(CAST(sum({n}) AS DECIMAL(38,0)) AS VARCHAR) AS total_{n}" for n in _WIDE_FIELDS)} FROM ({_WIDE_STAGED}) s GROUP BY department""")
def q_wide_totals(spark, sf_dir):
    from stratum.functions.scalars import sum_wide
    return _wide_staged(spark, sf_dir).groupBy("department").agg(
        F.count(F.lit(1)).alias("num_responses"), *[sum_wide(F.col(n)).cast("string").alias(f"total_{n}") for n in _WIDE_FIELDS])


@register("wide_range_check", o.issue_row(f"SELECT * FROM ({_WIDE_STAGED}) s WHERE coalesce(satisfaction_score, 0) NOT BETWEEN 1 AND 5",
                                          check_name="invalid_survey_range", layer="silver", table_name=staging.STAGED_TABLE,
                                          sample=KEY_SAMPLE, array_key="bad_rows"))
def q_wide_range_check(spark, sf_dir):
    return quality.range_check(_wide_staged(spark, sf_dir, True), ["satisfaction_score"], sample=KEY_SAMPLE, check_name="invalid_survey_range",
                               layer="silver", table_name=staging.STAGED_TABLE, as_of=fx.AS_OF)


@register("wide_quarantine", f"""SELECT employee_number, CAST(satisfaction_score AS VARCHAR) AS satisfaction_score, 'score_overflow' AS reject_reason
FROM ({_WIDE_STAGED}) s WHERE satisfaction_score > 100""")
def q_wide_quarantine(spark, sf_dir):
    _, rejected = quality.quarantine(_wide_staged(spark, sf_dir, True), {"score_overflow": F.coalesce(F.col("satisfaction_score"), F.lit(0)) > 100})
    return rejected.select("employee_number", F.col("satisfaction_score").cast("string").alias("satisfaction_score"), "reject_reason")
