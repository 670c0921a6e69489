"""Run logs and histories derived from `events` (one step run per event row).

The reference reads vendor-kept history relations; here they are tables
built from every events row, so their size follows the data. Expressions
are shared by Spark and the DuckDB oracle except timestamp arithmetic,
which `plus_seconds` spells per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.plans.fixtures import sql_select, table


def plus_seconds(ts: str, n: str, dialect: str) -> str:
    return f"timestampadd(SECOND, {n}, {ts})" if dialect == "spark" else f"({ts} + to_seconds({n}))"


def runs_exprs(d: str) -> list[str]:
    even = "event_id % 2 = 0"
    return [
        "concat('run-', cast(event_id AS string)) AS run_id",
        "CASE WHEN event_type = 'error' THEN 'refreshed_tables_elt' ELSE 'streams_tasks_elt' END AS pipeline",
        f"CASE WHEN {even} THEN 'silver_load' ELSE 'gold_materialize' END AS stage",
        f"CASE WHEN {even} THEN 'silver.load_employee_staging' ELSE 'gold.materialize_core_models' END AS procedure",
        f"CASE WHEN {even} THEN 'bronze.employee_data_parquet' ELSE 'silver.employee_data_stg' END AS source",
        f"CASE WHEN {even} THEN 'silver.employee_data_stg' "
        "ELSE 'gold.employee_demographics_by_department,gold.survey_results_by_department' END AS target",
        "ts AS started_at",
        f"{plus_seconds('ts', 'cast(floor(value) AS bigint)', d)} AS ended_at",
        "CASE WHEN user_id % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "CASE WHEN user_id % 5 = 0 THEN NULL ELSE concat('Loaded ', cast(user_id * 10 AS string), ' rows') END AS result",
        "CASE WHEN user_id % 5 = 0 THEN 100000 + user_id END AS error_code",
        "CASE WHEN user_id % 5 = 0 THEN concat('Simulated failure ', cast(user_id AS string)) END AS error_message",
    ]


def task_history_exprs(d: str) -> list[str]:
    return [
        "CASE WHEN event_type = 'view' THEN 'T_ADHOC_EXPORT' WHEN event_id % 2 = 0 "
        "THEN 'T_SILVER_FROM_BRONZE_STREAM' ELSE 'T_GOLD_REFRESH_AFTER_SILVER' END AS name",
        "CASE WHEN user_id % 10 = 0 THEN 'SANDBOX_DB' ELSE 'ELT_DB' END AS database_name",
        "CASE WHEN user_id % 10 = 1 THEN 'OPS' ELSE 'TASKS' END AS schema_name",
        "ts AS scheduled_time",
        f"CASE WHEN user_id % 4 = 1 THEN NULL ELSE {plus_seconds('ts', 'cast(floor(value) AS bigint)', d)} END AS completed_time",
        "CASE user_id % 4 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'SKIPPED' ELSE 'SUCCEEDED' END AS state",
        "CASE WHEN user_id % 4 > 1 THEN concat('Processed ', cast(user_id AS string), ' rows') END AS return_value",
        "CASE WHEN user_id % 4 = 0 THEN cast(100000 + user_id AS string) END AS error_code",
        "CASE WHEN user_id % 4 = 0 THEN concat('Simulated failure ', cast(user_id AS string)) END AS error_message",
    ]


def refresh_history_exprs(d: str) -> list[str]:
    failed = "user_id % 6 = 0"
    return [
        "CASE WHEN event_id % 17 = 0 THEN concat('DTX', upper(event_type)) "
        "WHEN event_id % 19 = 0 THEN concat('XDT_', upper(event_type)) "
        "ELSE concat('DT_', upper(event_type)) END AS name",
        "CASE WHEN event_type IN ('view', 'click') THEN 'SILVER' ELSE 'GOLD' END AS schema_name",
        "ts AS data_timestamp",
        f"{plus_seconds('ts', 'cast(floor(value) AS bigint) * 20', d)} AS refresh_end_time",
        f"CASE WHEN {failed} THEN 'FAILED' ELSE 'SUCCEEDED' END AS state",
        f"CASE WHEN {failed} THEN concat('ERR', cast(user_id % 100 AS string)) ELSE 'SUCCESS' END AS state_code",
        f"CASE WHEN {failed} THEN 'Simulated refresh failure' END AS state_message",
        "CASE user_id % 3 WHEN 0 THEN 'INCREMENTAL' WHEN 1 THEN 'FULL' ELSE 'NO_DATA' END AS refresh_action",
        "concat('q-', cast(event_id AS string)) AS query_id",
        f"CASE WHEN {failed} THEN NULL ELSE concat('{{\"numInsertedRows\": ', cast(user_id % 50 AS string), "
        "', \"numDeletedRows\": ', cast(event_id % 7 AS string), ', \"numCopiedRows\": ', "
        "cast(cast(floor(value) AS bigint) AS string), '}') END AS statistics",
    ]


# Two build steps per run of the mart builder.
def step_exprs(d: str, step: int) -> list[str]:
    run = ["concat('run-', cast(event_id AS string)) AS run_id"]
    if step == 1:
        end = plus_seconds("ts", "cast(floor(value) AS bigint) % 10", d)
        return run + [
            "'DEMOGRAPHICS TABLE' AS step", "'employee_demographics_by_department' AS table_name",
            "ts AS started_at", f"{end} AS ended_at", "user_id % 6 AS row_count",
            "CASE WHEN event_id % 23 = 0 THEN 'Object does not exist' END AS error_message"]
    start = plus_seconds("ts", "cast(floor(value) AS bigint) % 10", d)
    end = plus_seconds(start, "user_id % 5", d)
    return run + [
        "'SURVEY TABLE' AS step", "'survey_results_by_department' AS table_name",
        f"{start} AS started_at", f"{end} AS ended_at", "5 AS row_count",
        "CASE WHEN event_id % 29 = 0 THEN 'Division by zero' END AS error_message"]


STEP_LABELS = [("DEMOGRAPHICS TABLE", "DEMOGRAPHICS TABLE"), ("SURVEY TABLE", "SURVEY TABLE")]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", spread=True)


def runs(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(*runs_exprs("spark"))


def task_history(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(*task_history_exprs("spark"))


def dt_refresh_history(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(*refresh_history_exprs("spark"))


def build_steps(spark, sf_dir) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.selectExpr(*step_exprs("spark", 1)).unionByName(ev.selectExpr(*step_exprs("spark", 2)))


RUNS_SQL = sql_select(runs_exprs("duck"), "events")
TASK_HISTORY_SQL = sql_select(task_history_exprs("duck"), "events")
REFRESH_HISTORY_SQL = sql_select(refresh_history_exprs("duck"), "events")
STEPS_SQL = sql_select(step_exprs("duck", 1), "events") + "\nUNION ALL\n" + sql_select(step_exprs("duck", 2), "events")
