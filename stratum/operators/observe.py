"""Run logs and run/refresh history: building log rows, and reading them back.

Everything is a filter, a bounded top-k, or a grouped aggregate with a fixed
number of outputs per group -- no per-group collection of rows -- so a run
or table holding a third of all log rows costs one partial row per task.
JSON payloads are parsed once per row (`from_json` into a struct of string
fields) and typed afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.json_fields import parsed_object, try_to_number
from stratum.functions.scalars import avg_exact, json_object, seconds_between, ts_literal

# The payload keys of a pipeline log record, in writing order.
LOG_KEYS = ["component", "run_id", "pipeline", "stage", "status", "source", "target",
            "duration_seconds", "result", "error_code", "error_message", "procedure"]
# Fields the structured log reader extracts (two of them no writer emits).
READ_KEYS = ["run_id", "pipeline", "stage", "event", "status", "task_name", "duration_seconds",
             "source", "target", "error_message"]
COMPONENT = "ELT_Pipeline"
# The texts a mart build and the build summary report.
STEP_OK = ("SUCCESS: Built ", " with ", " rows in ", " seconds")
STEP_ERROR = ("ERROR: Failed to build ", " - ")
ERROR_PREFIX = "ERROR:%"
SUMMARY_TITLE = "=== GOLD LAYER BUILD SUMMARY ==="
SUMMARY_TIME = ("Total execution time: ", " seconds")
SUMMARY_ERRORS = "Errors encountered: "


def event_rows(runs: DataFrame, *, include_spans: bool = False) -> DataFrame:
    """Step runs -> structured log rows with JSON object payloads.

    `runs` has run_id, pipeline, stage, procedure, source, target, started_at,
    ended_at, status ('SUCCESS' | 'FAILED'), result, error_code, error_message.
    Each run yields a STARTED row at `started_at` and a SUCCESS/FAILED row at
    `ended_at` (plus a SPAN row when tracing is on). Payload keys whose value
    is NULL are left out, as object construction does.
    """
    failed = F.col("status") == "FAILED"
    common = [("component", F.lit(COMPONENT)), ("run_id", F.col("run_id")),
              ("pipeline", F.col("pipeline")), ("stage", F.col("stage"))]
    none = F.lit(None)
    started = json_object([*common, ("status", F.lit("STARTED")), ("source", F.col("source")),
                           ("target", F.col("target")), ("duration_seconds", none.cast("bigint")),
                           ("result", none.cast("string")), ("error_code", none.cast("bigint")),
                           ("error_message", none.cast("string")), ("procedure", F.col("procedure"))])
    finished = json_object([*common, ("status", F.col("status")), ("source", none.cast("string")),
                            ("target", none.cast("string")),
                            ("duration_seconds", F.when(~failed, seconds_between(F.col("started_at"), F.col("ended_at")))),
                            ("result", F.when(~failed, F.col("result"))),
                            ("error_code", F.when(failed, F.col("error_code").cast("bigint"))),
                            ("error_message", F.when(failed, F.col("error_message"))),
                            ("procedure", F.col("procedure"))])
    scope = json_object([("name", F.col("procedure"))])
    rec = lambda ts, rtype, sev, value: F.struct(
        ts.alias("timestamp"), F.lit(rtype).alias("record_type"), sev.alias("severity"),
        scope.alias("scope"), value.alias("value"))
    records = [rec(F.col("started_at"), "LOG", F.lit("INFO"), started),
               rec(F.col("ended_at"), "LOG", F.when(failed, "ERROR").otherwise("INFO"), finished)]
    if include_spans:
        records.append(rec(F.col("started_at"), "SPAN", F.lit("INFO"), F.lit(None).cast("string")))
    return runs.select(F.explode(F.array(*records)).alias("r")).select("r.*")


def event_recent(events: DataFrame, k: int = 50, types: Sequence[str] = ("EVENT", "LOG", "INFO")) -> DataFrame:
    """WHERE RECORD_TYPE IN (...) ORDER BY TIMESTAMP DESC LIMIT k (total order by payload)."""
    return (events.filter(F.col("record_type").isin(*types))
            .orderBy(F.col("timestamp").desc(), F.col("value").asc_nulls_last(),
                     F.col("scope").asc_nulls_last(), F.col("severity").asc_nulls_last(),
                     F.col("record_type").asc_nulls_last())
            .limit(k))


def parse_log(events: DataFrame) -> DataFrame:
    """Typed fields out of the scope and payload JSON (parsed once each)."""
    p = parsed_object(F.col("value"), READ_KEYS)
    s = parsed_object(F.col("scope"), ["name"])
    # One parse per row: the generator keeps later filters (on pipeline,
    # status) from being pushed beneath it with the parse inlined.
    parsed = F.explode(F.array(F.struct(s.alias("s"), p.alias("p"))))
    rows = events.select("timestamp", "record_type", parsed.alias("__j"))
    return _log_fields(rows, lambda key: F.col("__j.p").getField(key), F.col("__j.s").getField("name"))


def variant_log(events: DataFrame, value: str = "value_v", scope: str = "scope_v") -> DataFrame:
    """The same fields of a log whose payload and scope are VARIANT columns: read by path, nothing is parsed."""
    from stratum.functions.variants import text_at
    return _log_fields(events, lambda key: text_at(F.col(value), f"$.{key}"), text_at(F.col(scope), "$.name"))


def _log_fields(rows: DataFrame, field, scope_name: Column) -> DataFrame:
    return rows.select(
        "timestamp", "record_type", scope_name.alias("scope_name"),
        *[field(key).alias(key) for key in ("run_id", "pipeline", "stage", "event", "status", "task_name")],
        try_to_number(field("duration_seconds")).alias("duration_seconds"),
        field("source").alias("source_object"), field("target").alias("target_object"), field("error_message").alias("error_message"))


def event_extract(events: DataFrame, pipeline: str = "streams_tasks_elt", k: int = 20, parsed: bool = False) -> DataFrame:
    """Structured view of one pipeline's LOG rows, newest k. `parsed`: `events` are fields already (`variant_log`)."""
    log = events.filter(F.col("record_type") == "LOG")
    log = log if parsed else parse_log(log)
    return (log.filter(F.col("pipeline") == pipeline).drop("record_type")
            .orderBy(F.col("timestamp").desc(), F.col("run_id").asc_nulls_last(),
                     F.col("status").asc_nulls_last(), F.col("stage").asc_nulls_last())
            .limit(k))


def event_summary(events: DataFrame, as_of, days: int = 7, pipeline: str = "streams_tasks_elt") -> DataFrame:
    """Executions and mean duration per (stage, status) over the last `days` days."""
    since = ts_literal(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    parsed = parse_log(events.filter((F.col("record_type") == "LOG") & (F.col("timestamp") >= since)))
    return (parsed.filter((F.col("pipeline") == pipeline) & F.col("status").isNotNull())
            .groupBy(F.col("stage").alias("pipeline_stage"), "status")
            .agg(F.count(F.lit(1)).alias("execution_count"),
                 avg_exact(F.col("duration_seconds")).alias("avg_duration_seconds"))
            .orderBy("pipeline_stage", "status"))


def run_history(history: DataFrame, as_of, *, hours: float = 2, limit: int = 50,
                where: Column | None = None, time_col: str = "scheduled_time",
                tie_break: Sequence[str] = ("name",)) -> DataFrame:
    """Task-run history from a range start with a result limit, then WHERE: the newest `limit` runs
    in range, then the caller's filter (the limit applies first, as there)."""
    since = ts_literal(as_of) - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    top = (history.filter(F.col(time_col) >= since)
           .orderBy(F.col(time_col).desc(), *[F.col(c).asc_nulls_last() for c in tie_break])
           .limit(limit))
    return top.filter(where) if where is not None else top


def refresh_history(history: DataFrame, as_of, *, days: int = 6, pattern: str = "DT_%") -> DataFrame:
    """Refreshes since `as_of - days` of tables matching `pattern`, newest first, then by name."""
    since = ts_literal(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return (history.filter(F.col("name").like(pattern) & (F.col("data_timestamp") >= since))
            .select("name", "data_timestamp", "state", "state_code", "state_message",
                    "refresh_action", "query_id", "statistics")
            .orderBy(F.col("data_timestamp").desc_nulls_last(), F.col("name").asc()))


def refresh_summary(history: DataFrame, as_of, *, days: int = 1, pattern: str = "DT_%", statistics: str = "statistics") -> DataFrame:
    """Per table: refreshes, successes, failures and rows inserted/deleted/copied. `statistics`: JSON text or VARIANT."""
    from stratum.functions.variants import text_at
    since = ts_literal(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    keys = ["numInsertedRows", "numDeletedRows", "numCopiedRows"]
    if dict(history.dtypes)[statistics] == "variant":
        st = F.struct(*[text_at(F.col(statistics), f"$.{k}").alias(k) for k in keys])
    else:
        st = parsed_object(F.col(statistics), keys)
    h = (history.filter(F.col("name").like(pattern) & (F.col("data_timestamp") >= since))
         .select("name", "state", st.alias("__st")))
    return h.groupBy("name").agg(
        F.count(F.lit(1)).alias("total_refreshes"),
        F.sum(F.when(F.col("state") == "SUCCEEDED", 1).otherwise(0)).cast("bigint").alias("successful_refreshes"),
        F.sum(F.when(F.col("state") == "FAILED", 1).otherwise(0)).cast("bigint").alias("failed_refreshes"),
        F.sum(try_to_number(F.col("__st.numInsertedRows"))).alias("total_rows_inserted"),
        F.sum(try_to_number(F.col("__st.numDeletedRows"))).alias("total_rows_deleted"),
        F.sum(try_to_number(F.col("__st.numCopiedRows"))).alias("total_rows_copied"),
    ).orderBy("name")


def table_listing(history: DataFrame, *, pattern: str = "DT_%", target_lag_sec: int = 300) -> DataFrame:
    """Refreshed tables whose name matches a LIKE pattern ('_' is a wildcard)."""
    return (history.filter(F.col("name").like(pattern))
            .groupBy("name", "schema_name")
            .agg(F.count(F.lit(1)).alias("refresh_count"))
            .withColumn("target_lag_sec", F.lit(target_lag_sec).cast("bigint"))
            .orderBy("schema_name", "name"))


def step_messages(steps: DataFrame) -> DataFrame:
    """Per build step: the status text the build procedure returns."""
    secs = seconds_between(F.col("started_at"), F.col("ended_at"))
    text = (F.when(F.col("error_message").isNotNull(),
                   F.concat(F.lit(STEP_ERROR[0]), F.col("table_name"), F.lit(STEP_ERROR[1]), F.col("error_message")))
            .otherwise(F.concat(F.lit(STEP_OK[0]), F.col("table_name"), F.lit(STEP_OK[1]),
                                F.col("row_count").cast("string"), F.lit(STEP_OK[2]), secs.cast("string"),
                                F.lit(STEP_OK[3]))))
    return steps.withColumn("result", text)


def run_summary(steps: DataFrame, labels: Sequence[tuple[str, str]], title: str = SUMMARY_TITLE) -> DataFrame:
    """One row per run: elapsed seconds, failed-step count and the summary text.

    `labels` is [(step value, heading)] in print order; each heading's text is
    picked by a conditional aggregate, so memory per run stays fixed however
    many rows a run has.
    """
    msgs = step_messages(steps)
    is_error = F.col("result").like(ERROR_PREFIX)
    per_step = [F.max(F.when(F.col("step") == step, F.col("result"))).alias(f"__t{i}")
                for i, (step, _) in enumerate(labels)]
    agg = msgs.groupBy("run_id").agg(
        F.min("started_at").alias("run_started_at"),
        F.max("ended_at").alias("__end"),
        F.sum(F.when(is_error, 1).otherwise(0)).cast("bigint").alias("error_count"),
        *per_step)
    total = seconds_between(F.col("run_started_at"), F.col("__end"))
    parts = [F.lit(title + "\n"), F.lit(SUMMARY_TIME[0]), total.cast("string"), F.lit(SUMMARY_TIME[1] + "\n"),
             F.lit(SUMMARY_ERRORS), F.col("error_count").cast("string"), F.lit("\n\n")]
    for i, (_, heading) in enumerate(labels):
        parts += [F.lit(("\n" if i else "") + heading + ": "), F.coalesce(F.col(f"__t{i}"), F.lit(""))]
    return agg.select(
        "run_id", "run_started_at", total.alias("total_seconds"), "error_count",
        F.when(F.col("error_count") > 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.concat(*parts).alias("summary"))
