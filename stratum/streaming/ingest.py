"""Incremental file ingest and the gated incremental run, on Structured Streaming.

`ingest_new_files` is the load pipe: a file stream over the landing folder,
run with `Trigger.AvailableNow`, loads each file exactly once -- the
checkpoint remembers which files were taken, so a second run reads only
files that arrived since (and a fresh checkpoint loads everything again, as
re-creating the pipe does). Rows land in the raw table partitioned by the
run that loaded them, so "this run's rows" is a partition-pruned read.

No `foreachBatch` (it needs a Python callback server); the stream writes a
Parquet sink and the merge runs afterwards as an ordinary batch job keyed by
run id. A run that dies after the stream committed is finished by the next
run: it picks up every raw partition whose run id is not yet merged.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.scalars import ts_literal
from stratum.operators import changes, marts, merge, observe, refresh, staging
from stratum.sources import files, tables

RUN_COL = "_run_id"
FILE_COL = "_source_file"


def _raw_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(FILE_COL, T.StringType()),
                         T.StructField(RUN_COL, T.StringType())])


def file_stream(spark: SparkSession, landing: str, schema: T.StructType, *, pattern: str | None = None,
                fmt: str = "parquet", max_files_per_trigger: int | None = None,
                archive_dir: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Streaming read of new files, columns matched to `schema` by name (ignoring case), then the
    file-metadata fields `keep`. Parquet and JSON lines; CSV files each have a header of their own and
    are loaded by `ingest_new_files`.

    `max_files_per_trigger` bounds each micro-batch (an AvailableNow run then
    processes a large backlog as several batches instead of one huge one);
    `archive_dir` moves each processed file there once its batch commits, so
    listing the landing folder stays cheap as files accumulate.
    """
    if fmt not in ("parquet", "json"):
        raise ValueError(f"no stream by name over {fmt} files")
    reader = spark.readStream.format("text") if fmt == "json" else spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if fmt == "json":
        return files.json_by_name(reader.load(landing), schema, keep)
    return reader.load(landing).select(*schema.names, *[F.col(f"_metadata.{k}") for k in keep])


def run_available_now(df: DataFrame, sink: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Process everything available now into a Parquet sink, then stop."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(sink).awaitTermination()


def ingest_new_files(spark: SparkSession, landing: str, raw_table: str, checkpoint: str,
                     schema: T.StructType, *, run_id: str, pattern: str | None = None,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None,
                     archive_dir: str | None = None) -> DataFrame:
    """Load files not loaded before into `raw_table`; return this run's rows.

    A new checkpoint (re-creating the load) needs a new `raw_table` folder:
    the sink's own log would otherwise skip the batch ids it already holds
    and drop the reloaded rows, so that combination is refused.
    """
    if not _exists(spark, checkpoint) and _exists(spark, f"{raw_table.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{raw_table} already has a stream log; load into a new folder with a new checkpoint")
    if fmt == "csv":
        if archive_dir:
            raise ValueError("CSV files are read after the stream has named them: they can't be moved by it")
        _ingest_csv(spark, landing, raw_table, checkpoint, schema, run_id, pattern, max_files_per_trigger)
    else:
        stream = (file_stream(spark, landing, schema, pattern=pattern, fmt=fmt, max_files_per_trigger=max_files_per_trigger,
                              archive_dir=archive_dir, keep=["file_name"])
                  .withColumnRenamed("file_name", FILE_COL).withColumn(RUN_COL, F.lit(run_id)))
        run_available_now(stream, raw_table, checkpoint, [RUN_COL])
    return read_raw(spark, raw_table, schema).filter(F.col(RUN_COL) == run_id)


def _ingest_csv(spark: SparkSession, landing: str, raw_table: str, checkpoint: str, schema: T.StructType, run_id: str,
                pattern: str | None, max_files_per_trigger: int | None) -> None:
    """CSV files load by name once each: a stream over the landing folder notes the paths of new files per run (their
    contents aren't read), then each run's files are loaded under their own headers into the run's partition.

    The partition is replaced as a whole, so a load that died after its files were noted is done again by the
    next call (any noted run without a partition is loaded).
    """
    noted = f"{checkpoint.rstrip('/')}_files"
    reader = spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    run_available_now(reader.load(landing).select("path", F.lit(run_id).alias(RUN_COL)), noted, checkpoint, [RUN_COL])
    paths: dict[str, list[str]] = {}
    for r in spark.read.schema(f"path STRING, {RUN_COL} STRING").parquet(noted).collect():  # file names, as a listing has them
        paths.setdefault(r[RUN_COL], []).append(r["path"])
    for run, own in paths.items():
        if _exists(spark, f"{raw_table.rstrip('/')}/{RUN_COL}={run}"):
            continue
        rows = files.load_by_name(spark, sorted(own), schema, fmt="csv", keep=["file_name"]).withColumnRenamed("file_name", FILE_COL)
        (rows.withColumn(RUN_COL, F.lit(run)).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
         .partitionBy(RUN_COL).parquet(raw_table))


def _exists(spark: SparkSession, path: str) -> bool:
    from stratum.sources.files import _fs
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    from stratum.sources.files import _fs
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_raw(spark: SparkSession, raw_table: str, schema: T.StructType) -> DataFrame:
    if not _exists(spark, raw_table):  # nothing has been loaded yet
        return spark.createDataFrame([], _raw_schema(schema))
    return spark.read.schema(_raw_schema(schema)).parquet(raw_table)


def load_history(rows: DataFrame, *, table_name: str, as_of) -> DataFrame:
    """Load-history rows for one run: per file, rows loaded and load time."""
    return (rows.groupBy(F.col(FILE_COL).alias("file_name"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(table_name).alias("table_name"), "file_name", "row_count",
                    F.lit("LOADED").alias("status"), ts_literal(as_of).alias("last_load_time")))


def recent_loads(history: DataFrame, as_of, minutes: int = 10) -> DataFrame:
    """Loads since `as_of - minutes`, newest first."""
    since = ts_literal(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return (history.filter(F.col("last_load_time") >= since)
            .orderBy(F.col("last_load_time").desc(), F.col("file_name").asc()))


def staged_stream(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str, *,
                  pattern: str | None = None, as_of, fields: Mapping[str, str] = staging.SURVEY_FIELDS,
                  json_col: str = "engagement_survey") -> DataFrame:
    """The refreshed staging table: new files -> staged rows, appended to `sink`."""
    stream = file_stream(spark, landing, schema, pattern=pattern)
    staged = staging.stage_rows(stream, json_col=json_col, fields=fields, as_of=as_of,
                                source_object=staging.RAW_TABLE, process_type="dt_refresh")
    run_available_now(staged, sink, checkpoint)
    return spark.read.schema(staged.schema).parquet(sink)


# The names the run log uses for this pipeline and its task.
PIPELINE = "streams_tasks_elt"
TASK_NAME = "T_SILVER_FROM_BRONZE_STREAM"
RUNS_SCHEMA = ("run_id STRING, pipeline STRING, stage STRING, procedure STRING, source STRING, target STRING, "
               "started_at TIMESTAMP_NTZ, ended_at TIMESTAMP_NTZ, status STRING, result STRING, "
               "error_code BIGINT, error_message STRING")


REFRESH_SCHEMA = ("name STRING, schema_name STRING, data_timestamp TIMESTAMP_NTZ, refresh_end_time TIMESTAMP_NTZ, "
                  "state STRING, state_code STRING, state_message STRING, refresh_action STRING, "
                  "query_id STRING, statistics STRING")


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _default_marts() -> dict:
    return {"demographics": refresh.demographics_measures(), "survey_results": refresh.survey_measures()}


class IncrementalPipeline:
    """Raw files -> raw table -> staged table (MERGE by key) -> marts, one run at a time.

    The feed of a file stream is insert-only, so the MERGE of a run only adds
    the rows whose key the staged table lacks (existing keys are ignored, as
    the MERGE's clauses say): those rows are written as a new version
    partition `_v=N` of the staged table, and each mart's additive state is
    advanced by the same rows. A run therefore costs the new data plus a
    probe of the staged keys -- never a rewrite of the staged table or a
    rescan for the marts.

    All state lives under `root` (a shared folder): the raw table and its
    stream checkpoint, the staged table, mart state and mart snapshots per
    version, and a version log naming the runs each version merged. A run
    writes its partition and snapshots with overwrite semantics before it
    appends to the log, so a run that dies midway is redone whole by the next.
    """

    def __init__(self, spark: SparkSession, root: str, landing: str, schema: T.StructType, *,
                 key: str = "employee_number", pattern: str | None = None, group: str = "department",
                 mart_measures: Mapping[str, list] | None = None):
        self.spark, self.root, self.landing, self.schema = spark, root.rstrip("/"), landing, schema
        self.key, self.pattern, self.group = key, pattern, group
        self.mart_measures = dict(mart_measures or _default_marts())
        self.raw = f"{self.root}/raw"
        self.checkpoint = f"{self.root}/_checkpoints/raw"
        self.staged_root = f"{self.root}/staged"
        self.versions = f"{self.root}/_versions"
        self.loads = f"{self.root}/_load_history"
        self.events = f"{self.root}/_events"
        self.refreshes = f"{self.root}/_refresh_history"
        self.task_history = f"{self.root}/_task_history"

    def _versions(self) -> DataFrame:
        return self.spark.read.schema("version BIGINT, run_id STRING").parquet(self.versions)

    def current_version(self) -> int:
        """Newest published version (0 = nothing yet). Reads the tiny version log."""
        if not _exists(self.spark, self.versions):  # no log yet; an unreadable one is an error
            return 0
        return int(self._versions().agg(F.max("version")).first()[0] or 0)

    def _empty_staged(self) -> DataFrame:
        return staging.stage_rows(self.spark.createDataFrame([], self.schema), run_id="")

    def staged(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v == 0 or not _exists(self.spark, self.staged_root):
            return self._empty_staged()
        schema = T.StructType([*self._empty_staged().schema.fields, T.StructField("_v", T.LongType())])
        return (self.spark.read.schema(schema).parquet(self.staged_root)
                .filter(F.col("_v") <= v).drop("_v"))

    def _added(self, version: int) -> DataFrame:
        """The rows of one version; a version may add none."""
        part = f"{self.staged_root}/_v={version}"
        return self.spark.read.schema(self._empty_staged().schema).parquet(part) if _exists(self.spark, part) else self._empty_staged()

    def mart(self, name: str) -> DataFrame:
        return self.spark.read.parquet(tables.snapshot_path(f"{self.root}/{name}", self.current_version()))

    def run(self, run_id: str, as_of) -> dict:
        """One gated run: ingest new files; if any raw rows are unmerged, MERGE them
        into the staged table as version N+1 and advance the marts.

        The run logs itself: a STARTED and a SUCCESS/FAILED log row per stage
        (`observe.event_rows`) and one task-history row. A failure is logged as
        FAILED and raised -- never reported as success.
        """
        scheduled = _now()
        steps: list[dict] = []
        self._refreshing: list[tuple] = []
        self._refresh_rows: list[tuple] = []
        if _exists(self.spark, self.versions) and not self._versions().filter(F.col("run_id") == run_id).isEmpty():
            raise ValueError(f"run id {run_id!r} was merged before; rows loaded under it again would not be seen")
        try:
            result = self._run(run_id, as_of, steps)
        except Exception as exc:
            message = f"{type(exc).__name__}: {exc}"
            if steps and steps[-1]["status"] == "RUNNING":
                steps[-1].update(status="FAILED", ended_at=_now(), error_code=1, error_message=message)
            if self._refreshing and self._refreshing[-1][4] == "RUNNING":
                self._refresh_row(*self._refreshing.pop()[:3], "FAILED", message, None, run_id, as_of)
            self._log(run_id, steps, scheduled, "FAILED", None, message)
            raise
        state = "SUCCEEDED" if result["merged"] else "SKIPPED"
        text = (f"Merged {result['rows_inserted']} rows into version {result['version']}"
                if result["merged"] else "No new data")
        self._log(run_id, steps, scheduled, state, text, None)
        return result

    def _step(self, steps: list[dict], run_id: str, stage: str, procedure: str, source: str, target: str) -> dict:
        step = dict(run_id=run_id, pipeline=PIPELINE, stage=stage, procedure=procedure, source=source,
                    target=target, started_at=_now(), ended_at=None, status="RUNNING", result=None,
                    error_code=None, error_message=None)
        steps.append(step)
        return step

    def _run(self, run_id: str, as_of, steps: list[dict]) -> dict:
        load = self._step(steps, run_id, "silver_load", "staging.merge", staging.RAW_TABLE, staging.STAGED_TABLE)
        ingest_new_files(self.spark, self.landing, self.raw, self.checkpoint, self.schema,
                         run_id=run_id, pattern=self.pattern)
        raw = read_raw(self.spark, self.raw, self.schema)
        pending = raw
        if _exists(self.spark, self.versions):
            pending = raw.join(self._versions().select(F.col("run_id").alias(RUN_COL)).distinct(), RUN_COL, "left_anti").select(*raw.columns)
        if pending.isEmpty():  # the has-data gate: nothing new, no work
            steps.remove(load)
            return {"run_id": run_id, "merged": False, "version": self.current_version()}
        previous = self.current_version()
        version = previous + 1
        # A redo after a failure writes the same folders again: nothing is logged or staged twice.
        load_history(pending, table_name=staging.RAW_TABLE, as_of=as_of).write.mode("overwrite").parquet(f"{self.loads}/version={version}")
        _delete(self.spark, f"{self.staged_root}/_v={version}")
        feed = changes.appended_rows(pending.drop(FILE_COL, RUN_COL))
        staged_feed = staging.stage_rows(feed, as_of=as_of, source_object=staging.RAW_STREAM, run_id=run_id)
        stamps = staging.lineage_stamps(as_of, staging.RAW_STREAM, run_id)
        # Probe only the staged rows whose key lies in the new rows' key range: two
        # scalars, and as a literal filter it reaches the Parquet scan, where
        # row-group statistics skip older data when keys arrive in order.
        lo, hi = feed.agg(F.min(self.key), F.max(self.key)).first()
        existing = self.staged(previous)
        if lo is not None:
            existing = existing.filter(F.col(self.key).between(F.lit(lo), F.lit(hi)))
        added = merge.insert_new_keys(existing, staged_feed, self.key, stamps=stamps)
        # Rows affected, counted while the rows are written (no second pass).
        observed = Observation(f"merge_{version}")
        (added.observe(observed, F.count(F.lit(1)).alias("rows_inserted"))
         .withColumn("_v", F.lit(version).cast("bigint")).write
         .option("partitionOverwriteMode", "dynamic").mode("overwrite")
         .partitionBy("_v").parquet(self.staged_root))
        rows_inserted = observed.get["rows_inserted"]
        self._refresh_row("DT_EMPLOYEE_DATA_STG", "SILVER", previous, "SUCCEEDED", None,
                          rows_inserted, run_id, as_of)
        load.update(status="SUCCESS", ended_at=_now(),
                    result=f"Processed {rows_inserted} new rows into {staging.STAGED_TABLE} with etl_run_id={run_id}")

        build = self._step(steps, run_id, "gold_materialize", "marts.refresh", staging.STAGED_TABLE,
                           ",".join(self.mart_measures))
        added = self._added(version)
        for name, measures in self.mart_measures.items():
            self._refreshing.append((f"DT_{name.upper()}", "GOLD", previous, None, "RUNNING"))
            delta = refresh.mart_state(added, [self.group], measures)
            state = delta if previous == 0 else refresh.apply_delta(
                self.spark.read.parquet(tables.snapshot_path(f"{self.root}/{name}_state", previous)),
                delta, [self.group], measures)
            state = tables.publish_snapshot(state, f"{self.root}/{name}_state", version)
            mart = tables.publish_snapshot(
                refresh.finalize(state, [self.group], measures, marts.mart_stamps(as_of, run_id)),
                f"{self.root}/{name}", version)
            self._refreshing.pop()
            self._refresh_row(f"DT_{name.upper()}", "GOLD", previous, "SUCCEEDED", None, mart.count(),
                              run_id, as_of)
        build.update(status="SUCCESS", ended_at=_now(), result=f"Built {len(self.mart_measures)} marts")
        merged = pending.select(F.col(RUN_COL).alias("run_id")).union(self.spark.createDataFrame([(run_id,)], "run_id STRING")).distinct()
        tables.append_rows(merged.select(F.lit(version).cast("bigint").alias("version"), "run_id"), self.versions)
        return {"run_id": run_id, "merged": True, "version": version, "rows_inserted": rows_inserted}

    def _refresh_row(self, name: str, schema_name: str, previous: int, state: str, message, rows,
                     run_id: str, as_of) -> None:
        """One refresh-history row: data time, completion, state and row statistics (JSON)."""
        stats = None if rows is None else json.dumps(
            {"numInsertedRows": int(rows), "numDeletedRows": 0, "numCopiedRows": 0})
        self._refresh_rows.append(
            (name, schema_name, _dt.datetime.fromisoformat(str(as_of)), _now(), state,
             "SUCCESS" if state == "SUCCEEDED" else "ERROR", message,
             "INCREMENTAL" if previous else "FULL", f"{run_id}:{name}", stats))

    def refresh_history(self) -> DataFrame:
        return self.spark.read.parquet(self.refreshes)

    def _log(self, run_id: str, steps: list[dict], scheduled, state: str, text, error) -> None:
        """Append the run's log rows, refresh-history rows and task-history row (one write each)."""
        if self._refresh_rows:
            tables.append_rows(self.spark.createDataFrame(self._refresh_rows, REFRESH_SCHEMA), self.refreshes)
            self._refresh_rows = []
        if steps:
            runs = self.spark.createDataFrame([{k: v for k, v in s.items()} for s in steps], RUNS_SCHEMA)
            tables.append_rows(observe.event_rows(runs), self.events)
        history = self.spark.createDataFrame(
            [(TASK_NAME, scheduled, _now(), state, text, "1" if error else None, error)],
            "name STRING, scheduled_time TIMESTAMP_NTZ, completed_time TIMESTAMP_NTZ, state STRING, "
            "return_value STRING, error_code STRING, error_message STRING")
        tables.append_rows(history, self.task_history)

    def event_log(self) -> DataFrame:
        return self.spark.read.parquet(self.events)

    def task_runs(self) -> DataFrame:
        return self.spark.read.parquet(self.task_history)

    def load_history(self) -> DataFrame:
        """Load history of the published versions."""
        return self.spark.read.parquet(self.loads).filter(F.col("version") <= self.current_version()).drop("version")
