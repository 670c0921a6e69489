"""Gated incremental runs over a feed of inserts, updates and deletes.

`ChangePipeline` is the run of `ingest.IncrementalPipeline` for a source that
delivers change rows (`_action`, `_is_update` and an order column) instead of
new rows only. A run takes the files that arrived, nets the changes of each key,
and MERGEs them into a staged table kept in buckets by key: only buckets that
a change touches are read and rewritten. The marts' additive state is advanced by
the signed rows of that MERGE, never by a rescan.

A run's steps can each be repeated:

  1. raw files -> raw table (stream checkpoint)
  2. `_merge/v=N/runs`: the runs the version takes in; `_merge/v=N/buckets`: those it touches
  3. `_merge/v=N/rows`: every row of the touched buckets, with its fate
  4. the touched buckets are replaced from 3 (not from the table itself)
  5. mart states and marts of version N, from those of N-1 and the signed rows of 3
  6. the version log names N and its runs

A version whose rows (3) are complete, but which the log doesn't name, is finished
by the next run before it looks at new files: steps 4 to 6 read only what is
stored, so nothing is merged twice or lost. One whose rows aren't is made anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators import changes, marts, merge, refresh, staging
from stratum.sources import tables
from stratum.sources.bucketed import BUCKET, BucketedTable
from stratum.streaming.ingest import FILE_COL, RUN_COL, IncrementalPipeline, _delete, _exists, _now, ingest_new_files, load_history, read_raw


class ChangePipeline(IncrementalPipeline):
    """`schema`: the source's columns, without `_action`, `_is_update` and the order column."""

    def __init__(self, *args, order: str = "_seq", n_buckets: int = 256, **kwargs):
        super().__init__(*args, **kwargs)
        self.order = order
        self.columns = self.schema
        self.schema = T.StructType([*self.columns.fields, T.StructField(changes.ACTION, T.StringType()),
                                    T.StructField(changes.IS_UPDATE, T.BooleanType()), T.StructField(order, T.LongType())])
        self.table = BucketedTable(self.spark, self.staged_root, self._empty_staged().schema, self.key, n_buckets)

    def _empty_staged(self) -> DataFrame:
        return staging.stage_rows(self.spark.createDataFrame([], self.columns), run_id="")

    def staged(self) -> DataFrame:
        """The staged table as last published."""
        return self.table.read()

    def _merge_path(self, version: int, what: str) -> str:
        return f"{self.root}/_merge/v={version:08d}/{what}"

    def _run(self, run_id: str, as_of, steps: list[dict]) -> dict:
        load = self._step(steps, run_id, "silver_load", "staging.merge", staging.RAW_STREAM, staging.STAGED_TABLE)
        left = self.current_version() + 1
        resumed = None
        if _exists(self.spark, f"{self._merge_path(left, 'rows')}/_SUCCESS"):  # a run died after its MERGE was stored
            resumed = self._finish(left, as_of, run_id)
            if not self._versions().filter(F.col("run_id") == run_id).isEmpty():  # that run, called again: it is complete now
                return self._done(steps, load, run_id, left, resumed)
        ingest_new_files(self.spark, self.landing, self.raw, self.checkpoint, self.schema, run_id=run_id, pattern=self.pattern)
        pending = read_raw(self.spark, self.raw, self.schema)
        if _exists(self.spark, self.versions):
            merged_runs = self._versions().select(F.col("run_id").alias(RUN_COL)).distinct()
            pending = pending.join(merged_runs, RUN_COL, "left_anti")
        if pending.isEmpty():  # the has-data gate: nothing new, no work
            if resumed is None:
                steps.remove(load)
                return {"run_id": run_id, "merged": False, "version": self.current_version()}
            counts, version = resumed, left
        else:
            version = self.current_version() + 1
            self._merge(version, pending, as_of, run_id)
            counts = self._finish(version, as_of, run_id)
        return self._done(steps, load, run_id, version, counts)

    def _done(self, steps: list[dict], load: dict, run_id: str, version: int, counts: dict) -> dict:
        load["result"] = (f"Processed stream records (INSERT/UPDATE/DELETE) into {staging.STAGED_TABLE} with etl_run_id={run_id}. "
                          f"Rows affected: {sum(counts.values())}")
        load.update(status="SUCCESS", ended_at=_now())
        build = self._step(steps, run_id, "gold_materialize", "marts.refresh", staging.STAGED_TABLE, ",".join(self.mart_measures))
        build.update(status="SUCCESS", ended_at=_now(), result=f"Built {len(self.mart_measures)} marts")
        return {"run_id": run_id, "merged": True, "version": version, **counts}

    def _merge(self, version: int, pending: DataFrame, as_of, run_id: str) -> None:
        """Steps 2 and 3: the runs and buckets of the version, then its rows."""
        load_history(pending, table_name=staging.RAW_TABLE, as_of=as_of).write.mode("overwrite").parquet(f"{self.loads}/version={version}")
        own = self.spark.createDataFrame([(run_id,)], "run_id STRING")
        pending.select(F.col(RUN_COL).alias("run_id")).union(own).distinct().write.mode("overwrite").parquet(self._merge_path(version, "runs"))
        net = changes.net_changes(pending.drop(FILE_COL, RUN_COL), self.key, self.order)
        feed = staging.stage_rows(net, as_of=as_of, source_object=staging.RAW_STREAM, run_id=run_id)
        feed = tables.materialize(self.table.with_bucket(feed), self._merge_path(version, "feed"))
        touched = tables.materialize(feed.select(BUCKET).distinct().coalesce(1), self._merge_path(version, "buckets"))
        stamps = staging.lineage_stamps(as_of, staging.RAW_STREAM, run_id)
        current = self.table.rows([r[0] for r in touched.collect()])  # n_buckets numbers at most
        fates = merge.merge_fates(current, feed, [*self.table.keys, BUCKET], stamps=stamps)
        _delete(self.spark, self._merge_path(version, "rows"))
        fates.write.parquet(self._merge_path(version, "rows"))

    def _finish(self, version: int, as_of, run_id: str) -> dict:
        """Steps 4 to 6, from what is stored; returns the numbers of rows inserted, updated and deleted."""
        previous = version - 1
        fates = self.spark.read.parquet(self._merge_path(version, "rows"))
        touched = [r[0] for r in self.spark.read.parquet(self._merge_path(version, "buckets")).collect()]
        self.table.publish(fates.filter(F.col(merge.FATE) != "DELETE"), touched)
        fate = F.col(merge.FATE)
        counts = fates.agg(*[F.count_if(fate == f).alias(f"rows_{name}") for f, name in
                             (("INSERT", "inserted"), ("UPDATE", "updated"), ("DELETE", "deleted"))]).first().asDict()
        self._refresh_row("DT_EMPLOYEE_DATA_STG", "SILVER", previous, "SUCCEEDED", None, counts["rows_inserted"] + counts["rows_updated"], run_id, as_of)
        signed = merge.signed_rows(fates, self.table.schema.names)
        for name, measures in self.mart_measures.items():
            self._refreshing.append((f"DT_{name.upper()}", "GOLD", previous, None, "RUNNING"))
            delta = refresh.mart_state(signed, [self.group], measures, F.col(merge.WEIGHT))
            state = delta if previous == 0 else refresh.apply_delta(
                self.spark.read.parquet(tables.snapshot_path(f"{self.root}/{name}_state", previous)), delta, [self.group], measures)
            state = tables.publish_snapshot(state, f"{self.root}/{name}_state", version)
            mart = tables.publish_snapshot(refresh.finalize(state, [self.group], measures, marts.mart_stamps(as_of, run_id)), f"{self.root}/{name}", version)
            self._refreshing.pop()
            self._refresh_row(f"DT_{name.upper()}", "GOLD", previous, "SUCCEEDED", None, mart.count(), run_id, as_of)
        runs = self.spark.read.parquet(self._merge_path(version, "runs"))
        tables.append_rows(runs.select(F.lit(version).cast("bigint").alias("version"), "run_id"), self.versions)
        return counts
