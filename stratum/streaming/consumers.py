"""Several consumers of one feed, each at its own place.

The feed is a table partitioned by the run that loaded it (`_run_id`), as
`ingest.ingest_new_files` writes it. A consumer takes in whole runs; which ones
it has taken is its own small log, so consumers neither see nor move each
other's place, and a new consumer starts from the first run.

The place moves only with a write, as a table stream's does:

  1. claim: the runs to take are noted as version N (kept as they are if N was claimed before)
  2. `write(rows, N)`: must replace what it wrote as version N before (`write_version` does)
  3. log: N's runs are taken

A consumer that dies after 1 or 2 repeats version N with the same runs, whatever
has arrived since, so its target holds each row once. Reading (`pending`) moves nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sources import tables
from stratum.streaming.ingest import FILE_COL, RUN_COL, _exists, read_raw

VERSION = "_v"


def write_version(rows: DataFrame, path: str, version: int) -> None:
    """Write a version's rows as a partition of the target, in place of what it held."""
    (rows.withColumn(VERSION, F.lit(version).cast("bigint")).write.option("partitionOverwriteMode", "dynamic")
     .mode("overwrite").partitionBy(VERSION).parquet(path))


class Consumer:
    """One named reader of the feed `raw_table`; its state lies under `root`/`name`."""

    def __init__(self, spark: SparkSession, root: str, name: str, raw_table: str, schema: T.StructType):
        self.spark, self.raw, self.schema = spark, raw_table, schema
        self.claims, self.log = f"{root.rstrip('/')}/{name}/_claims", f"{root.rstrip('/')}/{name}/_log"

    def _log(self) -> DataFrame:
        schema = f"version BIGINT, {RUN_COL} STRING"
        return self.spark.read.schema(schema).parquet(self.log) if _exists(self.spark, self.log) else self.spark.createDataFrame([], schema)

    def version(self) -> int:
        """The last version whose runs are taken; 0 before the first."""
        return int(self._log().agg(F.max("version")).first()[0] or 0)

    def pending(self) -> DataFrame:
        """Rows of runs not taken yet, with their run and file."""
        rows = read_raw(self.spark, self.raw, self.schema)
        return rows.join(self._log().select(RUN_COL).distinct(), RUN_COL, "left_anti").select(*rows.columns)

    def has_data(self) -> bool:
        return not self.pending().isEmpty()

    def consume(self, write: Callable[[DataFrame, int], None]) -> int | None:
        """Take in what is pending by `write(rows, version)`; the version, or None if there is nothing."""
        version = self.version() + 1
        claim = tables.snapshot_path(self.claims, version)
        if not _exists(self.spark, f"{claim}/_SUCCESS"):
            if not self.has_data():
                return None
            self.pending().select(RUN_COL).distinct().write.mode("overwrite").parquet(claim)
        runs = self.spark.read.schema(f"{RUN_COL} STRING").parquet(claim)
        rows = read_raw(self.spark, self.raw, self.schema)
        write(rows.join(runs, RUN_COL, "left_semi").select(*rows.columns).drop(FILE_COL, RUN_COL), version)
        tables.append_rows(runs.select(F.lit(version).cast("bigint").alias("version"), RUN_COL), self.log)
        return version
