"""Table writes on plain Parquet folders (no row-level table format needed).

Parquet files are immutable, so every change publishes a new snapshot
folder and readers switch to it; a folder is never overwritten while a plan
reads it (Spark refuses that anyway).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """CREATE OR REPLACE TABLE t AS <df>: write the rows aside, then switch folders by rename.

    A build that fails leaves the old table as it is, and `df` may read the table it replaces.
    """
    spark, path, mark = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex[:8]
    made = f"{path}__new_{mark}"
    df.write.parquet(made)
    new = spark._jvm.org.apache.hadoop.fs.Path(made)
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    here, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}__old_{mark}"))
    had = fs.exists(here)
    if had and not fs.rename(here, old):
        raise OSError(f"could not set aside {path}")
    if not fs.rename(new, here):
        if had:
            fs.rename(old, here)
        raise OSError(f"could not publish {path}")
    if had:
        fs.delete(old, True)
    return spark.read.parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """INSERT INTO t SELECT ...: add files to the folder."""
    df.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:08d}"


def publish_snapshot(df: DataFrame, root: str, version: int) -> DataFrame:
    """Write version `version` of a table (idempotent: a replay rewrites the same
    folder from the same inputs) and return it read back from storage, which
    also cuts the lineage of the plan that produced it."""
    path = snapshot_path(root, version)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back.

    For an intermediate result that later plans read more than once (a change
    feed consumed by MERGE): they scan the written files instead of
    recomputing it, and the lineage is cut, so a lost executor costs a
    re-read of files rather than a recompute of the whole upstream plan.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


INPUT_PARTITIONS = "spark.stratum.input.partitions"


def spread_input(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal a scan's rows round-robin to `partitions` tasks, where the caller or the session asks for it.

    For one-row-group files that feed a CPU-heavy row-wise step such as JSON
    parsing: such a file is one task however many cores wait. Without a number
    (neither given nor set as `spark.stratum.input.partitions`, as on a cluster
    whose inputs have many splits) the scan stays as it is. Results are the same.
    """
    n = partitions or df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n)) if n and not df.isStreaming else df


def spread_few_splits(df: DataFrame) -> DataFrame:
    """`spread_input`, where the session names no number: a scan of no more splits than the session has cores is
    dealt round-robin to as many tasks as cores.

    A file's splits are cut by bytes, but a row group is read by one task, so such a scan, and every
    step over files written from it, may run on one core. A scan of more splits stays as it is.
    """
    spark = df.sparkSession
    if spark.conf.get(INPUT_PARTITIONS, None):
        return spread_input(df)
    cores = spark.sparkContext.defaultParallelism
    return spread_input(df, cores) if df.rdd.getNumPartitions() <= cores else df


def truncate_table(spark: SparkSession, path: str) -> DataFrame:
    """TRUNCATE TABLE: keep the schema, drop every row (the schema is read first,
    so the folder being overwritten is not also being read)."""
    schema = spark.read.parquet(path).schema
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)
