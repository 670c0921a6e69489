"""Tables kept in buckets by key, so that a change rewrites only the buckets it touches.

The bucket is an ordinary partition column (`_bucket`, a hash of the key), so
Spark's own partition pruning reads the touched buckets only and dynamic
partition overwrite replaces them only; the files of other buckets stay as
they are. There is no manifest: the folders are the table. Rows with a NULL key
are dealt by a hash of the whole row, so they don't pile up in one bucket.

Writes go out by `rebalance`: adaptive execution cuts a bucket that holds a hot
key into several files and puts small buckets into one task. While a publish
runs, a reader may see old and new buckets side by side; a publish that was cut
off is repeated from its stored rows (see `streaming.change_runs`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.changes import any_null

BUCKET = "_bucket"
MAX_BUCKETS = 1 << 16  # bucket numbers of a change are listed on the driver


def bucket_of(keys: Sequence[str], columns: Sequence[str], n_buckets: int) -> Column:
    """The bucket of a row: a hash of its key, or of the whole row if a key part is NULL."""
    by_row = F.xxhash64(*[F.col(c) for c in columns])
    return F.pmod(F.when(any_null(list(keys)), by_row).otherwise(F.xxhash64(*keys)), F.lit(n_buckets)).cast("int")


class BucketedTable:
    """A Parquet folder of `schema`, in `n_buckets` buckets by `key`. The number of buckets is fixed for its life."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str | Sequence[str], n_buckets: int = 256):
        if not 0 < n_buckets <= MAX_BUCKETS:
            raise ValueError(f"n_buckets must be between 1 and {MAX_BUCKETS}")
        self.spark, self.path, self.schema, self.n_buckets = spark, path.rstrip("/"), schema, n_buckets
        self.keys = [key] if isinstance(key, str) else list(key)

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p))

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table with its bucket column, or these buckets of it (a partition filter: others aren't listed as input)."""
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        if not self._exists(self.path) or (buckets is not None and not buckets):
            return self.spark.createDataFrame([], schema)
        table = self.spark.read.schema(schema).parquet(self.path)
        return table if buckets is None else table.filter(F.col(BUCKET).isin(*buckets))

    def read(self) -> DataFrame:
        return self.rows().drop(BUCKET)

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        """Rows with the number of the bucket they belong to; keys are read as the table's key types."""
        types = {f.name: f.dataType for f in self.schema.fields}
        return rows.withColumns({k: F.col(k).cast(types[k]) for k in self.keys}).withColumn(
            BUCKET, bucket_of(self.keys, [c for c in self.schema.names if c in rows.columns], self.n_buckets))

    def publish(self, rows: DataFrame, buckets: Sequence[int]) -> None:
        """Replace `buckets` by `rows` (with their bucket column); all other buckets stay untouched.

        Can be repeated with the same rows after a failure; `rows` must not read this table then.
        """
        (rows.select(*self.schema.names, BUCKET).hint("rebalance", BUCKET).write.option("partitionOverwriteMode", "dynamic")
         .mode("overwrite").partitionBy(BUCKET).parquet(self.path))
        # Dynamic overwrite leaves a partition alone for which there are no rows: buckets that lost their last row.
        filled = {r[0] for r in rows.select(BUCKET).distinct().collect()}
        for bucket in sorted(set(buckets) - filled):
            p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}={bucket}")
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def create(self, rows: DataFrame) -> None:
        """Write the whole table anew."""
        self.publish(self.with_bucket(rows), range(self.n_buckets))
