"""Stored snapshots with digests: what changed between two of them, without reading what didn't.

A snapshot is written in parts. A part holds whole key ranges: `width`
consecutive keys stay together (so changes to recent keys touch few parts),
and ranges are dealt to a fixed number of parts; keys that aren't integers are
dealt one by one, rows with a NULL key by a hash of the row. Beside each snapshot
stands a small table with one row per part: the number of rows and two sums of
64-bit row hashes. Sums don't depend on the order of rows and count copies.

`changed_parts` compares the digests alone; `diff` reads only the parts whose
digests differ, in both snapshots, and gives `changes.snapshot_diff` of them;
`has_changes` reads no row at all. A part that changed with equal count and
both sums equal (odds of about 2**-128) would be missed.

Digests cost one more scan of a snapshot when it is stored (no shuffle: a task
sends one row per part). A diff then reads and shuffles changed parts only,
instead of both snapshots whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators import changes
from stratum.operators.changes import any_null

PART = "_part"
MAX_PARTS = 1 << 16  # parts that differ are listed on the driver
_WIDE = "decimal(38,0)"


def row_hash(columns: Sequence[str], salt: int) -> Column:
    """64-bit hash of a row; NULLs count by their place (a plain hash skips them)."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(salt), *[F.col(c) for c in columns], *nulls)


class SnapshotStore:
    """Versions of one table under `root`. `width`: how many consecutive integer keys stay together (None: hashed keys)."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str | Sequence[str], *,
                 width: int | None = None, n_parts: int = 1024):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys = [key] if isinstance(key, str) else list(key)
        if width is not None and (len(self.keys) != 1 or not isinstance(schema[self.keys[0]].dataType, T.IntegralType) or width < 1):
            raise ValueError("width needs one key column of integers, and is 1 or more")
        if not 0 < n_parts <= MAX_PARTS:
            raise ValueError(f"n_parts must be between 1 and {MAX_PARTS}")
        self.width, self.n_parts = width, n_parts

    def _path(self, version: int, what: str) -> str:
        return f"{self.root}/v={version:08d}/{what}"

    def part_of(self) -> Column:
        if self.width is None:
            held = F.xxhash64(*self.keys)
        else:
            key = F.col(self.keys[0]).cast("bigint")
            held = F.xxhash64((key - F.pmod(key, F.lit(self.width).cast("bigint"))).cast("decimal(20,0)"))
        nulls = F.xxhash64(*[F.col(c) for c in self.schema.names])
        return F.pmod(F.when(any_null(self.keys), nulls).otherwise(held), F.lit(self.n_parts)).cast("int")

    def publish(self, rows: DataFrame, version: int) -> None:
        """Store a version and its digests (again, if a run was cut off: both are overwritten)."""
        columns = self.schema.names
        (rows.select(*columns).withColumn(PART, self.part_of()).hint("rebalance", PART).write.mode("overwrite")
         .partitionBy(PART).parquet(self._path(version, "rows")))
        digests = self.rows(version).groupBy(PART).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(row_hash(columns, salt).cast(_WIDE)).alias(f"h{salt}") for salt in (1, 2)])
        digests.coalesce(1).write.mode("overwrite").parquet(self._path(version, "digests"))  # n_parts rows at most

    def rows(self, version: int, parts: Sequence[int] | None = None) -> DataFrame:
        """A version's rows with their part, or those of some parts (a partition filter)."""
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.IntegerType())])
        table = self.spark.read.schema(schema).parquet(self._path(version, "rows"))
        return table if parts is None else table.filter(F.col(PART).isin(*parts))

    def read(self, version: int) -> DataFrame:
        return self.rows(version).drop(PART)

    def digests(self, version: int) -> DataFrame:
        return self.spark.read.schema(f"{PART} INT, n BIGINT, h1 {_WIDE}, h2 {_WIDE}").parquet(self._path(version, "digests"))

    def changed_parts(self, before: int, after: int) -> DataFrame:
        """Parts whose digests differ, or that one of the versions lacks."""
        both = self.digests(before).unionByName(self.digests(after))
        return (both.groupBy(PART).agg(F.count(F.lit(1)).alias("__v"), F.count_distinct("n", "h1", "h2").alias("__d"))
                .filter("__v = 1 OR __d > 1").select(PART))

    def has_changes(self, before: int, after: int, name: str = "has_changes") -> DataFrame:
        """One boolean row, from the digests alone."""
        return self.changed_parts(before, after).agg((F.count(F.lit(1)) > 0).alias(name))

    def diff(self, before: int, after: int) -> DataFrame:
        """The change feed from one version to the other (see `changes.snapshot_diff`)."""
        parts = sorted(r[0] for r in self.changed_parts(before, after).collect())  # n_parts numbers at most
        return changes.snapshot_diff(self.rows(before, parts).drop(PART), self.rows(after, parts).drop(PART), self.keys)
