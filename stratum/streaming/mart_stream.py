"""Marts as stateful streams: the state store of a streaming aggregation is the mart.

A folder of signed rows (what a change feed adds and takes away, `_w` = +1 or
-1) is read as a file stream, grouped, and summed; each refresh takes the files
that arrived since the last one and advances the sums in the query's state store.
Checkpoint and state are versioned together, so a refresh that dies is repeated
from the last committed batch, a restarted process goes on where the last one
ended, and neither the table nor earlier files are read again.

The mart is read from the state store itself (Spark's state data source), so no
sink has to hold it and nothing passes through the driver: `mart` turns each
group's sums into its counts and averages. The state is split over as many
partitions as the session had shuffle partitions at the first refresh; a hot
group is summed within each task before it reaches its state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.scalars import limbs
from stratum.operators.merge import WEIGHT
from stratum.operators.refresh import ROWS, Measure, finalize

_SUM = "decimal(38,0)"


class MartStream:
    """One mart over the signed rows appended under `feed`; all its state lies under `root`."""

    def __init__(self, spark: SparkSession, root: str, feed: str, schema: T.StructType, group: Sequence[str], measures: Sequence[Measure]):
        self.spark, self.feed, self.checkpoint = spark, feed.rstrip("/"), f"{root.rstrip('/')}/_checkpoint"
        self.schema = T.StructType([*schema.fields, T.StructField(WEIGHT, T.IntegerType())])
        self.group, self.measures = list(group), list(measures)

    def append(self, signed: DataFrame) -> None:
        """Hand signed rows to the stream (files appear whole, as a write commits)."""
        signed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.mode("append").parquet(self.feed)

    def _sums(self) -> list[tuple[str, Column, str]]:
        """(name, summed value, type) of the state: rows, and per average a sum and a count."""
        w = F.col(WEIGHT)
        made = [(ROWS, w.cast("bigint"), "bigint")]
        for m in self.measures:
            if m.kind == "sum":
                made.append((m.name, (w * m.expr).cast("bigint"), "bigint"))
            elif m.kind == "avg":
                made.append((f"{m.name}__sum", (w * m.expr).cast("decimal(28,0)"), _SUM))
            elif m.kind == "avg_wide":
                made += [(f"{m.name}__{end}__sum", (w * x).cast("decimal(28,0)"), _SUM) for end, x in zip(("high", "low"), limbs(m.expr))]
            if m.kind.startswith("avg"):
                made.append((f"{m.name}__n", F.when(m.expr.isNotNull(), w).otherwise(0).cast("bigint"), "bigint"))
        return made

    def refresh(self, max_files_per_trigger: int | None = None) -> None:
        """Take in what arrived since the last refresh, then stop."""
        reader = self.spark.readStream.schema(self.schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        rows = reader.parquet(self.feed)
        # NULL values leave a sum as it is; 0 says the same and keeps the state free of them.
        state = rows.groupBy(*self.group).agg(*[F.sum(F.coalesce(value, F.lit(0).cast(value_type))).alias(name)
                                                for name, value, value_type in [(n, v, "decimal(28,0)" if t == _SUM else t) for n, v, t in self._sums()]])
        (state.writeStream.outputMode("update").format("noop").option("checkpointLocation", self.checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    def state(self) -> DataFrame:
        """Groups and their sums, as of the last refresh; groups whose rows are all gone are left out."""
        stored = self.spark.read.format("statestore").load(self.checkpoint)
        sums = self._sums()
        # A decimal sum keeps a flag beside it; the fields stand in the order of the aggregates.
        fields = [f for name, _, t in sums for f in ([f"`{name}`:{t}"] + ([f"`{name}__empty`:boolean"] if t == _SUM else []))]
        found = stored.schema["value"].dataType
        if len(found.fields) != len(fields):
            raise ValueError(f"unexpected state: {found.simpleString()}")
        keys = [F.col("key").getField(k.name).alias(g) for g, k in zip(self.group, stored.schema["key"].dataType.fields)]
        value = F.col("value").cast(f"struct<{','.join(fields)}>")
        return (stored.select(*keys, value.alias("__v")).select(*self.group, *[F.col("__v").getField(name).alias(name) for name, _, _ in sums])
                .filter(F.col(ROWS) > 0))

    def mart(self, stamps: Mapping[str, Column] | None = None) -> DataFrame:
        return finalize(self.state(), self.group, self.measures, stamps)
