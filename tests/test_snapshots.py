"""Diffs by digests: equal to the whole diff, and blind to parts that didn't change."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import changes
from stratum.session import work_dir
from stratum.sources.snapshots import PART, SnapshotStore

SCHEMA = "k bigint, a string, b double"


def _store(spark, **kw):
    return SnapshotStore(spark, work_dir(spark, "t_snap"), spark.createDataFrame([], SCHEMA).schema, "k", **kw)


def _made(seed, n=300):
    r = random.Random(seed)
    return [(r.choice([None, r.randrange(-50, 400)]) if r.random() < 0.1 else i, r.choice(["x", "y", None]), r.choice([0.5, -0.0, None])) for i in range(n)]


@pytest.mark.parametrize("width", [None, 16])
def test_diff_equals_the_whole_diff(spark, width):
    r, before = random.Random(2), _made(1)
    after = [row for row in before if r.random() > 0.02] + [(1000, "new", 1.0), (5, None, None), before[3], before[3]]
    b, a = (spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (before, after))
    store = _store(spark, width=width, n_parts=32)
    store.publish(b, 1)
    store.publish(a, 2)
    store.publish(b.repartition(5), 3)
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(store.diff(1, 2)) == key(changes.snapshot_diff(b, a, "k"))
    assert key(store.read(2)) == key(a)
    assert store.has_changes(1, 2).first()[0] is True and store.has_changes(1, 3).first()[0] is False
    assert store.diff(1, 3).count() == 0


def test_only_changed_parts_are_read(spark):
    """Every file of an unchanged part is made unreadable: the diff doesn't notice. The gate reads no rows at all."""
    before = spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.lit(1.0).alias("b"))
    after = before.withColumn("a", F.when(F.col("k").between(100, 109), "y").otherwise(F.col("a")))
    store = _store(spark, width=64, n_parts=64)
    store.publish(before, 1)
    store.publish(after, 2)
    changed = {r[0] for r in store.changed_parts(1, 2).collect()}
    assert 1 <= len(changed) <= 2
    for f in glob.glob(f"{store.root.removeprefix('file:')}/v=*/rows/{PART}=*/*.parquet"):
        if int(f.split(f"{PART}=")[1].split("/")[0]) not in changed:
            open(f, "wb").write(b"broken")
    assert store.diff(1, 2).count() == 20
    for f in glob.glob(f"{store.root.removeprefix('file:')}/v=*/rows/{PART}=*/*.parquet"):
        open(f, "wb").write(b"broken")
    assert store.has_changes(1, 2).first()[0] is True


def test_digests_tell_nulls_copies_and_places_apart(spark):
    pairs = [([(1, None, 2.0)], [(1, "x", None)]), ([(1, "x", 1.0)], [(1, "x", 1.0)] * 2), ([], [(None, None, None)]),
             ([(1, "x", 1.0), (2, "y", 1.0)], [(1, "y", 1.0), (2, "x", 1.0)])]
    for n, (x, y) in enumerate(pairs):
        store = _store(spark, n_parts=2)
        store.publish(spark.createDataFrame(x, SCHEMA), 1)
        store.publish(spark.createDataFrame(y, SCHEMA), 2)
        assert store.has_changes(1, 2).first()[0] is True, n
    with pytest.raises(ValueError):
        SnapshotStore(spark, "x", spark.createDataFrame([], SCHEMA).schema, "a", width=4)
