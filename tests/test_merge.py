import pytest
from pyspark.sql import functions as F

from stratum.operators.changes import snapshot_diff, has_changes
from stratum.operators.merge import merge_changes, merge_counts, update_where_in, semi_in
from conftest import rows

TARGET = "k bigint, v string, staged_at string"
FEED = "k bigint, v string, _action string, _is_update boolean"


def test_every_fate(spark):
    target = spark.createDataFrame(
        [(1, "a", "old"), (2, "b", "old"), (3, "c", "old"), (5, "e", "old"), (6, "f", "old"), (6, "f2", "old"),
         (None, "n", "old")], TARGET)
    feed = spark.createDataFrame([
        (1, None, "DELETE", False),      # matched DELETE -> deleted
        (2, "B", "INSERT", True),        # matched INSERT+update -> updated, restamped
        (2, "b", "DELETE", True),        # update's DELETE half -> dropped before matching
        (3, "C", "INSERT", False),       # matched plain INSERT -> ignored
        (4, "d", "INSERT", False),       # not matched INSERT -> inserted
        (7, "g", "INSERT", True),        # not matched INSERT (update flag) -> inserted
        (8, "h", "DELETE", False),       # not matched DELETE -> ignored
        (None, "m", "INSERT", False),    # NULL key INSERT -> inserted
        (None, "m2", "DELETE", False),   # NULL key DELETE -> ignored
        (9, "i1", "INSERT", False),      # key twice in feed -> both inserted
        (9, "i2", "INSERT", False),
        (6, "F", "INSERT", True),        # key on two target rows -> both updated
    ], FEED)
    out = merge_changes(target, feed, "k", stamps={"staged_at": F.lit("new")})
    assert out.columns == ["k", "v", "staged_at"]
    assert rows(out) == sorted([
        (2, "B", "new"), (3, "c", "old"), (5, "e", "old"), (6, "F", "new"), (6, "F", "new"), (None, "n", "old"),
        (4, "d", "new"), (7, "g", "new"), (None, "m", "new"), (9, "i1", "new"), (9, "i2", "new"),
    ], key=repr)
    c = merge_counts(target, feed, "k").first()
    assert (c.rows_inserted, c.rows_updated, c.rows_deleted) == (5, 3, 1)
    from pyspark.sql import Observation
    obs = Observation("merge")
    merge_changes(target, feed, "k", stamps={"staged_at": F.lit("new")}, observation=obs) \
        .write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows_inserted": 5, "rows_updated": 3, "rows_deleted": 1}


def test_ambiguous_changes_raise(spark):
    target = spark.createDataFrame([(1, "a", "old")], TARGET)
    feed = spark.createDataFrame([(1, "x", "INSERT", True), (1, "y", "INSERT", True)], FEED)
    with pytest.raises(Exception, match="several DELETE/UPDATE"):
        merge_changes(target, feed, "k", stamps={"staged_at": F.lit("new")}).collect()


def test_diff_then_merge_restores_after(spark):
    before = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k bigint, v string")
    after = spark.createDataFrame([(i, f"v{i}" if i % 3 else f"w{i}") for i in range(10, 70) if i % 7], "k bigint, v string")
    feed = snapshot_diff(before, after, "k")
    merged = merge_changes(before, feed, "k")
    assert rows(merged) == rows(after)
    updates = feed.filter("_is_update").groupBy("_action").count()
    assert {r["_action"]: r["count"] for r in updates.collect()} == {"DELETE": 11, "INSERT": 11}  # k in 10..49, k % 3 == 0, k % 7 != 0


def test_diff_is_a_bag_and_null_keys_never_pair(spark):
    before = spark.createDataFrame([(1, "a"), (1, "a"), (None, "x"), (2, "b")], "k bigint, v string")
    after = spark.createDataFrame([(1, "a"), (None, "y"), (2, "b")], "k bigint, v string")
    got = rows(snapshot_diff(before, after, "k"))
    assert got == sorted([(1, "a", "DELETE", False), (None, "x", "DELETE", False),
                          (None, "y", "INSERT", False)], key=repr)


def test_has_changes(spark):
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    assert has_changes(snapshot_diff(df, df, "k")).first()[0] is False
    assert has_changes(snapshot_diff(df, df.limit(0), "k")).first()[0] is True


def test_update_where_in_and_semi_in(spark):
    df = spark.createDataFrame([(3, 1), (1, 2), (2, 3)], "k bigint, s bigint")
    assert rows(update_where_in(df, "s", 99, "k")) == [(1, 99), (2, 3), (3, 1)]
    keys = spark.createDataFrame([(1,), (None,)], "c bigint")
    assert rows(semi_in(df, "k", keys, "c")) == [(1, 2)]


def test_update_where_in_listed_keys(spark):
    df = spark.createDataFrame([(1, 5), (2, 3), (3, 1), (None, 7)], "k long, s int")
    listed = spark.createDataFrame([(1,), (3,), (3,), (None,), (9,)], "id long")
    assert sorted(rows(update_where_in(df, "s", 99, "k", keys=listed, keys_col="id")), key=str) == \
        [(1, 99), (2, 3), (3, 99), (None, 7)]
    assert sorted(rows(update_where_in(df, "s", 99, "k", keys=listed.limit(0), keys_col="id")), key=str) == sorted(rows(df), key=str)


def test_diff_makes_many_copies_and_flags_no_null_key(spark):
    from pyspark.sql import functions as F

    from stratum.operators.changes import COPIES, snapshot_diff
    n = 2 * COPIES + 3
    before = spark.createDataFrame([(None, 1), (5, 1), (6, 1)], "k long, v int")
    after = spark.range(n).select(F.lit(7).cast("long").alias("k"), F.lit(0).alias("v")).unionByName(
        spark.createDataFrame([(None, 2), (5, 2), (6, 1)], "k long, v int"))
    got = {tuple(r)[:4]: r[4] for r in snapshot_diff(before, after, "k").groupBy("k", "v", "_action", "_is_update").count().collect()}
    assert got == {(7, 0, "INSERT", False): n, (None, 1, "DELETE", False): 1, (None, 2, "INSERT", False): 1,
                   (5, 1, "DELETE", True): 1, (5, 2, "INSERT", True): 1}
