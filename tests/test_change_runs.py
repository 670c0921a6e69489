"""Incremental runs over inserts, updates and deletes: against a full recompute, and cut off at every step."""

import os
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import changes, merge, refresh
from stratum.session import work_dir
from stratum.sources import files, tables
from stratum.sources.bucketed import BUCKET, BucketedTable
from stratum.streaming import change_runs
from stratum.streaming.change_runs import ChangePipeline

RAW = "employee_number bigint, department string, engagement_survey string"
FEED = RAW + ", _action string, _is_update boolean, _seq bigint"


def _score(n):
    return f'{{"satisfaction_score": {n}}}'


def _land(spark, landing, rows, prefix):
    df = spark.createDataFrame(rows, FEED).withColumn("s", F.lit(1))
    files.land_files(spark, df.repartition(2), "s", landing, f"employee_data_part_{prefix}")


def _pipeline(spark, root=None, landing=None, n_buckets=8):
    schema = spark.createDataFrame([], RAW).schema
    return ChangePipeline(spark, root or work_dir(spark, "t_chg"), landing or work_dir(spark, "t_chg_landing"), schema, n_buckets=n_buckets,
                          pattern="employee_data_part_*.parquet", mart_measures={"survey_results": refresh.survey_measures()})


def _files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.join(folder, name)] = os.path.getmtime(os.path.join(folder, name))
    return found


def _rows(p):
    rows = [(r.employee_number, r.department, r.satisfaction_score) for r in p.staged().collect()]
    return sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))


def _mart(p):
    return {r.department: (r.num_responses, r.avg_satisfaction_score) for r in p.mart("survey_results").collect()}


def test_random_changes_equal_a_recompute(spark):
    r, p, table, seq, nulls = random.Random(1), _pipeline(spark), {}, 0, 0
    for run in range(3):
        rows = []
        for _ in range(60):
            seq += 1
            key, dept, score = r.randrange(40), r.choice("ab"), r.randrange(1, 6)
            if r.random() < 0.05:
                rows.append((None, dept, _score(score), "INSERT", False, seq))
                nulls += 1
            elif key not in table:
                rows.append((key, dept, _score(score), "INSERT", False, seq))
                table[key] = (dept, score)
            elif r.random() < 0.4:
                rows.append((key, *[table[key][0], _score(table[key][1])], "DELETE", False, seq))
                del table[key]
            else:
                rows.append((key, table[key][0], _score(table[key][1]), "DELETE", True, seq))
                rows.append((key, dept, _score(score), "INSERT", True, seq))
                table[key] = (dept, score)
        _land(spark, p.landing, rows, f"r{run}")
        result = p.run(f"run-{run}", "2024-01-30 00:00:00")
        assert result["merged"] and result["version"] == run + 1
        got = _rows(p)
        assert [x for x in got if x[0] is not None] == sorted((k, *v) for k, v in table.items())
        assert len(got) == len(table) + nulls
        every = [x[1:] for x in got]
        assert _mart(p) == {d: (len(s), sum(s) / len(s)) for d in {x[0] for x in every} if (s := [y for x, y in every if x == d])}
    assert p.run("run-9", "2024-01-31 00:00:00") == {"run_id": "run-9", "merged": False, "version": 3}


def test_untouched_buckets_keep_their_files(spark):
    p = _pipeline(spark, n_buckets=16)
    _land(spark, p.landing, [(i, "a", _score(3), "INSERT", False, 1) for i in range(200)], "x")
    p.run("r1", "2024-01-30 00:00:00")
    before = _files(p.staged_root)
    _land(spark, p.landing, [(7, "b", _score(5), "INSERT", True, 2), (11, "a", _score(3), "DELETE", False, 2), (999, "a", _score(1), "DELETE", False, 2)], "y")
    result = p.run("r2", "2024-01-31 00:00:00")
    assert (result["rows_inserted"], result["rows_updated"], result["rows_deleted"]) == (0, 1, 1)
    after = _files(p.staged_root)
    touched = {r[0] for r in p.table.with_bucket(spark.createDataFrame([(7,), (11,), (999,)], "employee_number bigint")).select(BUCKET).collect()}
    kept = {f: t for f, t in before.items() if int(f.split(f"{BUCKET}=")[1].split("/")[0]) not in touched}
    assert kept and all(after.get(f) == t for f, t in kept.items())
    assert p.staged().count() == 199 and p.staged().filter("employee_number = 7").first().department == "b"
    assert _mart(p) == {"a": (198, 3.0), "b": (1, 5.0)}
    plan = p.table.rows([1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and BUCKET in plan


def test_a_bucket_that_loses_its_last_row(spark):
    p = _pipeline(spark, n_buckets=4)
    _land(spark, p.landing, [(i, "a", _score(3), "INSERT", False, 1) for i in range(4)], "x")
    p.run("r1", "2024-01-30 00:00:00")
    _land(spark, p.landing, [(i, "a", _score(3), "DELETE", False, 2) for i in range(4)], "y")
    p.run("r2", "2024-01-31 00:00:00")
    assert p.staged().count() == 0 and _mart(p) == {}


@pytest.mark.parametrize("step", ["merge_fates", "publish", "publish_snapshot", "append_rows"])
def test_a_run_cut_off_is_finished_by_the_next(spark, monkeypatch, step):
    """Dies while merging, half-way through publishing, at a mart, or before the version log."""
    p = _pipeline(spark, n_buckets=4)
    _land(spark, p.landing, [(i, "a", _score(3), "INSERT", False, 1) for i in range(20)] + [(None, "n", _score(1), "INSERT", False, 1)], "x")
    p.run("r1", "2024-01-30 00:00:00")
    _land(spark, p.landing, [(3, "b", _score(5), "INSERT", True, 2), (4, "a", _score(3), "DELETE", False, 2),
                             (50, "b", _score(1), "INSERT", False, 2), (None, "n", _score(2), "INSERT", False, 2)], "y")

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "publish":
            whole = BucketedTable.publish

            def half(self, rows, buckets):
                whole(self, rows.filter(F.col(BUCKET) < 2), [b for b in buckets if b < 2])
                die()
            m.setattr(BucketedTable, "publish", half)
        else:
            owner = merge if step == "merge_fates" else change_runs.tables
            if step == "append_rows":
                log, append = p.versions, change_runs.tables.append_rows
                m.setattr(owner, step, lambda df, path: die() if path == log else append(df, path))
            else:
                m.setattr(owner, step, die)
        with pytest.raises(RuntimeError, match="lost"):
            p.run("r2", "2024-01-31 00:00:00")
    again = _pipeline(spark, p.root, p.landing, 4)
    _land(spark, p.landing, [(60, "b", _score(2), "INSERT", False, 3)], "z")
    again.run("r3", "2024-01-31 01:00:00")
    want = {i: ("a", 3) for i in range(20)} | {3: ("b", 5), 50: ("b", 1), 60: ("b", 2)}
    del want[4]
    got = _rows(again)
    assert [x for x in got if x[0] is not None] == sorted((k, *v) for k, v in want.items())
    assert sorted(x[2] for x in got if x[0] is None) == [1, 2]
    assert _mart(again) == {"a": (18, 3.0), "b": (3, 8 / 3), "n": (2, 1.5)}


def test_net_changes_of_a_key(spark):
    rows = [(1, "x", "INSERT", False, 1), (1, "y", "INSERT", True, 2),                       # new, then updated
            (2, "x", "DELETE", False, 1), (2, "y", "INSERT", False, 2),                      # replaced
            (3, "x", "INSERT", False, 1), (3, "x", "DELETE", False, 2),                      # came and went
            (4, "x", "INSERT", True, 1), (4, "x", "DELETE", True, 1), (4, "z", "INSERT", True, 5),
            (5, "x", "INSERT", False, 3), (5, "y", "INSERT", False, 4),                      # delivered twice
            (None, "x", "INSERT", False, 1), (None, "y", "INSERT", False, 2), (None, "x", "DELETE", False, 3)]
    feed = spark.createDataFrame(rows, "k bigint, v string, _action string, _is_update boolean, _seq bigint").repartition(4)
    got = sorted(map(tuple, changes.net_changes(feed, "k", "_seq").collect()), key=repr)
    assert got == sorted([(1, "y", "INSERT", True), (2, "y", "INSERT", True), (3, "x", "DELETE", False), (4, "z", "INSERT", True),
                          (5, "x", "INSERT", False), (None, "x", "INSERT", False), (None, "y", "INSERT", False)], key=repr)
    assert changes.net_changes(feed.limit(0), "k", "_seq").count() == 0


def test_signed_rows_of_a_merge(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, v string")
    feed = spark.createDataFrame([(1, "x", "INSERT", True), (2, "b", "DELETE", False), (4, "d", "INSERT", False), (3, "q", "INSERT", False), (9, "q", "DELETE", False)],
                                 "k bigint, v string, _action string, _is_update boolean")
    fates = merge.merge_fates(target, feed, "k")
    assert sorted(map(tuple, merge.signed_rows(fates, ["k", "v"]).collect())) == [(1, "a", -1), (1, "x", 1), (2, "b", -1), (4, "d", 1)]


def test_one_row_group_is_read_by_all_cores(spark, tmp_path):
    """A session that names no number of input tasks: a scan of few splits is dealt to every core, one of many stays as it is."""
    from stratum.plans import registry
    name = tables.INPUT_PARTITIONS
    before, cores = spark.conf.get(name, None), spark.sparkContext.defaultParallelism
    spark.conf.unset(name)
    try:
        spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
        one = tables.spread_few_splits(spark.read.parquet(f"{tmp_path}/one"))
        assert one.rdd.getNumPartitions() == cores > 1 and sorted(r.id for r in one.collect()) == list(range(100))
        many = spark.range(0, 100, 1, cores + 3)
        assert tables.spread_few_splits(many) is many
        p = registry._change_runs(spark, "/root/testdata/sf0.01")
        landed = {r[0] for r in spark.read.parquet(p.raw).select("_source_file").distinct().collect()}
        assert len([f for f in landed if f.startswith("employee_data_part_a")]) > 5  # one task writes one file per department
    finally:
        if before is not None:
            spark.conf.set(name, before)
