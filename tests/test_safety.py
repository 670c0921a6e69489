"""Failures and odd inputs must not lose, duplicate or swap data."""

import pytest
from pyspark.sql import functions as F

from stratum.functions.json_fields import with_json_number_fields
from stratum.functions.scalars import avg_exact
from stratum.operators import refresh
from stratum.session import work_dir
from stratum.sources import files, tables
from stratum.streaming import ingest

SCHEMA = "employee_number bigint, department string, engagement_survey string"
DAY = "2024-01-30 00:00:00"


def _pipeline(spark, name):
    root, landing = work_dir(spark, name), work_dir(spark, name + "_landing")
    p = ingest.IncrementalPipeline(spark, root, landing, spark.createDataFrame([], SCHEMA).schema, pattern="employee_data_part_*.parquet",
                                   mart_measures={"survey_results": refresh.survey_measures()})

    def land(ids):
        df = spark.createDataFrame([(i, "d", '{"satisfaction_score": 3}', 1) for i in ids], SCHEMA + ", s int")
        files.land_files(spark, df, "s", landing, "employee_data_part")
    return p, land


def test_reused_run_id_is_refused(spark):
    p, land = _pipeline(spark, "t_reused")
    land(range(3))
    p.run("r1", DAY)
    land(range(3, 5))
    with pytest.raises(ValueError):
        p.run("r1", DAY)
    assert p.run("r2", DAY)["rows_inserted"] == 2
    assert p.staged().count() == 5


def test_run_with_known_keys_only_publishes_an_empty_version(spark):
    p, land = _pipeline(spark, "t_known")
    land(range(3))
    p.run("r1", DAY)
    land(range(2))
    again = p.run("r2", DAY)
    assert (again["version"], again["rows_inserted"]) == (2, 0)
    assert p.staged().count() == 3 and p.mart("survey_results").first().num_responses == 3


def test_failed_run_logs_each_file_once(spark, monkeypatch):
    p, land = _pipeline(spark, "t_failed")
    land(range(3))
    real = refresh.mart_state
    monkeypatch.setattr(refresh, "mart_state", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        p.run("r1", DAY)
    monkeypatch.setattr(refresh, "mart_state", real)
    assert p.run("r2", DAY)["rows_inserted"] == 3
    names = [r.file_name for r in p.load_history().collect()]
    assert len(names) == len(set(names)) and p.staged().count() == 3


def test_unreadable_version_log_fails_the_run(spark):
    p, land = _pipeline(spark, "t_log")
    land(range(3))
    p.run("r1", DAY)
    with open(p.versions.replace("file:", "") + "/part-bad.parquet", "wb") as f:
        f.write(b"not parquet")
    land(range(3, 5))
    with pytest.raises(Exception):
        p.run("r2", DAY)


def test_failed_rebuild_keeps_the_old_table(spark):
    path = work_dir(spark, "t_replace") + "/t"
    tables.replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        tables.replace_table(spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    assert tables.replace_table(spark.read.parquet(path).filter("id > 0"), path).count() == 2


def test_json_is_strict(spark):
    texts = ['{"s": 3} garbage', '{"s": 3}{"s": 4}', '{"s": 3},{"s": 4}', "{'s': 3}", '{"s": 3} ', "", None]
    df = with_json_number_fields(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", {"s": "s"})
    assert [r.s for r in df.orderBy("i").collect()] == [None, None, None, None, 3, None, None]


def test_averages_do_not_overflow(spark):
    df = spark.createDataFrame([(9 * 10**18,)] * 3, "x bigint")
    assert df.agg(avg_exact(F.col("x")).alias("a")).first().a == 9e18
    state = refresh.mart_state(df.withColumn("g", F.lit(1)), ["g"], [refresh.Measure("a", "avg", F.col("x"))])
    assert refresh.finalize(state, ["g"], [refresh.Measure("a", "avg", F.col("x"))]).first().a == 9e18


def test_csv_with_another_header_is_read_by_name(spark):
    path = work_dir(spark, "t_csv")
    spark.createDataFrame([("1", "x")], "id string, name string").coalesce(1).write.option("header", "true").csv(path)
    spark.createDataFrame([("y", "2")], "name string, id string").coalesce(1).write.option("header", "true").mode("append").csv(path)
    schema = spark.createDataFrame([], "id int, name string").schema
    assert sorted(map(tuple, files.load_by_name(spark, path, schema, fmt="csv").collect())) == [(1, "x"), (2, "y")]


def test_running_refreshes_do_not_count_as_completed(spark):
    rows = [("DT_A", "2024-01-01 00:00:00", "2024-01-01 00:01:00", "SUCCEEDED", "q1"), ("DT_A", "2024-01-02 00:00:00", None, "RUNNING", "q2")]
    history = spark.createDataFrame(rows, "name string, data_timestamp string, refresh_end_time string, state string, query_id string")
    history = history.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("data_timestamp", "refresh_end_time")})
    assert refresh.freshness(history).first().last_completed_refresh_state == "SUCCEEDED"
