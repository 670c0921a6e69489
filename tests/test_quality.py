import json

from pyspark.sql import functions as F

from stratum.operators import quality


def test_null_check_zero_issues_and_bounded_sample(spark):
    df = spark.createDataFrame([(i, None if i < 15 else f"n{i}") for i in range(30)], "k bigint, name string")
    none = quality.null_check(df, "k", sample=[("name", "name")], check_name="c", layer="l",
                              table_name="t", as_of="2024-01-31 00:00:00").first()
    assert none.issue_count == 0 and json.loads(none.sample_details) == {"sample_rows": []}
    some = df.withColumn("k", F.when(F.col("k") % 2 == 0, None).otherwise(F.col("k")))
    r = quality.null_check(some, "k", sample=[("name", "name")], check_name="c", layer="l",
                           table_name="t", as_of="2024-01-31 00:00:00").first()
    sample = json.loads(r.sample_details)["sample_rows"]
    assert r.issue_count == 15 and len(sample) == 10
    assert sample[:8] == [{}] * 8  # NULL names: key dropped, sorted first


def test_range_check_counts_null_as_issue(spark):
    df = spark.createDataFrame([(1, 3, 4), (2, None, 4), (3, 0, 5), (4, 5, 6)], "k bigint, a bigint, b bigint")
    r = quality.range_check(df, ["a", "b"], sample=[("k", "k")], check_name="c", layer="l", table_name="t",
                            as_of="2024-01-31 00:00:00").first()
    assert r.issue_count == 3
    assert json.loads(r.sample_details) == {"bad_rows": [{"k": 2}, {"k": 3}, {"k": 4}]}


def test_ref_check_ignores_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id bigint, fk bigint")
    parent = spark.createDataFrame([(10,)], "pk bigint")
    r = quality.ref_check(child, "fk", parent, "pk", sample=[("id", "id")], check_name="c", layer="l",
                          table_name="t", as_of="2024-01-31 00:00:00").first()
    assert r.issue_count == 1 and json.loads(r.sample_details) == {"sample_rows": [{"id": 2}]}


def test_quarantine_and_score(spark):
    df = spark.createDataFrame([(1, 3), (2, 200), (None, 4)], "k bigint, s bigint")
    good, bad = quality.quarantine(df, {"null_key": F.col("k").isNull(), "too_big": F.col("s") > 100})
    assert good.count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == ["null_key", "too_big"]
    sc = {r.check_name: r for r in quality.quality_score(df, {"null_key": F.col("k").isNull()}, table_name="t").collect()}
    assert sc["null_key"].issue_count == 1 and abs(sc["null_key"].quality_score - 2 / 3) < 1e-12


def test_truncate_keeps_schema(spark):
    from stratum.session import work_dir
    from stratum.sources import tables
    path = work_dir(spark, "t_trunc")
    tables.replace_table(spark.createDataFrame([(1, "a")], "k bigint, v string"), path)
    out = tables.truncate_table(spark, path)
    assert out.count() == 0 and out.dtypes == [("k", "bigint"), ("v", "string")]


def test_suite_of_all_checks_in_one_scan(spark):
    """Counts and samples as each check alone gives them; one scan, one row a task, nothing written aside."""
    rows = [(None if i % 7 == 0 else i, i % 9, f"n{i % 5}" if i % 11 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "k bigint, s bigint, name string").repartition(6)
    checks = [quality.Check("null_k", F.col("k").isNull(), [("name", "name"), ("s", "s")], "sample_rows", "l", "t"),
              quality.Check("range_s", quality.out_of_range(F.col("s")), [("s", "s"), ("k", "k")], "bad_rows", "l", "t"),
              quality.Check("unknown", F.col("k") > 400, [("k", "k")], "sample_rows", "l", "t"),  # NULL where k is NULL: no issue
              quality.Check("never", F.lit(False), [("k", "k")], "sample_rows", "l", "t")]
    got = {r.check_name: r for r in quality.check_suite(df, checks, as_of="2024-01-31 00:00:00").collect()}
    assert {n: r.issue_count for n, r in got.items()} == {"null_k": 72, "range_s": sum(not 1 <= r[1] <= 5 for r in rows),
                                                         "unknown": sum((r[0] or 0) > 400 for r in rows), "never": 0}
    assert all(r.rows_checked == 500 for r in got.values())
    first = lambda x: (x is not None, x)
    nulls = sorted(((r[2], r[1]) for r in rows if r[0] is None), key=lambda x: (first(x[0]), first(x[1])))[:10]
    assert json.loads(got["null_k"].sample_details)["sample_rows"] == [{k: v for k, v in (("name", n), ("s", s)) if v is not None} for n, s in nulls]
    assert json.loads(got["never"].sample_details) == {"sample_rows": []}
    alone = quality.range_check(df, ["s"], sample=[("s", "s"), ("k", "k")], check_name="range_s", layer="l", table_name="t", as_of="2024-01-31 00:00:00").first()
    assert alone.sample_details == got["range_s"].sample_details and alone.issue_count == got["range_s"].issue_count
    empty = quality.check_suite(df.limit(0), checks, as_of="2024-01-31 00:00:00").collect()
    assert [(r.issue_count, r.rows_checked) for r in empty] == [(0, 0)] * 4


def test_suite_plan_has_one_scan_and_one_exchange(spark):
    from stratum.plans import registry
    for name in ("check_suite_staged", "range_check", "null_check"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1 and "Sort" not in plan, name


def test_reference_flag_in_a_suite(spark):
    child = spark.createDataFrame([(i, None if i % 5 == 0 else i % 40) for i in range(200)], "id bigint, fk bigint")
    parent = spark.createDataFrame([(i,) for i in range(30)] * 2 + [(None,)], "pk bigint")
    flagged = quality.with_reference(child, "fk", parent, "pk", "orphan")
    assert flagged.columns == ["id", "fk", "orphan"] and flagged.count() == 200
    assert sorted(r.id for r in flagged.filter("orphan").collect()) == [i for i in range(200) if i % 5 and i % 40 >= 30]


def test_run_summary_and_freshness(spark):
    from stratum.operators import observe, refresh
    steps = spark.createDataFrame([
        ("r1", "DEMOGRAPHICS TABLE", "demo", "2024-01-01 00:00:00.9", "2024-01-01 00:00:02.1", 6, None),
        ("r1", "SURVEY TABLE", "survey", "2024-01-01 00:00:02.1", "2024-01-01 00:00:03.0", 5, "boom"),
        ("r2", "DEMOGRAPHICS TABLE", "demo", "2024-01-01 00:00:00", "2024-01-01 00:00:01", 6, None),
    ], "run_id string, step string, table_name string, started_at string, ended_at string, row_count int, "
       "error_message string").withColumn("started_at", F.col("started_at").cast("timestamp_ntz")) \
        .withColumn("ended_at", F.col("ended_at").cast("timestamp_ntz"))
    out = {r.run_id: r for r in observe.run_summary(
        steps, [("DEMOGRAPHICS TABLE", "DEMOGRAPHICS TABLE"), ("SURVEY TABLE", "SURVEY TABLE")]).collect()}
    assert (out["r1"].status, out["r1"].error_count, out["r1"].total_seconds) == ("FAILED", 1, 3)
    assert "SUCCESS: Built demo with 6 rows in 2 seconds" in out["r1"].summary
    assert "SURVEY TABLE: ERROR: Failed to build survey - boom" in out["r1"].summary
    assert out["r2"].status == "SUCCESS" and out["r2"].summary.endswith("SURVEY TABLE: ")
    hist = spark.createDataFrame([
        ("DT_A", "2024-01-01 00:00:00", "2024-01-01 00:04:00", "SUCCEEDED", "q1"),
        ("DT_A", "2024-01-01 01:00:00", "2024-01-01 01:10:00", "FAILED", "q2"),
        ("XDT_B", "2024-01-01 00:00:00", "2024-01-01 00:01:00", "SUCCEEDED", "q3"),
    ], "name string, data_timestamp string, refresh_end_time string, state string, query_id string")
    hist = hist.select("name", F.lit("GOLD").alias("schema_name"), F.concat("query_id", F.lit("-code")).alias("state_code"), F.lit(None).cast("string").alias("state_message"), *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("data_timestamp", "refresh_end_time")],
                       "state", "query_id")
    f = refresh.freshness(hist, target_lag_sec=300).collect()
    assert len(f) == 1 and f[0].name == "DT_A"
    assert (f[0].time_within_target_lag_ratio, f[0].maximum_lag_sec, f[0].last_completed_refresh_state) == (0.5, 600, "FAILED")
    assert (f[0].schema_name, f[0].last_completed_refresh_state_code, f[0].last_completed_refresh_state_message) == ("GOLD", "q2-code", None)
    assert str(f[0].latest_data_timestamp) == "2024-01-01 00:00:00"
