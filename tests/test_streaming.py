from pyspark.sql import functions as F

from stratum.session import work_dir
from stratum.sources import files
from stratum.streaming import ingest

SCHEMA = "employee_number bigint, department string, engagement_survey string"


def _land(spark, landing, ids, prefix="employee_data_part"):
    df = spark.createDataFrame([(i, "d", '{"satisfaction_score": 3}', i % 2 + 1) for i in ids],
                               SCHEMA + ", s int").withColumnRenamed("employee_number", "EMPLOYEE_NUMBER")
    return files.land_files(spark, df, "s", landing, prefix)


def test_each_file_loads_once(spark):
    root, landing = work_dir(spark, "t_pipe"), work_dir(spark, "t_landing")
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, landing, range(10))
    _land(spark, landing, range(100, 105), prefix="not_matching")
    first = ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck", schema, run_id="r1",
                                    pattern="employee_data_part_*.parquet")
    assert sorted(r.employee_number for r in first.collect()) == list(range(10))  # matched by name, any case
    again = ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck", schema, run_id="r2",
                                    pattern="employee_data_part_*.parquet")
    assert again.count() == 0
    _land(spark, landing, range(20, 24), prefix="employee_data_part_b")
    third = ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck", schema, run_id="r3",
                                    pattern="employee_data_part_*.parquet")
    assert sorted(r.employee_number for r in third.collect()) == [20, 21, 22, 23]
    hist = ingest.load_history(third, table_name="t", as_of="2024-01-31 00:00:00")
    assert sum(r.row_count for r in hist.collect()) == 4


def test_pipeline_gate_and_replay(spark):
    root, landing = work_dir(spark, "t_elt"), work_dir(spark, "t_landing")
    schema = spark.createDataFrame([], SCHEMA).schema
    from stratum.operators import refresh
    p = ingest.IncrementalPipeline(spark, root, landing, schema, pattern="employee_data_part_*.parquet",
                                   mart_measures={"survey_results": refresh.survey_measures()})
    _land(spark, landing, range(6))
    first = p.run("r1", "2024-01-30 00:00:00")
    assert (first["version"], first["rows_inserted"]) == (1, 6)
    assert p.run("r2", "2024-01-30 00:01:00") == {"run_id": "r2", "merged": False, "version": 1}
    _land(spark, landing, [*range(6, 9), 2])  # key 2 again: the MERGE ignores an existing key
    third = p.run("r3", "2024-01-31 00:00:00")
    assert (third["version"], third["rows_inserted"]) == (2, 3)  # key 2 re-delivered: ignored
    staged = p.staged()
    assert staged.count() == 9
    assert {r.etl_run_id for r in staged.filter(F.col("employee_number") >= 6).collect()} == {"r3"}
    assert p.mart("survey_results").first().num_responses == 9
    log = p.event_log()
    assert log.filter("record_type = 'LOG'").count() == 8  # 2 merged runs x 2 stages x (STARTED, SUCCESS)
    assert sorted(r.state for r in p.task_runs().collect()) == ["SKIPPED", "SUCCEEDED", "SUCCEEDED"]
    from stratum.operators import observe
    summary = {(r.pipeline_stage, r.status): r.execution_count
               for r in observe.event_summary(log, "2100-01-01 00:00:00", days=365 * 200).collect()}
    assert summary == {("silver_load", "STARTED"): 2, ("silver_load", "SUCCESS"): 2,
                       ("gold_materialize", "STARTED"): 2, ("gold_materialize", "SUCCESS"): 2}
    hist = p.refresh_history()
    totals = {r.name: (r.total_refreshes, r.successful_refreshes, r.total_rows_inserted)
              for r in observe.refresh_summary(hist, "2100-01-01 00:00:00", days=365 * 200).collect()}
    assert totals == {"DT_EMPLOYEE_DATA_STG": (2, 2, 9), "DT_SURVEY_RESULTS": (2, 2, 2)}
    fresh = refresh.freshness(hist).collect()
    assert {r.name: r.last_completed_refresh_state for r in fresh} == {
        "DT_EMPLOYEE_DATA_STG": "SUCCEEDED", "DT_SURVEY_RESULTS": "SUCCEEDED"}


def test_bounded_batches_and_archive(spark):
    root, landing = work_dir(spark, "t_pipe"), work_dir(spark, "t_landing")
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, landing, range(10))
    _land(spark, landing, range(10, 20))
    got = ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck", schema, run_id="r1",
                                  pattern="employee_data_part_*.parquet", max_files_per_trigger=1,
                                  archive_dir=f"{root}/archive")
    assert sorted(r.employee_number for r in got.collect()) == list(range(20))


def test_failed_stage_is_logged_as_failed_and_raised(spark):
    import pytest
    from stratum.operators import refresh
    root, landing = work_dir(spark, "t_elt"), work_dir(spark, "t_landing")
    schema = spark.createDataFrame([], SCHEMA).schema
    broken = {"demographics": refresh.demographics_measures()}  # needs age/gender: absent here
    p = ingest.IncrementalPipeline(spark, root, landing, schema, pattern="employee_data_part_*.parquet",
                                   mart_measures=broken)
    _land(spark, landing, range(4))
    with pytest.raises(Exception):
        p.run("r1", "2024-01-30 00:00:00")
    statuses = sorted(r.value.split('"status":"')[1].split('"')[0] for r in p.event_log().collect())
    assert statuses == ["FAILED", "STARTED", "STARTED", "SUCCESS"]
    assert [r.state for r in p.task_runs().collect()] == ["FAILED"]
    assert sorted((r.name, r.state) for r in p.refresh_history().collect()) == [
        ("DT_DEMOGRAPHICS", "FAILED"), ("DT_EMPLOYEE_DATA_STG", "SUCCEEDED")]
    assert p.current_version() == 0  # nothing published: the next run redoes the whole merge


def test_regex_file_filter(spark):
    landing = work_dir(spark, "t_landing")
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, landing, range(4))
    _land(spark, landing, range(100, 103), prefix="employee_archive")
    got = files.load_by_name(spark, landing, schema, regex=r".*employee_data_part_.*[.]parquet")
    assert sorted(r.employee_number for r in got.collect()) == [0, 1, 2, 3]


def test_new_checkpoint_loads_everything_again(spark):
    """Re-creating the load pipe clears its history: a fresh checkpoint reloads every file."""
    root, landing = work_dir(spark, "t_pipe"), work_dir(spark, "t_landing")
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, landing, range(5))
    args = dict(pattern="employee_data_part_*.parquet")
    assert ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck1", schema, run_id="r1", **args).count() == 5
    assert ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck1", schema, run_id="r2", **args).count() == 0
    assert ingest.ingest_new_files(spark, landing, f"{root}/raw2", f"{root}/ck2", schema, run_id="r3", **args).count() == 5


def test_new_checkpoint_on_old_raw_table_is_refused(spark):
    import pytest
    root, landing = work_dir(spark, "t_pipe"), work_dir(spark, "t_landing")
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, landing, range(3))
    ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck1", schema, run_id="r1")
    with pytest.raises(ValueError, match="stream log"):
        ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck2", schema, run_id="r2")


def test_cli_run_and_checks(spark):
    import json
    from stratum import cli
    root, landing = work_dir(spark, "t_cli"), work_dir(spark, "t_landing")
    _land(spark, landing, range(5))
    full = ("employee_number bigint, employee_name string, gender string, department string, age double, "
            "length_of_service double, engagement_survey string")  # absent columns load as NULL
    assert cli.main(["run", "--root", root, "--landing", landing, "--schema", full,
                     "--run-id", "r1", "--as-of", "2024-01-31 00:00:00"]) == 0
    staged = f"{root}/staged"
    raw = f"{root}/raw"
    results = f"{root}/_dq"
    assert cli.main(["checks", "--raw", raw, "--staged", staged, "--results", results,
                     "--as-of", "2024-01-31 00:00:00"]) == 0
    got = {r.check_name: r.issue_count for r in spark.read.parquet(results).collect()}
    assert got == {"null_employee_number": 0, "invalid_survey_range": 5}  # only one of five scores present


def _csv(spark, landing, name, lines):
    import os
    os.makedirs(landing.removeprefix("file:"), exist_ok=True)
    with open(f"{landing.removeprefix('file:')}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n" if lines else "")


CSV_A = ["EMPLOYEE_NUMBER,department,engagement_survey", '1,a,"{\\"s\\": 1}"', "2,b,"]
CSV_B = ["department,extra,Employee_Number", "c,x,3", "d,y,4"]
CSV_ROWS = [(1, "a", '{"s": 1}'), (2, "b", None), (3, "c", None), (4, "d", None)]


def test_csv_files_with_swapped_columns_load_by_name(spark):
    import gzip
    landing, schema = work_dir(spark, "t_landing"), spark.createDataFrame([], SCHEMA).schema
    _csv(spark, landing, "part_1.csv", CSV_A)
    _csv(spark, landing, "part_2.csv", CSV_B)
    _csv(spark, landing, "part_3.csv", [])
    _csv(spark, landing, "other.csv", ["employee_number", "99"])
    with gzip.open(f"{landing.removeprefix('file:')}/part_4.csv.gz", "wt") as f:
        f.write("department,employee_number\ne,5\n")
    got = files.load_by_name(spark, landing, schema, fmt="csv", pattern="part_*")
    assert sorted(map(tuple, got.collect())) == [*CSV_ROWS, (5, "e", None)]
    only = files.load_by_name(spark, landing, schema, fmt="csv", regex=r".*part_[12][.]csv")
    assert only.columns == schema.names and sorted(map(tuple, only.collect())) == CSV_ROWS
    assert files.load_by_name(spark, landing, schema, fmt="csv", pattern="none_*").count() == 0


def test_csv_stream_by_name_and_a_load_cut_off(spark, monkeypatch):
    """The files of a load that died after the stream had noted them are loaded by the next call, once."""
    import pytest
    root, landing, schema = work_dir(spark, "t_pipe"), work_dir(spark, "t_landing"), spark.createDataFrame([], SCHEMA).schema
    args = dict(schema=schema, fmt="csv", pattern="part_*.csv")
    _csv(spark, landing, "part_1.csv", CSV_A)
    with monkeypatch.context() as m:
        m.setattr(ingest.files, "load_by_name", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck", run_id="r1", **args)
    _csv(spark, landing, "part_2.csv", CSV_B)
    second = ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck", run_id="r2", **args)
    assert sorted(r.employee_number for r in second.collect()) == [3, 4]
    ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck", run_id="r3", **args)
    every = ingest.read_raw(spark, f"{root}/raw", schema)
    assert sorted((r._run_id, r._source_file, r.employee_number, r.department) for r in every.collect()) == [
        ("r1", "part_1.csv", 1, "a"), ("r1", "part_1.csv", 2, "b"), ("r2", "part_2.csv", 3, "c"), ("r2", "part_2.csv", 4, "d")]


def test_json_stream_by_name(spark):
    root, landing, schema = work_dir(spark, "t_pipe"), work_dir(spark, "t_landing"), spark.createDataFrame([], SCHEMA).schema
    _csv(spark, landing, "a.json", ['{"DEPARTMENT": "a", "employee_NUMBER": 1}', '{"employee_number": "2", "engagement_survey": {"s": 1}}', "{bad"])
    got = ingest.ingest_new_files(spark, landing, f"{root}/raw", f"{root}/ck", schema, run_id="r1", fmt="json")
    assert sorted(((r.employee_number, r.department, r.engagement_survey) for r in got.collect()), key=repr) == sorted(
        [(1, "a", None), (2, None, '{"s":1}'), (None, None, None)], key=repr)


def test_consumers_at_different_places(spark):
    """A crash between write and log is repeated with the same runs; nothing is lost or doubled for either consumer."""
    import pytest
    from stratum.streaming.consumers import Consumer, write_version
    root, landing, schema = work_dir(spark, "t_consumers"), work_dir(spark, "t_landing"), spark.createDataFrame([], SCHEMA).schema
    ingest_ = lambda ids, run: (_land(spark, landing, ids, f"employee_data_part_{run}"), ingest.ingest_new_files(
        spark, landing, f"{root}/raw", f"{root}/ck", schema, run_id=run, pattern="employee_data_part_*.parquet"))
    make = lambda name: Consumer(spark, root, name, f"{root}/raw", schema)
    write = lambda name: lambda rows, v: write_version(rows, f"{root}/{name}/rows", v)
    keys = lambda name: sorted((r._v, r.employee_number) for r in spark.read.parquet(f"{root}/{name}/rows").collect())
    assert make("a").consume(write("a")) is None and not make("a").has_data()
    ingest_(range(4), "r1")
    assert make("a").consume(write("a")) == 1
    ingest_(range(4, 6), "r2")

    def dies(rows, v):
        write("a")(rows, v)
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        make("a").consume(dies)
    assert make("a").version() == 1 and make("a").has_data()
    ingest_(range(6, 9), "r3")
    assert make("a").consume(write("a")) == 2
    assert keys("a") == [(1, i) for i in range(4)] + [(2, 4), (2, 5)]
    assert make("a").pending().count() == 3 and make("b").pending().count() == 9
    assert make("b").consume(write("b")) == 1 and make("a").consume(write("a")) == 3
    assert make("a").consume(write("a")) is None and make("b").consume(write("b")) is None
    assert [k for _, k in keys("b")] == [k for _, k in keys("a")] == list(range(9))
