from pyspark.sql import functions as F

from stratum.functions.json_fields import flatten_object, with_json_number_fields
from stratum.operators.staging import stage_rows

CASES = [  # (text, satisfaction_score after staging)
    ('{"satisfaction_score": 4}', 4),
    ('{"satisfaction_score": "4"}', 4),
    ('{"satisfaction_score": 3.6}', 4),
    ('{"satisfaction_score": "4.6"}', 5),
    ('{"satisfaction_score": -4.5}', -5),
    ('{"satisfaction_score": 2.5}', 3),
    ('{"satisfaction_score": 1e2}', 100),
    ('{"satisfaction_score": " 5 "}', 5),
    ('{"satisfaction_score": 0}', 0),
    ('{"satisfaction_score": 99}', 99),
    ('{"satisfaction_score": null}', None),
    ('{}', None),
    ('{"satisfaction_score": "n/a"}', None),
    ('{"satisfaction_score": "1,000"}', None),
    ('{"satisfaction_score": true}', None),
    ('{"satisfaction_score": {"x": 1}}', None),
    ('{"satisfaction_score": 99999999999}', 99999999999),
    (None, None),
    ('{bad', None),
]


def test_number_semantics(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, s string")
    out = with_json_number_fields(df, "s", {"score": "satisfaction_score"})
    got = {r["id"]: r["score"] for r in out.collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}
    assert dict(out.dtypes)["score"] == "bigint"


def test_one_parse_per_row_under_a_filter(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": 9}')], "id int, s string")
    out = with_json_number_fields(df, "s", {"a": "a", "b": "b"}).filter((F.col("a") > 0) | (F.col("b") > 5))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1, plan


def test_stage_rows_adds_scores_and_stamps(spark):
    raw = spark.createDataFrame([(1, '{"satisfaction_score": 3, "teamwork_score": "5"}')],
                                "employee_number bigint, engagement_survey string")
    staged = stage_rows(raw, as_of="2024-01-31 00:00:00", run_id="r1")
    r = staged.first()
    assert (r.satisfaction_score, r.teamwork_score, r.work_life_balance_score) == (3, 5, None)
    assert r.source_object == "bronze.employee_data_parquet" and r.etl_run_id == "r1"
    assert str(r.staged_at) == "2024-01-31 00:00:00"
    assert dict(staged.dtypes)["staged_at"] == "timestamp_ntz"


def test_flatten_object(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"x": 2}, "c": "t", "d": null}'), (2, "{bad"), (3, None)],
                               "id int, j string")
    got = sorted((r.id, r.key, r.value) for r in flatten_object(df, "j", keep=["id"]).collect())
    assert got == [(1, "a", "1"), (1, "b", '{"x":2}'), (1, "c", "t"), (1, "d", None)]


def test_scalar_helpers(spark):
    from stratum.functions.scalars import json_object, seconds_between, ts_literal, avg_exact
    df = spark.createDataFrame([("2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", None)],
                               "a string, b string, n string")
    r = df.select(
        seconds_between(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("boundaries"),
        json_object([("x", F.lit(1)), ("n", F.col("n")), ("s", F.lit("t"))]).alias("obj"),
        ts_literal("2024-01-31 00:00:00").alias("ts"),
    ).first()
    assert r.boundaries == 1          # .9 -> 1.1 crosses one second boundary
    assert r.obj == '{"x":1,"s":"t"}'  # NULL-valued keys are left out
    assert dict(df.select(ts_literal("2024-01-31 00:00:00").alias("t")).dtypes)["t"] == "timestamp_ntz"
    empty = spark.createDataFrame([(None,)], "v bigint").agg(avg_exact(F.col("v")).alias("a")).first()
    assert empty.a is None


def test_conform_and_evolve_schema(spark):
    from pyspark.sql import types as T
    from stratum.operators.staging import conform, empty_like, evolve_schema
    df = spark.createDataFrame([(1, "x", "extra")], "ID bigint, Name string, other string")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("source_object", T.StringType()), T.StructField("n", T.IntegerType())])
    out = conform(df, target, {"source_object": "bronze"})
    assert out.columns == ["id", "name", "source_object", "n"]           # by name, any case; extras dropped
    assert tuple(out.first()) == (1, "x", "bronze", None)               # unlisted: default or NULL
    ev = evolve_schema(df, [("score", "bigint", None), ("source_object", "string", "bronze")])
    assert ev.dtypes[-2:] == [("score", "bigint"), ("source_object", "string")]
    assert ev.first().source_object == "bronze"                          # existing rows take the default
    assert empty_like(df, [("score", "bigint", None)]).count() == 0


def test_flatten_array(spark):
    from stratum.functions.json_fields import flatten_array
    df = spark.createDataFrame([(1, '[1, "a", null, {"x":2}]'), (2, "[]"), (3, '{"x": 1}'), (4, "[1"), (5, None), (6, "7")], "id int, j string")
    assert [tuple(r) for r in flatten_array(df, "j", ["id"]).orderBy("id", "pos").collect()] == \
        [(1, 0, "1"), (1, 1, "a"), (1, 2, None), (1, 3, '{"x":2}')]


def test_flatten_is_strict(spark):
    from stratum.functions.json_fields import flatten_array, flatten_object
    rows = [(1, '{"a":1}'), (2, "{'a':1}"), (3, '{"a":1} junk'), (4, '{"a":1},{"b":2}'), (5, "[1]"), (6, ""), (7, None), (8, '{"a":1,"a":2}'), (9, "5")]
    df = spark.createDataFrame(rows, "i int, t string")
    assert sorted(map(tuple, flatten_object(df, "t", ["i"]).collect())) == [(1, "a", "1"), (8, "a", "1"), (8, "a", "2")]
    lists = spark.createDataFrame([(1, '[1,"x"]'), (2, "[1] junk"), (3, "[1],[2]"), (4, "['x']"), (5, '{"a":1}'), (6, "[]"), (7, None)], "i int, t string")
    assert sorted(map(tuple, flatten_array(lists, "t", ["i"]).collect())) == [(1, 0, "1"), (1, 1, "x")]


def test_flatten_deep_against_brute_force(spark):
    import json
    from stratum.functions.variants import flatten_deep, parsed
    values = [{"a": 1, "b": {"c": [1, "x", None, {"d": [[], {}]}]}}, [1, [2, [3, {"k": True}]]], 5, {}, [], {"z": None}]
    texts = [json.dumps(v) for v in values] + ["{'a':1}", '{"a":1} x', '{"a":1,"a":2}', "", None]
    want = []

    def walk(i, v, path):
        pairs = [(f"{path}.{k}", None, k, x) for k, x in v.items()] if isinstance(v, dict) else [(f"{path}[{n}]", n, None, x) for n, x in enumerate(v)] if isinstance(v, list) else []
        for p, n, k, x in pairs:
            nested = isinstance(x, (dict, list))
            text = None if x is None else x if isinstance(x, str) else json.dumps(x, separators=(",", ":"))
            want.append((i, p, n, k, text, nested))
            walk(i, x, p)
    for i, v in enumerate(values):
        walk(i, v, "$")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert sorted(map(tuple, flatten_deep(df, "t", ["i"]).collect()), key=repr) == sorted(want, key=repr)
    stored = df.select("i", parsed(F.col("t")).alias("v"))
    assert flatten_deep(stored, "v", ["i"]).count() == len(want)
    assert flatten_deep(df.limit(0), "t", ["i"]).count() == 0


def test_variants_read_as_the_text_does(spark):
    from stratum.functions.json_fields import with_json_number_fields
    from stratum.functions.variants import with_variant, with_variant_numbers
    texts = ['{"a": 3.6, "b": "4"}', '{"a": -4.5, "b": {"x": 1}}', '{"a": 99999999999, "b": true}', "{bad", '{"a": 1e2, "b": " 5 "}', '{"a": null}', "[1]", '{"a": 1} x', "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    fields = {"a": "a", "b": "b"}
    want = with_json_number_fields(df, "t", fields).select("i", "a", "b")
    stored = with_variant(df, "t", "v")
    assert sorted(map(tuple, with_variant_numbers(stored, "v", fields).select("i", "a", "b").collect())) == sorted(map(tuple, want.collect()))


def test_variant_queries_parse_nothing(spark):
    from stratum.plans import registry
    for name in ("variant_stage", "variant_event_extract", "variant_refresh_summary"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "parse_json" not in plan, name


def test_stamps_are_made_once_a_call(spark):
    import datetime as dt
    from stratum.operators import marts, staging
    raw = spark.createDataFrame([(i, "d", None) for i in range(50)], "employee_number bigint, department string, engagement_survey string").repartition(5)
    staged = staging.stage_rows(raw, run_id="auto")
    stamps = {(r.staged_at, r.etl_run_id) for r in staged.collect()} | {(r.staged_at, r.etl_run_id) for r in staged.collect()}
    assert len(stamps) == 1
    at, run_id = stamps.pop()
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - at).total_seconds()) < 600 and len(run_id) == 36
    assert staging.stage_rows(raw, run_id="auto").first().etl_run_id != run_id
    assert "etl_run_id" not in staging.stage_rows(raw).columns
    assert marts.survey_results(staged, run_id="auto").first().materialized_at >= at
