"""Marts kept in a stream's state: signed rows in several refreshes, restarts, groups that vanish."""

from pyspark.sql import functions as F

from stratum.operators import refresh
from stratum.session import work_dir
from stratum.streaming.mart_stream import MartStream

SCHEMA = "department string, age double, length_of_service double, gender string"


def _stream(spark, root):
    return MartStream(spark, root, f"{root}/feed", spark.createDataFrame([], SCHEMA).schema, ["department"], refresh.demographics_measures())


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA + ", _w int")


def test_refreshes_and_restarts(spark):
    root = work_dir(spark, "t_mart_stream")
    _stream(spark, root).append(_rows(spark, [("a", 30.0, 1.0, "male", 1), ("a", None, 2.0, None, 1), ("b", 50.4, 3.0, "Female", 1), (None, 9.0, 1.0, "x", 1)]))
    _stream(spark, root).refresh()
    first = {r.department: r for r in _stream(spark, root).mart().collect()}
    assert {d: (r.num_employees, r.avg_age, r.num_male, r.num_female, r.num_other_gender) for d, r in first.items()} == {
        "a": (2, 30.0, 1, 0, 0), "b": (1, 50.0, 0, 1, 0), None: (1, 9.0, 0, 0, 1)}
    _stream(spark, root).append(_rows(spark, [("b", 50.4, 3.0, "Female", -1), ("a", None, 2.0, None, -1), ("a", 41.0, 2.0, "other", 1)]))
    _stream(spark, root).append(_rows(spark, [("c", None, None, None, 1)]))
    _stream(spark, root).refresh(max_files_per_trigger=1)
    _stream(spark, root).refresh()  # nothing new
    second = {r.department: (r.num_employees, r.avg_age, r.avg_length_of_service) for r in _stream(spark, root).mart({"as_of": F.lit("x")}).collect()}
    assert second == {"a": (2, 35.5, 1.5), "c": (1, None, None), None: (1, 9.0, 1.0)}


def test_earlier_files_are_not_read_again(spark):
    import glob
    root = work_dir(spark, "t_mart_stream")
    _stream(spark, root).append(_rows(spark, [("a", 30.0, 1.0, "male", 1)]))
    _stream(spark, root).refresh()
    for f in glob.glob(f"{root.removeprefix('file:')}/feed/*.parquet"):
        open(f, "wb").write(b"broken")
    _stream(spark, root).append(_rows(spark, [("a", 40.0, 1.0, "male", 1)]))
    _stream(spark, root).refresh()
    assert [(r.num_employees, r.avg_age) for r in _stream(spark, root).mart().collect()] == [(2, 35.0)]
