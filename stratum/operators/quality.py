"""Data-quality checks: issue counts with bounded samples, rejects, scores, trends.

A check result row is (check_name, layer, table_name, issue_count,
sample_details JSON, checked_at). All checks of a table are one global
aggregation over one scan (`check_suite`): per check a conditional count and
the 10 smallest failing rows, kept in a bounded priority queue by Spark's own
top-k aggregate. A task hands on one row, however many rows fail; nothing is
sorted, shuffled by key or written aside.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from stratum.functions.scalars import ts_literal

RESULT_COLUMNS = ["check_name", "layer", "table_name", "issue_count", "sample_details", "checked_at"]


def out_of_range(c: Column, lo: int = 1, hi: int = 5) -> Column:
    """COALESCE(x, 0) NOT BETWEEN lo AND hi: NULL counts as out of range."""
    return ~F.coalesce(c, F.lit(0)).between(lo, hi)


def any_of(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


@dataclass(frozen=True)
class Check:
    """One rule: rows where `failed` is true are issues; `sample` = [(json key, column)] are the fields kept of them."""
    name: str
    failed: Column
    sample: Sequence[tuple[str, Column | str]]
    array_key: str
    layer: str
    table_name: str


def smallest(rows: Column, k: int) -> Column:
    """The `k` smallest non-NULL values in ascending order (of structs: by their fields in turn, NULLs
    first); an aggregate that holds k values at most."""
    return InternalFunction.collect_top_k(rows, k, True)


def check_suite(df: DataFrame, checks: Sequence[Check], *, as_of, limit: int = 10) -> DataFrame:
    """One result row for each check, all from one scan of `df`.

    `issue_count` is exact; up to `limit` issue rows, the smallest in the order
    of the sample's fields (NULLs first), become `{array_key: [...]}` with
    NULL-valued keys left out. `rows_checked` is the number of rows seen. An
    empty table gives counts of 0 and empty samples.
    """
    failed = [F.coalesce(c.failed, F.lit(False)) for c in checks]
    samples = [F.struct(*[(F.col(x) if isinstance(x, str) else x).alias(k) for k, x in c.sample]) for c in checks]
    # Rules and samples are evaluated once a row, beneath the aggregate.
    flagged = df.select(*[f.alias(f"__f{i}") for i, f in enumerate(failed)],
                        *[F.when(f, s).alias(f"__s{i}") for i, (f, s) in enumerate(zip(failed, samples))])
    counted = flagged.agg(F.count(F.lit(1)).alias("__rows"),
                          *[F.count_if(F.col(f"__f{i}")).alias(f"__n{i}") for i in range(len(checks))],
                          *[smallest(F.col(f"__s{i}"), limit).alias(f"__t{i}") for i in range(len(checks))])
    rows = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.layer).alias("layer"), F.lit(c.table_name).alias("table_name"),
                     F.col(f"__n{i}").alias("issue_count"), F.to_json(F.struct(F.col(f"__t{i}").alias(c.array_key))).alias("sample_details"))
            for i, c in enumerate(checks)]
    return (counted.select("__rows", F.explode(F.array(*rows)).alias("__c"))
            .select("__c.*", ts_literal(as_of).alias("checked_at"), F.col("__rows").alias("rows_checked")))


def with_reference(df: DataFrame, fk: str, parent: DataFrame, pk: str, flag: str) -> DataFrame:
    """`df` with a boolean column: is `fk` a value that `parent` lacks? (NULL is not.) One left join with the
    distinct keys, which Spark broadcasts if their measured size is small; rows with a NULL key are spread by a row hash."""
    spread = F.when(F.col(fk).isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("bigint"))
    known = parent.select(F.col(pk).alias("__pk")).filter("__pk IS NOT NULL").distinct().withColumn("__zero", F.lit(0).cast("bigint"))
    joined = df.withColumn("__spread", spread).join(known, (F.col(fk) == F.col("__pk")) & (F.col("__spread") == F.col("__zero")), "left")
    return joined.select(*df.columns, (F.col(fk).isNotNull() & F.col("__pk").isNull()).alias(flag))


def suite_score(results: DataFrame) -> DataFrame:
    """Per check of a suite: rows checked, rows failing, and the passing share."""
    return results.select("check_name", "table_name", "rows_checked", "issue_count",
                          F.try_divide((F.col("rows_checked") - F.col("issue_count")).cast("double"),
                                       F.col("rows_checked").cast("double")).alias("quality_score"))


def issue_report(issues: DataFrame, *, check_name: str, layer: str, table_name: str,
                 sample: Sequence[tuple[str, Column | str]], array_key: str, as_of, limit: int = 10) -> DataFrame:
    """One result row for the issue rows `issues`: a suite of one check that every row fails."""
    check = Check(check_name, F.lit(True), sample, array_key, layer, table_name)
    return check_suite(issues, [check], as_of=as_of, limit=limit).select(*RESULT_COLUMNS)


def null_check(df: DataFrame, column: str, *, sample: Sequence[tuple[str, Column | str]],
               check_name: str, layer: str, table_name: str, as_of, limit: int = 10) -> DataFrame:
    """Rows whose `column` is NULL: count and `{"sample_rows": [...]}`."""
    return issue_report(df.filter(F.col(column).isNull()), check_name=check_name, layer=layer,
                        table_name=table_name, sample=sample, array_key="sample_rows", as_of=as_of, limit=limit)


def range_check(df: DataFrame, columns: Sequence[str], *, sample: Sequence[tuple[str, Column | str]],
                check_name: str, layer: str, table_name: str, as_of, lo: int = 1, hi: int = 5,
                limit: int = 10) -> DataFrame:
    """Rows with any of `columns` outside [lo, hi] or NULL: count and `{"bad_rows": [...]}`."""
    bad = any_of([out_of_range(F.col(c), lo, hi) for c in columns])
    return issue_report(df.filter(bad), check_name=check_name, layer=layer, table_name=table_name,
                        sample=sample, array_key="bad_rows", as_of=as_of, limit=limit)


def ref_check(df: DataFrame, fk: str, parent: DataFrame, pk: str, *, sample: Sequence[tuple[str, Column | str]],
              check_name: str, layer: str, table_name: str, as_of, limit: int = 10) -> DataFrame:
    """Referential integrity: non-NULL `fk` values with no `pk` in `parent` (left anti join).

    NULL foreign keys are not violations and never enter the join.
    """
    orphans = df.filter(F.col(fk).isNotNull()).join(
        parent.select(F.col(pk).alias(fk)), on=fk, how="left_anti")
    return issue_report(orphans, check_name=check_name, layer=layer, table_name=table_name,
                        sample=sample, array_key="sample_rows", as_of=as_of, limit=limit)


def quarantine(df: DataFrame, rules: Mapping[str, Column], reason_col: str = "reject_reason"
               ) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, rejected); rejected rows carry the failed rule names,
    comma-separated in rule order. One pass per side, map-only."""
    reasons = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    tagged = df.withColumn(reason_col, reasons)
    return (tagged.filter(F.col(reason_col) == "").drop(reason_col),
            tagged.filter(F.col(reason_col) != ""))


def quality_score(df: DataFrame, checks: Mapping[str, Column], *, table_name: str) -> DataFrame:
    """Per check: rows checked, rows failing, and the passing share -- all checks
    in one scan (one global aggregate), then one output row per check."""
    aggs = [F.count(F.lit(1)).alias("rows_checked")]
    aggs += [F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in checks.items()]
    counted = df.agg(*aggs).unpivot("rows_checked", list(checks), "check_name", "issue_count")
    return counted.select(
        "check_name", F.lit(table_name).alias("table_name"), "rows_checked", "issue_count",
        F.try_divide((F.col("rows_checked") - F.col("issue_count")).cast("double"),
                     F.col("rows_checked").cast("double")).alias("quality_score"))


def latest_results(results: DataFrame, k: int = 50) -> DataFrame:
    """SELECT * FROM results ORDER BY checked_at DESC LIMIT k (ties by check and table)."""
    return results.orderBy(F.col("checked_at").desc(), F.col("check_name").asc(),
                           F.col("table_name").asc()).limit(k)


def dq_trend(results: DataFrame) -> DataFrame:
    """Audit over time: per check and day, runs, total and worst issue counts."""
    return (results.groupBy("check_name", "table_name", F.to_date("checked_at").alias("check_date"))
            .agg(F.count(F.lit(1)).alias("runs"),
                 F.sum("issue_count").cast("bigint").alias("total_issues"),
                 F.max("issue_count").alias("max_issues")))
