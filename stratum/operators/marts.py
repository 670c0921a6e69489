"""Grouped summary tables (the "gold" marts) and small read-side operators.

All marts are one hash aggregation: partial aggregation on each task, one
shuffle of (group key, partial state), final aggregation. Group keys of low
cardinality and heavy skew (a department holding a third of the rows) are
therefore harmless: each task ships one partial row per key.

Averages are computed as exact integer sums divided once as double
(`avg_exact`), so they do not depend on the order partial sums are merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.json_fields import WIDE
from stratum.functions.scalars import avg_exact, avg_wide, nullifzero, run_id_literal, ts_literal
from stratum.operators.staging import STAGED_TABLE, SURVEY_FIELDS

SCORE_AVERAGES = {f"avg_{name}": name for name in SURVEY_FIELDS}


def to_number(c: Column) -> Column:
    """x::NUMBER for a double: round half away from zero to a whole number (bigint)."""
    return F.round(c, 0).cast("bigint")


def mart_stamps(as_of, run_id: str | None, source_object: str = STAGED_TABLE,
                process_type: str | None = None) -> dict[str, Column]:
    stamps = {"materialized_at": ts_literal(as_of), "source_object": F.lit(source_object)}
    if run_id is not None:
        stamps["etl_run_id"] = run_id_literal(run_id)
    if process_type is not None:
        stamps["etl_process_type"] = F.lit(process_type)
    return stamps


def gender_counts(gender: Column) -> list[Column]:
    """Conditional counts on the upper-cased gender; a NULL gender counts in none of the three."""
    g = F.upper(gender)
    return [
        F.sum(F.when(g == "MALE", 1).otherwise(0)).cast("bigint").alias("num_male"),
        F.sum(F.when(g == "FEMALE", 1).otherwise(0)).cast("bigint").alias("num_female"),
        F.sum(F.when(~g.isin("MALE", "FEMALE"), 1).otherwise(0)).cast("bigint").alias("num_other_gender"),
    ]


def demographics(staged: DataFrame, *, group: str = "department", age: str = "age",
                 service: str = "length_of_service", gender: str = "gender",
                 as_of=None, run_id: str | None = None,
                 source_object: str = STAGED_TABLE, process_type: str | None = None, ordered: bool = False) -> DataFrame:
    """Head count, mean rounded age and service, and gender counts per group; `ordered` by group, for a result that is read at once."""
    mart = (
        staged.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("num_employees"),
            avg_exact(to_number(F.col(age))).alias("avg_age"),
            avg_exact(to_number(F.col(service))).alias("avg_length_of_service"),
            *gender_counts(F.col(gender)),
        )
        .withColumns(mart_stamps(as_of, run_id, source_object, process_type))
    )
    return mart.orderBy(group) if ordered else mart


def survey_results(staged: DataFrame, *, group: str = "department",
                   scores: Mapping[str, str] = SCORE_AVERAGES, as_of=None,
                   run_id: str | None = None, source_object: str = STAGED_TABLE,
                   process_type: str | None = None) -> DataFrame:
    """Mean of each score with 0 treated as missing (a zero-as-missing average), and the row count.
    Scores of type decimal(38,0) are summed in two limbs."""
    types = dict(staged.dtypes)
    mean = {src: avg_wide if types[src] == WIDE else avg_exact for src in scores.values()}
    return (
        staged.groupBy(group)
        .agg(
            *[mean[src](nullifzero(F.col(src))).alias(out) for out, src in scores.items()],
            F.count(F.lit(1)).alias("num_responses"),
        )
        .withColumns(mart_stamps(as_of, run_id, source_object, process_type))
    )


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """SELECT COUNT(*) AS name FROM df (one row)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def latest_k(df: DataFrame, order_col: str, k: int, tie_break: Sequence[str] = (),
             columns: Sequence[str] | None = None) -> DataFrame:
    """ORDER BY order_col DESC LIMIT k with an explicit total order.

    Planned as TakeOrderedAndProject: each task keeps its own top k, the
    driver merges at most k rows per task -- never a full sort.
    """
    order = [F.col(order_col).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    out = df.orderBy(*order).limit(k)
    return out.select(*columns) if columns else out
