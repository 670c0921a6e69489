"""Refreshed tables kept current from a change feed (self-maintained aggregates).

A mart made of COUNT, SUM and AVG is kept as additive state per group:
a row count, and for each average an exact sum and a non-NULL count. A change
feed turns into the same state with signed weights (+1 INSERT, -1 DELETE);
adding the two states group by group and dropping groups whose row count
reaches 0 gives exactly the mart a full recompute would give (the counting
algorithm for view maintenance). Averages are divided only at the end, so
deletes never leave rounding residue.

Work per refresh is one aggregation of the feed plus one aggregation over
(state rows + delta rows) -- both tiny next to the table -- instead of a
rescan of the staged table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.scalars import limbs, limbs_total, nullifzero, seconds_between
from stratum.operators.marts import SCORE_AVERAGES, to_number

ROWS = "__rows"


@dataclass(frozen=True)
class Measure:
    """kind: 'count' (rows), 'sum' (of expr), 'avg' (of a 64-bit expr, NULLs skipped) or 'avg_wide' (of a decimal(38,0))."""
    name: str
    kind: str
    expr: Column | None = None


def demographics_measures(age: str = "age", service: str = "length_of_service",
                          gender: str = "gender") -> list[Measure]:
    g = F.upper(F.col(gender))
    return [
        Measure("num_employees", "count"),
        Measure("avg_age", "avg", to_number(F.col(age))),
        Measure("avg_length_of_service", "avg", to_number(F.col(service))),
        Measure("num_male", "sum", F.when(g == "MALE", 1).otherwise(0)),
        Measure("num_female", "sum", F.when(g == "FEMALE", 1).otherwise(0)),
        Measure("num_other_gender", "sum", F.when(~g.isin("MALE", "FEMALE"), 1).otherwise(0)),
    ]


def survey_measures(scores: Mapping[str, str] = SCORE_AVERAGES, wide: bool = False) -> list[Measure]:
    return [*[Measure(out, "avg_wide" if wide else "avg", nullifzero(F.col(src))) for out, src in scores.items()],
            Measure("num_responses", "count")]


def mart_state(rows: DataFrame, group: Sequence[str], measures: Sequence[Measure],
               weight: Column | None = None) -> DataFrame:
    """Additive state per group; `weight` (+1/-1) turns a change feed into a delta."""
    w = F.lit(1) if weight is None else weight
    aggs = [F.sum(w).cast("bigint").alias(ROWS)]
    for m in measures:
        if m.kind == "sum":
            aggs.append(F.sum(w * m.expr).cast("bigint").alias(m.name))
        elif m.kind == "avg":
            # Wide: a sum of many 64-bit values can leave the 64-bit range.
            aggs.append(F.sum(w * m.expr.cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"{m.name}__sum"))
            aggs.append(F.sum(F.when(m.expr.isNotNull(), w).otherwise(0)).cast("bigint").alias(f"{m.name}__n"))
        elif m.kind == "avg_wide":
            aggs += [F.sum(w * x).cast("decimal(38,0)").alias(f"{m.name}__{end}__sum") for end, x in zip(("high", "low"), limbs(m.expr))]
            aggs.append(F.sum(F.when(m.expr.isNotNull(), w).otherwise(0)).cast("bigint").alias(f"{m.name}__n"))
    return rows.groupBy(*group).agg(*aggs)


def _state_columns(measures: Sequence[Measure]) -> list[str]:
    cols = [ROWS]
    for m in measures:
        if m.kind == "sum":
            cols.append(m.name)
        elif m.kind == "avg":
            cols += [f"{m.name}__sum", f"{m.name}__n"]
        elif m.kind == "avg_wide":
            cols += [f"{m.name}__high__sum", f"{m.name}__low__sum", f"{m.name}__n"]
    return cols


def apply_delta(state: DataFrame, delta: DataFrame, group: Sequence[str],
                measures: Sequence[Measure]) -> DataFrame:
    """state + delta per group (NULL group keys match each other); empty groups vanish."""
    cols = _state_columns(measures)
    return (state.select(*group, *cols).unionByName(delta.select(*group, *cols))
            .groupBy(*group).agg(*[F.sum(c).cast("decimal(38,0)" if c.endswith("__sum") else "bigint").alias(c) for c in cols])
            .filter(F.col(ROWS) > 0))


def finalize(state: DataFrame, group: Sequence[str], measures: Sequence[Measure],
             stamps: Mapping[str, Column] | None = None) -> DataFrame:
    out = [F.col(g) for g in group]
    for m in measures:
        if m.kind == "count":
            out.append(F.col(ROWS).alias(m.name))
        elif m.kind == "sum":
            out.append(F.col(m.name))
        elif m.kind == "avg_wide":
            total = limbs_total(F.col(f"{m.name}__high__sum"), F.col(f"{m.name}__low__sum"))[1]
            out.append(F.try_divide(total, F.col(f"{m.name}__n").cast("double")).alias(m.name))
        else:
            out.append(F.try_divide(F.col(f"{m.name}__sum").cast("double"),
                                    F.col(f"{m.name}__n").cast("double")).alias(m.name))
    return state.select(*out).withColumns(dict(stamps or {}))


def refresh_mart(state: DataFrame, feed_rows: DataFrame, weight: Column, group: Sequence[str],
                 measures: Sequence[Measure]) -> DataFrame:
    """New state after applying a (staged) change feed."""
    return apply_delta(state, mart_state(feed_rows, group, measures, weight), group, measures)


def freshness(history: DataFrame, *, name: str = "name", data_ts: str = "data_timestamp",
              end_ts: str = "refresh_end_time", state: str = "state", order_tie: str = "query_id",
              target_lag_sec: int = 300, pattern: str | None = "DT_%") -> DataFrame:
    """Per refreshed table: schema, target lag, newest data time, last state with its code and message (where the history has them), lag statistics.

    Lag of a refresh = seconds from its data timestamp to its completion.
    `time_within_target_lag_ratio` is the share of refreshes completed within
    the target; `maximum_lag_sec` the worst lag. A refresh that is still running (no end
    time) does not count. All bounded aggregates.
    """
    h = history.filter(F.col(end_ts).isNotNull())
    h = h.filter(F.col(name).like(pattern)) if pattern else h
    lag = seconds_between(F.col(data_ts), F.col(end_ts))
    ok = F.col(state) == "SUCCEEDED"
    also = {"schema_name": "schema_name", "state_code": "last_completed_refresh_state_code", "state_message": "last_completed_refresh_state_message"}
    last = lambda c: F.max_by(F.col(c), F.struct(F.col(data_ts), F.col(order_tie)))
    return (
        h.groupBy(name)
        .agg(*[last(c).alias(out) for c, out in also.items() if c in history.columns],
             F.max(F.when(ok, F.col(data_ts))).alias("latest_data_timestamp"),
             last(state).alias("last_completed_refresh_state"),
             F.try_divide(F.sum(F.when(lag <= target_lag_sec, 1).otherwise(0)).cast("double"),
                          F.count(lag).cast("double")).alias("time_within_target_lag_ratio"),
             F.max(lag).alias("maximum_lag_sec"))
        .withColumn("target_lag_sec", F.lit(target_lag_sec).cast("bigint"))
    )
