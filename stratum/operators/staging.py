"""Raw -> staged rows: typed survey scores plus lineage stamps (INSERT ... SELECT)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.json_fields import with_json_number_fields
from stratum.functions.scalars import run_id_literal, ts_literal

# The five survey keys and the lineage names the staging step uses.
SURVEY_FIELDS = {
    "satisfaction_score": "satisfaction_score",
    "work_life_balance_score": "work_life_balance_score",
    "career_growth_score": "career_growth_score",
    "communication_score": "communication_score",
    "teamwork_score": "teamwork_score",
}
RAW_TABLE = "bronze.employee_data_parquet"
RAW_STREAM = "bronze.employee_data_parquet_stream"
STAGED_TABLE = "silver.employee_data_stg"
STAGED_REFRESHED = "silver.dt_employee_data_stg"


def lineage_stamps(as_of, source_object: str, run_id: str | None = None,
                   process_type: str | None = None, time_col: str = "staged_at") -> dict[str, Column]:
    """The stamp columns written beside each staged row.

    One value per load, never per-row volatile calls: given ones make a replayed
    load write identical rows. `as_of` None is the time of the call, `run_id`
    "auto" a new id; without a run id there is no such column.
    """
    stamps = {time_col: ts_literal(as_of), "source_object": F.lit(source_object)}
    if run_id is not None:
        stamps["etl_run_id"] = run_id_literal(run_id)
    if process_type is not None:
        stamps["etl_process_type"] = F.lit(process_type)
    return stamps


def stage_rows(raw: DataFrame, *, json_col: str = "engagement_survey",
               fields: Mapping[str, str] = SURVEY_FIELDS, as_of=None,
               source_object: str = RAW_TABLE, run_id: str | None = None,
               process_type: str | None = None, keep: Sequence[str] | None = None,
               filtered: bool = False, number: str = "bigint") -> DataFrame:
    """Every raw column (or `keep`), the numeric survey fields, then the stamps.

    Map-only: scan -> project, no shuffle. A malformed JSON text stages with
    NULL scores (use `quality.quarantine` to route such rows aside). `filtered`:
    the consumer filters on the scores (see `with_json_number_fields`). `number`:
    the scores' type; `json_fields.WIDE` keeps scores of up to 38 digits.
    """
    base = raw.select(*(keep or raw.columns))
    if json_col not in base.columns:
        base = base.withColumn(json_col, raw[json_col])
    staged = with_json_number_fields(base, json_col, fields, filtered=filtered, number=number)
    if keep is not None and json_col not in keep:
        staged = staged.drop(json_col)
    return staged.withColumns(lineage_stamps(as_of, source_object, run_id, process_type))


def evolve_schema(df: DataFrame, added: Sequence[tuple[str, str, object]]) -> DataFrame:
    """CREATE TABLE a LIKE b + ALTER TABLE a ADD COLUMN c T [DEFAULT x].

    `added` is a list of (name, spark type, default or None). Existing rows take
    the default, as an added column with a default does; the result keeps the
    source columns in order, then the added ones.
    """
    cols = {}
    for name, dtype, default in added:
        value = F.lit(None) if default is None else F.lit(default)
        cols[name] = value.cast(dtype)
    return df.withColumns(cols)


def empty_like(df: DataFrame, added: Sequence[tuple[str, str, object]] = ()) -> DataFrame:
    """An empty frame with df's schema plus `added` columns (the LIKE clause alone)."""
    return evolve_schema(df.limit(0), added)


def conform(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """INSERT INTO t (cols) SELECT ...: align `df` to `schema` by name.

    Columns of `schema` missing from `df` take their default (or NULL);
    extra columns of `df` are dropped; every column is cast to its target type.
    `keep`: fields of the file-metadata column to append, for a plain file scan.
    """
    defaults = defaults or {}
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in schema.fields:
        src = have.get(field.name.lower())
        if src is not None:
            out.append(F.col(src).cast(field.dataType).alias(field.name))
        else:
            out.append(F.lit(defaults.get(field.name)).cast(field.dataType).alias(field.name))
    return df.select(*out, *[F.col(f"_metadata.{k}") for k in keep])
