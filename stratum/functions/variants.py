"""JSON kept as VARIANT: parsed once when a row is loaded, read by path ever after.

`parsed` turns text into a VARIANT column, which Parquet stores; `number_at` and
`text_at` read it by path without parsing. Malformed text (single quotes, text
after the value, a key given twice) is NULL, as everywhere in this library.
`flatten_deep` lists every value of nested objects and arrays, at any depth.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.json_fields import try_to_number


def parsed(json_text: Column) -> Column:
    """JSON text as VARIANT, NULL if malformed. It is read as the only element of a list: the
    parser would not look at what stands after a lone value."""
    listed = F.try_parse_json(F.concat(F.lit("["), json_text, F.lit("]")))
    return F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))


def with_variant(df: DataFrame, json_col: str, variant_col: str) -> DataFrame:
    """`df` with the text column replaced by a VARIANT column (one parse per row, at the load)."""
    return df.select(*[F.col(c) for c in df.columns if c != json_col], parsed(F.col(json_col)).alias(variant_col))


def text_at(variant: Column, path: str) -> Column:
    """The text of the value at `path` (strings unquoted, nested values as JSON); NULL if absent or JSON null."""
    return F.try_variant_get(variant, path, "string")


def number_at(variant: Column, path: str) -> Column:
    """The value at `path` as a whole number, by the rules of `json_fields.try_to_number`."""
    return try_to_number(text_at(variant, path))


def with_variant_numbers(df: DataFrame, variant_col: str, fields: Mapping[str, str]) -> DataFrame:
    """Append one number column per `{output name: key}` of a VARIANT column."""
    return df.withColumns({name: number_at(F.col(variant_col), f"$.{key}") for name, key in fields.items()})


def flatten_deep(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten nested JSON laterally: one row for every value below the top, at any depth.

    Columns: `keep`, path (`$.a[0].b`), pos (place in an array from 0, NULL in an
    object), key (NULL in an array), value (text: strings unquoted, nested
    values as JSON, JSON null as NULL) and is_nested. Text that is malformed, or
    neither object nor array, gives no rows. `json_col` may be text or VARIANT.

    Each level is written once and exploded to the next, until none is nested:
    work grows with the values listed, rounds with the depth only.
    """
    from stratum.session import work_dir
    from stratum.sources.tables import materialize
    spark = df.sparkSession
    variant = F.col(json_col) if dict(df.dtypes)[json_col] == "variant" else parsed(F.col(json_col))
    level, levels = df.select(*keep, F.lit("$").alias("path"), variant.alias("__v")), []
    step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("key")))
    while True:
        rows = level.filter("__v IS NOT NULL").lateralJoin(spark.tvf.variant_explode(F.col("__v").outer()))
        rows = rows.select(*keep, F.concat("path", step).alias("path"), F.when(F.col("key").isNull(), F.col("pos")).alias("pos"), "key",
                           F.col("value").alias("__v"), F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)<").alias("is_nested"))
        rows = materialize(rows, work_dir(spark, "flatten"))
        levels.append(rows.select(*keep, "path", "pos", "key", F.col("__v").cast("string").alias("value"), "is_nested"))
        level = rows.filter("is_nested").select(*keep, "path", "__v")
        if level.isEmpty():
            break
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    return every
