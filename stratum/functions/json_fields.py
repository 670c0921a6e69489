"""Numbers out of JSON text: parse, pick a key, read its text as a number, keep it whole.

Semantics kept from the reference's staging step:
  * malformed text (also single quotes, text after the value), missing key, JSON null -> NULL
  * "4", 4, " 5 "                                     -> 4, 4, 5
  * 3.6 / "4.6" / -4.5 / 1e2                          -> 4 / 5 / -5 / 100 (round half away from zero)
  * "n/a", true, {"x": 1}, "1,000"                    -> NULL
  * 99999999999                                       -> 99999999999 (64-bit, or up to 38 digits if asked for)

The text is parsed ONCE per row for all requested fields: `from_json` into a
struct whose fields are all strings (a number keeps its literal text, an
object its JSON text), then each field goes through `try_cast` to
decimal(38,0) (rounds half-up) and on to bigint. Everything stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


WIDE = "decimal(38,0)"


def try_to_number(text: Column, number: str = "bigint") -> Column:
    """Text -> whole number (rounded half away from zero); NULL when the text is not a number.

    `number`: WIDE keeps up to 38 digits; as bigint, wider numbers are NULL."""
    wide = text.try_cast(WIDE)
    return wide if number == WIDE else wide.try_cast(number)


# JSON as the standard has it: single-quoted strings are malformed.
STRICT = {"allowSingleQuotes": "false"}


def _parsed(json_text: Column, keys: Sequence[str]) -> Column:
    """The text as the elements of a list: a valid object is its only element, and text after
    it (which a parser reading one value would not see) makes the list malformed or longer."""
    return F.from_json(F.concat(F.lit("["), json_text, F.lit("]")), T.ArrayType(_string_struct(keys)), STRICT)


def parsed_object(json_text: Column, keys: Sequence[str]) -> Column:
    """The text's object as a struct of strings; NULL if the text is malformed or no object."""
    listed = _parsed(json_text, keys)
    return F.when(F.size(listed) == 1, F.get(listed, F.lit(0)))


def _field(parsed: Column, key: str) -> Column:
    return F.when(F.size(parsed) == 1, F.get(parsed, F.lit(0)).getField(key))


def _string_struct(keys: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(k, T.StringType(), True) for k in dict.fromkeys(keys)])


def json_number_fields(json_text: Column, fields: Mapping[str, str]) -> list[Column]:
    """One bigint column per `{output_name: json_key}`; parses the text once per row
    when used through `with_json_number_fields` (see there)."""
    parsed = _parsed(json_text, list(fields.values()))
    return [try_to_number(_field(parsed, key)).alias(name) for name, key in fields.items()]


def with_json_number_fields(df: DataFrame, json_col: str, fields: Mapping[str, str], *,
                            filtered: bool = True, number: str = "bigint") -> DataFrame:
    """Append the numeric fields of the JSON text column `json_col` to `df`.

    `filtered`: for consumers that filter on the fields (a range check, a reject
    rule). A generator (`explode` of a one-element array) makes the parsed
    struct, and predicates cannot be pushed beneath it; else one `from_json` per
    field per comparison would be. Without it the struct is a projection of its
    own: still one parse per row, as the optimizer doesn't inline it into the
    fields, and a consumer that reads no field neither parses nor reads the
    text. A NULL or malformed text yields its row, with NULL fields. `number`:
    the fields' type (see `try_to_number`).
    """
    if not fields:
        return df
    tmp = "__json_fields"
    parsed = _parsed(F.col(json_col), list(fields.values()))
    if filtered:
        parsed = F.explode(F.array(parsed))
    return df.select(*[F.col(c) for c in df.columns], parsed.alias(tmp)).select(
        *[F.col(c) for c in df.columns],
        *[try_to_number(_field(F.col(tmp), key), number).alias(name) for name, key in fields.items()],
    )


def flatten_object(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten a JSON object laterally: one row per key with the value's text
    (strings unquoted, nested values as compact JSON, JSON null as NULL).
    A key given twice yields two rows. Rows whose text is not a JSON object yield no rows."""
    listed = F.from_json(F.concat(F.lit("["), F.col(json_col), F.lit("]")), T.ArrayType(T.MapType(T.StringType(), T.StringType())), STRICT)
    as_map = F.when(F.size(listed) == 1, F.get(listed, F.lit(0)))  # text after the object makes the list malformed or longer
    return df.select(*keep, F.explode(as_map).alias("key", "value"))


def flatten_array(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten a JSON array laterally: one row per element with its place (from 0) and text
    (strings unquoted, nested values as compact JSON, JSON null as NULL).
    Rows whose text is not a JSON array yield no rows."""
    listed = F.from_json(F.concat(F.lit("["), F.col(json_col), F.lit("]")), T.ArrayType(T.ArrayType(T.StringType())), STRICT)
    as_list = F.when(F.size(listed) == 1, F.get(listed, F.lit(0)))
    is_list = F.ltrim(F.col(json_col)).startswith("[")  # a lone value would be read as a list of one
    return df.select(*keep, F.posexplode(F.when(is_list, as_list)).alias("pos", "value"))
