from stratum.functions.json_fields import json_number_fields, try_to_number, with_json_number_fields
from stratum.functions.scalars import (
    avg_exact, json_object, nullifzero, seconds_between, ts_literal,
)

__all__ = [
    "avg_exact", "json_number_fields", "json_object", "nullifzero", "seconds_between",
    "try_to_number", "ts_literal", "with_json_number_fields",
]
