"""stratum: layered ELT operators (raw -> staged -> marts) on Spark DataFrames.

Every operator is a plain function from DataFrames to a DataFrame built from
Spark's own expressions, joins, aggregations and Structured Streaming. The
most used ones are re-exported here; see the README for the full map.
"""

__version__ = "0.1.0"

from stratum.functions.json_fields import flatten_object, json_number_fields, with_json_number_fields  # noqa: E402
from stratum.operators.changes import has_changes, snapshot_diff  # noqa: E402
from stratum.operators.marts import demographics, latest_k, row_count, survey_results  # noqa: E402
from stratum.operators.merge import insert_new_keys, merge_changes, merge_counts, semi_in, update_where_in  # noqa: E402
from stratum.operators.quality import (  # noqa: E402
    dq_trend, null_check, quality_score, quarantine, range_check, ref_check,
)
from stratum.operators.refresh import apply_delta, finalize, freshness, mart_state, refresh_mart  # noqa: E402
from stratum.operators.staging import conform, evolve_schema, stage_rows  # noqa: E402
from stratum.sources.files import load_by_name  # noqa: E402
from stratum.sources.tables import materialize, replace_table, truncate_table  # noqa: E402
from stratum.streaming.ingest import IncrementalPipeline, ingest_new_files  # noqa: E402

__all__ = [
    "IncrementalPipeline", "apply_delta", "conform", "demographics", "dq_trend", "evolve_schema",
    "finalize", "flatten_object", "freshness", "has_changes", "ingest_new_files", "insert_new_keys",
    "json_number_fields", "latest_k", "load_by_name", "mart_state", "materialize", "merge_changes",
    "merge_counts", "null_check", "quality_score", "quarantine", "range_check", "ref_check",
    "refresh_mart", "replace_table", "row_count", "semi_in", "snapshot_diff", "stage_rows",
    "survey_results", "truncate_table", "update_where_in", "with_json_number_fields",
]
