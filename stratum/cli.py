"""Job entry points, for `spark-submit` or `python -m stratum.cli`.

    stratum.cli run     --root R --landing L --schema "k bigint, ..." --run-id ID --as-of TS [--pattern GLOB]
    stratum.cli marts   --staged PATH --out PATH --as-of TS --run-id ID
    stratum.cli checks  --raw PATH --staged PATH --results PATH --as-of TS

`run` is one scheduled run of the incremental pipeline (ingest new files,
MERGE, advance marts, log the run); `marts` rebuilds both marts from a stored
staged table; `checks` runs the null and range checks and appends their
result rows. The session comes from the submitter (cluster settings,
`spark.checkpoint.dir`); only a bare local run builds one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def _spark() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from stratum.session import get_session
    return get_session()


def _run(args) -> dict:
    from stratum.streaming.ingest import IncrementalPipeline
    schema = T._parse_datatype_string(args.schema)
    p = IncrementalPipeline(_spark(), args.root, args.landing, schema, key=args.key,
                            pattern=args.pattern, group=args.group)
    return p.run(args.run_id, args.as_of)


def _marts(args) -> dict:
    from stratum.operators import marts
    from stratum.sources import tables
    spark = _spark()
    staged = spark.read.parquet(args.staged)
    out = args.out.rstrip("/")
    tables.replace_table(marts.demographics(staged, as_of=args.as_of, run_id=args.run_id), f"{out}/demographics")
    tables.replace_table(marts.survey_results(staged, as_of=args.as_of, run_id=args.run_id), f"{out}/survey_results")
    return {"demographics": f"{out}/demographics", "survey_results": f"{out}/survey_results"}


def _checks(args) -> dict:
    from stratum.operators import quality, staging
    from stratum.sources import tables
    spark = _spark()
    raw, staged = spark.read.parquet(args.raw), spark.read.parquet(args.staged)
    nulls = quality.null_check(raw, "employee_number", sample=[("employee_name", "employee_name")],
                               check_name="null_employee_number", layer="bronze",
                               table_name=staging.RAW_TABLE, as_of=args.as_of)
    sample = [("employee_number", "employee_number"), ("department", "department"),
              ("satisfaction", "satisfaction_score"), ("work_life", "work_life_balance_score"),
              ("career", "career_growth_score"), ("communication", "communication_score"),
              ("teamwork", "teamwork_score"), ("staged_at", "staged_at"),
              ("source_object", "source_object"), ("etl_run_id", "etl_run_id")]
    ranges = quality.range_check(staged, list(staging.SURVEY_FIELDS), sample=sample,
                                 check_name="invalid_survey_range", layer="silver",
                                 table_name=staging.STAGED_TABLE, as_of=args.as_of)
    results = nulls.unionByName(ranges).select(*quality.RESULT_COLUMNS)
    tables.append_rows(results, args.results)
    return {r.check_name: r.issue_count for r in spark.read.parquet(args.results)
            .filter(f"checked_at = timestamp_ntz'{args.as_of}'").collect()}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stratum.cli")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--root", required=True)
    r.add_argument("--landing", required=True)
    r.add_argument("--schema", required=True, help="DDL of the raw table, e.g. 'employee_number bigint, ...'")
    r.add_argument("--run-id", required=True)
    r.add_argument("--as-of", required=True)
    r.add_argument("--pattern", default="employee_data_part_*.parquet")
    r.add_argument("--key", default="employee_number")
    r.add_argument("--group", default="department")
    m = sub.add_parser("marts")
    m.add_argument("--staged", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--as-of", required=True)
    m.add_argument("--run-id", required=True)
    c = sub.add_parser("checks")
    c.add_argument("--raw", required=True)
    c.add_argument("--staged", required=True)
    c.add_argument("--results", required=True)
    c.add_argument("--as-of", required=True)
    args = ap.parse_args(argv)
    result = {"run": _run, "marts": _marts, "checks": _checks}[args.cmd](args)
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
