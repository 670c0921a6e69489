"""Inputs for the registered queries, derived from the driver's tables.

The reference's own input files are not public, so its concepts are mapped
onto the given tables (employee -> event or order, department -> event type
or order priority, survey JSON -> text built from each row). Dirty cases the
clean tables lack (NULL keys, malformed JSON, wide numbers, a before/after
pair of snapshots) are derived from key arithmetic on every row, so each
query still reads whole tables and its work grows with them.

Each derivation is written once as SQL expressions that Spark (`selectExpr`)
and the DuckDB oracle both accept, so both sides see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values used by every query: "now" and the run ids.
AS_OF = "2024-01-31 00:00:00"
PREVIOUS_AS_OF = "2024-01-30 00:00:00"
RUN_ID = "run-0001"
PREVIOUS_RUN_ID = "run-0000"

# Survey JSON per event row. Most rows carry all five keys with mixed number
# spellings; every 101st row is malformed, every 103rd has text and a boolean,
# every 107th has a fraction, a negative half, an object and an 11-digit value.
SURVEY_FROM_EVENT = """CASE
  WHEN event_id % 101 = 0 THEN '{bad'
  WHEN event_id % 103 = 0 THEN '{"satisfaction_score": "n/a", "teamwork_score": true}'
  WHEN event_id % 107 = 0 THEN '{"satisfaction_score": 3.6, "work_life_balance_score": "4", "career_growth_score": -4.5, "communication_score": {"x": 1}, "teamwork_score": 99999999999}'
  ELSE replace(replace(props, '"k"', '"satisfaction_score"'), '}',
       concat(', "work_life_balance_score": ', cast(user_id % 6 AS string),
              ', "career_growth_score": "', cast(event_id % 5 + 1 AS string),
              '", "communication_score": ', cast(event_id % 6 AS string), '.5',
              ', "teamwork_score": ', CASE WHEN user_id % 4 = 0 THEN 'null' ELSE cast(user_id % 5 + 1 AS string) END,
              '}'))
END"""

RAW_FROM_EVENTS = [
    "event_id AS employee_number",
    "concat('user-', cast(user_id AS string)) AS employee_name",
    "CASE user_id % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'FEMALE' ELSE 'other' END AS gender",
    "concat('city-', cast(user_id % 10 AS string)) AS city",
    "concat('job-', cast(user_id % 4 AS string)) AS job_title",
    "event_type AS department",
    "concat('store-', cast(user_id % 7 AS string)) AS store_location",
    "'retail' AS business_unit",
    "'operations' AS division",
    "value AS age",
    "cast(user_id % 40 AS double) + 0.5 AS length_of_service",
    "value / 4 AS hours_absent",
    f"{SURVEY_FROM_EVENT} AS engagement_survey",
]

# Orders as employees: NULL keys (every 97th), NULL names (13th), NULL gender
# (89th) and NULL department (83rd); ages are prices / 1000, rounded when used.
RAW_FROM_ORDERS = [
    "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS employee_number",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('cust-', cast(o_custkey AS string)) END AS employee_name",
    "CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Male' "
    "WHEN o_orderstatus = 'O' THEN 'FEMALE' ELSE 'other' END AS gender",
    "concat('city-', cast(o_custkey % 10 AS string)) AS city",
    "'clerk' AS job_title",
    "CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderpriority END AS department",
    "concat('store-', cast(o_custkey % 7 AS string)) AS store_location",
    "'retail' AS business_unit",
    "'operations' AS division",
    "o_totalprice / 1000 AS age",
    "cast(o_custkey % 40 AS double) + 0.5 AS length_of_service",
    "cast(o_custkey % 9 AS double) AS hours_absent",
    "concat('{\"satisfaction_score\": ', cast(o_custkey % 7 AS string), '}') AS engagement_survey",
]

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

# A change scenario over the whole orders table: "before" is the table as it
# stood before the 2001 orders arrived; "after" is today's table, in which
# low-priority pending orders were cancelled (deleted) and open urgent orders
# repriced (updated). Every row of orders is read for both snapshots.
BEFORE_FILTER = "o_orderdate < DATE '2001-01-01'"
AFTER_FILTER = "NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"
AFTER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus",
    "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1 "
    "ELSE o_totalprice END AS o_totalprice",
    "o_orderdate", "o_orderpriority",
]

# Landing files are exported per department: upload group 1..5 by department name.
UPLOAD_GROUP = ("CASE department WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 "
                "WHEN 'signup' THEN 4 ELSE 5 END")

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
# The same for events: "before" is the stream up to 24 January; "after" has
# the later events, drops retracted low-value error events and reassigns
# high-value purchases to another user.
EVENTS_BEFORE_FILTER = "ts < DATE '2024-01-25'"
EVENTS_AFTER_FILTER = "NOT (event_type = 'error' AND value < 5)"
EVENTS_AFTER_COLUMNS = [
    "event_id", "ts",
    "CASE WHEN event_type = 'purchase' AND value >= 25 THEN user_id + 1 ELSE user_id END AS user_id",
    "event_type", "value", "props",
]

# Orders whose customer key points outside every customer (shifted by 1,000,000).
ORDERS_WITH_ORPHANS = [
    "o_orderkey",
    "CASE WHEN o_orderkey % 31 = 0 THEN o_custkey + 1000000 "
    "WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey",
    "o_orderstatus", "o_totalprice",
]


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table; `spread` applies the parallelism floor for inputs of
    JSON-heavy steps (every table here is a single row group)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        from stratum.sources.tables import spread_input
        df = spread_input(df)
    return df


def raw_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", spread=True).selectExpr(*RAW_FROM_EVENTS)


def raw_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*RAW_FROM_ORDERS)


def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(BEFORE_FILTER).select(*ORDER_COLUMNS)


def orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(AFTER_FILTER).selectExpr(*AFTER_COLUMNS)


def events_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(EVENTS_BEFORE_FILTER).select(*EVENT_COLUMNS)


def events_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(EVENTS_AFTER_FILTER).selectExpr(*EVENTS_AFTER_COLUMNS)


def sql_select(exprs: list[str], source: str, where: str | None = None) -> str:
    """The same derivation as DuckDB SQL text, for the oracles."""
    body = ",\n  ".join(exprs)
    return f"SELECT\n  {body}\nFROM {source}" + (f"\nWHERE {where}" if where else "")
