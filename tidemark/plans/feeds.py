"""Input feeds derived from the given tables.

The raw change feed is written once, in SQL that Spark and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.spec import HistorySpec

RAW_SQL = """
select
  case when event_id % 97 = 0 then null else 'U' || lpad(cast(user_id as string), 5, '0') end as id,
  case when event_id % 89 = 0 then null when event_id % 83 = 0 then '   '
       else '  User ' || cast(user_id as string) || ' ' end as name,
  case when event_id % 59 = 0 then null when event_id % 53 = 0 then 'Overseas'
       when event_id % 4 = 0 then upper(d) when event_id % 4 = 1 then ' ' || lower(d) || ' '
       else d end as division,
  case when event_id % 61 = 0 then null when event_id % 67 = 0 then 'PhaseX'
       when event_id % 5 = 0 then upper(p) when event_id % 5 = 1 then lower(p) || '  '
       else p end as audit_phase__c,
  case when event_id % 41 = 0 then null else event_type <> 'error' end as isactive,
  case when event_id % 43 = 0 then null when event_id % 101 = 0 then true else false end as isdeleted,
  timestamp '2024-01-01 00:00:00' as createddate,
  case when event_id % 103 = 0 then null else ts end as lastmodifieddate,
  ts + interval '1' hour as _extracted_at,
  'run_' || lpad(cast(extract(day from ts) as string), 2, '0') as _extraction_run_id,
  cast(cast(ts as date) as string) as _extracted_date
from (
  select *,
    case event_type when 'click' then 'North' when 'error' then 'South' when 'purchase' then 'East'
                    when 'signup' then 'West' else 'Central' end as d,
    case cast(floor((extract(day from ts) - 1) / 8) as int) when 0 then 'Phase1' when 1 then 'Phase2'
                    when 2 then 'Phase3' else 'Complete' end as p
  from {events}) e
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append-only extract log: padded, mixed-case, NULL-ridden user changes."""
    return raw_from(table(spark, sf_dir, "events"))


def raw_from(events: DataFrame) -> DataFrame:
    raw = events.sparkSession.sql(RAW_SQL, events=events)
    kind = events.schema["ts"].dataType
    return raw.withColumn("createddate", F.col("createddate").cast(kind))


# Orders as a change feed with ties: several orders of a customer share a time.
ORDERS = HistorySpec(
    key="o_custkey",
    ts="o_orderdate",
    tracked=("o_orderstatus", "o_orderpriority"),
    deleted="is_deleted",
)


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    return orders.withColumn("is_deleted", F.lit(False))


# The same orders as the history of a few states: each key holds a large share of all rows,
# and most of a key's rows share their time.
STATES = HistorySpec(key="o_orderstatus", ts="o_orderdate", tracked=("o_orderpriority",), deleted="is_deleted")


def state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.expr("cast(date_trunc('month', o_orderdate) as timestamp_ntz)")
    return order_changes(spark, sf_dir).drop("o_custkey").withColumn("o_orderdate", month)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics: one value per event, named by the event's type."""
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("metric"), "ts", "value")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("ts", F.concat(F.upper("event_type"), F.lit(" "), F.col("props")).alias("message"))
