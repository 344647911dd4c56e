"""Registered queries: each runs over the whole given tables, with its expected result as SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.audit import audit_columns
from tidemark.functions.clean import delete_status, is_blank
from tidemark.functions.ids import bucket_of, hash_id, version_id
from tidemark.operators import checks, history, merge, metrics, profiles, report, serve, staging
from tidemark.operators.keyed import Cuts, find_cuts
from tidemark.operators.metrics import AlarmRule
from tidemark.plans import expected as sql, feeds, lifecycle
from tidemark.session import scratch, small_table, written
from tidemark.sources import kept, landing, runs, tables
from tidemark.spec import AUDIT_PHASES, DIVISIONS, USERS
from tidemark.streaming.history import stream_scd2, stream_table
from tidemark.streaming.windows import read_windows, stream_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def query(expected: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if expected is not None:
            EXPECTED[f.__name__] = expected
        return f

    return register


SPLIT = "2024-01-16 00:00:00"
AS_OF = "2024-01-31 00:00:00"
MIDDLE = "2024-01-10 12:00:00"
START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"


def now() -> Column:
    return F.expr("timestamp_ntz'2024-02-01 00:00:00'")


class Feed:
    """The user feed of one run, and what is built from it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return feeds.raw_changes(self.spark, self.sf_dir)

    @cached_property
    def staged(self) -> DataFrame:
        return staging.stage_users(self.raw)

    @cached_property
    def rows(self) -> DataFrame:
        return staging.to_history_names(self.staged)

    @cached_property
    def cuts(self) -> Cuts | None:
        return find_cuts(self.rows, USERS.key, USERS.order(self.rows.columns))

    @cached_property
    def old(self) -> DataFrame:
        """The stored history of all rows before the split."""
        return written(self.build(self.before(SPLIT)), "old")

    @cached_property
    def dim(self) -> DataFrame:
        return self.kept(self.build(self.rows), "dim")

    @cached_property
    def versions(self) -> DataFrame:
        """Version-opening rows, before they are numbered."""
        found = history.change_feed(self.rows, USERS, self.cuts).select(*self.rows.columns)
        return self.kept(found, "versions")

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """With cut keys, what follows reads its input more than once: store it first."""
        return df if self.cuts is None else written(df, name)

    @cached_property
    def damaged(self) -> DataFrame:
        """The dimension with faults planted, for checks a sound one never fails."""
        fault = F.col("version_sequence") % 40 == 0
        return self.dim.withColumn("is_current", F.col("is_current") | fault)

    def build(self, rows: DataFrame, **options) -> DataFrame:
        return history.scd2_build(rows, USERS, self.cuts, now=now(), **options)

    def before(self, at: str) -> DataFrame:
        return self.rows.filter(F.col("update_date") < F.lit(at).cast("timestamp_ntz"))

    def since(self, at: str) -> DataFrame:
        return self.rows.filter(F.col("update_date") >= F.lit(at).cast("timestamp_ntz"))


# --- Sources and staging -----------------------------------------------------------------


@query(sql.with_(sql.RAW, select="select * from raw"))
def raw_changes(spark, d):
    return Feed(spark, d).raw


_RECORDS = """select id, name, division, audit_phase__c, isactive, createddate, lastmodifieddate, isdeleted
from raw"""


@query(sql.with_(sql.RAW, select=_RECORDS))
def landing_records(spark, d):
    """Raw rows as JSON records with an envelope, parsed back with the fixed schema."""
    raw = Feed(spark, d).raw
    record = F.struct(
        F.create_map(F.lit("type"), F.lit("User")).alias("attributes"),
        F.col("id").alias("Id"), F.col("name").alias("Name"), F.col("division").alias("Division"),
        F.col("audit_phase__c").alias("Audit_Phase__c"), F.col("isactive").alias("IsActive"),
        F.col("createddate").cast("string").alias("CreatedDate"),
        F.col("lastmodifieddate").cast("string").alias("LastModifiedDate"),
        F.col("isdeleted").alias("IsDeleted"),
    )
    lines = raw.select(F.to_json(record).alias("line"))
    records = landing.parse_records(lines, "line", landing.user_record_schema())
    typed = landing.lower_names(landing.type_times(landing.strip_envelope(records), ntz=True))
    return typed.drop("username", "email", "lastlogindate")


@query(sql.with_(sql.RAW, select=f"""select id, name, division, isactive, lastmodifieddate from raw
where lastmodifieddate > timestamp '{SPLIT}'"""))
def incremental_pull(spark, d):
    fields = ["id", "name", "division", "isactive", "lastmodifieddate"]
    return landing.read_incremental(Feed(spark, d).raw, "lastmodifieddate", SPLIT, fields)


@query(sql.with_(sql.RAW, select=f"""select id, lastmodifieddate, {sql.NOW} as _extracted_at,
  'run-7' as _extraction_run_id, '2024-02-01' as _extracted_date from raw"""))
def stamp_extraction(spark, d):
    rows = Feed(spark, d).raw.select("id", "lastmodifieddate")
    return landing.stamp_extraction(rows, "run-7", now())


@query(sql.with_(sql.RAW, select="""select 'ingest' as job, max(lastmodifieddate) as mark from raw
where _extraction_run_id = (select max(_extraction_run_id) from raw
  where cast(substr(_extraction_run_id, 5) as int) % 4 <> 0)"""))
def bookmark_mark(spark, d):
    """One run per day, every fourth failed: the mark is that of the last success."""
    raw = Feed(spark, d).raw
    failed = F.substr(F.col("_extraction_run_id"), F.lit(5)).cast("int") % 4 == 0
    log = raw.groupBy("_extraction_run_id").agg(
        F.lit("ingest").alias("job"),
        F.max("lastmodifieddate").alias("mark"),
        F.max("_extracted_at").alias("recorded_at"),
    ).withColumn("state", F.when(failed, "failed").otherwise("succeeded"))
    return runs.latest_marks(log)


@query(sql.with_(sql.RAW, select=f"""select * from raw
where _extracted_at >= cast(cast(timestamp '{AS_OF}' as date) - 7 as timestamp)"""))
def lookback_scan(spark, d):
    return landing.lookback(Feed(spark, d).raw, AS_OF, days=7)


@query(sql.with_(sql.USERS, select="select * from staged"))
def stage_users(spark, d):
    return Feed(spark, d).staged


@query(sql.with_(sql.USERS, select=f"""select * from staged
where lastmodifieddate between timestamp '{MIDDLE}' and timestamp '{SPLIT}'"""))
def stage_between(spark, d):
    return staging.between_dates(Feed(spark, d).staged, "lastmodifieddate", MIDDLE, SPLIT)


@query(sql.with_(sql.HISTORY, select=f"""select * from src
where division in {sql.listed(DIVISIONS)} and audit_phase__c in {sql.listed(AUDIT_PHASES)}"""))
def valid_members(spark, d):
    return staging.in_lists(Feed(spark, d).rows, USERS.valid)


@query(sql.with_(sql.RAW, select=f"{_RECORDS} where lastmodifieddate > (select max(lastmodifieddate) from raw)"))
def empty_pull(spark, d):
    """Nothing follows the mark: no rows, the whole schema."""
    raw = Feed(spark, d).raw
    mark = raw.agg(F.max("lastmodifieddate")).first()[0]
    fields = ["id", "name", "division", "audit_phase__c", "isactive", "createddate", "lastmodifieddate", "isdeleted"]
    return landing.read_incremental(raw, "lastmodifieddate", mark, fields)


@query(sql.with_(sql.RAW, select=f"""select id, name, lastmodifieddate from raw
where lastmodifieddate > timestamp '{SPLIT}' order by lastmodifieddate"""))
def ordered_extract(spark, d):
    fields = ["id", "name", "lastmodifieddate"]
    return landing.read_incremental(Feed(spark, d).raw, "lastmodifieddate", SPLIT, fields, ordered=True)


@query(sql.with_(sql.USERS, select="select * from staged"))
def replaced_table(spark, d):
    """A table replaced by another one, read back through a view."""
    f, path = Feed(spark, d), scratch(spark, "replaced")
    tables.create_or_replace(f.raw, path)
    tables.create_or_replace(f.staged, path)
    tables.publish_view(spark.read.parquet(path), "replaced_rows")
    return spark.table("replaced_rows")


_ANALYZED = ("division", "audit_phase__c", "_extraction_run_id")


@query(sql.with_(sql.DIM, select=" union all ".join(
    f"select '{c}' as column_name, (count(*) - count({c}))::varchar as num_nulls, max(len({c}::varchar))::varchar as max_col_len from dim" for c in _ANALYZED
)))
def analyzed_columns(spark, d):
    """Statistics of a catalog table's columns, as the catalog gives them afterwards."""
    path = scratch(spark, "analyzed")
    Feed(spark, d).dim.write.parquet(path)
    name = "analyzed_" + path.rsplit("-", 1)[1]
    spark.sql(f"create table {name} using parquet location '{path}'")
    tables.analyze(spark, name)
    found = []
    for c in _ANALYZED:
        got = {r["info_name"]: r["info_value"] for r in spark.sql(f"describe extended {name} {c}").collect()}
        found.append((c, got["num_nulls"], got["max_col_len"]))
    spark.sql(f"drop table {name}")
    return small_table(spark, found, "column_name string, num_nulls string, max_col_len string")


@query(sql.with_(sql.RAW, select="""select id, lastmodifieddate as update_date,
  coalesce(isdeleted, false) as is_deleted,
  case when isdeleted then false end as is_current,
  case when isdeleted then 'DELETED' else 'ACTIVE' end as record_status from raw"""))
def delete_status_rows(spark, d):
    rows = Feed(spark, d).raw
    return rows.select("id", delete_status("isdeleted", "lastmodifieddate").alias("s")).select("id", "s.*")


@query(sql.with_(sql.HISTORY, select=f"""select *, {sql.NOW} as _dbt_updated_at,
  'inv-1' as _dbt_invocation_id, '2024-02-01 00:00:00' as _dbt_run_started_at from src"""))
def audit_fields(spark, d):
    return audit_columns(Feed(spark, d).rows, "inv-1", "2024-02-01 00:00:00", now())


@query(sql.with_(sql.HISTORY, select=f"""select {sql.USER_KEY} as user_key,
  md5(concat_ws('-', coalesce(user_id, '_null_'), cast(epoch_us(update_date) as varchar), coalesce(name, '_null_'))) as plain_id,
  {sql.SCD_ID} as _scd_id from src"""))
def version_ids(spark, d):
    rows = Feed(spark, d).rows
    return rows.select(
        hash_id(rows, ["user_id", "update_date"]).alias("user_key"),
        version_id(rows, "user_id", "update_date", ["name"], deleted=None).alias("plain_id"),
        version_id(rows, "user_id", "update_date", USERS.tracked).alias("_scd_id"),
    )


@query(sql.with_(sql.USERS, select=f"""select id, name, division, lastmodifieddate, cast(null as varchar) as region
from staged where lastmodifieddate < timestamp '{SPLIT}'
union all
select id, name, division, lastmodifieddate, 'R-' || substr(division, 1, 1) as region
from staged where lastmodifieddate >= timestamp '{SPLIT}'"""))
def schema_sync(spark, d):
    """A later extract has lost one column and gained another."""
    staged = Feed(spark, d).staged
    at = F.lit(SPLIT).cast("timestamp_ntz")
    old = staged.filter(F.col("lastmodifieddate") < at).select("id", "name", "division", "isactive", "lastmodifieddate")
    new = staged.filter(F.col("lastmodifieddate") >= at).select(
        "id", "name", "division", "lastmodifieddate",
        F.concat(F.lit("R-"), F.substring("division", 1, 1)).alias("region"),
    )
    return staging.sync_columns(old, new)


@query("""with old as (select * from orders where o_orderkey % 2 = 0), new as (select * from orders where o_orderkey % 2 = 1)
select o_orderkey, cast(o_custkey as bigint) as number, cast(cast(cast(o_totalprice as decimal(10,2)) as decimal(12,4)) as varchar) as amount,
  cast(o_custkey % 1000 as int) as zip, o_orderstatus as status, cast(null as varchar) as priority, cast(null as varchar) as reject_reason from old
union all
select o_orderkey, case when o_orderkey % 7 = 1 then null else 5000000000 + o_custkey end, case when o_orderkey % 7 = 1 then null
    else cast(cast(o_totalprice as decimal(12,4)) as varchar) end,
  case when o_orderkey % 7 = 1 then null else cast(o_custkey % 1000 as int) end, null, case when o_orderkey % 7 = 1 then null else o_orderpriority end,
  case when o_orderkey % 7 = 1 then 'does not fit: place' end from new""")
def schema_retyped(spark, d):
    """A later extract has wider numbers, a struct with other fields, and text where a number was: what is no number is rejected."""
    orders = feeds.table(spark, d, "orders").withColumn("zip", (F.col("o_custkey") % 1000).cast("int"))
    text = F.when(F.col("o_orderkey") % 7 == 1, F.concat(F.lit("Z-"), "zip")).otherwise(F.col("zip").cast("string"))
    old = orders.filter("o_orderkey % 2 = 0").select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("number"), F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.struct("zip", F.col("o_orderstatus").alias("status")).alias("place"),
    )
    new = orders.filter("o_orderkey % 2 = 1").select(
        "o_orderkey", (F.col("o_custkey") + 5_000_000_000).alias("number"), F.col("o_totalprice").cast("decimal(12,4)").alias("amount"),
        F.struct(text.alias("zip"), F.col("o_orderpriority").alias("priority")).alias("place"),
    )
    rows, rejected = staging.sync_schemas(old, new)
    flat = rows.select("o_orderkey", "number", F.col("amount").cast("string").alias("amount"), "place.zip", "place.status", "place.priority")
    key = F.get_json_object("row", "$.o_orderkey").cast("bigint").alias("o_orderkey")
    return flat.unionByName(rejected.select(key, "reject_reason"), allowMissingColumns=True)


@query(sql.with_(sql.RAW, select="""select _extracted_date, count(*) as n, count(id) as n_ids
from raw group by _extracted_date"""))
def append_raw(spark, d):
    """Two appends to a partitioned raw table, read back."""
    raw, path = Feed(spark, d).raw, scratch(spark, "raw")
    at = F.lit(SPLIT).cast("timestamp_ntz")
    tables.append_raw(raw.filter(F.col("_extracted_at") < at), path)
    tables.append_raw(raw.filter(F.col("_extracted_at") >= at), path)
    back = tables.read_raw(spark, path)
    return back.groupBy("_extracted_date").agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("n_ids"))


@query(sql.with_(sql.HISTORY, select="""select * from src qualify row_number() over (partition by user_id
  order by update_date desc, _extracted_at desc, _extraction_run_id desc, audit_phase__c desc nulls last,
  division desc nulls last, is_active desc, is_deleted desc, name desc) = 1"""))
def upsert_latest(spark, d):
    f = Feed(spark, d)
    return merge.upsert_latest(f.before(SPLIT), f.since(SPLIT), USERS.key, USERS.ts)


# --- Histories ---------------------------------------------------------------------------

_FEED = """select user_id, name, division, audit_phase__c, is_active, update_date, is_deleted,
  _extracted_at, _extraction_run_id, prev_division, prev_audit_phase__c, prev_update_date, rn from dim_seen"""


@query(sql.with_(sql.HISTORY, sql.seen("dim", "src"), select=f"""{_FEED} where {sql.CHANGED}"""))
def change_feed(spark, d):
    f = Feed(spark, d)
    return history.change_feed(f.rows, USERS, f.cuts)


@query(sql.with_(sql.HISTORY, sql.seen("dim", "src"), select=f"""select user_id, update_date,
  coalesce({sql.CHANGED}, false) as needs_scd_record from dim_seen"""))
def detect_changes(spark, d):
    f = Feed(spark, d)
    found = history.detect_changes(f.rows, USERS, f.cuts)
    return found.select("user_id", "update_date", "needs_scd_record")


@query(sql.with_(sql.DIM, select="select * from dim"))
def scd2_build(spark, d):
    return Feed(spark, d).dim


@query(sql.with_(
    sql.HISTORY, f"good as (select * from src where {sql.VALID})", sql.dim("dim", "good"),
    select="select * from dim",
))
def scd2_filter_first(spark, d):
    f = Feed(spark, d)
    return f.build(f.rows, filter_first=True)


_WITH_DELETES = f"({sql.CHANGED} or is_deleted <> prev_is_deleted)"


@query(sql.with_(sql.HISTORY, sql.dim("dim", "src", _WITH_DELETES), select="select * from dim"))
def scd2_track_deletes(spark, d):
    f = Feed(spark, d)
    return f.build(f.rows, track_deletes=True)


@query(sql.with_(sql.HISTORY, sql.seen("dim", "src"), f"""v as (
  select user_id, update_date, division, audit_phase__c, is_deleted, name, _extracted_at, _extraction_run_id, is_active,
    lead(update_date) over {sql.KEYED} is null and not is_deleted as preliminary_current
  from dim_seen where {sql.CHANGED})""", select=f"""select user_id, update_date, is_deleted, preliminary_current,
  cast(count(*) filter (where preliminary_current) over {sql.ALL_KEY} as bigint) as current_record_count from v"""))
def scd2_preliminary_currency(spark, d):
    f = Feed(spark, d)
    found = history.preliminary_currency(f.versions, USERS, f.cuts)
    return found.select("user_id", "update_date", "is_deleted", "preliminary_current", "current_record_count")


@query(sql.with_(sql.DIM, sql.DAMAGED, select=f"""select _scd_id, user_id, update_date,
  case when is_deleted then false else update_date = max(update_date) over {sql.ALL_KEY} end as is_current from bad"""))
def scd2_currency(spark, d):
    """The current flag repaired on a history whose flags are wrong."""
    f = Feed(spark, d)
    return history.ensure_currency(f.damaged, USERS, f.cuts).select("_scd_id", "user_id", "update_date", "is_current")


_DIM_KEYED = f"(partition by user_id order by {sql.ORDER.replace(', is_active', ', _scd_id, is_active, is_current')})"


@query(sql.with_(sql.DIM, select=f"""select _scd_id, user_id, update_date,
  cast(row_number() over {_DIM_KEYED} as int) as version_sequence,
  lag(update_date) over {_DIM_KEYED} as previous_version_date,
  lead(update_date) over {_DIM_KEYED} as next_version_date,
  update_date = max(update_date) over {sql.ALL_KEY} as is_latest_version from dim"""))
def scd2_version_tracking(spark, d):
    f = Feed(spark, d)
    return history.version_tracking(f.dim, USERS, f.cuts).select(
        "_scd_id", "user_id", "update_date", "version_sequence", "previous_version_date",
        "next_version_date", "is_latest_version",
    )


VALIDITY = f"""valid_dim as (select *, update_date as effective_from,
  lead(update_date) over (partition by user_id order by update_date, version_sequence) as effective_to from dim)"""


@query(sql.with_(sql.DIM, VALIDITY, select="select * from valid_dim"))
def scd2_validity(spark, d):
    f = Feed(spark, d)
    return history.with_validity(f.dim, USERS, f.cuts)


@query(sql.with_(sql.HISTORY, """f as (select * from src qualify row_number() over (partition by user_id, update_date
  order by _extracted_at, _extraction_run_id, audit_phase__c nulls first, division nulls first, is_active, is_deleted, name) = 1)""",
  select="""select *, update_date as valid_from,
  lead(update_date) over (partition by user_id order by update_date) as valid_to from f"""))
def snapshot_timestamp(spark, d):
    f = Feed(spark, d)
    return history.snapshot_by_timestamp(f.rows, USERS.key, USERS.ts, f.cuts)


def _orders(spark, d) -> tuple[DataFrame, Cuts | None]:
    rows = feeds.order_changes(spark, d)
    return rows, find_cuts(rows, feeds.ORDERS.key, feeds.ORDERS.order(rows.columns))


def _order_dim(spark, d) -> tuple[DataFrame, Cuts | None]:
    rows, cuts = _orders(spark, d)
    return history.scd2_build(rows, feeds.ORDERS, cuts).drop("_dbt_updated_at"), cuts


@query(sql.with_(sql.ORDER_DIM, select="select * from o_dim"))
def order_history(spark, d):
    """A history of another entity, with ties on (key, time)."""
    return _order_dim(spark, d)[0]


@query("""with rows as (select o_orderkey, o_orderstatus, cast(date_trunc('month', o_orderdate) as timestamp) as o_orderdate, o_orderpriority,
  false as is_deleted from orders),
seen as (select *, lag(o_orderpriority) over w as pp, row_number() over w as rn from rows
  window w as (partition by o_orderstatus order by o_orderdate, o_orderpriority nulls first, o_orderkey))
select o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, is_deleted,
  md5(concat_ws('-', o_orderstatus, cast(epoch_us(o_orderdate) as varchar))) as user_key,
  o_orderdate = max(o_orderdate) over (partition by o_orderstatus) as is_current,
  md5(concat_ws('-', o_orderstatus, cast(epoch_us(o_orderdate) as varchar), coalesce(o_orderpriority, '_null_'), 'false')) as _scd_id,
  cast(row_number() over w as int) as version_sequence
from seen where rn = 1 or o_orderpriority <> coalesce(pp, '')
window w as (partition by o_orderstatus order by o_orderdate, o_orderpriority nulls first, o_orderkey)""")
def heavy_key_history(spark, d):
    """A history of a few keys, each of which fills whole segments and has most rows at equal times."""
    rows = feeds.state_changes(spark, d)
    cuts = find_cuts(rows, feeds.STATES.key, feeds.STATES.order(rows.columns), segments=32)
    return history.scd2_build(rows, feeds.STATES, cuts).drop("_dbt_updated_at")


# --- Serving -----------------------------------------------------------------------------


@query(sql.with_(sql.DIM, select="select * from dim where is_current and not is_deleted"))
def scd_current(spark, d):
    return serve.current(Feed(spark, d).dim, USERS)


@query(sql.with_(sql.DIM, select="""select user_id, division, audit_phase__c, update_date, version_sequence
from dim where user_id = 'U00007' order by version_sequence"""))
def scd_history(spark, d):
    rows = serve.history_of(Feed(spark, d).dim, USERS, "U00007")
    return rows.select("user_id", "division", "audit_phase__c", "update_date", "version_sequence")


@query(sql.with_(sql.DIM, select="""select division, count(*) as change_count, min(update_date) as first_change,
  max(update_date) as last_change from dim where version_sequence > 1 group by division order by change_count desc, division"""))
def scd_division_changes(spark, d):
    return serve.change_analysis(Feed(spark, d).dim, USERS, "division")


@query(sql.with_(sql.DIM, VALIDITY, select=f"""select _scd_id, user_id, division, effective_from, effective_to
from valid_dim where effective_from <= timestamp '{MIDDLE}' and (effective_to is null or effective_to > timestamp '{MIDDLE}')"""))
def scd_state_at(spark, d):
    f = Feed(spark, d)
    return serve.state_at(f.dim, USERS, MIDDLE).select("_scd_id", "user_id", "division", "effective_from", "effective_to")


@query(sql.with_(sql.DIM, VALIDITY, select="""select e.event_id, e.ts, e.value, 'U' || lpad(cast(e.user_id as string), 5, '0') as user_key,
  v._scd_id, v.division, v.version_sequence
from events e left join valid_dim v on 'U' || lpad(cast(e.user_id as string), 5, '0') = v.user_id
  and e.ts >= v.effective_from and (v.effective_to is null or e.ts < v.effective_to)"""))
def scd_as_of_join(spark, d):
    f = Feed(spark, d)
    key = F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 5, "0"))
    facts = feeds.table(spark, d, "events").select("event_id", "ts", "value", key.alias("user_key"))
    return serve.as_of(facts, written(f.dim, "dim"), USERS, "user_key", "ts", ["_scd_id", "division", "version_sequence"])


@query(sql.with_(sql.DIM, select="""select 'sf_user_scd' as table_name, count(*) as total_records,
  count(distinct user_id) as unique_users,
  cast(sum(case when is_current and not is_deleted then 1 else 0 end) as bigint) as current_active_records,
  cast(sum(case when not is_current and not is_deleted then 1 else 0 end) as bigint) as historical_records,
  cast(sum(case when is_deleted then 1 else 0 end) as bigint) as deleted_records,
  min(update_date) as earliest_record_date, max(update_date) as latest_record_date,
  max(_dbt_updated_at) as last_dbt_run from dim"""))
def scd_statistics(spark, d):
    return serve.scd_statistics(Feed(spark, d).dim, USERS)


@query(sql.with_(sql.DIM, select=f"""select count(*) as total_records, count(distinct user_id) as unique_users,
  round(avg(version_sequence), 2) as avg_versions_per_user,
  cast(max(version_sequence) as bigint) as max_versions_per_user,
  cast(extract(day from max(update_date) - min(update_date)) as bigint) as date_range_days,
  round(count(*) / count(distinct user_id), 2) as avg_scd_records_per_user,
  round(sum(case when is_current then 1 else 0 end) / count(distinct user_id), 4) as current_records_ratio,
  round(sum(case when division in {sql.listed(DIVISIONS)} then 1 else 0 end) / count(*), 4) as valid_division_ratio,
  round(sum(case when audit_phase__c in {sql.listed(AUDIT_PHASES)} then 1 else 0 end) / count(*), 4) as valid_audit_phase_ratio
from dim where not is_deleted"""))
def scd_performance(spark, d):
    return serve.performance_metrics(Feed(spark, d).dim, USERS)


@query(sql.with_(sql.DIM, select="select count(*) as total_records, count(*) filter (where is_current) as current_records from dim"))
def scd_counts(spark, d):
    return serve.table_counts(Feed(spark, d).dim, USERS)


@query(sql.with_(sql.DIM, select="select distinct user_id from dim"))
def distinct_keys(spark, d):
    return serve.distinct_keys(Feed(spark, d).dim, USERS.key)


# --- Checks ------------------------------------------------------------------------------


@query(sql.with_(sql.DIM, sql.DAMAGED, select="""select user_id, count(*) as current_record_count from bad
where is_current and not is_deleted group by user_id having count(*) > 1"""))
def q_multi_current(spark, d):
    return checks.multiple_current(Feed(spark, d).damaged, USERS)


@query(sql.with_(sql.DIM, sql.DAMAGED, select="""select * from (select user_id,
  count(*) filter (where is_current and not is_deleted) as current_record_count, count(*) as total_versions,
  max(update_date) as latest_update_date,
  cast(sum(case when is_current and not is_deleted then 1 else 0 end) as bigint) as active_current_count
  from bad group by user_id) where current_record_count <> 1 or active_current_count > 1"""))
def q_strict_current(spark, d):
    return checks.not_exactly_one_current(Feed(spark, d).damaged, USERS)


@query(sql.with_(sql.DIM, select="""select user_id, update_date, prev_update_date, days_gap from (
  select user_id, update_date, lag(update_date) over (partition by user_id order by update_date) as prev_update_date,
    cast(extract(day from update_date - lag(update_date) over (partition by user_id order by update_date)) as bigint) as days_gap
  from dim where not is_deleted) where days_gap > 1"""))
def q_gaps(spark, d):
    f = Feed(spark, d)
    return checks.history_gaps(f.dim, USERS, cuts=f.cuts)


_NEIGHBOURS = """n as (select user_id, update_date, division, audit_phase__c,
  lag(division) over w as prev_division, lag(audit_phase__c) over w as prev_audit_phase__c,
  cast(row_number() over w as int) as rn from dim where not is_deleted
  window w as (partition by user_id order by update_date, division nulls first, audit_phase__c nulls first))"""


@query(sql.with_(sql.DIM, _NEIGHBOURS, select="""select * from n where rn > 1
  and division = coalesce(prev_division, division) and audit_phase__c = coalesce(prev_audit_phase__c, audit_phase__c)"""))
def q_unchanged(spark, d):
    f = Feed(spark, d)
    return checks.unchanged_versions(f.dim, USERS, f.cuts)


@query(sql.with_(sql.HISTORY, sql.seen("dim", "src"), sql.numbered("dim"), select=f"""select * from (
  select user_id, name, division, audit_phase__c, update_date,
    case when division not in {sql.listed(DIVISIONS)} then 'Invalid Division'
         when audit_phase__c not in {sql.listed(AUDIT_PHASES)} then 'Invalid Audit Phase'
         when name is null or trim(name) = '' then 'Missing Name' end as violation_type
  from dim_all where not is_deleted) where violation_type is not null"""))
def q_business_rules(spark, d):
    """On the versions as derived, before invalid ones are left out."""
    f = Feed(spark, d)
    return checks.business_rules(history.number_versions(f.versions, USERS, f.cuts, now()), USERS)


@query(sql.with_(sql.DIM, select="""select user_id, max(update_date) as latest_update_date from dim group by user_id
having count(*) filter (where is_current and not is_deleted) = 0
  and not arg_max(is_deleted, struct_pack(a := update_date, b := not is_deleted))"""))
def q_missing_current(spark, d):
    return checks.missing_current(Feed(spark, d).dim, USERS)


@query(sql.with_(sql.DIM, sql.DAMAGED, select="select * from bad where is_deleted and is_current"))
def q_deleted_current(spark, d):
    return checks.deleted_current(Feed(spark, d).damaged, USERS)


@query(sql.with_(sql.DIM, select="""select _scd_id, user_key, count(*) as n_records
from (select * from dim union all select * from dim where version_sequence % 25 = 0) group by _scd_id, user_key having count(*) > 1"""))
def q_id_unique(spark, d):
    dim = Feed(spark, d).dim
    return checks.duplicate_ids(dim.unionByName(dim.filter(F.col("version_sequence") % 25 == 0)), ["_scd_id", "user_key"])


@query(sql.with_(sql.DIM, select="""select user_id, count(*) as total_versions, cast(max(version_sequence) as bigint) as last_sequence
from dim group by user_id having count(*) <> max(version_sequence)"""))
def q_sequence(spark, d):
    return checks.sequence_gaps(Feed(spark, d).dim, USERS)


@query(sql.with_(sql.DIM, sql.DAMAGED, select="""select b.*, m.latest_update_date from bad b
join (select user_id, max(update_date) as latest_update_date from bad group by user_id) m using (user_id)
where b.is_current and b.update_date < m.latest_update_date"""))
def q_current_latest(spark, d):
    return checks.current_not_latest(Feed(spark, d).damaged, USERS)


_SHIFTED = """shifted as (select user_id, version_sequence, effective_from,
  case when version_sequence % 10 = 3 then effective_to + interval 9 day
       when version_sequence % 30 = 0 then effective_to + interval 1 day
       when version_sequence % 31 = 1 then effective_to - interval 1 minute
       when version_sequence % 47 = 0 then effective_from - interval 1 hour
       when version_sequence % 97 = 0 then null else effective_to end as effective_to from valid_dim)"""
# By pairs: every earlier interval of the key is looked at.
_PAIRS = """placed as (select *, row_number() over (partition by user_id order by effective_from, effective_to nulls first, version_sequence) as n,
  effective_to is null or effective_to > effective_from as solid from shifted)"""


@query(sql.with_(sql.DIM, VALIDITY, _SHIFTED, _PAIRS, select="""select * from (
  select b.user_id, b.effective_from, b.effective_to,
    case when bool_or(a.effective_to is null and a.n is not null) then null else max(a.effective_to) end as reached,
    case when b.effective_to < b.effective_from then 'inverted'
      when b.solid and bool_or(a.n is not null and (a.effective_to is null or a.effective_to > b.effective_from)) then 'overlap'
      when b.solid and count(a.n) > 0 and max(a.effective_to) < b.effective_from then 'gap' end as problem
  from placed b left join placed a on a.user_id = b.user_id and a.n < b.n and a.solid
  group by b.user_id, b.n, b.effective_from, b.effective_to, b.solid)
where problem is not null"""))
def q_overlaps(spark, d):
    """On intervals some of which are shifted: nested ones, holes, open ends in the middle."""
    f = Feed(spark, d)
    valid, seq, end = history.with_validity(f.dim, USERS, f.cuts), F.col("version_sequence"), F.col("effective_to")
    shifted = (
        F.when(seq % 10 == 3, end + F.expr("interval 9 day"))
        .when(seq % 30 == 0, end + F.expr("interval 1 day"))
        .when(seq % 31 == 1, end - F.expr("interval 1 minute"))
        .when(seq % 47 == 0, F.col("effective_from") - F.expr("interval 1 hour"))
        .when(seq % 97 == 0, F.lit(None))
        .otherwise(end)
    )
    return checks.interval_overlaps(valid.withColumn("effective_to", shifted), USERS)


_RAW_COLUMNS = ["id", "name", "division", "audit_phase__c", "isactive", "isdeleted", "lastmodifieddate", "_extracted_at"]


@query(sql.with_(sql.RAW, select=" union all ".join(
    f"select '{c}' as column_name, count(*) as null_count from raw where {c} is null having count(*) > 0" for c in _RAW_COLUMNS)))
def q_not_null(spark, d):
    return checks.not_null(Feed(spark, d).raw, _RAW_COLUMNS)


@query(sql.with_(sql.RAW, select="select id, count(*) as n_records from raw where id is not null group by id having count(*) > 1"))
def q_unique(spark, d):
    return checks.unique(Feed(spark, d).raw, ["id"])


@query(sql.with_(sql.RAW, select="""select id, lastmodifieddate, count(*) as n_records from raw
where isactive and id is not null and lastmodifieddate is not null group by id, lastmodifieddate having count(*) > 1
union all select null, null, count(*) from raw where isactive"""))
def q_unique_where(spark, d):
    """Duplicates among active rows, and how many rows were compared."""
    raw = Feed(spark, d).raw
    found = checks.unique(raw, ["id", "lastmodifieddate"], where=F.col("isactive"))
    n = raw.filter("isactive").agg(F.count(F.lit(1)).alias("n_records"))
    return found.unionByName(n, allowMissingColumns=True)


@query("""select o_custkey, o_orderdate, count(*) as n_records from orders
where o_orderstatus <> 'X' group by o_custkey, o_orderdate having count(*) > 1""")
def q_unique_orders(spark, d):
    orders = feeds.table(spark, d, "orders")
    return checks.unique(orders, ["o_custkey", "o_orderdate"], where=F.col("o_orderstatus") != "X")


@query(sql.with_(sql.USERS, select=f"""select division as value_field, count(*) as n_records from staged
where division not in {sql.listed(DIVISIONS)} group by division"""))
def q_accepted_values(spark, d):
    return checks.accepted_values(Feed(spark, d).staged, "division", DIVISIONS)


_DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@query(f"""with p as (select count(*) as n, count(distinct text) as k,
  {", ".join(f"count(*) - count({c}) as null_{c}" for c in _DOC_COLUMNS)},
  count(*) filter (where {" and ".join(f"{c} is not null" for c in _DOC_COLUMNS)}) as complete from documents)
""" + " union all ".join(
    [f"select 'null_share:{c}' as measure, round(null_{c} / n, 6) as value, 0.05::double as threshold, null_{c} / n <= 0.05 as passed from p" for c in _DOC_COLUMNS]
    + ["select 'duplicate_share', round((n - k) / n, 6), 0.01::double, (n - k) / n <= 0.01 from p",
       "select 'success_rate', round(complete / n, 6), 0.95::double, complete / n >= 0.95 from p"]))
def dq_profile(spark, d):
    """Document rows: NULL shares, and the share of documents whose text is a copy."""
    return checks.dq_profile(feeds.table(spark, d, "documents"), _DOC_COLUMNS, ["text"], digest=True)


@query(sql.with_(sql.USERS, select=f"""select rule, violations, violations = 0 as passed from (
  select 'required:name' as rule, count(*) filter (where name is null) as violations from staged
  union all select 'required:division', count(*) filter (where division is null) from staged
  union all select 'accepted:audit_phase__c', count(*) filter (where audit_phase__c not in {sql.listed(AUDIT_PHASES)}) from staged
  union all select 'unique:id', count(*) from (select id from staged group by id having count(*) > 1))"""))
def dq_rules(spark, d):
    rules = {"required": ["name", "division"], "unique": ["id"], "accepted": {"audit_phase__c": AUDIT_PHASES}}
    return checks.apply_rules(Feed(spark, d).staged, rules)


_REASON = """case when id is null then 'missing_id' when name is null or trim(name) = '' then 'missing_name'
  when lastmodifieddate is null then 'missing_lastmodifieddate' end"""


@query(sql.with_(sql.RAW, select=f"select *, {_REASON} as reject_reason from raw where {_REASON} is not null"))
def quarantine(spark, d):
    return checks.quarantine(Feed(spark, d).raw, lifecycle.raw_rules())[1]


@query(sql.with_(sql.RAW, select=f"""select count(*) as total, count({_REASON}) as rejected,
  round(count({_REASON}) * 100.0 / count(*), 4)::double as rejected_pct,
  count({_REASON}) * 100.0 / count(*) <= 5 as batch_accepted from raw"""))
def reject_rate(spark, d):
    return checks.reject_rate(Feed(spark, d).raw, lifecycle.raw_rules())


@query(sql.with_(sql.RAW, select=f"""select max(_extracted_at) as latest_extraction, count(*) as total_records,
  not coalesce(max(_extracted_at) >= timestamp '{AS_OF}' - interval 6 hour, false) as is_stale
from raw where _extracted_at between timestamp '{AS_OF}' - interval 1 day and timestamp '{AS_OF}'"""))
def freshness(spark, d):
    return checks.freshness(Feed(spark, d).raw, "_extracted_at", AS_OF)


@query(sql.with_(sql.RAW, select="""select count(*) as record_count, cast(1000 as bigint) as minimum, count(*) >= 1000 as passed from raw"""))
def min_records(spark, d):
    return checks.min_records(Feed(spark, d).raw, 1_000)


@query(sql.with_(sql.RAW, select="select count(*) as record_count, cast(50000 as bigint) as batch_limit, count(*) <= 50000 as passed from raw"))
def batch_guard(spark, d):
    return checks.batch_guard(Feed(spark, d).raw)


@query(sql.with_(sql.RAW, select="select count(*) as record_count from raw where _extracted_date = '2024-01-16'"))
def partition_count(spark, d):
    return checks.partition_count(Feed(spark, d).raw, "_extracted_date", "2024-01-16")


@query(sql.with_(sql.RAW, """r as (select _extraction_run_id, count(*) as record_count from raw group by _extraction_run_id)""",
  """s as (select *, lag(record_count) over (order by _extraction_run_id) as previous_count from r)""",
  select="""select *, round(abs(record_count - previous_count) * 100.0 / previous_count, 4)::double as deviation_pct,
  record_count not between 320 and 345 as out_of_range,
  coalesce(abs(record_count - previous_count) * 100.0 / previous_count > 5, false) as deviates from s"""))
def volume_anomaly(spark, d):
    daily = Feed(spark, d).raw.groupBy("_extraction_run_id").agg(F.count(F.lit(1)).alias("record_count"))
    daily = daily.withColumn("job", F.lit(lifecycle.JOB))
    return checks.volume_anomaly(daily, "job", "_extraction_run_id", "record_count", 320, 345, 5.0).drop("job")


@query("""with daily as (select event_type as job, cast(ts as date) as day, count(*) as n from events group by all),
base as (select job, dayofweek(day) as w, quantile_cont(n, 0.5) as usual, quantile_cont(n, 0.75) - quantile_cont(n, 0.25) as spread
  from daily group by all)
select d.job, d.day, d.n, b.usual, b.spread, abs(d.n - b.usual) > greatest(0.5 * b.spread, 1.0) as unusual
from daily d join base b on d.job = b.job and dayofweek(d.day) = b.w""")
def volume_baseline(spark, d):
    """Each job's daily volume against its own weekdays."""
    events = feeds.table(spark, d, "events")
    daily = events.groupBy(F.col("event_type").alias("job"), F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return checks.volume_baseline(daily, "job", "day", "n", spread=0.5)


@query(sql.with_(sql.RAW, """n as (select count(*) as n from raw)""", select="""
select 'null_share:division' as measure, round(count(*) filter (where division is null) / max(n)::double, 6) as value,
  count(*) filter (where division is null) / max(n)::double <= 0.05 as passed from raw, n
union all select 'success_rate', round(count(*) filter (where division is not null and lastmodifieddate is not null) / max(n)::double, 6),
  count(*) filter (where division is not null and lastmodifieddate is not null) / max(n)::double >= 0.95 from raw, n
union all select 'null_share:lastmodifieddate', round(count(*) filter (where lastmodifieddate is null) / max(n)::double, 6),
  count(*) filter (where lastmodifieddate is null) / max(n)::double <= 0.05 from raw, n
union all select 'duplicate_share:user', null, 1 - count(distinct id) / max(n)::double <= 0.01 from raw, n
union all select 'duplicate_share:change', round(1 - max(d) / max(n)::double, 6), 1 - max(d) / max(n)::double <= 0.01
  from n, (select count(*) as d from (select distinct id, lastmodifieddate, createddate from raw))"""))
def profile_by_extract(spark, d):
    """The profile of all extracts from those of each, of which the last arrives later; what the sketches can't tell is counted."""
    raw, path = Feed(spark, d).raw, scratch(spark, "profiles")
    columns, keys = ["division", "lastmodifieddate"], {"user": ["id"], "change": ["id", "lastmodifieddate", "createddate"]}
    for part in (F.col("_extracted_date") < "2024-01-20", F.col("_extracted_date") >= "2024-01-20"):
        profiles.keep_profiles(profiles.profile_extracts(raw.filter(part), columns, keys, "_extracted_date"), path)
    out = profiles.merged_profile(profiles.read_profiles(spark, path), raw, columns, keys)
    return out.select("measure", F.when(F.col("error") == 0, F.round("value", 6)).alias("value"), "passed")


@query(sql.with_(sql.RAW, select=f"select *, {_REASON} as reject_reason from raw where {_REASON} is not null"))
def quarantine_sink(spark, d):
    """The rejected rows as they were filed, a directory for each reason."""
    path = scratch(spark, "quarantine")
    tables.write_quarantine(checks.quarantine(Feed(spark, d).raw, lifecycle.raw_rules())[1], path)
    return spark.read.parquet(path).withColumn("_extracted_date", F.col("_extracted_date").cast("string"))


@query(sql.with_(sql.USERS, select="""select unnest(['accepted:audit_phase__c', 'required:division', 'unique:id']) as measure"""))
def closed_gate(spark, d):
    """The measures a gate names when it stops a run, each of them."""
    rules = {"required": ["name", "division"], "unique": ["id"], "accepted": {"audit_phase__c": AUDIT_PHASES}}
    report = checks.apply_rules(Feed(spark, d).staged, rules)
    try:
        checks.gate(report, name="rule")
        failed = []
    except checks.QualityGateClosed as closed:
        failed = closed.measures
    return small_table(spark, [(m,) for m in failed], "measure string")


def _staged_rules():
    return [
        ("division", ~F.col("division").isin(*DIVISIONS)),
        ("audit_phase__c", ~F.col("audit_phase__c").isin(*AUDIT_PHASES)),
        ("name", is_blank("name")),
    ]


@query(sql.with_(sql.DIM, select=f"""select 'DataQualityScore' as metric,
  round(100 * (1 - count(*) filter (where division not in {sql.listed(DIVISIONS)} or audit_phase__c not in {sql.listed(AUDIT_PHASES)}) / count(*)), 4) as score from staged
union all select 'SCDIntegrityScore', round(100 * (1 - count(*) filter (where n <> 1) / count(*)), 4)
from (select user_id, count(*) filter (where is_current and not is_deleted) as n from dim group by user_id)"""))
def dq_scores(spark, d):
    f = Feed(spark, d)
    return checks.quality_scores(f.staged, _staged_rules(), f.dim, USERS)


_COUNTS = f"""select 'scd_integrity' as test_name, (select count(*) from (select user_id from dim where is_current and not is_deleted
    group by user_id having count(*) > 1)) as violation_count, 'Each user should have exactly one current record' as description
union all select 'scd_history_completeness', (select count(*) from (select extract(day from update_date
    - lag(update_date) over (partition by user_id order by update_date)) as g from dim where not is_deleted) where g > 1),
  'SCD history should be complete without gaps'
union all select 'tracked_field_changes', (select count(*) from n where rn > 1 and division = coalesce(prev_division, division)
    and audit_phase__c = coalesce(prev_audit_phase__c, audit_phase__c)),
  'SCD records should only be created when tracked fields change'
union all select 'business_rules', (select count(*) from dim where not is_deleted and (division not in {sql.listed(DIVISIONS)}
    or audit_phase__c not in {sql.listed(AUDIT_PHASES)} or name is null or trim(name) = '')),
  'All business rules should be satisfied'
union all select 'overall_statistics', 0, concat('Total records: ', count(*), ', Unique users: ', count(distinct user_id),
  ', Current records: ', count(*) filter (where is_current and not is_deleted),
  ', Historical records: ', count(*) filter (where not is_current and not is_deleted),
  ', Deleted records: ', count(*) filter (where is_deleted)) from dim"""


@query(sql.with_(sql.DIM, _NEIGHBOURS, select=f"""select * from ({_COUNTS}) c
order by case when test_name = 'overall_statistics' then 1 else 2 end, test_name"""))
def scd_suite(spark, d):
    f = Feed(spark, d)
    return report.scd_suite(f.dim, USERS, f.cuts)


@query(sql.with_(sql.DIM, _NEIGHBOURS, select=f"select * from ({_COUNTS}) c"))
def suite_after_merge(spark, d):
    """The suite from kept counts, of which a merge of late changes replaces those of three hash buckets."""
    f, path = Feed(spark, d), scratch(spark, "history")
    moved = bucket_of("user_id", 16) < 3
    tables.write_history(f.build(f.rows.filter(~moved | (F.col("update_date") < F.lit(SPLIT).cast("timestamp_ntz")))), path, USERS)
    kept.refresh_counts(spark, path, USERS, cuts=f.cuts)
    rows = f.rows.filter(moved)
    keys = rows.select("user_id").distinct()
    tables.merge_into(spark, path, rows, USERS, run_id="late", cuts=f.cuts, now=now(), keys=keys, complete=True)
    kept.refresh_counts(spark, path, USERS, keys, f.cuts)
    return report.suite_of(kept.read_counts(spark, path))


_REPORT = f"""select 'sf_user_scd_test_report' as report_type, test_name, violation_count,
  case when violation_count = 0 then 'PASS' when violation_count > 0 and test_name <> 'overall_statistics' then 'FAIL' else 'INFO' end as test_status,
  description from ({_COUNTS}) c"""


@query(sql.with_(sql.DIM, _NEIGHBOURS, select=_REPORT))
def scd_report(spark, d):
    f = Feed(spark, d)
    return report.scd_report(report.scd_suite(f.dim, USERS, f.cuts)).drop("report_generated_at")


@query(sql.with_(sql.DIM, _NEIGHBOURS, select=_REPORT))
def report_sink(spark, d):
    """The report as its JSON file holds it."""
    f, path = Feed(spark, d), scratch(spark, "report")
    lines = report.scd_report(report.scd_suite(f.dim, USERS, f.cuts))
    tables.write_report(lines, path)
    return spark.read.schema(lines.schema).json(path).drop("report_generated_at")


@query(sql.with_(sql.DIM, _NEIGHBOURS, select=f"""select count(*) as total_tests, count(*) filter (where test_status = 'PASS') as passed,
  count(*) filter (where test_status <> 'PASS') as failed,
  round(count(*) filter (where test_status = 'PASS') / count(*) * 100, 2) as success_rate from ({_REPORT}) r"""))
def suite_summary(spark, d):
    f = Feed(spark, d)
    lines = report.scd_report(report.scd_suite(f.dim, USERS, f.cuts))
    return report.suite_summary(lines, F.col("test_status") == "PASS")


# --- Incremental maintenance -------------------------------------------------------------

OLD = f"old_src as (select * from src where update_date < timestamp '{SPLIT}')"
NEW = f"new_src as (select * from src where update_date >= timestamp '{SPLIT}')"
_OLD_DIM = [sql.HISTORY, OLD, NEW, sql.dim("old", "old_src")]
_KEYS = "keys as (select distinct user_id from src where update_date > (select max(update_date) from old))"


@query(sql.with_(*_OLD_DIM, _KEYS, select="select * from keys"))
def updated_keys(spark, d):
    f = Feed(spark, d)
    return merge.updated_keys(f.rows, f.old, USERS)


@query(sql.with_(*_OLD_DIM, select="""select user_id from src group by user_id
having max(update_date) > coalesce((select max(o.update_date) from old o where o.user_id = src.user_id), timestamp '1900-01-01')"""))
def updated_keys_per_key(spark, d):
    f = Feed(spark, d)
    return merge.updated_keys(f.rows, f.old, USERS, per_key=True)


_PARTIAL = sql.dim("new", "new_src")
_CLOSED = """closed as (select * replace (false as is_current) from old
  where is_current and user_id in (select user_id from keys) and _scd_id not in (select _scd_id from new))"""


@query(sql.with_(*_OLD_DIM, _KEYS, _PARTIAL, _CLOSED, select="select * from closed"))
def closed_versions(spark, d):
    """A staging of the recent rows only closes the current versions it replaces."""
    f = Feed(spark, d)
    recent = f.since(SPLIT)
    keys = merge.updated_keys(recent, f.old, USERS)
    return merge.close_versions(f.old, keys, USERS, f.build(recent), now())


@query(sql.with_(*_OLD_DIM, _KEYS, select="""select * replace (false as is_current) from old
where is_current and user_id in (select user_id from keys)"""))
def closed_all_versions(spark, d):
    """Every current version of an updated key, derived again or not."""
    f = Feed(spark, d)
    return merge.close_versions(f.old, merge.updated_keys(f.rows, f.old, USERS), USERS, now=now())


@query(sql.with_(sql.DIM, select="select * from dim"))
def scd2_merge(spark, d):
    """Two batches merged equal one full build."""
    f = Feed(spark, d)
    return merge.scd2_merge(f.old, f.rows, USERS, cuts=f.cuts, now=now())


@query(sql.with_(*_OLD_DIM, _KEYS, _PARTIAL, _CLOSED, select="""select * from old where _scd_id not in (select _scd_id from closed)
union all select * from closed union all select * from new"""))
def scd2_merge_partial(spark, d):
    """Recent rows only, without continuing from the stored history."""
    f = Feed(spark, d)
    return merge.scd2_merge(f.old, f.since(SPLIT), USERS, cuts=f.cuts, now=now())


_SEEDED = f"""first_new as (select user_id, min(update_date) as first_date from new_src group by user_id),
seeds as (select o.* from old o join first_new n using (user_id) where o.update_date < n.first_date
  qualify row_number() over (partition by o.user_id order by o.version_sequence desc) = 1),
mixed as (select user_id, name, division, audit_phase__c, is_active, update_date, is_deleted, _extracted_at, _extraction_run_id,
    true as seed from seeds
  union all select *, false from new_src),
m_seen as (select *, lag(division) over w as prev_division, lag(audit_phase__c) over w as prev_audit_phase__c, row_number() over w as rn
  from mixed window w as {sql.KEYED}),
m_all as (select {sql.USER_KEY} as user_key, m.user_id, name, division, audit_phase__c, is_active, update_date,
    case when is_deleted then false else update_date = max(update_date) over {sql.ALL_KEY} end as is_current,
    is_deleted, {sql.NOW} as _dbt_updated_at, _extracted_at, _extraction_run_id, {sql.SCD_ID} as _scd_id,
    cast(row_number() over w + coalesce((select s.version_sequence from seeds s where s.user_id = m.user_id), 0) as int) as version_sequence
  from m_seen m where {sql.CHANGED} and not seed window w as {sql.KEYED}),
new as (select * from m_all where {sql.VALID}),
closed as (select * replace (false as is_current) from old where is_current and user_id in (select user_id from m_all))"""


@query(sql.with_(*_OLD_DIM, _SEEDED, select="""select * from old where _scd_id not in (select _scd_id from closed)
union all select * from closed union all select * from new"""))
def lookback_seeded(spark, d):
    """Recent rows only, continued from the stored history."""
    f = Feed(spark, d)
    return merge.scd2_merge(f.old, f.since(SPLIT), USERS, cuts=f.cuts, seeded=True, now=now())


@query(sql.with_(*_OLD_DIM, sql.dim(), select="""select count(*) filter (where o._scd_id is null and not n.is_deleted) as records_created,
  count(*) filter (where o._scd_id is not null and o.is_current <> n.is_current) as records_updated,
  count(*) filter (where o._scd_id is null and n.is_deleted) as records_deleted
from dim n left join old o on n._scd_id = o._scd_id"""))
def merge_stats(spark, d):
    f = Feed(spark, d)
    return merge.merge_stats(f.old, merge.scd2_changes(f.old, f.rows, USERS, cuts=f.cuts, now=now()), USERS)


@query(sql.with_(sql.DIM, select="select * from dim"))
def scd2_apply(spark, d):
    """The same two batches against a stored, bucketed table."""
    f, path = Feed(spark, d), scratch(spark, "history")
    tables.write_history(f.build(f.before(SPLIT)), path, USERS)
    tables.merge_into(spark, path, f.rows, USERS, run_id="second", cuts=f.cuts, now=now())
    return tables.read_history(spark, path)


@query(sql.with_(sql.DIM, select="select * from dim"))
def compact(spark, d):
    """A history written in two parts, its cold directories compacted."""
    f, path = Feed(spark, d), scratch(spark, "compact")
    tables.write_history(f.build(f.before(SPLIT)), path, USERS)
    tables.merge_into(spark, path, f.rows, USERS, run_id="second", cuts=f.cuts, now=now())
    tables.compact(spark, path, USERS, "2024-02-02 00:00:00")
    return tables.read_history(spark, path)


_FULL = "*, lastmodifieddate as dwh_start_ts, cast(null as timestamp) as dwh_end_ts, true as dwh_active_flag"


@query(sql.with_(sql.USERS, select=f"select {_FULL} from staged"))
def dim_full(spark, d):
    return merge.dim_full(Feed(spark, d).staged)


_SECOND = [
    sql.USERS,
    f"t as (select {_FULL} from staged where lastmodifieddate < timestamp '{SPLIT}')",
    "latest as (select * from staged where lastmodifieddate > (select max(lastmodifieddate) from t))",
    """ends as (select t.id, t.lastmodifieddate, min(s.lastmodifieddate) as changed_at from t join latest s on t.id = s.id
  where t.dwh_active_flag and (t.division <> s.division or t.audit_phase__c <> s.audit_phase__c) group by t.id, t.lastmodifieddate)""",
]
_ENDED = """select t.* replace (coalesce(e.changed_at, t.dwh_end_ts) as dwh_end_ts, e.changed_at is null as dwh_active_flag)
from t {kind} join ends e on t.id = e.id and t.lastmodifieddate = e.lastmodifieddate"""


def _second(spark, d) -> tuple[DataFrame, DataFrame]:
    staged = Feed(spark, d).staged
    at = F.lit(SPLIT).cast("timestamp_ntz")
    old = merge.dim_full(staged.filter(F.col("lastmodifieddate") < at))
    return written(old, "second"), staged


@query(sql.with_(*_SECOND, select=f"{_ENDED.format(kind='left')} union all select {_FULL} from latest"))
def dim_merge(spark, d):
    return merge.dim_merge(*_second(spark, d))


@query(sql.with_(*_SECOND, select=f"{_ENDED.format(kind='inner')} union all select {_FULL} from latest"))
def dim_changes(spark, d):
    return merge.dim_changes(*_second(spark, d))


# --- Metrics and alarms ------------------------------------------------------------------


def _tumbling(seconds: int) -> str:
    return f"time_bucket(interval {seconds} second, ts, timestamp '1970-01-01')"


@query(f"""select event_type as metric, {_tumbling(21600)} as window_start, sum(value) as value
from events group by all""")
def metric_windows(spark, d):
    return metrics.metric_windows(feeds.metrics(spark, d), 21_600, "Sum")


@query(f"""select event_type as metric, {_tumbling(300)} as window_start, avg(value) as value from events group by all""")
def metric_windows_average(spark, d):
    return metrics.metric_windows(feeds.metrics(spark, d), 300, "Average")


# The alarms' shapes on the metrics at hand.
EVENT_ALARMS = (
    AlarmRule("pipeline-failures", "error", "Sum", 3600, ">=", 60),
    AlarmRule("pipeline-duration", "view", "Average", 3600, ">", 30),
    AlarmRule("data-quality", "purchase", "Average", 3600, "<", 15, 2, "breaching"),
    AlarmRule("scd-integrity", "signup", "Average", 3600, "<", 10, 1, "breaching"),
    AlarmRule("record-volume", "click", "Sum", 21600, "<", 300, 1, "breaching"),
)


def _spine(seconds: int) -> str:
    return f"""(select unnest(generate_series(timestamp '{START}', timestamp '{END}' - interval {seconds} second,
    interval {seconds} second)) as window_start)"""


def _alarm_sql(r: AlarmRule, source: str = "events", name: str = "event_type") -> str:
    agg = {"Sum": "sum", "Average": "avg"}[r.statistic]
    missing = "true" if r.missing == "breaching" else "false"
    return f"""select '{r.alarm}' as alarm, '{r.metric}' as metric, window_start, value, '{r.operator}' as operator,
    {float(r.threshold)}::double as threshold, '{r.severity}' as severity, breach,
    count(*) filter (where breach) over (order by window_start rows between {r.periods - 1} preceding and current row) = {r.periods} as in_alarm
  from (select s.window_start, w.value, case when w.value is null then {missing} else w.value {r.operator} {r.threshold} end as breach
    from {_spine(r.period)} s left join (select {_tumbling(r.period)} as window_start, {agg}(value) as value
      from {source} where {name} = '{r.metric}' group by all) w on s.window_start = w.window_start)"""


STATES = "states as (" + "\n union all ".join(_alarm_sql(r) for r in EVENT_ALARMS) + ")"


def _states(spark, d) -> DataFrame:
    return metrics.alarm_states(feeds.metrics(spark, d), EVENT_ALARMS, START, END)


@query(sql.with_(STATES, select="select * from states"))
def metric_alarms(spark, d):
    return _states(spark, d)


_ERROR_RULE = AlarmRule("busy-errors", "error", "Sum", 3600, ">", 20, 3)


@query(sql.with_(f"states as ({_alarm_sql(_ERROR_RULE)})", select="select window_start, value, breach, in_alarm from states"))
def metric_consecutive(spark, d):
    states = metrics.alarm_states(feeds.metrics(spark, d), [_ERROR_RULE], START, END)
    return states.select("window_start", "value", "breach", "in_alarm")


@query(f"""with m as (select distinct event_type as metric from events),
w as (select event_type as metric, {_tumbling(3600)} as window_start, sum(value) as value from events group by all)
select m.metric, s.window_start, w.value, w.value is null as missing
from m cross join {_spine(3600)} s left join w on w.metric = m.metric and w.window_start = s.window_start""")
def metric_gapfill(spark, d):
    return metrics.fill_missing(metrics.metric_windows(feeds.metrics(spark, d), 3_600, "Sum"), 3_600, START, END)


_VOLUME = AlarmRule("record-volume", "click", "Sum", 21600, "<", 400, 1, "breaching")


@query(sql.with_(f"states as ({_alarm_sql(_VOLUME)})", select="select * from states"))
def volume_alarm(spark, d):
    return metrics.volume_alarm(feeds.metrics(spark, d), START, END, 400, "click")


@query(sql.with_(STATES, select=f"""select window_start, bool_or(in_alarm) as in_alarm from states
where alarm in {sql.listed(metrics.HEALTH_MEMBERS)} group by window_start"""))
def composite_alarm(spark, d):
    return metrics.composite(_states(spark, d))


_RUN_METRICS = f"""m as (
  select unnest(['RecordsProcessed', 'DataQualityScore', 'ExecutionTime', 'ExecutionsFailed', 'NumFailedTasks', 'RunnerErrors', 'ValidatorErrors']) as metric, ts,
    unnest([n::double, round(100 * (1 - rejected / n), 4)::double, ms::double, no_time::double, no_id::double, no_name::double, rejected::double]) as value
  from (select _extraction_run_id, min(_extracted_at) as ts, count(*) as n, count({_REASON}) as rejected,
      count(*) filter (where lastmodifieddate is null) as no_time, count(*) filter (where id is null) as no_id,
      count(*) filter (where name is null or trim(name) = '') as no_name,
      1000 * date_diff('second', date_trunc('second', min(lastmodifieddate)), date_trunc('second', max(_extracted_at))) as ms
    from raw group by _extraction_run_id)
  union all select 'SCDIntegrityScore', min(ts), round(100 * avg(case when one then 1 else 0 end), 4)
  from (select _extraction_run_id, id, min(_extracted_at) as ts from raw where id is not null group by all) k
    join (select user_id, count(*) filter (where is_current) = 1 as one from dim group by user_id) l on k.id = l.user_id
  group by _extraction_run_id)"""
_RUN_STATES = "states as (" + "\n union all ".join(_alarm_sql(r, "m", "metric") for r in metrics.ALARMS) + ")"


def _run_metrics(spark, d) -> DataFrame:
    f = Feed(spark, d)
    failures = {
        "ExecutionsFailed": F.col("lastmodifieddate").isNull(), "NumFailedTasks": F.col("id").isNull(),
        "RunnerErrors": is_blank("name"), "ValidatorErrors": checks.any_broken(lifecycle.raw_rules()),
    }
    return metrics.run_metrics(
        f.raw, checks.any_broken(lifecycle.raw_rules()), failures, f.dim, USERS, "id", "lastmodifieddate", "_extracted_at", "_extraction_run_id"
    )


@query(sql.with_(sql.DIM, _RUN_METRICS, select="select metric, ts, value from m"))
def run_metrics(spark, d):
    """What the alarms watch, for each day's run of the feed."""
    return _run_metrics(spark, d)


@query(sql.with_(sql.DIM, _RUN_METRICS, _RUN_STATES, select="select * from states where in_alarm or breach or value is not null"))
def run_alarms(spark, d):
    """The monitored pipeline's own eight alarms over these metrics."""
    states = metrics.alarm_states(_run_metrics(spark, d), metrics.ALARMS, START, END)
    return states.filter("in_alarm or breach or value is not null")


@query(sql.with_(sql.DIM, _RUN_METRICS, _RUN_STATES, select=f"""select window_start, bool_or(in_alarm) as in_alarm from states
where alarm in {sql.listed(metrics.HEALTH_MEMBERS)} group by window_start"""))
def run_health(spark, d):
    return metrics.composite(metrics.alarm_states(_run_metrics(spark, d), metrics.ALARMS, START, END))


_TYPES = ("click", "error", "purchase", "signup", "view")


@query(f"""select {_tumbling(21600)} as window_start,
  {", ".join(f"sum(value) filter (where event_type = '{t}') as {t}" for t in _TYPES)} from events group by all""")
def metric_pivot(spark, d):
    return metrics.metric_pivot(metrics.metric_windows(feeds.metrics(spark, d), 21_600, "Sum"), _TYPES)


@query(sql.with_(sql.RAW, select="""select _extraction_run_id || '_duration' as metric, min(lastmodifieddate) as ts,
  cast(date_diff('second', date_trunc('second', min(lastmodifieddate)), date_trunc('second', max(_extracted_at))) as double) as value
from raw group by _extraction_run_id"""))
def run_durations(spark, d):
    spans = Feed(spark, d).raw.groupBy("_extraction_run_id").agg(
        F.min("lastmodifieddate").alias("started_at"), F.max("_extracted_at").alias("ended_at")
    )
    return metrics.durations(spans, "started_at", "ended_at", "_extraction_run_id")


@query("""select ts, upper(event_type) || ' ' || props as message from events
where regexp_matches(upper(event_type) || ' ' || props, 'ERROR') order by ts desc, message limit 20""")
def error_tail(spark, d):
    return metrics.error_tail(feeds.logs(spark, d))


# --- Streams and the whole run -----------------------------------------------------------


def _out_of_order(events: DataFrame, key: str, name: str):
    """Lands the events of each key in three parts, the middle of its time last; yields after each."""
    spark, landed = events.sparkSession, scratch(events.sparkSession, name)
    third = F.ntile(3).over(Window.partitionBy(key).orderBy("ts", "event_id"))
    parted = written(events.withColumn("third", third), "thirds")
    for part in (1, 3, 2):
        parted.where(F.col("third") == part).drop("third").write.mode("append").parquet(landed)
        yield stream_table(spark, landed, events.schema)


@query(sql.with_(sql.DIM, select="select * exclude (_dbt_updated_at) from dim"))
def stream_scd2_history(spark, d):
    """Three batches out of order, nothing filtered: the history of a full build."""
    path, checkpoint = scratch(spark, "stream"), scratch(spark, "checkpoint")

    def prepare(batch: DataFrame) -> DataFrame:
        return staging.to_history_names(staging.stage_users(feeds.raw_from(batch)))

    for events in _out_of_order(feeds.table(spark, d, "events"), "user_id", "late-changes"):
        stream_scd2(events, USERS, path, checkpoint, prepare).awaitTermination()
    return tables.read_history(spark, path).drop("_dbt_updated_at")


@query(f"""select event_type as metric, {_tumbling(21600)} as window_start, sum(value) as value from events group by all""")
def stream_metric_windows(spark, d):
    schema = feeds.table(spark, d, "events").schema
    events = stream_table(spark, f"{d}/events.parquet", schema)
    path = scratch(spark, "windows")
    values = events.select(F.col("event_type").alias("metric"), "ts", "value")
    stream_windows(values, 21_600, path, scratch(spark, "checkpoint")).awaitTermination()
    return read_windows(spark, path).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""select event_type as metric, {_tumbling(21600)} as window_start, sum(value) as value from events group by all""")
def stream_metric_windows_late(spark, d):
    """The same from three batches out of order: the middle of the time comes last, far behind the others."""
    path, checkpoint = scratch(spark, "windows"), scratch(spark, "checkpoint")
    for events in _out_of_order(feeds.table(spark, d, "events"), "event_type", "late-events"):
        values = events.select(F.col("event_type").alias("metric"), "ts", "value")
        stream_windows(values, 21_600, path, checkpoint).awaitTermination()
    return read_windows(spark, path).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""select event_type as metric, cast(user_id % 4 as int) as shard, {_tumbling(3600)} as window_start, avg(value) as value, min(value) as low,
  max(value) as high, cast(count(value) as double) as n from events group by all""")
def stream_metric_statistics(spark, d):
    """All statistics of hourly windows by a dimension, from the same partials of three batches out of order."""
    path, checkpoint = scratch(spark, "windows"), scratch(spark, "checkpoint")
    shard = F.pmod("user_id", F.lit(4)).cast("int").alias("shard")
    for events in _out_of_order(feeds.table(spark, d, "events"), "event_type", "stat-events"):
        values = events.select(F.col("event_type").alias("metric"), shard, "ts", "value")
        stream_windows(values, 3_600, path, checkpoint, dims=["shard"]).awaitTermination()
    sides = {"value": "Average", "low": "Minimum", "high": "Maximum", "n": "SampleCount"}
    read = [read_windows(spark, path, s, ["shard"]).withColumnRenamed("value", c) for c, s in sides.items()]
    out = reduce(lambda a, b: a.join(b, ["metric", "shard", "window_start"]), read)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_SHARD_RULES = (
    AlarmRule("shard-errors", "error", "Sum", 3600, ">", 4, 3),
    AlarmRule("shard-quiet", "signup", "Sum", 7200, "<", 8, 2, "breaching"),
)


def _shard_sql(r: AlarmRule) -> str:
    agg, missing = {"Sum": "sum", "Average": "avg"}[r.statistic], "true" if r.missing == "breaching" else "false"
    return f"""select '{r.alarm}' as alarm, '{r.metric}' as metric, shard, window_start, value, '{r.operator}' as operator,
    {float(r.threshold)}::double as threshold, '{r.severity}' as severity, breach,
    count(*) filter (where breach) over (partition by shard order by window_start rows between {r.periods - 1} preceding and current row) = {r.periods} as in_alarm
  from (select h.shard, s.window_start, w.value, case when w.value is null then {missing} else w.value {r.operator} {r.threshold} end as breach
    from {_spine(r.period)} s cross join (select distinct cast(user_id % 4 as int) as shard from events) h
    left join (select {_tumbling(r.period)} as window_start, cast(user_id % 4 as int) as shard, {agg}(value) as value
      from events where event_type = '{r.metric}' group by all) w on s.window_start = w.window_start and w.shard = h.shard)"""


@query("\n union all ".join(_shard_sql(r) for r in _SHARD_RULES))
def alarms_by_dimension(spark, d):
    """Alarms of each shard apart, evaluated in two steps, the second going on from the streaks of the first."""
    rows = feeds.table(spark, d, "events").select(F.col("event_type").alias("metric"), F.pmod("user_id", F.lit(4)).cast("int").alias("shard"), "ts", "value")
    shards = rows.select("shard").distinct()
    early = written(metrics.alarm_states(rows, _SHARD_RULES, START, SPLIT, dims=["shard"], series=shards), "alarms")
    late = metrics.alarm_states(rows, _SHARD_RULES, SPLIT, END, dims=["shard"], series=shards, carried=metrics.streaks(early, ["shard"]))
    return early.unionByName(late).drop("streak")


@query(sql.with_(
    sql.HISTORY, "stamped as (select * replace (" + sql.NOW + " as _extracted_at, case when _extracted_at < timestamp '"
    + SPLIT + "' then 'first' else 'second' end as _extraction_run_id) from src)",
    sql.dim("dim", "stamped"), select="select * from dim",
))
def scheduled_runs(spark, d):
    """Two scheduled runs of the whole lifecycle, the second after more rows have arrived, with an overlap."""
    raw, made = Feed(spark, d).raw, ["_extracted_at", "_extraction_run_id", "_extracted_date"]
    root, at = scratch(spark, "runs"), F.lit(SPLIT).cast("timestamp_ntz")
    early = raw.filter(F.col("_extracted_at") < at).drop(*made)
    lifecycle.run_once(spark, early, root, "first", now=now())
    lifecycle.run_once(spark, raw.drop(*made), root, "second", now=now(), overlap_days=2)
    return tables.read_history(spark, lifecycle.Paths(root).history)
