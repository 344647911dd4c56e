"""The expected results as plain SQL over the given tables.

Each piece is a common table expression; queries name the pieces they build on.
"""

from __future__ import annotations

from tidemark.plans.feeds import RAW_SQL
from tidemark.spec import AUDIT_PHASES, DIVISIONS

NOW = "timestamp '2024-02-01 00:00:00'"


def listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _enum(column: str, values) -> str:
    initcap = f"upper(substr(trim({column}), 1, 1)) || lower(substr(trim({column}), 2))"
    known = listed(v.upper() for v in values)
    return f"case when trim(upper({column})) in {known} then {initcap} else {column} end as {column}"


RAW = f"raw as ({RAW_SQL.format(events='events')})"
STAGED = f"""staged as (
  select id, trim(name) as name, {_enum('division', DIVISIONS)}, {_enum('audit_phase__c', AUDIT_PHASES)},
    coalesce(isactive, false) as isactive, coalesce(isdeleted, false) as isdeleted,
    lastmodifieddate, createddate, _extracted_at, _extraction_run_id
  from raw
  where id is not null and name is not null and trim(name) <> '' and lastmodifieddate is not null)"""
SRC = """src as (
  select id as user_id, name, division, audit_phase__c, isactive as is_active,
    lastmodifieddate as update_date, isdeleted as is_deleted, _extracted_at, _extraction_run_id
  from staged)"""

# The order of the versions of one user; "nulls first" where NULLs occur.
ORDER = """update_date, division nulls first, audit_phase__c nulls first, is_deleted,
    _extracted_at, _extraction_run_id, is_active, name"""
KEYED = f"(partition by user_id order by {ORDER})"
ALL_KEY = "(partition by user_id)"

_HASH = "coalesce(user_id, '_null_'), cast(epoch_us(update_date) as varchar)"
USER_KEY = f"md5(concat_ws('-', {_HASH}))"
SCD_ID = (
    f"md5(concat_ws('-', {_HASH}, coalesce(division, '_null_'), "
    "coalesce(audit_phase__c, '_null_'), cast(is_deleted as varchar)))"
)
VALID = f"name is not null and division in {listed(DIVISIONS)} and audit_phase__c in {listed(AUDIT_PHASES)}"
CHANGED = """(rn = 1 or division <> coalesce(prev_division, '')
    or audit_phase__c <> coalesce(prev_audit_phase__c, ''))"""
# The columns of the dimension.
DIM_COLUMNS = """user_key, user_id, name, division, audit_phase__c, is_active, update_date, is_current,
    is_deleted, _dbt_updated_at, _extracted_at, _extraction_run_id, _scd_id, version_sequence"""


def seen(name: str, src: str) -> str:
    return f"""{name}_seen as (
  select *, lag(division) over w as prev_division, lag(audit_phase__c) over w as prev_audit_phase__c,
    lag(update_date) over w as prev_update_date, lag(is_deleted) over w as prev_is_deleted,
    cast(row_number() over w as int) as rn
  from {src} window w as {KEYED})"""


def numbered(name: str, changed: str = CHANGED) -> str:
    """All versions with ids, flags and sequence, before values are validated."""
    return f"""{name}_all as (
  select {USER_KEY} as user_key, user_id, name, division, audit_phase__c, is_active, update_date,
    case when is_deleted then false else update_date = max(update_date) over {ALL_KEY} end as is_current,
    is_deleted, {NOW} as _dbt_updated_at, _extracted_at, _extraction_run_id,
    {SCD_ID} as _scd_id, cast(row_number() over w as int) as version_sequence
  from {name}_seen where {changed} window w as {KEYED})"""


def dim(name: str = "dim", src: str = "src", changed: str = CHANGED) -> str:
    valid = f"{name} as (select * from {name}_all where {VALID})"
    return ",\n".join([seen(name, src), numbered(name, changed), valid])


USERS = ",\n".join([RAW, STAGED])
HISTORY = ",\n".join([RAW, STAGED, SRC])
DIM = ",\n".join([HISTORY, dim()])


def with_(*pieces: str, select: str) -> str:
    return "with " + ",\n".join(pieces) + "\n" + select


# A history with faults planted, for the checks that a sound history never fails.
DAMAGED = """bad as (
  select * replace (is_current or version_sequence % 40 = 0 as is_current) from dim)"""

# Orders as a change feed with ties.
ORDER_TIE = """o_orderdate, o_orderstatus nulls first, o_orderpriority nulls first, o_orderkey"""
ORDER_DIM = f"""o_seen as (
  select o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, false as is_deleted,
    lag(o_orderstatus) over w as ps, lag(o_orderpriority) over w as pp, row_number() over w as rn
  from orders window w as (partition by o_custkey order by {ORDER_TIE})),
o_dim as (
  select o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, is_deleted,
    md5(concat_ws('-', cast(o_custkey as varchar), cast(epoch_us(o_orderdate) as varchar))) as user_key,
    o_orderdate = max(o_orderdate) over (partition by o_custkey) as is_current,
    md5(concat_ws('-', cast(o_custkey as varchar), cast(epoch_us(o_orderdate) as varchar),
      coalesce(o_orderstatus, '_null_'), coalesce(o_orderpriority, '_null_'), 'false')) as _scd_id,
    cast(row_number() over w as int) as version_sequence
  from o_seen
  where rn = 1 or o_orderstatus <> coalesce(ps, '') or o_orderpriority <> coalesce(pp, '')
  window w as (partition by o_custkey order by {ORDER_TIE}))"""
