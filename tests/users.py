"""Small hand-made user histories."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark import USERS
from tidemark.operators import history

BEGIN = datetime(2024, 1, 1)
SCHEMA = """user_id string, name string, division string, audit_phase__c string, is_active boolean,
update_date timestamp_ntz, is_deleted boolean, _extracted_at timestamp_ntz, _extraction_run_id string"""


def at(t) -> datetime:
    return BEGIN + timedelta(days=t)


def rows(spark, *changes, key="K"):
    """(t, division, deleted) triples, or (key, t, division, deleted)."""
    data = []
    for c in changes:
        k, t, division, deleted = c if len(c) == 4 else (key, *c)
        data.append((k, f"name {k}", division, "Phase1", True, at(t), deleted, at(t), "r"))
    return spark.createDataFrame(data, SCHEMA).coalesce(1)


def build(df, cuts=None, **options):
    return history.scd2_build(df, USERS, cuts, now=F.lit(BEGIN).cast("timestamp_ntz"), **options)


def shape(dim, spec=USERS):
    """(key, t, division, current, sequence, effective_to, deleted), in order."""
    got = history.with_validity(dim, spec).collect()
    day = lambda x: None if x is None else (x - BEGIN).days
    return sorted(
        [
            (r["user_id"], day(r["update_date"]), r["division"], r["is_current"], r["version_sequence"],
             day(r["effective_to"]), r["is_deleted"])
            for r in got
        ],
        key=repr,
    )


def same(a, b, but=()):
    """Whether two frames hold the same rows (as bags), some columns left out."""
    columns = sorted(c for c in a.columns if c not in but)
    assert columns == sorted(c for c in b.columns if c not in but)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
