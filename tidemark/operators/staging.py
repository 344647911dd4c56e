"""From raw extracts to clean rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.clean import default_false, is_blank, standardize_enum
from tidemark.functions.times import moment
from tidemark.session import small_table
from tidemark.spec import AUDIT_PHASES, DIVISIONS, USER_COLUMNS


def clean_rows(
    raw: DataFrame,
    key: str,
    trim: Sequence[str] = (),
    enums: Mapping[str, Sequence[str]] | None = None,
    flags: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Drop rows without a key, then trim, standardise and default the named columns."""
    enums = enums or {}
    columns = [F.col(key)]
    columns += [F.trim(F.col(c)).alias(c) for c in trim]
    columns += [standardize_enum(c, v).alias(c) for c, v in enums.items()]
    columns += [default_false(c).alias(c) for c in flags]
    columns += [F.col(c) for c in keep]
    return raw.filter(F.col(key).isNotNull()).select(*columns)


def quality_filter(df: DataFrame, not_blank: Sequence[str], not_null: Sequence[str]) -> DataFrame:
    tests = [~is_blank(c) for c in not_blank] + [F.col(c).isNotNull() for c in not_null]
    return df.filter(reduce(and_, tests))


def stage_users(raw: DataFrame) -> DataFrame:
    """The user staging step: narrow per-row work, no shuffle."""
    cleaned = clean_rows(
        raw,
        key="id",
        trim=["name"],
        enums={"division": DIVISIONS, "audit_phase__c": AUDIT_PHASES},
        flags=["isactive", "isdeleted"],
        keep=["lastmodifieddate", "createddate", "_extracted_at", "_extraction_run_id"],
    )
    return quality_filter(cleaned, not_blank=["name"], not_null=["lastmodifieddate"])


def to_history_names(staged: DataFrame) -> DataFrame:
    """Staged column names become the dimension's; columns it does not carry are dropped."""
    return staged.filter(F.col("lastmodifieddate").isNotNull()).drop("createddate").withColumnsRenamed(USER_COLUMNS)


def in_lists(df: DataFrame, valid: Mapping[str, Iterable[str]]) -> DataFrame:
    tests = [F.col(c).isin(*values) for c, values in valid.items()]
    return df.filter(reduce(and_, tests)) if tests else df


def between_dates(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows in the closed range ``[start, end]``."""
    return df.filter(F.col(ts).between(moment(df, ts, start), moment(df, ts, end)))


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of both with the source's columns: new ones are added, removed ones dropped."""
    kept = [c for c in target.columns if c in source.columns]
    return source.unionByName(target.select(*kept), allowMissingColumns=True)


def common_type(spark: SparkSession, old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds the values of both; where Spark knows none, the old one.

    Fields inside structs, arrays and maps are merged one by one; a struct has the fields
    of both.  Text that is retyped, or a type that becomes text, stays what it was.
    """
    if old == new:
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        names = [*old.names, *[n for n in new.names if n not in old.names]]
        one = lambda s, n: s[n].dataType if n in s.names else None
        both = [(n, one(old, n), one(new, n)) for n in names]
        return T.StructType([T.StructField(n, b if a is None else a if b is None else common_type(spark, a, b)) for n, a, b in both])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(common_type(spark, old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(common_type(spark, old.keyType, new.keyType), common_type(spark, old.valueType, new.valueType))
    if isinstance(old, T.StringType) or isinstance(new, T.StringType):
        return old
    try:
        # Reads no rows: the analyzer's own rule for two types.
        return spark.range(0).select(F.coalesce(F.lit(None).cast(old), F.lit(None).cast(new)).alias("c")).schema["c"].dataType
    except AnalysisException:
        return old


def fitted(value: Column, kind: T.DataType, wanted: T.DataType) -> tuple[Column, Column]:
    """A value in another type, NULL where it does not fit; and whether all of it fits."""
    if kind == wanted:
        return value, F.lit(True)
    if isinstance(kind, T.StructType) and isinstance(wanted, T.StructType):
        parts = {f.name: fitted(value[f.name], kind[f.name].dataType, f.dataType) if f.name in kind.names else (F.lit(None).cast(f.dataType), F.lit(True)) for f in wanted}
        made = F.when(value.isNotNull(), F.struct(*[c.alias(n) for n, (c, _) in parts.items()]))
        return made, F.coalesce(reduce(and_, [ok for _, ok in parts.values()]), F.lit(True))
    if isinstance(kind, T.ArrayType) and isinstance(wanted, T.ArrayType):
        part = lambda at: lambda x: fitted(x, kind.elementType, wanted.elementType)[at]
        return F.transform(value, part(0)), F.coalesce(F.forall(value, part(1)), F.lit(True))
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) or isinstance(wanted, (T.StructType, T.ArrayType, T.MapType)):
        return F.lit(None).cast(wanted), value.isNull()
    made = value.try_cast(wanted)
    return made, value.isNull() | made.isNotNull()


def sync_schemas(target: DataFrame, source: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(rows of both with the source's columns in common types, rows with a value that does not fit).

    Rejected rows keep what they had as JSON, with the first column that does not fit.
    """
    spark = source.sparkSession
    wanted = {
        f.name: common_type(spark, target.schema[f.name].dataType, f.dataType) if f.name in target.columns else f.dataType for f in source.schema
    }
    good, bad = [], []
    for df in (source, target):
        both = {c: fitted(F.col(c), df.schema[c].dataType, kind) for c, kind in wanted.items() if c in df.columns}
        why = F.lit(None).cast("string")
        for c, (_, ok) in reversed(both.items()):
            why = F.when(~ok, f"does not fit: {c}").otherwise(why)
        good.append(df.filter(why.isNull()).select(*[v.alias(c) for c, (v, _) in both.items()]))
        bad.append(df.filter(why.isNotNull()).select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row"), why.alias(reason)))
    return good[0].unionByName(good[1], allowMissingColumns=True), bad[0].unionByName(bad[1])


def schema_changes(target: DataFrame, source: DataFrame) -> DataFrame:
    """What differs between two schemas: (column_name, change, old_type, new_type).

    Reads no rows; a caller that must not stop on a change can log this and go on.
    """
    old = {f.name: f.dataType.simpleString() for f in target.schema}
    new = {f.name: f.dataType.simpleString() for f in source.schema}
    rows = [(c, "added", None, new[c]) for c in new if c not in old]
    rows += [(c, "removed", old[c], None) for c in old if c not in new]
    rows += [(c, "retyped", old[c], new[c]) for c in new if c in old and old[c] != new[c]]
    schema = "column_name string, change string, old_type string, new_type string"
    return small_table(source.sparkSession, sorted(rows), schema)
