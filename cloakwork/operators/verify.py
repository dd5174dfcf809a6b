"""The nine checks that a masked copy must pass, as queries. Only counts and booleans leave Spark."""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import INVALID, OK
from ..plans.catalog import Catalog, KeyConstraint, Snapshot, columns_frame, foreign_key_signatures, keys_frame
from ..plans.policy import ColumnRef, Policy
from .keys import Digester, group_values
from .registry import mapping_counts, small_enough

_DETAIL = re.compile("[a-z][a-z0-9_]{0,63}")


@dataclass(frozen=True)
class CheckResult:
    """details hold numbers and booleans only, so that a report can't carry data."""

    id: str
    name: str
    passed: bool
    details: dict[str, bool | int | float] = field(default_factory=dict)
    severity: str = "required"
    warned: bool = False

    def __post_init__(self) -> None:
        for k, v in self.details.items():
            if not _DETAIL.fullmatch(k) or not isinstance(v, bool | int | float) or isinstance(v, float) and not math.isfinite(v):
                raise ValueError("a check's details are finite numbers under plain names")

    @property
    def status(self) -> str:
        return "warn" if self.warned else "pass" if self.passed else "fail"


# --- building blocks ---


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows)."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in sorted(tables.items())])


def blinded(value: Column, salt: str) -> Column:
    """Salted SHA-256 of a value, null for null: what may be shuffled instead of the value."""
    return F.unhex(F.sha2(F.concat(F.lit(salt), value), 256))


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, null_count, distinct_count), all columns in one scan; distinct counts are exact and of raw values, which are blinded in the scan."""
    salt = uuid.uuid4().hex
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), blinded(F.col(c).cast("string"), salt).alias("value")) for c in columns])).alias("x")
    long = df.select(parts).select("x.*").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    empty = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    got = long.groupBy("column_name").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"), F.count("value").alias("distinct_count"))
    return empty.join(got, "column_name", "left").select("column_name", F.coalesce("null_count", F.lit(0)).alias("null_count"), F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"))


def duplicate_key_groups(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Keys that several rows share, among rows whose key parts are all non-null."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in columns])).groupBy(*columns).count().where("count > 1")


def key_null_rows(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.where(reduce(or_, [F.col(c).isNull() for c in columns]))


def orphan_rows(child: DataFrame, columns: tuple[str, ...], parent: DataFrame, target_columns: tuple[str, ...], match: str = "SIMPLE") -> DataFrame:
    """Rows of child that must have a parent and have none. SIMPLE: rows whose key parts are all non-null must; FULL: rows with any."""
    must = reduce(and_ if match == "SIMPLE" else or_, [F.col(c).isNotNull() for c in columns])
    keys = parent.select(*[F.col(c).alias(f"__parent_{i}") for i, c in enumerate(target_columns)])
    on = reduce(and_, [F.col(c) == F.col(f"__parent_{i}") for i, c in enumerate(columns)])
    return child.where(must).join(keys, on, "left_anti")


def signature_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """(missing, extra): rows of left that right lacks, and the reverse, as multisets."""
    missing = left.exceptAll(right).agg(F.count(F.lit(1)).alias("missing"))
    return missing.crossJoin(right.exceptAll(left).agg(F.count(F.lit(1)).alias("extra")))


def multiset_difference(expected: DataFrame, actual: DataFrame, column: str = "value") -> DataFrame:
    """(difference): sum over all values of |count expected - count actual|."""
    e = expected.groupBy(column).agg(F.count(F.lit(1)).alias("e"))
    a = actual.groupBy(column).agg(F.count(F.lit(1)).alias("a"))
    both = e.join(a, column, "full").select(F.abs(F.coalesce("e", F.lit(0)) - F.coalesce("a", F.lit(0))).alias("d"))
    return both.agg(F.coalesce(F.sum("d"), F.lit(0)).alias("difference"))


def positioned(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """df with position 1, 2, ... in the order of the key, nulls last: range-partitioned, numbered in parallel, and shifted by the partitions' sizes."""
    from ..functions.numbering import numbered

    return numbered(df, [F.col(c).asc_nulls_last() for c in key], "position")


def positional_mismatches(source: DataFrame, target: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """(rows_compared, mismatches) of two key columns laid side by side in key order.

    Equal multisets of keys can't mismatch, so the positions are only computed if the multisets differ.
    """
    s, t = source.select(*key), target.select(*key)
    tagged = s.withColumn("side", F.lit(1)).unionByName(t.withColumn("side", F.lit(-1)))
    if tagged.groupBy(*key).agg(F.sum("side").alias("d")).where("d <> 0").isEmpty():
        return s.agg(F.count(F.lit(1)).alias("rows_compared"), F.lit(0).cast("long").alias("mismatches"))
    a = positioned(s, key).select("position", *[F.col(c).alias(f"s_{c}") for c in key], F.lit(True).alias("in_s"))
    b = positioned(t, key).select("position", *[F.col(c).alias(f"t_{c}") for c in key], F.lit(True).alias("in_t"))
    both = a.join(b, "position", "full")
    equal = reduce(and_, [F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}")) for c in key]) & F.col("in_s").isNotNull() & F.col("in_t").isNotNull()
    return both.agg(F.count(F.lit(1)).alias("rows_compared"), F.count_if(~equal).alias("mismatches"))


_COUNTERS = ("rows_checked", "missing_mappings", "mapping_mismatches", "null_mismatches", "unchanged_values", "invalid_source_values", "invalid_target_values", "primary_key_mismatches")


def aligned_metrics(source: DataFrame, target: DataFrame, key: tuple[str, ...], column: str, mappings: DataFrame, norm, target_is_text: bool = True) -> DataFrame:
    """The counters of one column, rows paired by the order of their primary keys.

    If both sides have the same keys, pairing by position and by key is the same, and one join on
    the key does; else rows are paired by position and unequal keys are mismatches without a comparison of values.
    """
    salt = uuid.uuid4().hex
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in key], F.col(column).cast("string").alias("sv"), F.lit(True).alias("in_s"))
    # Values are hashed beside the scan, so that only digests are shuffled.
    s = s.withColumn("k", norm(F.col("sv"))).select("in_s", *[f"s_{c}" for c in key], F.col("k.status").alias("status"), F.col("k.digest").alias("h"), blinded(F.col("sv"), salt).alias("sv"))
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in key], blinded(F.col(column).cast("string"), salt).alias("tv"), F.lit(True).alias("in_t"))
    tagged = source.select(*key).withColumn("side", F.lit(1)).unionByName(target.select(*key).withColumn("side", F.lit(-1)))
    per_key = tagged.groupBy(*key).agg(F.sum("side").alias("d"), F.count(F.lit(1)).alias("n"))
    same_key = reduce(and_, [F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}")) for c in key])
    if per_key.where("d <> 0 or n <> 2").isEmpty():
        both = s.join(t, same_key)
    else:
        both = positioned(s, tuple(f"s_{c}" for c in key)).join(positioned(t, tuple(f"t_{c}" for c in key)), "position", "full")
    paired = F.coalesce(F.col("in_s") & F.col("in_t") & same_key, F.lit(False))
    side = small_enough(mappings.where(F.coalesce("replacement", F.lit("")) != "").select(F.col("source_hmac").alias("h"), blinded(F.col("replacement"), salt).alias("r")))
    both = both.join(side, "h", "left")
    source_null, valid = F.col("sv").isNull(), F.col("status") == OK
    found = valid & F.col("r").isNotNull()
    compared = paired & found & F.col("tv").isNotNull() & F.lit(target_is_text)
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return both.agg(
        count(paired).alias("rows_checked"),
        count(paired & valid & ~found).alias("missing_mappings"),
        count(compared & (F.col("tv") != F.col("r"))).alias("mapping_mismatches"),
        count(paired & ((source_null & F.col("tv").isNotNull()) | (found & F.col("tv").isNull()))).alias("null_mismatches"),
        count(compared & (F.col("tv") == F.col("sv"))).alias("unchanged_values"),
        count(paired & (F.col("status") == INVALID)).alias("invalid_source_values"),
        count(paired & found & F.col("tv").isNotNull() & ~F.lit(target_is_text)).alias("invalid_target_values"),
        count(~paired).alias("primary_key_mismatches"),
    )


def aggregate_metrics(source: DataFrame, target: DataFrame, column: str, mappings: DataFrame, norm, exact) -> DataFrame:
    """The counters of one column without a usable key: multisets of exact texts, as digests."""
    s = source.select(F.col(column).cast("string").alias("sv")).withColumn("k", norm(F.col("sv"))).select(F.col("sv").isNull().alias("s_null"), F.col("k.status").alias("status"), F.col("k.digest").alias("h"))
    side = small_enough(mappings.select(F.col("source_hmac").alias("h"), F.col("replacement").alias("r")))
    s = s.join(side, "h", "left")
    valid = F.col("status") == OK
    found = valid & (F.coalesce("r", F.lit("")) != "")
    t = target.select(F.col(column).cast("string").alias("tv"))
    mine = s.agg(F.count(F.lit(1)).alias("rows_checked"), F.count_if(valid & ~found).alias("missing_mappings"), F.count_if(F.col("status") == INVALID).alias("invalid_source_values"), F.count_if("s_null").alias("s_null"))
    theirs = t.agg(F.count_if(F.col("tv").isNull()).alias("t_null"))
    expected = s.where(found).select(exact(F.col("r"))["digest"].alias("value"))
    actual = t.where(F.col("tv").isNotNull()).select(exact(F.col("tv"))["digest"].alias("value"))
    zero = F.lit(0).cast("long")
    return mine.crossJoin(theirs).crossJoin(multiset_difference(expected, actual)).select("rows_checked", "missing_mappings", F.col("difference").alias("mapping_mismatches"), F.abs(F.col("s_null") - F.col("t_null")).alias("null_mismatches"), zero.alias("unchanged_values"), "invalid_source_values", zero.alias("invalid_target_values"), zero.alias("primary_key_mismatches"))


def nonintersection(targets: DataFrame, mappings: DataFrame, norm) -> DataFrame:
    """(distinct_target, intersection_keys, invalid_values) of one group's target values (value) and its mappings."""
    k = targets.where(F.col("value").isNotNull()).select(norm(F.col("value")).alias("k"))
    per = k.groupBy(F.col("k.status").alias("status"), F.col("k.digest").alias("source_hmac")).agg(F.count(F.lit(1)).alias("n"))
    known = mappings.select("source_hmac").distinct().withColumn("known", F.lit(True))
    return per.join(known, "source_hmac", "left").agg(F.count("source_hmac").alias("distinct_target"), F.count_if(F.col("known")).alias("intersection_keys"), F.coalesce(F.sum(F.when(F.col("status") == INVALID, F.col("n"))), F.lit(0)).alias("invalid_values"))


def schema_difference(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: columns on each side, missing and extra ones, and those of unequal type or length (frames of columns_frame())."""
    key = ["schema_name", "table_name", "column_name"]
    s = source.select(*key, F.lower(F.regexp_replace(F.trim("type"), r"\s+", " ")).alias("s_type"), F.col("max_length").alias("s_len"), F.lit(True).alias("in_s"))
    t = target.select(*key, F.lower(F.regexp_replace(F.trim("type"), r"\s+", " ")).alias("t_type"), F.col("max_length").alias("t_len"), F.lit(True).alias("in_t"))
    both = F.col("in_s").isNotNull() & F.col("in_t").isNotNull()
    return s.join(t, key, "full").agg(
        F.count("in_s").alias("source_columns"),
        F.count("in_t").alias("target_columns"),
        F.count_if(F.col("in_t").isNull()).alias("missing_target_columns"),
        F.count_if(F.col("in_s").isNull()).alias("extra_target_columns"),
        F.count_if(both & ~F.col("s_type").eqNullSafe(F.col("t_type"))).alias("type_mismatches"),
        F.count_if(both & ~F.col("s_len").eqNullSafe(F.col("t_len"))).alias("length_mismatches"),
    )


# --- the checks, in the order of the report ---


def _numbers(df: DataFrame) -> dict[str, int]:
    return {k: int(v) for k, v in df.first().asDict().items()}


def check_fingerprint(source: Snapshot, expected: str) -> CheckResult:
    same = source.fingerprint == expected
    return CheckResult("source_schema_fingerprint", "Source schema is the approved one", same, {"matches_expected": same})


def check_schema(spark: SparkSession, source: Snapshot, target: Snapshot) -> CheckResult:
    d = _numbers(schema_difference(columns_frame(spark, source), columns_frame(spark, target)))
    return CheckResult("schema_columns_types", "Columns, types and lengths agree", not any(v for k, v in d.items() if not k.endswith("t_columns") and not k.endswith("e_columns") or k.startswith(("missing", "extra"))), d)


def check_row_counts(source: Catalog, target: Catalog) -> CheckResult:
    both = row_counts(source.tables).withColumnRenamed("rows", "s").join(row_counts(target.tables).withColumnRenamed("rows", "t"), "table_name", "full")
    d = _numbers(both.agg(F.count(F.lit(1)).alias("tables_checked"), F.count_if(~F.col("s").eqNullSafe(F.col("t"))).alias("mismatched_tables")))
    return CheckResult("table_row_counts", "Row counts agree", d["mismatched_tables"] == 0, d)


def statistics_of(catalog: Catalog, policy: Policy) -> dict[ColumnRef, tuple[int, int]]:
    """(nulls, distinct) of each configured column that is there: one scan for each table."""
    out = {}
    for table, columns in policy.by_table().items():
        if table in catalog and (there := [c for c in columns if c in catalog[table].columns]):
            for r in column_statistics(catalog[table], there).collect():
                out[ColumnRef(*table.split(".", 1), r["column_name"])] = (r["null_count"], r["distinct_count"])
    return out


def check_statistics(policy: Policy, source: dict[ColumnRef, tuple[int, int]], target: dict[ColumnRef, tuple[int, int]]) -> CheckResult:
    there = [c for c in policy.columns() if c in source and c in target]
    d = {"columns_checked": len(there), "unavailable_columns": len(policy.columns()) - len(there), "null_mismatches": sum(source[c][0] != target[c][0] for c in there), "distinct_mismatches": sum(source[c][1] != target[c][1] for c in there)}
    return CheckResult("configured_column_statistics", "Null and distinct counts agree", not any(list(d.values())[1:]), d)


def check_foreign_keys(spark: SparkSession, source: Catalog, target: Catalog) -> CheckResult:
    diff = _numbers(signature_difference(foreign_key_signatures(spark, source.foreign_keys), foreign_key_signatures(spark, target.foreign_keys)))
    orphans = sum(orphan_rows(target[k.table], k.columns, target[k.target], k.target_columns, k.match).count() for k in target.foreign_keys if k.table in target and k.target in target)
    d = {"source_foreign_keys": len(source.foreign_keys), "target_foreign_keys": len(target.foreign_keys), "missing_foreign_keys": diff["missing"], "extra_foreign_keys": diff["extra"], "unvalidated_foreign_keys": sum(not k.validated for k in target.foreign_keys), "orphan_rows": orphans}
    return CheckResult("foreign_keys", "Foreign keys are there and hold", not any(list(d.values())[2:]), d)


def check_keys(spark: SparkSession, source: Catalog, target: Catalog, policy: Policy) -> CheckResult:
    diff = _numbers(signature_difference(keys_frame(spark, source.keys), keys_frame(spark, target.keys)))
    d = {"source_constraints": len(source.keys), "target_constraints": len(target.keys), "missing_constraints": diff["missing"], "extra_constraints": diff["extra"], "duplicate_key_groups": 0, "primary_key_null_rows": 0, "primary_keys_compared": 0, "transformed_primary_keys": 0, "primary_key_value_mismatches": 0}
    for k in target.keys:
        if k.table in target:
            d["duplicate_key_groups"] += duplicate_key_groups(target[k.table], k.columns).count()
            if k.kind == "PRIMARY KEY":
                d["primary_key_null_rows"] += key_null_rows(target[k.table], k.columns).count()
    there = {k.signature() for k in target.keys}
    for k in source.keys:
        if k.kind != "PRIMARY KEY" or k.signature() not in there:
            continue
        if any(policy.group_of(ColumnRef(*k.table.split(".", 1), c)) for c in k.columns):
            d["transformed_primary_keys"] += 1
            continue
        d["primary_keys_compared"] += 1
        d["primary_key_value_mismatches"] += int(positional_mismatches(source[k.table], target[k.table], k.columns).first()["mismatches"])
    bad = ("missing_constraints", "extra_constraints", "duplicate_key_groups", "primary_key_null_rows", "primary_key_value_mismatches")
    return CheckResult("primary_unique_constraints", "Primary and unique keys are there and hold", not any(d[b] for b in bad), d)


def usable_key(source: Catalog, target: Catalog, policy: Policy, table: str) -> KeyConstraint | None:
    """The table's primary key, if the target has it too and no part of it is masked."""
    key = source.primary_key(table)
    if key is None or key.signature() not in {k.signature() for k in target.keys}:
        return None
    return None if any(policy.group_of(ColumnRef(*table.split(".", 1), c)) for c in key.columns) else key


def check_mappings(source: Catalog, target: Catalog, policy: Policy, mappings: DataFrame, digester: Digester) -> CheckResult:
    d = {"columns_checked": 0, "primary_key_columns": 0, "aggregate_columns": 0, "unavailable_columns": 0} | dict.fromkeys(_COUNTERS, 0)
    for ref in policy.columns():
        table, group = f"{ref.schema}.{ref.table}", policy.group_of(ref)
        if table not in source or table not in target or ref.column not in source[table].columns or ref.column not in target[table].columns:
            d["unavailable_columns"] += 1
            continue
        g = policy.groups[group]
        mine = mappings.where(F.col("group_id") == group)
        norm, key = digester(group, g.normalization, g.allow_empty, False), usable_key(source, target, policy, table)
        if key:
            text = target[table].schema[ref.column].dataType.simpleString() == "string"
            got = aligned_metrics(source[table], target[table], key.columns, ref.column, mine, norm, text)
        else:
            got = aggregate_metrics(source[table], target[table], ref.column, mine, norm, digester(group, g.normalization, True, True))
        d["columns_checked"] += 1
        d["primary_key_columns" if key else "aggregate_columns"] += 1
        for k, v in _numbers(got).items():
            d[k] += v
    informational = ("columns_checked", "primary_key_columns", "aggregate_columns", "rows_checked")
    return CheckResult("configured_mappings", "Every value is its key's replacement", not any(v for k, v in d.items() if k not in informational), d)


def check_nonintersection(target: Catalog, policy: Policy, mappings: DataFrame, digester: Digester) -> tuple[CheckResult, dict[str, int]]:
    """The check, and each group's number of different target values."""
    d, distinct = {"groups_checked": 0, "intersection_keys": 0, "invalid_values": 0, "unavailable_columns": 0}, {}
    for name, g in policy.groups.items():
        gone = sum(f"{c.schema}.{c.table}" not in target or c.column not in target[f"{c.schema}.{c.table}"].columns for c in g.columns)
        d["groups_checked"] += 1
        d["unavailable_columns"] += gone
        if gone:
            continue
        got = _numbers(nonintersection(group_values(target, policy, name), mappings.where(F.col("group_id") == name), digester(name, g.normalization, g.allow_empty, False)))
        distinct[name] = got["distinct_target"]
        d["intersection_keys"] += got["intersection_keys"]
        d["invalid_values"] += got["invalid_values"]
    return CheckResult("source_target_hmac_nonintersection", "No source value is left in the target", not any(list(d.values())[1:]), d), distinct


def check_placeholder(policy: Policy, source: dict[ColumnRef, tuple[int, int]], target: dict[ColumnRef, tuple[int, int]]) -> CheckResult:
    there = [c for c in policy.columns() if c in source and c in target]
    candidates = [c for c in there if source[c][1] > 1]
    d = {"columns_checked": len(there), "candidate_columns": len(candidates), "collapsed_columns": sum(target[c][1] <= 1 for c in candidates), "unavailable_columns": len(policy.columns()) - len(there)}
    return CheckResult("no_single_placeholder", "No column collapsed to one value", d["collapsed_columns"] == d["unavailable_columns"] == 0, d)


def verify(source: Catalog, target: Catalog, policy: Policy, mappings: DataFrame, digester: Digester, expected_fingerprint: str) -> tuple[list[CheckResult], list[dict]]:
    """All nine checks, and a roll-up for each group."""
    spark = mappings.sparkSession
    before, after = source.snapshot(), target.snapshot()
    s_stats, t_stats = statistics_of(source, policy), statistics_of(target, policy)
    crossing, distinct = check_nonintersection(target, policy, mappings, digester)
    checks = [
        check_fingerprint(before, expected_fingerprint),
        check_schema(spark, before, after),
        check_row_counts(source, target),
        check_statistics(policy, s_stats, t_stats),
        check_foreign_keys(spark, source, target),
        check_keys(spark, source, target, policy),
        check_mappings(source, target, policy, mappings, digester),
        crossing,
        check_placeholder(policy, s_stats, t_stats),
    ]
    counts = {r["group_id"]: r for r in mapping_counts(mappings).collect()}
    groups = [
        {
            "group": n,
            "entity_type": g.entity_type,
            "columns": len(g.columns),
            "mapping_count": counts[n]["mappings"] if n in counts else 0,
            "distinct_source": counts[n]["mappings"] if n in counts else 0,
            "distinct_target": distinct.get(n, 0),
            "null_source": sum(s_stats[c][0] for c in g.columns if c in s_stats),
            "null_target": sum(t_stats[c][0] for c in g.columns if c in t_stats),
        }
        for n, g in sorted(policy.groups.items())
    ]
    return checks, groups
