"""Collecting the keys of a policy's columns: normalise, digest, distinct. Values are hashed before anything is shuffled."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import PolicyError
from ..functions.scalars import INVALID, OK, keyed
from ..plans.catalog import Catalog
from ..plans.policy import Policy

#: From (group, normalisation, allow_empty, raw) to a function from a column to struct(status, digest).
Digester = Callable[[str, str, bool, bool], Callable[[Column], Column]]


def arrow_digester(key: bytes) -> Digester:
    return lambda group, kind, allow_empty, raw: keyed(key, group, kind, allow_empty, raw)


def group_values(catalog: Catalog, policy: Policy, group: str) -> DataFrame:
    """(value) of all columns of a group, nulls left out, repeats kept."""
    parts = [catalog[f"{c.schema}.{c.table}"].where(F.col(c.column).isNotNull()).select(F.col(c.column).cast("string").alias("value")) for c in policy.groups[group].columns]
    return reduce(DataFrame.unionByName, parts)


def keyed_values(catalog: Catalog, policy: Policy, digester: Digester) -> DataFrame:
    """(group_id, status, source_hmac, raw_hmac) of all configured columns' non-null values, repeats kept."""
    parts = []
    for name, g in policy.groups.items():
        norm, exact = digester(name, g.normalization, g.allow_empty, False), digester(name, g.normalization, g.allow_empty, True)
        both = group_values(catalog, policy, name).select(norm(F.col("value")).alias("k"), exact(F.col("value")).alias("r"))
        parts.append(both.select(F.lit(name).alias("group_id"), F.col("k.status").alias("status"), F.col("k.digest").alias("source_hmac"), F.col("r.digest").alias("raw_hmac")))
    return reduce(DataFrame.unionByName, parts)


def distinct_keys(values: DataFrame) -> DataFrame:
    """(group_id, source_hmac), each once."""
    return values.where(F.col("status") == OK).select("group_id", "source_hmac").distinct()


def collection_stats(values: DataFrame) -> DataFrame:
    """Per group: different raw values seen, different keys, values that can't be normalised."""
    return values.groupBy("group_id").agg(F.count_distinct("raw_hmac").alias("distinct_values_seen"), F.count_distinct("source_hmac").alias("distinct_keys"), F.count_if(F.col("status") == INVALID).alias("invalid_values"))


def collect_keys(catalog: Catalog, policy: Policy, digester: Digester) -> DataFrame:
    """Distinct keys of the policy; PolicyError if a value can't be normalised."""
    values = keyed_values(catalog, policy, digester)
    if not values.where(F.col("status") == INVALID).isEmpty():
        raise PolicyError("a configured column holds a value that is empty after normalisation")
    return distinct_keys(values)
