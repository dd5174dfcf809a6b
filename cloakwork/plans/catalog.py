"""Tables of a source or target, and what is declared about them: keys, foreign keys, lengths."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import PolicyError
from .policy import TEXT_TYPES, ColumnRef, Policy


@dataclass(frozen=True)
class ColumnInfo:
    ref: ColumnRef
    type: str
    max_length: int | None = None
    is_primary_key: bool = False
    is_unique: bool = False


@dataclass(frozen=True)
class ForeignKey:
    """columns of table refer to target_columns of target, pair by pair. match: SIMPLE or FULL."""

    name: str
    table: str
    columns: tuple[str, ...]
    target: str
    target_columns: tuple[str, ...]
    match: str = "SIMPLE"
    validated: bool = True

    def __post_init__(self) -> None:
        if not self.columns or len(self.columns) != len(self.target_columns) or self.match not in ("SIMPLE", "FULL"):
            raise PolicyError("a foreign key needs pairs of columns and a known match type")

    def signature(self) -> tuple:
        """The key without its name."""
        return self.table, self.columns, self.target, self.target_columns, self.match


@dataclass(frozen=True)
class KeyConstraint:
    kind: str  # PRIMARY KEY or UNIQUE
    table: str
    columns: tuple[str, ...]
    name: str = ""

    def signature(self) -> tuple:
        """The constraint without its name."""
        return self.kind, self.table, self.columns


@dataclass(frozen=True)
class Snapshot:
    columns: tuple[ColumnInfo, ...]
    foreign_keys: tuple[ForeignKey, ...]

    @property
    def fingerprint(self) -> str:
        """SHA-256 of compact JSON: columns and foreign keys in sorted order."""
        doc = {
            "columns": [[c.ref.schema, c.ref.table, c.ref.column, c.type, c.max_length, c.is_primary_key, c.is_unique] for c in sorted(self.columns, key=lambda c: c.ref)],
            "foreign_keys": [[k.name, k.table, k.target, [*zip(k.columns, k.target_columns, strict=True)], k.match] for k in sorted(self.foreign_keys, key=lambda k: (k.table, k.name))],
        }
        return hashlib.sha256(json.dumps(doc, sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    def column(self, ref: ColumnRef) -> ColumnInfo | None:
        return {c.ref: c for c in self.columns}.get(ref)


class Catalog:
    """Named DataFrames ('schema.table') and their declarations. location tells two catalogs apart."""

    def __init__(self, location: str, tables: dict[str, DataFrame], keys: tuple[KeyConstraint, ...] = (), foreign_keys: tuple[ForeignKey, ...] = (), lengths: dict[ColumnRef, int] | None = None) -> None:
        self.location, self.tables, self.keys, self.foreign_keys, self.lengths = location, dict(tables), tuple(keys), tuple(foreign_keys), dict(lengths or {})

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def primary_key(self, table: str) -> KeyConstraint | None:
        return next((k for k in self.keys if k.kind == "PRIMARY KEY" and k.table == table), None)

    def snapshot(self) -> Snapshot:
        primary = {(k.table, c) for k in self.keys if k.kind == "PRIMARY KEY" for c in k.columns}
        unique = {(k.table, c) for k in self.keys if k.kind == "UNIQUE" for c in k.columns}
        found = []
        for name, df in sorted(self.tables.items()):
            schema, table = name.split(".", 1)
            for f in df.schema.fields:
                ref = ColumnRef(schema, table, f.name)
                found.append(ColumnInfo(ref, f.dataType.simpleString(), self.lengths.get(ref), (name, f.name) in primary, (name, f.name) in unique))
        return Snapshot(tuple(found), self.foreign_keys)

    def redeclared(self, location: str, tables: dict[str, DataFrame]) -> Catalog:
        """The same declarations over other data."""
        return Catalog(location, tables, self.keys, self.foreign_keys, self.lengths)


def columns_frame(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    rows = [(c.ref.schema, c.ref.table, c.ref.column, c.type, c.max_length) for c in snapshot.columns]
    return spark.createDataFrame(rows, "schema_name string, table_name string, column_name string, type string, max_length int")


def keys_frame(spark: SparkSession, keys: tuple[KeyConstraint, ...]) -> DataFrame:
    """One row for each constraint: its columns gathered in their order from one row a column."""
    rows = [(i, k.kind, k.table, p, c) for i, k in enumerate(keys) for p, c in enumerate(k.columns)]
    flat = spark.createDataFrame(rows, "no int, kind string, table_name string, place int, column_name string")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "column_name"))), lambda x: x["column_name"])
    return flat.groupBy("no", "kind", "table_name").agg(ordered.alias("columns")).drop("no")


def foreign_keys_frame(spark: SparkSession, keys: tuple[ForeignKey, ...]) -> DataFrame:
    """One row for each foreign key, with its pairs in their order; keys of equal name on other tables stay apart."""
    rows = [(k.name, k.table, k.target, list(k.columns), list(k.target_columns), k.match) for k in keys]
    df = spark.createDataFrame(rows, "name string, table_name string, target string, columns array<string>, target_columns array<string>, match string")
    return df.select("name", "table_name", "target", "match", F.arrays_zip("columns", "target_columns").alias("pairs"))


def foreign_key_signatures(spark: SparkSession, keys: tuple[ForeignKey, ...]) -> DataFrame:
    """What makes foreign keys equal: everything but their names."""
    return foreign_keys_frame(spark, keys).drop("name")


def foreign_key_pairs(df: DataFrame) -> DataFrame:
    """Frame of foreign_keys_frame() with one row for each pair."""
    flat = df.select("name", "table_name", "target", "match", F.posexplode("pairs").alias("place", "pair"))
    return flat.select("name", "table_name", "target", "match", "place", F.col("pair.columns").alias("column_name"), F.col("pair.target_columns").alias("target_column"))


def check_policy(policy: Policy, snapshot: Snapshot, foreign_keys: tuple[ForeignKey, ...]) -> None:
    """Raise PolicyError unless the policy fits the schema."""
    if not policy.allow_target_recreate:
        raise PolicyError("the policy doesn't allow the target to be recreated")
    known = {c.ref: c for c in snapshot.columns}
    for name, group in policy.groups.items():
        for ref in group.columns:
            info = known.get(ref)
            if info is None:
                raise PolicyError(f"column {ref.qualified} doesn't exist")
            if info.type.split("(")[0].strip().casefold() not in TEXT_TYPES:
                raise PolicyError(f"column {ref.qualified} is no text column")
            if info.max_length is not None and group.generation.max_length > info.max_length:
                raise PolicyError(f"column {ref.qualified} is too short for the replacements of group {name}")
    ref_of = lambda table, column: ColumnRef(*table.split(".", 1), column)
    for key in foreign_keys:
        ends = [ref_of(key.table, c) for c in key.columns] + [ref_of(key.target, c) for c in key.target_columns]
        groups = {policy.group_of(c) for c in ends}
        if groups != {None} and (None in groups or len(groups) > 1):
            raise PolicyError(f"foreign key {key.name}: all its columns must be in one group, or none")


def same_place(a: str, b: str) -> bool:
    """Whether two locations are one, whatever their credentials and spelling."""
    from urllib.parse import urlsplit

    def place(x: str) -> tuple:
        parts = urlsplit(x.removeprefix("jdbc:"))
        if parts.scheme in ("", "file"):
            import os

            return ("file", os.path.realpath(parts.path or x))
        return parts.scheme, (parts.hostname or "").casefold(), parts.port or {"postgresql": 5432}.get(parts.scheme), parts.path.rstrip("/")

    return place(a) == place(b)
