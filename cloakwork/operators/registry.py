"""The mapping registry: digests to replacements, as Parquet folders that are only ever added, with one pointer to those in force.

It never holds a source value. A change writes its own rows alone, as a new folder, after checking them against what is
there; then the pointer is replaced atomically. Folders that no pointer names are leftovers of a change that failed. When many folders have
gathered, they are merged into one. One writer at a time, as many readers as wanted.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import RegistryConflict, RegistryError
from ..functions.numbering import checkpointed
from ..functions.scalars import is_digest
from ..sources.tables import folder_holds_data, read_json_document, write_json_document

SCHEMA = "group_id string, source_hmac string, replacement string, replacement_hmac string"
#: Registries of more rows than this are joined by shuffling both sides.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class RunMetadata:
    run_id: str
    policy_hash: str
    schema_fingerprint: str
    key_fingerprint: str
    provider: str
    model: str
    status: str = "created"


@dataclass(frozen=True)
class GenerationStats:
    batches: int = 0
    accepted_items: int = 0
    rejected_items: int = 0
    duration_seconds: float = 0.0

    def plus(self, other: GenerationStats) -> GenerationStats:
        if min(asdict(other).values()) < 0:
            raise RegistryError("statistics can't be negative")
        return GenerationStats(*(a + b for a, b in zip(asdict(self).values(), asdict(other).values(), strict=True)))


# --- queries over a frame of mappings ---


def pending(mappings: DataFrame, group: str, limit: int | None = None) -> DataFrame:
    """Keys without a replacement by digest, the first `limit` of them."""
    if limit is not None and limit < 1:
        raise RegistryError("a limit must be positive")
    out = mappings.where((F.col("group_id") == group) & F.col("replacement").isNull()).select("source_hmac").orderBy("source_hmac")
    return out if limit is None else out.limit(limit)


def duplicate_replacements(mappings: DataFrame, column: str = "replacement") -> DataFrame:
    """(group_id, <column>, count) of replacements, or of their digests, that several keys have."""
    return mappings.where(F.col(column).isNotNull()).groupBy("group_id", column).count().where("count > 1")


def source_collisions(mappings: DataFrame) -> DataFrame:
    """Mappings whose replacement's digest is a source key of the group."""
    sources = mappings.select("group_id", F.col("source_hmac").alias("replacement_hmac"))
    return mappings.where(F.col("replacement_hmac").isNotNull()).join(sources, ["group_id", "replacement_hmac"], "left_semi")


def already_given(batch: DataFrame, given: DataFrame, column: str = "source_hmac") -> DataFrame:
    """Rows of given (group_id, ...) whose column some row of the batch has too."""
    return given.join(batch.select("group_id", column), ["group_id", column], "left_semi")


def mapping_counts(mappings: DataFrame) -> DataFrame:
    """(group_id, mappings, assigned)."""
    return mappings.groupBy("group_id").agg(F.count(F.lit(1)).alias("mappings"), F.count("replacement").alias("assigned"))


def new_keys(keys: DataFrame, mappings: DataFrame) -> DataFrame:
    """Distinct keys that aren't registered yet."""
    return keys.select("group_id", "source_hmac").dropDuplicates().join(mappings, ["group_id", "source_hmac"], "left_anti")


def ranked(keys: DataFrame) -> DataFrame:
    """keys (group_id, source_hmac) with rank: 1, 2, ... by digest within the group.

    Digests are uniform, so their first three hex digits cut a group into 4,096 even buckets that are ranked in parallel.
    """
    k = keys.withColumn("bucket", F.substring("source_hmac", 1, 3))
    sizes = k.groupBy("group_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("group_id", "bucket", (F.sum("n").over(Window.partitionBy("group_id").orderBy("bucket")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("group_id", "bucket").orderBy("source_hmac"))
    return k.withColumn("within", within).join(before, ["group_id", "bucket"]).withColumn("rank", F.col("before") + F.col("within")).select(*keys.columns, "rank")


def small_enough(mappings: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """mappings, to be broadcast if they have at most `most` rows."""
    return F.broadcast(mappings) if mappings.limit(most + 1).count() <= most else mappings


#: Folders of either kind beyond which they are merged.
MOST_PARTS = 32
_KEYS, _GIVEN = "group_id string, source_hmac string", SCHEMA


class Registry:
    """Folders under `root`; `root`/CURRENT names those in force: keys, and replacements given to them."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        text = read_json_document(spark, f"{self.root}/CURRENT")
        if text is None and folder_holds_data(spark, self.root):
            raise RegistryError("the registry has lost its pointer")
        state = json.loads(text) if text else {"keys": [], "given": [], "meta": None, "stats": asdict(GenerationStats())}
        self.parts: dict[str, list[str]] = {"keys": state["keys"], "given": state["given"]}
        self.metadata = RunMetadata(**state["meta"]) if state["meta"] else None
        self.stats = GenerationStats(**state["stats"])

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{x}" for x in self.parts[kind]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def frame(self) -> DataFrame:
        """(group_id, source_hmac, replacement, replacement_hmac) of all keys."""
        return self._read("keys", _KEYS).join(self._read("given", _GIVEN), ["group_id", "source_hmac"], "left") if self.parts["given"] else self._read("keys", _KEYS).select("*", F.lit(None).cast("string").alias("replacement"), F.lit(None).cast("string").alias("replacement_hmac"))

    def _point(self, parts: dict[str, list[str]] | None = None, stats: GenerationStats | None = None) -> None:
        parts, stats = parts or self.parts, stats or self.stats
        state = {**parts, "meta": asdict(self.metadata) if self.metadata else None, "stats": asdict(stats)}
        write_json_document(self.spark, f"{self.root}/CURRENT", json.dumps(state, sort_keys=True))
        self.parts, self.stats = parts, stats

    def _add(self, kind: str, rows: DataFrame, schema: str, stats: GenerationStats | None = None) -> None:
        """Put rows in force, with the statistics, in one step."""
        name = f"{kind}-{uuid.uuid4().hex}"
        rows.select(*[c.split()[0] for c in schema.split(", ")]).write.parquet(f"{self.root}/{name}")
        self._point(self.parts | {kind: [*self.parts[kind], name]}, stats)
        if len(self.parts[kind]) > MOST_PARTS:
            merged = f"{kind}-{uuid.uuid4().hex}"
            self._read(kind, schema).write.parquet(f"{self.root}/{merged}")
            self._point(self.parts | {kind: [merged]})

    def initialise(self, metadata: RunMetadata) -> None:
        """Store the metadata, or require that they equal the stored ones in every field."""
        if self.metadata is None:
            self.metadata = metadata
            self._point()
        elif self.metadata != metadata:
            raise RegistryError("the registry belongs to another run")

    def set_status(self, status: str) -> None:
        if self.metadata is None:
            raise RegistryError("the registry isn't initialised")
        self.metadata = replace(self.metadata, status=status)
        self._point()

    def insert(self, keys: DataFrame) -> int:
        """Register keys (group_id, source_hmac); those known are left alone. Number of new ones."""
        before = self._read("keys", _KEYS)
        fresh = new_keys(keys, before)
        if fresh.isEmpty():
            return 0
        # A replacement that was given before must not be a key now.
        if not self._read("given", _GIVEN).join(fresh.select("group_id", F.col("source_hmac").alias("replacement_hmac")), ["group_id", "replacement_hmac"], "left_semi").isEmpty():
            raise RegistryConflict("a replacement equals a source value")
        count = before.count()
        self._add("keys", fresh, _KEYS)
        return self._read("keys", _KEYS).count() - count

    def assign(self, assignments: DataFrame, stats: GenerationStats | None = None) -> None:
        """Give replacements (group_id, source_hmac, replacement, replacement_hmac) to registered keys: all of them or none.

        Only the batch is checked, against itself and against what is there.
        """
        a = checkpointed(assignments.select("group_id", "source_hmac", "replacement", "replacement_hmac"))
        small = small_enough(a)
        known, given = self._read("keys", _KEYS), self._read("given", _GIVEN)
        if not a.where(F.col("replacement").isNull() | F.col("replacement_hmac").isNull()).isEmpty():
            raise RegistryError("an assignment needs a replacement and its digest")
        if not a.groupBy("group_id", "source_hmac").count().where("count > 1").isEmpty():
            raise RegistryConflict("a batch assigns a key twice")
        if known.join(small.select("group_id", "source_hmac"), ["group_id", "source_hmac"], "left_semi").count() < a.count():
            raise RegistryError("a batch assigns a key that isn't registered")
        if not already_given(small, given).isEmpty():
            raise RegistryConflict("a key is already assigned")
        for column in ("replacement", "replacement_hmac"):
            if not duplicate_replacements(a, column).isEmpty() or not already_given(small, given, column).isEmpty():
                raise RegistryConflict("two keys would share a replacement")
        if not already_given(small.select("group_id", F.col("replacement_hmac").alias("source_hmac")), known).isEmpty():
            raise RegistryConflict("a replacement equals a source value")
        self._add("given", a, _GIVEN, self.stats.plus(stats or GenerationStats()))

    def _publish(self, mappings: DataFrame) -> None:
        """Take over the mappings of another registry."""
        self.insert(mappings)
        self.assign(mappings.where(F.col("replacement").isNotNull()))

    def record(self, stats: GenerationStats) -> None:
        self._point(stats=self.stats.plus(stats))

    def count(self, group: str, assigned_only: bool = False) -> int:
        rows = self.frame().where(F.col("group_id") == group)
        return (rows.where(F.col("replacement").isNotNull()) if assigned_only else rows).count()

    def lookup(self, group: str, source_hmac: str) -> str | None:
        if not is_digest(source_hmac):
            raise RegistryError("not a digest")
        row = self.frame().where((F.col("group_id") == group) & (F.col("source_hmac") == source_hmac)).select("replacement").first()
        return row[0] if row else None

    def has_source(self, group: str, source_hmac: str) -> bool:
        return not self.frame().where((F.col("group_id") == group) & (F.col("source_hmac") == source_hmac)).isEmpty()

    def has_replacement(self, group: str, replacement_hmac: str) -> bool:
        return not self.frame().where((F.col("group_id") == group) & (F.col("replacement_hmac") == replacement_hmac)).isEmpty()
