"""Sharding: a global shuffle of a corpus into output shards, by a two-pass external shuffle.

Pass 1 scatters the rows by a seeded hash into buckets that fit in memory; their number follows
from the corpus's bytes. Equal rows are counted first, and each of them is scattered by its number among its
equals too, so that no bucket gathers them. Pass 2 shuffles each bucket (Fisher-Yates, seeded by the bucket) and
deals the rows out in the order of the buckets: the row at global place p goes to shard
p mod shards, slot p div shards. So shards differ by one row at most and slots have no gaps.

Defined cases: nulls hash like any value; a null text has no bytes; equal rows (told by 128 bits of hash) may land
anywhere; an empty table gives an empty result; all columns stay, whatever their names. The same
rows give the same shards, in whatever order and partitions they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import free_name, materialize, small_batches

SHARDS, SEED = 40, 20240611
#: A bucket's aim in bytes of text, and at most so many rows on average.
BUCKET_BYTES, BUCKET_ROWS = 8 << 20, 4000
#: Equal rows that one task writes out.
CHUNK = 1000
#: Keys of repeated rows that may be broadcast; beyond, both sides are shuffled by key.
BROADCAST_ROWS = 1_000_000
#: Buckets whose running counts one task computes.
BLOCK = 4096


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _hashable(docs: DataFrame) -> list[Column]:
    """All columns, maps as JSON."""
    return [F.to_json(F.struct(_quoted(c))) if "map<" in kind else _quoted(c) for c, kind in docs.dtypes]


def _numbered(ties: DataFrame, keys: list[str], n: str, copy: str) -> DataFrame:
    """Each row n times, with copy = 0, 1, ...; a row of many copies is dealt out to many tasks first."""
    chunked = ties.withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / CHUNK)))).repartition(*keys, copy)
    first = F.col(copy) * CHUNK
    return chunked.withColumn(copy, F.explode(F.sequence(first, F.least(first + CHUNK, F.col(n)) - 1))).drop(n)


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, text_col: str = "text", seed: int = SEED) -> DataFrame:
    """docs, shuffled, with shard and slot (named shard_ and so on where docs has such a column)."""
    spark = docs.sparkSession
    small_batches(spark)
    bucket, offset, k1, k2, t1, t2, n, copy, whole, place = (free_name(docs, c) for c in ("__bucket", "__offset", "__key1", "__key2", "__tie1", "__tie2", "__n", "__copy", "__row", "__place"))
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long")
    kept, hashed = [_quoted(c) for c in docs.columns], _hashable(docs)
    tagged = docs.withColumns({k1: F.xxhash64(F.lit(seed), *hashed), k2: F.xxhash64(F.lit(seed + 1), *hashed)})
    slim = tagged.groupBy(k1, k2).agg(F.count(F.lit(1)).alias(n), F.max(size).alias("size"))
    slim = materialize(slim, "rows")  # four numbers for each different row
    rows, volume, ties = slim.agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.sum(F.col("size") * F.col(n)), F.lit(0)), F.count_if(F.col(n) > 1)).first()
    buckets = max(1, -(-volume // BUCKET_BYTES), -(-rows // BUCKET_ROWS))
    at = F.pmod(F.xxhash64(k1, k2, copy), F.lit(buckets))

    tied = slim.where(F.col(n) > 1).select(k1, k2, n)
    keys = slim.where(F.col(n) == 1).select(k1, k2, F.lit(0).cast("long").alias(copy))
    scattered = tagged.withColumn(copy, F.lit(0).cast("long"))
    if ties:
        keys = keys.unionByName(_numbered(tied, [k1, k2], n, copy))
        named = tied.select(F.col(k1).alias(t1), F.col(k2).alias(t2), n)
        named = F.broadcast(named) if ties <= BROADCAST_ROWS else named.hint("merge")
        same = (F.col(k1) == F.col(t1)) & (F.col(k2) == F.col(t2))
        equal = tagged.join(named, same).groupBy(k1, k2, n).agg(F.first(F.struct(*kept)).alias(whole))
        equal = _numbered(equal, [k1, k2], n, copy).select(*[F.col(whole)[c].alias(c) for c in docs.columns], k1, k2, copy)
        scattered = scattered.join(named, same, "left_anti").unionByName(equal)

    counts = keys.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.floor(F.col("b") / BLOCK))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("all"))
    blocks = blocks.select("block", (F.sum("all").over(Window.orderBy("block")) - F.col("all")).alias("before"))  # one row for BLOCK buckets
    within = F.sum("n").over(Window.partitionBy("block").orderBy("b")) - F.col("n")
    before = materialize(counts.withColumn("within", within).join(blocks, "block").select(F.col("b").alias(bucket), (F.col("before") + F.col("within")).alias(offset)), "offsets")
    parts = max(1, min(buckets, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-buckets // 4))))
    dealt = scattered.withColumn(bucket, at).drop(copy).join(before, bucket)
    dealt = dealt.repartitionById(parts, (F.col(bucket) % parts).cast("int")).sortWithinPartitions(bucket, k1, k2)

    shard, slot = free_name(docs, "shard"), free_name(docs, "slot")
    schema = T.StructType([*dealt.schema.fields, T.StructField(place, T.LongType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shuffle bucket by bucket; a bucket may reach over several batches."""
        held: list[pa.RecordBatch] = []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                table = pa.Table.from_batches(held).combine_chunks()
                b, first = table.column(bucket)[0].as_py(), table.column(offset)[0].as_py()
                order = np.random.Generator(np.random.PCG64([seed, b])).permutation(len(table))
                for a in range(0, len(table), 256):  # takes of few rows stay within the offsets of a string array
                    part = table.take(pa.array(order[a : a + 256]))
                    yield from part.append_column(place, pa.array(np.arange(a, a + len(part)) + first)).combine_chunks().to_batches()
                held.clear()

        for batch in batches:
            marks = np.asarray(batch.column(batch.schema.get_field_index(bucket)))
            cuts = np.concatenate([[0], np.flatnonzero(marks[1:] != marks[:-1]) + 1, [len(marks)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if held and held[-1].column(held[-1].schema.get_field_index(bucket))[0].as_py() != marks[a]:
                    yield from out()
                if b > a:
                    held.append(batch.slice(a, b - a))
        yield from out()

    placed = dealt.mapInArrow(deal, schema)
    return placed.select(*kept, (F.col(place) % shards).cast("int").alias(shard), F.floor(F.col(place) / shards).alias(slot))


def write_shards(sharded: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Parquet files in one folder a shard, rows in the order of their slots."""
    sharded.repartition(F.col(shard)).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
