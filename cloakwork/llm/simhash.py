"""Document fingerprints: SimHash of weighted terms, and permuted block tables to search them.

A term is a run of three words (case and punctuation don't count; a text of fewer words has one
term of them all), weighted by 1 + log2 of its count. Each term's 64-bit hash votes with its weight on every
bit; a bit of the fingerprint is set if more weight votes for it than against it.

`neighbours` finds all fingerprints within a Hamming radius: the 64 bits are cut into blocks, and
two fingerprints within the radius agree in all but `radius` of the blocks. There is a table for
each choice of blocks that agree; a pair counts in the first table in which it meets, so
nothing is dropped and nothing comes twice.

Defined cases: a null text is empty; a text without words has fingerprint 0; equal texts have equal
fingerprints; rows of equal ids follow each other by the hash of their texts, rows without an id
come last; a single document is its own successor; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buffers, counted, materialize, shingles, small_batches, words

TERM_WORDS = 3
RADIUS, BLOCKS = 3, 5
#: Terms whose votes are added up in one go.
TERMS = 8192
#: A bucket's aim in bytes of the input as Spark estimates it, and the most buckets; each is sorted outside memory if need be.
BUCKET_BYTES, MOST_BUCKETS = 64 << 20, 1 << 16
#: Bounds of buckets are looked up in two steps, among the first of so many and then among these.
_FAN = 256


def fingerprints(texts: pa.Array, k: int = TERM_WORDS) -> np.ndarray:
    """64-bit SimHash of each text."""
    data, offs = buffers(texts)
    out, a = np.zeros(len(texts), np.uint64), 0
    while a < len(texts):
        b = min(len(texts), max(a + 1, int(np.searchsorted(offs, offs[a] + (1 << 18), "right")) - 1))
        terms, counts, at = counted(*shingles(*words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]), k))
        weight = np.rint(64 * (1 + np.log2(counts))).astype(np.float32)
        for i, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            # Sums of whole numbers below 2^24 are exact in 32-bit floats: so many terms' weights stay below.
            votes, every = np.zeros(64, np.int64), 0
            for x in range(lo, hi, TERMS):
                part = slice(x, min(x + TERMS, hi))
                bits = np.unpackbits(terms[part].astype(">u8").view(np.uint8)).reshape(-1, 64)
                votes += (weight[part] @ bits.astype(np.float32)).astype(np.int64)
                every += int(weight[part].sum(dtype=np.float64))
            out[a + i] = np.packbits(2 * votes > every).view(">u8")[0]
        a = b
    return out


def edited(text: str, following: str) -> str:
    """text with its last third replaced by as many of the first code points of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b) / 64


def bucket_of(x: Column, bounds: list[int]) -> Column:
    """Number of bounds (sorted) that are x or less."""
    if not bounds:
        return F.lit(0)
    # One constant each, however many bounds there are.
    runs = F.from_json(F.lit(json.dumps([bounds[i : i + _FAN] for i in range(0, len(bounds), _FAN)])), "array<array<bigint>>")
    heads = F.from_json(F.lit(json.dumps(bounds[::_FAN])), "array<bigint>")
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= x))
    run = below(heads) - 1
    return F.when(x < bounds[0], 0).otherwise(run * _FAN + below(F.get(runs, run)))


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows (id, text) in partitions such that each row's successor by descending id follows it in its partition.

    Ids are cut into buckets at approximate quantiles. The first row of a bucket also goes to
    the end of the bucket before, as a marker, and the very first row to the end of the last bucket.
    """
    spark = docs.sparkSession
    estimate = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = max(2, min(MOST_BUCKETS, max(estimate // BUCKET_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    bounds = sorted({min(int(x), (1 << 63) - 1) for x in docs.select("id").where("id is not null").approxQuantile("id", [i / wanted for i in range(1, wanted)], 0.2 / wanted)})
    bucket = bucket_of(F.col("id"), bounds)
    # Without an id a row is in the last bucket, which is number 0.
    placed = docs.withColumns({"none": F.col("id").isNull(), "tie": F.xxhash64("text"), "bucket": F.when(F.col("id").isNull(), 0).otherwise(bucket)})
    order = F.struct("none", F.bitwise_not("id").alias("down"), "tie")
    firsts = placed.groupBy("bucket").agg(F.min(order).alias("first")).orderBy(F.col("bucket").desc()).collect()  # MOST_BUCKETS rows at most
    before = {r["bucket"]: firsts[i - 1]["bucket"] for i, r in enumerate(firsts)}
    table = spark.createDataFrame([(r["bucket"], before[r["bucket"]], *r["first"]) for r in firsts], "bucket int, before int, f_none boolean, f_down long, f_tie long")
    placed = placed.join(F.broadcast(table), "bucket")
    is_first = F.struct("none", F.bitwise_not("id").alias("down"), "tie").eqNullSafe(F.struct(F.col("f_none").alias("none"), F.col("f_down").alias("down"), F.col("f_tie").alias("tie")))
    spread = placed.select("id", "text", "none", "tie", F.posexplode(F.when(is_first, F.array("bucket", "before")).otherwise(F.array("bucket"))).alias("copy", "place"))
    # Rows that are equal in id and text make several markers; all but the last are as good as absent.
    parts = max(1, len(firsts))
    return spread.repartition(parts, "place").sortWithinPartitions(F.col("place"), F.col("copy"), F.col("none"), F.col("id").desc(), F.col("tie")).select("id", "text", "place", "copy")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = TERM_WORDS) -> DataFrame:
    """For every row: id, n_chars, fingerprint, the edited text's SHA-256 and fingerprint, and how like its fingerprint is to the edited
    text's and to the next document's."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row so far, whose successor is still to come

        def made(ids: list, texts: list[str], prints: np.ndarray, places: list, copies: list) -> pa.RecordBatch:
            own = [i for i in range(len(ids) - 1) if copies[i] == 0 and places[i] == places[i + 1]]
            changed = [edited(texts[i], texts[i + 1]) for i in own]
            raw = [x.encode() for x in changed]
            after = fingerprints(pa.array(raw, pa.large_binary()).view(pa.large_string()), k)
            mine, following = prints[own], prints[[i + 1 for i in own]]
            cols = [pa.array([ids[i] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()), pa.array([f"{x:016x}" for x in mine.tolist()], pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()), pa.array([f"{x:016x}" for x in after.tolist()], pa.string()), pa.array(likeness(mine, after)), pa.array(likeness(mine, following)), pa.array(mine.view(np.int64))]
            return pa.RecordBatch.from_arrays(cols, ["id", "n_chars", "fingerprint", "edited_sha256", "edited_fingerprint", "near_edited", "near_next", "bits"])

        for batch in batches:
            step = 200
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                prints = fingerprints(part.column(1), k)
                ids, texts, places, copies = (part.column(i).to_pylist() for i in range(4))
                if held:
                    ids, texts, places, copies = [held[0], *ids], [held[1], *texts], [held[2], *places], [held[3], *copies]
                    prints = np.concatenate([[held[4]], prints]).astype(np.uint64)
                held = (ids[-1], texts[-1], places[-1], copies[-1], prints[-1])
                yield made(ids, texts, prints, places, copies)

    return _in_order(slim).mapInArrow(run, "id long, n_chars long, fingerprint string, edited_sha256 string, edited_fingerprint string, near_edited double, near_next double, bits long")


def _masks(radius: int, blocks: int) -> list[int]:
    """One mask for each choice of blocks - radius blocks."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(chosen)) for chosen in combinations(block, blocks - radius)]


def _tabled(prints: DataFrame, name: str, masks: list[int]) -> DataFrame:
    tables = F.posexplode(F.array(*[F.col("bits").bitwiseAND(F.lit(m)) for m in masks])).alias("no", "part")
    return prints.select(F.col("bits").alias(name), *[c for c in prints.columns if c != "bits"], tables).withColumn("key", F.xxhash64("no", "part")).drop("part")


def neighbours(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(q, bits, distance, ...) for distinct fingerprints `bits` of index within the radius of the distinct ones of queries.

    Both have a column bits without repeats; index may have more columns.
    """
    masks = _masks(radius, blocks)
    q, x = _tabled(queries.select("bits"), "q", masks), _tabled(index, "bits", masks)
    apart: Column = F.col("q").bitwiseXOR(F.col("bits"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, i) for i, m in enumerate(masks)])
    x = x.withColumnRenamed("no", "x_no")
    met = q.hint("merge").join(x, "key").where((F.col("no") == F.col("x_no")) & (F.bit_count(apart) <= radius) & (first == F.col("no")))
    return met.select("q", "bits", F.bit_count(apart).alias("distance"), *[c for c in index.columns if c != "bits"])


def with_neighbours(prints: DataFrame, every: int = 100, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """prints with n_near: how many other documents lie within the radius, for ids that `every` divides (else null)."""
    prints = materialize(prints, "prints")
    chosen = F.coalesce(F.col("id") % every == 0, F.lit(False))
    index = prints.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    found = neighbours(prints.where(chosen).select("bits").distinct(), index, radius, blocks).groupBy("q").agg(F.sum("n").alias("n_near"))
    near = prints.where(chosen).join(found, F.col("bits") == F.col("q")).withColumn("n_near", F.col("n_near") - 1).drop("q")
    return near.unionByName(prints.where(~chosen).withColumn("n_near", F.lit(None).cast("long")))
