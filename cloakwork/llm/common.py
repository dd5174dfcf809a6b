"""What several operators share: scratch tables, vectorised word hashes, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch. Texts can be long, and a Python worker shares its executor's memory.
ARROW_ROWS = 1000
#: Bytes of text that the vectorised functions look at in one go; a longer text takes several.
PIECE = 1 << 20

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a folder of this machine only where none is set."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="cloakwork-")
    return f"file://{_local[app]}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: fewer rows in an Arrow batch than Spark's default."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """name, or a variant that none of df's columns has (compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# --- hashes of words, without a Python object per word ---

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    byte = np.arange(256)
    word = (byte >= 128) | ((byte >= 48) & (byte <= 57)) | ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122))
    fold = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint8)
    value = mix(byte.astype(np.uint64) + _U(1 << 32))
    step = _U(0x2545F4914F6CDD1D)  # odd, so it has an inverse modulo 2^64
    inverse = _U(pow(int(step), -1, 1 << 64))
    return word, fold, value, np.array([step, inverse])


_WORD, _FOLD, _VALUE, _STEPS = _tables()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_string(texts.type):
        kind = np.int32
    elif pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        raise TypeError(f"no string array: {texts.type}")
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def words(data: np.ndarray, offs: np.ndarray, prefix: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word in page order, and the first word's index of each text (n + 1 of them).

    With prefix, only so many bytes of each word count. A word is a run of ASCII letters, digits and bytes of other characters. ASCII letters and
    those of Latin-1 count without case.
    """
    hashes, starts, lo, end = [], [], 0, len(data)
    breaks = offs[1:-1]
    while lo < end:
        hi = min(lo + PIECE, end)
        if hi < end:  # not within a word, if the piece holds a better place
            here = np.flatnonzero(~_WORD[data[max(lo, hi - 4096) : hi]])
            text = breaks[np.searchsorted(breaks, hi, "right") - 1] if len(breaks) and breaks[0] <= hi else 0
            cut = max(max(lo, hi - 4096) + here[-1] + 1 if len(here) else 0, text)
            if cut <= lo:
                rest = np.flatnonzero(~_WORD[data[hi:end]])
                later = breaks[np.searchsorted(breaks, hi, "right") :]
                cut = min(hi + rest[0] if len(rest) else end, later[0] if len(later) else end)
            hi = int(cut)
        b = _FOLD[data[lo:hi]]
        is_word = _WORD[b]
        if (b == 0xC3).any():  # capitals of Latin-1
            up = np.zeros(len(b), bool)
            up[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
            b = np.where(up, b + 0x20, b).astype(np.uint8)
        fresh = np.zeros(len(b) + 1, bool)  # where one text ends and the next starts
        inside = breaks[(breaks > lo) & (breaks < hi)] - lo
        fresh[inside] = True
        before = np.concatenate([[False], is_word[:-1]])
        s = np.flatnonzero(is_word & (~before | fresh[:-1]))
        if len(s):
            after = np.concatenate([is_word[1:], [False]])
            e = np.flatnonzero(is_word & (~after | fresh[1:])) + 1
            if prefix:
                e = np.minimum(e, s + prefix)
            total = np.concatenate([[_U(0)], np.cumsum(_VALUE[b] * _powers(_STEPS[0], len(b)), dtype=np.uint64)])
            hashes.append(mix((total[e] - total[s]) * _powers(_STEPS[1], len(b))[s] + (e - s).astype(np.uint64)))
            starts.append(s + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offs, "left")


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of k words, and each text's first; a text of fewer words has one run of them all."""
    n, per = len(hashes), np.diff(first)
    made = np.where(per >= k, per - k + 1, (per > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(made)])
    if not at[-1]:
        return np.zeros(0, np.uint64), at
    factor = mix(np.arange(1, k + 1, dtype=np.uint64)) | _U(1)
    begin = np.repeat(first[:-1] - at[:-1], made) + np.arange(at[-1])
    length = np.minimum(np.repeat(per, made), k)
    out = length.astype(np.uint64)
    for j in range(k):
        out += np.where(j < length, hashes[np.minimum(begin + j, n - 1)], _U(0)) * factor[j]
    return mix(out), at


def counted(items: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct items of each text in order, how often each occurs, and each text's first."""
    items = items.copy()
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        items[a:b].sort()
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    new[at[:-1][at[:-1] < len(items)]] = True
    where = np.flatnonzero(new)
    counts = np.diff(np.concatenate([where, [len(items)]]))
    return items[where], counts, np.searchsorted(where, at, "left")


# --- connected components ---


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node of its component.

    Alternating large-star and small-star rounds. Each aggregates before it shuffles, and the
    join back is on a key that Spark splits if many edges share it. A round's edges go to the
    shared folder; the driver learns only whether all components are stars by then.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def settled() -> bool:
        several = e.groupBy("u").count().where("count > 1")
        chained = e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        return several.isEmpty() and chained.isEmpty()

    while not settled():
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        e = materialize(small.where("u <> v").distinct(), "small")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
