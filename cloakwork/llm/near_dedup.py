"""Near-duplicate documents: BagMinHash signatures, banding, exact verification, classes.

A text is the multiset of its runs of five words (case and punctuation don't count); two
texts are near copies if their weighted Jaccard similarity is 0.8 or more. Equal texts
collapse into one node before anything else is shuffled. Nodes that share a band are linked to
the band's head, the member that meets most others (never to one another in all pairs), links are
verified on whole texts, and what the stars leave open is compared across components, pruned by the triangle
inequality of the Jaccard distance and by the similarity that the whole signatures suggest.

Defined cases: a null text is a class of its own. A text without words equals only the same
text. Repeated rows and equal texts share a class. The class id is the least id of its rows
(null if none of them has an id). An empty table gives an empty result. Other columns are
ignored by `near_duplicates` and kept, whatever their names, by `deduplicate`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import buffers, components, counted, free_name, materialize, mix, shingles, small_batches, words

SHINGLE, THRESHOLD = 5, 0.8
#: At similarity 0.8 a pair shares none of 36 bands of 6 values with probability 2e-5.
BANDS, BAND_ROWS = 36, 6
#: Pairs across components whose signatures suggest a similarity of so many standard errors below the threshold are no candidates.
ERRORS = 3.0

_U = np.uint64


def _uniform(h: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((h >> _U(12)).astype(np.float64) + 0.5) * 2.0**-52


def _points(e: np.ndarray, w: np.ndarray, d: np.ndarray, limit: np.ndarray, sig: np.ndarray) -> None:
    """Lower sig (texts x components) to the least point of each component's Poisson process.

    The weight axis of an element is cut at 1, 2, 4, 8, ...; each dyadic interval below or at
    its weight has a process of its own whose rate is the interval's length, so a heavy
    element costs the logarithm of its weight. Points of the last interval are thinned by
    their position on the axis: exactly those below the weight count, and a text with a
    greater weight sees the same points. Points come in order of time, and an element is left
    as soon as its next point lies beyond its text's limit.
    """
    m = sig.shape[1]
    flat = sig.reshape(-1)
    levels = 1 + np.ceil(np.log2(w)).astype(np.int64)
    which = np.repeat(np.arange(len(e)), levels)
    level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    length = np.maximum(low, 1)
    node = mix(e[which] ^ mix(level.astype(np.uint64) + _U(77)))
    room = w[which] - low  # of the interval, as far as the weight reaches
    text, until, time, j = d[which], limit[d[which]], np.zeros(len(which)), 0
    while len(node):
        j += 1
        h = mix(node + _U(2 * j))
        time = time - np.log(_uniform(h)) / length
        go = time < until
        if not go.all():
            node, length, room, text, until, time = (x[go] for x in (node, length, room, text, until, time))
        g = mix(node + _U(2 * j + 1))
        hit = (g & _U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * length < room
        at = text * m + ((g >> _U(32)) % _U(m)).astype(np.int64)
        np.minimum.at(flat, at[hit], time[hit])


def bag_minhash(e: np.ndarray, w: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """Signatures (texts x m) of multisets: distinct elements e with counts w, text by text.

    P(equal components) is the weighted Jaccard similarity. Times are rounded to 32-bit
    floats, so that executors whose logarithm differs in the last bit agree. A text without
    elements has infinity throughout.
    """
    n, per = len(at) - 1, np.diff(at)
    sig = np.full((n, m), np.inf)
    total = np.add.reduceat(np.concatenate([w, [0]]), at[:-1]) * (per > 0) if n else np.zeros(0)
    todo, slack = np.flatnonzero(per), np.log(m) + 3
    while len(todo):
        keep = np.repeat(np.isin(np.arange(n), todo), per) if len(todo) < n else slice(None)
        owner = np.repeat(np.arange(n), per)[keep]
        limit = np.zeros(n)
        limit[todo] = slack * m / total[todo]
        sig[todo] = np.inf
        _points(e[keep], w[keep], owner, limit, sig)
        todo = todo[np.isinf(sig[todo]).any(axis=1)]  # a component without a point so far: look further
        slack *= 2
    return sig.astype(np.float32)


def _pieces(texts: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most` bytes."""
    _, offs = buffers(texts)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, min(b, len(texts))
        a = b


def bags(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return counted(*shingles(*words(*buffers(texts)), k))


def planes(sig: np.ndarray) -> np.ndarray:
    """Four hashed bits of each component of a signature; the first bits of 64 components in a long, then their second, third and fourth ones."""
    n, m = sig.shape
    bits = np.zeros((n, -(-m // 64), 4, 64), np.uint64)
    bits[:] = np.pad(mix(sig) >> _U(60), ((0, 0), (0, -m % 64))).reshape(n, -1, 1, 64) >> np.arange(4, dtype=np.uint64)[:, None] & _U(1)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=3, dtype=np.uint64).reshape(n, -1).view(np.int64)


def _unlike(x: str, y: str, longs: int):
    """Number of components in which two sketches differ, as a column.

    It names each long once: Spark repeats the code of whatever is named twice in a join's condition, and Java leaves long methods uncompiled.
    """
    total = F.lit(0)
    for i in range(0, longs, 4):
        total = total + F.bit_count(reduce(lambda d, e: d.bitwiseOR(e), [F.get(x, F.lit(j)).bitwiseXOR(F.get(y, F.lit(j))) for j in range(i, i + 4)]))
    return total


def _signer(k: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(bands, dtype=np.uint64))
        for batch in batches:
            for a, b in _pieces(batch.column(1)):
                ids, texts = batch.column(0)[a:b], batch.column(1)[a:b]
                e, w, at = bags(texts, k)
                sig = bag_minhash(e, w, at, bands * rows).view(np.uint32).astype(np.uint64).reshape(len(texts), bands, rows)
                key = np.broadcast_to(salt, sig.shape[:2])
                for r in range(rows):
                    key = mix(key ^ sig[:, :, r])
                empty = np.diff(at) == 0
                flat = pa.array(key[~empty].reshape(-1).view(np.int64))
                listed = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.where(empty, 0, bands))]).astype(np.int32), flat)
                data, offs = buffers(texts)
                raw, valid = data.tobytes(), texts.is_valid().to_pylist()
                digest = [hashlib.md5(raw[x:y]).digest() if ok else None for x, y, ok in zip(offs[:-1].tolist(), offs[1:].tolist(), valid, strict=True)]
                sketch = planes(sig.reshape(len(texts), bands * rows))
                longs = pa.ListArray.from_arrays(np.arange(0, sketch.size + 1, sketch.shape[1], dtype=np.int32), pa.array(sketch.reshape(-1)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(digest, pa.binary()), listed, longs], ["id", "digest", "bands", "sketch"])

    return sign


def overlap(ea: np.ndarray, wa: np.ndarray, eb: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets with sorted distinct elements."""
    where = np.searchsorted(ea, eb)
    same = where < len(ea)
    same[same] = ea[where[same]] == eb[same]
    both = np.minimum(wa[where[same]], wb[same]).sum()
    whole = wa.sum() + wb.sum() - both
    return float(both / whole) if whole else 0.0


def _verifier(k: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            ends = np.cumsum(np.diff(buffers(left)[1]) + np.diff(buffers(right)[1]))
            i = 0
            while i < len(batch):  # runs of rows of about 2 MB of text
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + (1 << 21), "right")))
                coded = pa.concat_arrays([left[i:j], right[i:j]]).dictionary_encode()  # a text of many links is read once
                held = []
                for x, y in _pieces(coded.dictionary):
                    e, w, at = bags(coded.dictionary[x:y], k)
                    held += [(e[p:q], w[p:q]) for p, q in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                of = coded.indices.to_numpy().reshape(2, -1)
                sim = pa.array([overlap(*held[x], *held[y]) for x, y in of.T.tolist()], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], sim], ["a", "b", "sim"])
                i = j

    return verify


def _similar(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(a, b, sim) for pairs (a, b) of nodes, by the multisets of their whole texts."""
    left = texts.select(F.col("nid").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("nid").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "ta", "tb")
    return joined.mapInArrow(_verifier(k), "a long, b long, sim double")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, k: int = SHINGLE, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """One row for each row of docs: id, digest (MD5 of the text), class_id, class_digest.

    class_id and class_digest name the class's representative: its least id (nulls last) and
    among rows of that id the least digest.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.ArrayType(T.LongType()))])
    signed = materialize(slim.mapInArrow(_signer(k, bands, rows), schema), "signed")

    nodes = signed.where("digest is not null").groupBy("digest").agg(F.min("id").alias("first_id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = materialize(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")  # written once, so the numbers stay
    banded = nodes.select("nid", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(banded.join(buckets, "key"), "shared")
    met = shared.groupBy("nid").agg(F.sum("n").alias("met"))
    heads = shared.join(met, "nid").groupBy("key").agg(F.max(F.struct("met", "nid")).alias("h")).select("key", F.col("h.nid").alias("head"))
    members = materialize(shared.join(heads, "key").select("key", "nid", "head"), "members")

    stars = members.where("nid <> head").select(F.col("head").alias("a"), F.col("nid").alias("b")).distinct()
    stars = materialize(stars, "stars")
    involved = materialize(stars.select("a").union(stars.select("b")).distinct().withColumnRenamed("a", "nid").join(nodes.select("nid", "digest"), "nid"), "involved")
    # A merge join at every size: what it shuffles follows the input, and Spark splits a digest with many copies.
    texts = slim.where("text is not null").withColumn("digest", F.unhex(F.md5("text"))).hint("merge").join(involved, "digest").groupBy("nid").agg(F.first("text").alias("text"))
    texts = materialize(texts, "texts")
    near = materialize(_similar(stars, texts, k), "near")
    links = near.where(F.col("sim") >= threshold).select("a", "b")
    parts = materialize(components(links), "parts")

    # Members that no link ties to their band's head may be linked to others of the band. With x and y the
    # distances of two members from the head, their own distance is |x - y| or more, so most pairs need no look.
    placed = members.join(near.select(F.col("a").alias("head"), F.col("b").alias("nid"), (1 - F.col("sim")).alias("far")), ["head", "nid"], "left").withColumn("far", F.coalesce("far", F.lit(0.0)))
    placed = placed.join(parts.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    heads = parts.select(F.col("node").alias("head"), F.col("root").alias("head_root"))
    placed = placed.join(heads, "head", "left").withColumn("head_root", F.coalesce("head_root", "head"))
    placed = materialize(placed.select("key", "head", "nid", "far", "root", (F.col("root") != F.col("head_root")).alias("stray")), "placed")
    signs = nodes.select("nid", "sketch", "bands")
    strays = placed.where("stray").join(signs, "nid").select("key", F.col("nid").alias("s"), F.col("far").alias("s_far"), F.col("root").alias("s_root"), F.col("sketch").alias("s_sketch"), F.col("bands").alias("s_bands"))
    strays = materialize(strays, "strays")
    others = placed.where("nid <> head").join(strays.select("key").distinct(), "key", "left_semi").join(signs, "nid").select("key", "nid", "far", "root", "stray", "sketch", "bands")
    m = bands * rows
    most = m * 15 / 16 * (1 - threshold) + ERRORS * (m * 15 / 16 * (1 - threshold) * (1 - 15 / 16 * (1 - threshold))) ** 0.5
    apart = (F.col("root") != F.col("s_root")) & (~F.col("stray") | (F.col("s") < F.col("nid")))
    hopeful = (F.abs(F.col("far") - F.col("s_far")) <= 1 - threshold + 1e-9) & (_unlike("sketch", "s_sketch", -(-m // 64) * 4) <= most)
    once = F.col("key") == F.get(F.array_intersect("bands", "s_bands"), F.lit(0))  # in the first band that a pair shares
    open_pairs = strays.join(others, "key").where(apart & hopeful & once)
    open_pairs = open_pairs.select(F.greatest("s", "nid").alias("b"), F.least("s", "nid").alias("a")).distinct()
    more = materialize(_similar(open_pairs, texts, k).where(F.col("sim") >= threshold).select("a", "b"), "more")
    if not more.isEmpty():
        parts = materialize(components(links.union(more)), "parts")

    placed = parts.withColumnRenamed("node", "nid").join(nodes.select("nid", "digest", "first_id"), "nid")
    elected = materialize(placed.groupBy("root").agg(F.min(rep_of("first_id", "digest")).alias("rep")), "elected")
    tied = placed.join(elected, "root").select("digest", "rep")
    named = nodes.select("digest", rep_of("first_id", "digest").alias("own")).join(tied, "digest", "left").select("digest", F.coalesce("rep", "own").alias("rep"))
    named = materialize(named, "named")  # so that both sides of the next join are shuffled for it, and Spark can split a digest with many copies
    out = signed.select("id", "digest").join(named, "digest", "left")
    rep = F.coalesce("rep", rep_of("id", "digest"))
    return out.select("id", "digest", rep["id"].alias("class_id"), rep["digest"].alias("class_digest"))


def rep_of(id_col: str, digest_col: str):
    """Orders ids with nulls last, then digests."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(digest_col).alias("digest"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with one row of each class: its representative. All columns stay as they are."""
    classes = near_duplicates(docs, id_col, text_col, **how)
    kept = classes.where(F.col("id").eqNullSafe(F.col("class_id")) & F.col("digest").eqNullSafe(F.col("class_digest")))
    kept = materialize(kept.select("id", "digest"), "kept")  # a few rows of each class, before they are grouped
    ident, digest = free_name(docs, "__id"), free_name(docs, "__digest")
    keys = kept.select(F.col("id").alias(ident), F.col("digest").alias(digest))
    tagged = docs.withColumn(digest, F.unhex(F.md5(F.col(text_col).cast("string"))))
    out = tagged.join(keys, F.col(id_col).eqNullSafe(keys[ident]) & tagged[digest].eqNullSafe(keys[digest]), "left_semi")
    if kept.where("digest is not null").groupBy("id", "digest").count().where("count > 1").isEmpty():
        return out.drop(digest)
    alone = out.where(F.col(digest).isNull())  # rows without a text are classes of their own, repeated or not
    return out.where(F.col(digest).isNotNull()).dropDuplicates([id_col, digest]).union(alone).drop(digest)
