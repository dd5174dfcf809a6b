"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text's features are its words and their first six and eight bytes, hashed into 2^16 weights and
damped by the square root of the text's length, the share of each ASCII character that is no
lower-case letter, and the share of words that repeat the word before. One weight
vector w is shared by all grades; ordered thresholds t_1 < ... < t_{K-1} give
P(grade >= k) = 1 / (1 + exp(t_k - w x)), hence the expected grade and the tail probability
that selects. Ratings of the table `labels`: 0 for quality 0, 1 for toxic texts, 2 for the rest.

The model is fitted on the driver on a bounded sample: at most `most` (LABELLED) ratings of documents that there are, those with
the least hash of id and grade, and of these as many, in this order, as have `entries` (ENTRIES) features together. So fitting costs the
same at every corpus size; scoring covers every row. Defined cases: a null text is an empty one; an empty text has no features and
gets what the thresholds alone say; labels without a rating or a document are ignored; several labels of one
id all count; of several documents of one id the one whose text has the least hash is learned from. Without two different
ratings nothing can be learned and every text gets the highest rating seen (0 if none). Without a rating of the
wanted grade its probability is unknown: it is null, and `select` keeps every row. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import buffers, free_name, materialize, mix, small_batches, words

#: Bound of the labelled sample that the model is fitted on.
LABELLED = 6000
#: Bound of the sample's features, all texts together: 8 bytes each on the driver.
ENTRIES = 16_000_000
BITS = 16
WIDTH = (1 << BITS) + 129
#: Leading bytes of a word that count as a feature of their own, so that inflected forms share weight.
PREFIXES = (6, 8)
SCALE = 5.0
LEAST_FAR = 2.5
_SHIFT = np.uint64(64 - BITS)
KEEP_GRADE, KEEP_TAIL = 2, 0.7


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # of grades 1, 2, ...


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: feature numbers, values, and the first entry of each text (n + 1 of them)."""
    data, offs = buffers(texts)
    h, first = words(data, offs)
    per = np.diff(first)
    n = len(per)
    text = np.repeat(np.arange(n), per)
    damp = SCALE / np.sqrt(np.maximum(per, 1))[text]
    parts = [(text, h >> _SHIFT, damp)]
    for p in PREFIXES:
        stem, _ = words(data, offs, p)
        parts.append((text, mix(stem + np.uint64(p)) >> _SHIFT, damp))
    again = np.flatnonzero((h[1:] == h[:-1]) & (text[1:] == text[:-1]))
    repeats = np.bincount(text[again], minlength=n)
    row = np.flatnonzero(repeats)
    parts.append((row, np.full(len(row), WIDTH - 1), SCALE * repeats[row] / per[row]))
    owner = np.repeat(np.arange(n), np.diff(offs))
    told = (data < 128) & ~((data >= 97) & (data <= 122)) & (data != 32)
    signs = np.bincount(owner[told] * 128 + data[told], minlength=n * 128).reshape(n, 128)
    row, sign = np.nonzero(signs)
    parts.append((row, sign + (1 << BITS), SCALE * np.sqrt(signs[row, sign] / np.diff(offs)[row])))
    text = np.concatenate([x[0] for x in parts])
    order = np.argsort(text, kind="stable")
    index = np.concatenate([x[1].astype(np.int32) for x in parts])[order]
    return index, np.concatenate([x[2] for x in parts])[order], np.searchsorted(text[order], np.arange(n + 1))


def merged(index: np.ndarray, value: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same rows with each feature once: values of one feature of a text are added up."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    key, back = np.unique(owner * WIDTH + index, return_inverse=True)
    total = np.bincount(back, value, minlength=len(key)).astype(np.float32)
    return (key % WIDTH).astype(np.int32), total, np.searchsorted(key // WIDTH, np.arange(len(at)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def relevance(index: np.ndarray, at: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """How far each feature's frequency in some grade lies from what chance gives, in standard deviations (rows of merged()).

    Features near chance get 0 and so drop out: they'd only let the model learn single texts by heart.
    """
    everywhere, far = np.bincount(index, minlength=WIDTH), np.zeros(WIDTH)
    for k in np.unique(grades):
        chance = everywhere * (grades == k).mean()
        here = np.bincount(index[np.repeat(grades == k, np.diff(at))], minlength=WIDTH)
        far = np.maximum(far, np.abs(here - chance) / np.sqrt(chance + 1))
    out = np.where(far > LEAST_FAR, np.minimum(far, 20) / 4, 0)
    out[1 << BITS :] = np.maximum(out[1 << BITS :], 0.5)
    return out


def ordered(t: np.ndarray) -> np.ndarray:
    """The nearest thresholds in order: those in disorder become their mean, so that a grade without ratings pulls neither up nor down."""
    blocks: list[list[float]] = []
    for x in t.tolist():
        blocks.append([x, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            (a, m), (b, n) = blocks[-2:]
            blocks[-2:] = [[(a * m + b * n) / (m + n), m + n]]
    return np.repeat([b for b, _ in blocks], [n for _, n in blocks])


def fit(index: np.ndarray, value: np.ndarray, at: np.ndarray, grades: np.ndarray, epochs: int = 40, rate: float = 0.3, decay: float = 1e-5, seed: int = 7) -> Model:
    """Minimise the cumulative-link log loss by AdaGrad over seeded batches of 64 texts."""
    top = int(grades.max()) if len(grades) else 0
    if not len(grades) or grades.min() == top:
        return Model(np.zeros(WIDTH), np.full(top, -40.0))
    scale = relevance(index, at, grades)
    told = scale[index] > 0
    at = np.concatenate([[0], np.cumsum(told, dtype=np.int64)])[at]
    index = index[told]
    value = value[told] * scale[index].astype(np.float32)
    rng = np.random.default_rng(seed)
    w, t = np.zeros(WIDTH), np.log(np.array([((grades < k).mean() + 1e-3) / ((grades >= k).mean() + 1e-3) for k in range(1, top + 1)]))
    gw, gt = np.full(WIDTH, 1e-2), np.full(top, 1e-2)
    n, per = len(grades), np.diff(at)
    for _ in range(epochs):
        order = rng.permutation(n)
        for some in np.array_split(order, max(1, n // 64)):
            entry = np.repeat(at[some] - np.concatenate([[0], np.cumsum(per[some])[:-1]]), per[some]) + np.arange(per[some].sum())
            owner, i, v = np.repeat(np.arange(len(some)), per[some]), index[entry], value[entry]
            score = np.bincount(owner, w[i] * v, minlength=len(some))
            g = grades[some]
            # P(g) = s(t_{g+1} - score) - s(t_g - score), with t_0 = -inf and t_{K} = inf
            bounds = np.concatenate([[-40.0], t, [40.0]])
            hi, lo = _sigmoid(bounds[g + 1] - score), _sigmoid(bounds[g] - score)
            p = np.maximum(hi - lo, 1e-6)
            dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
            ds = dhi - dlo
            feats, back = np.unique(i, return_inverse=True)
            grad = np.bincount(back, ds[owner] * v) / len(some) + decay * w[feats]
            gw[feats] += grad**2
            w[feats] -= rate * grad / np.sqrt(gw[feats])
            grad_t = (np.bincount(g, dlo, minlength=top + 1)[1:] - np.bincount(g, dhi, minlength=top + 1)[:top]) / len(some)
            gt += grad_t**2
            t = ordered(t - rate * grad_t / np.sqrt(gt))
    return Model(w * scale, t)


def tails(model: Model, index: np.ndarray, value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1, 2, ...: texts x thresholds."""
    n = len(at) - 1
    score = np.bincount(np.repeat(np.arange(n), np.diff(at)), model.weights[index] * value, minlength=n)
    return _sigmoid(score[:, None] - model.thresholds[None, :])


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from the columns quality and toxic."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("doc_id is not null and quality is not null").select("doc_id", grade.alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = LABELLED, entries: int = ENTRIES) -> Model:
    """Fit on at most `most` ratings (doc_id, grade) of documents that there are, with at most `entries` features together."""
    small_batches(docs.sparkSession)
    rated = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    told = ratings.select("doc_id", F.col("grade").cast("int").alias("grade")).where("grade is not null").join(rated.select("doc_id"), "doc_id", "left_semi")
    # `most` rows of three numbers: small enough to broadcast whatever the corpus's size.
    ids = materialize(told.withColumn("order", F.xxhash64("doc_id", "grade")).orderBy("order", "doc_id", "grade").limit(most), "labelled")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i, v, at = merged(*features(b.column(1)))
            offs = pa.array(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offs, pa.array(i)), pa.ListArray.from_arrays(offs, pa.array(v))], ["doc_id", "i", "v"])

    kind = rated.schema["doc_id"].dataType.simpleString()
    once = rated.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sparse_rows = materialize(once.mapInArrow(sparse, f"doc_id {kind}, i array<int>, v array<float>").join(F.broadcast(ids), "doc_id"), "features")
    sized = sparse_rows.select("doc_id", "grade", "order", F.size("i").alias("n"))  # `most` rows of four numbers
    kept = sized.withColumn("sum", F.sum("n").over(Window.orderBy("order", "doc_id", "grade").rowsBetween(Window.unboundedPreceding, 0))).where(F.col("sum") <= entries)
    got = sparse_rows.join(F.broadcast(kept.select("doc_id", "grade").distinct()), ["doc_id", "grade"], "left_semi").drop("order").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("grade", "ascending")]).combine_chunks()
    at = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(got.column("i"))))]).astype(np.int64)
    i, v, grades = (np.array(x) for x in (pc.list_flatten(got.column("i")), pc.list_flatten(got.column("v")), got.column("grade").cast(pa.int64())))  # copies, so that the table can go
    del got
    pa.default_memory_pool().release_unused()
    return fit(i, v, at, grades)


def score(docs: DataFrame, model: Model, text_col: str = "text", grade: int = KEEP_GRADE) -> DataFrame:
    """docs with expected_grade and tail_probability, P(rating >= grade)."""
    expected, tail, both = (free_name(docs, c) for c in ("expected_grade", "tail_probability", "__score"))
    weights = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))  # 2^16 floats at any size

    @F.pandas_udf("expected double, tail double")
    def rate(texts):
        import pandas as pd

        w, t = weights.value
        arr, out = pa.array(texts, pa.string(), from_pandas=True), []
        _, offs = buffers(arr)
        a = 0
        while a < len(arr):
            b = min(len(arr), max(a + 1, int(np.searchsorted(offs, offs[a] + (1 << 20), "right")) - 1))
            out.append(tails(Model(w, t), *features(arr[a:b])))
            a = b
        p = np.concatenate(out) if out else np.zeros((0, len(t)))
        last = p[:, grade - 1] if p.shape[1] >= grade else np.full(len(p), None)  # a grade that nothing was learned about
        return pd.DataFrame({"expected": p.sum(axis=1), "tail": last})

    small_batches(docs.sparkSession)
    scored = docs.withColumn(both, rate(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return scored.withColumns({expected: F.col(f"{both}.expected"), tail: F.col(f"{both}.tail")}).drop(both)


def select(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade: int = KEEP_GRADE, tail: float = KEEP_TAIL) -> DataFrame:
    """Rows of docs whose tail probability is at least `tail` or unknown, with the two scores."""
    scored = score(docs, train(docs, ratings, id_col, text_col), text_col, grade)
    return scored.where(F.coalesce(F.col(scored.columns[-1]) >= tail, F.lit(True)))
