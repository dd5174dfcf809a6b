"""Mixing sources to target weights by entropy balancing.

A document's size is its number of words (runs of other characters than ASCII white space).
Each source has a target in words. Among all document rates r between 0 and MOST with the source's target as their
weighted sum, entropy balancing takes the one of least relative entropy to rate 1: r = min(MOST, exp(l * x)), an
exponential tilt in x, the size by the source's mean size, clipped where the bound holds. The multiplier l solves the
source's convex dual, whose gradient is the target minus the words taken. All sources take a Newton step at once: one
distributed aggregation of the words taken and of the curvature (on the logarithm, which a tilt makes nearly straight),
until every gradient vanishes. Documents of one source and size have the same rate, so these sums run over
(source, size, count) cells, not over documents. Rates become whole copies cell by cell, the largest size first, each
cell making up for the rounding of those before; within a cell a seeded hash chooses who gets the extra copy.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
documents of size 0 are taken once; sources without words have target 0; a table without words
gives targets of 0; repeated rows are documents of their own; extra columns stay.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_name, materialize

#: No document is taken more often, no source beyond so many times its size.
MOST = 3
#: Rows of a cell that one task ranks. Larger cells are split by hash.
CELL_ROWS = 256
SEED = 9001

_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text_col: str):
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame) -> DataFrame:
    """sources with the column weight: 1, 2, 3, 1, ... in code point order, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", (1 + (F.row_number().over(order) - 1) % 3).cast("double"))


def water_fill(sources: DataFrame, most: int = MOST) -> DataFrame:
    """sources (source, source_size, weight) with target: shares of all words by weight, no target above `most` times
    the source's size; the excess is shared again by weight.

    Sources in the order in which they reach their cap: a prefix of them is capped, and the rest share what remains.
    """
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy("full", F.col("source").asc_nulls_last())
    s = sources.withColumn("cap", (most * F.col("source_size")).cast("double")).withColumn("full", F.col("cap") / F.col("weight"))
    s = s.withColumns({"all_words": F.sum("source_size").over(everything), "all_weight": F.sum("weight").over(everything), "capped": F.sum("cap").over(order) - F.col("cap"), "gone": F.sum("weight").over(order) - F.col("weight")})
    s = s.withColumn("level", (F.col("all_words") - F.col("capped")) / (F.col("all_weight") - F.col("gone")))
    s = s.withColumn("level", F.max(F.when(F.col("full") >= F.col("level"), F.col("level"))).over(everything))
    return s.withColumn("target", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))).select("source", "source_size", "weight", "target")


#: Newton iterations at most, and the gradient (in parts of the source's words) that ends them.
MOST_STEPS, EXACT = 60, 1e-9


def next_multiplier(at, low, high, words, curve, target, lib):
    """The Newton step on ln(words) from `at`, or the middle of the bracket (low, high) if it would leave it. lib: numpy or columns."""
    step = at + words * lib.log(target / words) / lib.greatest(curve, 1e-300)
    return lib.where((step > low) & (step < high), step, (low + high) / 2)


class _Columns:
    """What next_multiplier() needs, as column functions."""

    log, greatest, where = staticmethod(F.log), staticmethod(lambda x, least: F.greatest(x, F.lit(least))), staticmethod(lambda test, x, y: F.when(test, x).otherwise(y))


class _Arrays:
    log, greatest, where = staticmethod(np.log), staticmethod(np.maximum), staticmethod(np.where)


def tilt(size: np.ndarray, count: np.ndarray, target: float, most: int = MOST) -> tuple[np.ndarray, int]:
    """Rates of one source's cells (size, count) whose words sum to target, and the Newton iterations it took: what `multipliers` does, on one machine."""
    whole = float((size * count).sum())
    if not whole or target <= 0:
        return np.where(size > 0, 0.0, 1.0), 0
    if target >= most * whole * (1 - EXACT):
        return np.where(size > 0, float(most), 1.0), 0
    x = size / (whole / count[size > 0].sum())
    least = x[size > 0].min()
    at, low, high = 0.0, min(0.0, math.log(target / whole) / least), math.log(most) / least * (target > whole)
    for step in range(1, MOST_STEPS):
        rate = np.minimum(most, np.exp(at * x))
        words = float((rate * size * count).sum())
        if abs(target - words) <= EXACT * whole:
            break
        curve = float(((rate < most) * rate * x * size * count).sum())
        low, high = (at, high) if words < target else (low, at)
        at = float(next_multiplier(at, low, high, words, curve, target, _Arrays))
    return np.where(size > 0, rate, 1.0), step


def multipliers(cells: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """goals (source, source_size, target) with mean_size and the multiplier `at` of each source that has an inner solution (else null).

    cells: (source, size, n). Each iteration is one aggregation of the cells by source, written to the shared folder.
    """
    told = cells.where("size > 0").groupBy(F.col("source").alias("of")).agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_size"), F.min("size").alias("least"))
    s = goals.join(told, goals["source"].eqNullSafe(told["of"]), "left").drop("of")
    whole, least = F.col("source_size").cast("double"), F.col("least") / F.col("mean_size")
    inner = (F.col("target") > 0) & (F.col("target") < F.lit(most * (1 - EXACT)) * whole)
    s = s.withColumns({"at": F.when(inner, F.lit(0.0)), "low": F.least(F.lit(0.0), F.log(F.col("target") / whole) / least), "high": F.when(F.col("target") > whole, math.log(most) / least).otherwise(0.0), "done": ~inner})
    s = materialize(s.select("source", "source_size", "target", "mean_size", "at", "low", "high", "done"), "multipliers")
    for _ in range(MOST_STEPS):
        todo = s.where(~F.col("done"))
        if todo.isEmpty():
            break
        x = F.col("size") / F.col("mean_size")
        rate, mass = F.least(F.lit(float(most)), F.exp(F.col("at") * x)), F.col("size") * F.col("n")
        met = cells.withColumnRenamed("source", "of").join(todo, F.col("of").eqNullSafe(todo["source"]))
        sums = met.groupBy("of").agg(F.sum(rate * mass).alias("words"), F.sum(F.when(rate < most, rate * x * mass).otherwise(0.0)).alias("curve"))
        got = s.join(sums, s["source"].eqNullSafe(sums["of"]), "left").drop("of")
        open_ = ~F.col("done") & (F.abs(F.col("target") - F.col("words")) > EXACT * F.col("source_size"))
        got = got.withColumns({"low": F.when(F.col("words") < F.col("target"), F.col("at")).otherwise(F.col("low")), "high": F.when(F.col("words") >= F.col("target"), F.col("at")).otherwise(F.col("high"))})
        new = next_multiplier(F.col("at"), F.col("low"), F.col("high"), F.col("words"), F.col("curve"), F.col("target"), _Columns)
        got = got.withColumns({"at": F.when(open_, new).otherwise(F.col("at")), "done": ~F.coalesce(open_, F.lit(False))})
        s = materialize(got.select(*s.columns), "multipliers")
    return s.select("source", "source_size", "target", "mean_size", "at")


def whole_copies(size: np.ndarray, count: np.ndarray, rate: np.ndarray, most: int = MOST) -> np.ndarray:
    """Copies of all documents of each cell together, cells in descending size: each makes up for the rounding so far."""
    out, owed = np.zeros(len(size), np.int64), 0.0
    for i, (z, n, r) in enumerate(zip(size.tolist(), count.tolist(), rate.tolist(), strict=True)):
        low, high = max(0, math.floor(r) - 1) * n, min(most, math.ceil(r) + 1) * n
        out[i] = min(high, max(low, math.floor(r * n + (owed / z if z else 0) + 0.5)))
        owed += (r * n - out[i]) * z
    return out


def mix_sources(docs: DataFrame, weigh=cycle_weights, source_col: str = "source", text_col: str = "text", most: int = MOST, seed: int = SEED) -> DataFrame:
    """docs with size, source_size, target and copies (how often the mix takes the row).

    weigh adds the column weight to (source, source_size).
    """
    names = ("size", "source_size", "target", "copies", "__row", "__block", "__key", "__cell_size", "__cell_n", "__cell_copies")
    size, source_size, target, copies, row, block, key, cell_size, n, total = (free_name(docs, c) for c in names)
    sized = docs.withColumns({size: size_of(text_col), row: F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith("map")])})
    cells = materialize(sized.groupBy(F.col(source_col).alias("source"), F.col(size).alias("size")).agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = materialize(water_fill(weigh(sources), most), "goals")

    def balance(cell: pa.Table) -> pa.Table:
        """Whole copies of one source's cells (its different sizes, however many documents it has)."""
        cell = cell.sort_by([("size", "descending")])
        z, c, rate = (np.asarray(cell.column(x)) for x in ("size", "n", "rate"))
        return cell.append_column("cell_copies", pa.array(whole_copies(z, c, rate, most))).select(["source", "size", "n", "source_size", "target", "cell_copies"])

    goals = multipliers(cells, goals, most)
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("target") <= 0, 0.0).when(F.col("at").isNull(), float(most)).otherwise(F.least(F.lit(float(most)), F.exp(F.col("at") * F.col("size") / F.col("mean_size"))))
    tied = cells.join(goals, cells["source"].eqNullSafe(goals["source"])).select(cells["source"], "size", "n", "source_size", "target", rate.alias("rate"))
    kind = cells.schema["source"].dataType.simpleString()
    solved = tied.groupBy("source").applyInArrow(balance, f"source {kind}, size long, n long, source_size long, target double, cell_copies long")
    solved = materialize(solved, "solved").select(F.col("source").alias(key), F.col("size").alias(cell_size), F.col("n").alias(n), F.col("source_size").alias(source_size), F.col("target").alias(target), F.col("cell_copies").alias(total))

    joined = sized.join(solved, sized[source_col].eqNullSafe(solved[key]) & (sized[size] == solved[cell_size]))
    joined = joined.withColumn(block, F.pmod(F.col(row), F.ceil(F.col(n) / CELL_ROWS)))
    # A block of a split cell gets its share of the extra copies, rounded with a seeded hash as the chance.
    cell = Window.partitionBy(key, size, block)
    base = F.floor(F.col(total) / F.col(n))
    extra = (F.col(total) - base * F.col(n)) / F.col(n) * F.count(F.lit(1)).over(cell)
    chance = F.when(F.col(n) <= CELL_ROWS, 0.5).otherwise(F.pmod(F.xxhash64(F.lit(seed), key, size, block), F.lit(1 << 20)) / (1 << 20))
    got = base + (F.row_number().over(cell.orderBy(F.xxhash64(row))) <= F.floor(extra + chance)).cast("long")
    out = joined.withColumn(copies, F.least(F.lit(most), got).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], size, source_size, target, copies)


def take_mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken."""
    mixed = mix_sources(docs, **how)
    copies = mixed.columns[-1]
    return mixed.withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
