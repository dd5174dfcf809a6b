"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts become templates: case and punctuation go, and numbers, names (capitalised words that
don't begin a sentence) and units (of a number) become typed placeholders that remember their
value. Runs of five template words are hash-joined with those of the benchmark: those with three
words or more that are no placeholders by their templates, others by their values too. Runs of one document and item on the same diagonal
(document place minus item place) should fill the item's slots consistently: each value of the
item stands for one value of the document. Where they don't, the runs count that fill their slots
with the value more than half of the diagonal's runs have there (the item's own if there is none),
and those with the item's own values.

A document leaks an item if it holds 0.8 of the item's different runs, or 0.8 of those that are
joined by their templates, or as many runs in a row of the item as a passage of `passage` words has.
`matched` and `windows` count all runs.

Defined cases: a null or empty text, or one of fewer than five words, leaks nothing and, as an
item, can't be found; repeated rows of one id and text are one document; documents with a null
id are told apart by their text; equal items are all reported; an empty table gives an empty
result; extra columns are ignored by `leaks` and kept by `decontaminate`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

WINDOW, CONTAINMENT, LITERALS = 5, 0.8, 3
#: Words of an item in a row that make a passage.
PASSAGE = 13
#: Benchmark windows that may be broadcast; beyond, both sides are shuffled by the window's hash.
BROADCAST_ROWS = 500_000

# Marks of a number, a name, a decimal sign within a number, and a unit. Texts don't keep these control characters.
_NUM, _NAME, _POINT, _UNIT = "\u0002", "\u0003", "\u0004", "\u0005"
_MARKS = "[\u0002\u0003\u0005]"
# Units of measure and of money.
UNITS = (
    "km", "m", "cm", "mm", "mi", "miles", "mile", "ft", "feet", "foot", "inch", "inches", "yards", "yard", "meters", "metres", "meter", "metre", "kilometers", "kilometres",
    "kg", "g", "mg", "lb", "lbs", "oz", "pounds", "pound", "ounces", "grams", "kilograms", "tons", "l", "ml", "liters", "litres", "gallons",
    "s", "sec", "seconds", "second", "min", "minutes", "minute", "h", "hours", "hour", "days", "day", "weeks", "week", "months", "month", "years", "year",
    "percent", "dollars", "dollar", "cents", "cent", "euros", "euro", "usd", "eur", "gbp", "mph", "kmh", "degrees", "watts", "volts", "joules", "newtons",
)


def template(text: Column) -> Column:
    """Template words with one space between them; a placeholder is its mark followed by its value."""
    t = F.translate(text, _NUM + _NAME + _POINT + _UNIT, "    ")
    t = F.regexp_replace(t, r"[.,](?<=\p{Nd}.)(?=\p{Nd})", _POINT)
    t = F.regexp_replace(t, r"\p{Lu}(?<=[\p{Ll}\p{Nd},;] .)[\p{L}\p{M}]+", _NAME + "$0")
    t = F.lower(t)
    t = F.regexp_replace(t, f"[\\p{{Nd}}{_POINT}]+", f" {_NUM}$0 ")
    t = F.trim(F.regexp_replace(t, f"[^\\p{{L}}\\p{{M}}\\p{{Nd}}{_NUM}-{_UNIT}]+", " "))
    return F.when(F.contains(t, F.lit(_NUM)), F.regexp_replace(t, f"({_NUM}[^ ]+ )(?=(?:{'|'.join(UNITS)})(?: |$))", f"$1{_UNIT}")).otherwise(t)


def windows(words: Column, k: int = WINDOW) -> Column:
    """All runs of k template words, in order."""
    return F.regexp_extract_all(words, F.lit(f"(?:^|(?<= ))(?=([^ ]+(?: [^ ]+){{{k - 1}}}))"), 1)


def is_literal(window: Column, k: int = WINDOW) -> Column:
    """Whether a run has enough words that are no placeholders to be joined by its template."""
    return ~window.rlike(f"(?:{_MARKS}[^{_MARKS[1:-1]}]*){{{k - min(LITERALS, k) + 1}}}")


def window_key(window: Column, k: int = WINDOW) -> Column:
    """Hash of a run without the values of its placeholders; with them, if there are few other words."""
    bare = F.when(window.rlike(_MARKS) & is_literal(window, k), F.regexp_replace(window, f"({_MARKS})[^ ]*", "$1")).otherwise(window)
    return F.xxhash64(bare)


def benchmark_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", k: int = WINDOW) -> DataFrame:
    """(key, item_id, q, item_window, literal, windows, literal_windows) of all runs; q is a run's place in its item."""
    w = items.select(F.col(item_col).alias("item_id"), F.posexplode(windows(template(F.col(text_col).cast("string")), k)).alias("at", "item_window"))
    w = w.withColumns({"key": window_key(F.col("item_window"), k), "literal": is_literal(F.col("item_window"), k)})
    total = w.groupBy(F.col("item_id").alias("of_item")).agg(F.count_distinct("key").alias("windows"), F.count_distinct(F.when(F.col("literal"), F.col("key"))).alias("literal_windows"))
    return w.join(total, F.col("item_id").eqNullSafe(F.col("of_item"))).select("key", "item_id", F.col("at").alias("q"), "item_window", "literal", "windows", "literal_windows")


def _slots(window: str) -> Column:
    return F.regexp_extract_all(F.col(window), F.lit(f"{_MARKS}[^ ]*"), 0)


def _usual(runs: Column, pairs: Column) -> Column:
    """For each value of the item, what more than half of its runs hold for it; else the item's own value."""
    holds = lambda v: F.size(F.filter(runs, lambda r: F.array_contains(r["pairs"], v)))
    every = lambda v: F.size(F.filter(runs, lambda r: F.exists(r["pairs"], lambda w: w["x"] == v["x"])))
    most = F.filter(pairs, lambda v: 2 * holds(v) > every(v))
    return F.concat(most, F.filter(pairs, lambda v: (v["x"] == v["y"]) & ~F.exists(most, lambda w: w["x"] == v["x"])))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", k: int = WINDOW, containment: float = CONTAINMENT, passage: int = PASSAGE) -> DataFrame:
    """(doc_id, text_hash, item_id, matched, windows, longest) of every document that leaks an item."""
    bench = materialize(benchmark_windows(items, item_col, item_text_col, k), "bench")
    bench = F.broadcast(bench) if bench.count() <= BROADCAST_ROWS else bench
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), template(text).alias("words"))
    run = slim.select("doc_id", "text_hash", F.posexplode(windows(F.col("words"), k)).alias("p", "window")).withColumn("key", window_key(F.col("window"), k))
    hits = run.join(bench, "key").select("doc_id", "text_hash", "item_id", "key", "q", (F.col("p") - F.col("q")).alias("diagonal"), "literal", "windows", "literal_windows", "window", "item_window")

    # Values of an item's slots and what stands for them. Runs joined by their values have no slots.
    pair = F.array_distinct(F.arrays_zip(_slots("item_window").alias("x"), _slots("window").alias("y")))
    hits = hits.withColumn("pairs", F.when(F.col("literal") & F.col("window").rlike(_MARKS), pair).otherwise(F.array().cast("array<struct<x:string,y:string>>")))
    held = hits.groupBy("doc_id", "text_hash", "item_id", "diagonal", "windows", "literal_windows").agg(F.collect_set(F.struct("q", "key", "literal", "pairs")).alias("runs"))
    held = held.withColumn("pairs", F.array_distinct(F.flatten("runs.pairs")))
    # More values of the document than of the item means inconsistent.
    consistent = F.size(F.array_distinct("pairs.x")) == F.size("pairs")
    held = held.withColumn("usual", F.when(consistent, F.col("pairs")).otherwise(_usual(F.col("runs"), F.col("pairs"))))
    fits = lambda r: F.forall(r["pairs"], lambda v: F.array_contains("usual", v)) | F.forall(r["pairs"], lambda v: v["x"] == v["y"])
    held = held.withColumn("held", F.when(consistent, F.col("runs")).otherwise(F.filter("runs", fits)))
    # How many runs of the item follow each other without a gap, at most.
    places = F.array_sort(F.transform("held", lambda v: v["q"]))
    step = F.aggregate(
        places,
        F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best")),
        lambda a, q: F.struct(
            q.alias("last"),
            F.when(q == a["last"] + 1, a["run"] + 1).otherwise(1).alias("run"),
            F.greatest(a["best"], F.when(q == a["last"] + 1, a["run"] + 1).otherwise(1)).alias("best"),
        ),
        lambda a: a["best"],
    )
    held = held.withColumn("longest", step)
    keys = F.array_distinct(F.flatten(F.collect_list(F.transform("held", lambda v: F.struct(v["key"], v["literal"])))))
    found = held.groupBy("doc_id", "text_hash", "item_id", "windows", "literal_windows").agg(F.max("longest").cast("long").alias("longest"), keys.alias("keys"))
    literal = F.size(F.filter("keys", lambda v: v["literal"]))
    found = found.withColumns({"matched": F.size("keys").cast("long"), "literal": literal})
    reached = (F.col("matched") >= F.lit(containment) * F.col("windows")) | ((F.col("literal") > 0) & (F.col("literal") >= F.lit(containment) * F.col("literal_windows")))
    leak = reached | (F.col("longest") >= passage - k + 1)
    return found.where(leak).select("doc_id", "text_hash", "item_id", "matched", "windows", "longest")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without the rows that leak an item."""
    found = materialize(leaks(docs, items, id_col, text_col, **how).select("doc_id", "text_hash").distinct(), "leaks")
    ident, mark, hashed = (free_name(docs, c) for c in ("__leak_id", "__leak_hash", "__text_hash"))
    found = found.select(F.col("doc_id").alias(ident), F.col("text_hash").alias(mark))
    tagged = docs.withColumn(hashed, F.xxhash64(F.col(text_col).cast("string")))
    return tagged.join(found, F.col(id_col).eqNullSafe(found[ident]) & (tagged[hashed] == found[mark]), "left_anti").drop(hashed)
