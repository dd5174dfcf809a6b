"""Secret scans with DataFrame functions only.

Base kinds are found by pattern: assignments to a secret's name, access keys and hex strings.
The method adds the kind `entropy`: a candidate is a run of 20 or more characters of the
base64 alphabets that holds a letter and a digit; a window of 20 characters slides over it, and
the Shannon entropy of the window follows from counts that each step changes in two places.
The largest entropy must reach the threshold of the candidate's character class. Candidates that
an allow-list pattern matches, and those that overlap a base span, are left out. Time is in proportion to a
text's length, however long a candidate and however many matches it holds.

Defined cases: a null or empty text has no spans; equal rows have equal results; an empty table
gives an empty result; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: Same matches as HEX that are long enough; a shorter run can't be a part of one.
_LONG_HEX = f"(?<![0-9a-f])[0-9a-f]{{{LEAST_HEX},}}"
WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Least entropy, in bits, of a window of each character class.
THRESHOLDS = {"hex": 3.0, "base64": 3.9}
#: Candidates that are known to be harmless: placeholders, alphabets, long repeats, UUIDs.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|lorem|0123456789|abcdefghij|qwertyuiop",
    r"(.)\1{5,}",
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
KINDS = ("assign", "access", "hex", "entropy")


#: Elements that are summed up together on the way to running sums.
BLOCK = 64
_NO_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums_before(numbers: Column) -> Column:
    """For each element the sum of those before it, by sums of blocks: Spark copies an accumulator at each step, so none may grow."""
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda s, x: s + x)

    def sums(xs: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int")), lambda j: total(F.slice(xs, j * BLOCK + 1, BLOCK)))
        before = lambda bs: F.transform(bs, lambda _, j: total(F.slice(bs, F.lit(1), j)))
        return _bound(_bound(blocks, before), lambda bs: F.transform(xs, lambda _, i: F.get(bs, F.floor(i / BLOCK).cast("int")) + total(F.slice(xs, i - i % BLOCK + 1, i % BLOCK))))

    return _bound(numbers, lambda xs: F.when(F.size(xs) > 0, sums(xs)).otherwise(xs))


def located(text: Column, pattern: str, kind: str, group: int = 0, least: int = 1) -> Column:
    """Matches of pattern whose group has `least` characters or more, as structs (start, rank, end, kind, value), in order.

    Places are code points, the end is exclusive.
    """
    found, between, inner = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), group)
    pieces = F.filter(F.arrays_zip(found.alias("f"), between.alias("b"), inner.alias("g")), lambda x: x["f"].isNotNull())  # without what follows the last match

    def placed(xs: Column, before: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            start = F.get(before, i) + F.length(x["b"])
            made = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + F.length(x["f"])).alias("end"), F.lit(kind).alias("kind"), x["f"].alias("value"))
            return F.when(F.length(x["g"]) >= least, made)

        return F.filter(F.transform(xs, one), lambda x: x.isNotNull())

    return _bound(pieces, lambda xs: _bound(_sums_before(F.transform(xs, lambda x: F.length(x["b"]) + F.length(x["f"]))), lambda before: placed(xs, before)))


def _weight(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c)).otherwise(0.0)


#: Counts of a window's characters are packed in longs, so that a step touches two of them and copies few words.
_BITS, _PER_LONG = 5, 12


def peak_entropy(value: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy of a window (of 31 characters at most) of the ASCII string, in bits; 0 if it is shorter than a window.

    The counts of the 128 characters are fields of five bits in eleven longs. Each step lowers the count of
    the character that leaves, raises that of the one that enters, and changes the sum of c log2 c by these two counts.
    """
    units = F.array(*[F.lit(1 << _BITS * i).cast("long") for i in range(_PER_LONG)])
    unit = lambda c: F.get(units, c % _PER_LONG)
    long_of = lambda c: F.floor(c / _PER_LONG).cast("int")
    count = lambda n, c: F.floor(F.get(n, long_of(c)) / unit(c)).cast("long") % (1 << _BITS)
    bump = lambda n, c, by: F.transform(n, lambda x, k: F.when(k == long_of(c), x + by * unit(c)).otherwise(x))
    begin = F.struct(F.array_repeat(F.lit(0).cast("long"), -(-128 // _PER_LONG)).alias("n"), F.lit(0.0).alias("s"), F.lit(1e9).cast("double").alias("least"))

    def peak(codes: Column) -> Column:
        def slide(acc: Column, i: Column) -> Column:
            return _bound(F.struct(acc["n"].alias("n"), acc["s"].alias("s"), acc["least"].alias("least"), F.get(codes, i).alias("new"), F.get(codes, i - window).alias("gone"), i.alias("i")), moved)

        def moved(x: Column) -> Column:
            left = F.when(x["gone"].isNull(), F.struct(x["n"].alias("n"), x["s"].alias("s"))).otherwise(_bound(count(x["n"], x["gone"]), lambda c: F.struct(bump(x["n"], x["gone"], -1).alias("n"), (x["s"] - _weight(c) + _weight(c - 1)).alias("s"))))
            entered = _bound(left, lambda y: _bound(count(y["n"], x["new"]), lambda c: F.struct(bump(y["n"], x["new"], 1).alias("n"), (y["s"] - _weight(c) + _weight(c + 1)).alias("s"))))
            return _bound(entered, lambda y: F.struct(y["n"].alias("n"), y["s"].alias("s"), F.when(x["i"] >= window - 1, F.least(x["least"], y["s"])).otherwise(x["least"]).alias("least")))

        least = F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), begin, slide, lambda acc: acc["least"])
        # The entropy is log2(window) - s / window, s the sum of c log2 c over the counts: largest where s is least.
        return F.when(F.size(codes) >= window, F.log2(F.lit(float(window))) - least / window).otherwise(0.0)

    return _bound(F.transform(F.split(value, ""), F.ascii), peak)


def _meets(x: Column, spans: Column) -> Column:
    """Whether span x overlaps one of the sorted spans, none of which overlap: binary search for the last that begins before x ends."""
    begin = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        return F.when(acc["low"] >= acc["high"], acc).when(F.get(spans, mid)["start"] < x["end"], F.struct((mid + 1).alias("low"), acc["high"].alias("high"))).otherwise(F.struct(acc["low"].alias("low"), mid.alias("high")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 2.0)).cast("int"))
    before = F.aggregate(steps, begin, halve, lambda acc: acc["low"])
    return F.coalesce(F.get(spans, before - 1)["end"] > x["start"], F.lit(False))


def _suspicious(value: Column) -> Column:
    """Whether a candidate's entropy reaches its class's threshold and no allow-list pattern matches it."""
    mixed = value.rlike("[A-Za-z]") & value.rlike("[0-9]")
    for pattern in ALLOWED:
        mixed = mixed & ~value.rlike(pattern)
    least = F.when(value.rlike("^[0-9a-fA-F]+$"), THRESHOLDS["hex"]).otherwise(THRESHOLDS["base64"])
    return F.when(mixed, peak_entropy(value) >= least).otherwise(False)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with base_spans and secret_spans: arrays of (start, rank, end, kind, value) by start, then kind."""
    text, low, base, spans = (free_name(docs, c) for c in ("__text", "__low", "base_spans", "secret_spans"))
    a, b, c, e = (free_name(docs, x) for x in ("__assign", "__access", "__hex", "__entropy"))
    none = F.array().cast(_NO_SPANS)
    whole = F.col(text_col).cast("string")
    # What no pattern can match is left out before the costly part; each test accepts all that its pattern does.
    lower = F.lower(whole)
    named = F.contains(lower, F.lit("passw")) | F.contains(lower, F.lit("secret")) | F.contains(lower, F.lit("token")) | F.contains(lower, F.lit("api"))
    out = docs.withColumn(low, F.struct(F.when(named, whole).alias("n"), F.when(F.contains(whole, F.lit("AKIA")), whole).alias("k"), F.when(whole.rlike(CANDIDATE), whole).alias("c")))
    out = out.withColumn(text, F.struct(F.col(f"{low}.n").alias("n"), F.col(f"{low}.k").alias("k"), F.when(F.col(f"{low}.c").rlike(_LONG_HEX), F.col(f"{low}.c")).alias("h"), F.col(f"{low}.c").alias("c")))
    out = out.withColumns(
        {
            a: located(F.col(f"{text}.n"), ASSIGN, "assign", 2, LEAST_ASSIGN),
            b: located(F.col(f"{text}.k"), ACCESS, "access", 0, LEAST_ACCESS),
            c: located(F.col(f"{text}.h"), _LONG_HEX, "hex"),
            e: F.filter(located(F.col(f"{text}.c"), CANDIDATE, "entropy"), lambda x: _suspicious(x["value"])),
        }
    )
    out = out.withColumn(base, F.array_sort(F.concat(*[F.coalesce(F.col(x), none) for x in (a, b, c)])))
    kinds = [F.coalesce(F.col(x), none) for x in (a, b, c)]
    free = F.filter(F.coalesce(F.col(e), none), lambda x: ~reduce(or_, [_bound(k, lambda spans: _meets(x, spans)) for k in kinds]))
    out = out.withColumn(spans, F.when(F.size(e) > 0, F.array_sort(F.concat(F.col(base), free))).otherwise(F.col(base)))
    return out.drop(low, text, a, b, c, e)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
