"""Personal data in texts: patterns, and a character BiLSTM-CRF for what patterns miss.

Base spans (e-mail, IP, card, phone) come from fixed rules. For the model the whole text is cut
into overlapping windows; each character's scores come from the window in which it is farthest from an edge, so that the
windows together score the text once, and the CRF decodes these scores as one sequence. The model's spans are added if they don't touch a
base span, are sure enough and are written like their kind: `name at firm dot org`, enough digits, four numbers. Every such spelling
holds a place that a pattern finds (`marks`); characters further from all such places than the windows around them reach
belong to no span, by definition, so windows there needn't be computed: the spans are those of reading all windows. The model is
trained in numpy on labelled spans that a seeded grammar writes (`examples`), with dates, versions, amounts, codes and the word
`at` as negative examples; no corpus text goes into it.

Defined cases: a null or empty text has no spans; equal rows have equal results; a long text is
read in as many windows as it needs; an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bilstm_crf
from .common import free_name, small_batches

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
#: Windows read on either side of those that decide the characters of a mark.
AROUND = 2
#: Least mean probability of a model span's characters.
SURE = 0.75
SEED = 11

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# How a span of the model must be written. Each spelling holds a match of one of the marks below.
_AT = r"(?:@|[(\[]at[)\]]|\bat\b)"
_DOT = r"(?:\.|\s\.\s|\s?[(\[]dot[)\]]\s?|\sdot\s)"
_HOST = rf"\s?[A-Za-z0-9-]++{_DOT}[A-Za-z]"
_EMAIL = re.compile(rf"[A-Za-z0-9._%+-]+\s?{_AT}\s?[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]+)+")
_WRITTEN = {"ip": re.compile(r"[0-9]+(?: ?\. ?[0-9]+){3}"), "card": re.compile(r"[0-9][0-9 -]*"), "phone": re.compile(r"[+(0-9][0-9 ().+/-]*")}
_MARKS = (re.compile(rf"{_AT}(?={_HOST})"), re.compile(r"(?<![0-9])[0-9]++(?: ?\. ?[0-9]++){3,}"), re.compile(r"[0-9](?:[ ().+/-]*[0-9]){8,}"))
#: For Spark: matches every text in which a base rule or a mark matches.
_MAY_HOLD = r"@|(?<![0-9A-Za-z_])at(?![0-9A-Za-z_])|[0-9] ?\. ?[0-9]++ ?\. ?[0-9]|[0-9](?:[ ().+/-]*+[0-9]){7}"


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @, domain; found from the @, so that long words cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# --- the model ---


def encode(text: str) -> np.ndarray:
    """Character classes: 1 white space, 2 other characters, then ASCII from '!'; all digits but their place are one class."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = np.where((codes > 32) & (codes < 127), codes - 30, 2)
    out[(codes == 32) | ((codes >= 9) & (codes <= 13))] = 1
    out[(codes >= 48) & (codes <= 57)] = 48 - 30
    lower = (codes >= 97) & (codes <= 122)
    out[lower] = 97 - 30
    out[(codes >= 65) & (codes <= 90)] = 65 - 30
    return out.astype(np.int64)


CHARS = 127 - 30


def examples(count: int, seed: int = SEED) -> tuple[list[str], list[list[tuple[str, int, int]]]]:
    """Labelled texts of the seeded grammar."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    digits = lambda n: "".join(str(int(d)) for d in rng.integers(0, 10, n))
    syllables = ("an", "er", "th", "ion", "re", "de", "le", "que", "sch", "ung", "ción", "os", "ñ", "é", "ä", "be", "ti", "or", "wh", "st")

    def word() -> str:
        w = "".join(pick(syllables) for _ in range(int(rng.integers(1, 5))))
        return w.capitalize() if rng.random() < 0.15 else w.upper() if rng.random() < 0.05 else w

    def name() -> str:
        return "".join(pick("abcdefghijklmnoprstuvw") for _ in range(int(rng.integers(2, 9))))

    def email() -> str:
        at = pick(("@", "@", "@", " @ ", " at ", " at ", " at ", "(at)", "[at]", " (at) ", " [at] "))
        dot = pick((" dot ", ".")) if "at" in at else "."
        return name() + pick(("", ".", "_", "-")) + pick(("", digits(2), name())) + at + name() + pick(("", digits(1))) + dot + pick(("com", "org", "net", "de", "example.com", "co.uk"))

    def ip() -> str:
        return ".".join(str(int(x)) for x in rng.integers(0, 256, 4))

    def card() -> str:
        s, n = pick(("", "", " ", "-")), pick((15, 16, 16, 16))
        d = digits(n)
        return s.join(d[i : i + 4] for i in range(0, n, 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return pick((f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{digits(2)} {a} {b}{c}", f"+{digits(2)}{a}{b}{c}", f"{a}.{b}.{c}", f"0{a} {b} {c}", f"00{digits(2)} {a} {b}{c}"))

    def benign() -> str:
        return pick(
            (
                f"{word()} at {word()}",
                f"at {digits(2)}:{digits(2)}",
                f"{pick(('19', '20'))}{digits(2)}",
                f"{digits(4)}-{digits(2)}-{digits(2)}",
                f"{digits(2)}.{digits(2)}.{digits(4)}",
                f"{digits(2)}:{digits(2)}",
                f"v{digits(1)}.{digits(1)}.{digits(2)}",
                f"{digits(1)}.{digits(2)}",
                f"${digits(2)},{digits(3)}.{digits(2)}",
                digits(int(rng.integers(1, 8))),
                f"#{digits(5)}",
                f"{digits(2)}%",
                "".join(pick("0123456789abcdef") for _ in range(int(rng.integers(20, 48)))),
                f"{name()}{digits(2)}",
                f"@{name()}",
                f"{digits(3)}-{digits(2)}",
                f"ISBN {digits(3)}-{digits(1)}-{digits(4)}",
                f"{digits(1)}.{digits(1)}.{digits(1)}",
                f"{digits(1)}. {word()}",
            )
        )

    make = {"email": email, "ip": ip, "card": card, "phone": phone}
    texts, spans = [], []
    for _ in range(count):
        text, marked = "", []
        if rng.random() < 0.15:  # a short text
            kind, before = pick(KINDS), " ".join(word() for _ in range(int(rng.integers(0, 3))))
            value = make[kind]()
            at = len(before) + bool(before)
            text = f"{before} {value}".lstrip() + pick(("", ".", f" {word()}"))
            texts.append(text[:WINDOW])
            spans.append([(kind, at, min(at + len(value), WINDOW))] if at < WINDOW else [])
            continue
        while len(text) < WINDOW:
            r = rng.random()
            if r < 0.16:
                kind = pick(KINDS)
                value = make[kind]()
                marked.append((kind, len(text), len(text) + len(value)))
                text += value
            elif r < 0.32:
                text += benign()
            else:
                text += word()
            text += pick((" ", " ", " ", ", ", ". ", "\n", "*** ", "### ", "!! ", '" '))
        cut = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
        texts.append(text[cut : cut + WINDOW])
        spans.append([(k, max(a - cut, 0), min(b - cut, WINDOW)) for k, a, b in marked if a < cut + WINDOW and b > cut])
    return texts, spans


def tagged(texts: list[str], spans: list[list[tuple[str, int, int]]]) -> tuple[np.ndarray, np.ndarray]:
    codes, tags = np.full((len(texts), WINDOW), 1), np.zeros((len(texts), WINDOW), np.int64)
    for i, (text, found) in enumerate(zip(texts, spans, strict=True)):
        codes[i, : len(text)] = encode(text)
        for kind, a, b in found:
            tags[i, a:b] = 1 + KINDS.index(kind)
    return codes, tags


@lru_cache(maxsize=1)
def model(count: int = 12000, epochs: int = 6) -> bilstm_crf.Params:
    return bilstm_crf.train(*tagged(*examples(count)), CHARS, 1 + len(KINDS), h=24, epochs=epochs)


def last_window(n: int) -> int:
    """Number of the last window of a text of n characters; window k begins at k * STRIDE."""
    return (max(1, n - STRIDE) - 1) // STRIDE


def decided(k: int, n: int) -> tuple[int, int]:
    """The characters that are farthest from an edge in window k; the text's own ends are no edges."""
    edge = (WINDOW - STRIDE) // 2
    return (k * STRIDE + edge if k else 0), (n if k == last_window(n) else (k + 1) * STRIDE + edge)


def marks(text: str) -> list[tuple[int, int]]:
    """Places without which no span of the model is written like its kind."""
    return [m.span() for pattern in _MARKS for m in pattern.finditer(text)]


def stretches(text: str) -> list[tuple[int, int]]:
    """Runs of windows (first, last) that are read: those that decide the characters of a mark, and AROUND on either side."""
    last, edge, out = last_window(len(text)), (WINDOW - STRIDE) // 2, []
    deciding = lambda i: min(last, max(0, (i - edge) // STRIDE))
    for a, b in sorted((max(0, deciding(a) - AROUND), min(last, deciding(b - 1) + AROUND)) for a, b in marks(text)):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def readings(p: bilstm_crf.Params, texts: list[str], needed: list[set[int]]) -> list[dict[int, np.ndarray]]:
    """For each text and needed window the scores (characters x tags) of the characters that the window decides."""
    todo = [(i, k) for i, some in enumerate(needed) for k in sorted(some)]
    out: list[dict[int, np.ndarray]] = [{} for _ in texts]
    for lo in range(0, len(todo), 1024):
        some = todo[lo : lo + 1024]
        block = np.ones((len(some), WINDOW), np.int64)
        for row, (i, k) in enumerate(some):
            part = encode(texts[i][k * STRIDE : k * STRIDE + WINDOW])
            block[row, : len(part)] = part
        em = bilstm_crf.emissions(p, block)
        for row, (i, k) in enumerate(some):
            a, b = decided(k, len(texts[i]))
            out[i][k] = em[row, a - k * STRIDE : b - k * STRIDE]
    return out


def decode(p: bilstm_crf.Params, runs: list[np.ndarray], cells: int = 1 << 17) -> list[tuple[np.ndarray, np.ndarray]]:
    """Best tags of each run of scores, no span crossing its ends, and their probabilities (of runs without a span: 1)."""
    out: list = [None] * len(runs)
    order, lo = sorted(range(len(runs)), key=lambda i: len(runs[i])), 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * len(runs[order[hi]]) <= cells:
            hi += 1
        some, lo = order[lo:hi], hi
        # Before, behind and beside the run all characters are without a span.
        em = np.full((len(some), len(runs[some[-1]]) + 2, len(p.trans)), -1e6, np.float32)
        em[:, :, 0] = 0
        for row, i in enumerate(some):
            em[row, 1 : len(runs[i]) + 1] = runs[i]
        best = bilstm_crf.viterbi(em, p.trans)
        told = np.flatnonzero(best.any(axis=1))
        sure = dict(zip(told.tolist(), bilstm_crf.marginals(em[told], p.trans)[1], strict=True)) if len(told) else {}
        for row, i in enumerate(some):
            tags = best[row, 1 : len(runs[i]) + 1]
            out[i] = tags, sure[row][np.arange(1, len(tags) + 1), tags] if row in sure else np.ones(len(tags))
    return out


def written(kind: str, value: str) -> tuple[int, int] | None:
    """The part of a span of the model that is written like its kind."""
    if kind == "email":
        found = _EMAIL.search(value)
        return found.span() if found else None
    x, y = len(value) - len(value.lstrip(" .,;:\n\t")), len(value.rstrip(" .,;:\n\t\"'*#!"))
    digits, (least, most) = sum(c.isdigit() for c in value), {"ip": (4, 12), "card": (15, 19), "phone": (9, 15)}[kind]
    return (x, y) if least <= digits <= most and _WRITTEN[kind].fullmatch(value, x, y) else None


def model_spans(p: bilstm_crf.Params, texts: list[str], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """Spans that the model adds to each text."""
    runs = [stretches(t) for t in texts]
    read = readings(p, texts, [{k for a, b in some for k in range(a, b + 1)} for some in runs])
    flat = [(i, decided(a, len(texts[i]))[0], np.concatenate([read[i][k] for k in range(a, b + 1)])) for i, some in enumerate(runs) for a, b in some]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    taken = {}
    for (i, a, _), (tags, sure) in zip(flat, decode(p, [em for _, _, em in flat]), strict=True):
        change = np.flatnonzero(np.diff(tags, prepend=-1))
        for x, y in zip(change.tolist(), [*change[1:].tolist(), len(tags)], strict=True):
            kind = KINDS[tags[x] - 1]
            part = written(kind, texts[i][a + x : a + y]) if tags[x] else None
            if part is None:
                continue
            x, y = x + part[0], x + part[1]
            if float(sure[x:y].mean()) < SURE:
                continue
            if i not in taken:  # sorted starts and the farthest end so far
                s = sorted((a, b) for _, a, b in base[i])
                taken[i] = [a for a, _ in s], np.maximum.accumulate([b for _, b in s] or [0]).tolist()
            starts, ends = taken[i]
            before = bisect_left(starts, a + y)
            if before == 0 or ends[before - 1] <= a + x:
                out[i].append((kind, a + x, a + y))
    return out


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with base_spans and pii_spans: arrays of (kind, start, end), by kind, then start."""
    small_batches(docs.sparkSession)
    p, spans, base, every = model(), free_name(docs, "__spans"), free_name(docs, "base_spans"), free_name(docs, "pii_spans")
    kind = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"base {kind}, every {kind}")
    def spot(texts: pd.Series) -> pd.DataFrame:
        told = [i for i, t in enumerate(texts) if t]
        some = [texts.iloc[i] for i in told]
        first = [base_spans(t) for t in some]
        added = model_spans(p, some, first)
        order = lambda s: (KINDS.index(s[0]), s[1])
        out_b, out_e = [[] for _ in range(len(texts))], [[] for _ in range(len(texts))]
        for i, f, m in zip(told, first, added, strict=True):
            out_b[i] = [dict(zip(("kind", "start", "end"), s, strict=True)) for s in sorted(f, key=order)]
            out_e[i] = [dict(zip(("kind", "start", "end"), s, strict=True)) for s in sorted(f + m, key=order)]
        return pd.DataFrame({"base": out_b, "every": out_e})

    text = F.col(text_col).cast("string")
    # A text in which no base rule and no mark can match has no spans; it needn't travel to Python.
    out = docs.withColumn(spans, spot(F.when(text.rlike(_MAY_HOLD), text)))
    return out.withColumns({base: F.col(f"{spans}.base"), every: F.col(f"{spans}.every")}).drop(spans)
