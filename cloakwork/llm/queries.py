"""The queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, html_text, line_dedup, mixing, near_dedup, pii, quality, secrets, sharding, simhash
from .common import materialize, table
from .secrets import joined


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the id of its class of near copies, for every document."""
    classes = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "class_id")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document: its size, its source's size and target, and the words the mix takes of it."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document: the shard and the slot that the shuffle gives it, from the shuffled records."""
    records = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return records.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    read = html_text.extract(table(spark, sf_dir, "pages"))
    return read.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, and all spans."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, counts = F.col("base_spans"), {f"n_{kind}": secrets.count_of(F.col("base_spans"), kind) for kind in secrets.KINDS[:3]}
    return found.select("doc_id", *[v.alias(k) for k, v in counts.items()], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without its host's boilerplate lines."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", line_dedup.html_lines(F.col("html")).alias("text"))
    pages = materialize(pages, "lines")  # read twice: to count, and to drop
    return line_dedup.drop_site_lines(pages, line_dedup.host_of(F.col("url"))).select("page_id", "url", "text", "n_lines", "n_dropped")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text; for ids divisible by 100 also how many others lie within the radius."""
    prints = simhash.with_neighbours(simhash.fingerprint_documents(table(spark, sf_dir, "documents")))
    return prints.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near")


def _is(kind: str):
    return lambda x: x["kind"] == kind


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base kinds, and all spans."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base_spans")
    counts = [F.size(F.filter(base, _is(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii_spans")).alias("spans"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the item and what was found of it."""
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "windows", "longest")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier selects: doc_id, expected grade and P(highest grade)."""
    kept = quality.select(table(spark, sf_dir, "documents"), quality.graded(table(spark, sf_dir, "labels")))
    return kept.select("doc_id", "expected_grade", "tail_probability")


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_mix": op2_mix,
    "op3_sharding": op3_sharding,
    "op4_html": op4_html,
    "op5_secrets": op5_secrets,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash": op7_simhash,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_decontamination": op10_decontamination,
}


def _spans_sql(kind: str, rank: int, pattern: str, keep: str) -> str:
    """Matches of a pattern with their places: the pieces between the matches and the matches before add up."""
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, m[i] AS value, g[i] AS inner_value,
CAST(list_sum(list_transform(b[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS start
FROM (SELECT doc_id, m, b, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS b, regexp_extract_all(text, '{p}', {2 if kind == "assign" else 0}) AS g FROM d)) WHERE {keep}"""


_ALLOWED_SQL = " OR ".join(f"regexp_matches(value, '{p}')" for p in (secrets.ALLOWED[0], secrets.ALLOWED[2])) + " OR list_bool_or(list_transform(range(1, len(value) - 4), lambda i: len(list_distinct(string_split(value[i:i + 5], ''))) = 1))"
_PEAK_SQL = f"list_max(list_transform(range(1, len(value) - {secrets.WINDOW - 2}), lambda i: list_aggregate(string_split(value[i:i + {secrets.WINDOW - 1}], ''), 'entropy')))"
_JOINED = "string_agg(kind || ':' || start || ':' || start + len(value), ',' ORDER BY start, rank)"

_OP5_SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS ({_spans_sql("assign", 0, secrets.ASSIGN, f"len(g[i]) >= {secrets.LEAST_ASSIGN}")} UNION ALL {_spans_sql("access", 1, secrets.ACCESS, f"len(m[i]) >= {secrets.LEAST_ACCESS}")} UNION ALL {_spans_sql("hex", 2, secrets.HEX, f"len(m[i]) >= {secrets.LEAST_HEX}")}),
candidate AS ({_spans_sql("entropy", 3, secrets.CANDIDATE, "true")}),
added AS (SELECT * FROM candidate WHERE regexp_matches(value, '[A-Za-z]') AND regexp_matches(value, '[0-9]') AND NOT ({_ALLOWED_SQL})
 AND {_PEAK_SQL} >= CASE WHEN regexp_matches(value, '^[0-9a-fA-F]+$') THEN {secrets.THRESHOLDS["hex"]} ELSE {secrets.THRESHOLDS["base64"]} END
 AND NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = candidate.doc_id AND base.start < candidate.start + len(candidate.value) AND candidate.start < base.start + len(base.value))),
told AS (SELECT doc_id, {_JOINED} AS spans, count(*) FILTER (WHERE rank = 0) AS a, count(*) FILTER (WHERE rank = 1) AS b, count(*) FILTER (WHERE rank = 2) AS c FROM base GROUP BY doc_id),
every AS (SELECT doc_id, {_JOINED} AS spans FROM (FROM base UNION ALL FROM added) GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(told.spans, '')) AS base_sha256, coalesce(every.spans, '') AS spans
FROM d LEFT JOIN told ON told.doc_id = d.doc_id LEFT JOIN every ON every.doc_id = d.doc_id"""

_OP1_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents WHERE text IS NOT NULL),
t AS (SELECT text, min(doc_id) AS id, any_value(ws) AS ws FROM w GROUP BY text),
g AS (SELECT id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM t),
c AS (SELECT id, s, count(*) AS n FROM g GROUP BY ALL),
z AS (SELECT id, sum(n) AS n FROM c GROUP BY id),
p AS (SELECT a.id AS a, b.id AS b, sum(least(a.n, b.n)) AS m FROM c a JOIN c b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN z za ON za.id = a JOIN z zb ON zb.id = b WHERE m >= 0.8 * (za.n + zb.n - m)),
x AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(id, root) AS (SELECT id, id FROM t UNION SELECT x.b, r.root FROM r JOIN x ON r.id = x.a),
k AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT d.doc_id, coalesce(k.root, d.doc_id) AS class_id FROM documents d LEFT JOIN t ON t.text = d.text LEFT JOIN k ON k.id = t.id"""

_HIDDEN_SQL = "|".join(f"{t}\\b.*?</{t}\\s*>" for t in line_dedup.HIDDEN.split("|"))
_OP6_SQL = f"""WITH a AS (SELECT page_id, url, coalesce(nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), ''), '') AS host,
 regexp_replace(regexp_replace(translate(html, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), '<(?:!--.*?-->|{_HIDDEN_SQL}|/?(?:{line_dedup.BLOCKS})(?:[\\s/][^>]*)?>)', chr(10), 'gis'), '<[^>]*>', '', 'g') AS t FROM pages),
b AS (SELECT page_id, url, host, trim(regexp_replace(regexp_replace(t, ' {{2,}}', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10)) AS t FROM a),
c AS (SELECT page_id, url, host, string_split(t, chr(10)) AS ls FROM b),
n AS (SELECT host, count(*) AS pages FROM c GROUP BY host),
f AS (SELECT host, l, count(*) AS n FROM (SELECT DISTINCT page_id, host, trim(l) AS l FROM (SELECT page_id, host, unnest(ls) AS l FROM c)) WHERE l <> '' GROUP BY ALL),
bad AS (SELECT f.host, list(l) AS bad FROM f JOIN n ON n.host = f.host WHERE n.pages >= {line_dedup.LEAST_PAGES} AND f.n > {line_dedup.RATIO} * n.pages AND f.n >= {line_dedup.LEAST_HITS} GROUP BY f.host),
k AS (SELECT page_id, url, ls, list_filter(ls, lambda x: bad IS NULL OR NOT list_contains(bad, trim(x))) AS kept FROM c LEFT JOIN bad ON bad.host = c.host)
SELECT page_id, url, array_to_string(kept, chr(10)) AS text, len(ls) AS n_lines, len(ls) - len(kept) AS n_dropped FROM k"""

# Template words are a list here; a placeholder begins with its mark. Marks of decimals and names are put in twice, as matches may not share a character.
_D = decontamination
_TEMPLATE_SQL = "lower(T2)"
for _name, _pattern, _new in (("T2", "([\\p{Ll}\\p{Nd},;] )(\\p{Lu}[\\p{L}\\p{M}]+)", "'\\1' || chr(3) || '\\2'"), ("T1", "(\\p{Nd})[.,](\\p{Nd})", "'\\1' || chr(4) || '\\2'")):
    _inner = "T1" if _name == "T2" else "regexp_replace(text, '[\\x02-\\x05]', ' ', 'g')"
    _TEMPLATE_SQL = _TEMPLATE_SQL.replace(_name, f"regexp_replace(regexp_replace({_inner}, '{_pattern}', {_new}, 'g'), '{_pattern}', {_new}, 'g')")
_WORDS_SQL = f"string_split(trim(regexp_replace(regexp_replace({_TEMPLATE_SQL}, '([\\p{{Nd}}\\x04]+)', ' ' || chr(2) || '\\1 ', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\x02-\\x05]+', ' ', 'g')), ' ')"
_UNITS_SQL = ", ".join(f"'{u}'" for u in _D.UNITS)


def _runs_sql(ids: str, table: str) -> str:
    """Runs of template words of a table: ids, place, words, whether joined by template, key."""
    return f"""SELECT {ids}, place, w, literal, array_to_string(CASE WHEN literal THEN list_transform(w, lambda x: CASE WHEN x[1] IN (chr(2), chr(3), chr(5)) THEN x[1] ELSE x END) ELSE w END, ' ') AS key
FROM (SELECT *, len(list_filter(w, lambda x: x[1] IN (chr(2), chr(3), chr(5)))) <= {_D.WINDOW - min(_D.LITERALS, _D.WINDOW)} AS literal FROM (SELECT {ids}, place, ws[place:place + {_D.WINDOW - 1}] AS w FROM (SELECT {ids}, ws, unnest(range(1, len(ws) - {_D.WINDOW - 2})) AS place FROM
 (SELECT {ids}, list_transform(ws, lambda x, i: CASE WHEN i > 1 AND ws[i - 1][1] = chr(2) AND x IN ({_UNITS_SQL}) THEN chr(5) || x ELSE x END) AS ws FROM (SELECT DISTINCT {ids}, {_WORDS_SQL} AS ws FROM {table} WHERE text IS NOT NULL)))))"""


_OP10_SQL = f"""WITH b AS ({_runs_sql("item_id", "benchmark")}), n AS (SELECT item_id, count(DISTINCT key) AS windows, count(DISTINCT key) FILTER (WHERE literal) AS literal_windows FROM b GROUP BY ALL),
d AS (SELECT * FROM ({_runs_sql("doc_id, text", "documents")}) WHERE key IN (SELECT key FROM b)),
hit AS (SELECT doc_id, text, item_id, d.place - b.place AS diagonal, b.place AS q, d.key, d.literal, CASE WHEN d.literal THEN list_distinct(list_filter(list_zip(b.w, d.w), lambda z: z[1][1] IN (chr(2), chr(3), chr(5)))) ELSE [] END AS pairs FROM d JOIN b USING (key)),
v AS (SELECT doc_id, text, item_id, diagonal, q, unnest(pairs) AS pair FROM hit),
holds AS (SELECT doc_id, text, item_id, diagonal, pair, count(*) AS holds FROM v GROUP BY ALL),
every AS (SELECT doc_id AS ed, text AS et, item_id AS ei, diagonal AS eg, pair[1] AS x, count(DISTINCT q) AS every FROM v GROUP BY ALL),
line AS (SELECT doc_id, text, item_id, diagonal, count(*) = count(DISTINCT pair[1]) AS consistent FROM holds GROUP BY ALL),
judged AS (SELECT holds.*, consistent, 2 * holds > every AS most FROM holds JOIN every ON doc_id = ed AND text = et AND item_id = ei AND diagonal = eg AND pair[1] = x JOIN line USING (doc_id, text, item_id, diagonal)),
usual AS (SELECT doc_id, text, item_id, diagonal, pair, consistent OR most OR (pair[1] = pair[2] AND NOT coalesce(bool_or(most) OVER (PARTITION BY doc_id, text, item_id, diagonal, pair[1]), false)) AS usual FROM judged),
bad AS (SELECT doc_id, text, item_id, diagonal, q, bool_and(pair[1] = pair[2]) AS own FROM v GROUP BY ALL HAVING NOT bool_and((doc_id, text, item_id, diagonal, pair) IN (SELECT (doc_id, text, item_id, diagonal, pair) FROM usual WHERE usual))),
held AS (SELECT * FROM hit ANTI JOIN (SELECT * FROM bad WHERE NOT own) x USING (doc_id, text, item_id, diagonal, q)),
row_of AS (SELECT doc_id, text, item_id, diagonal, q - row_number() OVER (PARTITION BY doc_id, text, item_id, diagonal ORDER BY q) AS island FROM held),
longest AS (SELECT doc_id, text, item_id, max(n) AS longest FROM (SELECT doc_id, text, item_id, diagonal, island, count(*) AS n FROM row_of GROUP BY ALL) GROUP BY ALL),
found AS (SELECT doc_id, text, item_id, count(DISTINCT key) AS matched, count(DISTINCT key) FILTER (WHERE literal) AS literal FROM held GROUP BY ALL)
SELECT doc_id, item_id, matched, windows, longest FROM found JOIN n USING (item_id) JOIN longest USING (doc_id, text, item_id)
WHERE matched >= {_D.CONTAINMENT} * windows OR (literal > 0 AND literal >= {_D.CONTAINMENT} * literal_windows) OR longest >= {_D.PASSAGE - _D.WINDOW + 1}"""

ORACLES: dict[str, str] = {"op1_near_dedup": _OP1_SQL, "op5_secrets": _OP5_SQL, "op6_line_dedup": _OP6_SQL, "op10_decontamination": _OP10_SQL}
