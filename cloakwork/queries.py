"""Queries over the TPC-H-like tables that show each operator, and the SQL each must agree with.

They use a public test key. The tables hold no nulls and no broken keys where it matters, so defects are
put in by expressions of the key columns, the same in both dialects.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import replace
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import GenerationError
from .functions.numbering import checkpointed, scratch_dir
from .functions.scalars import FAMILY, GIVEN, ascii_normalized, batched_sequence, is_digest, key_fingerprint, keyed, normalized, short_digest, synthetic
from .operators import generate as G
from .operators import registry as R
from .operators import verify as V
from .operators.keys import arrow_digester, collection_stats, distinct_keys, keyed_values
from .operators.transform import mask_table, missing_mappings
from .plans.catalog import Catalog, ForeignKey, KeyConstraint, foreign_key_pairs, foreign_key_signatures, foreign_keys_frame, keys_frame
from .plans.policy import ColumnRef, Generation, Group, Policy
from .plans.report import benchmark, escape_cell
from .plans.settings import redact
from .plans.stages import Interrupted, before_after, run_masking
from .sources.embedded import embedded_database
from .sources.jdbc_catalog import DRIVERS, jdbc_catalog
from .sources.tables import jdbc_table, parquet_catalog, read_jsonl, write_jsonl

TEST_KEY = b"cloakwork public test key, 32 B."
PEOPLE, BATCH = "people", 25
_DIGESTER = arrow_digester(TEST_KEY)


def _policy(*columns: str) -> Policy:
    refs = tuple(ColumnRef.parse(f"public.{c}") for c in columns)
    group = Group("person_name", "en", "human_text", Generation("names", 1, 100), refs)
    return Policy({PEOPLE: group}, True, _of=dict.fromkeys(refs, PEOPLE))


POLICY = _policy("customer.c_name", "supplier.s_name")


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _variants(name: str, key: str) -> Column:
    """Some names in capitals, some with spaces around, some null."""
    k, n = F.col(key), F.col(name)
    return F.when(k % 53 == 0, None).when(k % 7 == 1, F.upper(n)).when(k % 7 == 2, F.concat(F.lit("  "), n, F.lit("\t"))).otherwise(n)


def _customer(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "customer").withColumn("c_name", _variants("c_name", "c_custkey"))


def _supplier(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "supplier").withColumn("s_name", _variants("s_name", "s_suppkey"))


def _people(spark: SparkSession, d: str) -> Catalog:
    return Catalog(d, {"public.customer": _customer(spark, d), "public.supplier": _supplier(spark, d)}, (KeyConstraint("PRIMARY KEY", "public.customer", ("c_custkey",)), KeyConstraint("PRIMARY KEY", "public.supplier", ("s_suppkey",))))


def _keys(spark: SparkSession, d: str) -> DataFrame:
    return distinct_keys(keyed_values(_people(spark, d), POLICY, _DIGESTER))


def _mappings(spark: SparkSession, d: str) -> DataFrame:
    rank = R.ranked(_keys(spark, d))
    new = synthetic("person_name", batched_sequence(F.col("rank"), BATCH))
    norm = _DIGESTER(PEOPLE, "human_text", False, False)
    return rank.select("group_id", "source_hmac", new.alias("replacement")).withColumn("replacement_hmac", norm(F.col("replacement"))["digest"])


def _masked(spark: SparkSession, d: str) -> DataFrame:
    return mask_table(_customer(spark, d), {"c_name": PEOPLE}, _mappings(spark, d), POLICY, _DIGESTER, "customer")


def _norm():
    return _DIGESTER(PEOPLE, "human_text", False, False)


# --- the other dialect's building blocks ---


def _hex(x: int) -> str:
    return bytes(b ^ x for b in TEST_KEY.ljust(64, b"\0")).hex()


def _hmac(value: str, group: str = PEOPLE) -> str:
    return f"sha256(unhex('{_hex(0x5C)}') || unhex(sha256(unhex('{_hex(0x36)}') || encode('{group}') || unhex('00') || encode({value}))))"


def _norm_sql(value: str) -> str:
    return f"lower(regexp_replace(regexp_replace({value}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g'))"


def _variants_sql(name: str, key: str) -> str:
    return f"CASE WHEN {key} % 53 = 0 THEN NULL WHEN {key} % 7 = 1 THEN upper({name}) WHEN {key} % 7 = 2 THEN '  ' || {name} || chr(9) ELSE {name} END"


def _name_sql(n: str) -> str:
    pick = lambda names, at: f"list_extract([{', '.join(repr(x) for x in names)}], CAST({at} AS INT))"
    letters = f"CASE WHEN {n} <= 26 THEN chr(CAST(64 + {n} AS INT)) WHEN {n} <= 702 THEN chr(CAST(65 + ({n} - 27) // 26 AS INT)) || chr(CAST(65 + ({n} - 27) % 26 AS INT)) ELSE chr(CAST(65 + ({n} - 703) // 676 AS INT)) || chr(CAST(65 + (({n} - 703) // 26) % 26 AS INT)) || chr(CAST(65 + ({n} - 703) % 26 AS INT)) END"
    return f"{pick(GIVEN, f'({n} - 1) % {len(GIVEN)} + 1')} || ' ' || {pick(FAMILY, f'(({n} - 1) // {len(GIVEN)}) % {len(FAMILY)} + 1')} || ' ' || {letters}"


_ASKED = min(1000, 2 * BATCH, BATCH + max(2, (BATCH + 3) // 4))
_CTE = f"""
c AS (SELECT * REPLACE ({_variants_sql("c_name", "c_custkey")} AS c_name) FROM customer),
s AS (SELECT * REPLACE ({_variants_sql("s_name", "s_suppkey")} AS s_name) FROM supplier),
v AS (SELECT c_name AS v FROM c WHERE c_name IS NOT NULL UNION ALL SELECT s_name FROM s WHERE s_name IS NOT NULL),
k AS (SELECT DISTINCT {_hmac(_norm_sql("v"))} AS h FROM v),
r AS (SELECT h, row_number() OVER (ORDER BY h) AS rank FROM k),
q AS (SELECT h, rank, ((rank - 1) // {BATCH}) * {_ASKED} + (rank - 1) % {BATCH} + 1 AS n FROM r),
m AS (SELECT h, rank, n, {_name_sql("n")} AS replacement FROM q),
ck AS (SELECT c.*, {_hmac(_norm_sql("c_name"))} AS h FROM c),
masked AS (SELECT ck.* EXCLUDE (h) REPLACE (CASE WHEN c_name IS NULL THEN NULL ELSE m.replacement END AS c_name) FROM ck LEFT JOIN m USING (h))
"""


def _with(sql: str) -> str:
    return f"WITH {_CTE} {sql}"


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


_RELATIONAL = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@_query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _RELATIONAL))
def table_row_counts(spark, d):
    return V.row_counts({t: _t(spark, d, t) for t in _RELATIONAL})


@_query(
    _with("""SELECT 'c_name' AS column_name, count(*) FILTER (WHERE c_name IS NULL) AS null_count, count(DISTINCT c_name) AS distinct_count FROM c
UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL), count(DISTINCT c_mktsegment) FROM c""")
)
def column_statistics(spark, d):
    return V.column_statistics(_customer(spark, d), ["c_name", "c_mktsegment"])


@_query(_with("SELECT 'people' AS group_id, h AS source_hmac FROM k"))
def collect_keys_person(spark, d):
    return _keys(spark, d)


@_query(_with("SELECT 'people' AS group_id, (SELECT count(DISTINCT v) FROM v) AS distinct_values_seen, (SELECT count(*) FROM k) AS distinct_keys, 0 AS invalid_values"))
def collect_key_stats(spark, d):
    return collection_stats(keyed_values(_people(spark, d), POLICY, _DIGESTER))


@_query(_with(f"SELECT c_custkey, {_norm_sql('c_name')} AS n FROM c"))
def normalize_human_text(spark, d):
    return _customer(spark, d).select("c_custkey", normalized("human_text")("c_name").alias("n"))


_EMAIL, _PHONE = "' User' || CAST(c_custkey AS VARCHAR) || '@Source.TEST '", "'+7 (' || CAST(100 + c_custkey % 900 AS VARCHAR) || ') ' || CAST(c_custkey AS VARCHAR) || '-00 '"


@_query(f"SELECT c_custkey, lower(trim({_EMAIL})) AS n FROM customer")
def normalize_email(spark, d):
    value = F.concat(F.lit(" User"), F.col("c_custkey").cast("string"), F.lit("@Source.TEST "))
    return _t(spark, d, "customer").select("c_custkey", normalized("email")(value).alias("n"))


@_query(f"SELECT c_custkey, regexp_replace({_PHONE}, '[^0-9]', '', 'g') AS n FROM customer")
def normalize_phone(spark, d):
    value = F.concat(F.lit("+7 ("), (F.lit(100) + F.col("c_custkey") % 900).cast("string"), F.lit(") "), F.col("c_custkey").cast("string"), F.lit("-00 "))
    return _t(spark, d, "customer").select("c_custkey", normalized("phone")(value).alias("n"))


@_query(_with(f"SELECT c_custkey, {_norm_sql('c_name')} AS n FROM c"))
def normalize_builtin_ascii(spark, d):
    return _customer(spark, d).select("c_custkey", ascii_normalized(F.col("c_name"), "human_text").alias("n"))


@_query(_with("SELECT h AS source_hmac FROM m WHERE rank % 3 = 0 ORDER BY h LIMIT 20"))
def pending_keys_topk(spark, d):
    rank = R.ranked(_keys(spark, d))
    some = rank.withColumn("replacement", F.when(F.col("rank") % 3 != 0, "assigned"))
    return R.pending(some, PEOPLE, 20)


@_query(_with("SELECT 'people' AS group_id, h AS source_hmac, replacement FROM m"))
def assign_replacements(spark, d):
    return _mappings(spark, d).drop("replacement_hmac")


@_query(_with("SELECT count(*) AS mappings, count(CASE WHEN rank % 4 > 0 THEN 1 END) AS assigned, 'people' AS group_id FROM m"))
def registry_counts(spark, d):
    return R.mapping_counts(R.ranked(_keys(spark, d)).withColumn("replacement", F.when(F.col("rank") % 4 > 0, "x")))


@_query(_with("SELECT 'people' AS group_id, h AS source_hmac FROM k WHERE h NOT IN (SELECT h FROM m WHERE rank % 5 > 0)"))
def registry_new_keys(spark, d):
    known = R.ranked(_keys(spark, d)).where("rank % 5 > 0")
    return R.new_keys(_keys(spark, d).union(_keys(spark, d)), known)


@_query(_with("SELECT 'people' AS group_id, CASE WHEN rank % 7 = 0 THEN 'twice' ELSE replacement END AS replacement, count(*) AS count FROM m GROUP BY ALL HAVING count(*) > 1"))
def registry_duplicate_replacements(spark, d):
    rank = R.ranked(_keys(spark, d))
    new = F.when(F.col("rank") % 7 == 0, "twice").otherwise(synthetic("person_name", batched_sequence(F.col("rank"), BATCH)))
    return R.duplicate_replacements(rank.select("group_id", new.alias("replacement")))


@_query(_with("SELECT source_hmac FROM (SELECT h AS source_hmac, CASE WHEN rank % 11 = 0 THEN lead(h) OVER (ORDER BY h) END AS rh FROM m) WHERE rh IN (SELECT h FROM k)"))
def registry_source_collisions(spark, d):
    rank = R.ranked(_keys(spark, d))
    following = rank.select((F.col("rank") - 1).alias("rank"), F.col("source_hmac").alias("next"))
    tampered = rank.join(following, "rank", "left").withColumn("replacement_hmac", F.when(F.col("rank") % 11 == 0, F.col("next")))
    return R.source_collisions(tampered).select("source_hmac")


@_query(_with("SELECT * FROM masked"))
def mask_customer(spark, d):
    return _masked(spark, d)


@_query(_with("SELECT o_orderkey, masked.c_name AS billing_name FROM orders LEFT JOIN masked ON o_custkey = c_custkey"))
def mask_orders_denorm(spark, d):
    named = _t(spark, d, "orders").join(_customer(spark, d), F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", F.col("c_name").alias("billing_name"))
    return mask_table(named, {"billing_name": PEOPLE}, _mappings(spark, d), POLICY, _DIGESTER, "orders")


@_query(_with("SELECT 'people' AS group_id, h AS source_hmac FROM m WHERE rank % 97 = 0"))
def missing_mapping_preflight(spark, d):
    rank = R.ranked(_keys(spark, d))
    have = rank.where("rank % 97 > 0").withColumn("replacement", F.lit("x"))
    return missing_mappings(_keys(spark, d), have)


@_query("SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_key_groups(spark, d):
    return V.duplicate_key_groups(_t(spark, d, "lineitem"), ("l_orderkey", "l_linenumber"))


@_query("SELECT count(*) AS rows FROM orders WHERE o_orderkey % 53 = 0")
def primary_key_nulls(spark, d):
    broken = _t(spark, d, "orders").withColumn("o_orderkey", F.when(F.col("o_orderkey") % 53 != 0, F.col("o_orderkey")))
    return V.key_null_rows(broken, ("o_orderkey",)).agg(F.count(F.lit(1)).alias("rows"))


@_query("""WITH a AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) AS p FROM customer),
b AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) AS p FROM customer WHERE c_custkey > 5)
SELECT count(*) AS rows_compared, count(*) FILTER (WHERE a.k IS DISTINCT FROM b.k) AS mismatches FROM a FULL JOIN b USING (p)""")
def pk_positional_mismatch(spark, d):
    c = _t(spark, d, "customer")
    return V.positional_mismatches(c, c.where("c_custkey > 5"), ("c_custkey",))


@_query("SELECT event_id, user_id FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 > 0)")
def fk_orphans_simple(spark, d):
    parent = _t(spark, d, "customer").where("c_custkey % 10 > 0")
    return V.orphan_rows(_t(spark, d, "events").select("event_id", "user_id"), ("user_id",), parent, ("c_custkey",))


_PARTIAL = "CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE l_partkey END AS p, CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_suppkey END AS s"
_PAIRS = "SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem WHERE l_partkey % 4 > 0"


def _partial(spark, d) -> tuple[DataFrame, DataFrame]:
    line = _t(spark, d, "lineitem")
    child = line.select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 6 != 0, F.col("l_partkey")).alias("p"), F.when(F.col("l_orderkey") % 10 != 0, F.col("l_suppkey")).alias("s"))
    return child, line.where("l_partkey % 4 > 0").select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s")).distinct()


@_query(f"WITH x AS (SELECT l_orderkey, l_linenumber, {_PARTIAL} FROM lineitem), y AS ({_PAIRS}) SELECT * FROM x WHERE p IS NOT NULL AND s IS NOT NULL AND NOT EXISTS (SELECT 1 FROM y WHERE y.p = x.p AND y.s = x.s)")
def fk_orphans_match_simple_composite(spark, d):
    child, parent = _partial(spark, d)
    return V.orphan_rows(child, ("p", "s"), parent, ("p", "s"))


@_query(f"WITH x AS (SELECT l_orderkey, l_linenumber, {_PARTIAL} FROM lineitem), y AS ({_PAIRS}) SELECT * FROM x WHERE (p IS NOT NULL OR s IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM y WHERE y.p = x.p AND y.s = x.s)")
def fk_orphans_match_full(spark, d):
    child, parent = _partial(spark, d)
    return V.orphan_rows(child, ("p", "s"), parent, ("p", "s"), "FULL")


_FKS = (
    ForeignKey("fk_o", "public.orders", ("o_custkey",), "public.customer", ("c_custkey",)),
    ForeignKey("fk_l", "public.lineitem", ("l_partkey", "l_suppkey"), "public.partsupp", ("ps_partkey", "ps_suppkey")),
    ForeignKey("fk_l", "public.events", ("user_id",), "public.customer", ("c_custkey",)),
)


@_query("SELECT 1 AS missing, 2 AS extra")
def fk_signature_diff(spark, d):
    other = (_FKS[0], _FKS[1], ForeignKey("fk_l", "public.events", ("user_id",), "public.customer", ("c_custkey",), "FULL"), _FKS[0])
    return V.signature_difference(foreign_key_signatures(spark, _FKS), foreign_key_signatures(spark, other))


@_query("SELECT * FROM (VALUES ('fk_o', 'public.orders', 'o_custkey', 'c_custkey', 0), ('fk_l', 'public.lineitem', 'l_partkey', 'ps_partkey', 0), ('fk_l', 'public.lineitem', 'l_suppkey', 'ps_suppkey', 1), ('fk_l', 'public.events', 'user_id', 'c_custkey', 0)) t(name, table_name, column_name, target_column, place)")
def fk_catalog_pairs(spark, d):
    return foreign_key_pairs(foreign_keys_frame(spark, _FKS)).drop("target", "match")


@_query("SELECT 1 AS missing, 1 AS extra")
def key_signature_diff(spark, d):
    a = (KeyConstraint("PRIMARY KEY", "t", ("a", "b"), "one"), KeyConstraint("UNIQUE", "t", ("c",), "two"))
    b = (KeyConstraint("PRIMARY KEY", "t", ("b", "a"), "one"), KeyConstraint("UNIQUE", "t", ("c",), "other name"))
    return V.signature_difference(keys_frame(spark, a), keys_frame(spark, b))


@_query("SELECT 8 AS source_columns, 8 AS target_columns, 1 AS missing_target_columns, 1 AS extra_target_columns, 1 AS type_mismatches, 1 AS length_mismatches")
def schema_diff(spark, d):
    fields = [("c", "bigint"), ("n", "VARCHAR"), ("t", "double  precision"), ("u", "int"), ("v", "string"), ("w", "string"), ("x", "string"), ("y", "date")]
    a = spark.createDataFrame([("public", "t", n, k, None) for n, k in fields], columns_frame_schema())
    changed = [("c", "bigint", None), ("n", "varchar", None), ("t", "Double Precision", None), ("u", "bigint", None), ("v", "string", 10), ("w", "string", None), ("x", "string", None), ("z", "date", None)]
    b = spark.createDataFrame([("public", "t", *x) for x in changed], columns_frame_schema())
    return V.schema_difference(a, b)


def columns_frame_schema() -> str:
    return "schema_name string, table_name string, column_name string, type string, max_length int"


_TAMPER_SQL = "CASE WHEN c_custkey % 31 = 0 THEN 'Wrong' WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN {raw} ELSE {new} END"


def _tamper(raw: Column, new: Column) -> Column:
    k = F.col("c_custkey")
    return F.when(k % 31 == 0, "Wrong").when(k % 37 == 0, None).when(k % 41 == 0, raw).otherwise(new)


@_query(
    _with(f"""SELECT count(*) AS rows_checked, count(*) FILTER (WHERE s IS NOT NULL AND r IS NULL) AS missing_mappings,
count(*) FILTER (WHERE s IS NOT NULL AND r IS NOT NULL AND t IS NOT NULL AND t <> r) AS mapping_mismatches,
count(*) FILTER (WHERE (s IS NULL AND t IS NOT NULL) OR (s IS NOT NULL AND r IS NOT NULL AND t IS NULL)) AS null_mismatches,
count(*) FILTER (WHERE s IS NOT NULL AND r IS NOT NULL AND t = s) AS unchanged_values,
0 AS invalid_source_values, 0 AS invalid_target_values, 0 AS primary_key_mismatches
FROM (SELECT ck.c_name AS s, CASE WHEN m.rank % 19 > 0 THEN m.replacement END AS r, {_TAMPER_SQL.format(raw="ck.c_name", new="masked.c_name")} AS t
FROM ck LEFT JOIN m USING (h) JOIN masked USING (c_custkey))""")
)
def mapping_pk_aligned(spark, d):
    raw, all_mappings = _customer(spark, d), checkpointed(_mappings(spark, d))
    masked = mask_table(raw, {"c_name": PEOPLE}, all_mappings, POLICY, _DIGESTER, "customer").withColumnRenamed("c_name", "new").join(raw.select("c_custkey", "c_name"), "c_custkey").withColumn("c_name", _tamper(F.col("c_name"), F.col("new")))
    kept = R.ranked(_keys(spark, d)).where("rank % 19 > 0").select("source_hmac").join(all_mappings, "source_hmac")
    return V.aligned_metrics(raw, masked, ("c_custkey",), "c_name", kept, _norm())


@_query(
    _with("""SELECT (SELECT count(*) FROM ck) AS rows_checked, 0 AS missing_mappings,
(SELECT CAST(sum(abs(coalesce(e, 0) - coalesce(a, 0))) AS BIGINT) FROM (SELECT c_name AS x, count(*) AS e FROM masked WHERE c_name IS NOT NULL GROUP BY ALL) FULL JOIN
 (SELECT x, count(*) AS a FROM (SELECT CASE WHEN c_custkey % 31 = 0 THEN 'Wrong' ELSE c_name END AS x FROM masked WHERE c_custkey % 13 > 0) WHERE x IS NOT NULL GROUP BY ALL) USING (x)) AS mapping_mismatches,
abs((SELECT count(*) FROM c WHERE c_name IS NULL) - (SELECT count(*) FROM masked WHERE c_name IS NULL AND c_custkey % 13 > 0 AND c_custkey % 31 > 0)) AS null_mismatches,
0 AS unchanged_values, 0 AS invalid_source_values, 0 AS invalid_target_values, 0 AS primary_key_mismatches""")
)
def mapping_aggregate(spark, d):
    masked = _masked(spark, d).where("c_custkey % 13 > 0").withColumn("c_name", F.when(F.col("c_custkey") % 31 == 0, "Wrong").otherwise(F.col("c_name")))
    return V.aggregate_metrics(_customer(spark, d), masked, "c_name", _mappings(spark, d), _norm(), _DIGESTER(PEOPLE, "human_text", True, True))


@_query("""WITH e AS (SELECT l_partkey AS value, count(*) AS e FROM lineitem GROUP BY ALL), a AS (SELECT l_partkey AS value, count(*) AS a FROM lineitem WHERE l_linenumber <> 3 GROUP BY ALL)
SELECT CAST(sum(abs(coalesce(e, 0) - coalesce(a, 0))) AS BIGINT) AS difference FROM e FULL JOIN a USING (value)""")
def multiset_difference(spark, d):
    line = _t(spark, d, "lineitem")
    return V.multiset_difference(line.select(F.col("l_partkey").alias("value")), line.where("l_linenumber <> 3").select(F.col("l_partkey").alias("value")))


@_query(_with(f"SELECT count(DISTINCT h) AS distinct_target, count(DISTINCT h) FILTER (WHERE h IN (SELECT h FROM k)) AS intersection_keys, 0 AS invalid_values FROM (SELECT {_hmac(_norm_sql('t'))} AS h FROM (SELECT CASE WHEN c_custkey % 29 = 0 THEN c.c_name ELSE masked.c_name END AS t FROM c JOIN masked USING (c_custkey)) WHERE t IS NOT NULL)"))
def hmac_nonintersection(spark, d):
    leaked = _masked(spark, d).withColumnRenamed("c_name", "new").join(_customer(spark, d).select("c_custkey", "c_name"), "c_custkey")
    return V.nonintersection(leaked.select(F.when(F.col("c_custkey") % 29 == 0, F.col("c_name")).otherwise(F.col("new")).alias("value")), _mappings(spark, d), _norm())


@_query("SELECT 'o_orderpriority' AS column_name, (SELECT count(DISTINCT o_orderpriority) FROM orders) AS source_distinct, 1 AS target_distinct, TRUE AS collapsed")
def no_single_placeholder(spark, d):
    o = _t(spark, d, "orders")
    s, t = V.column_statistics(o, ["o_orderpriority"]), V.column_statistics(o.withColumn("o_orderpriority", F.lit("none")), ["o_orderpriority"])
    both = s.select("column_name", F.col("distinct_count").alias("source_distinct")).join(t.select("column_name", F.col("distinct_count").alias("target_distinct")), "column_name")
    return both.withColumn("collapsed", (F.col("source_distinct") > 1) & (F.col("target_distinct") <= 1))


@_query(_with("SELECT 'people' AS group_id, (SELECT count(*) FROM k) AS mappings, (SELECT count(*) FROM c WHERE c_name IS NULL) + (SELECT count(*) FROM s WHERE s_name IS NULL) AS nulls, (SELECT count(DISTINCT c_name) FROM c) + (SELECT count(DISTINCT s_name) FROM s) AS distinct_values"))
def group_report(spark, d):
    stats = V.column_statistics(_customer(spark, d), ["c_name"]).union(V.column_statistics(_supplier(spark, d), ["s_name"])).withColumn("group_id", F.lit(PEOPLE))
    total = stats.groupBy("group_id").agg(F.sum("null_count").alias("nulls"), F.sum("distinct_count").alias("distinct_values"))
    return R.mapping_counts(_mappings(spark, d)).drop("assigned").join(total, "group_id")


@_query(_with("SELECT c.c_custkey, c.c_name AS before, masked.c_name AS after FROM c JOIN masked USING (c_custkey) WHERE c.c_name IS NOT NULL ORDER BY c_custkey LIMIT 5"))
def before_after_sample(spark, d):
    return before_after(_customer(spark, d), _masked(spark, d), "c_custkey", "c_name", 5)


@_query("""SELECT * FROM (VALUES ('source_schema_fingerprint', 'pass'), ('schema_columns_types', 'pass'), ('table_row_counts', 'pass'), ('configured_column_statistics', 'fail'), ('foreign_keys', 'pass'),
('primary_unique_constraints', 'pass'), ('configured_mappings', 'pass'), ('source_target_hmac_nonintersection', 'pass'), ('no_single_placeholder', 'pass')) t(id, status)""")
def verification_summary(spark, d):
    """Nine checks. Spelling variants of one name share a replacement, so raw distinct counts differ, as they should say."""
    return _checks(_people_doubled(spark, d), POLICY)


@_query("""SELECT * FROM (VALUES ('source_schema_fingerprint', 'pass'), ('schema_columns_types', 'pass'), ('table_row_counts', 'pass'), ('configured_column_statistics', 'pass'), ('foreign_keys', 'pass'),
('primary_unique_constraints', 'pass'), ('configured_mappings', 'pass'), ('source_target_hmac_nonintersection', 'pass'), ('no_single_placeholder', 'pass')) t(id, status)""")
def verification_clean(spark, d):
    """The nine checks of a source without spelling variants: all pass."""
    o = ForeignKey("fk_o", "public.orders", ("o_custkey",), "public.customer", ("c_custkey",))
    tables = {"public.customer": _t(spark, d, "customer"), "public.supplier": _t(spark, d, "supplier"), "public.orders": _t(spark, d, "orders")}
    keys = tuple(KeyConstraint("PRIMARY KEY", f"public.{t}", (c,)) for t, c in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")))
    return _checks(Catalog(d, tables, keys, (o,)), POLICY)


def _people_doubled(spark, d) -> Catalog:
    """Customers, twice: once with their names in capitals, under other keys."""
    c = _customer(spark, d)
    again = c.withColumns({"c_custkey": -1 - F.col("c_custkey"), "c_name": F.upper("c_name")})
    people = _people(spark, d)
    return people.redeclared(d, people.tables | {"public.customer": c.unionByName(again)})


def _checks(source: Catalog, policy: Policy) -> DataFrame:
    spark = next(iter(source.tables.values())).sparkSession
    rank = R.ranked(distinct_keys(keyed_values(source, policy, _DIGESTER)))
    new = synthetic("person_name", batched_sequence(F.col("rank"), BATCH))
    mappings = checkpointed(rank.select("group_id", "source_hmac", new.alias("replacement")).withColumn("replacement_hmac", _norm()(F.col("replacement"))["digest"]))
    plan = policy.by_table()
    target = source.redeclared("masked", {n: checkpointed(mask_table(df, plan[n], mappings, policy, _DIGESTER, n)) if n in plan else df for n, df in source.tables.items()})
    checks, _ = V.verify(source, target, policy, mappings, _DIGESTER, source.snapshot().fingerprint)
    return spark.createDataFrame([(c.id, c.status) for c in checks], "id string, status string")


@_query("SELECT i AS id, CASE WHEN i = 53 THEN NULL ELSE list_extract(['Anna', 'Boris', 'Clara', 'Denis', 'Elena', 'Fedor'], CAST(i % 6 + 1 AS INT)) || ' No' || lpad(CAST(i AS VARCHAR), 4, '0') END AS full_name, CASE WHEN i = 54 THEN NULL ELSE 'user' || i || '@source.test' END AS email, CASE WHEN i = 55 THEN NULL ELSE '+7 999 ' || lpad(CAST(i AS VARCHAR), 7, '0') END AS phone, CASE WHEN i = 56 THEN NULL ELSE list_extract(['Lime', 'Oak', 'Pine', 'Elm'], CAST(i % 4 + 1 AS INT)) || ' street ' || i END AS address FROM range(1, 61) t(i)")
def seed_customers(spark, d):
    from .sources.seeds import customers

    return customers(spark, 60, nulls=True)


@_query("SELECT i * 3 - k AS id, i AS customer_id, CAST(i * 10 + k AS DOUBLE) AS amount FROM range(1, 61) t(i), range(3) u(k)")
def seed_orders(spark, d):
    from .sources.seeds import customers, orders

    return orders(spark, 3, customers(spark, 60)).select("id", "customer_id", F.col("amount").cast("double").alias("amount"))


@_query("SELECT i AS id, (i - 1) % 100 + 1 AS customer_id FROM range(1, 20001) t(i)")
def seed_cycled_orders(spark, d):
    from .sources.seeds import customers, cycled_orders

    return cycled_orders(spark, 20000, customers(spark, 100), 100).select("id", "customer_id")


# --- sources and sinks ---


@_query(_with("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM c"))
def jsonl_round_trip(spark, d):
    path = f"{scratch_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    write_jsonl(_customer(spark, d).select("c_custkey", "c_name"), path)
    return read_jsonl(spark, path, ("c_custkey", "c_name"))


@_query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def jdbc_round_trip(spark, d):
    """Written to a database and read from it by the executors, in four ranges of the key."""
    people = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    low, high = people.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    got = jdbc_table(spark, embedded_database(spark, {"people": people}), "people", 500, {"driver": DRIVERS["derby"]}, ("c_custkey", low or 0, (high or 0) + 1, 4))
    return got.select(*[F.col(c).alias(c.lower()) for c in got.columns])


@_query("SELECT table_name, column_name, column_name IN ('c_custkey', 's_suppkey') AS is_primary_key FROM information_schema.columns WHERE table_name IN ('customer', 'supplier')")
def column_catalog(spark, d):
    found = _people(spark, d).snapshot().columns
    return spark.createDataFrame([(c.ref.table, c.ref.column, c.is_primary_key) for c in found], "table_name string, column_name string, is_primary_key boolean")


@_query("SELECT 'public.' || table_name AS table_name, column_name, 'people' AS group_id FROM information_schema.columns WHERE column_name LIKE '%\\_name' ESCAPE '\\' AND table_name IN ('customer', 'supplier')")
def transform_plan(spark, d):
    rows = [(t, c, g) for t, columns in POLICY.by_table().items() for c, g in columns.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, group_id string")


_KIND_SQL = "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END"


@_query(f"SELECT table_name, column_name, {_KIND_SQL} AS type FROM information_schema.columns WHERE table_name IN ('region', 'nation')")
def introspected_columns(spark, d):
    """Two tables written to a database, as its metadata tell them: without the system's own."""
    url = embedded_database(spark, {t: _t(spark, d, t) for t in ("region", "nation")})
    found = jdbc_catalog(spark, url, DRIVERS["derby"]).snapshot().columns
    return spark.createDataFrame([(c.ref.table.lower(), c.ref.column, c.type) for c in found], "table_name string, column_name string, type string")


@_query(f"""SELECT 'key' AS what, sha256(encode('{TEST_KEY.decode()}')) AS digest UNION ALL SELECT 'schema',
 sha256(encode('{{"columns":[' || string_agg('["public","nation","' || column_name || '","' || {_KIND_SQL} || '",null,' || CASE column_name WHEN 'n_nationkey' THEN 'true' ELSE 'false' END || ',false]', ',' ORDER BY column_name) || '],"foreign_keys":[]}}')) FROM information_schema.columns WHERE table_name = 'nation'""")
def fingerprints(spark, d):
    nation = Catalog(d, {"public.nation": _t(spark, d, "nation")}, (KeyConstraint("PRIMARY KEY", "public.nation", ("n_nationkey",)),))
    return spark.createDataFrame([("key", key_fingerprint(TEST_KEY)), ("schema", nation.snapshot().fingerprint)], "what string, digest string")


# --- predicates and texts ---


def _applied(function, kind: str):
    """A plain function of one text as an Arrow function."""
    return F.pandas_udf(lambda values: values.map(function), kind)


@_query("SELECT p_partkey FROM part WHERE length(p_name) BETWEEN 12 AND 30 AND regexp_full_match(p_name, '[A-Za-z]+( [A-Za-z#0-9]+)*')")
def accepted_values(spark, d):
    limits = Generation("parts", 12, 30, "[A-Za-z]+( [A-Za-z#0-9]+)*")
    return _t(spark, d, "part").where(G.accepted(limits)("p_name")).select("p_partkey")


@_query(_with("SELECT h AS source_hmac, substr(h, 1, 12) AS shown, regexp_full_match(h, '[0-9a-f]{64}') AS valid, regexp_full_match(upper(h), '[0-9a-f]{64}') AS valid_upper FROM k"))
def digest_forms(spark, d):
    h = F.col("source_hmac")
    valid = _applied(is_digest, "boolean")
    return _keys(spark, d).select(h, _applied(short_digest, "string")(h).alias("shown"), valid(h).alias("valid"), valid(F.upper(h)).alias("valid_upper"))


_PLACES = ("postgresql://{0}:pw{0}@db.example:5432/x?sslmode=a", "jdbc:postgresql://db.example/x?user={0}&password=b", "host=h user={0} password='p w'", "no location {0}")
_REDACTED = ("postgresql://***@db.example:5432/x", "jdbc:postgresql://db.example/x", "host=h user=*** password=***", "[redacted]")


@_query(f"SELECT c_custkey, list_extract([{', '.join(repr(x) for x in _REDACTED)}], CAST(c_custkey % 4 + 1 AS INT)) AS shown FROM customer")
def redacted_locations(spark, d):
    texts = F.array(*[F.concat_ws("", *[F.col("c_custkey").cast("string") if i else F.lit(x) for part in [x.split("{0}")] for j, x in enumerate(part) for i in ((0, 1) if j < len(part) - 1 else (0,))]) for x in _PLACES])
    return _t(spark, d, "customer").select("c_custkey", _applied(redact, "string")(F.get(texts, (F.col("c_custkey") % 4).cast("int"))).alias("shown"))


@_query("SELECT c_custkey, replace(replace(replace(replace(c_name, '0', '|') || chr(92) || chr(10), chr(92), chr(92) || chr(92)), '|', chr(92) || '|'), chr(10), ' ') AS cell FROM customer")
def escaped_cells(spark, d):
    value = F.concat(F.replace("c_name", F.lit("0"), F.lit("|")), F.lit("\\\n"))
    return _t(spark, d, "customer").select("c_custkey", _applied(escape_cell, "string")(value).alias("cell"))


@_query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'invalid' WHEN 2 THEN 'invalid' ELSE 'ok' END AS phone_status, CASE c_custkey % 5 WHEN 0 THEN 'null' ELSE 'ok' END AS empty_allowed FROM customer")
def empty_values(spark, d):
    value = F.when(F.col("c_custkey") % 5 == 0, None).when(F.col("c_custkey") % 5 == 1, " \t").when(F.col("c_custkey") % 5 == 2, "no number").otherwise(F.col("c_custkey").cast("string"))
    status = lambda allow: keyed(TEST_KEY, PEOPLE, "phone", allow)(value)["status"]
    return _t(spark, d, "customer").select("c_custkey", status(False).alias("phone_status"), status(True).alias("empty_allowed"))


# --- registry and generation, by the engine's own path ---


@_query(_with(f"SELECT {_hmac(_norm_sql('v'))} AS replacement_hmac, count(*) AS count, 'people' AS group_id FROM (SELECT v FROM v UNION SELECT upper(v) FROM v WHERE length(v) % 2 = 0) GROUP BY ALL HAVING count(*) > 1"))
def registry_duplicate_digests(spark, d):
    """Replacements that are spelled apart but equal after normalisation: source values in their spellings stand in for them."""
    values = _people(spark, d)
    both = values["public.customer"].select(F.col("c_name").alias("v")).union(values["public.supplier"].select("s_name")).where("v is not null").distinct()
    both = both.union(both.where("length(v) % 2 = 0").select(F.upper("v"))).distinct()
    return R.duplicate_replacements(both.select(F.lit(PEOPLE).alias("group_id"), _norm()(F.col("v"))["digest"].alias("replacement_hmac")), "replacement_hmac").select("group_id", "replacement_hmac", "count")


@_query(_with("SELECT 'people' AS group_id, h AS source_hmac FROM m WHERE rank % 6 = 0 AND rank % 4 = 0"))
def registry_assigned_again(spark, d):
    rank = R.ranked(_keys(spark, d))
    return R.already_given(rank.where("rank % 4 = 0"), rank.where("rank % 6 = 0")).select("group_id", "source_hmac")


class _Numbered:
    """A provider for queries: V 1, V 2, ..., every seventh value empty."""

    name, model = "numbered", "none"

    def __init__(self) -> None:
        self.last = 0

    def generate(self, request: G.Request) -> list[str]:
        numbers = range(self.last + 1, self.last + request.count + 1)
        self.last += request.count
        return ["" if n % 7 == 0 else f"V {n}" for n in numbers]


def _nations(spark: SparkSession, d: str) -> R.Registry:
    """A registry of the nations' names, filled batch by batch."""
    reg = R.Registry(spark, f"{scratch_dir(spark)}/registry-{uuid.uuid4().hex}")
    names = _t(spark, d, "nation").select(F.lit(PEOPLE).alias("group_id"), _norm()(F.col("n_name"))["digest"].alias("source_hmac"))
    reg.insert(names)
    G.ReplacementGenerator(reg, _Numbered(), TEST_KEY, 10, 2).generate_group(PEOPLE, POLICY.groups[PEOPLE])
    return reg


# Three batches of keys, of 10, 10 and 5: 13, 13 and 7 values are asked for.
_BATCH_SQL = f"""WITH k AS (SELECT {_hmac(_norm_sql('n_name'))} AS h FROM nation), r AS (SELECT h, row_number() OVER (ORDER BY h) AS rank FROM k),
asked AS (SELECT n, CASE WHEN n <= 13 THEN 0 WHEN n <= 26 THEN 1 ELSE 2 END AS batch FROM range(1, 34) t(n)),
good AS (SELECT n, batch, row_number() OVER (PARTITION BY batch ORDER BY n) AS place FROM asked WHERE n % 7 > 0),
used AS (SELECT n, batch, place FROM good WHERE place <= CASE batch WHEN 2 THEN 5 ELSE 10 END)"""


@_query(_BATCH_SQL + " SELECT h AS source_hmac, 'V ' || n AS replacement FROM r JOIN used ON rank = batch * 10 + place")
def generated_by_batches(spark, d):
    return _nations(spark, d).frame().select("source_hmac", "replacement")


@_query(_BATCH_SQL + " SELECT (SELECT count(DISTINCT batch) FROM asked) AS batches, (SELECT count(*) FROM used) AS accepted_items, (SELECT count(*) FROM asked) - (SELECT count(*) FROM used) AS rejected_items")
def generation_statistics(spark, d):
    got = R.Registry(spark, _nations(spark, d).root).stats  # as it is stored
    return spark.createDataFrame([(got.batches, got.accepted_items, got.rejected_items)], "batches long, accepted_items long, rejected_items long")


@_query("SELECT CAST(n AS BIGINT) AS remaining, CAST(least(1000, 50, n + greatest(2, CAST(ceil(n / 4.0) AS BIGINT))) AS BIGINT) AS asked FROM range(1, 1001) t(n)")
def request_sizes(spark, d):
    loop = G.ReplacementGenerator(None, None, TEST_KEY, 25)
    return spark.createDataFrame([(n, loop.request_size(n)) for n in range(1, 1001)], "remaining long, asked long")


@_query("""SELECT CAST(n AS BIGINT) AS number, e AS entity, 'Batch ' || n || ': write 13 different made-up ' || e || ' values for locale en: made up. 1 to 60 characters.' ||
CASE e WHEN 'email' THEN ' Let every local part end in .' || n || '.' WHEN 'phone' THEN ' Let the last two digits differ from number to number, starting at ' || lpad(CAST(n * 37 % 100 AS VARCHAR), 2, '0') || '.' ELSE '' END AS asked
FROM range(1, 121) t(n), (VALUES ('person_name'), ('email'), ('phone'), ('address')) u(e)""")
def prompts(spark, d):
    """What a model is asked: entity, locale, limits and a number, nothing of the source."""
    rows = [(n, e, G.prompt(G.Request(e, "en", "made up", 1, 60, None, 13, n))) for n in range(1, 121) for e in ("person_name", "email", "phone", "address")]
    return spark.createDataFrame(rows, "number long, entity string, asked string")


@_query("""SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS items FROM customer""")
def parsed_answers(spark, d):
    """How many values an answer holds; null for answers of another form."""
    forms = ('{"items":[{"value":"a"}]}', '{"items":[{"value":"a"},{"value":""}]}', '{"items":[]}', '{"items":[{"value":1}]}', '{"items":[{"value":"a","more":1}]}')

    def items(number: int) -> int | None:
        try:
            return len(G.parse_response(forms[number % 5]))
        except GenerationError:
            return None

    return _t(spark, d, "customer").select("c_custkey", _applied(items, "long")(F.col("c_custkey")).alias("items"))


# --- whole runs: policy, stages with a stop between, target, report ---

_runs: dict[tuple[str, str], tuple[str, dict, list]] = {}


def _run(spark: SparkSession, d: str) -> tuple[str, dict, list]:
    """Target, report and log of a run that was stopped after generating and resumed: once for each session and folder."""
    at = spark.sparkContext.applicationId, d
    if at not in _runs:
        source, target = (f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}-{x}" for x in ("source", "target"))
        for t in ("customer", "supplier", "orders"):
            df = _t(spark, d, t)
            (df.withColumn("c_name", F.when(F.col("c_custkey") % 53 != 0, F.col("c_name"))) if t == "customer" else df).write.parquet(f"{source}/{t}.parquet")
        keys = tuple(KeyConstraint("PRIMARY KEY", f"public.{t}", (c,)) for t, c in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")))
        refers = (ForeignKey("fk_o", "public.orders", ("o_custkey",), "public.customer", ("c_custkey",)),)
        opened = lambda session, place: parquet_catalog(session, place, ("customer", "supplier", "orders"), keys, refers)
        policy = replace(POLICY, run_directory=tempfile.mkdtemp(prefix="cloakwork-run-"))  # state and report of this driver program
        env = {policy.source_env: source, policy.target_env: target, policy.key_env: TEST_KEY.decode()}
        try:
            run_masking(spark, policy, env, opened, "query", stop_after=("generate",))
        except Interrupted:
            report = run_masking(spark, policy, env, opened, "query", resume=True)
        log = [json.loads(line) for line in (Path(policy.run_directory) / "query" / "run.jsonl").read_text().splitlines()]
        _runs[at] = target, report.document(), log
    return _runs[at]


_RUN_CTE = f"""p AS (SELECT * REPLACE (CASE WHEN c_custkey % 53 <> 0 THEN c_name END AS c_name) FROM customer),
n AS (SELECT c_name AS v FROM p WHERE c_name IS NOT NULL UNION SELECT s_name FROM supplier), g AS (SELECT DISTINCT {_hmac(_norm_sql('v'))} AS h FROM n),
o AS (SELECT h, row_number() OVER (ORDER BY h) AS n FROM g), a AS (SELECT h, {_name_sql('n')} AS replacement FROM o)"""


@_query(f"WITH {_RUN_CTE} SELECT p.* REPLACE (a.replacement AS c_name) FROM p LEFT JOIN a ON a.h = {_hmac(_norm_sql('c_name'))}")
def run_masked_customer(spark, d):
    """A table of the target that a whole run published: replacements are numbered by the engine."""
    return spark.read.parquet(f"{_run(spark, d)[0]}/customer.parquet")


@_query("SELECT 'public.' || t AS name, n AS source_rows, n AS target_rows, TRUE AS row_count_equal FROM (SELECT 'customer' AS t, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'orders', count(*) FROM orders)")
def run_report_tables(spark, d):
    rows = [(t["table"], t["source_rows"], t["target_rows"], t["row_count_equal"]) for t in _run(spark, d)[1]["tables"]]
    return spark.createDataFrame(rows, "name string, source_rows long, target_rows long, row_count_equal boolean")


@_query(f"WITH {_RUN_CTE} SELECT 'people' AS id, 'person_name' AS entity_type, (SELECT count(*) FROM g) AS mapping_count, (SELECT count(*) FROM a) AS distinct_target, (SELECT count(*) FROM p WHERE c_name IS NULL) AS nulls_source, (SELECT count(*) FROM p WHERE c_name IS NULL) AS nulls_target")
def run_report_groups(spark, d):
    rows = [(g["group"], g["entity_type"], g["mapping_count"], g["distinct_target"], g["null_source"], g["null_target"]) for g in _run(spark, d)[1]["groups"]]
    return spark.createDataFrame(rows, "id string, entity_type string, mapping_count long, distinct_target long, nulls_source long, nulls_target long")


@_query(f"WITH {_RUN_CTE} SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM orders) AS rows, (SELECT count(*) FROM g) AS mappings, (SELECT count(*) FROM g) AS accepted_items, 5 AS stages")
def run_benchmark(spark, d):
    _, report, log = _run(spark, d)
    got = benchmark(report, log, 1)
    return spark.createDataFrame([(got["rows"], got["mappings"], got["accepted_items"], len(got["stage_seconds"]))], "rows long, mappings long, accepted_items long, stages long")


# --- every check's counters on a copy with known defects ---

_COPY = """ts AS (SELECT * FROM s), tc AS (SELECT masked.* REPLACE (CASE WHEN c_custkey % 31 = 0 THEN 'Wrong' WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN c.c_name ELSE masked.c_name END AS c_name) FROM masked JOIN c USING (c_custkey)),
t_o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE o_custkey END AS o_custkey FROM orders WHERE o_orderkey % 50 > 0),
pairs AS (SELECT c.c_name AS sv, m.replacement AS r, tc.c_name AS tv FROM ck AS c LEFT JOIN m USING (h) JOIN tc USING (c_custkey) UNION ALL SELECT x.s_name, m.replacement, ts.s_name FROM (SELECT s.*, {hmac} AS h FROM s) x LEFT JOIN m USING (h) JOIN ts USING (s_suppkey)),
left_in AS (SELECT DISTINCT {hmac_tv} AS h FROM pairs WHERE tv IS NOT NULL),
so AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) AS p FROM orders), tp AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) AS p FROM t_o)""".format(hmac=_hmac(_norm_sql("s_name")), hmac_tv=_hmac(_norm_sql("tv")))


@_query(f"""WITH {_CTE}, {_COPY}
SELECT 'table_row_counts' AS id, 'mismatched_tables' AS counter, CAST((SELECT count(*) FROM orders) <> (SELECT count(*) FROM t_o) AS BIGINT) AS value
UNION ALL SELECT 'schema_columns_types', 'extra_target_columns', 0
UNION ALL SELECT 'configured_column_statistics', 'null_mismatches', CAST((SELECT count(*) FROM c WHERE c_name IS NULL) <> (SELECT count(*) FROM tc WHERE c_name IS NULL) AS BIGINT)
UNION ALL SELECT 'configured_column_statistics', 'distinct_mismatches', CAST((SELECT count(DISTINCT c_name) FROM c) <> (SELECT count(DISTINCT c_name) FROM tc) AS BIGINT)
UNION ALL SELECT 'foreign_keys', 'orphan_rows', (SELECT count(*) FROM t_o WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM tc))
UNION ALL SELECT 'primary_unique_constraints', 'primary_key_value_mismatches', (SELECT count(*) FROM so FULL JOIN tp USING (p) WHERE so.k IS DISTINCT FROM tp.k)
UNION ALL SELECT 'primary_unique_constraints', 'duplicate_key_groups', (SELECT count(*) FROM (SELECT o_orderkey FROM t_o GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'configured_mappings', 'rows_checked', (SELECT count(*) FROM pairs)
UNION ALL SELECT 'configured_mappings', 'mapping_mismatches', (SELECT count(*) FROM pairs WHERE sv IS NOT NULL AND tv <> r)
UNION ALL SELECT 'configured_mappings', 'null_mismatches', (SELECT count(*) FROM pairs WHERE (sv IS NULL) <> (tv IS NULL))
UNION ALL SELECT 'configured_mappings', 'unchanged_values', (SELECT count(*) FROM pairs WHERE sv = tv)
UNION ALL SELECT 'source_target_hmac_nonintersection', 'intersection_keys', (SELECT count(*) FROM left_in WHERE h IN (SELECT h FROM k))
UNION ALL SELECT 'no_single_placeholder', 'collapsed_columns', CAST((SELECT count(DISTINCT c_name) FROM tc) <= 1 AS BIGINT) + CAST((SELECT count(DISTINCT s_name) FROM ts) <= 1 AS BIGINT)""")
def verification_counters(spark, d):
    """What the checks count on a copy whose suppliers were not masked, with tampered customers and lost orders."""
    mappings = checkpointed(_mappings(spark, d))
    c, o = _customer(spark, d), _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    keys = tuple(KeyConstraint("PRIMARY KEY", f"public.{t}", (k,)) for t, k in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")))
    refers = (ForeignKey("fk_o", "public.orders", ("o_custkey",), "public.customer", ("c_custkey",)),)
    source = Catalog(d, {"public.customer": c, "public.supplier": _supplier(spark, d), "public.orders": o}, keys, refers)
    masked = mask_table(c, {"c_name": PEOPLE}, mappings, POLICY, _DIGESTER, "customer").withColumnRenamed("c_name", "new").join(c.select("c_custkey", "c_name"), "c_custkey")
    spoiled = masked.withColumn("c_name", _tamper(F.col("c_name"), F.col("new"))).select(*c.columns)
    lost = o.where("o_orderkey % 50 > 0").withColumn("o_custkey", F.when(F.col("o_orderkey") % 97 == 0, F.lit(-1).cast(o.schema["o_custkey"].dataType)).otherwise(F.col("o_custkey")))
    target = source.redeclared("copy", {"public.customer": checkpointed(spoiled), "public.supplier": _supplier(spark, d), "public.orders": lost})
    checks, _ = V.verify(source, target, POLICY, mappings, _DIGESTER, source.snapshot().fingerprint)
    told = ("mismatched_tables", "extra_target_columns", "distinct_mismatches", "orphan_rows", "primary_key_value_mismatches", "duplicate_key_groups", "rows_checked", "mapping_mismatches", "null_mismatches", "unchanged_values", "intersection_keys", "collapsed_columns")
    rows = [(x.id, k, int(v)) for x in checks for k, v in x.details.items() if k in told]
    return spark.createDataFrame(rows, "id string, counter string, value long")
