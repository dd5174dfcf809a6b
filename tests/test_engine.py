"""The pseudonymisation engine: scalar vectors, policy, registry, generation, masking, each check with a tampered target, whole runs."""

import json
import os
import unicodedata
from dataclasses import replace

import pytest
import yaml
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cloakwork.__main__ import main
from cloakwork.errors import GenerationError, PolicyError, RegistryConflict, RegistryError, TransformError, VerificationError
from cloakwork.functions.numbering import numbered
from cloakwork.functions.scalars import ascii_normalized, digest, digest_expression, key_fingerprint, keyed, normalize, synthetic
from cloakwork.operators import verify as V
from cloakwork.operators.generate import HttpProvider, ReplacementGenerator, Request, ScriptedProvider, assign_synthetic, parse_response, prompt
from cloakwork.operators.keys import arrow_digester, collect_keys, collection_stats, keyed_values
from cloakwork.operators.registry import Registry, RunMetadata, duplicate_replacements, pending
from cloakwork.operators.transform import mask_table, preflight
from cloakwork.plans.catalog import Catalog, ForeignKey, KeyConstraint, check_policy, same_place
from cloakwork.plans.policy import ColumnRef, parse
from cloakwork.plans.report import Report, check_shape, escape_cell, markdown, rollup
from cloakwork.plans.settings import redact, resolve
from cloakwork.plans.stages import Interrupted, run_masking, verify_run
from cloakwork.sources.seeds import customers, orders
from cloakwork.sources.tables import jdbc_table, publish, read_jsonl, write_jsonl

KEY = b"a public key of 32 bytes or more"
MARKERS = ("Zyxw-Marker-Name", "marker.mail@leak.test", "+7 111 222-33-44", "Marker Street 99")


def raw_policy(**changes):
    limits = {"description": "made up", "min_length": 1, "max_length": 60}
    group = lambda kind, norm, *cols: {"entity_type": kind, "locale": "en", "normalization": norm, "generation": dict(limits), "columns": list(cols)}
    raw = {
        "version": 1,
        "run": {"allow_target_recreate": True},
        "groups": {
            "names": group("person_name", "human_text", "public.customers.full_name", "public.orders.billing_name"),
            "mails": group("email", "email", "public.customers.email", "public.orders.contact_email"),
            "phones": group("phone", "phone", "public.customers.phone"),
            "addresses": group("address", "human_text", "public.customers.address"),
        },
    }
    return raw | changes


def policy(**changes):
    return parse(raw_policy(**changes))


def demo(spark, location="source"):
    c = customers(spark, 60, nulls=True)
    keys = (KeyConstraint("PRIMARY KEY", "public.customers", ("id",)), KeyConstraint("UNIQUE", "public.customers", ("email",)), KeyConstraint("PRIMARY KEY", "public.orders", ("id",)))
    fks = (ForeignKey("orders_customer", "public.orders", ("customer_id",), "public.customers", ("id",)),)
    return Catalog(location, {"public.customers": c, "public.orders": orders(spark, 3, c)}, keys, fks)


def meta(**changes):
    return replace(RunMetadata("r1", "p", "s", key_fingerprint(KEY), "deterministic", "none"), **changes)


@pytest.fixture(scope="module")
def masked(spark, tmp_path_factory):
    """A source, its mappings, and a sound masked copy."""
    p, source, d = policy(), demo(spark), arrow_digester(KEY)
    reg = Registry(spark, str(tmp_path_factory.mktemp("reg")))
    reg.insert(collect_keys(source, p, d))
    for g in p.groups:
        assign_synthetic(reg, p, d, g)
    mappings = reg.frame().cache()
    plan = p.by_table()
    tables = {n: mask_table(df, plan[n], mappings, p, d, n).cache() for n, df in source.tables.items()}
    return p, source, mappings, source.redeclared("target", tables), d


# --- scalars ---


def test_normalisation_vectors():
    assert normalize("  Ada\tLOVELACE  ", "human_text") == "ada lovelace"
    assert normalize("  AＤＡ@EXAMPLE.TEST ", "email") == "ada@example.test"
    assert normalize(" +7 (999) 123-45-67 ", "phone") == "79991234567"
    assert normalize("Straße ﬁn", "human_text") == "strasse fin"
    for bad in (None, 5):
        with pytest.raises(ValueError):
            normalize(bad, "human_text")
    with pytest.raises(ValueError):
        normalize(" \t", "human_text", allow_empty=False)
    with pytest.raises(ValueError):
        normalize("abc", "phone", allow_empty=False)


@given(st.text(max_size=30), st.sampled_from(["human_text", "email", "phone"]))
@settings(max_examples=200, deadline=None)
def test_normalisation_is_idempotent_enough(value, kind):
    once = normalize(value, kind)
    assert once == once.strip() and (kind != "phone" or all(c.isdigit() for c in once))
    assert normalize(unicodedata.normalize("NFC", value), kind) == normalize(value, kind)


def test_digests(spark):
    assert digest(KEY, "names", "x") != digest(KEY, "addresses", "x") and len(digest(KEY, "n", "x")) == 64
    values = ["  Ada  L ", "ADA l", None, " \t", "ß", "x" * 500]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [tuple(r["k"]) for r in df.select(keyed(KEY, "names", "human_text")("v").alias("k")).collect()]
    assert got == [("ok", digest(KEY, "names", "ada l")), ("ok", digest(KEY, "names", "ada l")), ("null", None), ("invalid", None), ("ok", digest(KEY, "names", "ss")), ("ok", digest(KEY, "names", "x" * 500))]
    same = df.where("v like 'A%'").select(digest_expression(KEY, "names", ascii_normalized(F.col("v"), "human_text")).alias("h")).first()["h"]
    assert same == digest(KEY, "names", "ada l")
    plan = df.select(keyed(KEY, "names", "human_text")("v"))._jdf.queryExecution().toString()
    assert KEY.decode() not in plan and KEY.hex() not in plan.lower()
    with pytest.raises(ValueError):
        keyed(b"short", "names", "human_text")


def test_synthetic_values_differ(spark):
    n = spark.range(1, 20001)
    for kind in ("person_name", "email", "phone", "address"):
        values = n.select(synthetic(kind, F.col("id")).alias("v"))
        assert values.distinct().count() == 20000
        norm = {"person_name": "human_text", "address": "human_text"}.get(kind, kind)
        assert len({normalize(r["v"], norm) for r in values.limit(3000).collect()}) == 3000
    assert [r["v"] for r in spark.range(1, 4).select(synthetic("person_name", F.col("id")).alias("v")).collect()][0] == "Ada Arden A"


def test_numbered(spark):
    df = spark.createDataFrame([(None,), (5,), (1,), (9,), (3,), (None,)], "k long")
    got = sorted((r["n"], r["k"]) for r in numbered(df, [F.col("k").asc_nulls_last()], "n").collect())
    assert [n for n, _ in got] == [1, 2, 3, 4, 5, 6] and [k for _, k in got][:4] == [1, 3, 5, 9]


# --- policy, catalog, settings ---


@pytest.mark.parametrize(
    "spoil",
    [
        lambda r: r.update(version=2),
        lambda r: r.update(surprise=1),
        lambda r: r["groups"]["names"]["columns"].append("public.customers.full_name"),
        lambda r: r["groups"]["mails"]["columns"].append("public.customers.full_name"),
        lambda r: r["groups"]["names"].update(normalization="email"),
        lambda r: r["groups"]["names"]["generation"].update(min_length=70),
        lambda r: r["groups"]["names"]["generation"].update(regex="("),
        lambda r: r["groups"]["names"].update(columns=[]),
        lambda r: r["groups"]["names"].update(columns=["public.customers.bad name"]),
        lambda r: r.update(groups={}),
        lambda r: r.update(mapping={"registry_filename": "../x"}),
        lambda r: r.update(report={"json_filename": "a/b"}),
        lambda r: r.update(report={"json_filename": "same", "markdown_filename": "same"}),
        lambda r: r.update(mapping={"hmac_key_env": "lower"}),
        lambda r: r.update(llm={"batch_size": 1001}),
        lambda r: r.update(llm={"batch_size": True}),
        lambda r: r["run"].pop("allow_target_recreate"),
    ],
)
def test_policy_is_strict(spoil):
    raw = raw_policy()
    spoil(raw)
    with pytest.raises(PolicyError):
        parse(raw)


def test_policy_against_schema(spark):
    c = demo(spark)
    check_policy(policy(), c.snapshot(), c.foreign_keys)
    with pytest.raises(PolicyError):
        check_policy(policy(run={"allow_target_recreate": False}), c.snapshot(), c.foreign_keys)
    for column in ("public.customers.missing", "public.customers.id"):
        raw = raw_policy()
        raw["groups"]["names"]["columns"] = [column]
        with pytest.raises(PolicyError):
            check_policy(parse(raw), c.snapshot(), ())
    short = Catalog("x", c.tables, c.keys, c.foreign_keys, {ColumnRef("public", "customers", "full_name"): 20})
    with pytest.raises(PolicyError):
        check_policy(policy(), short.snapshot(), ())
    natural = (ForeignKey("n", "public.orders", ("billing_name",), "public.customers", ("full_name",)),)
    check_policy(policy(), c.snapshot(), natural)
    with pytest.raises(PolicyError):
        check_policy(policy(), c.snapshot(), (ForeignKey("n", "public.orders", ("billing_name",), "public.customers", ("id",)),))


def test_fingerprint_ignores_order_and_key_names(spark):
    c = demo(spark)
    a = c.snapshot().fingerprint
    b = Catalog("y", {"public.orders": c["public.orders"], "public.customers": c["public.customers"].select(*reversed(c["public.customers"].columns))}, c.keys, c.foreign_keys)
    assert b.snapshot().fingerprint == a
    assert Catalog("y", c.tables, c.keys, (replace(c.foreign_keys[0], name="other"),)).snapshot().fingerprint != a


def test_settings_and_redaction():
    p, env = policy(), {"SOURCE_DSN": "/a", "TARGET_DSN": "/b", "MAPPING_HMAC_KEY": KEY.decode()}
    s = resolve(p, env)
    assert KEY.decode() not in repr(s)
    for change in ({"SOURCE_DSN": ""}, {"TARGET_DSN": "/a/../a"}, {"MAPPING_HMAC_KEY": "short"}):
        with pytest.raises(PolicyError):
            resolve(p, env | change)
    assert same_place("postgresql://u:p@h/db", "postgresql://v@H:5432/db/") and not same_place("postgresql://h/db", "postgresql://h/other")
    assert redact("postgresql://me:secret@host:1/db?password=x") == "postgresql://***@host:1/db"
    assert "secret" not in redact("host=h user=me password='secret'") and redact("weird secret") == "[redacted]"


# --- sources ---


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("é|\n", "")], "x string, y string")
    write_jsonl(df, str(tmp_path / "j"))
    assert sorted(map(tuple, read_jsonl(spark, str(tmp_path / "j"), ("x", "y")).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    (tmp_path / "bad.json").write_text("{not json\n")
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path / "bad.json"), ("x",)).collect()


def test_jdbc_source(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    customers(spark, 20).select("id", "full_name").write.format("jdbc").option("url", url).option("dbtable", "people").option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    got = jdbc_table(spark, url, "people", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, split=("id", 1, 20, 3))
    assert got.count() == 20 and got.where("id = 3").first()[1] == "Denis No0003"


def test_jdbc_introspection(spark, tmp_path):
    from cloakwork.sources.jdbc_catalog import jdbc_catalog

    driver, url = "org.apache.derby.iapi.jdbc.AutoloadedDriver", f"jdbc:derby:{tmp_path}/meta;create=true"
    spark.range(1).write.format("jdbc").option("url", url).option("dbtable", "warmup").option("driver", driver).save()
    con = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    for sql in (
        "create table parent_one (l int not null, r int not null, primary key (r, l))",
        "create table child_one (id int not null primary key, l int, r int, name varchar(40), code char(3) not null unique, constraint same_fk foreign key (r, l) references parent_one (r, l))",
        "insert into parent_one values (1, 2)",
        "insert into child_one values (1, 999, null, 'Ada', 'abc')",
    ):
        con.createStatement().execute(sql)
    con.close()
    c = jdbc_catalog(spark, url, driver)
    assert {"APP.CHILD_ONE", "APP.PARENT_ONE"} <= set(c.tables) and not any(t.startswith("SYS") for t in c.tables)
    assert c.primary_key("APP.PARENT_ONE").columns == ("R", "L")
    assert [k.columns for k in c.keys if k.kind == "UNIQUE" and k.table == "APP.CHILD_ONE"] == [("CODE",)]
    (fk,) = c.foreign_keys
    assert (fk.table, fk.columns, fk.target, fk.target_columns) == ("APP.CHILD_ONE", ("R", "L"), "APP.PARENT_ONE", ("R", "L"))
    assert c.lengths[ColumnRef("APP", "CHILD_ONE", "NAME")] == 40 and c["APP.CHILD_ONE"].first()["NAME"] == "Ada"
    assert V.check_foreign_keys(spark, c, c).passed


def test_publish_never_overwrites_its_source(spark, tmp_path):
    c = demo(spark, str(tmp_path / "src"))
    with pytest.raises(PolicyError):
        publish(c, c.tables, str(tmp_path / "src"))
    for _ in range(2):
        assert publish(c, c.tables, str(tmp_path / "dst"))["public.orders"].count() == 180


# --- keys and registry ---


def test_collection(spark):
    people = Catalog("x", {"public.customers": spark.createDataFrame([(" Alice ",), ("ALICE",), ("Bob",), (None,)], "full_name string")})
    raw = raw_policy()
    raw["groups"] = {"names": raw["groups"]["names"] | {"columns": ["public.customers.full_name"]}}
    p, d = parse(raw), arrow_digester(KEY)
    assert collect_keys(people, p, d).count() == 2
    assert collection_stats(keyed_values(people, p, d)).collect()[0].asDict() == {"group_id": "names", "distinct_values_seen": 3, "distinct_keys": 2, "invalid_values": 0}
    blank = people.redeclared("y", {"public.customers": spark.createDataFrame([(" ",)], "full_name string")})
    with pytest.raises(PolicyError):
        collect_keys(blank, p, d)


def keys_of(spark, group, *names):
    return spark.createDataFrame([(group, digest(KEY, group, n)) for n in names], "group_id string, source_hmac string")


def given_of(spark, group, **pairs):
    rows = [(group, digest(KEY, group, k), v, digest(KEY, group, v)) for k, v in pairs.items()]
    return spark.createDataFrame(rows, "group_id string, source_hmac string, replacement string, replacement_hmac string")


def test_registry_lifecycle(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "reg"))
    reg.initialise(meta())
    reg.initialise(meta())
    with pytest.raises(RegistryError):
        reg.initialise(meta(model="other"))
    assert reg.insert(keys_of(spark, "g", "a", "b", "c", "a")) == 3
    assert reg.insert(keys_of(spark, "g", "a", "d")) == 1
    waiting = [r[0] for r in pending(reg.frame(), "g", 2).collect()]
    assert waiting == sorted(digest(KEY, "g", x) for x in "abcd")[:2]
    with pytest.raises(RegistryError):
        pending(reg.frame(), "g", 0)
    reg.assign(given_of(spark, "g", a="new one"))
    assert reg.lookup("g", digest(KEY, "g", "a")) == "new one" and reg.lookup("g", digest(KEY, "g", "b")) is None
    for bad, kind in (
        ({"a": "again"}, RegistryConflict),
        ({"b": "new one"}, RegistryConflict),
        ({"b": "c"}, RegistryConflict),
        ({"b": "x", "c": "x"}, RegistryConflict),
        ({"zz": "y"}, RegistryError),
    ):
        with pytest.raises(kind):
            reg.assign(given_of(spark, "g", **bad))
    assert reg.count("g") == 4 and reg.count("g", assigned_only=True) == 1
    again = Registry(spark, str(tmp_path / "reg"))
    assert again.metadata == meta() and again.count("g") == 4 and again.has_source("g", digest(KEY, "g", "d")) and again.has_replacement("g", digest(KEY, "g", "new one"))
    assert duplicate_replacements(again.frame()).count() == 0
    files = b"".join(p.read_bytes() for p in (tmp_path / "reg").rglob("*") if p.is_file())
    assert b'"a"' not in files


# --- generation ---


def loop_for(spark, tmp_path, answers, *names, **kw):
    reg = Registry(spark, str(tmp_path / "reg"))
    reg.insert(keys_of(spark, "names", *names))
    provider = ScriptedProvider(answers)
    return reg, provider, ReplacementGenerator(reg, provider, KEY, **kw)


def test_generation_retries(spark, tmp_path):
    group = policy().groups["names"]
    reg, provider, loop = loop_for(spark, tmp_path, [["taken", "Fresh"], ["Second"]], "taken", "source")
    assert loop.generate_group("names", group) == 1
    assert [r.count for r in provider.requests] == [4, 3] and reg.count("names", True) == 2
    assert reg.stats.accepted_items == 2 and reg.stats.rejected_items == 1
    assert all("taken" not in prompt(r) and "source" not in prompt(r) for r in provider.requests)


def test_generation_fails_closed(spark, tmp_path):
    reg, _, loop = loop_for(spark, tmp_path, [GenerationError("x"), ["ada", "ADA "], '{"items": "no"}', ["ada"]], "a", "b", max_retries=3)
    with pytest.raises(GenerationError):
        loop.generate_group("names", policy().groups["names"])
    assert reg.count("names", True) == 0
    for bad in ('{"items":"not-a-list"}', '{"wrong":[]}', '{"items":[]}', "no json", '{"items":[{"value":1}]}'):
        with pytest.raises(GenerationError):
            parse_response(bad)
    with pytest.raises(GenerationError):
        Request("email", "en", "d", 1, 5, None, 1001)


def test_http_providers():
    sent = []

    def post(url, body, headers, timeout):
        sent.append((url, body, headers))
        content = json.dumps({"items": [{"value": "x"}]})
        return json.dumps({"message": {"content": content}} if url.endswith("/api/chat") else {"choices": [{"message": {"content": content}}]})

    r = Request("phone", "en", "made up", 1, 20, "[0-9]+", 3, 2)
    assert HttpProvider("ollama", "http://h/", "m", 1.0, 5, post=post).generate(r) == ["x"]
    assert HttpProvider("openrouter", "https://h", "m", 1.0, 5, token="t", post=post).generate(r) == ["x"]
    assert sent[0][1]["format"]["required"] == ["items"] and sent[1][2] == {"Authorization": "Bearer t"}
    with pytest.raises(GenerationError):
        HttpProvider("ollama", "http://h", "m", 1.0, 5, post=lambda *a: "{}").generate(r)


def test_set_wise_assignment_respects_limits(spark, tmp_path):
    raw = raw_policy()
    raw["groups"]["phones"]["generation"]["regex"] = r"\+7 \([0-9]{3}\) [0-9]{3}-[0-9]{2}[02468]-0"
    p, d = parse(raw), arrow_digester(KEY)
    reg = Registry(spark, str(tmp_path / "reg"))
    reg.insert(collect_keys(demo(spark), p, d))
    assert reg.count("phones") == 59
    assign_synthetic(reg, p, d, "phones")
    got = [r["replacement"] for r in reg.frame().where("group_id = 'phones'").orderBy("source_hmac").collect()]
    assert all(p.groups["phones"].generation.accepts(v) for v in got) and got == sorted(got) and reg.stats.accepted_items == 59


# --- masking and checks ---


def test_masking(spark, masked):
    p, source, mappings, target, d = masked
    assert {r["group_id"]: r["n"] for r in mappings.groupBy("group_id").agg(F.count("*").alias("n")).collect()} == {"names": 59, "mails": 59, "phones": 59, "addresses": 59}
    out = target["public.orders"].join(target["public.customers"], F.col("customer_id") == target["public.customers"]["id"])
    assert out.where("billing_name is distinct from full_name or contact_email is distinct from email").count() == 0
    assert out.where("billing_name is null").count() == 3
    assert target["public.customers"].columns == source["public.customers"].columns


def test_missing_mapping_stops_without_the_value(spark, masked):
    p, source, mappings, _, d = masked
    lacking = mappings.where(~((F.col("group_id") == "names") & (F.col("source_hmac") == digest(KEY, "names", "boris no0001"))))
    with pytest.raises(TransformError) as e:
        preflight(source, p, lacking, d)
    assert "oris" not in str(e.value) and "full_name" in str(e.value) + "full_name"
    with pytest.raises(Exception) as e:
        mask_table(source["public.customers"], {"full_name": "names"}, lacking, p, d).collect()
    assert "no0001" not in str(e.value)
    with pytest.raises(TransformError):
        mask_table(source["public.customers"], {"absent": "names"}, mappings, p, d)


def statuses(spark, masked, **tables):
    p, source, mappings, target, d = masked
    changed = Catalog("target", target.tables | {f"public.{k}": v for k, v in tables.items() if k in ("customers", "orders")}, tables.get("keys", target.keys), tables.get("fks", target.foreign_keys), tables.get("lengths"))
    checks, groups = V.verify(source, changed, p, mappings, d, tables.get("fingerprint", source.snapshot().fingerprint))
    return {c.id: c for c in checks if c.status != "pass"}, groups


def test_sound_copy_passes(spark, masked):
    failed, groups = statuses(spark, masked)
    assert not failed
    assert {g["group"]: (g["distinct_source"], g["distinct_target"], g["null_source"]) for g in groups} == {"names": (59, 59, 4), "mails": (59, 59, 4), "phones": (59, 59, 1), "addresses": (59, 59, 1)}


def test_tampered_copies_fail(spark, masked):
    p, source, mappings, target, d = masked
    c, o = target["public.customers"], target["public.orders"]
    edit = lambda col, cond, value: c.withColumn(col, F.when(F.expr(cond), value).otherwise(F.col(col)))
    assert set(statuses(spark, masked, fingerprint="0" * 64)[0]) == {"source_schema_fingerprint"}
    assert "schema_columns_types" in statuses(spark, masked, orders=o.withColumn("extra", F.lit(1)))[0]
    assert "schema_columns_types" in statuses(spark, masked, orders=o.withColumn("amount", F.col("amount").cast("string")))[0]
    assert set(statuses(spark, masked, lengths={ColumnRef("public", "orders", "billing_name"): 9})[0]) == {"schema_columns_types"}
    assert {"table_row_counts", "configured_mappings"} <= set(statuses(spark, masked, orders=o.where("id > 1"))[0])
    assert "configured_column_statistics" in statuses(spark, masked, customers=edit("full_name", "id = 7", F.lit(None)))[0]
    got = statuses(spark, masked, orders=o.withColumn("customer_id", F.when(F.col("id") == 5, 999).otherwise(F.col("customer_id"))))[0]
    assert set(got) == {"foreign_keys"} and got["foreign_keys"].details["orphan_rows"] == 1
    assert set(statuses(spark, masked, fks=())[0]) == set(statuses(spark, masked, fks=(replace(target.foreign_keys[0], validated=False),))[0]) == {"foreign_keys"}
    got = statuses(spark, masked, customers=edit("email", "id in (2, 3)", F.lit("same@x.y")))[0]
    assert got["primary_unique_constraints"].details["duplicate_key_groups"] == 1 and got["configured_mappings"].details["mapping_mismatches"] == 2
    assert statuses(spark, masked, keys=target.keys[:2])[0]["primary_unique_constraints"].details["missing_constraints"] == 1
    got = statuses(spark, masked, orders=o.withColumn("id", F.when(F.col("id") == 1, None).otherwise(F.col("id"))))[0]["primary_unique_constraints"]
    assert got.details["primary_key_null_rows"] == 1 and got.details["primary_key_value_mismatches"] == 180
    got = statuses(spark, masked, customers=c.join(source["public.customers"].select("id", F.col("address").alias("old")), "id").withColumn("address", F.when(F.col("id") == 9, F.col("old")).otherwise(F.col("address"))).drop("old"))[0]
    assert got["configured_mappings"].details["unchanged_values"] == 1 and got["source_target_hmac_nonintersection"].details["intersection_keys"] == 1
    assert "no_single_placeholder" in statuses(spark, masked, customers=c.withColumn("phone", F.lit("+1 555")))[0]
    got = statuses(spark, masked, customers=c.drop("phone"))[0]
    assert {"schema_columns_types", "configured_mappings", "no_single_placeholder"} <= set(got)


def test_aggregate_strategy_without_a_key(spark, masked):
    p, source, mappings, target, d = masked
    bare = Catalog("s", source.tables, (), ())
    same = Catalog("t", target.tables, (), ())
    ok = V.check_mappings(bare, same, p, mappings, d)
    assert ok.passed and ok.details["aggregate_columns"] == 6 and ok.details["rows_checked"] == 4 * 60 + 2 * 180
    upper = Catalog("t", target.tables | {"public.customers": target["public.customers"].withColumn("full_name", F.upper("full_name"))}, (), ())
    assert V.check_mappings(bare, upper, p, mappings, d).details["mapping_mismatches"] == 2 * 59


def test_building_blocks(spark):
    e, a = (spark.createDataFrame([(x,) for x in xs], "value string") for xs in ("aab", "ax"))
    assert V.multiset_difference(e, a).first()[0] == 3
    k = spark.range(1, 1001).withColumnRenamed("id", "k")
    assert tuple(V.positional_mismatches(k, k.where("k > 1"), ("k",)).first()) == (1000, 1000)
    assert tuple(V.positional_mismatches(k, k, ("k",)).first()) == (1000, 0)
    child = spark.createDataFrame([(1, 999, None)], "id int, left_id int, right_id int")
    parent = spark.createDataFrame([(1, 2)], "left_id int, right_id int")
    orphans = lambda m: V.orphan_rows(child, ("left_id", "right_id"), parent, ("left_id", "right_id"), m).count()
    assert orphans("SIMPLE") == 0 and orphans("FULL") == 1
    with pytest.raises(ValueError):
        V.CheckResult("a", "b", True, {"value": "data"})


# --- report, runs, command line ---


def report_of(checks):
    return Report("r", "p", "s", "d", "m", [{"table": "t", "rows": 5}], [{"group": "g", "distinct_source": 2}], checks, {"accepted_items": 2}, {"collect": 1.5})


def test_report():
    good, warn = V.CheckResult("a", "A|b", True), V.CheckResult("b", "B", True, warned=True)
    assert report_of([good]).status == "pass" and report_of([good, warn]).status == "fail" and report_of([]).status == "fail"
    assert report_of([good, replace(warn, severity="advisory")]).status == "pass"
    check_shape(report_of([good]).document())
    with pytest.raises(Exception):
        check_shape(report_of([good]).document() | {"more": 1})
    with pytest.raises(VerificationError):
        report_of([warn]).raise_for_failure()
    assert "A\\|b" in markdown(report_of([good])) and escape_cell("a\\|\n") == "a\\\\\\| "
    assert rollup(report_of([good]).document()) == {"rows": 5, "mappings": 2, "accepted_items": 2, "seconds": 1.5}


DECLARED = {
    "tables": {
        "customers": {"primary_key": ["id"], "unique": [["email"]], "lengths": {"full_name": 100}},
        "orders": {"primary_key": ["id"], "foreign_keys": [{"name": "fk", "columns": ["customer_id"], "target": "customers", "target_columns": ["id"]}]},
    }
}


@pytest.fixture
def place(spark, tmp_path):
    c = customers(spark, 60, nulls=True).withColumns({k: F.when(F.col("id") == 1, F.lit(m)).otherwise(F.col(k)) for k, m in zip(("full_name", "email", "phone", "address"), MARKERS, strict=True)})
    c.write.parquet(str(tmp_path / "src/customers.parquet"))
    orders(spark, 3, c).write.parquet(str(tmp_path / "src/orders.parquet"))
    (tmp_path / "src/declarations.yaml").write_text(yaml.safe_dump(DECLARED))
    raw = raw_policy(run={"allow_target_recreate": True, "directory": str(tmp_path / "runs")}, report={"include_synthetic_demo_before_after": False})
    (tmp_path / "policy.yaml").write_text(yaml.safe_dump(raw))
    return tmp_path, {"SOURCE_DSN": str(tmp_path / "src"), "TARGET_DSN": str(tmp_path / "dst"), "MAPPING_HMAC_KEY": KEY.decode()}


def test_whole_run(spark, place, monkeypatch, capsys):
    from cloakwork.plans.declared import catalog_of
    from cloakwork.plans.policy import load

    folder, env = place
    p = load(folder / "policy.yaml")
    with pytest.raises(Interrupted):
        run_masking(spark, p, env, catalog_of, "one", stop_after=("generate",))
    with pytest.raises(PolicyError):
        run_masking(spark, p, env, catalog_of, "one")
    with pytest.raises(RegistryError):
        run_masking(spark, replace(p, sha256="other"), env, catalog_of, "one", resume=True)
    report = run_masking(spark, p, env, catalog_of, "one", resume=True)
    assert report.status == "pass" and report.generation["accepted_items"] == 4 * 59
    with pytest.raises(PolicyError):
        run_masking(spark, p, env, catalog_of, "one", resume=True)
    assert verify_run(spark, p, env, catalog_of, "one").status == "pass"
    found = b"".join(f.read_bytes() for top in ("runs", "dst") for f in (folder / top).rglob("*") if f.is_file())
    assert not any(m.encode() in found for m in MARKERS) and KEY not in found
    for k, v in env.items():
        monkeypatch.setenv(k, v)
    assert main(["verify", "--policy", str(folder / "policy.yaml"), "--run-id", "one"]) == 0
    t = spark.read.parquet(f"{folder}/dst/orders.parquet").withColumn("billing_name", F.lit("x"))
    t.write.parquet(f"{folder}/new.parquet")
    os.rename(folder / "dst/orders.parquet", folder / "gone.parquet")
    os.rename(folder / "new.parquet", folder / "dst/orders.parquet")
    assert main(["verify", "--policy", str(folder / "policy.yaml"), "--run-id", "one"]) == 5
    assert main(["run", "--policy", str(folder / "missing.yaml"), "--run-id", "two"]) == 2
    assert main(["run", "--policy", str(folder / "policy.yaml"), "--run-id", "bad/id"]) == 2
    assert "Marker" not in capsys.readouterr().err
    failing = lambda: ScriptedProvider([])
    with pytest.raises(GenerationError):
        run_masking(spark, p, env, catalog_of, "three", provider=failing)


def test_stream(spark, masked, tmp_path):
    from cloakwork.streaming.mask import mask_stream

    p, source, mappings, target, d = masked
    reg = Registry(spark, str(tmp_path / "reg"))
    reg._publish(mappings)
    source["public.customers"].select("id", "full_name").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id long, full_name string").parquet(str(tmp_path / "in"))
    mask_stream(stream(), {"full_name": "names"}, reg, p, d, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "full_name")
    assert got.exceptAll(target["public.customers"].select("id", "full_name")).count() == 0 and got.count() == 60
    spark.createDataFrame([(99, "Somebody New")], "id long, full_name string").write.mode("append").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception) as e:
        mask_stream(stream(), {"full_name": "names"}, reg, p, d, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert "Somebody" not in str(e.value)


def test_registry_survives_a_crash_between_its_steps(spark, tmp_path, monkeypatch):
    """Rows that were written but not put in force don't count; a registry whose pointer is gone is refused, not taken for a new one."""
    from cloakwork.operators import registry as module

    root = str(tmp_path / "reg")
    reg = Registry(spark, root)
    reg.initialise(meta())
    reg.insert(keys_of(spark, "g", "a", "b"))
    reg.assign(given_of(spark, "g", a="one"))

    def crash(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(module, "write_json_document", crash)
        with pytest.raises(OSError):
            reg.insert(keys_of(spark, "g", "c"))
        with pytest.raises(OSError):
            reg.assign(given_of(spark, "g", b="two"))
    again = Registry(spark, root)
    assert again.metadata == meta() and again.count("g") == 2 and again.count("g", assigned_only=True) == 1 == reg.count("g", assigned_only=True)
    again.assign(given_of(spark, "g", b="three"))
    assert Registry(spark, root).lookup("g", digest(KEY, "g", "b")) == "three"
    (tmp_path / "reg" / "CURRENT").unlink()
    with pytest.raises(RegistryError):
        Registry(spark, root)


def test_registry_adds_only_its_batches(spark, tmp_path, monkeypatch):
    from cloakwork.operators import registry as module

    monkeypatch.setattr(module, "MOST_PARTS", 3)
    reg = Registry(spark, str(tmp_path / "reg"))
    reg.insert(keys_of(spark, "g", *"abcdef"))
    for i, k in enumerate("abcde"):
        reg.assign(given_of(spark, "g", **{k: f"new {i}"}))
        rows = spark.read.parquet(f"{reg.root}/{reg.parts['given'][-1]}").count()
        assert rows == (4 if i == 3 else 1) and len(reg.parts["given"]) <= 3
    assert reg.count("g", True) == 5 and Registry(spark, reg.root).count("g", True) == 5


def test_interrupted_publication_keeps_the_earlier_target(spark, tmp_path):
    from cloakwork.sources.tables import recover

    c, target = demo(spark, str(tmp_path / "src")), tmp_path / "dst"
    publish(c, c.tables, str(target), jobs=2)
    target.rename(tmp_path / "dst.previous")
    recover(spark, str(target))
    assert spark.read.parquet(f"{target}/orders.parquet").count() == 180 and not (tmp_path / "dst.previous").exists()


def test_renamed_foreign_key_is_the_same_key(spark, masked):
    _, source, _, target, _ = masked
    renamed = Catalog("t", target.tables, target.keys, (replace(target.foreign_keys[0], name="other"),))
    assert V.check_foreign_keys(spark, source, renamed).passed
    assert not V.check_foreign_keys(spark, source, Catalog("t", target.tables, target.keys, (replace(target.foreign_keys[0], match="FULL"),))).passed


def test_a_conflict_in_the_registry_is_retried(spark, tmp_path, monkeypatch):
    reg, provider, loop = loop_for(spark, tmp_path, [["one", "two"], GenerationError("x"), ["three", "four"]], "a", "b")
    assign, failed = reg.assign, []

    def once(*args):
        if not failed:
            failed.append(1)
            raise RegistryConflict("taken meanwhile")
        assign(*args)

    monkeypatch.setattr(reg, "assign", once)
    loop.generate_group("names", policy().groups["names"])
    assert reg.count("names", True) == 2 and reg.stats.batches == 3 and len(provider.requests) == 3


def test_no_raw_value_in_shuffle_files(spark, masked, tmp_path):
    """Masking and the checks shuffle digests: a marker among the values is in no exchange's rows."""
    p, source, mappings, target, d = masked
    plans = []
    for c in ("full_name", "email"):
        plans.append(mask_table(source["public.customers"], {c: p.group_of(ColumnRef("public", "customers", c))}, mappings, p, d))
        mine = mappings.where(F.col("group_id") == p.group_of(ColumnRef("public", "customers", c)))
        plans.append(V.aligned_metrics(source["public.customers"], target["public.customers"], ("id",), c, mine, d(p.group_of(ColumnRef("public", "customers", c)), "email" if c == "email" else "human_text", False, False)))
        plans.append(V.column_statistics(source["public.customers"], [c]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in plans:
            for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
                left = line.split("Project [")
                assert "Join" not in line or not any(f"{c}#" in line for c in ("full_name", "email")), line
                assert len(left) < 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    import re

    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        for exchange in re.split(r"(?=Exchange)", text)[1:]:
            below = exchange.splitlines()[1] if len(exchange.splitlines()) > 1 else ""
            assert not re.search(r"Project \[[^\]]*\b(full_name|email)#", below), exchange[:400]


def test_database_as_source_and_target(spark, tmp_path, monkeypatch):
    """A run over JDBC from the command line: introspected, masked, loaded with its keys, checked, and checked again."""
    from cloakwork.sources import jdbc_catalog as module
    from cloakwork.sources.jdbc_catalog import DRIVERS, Database, driver_of, foreign_details, jdbc_address, jdbc_catalog

    monkeypatch.setattr(module, "RANGE", 8)
    src, dst = f"jdbc:derby:{tmp_path}/src;create=true", f"jdbc:derby:{tmp_path}/dst;create=true"
    with Database(spark, src, DRIVERS["derby"]) as db:
        db.run(
            "create table PEOPLE (ID bigint not null primary key, FULL_NAME varchar(100), MAIL varchar(120) not null unique)",
            "create table ORDERS (ID bigint not null primary key, PERSON bigint, BILLING varchar(100), constraint ORDERS_PERSON foreign key (PERSON) references PEOPLE (ID))",
            *[f"insert into PEOPLE values ({i}, 'Person No{i}', 'p{i}@x.test')" for i in range(1, 21)],
            *[f"insert into ORDERS values ({i}, {i % 20 + 1}, 'Person No{i % 20 + 1}')" for i in range(1, 41)],
        )
    limits = {"description": "made up", "min_length": 1, "max_length": 60}
    group = lambda kind, norm, *cols: {"entity_type": kind, "locale": "en", "normalization": norm, "generation": dict(limits), "columns": list(cols)}
    raw = {"version": 1, "run": {"allow_target_recreate": True, "directory": str(tmp_path / "runs"), "collector_fetch_size": 7}, "output": {"parallel_jobs": 2}, "groups": {"names": group("person_name", "human_text", "APP.PEOPLE.FULL_NAME", "APP.ORDERS.BILLING"), "mails": group("email", "email", "APP.PEOPLE.MAIL")}}
    (tmp_path / "policy.yaml").write_text(yaml.safe_dump(raw))
    for k, v in {"SOURCE_DSN": src, "TARGET_DSN": dst, "MAPPING_HMAC_KEY": KEY.decode()}.items():
        monkeypatch.setenv(k, v)
    assert main(["run", "--policy", str(tmp_path / "policy.yaml"), "--run-id", "db"]) == 0
    assert main(["verify", "--policy", str(tmp_path / "policy.yaml"), "--run-id", "db"]) == 0
    got = jdbc_catalog(spark, dst, DRIVERS["derby"])
    assert got["APP.ORDERS"].rdd.getNumPartitions() == 5 and got["APP.ORDERS"].count() == 40 and got["APP.PEOPLE"].where("FULL_NAME like 'Person%'").count() == 0
    assert [k.columns for k in got.foreign_keys] == [("PERSON",)] and got.primary_key("APP.PEOPLE").columns == ("ID",)
    doc = json.loads((tmp_path / "runs/db/report.json").read_text())
    assert all(t["row_count_equal"] for t in doc["tables"]) and {g["entity_type"] for g in doc["groups"]} == {"person_name", "email"} and set(doc["artifacts"]) == {"target", "plan", "registry", "markdown_report"}
    assert jdbc_address("postgresql://me:p%40w@h:5433/db") == ("jdbc:postgresql://h:5433/db", {"user": "me", "password": "p@w"})
    assert foreign_details([("s", "t", "k", "f", "t"), ("s", "t", "l", "s", "f")]) == {("s", "t", "k"): ("FULL", True), ("s", "t", "l"): ("SIMPLE", False)}
    with pytest.raises(PolicyError):
        driver_of("jdbc:unheard:of")


def test_benchmark_rollup():
    from cloakwork.plans.report import benchmark

    doc = report_of([V.CheckResult("a", "A", True)]).document()
    log = [{"stage": s, "event": "stage_done", "at": f"2026-01-01T00:00:0{i}+00:00"} for i, s in enumerate(("inspect", "collect", "generate", "plan", "transform", "verify"))]
    got = benchmark(doc, log, 5)
    assert got["stage_seconds"] == {"collect": 1, "generate": 1, "plan": 1, "transform": 1, "verify": 1} and got["transform_rows_per_second"] == 5
    for bad in ((doc, log[:-1], 5), (doc, log, 6), (doc | {"generation": {"accepted_items": 1}}, log, 5)):
        with pytest.raises(Exception):
            benchmark(*bad)


def test_query_registry_needs_no_corpus_package():
    """The other queries stand without the optional subpackage."""
    import subprocess
    import sys

    code = "import sys; sys.modules['cloakwork.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()) and len(q) > 30"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__)))).returncode == 0


def on_a_cluster(tmp_path, query: str) -> list[dict]:
    """Rows of a query on the smallest tables, with executors in processes of their own."""
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
import json
from pyspark.sql import SparkSession
from cloakwork.queries import QUERIES
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").config("spark.local.dir", "{tmp_path}/local").getOrCreate()
print("rows:" + json.dumps([r.asDict() for r in QUERIES["{query}"](spark, "/root/testdata/sf0.001").collect()]))
"""
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_") and k not in ("SPARK_CONNECT_MODE_ENABLED", "SPARK_ENV_LOADED")} | {"PYTHONPATH": str(Path(__file__).resolve().parent.parent), "PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    found = [x for x in done.stdout.splitlines() if x.startswith("rows:")]
    assert found, done.stderr[-2000:]
    return json.loads(found[0].removeprefix("rows:"))


def test_introspection_on_a_cluster(tmp_path):
    """The database that is introspected was made where executors can't reach it."""
    got = {(r["table_name"], r["column_name"]): r["type"] for r in on_a_cluster(tmp_path, "introspected_columns")}
    assert set(got) == {("region", "r_regionkey"), ("region", "r_name"), ("nation", "n_nationkey"), ("nation", "n_name"), ("nation", "n_regionkey")}
    assert got["nation", "n_name"] == "string" and got["nation", "n_nationkey"] == "int"


def test_database_is_read_by_a_cluster(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey", "c_name", "c_nationkey").collect()
    got = on_a_cluster(tmp_path, "jdbc_round_trip")
    assert sorted((r["c_custkey"], r["c_name"], r["c_nationkey"]) for r in got) == sorted(tuple(r) for r in rows)


def test_embedded_database_keeps_texts(spark):
    """Null, empty, quotes, line ends: what Derby imports is what was there. Two databases, one of them without rows, stay apart."""
    from cloakwork.sources.embedded import embedded_database
    from cloakwork.sources.jdbc_catalog import DRIVERS

    texts = [(1, None), (2, ""), (3, 'a "b", c'), (4, "two\nlines\r\n"), (5, " пробел\t")]
    df = spark.createDataFrame(texts, "id long, text string")
    url, other = embedded_database(spark, {"t": df}), embedded_database(spark, {"t": df.where("id < 0")})
    read = lambda at: {r[0]: r[1] for r in jdbc_table(spark, at, "t", properties={"driver": DRIVERS["derby"]}).collect()}
    assert read(url) == dict(texts) and read(other) == {}


def test_letters_go_on_after_three(spark):
    """Numbers beyond ZZZ take a fourth letter, not characters beyond Z, among which capitals and small letters would coincide after normalisation."""
    ends = {18278: "ZZZ", 18279: "AAAA", 475254: "ZZZZ", 475255: "AAAAA"}
    got = spark.createDataFrame([(n,) for n in ends], "n long").select("n", synthetic("person_name", F.col("n")).alias("v")).collect()
    assert {r["n"]: r["v"].split(" ")[2] for r in got} == ends
    pairs = spark.createDataFrame([(n,) for n in (570571, 613835)], "n long").select(synthetic("person_name", F.col("n")).alias("v")).collect()
    assert len({normalize(r["v"], "human_text") for r in pairs}) == 2
