"""Patterns against like over all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from changelake.operators import ingest_rules, patterns
from changelake.plans import registry


def like(name, pattern):
    return re.fullmatch(".*".join(map(re.escape, pattern.split("%"))), name, re.S) is not None


@pytest.mark.parametrize("seed", range(4))
def test_selection_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    word = lambda n, alphabet: "".join(rng.choice(alphabet) for _ in range(rng.randint(0, n)))
    names = sorted({(word(3, "ab_"), word(5, "ab_\\.")) for _ in range(150)})
    rules = [(rng.choice(["include", "include", "exclude"]), word(3, "ab_%"), word(4, "ab_%\\")) for _ in range(25)]
    rules += [("include", "%", "%a"), ("include", "a%b", "%"), ("exclude", None, "%"), ("other", "%", "%")]
    want = sorted(n for n in names if any(a == "include" and s is not None and like(n[0], s) and like(n[1], t) for a, s, t in rules)
                  and not any(a == "exclude" and s is not None and like(n[0], s) and like(n[1], t) for a, s, t in rules))
    got = patterns.wildcard_selection(spark.createDataFrame(names, "schema string, table string"),
                                      spark.createDataFrame(rules, "action string, schema string, table string"))
    assert sorted(tuple(r) for r in got.collect()) == want
    none = spark.createDataFrame([], "action string, schema string, table string")
    assert patterns.wildcard_selection(spark.createDataFrame(names, "schema string, table string"), none).count() == 0


def test_names_meet_patterns_by_keys_only(spark):
    names = spark.createDataFrame([("s", "t")], "schema string, table string")
    rules = spark.createDataFrame([("include", "s", "t%")], "action string, schema string, table string")
    plan = patterns.wildcard_selection(names, rules)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_plan_of_patterns_applies_like_one_of_names(spark):
    cols = "database string, rule_action string, table_name string, column_name string, value string, rule_id int"
    plan = spark.createDataFrame([
        ("d%", "include", "T%", None, None, 1), ("d1", "exclude", "%_tmp", None, None, 2), ("d%", "convert-lowercase", "Ta", None, None, 3),
        ("%", "remove-column", "T%", "secret", None, 4), ("d1", "include", "Ta", None, None, 5), ("d1", "rename", None, None, "d1", 6)], cols)
    names = spark.createDataFrame([("d1", "Ta"), ("d1", "T_tmp"), ("d2", "Tb"), ("e", "Ta")], "database string, table string")
    out = patterns.expand_plan(plan, names)
    assert sorted(((r.database, r.table_name or "", r.rule_action) for r in out.collect())) == [
        ("d1", "", "rename"), ("d1", "Ta", "convert-lowercase"), ("d1", "Ta", "include"), ("d1", "Ta", "remove-column"),
        ("d2", "Tb", "include"), ("d2", "Tb", "remove-column"), ("e", "Ta", "remove-column")]
    rows = spark.createDataFrame([(d, t, 1, "x") for d, t in (("d1", "Ta"), ("d1", "T_tmp"), ("d2", "Tb"), ("e", "Ta"))], "db string, tb string, id int, secret string")
    got = ingest_rules.apply_ingest_plan(rows, out, "db", "tb", F.lit(0), ["id", "secret"])
    assert sorted((r.db, r.target_table, r.secret) for r in got.collect()) == [("d1", "ta", None), ("d2", "Tb", None)]


def test_query_has_both_kinds(spark, sf_dir):
    assert registry.QUERIES["wildcard_selection"](spark, sf_dir).count() > 10


def test_names_meet_only_patterns_that_agree_in_schema_and_table(spark):
    names = spark.createDataFrame([(f"db1{i % 10}", f"T{i}") for i in range(300)], "schema string, table string")
    rules = spark.createDataFrame([("include", "db1%", f"%{i:02d}") for i in range(100)], "action string, schema string, table string")
    patterns_of = rules.select("action", F.col("schema").alias("schema_pattern"), F.col("table").alias("table_pattern"))
    keyed = patterns._keyed_patterns(patterns_of)
    kind, sizes = keyed.select("_kind", keyed.columns[4]).distinct().collect()[0]
    assert patterns._meet(names, keyed, [(kind, sizes)]).count() == 290  # not 300 * 100; ten names have one digit


@pytest.mark.parametrize("few", [0, 3, 50_000])
def test_few_and_many_patterns_give_the_same(spark, monkeypatch, few):
    monkeypatch.setattr(patterns, "FEW_PATTERNS", few)
    names = spark.createDataFrame([("a", "t1"), ("ab", "t12"), ("b", "x"), ("b", "t1")], "schema string, table string")
    rules = spark.createDataFrame([("include", "a%", "%1"), ("include", "a%", "t%2"), ("include", "b", "%"), ("exclude", "%", "x"), ("include", "ab", "zz%")],
                                  "action string, schema string, table string")
    assert sorted(map(tuple, patterns.wildcard_selection(names, rules).collect())) == [("a", "t1"), ("ab", "t12"), ("b", "t1")]
