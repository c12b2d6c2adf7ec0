"""The manifest against a plain tree, for several arities and group sizes."""

import hashlib
import random
import zlib

import pytest

from changelake.llm import merkle
from changelake.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_compare import compare, duck_connect


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes, k):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + k]) for i in range(0, len(out[-1]), k)])
    return out


def proof(levels, i, k):
    """(before, after) of each level."""
    steps = []
    for nodes in levels[:-1]:
        lo = i - i % k
        steps.append((nodes[lo:i], nodes[i + 1:lo + k]))
        i //= k
    return steps


def brute(rows, k=2):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    low = -(1 << 70)
    trees = {g: sorted(((low if r[0] is None else r[0], leaf(r), r) for r in rows if r[2] == g), key=lambda x: x[:2]) for g in langs}
    built = {g: levels_of([x[1] for x in t], k) for g, t in trees.items()}
    top = levels_of([built[g][-1][0] for g in langs], k) if langs else []
    out = []
    for at, g in enumerate(langs):
        for i, (_, h, r) in enumerate(trees[g]):
            steps = proof(built[g], i, k) + proof(top, at, k)
            f = h
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 0 and r[3] is not None:
                f = leaf((*r[:3], r[3] + 1, r[4]))
            for b, a in steps:
                f = H(*b, f, *a)
            root = top[-1][0]
            out.append((r[0], h, built[g][-1][0], root, H(*[x for b, a in steps for x in b + a]), f, f == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = brute(rows)
    assert got(QUERIES["op13_merkle_manifest"](spark, sf_dir)) == want
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_query_equals_sql(spark, sf_dir):
    problems, n, _, _, _ = compare(spark, duck_connect(sf_dir), "op13_merkle_manifest", QUERIES["op13_merkle_manifest"],
                                   ORACLE_SQL["op13_merkle_manifest"], sf_dir)
    assert not problems and n


@pytest.mark.parametrize("arity,sizes", [(2, [1, 2, 3, 17, 64]), (2, [1]), (2, [5]), (3, [1, 3, 4, 10, 29]), (4, [2, 16, 21]), (5, [1, 1, 1, 1, 1, 1, 7])])
def test_arities_and_sizes(spark, arity, sizes):
    rng = random.Random(arity)
    langs = [None, "", "a", "é", "zz", "Z", "😀"]
    rows = [(rng.randrange(10**6), rng.choice([None, "s"]), langs[g], rng.choice([None, 4]), rng.choice([None, "", "é" * 5, "x"]))
            for g, n in enumerate(sizes) for _ in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(merkle.document_manifest(df, arity)) == brute(rows, arity)


def test_nulls_repeats_clashes_long_texts_and_empty(spark):
    rows = [(None, None, None, None, None), (None, "", "", 0, ""), (1, "s", "en", 2**63 - 1, "x" * 1_000_000), (1, "s", "en", 5, "dup"),
            (1, "s", "en", 5, "dup"), (1, "s", "en", 5, "dup"), (8, "a.b", "en", -3, "1:-"), (9, "s", None, 9, "t"), (5, "-", "de", 1, "-")]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA + ", i int, h string, steps string")
    assert got(merkle.document_manifest(df)) == brute(rows)
    assert merkle.document_manifest(df.limit(0)).count() == 0


def test_hot_equal_rows_are_numbered_without_gaps(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 40)) as g", "if(id % 3 = 0, 1, id) as k")
    out = merkle.number_rows(df, "g", ["k"], slices=16).collect()
    by = {}
    for r in out:
        by.setdefault(r["g"], []).append((r["i"], r["k"], r["n"]))
    assert len(out) == 3000
    for rows in by.values():
        rows.sort()
        assert [i for i, _, _ in rows] == list(range(len(rows))) and {n for _, _, n in rows} == {len(rows)}
        assert [k for _, k, _ in rows] == sorted(k for _, k, _ in rows)


def test_siblings_are_joined_by_index_and_no_text_is_shuffled(spark, sf_dir):
    nodes = spark.range(10).selectExpr("'' as g", "id as i", "10L as n", "sha2(string(id), 256) as h")
    plan = merkle.with_siblings(nodes, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "^ 1" in plan
    assert merkle.with_siblings(nodes, 4)._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 3
