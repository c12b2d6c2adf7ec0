"""Quality rules against a plain Python count, and the edge rows."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from changelake.llm import quality
from changelake.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_compare import compare, duck_connect


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(wins)
    hit = {i + k for i, g in enumerate(wins) if c[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_query_equals_sql(spark, sf_dir):
    problems, n, _, _, _ = compare(spark, duck_connect(sf_dir), "op4_quality_rules", QUERIES["op4_quality_rules"],
                                   ORACLE_SQL["op4_quality_rules"], sf_dir)
    assert not problems and n


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t#é\x0b\xa0😀", max_size=60)), min_size=1, max_size=30))
def test_counts_equal_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.add_counts(df).collect():
        assert tuple(r[c] for c in COLS) == brute(texts[r["doc_id"]])


def test_nulls_repeats_clashes_and_long_text(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None, "a", 5), (2, "", None, 5), (3, good, None, 5), (3, good, None, 5), (None, good, "a", 5),
            (7, "x " * 200_000, "b", 5)]
    out = quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int"))
    got = sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in out.collect())
    assert got == [(0, 80, True), (1, 0, False), (2, 0, False), (3, 80, True), (3, 80, True), (7, 200_000, False)]
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert quality.quality_verdicts(empty).count() == 0


def test_host_is_rejected_as_a_whole(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, "bad", "junk") for i in range(200)] + [(1000, good, "junk")] + [(2000 + i, good, "fine") for i in range(200)]
    out = quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["doc_id"] for r in out.filter("kept").collect()}
    assert kept == {2000 + i for i in range(200)}
