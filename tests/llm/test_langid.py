"""Language identification: words and paths against plain versions, held-out accuracy, spans of mixed texts."""

import itertools
import random
import zlib

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from changelake.llm import langid
from changelake.llm.queries import QUERIES


def grams(word, k):
    s = "^" + word + "^" if k > 1 else word
    return [s[i:i + k] for i in range(len(s) - k + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abÉ \n'1ßшИ中́İ😀\x00", max_size=30), min_size=1, max_size=5))
def test_words_and_grams_equal_a_plain_reading(texts):
    w = langid.read_words(texts, 4, 1 << 16)
    want = [(k, m.start(), m.end()) for k, t in enumerate(texts) for m in regex.finditer(r"[\p{L}\p{M}]+", t)]
    assert list(zip(w.text.tolist(), w.start.tolist(), w.end.tolist())) == want
    assert w.letters.tolist() == [len(regex.findall(r"\p{L}", texts[k][s:e])) for k, s, e in want]
    ends = [*w.at[1:].tolist(), len(w.grams[0])]
    bucket = {}
    for (k, s, e), lo, hi in zip(want, w.at.tolist(), ends):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in texts[k][s:e])
        for n, g in enumerate(w.grams, 1):
            mine = [x for x in g[lo:hi].tolist() if x < 1 << 16]
            plain = grams(low, n)
            assert len(mine) == len(plain)
            for x, y in zip(mine, plain):  # equal n-grams, equal buckets
                assert bucket.setdefault((n, y), x) == x


def plain_path(s, cost):
    best = list(s[0])
    back = []
    for row in s[1:]:
        back.append([max(range(len(row)), key=lambda a: best[a] - (cost if a != b else 0)) for b in range(len(row))])
        best = [max(best[a] - (cost if a != b else 0) for a in range(len(row))) + row[b] for b in range(len(row))]
    return max(best)


def worth(s, path, cost):
    return sum(r[k] for r, k in zip(s, path)) - cost * int((np.diff(path) != 0).sum())


@pytest.mark.parametrize("seed", range(20))
def test_paths_are_best_with_and_without_the_walk(seed):
    rng = np.random.default_rng(seed)
    n_lang, cost = int(rng.integers(1, 5)), 3.0
    model = langid.LangModel([f"l{k}" for k in range(n_lang)], np.zeros((3, n_lang), np.float32), np.zeros(n_lang, np.uint64), langid.LangParams(switch=cost))
    sizes = rng.integers(0, 30, 12)
    scores = rng.normal(0, 2, (sizes.sum(), n_lang))
    # some texts with a clear language, some with one at a time
    for k, b in enumerate(np.cumsum(sizes) - sizes):
        if k % 3 == 0:
            scores[b:b + sizes[k], 0] += 4
        elif k % 3 == 1:
            scores[b:b + sizes[k] // 2, -1] += 3
    path = model.paths(scores, sizes)
    for b, n in zip(np.cumsum(sizes) - sizes, sizes):
        if n:
            assert abs(worth(scores[b:b + n], path[b:b + n], cost) - plain_path(scores[b:b + n].tolist(), cost)) < 1e-9
    if n_lang == 2:
        k = int(np.flatnonzero((sizes > 0) & (sizes < 12))[0]) if ((sizes > 0) & (sizes < 12)).any() else None
        if k is not None:
            b = int((np.cumsum(sizes) - sizes)[k])
            s = scores[b:b + sizes[k]]
            assert abs(max(worth(s, np.array(p), cost) for p in itertools.product(range(2), repeat=len(s))) - worth(s, path[b:b + sizes[k]], cost)) < 1e-9


def test_query_and_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()
    got = QUERIES["op11_language_id"](spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    got = {r["doc_id"]: r for r in got.collect()}
    assert got.keys() == {r["doc_id"] for r in rows}
    for r in got.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in rows if got[r["doc_id"]]["held_out"]]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert len(held) > 250 and right >= 0.99 * len(held)


def test_columns_that_are_not_text_do_not_matter(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(df)
    a = langid.label_documents(df, model).select("doc_id", "lang_pred", "score").collect()
    b = langid.label_documents(df.selectExpr("doc_id", "text", "'zz' as lang", "'x' as source"), model).select("doc_id", "lang_pred", "score").collect()
    assert sorted(a) == sorted(b)


def test_spans_of_mixed_texts(spark, sf_dir):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 600").select("doc_id", "lang", "text").collect()
    df = spark.createDataFrame(rows)
    model = langid.fit(df)
    rng = random.Random(1)
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r["text"].split())
    letters = hit = 0
    for _ in range(60):
        parts = []
        for lang in rng.sample(sorted(by), 3):
            t = rng.choice([x for x in by[lang] if len(x) > 80])
            at = rng.randrange(len(t) - 60)
            parts.append((lang, " ".join(t[at:at + 50])))
        text, truth = "", []
        for lang, part in parts:
            truth += [lang] * len(part) + [None]
            text += part + " "
        _, _, spans = model.label([text])[0]
        assert all(a["end"] <= b["start"] for a, b in zip(spans, spans[1:]))
        for s in spans:
            for i in range(s["start"], s["end"]):
                if text[i].isalpha():
                    letters += 1
                    hit += truth[i] == s["lang"]
    assert hit >= 0.95 * letters


def test_scripts_narrow_the_candidates(spark):
    rows = [("en", "the cat sat on the mat and the dog ran"), ("ru", "кошка сидела на коврике и собака бежала"), ("el", "η γάτα κάθισε στο χαλί"),
            ("uk", "кішка сиділа на килимку і собака бігла"), ("zh", "猫坐在垫子上")] * 3
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    out = model.label(["собака бежала", "собака бігла і", "dog mat", "γάτα", "在垫子上猫", "the dog ran on the mat and собака сидела на коврике и бежала", "ابت", "123 !?", ""])
    assert [x[0] for x in out[:5]] == ["ru", "uk", "en", "el", "zh"]
    assert [(s["lang"], s["start"], s["end"]) for s in out[5][2]] == [("en", 0, 26), ("ru", 27, 27 + 33)]
    assert out[6][0] in {r[0] for r in rows}  # a script nobody uses leaves all languages
    assert out[7:] == [("und", 0.0, [])] * 2


def test_pools_and_pieces_change_nothing(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    small, large = langid.LangParams(pool=3000), langid.LangParams()
    a = {r["doc_id"]: (r["lang_pred"], round(r["score"], 6), r["spans"]) for r in langid.identify(df, small).collect()}
    b = {r["doc_id"]: (r["lang_pred"], round(r["score"], 6), r["spans"]) for r in langid.identify(df.repartition(3), large).collect()}
    assert a == b


def test_nulls_repeats_clashes_long_texts_and_empty(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "77 --", None), (None, "the cat", "en"), (5, "the cat sat", "en"), (5, "the cat sat", "en"),
            (6, "le chat", None), (7, "le chat est la", "fr"), (8, "le chat " * 200_000, "fr"), (10, "x" * 2_500_000, ""), (11, None, None)]
    df = spark.createDataFrame([(i, t, g, 1, "s") for i, t, g in rows], "doc_id long, text string, lang string, spans int, lang_pred string")
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] in (1, 2, 3, 11):
            assert (r["lang_pred"], r["score"], r["spans"]) == ("und", 0.0, [])
        else:
            assert r["lang_pred"] in ("en", "fr", "") and 0 < r["score"] <= 1
    assert langid.identify(df.limit(0)).count() == 0
    untaught = langid.identify(df.withColumn("lang", df["lang"].substr(100, 1).cast("string")).selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}
    with pytest.raises(ValueError):
        langid.fit(df, langid.LangParams(max_languages=1))
