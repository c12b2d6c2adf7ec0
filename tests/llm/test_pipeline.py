"""The pipeline stage by stage against plain Python versions of what each stage decides."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from changelake.llm import toxicity
from changelake.llm.queries import tokenizer_file
from changelake.session import materialize, read_table
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_neardup import brute as near


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def cut(rows, n_bytes, n_words):
    """The texts without what strings of n_bytes bytes cover that start twice, or strings of n_words words in fewer bytes that occur twice."""
    texts = [(t or "").encode() for _, t in rows]
    spans = []
    for t in texts:
        words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]
        short = [(a[0], b[1]) for a, b in zip(words, words[n_words - 1:]) if b[1] - a[0] < n_bytes]
        spans.append([(i, i + n_bytes) for i in range(len(t) - n_bytes + 1)] + short)
    seen = Counter(t[a:b] for t, s in zip(texts, spans) for a, b in s)
    out = []
    for t, s in zip(texts, spans):
        gone = bytearray(len(t))
        for a, b in s:
            if seen[t[a:b]] > 1:
                gone[a:b] = b"\x01" * (b - a)
        out.append(bytes(c for c, g in zip(t, gone) if not g).decode(errors="ignore"))
    return out


def test_stages_and_run(spark, sf_dir):
    from changelake.llm import decontamination as dec

    docs = read_table(spark, sf_dir, "documents")
    columns = docs.columns
    out, frames = docs, []
    for _, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, out, sf_dir), "test")
        frames.append(out)
    assert all(f.columns == columns for f in frames[:-1])
    before = [docs, *frames]
    got = [rows_of(f) for f in before[:-1]]
    # toxicity: what the operator rejects goes
    rejected = {r["doc_id"] for r in toxicity.toxicity_scores(docs, read_table(spark, sf_dir, "labels")).filter("predicted = 1").collect()}
    assert got[1] == [r for r in got[0] if r[0] not in rejected]
    kept = {i for i, _, _, k in near(got[1], 5) if k}
    assert len(kept) < len(got[1]) and got[2] == [r for r in got[1] if r[0] in kept]
    want = cut(got[2], 240, 51)
    assert want != [t for _, t in got[2]] and want != cut(got[2], 240, 10**9)  # both rules cut something
    assert got[3] == [(i, t) for (i, _), t in zip(got[2], want)]
    assert all(r["n_chars"] == len(r["text"]) for r in frames[2].collect())
    items = [(r["item_id"], r["text"]) for r in read_table(spark, sf_dir, "benchmark").collect()]
    assert got[4] == [r for r in got[3] if not leaks(r[1], items, dec.LeakParams())]
    lib = Tokenizer.from_file(tokenizer_file())
    texts = dict(got[4])
    last = frames[4].collect()
    assert len(last) == len(got[4])
    for r in last:
        ids = lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(r["doc_id"] for r in last)


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows_and_empty_tables(spark, sf_dir, k):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c", "x", "y", 5), (3, "same text here", "e", "s", 1),
            (3, "same text here", "e", "s", 1), (4, "é" * 400, "e", "s", 400), (5, "x" + "é" * 400, "e", "s", 401)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.STAGES[k][1](spark, df, sf_dir)
    assert {r["doc_id"] for r in out.collect()} >= {1, 2, None, 3}
    assert corpus_pipeline.STAGES[k][1](spark, df.limit(0), sf_dir).count() == 0


def test_repeats_of_51_short_words_are_cut(spark, sf_dir):
    passage = " ".join(f"{c}{d}" for c in "abcde" for d in "abcdefghijk")[:51 * 3 - 1]  # 152 bytes
    assert len(passage.split()) == 51
    fifty = passage.replace("a", "z").rsplit(" ", 1)[0]
    rows = [(i, f"start{i} {passage} end{i}") for i in range(3)] + [(9, f"one {fifty} two"), (10, f"three {fifty} four"), (11, None), (12, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["suffix_array_dedup"](spark, df, sf_dir).collect()}
    assert got == {**{i: f"start{i}  end{i}" for i in range(3)}, 9: rows[3][1], 10: rows[4][1], 11: "", 12: ""}
