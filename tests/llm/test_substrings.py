"""Removal of repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from changelake.llm import substrings
from changelake.llm.queries import QUERIES


def brute(rows, n):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = b"\x01" * n
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        keep = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(keep).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op5_suffix_array_dedup"](spark, sf_dir)) == brute(rows, 400)


@pytest.mark.parametrize("seed,length", [(1, 20), (2, 21), (3, 30)])
def test_random_texts(spark, seed, length):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abé") for _ in range(rng.randint(length - 3, 4 * length))) for _ in range(6)]
    rows = []
    for i in range(60):
        t = "".join(rng.choice([rng.choice(passages), "".join(rng.choice("abcdé") for _ in range(rng.randint(0, 25)))]) for _ in range(rng.randint(0, 5)))
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, "ab" * 40), (None, "x" * 50), (103, rows[5][1]), (5, rows[5][1]), (104, "abc" * 13)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, tid string")
    p = substrings.RepeatParams(length=length, seed=7, piece=4, slice=64)
    assert got(substrings.removal_digest(df, p)) == brute(rows, length)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.removal_digest(df).count() == 0
