"""Periodic runs against brute force over all lags."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changelake.llm import periods
from changelake.llm.queries import QUERIES


def brute_runs(w, least=12):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, text):
    w = words_of(text)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute(doc_id, w):
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    # the plain version takes every lag of every text, so whole rows only up to 3,000 words
    want = {i: brute(i, w) for i, w in ((i, planted(i, t)) for i, t in rows) if len(w) <= 3000}
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()]
    assert len(got) == len(rows) and len(want) > 0.9 * len(rows)
    assert {r[0]: r for r in got if r[0] in want} == want
    assert sum(r[1] > 0 for r in want.values()) > 10


def find(docs, least=12, pool=10**9):
    return periods.RunFinder(docs, periods.RunParams(min_length=least, pool=pool)).runs()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4), st.integers(2, 15))
def test_random_words(docs, least):
    assert find(docs, least) == [brute_runs(d, least) for d in docs]


@pytest.mark.parametrize("seed", range(60))
def test_texts_made_of_repeats(seed):
    """Repeats of repeats, cut anywhere, with single words changed: nested periods meet at all borders."""
    rng = random.Random(seed)
    docs = []
    for _ in range(4):
        d = [rng.randrange(3) for _ in range(rng.randint(1, 5))]
        while len(d) < 250:
            kind = rng.randrange(4)
            if kind == 0:
                d = (d * rng.randint(2, 5))[:rng.randint(len(d), 5 * len(d))]
            elif kind == 1:
                d = d + [rng.randrange(4) for _ in range(rng.randint(1, 6))]
            elif kind == 2:
                d = d + d[rng.randrange(len(d)):]
            else:
                d = d + d[::-1]
                d[rng.randrange(len(d))] = rng.randrange(4)
        docs.append(d[:400])
    assert find(docs) == [brute_runs(d) for d in docs]


def test_two_stretches_of_one_small_period():
    docs = [[0, 1] * 20 + [1, 0] * 20, [0] * 30 + [1] + [0] * 30 + [1] + [0] * 29, ([0] * 9 + [1]) * 9 + [0] * 50, [0, 0, 1] * 15 + [0, 1, 0] * 15]
    assert find(docs) == [brute_runs(d) for d in docs]


def test_fibonacci_and_thue_morse_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    t = [bin(i).count("1") % 2 for i in range(1500)]
    assert find([b, t]) == [brute_runs(b), brute_runs(t)]


def test_long_uniform_text_is_quick():
    docs = [[0] * 300_000, [0, 1] * 150_000, list(range(300_000)), list(range(100_000)) * 2]
    assert find(docs) == [[(0, 300_000, 1)], [(0, 300_000, 2)], [], [(0, 200_000, 100_000)]]


def test_collapse_keeps_what_stands_outside_and_the_first_period():
    w = [b"%d" % i for i in range(3)] + [b"a", b"b"] * 6 + [b"z"]
    runs = [(3, 12, 2)]
    assert periods.collapse(w, runs) == b"0 1 2 a b z"


def test_nulls_repeats_clashes_and_pools(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "x " * 40), (4, "x " * 40), (None, "a b " * 9), (6, "é b \x0bc\r" * 30), (7, "A a " * 6), (8, "A b " * 5)]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, runs int, n_words string")
    for pool in (1, 10**9):
        found = periods.periodic_runs(df, periods.RunParams(pool=pool))
        got = sorted((tuple(r) for r in periods.run_digest(found).collect()), key=str)
        assert got == sorted((brute(i, words_of(t)) for i, t in rows), key=str)
    spread = periods.plant_runs(df.repartition(2))
    got = sorted((tuple(r) for r in periods.run_digest(periods.periodic_runs(spread)).collect()), key=str)
    assert got == sorted((brute(i, planted(i, t)) for i, t in rows), key=str)
    assert periods.periodic_runs(df.limit(0)).count() == 0
