"""The HMM against a plain forward recursion; counts, base scores and held-out gain."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np

from changelake.llm import hmm
from changelake.llm.queries import QUERIES


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def model(p, seed=0):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return hmm.Hmm(norm(rng.random(p.states), 0), norm(rng.random((p.states, p.states)), 1), norm(rng.random((p.symbols, p.states)), 0))


def plain(m, seq):
    total = 0.0
    for path in itertools.product(range(len(m.start)), repeat=len(seq)):
        x = m.start[path[0]] * m.emit[seq[0], path[0]]
        for t in range(1, len(seq)):
            x *= m.move[path[t - 1], path[t]] * m.emit[seq[t], path[t]]
        total += x
    return total


P = hmm.HmmParams(states=3, symbols=8)


def test_likelihood_equals_the_sum_over_all_paths():
    m, rng = model(P), np.random.default_rng(1)
    seqs = [rng.integers(0, 8, n).astype(np.int32) for n in (1, 5, 3, 6, 1, 4)]
    assert np.allclose(m.log10(seqs), [math.log10(plain(m, s)) for s in seqs])
    # all sequences of one length are one distribution
    assert np.isclose(sum(10 ** x for x in m.log10([np.array(s, np.int32) for s in itertools.product(range(8), repeat=3)])), 1)


def test_expected_counts_equal_posteriors_by_brute_force():
    m, rng = model(P, 3), np.random.default_rng(2)
    lengths = [4, 2, 4, 1]
    seq = np.full((4, 4), -1, np.int32)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((8, 3))]
    for i, n in enumerate(lengths):
        seq[i, :n] = s = rng.integers(0, 8, n)
        total = plain(m, s)
        for path in itertools.product(range(3), repeat=n):
            x = m.start[path[0]] * m.emit[s[0], path[0]]
            for t in range(1, n):
                x *= m.move[path[t - 1], path[t]] * m.emit[s[t], path[t]]
            want[0][path[0]] += x / total
            for t in range(n):
                want[2][s[t], path[t]] += x / total
                if t:
                    want[1][path[t - 1], path[t]] += x / total
    for a, b in zip(m.expected(seq, np.ones(4, bool)), want):
        assert np.allclose(a, b)


def brute(rows, p):
    train = Counter(w for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    per = lambda w: math.log10((train[w] + 1) / (n + v + 1))
    return [(i, zlib.crc32(str("" if i is None else i).encode()) % 7 == 2, len(tokens(t)), sum(w in train for w in tokens(t)), n,
             round(sum(map(per, tokens(t))), 6)) for i, t in rows]


def got(rows):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows), key=str)


def test_query_counts_and_gain(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op8_hmm_scores"](spark, sf_dir).collect()
    assert got(out) == sorted(brute(rows, hmm.HmmParams()), key=str)
    assert sum(r["score"] for r in out if r["held_out"]) > sum(r["base_score"] for r in out if r["held_out"])


def test_rare_words_by_join_nulls_repeats_and_clashes(spark):
    rows = [(i, f"the word{i % 7} THE rare{i} \t é") for i in range(60)] + [(100, None), (101, ""), (None, "the"), (5, "again the"), (5, "again the"),
                                                                           (102, "long " * 30_000)]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    p = hmm.HmmParams(frequent=4, rounds=1, segment=16, width=5)
    out = hmm.score_texts(df, p).collect()
    assert got(out) == sorted(brute(rows, p), key=str)
    assert all(r["score"] < 0 for r in out)
    assert hmm.score_texts(df.limit(0)).count() == 0
    none = hmm.score_texts(df.filter("doc_id = 100"), hmm.HmmParams(rounds=1)).collect()
    assert none[0]["n_tokens"] == 1


def test_segments_change_no_counts():
    m, rng = model(P, 3), np.random.default_rng(4)
    texts = [rng.integers(0, 8, n).astype(np.int32) for n in (1, 7, 3, 20, 4, 6)]
    whole = m.expected_of_texts(texts, P)
    cut = m.expected_of_texts(texts, hmm.HmmParams(states=3, symbols=8, segment=3, width=4))
    assert all(np.allclose(a, b) for a, b in zip(whole, cut))
    assert np.isclose(whole[3], m.log10(texts).sum())
    assert np.isclose(whole[1].sum(), sum(len(t) - 1 for t in texts)) and np.isclose(whole[0].sum(), len(texts))


def test_held_out_gain_reaches_a_converged_reference(spark, sf_dir):
    p = hmm.HmmParams()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = hmm.Words()
    symbols = [(zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2, hmm.symbol_of(words(r["text"]), p)) for r in docs.collect()]
    train, held = [x for h, x in symbols if not h], [x for h, x in symbols if h]
    per_token = lambda m: m.log10(held).sum() / sum(map(len, held))
    reference, after = hmm.Hmm.first(p), []
    for _ in range(40):
        start, moves, emits, _ = reference.expected_of_texts(train, p)
        start, moves, emits = start + p.smooth, moves + p.smooth, emits + p.smooth
        reference = hmm.Hmm(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
        after.append(per_token(reference))
    got = per_token(hmm.train_hmm(docs.filter(hmm.train_flag(p)), p))
    # the first round learns what single words tell, the others what their order tells
    assert got - after[0] > 0.9 * (after[-1] - after[0]) > 0
    assert after[1] - after[0] < 0.9 * (after[-1] - after[0])  # two rounds do not
