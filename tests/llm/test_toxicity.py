"""The block index against brute force, held-out accuracy, edge rows."""

from collections import Counter

import numpy as np
import pytest

from changelake.llm import toxicity as tox
from changelake.llm.queries import QUERIES


@pytest.mark.parametrize("seed,block", [(0, 4), (1, 16), (2, 64)])
def test_search_equals_brute_force(seed, block):
    rng = np.random.default_rng(seed)
    n, terms = 300, 40
    m = rng.random((n, terms)) * (rng.random((n, terms)) < 0.1)
    m[5] = m[6] = m[7]  # ties
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    index = tox.BlockMaxIndex(np.arange(n) * 10, np.zeros(n), [np.flatnonzero(m[:, t]) for t in range(terms)],
                              [m[m[:, t] > 0, t] for t in range(terms)], block)
    for k in (1, 7, 400):
        for _ in range(20):
            q = rng.random(terms) * (rng.random(terms) < 0.15)
            if not q.any():
                continue
            q /= np.linalg.norm(q)
            t = np.flatnonzero(q).tolist()
            pos, cos = index.search(t, q[t], k)
            full = m @ q
            want = [i for i in np.lexsort((np.arange(n), -np.round(full, 12))) if full[i] > 0][:k]
            assert np.allclose(cos, full[want])
            assert np.allclose(full[pos], full[want])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op1_toxicity"](spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(labels[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic, clean = [s for y, s in held if y], [s for y, s in held if not y]
    assert toxic and clean
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert auc > 0.8
    assert np.mean([s >= 0.5 for s in clean]) < 0.05


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(i, f"{'vile ' if i % 3 == 0 else ''}word{i} text", "x") for i in range(300)]
        + [(1000, None, "x"), (1001, "", "x"), (None, "vile", "x"), (3, "vile word3 text", "x"), (1002, "vile " * 100_000, "x")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(300)] + [(None, 1, 1), (5, None, 1), (6, 1, 0)],
                                   "doc_id long, toxic int, quality int")
    rows = tox.toxicity_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], r)
    assert by[1000]["score"] == by[1001]["score"] < 0.5 and by[1000]["predicted"] == 0
    assert by[None]["predicted"] == 1 and by[1002]["predicted"] == 1
    assert all(by[i]["predicted"] == (i % 3 == 0) for i in range(300))
    assert all(e % 3 == 0 for e in by[1002]["evidence"])
    # nothing to learn from
    none = tox.toxicity_scores(docs, labels.limit(0)).collect()
    assert len(none) == docs.count() and {r["predicted"] for r in none} == {0}
    one_class = tox.toxicity_scores(docs, labels.filter("toxic = 1")).collect()
    assert {r["predicted"] for r in one_class} == {1}
    assert tox.toxicity_scores(docs.limit(0), labels).count() == 0


def test_unseen_terms_have_no_counts():
    assert tox.TermCounter({"=bad": 0, "^ugli": 1}, (4,))("Bad UGLINESS bad fine") == Counter({0: 2, 1: 1})
