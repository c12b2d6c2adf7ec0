"""Candidates of nodes: few where nothing is linked, none lost at the similarity."""

import random

import numpy as np
import pyarrow as pa
import pytest

from changelake.llm import neardup


def test_unlinked_members_of_a_large_node_make_few_pairs(spark, monkeypatch):
    # all meet in one large node; any two share 0.6 of their words, so nothing but the planted pair is linked
    shared = [f"s{i}" for i in range(150)]
    rows = [(k, " ".join(shared + [f"k{k}n{i}" for i in range(50)])) for k in range(150)]
    rows.append((1000, rows[7][1] + " more"))
    sizes = []
    real = neardup.materialize

    def counted(df, name):
        out = real(df, name)
        if name in ("pairs", "stars"):
            sizes.append(out.count())
        return out

    monkeypatch.setattr(neardup, "materialize", counted)
    p = neardup.NearDupParams(words=1, trees=1, first_level=0, last_level=0, small_node=4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, p).collect()}
    assert got == {i: 7 if i == 1000 else i for i, _ in rows}
    assert sum(sizes) <= 3 * len(rows)


@pytest.mark.parametrize("n", [5, 40, 150, 900, 6000])
def test_pairs_at_the_similarity_pass(n):
    p, rng = neardup.NearDupParams(), np.random.default_rng(n)
    sh = neardup.Shingler(1, p.tokens)
    briefs = []
    for _ in range(200):
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        # a of n elements are replaced: (n - a) * 100 >= 80 * (n + a)
        y = np.concatenate([x[n // 9:], rng.integers(0, 1 << 63, n // 9, dtype=np.uint64)])
        briefs += [sh.brief(s, sh.signature(s), p.bits) for s in (np.unique(x), np.unique(y))]
    rows = neardup.Briefs(pa.StructArray.from_arrays([pa.array([str(i).encode() for i in range(400)]), pa.array([b""] * 400), pa.array(briefs)],
                                                     names=["cls", "label", "brief"]), p)
    even = np.arange(0, 400, 2)
    assert neardup.may_reach(rows, even, rows, even + 1).all()
    if 40 <= n <= 900:  # unrelated sets do not pass
        assert not neardup.may_reach(rows, even, rows, np.roll(even, 1)).any()


def test_blocks_of_a_large_node_meet_each_other(spark):
    rng = random.Random(3)
    rows = []
    for k in range(40):
        base = [f"b{k}w{i}" for i in range(60)]
        rows += [(10 * k + j, " ".join(base[:60 - j] + [f"x{rng.random()}"] * bool(j))) for j in range(3)]
    p = neardup.NearDupParams(words=1, trees=1, first_level=0, last_level=0, small_node=4, block=7)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), p).collect()}
    assert got == {i: i // 10 * 10 for i, _ in rows}
