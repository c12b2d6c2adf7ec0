"""Operators leave only the tables that their result reads in the scratch folder."""

import os
import weakref

import pytest

from changelake import session
from changelake.llm import bpe, common, graph, neardup, queries, substrings


def tables(spark):
    folder = session._scratch_root(spark).removeprefix("file:")
    return {x for x in (os.listdir(folder) if os.path.isdir(folder) else ())}


def test_block_keeps_its_result_only(spark):
    before = tables(spark)
    with session.scratch_block(spark, "outer") as keep:
        session.materialize(spark.range(3), "gone")
        with session.scratch_block(spark, "inner") as keep_inner:
            session.materialize(spark.range(4), "gone")
            inner = keep_inner(spark.range(5), "inner-result")
        assert inner.count() == 5
        out = keep(inner, "result")
    assert out.count() == 5
    assert [x.rsplit("-", 1)[0] for x in tables(spark) - before] == ["result"]


def test_block_that_fails_is_removed_too(spark):
    before = tables(spark)
    with pytest.raises(ValueError):
        with session.scratch_block(spark, "outer"):
            session.materialize(spark.range(3), "gone")
            raise ValueError
    assert tables(spark) == before
    session.materialize(spark.range(3), "outside")
    assert len(tables(spark) - before) == 1


@pytest.mark.parametrize("run, kept", [
    (lambda df: neardup.near_duplicates(df, neardup.NearDupParams(words=2)), "near-duplicates"),
    (lambda df: substrings.remove_repeats(df, substrings.RepeatParams(length=40, seed=16, words=9)), "repeats")])
def test_operators_leave_one_table(spark, run, kept):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text), (1, text), (2, text + " more"), (3, None), (None, text), (4, "")]
    before = tables(spark)
    out = run(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert len(out.collect()) == len(rows)
    assert [x.rsplit("-", 1)[0] for x in tables(spark) - before] == [kept]


def test_small_tables_are_written_by_few_tasks(spark, monkeypatch):
    # 40 shuffle partitions that AQE leaves alone: the tables of a few rows were written in 40 files each
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    files = {}

    def counted(df, name):
        out = session.materialize(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    for module in (neardup, graph):
        monkeypatch.setattr(module, "materialize", counted)
    text = [f"w{i}" for i in range(40)]
    rows = [(k, " ".join([*text, f"end{k}"])) for k in range(8)] + [(100, "something else entirely"), (101, None)]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2), neardup.NearDupParams(words=2))
        got = {r["doc_id"]: r["component_id"] for r in out.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {k: 0 for k in range(8)} | {100: 100, 101: 101}
    assert {"sketches", "classes", "pairs", "links", "labels"} <= files.keys()
    assert max(max(n) for n in files.values()) <= max(2, spark.sparkContext.defaultParallelism)


def test_a_worker_holds_one_operators_object(spark):
    # the encoder with its memo stayed in the worker while other operators' tasks ran there
    first = bpe._bpe_for(open(queries.tokenizer_file(), encoding="utf-8").read())
    first.encode_bytes("some words to remember")
    assert bpe._bpe_for(open(queries.tokenizer_file(), encoding="utf-8").read()) is first
    gone = weakref.ref(first)
    del first
    assert common.per_worker(("shingles", 2, 1), lambda: neardup.Shingler(2)).words == 2
    assert gone() is None
