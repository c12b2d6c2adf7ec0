"""Compaction by size: large files untouched, nothing lost, reruns, broken runs, odd folder names."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from changelake.plans import fixtures
from changelake.sources import compaction, lake
from changelake.streaming import jobs


def files(root):
    return {str(p.relative_to(root)): p.stat().st_size for p in root.rglob("*.parquet") if "_compaction" not in str(p)}


def rows(spark, root):
    return sorted(tuple(r) for r in lake.scan_lake(spark, str(root)).select("topic", "year", "month", "day", "offset", "op").collect())


@pytest.fixture
def small_lake(spark, sf_dir, tmp_path):
    """Two days: one file of many rows and many files of few rows each, in a topic whose name needs escapes."""
    ce = fixtures.change_events(fixtures.load_events(spark, sf_dir)).filter("topic like '%tb_click'").withColumns(
        {"topic": F.lit("a b%c+d:é"), "timestamp": F.expr("timestamp'2024-01-05 02:00:00' + make_interval(0, 0, 0, cast(offset % 2 as int))")})
    ready = lake.prepare_lake_rows(ce)
    lake.write_lake(ready.coalesce(1), str(tmp_path / "lake"))
    lake.write_lake(ready.limit(30).withColumn("offset", F.col("offset") + 10**6).coalesce(1), str(tmp_path / "lake"), max_records_per_file=2)
    return tmp_path / "lake"


def test_small_files_become_one_and_large_ones_stay(spark, small_lake):
    before, content = files(small_lake), rows(spark, small_lake)
    large = {f for f, n in before.items() if n >= 15_000}
    assert len(large) == 2 and len(before) > 10
    report = compaction.compact_small_files(spark, str(small_lake), target_bytes=10**6, small_below=15_000).collect()
    after = files(small_lake)
    assert large <= after.keys() and len(after) == 4 and not (after.keys() - large) & before.keys()
    assert rows(spark, small_lake) == content
    assert sorted(r["n_files"] for r in report) == sorted(
        sum(f.startswith(f"{d}/") for f in before.keys() - large) for d in {f.rsplit("/", 1)[0] for f in large})
    assert all(before[f] == after[f] for f in large)
    assert compaction.compact_small_files(spark, str(small_lake), target_bytes=10**6, small_below=15_000).count() == 0
    assert files(small_lake) == after


def test_bins_follow_the_bytes(spark):
    rows = [(f"file:/l/day={d}/p{i:03d}", 10 + i % 7) for d in range(3) for i in range(100)] + [("file:/l/day=9/one", 5), ("file:/l/day=0/big", 50)]
    df = spark.createDataFrame(rows, "path string, size bigint")
    out = compaction.pack_files(df, 40, 50).collect()
    assert {r["path"] for r in out} <= {p for p, n in rows if n < 50 and "day=9" not in p} and len(out) > 280
    bins = {}
    for r in out:
        bins.setdefault(r["bin"], []).append(r)
    for b in bins.values():
        assert len(b) > 1 and len({r["folder"] for r in b}) == 1 and sum(r["size"] for r in b) < 40 + 50


def test_a_run_that_broke_is_finished(spark, small_lake, monkeypatch):
    content = rows(spark, small_lake)
    real = compaction.finish
    calls = []

    def breaks(spark, path):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(spark, path)

    monkeypatch.setattr(compaction, "finish", breaks)
    with pytest.raises(RuntimeError):
        compaction.compact_small_files(spark, str(small_lake), target_bytes=10**6, small_below=15_000)
    monkeypatch.undo()
    assert rows(spark, small_lake) == content  # nothing was changed yet
    # part of the moves is done, as when a task was lost in the middle
    moves = spark.read.parquet(str(next((small_lake / "_compaction").iterdir()) / "moves")).filter("target is not null").collect()
    shutil.move(moves[0]["source"].removeprefix("file:"), moves[0]["target"].removeprefix("file:"))
    assert compaction.finish(spark, str(small_lake)) == 1
    assert rows(spark, small_lake) == content and len(files(small_lake)) == 4
    assert compaction.finish(spark, str(small_lake)) == 0


def test_open_days_and_stream_lakes_are_left_alone(spark, small_lake):
    before = files(small_lake)
    assert jobs.lake_upkeep(spark, str(small_lake), dt.date(2024, 1, 6), days_open=1).count() == 0 and files(small_lake) == before
    out = jobs.lake_upkeep(spark, str(small_lake), dt.date(2024, 1, 7), days_open=1)
    assert out.count() == 1 and "day=05" in out.first()["folder"]
    (small_lake / "_spark_metadata").mkdir()
    with pytest.raises(ValueError):
        compaction.compact_small_files(spark, str(small_lake))
