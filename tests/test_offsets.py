"""Offset intervals against plain sets, replays on a stream, accounting by offset."""

import random

import pytest
from pyspark.sql import functions as F

from changelake.operators import bronze, offsets
from changelake.plans import registry
from changelake.streaming import jobs

RECORD = "topic string, partition int, offset long"


def ranges(numbers):
    out = []
    for o in sorted(numbers):
        if out and out[-1][1] == o - 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("seed,width", [(1, 4), (2, 7), (3, 1000), (4, 1)])
def test_ranges_equal_plain_sets(spark, seed, width):
    rng = random.Random(seed)
    rows, want = [], {"covered": [], "missing": [], "repeated": []}
    for p in range(6):
        n = rng.choice([0, 1, 5, 60, 200])
        got = [rng.randrange(-20, 100) for _ in range(n)] if p % 2 else [o for o in range(n) if rng.random() < 0.9]
        rows += [("t", p, o) for o in got]
        want["covered"] += [("t", p, a, b) for a, b in ranges(set(got))]
        if got:
            want["missing"] += [("t", p, a, b) for a, b in ranges(set(range(min(got), max(got) + 1)) - set(got))]
        twice = {o for o in got if got.count(o) > 1}
        want["repeated"] += [("t", p, a, b, sum(got.count(o) - 1 for o in range(a, b + 1))) for a, b in ranges(twice)]
    df = spark.createDataFrame(rows, RECORD).repartition(3)
    assert sorted(tuple(r) for r in offsets.covered_ranges(df, width).collect()) == sorted(want["covered"])
    assert sorted(tuple(r) for r in offsets.repeated_ranges(df, width).collect()) == sorted(want["repeated"])
    whole = offsets.covered_ranges(df, width)
    assert sorted(tuple(r) for r in offsets.missing_ranges(whole, width=width).collect()) == sorted(want["missing"])
    # sets of two halves merge to the set of the whole, overlaps included
    a, b = (offsets.covered_ranges(df.filter(c), width) for c in ("offset % 3 < 2", "offset % 3 > 0"))
    both = offsets.merge_intervals(a.unionByName(b), width=width)
    assert sorted(tuple(r) for r in both.collect()) == sorted(want["covered"])


def test_bounds_name_the_ends_and_silent_partitions(spark):
    df = spark.createDataFrame([("t", 0, o) for o in (5, 6, 9, 2)], RECORD)
    bounds = spark.createDataFrame([("t", 0, 4, 12), ("t", 1, 0, 3), ("t", 2, 7, 7)], "topic string, partition int, low long, high long")
    got = sorted(tuple(r) for r in offsets.offset_gaps(df, bounds, width=4).collect())
    assert got == [("t", 0, "missing", 4, 4, 1), ("t", 0, "missing", 7, 8, 2), ("t", 0, "missing", 10, 11, 2), ("t", 1, "missing", 0, 2, 3)]


def test_nothing_and_full_slices(spark):
    none = spark.createDataFrame([], RECORD)
    assert offsets.offset_gaps(none).count() == 0 and offsets.covered_ranges(none).count() == 0
    full = spark.range(1000).selectExpr("'t' as topic", "0 as partition", "id as offset")
    assert [tuple(r) for r in offsets.covered_ranges(full, 10).collect()] == [("t", 0, 0, 999)]
    assert offsets.offset_gaps(full, width=10).count() == 0


def test_account_sees_what_counts_cancel_out(spark):
    of = lambda *os: spark.createDataFrame([("t", 0, o) for o in os], RECORD)
    out = offsets.account(of(1, 2, 3, 3, 4), {"lake": of(1, 1, 2), "dead": of(3, 9)}).collect()
    # five records and five outcomes, but 4 is lost, 1 came out twice and 9 from nowhere
    assert [r.asDict() for r in out] == [dict(topic="t", n_records=5, n_lake=3, n_dead=2, n_lost=1, n_repeated=1, n_stray=1)]


def test_a_replayed_range_arrives_once(spark, tmp_path):
    """Records that come again, in the same run or after a restart, reach lake, bronze and dead letters once;
    an old record that comes for the first time is not taken for a late one."""
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    src = tmp_path / "src"
    src.mkdir()

    def value(o):
        return b"{" if o % 5 == 0 else (
            '{"op": "c", "after": {"user_id": %d, "event_id": %d}, "source": {"db": "store", "table": "tb_x"}, "ts_ms": %d}' % (o % 3, o, o)).encode()

    def feed(os, at=1_700_000_000):
        rows = [(None, bytearray(value(o)), "local.store.tb_x", 0, o, None, 0) for o in os]
        df = spark.createDataFrame(rows, schema).withColumn("timestamp", F.timestamp_seconds(F.col("offset") * 60 + at))
        df.repartition(2).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
        for q in jobs.change_capture_streams(stream, registry.B1_ENVELOPE, str(tmp_path / "lake"), str(tmp_path / "bronze"),
                                             str(tmp_path / "dead"), str(tmp_path / "ck"), ["user_id"], frame=None, available_now=True):
            q.awaitTermination()

    feed(range(1, 12))
    feed(range(6, 20))
    feed(range(100, 103), at=1_500_000_000)
    want = [*range(1, 20), 100, 101, 102]
    lake_rows = spark.read.parquet(str(tmp_path / "lake"))
    dead = spark.read.parquet(str(tmp_path / "dead"))
    assert sorted(r.offset for r in lake_rows.select("offset").collect()) == [o for o in want if o % 5]
    assert sorted(r.offset for r in dead.select("offset").collect()) == [o for o in want if o % 5 == 0]
    live = bronze.live_rows(jobs.read_bronze(spark, str(tmp_path / "bronze")))
    assert sorted(r.event_id for r in live.collect()) == [19, 101, 102]  # the newest by ts_ms of each user; 100 is a dead letter
    out = offsets.account(spark.read.parquet(str(src)), {"lake": lake_rows, "dead": dead}).first()
    assert (out.n_records, out.n_lost, out.n_repeated, out.n_stray) == (28, 0, 0, 0)
