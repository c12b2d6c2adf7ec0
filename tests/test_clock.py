"""Lag metrics by the clock: a stream without input goes on, and the replay equals a scrape at each time."""

import datetime as dt
import time

from pyspark.sql import functions as F

from changelake.operators import lag
from changelake.plans import fixtures
from changelake.streaming import clock


def test_metrics_go_on_without_new_records(spark, sf_dir, tmp_path):
    recs = fixtures.kafka_records(fixtures.load_events(spark, sf_dir), framed=True, text_ts=True)
    src, out = str(tmp_path / "src"), tmp_path / "metrics"
    recs.coalesce(1).write.parquet(src)
    q = clock.lag_clock_stream(spark.readStream.schema(recs.schema).parquet(src), str(out), str(tmp_path / "ck"), period=2)
    end = time.time() + 90
    while time.time() < end and len(list(out.glob("batch_id=*/_SUCCESS"))) < 4:
        assert q.isActive, q.exception()
        time.sleep(0.5)
    q.stop()
    rows = spark.read.parquet(str(out))
    scrapes = [r[0] for r in rows.select("at").distinct().orderBy("at").collect()]
    assert len(scrapes) >= 4  # one file of records, at least three scrapes without news
    assert all(a.second % 2 == 0 and a.microsecond == 0 for a in scrapes)
    fresh = {}
    for r in rows.filter(F.col("metric") == lag.SCHEMA_FRESHNESS_METRIC).orderBy("at").collect():
        fresh.setdefault(r.labels, []).append((r["at"], r["value"]))
    assert len(fresh) == 2
    for series in fresh.values():
        for (a, x), (b, y) in zip(series, series[1:]):
            assert b > a and abs((y - x) - (b - a).total_seconds()) < 1e-6
    # a scrape equals the batch scrape at its time
    at = scrapes[-1]
    got = sorted((r.metric, r.labels, round(r.value, 6)) for r in rows.filter(F.col("at") == at).collect())
    want = sorted((r.metric, r.labels, round(r.value, 6)) for r in lag.lag_metrics(recs, at).collect())
    assert got == want


def test_timeline_equals_a_scrape_at_each_time(spark, sf_dir):
    recs = fixtures.spoiled_records(fixtures.kafka_records(fixtures.load_events(spark, sf_dir), framed=True, text_ts=True), 4)
    start, end = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 9)
    rows = lag.metrics_timeline(recs, start, end, period=43_200)
    got = {}
    for r in rows.collect():
        got.setdefault(r["at"], []).append(tuple(r)[1:])
    for k in range(13):
        at = start + dt.timedelta(seconds=43_200 * k)
        want = lag.topic_metrics(recs.filter(F.col("timestamp") <= F.lit(at).cast("timestamp")), at)
        assert sorted(got.get(at, []), key=str) == sorted((tuple(r) for r in want.collect()), key=str)


def test_timeline_of_nothing(spark, sf_dir):
    recs = fixtures.kafka_records(fixtures.load_events(spark, sf_dir), framed=True).limit(0)
    assert lag.lag_metrics_timeline(recs, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)).count() == 0
