"""Streaming = batch: each streaming job over a file source matches its batch twin."""

from pyspark.sql import functions as F

from changelake.operators import lag, transforms
from changelake.plans import fixtures, registry
from changelake.sources import framing, lake
from changelake.streaming import jobs


def _stream_of(spark, df, path):
    df.write.mode("overwrite").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _flat(ce):
    return transforms.format_field(transforms.unwrap(
        ce.withColumn("commit_ts", F.timestamp_millis("source.ts_ms"))
          .withColumn("processed_ts", F.timestamp_millis("ts_ms")),
        keep=("offset", "commit_ts", "processed_ts")))


def test_lag_by_minute_stream_equals_batch(spark, sf_dir, tmp_path):
    ce = fixtures.change_events(fixtures.load_events(spark, sf_dir))
    src = _stream_of(spark, ce.repartition(4), str(tmp_path / "src"))
    stream = jobs.lag_by_minute(_flat(src))
    q = (stream.writeStream.outputMode("complete").format("memory").queryName("lag_by_minute_t")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.table("lag_by_minute_t").collect())
    want = sorted(tuple(r) for r in jobs.lag_by_minute(_flat(ce)).collect())
    assert got == want and len(got) > 0


def test_lake_sink_stream_equals_batch(spark, sf_dir, tmp_path):
    ce = fixtures.change_events(fixtures.load_events(spark, sf_dir), tombstones=True)
    src = _stream_of(spark, ce.repartition(3), str(tmp_path / "src"))
    q = jobs.lake_sink_stream(src, str(tmp_path / "lake"), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    back = lake.scan_lake(spark, str(tmp_path / "lake"))
    got = sorted(tuple(r) for r in back.groupBy("topic", "year", "month", "day").count().collect())
    lake.write_lake(lake.prepare_lake_rows(ce), str(tmp_path / "batch"))
    want = sorted(tuple(r) for r in lake.scan_lake(spark, str(tmp_path / "batch"))
                  .groupBy("topic", "year", "month", "day").count().collect())
    assert got == want
    assert back.filter(F.col("op").isNull()).count() == 0   # tombstones dropped


def test_lake_files_roll_at_max_records(spark, sf_dir, tmp_path):
    ce = fixtures.change_events(fixtures.load_events(spark, sf_dir))
    rows = lake.prepare_lake_rows(ce).coalesce(1)
    lake.write_lake(rows, str(tmp_path / "lake"), max_records_per_file=10)
    files = spark.read.parquet(str(tmp_path / "lake")).select(F.input_file_name().alias("f")) \
        .groupBy("f").count().agg(F.max("count")).first()[0]
    assert files <= 10


def test_latest_per_topic_stream_equals_batch(spark, sf_dir, tmp_path):
    recs = fixtures.kafka_records(fixtures.load_events(spark, sf_dir), framed=True)
    src = _stream_of(spark, recs.repartition(4), str(tmp_path / "src"))
    q = (jobs.latest_per_topic_stream(src).writeStream.outputMode("complete").format("memory")
         .queryName("latest_t").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.topic, r.partition, r.offset) for r in spark.table("latest_t").collect())
    want = sorted((r.topic, r.partition, r.offset) for r in lag.latest_per_topic(recs).collect())
    assert got == want


def test_dead_letter_stream(spark, sf_dir, tmp_path):
    recs = fixtures.damaged_records(fixtures.load_events(spark, sf_dir))
    src = _stream_of(spark, recs, str(tmp_path / "src"))
    dec = framing.decode_json(src, registry.B1_ENVELOPE, frame="confluent")
    q = jobs.dead_letter_stream(dec, framing.decode_error("value", "data", "confluent"), str(tmp_path / "ok"),
                                str(tmp_path / "dead"), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    dead = spark.read.parquet(str(tmp_path / "dead"))
    ok = lake.scan_lake(spark, str(tmp_path / "ok"))
    bad = (F.col("offset") % 7 == 0) | (F.col("offset") % 26 == 0) | (F.col("offset") % 22 == 0) | (F.col("offset") % 38 == 0)
    full = recs.filter("value IS NOT NULL")
    assert dead.count() == full.filter(bad).count()
    assert {r[0] for r in dead.select("error").distinct().collect()} == {"missing magic byte", "cut header", "undecodable body", "not UTF-8"}
    assert ok.count() + dead.count() == full.count()
    assert {"topic", "year", "month", "day", "op"} <= set(ok.columns)


def test_archive_stream(spark, sf_dir, tmp_path):
    recs = fixtures.kafka_records(fixtures.load_events(spark, sf_dir), framed=False)
    src = _stream_of(spark, recs, str(tmp_path / "src"))
    jobs.archive_stream(src, str(tmp_path / "arch"), str(tmp_path / "ck"), available_now=True).awaitTermination()
    back = lake.read_archive(spark, str(tmp_path / "arch"))
    assert sorted(r.offset for r in back.select("offset").collect()) == \
        sorted(r.offset for r in recs.select("offset").collect())


def test_lag_metrics_stream_equals_batch(spark, sf_dir, tmp_path):
    import datetime as dt

    now = dt.datetime(2024, 2, 1)
    recs = fixtures.kafka_records(fixtures.load_events(spark, sf_dir), framed=True, text_ts=True)
    src = _stream_of(spark, recs.repartition(3), str(tmp_path / "src"))
    q = jobs.lag_metrics_stream(src, str(tmp_path / "state"), str(tmp_path / "metrics"), str(tmp_path / "ck"),
                                now=lambda _b: now, available_now=True)
    q.awaitTermination()
    metrics = spark.read.parquet(str(tmp_path / "metrics")).withColumn("batch_id", F.col("batch_id").cast("int"))
    last_batch = metrics.agg(F.max("batch_id")).first()[0]
    assert last_batch >= 1   # several micro-batches (one file per trigger)
    got = sorted(tuple(r) for r in metrics.filter(F.col("batch_id") == last_batch).drop("batch_id").collect())
    want = sorted(tuple(r) for r in lag.lag_metrics(recs, now).collect())
    assert got == want


def test_bronze_stream_equals_batch_fold(spark, sf_dir, tmp_path):
    from changelake.operators import bronze

    flat = registry.bronze_flat(spark, sf_dir).select(*registry.BRONZE_COLUMNS, "__deleted")
    src = _stream_of(spark, flat.repartition(3), str(tmp_path / "src"))
    jobs.bronze_stream(src, str(tmp_path / "state"), str(tmp_path / "ck"), available_now=True).awaitTermination()
    got = sorted(tuple(r) for r in bronze.live_rows(jobs.read_bronze(spark, str(tmp_path / "state")))
                 .select(*registry.BRONZE_COLUMNS).collect())
    want = sorted(tuple(r) for r in bronze.latest_state(flat).select(*registry.BRONZE_COLUMNS).collect())
    assert got == want


def test_bronze_stream_rewrites_only_touched_buckets(spark, tmp_path):
    from changelake.operators import bronze

    schema = "__db_table string, id_iceberg string, last_applied_date long, offset long, v string, __deleted string"
    src, state = tmp_path / "src", str(tmp_path / "state")
    src.mkdir()

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema(schema).parquet(str(src))
        jobs.bronze_stream(stream, state, str(tmp_path / "ck"), buckets=8, available_now=True).awaitTermination()
        return {str(p.relative_to(state)) for p in (tmp_path / "state").rglob("*.parquet")}

    files = run([("t", f"k{i}", 1, i, "a", "false") for i in range(100)])
    buckets = {f.split("/")[0] for f in files}
    assert len(buckets) == 8 and all("version=0" in f for f in files)
    files1 = run([("t", "k5", 2, 200, "b", "false")])
    new = {f.split("/")[0] for f in files1 if "version=1" in f}
    assert len(new) == 1 and files <= files1  # one bucket written, all others untouched
    files2 = run([("t", "k5", 3, 201, "b", "true"), ("t", "k5", 1, 202, "old", "false")])
    assert not any(f.split("/")[0] in new and "version=0" in f for f in files2)  # superseded twice
    live = bronze.live_rows(jobs.read_bronze(spark, state))
    assert sorted(r.id_iceberg for r in live.collect()) == sorted(f"k{i}" for i in range(100) if i != 5)


def test_compact_lake(spark, sf_dir, tmp_path):
    ce = fixtures.change_events(fixtures.load_events(spark, sf_dir))
    lake.write_lake(lake.prepare_lake_rows(ce).repartition(4), str(tmp_path / "lake"), max_records_per_file=5)
    lake.compact_lake(spark, str(tmp_path / "lake"), str(tmp_path / "compact"), target_rows_per_file=100)
    before = spark.read.parquet(str(tmp_path / "lake"))
    after = spark.read.parquet(str(tmp_path / "compact"))
    files = lambda d: d.select(F.input_file_name()).distinct().count()
    assert after.count() == before.count()
    assert files(after) < files(before)
    assert sorted(r.offset for r in after.select("offset").collect()) == \
        sorted(r.offset for r in before.select("offset").collect())


def test_lag_by_minute_append_drops_late_data(spark, tmp_path):
    """Append mode with a watermark: a minute is emitted once the watermark passes it, and
    an event older than the watermark is dropped (late data)."""
    import datetime as dt

    schema = "__db_table string, commit_ts timestamp, processed_ts timestamp"
    t = lambda m, s=0: dt.datetime(2024, 1, 1, 0, m, s)
    src = tmp_path / "src"
    src.mkdir()
    spark.createDataFrame([("a", t(0), t(0, 2)), ("a", t(0, 30), t(0, 31))], schema).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = (jobs.lag_by_minute(stream, watermark="1 minute").writeStream.outputMode("append").format("memory")
         .queryName("lbm_append").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    spark.createDataFrame([("a", t(20), t(20, 1))], schema).write.mode("append").parquet(str(src))
    q.processAllAvailable()
    spark.createDataFrame([("a", t(0, 40), t(0, 41)), ("a", t(30), t(30, 1))], schema) \
        .write.mode("append").parquet(str(src))   # 00:00:40 is late now
    q.processAllAvailable()
    q.stop()
    rows = {r.window_start: r.n_events for r in spark.table("lbm_append").collect()}
    assert rows[t(0)] == 2          # the late 00:00:40 event did not change the emitted minute
    assert t(30) not in rows        # still open: the watermark has not passed it


def test_lake_overwrite_is_idempotent(spark, sf_dir, tmp_path):
    ce = fixtures.change_events(fixtures.load_events(spark, sf_dir))
    rows = lake.prepare_lake_rows(ce)
    path = str(tmp_path / "lake")
    lake.write_lake(rows, path, mode="overwrite")
    lake.write_lake(rows.filter(F.col("day") == "05"), path, mode="overwrite")   # re-run of one day
    assert spark.read.parquet(path).count() == rows.count()


def test_change_capture_streams(spark, sf_dir, tmp_path):
    from changelake.operators import bronze

    ev = fixtures.load_events(spark, sf_dir)
    # tombstones and two broken records: a malformed body and an empty one
    broken = spark.createDataFrame([(None, bytearray(b'{"op": "u", "after": {'), "local.store.tb_x", 0, -1),
                                    (None, bytearray(b""), "local.store.tb_x", 0, -2),
                                    (None, None, "local.store.tb_x", 0, -3)],
                                   "key binary, value binary, topic string, partition int, offset long")
    good = fixtures.kafka_records(ev, framed=False)
    recs = good.unionByName(broken.withColumns({"timestamp": F.current_timestamp(), "timestampType": F.lit(0)}))
    src = _stream_of(spark, recs.repartition(2), str(tmp_path / "src"))
    queries = jobs.change_capture_streams(src, registry.B1_ENVELOPE, str(tmp_path / "lake"), str(tmp_path / "bronze"),
                                          str(tmp_path / "dead"), str(tmp_path / "ck"), ["user_id"],
                                          frame=None, available_now=True)
    for q in queries:
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "lake")).count() == good.count()
    dead = spark.read.parquet(str(tmp_path / "dead"))
    assert sorted((r.offset, r.error) for r in dead.collect()) == [(-2, "undecodable body"), (-1, "undecodable body")]
    got = bronze.live_rows(jobs.read_bronze(spark, str(tmp_path / "bronze")))
    want = registry.QUERIES["bronze_latest_state"](spark, sf_dir)
    cols = ["__db_table", "id_iceberg", "offset", "event_id"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def test_lag_by_minute_stream_sink(spark, sf_dir, tmp_path):
    ce = fixtures.change_events(fixtures.load_events(spark, sf_dir))
    src = _stream_of(spark, ce.repartition(2), str(tmp_path / "src"))
    jobs.lag_by_minute_stream(_flat(src), str(tmp_path / "out"), str(tmp_path / "ck"),
                              available_now=True).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    batch = jobs.lag_by_minute(_flat(ce))
    # append mode emits the minutes the watermark has passed: all but the last few
    assert 0 < out.count() <= batch.count()
    joined = out.join(batch, ["__db_table", "window_start"]).filter(out.n_events != batch.n_events)
    assert joined.count() == 0


def test_values_that_are_not_utf8_end_no_stream(spark, tmp_path):
    """A stream that met such a record goes on, also after a restart; the value stands in the dead letters byte by byte."""
    bad, src = b'{"op": "u\xff"}', tmp_path / "src"
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    src.mkdir()

    def feed(*rows):
        df = spark.createDataFrame([(None, bytearray(v), "local.store.tb_x", 0, o, None, 0) for o, v in rows], schema)
        df.withColumn("timestamp", F.timestamp_seconds(F.col("offset") + 1_700_000_000)).coalesce(1).write.mode("append").parquet(str(src))
        stream = lambda: spark.readStream.schema(schema).parquet(str(src))
        for q in jobs.change_capture_streams(stream(), registry.B1_ENVELOPE, str(tmp_path / "lake"), str(tmp_path / "bronze"),
                                             str(tmp_path / "dead"), str(tmp_path / "ck"), ["user_id"], frame=None, available_now=True):
            q.awaitTermination()
        jobs.archive_stream(stream(), str(tmp_path / "arch"), str(tmp_path / "ck-a"), available_now=True).awaitTermination()

    good = b'{"op": "c", "after": {"user_id": 1}, "source": {"db": "store", "table": "tb_x"}, "ts_ms": 5}'
    feed((1, good), (2, bad))
    feed((3, good), (4, bad), (5, good))
    dead = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert sorted((r.offset, bytes(r.raw_value), r.error) for r in dead) == [(2, bad, "not UTF-8"), (4, bad, "not UTF-8")]
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 3
    arch = lake.read_archive(spark, str(tmp_path / "arch")).collect()
    assert sorted((r.offset, r.message is None, bytes(r.value)) for r in arch) == [
        (1, False, good), (2, True, bad), (3, False, good), (4, True, bad), (5, False, good)]
