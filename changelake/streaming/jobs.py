"""Structured Streaming jobs: the same operators as the batch path, on streaming frames.

* :func:`lake_sink_stream` (S12): decoded change events -> daily Parquet lake, files roll
  at ``maxRecordsPerFile``, micro-batches every 60 s; the file sink's log makes it
  exactly-once.
* :func:`archive_stream` (S11): messages as JSON lines under topic/partition.
* :func:`dead_letter_stream` (S21): ``foreachBatch`` writing valid rows to the lake and
  failures to a dead-letter folder; both writes are keyed by batch id, so a replayed
  batch overwrites its own output instead of duplicating it.
* :func:`latest_per_topic_stream` (M5 streaming): ``max_by`` state per topic, update mode.
* :func:`lag_by_minute` (X3): per table and minute, latency stats with a watermark.
* :func:`lag_metrics_stream` (M10): the lag scrape re-run on every trigger over a small
  last-record-per-partition state table.
* :func:`bronze_stream` (X1/X2): change batches folded into a bucketed bronze state; the capture
  path uses ``bronze_files``, which rewrites only the files that may hold a touched key.
* :func:`change_capture_streams`: one record stream -> decoded envelope -> lake sink, bronze
  fold and dead letters, as three checkpointed queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.sources import lake

# fixed values: the lake sink's roll interval
LAKE_TRIGGER = "60 seconds"


def lake_sink_stream(events: DataFrame, path: str, checkpoint: str, trigger: str | None = LAKE_TRIGGER,
                     available_now: bool = False, max_records_per_file: int = lake.DEFAULT_MAX_RECORDS_PER_FILE,
                     compression: str = lake.DEFAULT_COMPRESSION):
    """S12 streaming sink; returns the started query."""
    rows = lake.prepare_lake_rows(events)
    w = (rows.writeStream.format("parquet").outputMode("append").partitionBy(*lake.PARTITION_COLUMNS)
         .option("path", path).option("checkpointLocation", checkpoint)
         .option("maxRecordsPerFile", max_records_per_file).option("compression", compression))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def archive_stream(records: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """S11 streaming sink."""
    w = (lake.archive_lines(records).writeStream.format("text").partitionBy("topic", "partition")
         .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def dead_letter_stream(decoded: DataFrame, reason: Column, lake_path: str, dead_path: str, checkpoint: str,
                       available_now: bool = False):
    """S21 streaming: split every micro-batch into lake rows and dead letters.

    ``decoded`` has the Kafka columns, the raw ``value`` and the decoded struct ``data``;
    tombstones (null values without a reason) are neither.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # decoded once for the two writes
        try:
            valid, dead = lake.split_dead_letters(batch, "data", reason)
            rows = lake.prepare_lake_rows(valid.filter(F.col("value").isNotNull()).select(
                "topic", "partition", "offset", "timestamp", "data.*"))
            # the lake's own layout below a folder per batch: replays replace their own files,
            # and scan_lake reads the rows by topic and day
            rows.withColumn("batch_id", F.lit(str(batch_id))).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy(*lake.PARTITION_COLUMNS, "batch_id").parquet(lake_path)
            dead.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(dead_path)
        finally:
            batch.unpersist()

    w = decoded.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def lake_upkeep(spark, path: str, today, days_open: int = 1, target_bytes: int | None = None) -> DataFrame:
    """S12 upkeep, for a daily schedule: the small files of the lake's closed days merged by size.

    ``today`` is the local day; the last ``days_open`` days before it may still get late records
    and stay as they are. Returns the run's report (see ``compaction.compact_small_files``).
    """
    import datetime as dt

    from changelake.sources import compaction

    return compaction.compact_small_files(spark, path, target_bytes or compaction.TARGET_BYTES, before=today - dt.timedelta(days=days_open))


def latest_per_topic_stream(records: DataFrame) -> DataFrame:
    """M5 on a stream: newest record per topic kept as state (update or complete mode)."""
    payload = [c for c in records.columns if c != "topic"]
    order = F.struct(F.col("timestamp").alias("ts"), (-F.col("partition")).alias("neg_partition"))
    return (records.groupBy("topic").agg(F.max_by(F.struct(*payload), order).alias("_r"))
            .select("topic", *[F.col("_r").getField(c).alias(c) for c in payload]))


def lag_by_minute(flat: DataFrame, event_ts: str = "commit_ts", processed_ts: str = "processed_ts",
                  table_col: str = "__db_table", watermark: str | None = "10 minutes",
                  window: str = "1 minute") -> DataFrame:
    """Per table and minute of commit time, count / mean / max of processing latency (s).

    Works on batch and streaming frames alike; on a stream the watermark bounds the
    state and append mode emits each minute once it can no longer change.
    """
    df = flat
    if watermark and flat.isStreaming:
        df = df.withWatermark(event_ts, watermark)
    # integer microseconds: the sum is exact, so the mean does not depend on summation order
    latency_us = F.unix_micros(F.col(processed_ts)) - F.unix_micros(F.col(event_ts))
    micro = F.lit(1000000.0).cast("double")
    return (df.groupBy(F.col(table_col), F.window(F.col(event_ts), window).alias("w"))
            .agg(F.count("*").alias("n_events"), F.sum(latency_us).alias("_sum_us"), F.max(latency_us).alias("_max_us"))
            .withColumn("avg_latency", F.col("_sum_us") / F.col("n_events") / micro)
            .withColumn("max_latency", F.col("_max_us") / micro)
            .select(table_col, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_events", "avg_latency", "max_latency"))


def run_available_now(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                      output_mode: str = "update") -> None:
    """Drive a streaming frame to the end of its input (``availableNow``) into ``sink``."""
    q = (df.writeStream.outputMode(output_mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def lag_metrics_stream(records: DataFrame, state_path: str, metrics_path: str, checkpoint: str,
                       now: Callable[[int], object] | None = None, trigger: str | None = "60 seconds",
                       available_now: bool = False):
    """M10 as a stream: rescrape on every trigger (60 s, the reference's scrape period).

    Each micro-batch folds its records into a small state table holding the last record
    of every topic-partition (M3 across batches: union with the previous state, newest
    offset wins), then computes the per-topic and per-schema metric rows from that
    state (M4 -> M5 -> decode -> M6-M8) and writes them under ``batch_id=<n>``.
    State and metrics of a batch are written to their own batch folder, so a replayed
    batch rewrites the same output. ``now(batch_id)`` supplies the clock (tests freeze it).
    """
    from changelake.operators import lag

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = lag.last_per_partition(lag.topic_filter(
            batch.select("topic", "partition", "offset", "timestamp", "value")))
        if batch_id > 0:
            prev = spark.read.parquet(f"{state_path}/batch_id={batch_id - 1}")
            last = lag.last_per_partition(prev.unionByName(last))
        last.write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
        state = spark.read.parquet(f"{state_path}/batch_id={batch_id}")
        clock = now(batch_id) if now else F.current_timestamp()
        metrics = lag.lag_metrics(state, clock)
        metrics.write.mode("overwrite").parquet(f"{metrics_path}/batch_id={batch_id}")

    w = records.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def bronze_stream(flat: DataFrame, state_path: str, checkpoint: str, key=None, order=None, buckets: int = 64,
                  trigger: str | None = "60 seconds", available_now: bool = False):
    """X1/X2 as a stream: every micro-batch is folded into the bronze state.

    The state is divided into ``buckets`` by a hash of the key, and each bucket has its own
    version: ``bucket=<b>/version=<batch>``. A batch reads and rewrites only the buckets that
    its keys fall into (union + newest-per-key aggregate, one shuffle on the key); the others
    keep their files. Which version of a bucket counts stands in a small table per batch
    beside the state (``<state_path>-buckets``, one row per bucket), written last, so a
    replayed batch starts from the same versions again and readers never see half a batch.
    Versions that no table of the last two batches names are removed.

    The state keeps tombstones (so late, older changes cannot revive a deleted key);
    ``read_bronze`` gives the current state, ``bronze.live_rows`` of it the visible table.
    Take enough buckets that one holds a few hundred MB; batches that touch every bucket
    rewrite the whole state, which ``MERGE INTO`` on a table format would do by file.
    """
    from changelake.operators import bronze

    key = list(key or bronze.DEFAULT_KEY)
    order = order or bronze.DEFAULT_ORDER

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        in_bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
        fresh = bronze.latest_state(batch, key, order, keep_deletes=True).persist()
        try:
            # at most ``buckets`` rows each
            touched = sorted(r["b"] for r in fresh.select(in_bucket.alias("b")).distinct().collect())
            before = bucket_versions(spark, state_path, batch_id - 1)
            stored = [f"{state_path}/bucket={b}/version={before[b]}" for b in touched if b in before]
            state = fresh
            if stored:
                prev = spark.read.parquet(*stored)
                state = bronze.upsert(prev, fresh.select(*prev.columns), key, order)
            if touched:
                (state.withColumn("bucket", in_bucket).withColumn("version", F.lit(batch_id))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("bucket", "version").parquet(state_path))
        finally:
            fresh.unpersist()
        now = before | dict.fromkeys(touched, batch_id)
        spark.createDataFrame(sorted(now.items()), "bucket int, version bigint").coalesce(1).write.mode("overwrite").parquet(
            _version_table(state_path, batch_id))
        older = bucket_versions(spark, state_path, batch_id - 2)
        _remove(spark, [f"{state_path}/bucket={b}/version={v}" for b, v in older.items() if before.get(b) != v]
                + [_version_table(state_path, batch_id - 2)])

    w = flat.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def _version_table(state_path: str, batch_id: int) -> str:
    return f"{state_path}-buckets/batch_id={batch_id}"


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _remove(spark, paths: list[str]) -> None:
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def bucket_versions(spark, state_path: str, batch_id: int) -> dict[int, int]:
    """Bucket -> version after a batch (empty before the first one): one row per bucket."""
    table = _version_table(state_path, batch_id)
    if batch_id < 0 or not _exists(spark, table):
        return {}
    return {r["bucket"]: r["version"] for r in spark.read.schema("bucket int, version bigint").parquet(table).collect()}


def read_bronze(spark, state_path: str) -> DataFrame:
    """The current state of a bronze stream (by buckets or by files), tombstones included."""
    from changelake.streaming import bronze_files

    if _exists(spark, f"{state_path}-live"):
        return bronze_files.read_state(spark, state_path)
    tables = spark.read.schema("bucket int, version bigint, batch_id bigint").parquet(f"{state_path}-buckets")
    last = tables.agg(F.max("batch_id")).first()[0]
    versions = bucket_versions(spark, state_path, last)
    return spark.read.parquet(*[f"{state_path}/bucket={b}/version={v}" for b, v in sorted(versions.items())])


def change_capture_streams(records: DataFrame, envelope, lake_path: str, bronze_path: str, dead_path: str,
                           checkpoint_root: str, key_fields: list[str], chain=None, topic_prefix: str = "local",
                           frame: str | None = "confluent", strict: bool = False, available_now: bool = False,
                           replay_window: str | None = "1 hour"):
    """The whole capture path on one record stream (Kafka source or any frame with its schema).

    Decodes the registry-framed JSON envelope, keeps Kafka metadata, and starts three
    queries on it: the daily lake sink (S12), the bronze fold (C-chain + X1/X2) and the dead
    letters (S21). A record is a tombstone if its raw value is null; one that does not decode
    is a dead letter; all others reach lake and bronze, so nothing vanishes. A record that
    arrives again within ``replay_window`` (None: never) counts once, see ``offsets.drop_replayed``.
    Each query has its own checkpoint under ``checkpoint_root``. Returns the three queries.
    """
    from changelake.operators import offsets, transforms
    from changelake.streaming import bronze_files

    if replay_window is not None:
        records = offsets.drop_replayed(records, replay_window)
    events, dead = capture_split(records, envelope, frame, strict)
    lake_q = lake_sink_stream(events, lake_path, f"{checkpoint_root}/lake", available_now=available_now)
    names = chain or transforms.BRONZE_CHAIN
    flat = transforms.transform_chain(events, names, topic_prefix=topic_prefix,
                                      overrides={"hashKey": {"key_fields": key_fields}})
    bronze_q = bronze_files.bronze_file_stream(flat.drop("topic", "timestamp"), bronze_path, f"{checkpoint_root}/bronze",
                                               available_now=available_now)
    w = (dead.writeStream.format("parquet").outputMode("append").option("path", dead_path)
         .option("checkpointLocation", f"{checkpoint_root}/dead"))
    dead_q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=LAKE_TRIGGER)).start()
    return lake_q, bronze_q, dead_q


def capture_split(records: DataFrame, envelope, frame: str | None = "confluent",
                  strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of raw records; tombstones are in neither."""
    from changelake.sources import framing

    decoded = framing.decode_json(records, envelope, frame=frame, out="_env")
    valid, dead = lake.split_dead_letters(decoded, "_env", framing.decode_error("value", "_env", frame, strict))
    events = valid.filter(F.col("value").isNotNull()).select("topic", "partition", "offset", "timestamp", "_env.*")
    return events, dead


def lag_by_minute_stream(flat: DataFrame, path: str, checkpoint: str, watermark: str = "10 minutes",
                         trigger: str | None = "60 seconds", available_now: bool = False):
    """X3 sink: append each finished minute (once the watermark passes it) to Parquet,
    partitioned by table; the file sink's log makes the output exactly-once."""
    rows = lag_by_minute(flat, watermark=watermark)
    w = (rows.writeStream.format("parquet").outputMode("append").partitionBy("__db_table")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
