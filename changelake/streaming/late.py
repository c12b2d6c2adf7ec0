"""Latency per table and minute that loses no late row.

A streaming aggregate with a watermark drops rows that come after their minute was closed, and
nothing says how many.  Here each micro-batch is split by the watermark that the batches before it
left: rows of open minutes are added to the state (counts, sums and maxima, so a hot table is
reduced in every task first), minutes that the new watermark passes are emitted, rows of closed
minutes, and rows without a time, are handed on as late.  Counters taken in flight
make the account of every batch: open before + input = emitted + late + open after.

Below ``path``: ``minutes/batch_id=<n>`` closed minutes, ``late/batch_id=<n>`` late rows with their
minute, ``open/batch_id=<n>`` the state, ``account/batch_id=<n>`` one row with the watermark and the
counters, written last.  A batch that is replayed starts from the batch before and replaces its own
folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

MINUTE_US = 60_000_000
ACCOUNT = "watermark_us bigint, n_input bigint, n_late bigint, n_emitted bigint, n_open bigint"


def _minute(event_ts: str) -> Column:
    return F.floor(F.unix_micros(event_ts) / MINUTE_US).cast("bigint")


def _fold(rows: DataFrame, table_col: str) -> DataFrame:
    return rows.groupBy(table_col, "minute").agg(F.sum("n").alias("n"), F.sum("sum_us").alias("sum_us"), F.max("max_us").alias("max_us"))


def _closed(open_: DataFrame, table_col: str) -> DataFrame:
    micro = F.lit(1000000.0).cast("double")
    start = F.col("minute") * MINUTE_US
    return open_.select(table_col, F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + MINUTE_US).alias("window_end"),
                        F.col("n").alias("n_events"), (F.col("sum_us") / F.col("n") / micro).alias("avg_latency"), (F.col("max_us") / micro).alias("max_latency"))


def _account(spark: SparkSession, path: str, batch_id: int):
    from changelake.streaming.jobs import _exists

    at = f"{path}/account/batch_id={batch_id}"
    return spark.read.schema(ACCOUNT).parquet(at).first() if batch_id >= 0 and _exists(spark, f"{at}/_SUCCESS") else None


def fold_minutes(batch: DataFrame, batch_id: int, path: str, event_ts: str = "commit_ts", processed_ts: str = "processed_ts",
                 table_col: str = "__db_table", delay_seconds: int = 600, last: bool = False) -> None:
    """One batch of flat change rows; ``last`` closes all open minutes (the end of a finite input)."""
    spark = batch.sparkSession
    before = _account(spark, path, batch_id - 1)
    passed = before["watermark_us"] if before else None
    rows = batch.withColumn("minute", _minute(event_ts))
    # a minute is closed if it ends at the watermark or before
    late = F.col("minute").isNull()
    if passed is not None:
        late = late | ((F.col("minute") + 1) * MINUTE_US <= passed)
    seen = Observation()
    rows = rows.withColumn("_late", late).observe(
        seen, F.count(F.lit(1)).alias("n_input"), F.coalesce(F.sum(F.col("_late").cast("bigint")), F.lit(0)).alias("n_late"),
        F.max(F.unix_micros(event_ts)).alias("newest"))
    rows = rows.persist()  # one pass over the batch for its counters, its late rows and its minutes
    try:
        rows.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        latency = F.unix_micros(processed_ts) - F.unix_micros(event_ts)
        fresh = _fold(rows.filter("not _late").select(table_col, "minute", F.lit(1).cast("bigint").alias("n"), latency.alias("sum_us"), latency.alias("max_us")), table_col)
        if before:
            fresh = _fold(fresh.unionByName(spark.read.parquet(f"{path}/open/batch_id={batch_id - 1}").select(*fresh.columns)), table_col)
        # filling the cache has run the whole batch once, so the counters are there
        counts = seen.get
        newest = [x for x in (passed, None if counts["newest"] is None else counts["newest"] - delay_seconds * 1_000_000) if x is not None]
        mark = max(newest) if newest else None
        done = F.lit(last) if mark is None else F.lit(last) | ((F.col("minute") + 1) * MINUTE_US <= mark)
        folded = fresh.withColumn("_done", done).persist()
        try:
            n = folded.agg(F.coalesce(F.sum(F.when(F.col("_done"), F.col("n"))), F.lit(0)).alias("out"),
                           F.coalesce(F.sum(F.when(~F.col("_done"), F.col("n"))), F.lit(0)).alias("open")).first()
            _closed(folded.filter("_done"), table_col).write.mode("overwrite").parquet(f"{path}/minutes/batch_id={batch_id}")
            folded.filter("not _done").drop("_done").write.mode("overwrite").parquet(f"{path}/open/batch_id={batch_id}")
        finally:
            folded.unpersist()
    finally:
        rows.unpersist()
    row = (mark, counts["n_input"], counts["n_late"], n["out"], n["open"])
    if (before["n_open"] if before else 0) + row[1] != row[2] + row[3] + row[4]:
        raise RuntimeError(f"batch {batch_id}: the account does not add up: {row}")
    spark.createDataFrame([row], ACCOUNT).coalesce(1).write.mode("overwrite").parquet(f"{path}/account/batch_id={batch_id}")


def lag_by_minute_exact_stream(flat: DataFrame, path: str, checkpoint: str, delay_seconds: int = 600, trigger: str | None = "60 seconds",
                               available_now: bool = False, **columns: str):
    """X3 as a stream that hands late rows on. Returns the started query."""
    w = flat.writeStream.foreachBatch(lambda batch, n: fold_minutes(batch, n, path, delay_seconds=delay_seconds, **columns)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def late_rows(flat: DataFrame, arrival_ts: str, event_ts: str = "commit_ts", batch_seconds: int = 60, delay_seconds: int = 600) -> DataFrame:
    """The rows that such a stream hands on as late, if it takes what arrives in ``batch_seconds`` as one batch.

    The watermarks come from one row for each batch; the rows meet theirs by the batch's number.
    """
    rows = flat.withColumns({"_batch": F.floor(F.unix_micros(arrival_ts) / (batch_seconds * 1_000_000)).cast("bigint"), "minute": _minute(event_ts)})
    newest = rows.groupBy("_batch").agg(F.max(F.unix_micros(event_ts)).alias("_newest"))
    # a row for each batch: days of minutes, not rows
    marks = newest.select("_batch", (F.max("_newest").over(Window.orderBy("_batch").rowsBetween(Window.unboundedPreceding, -1))
                                     - F.lit(delay_seconds * 1_000_000)).alias("_mark"))
    met = rows.join(marks, "_batch")
    return met.filter(F.col("minute").isNull() | ((F.col("minute") + 1) * MINUTE_US <= F.col("_mark"))).drop("_batch", "_mark")


def late_by_minute(flat: DataFrame, arrival_ts: str, table_col: str = "__db_table", event_ts: str = "commit_ts", batch_seconds: int = 60,
                   delay_seconds: int = 600) -> DataFrame:
    """X3's other half: per table and minute of commit time, the late rows and by how much the last one missed the minute's end (s)."""
    late = late_rows(flat, arrival_ts, event_ts, batch_seconds, delay_seconds)
    behind = F.unix_micros(arrival_ts) - (F.col("minute") + 1) * MINUTE_US
    return late.groupBy(table_col, "minute").agg(F.count(F.lit(1)).alias("n_late"), F.max(behind).alias("_b")).select(
        table_col, F.timestamp_micros(F.col("minute") * MINUTE_US).alias("window_start"), "n_late",
        (F.col("_b") / F.lit(1000000.0).cast("double")).alias("max_behind"))
