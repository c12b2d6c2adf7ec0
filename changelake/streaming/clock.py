"""The lag scrape by the clock (M7, M10): metrics go on where records stop.

State per topic and partition: its last record. A processing-time timer of each key fires at
every multiple of the period, whether records came or not, and hands the last record on with
the time of the scrape; the engine runs a batch for timers on every trigger. The records of one
scrape then go through the same steps as a batch scrape (M4 -> M5 -> decode -> M6-M8), so a
connector that stopped shows a freshness that grows.

A key is a partition, not a topic: one Kafka partition is read by one task anyway, so a hot topic
spreads over its partitions. State is one record per partition, in RocksDB.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle,
                                                      TimerValues)

from changelake.operators import lag

# fixed values: the scrape's period in seconds, and the state store that timers need
SCRAPE_PERIOD = 60
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

LAST_RECORD = "offset bigint, timestamp_us bigint, value binary"
SCRAPED = f"topic string, partition int, {LAST_RECORD}, scrape_ms bigint"


class LastRecord(StatefulProcessor):
    """Keeps a partition's last record and emits it at every multiple of the period."""

    def __init__(self, period: int):
        self.period_ms = period * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", LAST_RECORD)

    def _wind(self, now_ms: int) -> None:
        self.handle.registerTimer((now_ms // self.period_ms + 1) * self.period_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = self.last.exists()
        best = tuple(self.last.get()) if known else None
        for df in rows:
            r = df.loc[df["offset"].idxmax()]
            if best is None or r["offset"] > best[0]:
                best = (int(r["offset"]), int(r["timestamp_us"]), None if r["value"] is None else bytes(r["value"]))
        if best is not None:
            self.last.update(best)
            if not known:
                self._wind(timerValues.getCurrentProcessingTimeInMs())
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        # a trigger that ran late skips the scrapes it missed; the next one is on the grid again
        self._wind(timerValues.getCurrentProcessingTimeInMs())
        offset, ts, value = self.last.get()
        at = expiredTimerInfo.getExpiryTimeInMs()
        yield pd.DataFrame({"topic": [key[0]], "partition": [key[1]], "offset": [offset], "timestamp_us": [ts],
                            "value": [value], "scrape_ms": [at]})

    def close(self) -> None:
        pass


def scraped_records(records: DataFrame, period: int = SCRAPE_PERIOD) -> DataFrame:
    """The last record of each partition at every scrape: topic, partition, offset, timestamp, value, at."""
    rows = lag.topic_filter(records).select(
        "topic", F.col("partition").cast("int"), F.col("offset").cast("bigint"), F.unix_micros("timestamp").alias("timestamp_us"), "value")
    out = rows.groupBy("topic", "partition").transformWithStateInPandas(
        statefulProcessor=LastRecord(period), outputStructType=SCRAPED, outputMode="Append", timeMode="ProcessingTime")
    return out.select("topic", "partition", "offset", F.timestamp_micros("timestamp_us").alias("timestamp"), "value",
                      F.timestamp_millis("scrape_ms").alias("at"))


def lag_clock_stream(records: DataFrame, metrics_path: str, checkpoint: str, period: int = SCRAPE_PERIOD,
                     decoder: lag.Decoder = lag.json_decoder):
    """M10 by the clock: gauge rows (at, metric, labels, value) of every scrape, written under ``batch_id=<n>``.

    A replayed batch replaces its own folder; batches without a scrape write nothing. Returns the
    started query.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # a few rows for each partition
        try:
            if batch.limit(1).count():
                per_topic = lag.metrics_of_last(batch, F.col("at"), decoder, by=["at"])
                lag.metric_rows(per_topic, ["at"]).coalesce(1).write.mode("overwrite").parquet(f"{metrics_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    with _rocksdb(records.sparkSession):
        return (scraped_records(records, period).writeStream.foreachBatch(write_batch).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(processingTime=f"{period} seconds").start())


class _rocksdb:
    """The state store that timers need, for the query started inside; other queries keep the session's."""

    KEY = "spark.sql.streaming.stateStore.providerClass"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(self.KEY, None)
        self.spark.conf.set(self.KEY, ROCKSDB)

    def __exit__(self, *_):
        if self.before is None:
            self.spark.conf.unset(self.KEY)
        else:
            self.spark.conf.set(self.KEY, self.before)
