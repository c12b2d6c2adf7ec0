"""Kafka connector options (S1, S7 and the scrape read of M3).

The ``spark-sql-kafka`` package is needed at run time; these helpers only build the
reader/writer with the options the pipeline uses, so the decode/encode halves in
:mod:`changelake.sources.framing` can be tested without a broker.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

# fixed values: where a new consumer starts
STARTING_OFFSETS = "earliest"
# records of a micro-batch over all partitions
MAX_OFFSETS_PER_TRIGGER = 50_000_000


def read_stream(spark: SparkSession, bootstrap_servers: str, topics: str | list[str], pattern: bool = False,
                starting_offsets: str = STARTING_OFFSETS,
                max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER, fail_on_data_loss: bool = True,
                extra: dict[str, str] | None = None) -> DataFrame:
    """S1 connector half: a streaming Kafka source. The consumer group's committed offset is
    replaced by the query's checkpoint (offsets are recorded after each micro-batch).

    Offsets that retention has removed before they were read fail the query, unless the
    caller accepts the gap with ``fail_on_data_loss=False``. A first run from the earliest
    offset is split into batches of ``max_offsets_per_trigger`` records (None: one batch)."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if pattern:
        reader = reader.option("subscribePattern", topics)
    else:
        reader = reader.option("subscribe", topics if isinstance(topics, str) else ",".join(topics))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (extra or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def tail_offsets(end_offsets: dict[str, dict[str, int]]) -> tuple[str, str]:
    """Batch-read bounds for "the last record of every non-empty partition" (M3).

    ``end_offsets``: topic -> partition -> high watermark. Returns (startingOffsets,
    endingOffsets) JSON for ``spark.read.format("kafka")``: start at high-1, end at high.
    """
    start = {t: {p: hi - 1 for p, hi in parts.items() if hi > 0} for t, parts in end_offsets.items()}
    end = {t: {p: hi for p, hi in parts.items() if hi > 0} for t, parts in end_offsets.items()}
    start = {t: p for t, p in start.items() if p}
    end = {t: p for t, p in end.items() if p}
    return json.dumps(start), json.dumps(end)


def read_tail(spark: SparkSession, bootstrap_servers: str, end_offsets: dict[str, dict[str, int]]) -> DataFrame:
    """Batch read of only the last record per partition (the scrape's minimal read)."""
    starting, ending = tail_offsets(end_offsets)
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("assign", json.dumps({t: list(map(int, p)) for t, p in json.loads(ending).items()}))
            .option("startingOffsets", starting).option("endingOffsets", ending).load())


def write_stream(df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
                 trigger_seconds: int | None = None):
    """S7 connector half: (key, value) rows to a topic; the checkpoint gives at-least-once."""
    w = (df.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", topic).option("checkpointLocation", checkpoint))
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w


def write_batch(df: DataFrame, bootstrap_servers: str, topic: str) -> None:
    df.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save()
