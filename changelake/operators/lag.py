"""Pipeline lag and freshness metrics over change topics.

The scrape works on a frame with the Kafka record schema (topic, partition, offset,
value, timestamp). The order is fixed: last record per partition (M3) -> keep
registry-framed values (M4) -> newest per topic (M5) -> decode -> metrics. Filtering
before M3 would give another answer: a partition whose last record is not framed
contributes nothing at all.

All steps are aggregates with a partial phase (``max_by``/``min``), so the shuffle
carries one row per (map task, topic-partition) at most, however many records a
topic holds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.temporal import mixed_ts_decode
from changelake.sources.framing import decode_avro, has_magic_byte, strip_confluent_frame, utf8_text

# fixed values: topics that are never scraped (internal, and Connect's own topics)
CONNECT_TOPIC_PATTERN = "connect-(configs|offsets|status)"
INTERNAL_PREFIX = "_"
# fixed values: gauge names of the lag metrics
SOURCE_TS_METRIC = "debezium_source_timestamp_seconds"
PROCESSING_TS_METRIC = "debezium_processing_timestamp_seconds"
SCHEMA_FRESHNESS_METRIC = "schema_freshness_seconds"


def topic_filter(topics: DataFrame, col: str = "topic") -> DataFrame:
    """M1: drop internal topics (leading ``_``) and Connect's config/offset/status topics."""
    t = F.col(col)
    return topics.filter(~t.startswith(INTERNAL_PREFIX) & ~t.rlike(CONNECT_TOPIC_PATTERN))


def topic_parts(topics: DataFrame, col: str = "topic", allow_four_parts: bool = False) -> DataFrame:
    """M2: keep ``prefix.schema.table`` names (exactly two dots) and split them.

    ``allow_four_parts`` also admits SQL Server's ``prefix.db.schema.table`` and folds
    ``db.schema`` into the schema part.
    """
    parts = F.split(F.col(col), r"\.")
    n = F.size(parts)
    if allow_four_parts:
        keep = n.isin(3, 4)
        schema = F.when(n == 4, F.concat_ws(".", parts[1], parts[2])).otherwise(parts[1])
        table = F.element_at(parts, -1)
    else:
        keep = n == 3
        schema, table = parts[1], parts[2]
    return topics.filter(keep).withColumns({"prefix": parts[0], "schema": schema, "table": table})


def last_per_partition(records: DataFrame) -> DataFrame:
    """M3: the record at the high watermark - 1 of every non-empty partition."""
    payload = [c for c in records.columns if c not in ("topic", "partition")]
    return (records.groupBy("topic", "partition")
            .agg(F.max_by(F.struct(*payload), F.col("offset")).alias("_r"))
            .select("topic", "partition", *[F.col("_r").getField(c).alias(c) for c in payload]))


def avro_magic_filter(records: DataFrame, col: str = "value") -> DataFrame:
    """M4: keep registry-framed values (first byte 0); null and empty values are dropped."""
    return records.filter(has_magic_byte(F.col(col)))


def latest_per_topic(records: DataFrame) -> DataFrame:
    """M5: per topic, the record with the greatest timestamp; ties go to the lowest partition."""
    payload = [c for c in records.columns if c != "topic"]
    order = F.struct(F.col("timestamp").alias("ts"), (-F.col("partition")).alias("neg_partition"))
    return (records.groupBy("topic")
            .agg(F.max_by(F.struct(*payload), order).alias("_r"))
            .select("topic", *[F.col("_r").getField(c).alias(c) for c in payload]))


def scrape_latest(records: DataFrame, topics_ok: bool = True) -> DataFrame:
    """M1 + M3 + M4 + M5 in the reference's order (only the columns the scrape needs are carried)."""
    records = records.select("topic", "partition", "offset", "timestamp", "value")
    if topics_ok:
        records = topic_filter(records)
    return latest_per_topic(avro_magic_filter(last_per_partition(records)))


# what the metrics need of an envelope; ts_ms as text, so both shapes survive: epoch ms or ISO text
ENVELOPE_TIMES = T.StructType([
    T.StructField("source", T.StructType([T.StructField("ts_ms", T.LongType())])),
    T.StructField("ts_ms", T.StringType()),
])

# (records with a framed ``value``, name of the struct column to add) -> records with that struct
Decoder = Callable[[DataFrame, str], DataFrame]


def json_decoder(records: DataFrame, out: str) -> DataFrame:
    """Registry-framed JSON envelopes; a body that does not decode gives nulls, so only its topic has no row."""
    return records.withColumn(out, F.from_json(utf8_text(strip_confluent_frame(F.col("value"))), ENVELOPE_TIMES))


def avro_decoder(avro_schema_json: str) -> Decoder:
    """Registry-framed Avro envelopes with the given writer schema (needs spark-avro)."""
    return lambda records, out: decode_avro(records, avro_schema_json, out=out)


def envelope_times(latest: DataFrame, decoder: Decoder = json_decoder) -> DataFrame:
    """Columns source_ts and debezium_ts from each record's envelope; ``decoder`` reads the body.

    The decoded struct must hold ``source.ts_ms`` (epoch ms) and ``ts_ms`` (epoch ms as
    number or text, or ISO text). ``_known`` is false for a record that does not decode.
    """
    decoded = decoder(latest, "_env").withColumn("_env", F.struct(
        F.struct(F.col("_env.source.ts_ms").cast("bigint").alias("ts_ms")).alias("source"),
        F.col("_env.ts_ms").cast("string").alias("ts_ms")))
    return (decoded
            .withColumn("_known", F.col("_env.source.ts_ms").isNotNull() & F.col("_env.ts_ms").isNotNull())
            .withColumn("source_ts", F.timestamp_millis(F.col("_env.source.ts_ms")))
            .withColumn("debezium_ts", mixed_ts_decode(F.col("_env.ts_ms")))
            .drop("_env"))


def decode_envelope_times(latest: DataFrame, decoder: Decoder = json_decoder) -> DataFrame:
    """:func:`envelope_times` of the records that decode; the others have no row."""
    return envelope_times(latest, decoder).filter("_known").drop("_known")


def _seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1000000.0).cast("double")


def cdc_latency(df: DataFrame) -> DataFrame:
    """M6: connector processing time minus source commit time, in seconds (may be negative)."""
    return df.withColumn("latency", _seconds_between(F.col("debezium_ts"), F.col("source_ts")))


def topic_freshness(df: DataFrame, now: dt.datetime | Column) -> DataFrame:
    """M7: ``max(now - debezium_ts, 0)`` in seconds. ``now`` is an argument, never the wall clock."""
    now_col = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    return df.withColumn("freshness", F.greatest(_seconds_between(now_col, F.col("debezium_ts")), F.lit(0.0)))


def schema_freshness(per_topic: DataFrame, at: Sequence[str] = ()) -> DataFrame:
    """M8: freshest topic per ``prefix.schema`` (and per scrape, where ``at`` names its columns)."""
    return per_topic.groupBy(*at, "prefix", "schema").agg(F.min("freshness").alias("freshness"))


def topic_metrics(records: DataFrame, now: dt.datetime | Column, decoder: Decoder = json_decoder) -> DataFrame:
    """M9 per-topic table: topic, prefix, schema, table, source_ts, debezium_ts, latency, freshness."""
    latest = decode_envelope_times(scrape_latest(records), decoder)
    named = topic_parts(latest)
    return topic_freshness(cdc_latency(named), now).select(
        "topic", "prefix", "schema", "table", "source_ts", "debezium_ts", "latency", "freshness")


def lag_report(records: DataFrame, now: dt.datetime | Column, decoder: Decoder = json_decoder) -> tuple[DataFrame, DataFrame]:
    """M9: per-topic metrics ordered by (prefix.schema, freshness) and per-schema freshness ordered by key."""
    per_topic = topic_metrics(records, now, decoder)
    ordered = per_topic.orderBy(F.concat_ws(".", "prefix", "schema"), "freshness", "topic")
    per_schema = schema_freshness(per_topic).orderBy("prefix", "schema")
    return ordered, per_schema


def metric_rows(per_topic: DataFrame, at: Sequence[str] = ()) -> DataFrame:
    """Gauge rows (``at`` columns, metric, labels, value) of a per-topic table; ``at`` names the scrape."""
    epoch = lambda c: F.unix_micros(F.col(c)) / F.lit(1000000.0).cast("double")
    topic_rows = per_topic.select(
        *at, F.concat(F.lit("topic="), F.col("topic")).alias("labels"),
        epoch("source_ts").alias(SOURCE_TS_METRIC),
        epoch("debezium_ts").alias(PROCESSING_TS_METRIC),
    ).unpivot([*at, "labels"], [SOURCE_TS_METRIC, PROCESSING_TS_METRIC], "metric", "value")
    schema_rows = schema_freshness(per_topic, at).select(
        *at, F.lit(SCHEMA_FRESHNESS_METRIC).alias("metric"),
        F.concat(F.lit("prefix="), F.col("prefix"), F.lit(",schema="), F.col("schema")).alias("labels"),
        F.col("freshness").alias("value"),
    )
    return topic_rows.select(*at, "metric", "labels", "value").unionByName(schema_rows)


def lag_metrics(records: DataFrame, now: dt.datetime | Column, decoder: Decoder = json_decoder) -> DataFrame:
    """Gauges as rows (metric, labels, value) ready for a table or topic sink."""
    return metric_rows(topic_metrics(records, now, decoder))


def metrics_of_last(last: DataFrame, at: Column, decoder: Decoder = json_decoder, by: Sequence[str] = ()) -> DataFrame:
    """The per-topic table from the last record of each partition (M4 -> M5 -> decode -> M2, M6, M7).

    ``by`` names columns of the scrape that a record belongs to, where ``last`` holds several
    scrapes; ``at`` is their clock.
    """
    newest = F.struct(F.col("timestamp").alias("ts"), (-F.col("partition")).alias("neg_partition"))
    payload = [c for c in last.columns if c not in ("topic", *by)]
    latest = (avro_magic_filter(last).groupBy("topic", *by).agg(F.max_by(F.struct(*payload), newest).alias("_r"))
              .select("topic", *by, *[F.col("_r").getField(c).alias(c) for c in payload]))
    named = topic_parts(decode_envelope_times(latest, decoder))
    return topic_freshness(cdc_latency(named), at).select(
        *by, "topic", "prefix", "schema", "table", "source_ts", "debezium_ts", "latency", "freshness")


def metrics_timeline(records: DataFrame, start: dt.datetime, end: dt.datetime, period: int = 60,
                     decoder: Decoder = json_decoder) -> DataFrame:
    """M7/M9 replayed: the per-topic table of every scrape from ``start`` to ``end``, ``period`` seconds apart.

    A scrape (column ``at``) sees the records with a timestamp up to its time; topics without a new
    record keep their last one, so their freshness grows.  Records are first reduced to the last of
    each partition and scrape (partial aggregate: a hot partition is as small as the scrapes), those
    are carried forward by a running maximum and stretched over the scrapes up to the next one;
    there is no join of records with times.
    """
    width, first = period * 1_000_000, F.unix_micros(F.lit(start).cast("timestamp"))
    scrapes = int((end - start).total_seconds()) // period
    behind = F.unix_micros("timestamp") - first
    tick = F.greatest(F.lit(0), F.ceil(behind / width)).cast("bigint")
    recs = topic_filter(records.select("topic", "partition", "offset", "timestamp", "value")).withColumn("_tick", tick)
    last = (recs.filter(F.col("_tick") <= scrapes).groupBy("topic", "partition", "_tick")
            .agg(F.max(F.struct("offset", "timestamp", "value")).alias("_r")))
    along = Window.partitionBy("topic", "partition").orderBy("_tick")
    last = last.withColumns({"_r": F.max("_r").over(along.rowsBetween(Window.unboundedPreceding, 0)),
                             "_next": F.lead("_tick").over(along)})
    # decoded once, before the rows are stretched
    times = envelope_times(avro_magic_filter(
        last.select("topic", "partition", "_tick", "_next", "_r.timestamp", "_r.value")), decoder).drop("value")
    until = F.coalesce(F.col("_next") - 1, F.lit(scrapes).cast("bigint"))
    each = times.withColumn("_tick", F.explode(F.sequence("_tick", until))).withColumn(
        "at", F.timestamp_micros(first + F.col("_tick") * width))
    newest = F.struct(F.col("timestamp").alias("ts"), (-F.col("partition")).alias("neg_partition"))
    # M5 takes the newest framed record whether it decodes or not; a topic whose newest does not has no row
    latest = each.groupBy("topic", "at").agg(F.max_by(F.struct("source_ts", "debezium_ts", "_known"), newest).alias("_r")).filter("_r._known")
    named = topic_parts(latest.select("topic", "at", "_r.source_ts", "_r.debezium_ts"))
    return topic_freshness(cdc_latency(named), F.col("at")).select(
        "at", "topic", "prefix", "schema", "table", "source_ts", "debezium_ts", "latency", "freshness")


def lag_metrics_timeline(records: DataFrame, start: dt.datetime, end: dt.datetime, period: int = 60,
                         decoder: Decoder = json_decoder) -> DataFrame:
    """M10 replayed: gauge rows (at, metric, labels, value) of every scrape."""
    return metric_rows(metrics_timeline(records, start, end, period, decoder), ["at"])
