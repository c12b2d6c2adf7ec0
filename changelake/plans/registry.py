"""Registered queries: one callable per operator of the inventory.

Each callable takes ``(spark, sf_dir)``, reads the driver tables (or frames Spark
derives from them) and returns a DataFrame with plain, aliased columns so it can be
compared with :mod:`changelake.plans.oracle`.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake import schemas
from changelake.functions import temporal as tm
from changelake.operators import bronze, catalog, ingest_rules, lag, offsets, patterns, topology, transforms
from changelake.plans import fixtures
from changelake.session import configure, materialize, read_table, scratch_path, write_tasks
from changelake.sources import catalog_io, compaction, framing, lake, versions
from changelake.streaming import bronze_files, jobs, late

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return deco


BRONZE_COLUMNS = ["__db_table", "id_iceberg", "partition", "offset", "user_id", "event_id", "event_type", "value",
                  "props", "__op", "__db", "__table", "last_applied_date"]


def bronze_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 change log through the connector's bronze chain."""
    ce = fixtures.change_events(fixtures.load_events(spark, sf_dir))
    return transforms.transform_chain(ce, transforms.BRONZE_CHAIN, topic_prefix=fixtures.TOPIC_PREFIX,
                                      overrides={"hashKey": {"key_fields": ["user_id"]}})


@register("bronze_latest_state")
def q_bronze_latest_state(spark, sf_dir):
    """Current state per (table, key) from the change log; deletes removed."""
    flat = bronze_flat(spark, sf_dir).select(*BRONZE_COLUMNS, "__deleted")
    return bronze.latest_state(flat)


# --- C*: change-event transforms -----------------------------------------------------

ENVELOPE_SUMMARY = ["topic", "partition", "offset", "op", "ts_ms"]
FLAT_COLUMNS = ["topic", "partition", "offset", "user_id", "event_id", "event_type", "value", "props",
                "__op", "__db", "__table", "__ts_ms", "__deleted"]


def _events(spark, sf_dir):
    return fixtures.load_events(spark, sf_dir)


@register("ignore_read_op")
def q_ignore_read_op(spark, sf_dir):
    """Snapshot reads dropped on matching topics."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    return transforms.ignore_read_op(ce, "^(local.*)\\..*").select(*ENVELOPE_SUMMARY)


@register("unwrap")
def q_unwrap(spark, sf_dir):
    """Envelope -> flat rows, deletes rewritten, tombstones dropped."""
    ce = fixtures.change_events(_events(spark, sf_dir), tombstones=True)
    return transforms.unwrap(ce).select(*FLAT_COLUMNS)


@register("drop_tombstones")
def q_drop_tombstones(spark, sf_dir):
    """C14: null-value records dropped from the raw Kafka frame."""
    recs = fixtures.kafka_records(_events(spark, sf_dir), framed=False, tombstones=True)
    return transforms.drop_tombstones(recs).select("topic", "partition", "offset")


@register("ts_convert")
def q_ts_convert(spark, sf_dir):
    """Envelope ts_ms -> yyyy-MM-dd'T'HH:mm:ss.SSS text (UTC)."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    return transforms.ts_convert(ce).select(*ENVELOPE_SUMMARY)


def _flat(spark, sf_dir):
    return transforms.unwrap(fixtures.change_events(_events(spark, sf_dir)))


@register("format_field")
def q_format_field(spark, sf_dir):
    """C4: __db_table = <db>_bronze.<table>."""
    return transforms.format_field(_flat(spark, sf_dir)).select("offset", "__db", "__table", "__db_table")


@register("replace_value")
def q_replace_value(spark, sf_dir):
    """__op codes c/u/d -> I/U/D, others unchanged."""
    return transforms.replace_value(_flat(spark, sf_dir)).select("offset", "__op")


@register("replace_field")
def q_replace_field(spark, sf_dir):
    """__ts_ms renamed to last_applied_date."""
    return transforms.replace_field(_flat(spark, sf_dir)).select("offset", "last_applied_date")


@register("hash_key")
def q_hash_key(spark, sf_dir):
    """md5 over the record key fields joined with '|'."""
    out = transforms.hash_key(_flat(spark, sf_dir), ["user_id", "__table"])
    return out.select("offset", "user_id", "__table", "id_iceberg")


TS_CHAIN = ("tsConvertor", "ignoreReadOp", "unwrap", "formatField", "replaceValue", "replaceField", "hashKey",
            "notATransform")


@register("transform_chain")
def q_transform_chain(spark, sf_dir):
    """Ordered chain with C3 first (text times), an unknown name skipped."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    out = transforms.transform_chain(ce, TS_CHAIN, topic_prefix="local",
                                     overrides={"hashKey": {"key_fields": ["user_id"]}})
    return out.select(*BRONZE_COLUMNS, "__deleted")


@register("table_include")
def q_table_include(spark, sf_dir):
    """Only listed tables of one database."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    return transforms.table_include(ce, "store", ["tb_click", "tb_purchase"]).select(*ENVELOPE_SUMMARY)


def _lake_rows(spark, sf_dir):
    return fixtures.lake_rows(read_table(spark, sf_dir, "orders"))


@register("tinyint1_to_boolean")
def q_tinyint1_to_boolean(spark, sf_dir):
    """TINYINT(1) -> boolean."""
    return transforms.tinyint1_to_boolean(_lake_rows(spark, sf_dir), ["boolean1"]).select("id", "boolean1")


@register("decimal_precise")
def q_decimal_precise(spark, sf_dir):
    """Exact decimal(12,8)."""
    df = _lake_rows(spark, sf_dir).withColumn("decimal1", F.col("decimal1").cast("string"))
    return transforms.decimal_precise(df, ["decimal1"]).select("id", "decimal1")


@register("normalize_char")
def q_normalize_char(spark, sf_dir):
    """SQL Server CHAR padding removed."""
    return transforms.normalize_char(_lake_rows(spark, sf_dir), ["char36"]).select("id", "char36")


@register("decode_temporal")
def q_decode_temporal(spark, sf_dir):
    """C11: DATE days, TIME micros, DATETIME ms/us and ISO text decoded (shown as text)."""
    rows = _lake_rows(spark, sf_dir)
    return rows.select(
        "id",
        F.date_format(tm.date_from_days("date1"), "yyyy-MM-dd").alias("date1"),
        tm.time_of_day_text("time1").alias("time1"),
        tm.iso_text(tm.timestamp_from_epoch("datetime1", tm.unit_for_precision(3))).alias("datetime1"),
        tm.iso_text(tm.timestamp_from_epoch("create_datetime", tm.unit_for_precision(6))).alias("create_datetime"),
        tm.iso_text(tm.iso_timestamp("update_timestamp")).alias("update_timestamp"),
    )


# --- M*: lag, freshness and topology -------------------------------------------------


FROZEN_NOW = _dt.datetime(2024, 2, 1, 0, 0, 0)  # frozen clock for freshness (UTC)


def _records(spark, sf_dir, text_ts=True):
    return fixtures.kafka_records(_events(spark, sf_dir), framed=True, text_ts=text_ts)


def _ms(c):
    return F.unix_millis(F.col(c))


@register("topic_filter")
def q_topic_filter(spark, sf_dir):
    """M1: internal and Connect topics dropped from the listing."""
    return lag.topic_filter(fixtures.topic_listing(_events(spark, sf_dir)))


@register("topic_parts")
def q_topic_parts(spark, sf_dir):
    """M2: prefix.schema.table names split (others dropped)."""
    t = lag.topic_parts(lag.topic_filter(fixtures.topic_listing(_events(spark, sf_dir))))
    return t.select("topic", "prefix", "schema", "table")


@register("last_per_partition")
def q_last_per_partition(spark, sf_dir):
    """M3: last record of every non-empty partition."""
    last = lag.last_per_partition(_records(spark, sf_dir))
    return last.select("topic", "partition", "offset", _ms("timestamp").alias("timestamp_ms"),
                       F.hex(F.substring("value", 1, 1)).alias("first_byte"))


@register("avro_magic_filter")
def q_avro_magic_filter(spark, sf_dir):
    """M4: records whose value starts with the registry magic byte."""
    return lag.avro_magic_filter(_records(spark, sf_dir)).select("topic", "partition", "offset")


@register("latest_per_topic")
def q_latest_per_topic(spark, sf_dir):
    """M5: M3 -> M4 -> newest per topic (timestamp, then lowest partition)."""
    latest = lag.scrape_latest(_records(spark, sf_dir))
    return latest.select("topic", "partition", "offset", _ms("timestamp").alias("timestamp_ms"))


@register("mixed_ts_decode")
def q_mixed_ts_decode(spark, sf_dir):
    """Connector time as epoch-ms digits or ISO text -> one instant."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    text = F.when(F.col("offset") % 2 == 1, tm.format_epoch_millis("ts_ms")).otherwise(F.col("ts_ms").cast("string"))
    out = ce.select("offset", text.alias("ts_text"))
    return out.withColumn("decoded_ms", F.unix_millis(tm.mixed_ts_decode("ts_text")))


def _topic_metrics(spark, sf_dir):
    return lag.topic_metrics(_records(spark, sf_dir), FROZEN_NOW)


@register("cdc_latency")
def q_cdc_latency(spark, sf_dir):
    """M6: processing minus source time per topic, seconds."""
    m = _topic_metrics(spark, sf_dir)
    return m.select("topic", _ms("source_ts").alias("source_ts_ms"), _ms("debezium_ts").alias("debezium_ts_ms"),
                    "latency")


@register("topic_freshness")
def q_topic_freshness(spark, sf_dir):
    """M7: seconds since the newest processed change per topic (frozen clock, clamped at 0)."""
    return _topic_metrics(spark, sf_dir).select("topic", "freshness")


@register("schema_freshness")
def q_schema_freshness(spark, sf_dir):
    """M8: freshest topic per prefix.schema."""
    return lag.schema_freshness(_topic_metrics(spark, sf_dir))


@register("lag_report")
def q_lag_report(spark, sf_dir):
    """M9: the per-topic report (ordered by prefix.schema, freshness)."""
    per_topic, _ = lag.lag_report(_records(spark, sf_dir), FROZEN_NOW)
    return per_topic.select(
        "topic", "prefix", "schema", "table",
        F.date_format("source_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("source_ts"),
        F.date_format("debezium_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("debezium_ts"),
        "latency", "freshness")


@register("lag_report_damaged")
def q_lag_report_damaged(spark, sf_dir):
    """M9 over topics of which some end in a record that is not UTF-8: only those have no row."""
    recs = fixtures.spoiled_records(_records(spark, sf_dir), 3)
    return lag.topic_metrics(recs, FROZEN_NOW).select("topic", "latency", "freshness")


@register("lag_metrics")
def q_lag_metrics(spark, sf_dir):
    """Gauges as (metric, labels, value) rows."""
    return lag.lag_metrics(_records(spark, sf_dir), FROZEN_NOW)


@register("lag_metrics_timeline")
def q_lag_metrics_timeline(spark, sf_dir):
    """M10 by the clock: gauges of an hourly scrape over the whole log, topics without news included."""
    recs = fixtures.spoiled_records(_records(spark, sf_dir), 5)
    out = lag.lag_metrics_timeline(recs, _dt.datetime(2024, 1, 1), FROZEN_NOW, period=3600)
    return out.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


def _topology_inputs(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return fixtures.topic_listing(ev), fixtures.assignments(ev), fixtures.consumer_groups(ev)


@register("topic_consumers")
def q_topic_consumers(spark, sf_dir):
    """Topic -> sorted groups (one entry per partition held; idle topic -> empty)."""
    topics, assign, _ = _topology_inputs(spark, sf_dir)
    return topology.topic_consumers(topics, assign).select("topic", "groups_text")


@register("consumer_topics")
def q_consumer_topics(spark, sf_dir):
    """Group -> sorted distinct topics (group without members -> empty)."""
    _, assign, groups = _topology_inputs(spark, sf_dir)
    return topology.consumer_topics(groups, assign).select("group_id", "topics_text")


@register("connectors_by_worker")
def q_connectors_by_worker(spark, sf_dir):
    """Connectors grouped by worker host."""
    status = fixtures.connector_status(read_table(spark, sf_dir, "nation"))
    return topology.connectors_by_worker(status).select("worker_host", "connectors_text", "n_connectors")


# --- T*: catalog specification, audit, reconciliation ------------------------------


TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _spec_out(spec):
    return spec.withColumns({c: F.date_format(c, TS_TEXT) for c in ("CREATE_TIME", "UPDATE_TIME")})


def _cat(spark, sf_dir):
    """Catalog views for one query: derived once, snapshotted, then joined as needed."""
    return fixtures.load_catalog(spark, sf_dir)


def _mysql_spec(spark, sf_dir, ordered=False, c=None):
    c = _cat(spark, sf_dir) if c is None else c
    return catalog.mysql_table_spec(c["tables"], c["columns"], c["key_usage"], c["include"], ordered=ordered)


def _mssql_spec(spark, sf_dir, ordered=False, c=None):
    c = _cat(spark, sf_dir) if c is None else c
    return catalog.mssql_table_spec(c["tables"], c["columns"], c["key_usage"], c["partitions"], c["ext_props"],
                                    c["identity"], c["include"], ordered=ordered)


def _second_spec(spark, sf_dir, c=None):
    c = _cat(spark, sf_dir) if c is None else c
    return catalog.mysql_table_spec(c["tables"], c["second_columns"], c["key_usage"], c["include"], ordered=False)


@register("mysql_table_spec")
def q_mysql_table_spec(spark, sf_dir):
    """MySQL specification (ordered report)."""
    return _spec_out(_mysql_spec(spark, sf_dir, ordered=True))


@register("mssql_table_spec")
def q_mssql_table_spec(spark, sf_dir):
    """SQL Server specification (ordered report)."""
    return _spec_out(_mssql_spec(spark, sf_dir, ordered=True))


@register("pk_columns")
def q_pk_columns(spark, sf_dir):
    """Db.table.column of primary-key columns (SQL Server spec)."""
    return catalog.pk_columns(_mssql_spec(spark, sf_dir))


@register("tables_without_pk")
def q_tables_without_pk(spark, sf_dir):
    """T4: tables without any primary-key column (SQL Server spec)."""
    return catalog.tables_without_pk(_mssql_spec(spark, sf_dir))


@register("table_row_count")
def q_table_row_count(spark, sf_dir):
    """T5: rows per object over index 0/1 partitions."""
    return catalog.table_row_count(_cat(spark, sf_dir)["partitions"])


@register("pk_name_match")
def q_pk_name_match(spark, sf_dir):
    """Primary-key columns found by constraint name."""
    return catalog.pk_name_match(_cat(spark, sf_dir)["key_usage"])


@register("unique_name_match")
def q_unique_name_match(spark, sf_dir):
    """Unique columns found by constraint name."""
    return catalog.unique_name_match(_cat(spark, sf_dir)["key_usage"])


@register("spec_union")
def q_spec_union(spark, sf_dir):
    """Both engines' specifications concatenated by name, tagged with the engine."""
    c = _cat(spark, sf_dir)
    my = _mysql_spec(spark, sf_dir, c=c).withColumn("ENGINE", F.lit("mysql"))
    ms = _mssql_spec(spark, sf_dir, c=c).withColumn("ENGINE", F.lit("mssql")).drop("COLUMN_EXTRA")
    return _spec_out(catalog.spec_union(my, ms))


@register("space_used")
def q_space_used(spark, sf_dir):
    """Space-used rows with sizes as numbers."""
    return catalog.space_used(fixtures.space_used_frames(read_table(spark, sf_dir, "part")))


@register("type_map")
def q_type_map(spark, sf_dir):
    """SQL Server type + length -> MySQL-style and Spark types."""
    m = catalog.type_map(_mssql_spec(spark, sf_dir))
    return m.select("DB_NAME", "TABLE_NAME", "COLUMN_NAME", "DATA_TYPE", "COLUMN_LENGTH", "mysql_type",
                    "type_changed", "spark_type")


@register("type_change_report")
def q_type_change_report(spark, sf_dir):
    """Columns whose type changes."""
    return catalog.type_change_report(_mssql_spec(spark, sf_dir))


@register("pk_list_per_table")
def q_pk_list_per_table(spark, sf_dir):
    """Key columns per table in column order."""
    return catalog.pk_list_per_table(_mssql_spec(spark, sf_dir))


def _match_out(m):
    return m.select("DB_NAME", "TABLE_NAME", "idx", F.col("src_COLUMN_NAME").alias("src_column"),
                    F.col("dst_COLUMN_NAME").alias("dst_column"))


@register("comment_match_by_name")
def q_comment_match_by_name(spark, sf_dir):
    """SQL Server columns matched to MySQL columns by exact name."""
    c = _cat(spark, sf_dir)
    return _match_out(catalog.comment_match_by_name(_mssql_spec(spark, sf_dir, c=c), _second_spec(spark, sf_dir, c=c)))


@register("comment_match_by_sequence")
def q_comment_match_by_sequence(spark, sf_dir):
    """SQL Server columns paired with MySQL columns by position."""
    c = _cat(spark, sf_dir)
    return _match_out(catalog.comment_match_by_sequence(_mssql_spec(spark, sf_dir, c=c),
                                                        _second_spec(spark, sf_dir, c=c)))


@register("comment_rows")
def q_comment_rows(spark, sf_dir):
    """Comment statements for the target engine (name matching)."""
    c = _cat(spark, sf_dir)
    m = catalog.comment_match_by_name(_mssql_spec(spark, sf_dir, c=c), _second_spec(spark, sf_dir, c=c))
    return catalog.comment_rows(m)


@register("bronze_comment_rows")
def q_bronze_comment_rows(spark, sf_dir):
    """Comment statements for the bronze tables."""
    return catalog.bronze_comment_rows(_mysql_spec(spark, sf_dir))


@register("data_dictionary")
def q_data_dictionary(spark, sf_dir):
    """Data dictionary rows per table."""
    return catalog.data_dictionary(_mssql_spec(spark, sf_dir))


# --- R*: ingest rules ------------------------------------------------------------------


def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders")


@register("rules_tidy")
def q_rules_tidy(spark, sf_dir):
    """Selection rules of rule-set documents; dbo replaced by the last rename target."""
    docs = fixtures.rule_set_documents(_orders(spark, sf_dir))
    return ingest_rules.rules_tidy(ingest_rules.parse_rule_sets(docs))


@register("tasks_tidy")
def q_tasks_tidy(spark, sf_dir):
    """R2: task descriptions -> 6 columns."""
    return ingest_rules.tasks_tidy(fixtures.task_documents(_orders(spark, sf_dir)))


@register("ingest_plan_mssql")
def q_ingest_plan_mssql(spark, sf_dir):
    """SQL Server rule plan."""
    lists = fixtures.ingest_lists(_orders(spark, sf_dir), "mssql")
    return ingest_rules.ingest_plan_mssql(**lists)


@register("ingest_plan_mysql")
def q_ingest_plan_mysql(spark, sf_dir):
    """MySQL rule plan (excluded tables leave gaps in the ids)."""
    lists = fixtures.ingest_lists(_orders(spark, sf_dir), "mysql")
    return ingest_rules.ingest_plan_mysql(**lists)


@register("table_selection")
def q_table_selection(spark, sf_dir):
    """Listed tables minus excluded ones."""
    lists = fixtures.ingest_lists(_orders(spark, sf_dir), "mssql")
    return ingest_rules.table_selection(lists["tables"], lists["except_tables"])


@register("type_fit_report")
def q_type_fit_report(spark, sf_dir):
    """T10 on data: what the casts of a text export to its specified types null or round."""
    df = fixtures.text_extract(_orders(spark, sf_dir))
    return catalog.type_fit_report(df, fixtures.text_extract_spec(spark), "sales", "export")


@register("cast_misfits")
def q_cast_misfits(spark, sf_dir):
    """T10 on data: every value that the casts null, with its row's key."""
    df = fixtures.text_extract(_orders(spark, sf_dir))
    return catalog.cast_misfits(df, fixtures.text_extract_spec(spark), "sales", "export", ["id"])


@register("wildcard_selection")
def q_wildcard_selection(spark, sf_dir):
    """Listed tables selected by rules with wildcards in schema and table; exclude beats include."""
    orders = _orders(spark, sf_dir)
    name = F.split("name", r"\.")
    names = fixtures.ingest_lists(orders, "mysql")["tables"].select(name[0].alias("schema"), name[1].alias("table"))
    return patterns.wildcard_selection(names, fixtures.pattern_rules(orders))


def _b1_plan_lists(spark, flat):
    # the list of names is derived once; the plan's several uses of it do not scan the events again
    names = materialize(flat.select(F.concat(F.col("__db"), F.lit(".dbo."), F.upper("__table")).alias("name")).distinct(), "names")
    mk = lambda xs: spark.createDataFrame([(x,) for x in xs], "name string")
    return {"tables": names,
            "except_tables": mk(["billing.dbo.TB_ERROR"]),
            "except_columns": mk(["store.dbo.TB_VIEW.props", "billing.dbo.TB_CLICK.value"]),
            "lower_case_tables": mk(["store.dbo.TB_CLICK", "store.dbo.TB_VIEW", "billing.dbo.TB_PURCHASE"])}


@register("apply_ingest_plan")
def q_apply_ingest_plan(spark, sf_dir):
    """A rule plan applied to the change rows of all tables at once."""
    ce = fixtures.change_events(_events(spark, sf_dir)).withColumn("commit_ms", F.col("source.ts_ms"))
    flat = transforms.unwrap(ce, keep=("offset", "commit_ms"))
    plan = ingest_rules.ingest_plan_mssql(**_b1_plan_lists(spark, flat), numbered=False)
    rows = flat.withColumn("_upper_table", F.upper("__table"))
    out = ingest_rules.apply_ingest_plan(rows, plan, "__db", "_upper_table", F.timestamp_millis("commit_ms"),
                                         ["user_id", "event_id", "event_type", "value", "props"])
    return out.select("target_schema", "target_table", "offset", "user_id", "event_id", "event_type", "value",
                      "props", F.unix_millis("cdc_dt").alias("cdc_dt_ms"))


# --- S*: sources, sinks, framing ------------------------------------------------------


B1_SOURCE = schemas.SOURCE
B1_ENVELOPE = schemas.envelope(T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType())]))
GSR_VERSION_ID = "0f8fad5b-d9cb-469f-a165-70867728950e"  # schema-version id used for the GSR fixtures


def _decoded_summary(df, data="data"):
    d = F.col(data)
    return df.select("topic", "partition", "offset", d.getField("op").alias("op"),
                     F.coalesce(d.getField("after").getField("user_id"),
                                d.getField("before").getField("user_id")).alias("user_id"),
                     d.getField("source").getField("ts_ms").alias("source_ts_ms"))


@register("kafka_json_source")
def q_kafka_json_source(spark, sf_dir):
    """S1 (decode half): plain UTF-8 JSON change events decoded with an explicit schema."""
    recs = fixtures.kafka_records(_events(spark, sf_dir), framed=False)
    return _decoded_summary(framing.decode_json(recs, B1_ENVELOPE))


@register("confluent_frame_decode")
def q_confluent_frame_decode(spark, sf_dir):
    """S2 (frame half): magic byte and schema id of registry-framed values."""
    recs = fixtures.kafka_records(_events(spark, sf_dir), framed=True)
    return recs.select("topic", "partition", "offset", framing.has_magic_byte("value").alias("has_frame"),
                       framing.confluent_schema_id("value").alias("schema_id"))


@register("confluent_jsonschema_decode")
def q_confluent_jsonschema_decode(spark, sf_dir):
    """S3: registry-framed JSON values decoded (unframed values decode without a schema id)."""
    recs = fixtures.kafka_records(_events(spark, sf_dir), framed=True)
    dec = framing.decode_json(recs, B1_ENVELOPE, frame="confluent")
    return dec.select("topic", "partition", "offset", "schema_id", F.col("data.op").alias("op"),
                      F.col("data.ts_ms").alias("ts_ms"))


def _flat_small(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", "user_id", "event_type")


@register("kafka_json_sink")
def q_kafka_json_sink(spark, sf_dir):
    """S7 (encode half): rows -> (key, JSON value) records."""
    rows = _flat_small(spark, sf_dir)
    enc = framing.encode_json(rows.select("user_id", "event_id", "event_type"),
                              key=F.encode(F.col("user_id").cast("string"), "UTF-8"))
    return enc.select(F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"))


@register("confluent_jsonschema_encode")
def q_confluent_jsonschema_encode(spark, sf_dir):
    """Rows -> magic byte + schema id + JSON (shown as hex)."""
    rows = _flat_small(spark, sf_dir).select("user_id", "event_id", "event_type")
    enc = framing.encode_json(rows, schema_id=fixtures.SCHEMA_ID, key=F.lit(None).cast("binary"))
    return enc.select(F.hex("value").alias("value_hex"))


def _gsr_records(spark, sf_dir):
    rows = _flat_small(spark, sf_dir)
    body = F.encode(F.to_json(F.struct("user_id", "event_id", "event_type")), "UTF-8")
    return rows.select("event_id", framing.gsr_frame(body, GSR_VERSION_ID).alias("value"))


@register("gsr_jsonschema_encode")
def q_gsr_jsonschema_encode(spark, sf_dir):
    """Rows -> GSR header (version 3, no compression, schema-version id) + JSON, as hex."""
    return _gsr_records(spark, sf_dir).select("event_id", F.hex("value").alias("value_hex"))


@register("gsr_frame_decode")
def q_gsr_frame_decode(spark, sf_dir):
    """S4 (frame half): GSR header fields of framed values."""
    r = _gsr_records(spark, sf_dir)
    return r.select("event_id", framing.is_gsr_framed("value").alias("has_frame"),
                    framing.gsr_compression("value").alias("compression"),
                    framing.gsr_schema_version("value").alias("schema_version"))


@register("gsr_jsonschema_decode")
def q_gsr_jsonschema_decode(spark, sf_dir):
    """GSR-framed JSON values decoded."""
    r = _gsr_records(spark, sf_dir)
    dec = framing.decode_json(r, T.StructType.fromDDL("user_id BIGINT, event_id BIGINT, event_type STRING"),
                              frame="gsr")
    return dec.select(F.col("event_id").alias("offset"), "schema_version", F.col("data.user_id").alias("user_id"),
                      F.col("data.event_type").alias("event_type"))


@register("connect_json_decode")
def q_connect_json_decode(spark, sf_dir):
    """Kafka Connect JSON with the schema/payload wrapper (schemas.enable=true)."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    wrapped = F.concat(F.lit('{"schema":{"type":"struct","optional":false},"payload":'), fixtures.envelope_json(ce),
                       F.lit("}"))
    recs = ce.select("topic", "partition", "offset", F.encode(wrapped, "UTF-8").alias("value"))
    return _decoded_summary(framing.connect_json_decode(recs, B1_ENVELOPE, schemas_enable=True))


@register("connect_json_dead_letters")
def q_connect_json_dead_letters(spark, sf_dir):
    """S6 + S21: wrapped values that are not UTF-8 or not JSON, with the reason."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    wrapped = F.concat(F.lit('{"schema":{"type":"struct","optional":false},"payload":'), fixtures.envelope_json(ce), F.lit("}"))
    recs = ce.select("topic", "partition", "offset", F.encode(wrapped, "UTF-8").alias("value"))
    recs = fixtures.spoiled_records(recs, 19).withColumn(
        "value", F.when(F.col("offset") % 23 == 0, F.substring("value", 1, 40)).otherwise(F.col("value")))
    dec = framing.connect_json_decode(recs, B1_ENVELOPE, schemas_enable=True)
    _, dead = lake.split_dead_letters(dec, "data", framing.decode_error("value", "data"))
    return dead.select("topic", "partition", "offset", "error")


@register("json_archive_sink")
def q_json_archive_sink(spark, sf_dir):
    """Messages archived as JSON lines under topic/partition, read back; some are not UTF-8."""
    recs = fixtures.spoiled_records(fixtures.kafka_records(_events(spark, sf_dir), framed=False), 19)
    path = scratch_path(spark, "archive")
    lake.write_archive(recs, path)
    back = lake.read_archive(spark, path)
    return back.select("topic", "partition", "offset", F.get_json_object("message", "$.op").alias("op"),
                       F.col("message").isNotNull().alias("is_text"), F.hex(F.substring("value", 21, 1)).alias("byte_21"))


def _write_lake(spark, sf_dir):
    ce = fixtures.change_events(_events(spark, sf_dir), tombstones=True)
    path = scratch_path(spark, "lake")
    lake.write_lake(lake.prepare_lake_rows(ce), path)
    return path


@register("lake_daily_sink")
def q_lake_daily_sink(spark, sf_dir):
    """Change events written to the daily lake (KST days), every row read back."""
    back = lake.scan_lake(spark, _write_lake(spark, sf_dir))
    return back.select("topic", "year", "month", "day", "offset", "op", "ts_ms", F.col("source.pos").alias("pos"),
                       F.coalesce("after.user_id", "before.user_id").alias("user_id"))


@register("lake_compact")
def q_lake_compact(spark, sf_dir):
    """A lake of many small files compacted; per day the rows and that one file is left."""
    ce = fixtures.change_events(_events(spark, sf_dir), tombstones=True)
    path, out = scratch_path(spark, "lake"), scratch_path(spark, "lake-compact")
    # costs by the file, not by the byte: dealt over tasks, a folder's rows to few of them, so that files are full
    rows = lake.prepare_lake_rows(ce).repartitionByRange(write_tasks(spark), *lake.PARTITION_COLUMNS, "offset")
    lake.write_lake(rows, path, max_records_per_file=20, fresh=True)
    lake.compact_lake(spark, path, out)
    back = lake.scan_lake(spark, out).withColumn("_file", F.input_file_name())
    return back.groupBy("topic", "year", "month", "day").agg(
        F.count("*").alias("n_rows"), F.sum("offset").alias("sum_offset"), F.countDistinct("_file").alias("n_files"))


@register("lake_compact_by_size")
def q_lake_compact_by_size(spark, sf_dir):
    """A lake of many small files compacted in place; per day the rows and the files left, and what a rerun merges."""
    ce = fixtures.change_events(_events(spark, sf_dir), tombstones=True)
    path = scratch_path(spark, "lake")
    # costs by the file, not by the byte: dealt over tasks, a folder's rows to few of them, so that files are full
    rows = lake.prepare_lake_rows(ce).repartitionByRange(write_tasks(spark), *lake.PARTITION_COLUMNS, "offset")
    lake.write_lake(rows, path, max_records_per_file=20, fresh=True)
    compaction.compact_small_files(spark, path)
    again = compaction.compact_small_files(spark, path).count()
    back = lake.scan_lake(spark, path).withColumn("_file", F.input_file_name())
    return back.groupBy("topic", "year", "month", "day").agg(
        F.count("*").alias("n_rows"), F.sum("offset").alias("sum_offset"), F.countDistinct("_file").alias("n_files"),
        F.lit(again).cast("bigint").alias("n_again"))


@register("lake_table_scan")
def q_lake_table_scan(spark, sf_dir):
    """Lake scan with an explicit schema, pruned to local days 2024-01-10..2024-01-20."""
    path = _write_lake(spark, sf_dir)
    schema = lake.lake_schema(B1_ENVELOPE, T.StructType.fromDDL("`partition` INT, `offset` BIGINT, `timestamp` TIMESTAMP"))
    back = lake.scan_lake(spark, path, schema, start=_dt.date(2024, 1, 10), end=_dt.date(2024, 1, 20))
    return back.select("topic", "offset", "op", "year", "month", "day")


@register("schema_evolution_scan")
def q_schema_evolution_scan(spark, sf_dir):
    """Files of two schema versions (boolean1 int -> boolean, text1 added) read as one."""
    rows = _lake_rows(spark, sf_dir)
    base = scratch_path(spark, "versions")
    v1, v2 = f"{base}/v1", f"{base}/v2"
    rows.filter(F.col("id") % 2 == 0).select("id", "boolean1", "decimal1").write.parquet(v1)
    rows.filter(F.col("id") % 2 == 1).select("id", (F.col("boolean1") != 0).alias("boolean1"), "decimal1",
                                              "text1").write.parquet(v2)
    target = T.StructType.fromDDL("id INT, boolean1 BOOLEAN, decimal1 DECIMAL(12,8), text1 STRING")
    return lake.scan_versions(spark, [v1, v2], target)


def _mixed_folder(spark, sf_dir):
    """Row images of ``orders`` in one folder by status, written under three schema versions."""
    rows = _lake_rows(spark, sf_dir)
    path = scratch_path(spark, "mixed")
    day = F.struct(F.col("id").alias("key"), F.col("date1"))
    v1 = rows.filter("id % 3 = 0").select("id", "boolean1", F.col("integer2").cast("int").alias("integer2"), "decimal1",
                                         F.col("float1").cast("float").alias("float1"), day.alias("image"), "varchar36")
    v2 = rows.filter("id % 3 = 1").select("id", (F.col("boolean1") != 0).alias("boolean1"), "integer2",
                                         F.col("decimal1").cast("decimal(16,4)").alias("decimal1"), F.col("double1").alias("float1"),
                                         "text1", F.struct(F.col("id").cast("bigint").alias("key"), "date1", "text1").alias("image"), "varchar36")
    v3 = rows.filter("id % 3 = 2").select("integer2", "id", F.col("id").cast("string").alias("text1"), F.col("id").alias("float1"),
                                         F.col("id").alias("decimal1"), "varchar36")
    for v in (v1, v2, v3):
        v.write.mode("append").partitionBy("varchar36").parquet(path)
    return path


@register("schema_versions_found")
def q_schema_versions_found(spark, sf_dir):
    """A folder of three mixed versions read without naming them."""
    out = versions.scan_folder(spark, _mixed_folder(spark, sf_dir))
    return out.select("id", "varchar36", "boolean1", "integer2", "decimal1", "float1", "text1", F.col("image.key").alias("image_key"),
                      F.col("image.date1").alias("image_date1"), F.col("image.text1").alias("image_text1"))


@register("schema_versions")
def q_schema_versions(spark, sf_dir):
    """The versions that the folder's footers show, by their columns, and the rows behind each."""
    path = _mixed_folder(spark, sf_dir)
    found = versions.find_versions(spark, path).select("schema_json", F.explode("files").alias("file"))
    rows = spark.read.schema("integer2 STRING").parquet(path).select(F.col("_metadata.file_path").alias("file")).groupBy("file").count()
    names = F.transform(F.from_json("schema_json", "fields ARRAY<STRUCT<name: STRING>>")["fields"], lambda f: f["name"])
    # both are paths as URIs, which differ in slashes only
    key = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return (found.withColumn("_k", key("file")).join(rows.withColumn("_k", key("file")).drop("file"), "_k")
            .groupBy(F.array_join(names, ",").alias("columns")).agg(F.sum("count").alias("n_rows")))


@register("spec_snapshot_io")
def q_spec_snapshot_io(spark, sf_dir):
    """Specification saved as Parquet and reloaded; blank text becomes null."""
    path = scratch_path(spark, "spec")
    catalog_io.save_spec(_mysql_spec(spark, sf_dir), path)
    return _spec_out(catalog_io.load_spec(spark, path))


@register("dead_letter_split")
def q_dead_letter_split(spark, sf_dir):
    """Records without the registry frame, with a cut header, an undecodable body, or bytes that are not UTF-8."""
    recs = fixtures.damaged_records(_events(spark, sf_dir))
    dec = framing.decode_json(recs, B1_ENVELOPE, frame="confluent")
    _, dead = lake.split_dead_letters(dec, "data", framing.decode_error("value", "data", "confluent"))
    return dead.select("topic", "partition", "offset", "error")


@register("capture_accounting")
def q_capture_accounting(spark, sf_dir):
    """S21/S12/C14 together: per topic every record is a lake row, a dead letter or a tombstone."""
    recs = fixtures.damaged_records(_events(spark, sf_dir))
    events, dead = jobs.capture_split(recs, B1_ENVELOPE)
    path = scratch_path(spark, "capture")
    lake.write_lake(lake.prepare_lake_rows(events), path)
    return offsets.account(recs, {"lake": lake.scan_lake(spark, path), "dead": dead, "tombstones": recs.filter("value IS NULL")})


@register("replayed_capture")
def q_replayed_capture(spark, sf_dir):
    """Ranges that a consumer saw twice and three times reach the lake and the dead letters once."""
    recs = fixtures.replayed_records(_events(spark, sf_dir))
    events, dead = jobs.capture_split(offsets.drop_replayed(recs), B1_ENVELOPE)
    path = scratch_path(spark, "capture")
    lake.write_lake(lake.prepare_lake_rows(events), path)
    return offsets.account(recs, {"lake": lake.scan_lake(spark, path), "dead": dead,
                                  "tombstones": offsets.drop_replayed(recs.filter("value IS NULL"))})


@register("offset_gaps")
def q_offset_gaps(spark, sf_dir):
    """Missing and repeated offset ranges of a topic, against the broker's bounds; small slices, many borders."""
    ev = _events(spark, sf_dir)
    return offsets.offset_gaps(fixtures.broken_journal(ev), fixtures.journal_bounds(ev), width=64)


@register("confluent_jsonschema_decode_versions")
def q_confluent_jsonschema_decode_versions(spark, sf_dir):
    """S3: two registry schema versions in one topic, each record decoded by its own."""
    rows = _events(spark, sf_dir).select("event_id", "user_id", "event_type")
    v1 = F.encode(F.to_json(F.struct("event_id", "user_id")), "UTF-8")
    v2 = F.encode(F.to_json(F.struct("event_id", "user_id", "event_type")), "UTF-8")
    sid = F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 3 == 1, 2).otherwise(9)
    recs = rows.select("event_id", framing.confluent_frame(F.when(F.col("event_id") % 3 == 0, v1).otherwise(v2), sid).alias("value"))
    dec = framing.decode_json_by_schema_id(recs, {1: T.StructType.fromDDL("event_id BIGINT, user_id BIGINT"),
                                                  2: T.StructType.fromDDL("event_id BIGINT, user_id BIGINT, event_type STRING")})
    return dec.select(F.col("event_id").alias("offset"), "schema_id", "data.user_id", "data.event_type")


@register("gsr_zlib_decode")
def q_gsr_zlib_decode(spark, sf_dir):
    """Zlib-compressed GSR bodies; a stored deflate block needs no compressor to be built here.

    Every fifth body is damaged, which makes it a dead letter.
    """
    rows = _flat_small(spark, sf_dir)
    body = F.encode(F.to_json(F.struct("user_id", "event_id", "event_type")), "UTF-8")
    framed = framing.gsr_frame(fixtures.zlib_stored(body), GSR_VERSION_ID)
    head = F.concat(F.substring(framed, 1, 1), F.lit(bytes([framing.GSR_COMPRESSION_ZLIB])))
    value = F.concat(head, F.substring(framed, F.lit(3), F.octet_length(framed) - F.when(F.col("event_id") % 5 == 0, 9).otherwise(0)))
    dec = framing.decode_json(rows.select("event_id", value.alias("value")),
                              T.StructType.fromDDL("user_id BIGINT, event_id BIGINT, event_type STRING"), frame="gsr", inflate=True)
    return dec.select(F.col("event_id").alias("offset"), F.col("data.user_id").alias("user_id"),
                      framing.decode_error("value", "data", "gsr").alias("error"))


@register("bronze_head")
def q_bronze_head(spark, sf_dir):
    """First ten rows of the bronze state in key order."""
    state = q_bronze_latest_state(spark, sf_dir)
    return catalog_io.bronze_head(state, ["__db_table", "id_iceberg"], 10)


@register("bronze_upsert")
def q_bronze_upsert(spark, sf_dir):
    """State as of 2024-01-15 folded with the later changes (equals the full fold)."""
    flat = bronze_flat(spark, sf_dir).select(*BRONZE_COLUMNS, "__deleted", "timestamp")
    cut = F.lit(_dt.datetime(2024, 1, 15)).cast("timestamp")
    before = flat.filter(F.col("timestamp") < cut).drop("timestamp")
    after = flat.filter(F.col("timestamp") >= cut).drop("timestamp")
    state = bronze.latest_state(before, keep_deletes=True)
    return bronze.live_rows(bronze.upsert(state, after))


@register("bronze_upsert_by_file")
def q_bronze_upsert_by_file(spark, sf_dir):
    """The change log folded into a state of files in four batches (days 1-8, 9-15, 16-23 and on), out of order inside."""
    flat = bronze_flat(spark, sf_dir).select(*BRONZE_COLUMNS, "__deleted", "timestamp")
    path = scratch_path(spark, "bronze-files")
    day = F.floor(F.datediff("timestamp", F.lit(_dt.date(2024, 1, 1))) / 8)
    for n in range(4):
        part = F.least(F.greatest(day, F.lit(0)), F.lit(3)) == n
        bronze_files.fold_batch(flat.filter(part).drop("timestamp"), n, path, bronze.DEFAULT_KEY, bronze.DEFAULT_ORDER, buckets=4, max_files=3)
    return bronze.live_rows(bronze_files.read_state(spark, path)).select(*BRONZE_COLUMNS)


@register("lag_by_minute")
def q_lag_by_minute(spark, sf_dir):
    """X3 (batch twin of the stream): latency per table and commit minute."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    flat = transforms.format_field(transforms.unwrap(
        ce.withColumn("commit_ts", F.timestamp_millis("source.ts_ms"))
          .withColumn("processed_ts", F.timestamp_millis("ts_ms")),
        keep=("offset", "commit_ts", "processed_ts")))
    out = jobs.lag_by_minute(flat)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


@register("late_by_minute")
def q_late_by_minute(spark, sf_dir):
    """Late rows per table and commit minute, where records arrive up to 49 minutes after their commit."""
    ce = fixtures.change_events(_events(spark, sf_dir))
    flat = transforms.format_field(transforms.unwrap(
        ce.withColumn("commit_ts", F.timestamp_millis("source.ts_ms"))
          .withColumn("arrival", F.timestamp_millis(F.col("source.ts_ms") + F.col("offset") % 50 * 60_000 + F.col("offset") % 1000)),
        keep=("offset", "commit_ts", "arrival")))
    out = late.late_by_minute(flat, "arrival")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@register("naming_audit")
def q_naming_audit(spark, sf_dir):
    """Names that need quoting (special characters, digits only, or a reserved word)."""
    return catalog.naming_audit(_mssql_spec(spark, sf_dir))


@register("rules_json_scan")
def q_rules_json_scan(spark, sf_dir):
    """S16 + R1: the SQL Server plan written as numbered rule documents per database (all files in
    folders of their own, some of equal names, one broken), scanned from the tree and tidied."""
    lists = fixtures.ingest_lists(_orders(spark, sf_dir), "mssql")
    path = scratch_path(spark, "rules")
    ingest_rules.write_plan(ingest_rules.ingest_plan_mssql(**lists), path, rules_per_document=200)
    spark.createDataFrame([('{"rules": [ {"rule-type": "selection"',)], "value string").write.text(f"{path}/database=broken")
    rules = ingest_rules.read_rule_sets(spark, path, glob="*.txt", name="folder")
    return ingest_rules.rules_tidy(rules)


@register("ingest_plan_documents")
def q_ingest_plan_documents(spark, sf_dir):
    """The numbered rule documents of each database read back as JSON: rules, selection rules with an empty filter list."""
    lists = fixtures.ingest_lists(_orders(spark, sf_dir), "mssql")
    docs = ingest_rules.plan_documents(ingest_rules.ingest_plan_mssql(**lists), rules_per_document=200)
    rules = F.from_json("text", "rules ARRAY<STRUCT<`rule-type`: STRING, `rule-id`: STRING, filters: ARRAY<STRING>>>")["rules"]
    of = lambda cond: F.size(F.filter(rules, cond)).cast("long")
    each = docs.select(
        "database", F.size(rules).cast("long").alias("n_rules"),
        of(lambda r: r["rule-type"] == "selection").alias("n_selections"),
        of(lambda r: F.size(r["filters"]) == 0).alias("n_filter_lists"),
        F.transform(rules, lambda r: r["rule-id"].cast("int")).eqNullSafe(
            F.sort_array(F.transform(rules, lambda r: r["rule-id"].cast("int")))).alias("in_order"))
    return each.groupBy("database").agg(
        F.count(F.lit(1)).alias("n_documents"), F.max("n_rules").alias("most_rules"),
        *[F.sum(c).alias(c) for c in ("n_rules", "n_selections", "n_filter_lists")], F.min("in_order").alias("in_order"))
