"""StructTypes of the change envelope, the lake tables, and the catalog frames."""

from __future__ import annotations

from pyspark.sql import types as T

# The source block of a change event (17 fields), as the lake tables declare it.
SOURCE = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("connector", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("snapshot", T.StringType()),
    T.StructField("db", T.StringType()),
    T.StructField("sequence", T.StringType()),
    T.StructField("ts_us", T.LongType()),
    T.StructField("ts_ns", T.LongType()),
    T.StructField("table", T.StringType()),
    T.StructField("server_id", T.LongType()),
    T.StructField("gtid", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("row", T.IntegerType()),
    T.StructField("thread", T.LongType()),
    T.StructField("query", T.StringType()),
])

# Row image of the lake DDL (17 columns, lower-case variant).
LAKE_ROW = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("char36", T.StringType()),
    T.StructField("varchar36", T.StringType()),
    T.StructField("integer1", T.IntegerType()),
    T.StructField("integer2", T.LongType()),
    T.StructField("unsigned_int", T.LongType()),
    T.StructField("float1", T.FloatType()),
    T.StructField("double1", T.DoubleType()),
    T.StructField("decimal1", T.DecimalType(12, 8)),
    T.StructField("boolean1", T.BooleanType()),
    T.StructField("blob1", T.BinaryType()),
    T.StructField("text1", T.StringType()),
    T.StructField("date1", T.IntegerType()),
    T.StructField("time1", T.LongType()),
    T.StructField("datetime1", T.LongType()),
    T.StructField("create_datetime", T.LongType()),
    T.StructField("update_timestamp", T.StringType()),
])


def upper_case(row: T.StructType) -> T.StructType:
    """The same row image with upper-case field names."""
    return T.StructType([T.StructField(f.name.upper(), f.dataType, f.nullable) for f in row.fields])


def mixed_case(row: T.StructType, n_lower: int = 10) -> T.StructType:
    """First ``n_lower`` fields lower case, the rest upper case (composite-key table)."""
    return T.StructType([
        T.StructField(f.name if i < n_lower else f.name.upper(), f.dataType, f.nullable)
        for i, f in enumerate(row.fields)
    ])


def envelope(row: T.StructType) -> T.StructType:
    """Change envelope around a row image."""
    return T.StructType([
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("source", SOURCE),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("ts_ns", T.LongType()),
    ])


LAKE_ENVELOPE = envelope(LAKE_ROW)

# Partition columns of the lake; strings so '01' keeps its padding.
LAKE_PARTITIONS = T.StructType([
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
])

# Kafka source schema (what readStream.format("kafka") yields).
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# User message value of the producer/consumer examples.
USER_MESSAGE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("email", T.StringType()),
])

# Table specification: one row per column, 20 fields.
TABLE_SPEC = T.StructType([
    T.StructField("DB_NAME", T.StringType()),
    T.StructField("TABLE_NAME", T.StringType()),
    T.StructField("TABLE_COMMENT", T.StringType()),
    T.StructField("ORDINAL_POSITION", T.IntegerType()),
    T.StructField("COLUMN_NAME", T.StringType()),
    T.StructField("COLUMN_TYPE", T.StringType()),
    T.StructField("CHARACTER_SET", T.StringType()),
    T.StructField("COLLATION_NAME", T.StringType()),
    T.StructField("DATA_TYPE", T.StringType()),
    T.StructField("COLUMN_LENGTH", T.StringType()),
    T.StructField("COLUMN_DEFAULT", T.StringType()),
    T.StructField("IS_NULLABLE", T.StringType()),
    T.StructField("IS_UNIQUE", T.StringType()),
    T.StructField("IS_AUTO_INCREMENT", T.StringType()),
    T.StructField("COLUMN_EXTRA", T.StringType()),
    T.StructField("PK", T.StringType()),
    T.StructField("COLUMN_COMMENT", T.StringType()),
    T.StructField("CREATE_TIME", T.TimestampType()),
    T.StructField("UPDATE_TIME", T.TimestampType()),
    T.StructField("ROW", T.LongType()),
])

SPACE_USED = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("rows", T.StringType()),
    T.StructField("reserved", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("index_size", T.StringType()),
    T.StructField("unused", T.StringType()),
    T.StructField("db_name", T.StringType()),
])

# Ingest rule set document: {"rules": [...]}.
RULE = T.StructType([
    T.StructField("rule-type", T.StringType()),
    T.StructField("rule-id", T.StringType()),
    T.StructField("rule-name", T.StringType()),
    T.StructField("rule-target", T.StringType()),
    T.StructField("rule-action", T.StringType()),
    T.StructField("object-locator", T.StructType([
        T.StructField("schema-name", T.StringType()),
        T.StructField("table-name", T.StringType()),
        T.StructField("column-name", T.StringType()),
    ])),
    T.StructField("value", T.StringType()),
    T.StructField("expression", T.StringType()),
    T.StructField("data-type", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("precision", T.IntegerType()),
    ])),
    T.StructField("filters", T.ArrayType(T.StringType())),
])
RULE_SET = T.StructType([T.StructField("rules", T.ArrayType(RULE))])

# Replication task description.
TASK = T.StructType([
    T.StructField("ReplicationTaskIdentifier", T.StringType()),
    T.StructField("ReplicationTaskArn", T.StringType()),
    T.StructField("SourceEndpointArn", T.StringType()),
    T.StructField("TargetEndpointArn", T.StringType()),
    T.StructField("MigrationType", T.StringType()),
    T.StructField("TableMappings", T.StringType()),
])
