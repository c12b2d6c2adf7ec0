"""Change logs, topic listings, catalogs and rule lists derived from the driver tables.

Every frame here is a pure DataFrame derivation of a driver table, so its size grows
with the table and the DuckDB oracle can rebuild it with the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelake.session import read_table

TOPIC_PREFIX = "local"
SCHEMA_ID = 7  # registry schema id written into framed values


def _instant(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def change_events(events: DataFrame, tombstones: bool = False) -> DataFrame:
    """Decoded change log (B1): Kafka metadata plus the change envelope, one row per event.

    db/table come from the user and event type, op from ``event_id % 10`` (0 read,
    1 create, 9 delete, otherwise update), and the connector time ``ts_ms`` runs
    ``event_id % 5000`` ms behind the source commit time.
    """
    uid, eid = F.col("user_id"), F.col("event_id")
    db = F.when(uid % 2 == 0, F.lit("store")).otherwise(F.lit("billing"))
    table = F.concat(F.lit("tb_"), F.col("event_type"))
    op = (F.when(eid % 10 == 0, F.lit("r")).when(eid % 10 == 1, F.lit("c"))
          .when(eid % 10 == 9, F.lit("d")).otherwise(F.lit("u")))
    src_us = F.unix_micros(_instant("ts"))
    src_ms = F.unix_millis(_instant("ts"))
    lag_ms = eid % 5000
    base = events.select(
        uid.alias("user_id"), eid.alias("event_id"), "event_type", "value", "props",
        db.alias("_db"), table.alias("_table"), op.alias("_op"), src_ms.alias("_src_ms"), src_us.alias("_src_us"),
        (src_ms + lag_ms).alias("_ts_ms"),
    )
    row = F.struct("user_id", "event_id", "event_type", "value", "props")
    source = F.struct(
        F.lit("2.7.0").alias("version"),
        F.lit("mysql").alias("connector"),
        F.lit(TOPIC_PREFIX).alias("name"),
        F.col("_src_ms").alias("ts_ms"),
        (F.col("_op") == "r").cast("string").alias("snapshot"),
        F.col("_db").alias("db"),
        F.lit(None).cast("string").alias("sequence"),
        F.col("_src_us").alias("ts_us"),
        (F.col("_src_us") * 1000).alias("ts_ns"),
        F.col("_table").alias("table"),
        F.lit(1).cast("bigint").alias("server_id"),
        F.lit(None).cast("string").alias("gtid"),
        F.lit("binlog.000001").alias("file"),
        F.col("event_id").alias("pos"),
        F.lit(0).alias("row"),
        F.lit(None).cast("bigint").alias("thread"),
        F.lit(None).cast("string").alias("query"),
    )
    out = base.select(
        F.concat_ws(".", F.lit(TOPIC_PREFIX), F.col("_db"), F.col("_table")).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis(F.col("_ts_ms")).alias("timestamp"),
        F.struct("user_id").alias("key"),
        F.when(F.col("_op").isin("u", "d"), row).alias("before"),
        F.when(F.col("_op") != "d", row).alias("after"),
        source.alias("source"),
        F.col("_op").alias("op"),
        F.col("_ts_ms").alias("ts_ms"),
        (F.col("_ts_ms") * 1000).alias("ts_us"),
        (F.col("_ts_ms") * 1000000).alias("ts_ns"),
    )
    if tombstones:
        # One null-value record right after each delete (same key, next offset slot).
        tomb = out.filter(F.col("op") == "d").select(
            "topic", "partition", (F.col("offset") * 2 + 1).alias("offset"), "timestamp", "key",
            *[F.lit(None).cast(out.schema[c].dataType).alias(c)
              for c in ("before", "after", "source", "op", "ts_ms", "ts_us", "ts_ns")],
        )
        out = out.withColumn("offset", F.col("offset") * 2).unionByName(tomb)
    return out


def envelope_json(df: DataFrame) -> Column:
    """The envelope of a decoded change log as JSON text (null for tombstones)."""
    return F.when(F.col("op").isNotNull() | F.col("source").isNotNull(),
                  F.to_json(F.struct("before", "after", "source", "op", "ts_ms", "ts_us", "ts_ns")))


def envelope_json_text_ts(df: DataFrame) -> tuple[Column, Column]:
    """Envelope JSON whose top-level ``ts_ms`` is ISO text for odd offsets and a number otherwise
    (the connector's converter transform turns it into text). Returns (head, body): the
    body refers to the head as column ``_head``."""
    head = F.to_json(F.struct("before", "after", "source", "op"))
    iso = F.date_format(F.timestamp_millis(F.col("ts_ms")), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    token = F.when(F.col("offset") % 2 == 1, F.concat(F.lit('"'), iso, F.lit('"'))) \
        .otherwise(F.col("ts_ms").cast("string"))
    body = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), F.lit(',"ts_ms":'), token, F.lit("}"))
    return head, body


def kafka_records(events: DataFrame, framed: bool = True, tombstones: bool = False,
                  text_ts: bool = False) -> DataFrame:
    """The change log as raw Kafka records (key/value bytes).

    ``framed``: value = magic byte 0 + 4-byte big-endian schema id + JSON envelope,
    except for ``offset % 7 = 0`` whose value is plain JSON (first byte ``{``).
    ``text_ts``: the envelope ``ts_ms`` is ISO text for odd offsets (mixed shapes, M11).
    """
    ce = change_events(events, tombstones=tombstones)
    if text_ts:
        head, body_text = envelope_json_text_ts(ce)
        ce = ce.withColumn("_head", head)
        body = F.encode(F.when(F.col("op").isNotNull(), body_text), "UTF-8")
    else:
        body = F.encode(envelope_json(ce), "UTF-8")
    if framed:
        header = F.concat(F.lit(bytes([0])), F.lit(SCHEMA_ID.to_bytes(4, "big")))
        plain = (F.col("offset") % 7 == 0)
        value = F.when(plain, body).otherwise(F.concat(header, body))
    else:
        value = body
    return ce.select(
        F.encode(F.to_json("key"), "UTF-8").alias("key"),
        value.alias("value"),
        "topic", "partition", "offset", "timestamp",
        F.lit(0).alias("timestampType"),
    )


def damaged_records(events: DataFrame) -> DataFrame:
    """Framed records with tombstones, of which some are damaged: every 26th offset is cut to
    its first three bytes, every other 22nd one loses its last five bytes (malformed JSON), every
    other 38th one has a byte that is not UTF-8."""
    recs = kafka_records(events, framed=True, tombstones=True)
    cut = (F.when(F.col("offset") % 26 == 0, F.substring("value", 1, 3))
           .when(F.col("offset") % 22 == 0, F.substring(F.col("value"), F.lit(1), F.octet_length("value") - 5))
           .when(F.col("offset") % 38 == 0, spoiled("value"))
           .otherwise(F.col("value")))
    return recs.withColumn("value", cut)


def spoiled(value: str) -> Column:
    """The value with a byte that occurs in no UTF-8 text, far enough behind to stand in the body."""
    v = F.col(value)
    return F.concat(F.substring(v, 1, 20), F.lit(b"\xff"), F.substring(v, F.lit(21), F.octet_length(v)))


def spoiled_records(records: DataFrame, every: int) -> DataFrame:
    """Records of which every ``every``-th offset's value is not UTF-8."""
    return records.withColumn("value", F.when(F.col("offset") % every == 0, spoiled("value")).otherwise(F.col("value")))


def replayed_records(events: DataFrame) -> DataFrame:
    """Framed records (some damaged, tombstones included) of which a consumer saw some ranges again: those
    with ``offset div 40 % 9 = 4`` twice, and of these the ones with ``offset div 40 % 5 = 0`` a third time."""
    recs = damaged_records(events)
    again = F.expr("offset div 40 % 9 = 4")
    return recs.unionByName(recs.filter(again)).unionByName(recs.filter(again & F.expr("offset div 40 % 5 = 0")))


def broken_journal(events: DataFrame) -> DataFrame:
    """(topic, partition, offset) of a topic whose records are numbered without gaps (four partitions, one with
    three quarters of all), of which every other 900th and some ranges are missing and others are repeated."""
    e = F.col("event_id")
    hot = e % 16 >= 4
    recs = events.select(F.lit(f"{TOPIC_PREFIX}.store.journal").alias("topic"),
                         F.when(hot, 0).otherwise(e % 16 + 1).cast("int").alias("partition"),
                         F.when(hot, F.expr("event_id div 16 * 12 + event_id % 16 - 4")).otherwise(F.expr("event_id div 16")).alias("offset"))
    o = F.col("offset")
    kept = recs.filter((o % 900 != 77) & ~F.expr("offset div 11 % 13 = 5"))
    return kept.unionByName(kept.filter(F.expr("offset div 7 % 10 = 3"))).unionByName(kept.filter(o % 210 == 22))


def journal_bounds(events: DataFrame) -> DataFrame:
    """(topic, partition, low, high) as a broker would report it for the journal: ten records more at both ends."""
    full = events.select((F.col("event_id") % 16).alias("r"), "event_id")
    hot = F.col("r") >= 4
    parts = full.groupBy(F.when(hot, 0).otherwise(F.col("r") + 1).cast("int").alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return parts.select(F.lit(f"{TOPIC_PREFIX}.store.journal").alias("topic"), "partition", F.lit(-10).cast("bigint").alias("low"),
                        (F.col("n") + 10).alias("high"))


def zlib_stored(body):
    """A zlib stream of one stored block around ``body`` (under 64 KiB), from built-in functions.

    The check sum runs over the bytes: a = 1 + sum, b = sum of the running a, both mod 65521.
    """
    size = F.octet_length(body)
    codes = F.transform(F.sequence(F.lit(1), size), lambda i: F.ascii(F.substring(F.decode(body, "ISO-8859-1"), i, 1)).cast("bigint"))
    sums = F.aggregate(codes, F.struct(F.lit(1).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")),
                       lambda s, c: F.struct(((s["a"] + c) % 65521).alias("a"), ((s["b"] + s["a"] + c) % 65521).alias("b")))
    hex4 = lambda n: F.lpad(F.hex(n), 4, "0")
    swap = lambda n: F.concat(F.substring(hex4(n), 3, 2), F.substring(hex4(n), 1, 2))  # noqa: E731  little-endian
    head = F.unhex(F.concat(F.lit("780101"), swap(size), swap(F.lit(65535) - size)))
    return F.concat(head, body, F.unhex(F.concat(hex4(sums["b"]), hex4(sums["a"]))))


def extra_topics(spark: SparkSession) -> DataFrame:
    """Topic names of B2 that exercise the topic filter and the name split."""
    # fixed values: internal, connect, malformed and idle topic names
    names = ["__consumer_offsets", "_schemas", "connect-configs", "my-connect-status-x", "plain", "a.b.c.d",
             "local.store.tb_idle"]
    return spark.createDataFrame([(n,) for n in names], "topic string")


def topic_listing(events: DataFrame) -> DataFrame:
    """All topic names: those of the change log plus the B2 names."""
    spark = events.sparkSession
    return (change_events(events).select("topic").distinct()
            .unionByName(extra_topics(spark)))


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


# --- B3: temporal and exact types from orders --------------------------------------

def lake_rows(orders: DataFrame) -> DataFrame:
    """Raw connector row images (lake DDL columns) derived from ``orders``.

    ``boolean1`` is still the TINYINT(1) 0/1 and ``char36`` carries SQL Server's blank
    padding, so C10 and C13 have something to do.
    """
    k = F.col("o_orderkey")
    day = _instant("o_orderdate")
    off_us = (k * 1000003) % 86400000000
    create_us = F.unix_micros(day) + off_us
    return orders.select(
        k.cast("int").alias("id"),
        F.rpad(F.col("o_orderpriority"), 36, " ").alias("char36"),
        F.col("o_orderstatus").alias("varchar36"),
        F.col("o_custkey").cast("int").alias("integer1"),
        k.alias("integer2"),
        (k * 3).alias("unsigned_int"),
        F.col("o_totalprice").cast("float").alias("float1"),
        F.col("o_totalprice").alias("double1"),
        ((k % 10000).cast("decimal(12,8)") + F.lit(0.12345678).cast("decimal(12,8)"))
        .cast("decimal(12,8)").alias("decimal1"),
        (k % 2).cast("int").alias("boolean1"),
        F.encode(F.col("o_orderpriority"), "UTF-8").alias("blob1"),
        F.col("o_orderpriority").alias("text1"),
        F.unix_date(F.to_date(day)).alias("date1"),
        off_us.alias("time1"),
        (F.unix_millis(day) + F.floor(off_us / F.lit(1000)).cast("bigint")).alias("datetime1"),
        create_us.alias("create_datetime"),
        F.date_format(F.timestamp_micros(create_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("update_timestamp"),
    )


# --- B7: topology ------------------------------------------------------------------

def assignments(events: DataFrame) -> DataFrame:
    """Consumer-group assignments: distinct (group, topic, partition) of the change log."""
    gid = F.concat(F.lit("g"), (F.col("user_id") % 7).cast("string"))
    return (events.select(
        gid.alias("group_id"),
        F.concat_ws(".", F.lit(TOPIC_PREFIX),
                    F.when(F.col("user_id") % 2 == 0, F.lit("store")).otherwise(F.lit("billing")),
                    F.concat(F.lit("tb_"), F.col("event_type"))).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"))
        .distinct()
        .withColumn("member_id", F.concat(F.col("group_id"), F.lit("-m"), F.col("partition").cast("string")))
        .select("group_id", "member_id", "topic", "partition"))


def consumer_groups(events: DataFrame) -> DataFrame:
    """Group listing: every assigned group plus one group without members."""
    spark = events.sparkSession
    idle = spark.createDataFrame([("g_idle",)], "group_id string")
    return assignments(events).select("group_id").distinct().unionByName(idle)


def connector_status(nation: DataFrame) -> DataFrame:
    """Connector status rows from ``nation``: name ``c<n>``, worker ``w<region>.host:8083``."""
    return nation.select(
        F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("name"),
        F.concat(F.lit("w"), F.col("n_regionkey").cast("string"), F.lit(".host:8083")).alias("worker_id"),
    )


# --- B4: database catalogs from orders and lineitem --------------------------------

# fixed values: SQL Server type names cycled through the generated columns
MSSQL_TYPES = ["int", "nvarchar", "numeric", "datetime2", "bit", "money", "varbinary", "nchar"]


def _catalog_columns(lineitem: DataFrame) -> DataFrame:
    """One column per distinct (l_orderkey, l_linenumber); other fields by min()."""
    # the flag is one character: aggregate its code so the buffer stays fixed-width (hash aggregate)
    # dealt by order: the aggregate, the windows and the join with the tables need no further shuffle
    g = (lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey", "l_quantity")
         .repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber")
         .agg(F.min(F.ascii("l_returnflag")).alias("_flag"), F.min("l_partkey").alias("partkey"),
              F.min("l_suppkey").alias("suppkey"), F.min("l_quantity").alias("qty"))
         .withColumn("flag", F.expr("chr(_flag)")))
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    types = F.array(*[F.lit(t) for t in MSSQL_TYPES])
    dtype = F.element_at(types, (F.col("partkey") % len(MSSQL_TYPES) + 1).cast("int"))
    is_text = dtype.isin("nvarchar", "nchar")
    char_len = (F.when(dtype == "nvarchar", F.when(F.col("suppkey") % 5 == 0, F.lit(-1))
                       .otherwise((F.col("qty") * 40).cast("bigint")))
                .when(dtype == "nchar", F.lit(36))
                .when(dtype == "varbinary", F.when(F.col("suppkey") % 2 == 0, F.lit(-1)).otherwise(F.lit(2000))))
    precision = F.when(dtype.isin("numeric", "money", "int"), F.when(dtype == "int", F.lit(10))
                       .when(dtype == "money", F.lit(19)).otherwise(F.lit(18)))
    scale = F.when(dtype == "numeric", n % 5).when(dtype == "money", F.lit(4)).when(dtype == "int", F.lit(0))
    default = (F.when(n % 4 == 1, F.lit("0")).when(n % 4 == 2, F.lit("current_timestamp()"))
               .when(n % 4 == 3, F.lit("N/A")))
    comment = (F.when(F.col("flag") == "R", F.lit(None).cast("string"))
               .when(F.col("flag") == "A", F.concat(F.lit("accepted line's "), n.cast("string")))
               .otherwise(F.concat(F.lit("line "), n.cast("string"))))
    mysql_type = F.when(dtype == "nvarchar", F.lit("varchar(255)")).when(dtype == "nchar", F.lit("char(36)")) \
        .when(dtype == "numeric", F.lit("decimal(18,2)")).otherwise(dtype)
    return g.select(
        k.alias("object_id"),
        n.cast("int").alias("ORDINAL_POSITION"),
        n.cast("int").alias("column_id"),
        F.when(n == 7, F.lit("order")).when(n == 6, F.lit("col 6"))
        .otherwise(F.concat(F.lit("col"), n.cast("string"))).alias("COLUMN_NAME"),
        mysql_type.alias("COLUMN_TYPE"),
        F.when(is_text, F.lit("utf8mb4")).alias("CHARACTER_SET_NAME"),
        F.when(is_text, F.lit("utf8mb4_general_ci")).alias("COLLATION_NAME"),
        dtype.alias("DATA_TYPE"),
        char_len.cast("bigint").alias("CHARACTER_MAXIMUM_LENGTH"),
        precision.cast("bigint").alias("NUMERIC_PRECISION"),
        scale.cast("bigint").alias("NUMERIC_SCALE"),
        default.alias("COLUMN_DEFAULT"),
        F.when(F.col("flag") == "N", F.lit("NO")).otherwise(F.lit("YES")).alias("IS_NULLABLE"),
        F.when((n == 1) & (k % 3 == 0), F.lit("auto_increment")).otherwise(F.lit("")).alias("EXTRA"),
        comment.alias("COLUMN_COMMENT"),
    )


def _catalog_tables(orders: DataFrame) -> DataFrame:
    """TABLES view: one table per order."""
    k = F.col("o_orderkey")
    db = F.concat(F.lit("db"), (F.col("o_custkey") % 25).cast("string"))
    tb = F.concat(F.lit("tb_"), k.cast("string"))
    return orders.select(
        db.alias("TABLE_SCHEMA"), tb.alias("TABLE_NAME"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("TABLE_COMMENT"),
        _instant("o_orderdate").alias("CREATE_TIME"),
        (_instant("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("UPDATE_TIME"),
        F.floor(F.col("o_totalprice")).cast("bigint").alias("TABLE_ROWS"),
        k.alias("object_id"), F.lit(1).alias("schema_id"),
        F.col("o_orderstatus").alias("_status"),
    )


def _catalog_columns_of(tables: DataFrame, lineitem: DataFrame) -> DataFrame:
    """COLUMNS view: lineitem-derived columns placed in their tables, with each table's first and last position."""
    table = Window.partitionBy("object_id")
    cols = _catalog_columns(lineitem).withColumns({"_first": F.min("ORDINAL_POSITION").over(table), "_last": F.max("ORDINAL_POSITION").over(table)})
    return cols.join(tables.select("object_id", "TABLE_SCHEMA", "TABLE_NAME"), "object_id", "inner")


def _with_ends(cols: DataFrame) -> DataFrame:
    """COLUMNS with ``_first`` and ``_last``, each table's first and last position."""
    if "_first" in cols.columns:
        return cols
    table = Window.partitionBy("object_id")
    return cols.withColumns({"_first": F.min("ORDINAL_POSITION").over(table), "_last": F.max("ORDINAL_POSITION").over(table)})


def table_views(orders: DataFrame) -> dict[str, DataFrame]:
    """The catalog views that need no columns: tables, partitions, include."""
    tables = _catalog_tables(orders)
    rows = F.col("TABLE_ROWS")
    idx = F.when(F.col("object_id") % 2 == 0, F.lit(1)).otherwise(F.lit(0))
    partitions = tables.select("object_id", idx.alias("index_id"), F.lit(1).alias("partition_number"),
                               F.floor(rows / 2).cast("bigint").alias("row_count")) \
        .unionByName(tables.select("object_id", idx.alias("index_id"), F.lit(2).alias("partition_number"),
                                   (rows - F.floor(rows / 2).cast("bigint")).alias("row_count"))) \
        .unionByName(tables.select("object_id", F.lit(2).alias("index_id"), F.lit(1).alias("partition_number"),
                                   rows.alias("row_count")))
    include = tables.filter(F.col("_status") != "P").select("TABLE_SCHEMA", "TABLE_NAME")
    return {"tables": tables.drop("_status"), "partitions": partitions, "include": include}


def column_views(orders: DataFrame, cols: DataFrame) -> dict[str, DataFrame]:
    """The catalog views over the COLUMNS view ``cols``: columns (and the target engine's), key_usage, ext_props, identity."""
    cols = _with_ends(cols)
    tables, oid = _catalog_tables(orders), F.col("object_id")
    pk_name = (F.when(oid % 7 == 0, F.concat(F.lit("ix_"), F.col("TABLE_NAME")))
               .when(oid % 4 == 0, F.concat(F.lit("pk_"), F.col("TABLE_NAME")))
               .when(oid % 4 == 1, F.concat(F.lit("CPK_"), F.col("TABLE_NAME")))
               .when(oid % 4 == 2, F.concat(F.col("TABLE_NAME"), F.lit("_PK")))
               .otherwise(F.concat(F.lit("npk_"), F.col("TABLE_NAME"))))
    keyed = cols.filter(F.col("ORDINAL_POSITION") == F.col("_first"))
    pk_rows = keyed.filter(oid % 5 != 0).select(
        "TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME", F.lit("PRIMARY").alias("CONSTRAINT_NAME"),
        F.lit(1).alias("ORDINAL_POSITION"), pk_name.alias("MSSQL_CONSTRAINT_NAME"))
    uq_src = cols.filter((F.col("ORDINAL_POSITION") == 2) & (oid % 4 == 1))
    uq_rows = uq_src.select(
        "TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME",
        F.when(oid % 8 == 1, F.lit("UNIQUE")).otherwise(F.lit("uq_name")).alias("CONSTRAINT_NAME"),
        F.lit(1).alias("ORDINAL_POSITION"),
        F.when(oid % 3 == 0, F.concat(F.col("TABLE_NAME"), F.lit("_UQ")))
        .otherwise(F.concat(F.lit("UQ_"), F.col("TABLE_NAME"))).alias("MSSQL_CONSTRAINT_NAME"))
    key_usage = pk_rows.unionByName(uq_rows)
    ext_props = tables.filter(F.col("TABLE_COMMENT").isNotNull()).select(
        F.lit("OBJECT_OR_COLUMN").alias("class_desc"), F.lit("MS_Description").alias("name"),
        F.col("object_id").alias("major_id"), F.lit(0).alias("minor_id"), F.col("TABLE_COMMENT").alias("value")) \
        .unionByName(cols.filter(F.col("COLUMN_COMMENT").isNotNull()).select(
            F.lit("OBJECT_OR_COLUMN").alias("class_desc"), F.lit("MS_Description").alias("name"),
            F.col("object_id").alias("major_id"), F.col("column_id").alias("minor_id"),
            F.col("COLUMN_COMMENT").alias("value")))
    identity = cols.filter(F.col("EXTRA") == "auto_increment").select("TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME")
    return {"columns": cols.drop("_first", "_last"), "second_columns": second_engine_columns(cols), "key_usage": key_usage,
            "ext_props": ext_props, "identity": identity}


def catalog(orders: DataFrame, lineitem: DataFrame, columns: DataFrame | None = None) -> dict[str, DataFrame]:
    """Catalog views of many databases as frames (a union of per-database catalogs).

    tables      TABLE_SCHEMA, TABLE_NAME, TABLE_COMMENT, CREATE_TIME, UPDATE_TIME, TABLE_ROWS, object_id, schema_id
    columns     TABLE_SCHEMA, TABLE_NAME, ORDINAL_POSITION, COLUMN_NAME, ... , object_id, column_id
    key_usage   TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME, CONSTRAINT_NAME, ORDINAL_POSITION
    partitions  object_id, index_id, partition_number, row_count
    ext_props   class_desc, name, major_id, minor_id, value
    identity    TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME
    include     TABLE_SCHEMA, TABLE_NAME (tables chosen for the spec: open or finished orders)
    """
    cols = columns if columns is not None else _catalog_columns_of(_catalog_tables(orders), lineitem)
    return table_views(orders) | column_views(orders, cols)


class _LazyViews(dict):
    """Catalog views derived on first use, so a query that needs no columns never reads lineitem."""

    def __init__(self, orders: DataFrame, lineitem: DataFrame):
        super().__init__()
        self._orders, self._lineitem = orders, lineitem

    def __missing__(self, name: str) -> DataFrame:
        if name in ("tables", "partitions", "include"):
            self.update(table_views(self._orders))
        else:
            from changelake.session import materialize

            # an aggregate over lineitem that several views reuse: written once, so the plan
            # does not aggregate it for each use
            cols = materialize(_catalog_columns_of(_catalog_tables(self._orders), self._lineitem), "catalog-columns")
            self.update(column_views(self._orders, cols))
        return self[name]


def load_catalog(spark: SparkSession, sf_dir: str, snapshot: bool = True) -> dict[str, DataFrame]:
    """Catalog views derived from the driver tables, each on first use; without ``snapshot``
    nothing is written and every view is a plan over the tables."""
    orders, lineitem = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    return _LazyViews(orders, lineitem) if snapshot else catalog(orders, lineitem)


def second_engine_columns(columns: DataFrame) -> DataFrame:
    """The target engine's columns (T13/T14): ``col3`` upper-cased, and the last column of
    tables with ``object_id % 11 = 0`` left out."""
    renamed = _with_ends(columns).withColumn("COLUMN_NAME", F.when(F.col("ORDINAL_POSITION") == 3, F.upper("COLUMN_NAME"))
                                             .otherwise(F.col("COLUMN_NAME")))
    return (renamed.filter(~((F.col("object_id") % 11 == 0) & (F.col("ORDINAL_POSITION") == F.col("_last"))))
            .drop("_first", "_last"))


def space_used_frames(part: DataFrame) -> DataFrame:
    """sp_spaceused-style rows from ``part`` (sizes as text with a KB suffix)."""
    size = lambda mult: F.concat((F.col("p_size") * mult).cast("string"), F.lit(" KB"))
    return part.select(
        F.col("p_name").alias("name"),
        (F.col("p_size") * 100).cast("string").alias("rows"),
        size(8).alias("reserved"), size(5).alias("data"), size(2).alias("index_size"),
        F.when(F.col("p_partkey") % 13 != 0, size(1)).alias("unused"),
        F.concat(F.lit("db"), (F.col("p_partkey") % 3).cast("string")).alias("db_name"),
    )


# --- B6: ingest lists and rule sets from orders ------------------------------------

def ingest_lists(orders: DataFrame, engine: str = "mssql") -> dict[str, DataFrame]:
    """Settings lists as frames of dotted names (column ``name``).

    SQL Server names are ``db<c>.dbo.T<k>``, MySQL names ``db<c>.T<k>``. Excluded where
    ``k % 5 = 0``, lower-cased where ``k % 2 = 0``, columns c1/c2 removed where
    ``k % 3 = 0``; ``dbx...T1`` is listed and excluded (an all-excluded database).
    """
    spark = orders.sparkSession
    k = F.col("o_orderkey")
    mid = ".dbo.T" if engine == "mssql" else ".T"
    name = F.concat(F.lit("db"), (F.col("o_custkey") % 25).cast("string"), F.lit(mid), k.cast("string"))
    base = orders.select(name.alias("name"), k.alias("k"))
    extra = spark.createDataFrame([(f"dbx{mid}1",)], "name string")
    tables = base.select("name").unionByName(extra)
    except_tables = base.filter(k % 5 == 0).select("name").unionByName(extra)
    lower = base.filter(k % 2 == 0).select("name")
    cols = base.filter(k % 3 == 0)
    except_columns = (cols.select(F.concat(F.col("name"), F.lit(".c1")).alias("name"))
                      .unionByName(cols.select(F.concat(F.col("name"), F.lit(".c2")).alias("name"))))
    return {"tables": tables, "except_tables": except_tables, "except_columns": except_columns,
            "lower_case_tables": lower}


def text_extract(orders: DataFrame) -> DataFrame:
    """A table as a text export holds it: some values do not fit the column's type, some lose digits, one column is bytes."""
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("id"),
        F.when(k % 50 == 0, F.concat(k.cast("string"), F.lit(" pcs"))).when(k % 70 == 0, F.lit("99999999999")).otherwise(k.cast("string")).alias("qty"),
        F.when(k % 40 == 0, F.lit("n/a")).when(k % 30 == 0, F.lit("1.23456")).otherwise(F.concat((k % 1000).cast("string"), F.lit(".5"))).alias("price"),
        F.when(k % 9 == 0, F.lit("false")).when(k % 9 == 1, F.lit("maybe")).when(k % 9 == 2, F.lit("0")).otherwise(F.lit("1")).alias("active"),
        F.when(k % 2 == 0, F.lit(b"\x00")).otherwise(F.lit(b"\x01")).alias("flag"),
        F.when(k % 11 == 0, F.lit("0000-00-00")).when(k % 13 == 0, F.lit(None)).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.lit("x").alias("unknown"))


def text_extract_spec(spark: SparkSession) -> DataFrame:
    """The specification of the exported table."""
    cols = [("qty", "int", None), ("price", "decimal", "8,2"), ("active", "bit", "1"), ("flag", "bit", "1"), ("day", "date", None), ("gone", "int", None)]
    return spark.createDataFrame([("sales", "export", *c) for c in cols],
                                 "DB_NAME string, TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, COLUMN_LENGTH string")


def pattern_rules(orders: DataFrame) -> DataFrame:
    """(action, schema, table) selection rules with wildcards in schema and table, derived from ``orders``: tables by
    their beginning, by their end, schemas by their beginning, and a few written out (one with a plain underscore)."""
    spark = orders.sparkSession
    k, c = F.col("o_orderkey"), F.col("o_custkey") % 25
    text = lambda x: x.cast("string")
    rule = lambda cond, action, schema, table: orders.filter(cond).select(
        F.lit(action).alias("action"), schema.alias("schema"), table.alias("table"))
    fixed = spark.createDataFrame([("include", "db7", "%"), ("exclude", "db1_", "T%"), ("include", "db12", "T5"), ("exclude", "db7", "%99")],
                                  "action string, schema string, table string")
    return (rule(k % 97 == 0, "include", F.concat(F.lit("db"), text(c)), F.concat(F.lit("T"), text(F.floor(k / 100)), F.lit("%")))
            .unionByName(rule(k % 101 == 0, "include", F.concat(F.lit("db"), text(F.floor(c / 10)), F.lit("%")), F.concat(F.lit("%"), text(k % 1000))))
            .unionByName(rule(k % 89 == 0, "exclude", F.lit("%"), F.concat(F.lit("%"), text(k % 1000))))
            .unionByName(fixed))


def rule_set_documents(orders: DataFrame) -> DataFrame:
    """(file_name, JSON text) rule sets, one per order's table.

    Each has a selection rule (exclude where ``k % 5 = 0``) and a dbo -> db rename;
    ``k % 11 = 0`` has two renames (the last one counts), ``k % 13 = 0`` none, and
    ``k % 17 = 0`` is not valid JSON.
    """
    k = F.col("o_orderkey")
    db = F.concat(F.lit("db"), (F.col("o_custkey") % 25).cast("string"))
    table = F.concat(F.lit("T"), k.cast("string"))
    none = F.lit(None).cast("string")

    action = F.when(k % 5 == 0, F.lit("exclude")).otherwise(F.lit("include"))
    select = F.struct(F.lit("selection").alias("rule-type"), F.lit("1").alias("rule-id"),
                      F.lit("selection_1").alias("rule-name"), none.alias("rule-target"), action.alias("rule-action"),
                      F.struct(F.lit("dbo").alias("schema-name"), table.alias("table-name")).alias("object-locator"),
                      none.alias("value"))
    rename = lambda rid, to: F.struct(
        F.lit("transformation").alias("rule-type"), F.lit(rid).alias("rule-id"),
        F.lit(f"rename_{rid}").alias("rule-name"), F.lit("schema").alias("rule-target"),
        F.lit("rename").alias("rule-action"),
        F.struct(F.lit("dbo").alias("schema-name"), none.alias("table-name")).alias("object-locator"),
        to.alias("value"))
    rules = (F.when(k % 13 == 0, F.array(select))
             .when(k % 11 == 0, F.array(rename("2", F.lit("staging")), select, rename("3", db)))
             .otherwise(F.array(select, rename("2", db))))
    text = F.when(k % 17 == 0, F.lit('{"rules": [')).otherwise(F.to_json(F.struct(rules.alias("rules"))))
    return orders.select(F.concat(db, F.lit("-"), table, F.lit(".json")).alias("file_name"), text.alias("text"))


def task_documents(orders: DataFrame) -> DataFrame:
    """Replication-task descriptions (JSON text), one per database."""
    db = F.concat(F.lit("db"), (F.col("o_custkey") % 25).cast("string"))
    d = orders.select(db.alias("db")).distinct()
    mapping = F.concat(F.lit('{"rules":[{"rule-type":"selection","object-locator":{"schema-name":"'), F.col("db"),
                       F.lit('"}}]}'))
    task = F.struct(
        F.concat(F.lit("task-"), F.col("db")).alias("ReplicationTaskIdentifier"),
        F.concat(F.lit("arn:aws:dms:region:0:task:"), F.col("db")).alias("ReplicationTaskArn"),
        F.concat(F.lit("arn:aws:dms:region:0:endpoint:src-"), F.col("db")).alias("SourceEndpointArn"),
        F.lit("arn:aws:dms:region:0:endpoint:lake").alias("TargetEndpointArn"),
        F.when(F.length("db") == 3, F.lit("full-load-and-cdc")).otherwise(F.lit("cdc")).alias("MigrationType"),
        mapping.alias("TableMappings"))
    return d.select(F.to_json(task).alias("text"))
