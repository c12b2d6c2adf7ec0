"""Edge cases on small inline frames."""

import datetime as dt
import hashlib

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake import schemas
from changelake.functions import temporal
from changelake.operators import bronze, catalog, ingest_rules, lag, topology, transforms
from changelake.sources import framing, kafka, lake

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
ENV = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("before", ROW), T.StructField("after", ROW),
    T.StructField("source", T.StructType([T.StructField("db", T.StringType()), T.StructField("table", T.StringType()),
                                          T.StructField("ts_ms", T.LongType())])),
    T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
])


def env_rows(spark, rows):
    return spark.createDataFrame(rows, ENV)


def test_ignore_read_op_keeps_null_op_and_other_topics(spark):
    df = env_rows(spark, [
        ("local.db.t", 0, 1, None, (1, "a"), ("db", "t", 1), "r", 2),
        ("local.db.t", 0, 2, None, (1, "a"), ("db", "t", 1), None, 2),
        ("other.db.t", 0, 3, None, (1, "a"), ("db", "t", 1), "r", 2),
        ("local.db.t", 0, 4, (1, "a"), (1, "b"), ("db", "t", 1), "u", 2),
    ])
    kept = sorted(r.offset for r in transforms.ignore_read_op(df, "^(local.*)\\..*").collect())
    assert kept == [2, 3, 4]


def test_unwrap_delete_without_before_and_tombstone(spark):
    df = env_rows(spark, [
        ("local.db.t", 0, 1, None, None, ("db", "t", 1), "d", 2),          # delete without before
        ("local.db.t", 0, 2, None, None, None, None, None),                 # tombstone
        ("local.db.t", 0, 3, (5, "x"), None, ("db", "t", 1), "d", 3),
    ])
    out = {r.offset: r for r in transforms.unwrap(df).collect()}
    assert set(out) == {1, 3}
    assert out[1].id is None and out[1]["__deleted"] == "true"
    assert out[3].id == 5 and out[3]["__op"] == "d" and out[3]["__db"] == "db" and out[3]["__ts_ms"] == 3


def test_chain_order_matters_ts_convert_before_unwrap(spark):
    df = env_rows(spark, [("local.db.t", 0, 1, None, (1, "a"), ("db", "t", 1), "c", 1704067200123)])
    good = transforms.transform_chain(df, ["tsConvertor", "unwrap", "replaceField"])
    assert good.first().last_applied_date == "2024-01-01T00:00:00.123"
    # after unwrap the envelope field is gone: the converter has nothing to convert
    late = transforms.transform_chain(df, ["unwrap", "replaceField"])
    assert late.first().last_applied_date == 1704067200123


def test_hash_key_null_field_gives_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "k1 string, k2 string")
    out = transforms.hash_key(df, ["k1", "k2"]).collect()
    assert out[0].id_iceberg is None
    assert out[1].id_iceberg == hashlib.md5(b"a|b").hexdigest()


def test_replace_value_and_format_field_nulls(spark):
    df = spark.createDataFrame([("c", "db", "t"), ("r", None, "t")], "__op string, __db string, __table string")
    out = transforms.format_field(transforms.replace_value(df)).collect()
    assert [r["__op"] for r in out] == ["I", "r"]
    assert out[0]["__db_table"] == "db_bronze.t" and out[1]["__db_table"] is None


def test_latest_state_skips_deletes_and_is_idempotent(spark):
    df = spark.createDataFrame([
        ("t", "k1", 1, 1, "false"), ("t", "k1", 2, 2, "true"),
        ("t", "k2", 5, 3, "false"), ("t", "k2", 5, 4, "false"),
    ], "__db_table string, id_iceberg string, last_applied_date long, offset long, __deleted string")
    state = bronze.latest_state(df)
    rows = state.collect()
    assert [(r.id_iceberg, r.offset) for r in rows] == [("k2", 4)]
    again = bronze.latest_state(state.withColumn("__deleted", F.lit("false")))
    assert sorted(again.collect()) == sorted(rows)


def test_upsert_equals_full_fold(spark):
    cols = "__db_table string, id_iceberg string, last_applied_date long, offset long, v long, __deleted string"
    events = spark.createDataFrame([
        ("t", "a", 1, 1, 10, "false"), ("t", "b", 2, 2, 20, "false"), ("t", "c", 3, 3, 30, "false"),
        ("t", "a", 4, 4, 11, "false"), ("t", "b", 5, 5, 0, "true"), ("t", "d", 6, 6, 40, "false"),
    ], cols)
    full = bronze.latest_state(events)
    first = bronze.latest_state(events.filter("offset <= 3"))
    merged = bronze.upsert(first, events.filter("offset > 3"))
    assert sorted(merged.collect()) == sorted(full.collect())


def test_scrape_order_last_record_not_framed(spark):
    # partition 0's last record is plain JSON: it contributes nothing even though
    # an earlier record of partition 0 is framed and newer than partition 1's record.
    ts = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    recs = spark.createDataFrame([
        ("t.a.b", 0, 1, b"\x00\x00\x00\x00\x01{}", ts(9)),
        ("t.a.b", 0, 2, b"{}", ts(1)),
        ("t.a.b", 1, 1, b"\x00\x00\x00\x00\x01{}", ts(5)),
        ("t.a.c", 0, 1, b"", ts(5)),
        ("t.a.c", 1, 1, None, ts(5)),
    ], "topic string, partition int, offset long, value binary, timestamp timestamp")
    latest = lag.scrape_latest(recs).collect()
    assert [(r.topic, r.partition, r.offset) for r in latest] == [("t.a.b", 1, 1)]


def test_latest_per_topic_tie_goes_to_lowest_partition(spark):
    t = dt.datetime(2024, 1, 1)
    recs = spark.createDataFrame([("x.y.z", 2, 7, b"\x00", t), ("x.y.z", 1, 9, b"\x00", t)],
                                 "topic string, partition int, offset long, value binary, timestamp timestamp")
    assert lag.latest_per_topic(recs).first().partition == 1


def test_topic_filter_and_parts(spark):
    topics = spark.createDataFrame([(t,) for t in ["_schemas", "x-connect-offsets", "a.b.c", "a.b", "a.b.c.d"]],
                                   "topic string")
    kept = [r.topic for r in lag.topic_parts(lag.topic_filter(topics)).collect()]
    assert kept == ["a.b.c"]
    four = lag.topic_parts(lag.topic_filter(topics), allow_four_parts=True).orderBy("topic").collect()
    assert [(r.topic, r.schema, r.table) for r in four] == [("a.b.c", "b", "c"), ("a.b.c.d", "b.c", "d")]


def test_mixed_ts_decode(spark):
    df = spark.createDataFrame([("1704067200123",), ("2024-01-01T00:00:00.123",), ("junk",)], "x string")
    got = [r.ms for r in df.select(F.unix_millis(temporal.mixed_ts_decode("x")).alias("ms")).collect()]
    assert got == [1704067200123, 1704067200123, None]


def test_freshness_clamped_at_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2),)], "debezium_ts timestamp")
    out = lag.topic_freshness(df, dt.datetime(2024, 1, 1)).first()
    assert out.freshness == 0.0


def test_kst_partition_boundary(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 14, 59, 59),), (dt.datetime(2024, 1, 1, 15, 0, 0),)],
                               "timestamp timestamp")
    out = lake.with_lake_partitions(df).collect()
    assert [(r.year, r.month, r.day) for r in out] == [("2024", "01", "01"), ("2024", "01", "02")]


def test_topic_consumers_idle_topic_and_duplicates(spark):
    topics = spark.createDataFrame([("t1",), ("idle",)], "topic string")
    assign = spark.createDataFrame([("g1", "m1", "t1", 0), ("g1", "m2", "t1", 1), ("g0", "m3", "t1", 2)],
                                   "group_id string, member_id string, topic string, partition int")
    out = {r.topic: r.groups for r in topology.topic_consumers(topics, assign).collect()}
    assert out == {"t1": ["g0", "g1", "g1"], "idle": []}
    groups = spark.createDataFrame([("g1",), ("lonely",)], "group_id string")
    ct = {r.group_id: r.topics for r in topology.consumer_topics(groups, assign).collect()}
    assert ct == {"g1": ["t1"], "lonely": []}


def test_frames_roundtrip(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    enc = framing.encode_json(df, schema_id=258)
    row = enc.select(framing.confluent_schema_id("value").alias("sid"),
                     F.decode(framing.strip_confluent_frame("value"), "UTF-8").alias("body")).first()
    assert row.sid == 258 and row.body == '{"id":1,"name":"a"}'
    uid = "0f8fad5b-d9cb-469f-a165-70867728950e"
    g = framing.encode_json(df, schema_version=uid)
    grow = g.select(framing.gsr_schema_version("value").alias("v"),
                    F.decode(framing.strip_gsr_frame("value"), "UTF-8").alias("body")).first()
    assert grow.v == uid and grow.body == '{"id":1,"name":"a"}'
    empty = spark.createDataFrame([(b"",), (None,)], "value binary")
    assert [r.m for r in empty.select(framing.has_magic_byte("value").alias("m")).collect()] == [False, False]


def test_connect_json_both_shapes(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    recs = spark.createDataFrame([(b'{"schema":{},"payload":{"a":1}}',), (b'{"a":2}',)], "value binary")
    wrapped = framing.connect_json_decode(recs, schema, schemas_enable=True).collect()
    bare = framing.connect_json_decode(recs, schema, schemas_enable=False).collect()
    assert wrapped[0].data.a == 1 and bare[1].data.a == 2


def test_tables_without_pk_and_pk_list(spark):
    spec = spark.createDataFrame([
        ("d", "t1", 1, "a", "YES"), ("d", "t1", 2, "b", "YES"), ("d", "t2", 1, "x", "NO"),
    ], "DB_NAME string, TABLE_NAME string, ORDINAL_POSITION int, COLUMN_NAME string, PK string")
    assert [tuple(r) for r in catalog.tables_without_pk(spec).collect()] == [("d", "t2")]
    assert [r.pk_columns for r in catalog.pk_list_per_table(spec).collect()] == ["a,b"]


def test_type_map_rules(spark):
    spec = spark.createDataFrame([
        ("nvarchar", "-1"), ("nvarchar", "50"), ("nvarchar", "4000"), ("varbinary", "2000"), ("numeric", "18,2"),
        ("hierarchyid", "892"), ("int", None), ("money", "19,4"), ("bit", "1"),
    ], "DATA_TYPE string, COLUMN_LENGTH string")
    out = [(r.mysql_type, r.type_changed, r.spark_type) for r in catalog.type_map(spec).collect()]
    assert out == [
        ("TEXT", True, "string"), ("VARCHAR(50)", False, "string"), ("TEXT", True, "string"),
        ("BLOB", True, "binary"), ("NUMERIC(18,2)", False, "decimal(18,2)"), ("VARCHAR(100)", True, "string"),
        ("INT", True, "int"), ("DECIMAL(19,4)", False, "decimal(19,4)"), ("TINYINT(1)(1)", False, "boolean"),
    ]


def test_default_clause(spark):
    df = spark.createDataFrame([("0",), ("now()",), ("CURRENT_TIMESTAMP",), ("abc",), (None,)], "d string")
    got = [r.c for r in df.select(catalog.default_clause(F.col("d")).alias("c")).collect()]
    assert got == ["DEFAULT 0", "DEFAULT now()", "DEFAULT CURRENT_TIMESTAMP", "DEFAULT 'abc'", ""]


def test_naming_audit_flags(spark):
    spec = spark.createDataFrame([("d", "t", "order"), ("d", "t", "컬럼"), ("d", "t", "123"), ("d", "t", "ok_name"),
                                  ("d", "t", "a b")], "DB_NAME string, TABLE_NAME string, COLUMN_NAME string")
    words = spark.createDataFrame([("ORDER",)], "word string")
    flagged = sorted(r.name for r in catalog.naming_audit(spec, words).filter("kind = 'column'").collect())
    assert flagged == ["123", "a b", "order", "컬럼"]


def _names(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "name string")


def test_mssql_plan_all_excluded_db_and_numbering(spark):
    plan = ingest_rules.ingest_plan_mssql(
        _names(spark, ["d1.dbo.B", "d1.dbo.A", "d2.dbo.X", "bad.name"]),
        _names(spark, ["d2.dbo.X"]), _names(spark, ["d1.dbo.A.z", "d1.dbo.A.y"]), _names(spark, ["d1.dbo.B"]))
    rows = [(r.database, r.rule_id, r.rule_name) for r in plan.orderBy("database", "rule_id").collect()]
    assert rows == [
        ("d1", 1, "include_table_1"), ("d1", 2, "add_column_cdc_dt_2"), ("d1", 3, "remove_column_y_3"),
        ("d1", 4, "remove_column_z_4"), ("d1", 5, "include_table_5"), ("d1", 6, "add_column_cdc_dt_6"),
        ("d1", 7, "table_rename_lower_case_7"), ("d1", 8, "schema_rename_dbo_to_d1"),
        ("d2", 1, "schema_rename_dbo_to_d2"),
    ]


def test_mysql_plan_leaves_gap_for_excluded(spark):
    plan = ingest_rules.ingest_plan_mysql(_names(spark, ["d.a", "d.b", "d.c"]), _names(spark, ["d.b"]),
                                          _names(spark, []), _names(spark, []))
    assert [r.rule_id for r in plan.orderBy("rule_id").collect()] == [1, 3]


def test_rules_tidy_last_rename_wins_and_bad_json_skipped(spark):
    docs = spark.createDataFrame([
        ("f1.json", '{"rules":[{"rule-type":"transformation","rule-action":"rename","rule-target":"schema",'
                    '"value":"s1"},{"rule-type":"selection","rule-action":"include","object-locator":'
                    '{"schema-name":"dbo","table-name":"T"}},{"rule-type":"transformation","rule-action":"rename",'
                    '"rule-target":"schema","value":"s2"}]}'),
        ("f2.json", '{"rules": ['),
    ], "file_name string, text string")
    out = [tuple(r) for r in ingest_rules.rules_tidy(ingest_rules.parse_rule_sets(docs)).collect()]
    assert out == [("f1.json", "selection", "include", "s2", "T")]


def test_read_rule_sets_from_files_skips_corrupt(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.json").write_text('{\n "rules": [\n  {"rule-type": "selection", "rule-action": "include",'
                                             ' "object-locator": {"schema-name": "dbo", "table-name": "T"}}\n ]\n}\n')
    (tmp_path / "b.json").write_text("{ not json")
    (tmp_path / "c.txt").write_text('{"rules": []}')
    rules = ingest_rules.read_rule_sets(spark, str(tmp_path))
    out = [tuple(r) for r in ingest_rules.rules_tidy(rules).collect()]
    assert out == [("a.json", "selection", "include", "dbo", "T")]


def test_rule_files_of_equal_names_do_not_mix(spark, tmp_path):
    doc = ('{"rules": [{"rule-type": "selection", "rule-action": "include", "object-locator": {"schema-name": "dbo", "table-name": "%s"}},'
           ' {"rule-type": "transformation", "rule-action": "rename", "rule-target": "schema", "value": "%s"}]}')
    for folder, table, db in (("a", "T1", "db1"), ("b", "T2", "db2")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "rules.json").write_text(doc % (table, db))
    out = ingest_rules.rules_tidy(ingest_rules.read_rule_sets(spark, str(tmp_path))).collect()
    assert sorted((r.file_name, r.schema, r.table) for r in out) == [("rules.json", "db1", "T1"), ("rules.json", "db2", "T2")]


def test_comments_with_quotes_and_backslashes_survive(spark):
    from changelake.sources import catalog_io

    spark.sql("CREATE DATABASE IF NOT EXISTS esc_bronze")
    spark.sql("DROP TABLE IF EXISTS esc_bronze.t")
    spark.sql("CREATE TABLE esc_bronze.t (`a``b` INT, c INT) USING parquet")
    texts = {None: "it's C:\\", "a`b": "end \\' quote; DROP", "c": "plain"}
    rows = spark.createDataFrame([("esc_bronze.t", k, v) for k, v in texts.items()], "target_table string, column_name string, comment string")
    assert {r.status for r in catalog_io.apply_catalog_comments(spark, rows).collect()} == {"ok"}
    got = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE esc_bronze.t").collect()}
    assert got["a`b"] == texts["a`b"] and got["c"] == "plain"
    about = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED esc_bronze.t").collect()}
    assert about["Comment"] == texts[None]
    spark.sql("DROP DATABASE esc_bronze CASCADE")


def test_lake_days_are_computed_not_listed(spark, tmp_path):
    import datetime as dt

    globs = lake.day_globs("/l", dt.date(2024, 1, 30), dt.date(2024, 2, 2), ["a.b", "c"])
    assert globs == ["/l/topic={a.b,c}/year=2024/month=01/day={30,31}", "/l/topic={a.b,c}/year=2024/month=02/day={01,02}"]
    path = str(tmp_path / "lake")
    days = spark.createDataFrame([(i, "t%d" % (i % 2), "2024", "01", "%02d" % (i + 1)) for i in range(9)],
                                 "offset long, topic string, year string, month string, day string")
    days.write.partitionBy("topic", "year", "month", "day").parquet(path)
    schema = T.StructType.fromDDL("offset BIGINT, topic STRING, year STRING, month STRING, day STRING")
    got = lake.scan_lake(spark, path, schema, dt.date(2024, 1, 3), dt.date(2024, 1, 6), topics=["t0"])
    assert sorted(r.offset for r in got.collect()) == [2, 4] and len(got.inputFiles()) == 2
    assert lake.scan_lake(spark, path, schema, dt.date(2023, 1, 3), dt.date(2023, 1, 6)).count() == 0


def test_lag_metrics_take_a_decoder(spark):
    import datetime as dt

    rows = spark.createDataFrame([("local.store.tb_x", 0, 5, dt.datetime(2024, 1, 1), b"\x00\x00\x00\x00\x01xx")],
                                 "topic string, partition int, offset long, timestamp timestamp, value binary")

    def decoder(records, out):
        return records.withColumn(out, F.struct(F.struct(F.lit(1000).alias("ts_ms")).alias("source"), F.lit(3000).alias("ts_ms")))

    got = lag.topic_metrics(rows, dt.datetime(1970, 1, 1, 0, 0, 10), decoder).first()
    assert (got.latency, got.freshness) == (2.0, 7.0)


def test_space_used_cleanup(spark):
    df = spark.createDataFrame([("t", "1", "16 KB", "8KB", None, "x KB", "db")], schemas.SPACE_USED)
    r = catalog.space_used(df).first()
    assert (r.reserved, r.data, r.index_size, r.unused) == (16, 8, 0, 0)


def test_tail_offsets():
    start, end = kafka.tail_offsets({"t": {"0": 10, "1": 0}})
    assert start == '{"t": {"0": 9}}' and end == '{"t": {"0": 10}}'


def test_schema_versions_int_to_boolean(spark, tmp_path):
    v1, v2 = str(tmp_path / "v1"), str(tmp_path / "v2")
    spark.createDataFrame([(1, 0), (2, 1)], "id int, boolean1 int").write.parquet(v1)
    spark.createDataFrame([(3, True, "x")], "id int, boolean1 boolean, text1 string").write.parquet(v2)
    target = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("boolean1", T.BooleanType()),
                           T.StructField("text1", T.StringType())])
    out = sorted(tuple(r) for r in lake.scan_versions(spark, [v1, v2], target).collect())
    assert out == [(1, False, None), (2, True, None), (3, True, "x")]


def test_dead_letter_split(spark):
    df = spark.createDataFrame([Row(topic="t", partition=0, offset=1, value=b"x", data=None),
                                Row(topic="t", partition=0, offset=2, value=b"y", data="ok")])
    valid, dead = lake.split_dead_letters(df, "data", F.when(F.col("data").isNull(), F.lit("bad")))
    assert valid.count() == 1 and [r.offset for r in dead.collect()] == [1]


def test_lake_tables_in_three_cases(spark, tmp_path):
    """Lower, upper and mixed-case lake tables read with their explicit schemas (case-sensitive)."""
    import decimal

    row = (1, "c", "v", 2, 3, 4, 1.5, 2.5, decimal.Decimal("1.12345678"), True, b"x", "t", 19559, 1, 2, 3, "2024-01-01T00:00:00Z")
    variants = (schemas.LAKE_ROW, schemas.upper_case(schemas.LAKE_ROW), schemas.mixed_case(schemas.LAKE_ROW))
    for i, variant in enumerate(variants):
        env = schemas.envelope(variant)
        df = spark.createDataFrame([(None, row, ("2.7", "mysql", "local", 1, "false", "store", None, 1, 1, "tb", 1,
                                                None, "f", 4, 0, None, None), "c", 5, 5, 5)], env)
        df = df.withColumn("timestamp", F.lit(dt.datetime(2024, 1, 1, 15, 30)))
        path = str(tmp_path / f"v{i}")
        lake.write_lake(lake.prepare_lake_rows(df).withColumn("topic", F.lit("local.store.tb")), path)
        back = lake.scan_lake(spark, path, lake.lake_schema(env)).first()
        assert back.after[variant.fieldNames()[0]] == 1 and (back.year, back.month, back.day) == ("2024", "01", "02")
        assert back.after.asDict()[variant.fieldNames()[12]] == 19559



def test_table_include_frame(spark):
    df = env_rows(spark, [("local.db.t", 0, 1, None, (1, "a"), ("db", "t", 1), "c", 2),
                          ("local.db.u", 0, 2, None, (1, "a"), ("db", "u", 1), "c", 2)])
    wanted = spark.createDataFrame([("db", "t")], "db string, table string")
    assert [r.offset for r in transforms.table_include_frame(df, wanted).collect()] == [1]
    assert [r.offset for r in transforms.table_include(df, "db", ["u"]).collect()] == [2]


def test_consumer_topics_failed_group(spark):
    assign = spark.createDataFrame([("g1", "m1", "t1", 0)], "group_id string, member_id string, topic string, partition int")
    groups = spark.createDataFrame([("g1",), ("bad",)], "group_id string")
    errors = spark.createDataFrame([("bad", "timeout")], "group_id string, error string")
    out = {r.group_id: r.topics for r in topology.consumer_topics(groups, assign, errors).collect()}
    assert out == {"g1": ["t1"], "bad": ["Error describing group: timeout"]}


def test_spec_driven_char_trim_and_types(spark):
    spec = spark.createDataFrame([
        ("d", "t", 1, "code", "nchar", "10"), ("d", "t", 2, "flag", "bit", "1"), ("d", "t", 3, "amount", "money", "19,4"),
        ("d", "u", 1, "code", "int", None),
    ], "DB_NAME string, TABLE_NAME string, ORDINAL_POSITION int, COLUMN_NAME string, DATA_TYPE string, "
       "COLUMN_LENGTH string")
    df = spark.createDataFrame([("ab   ", 1, "12.5")], "code string, flag int, amount string")
    out = catalog.apply_spark_types(catalog.normalize_char_by_spec(df, spec, "d", "t"), spec, "d", "t")
    r = out.first()
    assert r.code == "ab" and r.flag is True and str(r.amount) == "12.5000"
    assert dict(out.dtypes)["amount"] == "decimal(19,4)"


def test_merge_schema_scan(spark, tmp_path):
    base = str(tmp_path / "lake")
    spark.createDataFrame([("t", "2024", "01", "01", 1)], "topic string, year string, month string, day string, a int") \
        .write.partitionBy("topic", "year", "month", "day").parquet(base)
    spark.createDataFrame([("t", "2024", "01", "02", 2, "x")],
                          "topic string, year string, month string, day string, a int, b string") \
        .write.mode("append").partitionBy("topic", "year", "month", "day").parquet(base)
    rows = sorted(tuple(r) for r in lake.scan_lake(spark, base, merge_schema=True).select("a", "b").collect())
    assert rows == [(1, None), (2, "x")]


def test_apply_plan_to_one_table(spark):
    plan = ingest_rules.ingest_plan_mssql(_names(spark, ["d1.dbo.Orders", "d1.dbo.Gone"]), _names(spark, ["d1.dbo.Gone"]),
                                          _names(spark, ["d1.dbo.Orders.secret"]), _names(spark, ["d1.dbo.Orders"]))
    df = spark.createDataFrame([(1, "s", 5)], "id int, secret string, ts long")
    out, schema, table = ingest_rules.apply_plan_to_table(df, plan, "d1", "Orders", F.timestamp_millis("ts"))
    assert out.columns == ["id", "ts", "cdc_dt"] and (schema, table) == ("d1", "orders")
    assert ingest_rules.apply_plan_to_table(df, plan, "d1", "Gone", F.lit(None)) is None


def test_chain_hash_key_from_record_key(spark, sf_dir):
    from changelake.plans import fixtures as fx

    ce = fx.change_events(fx.load_events(spark, sf_dir))
    a = transforms.transform_chain(ce, transforms.BRONZE_CHAIN)
    b = transforms.transform_chain(ce, transforms.BRONZE_CHAIN, overrides={"hashKey": {"key_fields": ["user_id"]}})
    assert sorted(a.select("offset", "id_iceberg").collect()) == sorted(b.select("offset", "id_iceberg").collect())


def test_decode_json_by_schema_id(spark):
    v1 = T.StructType([T.StructField("id", T.LongType())])
    v2 = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    recs = spark.createDataFrame([(0, b'\x00\x00\x00\x00\x01{"id": 1}'), (1, b'\x00\x00\x00\x00\x02{"id": 2, "name": "b"}'),
                                  (2, b'\x00\x00\x00\x00\x09{"id": 3}')], "offset long, value binary")
    out = {r.offset: r for r in framing.decode_json_by_schema_id(recs, {1: v1, 2: v2}).collect()}
    assert out[0].data.id == 1 and out[0].data.name is None
    assert out[1].data.name == "b" and out[2].data is None and out[2].schema_id == 9


def test_parse_connector_status(spark):
    doc = ('{"c1": {"status": {"name": "c1", "connector": {"state": "RUNNING", "worker_id": "w1.host:8083"}}},'
           ' "c2": {"status": {"name": "c2", "connector": {"state": "FAILED", "worker_id": "w1.host:8083"}}}}')
    rows = topology.parse_connector_status(spark.createDataFrame([(doc,)], "text string"))
    grouped = topology.connectors_by_worker(rows).collect()
    assert [(r.worker_host, [c.name for c in r.connectors]) for r in grouped] == [("w1", ["c1", "c2"])]
    assert set(grouped[0].connectors[0].asDict()) == set(rows.columns)


def test_parse_group_descriptions(spark):
    docs = spark.createDataFrame([
        ('{"group_id": "g1", "members": [{"member_id": "m1", "assignment": [{"topic": "t1", "partition": 0},'
         ' {"topic": "t2", "partition": 1}]}, {"member_id": "m2", "assignment": [{"topic": "t1", "partition": 1}]}]}',),
        ('{"group_id": "empty", "members": []}',),
    ], "text string")
    groups, assign = topology.parse_group_descriptions(docs)
    out = {r.group_id: r.topics for r in topology.consumer_topics(groups, assign).collect()}
    assert out == {"g1": ["t1", "t2"], "empty": []}
    assert assign.count() == 3


def test_values_that_do_not_fit_are_reported(spark):
    spec = spark.createDataFrame([("d", "t", "a", "int", None), ("d", "t", "b", "bit", "1"), ("d", "t", "c", "numeric", "4,1"), ("d", "u", "a", "bit", "1")],
                                 "DB_NAME string, TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, COLUMN_LENGTH string")
    rows = [(1, "5", "true", "1.25"), (2, "x", "FALSE", "12345"), (3, None, " 0 ", "2.5"), (4, "y", "2", None), (5, "-7", "odd", "z"), (6, "", "0.0", "1e2")]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string")
    typed = catalog.apply_spark_types(df, spec, "d", "t").orderBy("id").collect()
    assert [(r.a, r.b, None if r.c is None else str(r.c)) for r in typed] == [
        (5, True, "1.3"), (None, False, None), (None, False, "2.5"), (None, True, None), (-7, None, None), (None, False, "100.0")]
    lost = catalog.cast_misfits(df, spec, "d", "t", ["id"]).collect()
    assert sorted(tuple(r) for r in lost) == [(2, "a", "int", "x"), (2, "c", "decimal(4,1)", "12345"), (4, "a", "int", "y"),
                                              (5, "b", "boolean", "odd"), (5, "c", "decimal(4,1)", "z"), (6, "a", "int", "")]
    report = {r.column_name: (r.n_values, r.n_misfits, r.smallest_misfit, r.n_rounded, r.smallest_rounded)
              for r in catalog.type_fit_report(df.repartition(3), spec, "d", "t").collect()}
    assert report == {"a": (5, 3, "", 0, None), "b": (6, 1, "odd", 0, None), "c": (5, 2, "12345", 1, "1.25")}
    none = {r.column_name: tuple(r)[3:] for r in catalog.type_fit_report(df.limit(0), spec, "d", "t").collect()}
    assert none["a"] == (0, 0, None, 0, None)
    bits = spark.createDataFrame([(bytearray(b"\x00"),), (bytearray(b"\x01"),), (None,)], "a binary")
    assert [r.a for r in catalog.apply_spark_types(bits, spec, "d", "u").collect()] == [False, True, None]
