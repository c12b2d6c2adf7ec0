"""Specifications: how often the column side is shuffled, and rows for repeated and null keys."""

from pyspark.sql import functions as F

from changelake.operators import catalog
from changelake.plans import fixtures


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _views(spark):
    orders = spark.createDataFrame([(k, k * 3, "O", 10.5 + k, "2024-01-0%d 00:00:00" % k, "1-URGENT") for k in range(1, 5)],
                                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, d string, o_orderpriority string")
    orders = orders.withColumn("o_orderdate", F.to_timestamp("d")).drop("d")
    lines = spark.createDataFrame([(k, k * n, n, n, 2.0, "N") for k in range(1, 5) for n in (1, 2, 3)],
                                  "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string")
    return fixtures.catalog(orders, lines)


def test_specs_shuffle_the_columns_twice_at_most(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = _views(spark)
        c = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in c.items()}
        my = catalog.mysql_table_spec(c["tables"], c["columns"], c["key_usage"], c["include"], ordered=False)
        ms = catalog.mssql_table_spec(c["tables"], c["columns"], c["key_usage"], c["partitions"], c["ext_props"], c["identity"],
                                      c["include"], ordered=False)
        assert _exchanges(my) <= 4    # columns, include, tables, keys
        assert _exchanges(ms) <= 8    # tables, columns, comments, row counts; names: specification, include, keys, identity
        assert _exchanges(catalog.data_dictionary(ms)) <= _exchanges(ms)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_repeated_entries_multiply_rows_and_null_names_match_nothing(spark):
    c = _views(spark)
    name = c["tables"].filter("object_id = 1").first()["TABLE_SCHEMA"]
    columns = c["columns"].withColumn("TABLE_NAME", F.when(F.col("object_id") != 2, F.col("TABLE_NAME")))
    twice = spark.createDataFrame([(name, "tb_1", "col2")] * 2 + [(None, None, "col1")], "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string")
    props = c["ext_props"].unionByName(spark.createDataFrame([("OBJECT_OR_COLUMN", "note", 1, 0, "second"), ("OBJECT_OR_COLUMN", "MS_Description", None, 1, "x"),
                                                              ("OBJECT_OR_COLUMN", "MS_Description", 1, 3, "also")],
                                                             "class_desc string, name string, major_id bigint, minor_id int, value string"))
    out = catalog.mssql_table_spec(c["tables"], columns, c["key_usage"], c["partitions"], props, twice, ordered=False)
    n = {(r["TABLE_NAME"], r["COLUMN_NAME"]): r["n"] for r in out.groupBy("TABLE_NAME", "COLUMN_NAME").agg(F.count("*").alias("n")).collect()}
    assert n[("tb_1", "col1")] == 2 and n[("tb_1", "col2")] == 4 and n[("tb_1", "col3")] == 4  # two table comments; two identity rows; two column comments
    assert n[(None, "col1")] == 1 and n[("tb_3", "col1")] == 1
    assert out.filter("TABLE_NAME is null and (PK = 'YES' or IS_AUTO_INCREMENT = 'YES')").count() == 0
