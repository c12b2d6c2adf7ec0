"""S17 snapshot and S18 comment application on session-catalog tables."""

from pyspark.sql import functions as F

from changelake.operators import catalog
from changelake.sources import catalog_io


def test_apply_catalog_comments(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_bronze")
    spark.sql(f"CREATE TABLE IF NOT EXISTS shop_bronze.orders (id INT, note STRING) USING parquet "
              f"LOCATION '{tmp_path / 'orders'}'")
    spec = spark.createDataFrame([
        ("SHOP", "Orders", "Customer's orders", 1, "id", "key"),
        ("SHOP", "Orders", None, 2, "note", "free 'text'"),
        ("SHOP", "Missing", "gone", 1, "x", "nope"),
    ], "DB_NAME string, TABLE_NAME string, TABLE_COMMENT string, ORDINAL_POSITION int, COLUMN_NAME string, "
       "COLUMN_COMMENT string")
    rows = catalog.bronze_comment_rows(spec)
    status = {(r.target_table, r.column_name): r.status for r in catalog_io.apply_catalog_comments(spark, rows).collect()}
    assert status[("shop_bronze.orders", "id")] == "ok"
    assert status[("shop_bronze.missing", None)] == "missing table"
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE shop_bronze.orders").collect()}
    assert described["id"] == "key" and described["note"] == "free text"
    extended = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED shop_bronze.orders").collect()}
    assert extended.get("Comment") == "Customers orders"


def test_spec_snapshot_roundtrip_blanks(spark, tmp_path):
    spec = spark.createDataFrame([("d", "t", 1, "a", "", "  ")],
                                 "DB_NAME string, TABLE_NAME string, ORDINAL_POSITION int, COLUMN_NAME string, "
                                 "COLUMN_EXTRA string, COLUMN_COMMENT string")
    catalog_io.save_spec(spec, str(tmp_path / "spec"))
    r = catalog_io.load_spec(spark, str(tmp_path / "spec")).first()
    assert r.COLUMN_EXTRA is None and r.COLUMN_COMMENT is None and r.DB_NAME == "d"


def test_bronze_head_and_inline_frame(spark):
    df = catalog_io.inline_frame(spark, [(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert [r.k for r in catalog_io.bronze_head(df, ["k"], 2).collect()] == [1, 2]
    assert df.filter(F.col("k") > 0).count() == 3
