"""Catalog sources and sinks.

* S15: catalog views over JDBC, one read per database, unioned (needs the JDBC driver
  jar on the cluster; the same operators accept Parquet snapshots of the views).
* S17: save / reload a specification snapshot; blank text becomes null.
* S18: apply column and table comments to session-catalog tables.
* S19: first rows of a bronze table in a stable order.
* S20: an in-memory frame with an explicit schema.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.operators.catalog import sql_name, sql_text


def read_catalog_jdbc(spark: SparkSession, url_for_db: dict[str, str], query: str, properties: dict[str, str],
                      split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """Run one catalog query per database and union the rows (tagged with the database).

    ``query`` is pushed to the database as a subquery (the include list can be part of it,
    so the filtering happens at the source). ``split`` = (numeric column, lower bound, upper
    bound, partitions) reads each database by that many range queries.
    """
    frames = []
    for db, url in url_for_db.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS q")
        for k, v in properties.items():
            reader = reader.option(k, v)
        if split:
            for k, v in zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), split):
                reader = reader.option(k, str(v))
        frames.append(reader.load().withColumn("SOURCE_DB", F.lit(db)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Text columns: empty or blank -> null (what a spreadsheet round trip does)."""
    return df.withColumns({f.name: F.when(F.trim(F.col(f.name)) != "", F.col(f.name))
                           for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


def save_spec(spec: DataFrame, path: str) -> None:
    """S17 write: specification snapshot as Parquet, one folder per database."""
    spec.write.mode("overwrite").partitionBy("DB_NAME").parquet(path)


def load_spec(spark: SparkSession, path: str) -> DataFrame:
    """S17 read: the snapshot with blanks as nulls (database partition kept as text)."""
    return blanks_to_null(spark.read.parquet(path))


def comment_statements(rows: DataFrame) -> DataFrame:
    """Spark SQL DDL for bronze comment rows (T16 output): escaped, one statement per row."""
    esc = sql_text(F.col("comment"))
    table = F.concat(F.lit("ALTER TABLE "), F.col("target_table"),
                     F.lit(" SET TBLPROPERTIES ('comment' = '"), esc, F.lit("')"))
    column = F.concat(F.lit("ALTER TABLE "), F.col("target_table"), F.lit(" ALTER COLUMN "),
                      sql_name(F.col("column_name")), F.lit(" COMMENT '"), esc, F.lit("'"))
    return rows.select("target_table", "column_name",
                       F.when(F.col("column_name").isNull(), table).otherwise(column).alias("sql"))


def apply_catalog_comments(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Run comment DDL for every row whose table exists; report (table, column, status).

    DDL is a driver-side catalog operation, so the statements are streamed to the driver
    one partition at a time (``toLocalIterator``), never collected whole; their number is
    the number of commented columns (catalog metadata, not data). A failing statement is
    reported and the rest carry on; a missing table is skipped.
    """
    results = []
    for r in comment_statements(rows).toLocalIterator():
        if not spark.catalog.tableExists(r["target_table"]):
            results.append((r["target_table"], r["column_name"], "missing table"))
            continue
        try:
            spark.sql(r["sql"])
            results.append((r["target_table"], r["column_name"], "ok"))
        except Exception as e:  # noqa: BLE001 - carry on after a failed statement
            results.append((r["target_table"], r["column_name"], f"error: {type(e).__name__}"))
    schema = "target_table string, column_name string, status string"
    return spark.createDataFrame(results, schema)


def bronze_head(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stable order (top-n: a sort with a limit, no full sort)."""
    return df.orderBy(*order).limit(n)


def inline_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """An in-memory frame with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)
