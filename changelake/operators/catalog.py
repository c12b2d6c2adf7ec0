"""Catalog specification, audit and reconciliation.

Inputs are catalog views as frames (one union over many databases, each row tagged
with its database): ``tables``, ``columns``, ``key_usage``, ``partitions``,
``ext_props``, ``identity``; see :func:`changelake.plans.fixtures.catalog`.
They come from JDBC reads of the catalog views (:mod:`changelake.sources.catalog_io`)
or from saved snapshots.

Scale notes: every join here is an equi-join on (database, table[, column]); the
per-table windows (ranking a table's columns) are bounded by the engine's column limit
per table (MySQL 4,096; SQL Server 1,024, or 30,000 sparse), so no group can hold a
large share of a big catalog. Include lists are joined, not inlined, and AQE decides
at runtime whether their measured size allows a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.schemas import TABLE_SPEC

SPEC_COLUMNS = TABLE_SPEC.fieldNames()
TABLE_KEY = ["DB_NAME", "TABLE_NAME"]
VIEW_KEY = ["TABLE_SCHEMA", "TABLE_NAME"]

# fixed values: constraint-name patterns (LIKE syntax: '_' is any one character)
PK_NAME_PATTERNS = ["pk_%", "cpk_%", "npk_%", "%_pk", "pk%_"]
UQ_NAME_PATTERNS = ["uq_%", "%_uq"]
MYSQL_PK_CONSTRAINT = "PRIMARY"
MYSQL_UQ_CONSTRAINT = "UNIQUE"


def _like_any(c: Column, patterns: Sequence[str]) -> Column:
    """Case-insensitive LIKE against several patterns (SQL Server's default collation)."""
    low = F.lower(c)
    return reduce(lambda a, b: a | b, [low.like(p) for p in patterns])


def _per_table(df: DataFrame, **aggs: Column) -> DataFrame:
    """One row for each table of a view; what it gathers is bounded by the table's columns."""
    named = df.filter("TABLE_SCHEMA is not null and TABLE_NAME is not null")
    return named.groupBy(*VIEW_KEY).agg(*[c.alias(name) for name, c in aggs.items()]) if aggs else named.select(*VIEW_KEY).distinct()


def _of_column(df: DataFrame, name: str, key: str = "COLUMN_NAME") -> DataFrame:
    """The array ``name`` of a table's entries as a left join by ``key``: a row for each entry of the row's column, or one with null."""
    found = F.filter(name, lambda e: e[key] == F.col(key))
    # most rows have one entry at most; the generator makes the others
    return df.withColumn(name, found).withColumn(name, F.explode_outer(name))


def _include(df: DataFrame, include: DataFrame | None, schema_col: str, table_col: str) -> DataFrame:
    if include is None:
        return df
    keys = include.select(F.col("TABLE_SCHEMA").alias(schema_col), F.col("TABLE_NAME").alias(table_col)).distinct()
    return df.join(keys, [schema_col, table_col], "left_semi")


# --- T1 / T2: specifications ---------------------------------------------------------

def mysql_table_spec(tables: DataFrame, columns: DataFrame, key_usage: DataFrame,
                     include: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    """The 20-field specification from MySQL's information_schema views.

    Table-level fields (comment, create/update time, rows) appear only on the row of the
    first primary-key column, as in the catalog query this mirrors.
    """
    t = tables.select("TABLE_SCHEMA", "TABLE_NAME", F.col("TABLE_COMMENT").alias("_tcomment"),
                      F.col("CREATE_TIME").alias("_ctime"), F.col("UPDATE_TIME").alias("_utime"),
                      F.col("TABLE_ROWS").alias("_rows"))
    c = _include(columns, include, "TABLE_SCHEMA", "TABLE_NAME")
    is_key = lambda name: F.col("CONSTRAINT_NAME") == name
    keys = _per_table(key_usage.filter(is_key(MYSQL_PK_CONSTRAINT) | is_key(MYSQL_UQ_CONSTRAINT)),
                      _pk=F.collect_list(F.when(is_key(MYSQL_PK_CONSTRAINT), F.struct("COLUMN_NAME", F.col("ORDINAL_POSITION").alias("pos")))),
                      _uq=F.collect_list(F.when(is_key(MYSQL_UQ_CONSTRAINT), F.struct("COLUMN_NAME"))))
    # every join is on the table, so the columns are shuffled once
    j = c.join(t, VIEW_KEY, "inner").join(keys, VIEW_KEY, "left")
    j = _of_column(_of_column(j, "_pk"), "_uq").withColumns(
        {"_pk_pos": F.col("_pk.pos"), "_is_pk": F.col("_pk"), "_is_uq": F.col("_uq")})
    first_key = F.col("_pk_pos") == 1
    length = F.coalesce(F.col("CHARACTER_MAXIMUM_LENGTH").cast("string"),
                        F.concat(F.col("NUMERIC_PRECISION").cast("string"), F.lit(","),
                                 F.coalesce(F.col("NUMERIC_SCALE").cast("string"), F.lit("0"))))
    yes_no = lambda cond: F.when(cond, F.lit("YES")).otherwise(F.lit("NO"))
    spec = j.select(
        F.col("TABLE_SCHEMA").alias("DB_NAME"),
        F.col("TABLE_NAME"),
        F.when(first_key, F.col("_tcomment")).alias("TABLE_COMMENT"),
        F.col("ORDINAL_POSITION").cast("int").alias("ORDINAL_POSITION"),
        "COLUMN_NAME", "COLUMN_TYPE",
        F.col("CHARACTER_SET_NAME").alias("CHARACTER_SET"),
        "COLLATION_NAME", "DATA_TYPE",
        length.alias("COLUMN_LENGTH"),
        "COLUMN_DEFAULT", "IS_NULLABLE",
        yes_no(F.col("_is_uq").isNotNull()).alias("IS_UNIQUE"),
        yes_no(F.coalesce(F.col("EXTRA").like("%auto_increment%"), F.lit(False))).alias("IS_AUTO_INCREMENT"),
        F.col("EXTRA").alias("COLUMN_EXTRA"),
        yes_no(F.col("_is_pk").isNotNull()).alias("PK"),
        "COLUMN_COMMENT",
        F.when(first_key, F.col("_ctime")).alias("CREATE_TIME"),
        F.when(first_key, F.col("_utime")).alias("UPDATE_TIME"),
        F.when(first_key, F.col("_rows")).cast("bigint").alias("ROW"),
    )
    return spec.orderBy("DB_NAME", "TABLE_NAME", "ORDINAL_POSITION") if ordered else spec


def table_row_count(partitions: DataFrame) -> DataFrame:
    """T5: rows per object: sum of ``row_count`` over the heap or clustered index (index_id 0/1)."""
    return (partitions.filter(F.col("index_id").isin(0, 1))
            .groupBy("object_id").agg(F.sum("row_count").cast("bigint").alias("ROW_COUNT")))


def pk_name_match(key_usage: DataFrame, name_col: str = "MSSQL_CONSTRAINT_NAME") -> DataFrame:
    """Primary-key columns recognised by constraint *name* (pk_%, cpk_%, npk_%, %_pk, pk%_)."""
    return (key_usage.filter(_like_any(F.col(name_col), PK_NAME_PATTERNS))
            .select("TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME").distinct())


def unique_name_match(key_usage: DataFrame, name_col: str = "MSSQL_CONSTRAINT_NAME") -> DataFrame:
    """Unique-constraint columns recognised by name (UQ_%, %_UQ)."""
    return (key_usage.filter(_like_any(F.col(name_col), UQ_NAME_PATTERNS))
            .select("TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME"))


def mssql_table_spec(tables: DataFrame, columns: DataFrame, key_usage: DataFrame, partitions: DataFrame,
                     ext_props: DataFrame, identity: DataFrame, include: DataFrame | None = None,
                     ordered: bool = True) -> DataFrame:
    """The 20-field specification from SQL Server's sys.* and INFORMATION_SCHEMA views.

    Table-level fields sit on the row with ORDINAL_POSITION 1. Columns are matched to
    their table by (database, schema-qualified table) rather than by bare table name.
    """
    # Two shuffles of the column side: by object id, then by table name. What belongs to single
    # columns is gathered for each table and picked from there, so no join needs a shuffle by column.
    spec_base = (tables.filter(F.col("schema_id") == 1)
                 .select("object_id", F.col("CREATE_TIME").alias("_create"), F.col("UPDATE_TIME").alias("_modify"))
                 .join(columns, "object_id", "inner"))
    # column comments: the MS_Description property of each column (distinct);
    # table comments: every table-level property, whatever its name (as the table listing does)
    of_table = F.col("minor_id") == 0
    comments = (ext_props.filter((F.col("class_desc") == "OBJECT_OR_COLUMN") & F.col("major_id").isNotNull()
                                 & (of_table | (F.col("name") == "MS_Description")))
                .groupBy(F.col("major_id").alias("object_id")).agg(
                    F.collect_set(F.when(F.col("minor_id") != 0, F.struct(F.col("minor_id").alias("column_id"), "value"))).alias("_cc"),
                    F.collect_list(F.when(of_table, F.struct("value"))).alias("_tc")))
    rows = table_row_count(partitions)
    j = spec_base.join(comments, "object_id", "left").join(rows, "object_id", "left")
    j = _of_column(j, "_cc", "column_id").withColumn("_tc", F.explode_outer("_tc")).withColumns(
        {"_ccomment": F.col("_cc.value"), "_tcomment": F.col("_tc.value")}).drop("_cc", "_tc")
    name = F.col("MSSQL_CONSTRAINT_NAME")
    pk, uq = _like_any(name, PK_NAME_PATTERNS), _like_any(name, UQ_NAME_PATTERNS)
    keys = _per_table(key_usage.filter(pk | uq), _pk=F.collect_set(F.when(pk, F.struct("COLUMN_NAME"))),
                      _uq=F.collect_list(F.when(uq, F.struct("COLUMN_NAME"))))
    if include is not None:
        # an inner join, as the optimizer would move a semi join below the joins by object id
        j = j.join(_per_table(include), VIEW_KEY, "inner")
    j = j.join(keys, VIEW_KEY, "left").join(_per_table(identity, _id=F.collect_list(F.struct("COLUMN_NAME"))), VIEW_KEY, "left")
    for fact in ("_pk", "_uq", "_id"):
        j = _of_column(j, fact)
    j = j.withColumns({"_is_pk": F.col("_pk"), "_is_uq": F.col("_uq"), "_is_id": F.col("_id")})
    first = F.col("ORDINAL_POSITION") == 1
    yes_no = lambda cond: F.when(cond, F.lit("YES")).otherwise(F.lit("NO"))
    length = F.coalesce(F.col("CHARACTER_MAXIMUM_LENGTH").cast("string"),
                        F.concat(F.col("NUMERIC_PRECISION").cast("string"), F.lit(","),
                                 F.col("NUMERIC_SCALE").cast("string")))
    spec = j.select(
        F.col("TABLE_SCHEMA").alias("DB_NAME"),
        "TABLE_NAME",
        F.when(first, F.col("_tcomment")).alias("TABLE_COMMENT"),
        F.col("ORDINAL_POSITION").cast("int").alias("ORDINAL_POSITION"),
        "COLUMN_NAME",
        F.lit(None).cast("string").alias("COLUMN_TYPE"),
        F.lit(None).cast("string").alias("CHARACTER_SET"),
        "COLLATION_NAME", "DATA_TYPE",
        length.alias("COLUMN_LENGTH"),
        "COLUMN_DEFAULT", "IS_NULLABLE",
        yes_no(F.col("_is_uq").isNotNull()).alias("IS_UNIQUE"),
        yes_no(F.col("_is_id").isNotNull()).alias("IS_AUTO_INCREMENT"),
        F.lit(None).cast("string").alias("COLUMN_EXTRA"),
        yes_no(F.col("_is_pk").isNotNull()).alias("PK"),
        F.col("_ccomment").alias("COLUMN_COMMENT"),
        F.when(first, F.col("_create")).alias("CREATE_TIME"),
        F.when(first, F.col("_modify")).alias("UPDATE_TIME"),
        F.when(first, F.col("ROW_COUNT")).cast("bigint").alias("ROW"),
    )
    return spec.orderBy("TABLE_NAME", "ORDINAL_POSITION") if ordered else spec


# --- T3, T4, T8: spec-level summaries -------------------------------------------------

def pk_columns(spec: DataFrame) -> DataFrame:
    """``db.table.column`` of every primary-key column."""
    return spec.filter(F.col("PK") == "YES").select(
        F.concat_ws(".", "DB_NAME", "TABLE_NAME", "COLUMN_NAME").alias("pk_column"))


def tables_without_pk(spec: DataFrame) -> DataFrame:
    """T4: tables none of whose columns is a primary-key column."""
    return (spec.groupBy(*TABLE_KEY).agg(F.count_if(F.col("PK") == "YES").alias("n_pk"))
            .filter(F.col("n_pk") == 0).select(*TABLE_KEY))


def spec_union(*specs: DataFrame) -> DataFrame:
    """Concatenate per-database (or per-engine) specifications by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), specs)


# --- T9: space used --------------------------------------------------------------------

SIZE_COLUMNS = ("reserved", "data", "index_size", "unused")


def space_used(frames: DataFrame) -> DataFrame:
    """Per-table sizes with the "KB" suffix stripped; missing or malformed sizes -> 0."""
    fixed = {c: F.coalesce(F.trim(F.replace(F.col(c), F.lit("KB"), F.lit(""))).try_cast("bigint"), F.lit(0))
             for c in SIZE_COLUMNS}
    return frames.withColumns(fixed)


# --- T10 - T12: type map, changes, key lists ---------------------------------------

# fixed values: SQL Server type -> MySQL type names (the DDL writer's map)
MYSQL_TYPE_NAMES = {
    "money": "DECIMAL(19,4)", "smalldatetime": "DATETIME", "datetime2": "DATETIME", "bit": "TINYINT(1)",
    "nvarchar": "VARCHAR", "ntext": "TEXT", "uniqueidentifier": "VARCHAR(64)", "nchar": "CHAR",
    "hierarchyid": "VARCHAR(100)", "tinyint": "TINYINT UNSIGNED", "xml": "LONGTEXT", "numeric": "NUMERIC",
    "decimal": "DECIMAL",
}
# SQL Server type -> Spark type (ours: the bronze tables are Spark tables)
SPARK_TYPE_NAMES = {
    "money": "decimal(19,4)", "smallmoney": "decimal(10,4)", "bit": "boolean", "tinyint": "smallint",
    "smallint": "smallint", "int": "int", "bigint": "bigint", "real": "float", "float": "double",
    "date": "date", "smalldatetime": "timestamp", "datetime": "timestamp", "datetime2": "timestamp",
    "datetimeoffset": "timestamp", "time": "string", "char": "string", "varchar": "string", "text": "string",
    "nchar": "string", "nvarchar": "string", "ntext": "string", "xml": "string", "uniqueidentifier": "string",
    "hierarchyid": "string", "sysname": "string", "binary": "binary", "varbinary": "binary", "image": "binary",
    "timestamp": "binary", "rowversion": "binary",
}


def _map_lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]


def type_map(spec: DataFrame, type_col: str = "DATA_TYPE", length_col: str = "COLUMN_LENGTH") -> DataFrame:
    """SQL Server type + length -> target types, and whether the type had to change.

    ``mysql_type`` follows the DDL writer's rules with one fix: binary types are never
    turned into text (a binary column with length >= 1000 becomes BLOB, not TEXT).
    ``spark_type`` is the type the bronze table uses.
    """
    t = F.lower(F.col(type_col).cast("string"))
    raw_len = F.col(length_col).cast("string")
    length = F.coalesce(raw_len, F.lit(""))
    is_digits = length.rlike("^[0-9]+$")
    long_len = is_digits & (F.length(length) >= 4)  # >= 1000 without overflowing a cast
    is_binary = t.contains("binary") | (t == "image")
    # (type after the length rule, length text, changed?)
    rule_type = (F.when(length == "", t)
                 .when(t.contains("char") & (length == "-1"), F.lit("text"))
                 .when(is_binary & (length == "-1"), F.lit("BLOB"))
                 .when(t == "hierarchyid", t)
                 .when(is_digits & long_len, F.when(is_binary, F.lit("BLOB")).otherwise(F.lit("text")))
                 .otherwise(t))
    rule_len = (F.when(length == "", F.lit(""))
                .when(t.contains("char") & (length == "-1"), F.lit(""))
                .when(is_binary & (length == "-1"), F.lit(""))
                .when(t == "hierarchyid", F.lit(""))
                .when(is_digits & long_len, F.lit(""))
                .when(is_digits, F.concat(F.lit("("), length, F.lit(")")))
                .when(t.isin("numeric", "decimal") & length.contains(","), F.concat(F.lit("("), length, F.lit(")")))
                .otherwise(F.lit("")))
    changed = ((length == "") | (t.contains("char") & (length == "-1")) | (is_binary & (length == "-1"))
               | (t == "hierarchyid") | (is_digits & long_len))
    mysql_name = F.coalesce(_map_lookup(MYSQL_TYPE_NAMES, rule_type), F.upper(rule_type))
    precision = F.split(length, ",")
    spark_base = F.coalesce(_map_lookup(SPARK_TYPE_NAMES, t), F.lit("string"))
    spark_type = (F.when(t.isin("numeric", "decimal") & length.contains(","),
                         F.concat(F.lit("decimal("), F.trim(precision[0]), F.lit(","), F.trim(precision[1]), F.lit(")")))
                  .when(t.isin("numeric", "decimal"), F.lit("decimal(38,0)"))
                  .otherwise(spark_base))
    return spec.withColumns({
        "mysql_type": F.trim(F.concat(mysql_name, rule_len)),
        "type_changed": changed,
        "spark_type": spark_type,
    })


def type_change_report(spec: DataFrame) -> DataFrame:
    """Columns whose type had to change, per table."""
    mapped = type_map(spec)
    return mapped.filter("type_changed").select(
        *TABLE_KEY, "COLUMN_NAME", "DATA_TYPE", "COLUMN_LENGTH", "mysql_type", "spark_type")


def pk_list_per_table(spec: DataFrame) -> DataFrame:
    """Primary-key columns of each table in column order, comma joined."""
    keys = spec.filter(F.col("PK") == "YES")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("ORDINAL_POSITION").alias("o"),
                                                   F.col("COLUMN_NAME").alias("c"))))
    return (keys.groupBy(*TABLE_KEY).agg(ordered.alias("_k"))
            .select(*TABLE_KEY, F.array_join(F.transform("_k", lambda x: x["c"]), ",").alias("pk_columns")))


# --- T13 - T15: comments from one engine's spec onto another's -----------------------

def _ranked(spec: DataFrame, prefix: str) -> DataFrame:
    w = Window.partitionBy(*TABLE_KEY).orderBy("ORDINAL_POSITION", "COLUMN_NAME")
    cols = [F.col(c).alias(f"{prefix}{c}") for c in spec.columns if c not in TABLE_KEY]
    return spec.select(*TABLE_KEY, *cols, F.row_number().over(w).alias(f"{prefix}rank"))


def comment_match_by_name(src: DataFrame, dest: DataFrame) -> DataFrame:
    """Source columns matched to target columns by exact name within (db, table).

    ``idx`` is the source column's rank in its table (1 = first column), which decides
    whether the table comment goes along (T15).
    """
    s = _ranked(src, "src_").withColumnRenamed("src_rank", "idx")
    d = dest.select(*[F.col(c).alias(f"dst_{c}") for c in dest.columns])
    cond = ((s["DB_NAME"] == d["dst_DB_NAME"]) & (s["TABLE_NAME"] == d["dst_TABLE_NAME"])
            & (s["src_COLUMN_NAME"] == d["dst_COLUMN_NAME"]))
    return s.join(d, cond, "inner").drop("dst_DB_NAME", "dst_TABLE_NAME")


def comment_match_by_sequence(src: DataFrame, dest: DataFrame) -> DataFrame:
    """The n-th source column paired with the n-th target column; stops at the shorter side."""
    s = _ranked(src, "src_").withColumnRenamed("src_rank", "idx")
    d = _ranked(dest, "dst_").withColumnRenamed("dst_rank", "idx")
    return s.join(d, [*TABLE_KEY, "idx"], "inner")


def sql_text(c: Column) -> Column:
    """Text inside a quoted SQL literal: backslashes first, then quotes."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))


def sql_name(c: Column) -> Column:
    """A column name as a quoted identifier."""
    return F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`"))


def default_clause(c: Column) -> Column:
    """Column default as DDL: digits and now()/current_timestamp bare, other text quoted."""
    low = F.lower(c)
    bare = c.rlike("^[0-9]+$") | low.contains("now") | low.contains("current_timestamp")
    return F.when(c.isNull(), F.lit("")).when(bare, F.concat(F.lit("DEFAULT "), c)) \
        .otherwise(F.concat(F.lit("DEFAULT '"), sql_text(c), F.lit("'")))


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def comment_rows(matched: DataFrame) -> DataFrame:
    """What to set on the target, one row per statement.

    A table row when the first source column matched and carries a table comment; a
    column row for every matched column with a comment, with the target's attributes
    (type, charset, collation, nullability, default, auto increment, unique).
    ``statement`` is the MySQL text of that change.
    """
    # fixed values: the texts of the ALTER statements
    target = F.concat_ws(".", F.col("DB_NAME"), F.col("TABLE_NAME"))
    table_row = F.when((F.col("idx") == 1) & _nonempty(F.col("src_TABLE_COMMENT")), F.struct(
        F.lit("table").alias("kind"), F.lit(None).cast("string").alias("column_name"),
        F.col("src_TABLE_COMMENT").alias("comment"),
        F.concat(F.lit("ALTER TABLE "), target, F.lit(" COMMENT = '"), sql_text(F.col("src_TABLE_COMMENT")), F.lit("';"))
        .alias("statement")))
    nullability = F.when(F.col("dst_IS_NULLABLE") == "YES", F.lit("NULL")).otherwise(F.lit("NOT NULL"))
    parts = [
        F.when(_nonempty(F.col("dst_CHARACTER_SET")), F.concat(F.lit("CHARACTER SET "), F.col("dst_CHARACTER_SET"))),
        F.when(_nonempty(F.col("dst_COLLATION_NAME")), F.concat(F.lit("COLLATE "), F.col("dst_COLLATION_NAME"))),
        nullability,
        F.when(F.col("dst_COLUMN_DEFAULT").isNotNull(), default_clause(F.col("dst_COLUMN_DEFAULT"))),
        F.when(F.col("dst_IS_AUTO_INCREMENT") == "YES", F.lit("AUTO_INCREMENT")),
        F.when(F.col("dst_IS_UNIQUE") == "YES", F.lit("UNIQUE")),
    ]
    stmt = F.concat_ws(" ", F.concat(F.lit("ALTER TABLE "), target, F.lit(" MODIFY COLUMN "),
                                     F.col("dst_COLUMN_NAME"), F.lit(" "),
                                     F.coalesce(F.col("dst_COLUMN_TYPE"), F.lit("None"))),
                       *parts, F.concat(F.lit("COMMENT '"), sql_text(F.col("src_COLUMN_COMMENT")), F.lit("';")))
    column_row = F.when(_nonempty(F.col("src_COLUMN_COMMENT")), F.struct(
        F.lit("column").alias("kind"), F.col("dst_COLUMN_NAME").alias("column_name"),
        F.col("src_COLUMN_COMMENT").alias("comment"), stmt.alias("statement")))
    # both kinds come out of one pass over the matches (no union of two re-computations)
    rows = F.filter(F.array(table_row, column_row), lambda r: r.isNotNull())
    return (matched.select("DB_NAME", "TABLE_NAME", F.explode(rows).alias("_r"))
            .select("DB_NAME", "TABLE_NAME", "_r.*"))


# --- T16, T17: bronze comments and the data dictionary ------------------------------

def _bronze_name(db: Column, table: Column) -> Column:
    return F.concat(F.lower(db), F.lit("_bronze."), F.lower(table))


def bronze_comment_rows(spec: DataFrame) -> DataFrame:
    """Comments for ``{db}_bronze.{table}``: quotes removed, text trimmed.

    One table row per table with the first non-empty table comment in column order,
    and a row per column with a non-empty comment.
    """
    clean = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("'"), F.lit(""))
    s = spec.select(*TABLE_KEY, "ORDINAL_POSITION", "COLUMN_NAME",
                    clean("TABLE_COMMENT").alias("_tc"), clean("COLUMN_COMMENT").alias("_cc"))
    first_tc = (s.filter(F.col("_tc") != "")
                .groupBy(*TABLE_KEY)
                .agg(F.min_by("_tc", F.struct("ORDINAL_POSITION", "COLUMN_NAME")).alias("_tc")))
    target = _bronze_name(F.col("DB_NAME"), F.col("TABLE_NAME"))
    table_rows = first_tc.select(
        target.alias("target_table"), F.lit(None).cast("string").alias("column_name"),
        F.trim(F.col("_tc")).alias("comment"),
        F.concat(F.lit("ALTER TABLE "), target, F.lit(" SET TBLPROPERTIES ('comment' = '"), sql_text(F.trim(F.col("_tc"))),
                 F.lit("');")).alias("statement"))
    column_rows = s.filter(F.col("_cc") != "").select(
        target.alias("target_table"), F.col("COLUMN_NAME").alias("column_name"), F.trim(F.col("_cc")).alias("comment"),
        F.concat(F.lit("ALTER TABLE "), target, F.lit(" ALTER COLUMN "), sql_name(F.col("COLUMN_NAME")), F.lit(" COMMENT '"),
                 sql_text(F.trim(F.col("_cc"))), F.lit("';")).alias("statement"))
    return table_rows.unionByName(column_rows)


def data_dictionary(spec: DataFrame) -> DataFrame:
    """Per-table dictionary rows: header + (SEQ, NAME, TYPE, PK 'V'/'', COMMENT).

    The header uses the first non-empty table comment in column order (where the comment
    stands on the key's row and the key is not the first column, it is still found).
    """
    # a window over the table's rows, so the specification is computed once; a null name is no table
    place = F.when(_nonempty(F.col("TABLE_COMMENT")), F.struct("ORDINAL_POSITION", "COLUMN_NAME"))
    first = F.min_by("TABLE_COMMENT", place).over(Window.partitionBy(*TABLE_KEY))
    j = spec.withColumn("_tc", F.when(F.col("DB_NAME").isNotNull() & F.col("TABLE_NAME").isNotNull(), first))
    title = F.concat(F.lit("### "), F.col("DB_NAME"), F.lit("."), F.col("TABLE_NAME"),
                     F.when(F.col("_tc").isNotNull(), F.concat(F.lit(" / "), F.col("_tc"))).otherwise(F.lit("")))
    return j.select(
        *TABLE_KEY, title.alias("header"), F.col("_tc").alias("table_comment"),
        F.col("ORDINAL_POSITION").alias("SEQ"), F.col("COLUMN_NAME").alias("NAME"), F.col("DATA_TYPE").alias("TYPE"),
        F.when(F.col("PK") == "YES", F.lit("V")).when(F.col("PK") == "NO", F.lit("")).otherwise(F.col("PK")).alias("PK"),
        F.col("COLUMN_COMMENT").alias("COMMENT"))


# --- T18: names that need quoting -----------------------------------------------------

# fixed values: characters that force a quoted identifier (Hangul syllables, brackets, #, ~, space)
QUOTE_CHARS = "[가-힣()\\[\\]#~ ]"


# fixed values: the words that Spark SQL's ANSI mode reserves (bronze tables are Spark
# tables); the list of another target engine is a parameter of naming_audit
RESERVED_WORDS = """
ALL AND ANY AS AUTHORIZATION BOTH CALL CASE CAST CHECK COLLATE COLLATION COLUMN CONSTRAINT CREATE CROSS CURRENT_DATE
CURRENT_TIME CURRENT_TIMESTAMP CURRENT_USER DISTINCT ELSE END ESCAPE EXCEPT EXECUTE FALSE FETCH FILTER FOR FOREIGN FROM
FULL GRANT GROUP HAVING IN INNER INTERSECT INTO IS JOIN LATERAL LEADING LEFT NATURAL NOT NULL OFFSET ON ONLY OR ORDER
OUTER OVERLAPS PRIMARY RECURSIVE REFERENCES RIGHT SELECT SESSION_USER SOME SQL TABLE THEN TIME TO TRAILING UNION UNIQUE
UNKNOWN USER USING WHEN WHERE WITH WITHIN
""".split()


def needs_quoting(name: Column, reserved: Column | None = None) -> Column:
    """Name needs quoting: special characters, all digits, or (``reserved``) a reserved word."""
    n = F.trim(name)
    cond = n.rlike(QUOTE_CHARS) | n.rlike("^[0-9]+$")
    return cond | reserved if reserved is not None else cond


def naming_audit(spec: DataFrame, reserved_words: DataFrame | None = None) -> DataFrame:
    """Per database, columns and tables whose names must be quoted.

    ``reserved_words`` is a one-column frame ``word`` of the target's reserved words; it is
    joined, so lists of any length work. Without it the target is Spark SQL.
    """
    if reserved_words is None:
        reserved_words = spec.sparkSession.createDataFrame([(w,) for w in RESERVED_WORDS], "word string")
    words = reserved_words.select(F.upper(F.trim(F.col("word"))).alias("_w")).distinct()
    # one pass over the specification: a table's row and its columns' rows (names that are null need no quoting)
    row = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    names = (spec.groupBy(*TABLE_KEY).agg(F.collect_list("COLUMN_NAME").alias("_c"))
             .withColumn("_n", F.explode(F.concat(F.array(row("table", F.col("TABLE_NAME"))),
                                                  F.transform("_c", lambda c: row("column", c)))))
             .select("DB_NAME", "_n.kind", "TABLE_NAME", "_n.name"))
    flagged = (names.join(words, F.upper(F.trim(F.col("name"))) == F.col("_w"), "left")
               .withColumn("reserved", F.col("_w").isNotNull())
               .withColumn("special", needs_quoting(F.col("name")))
               .filter(F.col("reserved") | F.col("special"))
               .drop("_w"))
    return flagged


def naming_audit_summary(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("DB_NAME", "kind").agg(F.count("*").alias("n_names"))


# --- spec-driven column handling (C13, T10 applied to data) -----------------------------

def _table_columns(spec: DataFrame, db: str, table: str, cond: Column | None = None) -> DataFrame:
    rows = spec.filter((F.col("DB_NAME") == db) & (F.col("TABLE_NAME") == table))
    return rows.filter(cond) if cond is not None else rows


def char_columns(spec: DataFrame, db: str, table: str) -> list[str]:
    """Names of one table's CHAR/NCHAR columns (schema metadata, a handful of rows)."""
    rows = _table_columns(spec, db, table, F.lower(F.col("DATA_TYPE")).isin("char", "nchar"))
    return [r["COLUMN_NAME"] for r in rows.select("COLUMN_NAME").collect()]


def normalize_char_by_spec(df: DataFrame, spec: DataFrame, db: str, table: str) -> DataFrame:
    """C13 driven by the spec: right-trim the columns the source declares as CHAR."""
    cols = [c for c in char_columns(spec, db, table) if c in df.columns]
    return df.withColumns({c: F.rtrim(F.col(c)) for c in cols})


def apply_spark_types(df: DataFrame, spec: DataFrame, db: str, table: str) -> DataFrame:
    """Cast one table's data columns to the Spark types of the type map.

    Casts are ``try_cast`` so a value that does not fit becomes null instead of failing
    the job under ANSI mode; bit columns arriving as numbers, bytes or text become booleans.
    :func:`cast_misfits` lists the values that this nulls, :func:`type_fit_report` counts them.
    """
    types = dict(df.dtypes)
    return df.withColumns({n: fitted(F.col(f"`{n}`"), types[n], t) for n, t in spark_types(df, spec, db, table).items()})


def spark_types(df: DataFrame, spec: DataFrame, db: str, table: str) -> dict[str, str]:
    """Column -> Spark type of the frame's columns that the spec knows (schema metadata, a row a column)."""
    mapped = type_map(_table_columns(spec, db, table)).select("COLUMN_NAME", "spark_type").collect()
    return {r["COLUMN_NAME"]: r["spark_type"] for r in mapped if r["COLUMN_NAME"] in df.columns}


def fitted(c: Column, source: str, target: str) -> Column:
    """The value as ``target``, null where it does not fit.

    A boolean comes from a number (not 0), from bytes (a bit that is set), or from text that
    says so (``1 t true y yes`` and their opposites, or a number); other text does not fit.
    """
    if target != "boolean" or source == "boolean":
        return c.try_cast(target)
    if source == "binary":
        return F.when(F.octet_length(c) > 0, ~F.hex(c).rlike("^0*$"))
    if source == "string":
        return F.coalesce(F.trim(c).try_cast("boolean"), F.trim(c).try_cast("double") != 0)
    return c != 0


def _shown(c: Column, source: str) -> Column:
    return F.hex(c) if source == "binary" else c.cast("string")


def _rounded(c: Column, target: str, value: Column) -> Column:
    """The value fits, but digits are lost on the way."""
    exact = target.startswith("decimal") or target in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(c.try_cast("decimal(38,18)") != value.try_cast("decimal(38,18)"), F.lit(False)) if exact else F.lit(False)


def fit_report(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """T10 on data: per column its values, misfits (nulled by the cast), rounded values, and the smallest of each as example.

    One pass whatever the number of columns: counts and minima, reduced in every task before the
    shuffle. Columns: column_name, source_type, spark_type, n_values, n_misfits, smallest_misfit,
    n_rounded, smallest_rounded.
    """
    source = dict(df.dtypes)
    aggs, rows = [], []
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    for i, (name, target) in enumerate(sorted(types.items())):
        c = F.col(f"`{name}`")
        value, text = fitted(c, source[name], target), _shown(c, source[name])
        misfit, lost = c.isNotNull() & value.isNull(), _rounded(c, target, value)
        for key, agg in (("n", F.count(c)), ("m", count(misfit)), ("x", F.min(F.when(misfit, text))), ("r", count(lost)), ("y", F.min(F.when(lost, text)))):
            aggs.append(agg.alias(f"{key}{i}"))
        rows.append(F.struct(F.lit(name).alias("column_name"), F.lit(source[name]).alias("source_type"), F.lit(target).alias("spark_type"),
                             F.col(f"n{i}").alias("n_values"), F.coalesce(f"m{i}", F.lit(0).cast("bigint")).alias("n_misfits"),
                             F.col(f"x{i}").alias("smallest_misfit"), F.coalesce(f"r{i}", F.lit(0).cast("bigint")).alias("n_rounded"),
                             F.col(f"y{i}").alias("smallest_rounded")))
    if not rows:
        raise ValueError("no column to report on")
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def type_fit_report(df: DataFrame, spec: DataFrame, db: str, table: str) -> DataFrame:
    """:func:`fit_report` of one table's data against the Spark types of its specification."""
    return fit_report(df, spark_types(df, spec, db, table))


def cast_misfits(df: DataFrame, spec: DataFrame, db: str, table: str, key: list[str]) -> DataFrame:
    """Every value that :func:`apply_spark_types` nulls: the row's key, column_name, spark_type, value as text (bytes as hex)."""
    source = dict(df.dtypes)
    found = []
    for name, target in sorted(spark_types(df, spec, db, table).items()):
        c = F.col(f"`{name}`")
        bad = c.isNotNull() & fitted(c, source[name], target).isNull()
        found.append(F.when(bad, F.struct(F.lit(name).alias("column_name"), F.lit(target).alias("spark_type"), _shown(c, source[name]).alias("value"))))
    if not found:
        raise ValueError("no column to report on")
    rows = df.select(*[F.col(f"`{k}`") for k in key], F.explode(F.filter(F.array(*found), lambda m: m.isNotNull())).alias("_m"))
    return rows.select(*key, "_m.*")
