"""Ingest rules: read rule sets, plan new ones, apply them to data.

Rule planning takes the settings lists as frames of dotted names (so lists of any
length are joined, never inlined) and emits one row per rule. Rule ids are numbered
per database in the order the rules appear: tables sorted by name, and for each table
its include / add-column / lower-case / remove-column rules, then (SQL Server) the
schema rename. Numbering is spread over range slices of the rule order, so one large
database does not end up in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.numbering import row_number_in_group
from changelake.schemas import RULE, RULE_SET, TASK
from changelake.session import COMMIT_BY_TASKS, materialize, remove, runtime_conf, write_tasks
from changelake.sources import small_files

# fixed values: the change-time column added to every table, and its source expression
CDC_COLUMN = "cdc_dt"
CDC_EXPRESSION = "$AR_H_COMMIT_TIMESTAMP"
CDC_TYPE, CDC_PRECISION = "datetime", 6
MSSQL_SCHEMA = "dbo"

# order of rule kinds inside one table
_KIND_ORDER = {"include": 0, "add-column": 1, "convert-lowercase": 2, "remove-column": 3, "rename": 9}
PLAN_COLUMNS = ["database", "rule_id", "rule_name", "rule_type", "rule_action", "rule_target", "schema_name",
                "table_name", "column_name", "value", "expression", "data_type", "precision"]


# --- R1 / R2 / S16: reading rule sets and task descriptions --------------------------

def parse_rule_sets(docs: DataFrame, text_col: str = "text", name_col: str = "file_name",
                    path_col: str | None = None) -> DataFrame:
    """Rule-set documents (file name, JSON text) -> one row per rule with its position.

    ``file_path`` identifies the document (``path_col``, else the name); undecodable
    documents are skipped (their ``rules`` are null).
    """
    parsed = docs.select(F.col(path_col or name_col).alias("file_path"), F.col(name_col).alias("file_name"),
                         F.from_json(F.col(text_col), RULE_SET).alias("_doc"))
    return (parsed.filter(F.col("_doc.rules").isNotNull())
            .select("file_path", "file_name", F.posexplode("_doc.rules").alias("pos", "rule")))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    """A copy of ``schema`` with the corrupt-record column (``StructType.add`` would mutate it)."""
    return T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])


# Spark lists the documents' folders in a job for each database; so many tasks of each cost little where it is small
_LISTING = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "64"}


def read_rule_sets(spark, path: str, layout: str = "document", glob: str = "*.json", name: str = "file") -> DataFrame:
    """Scan a folder tree of rule sets -> (file_path, file_name, pos, rule).

    ``layout="document"``: one ``{"rules": [...]}`` document per file (multi-line JSON, also
    what :func:`write_plan` writes); files that are not valid JSON land in
    ``_corrupt_record`` and are skipped. ``layout="lines"``: one rule object per line, the
    position being the rule id. A document is known by its full path (of the folder for
    lines); ``file_name`` shows the file's own name, or with ``name="folder"`` (and for
    lines) the folder's, without the ``key=`` of a partition folder. Numbered documents in
    ``document=<n>`` folders (:func:`write_plan`) are one rule set, known by the folder above;
    their rules follow one another. Documents are exploded where they are read.
    """
    reader = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record"))
    whole_path = F.col("_metadata.file_path")
    number = F.regexp_extract(whole_path, r"/document=(\d+)/[^/]+$", 1)
    file_path = F.regexp_replace(whole_path, r"/document=\d+/[^/]+$", "/rules")
    folder_path = F.regexp_extract(file_path, r"^(.*)/[^/]+$", 1)
    folder = F.regexp_replace(F.regexp_extract(folder_path, r"([^/]+)$", 1), r"^[^=]*=", "")
    if layout == "document":
        with runtime_conf(spark, _LISTING):
            raw = reader.schema(_with_corrupt(RULE_SET)).option("multiLine", "true").json(path)
        shown = folder if name == "folder" else F.col("_metadata.file_name")
        return (raw.filter(F.col("_corrupt_record").isNull() & F.col("rules").isNotNull())
                .select(file_path.alias("file_path"), shown.alias("file_name"), number.alias("_nr"), F.posexplode("rules").alias("pos", "rule"))
                .select("file_path", "file_name", (F.col("pos") + F.when(F.col("_nr") != "", F.col("_nr").cast("bigint") * _DOCUMENT_STEP).otherwise(0)).alias("pos"), "rule"))
    if layout == "lines":
        raw = reader.schema(_with_corrupt(RULE)).json(path)
        return (raw.filter(F.col("_corrupt_record").isNull())
                .select(folder_path.alias("file_path"), folder.alias("file_name"), F.col("`rule-id`").cast("int").alias("pos"),
                        F.struct(*[F.col(f"`{c}`") for c in RULE.fieldNames()]).alias("rule")))
    raise ValueError(f"unknown layout {layout!r}")


def rules_tidy(rules: DataFrame) -> DataFrame:
    """Selection include/exclude rules as (file_name, rule_type, action, schema, table).

    Schema ``dbo`` is replaced by the target of the file's *last* schema-rename rule; files
    are told apart by their path, so equal names in several folders do not mix.
    """
    r = rules.select("file_path", "file_name", "pos", F.col("rule.`rule-type`").alias("rule_type"),
                     F.col("rule.`rule-action`").alias("action"), F.col("rule.`rule-target`").alias("target"),
                     F.col("rule.`object-locator`.`schema-name`").alias("schema"),
                     F.col("rule.`object-locator`.`table-name`").alias("table"), F.col("rule.value").alias("value"))
    is_rename = (F.col("rule_type") == "transformation") & (F.col("action") == "rename") & (F.col("target") == "schema")
    is_selection = (F.col("rule_type") == "selection") & F.col("action").isin("include", "exclude")
    r = materialize(r.filter(is_rename | is_selection), "rules")  # documents are read and parsed once for both
    renames = r.filter(is_rename).groupBy("file_path").agg(F.max_by("value", "pos").alias("_target_schema"))
    sel = r.filter(is_selection)
    return (sel.join(renames, "file_path", "left")
            .select("file_name", "rule_type", "action",
                    F.when((F.col("schema") == MSSQL_SCHEMA) & F.col("_target_schema").isNotNull(),
                           F.col("_target_schema")).otherwise(F.col("schema")).alias("schema"),
                    "table"))


def tasks_tidy(tasks: DataFrame, text_col: str = "text") -> DataFrame:
    """R2: replication-task descriptions (JSON) -> 6 columns; the mapping stays JSON text."""
    t = tasks.select(F.from_json(F.col(text_col), TASK).alias("t"))
    return t.select(
        F.col("t.ReplicationTaskIdentifier").alias("replication_task_identifier"),
        F.col("t.ReplicationTaskArn").alias("replication_task_arn"),
        F.col("t.SourceEndpointArn").alias("source_endpoint_arn"),
        F.col("t.TargetEndpointArn").alias("target_endpoint_arn"),
        F.col("t.MigrationType").alias("migration_type"),
        F.col("t.TableMappings").alias("table_mappings"),
    )


# --- R3 / R4 / R6: planning ---------------------------------------------------------------

def _names(df: DataFrame, col: str = "name") -> DataFrame:
    return df.select(F.trim(F.col(col)).alias("name")).distinct()


def _split_columns(except_columns: DataFrame) -> DataFrame:
    """``db.schema.table.column`` (or ``db.table.column``) -> (owner, column) at the last dot."""
    n = F.col("name")
    return (except_columns.filter(n.contains("."))
            .select(F.regexp_extract(n, r"^(.*)\.([^.]*)$", 1).alias("owner"),
                    F.regexp_extract(n, r"^(.*)\.([^.]*)$", 2).alias("column_name")))


def table_selection(tables: DataFrame, except_tables: DataFrame) -> DataFrame:
    """Included minus excluded names (anti join)."""
    return _names(tables).join(_names(except_tables), "name", "left_anti")


def _number(rules: DataFrame) -> DataFrame:
    """Rule ids 1..n per database in rule order (a database may hold most of the rules, so
    the numbering is spread over range slices instead of one window task)."""
    kind = F.create_map(*[F.lit(x) for kv in _KIND_ORDER.items() for x in kv])[F.col("rule_action")]
    order = [(F.col("rule_action") == "rename").cast("int"), F.col("table_name"), kind, F.col("column_name"),
             F.col("_gap_slot")]
    return row_number_in_group(rules, ["database"], order, out="rule_id")


def _unnumbered(rules: DataFrame) -> DataFrame:
    """The rules without ids and names (all that applying a plan needs; no numbering pass)."""
    return rules.select(*[c for c in PLAN_COLUMNS if c not in ("rule_id", "rule_name")])


def _finish(rules: DataFrame) -> DataFrame:
    # fixed values: the beginnings of rule names
    rid = F.col("rule_id").cast("string")
    name = (F.when(F.col("rule_action") == "include", F.concat(F.lit("include_table_"), rid))
            .when(F.col("rule_action") == "add-column", F.concat(F.lit("add_column_cdc_dt_"), rid))
            .when(F.col("rule_action") == "convert-lowercase", F.concat(F.lit("table_rename_lower_case_"), rid))
            .when(F.col("rule_action") == "remove-column",
                  F.concat(F.lit("remove_column_"), F.col("column_name"), F.lit("_"), rid))
            .when(F.col("rule_action") == "rename", F.concat(F.lit("schema_rename_dbo_to_"), F.col("database"))))
    return rules.withColumn("rule_name", name).select(*PLAN_COLUMNS)


def _rule(df: DataFrame, action: str, rule_type: str, target: str | None, schema: Column, table: Column,
          column: Column | None = None, value: Column | None = None, expression: str | None = None,
          data_type: str | None = None, precision: int | None = None, gap: bool = False) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        F.col("database"), F.lit(rule_type).alias("rule_type"), F.lit(action).alias("rule_action"),
        (F.lit(target) if target else none).alias("rule_target"),
        schema.alias("schema_name"), table.alias("table_name"),
        (column if column is not None else none).alias("column_name"),
        (value if value is not None else none).alias("value"),
        (F.lit(expression) if expression else none).alias("expression"),
        (F.lit(data_type) if data_type else none).alias("data_type"),
        (F.lit(precision) if precision is not None else F.lit(None)).cast("int").alias("precision"),
        F.lit(gap).alias("_gap"), F.lit(0).alias("_gap_slot"),
    )


def ingest_plan_mssql(tables: DataFrame, except_tables: DataFrame, except_columns: DataFrame,
                      lower_case_tables: DataFrame, numbered: bool = True) -> DataFrame:
    """SQL Server rule plan per database.

    Only ``db.schema.table`` names are accepted; rules always name schema ``dbo`` (the
    exclude and lower-case lists are matched as ``db.dbo.table``), while excluded
    columns are keyed by the schema as written. Each table gets include + add
    ``cdc_dt`` (+ lower-case) (+ remove-column, by column name); every database ends
    with the ``dbo`` -> database rename, even when all its tables are excluded.
    """
    parts = F.split(F.col("name"), r"\.")
    t = (_names(tables).filter(F.size(parts) == 3)
         .select(parts[0].alias("database"), parts[1].alias("_schema"), parts[2].alias("table"), F.col("name")))
    databases = t.select("database").distinct()
    # one row per (database, table): the first spelling of the schema wins for column keys
    t = t.groupBy("database", "table").agg(F.min("name").alias("_key"))
    full = F.concat_ws(".", F.col("database"), F.lit(MSSQL_SCHEMA), F.col("table"))
    t = t.withColumn("_full", full)
    kept = t.join(_names(except_tables).withColumnRenamed("name", "_full"), "_full", "left_anti")
    lower = kept.join(_names(lower_case_tables).withColumnRenamed("name", "_full"), "_full", "left_semi")
    cols = kept.join(_split_columns(_names(except_columns)).withColumnRenamed("owner", "_key"), "_key", "inner")
    dbo, tab = F.lit(MSSQL_SCHEMA), F.col("table")
    rules = (_rule(kept, "include", "selection", None, dbo, tab)
             .unionByName(_rule(kept, "add-column", "transformation", "column", dbo, tab,
                                value=F.lit(CDC_COLUMN), expression=CDC_EXPRESSION, data_type=CDC_TYPE,
                                precision=CDC_PRECISION))
             .unionByName(_rule(lower, "convert-lowercase", "transformation", "table", dbo, tab))
             .unionByName(_rule(cols, "remove-column", "transformation", "column", dbo, tab,
                                column=F.col("column_name")))
             .unionByName(_rule(databases, "rename", "transformation", "schema", dbo,
                                F.lit(None).cast("string"), value=F.col("database"))))
    return _finish(_number(rules)) if numbered else _unnumbered(rules)


def ingest_plan_mysql(tables: DataFrame, except_tables: DataFrame, except_columns: DataFrame,
                      lower_case_tables: DataFrame, numbered: bool = True) -> DataFrame:
    """MySQL rule plan per database (split at the last dot; no cdc_dt, no rename).

    The number is taken before the exclude check, so an excluded table leaves a gap
    in the rule ids.
    """
    n = F.col("name")
    t = (_names(tables).filter(n.contains("."))
         .select(F.regexp_extract(n, r"^(.*)\.([^.]*)$", 1).alias("database"),
                 F.regexp_extract(n, r"^(.*)\.([^.]*)$", 2).alias("table"), n.alias("_full")))
    excluded = t.join(_names(except_tables).withColumnRenamed("name", "_full"), "_full", "left_semi")
    kept = t.join(_names(except_tables).withColumnRenamed("name", "_full"), "_full", "left_anti")
    lower = kept.join(_names(lower_case_tables).withColumnRenamed("name", "_full"), "_full", "left_semi")
    cols = kept.join(_split_columns(_names(except_columns)).withColumnRenamed("owner", "_full"), "_full", "inner")
    db, tab = F.col("database"), F.col("table")
    rules = (_rule(kept, "include", "selection", None, db, tab)
             .unionByName(_rule(excluded, "include", "selection", None, db, tab, gap=True))
             .unionByName(_rule(lower, "convert-lowercase", "transformation", "table", db, tab))
             .unionByName(_rule(cols, "remove-column", "transformation", "column", db, tab,
                                column=F.col("column_name"))))
    if not numbered:
        return _unnumbered(rules.filter(~F.col("_gap")))
    return _finish(_number(rules).filter(~F.col("_gap")))


def rule_documents(plan: DataFrame) -> DataFrame:
    """The plan as rule JSON objects (one line per rule), ready for a per-database JSON sink."""
    locator = F.struct(F.col("schema_name").alias("schema-name"), F.col("table_name").alias("table-name"),
                       F.col("column_name").alias("column-name"))
    rule = F.struct(
        F.col("rule_type").alias("rule-type"), F.col("rule_id").cast("string").alias("rule-id"),
        F.col("rule_name").alias("rule-name"), F.col("rule_target").alias("rule-target"),
        F.col("rule_action").alias("rule-action"), locator.alias("object-locator"),
        F.col("value").alias("value"), F.col("expression").alias("expression"),
        F.when(F.col("data_type").isNotNull(), F.struct(F.col("data_type").alias("type"),
                                                         F.col("precision").alias("precision"))).alias("data-type"),
        F.when(F.col("rule_type") == "selection", F.array().cast("array<string>")).alias("filters"))
    return plan.select("database", "rule_id", F.to_json(rule).alias("rule_json"))


# rules of a document: a few hundred bytes each, so a document is a few MB however large its database
RULES_PER_DOCUMENT = 10_000
# positions of a rule set's documents lie this far apart; no document may hold more rules
_DOCUMENT_STEP = 1_000_000


def plan_documents(plan: DataFrame, rules_per_document: int = RULES_PER_DOCUMENT) -> DataFrame:
    """(database, document, text): ``{"rules": [...]}`` documents of up to ``rules_per_document`` ids, rules by rule id.

    A database's documents are numbered from 0; each holds a range of the rule ids and is valid
    by itself, so no row and no task holds a whole database.
    """
    if not 0 < rules_per_document <= _DOCUMENT_STEP:
        raise ValueError(f"rules_per_document must be from 1 to {_DOCUMENT_STEP}")
    rules = F.transform(F.sort_array(F.collect_list(F.struct("rule_id", "rule_json"))), lambda r: r["rule_json"])
    number = F.floor((F.col("rule_id") - 1) / rules_per_document).cast("int")
    # dealt by a fixed number: rule texts compress so well that AQE would leave a task thousands of documents
    dealt = rule_documents(plan).withColumn("document", number).repartition(write_tasks(plan.sparkSession), "database", "document")
    return dealt.groupBy("database", "document").agg(
        F.concat(F.lit('{"rules": ['), F.array_join(rules, ", "), F.lit("]}")).alias("text"))


def write_plan(plan: DataFrame, path: str, rules_per_document: int = RULES_PER_DOCUMENT) -> None:
    """The plan as the replication service takes it: numbered documents below a folder for each database."""
    documents, spark = plan_documents(plan, rules_per_document), plan.sparkSession
    full = small_files.target(spark, path)
    if full is None:
        documents.write.mode("overwrite").options(**COMMIT_BY_TASKS).partitionBy("database", "document").text(path)
    else:
        remove(spark, path)
        small_files.write_texts(documents, full, ["database", "document"])


# --- R5: meaning of a plan on data ---------------------------------------------------------

def apply_ingest_plan(rows: DataFrame, plan: DataFrame, database_col: str, table_col: str,
                      commit_ts: Column, data_columns: list[str]) -> DataFrame:
    """What a plan does to change rows of many tables in one frame.

    Rows of tables without an include rule are dropped; removed columns become null for
    the tables that remove them (a multi-table frame keeps one schema); ``cdc_dt`` is
    the commit time; the target name is lower-cased where a rule says so and the schema
    renamed to the database.
    """
    # one row of rule facts per (database, table): the change rows meet the plan in a
    # single join, which Spark broadcasts or shuffles by the plan's measured bytes
    act = F.col("rule_action")
    per_table = (plan.filter(F.col("table_name").isNotNull())
                 .groupBy(F.col("database").alias("_db"), F.col("table_name").alias("_tb"))
                 .agg(F.max(act == "include").alias("_include"),
                      F.collect_set(F.when(act == "remove-column", F.col("column_name"))).alias("_removed"),
                      F.max(act == "convert-lowercase").alias("_lower")))
    renamed = (plan.filter(act == "rename")
               .select(F.col("database").alias("_db"), F.col("value").alias("_schema")))
    table_rules = per_table.filter(F.col("_include")).join(renamed, "_db", "left").drop("_include")
    keyed = rows.withColumn("_db", F.col(database_col)).withColumn("_tb", F.col(table_col))
    j = keyed.join(table_rules, ["_db", "_tb"])
    nulled = {c: F.when(F.array_contains("_removed", c), F.lit(None)).otherwise(F.col(c)) for c in data_columns}
    return (j.withColumns(nulled)
            .withColumn(CDC_COLUMN, commit_ts)
            .withColumn("target_schema", F.coalesce(F.col("_schema"), F.col("_db")))
            .withColumn("target_table", F.when(F.col("_lower"), F.lower(F.col("_tb"))).otherwise(F.col("_tb")))
            .drop("_db", "_tb", "_removed", "_lower", "_schema"))


def apply_plan_to_table(df: DataFrame, plan: DataFrame, database: str, table: str, commit_ts: Column,
                        schema: str = MSSQL_SCHEMA) -> tuple[DataFrame, str, str] | None:
    """R5 for one source table's frame: drop its removed columns, add ``cdc_dt``.

    Returns (frame, target schema, target table), or None when the plan does not include
    the table. Only the table's rule rows reach the driver (schema metadata).
    """
    rows = plan.filter((F.col("database") == database)
                       & (F.col("table_name").isNull() | (F.col("table_name") == table))).select(
        "rule_action", "column_name", "value").collect()
    actions = {r["rule_action"] for r in rows}
    if "include" not in actions:
        return None
    removed = [r["column_name"] for r in rows if r["rule_action"] == "remove-column"]
    renamed = [r["value"] for r in rows if r["rule_action"] == "rename"]
    target_table = table.lower() if "convert-lowercase" in actions else table
    target_schema = renamed[-1] if renamed else schema
    out = df.drop(*[c for c in removed if c in df.columns]).withColumn(CDC_COLUMN, commit_ts)
    return out, target_schema, target_table
