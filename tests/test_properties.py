"""Property checks: distributed numbering equals a plain window; folds are idempotent."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from changelake.functions.numbering import row_number_in_group
from changelake.operators import bronze

rows_strategy = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50)), min_size=1, max_size=60,
                         unique=True)


@settings(max_examples=5, deadline=None)
@given(rows=rows_strategy, slices=st.integers(1, 5))
def test_row_number_in_group_matches_window(spark, rows, slices):
    df = spark.createDataFrame(rows, "g string, o int")
    got = sorted(tuple(r) for r in row_number_in_group(df, ["g"], ["o"], num_slices=slices).collect())
    want = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
                  .collect())
    assert got == want


events_strategy = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(0, 20), st.booleans()),
                           min_size=1, max_size=30)


@settings(max_examples=5, deadline=None)
@given(events=events_strategy, cut=st.integers(0, 30))
def test_upsert_in_two_batches_equals_one_fold(spark, events, cut):
    rows = [("t", k, ts, i, "true" if d else "false") for i, (k, ts, d) in enumerate(events)]
    df = spark.createDataFrame(rows, "__db_table string, id_iceberg string, last_applied_date long, offset long, "
                                     "__deleted string")
    full = sorted(tuple(r) for r in bronze.latest_state(df).collect())
    first = bronze.latest_state(df.filter(F.col("offset") < cut), keep_deletes=True)
    state = bronze.upsert(first, df.filter(F.col("offset") >= cut))
    merged = sorted(tuple(r) for r in bronze.live_rows(state).collect())
    assert merged == full


def test_mssql_rule_ids_are_one_to_n_per_database(spark, sf_dir):
    from changelake.plans import registry

    plan = registry.QUERIES["ingest_plan_mssql"](spark, sf_dir)
    per_db = plan.groupBy("database").agg(F.count("*").alias("n"), F.min("rule_id").alias("lo"),
                                          F.max("rule_id").alias("hi"), F.countDistinct("rule_id").alias("d"))
    bad = per_db.filter((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).count()
    assert bad == 0 and per_db.count() > 1
    # every database ends with its schema rename
    last = plan.join(per_db, "database").filter(F.col("rule_id") == F.col("hi"))
    assert last.filter(F.col("rule_action") != "rename").count() == 0


def test_chain_is_deterministic_and_x1_idempotent(spark, sf_dir):
    from changelake.plans import registry

    flat = registry.bronze_flat(spark, sf_dir).select(*registry.BRONZE_COLUMNS, "__deleted")
    once = bronze.latest_state(flat, keep_deletes=True)
    twice = bronze.latest_state(once, keep_deletes=True)
    assert sorted(once.collect()) == sorted(twice.collect())


TYPE_NAMES = ["nvarchar", "varchar", "nchar", "char", "varbinary", "binary", "image", "numeric", "decimal", "money",
              "hierarchyid", "int", "bit", "datetime2", "xml", "uniqueidentifier", "tinyint"]
LENGTHS = [None, "", "-1", "1", "50", "999", "1000", "4000", "18,2", "19,4", "38,0", "abc"]


def _expected_mysql_type(t, length):
    """Brute-force statement of the type rules, binary never becomes text."""
    t = t.lower()
    n = length or ""
    binary = "binary" in t or t == "image"
    names = {"money": "DECIMAL(19,4)", "smalldatetime": "DATETIME", "datetime2": "DATETIME", "bit": "TINYINT(1)",
             "nvarchar": "VARCHAR", "ntext": "TEXT", "uniqueidentifier": "VARCHAR(64)", "nchar": "CHAR",
             "hierarchyid": "VARCHAR(100)", "tinyint": "TINYINT UNSIGNED", "xml": "LONGTEXT", "numeric": "NUMERIC",
             "decimal": "DECIMAL"}
    if n == "":
        base, suffix, changed = t, "", True
    elif "char" in t and n == "-1":
        base, suffix, changed = "text", "", True
    elif binary and n == "-1":
        base, suffix, changed = "BLOB", "", True
    elif t == "hierarchyid":
        base, suffix, changed = t, "", True
    elif n.isdigit() and int(n) >= 1000:
        base, suffix, changed = ("BLOB" if binary else "text"), "", True
    elif n.isdigit():
        base, suffix, changed = t, f"({n})", False
    elif t in ("numeric", "decimal") and "," in n:
        base, suffix, changed = t, f"({n})", False
    else:
        base, suffix, changed = t, "", False
    return (names.get(base, base.upper()) + suffix).strip(), changed


@settings(max_examples=3, deadline=None)
@given(pairs=st.lists(st.tuples(st.sampled_from(TYPE_NAMES), st.sampled_from(LENGTHS)), min_size=1, max_size=40))
def test_type_map_matches_brute_force(spark, pairs):
    from changelake.operators import catalog

    df = spark.createDataFrame(pairs, "DATA_TYPE string, COLUMN_LENGTH string")
    got = [(r.DATA_TYPE, r.COLUMN_LENGTH, r.mysql_type, r.type_changed) for r in catalog.type_map(df).collect()]
    want = [(t, n, *_expected_mysql_type(t, n)) for t, n in pairs]
    assert got == want
