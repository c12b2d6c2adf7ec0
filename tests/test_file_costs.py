"""Work that costs by the file is spread over tasks, and listings are not a task for each folder."""

from pyspark.sql import functions as F

from changelake.session import configure
from changelake.operators import ingest_rules
from changelake.sources import lake


def test_listing_of_many_folders_is_a_bounded_job(spark):
    configure(spark)
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 1000


def test_plan_is_written_by_several_tasks(spark, tmp_path):
    names = spark.range(400).select(F.concat(F.lit("db"), F.col("id") % 3, F.lit(".dbo.T"), F.col("id")).alias("name"))
    none = names.filter("false")
    plan = ingest_rules.ingest_plan_mssql(names, none, none, none)
    ingest_rules.write_plan(plan, str(tmp_path / "p"), rules_per_document=10)
    parts = {p.name.split("-")[1] for p in (tmp_path / "p").rglob("part-*.txt")}
    assert len(parts) > 1
    back = ingest_rules.rules_tidy(ingest_rules.read_rule_sets(spark, str(tmp_path / "p"), glob="*.txt", name="folder"))
    assert back.count() == 400 and back.select("table").distinct().count() == 400


def test_a_fresh_lake_holds_the_same_rows(spark, tmp_path):
    rows = spark.range(100).select(F.lit("t").alias("topic"), F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("02").alias("day"), "id")
    lake.write_lake(rows, str(tmp_path / "l"), max_records_per_file=7, fresh=True)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "l")).collect()) == list(range(100))
    assert not list((tmp_path / "l").rglob("_temporary"))


def _plan(spark, n):
    names = spark.range(n).select(F.concat(F.lit("d b%"), F.col("id") % 3, F.lit(".dbo.T"), F.col("id")).alias("name"))
    none = names.filter("false")
    return ingest_rules.ingest_plan_mssql(names, none, none, none)


def test_rule_documents_equal_those_of_sparks_writer(spark, tmp_path):
    plan = _plan(spark, 60)
    ingest_rules.write_plan(_plan(spark, 90), str(tmp_path / "own"), rules_per_document=7)
    ingest_rules.write_plan(plan, str(tmp_path / "own"), rules_per_document=7)  # takes the place of the first
    ingest_rules.plan_documents(plan, 7).write.partitionBy("database", "document").text(str(tmp_path / "spark"))
    own, want = ({str(p.parent.relative_to(tmp_path / x)): p.read_text() for p in (tmp_path / x).rglob("part-*.txt")} for x in ("own", "spark"))
    assert own == want and len(own) == len(list((tmp_path / "own").rglob("*.txt"))) > 10
    assert not list((tmp_path / "own").rglob("*.crc"))  # by the small-file writer


def test_rule_documents_are_parsed_once(spark, tmp_path):
    ingest_rules.write_plan(_plan(spark, 30), str(tmp_path / "p"), rules_per_document=10)
    out = ingest_rules.rules_tidy(ingest_rules.read_rule_sets(spark, str(tmp_path / "p"), glob="*.txt", name="folder"))
    assert "Scan json" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 30
