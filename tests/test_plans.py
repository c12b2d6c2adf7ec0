"""Guard the plan shapes the scale design relies on (see docs/PLANS.md)."""

from changelake.plans import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_state_is_partial_aggregate_not_window(spark, sf_dir):
    plan = _plan(registry.QUERIES["bronze_latest_state"](spark, sf_dir))
    assert "partial_max_by" in plan
    assert "Window" not in plan


def test_scrape_aggregates_are_partial(spark, sf_dir):
    plan = _plan(registry.QUERIES["lag_report"](spark, sf_dir))
    assert plan.count("partial_max_by") == 2
    assert "Window" not in plan


def test_lake_scan_prunes_partitions_and_columns(spark, sf_dir):
    df = registry.QUERIES["lake_table_scan"](spark, sf_dir)
    # only the folders of the asked days are read: they are computed, not listed and filtered
    days = {f.split("/day=")[1][:2] for f in df.inputFiles()}
    assert days <= {f"{d:02d}" for d in range(10, 21)} and all("/year=2024/month=01/" in f for f in df.inputFiles())
    assert "ReadSchema: struct<op:string,offset:bigint>" in _plan(df)


def test_open_day_range_prunes_partitions(spark, sf_dir):
    import datetime as dt

    from changelake.sources import lake

    path = registry._write_lake(spark, sf_dir)
    plan = _plan(lake.scan_lake(spark, path, start=dt.date(2024, 1, 20)).select("offset"))
    assert "PartitionFilters: [" in plan and "concat(year" in plan


def test_row_counts_read_no_lineitem(spark, sf_dir):
    files = registry.QUERIES["table_row_count"](spark, sf_dir).inputFiles()
    assert {f.rsplit("/", 1)[1] for f in files} == {"orders.parquet"}


def test_upsert_has_no_outer_join(spark, sf_dir):
    plan = _plan(registry.QUERIES["bronze_upsert"](spark, sf_dir))
    assert "FullOuter" not in plan and "partial_max_by" in plan


def test_lag_by_minute_uses_hash_aggregate(spark, sf_dir):
    plan = _plan(registry.QUERIES["lag_by_minute"](spark, sf_dir))
    assert "HashAggregate" in plan and "partial_sum" in plan
