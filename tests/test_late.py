"""Late rows are handed on and every row is accounted for."""

import datetime as dt
import random

from pyspark.sql import functions as F

from changelake.streaming import jobs, late

SCHEMA = "__db_table string, commit_ts timestamp, processed_ts timestamp, arrival timestamp"
T0 = dt.datetime(2024, 1, 1)


def make(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        arrival = T0 + dt.timedelta(seconds=i * 6)
        commit = arrival - dt.timedelta(seconds=rng.choice([1, 5, 30, 90, 400, 1500]) + rng.random())
        rows.append((f"t{rng.randrange(3)}", commit if rng.random() > 0.02 else None, arrival, arrival))
    return spark.createDataFrame(rows, SCHEMA)


def totals(spark, path):
    a = spark.read.schema(late.ACCOUNT + ", batch_id bigint").parquet(f"{path}/account").orderBy("batch_id").collect()
    return sum(r.n_input for r in a), sum(r.n_late for r in a), sum(r.n_emitted for r in a), a[-1].n_open


def test_emitted_and_late_rows_are_the_input(spark, tmp_path):
    df, src, path = make(spark), tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(src))
    # a file for every ten minutes of arrival, the second half after a restart
    for lo, hi in ((0, 3), (3, 6)):
        for m in range(lo, hi):
            part = df.filter(F.floor(F.unix_seconds("arrival") / 600) == int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) // 600 + m)
            part.coalesce(1).write.mode("append").parquet(str(src))
        late.lag_by_minute_exact_stream(stream(), path, str(tmp_path / "ck"), delay_seconds=120, available_now=True).awaitTermination()
    n_in, n_late, n_out, n_open = totals(spark, path)
    assert n_in == 600 and n_in == n_late + n_out + n_open and n_late > 20 and n_open > 0
    # the late rows are those of the batch twin
    cols = ["__db_table", "commit_ts", "arrival"]
    got = spark.read.parquet(f"{path}/late").select(*cols)
    want = late.late_rows(df, "arrival", batch_seconds=600, delay_seconds=120).select(*cols)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # at the end of the input the open minutes close; what was not late is what a batch aggregates
    last = spark.read.schema(late.ACCOUNT + ", batch_id bigint").parquet(f"{path}/account").agg(F.max("batch_id")).first()[0]
    late.fold_minutes(df.limit(0), last + 1, path, delay_seconds=120, last=True)
    n_in, n_late, n_out, n_open = totals(spark, path)
    assert n_in == n_late + n_out and n_open == 0
    on_time = df.join(got.withColumn("x", F.lit(1)), cols, "left").filter("x is null and commit_ts is not null")
    minutes = spark.read.parquet(f"{path}/minutes").drop("batch_id")
    assert sorted(map(str, minutes.collect())) == sorted(map(str, jobs.lag_by_minute(on_time).select(*minutes.columns).collect()))


def test_a_replayed_batch_counts_once(spark, tmp_path):
    df, path = make(spark, 100), str(tmp_path / "out")
    late.fold_minutes(df.filter("processed_ts < '2024-01-01 00:05:00'"), 0, path, delay_seconds=60)
    for _ in range(2):
        late.fold_minutes(df.filter("processed_ts >= '2024-01-01 00:05:00'"), 1, path, delay_seconds=60, last=True)
    n_in, n_late, n_out, n_open = totals(spark, path)
    assert n_in == 100 == n_late + n_out and n_open == 0


def test_empty_batches(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in range(2):
        late.fold_minutes(make(spark, 5).limit(0), n, path)
    assert totals(spark, path) == (0, 0, 0, 0)
    assert late.late_by_minute(make(spark, 5).limit(0), "arrival").count() == 0
