"""The bronze state by files: stream equals batch, few files rewritten, filters never miss, replays."""

import random

import pytest
from pyspark.sql import functions as F

from changelake.operators import bronze
from changelake.plans import registry
from changelake.streaming import bronze_files

SCHEMA = "__db_table string, id_iceberg string, last_applied_date long, offset long, v string, __deleted string"
KEY, ORDER = bronze.DEFAULT_KEY, bronze.DEFAULT_ORDER


def live(spark, state, batch):
    return {r["file"] for r in bronze_files.live_files(spark, str(state), batch).collect()}


def test_stream_equals_batch_fold(spark, sf_dir, tmp_path):
    flat = registry.bronze_flat(spark, sf_dir).select(*registry.BRONZE_COLUMNS, "__deleted")
    flat.repartition(4).write.parquet(str(tmp_path / "src"))
    src = spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "src"))
    bronze_files.bronze_file_stream(src, str(tmp_path / "state"), str(tmp_path / "ck"), buckets=4, max_files=3,
                                    available_now=True).awaitTermination()
    got = bronze.live_rows(bronze_files.read_state(spark, str(tmp_path / "state"))).select(*registry.BRONZE_COLUMNS)
    want = bronze.latest_state(flat).select(*registry.BRONZE_COLUMNS)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_a_small_batch_leaves_most_files_alone(spark, tmp_path):
    state, rng, rows = str(tmp_path / "state"), random.Random(5), []

    def fold(n, new):
        rows.extend(new)
        bronze_files.fold_batch(spark.createDataFrame(new, SCHEMA), n, state, KEY, ORDER, buckets=4)

    for n in range(8):
        fold(n, [("t", f"k{n * 100 + i:05d}", n, n * 1000 + i, "a", "false") for i in range(100)])
    before = live(spark, state, 7)
    assert len(before) == 32  # new keys never rewrite a file
    # 1 % of the keys, written lately as changes mostly are, and some of them new
    touched = [f"k{700 + i:05d}" for i in rng.sample(range(100), 8)] + ["new1", "new2"]
    fold(8, [("t", k, 9, 9000 + i, "b", "true" if i % 2 else "false") for i, k in enumerate(touched)])
    after = live(spark, state, 8)
    assert len(before - after) <= 5 and len(after - before) <= 4
    fold(9, [("t", "k00003", 0, 1, "older", "false")])  # an older change changes nothing
    got = sorted(tuple(r) for r in bronze_files.read_state(spark, state).select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect())
    whole = bronze.latest_state(spark.createDataFrame(rows, SCHEMA), keep_deletes=True)
    assert got == sorted(tuple(r) for r in whole.select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect())
    # superseded files went after two batches
    on_disk = {str(p) for p in (tmp_path / "state").rglob("*.parquet")}
    names = lambda files: {f.split("/state/")[1] for f in files}
    assert names(on_disk) == names(live(spark, state, 8) | live(spark, state, 9))


def test_a_replayed_batch_and_full_buckets(spark, tmp_path):
    state = str(tmp_path / "state")
    batch = lambda n: spark.createDataFrame([("t", f"k{n}-{i}", n, n * 10 + i, "a", "false") for i in range(5)], SCHEMA)
    for n in range(6):
        bronze_files.fold_batch(batch(n), n, state, KEY, ORDER, buckets=1, max_files=4)
        assert len(live(spark, state, n)) <= 4
    bronze_files.fold_batch(batch(5), 5, state, KEY, ORDER, buckets=1, max_files=4)
    assert bronze_files.read_state(spark, state).count() == 30
    bronze_files.fold_batch(batch(9).limit(0), 6, state, KEY, ORDER, buckets=1, max_files=4)
    assert bronze_files.read_state(spark, state).count() == 30


@pytest.mark.parametrize("block_keys", [50, 2_700])
def test_filters_find_every_key_and_few_others(spark, tmp_path, block_keys):
    rows = spark.range(20_000).selectExpr("concat('t', id % 3) as a", "cast(id as string) as b", "cast(id % 4 as int) as bucket")
    rows = rows.withColumn("bucket", bronze_files.bucket_of(["a", "b"], 4))
    rows.repartition("bucket").write.partitionBy("bucket").parquet(str(tmp_path / "f"))
    written = spark.read.schema("a string, b string, bucket int").parquet(str(tmp_path / "f"))
    lives, bits = (df.cache() for df in bronze_files.index_files(written, ["a", "b"], block_keys))
    one = lambda k: spark.createDataFrame([("t0", k)], "a string, b string")
    find = lambda df: bronze_files.files_to_rewrite(df, lives, bits, ["a", "b"], 4, 99).count()
    assert find(one("3")) == 1 and find(one("19998")) == 1
    # every key is found in its file; of keys that are not there few are
    keys = bronze_files._with_probes(rows.select("a", "b", "bucket"), ["a", "b"])
    other = bronze_files._with_probes(rows.select("a", F.concat("b", F.lit("x")).alias("b"), "bucket"), ["a", "b"])
    for df, share in ((keys, (1, 1)), (other, (0, 0.02 if block_keys == 2_700 else 0.001))):
        near = df.join(lives.select("bucket", "file", "n_blocks"), "bucket")
        near = near.withColumn("block", F.pmod(F.col("_h"), F.col("n_blocks"))).join(bits, ["file", "block"])
        for i in range(bronze_files.PROBES):
            near = near.filter(bronze_files._is_set("bits", F.col("_bits")[i]))
        assert share[0] * 20_000 <= near.count() <= share[1] * 20_000
