"""Folding change batches into a bronze state that rewrites few files.

The state is divided into buckets by a hash of the key, and a bucket holds up to ``max_files``
files.  Beside each file stand the bounds of its keys and a Bloom filter over them.  A batch looks
its keys up there and rewrites only the files that may hold one of them; keys that no file holds
make a new file.  Changes mostly touch rows that were written lately, which stand in few, small
files; old files keep their names.  A bucket that has ``max_files`` files is merged to one the next
time it is touched, so a row is rewritten once in so many batches, whatever the batches touch.

The filters are blocked: a file has one block of 32,768 bits for every ``block_keys`` keys, and a
key looks at four bits of one block of each file of its bucket, found by joins on (file, block).
That is about one and a half bytes for each key of the state to read for a batch, in place of the rows.

Tables: ``<state>/version=<batch>/bucket=<b>`` rows; ``<state>-bits/version=<batch>`` filter blocks
of the files written by that batch; ``<state>-live/batch_id=<batch>`` one row for each file that
counts after the batch.  The last is written at the end, so a batch that broke or is replayed
starts from the same files again, and readers never see half a batch.  Files that neither of the
last two batches counts are removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.operators import bronze

BLOCK_BITS = 32_768  # fixed value: bits of a bitmap that bitmap_construct_agg makes
PROBES = 4
LIVE = "bucket int, file string, n bigint, n_blocks bigint, lo string, hi string"
BITS = "file string, block bigint, bits binary"


def _hash(key: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in key])


def _text(key: Sequence[str]) -> Column:
    """The key as one text, for the bounds."""
    return F.concat_ws("\x01", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])


def _with_probes(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """_h picks the block, _bits are the places within it."""
    h = _hash(key, 2)
    return df.withColumns({"_h": _hash(key, 1), "_bits": F.array(*[F.pmod(F.shiftrightunsigned(h, 15 * i), F.lit(BLOCK_BITS)) for i in range(PROBES)])})


def _is_set(bits: str, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(_hash(key, 3), F.lit(buckets)).cast("int")


def index_files(rows: DataFrame, key: Sequence[str], block_keys: int) -> tuple[DataFrame, DataFrame]:
    """(live rows, filter blocks) of the files that ``rows`` (with their bucket) were read from."""
    keys = _with_probes(rows.select("bucket", F.col("_metadata.file_path").alias("file"), *key), key).withColumn("_t", _text(key))
    live = keys.groupBy("bucket", "file").agg(F.count(F.lit(1)).alias("n"), F.min("_t").alias("lo"), F.max("_t").alias("hi"))
    live = live.select("bucket", "file", "n", F.ceil(F.col("n") / block_keys).cast("bigint").alias("n_blocks"), "lo", "hi")
    placed = keys.join(live.select("file", "n_blocks"), "file").select(
        "file", F.pmod(F.col("_h"), F.col("n_blocks")).alias("block"), F.explode("_bits").alias("_b"))
    return live, placed.groupBy("file", "block").agg(F.bitmap_construct_agg("_b").alias("bits"))


def files_to_rewrite(fresh: DataFrame, live: DataFrame, bits: DataFrame, key: Sequence[str], buckets: int, max_files: int) -> DataFrame:
    """(file): those that may hold a key of ``fresh``, and all of a touched bucket that is full."""
    keys = _with_probes(fresh.select(*key), key).withColumns({"bucket": bucket_of(key, buckets), "_t": _text(key)})
    near = keys.join(live.select("bucket", "file", "n_blocks", "lo", "hi"), "bucket").filter("_t between lo and hi")
    near = near.select("file", F.pmod(F.col("_h"), F.col("n_blocks")).alias("block"), "_bits")
    held = near.join(bits, ["file", "block"])
    for i in range(PROBES):
        held = held.filter(_is_set("bits", F.col("_bits")[i]))
    full = live.groupBy("bucket").agg(F.count(F.lit(1)).alias("_files")).filter(F.col("_files") >= max_files)
    full = live.join(full, "bucket").join(keys.select("bucket").distinct(), "bucket", "left_semi")
    return held.select("file").union(full.select("file")).distinct()


def _live_path(state_path: str, batch_id: int) -> str:
    return f"{state_path}-live/batch_id={batch_id}"


def live_files(spark: SparkSession, state_path: str, batch_id: int) -> DataFrame | None:
    """The files that count after a batch; None before the first."""
    from changelake.streaming.jobs import _exists

    path = _live_path(state_path, batch_id)
    return spark.read.schema(LIVE).parquet(path) if batch_id >= 0 and _exists(spark, f"{path}/_SUCCESS") else None


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The current state, tombstones included."""
    batches = spark.read.schema(LIVE + ", batch_id bigint").parquet(f"{state_path}-live")
    last = batches.agg(F.max("batch_id")).first()[0]
    # the scan's own list of files
    files = [r["file"] for r in live_files(spark, state_path, last).select("file").collect()]
    return spark.read.parquet(*files)


def fold_batch(batch: DataFrame, batch_id: int, state_path: str, key: Sequence[str], order: Sequence[str | Column],
               buckets: int = 64, max_files: int = 16, block_keys: int = 2_700) -> None:
    """One batch of changes folded into the state."""
    from changelake.streaming.jobs import _remove

    spark = batch.sparkSession
    fresh = bronze.latest_state(batch, key, order, keep_deletes=True).persist()
    version = f"{state_path}/version={batch_id}"
    try:
        before = live_files(spark, state_path, batch_id - 1)
        if not fresh.limit(1).count():
            rest = before
            new = None
        else:
            state, rest = fresh, before
            if before is not None:
                bits = spark.read.schema(BITS).parquet(f"{state_path}-bits")
                touched = [r["file"] for r in files_to_rewrite(fresh, before, bits, key, buckets, max_files).collect()]
                if touched:
                    stored = spark.read.schema(fresh.schema).parquet(*touched)
                    state = bronze.upsert(stored, fresh.select(*stored.columns), key, order)
                    rest = before.join(spark.createDataFrame([(f,) for f in touched], "file string"), "file", "left_anti").select(*before.columns)
            # the bucket is part of the path only, so files can be read by name
            state.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(version)
            written = spark.read.schema(state.withColumn("bucket", F.lit(0)).schema).parquet(version)
            new, blocks = index_files(written, key, block_keys)
            blocks.write.mode("overwrite").parquet(f"{state_path}-bits/version={batch_id}")
    finally:
        fresh.unpersist()
    parts = [p for p in (rest, new) if p is not None]
    now = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else spark.createDataFrame([], LIVE)
    now.coalesce(1).write.mode("overwrite").parquet(_live_path(state_path, batch_id))
    # what the batch before the last one counted and the last one did not
    older = live_files(spark, state_path, batch_id - 2)
    if older is not None and before is not None:
        gone = older.join(before.select("file"), "file", "left_anti").select("file").collect()
        _remove(spark, [r["file"] for r in gone] + [_live_path(state_path, batch_id - 2)])


def bronze_file_stream(flat: DataFrame, state_path: str, checkpoint: str, key=None, order=None, buckets: int = 64,
                       max_files: int = 16, trigger: str | None = "60 seconds", available_now: bool = False):
    """X1/X2 as a stream: every micro-batch folded into the state, few files rewritten. Returns the started query."""
    key, order = list(key or bronze.DEFAULT_KEY), order or bronze.DEFAULT_ORDER

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, batch_id, state_path, key, order, buckets, max_files)

    w = flat.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
