"""Compaction of a lake's small files by their size, in place.

The sink rolls files early so that rows show soon; scans want few large files.  The files below
``small_below`` bytes of each folder are packed into bins of about ``target_bytes`` by their
measured sizes, each bin with two files or more becomes one file, all other files stay as they are.

A folder of plain files has no transactions, so a run has three steps, each of which can be
repeated: merged files are written beside the lake's folders (``_compaction/<run>``, which scans do
not see) and counted against their sources; the list of moves and deletions is written there; then
the list is carried out.  A run that broke in its last step is finished by the next call, before
anything else.  Between the first move and the last deletion a reader may see rows twice: compact
days that nobody writes to any more (``before``), when no scan of them runs.  A folder that
the streaming file sink wrote has a log of its files, which this would contradict; it is refused.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelake.session import COMMIT_BY_TASKS, runtime_conf, small_file_reads, write_tasks
from changelake.sources.lake import PARTITION_COLUMNS
from changelake.sources.versions import _open as open_path
from changelake.sources.versions import footer_counts, lake_files

TARGET_BYTES = 256 << 20
BINS_OF_A_WINDOW = 64  # a folder's files are packed in groups of about so many bins, one window each
WORK = "_compaction"


def pack_files(files: DataFrame, target_bytes: int, small_below: int) -> DataFrame:
    """(path, size, folder, bin): the files to merge, packed by folder; files that stay are not in it."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    small = files.filter(F.col("size") < small_below).withColumn("folder", folder)
    # one row for each folder: into how many groups its files go
    groups = small.groupBy("folder").agg(F.ceil(F.sum("size") / F.lit(target_bytes * BINS_OF_A_WINDOW)).cast("bigint").alias("_groups"))
    small = small.join(groups, "folder").withColumn("_group", F.pmod(F.xxhash64("path"), F.col("_groups")))
    before = Window.partitionBy("folder", "_group").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    # next fit: a file opens the bin in which the bytes before it end
    packed = small.withColumn("_nr", F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / F.lit(target_bytes)).cast("bigint"))
    packed = packed.withColumn("bin", F.concat_ws("-", F.md5("folder"), "_group", "_nr"))
    packed = packed.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("bin")))
    return packed.filter("_n > 1").select("path", "size", "folder", "bin")


def _key(c: Column) -> Column:
    """Paths of listings and of scanned rows in one spelling."""
    return F.regexp_replace(c, "^file:/+", "file:/")


def _scanned(c: Column) -> Column:
    """The path that a scan names URL-encoded, as a listing spells it."""
    return _key(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _days_before(day: dt.date) -> Column:
    """Partition predicate: local days before ``day``."""
    part = lambda name: F.regexp_extract("path", rf"/{name}=([^/]+)/", 1)
    return F.concat(part("year"), part("month"), part("day")) < day.strftime("%Y%m%d")


def compact_small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, small_below: int | None = None,
                        before: dt.date | None = None) -> DataFrame:
    """Merge the small files of a lake (``before``: of local days before that one); the report of the run.

    ``small_below`` is half of ``target_bytes`` by default, so a merged file is not merged again
    unless its bin was left far from full.  Files of one folder may be of versions that only add
    columns.  The report has a row for each bin: folder, n_files, bytes, new_file.
    """
    fs, root = _fs(spark, path)
    if fs.exists(_fs(spark, f"{path}/_spark_metadata")[1]):
        raise ValueError(f"{path} has the log of a streaming sink; use lake.compact_lake into another folder")
    finish(spark, path)
    files = lake_files(spark, path)
    if before is not None:
        files = files.filter(_days_before(before))
    work = f"{path}/{WORK}/{uuid.uuid4().hex[:12]}"
    report = "folder string, n_files bigint, bytes bigint, new_file string"
    plan_path = f"{work}/plan"
    # the listing is written once: each use would list anew
    files.write.options(**COMMIT_BY_TASKS).parquet(f"{work}/files")
    files = spark.read.parquet(f"{work}/files")
    below = target_bytes // 2 if small_below is None else small_below
    pack_files(files, target_bytes, below).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    # the versions of the files to merge and their rows, from the footers; a row for each task and version
    footers = footer_counts(plan).groupBy("schema_json").agg(F.min("first_path").alias("path"), F.sum("n_files").alias("n_files"),
                                                              F.sum("n_rows").alias("n_rows")).collect()
    if not footers:
        fs.delete(_fs(spark, work)[1], True)
        return spark.createDataFrame([], report)
    versions = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*sorted(r["path"] for r in footers))
    # folders, not files, are named to the scan; their large files are left out before they are opened
    folders = [r["folder"] for r in plan.select("folder").distinct().collect()]
    rows = spark.read.schema(versions.schema).option("basePath", path).parquet(*folders).filter(F.col("_metadata.file_size") < below)
    rows = rows.select("*", _scanned(F.col("_metadata.file_path")).alias("_file"))
    bins = plan.select(_key(F.col("path")).alias("_file"), F.col("bin").alias("_bin"))
    n_bins = plan.select("bin").distinct().count()
    merged = rows.join(bins, "_file").drop("_file").repartition(n_bins, "_bin")
    was = sum(r["n_rows"] for r in footers)
    with runtime_conf(spark, small_file_reads(sum(r["n_files"] for r in footers), was)):
        merged.write.options(**COMMIT_BY_TASKS).partitionBy(*PARTITION_COLUMNS, "_bin").parquet(f"{work}/merged")
    now = spark.read.parquet(f"{work}/merged").count()
    if was != now:
        raise RuntimeError(f"{was} rows in the files to merge, {now} in the merged ones; nothing was changed")
    made = lake_files(spark, f"{work}/merged").withColumn("bin", F.regexp_extract("path", r"/_bin=([^/]+)/", 1))
    folders = plan.groupBy("bin").agg(F.first("folder").alias("folder"), F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"))
    made = made.join(folders, "bin").select(
        F.col("path").alias("source"), F.concat(F.col("folder"), F.lit("/"), F.regexp_extract("path", r"([^/]+)$", 1)).alias("target"),
        "folder", "n_files", "bytes")
    gone = plan.select(F.col("path").alias("source"), F.lit(None).cast("string").alias("target"), "folder",
                       F.lit(None).cast("bigint").alias("n_files"), F.lit(None).cast("bigint").alias("bytes"))
    made.unionByName(gone).write.parquet(f"{work}/moves")
    done = spark.read.parquet(f"{work}/moves").filter("target is not null").select(
        "folder", "n_files", "bytes", F.col("target").alias("new_file")).toArrow()  # a row for each bin
    finish(spark, path)
    return spark.createDataFrame(done.to_pandas(), report)


def finish(spark: SparkSession, path: str) -> int:
    """Carry out the moves of runs that have written their list, drop what others left; the number of runs finished."""
    fs, work = _fs(spark, f"{path}/{WORK}")
    if not fs.exists(work):
        return 0
    done = 0
    for status in fs.listStatus(work):
        run = status.getPath().toString()
        if fs.exists(_fs(spark, f"{run}/moves/_SUCCESS")[1]):
            moves = spark.read.parquet(f"{run}/moves").select("source", "target")
            for step in (moves.filter("target is not null"), moves.filter("target is null")):
                step.repartition(write_tasks(spark), "source").mapInArrow(_carry_out, "n bigint").agg(F.sum("n")).collect()
            done += 1
        fs.delete(status.getPath(), True)
    return done


def _carry_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Move or delete files; what is done already is left, so a task may run again."""
    from pyarrow import fs as pafs

    def there(fs, name):
        return fs.get_file_info(name).type != pafs.FileType.NotFound

    for b in batches:
        for source, target in zip(b.column("source").to_pylist(), b.column("target").to_pylist()):
            fs, name = open_path(source)
            if target is not None:
                to = open_path(target)[1]
                if there(fs, name):
                    fs.move(name, to)
                elif not there(fs, to):
                    raise FileNotFoundError(source)
            elif there(fs, name):
                fs.delete_file(name)
            head, _, last = name.rpartition("/")
            if isinstance(fs, pafs.LocalFileSystem) and there(fs, f"{head}/.{last}.crc"):
                fs.delete_file(f"{head}/.{last}.crc")
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])
