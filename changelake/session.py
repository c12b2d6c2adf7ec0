"""Session helpers.

Everything the library needs from a session is a runtime SQL setting, so it can be
applied to a session somebody else built (the cluster's, a notebook's, a test's).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on.
#   * UTC session: epoch arithmetic and date_format never depend on the host zone.
#   * case-sensitive names: lake tables mix lower, upper and mixed case columns.
#   * partition columns stay strings: year/month/day keep their zero padding.
#   * zone-less parquet timestamps load as TIMESTAMP, so unix_millis() etc. apply.
#   * a listing of many folders is a job of some hundred tasks; Spark's default of 10,000 means a
#     task for nearly every folder, which is most of the time of a scan of many small files.
#   * AQE with skew-join splitting; automatic broadcasts stay at Spark's 10 MB limit.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "changelake", shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster leave ``master`` unset; the launcher decides. ``shuffle_partitions``
    should be sized so that one shuffle partition holds roughly 128-256 MB.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


# scratch tables of this process stand below one folder, which drop_scratch removes
RUN_ID = uuid.uuid4().hex[:12]
# the folder of the innermost scratch_block()
_block: ContextVar[str | None] = ContextVar("scratch_block", default=None)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    A cluster names it in ``spark.checkpoint.dir`` (a static setting read at start-up) or has
    set the context's checkpoint folder. Only a local master may do without: there a
    temporary folder is made and registered with the context.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        path = tempfile.mkdtemp(prefix="changelake-ckpt-")
        sc.setCheckpointDir(path)
    return path


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/changelake/{RUN_ID}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir for a job's intermediate table."""
    return f"{_block.get() or _scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove every scratch table this process has written (no frame over them may be used after)."""
    remove(spark, _scratch_root(spark))


@contextmanager
def scratch_block(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Scratch tables that the block writes are removed at its end; no frame over them may be used after.

    Gives a function like :func:`materialize` whose tables stay, for the block's result.
    """
    outside = _block.get()
    folder = scratch_path(spark, name)

    def keep(df: DataFrame, name: str) -> DataFrame:
        inside = _block.set(outside)
        try:
            return materialize(df, name)
        finally:
            _block.reset(inside)

    token = _block.set(folder)
    try:
        yield keep
    finally:
        _block.reset(token)
        remove(spark, folder)


# Write option for folders that nobody reads before the job has ended and that a repeated job writes
# anew: the tasks move their files in place themselves. By default the driver moves them one by one.
COMMIT_BY_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def small_file_reads(n_files: int, n_rows: int) -> dict[str, str]:
    """Settings for a read of many small files: the bytes that a file counts besides its own (Spark's 4 MB make
    tasks of 32 files, whose start costs as much as they do), and the rows for which a file's reader sets memory aside."""
    rows = min(4096, max(64, n_rows // max(1, n_files)))
    return {"spark.sql.files.openCostInBytes": str(256 << 10), "spark.sql.parquet.columnarReaderBatchSize": str(rows)}


def write_tasks(spark: SparkSession) -> int:
    """Tasks for work that costs by the file: a number that AQE does not reduce by the rows' few bytes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def runtime_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Runtime settings that hold for the jobs inside the block."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))


def materialize(df, name: str):
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage of a derived table that a plan uses several times (one computation
    instead of one per use) and survives executor loss, unlike a cache or a local
    checkpoint: the data sits in the cluster's shared storage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
