"""Exactly what arrived: replayed records dropped, missing and repeated offsets, outcomes by offset.

Delivery is at least once: a consumer that stores its offset after the work sees records again.
Counts alone cannot show that (a lost and a repeated record cancel out), offsets can.

Offsets are handled as sets of intervals per topic and partition.  A set is built and merged in
slices of ``width`` offsets, so a hot partition is many tasks and a window never holds more than a
slice; only pieces that touch a slice's border are looked at across slices, two of each at most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("topic", "partition", "offset")
PARTITION = ("topic", "partition")
SLICE = 1_000_000  # offsets of a partition that one window may hold


def drop_replayed(records: DataFrame, keep_for: str = "1 hour") -> DataFrame:
    """Every (topic, partition, offset) once.

    On a stream a key is remembered for ``keep_for`` after it arrived, so the state is what arrives
    in that time; a replay later than that passes (bronze folds it to the same state, and
    :func:`repeated_ranges` finds it).  The clock is the time of arrival: by the records' own
    timestamps an old record that comes for the first time would count as late and vanish.
    A batch is compared as a whole.
    """
    if not records.isStreaming:
        return records.dropDuplicates(list(KEY))
    return (records.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", keep_for)
            .dropDuplicatesWithinWatermark(list(KEY)).drop("_arrived"))


def offset_counts(records: DataFrame) -> DataFrame:
    """(topic, partition, offset, n): how often each offset is there."""
    return records.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))


def _islands(df: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Intervals of each group ``by`` that overlap or touch made one; ``sums`` are added up."""
    along = Window.partitionBy(*by).orderBy("first", "last")
    before = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_new", F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0))
    df = df.withColumn("_id", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return df.groupBy(*by, "_id").agg(F.min("first").alias("first"), F.max("last").alias("last"),
                                      *[F.sum(c).alias(c) for c in sums]).drop("_id")


def _slice(c: str | Column, width: int) -> Column:
    return F.floor((F.col(c) if isinstance(c, str) else c) / width).cast("bigint")


def _pieces(intervals: DataFrame, by: Sequence[str], width: int, sums: Sequence[str] = ()) -> DataFrame:
    """The intervals cut at the slices' borders and merged within each slice (column ``_slice``)."""
    cut = intervals.withColumn("_slice", F.explode(F.sequence(_slice("first", width), _slice("last", width))))
    cut = cut.withColumns({"first": F.greatest("first", F.col("_slice") * width), "last": F.least("last", F.col("_slice") * width + (width - 1))})
    return _islands(cut, [*by, "_slice"], sums)


def merge_intervals(intervals: DataFrame, by: Sequence[str] = PARTITION, width: int = SLICE, sums: Sequence[str] = ()) -> DataFrame:
    """Interval sets (by, first, last) of any number of sources as one: maximal intervals.

    ``sums`` are additive columns of intervals within one slice, such as counts of single offsets.
    """
    pieces = _pieces(intervals, by, width, sums)
    edge = (F.col("first") % width == 0) | ((F.col("last") + 1) % width == 0)
    cols = [*by, "first", "last", *sums]
    inner = pieces.filter(~edge).select(*cols)
    return inner.unionByName(_islands(pieces.filter(edge).select(*cols), list(by), sums).select(*cols))


def covered_ranges(records: DataFrame, width: int = SLICE) -> DataFrame:
    """(topic, partition, first, last): the offsets that are there, as maximal intervals."""
    seen = offset_counts(records).select(*PARTITION, F.col("offset").alias("first"), F.col("offset").alias("last"))
    return merge_intervals(seen, PARTITION, width)


def repeated_ranges(records: DataFrame, width: int = SLICE) -> DataFrame:
    """(topic, partition, first, last, n_copies): ranges of offsets that are there more than once, and the copies beyond one."""
    twice = offset_counts(records).filter("n > 1").select(
        *PARTITION, F.col("offset").alias("first"), F.col("offset").alias("last"), (F.col("n") - 1).alias("n_copies"))
    return merge_intervals(twice, PARTITION, width, ["n_copies"])


def missing_ranges(intervals: DataFrame, by: Sequence[str] = PARTITION, width: int = SLICE, bounds: DataFrame | None = None) -> DataFrame:
    """(by, first, last): what lies between the intervals of a group.

    ``bounds`` (by, low, high) names the first offset that should be there and the one after the
    last, as a broker reports them; then what lacks at both ends is missing too, also of a group
    without any interval, and what lies outside the bounds (expired meanwhile, or newer than the
    report) does not count.
    """
    if bounds is not None:
        kept = intervals.join(bounds.select(*by, "low", "high"), list(by)).filter("last >= low and first < high")
        intervals = kept.select(*by, F.greatest("first", "low").alias("first"), F.least(F.col("last"), F.col("high") - 1).alias("last"))
        for end in (F.col("low") - 1, F.col("high")):
            intervals = intervals.unionByName(bounds.select(*by, end.alias("first"), end.alias("last")))
    pieces = _pieces(intervals, by, width)
    within = Window.partitionBy(*by, "_slice").orderBy("first")
    gaps = pieces.withColumn("_next", F.lead("first").over(within)).select(*by, "last", "_next")
    # one row for each slice that holds something
    ends = pieces.groupBy(*by, "_slice").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    across = ends.withColumn("_next", F.lead("first").over(Window.partitionBy(*by).orderBy("_slice"))).select(*by, "last", "_next")
    return gaps.unionByName(across).filter(F.col("_next") > F.col("last") + 1).select(
        *by, (F.col("last") + 1).alias("first"), (F.col("_next") - 1).alias("last"))


def offset_gaps(records: DataFrame, bounds: DataFrame | None = None, width: int = SLICE) -> DataFrame:
    """(topic, partition, kind, first_offset, last_offset, n_records): missing and repeated ranges."""
    seen = offset_counts(records).select(*PARTITION, F.col("offset").alias("first"), F.col("offset").alias("last"))
    missing = missing_ranges(seen, PARTITION, width, bounds)
    rows = missing.select(*PARTITION, F.lit("missing").alias("kind"), "first", "last", (F.col("last") - F.col("first") + 1).alias("n_records"))
    rows = rows.unionByName(repeated_ranges(records, width).select(*PARTITION, F.lit("repeated").alias("kind"), "first", "last",
                                                                   F.col("n_copies").alias("n_records")))
    return rows.withColumnsRenamed({"first": "first_offset", "last": "last_offset"})


def account(records: DataFrame, outcomes: Mapping[str, DataFrame]) -> DataFrame:
    """Per topic, records and outcomes, and by offset what they do not agree on.

    Columns: topic, n_records (replays included), n_<outcome>..., n_lost (offsets without an outcome),
    n_repeated (outcomes beyond one of an offset), n_stray (offsets that have outcomes but no record).
    """
    frames = {"records": records, **outcomes}
    rows = None
    for name, df in frames.items():
        part = df.select(*KEY, *[F.lit(int(name == other)).cast("bigint").alias(other) for other in frames])
        rows = part if rows is None else rows.unionByName(part)
    per = rows.groupBy(*KEY).agg(*[F.sum(name).alias(name) for name in frames])
    done = sum((F.col(name) for name in outcomes), F.lit(0).cast("bigint"))
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return per.groupBy("topic").agg(
        *[F.sum(name).alias(f"n_{name}") for name in frames],
        count((F.col("records") > 0) & (done == 0)).alias("n_lost"),
        F.sum(F.greatest(done - 1, F.lit(0))).alias("n_repeated"),
        count((F.col("records") == 0) & (done > 0)).alias("n_stray"))
