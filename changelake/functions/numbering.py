"""Row numbers within a group without gathering the group in one task.

``row_number().over(partitionBy(g).orderBy(o))`` sends every row of a group to one
task. When one group may hold a large share of all rows, this helper numbers rows in
three steps that keep the work spread out:

1. range-partition by (group, order) so each task holds a contiguous slice of the
   global order (a hot group spans several tasks);
2. number rows inside each (group, task slice) with a window over that slice only;
3. add the number of rows of the same group in earlier slices, computed from a small
   per-slice count table (one row per group and slice).

The sliced rows are written to the shared checkpoint folder between steps 1 and 2:
slice ids come from sampled range bounds, so they must be fixed once for both uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.session import materialize


def row_number_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], out: str = "rn",
                        num_slices: int | None = None) -> DataFrame:
    """``out`` = 1-based position of each row within its group, in ``order``.

    ``order`` must make rows unique within a group (as ``row_number`` needs for a
    deterministic answer). ``num_slices`` defaults to the session's shuffle partitions.
    """
    spark = df.sparkSession
    n = num_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    sliced = (df.repartitionByRange(n, *[F.col(g) for g in group], *order_cols)
              .withColumn("_slice", F.spark_partition_id()))
    # Slice ids depend on sampled range bounds and on shuffle read order, so the slices are
    # written once (shared checkpoint folder) and both branches below read the same rows.
    sliced = materialize(sliced, "numbering-slices")
    # dealt by a fixed number: sorted rows compress so well that AQE would sort many slices in one task
    local = sliced.repartition(n, *group, "_slice").withColumn(
        "_local", F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order_cols)))
    counts = sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_slice")
                              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("_offset", F.coalesce(before, F.lit(0))).drop("_n")
    return (local.join(offsets, [*group, "_slice"], "inner")
            .withColumn(out, (F.col("_local") + F.col("_offset")).cast("int"))
            .drop("_local", "_offset", "_slice"))
