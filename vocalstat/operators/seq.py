"""Order-dependent building blocks without a single-task window.

``prefix_sum`` gives every row the running total of a value within its group
in a given order. Rows are range-partitioned on (group, order), each
(partition, group) chunk gets its offset from a table of chunk totals (about
partitions + groups rows), and the running sum inside a chunk is a window
over that chunk only. A hot group is spread over as many partitions as its
size needs. The range-partitioned rows are checkpointed so partition ids
stay the same between the two uses (and lineage is cut for executor loss).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from vocalstat.session import materialize


def prefix_sums(df: DataFrame, groups: Sequence[str], order: Sequence[str],
                sums: Sequence[tuple[str | None, str, bool]], partitions: int | None = None) -> DataFrame:
    """Several running sums in one range-partitioned pass.

    ``sums`` = [(value column or None for 1 per row, output name, inclusive), ...].
    ``order`` must be unique within a group for a deterministic result.
    """
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups, order = list(groups), list(order)
    ws = [f"_pw{i}" for i in range(len(sums))]
    for w, (value, _, _) in zip(ws, sums):
        df = df.withColumn(w, F.col(value).cast("long") if value else F.lit(1).cast("long"))
    ranged = materialize(df.repartitionByRange(p, *groups, *order)
                         .withColumn("_pid", F.spark_partition_id()), "ranged")
    chunks = ranged.groupBy("_pid", *groups).agg(*[F.sum(w).alias(f"_c{w}") for w in ws])
    by_group = Window.partitionBy(*groups).orderBy("_pid") if groups else Window.orderBy("_pid")
    before = by_group.rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("_pid", *groups, *[F.coalesce(F.sum(f"_c{w}").over(before), F.lit(0)).alias(f"_o{w}")
                                              for w in ws])
    j = ranged.join(chunks, ["_pid", *groups])
    within = Window.partitionBy("_pid", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for w, (_, out, inclusive) in zip(ws, sums):
        j = j.withColumn(out, F.col(f"_o{w}") + F.sum(w).over(within) - (F.lit(0) if inclusive else F.col(w)))
    return j.drop("_pid", *ws, *[f"_o{w}" for w in ws])


def prefix_sum(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str | None,
               out: str = "cum", inclusive: bool = True, partitions: int | None = None) -> DataFrame:
    """Running sum of ``value`` (1 per row when None) within ``groups`` ordered by ``order``.

    ``inclusive`` includes the row itself; otherwise the sum of strictly earlier rows.
    """
    return prefix_sums(df, groups, order, [(value, out, inclusive)], partitions)


def number_rows(df: DataFrame, order: Sequence[str], out: str, partitions: int | None = None) -> DataFrame:
    """Rows without the ``order`` columns, numbered densely from 0 in that order (unique for a deterministic result).

    The rows are moved and stored once: sorted within range partitions, a row's place is its
    ``monotonically_increasing_id``, and a table of one offset per partition makes it a number.
    """
    p = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(p, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    placed = materialize(placed.drop(*order), "numbered").withColumn("_pid", F.shiftright("_mid", 33))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    j = placed.join(F.broadcast(offsets), "_pid")
    return j.withColumn(out, F.col("_off") + F.col("_mid") - F.shiftleft("_pid", 33)).drop("_pid", "_mid", "_off")
