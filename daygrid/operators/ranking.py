"""Running totals in rank order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.durable import Scratch, freeze


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], totals: dict[str, str], scratch: Scratch | None = None
) -> DataFrame:
    """Cumulative sums per group in the given order, exact for groups of any size.

    One window over a whole group would put a large group into one task. So the
    rows are frozen, which computes the input once, and shuffled by range of
    (group, order) into parts that are stored with their number: a large group
    takes several parts, in its order. Each part of a group has one row of
    totals; the sum of those of the group's earlier parts enters the part's
    window as a row before its first one. Rows that tie in the whole order go
    by a hash of all their columns, so ties are cut as well; only rows that
    are equal throughout stay together. The frozen rows go with ``scratch``.
    """
    keep = scratch.freeze if scratch else freeze
    group = list(group)
    ranged = keep(df).withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(*group, *order, "_tie")
    parts = keep(ranged.withColumn("_part", F.spark_partition_id()))
    by_part = [*group, "_part"]
    # One row for each group and part.
    sums = parts.groupBy(*by_part).agg(*(F.sum(c).alias(f"_of_{n}") for n, c in totals.items()))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by_part, *(F.sum(f"_of_{n}").over(earlier).alias(f"_of_{n}") for n in totals))
    rows = parts.withColumns({f"_of_{n}": F.col(c) for n, c in totals.items()} | {"_row": F.lit(True)})
    both = rows.unionByName(starts, allowMissingColumns=True)
    so_far = Window.partitionBy(*by_part).orderBy(F.col("_row").asc_nulls_first(), *order, "_tie")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = both.withColumns({n: F.sum(f"_of_{n}").over(so_far) for n in totals}).filter("_row")
    return summed.select(*df.columns, *totals)
