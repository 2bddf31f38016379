"""Running totals over a total order, without a task or a row for any key.

A window over a key puts all rows of the key into one task. Here the rows are
dealt to partitions by ranges of (keys, order), so a hot key spans as many
partitions as its rows need. Totals are then summed twice: inside each
(partition, key), and over the earlier partitions of the key, of which there is
one row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.sources.handoff import Workspace


def running_totals(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, work: Workspace, partitions: int | None = None
) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the key's earlier rows in ``order``.

    ``(keys, order)`` must tell all rows apart and hold no NULL; ``value`` is an
    integer. Without ``keys`` the total runs over all rows. The dealt rows are
    written once as a stage of ``work``, so that the numbers of their partitions
    hold for both sums, whichever executor is lost later.
    """
    keys, order = list(keys), list(order)
    by = [F.col(c) for c in keys + order]
    dealt = rows.repartitionByRange(*by) if partitions is None else rows.repartitionByRange(partitions, *by)
    dealt = work.stage(dealt.withColumn("_part", F.spark_partition_id()), f"{name}-dealt")
    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    totals = dealt.groupBy("_part", *keys).agg(F.sum(value).alias("_total"))
    # One row for each (key, partition); without keys one row for each partition.
    before = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    totals = totals.withColumn("_before", F.sum("_total").over(before.orderBy("_part")) - F.col("_total")).drop("_total")
    summed = dealt.withColumn("_inside", F.sum(value).over(inside) - F.col(value))
    return summed.join(totals, ["_part", *keys]).withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")
