"""Ranks of rows in a stated order, without a task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchstats.llm.common import saved

_ROW_BITS = 33


def ranked(rows: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (), to: str = "rank") -> DataFrame:
    """``rows`` with ``to``, the place from 0 of each row of a group in the order.

    Rows are dealt by ranges of group and order, so a large group has many tasks; a row's place is its
    place in its task and what the group has in earlier ones.  The columns of ``group`` hold no NULL;
    rows that tie have places in any order.  ``_part`` and ``_row`` are no columns of ``rows``.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(parts, *group, *order).sortWithinPartitions(*group, *order)
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    stored = saved(dealt.select("*", F.spark_partition_id().alias("_part"), number.alias("_row")), "ranked")
    # one row for each task and, as groups are dealt in order, one more for each group
    runs = stored.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    more = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    runs = runs.select(*group, "_part", more.alias("_more"))
    placed = stored.join(runs, [*group, "_part"]).withColumn(to, F.col("_row") + F.col("_more"))
    return placed.drop("_part", "_row", "_more")
