"""Connected components of links, spread over the cluster.

Links are turned into stars by alternating two steps until nothing changes: every node points its
larger neighbours to the smallest node it knows (large star), then its smaller ones (small star).
Minima are combined before they are shuffled, so a node with very many links is no hot key of the
aggregation; what joins back to it is a join, which adaptive execution splits.  Each round is
written to the shared scratch folder, which cuts the lineage.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.llm.common import saved


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b"))).filter("a > b")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)`` that is not itself the smallest of its
    component; a node without a row is its own root.

    Self links, repeated links and links given both ways are allowed; rows with a NULL end are
    ignored; no links give no rows.
    """
    ends = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = saved(ends.distinct(), "links")
    before = _state(stars)
    while before[0]:
        stars = saved(_small_star(_large_star(stars)).distinct(), "links")
        after = _state(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def forest(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..size-1 linked left[i]-right[i], the smallest node each one reaches."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new
