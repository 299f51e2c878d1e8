"""Distributed connected components by alternating large-star and small-star rounds.

After Kiveris, Lattanzi, Mirrokni, Rastogi and Vassilvitskii, "Connected Components in
MapReduce and Beyond" (2014). Neighbourhoods are never gathered: each round joins edges with
an aggregated minimum, so a node of any degree is a few partial aggregates and a splittable join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunframe.llm.common import remove, written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a``, ``b``, orderable, same type).

    ``root`` is the smallest node of the component. Null ends and loops link nothing; a node that
    only has loops does not appear. Repeated edges count once. An empty input gives no rows.
    """
    spark = edges.sparkSession
    now = written(_oriented(edges.select("a", "b")), "cc-edges")
    state = _state(now)
    while True:
        given = now
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        least = written(least, "cc-min")
        star = _oriented(both.join(least, both["a"] == least["k"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        star = written(star, "cc-large")
        low = written(star.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k"), "cc-low")
        moved = star.join(low, star["a"] == low["k"]).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(_oriented(moved.unionByName(low.select(F.col("k").alias("a"), F.col("m").alias("b")))), "cc-small")
        before, state = state, _state(now)
        for table in (given, least, star, low):  # of this round, all read for the last time
            remove(spark, table.inputFiles()[0].rsplit("/", 1)[0])
        if before == state:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Larger end first, no loops, each once."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    """Rows and an order-free digest: equal digests of two rounds mean a fixed point."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())
