"""Connected components of a link table by alternating large-star and small-star rounds.

Links stay in Spark tables; nothing but a round's count and checksum reaches the driver. Every round
is written to the shared folder, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centroidal.llm.frames import dropped, written

MAX_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (two columns of longs): the root is the least node that
    links reach. Links to itself and repeated links do no harm; an empty table gives none."""
    spark = links.sparkSession
    x, y = F.col(a), F.col(b)
    nodes = links.select(F.explode(F.array(x, y)).alias("node")).distinct()
    edges = written(spark, links.filter(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct(), "links")
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")) \
            .union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.col("m").alias("lo")) \
            .filter("hi <> lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(
            F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")) \
            .select("e.hi", "e.lo").filter("hi <> lo").distinct()
        before, edges = edges, written(spark, small, "links")
        dropped(before)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.withColumnRenamed("hi", "of")
    return nodes.join(roots, F.col("node") == F.col("of"), "left").select("node", F.coalesce("lo", "node").alias("root"))
