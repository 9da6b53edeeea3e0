"""Connected components of an edge table by alternating stars, on Spark.

Large and small stars hang every node's neighbours on its smallest neighbour
until all edges point at the smallest node of their component.  Every round is
an aggregation and a join on the node, staged in the shared folder; the
aggregated side has one row a node, so a hot node can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisor.llm.common import staged
from revisor.session import release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u")
    if large:
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.filter("v <= u").select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
    return out.filter("u != v").distinct()


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """``edges(u, v)`` to staged (``node``, ``component``): the smallest node reachable, for nodes that have an edge."""
    spark = edges.sparkSession
    now, path = staged(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                       "edges")
    # done when no edge hangs on a node that hangs on another one, and each node hangs on one
    while _unsettled(now):
        after, path_after = staged(_star(_star(now, large=True), large=False), "edges")
        release(spark, path)
        now, path = after, path_after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")), path


def _unsettled(edges: DataFrame) -> bool:
    roles = edges.select(F.col("u").alias("node"), "v", F.lit(False).alias("end")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("v"), F.lit(True).alias("end")))
    by_node = roles.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max("end").alias("end"))
    return not by_node.filter("low IS NOT NULL AND (low != high OR end)").isEmpty()
