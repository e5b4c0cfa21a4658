"""Connected components of an edge table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.work import keep


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the component's smallest
    node. Each round is two aggregations and two joins on the edge table, which
    only shrinks towards one edge per node; rounds are logarithmic in the
    longest path. Null ends and loops are left out."""
    def ordered(x, y):
        return [F.greatest(x, y).alias("u"), F.least(x, y).alias("v")]

    e = keep(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .select(*ordered(F.col(a), F.col(b))).distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        e = keep(small.select(*ordered(F.col("u"), F.col("v"))).distinct(), "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
