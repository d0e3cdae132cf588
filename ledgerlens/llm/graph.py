"""Connected components of an edge table of any size, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of an edge can reach.

    Alternates two steps until nothing changes: every node's larger neighbours are hung on its smallest neighbour,
    then its smaller ones (itself included) likewise. Stars of any size cost an aggregate, not a list; each round is
    written to the shared folder, so lost executors cost one round at most. Null ends and loops are ignored.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = written(pairs, "edges")
    last = None
    while True:
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
        pairs = written(small.where("u > v").distinct(), "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
