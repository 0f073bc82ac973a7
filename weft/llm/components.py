"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an undirected edge table.

    ``component`` is the smallest node id reachable.  Each round links every
    node's larger neighbours to its smallest one, then its smaller ones, until
    the edges form stars: about log(n) rounds, each a min-aggregate (combined
    before its shuffle) and a join that AQE splits on hot nodes.  Every round is
    written to the shared folder.  Self-links are ignored; an empty table gives
    an empty result; null ends are dropped.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = materialise(e, "edges")
    state = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").where(F.col("u") != F.col("v")).distinct())
        e = materialise(small, "edges")
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
