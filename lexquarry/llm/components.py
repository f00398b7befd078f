"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.llm.common import discard, materialize


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (a, b: long) -> (node, component), component being the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., SoCC 2014): every round is two
    grouped minima and two joins, so a hub's neighbours are never gathered in one place, and each
    round's links are written to the shared folder. Nodes without a link to another node are left
    out. Nulls and loops are dropped, repeated links count once.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = materialize(links, name)
    before = None
    while True:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        last, links = links, materialize(small, name)
        discard(last)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
