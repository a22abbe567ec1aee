"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node (the greater ones, or the smaller ones and itself) to the least of all."""
    out = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = out.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = out.join(least, "a")
    if large:
        moved = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    moved = moved.where("a > b")
    return moved if large else moved.distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``links`` (columns ``a, b``): the least node it is linked to, however far.

    Rounds go through written tables and end when one changes nothing; their number grows with the logarithm of the
    longest way, squared at worst.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = Staged(pairs, "links")
    state = None
    while True:
        now = edges.df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        larger = Staged(_star(edges.df, large=True), "links")
        edges.drop()
        edges = Staged(_star(larger.df, large=False), "links")
        larger.drop()
    stars = edges.df
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
