"""Connected components of a table of edges, by stars.

Large stars link each node's larger neighbours to its smallest one, small
stars its smaller neighbours; repeated until the edges stay the same, each
node is linked to the smallest of its component.  Every round shuffles edges
by one end with partial minima; nothing but two numbers reaches the driver.
The minima are written before they are joined, so that both sides of the join
have a shuffle of their own and Spark can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.tables import removed, written


def _smallest(edges: DataFrame, made: list[DataFrame] | None) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "minima")
    if made is not None:
        made.append(least)
    return least


def _large_star(edges: DataFrame, made: list[DataFrame] | None = None) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both, made).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, made: list[DataFrame] | None = None) -> DataFrame:
    """Stars of smaller neighbours; `made` gets the tables written on the way."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_smallest(down, made), "u")
    links = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    return links.where("u != v")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v), two longs; label is
    the smallest node of the component.  Loops, repeats and either direction
    are allowed; an edge with a null end is none; no edges give no rows.
    What a round has written goes when the next one is there."""
    now = edges.select("u", "v").where("u != v").distinct()
    before = None
    while True:
        made = [now]
        now = written(_small_star(_large_star(now, made), made).distinct(), "stars")
        removed(*made)
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
