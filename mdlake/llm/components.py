"""Connected components of an edge table, by large-star and small-star rounds.

Each round replaces a node's edges by edges to the smallest node it knows.  A
node's neighbours are only ever reduced to their minimum and joined, never
gathered, so a node with millions of them is as good as any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """Link every node's larger neighbours, then the smaller ones, to the smallest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (
        both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()
    smallest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(smallest, "u")
    moved = small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest reachable.

    ``edges`` has two columns of one orderable type.  Null ends and loops are
    left out; an empty table gives an empty one.
    """
    first, second = edges.columns
    now = stored(
        edges.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
        .filter(F.col("u") > F.col("v"))
        .distinct()
    )
    state = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")))
    before = now.agg(state).first()[0]
    while True:
        now = stored(_star(now))
        after = now.agg(state).first()[0]
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
