"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share a token budget by weight, none beyond ``max_epochs`` times its
size.  A target of e full sizes and a rest takes every document e times, then a
weighted sample without replacement for the rest: each document draws the key
-ln(u) / quality, u uniform by a seeded hash of its id, and documents are taken
in key order until the prefix sum of their sizes reaches the rest.  A document
across the border is taken if its middle is inside.

Keys are sorted and summed over ranges that Spark cuts by sampling, so the
prefix sum of a source with most of the rows runs in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.llm.common import WHITE, in_order, running, uniform, word_count

# Weights of the sources in name order, repeating; budget as a
# share of all sizes; epochs a source may run through.
WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = 5


def quality(text: str | Column = "text") -> Column:
    """A weight from 0.1 to 1: how many of the words begin with a letter."""
    text = F.col(text) if isinstance(text, str) else text
    lettered = F.regexp_count(text, F.lit(rf"(?:^|[{WHITE}])\p{{L}}"))
    share = lettered.cast("double") / F.greatest(word_count(text), F.lit(1)).cast("double")
    return F.lit(0.1) + F.lit(0.9) * F.least(F.coalesce(share, F.lit(0.0)), F.lit(1.0))


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    The budget is shared by weight; what exceeds ``max_epochs`` sizes is shared
    again among the others until no target is above.  That fixed point is read
    off one sort by (most a source may take) / weight: the capped sources are
    the first ones.  One task sees one row per source of the mixture.
    """
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.select("source", "source_size").withColumn("weight", weight)
    rows = rows.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    money = F.lit(budget) * F.sum("source_size").over(every).cast("double")
    level = (money - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    rows = rows.withColumn("money", money).withColumn("capped", F.col("ratio") < level)
    spent = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(every)
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(every)
    rows = rows.withColumn("level", F.try_divide(F.col("money") - spent, open_weight))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("level") * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    rows: DataFrame,
    shares: DataFrame | None = None,
    seed: int = SEED,
    identity: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``copies``, how often the mix takes each.

    ``rows`` needs ``source``, ``size`` and ``quality`` (positive); ``shares``
    is (source, source_size, target), by default ``targets``.  A null source is
    a source like any other.  Rows equal in all of ``identity``, ``size`` and
    ``quality`` are interchangeable but counted one by one.  Rows of size 0 add
    nothing to a sum.  An empty table gives an empty one.  Further columns pass
    through; keep them narrow, as rows are sorted.
    """
    names = rows.columns
    ids = [f"id{i}" for i in range(len(identity))]
    held = rows.select(
        F.struct(*names).alias("row"),
        F.col("source").alias("stratum"),
        F.col("size").alias("amount"),
        F.col("quality").alias("worth"),
        *[F.col(c).alias(i) for c, i in zip(identity, ids)],
    )
    keyed = held.withColumn("draw", -F.log(uniform(*ids, seed=seed)) / F.col("worth"))
    order = ["draw", *ids, "amount", "worth"]
    cells = in_order(keyed, ["stratum"], order)
    if shares is None:
        sizes = cells.groupBy(F.col("stratum").alias("source")).agg(F.sum("amount").alias("source_size"))
        shares = targets(sizes)
    shares = shares.select(F.col("source").alias("__source"), "source_size", "target")
    taken = running(cells, ["stratum"], order, "amount").join(shares, F.col("stratum").eqNullSafe(F.col("__source")))
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0)).cast("bigint")
    rest = F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double")
    inside = (F.col("before") + F.col("amount") / 2.0 <= rest) & (rest > 0)
    return (
        taken.withColumn("epochs", epochs)
        .withColumn("copies", F.col("epochs") + inside.cast("bigint"))
        .select("row.*", "source_size", "target", "copies")
    )
