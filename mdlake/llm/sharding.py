"""Shards that all have the mixture of the whole: proportional interleaving.

Rows are shuffled by a seeded hash and ranked within their source; the
fractional rank (rank - 1/2) / (rows of the source) spreads every source evenly
over (0, 1).  Sorted by it, all sources run through in proportion, and equal
cuts give shards whose row counts differ by one at most and whose share of each
source differs by one row or so.

Both ranks are prefix sums over ranges that Spark cuts by sampling; a source
with most of the rows is ranked by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import in_order, running, uniform

SHARDS = 8
SEED = 4


def interleave(
    rows: DataFrame, shards: int = SHARDS, seed: int = SEED, source: str | Column = "source", identity: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``rows`` with ``position``, ``shard`` (0 to ``shards`` - 1) and ``slot``.

    ``identity`` names the columns that tell rows apart; they seed the shuffle
    and break ties.  Rows equal in all of them are interchangeable, and each
    still gets a slot of its own.  A null source is a source like any other.
    An empty table gives an empty one, and fewer rows than shards leave shards
    empty.  Further columns pass through; keep them narrow, as rows are sorted.
    """
    source = F.col(source) if isinstance(source, str) else source
    names = rows.columns
    held = rows.select(F.struct(*names).alias("row"), source.alias("stratum"), *[F.col(c).alias(f"id{i}") for i, c in enumerate(identity)])
    ids = [f"id{i}" for i in range(len(identity))]
    keyed = held.withColumn("shuffled", uniform(*ids, seed=seed)).withColumn("one", F.lit(1).cast("bigint"))
    order = ["shuffled", *ids]
    ranked = running(in_order(keyed, ["stratum"], order), ["stratum"], order, "one").drop("cell")
    counts = keyed.groupBy(F.col("stratum").alias("__stratum")).agg(F.count(F.lit(1)).alias("n"))
    fraction = (F.lit(2) * F.col("before") + F.lit(1)).cast("double") / (F.lit(2) * F.col("n")).cast("double")
    mixed = (
        ranked.join(counts, F.col("stratum").eqNullSafe(F.col("__stratum")))
        .withColumn("fraction", fraction)
        .drop("before", "n", "__stratum")
    )
    order = ["fraction", "stratum", *order]
    cells = in_order(mixed, [], order)
    total = F.lit(cells.count()).cast("bigint")
    placed = running(cells, [], order, "one").withColumnRenamed("before", "position")
    placed = placed.withColumn("total", total).withColumn("shard", F.expr(f"CAST(position * {shards} DIV total AS INT)"))
    first = F.expr(f"(shard * total + {shards - 1}) DIV {shards}")
    return placed.withColumn("slot", F.col("position") - first).select("row.*", "position", "shard", "slot")
