"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the white space that separates words.
WHITE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only a local session may leave it unset, as in tests, and gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="mdlake-llm-")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table of the shared folder: read again by column."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Words between white space; none in a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WHITE}]+")), F.lit(0)).cast("bigint")


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def uniform(*parts: str | Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the parts and the seed alone."""
    words = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *words))
    # 13 hexadecimal digits are 52 bits, which a double holds exactly.
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def in_order(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows dealt by ranges of (group, order), stored, with their range as ``cell``.

    Spark samples the order to cut ranges of like size, so a hot group spreads
    over as many tasks as its rows ask for.  ``cell`` rises with the order.
    """
    dealt = rows.repartitionByRange(*group, *order)
    return stored(dealt.withColumn("cell", F.spark_partition_id()))


def running(cells: DataFrame, group: list[str], order: list[str], amount: str) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over the rows that precede in the group.

    Each range is summed by itself; its start is the sum of the ranges before,
    one row per group and range.
    """
    here = Window.partitionBy("cell", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = cells.groupBy(*group, "cell").agg(F.sum(amount).alias("in_cell"))
    earlier = (
        Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        if group
        else Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = totals.select(*group, "cell", F.coalesce(F.sum("in_cell").over(earlier), F.lit(0)).alias("start"))
    for name in group:  # a null group meets itself
        starts = starts.withColumnRenamed(name, f"__{name}")
    same = F.col("cell") == F.col("__cell")
    for name in group:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    own = cells.withColumn("before", F.coalesce(F.sum(amount).over(here), F.lit(0)))
    joined = own.join(starts.withColumnRenamed("cell", "__cell"), same)
    return joined.withColumn("before", F.col("before") + F.col("start")).drop("start", "__cell", *[f"__{g}" for g in group])


def attach(docs: DataFrame, decided: DataFrame, key: list[str]) -> DataFrame:
    """``decided`` with the remaining columns of ``docs``, met on the ``key``.

    Rows of ``docs`` that agree in the key stand for each other.
    """
    once = docs.dropDuplicates(key)
    renamed = decided.select(*[F.col(c).alias(f"__{c}") if c in key else F.col(c) for c in decided.columns])
    same = F.lit(True)
    for name in key:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    return renamed.join(once, same).drop(*[f"__{c}" for c in key])


# --- inside tasks -------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its offsets; a null text is empty."""
    column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    return (np.frombuffer(body, dtype=np.uint8) if body else np.empty(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, size: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (row, begin, end) that hold about ``size`` bytes each.

    A text longer than that is cut; every row appears, empty ones too.
    """
    out: list[tuple[int, int, int]] = []
    held = 0
    for row, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while True:
            cut = min(end, begin + size)
            out.append((row, begin, cut))
            held += cut - begin
            if held >= size:
                yield out
                out, held = [], 0
            if cut == end:
                break
            begin = cut
    if out:
        yield out
