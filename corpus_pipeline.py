"""The corpus pipeline: five stages over ``documents``, each stored before the next.

A stage is a function (spark, docs, sf_dir) -> DataFrame that applies one
operator of ``mdlake.llm``.  All but the last return the columns of
``documents``; the last returns the shard and slot of every row of the mixture.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.llm import decontam, langid, mixing, sharding, simhash
from mdlake.llm.common import attach, shared_folder, table, word_count

# A text that even its best language cannot code below its raw size is in none of them.
RAW_BITS = 8.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what is in no known language: texts without letters, and texts whose
    code under the best language is longer than the text itself."""
    model = langid.train(docs)
    judged = langid.identify(_packed(docs), model, ["document"])
    kept = judged.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("bits_per_byte") < RAW_BITS))
    return kept.select("document.*")


KEY = ["doc_id", "text_hash"]


def _packed(docs: DataFrame) -> DataFrame:
    """The whole row in one column, so that columns of its own cannot clash with
    a stage's, beside what tells rows apart (ids may be null or repeated)."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
        "doc_id", F.xxhash64("text").alias("text_hash"), "source", "text",
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of SimHash near-duplicates, the one with the smallest id.

    Shingles of three words and a radius of three bits, as the operator's contract has them.
    A null id counts as the largest; of rows that share the id, one text stays.
    """
    packed = _packed(docs)
    found = simhash.near_duplicates(packed, keep=["text_hash"])
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    first = found.groupBy("class_fp").agg(F.min(order).alias("first")).select("first.doc_id", "first.text_hash")
    return attach(packed.select("document", *KEY), first, KEY).select("document.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of the benchmark."""
    packed = _packed(docs)
    keyed = packed.select(F.struct(*KEY).alias("key"), "text")
    found = decontam.contamination(keyed, table(spark, sf_dir, "benchmark"), doc_id="key")
    hit = found.filter(F.col("n_hit") > 0).select(F.col("doc_id.doc_id").alias("hit_id"), F.col("doc_id.text_hash").alias("hit_hash"))
    same = packed["doc_id"].eqNullSafe(F.col("hit_id")) & (packed["text_hash"] == F.col("hit_hash"))
    return packed.join(hit.distinct(), same, "left_anti").select("document.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources meet their targets.

    Rows that agree in id and text are counted one by one and come back together.
    """
    packed = _packed(docs)
    rows = packed.select(*KEY, "source", word_count("text").alias("size"), mixing.quality("text").alias("quality"))
    mixed = mixing.mix(rows, identity=tuple(KEY))
    copies = mixed.groupBy(*KEY, "source").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    repeated = copies.select(*KEY, "source", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
    return attach(packed.drop("text"), repeated.drop("copy"), [*KEY, "source"]).select("document.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every row of the mixture in one of eight shards; repeated rows get a slot each."""
    rows = _packed(docs).select(*KEY, "source")
    return sharding.interleave(rows, identity=tuple(KEY))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

# Language models and SimHash have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table that the next one reads.

    A stage's table goes once the next one stands.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            _remove(spark, f"{folder}/{number - 1}")
    return docs
