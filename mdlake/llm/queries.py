"""The operators applied to the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.llm import chat, decontam, langid, lexical, merkle, mixing, pii, sharding, simhash, toxicity, urls, vectors, winnow
from mdlake.llm.common import crc_of_id, table, word_count


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from labels of those not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.pmod(crc_of_id(), F.lit(5)) == 0)
    labels = table(spark, sf_dir, "labels").filter(F.pmod(crc_of_id(), F.lit(5)) != 0)
    model = toxicity.train(docs.filter(~F.col("held_out")), labels)
    scored = toxicity.toxicity(docs, model, ["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# Fixed value: a conversation whose texts hold the template's own marks.
MARKED = "\\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and read back from what was written."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)]
    marked = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return chat.read_back(chat.format_conversations(given.unionByName(marked)))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of the same mixture."""
    body = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    placed = sharding.interleave(rows, identity=("doc_id", "text_crc32", "size"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of all documents a mixture of their sources takes."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count("text").alias("size"), mixing.quality("text").alias("quality")
    )
    mixed = mixing.mix(rows)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages by rules and by their hosts."""
    judged = urls.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.find(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[pii.count_of(base, kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from those not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.pmod(crc_of_id(), F.lit(4)) == 2)
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.identify(docs, model, ["doc_id", "held_out"])


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of edited ones."""
    made = winnow.edited_fingerprints(table(spark, sf_dir, "documents"))
    return made.withColumn("fingerprint", winnow.digest("fingerprint")).withColumn(
        "edited_fingerprint", winnow.digest("edited_fingerprint")
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark stands in all documents."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every twentieth one, among all."""
    return vectors.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents in the manifest of the table, some of them tampered with."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.pmod(crc_of_id(), F.lit(7)) == 0
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    # One more character, as a decimal: the largest long has a successor too.
    changed = [(F.col(f).cast("decimal(20,0)") + 1) if f == "n_chars" else F.col(f) for f in fields]
    leaves = docs.select(
        "doc_id",
        "lang",
        merkle.leaf_digest(*fields).alias("leaf"),
        F.when(tampered & F.col("doc_id").isNotNull(), merkle.leaf_digest(*changed)).alias("changed"),
    )
    proven = merkle.prove(merkle.manifest(leaves))
    rows = proven.withColumn("folded_root", merkle.fold(F.coalesce("row.changed", "leaf")))
    return rows.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest().alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_chat": op3_chat,
    "op4_sharding": op4_sharding,
    "op5_mixing": op5_mixing,
    "op6_urls": op6_urls,
    "op7_pii": op7_pii,
    "op8_language": op8_language,
    "op9_fingerprints": op9_fingerprints,
    "op10_decontamination": op10_decontamination,
    "op11_lexical": op11_lexical,
    "op12_vectors": op12_vectors,
    "op13_merkle": op13_merkle,
}
