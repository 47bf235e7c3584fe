from collections import Counter

import corpus_pipeline
from mdlake.llm import langid, mixing
from mdlake.llm.common import word_count
from pyspark.sql import functions as F

from test_decontam import slow as slow_hits
from test_simhash import slow_classes, slow_print

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_names_and_columns(spark, sf_dir, documents):
    assert len(corpus_pipeline.STAGES) == 5
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == DOCUMENTS


def test_run_against_brute_force(spark, sf_dir, documents):
    """All stages but the shuffle by definition; the mixture from the operator's own counts."""
    given = {r.doc_id: r for r in documents.collect()}
    judged = langid.identify(documents, langid.train(documents), ["doc_id"]).collect()
    kept = [r.doc_id for r in judged if r.lang_pred != "und" and r.bits_per_byte < 8]
    classes = slow_classes({d: slow_print(given[d].text) for d in kept})
    kept = [d for d in kept if classes[d] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = [d for d, _, n, _ in slow_hits([(d, given[d].text) for d in kept], items) if n == 0]
    rest = documents.filter(F.col("doc_id").isin(kept)).withColumn("text_hash", F.xxhash64("text"))
    rows = rest.select("doc_id", "text_hash", "source", word_count("text").alias("size"), mixing.quality("text").alias("quality"))
    copies = {r.doc_id: r.copies for r in mixing.mix(rows, identity=("doc_id", "text_hash")).collect() if r.copies}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in got) == copies
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_odd_rows_in_every_stage(spark, sf_dir, odd, none):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, sf_dir).collect()
        assert stage(spark, none, sf_dir).count() == 0


def test_one_of_each_class_stays(spark, sf_dir, odd):
    left = corpus_pipeline.near_duplicates(spark, odd, sf_dir).collect()
    ids = Counter(r.doc_id for r in left)
    assert ids[None] == 1 and ids[6] == 1 and 7 not in ids and 2 not in ids and ids[3] == 1 and 4 not in ids


def test_benchmark_rows_without_id_go(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("length(text) > 100").first().text
    rows = [(None, item, "en", "a", 1), (None, "clean words", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    assert [r.text for r in corpus_pipeline.decontaminate(spark, docs, sf_dir).collect()] == ["clean words"]


def test_columns_of_its_own_pass_through(spark, sf_dir):
    """Extra columns named like the stages' helpers keep their values."""
    extra = ["key", "text_hash", "fp", "document", "size", "quality", "n_hit", "class_fp", "hit_id"]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, " + ", ".join(f"{c} STRING" for c in extra)
    rows = [(i, f"the quick brown fox {i} jumps over {i * i} lazy dogs", "en", "a", 10, *[f"{c}{i}" for c in extra]) for i in range(20)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        got = docs.collect()
        assert got and docs.columns == [f.split()[0] for f in schema.split(", ")]
        assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in extra)
