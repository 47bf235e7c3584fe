from collections import Counter

import pytest
from pyspark.sql import functions as F

from mdlake.llm import mixing, sharding
from mdlake.llm.common import word_count
from mdlake.llm.queries import QUERIES


def test_shards_are_even_in_rows_and_sources(spark, sf_dir, documents):
    source = {r.doc_id: r.source for r in documents.collect()}
    rows = QUERIES["op4_sharding"](spark, sf_dir).collect()
    assert len(rows) == len(source)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))
    for name in set(source.values()):
        each = Counter(r.shard for r in rows if source[r.doc_id] == name)
        assert max(each.get(s, 0) for s in range(8)) - min(each.get(s, 0) for s in range(8)) <= 2


def slow_interleave(rows, shards, seed):
    """The definition, from the seeded hash that the operator sorts by."""
    n = Counter(r["source"] for r in rows)
    ranked, seen = [], Counter()
    for r in sorted(rows, key=lambda r: (r["u"], r["doc_id"])):
        ranked.append(((2 * seen[r["source"]] + 1) / (2 * n[r["source"]]), r["source"], r["u"], r["doc_id"]))
        seen[r["source"]] += 1
    ranked.sort()
    return {r[3]: (i, i * shards // len(ranked)) for i, r in enumerate(ranked)}


def test_interleaving_by_definition(spark, documents):
    from mdlake.llm.common import uniform

    rows = documents.select("doc_id", "source")
    keyed = [r.asDict() for r in rows.withColumn("u", uniform("doc_id", seed=9)).collect()]
    want = slow_interleave(keyed, 5, 9)
    got = {r.doc_id: (r.position, r.shard) for r in sharding.interleave(rows, shards=5, seed=9).collect()}
    assert got == want


def test_sharding_of_odd_rows(odd, odd_rows, none):
    rows = odd.select("doc_id", "source", "row", "score", F.xxhash64("text").alias("h"))
    got = sharding.interleave(rows, identity=("doc_id", "h")).collect()
    assert sorted(r.position for r in got) == list(range(len(odd_rows)))
    assert {"row", "score"} <= set(got[0].asDict())
    assert sharding.interleave(none.select("doc_id", "source")).count() == 0


def test_targets_are_capped_and_shared_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 990), ("c", 0)], "source STRING, source_size BIGINT")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 20 and got["c"] == 0  # capped at twice their size
    rest = 3000 - 20
    # b weighs 2, the null source (last of four) weighs 5 again; its share is above its cap.
    assert got[None] == 1980 and got["b"] == pytest.approx(rest - 1980)


def test_mix_meets_targets(spark, sf_dir, documents):
    source = {r.doc_id: r.source for r in documents.collect()}
    rows = QUERIES["op5_mixing"](spark, sf_dir).collect()
    largest = Counter()
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        name = source[r.doc_id]
        taken[name] += r.taken
        target[name] = r.target
        largest[name] = max(largest[name], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in target)


def test_better_documents_are_taken_first(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.lit("a").alias("source"),
        F.lit(1).cast("bigint").alias("size"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.1).alias("quality"),
    )
    shares = spark.createDataFrame([("a", 4000, 1000.0)], "source STRING, source_size BIGINT, target DOUBLE")
    got = mixing.mix(rows, shares).filter("copies = 1").collect()
    assert len(got) == 1000
    assert sum(r.quality == 1.0 for r in got) > 850


def test_mix_of_odd_rows(odd, odd_rows, none):
    rows = odd.select("doc_id", "source", "fp", word_count("text").alias("size"), mixing.quality("text").alias("quality"))
    got = mixing.mix(rows).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.copies <= 2 for r in got)
    again = mixing.mix(rows.repartition(5)).collect()
    key = lambda r: str((r.doc_id, r.source, r.size, r.copies))
    assert sorted(map(key, got)) == sorted(map(key, again))
    nothing = none.select("doc_id", "source", F.lit(1).cast("bigint").alias("size"), F.lit(1.0).alias("quality"))
    assert mixing.mix(nothing).count() == 0
