from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mdlake.llm import vectors
from mdlake.llm.queries import QUERIES

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, list STRING, query STRING, score STRING"


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def slow(rows, asked, top=20):
    """{query: [(id, score)]} over all pairs."""
    return {
        q: sorted(((product(x, v), i) for i, v in rows if i != q), key=lambda h: (-h[0], h[1]))[:top]
        for q, x in rows
        if asked(q)
    }


def listed(found):
    out = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return dict(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "l", "q", "s") for i, v in rows], SCHEMA).repartition(4)


def randoms(n, dim, seed=1):
    return np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)


def test_query_recall_and_scores(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = listed(QUERIES["op12_vectors"](spark, sf_dir)), slow(rows, lambda i: i % 20 == 0)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    by_id = dict(rows)
    for q, hits in got.items():
        assert hits == sorted(hits, key=lambda h: (-h[0], h[1]))
        assert all(score == product(by_id[q], by_id[i]) for score, i in hits)
    found = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert found >= 0.9 * 20 * len(want)


def test_all_lists_probed_are_exact(spark):
    """With one list, only the tests stand between the scan and the whole answer; vectors of any length."""
    rows = [(i, (v * (1 + i % 3)).tolist()) for i, v in enumerate(randoms(900, 32))]
    got, want = listed(vectors.search(frame(spark, rows), F.col("vec_id") % 50 == 0, lists=1)), slow(rows, lambda i: i % 50 == 0)
    assert got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.99 * 20 * len(want)


def test_odd_vectors(spark):
    """Unusable vectors take no part, copies tie by id, fewer than ``top`` are all returned."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, v.tolist()) for i, v in enumerate(randoms(6, 4))]
    rows += [(20, rows[0][1]), (40, rows[0][1]), (-20, [float(2)] * 4), (7, rows[3][1]), (7, rows[3][1])]
    odd = [(60, None), (80, []), (100, [0.0] * 4), (120, [1.0, None, 1.0, 1.0]), (140, [nan, 1.0, 1.0, 1.0]), (160, [inf, 1.0, 1.0, 1.0])]
    odd += [(None, [1.0] * 4), (180, [1.0] * 5)]
    got = listed(vectors.search(frame(spark, rows + odd), F.col("vec_id") % 20 == 0))
    want = slow(list({i: (i, v) for i, v in rows}.values()), lambda i: i % 20 == 0)
    assert got == want and len(got[0]) == 9


def test_empty_and_single(spark):
    assert vectors.search(frame(spark, []), F.lit(True)).count() == 0
    assert vectors.search(frame(spark, [(0, None)]), F.lit(True)).count() == 0
    assert vectors.search(frame(spark, [(0, [1.0, 2.0])]), F.lit(True)).count() == 0


@pytest.mark.parametrize("chunk", [16, 4096])
def test_hot_vector_and_hot_list(spark, monkeypatch, chunk):
    """A third of all rows are one vector, and one list holds nearly all others."""
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    near = randoms(200, 8) * np.float32(0.01) + np.float32(1)
    rows = [(i, v.tolist()) for i, v in enumerate(near)] + [(1000 + i, near[0].tolist()) for i in range(150)]
    rows += [(5000 + i, v.tolist()) for i, v in enumerate(randoms(40, 8, 2))]
    asked = lambda i: i % 50 == 0
    got = listed(vectors.search(frame(spark, rows), F.col("vec_id") % 50 == 0, lists=4, recall=1.0))
    want = slow(rows, asked)
    assert got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.99 * 20 * len(want)


def test_tests_abandon_most_components():
    """Clustered vectors: far candidates are left early, near ones are kept."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 128))
    rows = centres[rng.integers(0, 20, 4000)] + 0.1 * rng.standard_normal((4000, 128))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    fitted = vectors.Lists(rows, 1, 20, 1.0)
    chunk = vectors.Chunk(rows, fitted.rotation)
    queries = rows[:50]
    query, at, score = chunk.best(queries, fitted.rotation, np.full(50, -np.inf), np.arange(4000), 21)
    want = np.argsort(-(queries @ rows.T), axis=1)[:, :21]
    assert sum(len(set(at[query == i]) & set(want[i])) for i in range(50)) >= 0.99 * 50 * 21
    assert chunk.tested < 0.5 * 50 * 4000 * 128
