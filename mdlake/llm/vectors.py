"""Approximate nearest neighbours by largest inner product: an inverted file of
lists, each probed list scanned dimension by dimension with early abandonment.

Fitting.  Centroids come from k-means on a bounded sample (``sample`` rows by a
hash of the vector, at most ``MAX_SAMPLE``).  How many lists a query probes is
calibrated on the same sample: the fewest that find the share ``recall`` of its
true neighbours there.  Every vector is put in the list of its nearest centroid.

Scanning.  A random orthogonal rotation spreads the length of a vector evenly
over its components, so the first d of D components give an unbiased estimate
D/d * partial of the squared distance between a query and a candidate.  An inner
product above t is a squared distance below |q|^2 + |x|^2 - 2t.  After every
column block a hypothesis test abandons the pairs whose estimate exceeds that
bound by more than the factor (1 + ``EPSILON`` / sqrt(d))^2; what is left after
the last block is scored exactly, in double precision on the original vectors,
component by component.  t is the query's k-th best score so far.

The nearest lists are probed first, enough to hold k candidates; their k-th best
score is where t starts in the other lists.

Equal vectors are one candidate with its smallest ids: ties go to smaller ids,
so only the k + 1 smallest of a group of copies can ever be among k neighbours.
A list over ``CHUNK`` vectors is dealt into chunks scanned by different tasks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 20
RECALL = 0.97  # of the calibration: the share of true neighbours in probed lists
MIN_SAMPLE, MAX_SAMPLE = 1 << 13, 1 << 16
MAX_LISTS = 1 << 12
ASKED = 256  # calibration queries
ROUNDS = 10  # of k-means
COLUMNS = 16  # components between two tests
EPSILON = 2.1
CHUNK = 1 << 12
QUERIES = 128  # scanned together
FIRST = 256  # candidates scored before the first threshold; later slices are longer
SEED = 12


# --- fitting ------------------------------------------------------------------------


class Lists:
    """Centroids, the rotation and how many lists to probe."""

    def __init__(self, sample: np.ndarray, lists: int, top: int, recall: float):
        rng = np.random.default_rng(SEED)
        self.dim = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0]
        self.centroids = sample[np.sort(rng.choice(len(sample), lists, replace=False))]
        for _ in range(ROUNDS):
            own = self.nearest(sample)
            counts = np.bincount(own, minlength=lists)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, own, sample)
            full = counts > 0
            self.centroids[full] = sums[full] / counts[full, None]
        self.probes = self._calibrate(sample, top, recall)

    def nearest(self, rows: np.ndarray) -> np.ndarray:
        half = (self.centroids**2).sum(axis=1) / 2
        return np.argmax(rows @ self.centroids.T - half, axis=1)

    def ranked(self, queries: np.ndarray) -> np.ndarray:
        """List numbers of each query, the most promising first."""
        return np.argsort(-(queries @ self.centroids.T), axis=1, kind="stable")

    def _calibrate(self, sample: np.ndarray, top: int, recall: float) -> int:
        own = self.nearest(sample)
        asked = np.arange(min(ASKED, len(sample)))
        scores = sample[asked] @ sample.T
        scores[asked, asked] = -np.inf
        k = min(top, len(sample) - 1)
        if k < 1:
            return len(self.centroids)
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        order = np.argsort(self.ranked(sample[asked]), axis=1)  # place of each list in the ranking
        found = np.bincount(np.take_along_axis(order, own[best], axis=1).ravel(), minlength=len(self.centroids))
        return int(np.searchsorted(np.cumsum(found), recall * found.sum())) + 1


# --- scanning -----------------------------------------------------------------------


class Chunk:
    """The candidates of one chunk of a list, rotated, in column blocks."""

    def __init__(self, rows: np.ndarray, rotation: np.ndarray):
        self.rows = rows
        turned = rows @ rotation
        cuts = range(0, rows.shape[1], COLUMNS)
        self.blocks = [np.ascontiguousarray(turned[:, c : c + COLUMNS]) for c in cuts]
        self.norms = [(b**2).sum(axis=1) for b in self.blocks]
        self.norm = sum(self.norms)
        self.tested = 0  # components compared, over all pairs

    def survivors(self, queries: list[np.ndarray], least: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, candidate from ``low`` to ``high``) that no test abandons."""
        dim = self.rows.shape[1]
        norms = [(q**2).sum(axis=1) for q in queries]
        bound = sum(norms)[:, None] + self.norm[low:high] - 2 * least[:, None]
        partial = np.zeros_like(bound)
        pairs: tuple[np.ndarray, np.ndarray] | None = None  # once few are left they are kept as a list
        seen = 0
        for q, own, block, norm in zip(queries, norms, self.blocks, self.norms):
            seen += block.shape[1]
            # The last test is exact but for rounding.
            slack = (1 + EPSILON / math.sqrt(seen)) ** 2 if seen < dim else 1 + 1e-9
            if pairs is None:
                self.tested += partial.size * block.shape[1]
                partial += own[:, None] + norm[low:high] - 2 * (q @ block[low:high].T)
                alive = partial * (dim / seen) <= np.maximum(bound, 0) * slack + 1e-9
                if seen == dim or np.count_nonzero(alive) * 4 < alive.size:
                    pairs = np.nonzero(alive)
                    partial, bound = partial[pairs], bound[pairs]
            else:
                a, b = pairs
                self.tested += len(a) * block.shape[1]
                partial = partial + own[a] + norm[low + b] - 2 * np.einsum("ij,ij->i", q[a], block[low + b])
                alive = partial * (dim / seen) <= np.maximum(bound, 0) * slack + 1e-9
                pairs, partial, bound = (a[alive], b[alive]), partial[alive], bound[alive]
        a, b = pairs
        return a, b + low

    def scores(self, queries: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products, summed in the order of the components."""
        total = np.zeros(len(a))
        for d in range(self.rows.shape[1]):
            total += queries[a, d] * self.rows[b, d]
        return total

    def best(self, queries: np.ndarray, rotation: np.ndarray, least: np.ndarray, first_id: np.ndarray, keep: int):
        """(query, candidate, score) of the ``keep`` best of each query that reach ``least``."""
        turned = queries @ rotation
        turned = [turned[:, c : c + COLUMNS] for c in range(0, turned.shape[1], COLUMNS)]
        least = least.copy()
        query, at, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        low, size = 0, FIRST
        while low < len(self.rows):
            high = min(low + size, len(self.rows))
            a, b = self.survivors(turned, least, low, high)
            exact = self.scores(queries, a, b)
            good = exact >= least[a]
            query, at, score = np.concatenate((query, a[good])), np.concatenate((at, b[good])), np.concatenate((score, exact[good]))
            order = np.lexsort((first_id[at], -score, query))
            query, at, score = query[order], at[order], score[order]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            query, at, score = query[rank < keep], at[rank < keep], score[rank < keep]
            last = np.flatnonzero(rank[rank < keep] == keep - 1)
            least[query[last]] = score[last]
            low, size = high, 4 * size
        return query, at, score


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _deal(lists: Lists):
    """The list of each vector."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = lists.nearest(_matrix(batch.column(1), lists.dim)) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=[*batch.schema.names, "list"])

    return deal


def _probe(lists: Lists, sizes: np.ndarray, top: int, first: bool):
    """A row for each query and each chunk of a list it probes.

    First come the nearest lists: an eighth of the probes, or as many as hold
    ``top`` vectors besides the query.  The second time come the rest.
    """
    chunks = -(-sizes // CHUNK)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ranked = lists.ranked(_matrix(batch.column(1), lists.dim))
            held = np.cumsum(sizes[ranked], axis=1)
            near = np.maximum(-(-lists.probes // 8), (held <= top).sum(axis=1) + 1)
            place = np.arange(ranked.shape[1])
            far = np.maximum(near, lists.probes)
            chosen = place < near[:, None] if first else (place >= near[:, None]) & (place < far[:, None])
            row, at = np.nonzero(chosen)
            number = ranked[row, at]
            times = chunks[number]
            chunk = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            rows = pa.array(np.repeat(row, times))
            columns = [c.take(rows) for c in batch.columns]
            columns += [pa.array(np.repeat(number, times).astype(np.int32)), pa.array(chunk.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "list", "chunk"])

    return probe


def _scan(lists: Lists, keep: int):
    """Of each chunk come its candidates, then the queries that probe it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, chunk, ids = None, [], None, []
        for batch in batches:
            number, part, kind = (batch.column(i).to_numpy() for i in range(3))
            change = (number[1:] != number[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if (number[a], part[a]) != group:
                    group, held, chunk, ids = (number[a], part[a]), [], None, []
                rows = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append(_matrix(rows.column(4), lists.dim))
                    ids.append(rows.column(5))
                    continue
                if chunk is None and held:
                    chunk = Chunk(np.concatenate(held), lists.rotation)
                    every = pa.chunked_array(ids).combine_chunks()
                    first_id = every.flatten().to_numpy()[np.concatenate(([0], np.cumsum(_lengths(every))[:-1]))]
                    held = []
                if chunk is None:
                    continue
                for low in range(0, b - a, QUERIES):
                    some = rows.slice(low, QUERIES)
                    queries, least = _matrix(some.column(4), lists.dim), some.column(6).to_numpy()
                    query, at, score = chunk.best(queries, lists.rotation, least, first_id, keep)
                    columns = [some.column(3).take(pa.array(query)), pa.array(score), every.take(pa.array(at))]
                    yield pa.RecordBatch.from_arrays(columns, names=["query", "score", "ids"])

    return scan


def _lengths(lists: pa.Array) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy())


# --- the search -----------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def search(
    vectors: DataFrame,
    asked: Column,
    top: int = TOP,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
    lists: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest found for each row of ``vectors`` that is ``asked``.

    ``asked`` is a condition on ``vectors``.  A query's own id is no candidate;
    equal scores go by ascending id.  Vectors that are null, zero or hold null
    or non-finite components, rows without an id, and vectors of another length
    than most take no part.  Rows equal in id and vector count once.  An empty
    table gives an empty one; other columns are unused.
    """
    spark = vectors.sparkSession
    kept = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), asked.alias("asked")
    )
    kept = kept.filter(_usable(F.col("vector")) & F.col("vec_id").isNotNull())
    lengths = kept.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    commonest = lengths.orderBy(F.desc("n"), "dim").first()
    if commonest is None:
        return spark.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE")
    held = dict(vectors.dtypes)[vector]  # vectors stay as narrow as they are given
    kept = kept.filter(F.size("vector") == commonest.dim).withColumn("vector", F.col("vector").cast(held))
    kept = kept.withColumn("hash", F.xxhash64("vector"))
    same = ["hash", "vector"]

    # Copies collapse before and after the shuffle: both sides keep the smallest ids only.
    order = Window.partitionBy(*same).orderBy("vec_id")
    first_ids = kept.select("vec_id", *same).withColumn("r", F.dense_rank().over(order)).filter(F.col("r") <= top + 1)
    ids = F.array_sort(F.collect_set("vec_id"))
    index = stored(first_ids.groupBy(*same).agg(ids.alias("ids")))
    n = index.count()
    lists = lists or max(1, min(MAX_LISTS, round(math.sqrt(n) / 4)))
    size = min(MAX_SAMPLE, max(MIN_SAMPLE, 16 * lists))
    drawn = index.orderBy(F.xxhash64("hash", F.lit(SEED)), "vector").limit(size).select("vector").toArrow()
    sample = _matrix(drawn["vector"].combine_chunks(), commonest.dim)
    fitted = Lists(sample, min(lists, len(sample)), top, recall)

    dealt = stored(index.select("ids", "vector").mapInArrow(_deal(fitted), f"ids ARRAY<BIGINT>, vector {held}, list INT"))
    sizes = np.zeros(len(fitted.centroids), dtype=np.int64)
    for r in dealt.groupBy("list").count().collect():  # at most MAX_LISTS rows
        sizes[r["list"]] = r["count"]
    chunks = F.array(*[F.lit(int(c)) for c in np.maximum(1, -(-sizes // CHUNK))])
    none = F.lit(None)
    candidates = dealt.select(
        "list",
        F.pmod(F.xxhash64("vector"), F.element_at(chunks, F.col("list") + 1)).cast("int").alias("chunk"),
        F.lit(0).alias("kind"),
        none.cast("bigint").alias("query"),
        "vector",
        "ids",
        none.cast("double").alias("least"),
    )

    rows = stored(kept.filter("asked").select("vec_id", *same))
    queries = stored(rows.select(*same).distinct().withColumn("query", F.monotonically_increasing_id()))
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])

    def probed(asking: DataFrame, first: bool) -> DataFrame:
        spread = asking.mapInArrow(
            _probe(fitted, sizes, top, first), f"query BIGINT, vector {held}, least DOUBLE, list INT, chunk INT"
        )
        spread = spread.select(
            "list", "chunk", F.lit(1).alias("kind"), "query", "vector", none.cast("array<bigint>").alias("ids"), "least"
        )
        group = ["list", "chunk"]
        streamed = candidates.unionByName(spread).repartition(*group).sortWithinPartitions(*group, "kind")
        found = streamed.mapInArrow(_scan(fitted, top + 1), "query BIGINT, score DOUBLE, ids ARRAY<BIGINT>")
        return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top + 1)

    asking = queries.select("query", "vector", F.lit(float("-inf")).alias("least"))
    near = stored(probed(asking, True))
    # The query's own vector may be one of them, so the place after the last counts.
    least = near.filter(F.col("r") == top + 1).select(F.col("query").alias("of"), F.col("score").alias("start"))
    asking = asking.join(least, F.col("query") == F.col("of"), "left").select(
        "query", "vector", F.coalesce("start", "least").alias("least")
    )
    far = probed(asking, False)

    # Per query vector the best ids in order; then each query id leaves itself out.
    every = near.drop("r").unionByName(far.drop("r")).select("query", "score", F.explode("ids").alias("vec_id")).distinct()
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = every.withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= top + 1)
    listed = ranked.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
    named = rows.distinct().join(queries, same).select("query", F.col("vec_id").alias("query_id"))
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, top)
    return (
        named.join(listed, "query")
        .select("query_id", F.posexplode(others).alias("place", "hit"))
        .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )
