"""Ranked lexical search of many queries at once, sharing what they have in common.

Queries are sums over their terms, so any set of terms has a partial score for
each document, and queries that hold the set can share it.

1. Mining.  Terms that occur in the same queries equally often are one class:
   such a class is a shared term set that no query splits.  Each query then is a
   short list of classes, the widest shared first; the neighbouring pair that
   most queries share becomes a node of its own, round by round, until no pair is
   left in two.  The nodes form a directed acyclic graph with the queries on top.
2. Index.  One scan of the documents finds, by 64-bit hash, the terms that any
   query asks for, and writes (id, length, terms, occurrences) once.  Collection
   statistics are sums over that table.
3. Accumulation.  Each task turns some documents at a time into a table of term
   scores, term by document, and fills the accumulators of all nodes in the order
   of the graph: each shared one once, from those below.  It keeps the best rows
   of every query, and one ranked merge of the tasks' best gives the answer.

Queries are taken in blocks of about ``BLOCK_TERMS`` terms, so the plan of a
block has a bounded size, whatever the number of queries; each block is one scan.
All documents and all terms count; nothing is cut or sampled.
"""

from __future__ import annotations

import math
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mdlake.llm.common import in_order, running, stored, utf8, written
from mdlake.llm.decontam import BLOCK, Powers, _blocks, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 20
BLOCK_TERMS = 1 << 18  # terms, with repeats, of the queries that are evaluated together
CELLS = 1 << 22  # accumulator cells that a task holds at once


# --- terms --------------------------------------------------------------------------


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """(first row, rows, row, hash, goes on) of the terms of consecutive pieces of the texts.

    A long text comes in several pieces; all but the last say that it goes on.
    """
    data, offsets = utf8(column)
    powers = Powers()
    for block in _blocks(data, offsets, BLOCK):
        sizes = np.array([end - begin + 1 for _, begin, end, _ in block])
        at = np.concatenate(([0], np.cumsum(sizes)))
        buffer = np.full(int(at[-1]), 32, dtype=np.uint8)
        for (_, begin, end, _), low in zip(block, at.tolist()):
            buffer[low : low + end - begin] = data[begin:end]
        hashes, starts = word_hashes(buffer, powers)
        rows = np.array([b[0] for b in block])
        piece = np.searchsorted(at, starts, side="right") - 1
        yield int(rows[0]), int(rows[-1] - rows[0] + 1), rows[piece], hashes, block[-1][3]


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[Counter] = [Counter() for _ in range(batch.num_rows)]
        for _, _, row, hashes, _ in _terms(batch.column(1)):
            for r, h in zip(row.tolist(), hashes.view(np.int64).tolist()):
                counts[r][h] += 1
        terms = pa.array([list(c.items()) for c in counts], pa.list_(pa.struct([("term", pa.int64()), ("times", pa.int64())])))
        sizes = pa.array([sum(c.values()) for c in counts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), terms, sizes], names=["item_id", "terms", "size"])


# --- mining -------------------------------------------------------------------------


class Plan:
    """Which accumulators to fill, in order, for one block of queries.

    Operand i is term i of ``terms`` for i below their number, and the node
    i - len(terms) otherwise.  ``nodes`` lists the operands of each node, which
    all come before it; ``queries`` lists (operand, times) of each query.
    """

    def __init__(self, queries: list[dict[int, int]]):
        self.terms = np.array(sorted({t for q in queries for t in q}), dtype=np.int64)
        self.nodes: list[list[int]] = []
        place = {t: i for i, t in enumerate(self.terms.tolist())}
        classes = self._classes(queries, place)
        # A query as a sequence of (operand, times), the most shared first.
        lists: list[list[tuple[int, int]]] = [[] for _ in queries]
        for uses, members in sorted(classes.items(), key=lambda c: (-len(c[0]), c[0])):
            operand = members[0] if len(members) == 1 else self._node(members)
            for query, times in uses:
                lists[query].append((operand, times))
        self.queries = self._share(lists)

    def _node(self, operands: list[int]) -> int:
        self.nodes.append(operands)
        return len(self.terms) + len(self.nodes) - 1

    @staticmethod
    def _classes(queries: list[dict[int, int]], place: dict[int, int]) -> dict[tuple, list[int]]:
        """Terms by the queries that hold them, with how often."""
        held: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, query in enumerate(queries):
            for term, times in query.items():
                held[place[term]].append((number, times))
        classes: dict[tuple, list[int]] = defaultdict(list)
        for term in sorted(held):
            classes[tuple(held[term])].append(term)
        return classes

    def _share(self, lists: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
        """Replace neighbouring pairs that several queries share by nodes, until none is left.

        Only neighbours are counted, so a round is linear in the lists.
        """
        while True:
            seen: Counter = Counter()
            for q in lists:
                seen.update({(a, b) for (a, m), (b, n) in zip(q, q[1:]) if m == n == 1})
            shared = {pair: None for pair, n in seen.items() if n > 1}
            if not shared:
                return lists
            out = []
            for q in lists:
                new, i = [], 0
                while i < len(q):
                    pair = (q[i][0], q[i + 1][0]) if i + 1 < len(q) and q[i][1] == q[i + 1][1] == 1 else None
                    # Of overlapping pairs the one that more queries share comes first.
                    after = (q[i + 1][0], q[i + 2][0]) if pair and i + 2 < len(q) and q[i + 2][1] == 1 else None
                    if pair in shared and not (after in shared and seen[after] > seen[pair]):
                        if shared[pair] is None:
                            shared[pair] = self._node(list(pair))
                        new.append((shared[pair], 1))
                        i += 2
                    else:
                        new.append(q[i])
                        i += 1
                out.append(new)
            lists = out

    def additions(self) -> int:
        """Vector additions that one evaluation takes."""
        return sum(map(len, self.nodes)) + sum(map(len, self.queries))


# --- index --------------------------------------------------------------------------


def _index(terms: np.ndarray):
    """Length of each document, and the wanted terms in it with their occurrences."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "terms", "tfs"]
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            keys, tfs = [], []
            width = max(1, len(terms))
            for first, rows, row, hashes, _ in _terms(batch.column(1)):
                n[first : first + rows] += np.bincount(row - first, minlength=rows)
                at = np.searchsorted(terms, hashes.view(np.int64))
                known = np.flatnonzero(at < len(terms))
                known = known[terms[at[known]] == hashes.view(np.int64)[known]]
                key, tf = np.unique(row[known] * width + at[known], return_counts=True)
                keys.append(key)
                tfs.append(tf)
            key, tf = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, tfs))
            key, back = np.unique(key, return_inverse=True)  # pieces of one text meet
            tf = np.bincount(back, weights=tf, minlength=len(key)).astype(np.int64)
            offsets = np.searchsorted(key, np.arange(batch.num_rows + 1) * width).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in ((key % width).astype(np.int32), tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], names=names)

    return scan


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of the partition hold each term."""
    held: np.ndarray = np.zeros(0, dtype=np.int64)
    for batch in batches:
        counts = np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(held))
        counts[: len(held)] += held
        held = counts
    term = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(held[term])], names=["term", "df"])


# --- accumulation -------------------------------------------------------------------


class Best:
    """The highest scores of each query so far, equal ones by ascending id."""

    def __init__(self, queries: int, top: int):
        self.top = top
        self.least = np.ones(queries, dtype=np.int64)  # what a score must reach
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.doc = np.empty(0, np.int64)
        self.named = np.empty(0, bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, named: np.ndarray) -> None:
        """``scores`` by query and document; a document that has no id comes after all others."""
        if scores.shape[1] > self.top:
            cut = np.partition(scores, scores.shape[1] - self.top, axis=1)[:, -self.top]
        else:
            cut = np.zeros(len(scores), np.int64)
        query, at = np.nonzero(scores >= np.maximum(self.least, cut)[:, None])
        query = np.concatenate((self.query, query))
        score = np.concatenate((self.score, scores[query[len(self.query) :], at]))
        doc, named = np.concatenate((self.doc, docs[at])), np.concatenate((self.named, named[at]))
        order = np.lexsort((doc, ~named, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        order = order[rank < self.top]
        self.query, self.score, self.doc, self.named = np.sort(query[rank < self.top]), score[order], doc[order], named[order]
        full, last = np.unique(self.query[::-1], return_index=True)
        ends = len(self.query) - 1 - last
        enough = np.bincount(self.query, minlength=len(self.least))[full] >= self.top
        self.least[full[enough]] = self.score[ends[enough]]


def _accumulate(plan: Plan, weight: np.ndarray, documents: int, length: int, top: int):
    """The best documents of the partition for each query of the plan."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(plan.queries), top)
        operands = len(plan.terms) + len(plan.nodes)
        step = max(16, CELLS // max(1, operands + len(plan.queries)))
        for batch in batches:
            ids, n = batch.column(0), batch.column(1).to_numpy()
            named = np.asarray(ids.is_valid())
            docs = np.asarray(ids.fill_null(0))
            offsets = batch.column(2).offsets.to_numpy()
            terms, tfs = (batch.column(i).values.to_numpy() for i in (2, 3))
            m = 100 - 25 + (25 * n * documents) // length
            for low in range(0, batch.num_rows, step):
                high = min(low + step, batch.num_rows)
                a, b = offsets[low], offsets[high]
                if a == b:
                    continue
                column = np.repeat(np.arange(high - low), np.diff(offsets[low : high + 1]))
                table = np.zeros((operands, high - low), dtype=np.int64)
                tf, term = tfs[a:b], terms[a:b]
                table[term, column] = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[low + column]))
                for at, parts in enumerate(plan.nodes, len(plan.terms)):
                    np.sum(table[parts], axis=0, out=table[at])
                scores = np.zeros((len(plan.queries), high - low), dtype=np.int64)
                for at, parts in enumerate(plan.queries):
                    for operand, times in parts:
                        scores[at] += table[operand] if times == 1 else times * table[operand]
                best.add(scores, docs[low:high], named[low:high])
        columns = [
            pa.array(best.query.astype(np.int32)),
            pa.array(best.doc, pa.int64(), mask=~best.named),
            pa.array(best.score),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])

    return score


def search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each query, scores above 0.

    Equal scores go by ascending id, null ids last.  A null or termless text
    has no score, a query without terms no rows; rows of either table that
    repeat are ranked one by one; empty tables give an empty one; other columns
    are unused.
    """
    spark = docs.sparkSession
    kind = dict(queries.dtypes)[item_id]
    asked = queries.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).mapInArrow(
        _query_terms, f"item_id {kind}, terms ARRAY<STRUCT<term: BIGINT, times: BIGINT>>, size BIGINT"
    )
    asked = stored(asked.filter("size > 0").withColumn("place", F.monotonically_increasing_id()))
    # Blocks of like size, in any order: an item longer than a block is one of its own.
    sized = running(in_order(asked.select("place", "size"), [], ["place"]), [], ["place"], "size")
    blocks = stored(sized.select("place", F.expr(f"before DIV {block_terms}").alias("block")))
    numbers = [r.block for r in blocks.select("block").distinct().orderBy("block").collect()]
    made = [
        _search_block(docs, asked.join(blocks.filter(F.col("block") == n), "place"), top, doc_id, text) for n in numbers
    ]
    if not made:
        return spark.createDataFrame([], f"item_id {kind}, rank INT, doc_id BIGINT, score BIGINT")
    every = made[0]
    for more in made[1:]:
        every = every.unionByName(more)
    return every


def _search_block(docs: DataFrame, asked: DataFrame, top: int, doc_id: str, text: str) -> DataFrame:
    """Rank the documents for the queries of one block, whose terms are bounded."""
    items = asked.select("place", "item_id", "terms").orderBy("place").collect()
    plan = Plan([{t.term: t.times for t in r.terms} for r in items])
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    index = written(rows.mapInArrow(_index(plan.terms), "doc_id BIGINT, n BIGINT, terms ARRAY<INT>, tfs ARRAY<BIGINT>"))
    totals = index.filter("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    held = index.select("terms").mapInArrow(_holders, "term INT, df BIGINT").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(plan.terms), dtype=np.int64)
    for r in held.collect():  # one row a term of the block
        df[r.term] = r.df
    above = 2 * totals.documents + 2
    weight = np.array([math.floor(1000 * math.log(above / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
    best = index.filter("size(terms) > 0").mapInArrow(
        _accumulate(plan, weight, totals.documents, max(1, totals.length), top), "query INT, doc_id BIGINT, score BIGINT"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    named = asked.withColumn("query", (F.row_number().over(Window.orderBy("place")) - 1).cast("int")).select("query", "item_id")
    return ranked.join(F.broadcast(named), "query").select("item_id", "rank", "doc_id", "score")
