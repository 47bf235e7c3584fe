"""Near-duplicate documents by SimHash fingerprints.

A fingerprint has 64 bits; bit j is set if bit j is set in over half of the
XXH64 values of the text's word shingles.  Two texts are linked where at most
``radius`` bits differ; components of links are classes of near-duplicates.

Candidates come from agreement: cut the 64 bits into five blocks, and three
differing bits leave two blocks untouched, so every link shows up in one of the
ten tables keyed by two blocks (about 26 bits).  Only distinct fingerprints take
part.  In a bucket the comparison is bit-sliced: word j of a block of 64 rows
holds bit j of all 64, one exclusive-or compares a fingerprint with 64 others,
and carry-save counters (ones, twos, more) add up the differing bits.  A word is
abandoned as soon as all its rows are over the radius.

A bucket over ``bucket_rows`` rows is dealt into chunks and every pair of chunks
is a group of its own, so no task holds more than two chunks of it and no pair
is left out.  A group reports a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import re
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import stored, utf8
from mdlake.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Seed and width of the hash, blocks of the candidate tables.
SEED = 42
BITS = 64
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
RADIUS = 3
SHINGLE = 3
BUCKET_ROWS = 4096

PIECE = 1 << 20  # bytes of a text that are cut into words at once
HASHES = 1 << 15  # shingle hashes whose bits are counted at once
SPACE = re.compile(rb"[\x20\x09-\x0D]")
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints ---------------------------------------------------------------


def _shingle_hashes(text: bytes, width: int) -> Iterator[list[int]]:
    """Hashes of all shingles, in lists that each stem from one piece of the text."""
    digest = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    at, total = 0, 0
    while at < len(text):
        cut = SPACE.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = cut.start() if cut else len(text)
        words = carry + text[at:end].lower().split()
        at = end
        total += len(words) - len(carry)
        n = len(words) - width + 1
        if n > 0:
            joined = b" ".join(words)
            ends, here = [], -1
            for word in words:
                here += len(word) + 1
                ends.append(here)
            starts = [0, *[e + 1 for e in ends[: n - 1]]]
            yield [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])]
        carry = words[max(0, len(words) - width + 1) :]
    if 0 < total < width:
        yield [digest(b" ".join(carry), SEED)]


def _bit_counts(hashes: list[int]) -> np.ndarray:
    out = np.zeros(BITS, dtype=np.int64)
    for low in range(0, len(hashes), HASHES):
        block = np.array(hashes[low : low + HASHES], dtype="<u8").view(np.uint8).reshape(-1, 8)
        out += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return out


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """SimHash of one text in UTF-8; 0 for one without words."""
    counts, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in _shingle_hashes(text, width):
        counts += _bit_counts(hashes)
        n += len(hashes)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0]) if n else 0


def _fingerprints(width: int, others: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(others))
            out = [fingerprint(data[a:b].tobytes(), width) for a, b in zip(offsets[:-1], offsets[1:])]
            values = np.array(out, dtype=np.uint64).view(np.int64)
            columns = [batch.column(i) for i in range(others)] + [pa.array(values)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:others], "fp"])

    return prints


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, keep: list[str] | None = None
) -> DataFrame:
    """(doc_id, the ``keep`` columns, fp); the unsigned fingerprint is held in a signed long."""
    kept = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), *(keep or []))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), *(keep or []), F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return rows.mapInArrow(_fingerprints(width, len(kept.columns)), f"{schema}, fp BIGINT")


# --- bit-sliced comparison --------------------------------------------------------


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit r of word w in plane j is bit j of value 64 w + r."""
    padded = np.zeros(-(-len(values) // BITS) * BITS, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(queries: np.ndarray, planes: np.ndarray, valid: np.ndarray, radius: int) -> np.ndarray:
    """(queries, words): the rows of each word at most ``radius`` bits away.

    Carry-save counters hold distances bit by bit for 64 rows at once; a count
    above the radius is final.  Words in which no row is left are dropped from
    the work after every eight planes.
    """
    if radius != RADIUS:
        raise ValueError("the counters hold two bits: the radius is 3")
    n, words = len(queries), planes.shape[1]
    q, w = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(words), indexing="ij"))
    ones = np.zeros(n * words, dtype=np.uint64)
    twos, over = ones.copy(), ~valid[w]
    for j in range(BITS):
        sign = np.where((queries[q] >> np.uint64(j)) & np.uint64(1), FULL, np.uint64(0))
        differ = planes[j, w] ^ sign
        carry = ones & differ
        ones ^= differ
        spill = twos & carry
        twos ^= carry
        over |= spill
        if j % 8 == 7:
            alive = over != FULL
            if not alive.all():
                q, w, ones, twos, over = q[alive], w[alive], ones[alive], twos[alive], over[alive]
    out = np.zeros((n, words), dtype=np.uint64)
    out[q, w] = ~over
    return out


def _rows_of(mask: np.ndarray) -> np.ndarray:
    return np.unpackbits(mask.view(np.uint8), bitorder="little").astype(bool)


def forest(values: np.ndarray, radius: int = RADIUS, step: int = 64) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct values, as index pairs.

    Every value is compared once with all that are not yet reached; what it
    reaches joins its tree and is compared in turn.
    """
    edges: list[tuple[int, int]] = []
    planes = bit_planes(values)
    left = np.zeros(planes.shape[1] * BITS, dtype=bool)
    left[: len(values)] = True
    for root in range(len(values)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue and left.any():
            ask, queue = queue[:step], queue[step:]
            words = np.flatnonzero(left.reshape(-1, BITS).any(axis=1))
            valid = np.packbits(left.reshape(-1, BITS)[words], axis=1, bitorder="little").view("<u8").ravel()
            near = within(values[ask], planes[:, words], valid, radius)
            for i, mask in zip(ask, near):
                hit = mask != 0
                if not hit.any():
                    continue
                found = (words[hit][:, None] * BITS + np.arange(BITS)).ravel()[_rows_of(mask[hit])]
                found = found[left[found]]
                left[found] = False
                edges += [(i, j) for j in found.tolist()]
                queue += found.tolist()
    return edges


def _link_groups(radius: int):
    """Links of each run of equal (key, low, high); rows come sorted by these."""

    def report(members: list[np.ndarray]) -> list[tuple[int, int]]:
        values = np.unique(np.concatenate(members))
        signed = values.view(np.int64)
        return [(int(signed[i]), int(signed[j])) for i, j in forest(values, radius)]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, low, high, fp = (batch.column(i).to_numpy() for i in range(4))
            change = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(key)]
            out: list[tuple[int, int]] = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                this = (key[a], low[a], high[a])
                if group is not None and this != group:
                    out += report(held)
                    held = []
                group = this
                held.append(fp[a:b].view(np.uint64))
            yield _edges(out)
        if held:
            yield _edges(report(held))

    return link


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    flat = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["a", "b"])


def links(prints: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Enough pairs (a, b) of distinct fingerprints to connect all linked ones.

    ``prints`` has one column, the distinct fingerprints.
    """
    fp = F.col(prints.columns[0])

    def block(i: int):
        low, size = BLOCKS[i]
        return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << size) - 1).cast("bigint"))

    keys = [
        F.lit(n << 26).cast("bigint").bitwiseOR(F.shiftleft(block(i), 13)).bitwiseOR(block(j))
        for n, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))
    ]
    rows = prints.select(fp.alias("fp"), F.explode(F.array(*keys)).alias("key"))
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / bucket_rows).cast("int")
    own = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("chunks")).cast("int")
    other = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
        F.array_except(F.sequence(F.lit(0), F.col("chunks") - 1), F.array(F.col("own")))
    )
    pairs = (
        rows.join(size, "key")
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .withColumn("other", F.explode(other))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    )
    group = ["key", "low", "high"]
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(parts, *group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_link_groups(radius), "a BIGINT, b BIGINT").distinct()


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    bucket_rows: int = BUCKET_ROWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """(doc_id, the ``keep`` columns, fp, component_id, class_fp) of every row of ``docs``.

    ``component_id`` is the smallest doc_id of the class, ``class_fp`` its
    smallest fingerprint.  Null and wordless texts have fingerprint 0 and are
    linked like any others; repeated rows each come back; a null doc_id is kept
    and never names a class.  An empty table gives an empty one, and columns
    that are not named are unused.
    """
    prints = stored(fingerprints(docs, doc_id, text, width, keep))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = components(links(first.select("fp"), bucket_rows=bucket_rows))
    rooted = first.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.select("fp", "root").join(least, "root").select("fp", "component_id", F.col("root").alias("class_fp"))
    return prints.join(classes, "fp").select("doc_id", *(keep or []), "fp", "component_id", "class_fp")
