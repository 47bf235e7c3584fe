"""Benchmark decontamination by winnowed word grams.

Texts become sequences of word hashes.  A winnowing window is ``window``
consecutive grams of ``gram`` words, so it spans ``window + gram - 1`` words (10
with the defaults), and its fingerprint is the smallest gram hash in it.  The
same span of words always selects the same fingerprint, wherever it stands, so
any shared span of that length meets in a join on fingerprints; the hit is then
extended to the whole span by comparing the hash of all its words.  Items
shorter than a span are one span of their own length.

The documents are read once.  Each task keeps the windows whose fingerprint is
set in a bitmap of the benchmark's fingerprints; its size is fixed by
``filter_bits``, whatever the benchmark holds, and what passes by chance fails
the join.  Benchmark and documents meet in a Spark join of the remaining
windows, so neither side has to fit in one process.

Words, grams and spans are compared by 64-bit hashes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mdlake.llm.common import stored, utf8

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 5
WINDOW = 6
SPAN = GRAM + WINDOW - 1
FILTER_BITS = 1 << 23
BLOCK = 1 << 19  # bytes of text hashed at once

# Odd multipliers of the polynomial hashes, and splitmix64's.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of each byte (A-Z only), and whether it belongs to a word."""
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += 32
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    return lower + np.uint64(1), word


LOWER, WORD = _byte_tables()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the byte base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(BYTE_BASE, -1, 1 << 64)
            self.up, self.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base, dtype=np.uint64))))
                for base in (BYTE_BASE, inverse)
            )
        return self.up, self.down


def word_hashes(buffer: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a buffer that ends outside a word."""
    inside = WORD[buffer]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    up, down = powers.upto(len(buffer) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(LOWER[buffer] * up[: len(buffer)])))
    return _mix((total[ends] - total[starts]) * down[starts]), starts


def _blocks(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[list[tuple[int, int, int, bool]]]:
    """Lists of (row, begin, end, goes on) of about ``size`` bytes; cuts fall outside words."""
    out: list[tuple[int, int, int, bool]] = []
    held = 0
    for row, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while end - begin > size:
            cut, reach = begin + size, size
            while True:
                free = np.flatnonzero(~WORD[data[cut : min(end, cut + reach)]])
                if len(free) or cut + reach >= end:
                    break
                cut, reach = cut + reach, 2 * reach
            cut = cut + int(free[0]) if len(free) else end
            if cut == end:
                break
            yield [*out, (row, begin, cut, True)]
            out, held, begin = [], 0, cut
        out.append((row, begin, end, False))
        held += end - begin
        if held >= size:
            yield out
            out, held = [], 0
    if out:
        yield out


def _at(words: np.ndarray, where: np.ndarray | slice, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each of the positions."""
    factors = [pow(WORD_BASE, j, 1 << 64) for j in range(width)]
    if isinstance(where, slice):
        n = len(words) - width + 1
        return sum(words[j : j + n] * np.uint64(f) for j, f in enumerate(factors))
    return sum((words[where + j] * np.uint64(f) for j, f in enumerate(factors)), np.zeros(len(where), np.uint64))


def _poly(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from every position."""
    return _at(words, slice(None), width)


def spans(column: pa.Array, widths: tuple[int, ...], bitmap: np.ndarray | None, whole: bool) -> Iterator[tuple]:
    """(first row, word counts, row, start, width, fp, span) of each block of texts.

    Windows of SPAN words carry the fingerprint winnowing selects; windows of
    the shorter ``widths`` carry their own hash.  With ``whole`` a text shorter
    than SPAN is one window.  A bitmap leaves only windows whose bit is set.
    """
    data, offsets = utf8(column)
    powers = Powers()
    carry, carry_row, carry_base = np.empty(0, np.uint64), -1, 0
    for block in _blocks(data, offsets, BLOCK):
        sizes = np.array([end - begin + 1 for _, begin, end, _ in block])
        at = np.concatenate(([0], np.cumsum(sizes)))
        buffer = np.full(int(at[-1]), 32, dtype=np.uint8)
        for (_, begin, end, _), low in zip(block, at.tolist()):
            buffer[low : low + end - begin] = data[begin:end]
        words, starts = word_hashes(buffer, powers)
        piece = np.searchsorted(at, starts, side="right") - 1
        rows = np.array([b[0] for b in block])
        row = rows[piece]
        first_row = rows[0]
        counts = np.bincount(row - first_row, minlength=rows[-1] - first_row + 1)
        # Words of a text cut before: the last ones stand in front again.
        held = 0
        base = np.zeros(len(counts), dtype=np.int64)
        if carry_row == first_row:
            held = len(carry)
            words, row = np.concatenate((carry, words)), np.concatenate((np.full(held, first_row), row))
            base[0] = carry_base
        begin_of = np.searchsorted(row, np.arange(first_row, first_row + len(counts)))
        found = []

        def collect(where: np.ndarray, width: np.ndarray | int, fp: np.ndarray, span: np.ndarray) -> None:
            r = row[where]
            start = where - begin_of[r - first_row] + base[r - first_row]
            found.append((r, start, np.broadcast_to(width, len(where)), fp, span))

        if len(words) >= SPAN:
            grams = _mix(_poly(words, GRAM))
            least = np.minimum(grams[:-1], grams[1:])
            least = np.minimum(np.minimum(least[:-4], least[2:-2]), least[4:])
            where = np.flatnonzero(_set(least, bitmap) & (row[: len(least)] == row[SPAN - 1 :]))
            collect(where, SPAN, least[where], _mix(_at(words, where, SPAN) + np.uint64(SPAN)))
        for width in widths:
            if len(words) >= width:
                full = _mix(_poly(words, width) + np.uint64(width))
                ok = _set(full, bitmap) & (row[: len(full)] == row[width - 1 :])
                ok[: max(0, held - width + 1)] = False
                where = np.flatnonzero(ok)
                collect(where, width, full[where], full[where])
        if whole:
            n = np.bincount(row - first_row, minlength=len(counts)) + base
            if block[-1][3]:
                n[-1] = SPAN  # more of this text follows
            for width in range(1, SPAN):
                where = begin_of[n == width]
                full = _mix(_at(words, where, width) + np.uint64(width))
                collect(where, width, full, full)
        yield (first_row, counts, *(np.concatenate(x) for x in zip(*found))) if found else (
            first_row, counts, *(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
        )
        if block[-1][3]:
            own = words[row == rows[-1]]
            before = base[-1] if rows[-1] == first_row else 0
            kept = min(SPAN - 1, len(own))
            carry, carry_row = own[len(own) - kept :], rows[-1]
            carry_base = int(before + len(own) - kept)
        else:
            carry_row = -1


def _set(fp: np.ndarray, bitmap: np.ndarray | None) -> np.ndarray:
    if bitmap is None:
        return np.ones(len(fp), dtype=bool)
    bit = fp & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, row, _, width, fp, span in spans(batch.column(1), (), None, True):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(width.astype(np.int32)),
                    pa.array(fp.view(np.int64)),
                    pa.array(span.view(np.int64)),
                ],
                names=["item_id", "width", "fp", "span"],
            )


def _doc_windows(widths: tuple[int, ...], bitmap: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words = np.zeros(batch.num_rows, dtype=np.int64)
            parts: list[list[np.ndarray]] = [[] for _ in range(5)]
            for first, counts, *columns in spans(batch.column(1), widths, bitmap, False):
                n_words[first : first + len(counts)] += counts
                for part, column in zip(parts, columns):
                    part.append(column)
            row, start, width, fp, span = (np.concatenate(p) if p else np.empty(0, np.int64) for p in parts)
            order = np.argsort(row, kind="stable")
            offsets = np.concatenate(([0], np.cumsum(np.bincount(row.astype(np.int64), minlength=batch.num_rows))))
            struct = pa.StructArray.from_arrays(
                [
                    pa.array(start[order].astype(np.int64)),
                    pa.array(width[order].astype(np.int32)),
                    pa.array(fp[order].astype(np.uint64).view(np.int64)),
                    pa.array(span[order].astype(np.uint64).view(np.int64)),
                ],
                names=["start", "width", "fp", "span"],
            )
            windows = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), struct)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), windows], names=["doc_id", "n_words", "windows"])

    return scan


def _bitmap(items: DataFrame, filter_bits: int) -> np.ndarray:
    """Bit (fp mod ``filter_bits``) of every fingerprint of the benchmark."""
    words = (
        items.selectExpr(
            f"shiftright(fp & {filter_bits - 1}L, 5) AS word", "shiftleft(1L, CAST(fp & 31L AS INT)) AS bits"
        )
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()  # filter_bits / 32 rows at most
    )
    out = np.zeros(filter_bits // 32, dtype="<u4")
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, hits) of every row of ``docs``.

    ``hits`` lists the merged word ranges [start, end) covered by windows of the
    benchmark, ``item_ids`` the items (as text, sorted) with such a window.
    Null and wordless texts have no words and no hits; a null item id is the
    empty text.  Rows with one id are judged one by one; an empty benchmark
    hits nothing; columns besides those named are unused.
    """
    items = stored(
        benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.col(item_text).alias("text"))
        .mapInArrow(_item_windows, "item_id STRING, width INT, fp BIGINT, span BIGINT")
        .distinct()
    )
    widths = tuple(sorted(r.width for r in items.filter(F.col("width") < SPAN).select("width").distinct().collect()))
    scanned = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _doc_windows(widths, _bitmap(items, filter_bits)),
        f"doc_id {dict(docs.dtypes)[doc_id]}, n_words BIGINT, "
        "windows ARRAY<STRUCT<start: BIGINT, width: INT, fp: BIGINT, span: BIGINT>>",
    )
    scanned = stored(scanned.withColumn("row", F.monotonically_increasing_id()))
    windows = scanned.filter(F.size("windows") > 0).select("row", F.explode("windows").alias("w")).select("row", "w.*")
    met = windows.join(items, ["width", "fp", "span"])
    item_ids = met.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    # Merge overlapping windows: one that starts past all ends so far opens a range.
    ordered = Window.partitionBy("row").orderBy("start")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    ranges = (
        met.groupBy("row", "start")
        .agg((F.col("start") + F.max("width")).alias("end"))
        .withColumn("opens", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
        .withColumn("range", F.sum("opens").over(ordered))
        .groupBy("row", "range")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("row")
        .agg(
            F.sum(F.col("end") - F.col("start")).alias("n_hit"),
            F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hits"),
        )
    )
    hits = ranges.join(item_ids, "row")
    return (
        scanned.select("row", "doc_id", "n_words")
        .join(hits, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("item_ids", F.expr("CAST(array() AS ARRAY<STRING>)")).alias("item_ids"),
            F.coalesce("hits", F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT>>)")).alias("hits"),
        )
    )
