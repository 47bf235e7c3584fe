"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of up to three bytes with the counts
of the byte that followed.  A byte costs -log2 of its share among what followed
the longest known context; where the byte is new there, an escape is paid
(method C: one part per distinct follower) and the next shorter context is
asked, down to a flat code over 256 values.  A text belongs to the language
whose frozen statistics give it the shortest code.

The statistics come from a sample of labelled rows bounded by
``max_train_bytes`` a language; scoring reads every byte of every text.  As a
byte's cost depends on at most four bytes, it is tabulated once for each known
gram of one to four bytes, and whole blocks of text are scored by lookups.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.llm.common import pieces, utf8

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4  # bytes in the longest gram: three of context and the one predicted
PAD = np.full(ORDER - 1, 10, dtype=np.uint8)  # what stands before a text
BLOCK = 1 << 19  # bytes scored at once
MAX_TRAIN_BYTES = 4_000_000
MAX_GRAMS = 100_000  # of a language
FLAT_BITS = 8.0
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Frozen statistics as lookup tables.

    Gram ids are 1.. per length, 0 for a gram that no language has seen.
    ``step[k]`` maps (id of a gram of k bytes, next byte) to the gram of k+1;
    ``bits[k][id]`` is what the gram's last byte costs in each language after
    the bytes before it; ``escape[k][id]`` the cost of leaving that context.
    """

    languages: tuple[str, ...]
    step: tuple[np.ndarray, ...]
    bits: tuple[np.ndarray, ...]
    escape: tuple[np.ndarray, ...]


# --- training -----------------------------------------------------------------


def _padded(data: np.ndarray, offsets: np.ndarray, part: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces in one buffer, each after the three bytes that precede it."""
    gap = len(PAD)
    sizes = np.array([end - begin for _, begin, end in part], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + gap)))[:-1] + gap
    out = np.empty(int(sizes.sum()) + gap * len(part), dtype=np.uint8)
    for (row, begin, end), at in zip(part, starts.tolist()):
        out[at - gap : at] = PAD
        before = min(gap, begin - int(offsets[row]))
        out[at - before : at + end - begin] = data[begin - before : end]
    return out, starts


def _grams(buffer: np.ndarray) -> np.ndarray:
    """The four bytes that end at each position from the fourth on, as a number."""
    wide = buffer.astype(np.uint32)
    return (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = np.array(batch.column(1).to_pylist(), dtype=object)
        data, offsets = utf8(batch.column(0))
        for part in pieces(offsets, BLOCK):
            for label in sorted({labels[row] for row, _, _ in part}):
                own = [p for p in part if labels[p[0]] == label and p[2] > p[1]]
                if not own:
                    continue
                buffer, starts = _padded(data, offsets, own)
                grams = _grams(buffer)
                inside = np.zeros(len(buffer), dtype=bool)
                for (_, begin, end), at in zip(own, starts.tolist()):
                    inside[at : at + end - begin] = True
                codes, n = np.unique(grams[inside[3:]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["label", "gram", "n"],
                )


def train(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    max_train_bytes: int = MAX_TRAIN_BYTES,
    max_grams: int = MAX_GRAMS,
) -> Model:
    """Learn from the labelled rows of ``docs``; rows without a label are left out.

    At most about ``max_train_bytes`` of text a language are read into the
    counts (rows chosen by a hash of the text; where that leaves a language none,
    as with a few huge texts, the one with the least hash), and of each language
    the ``max_grams`` most frequent grams are kept, however many languages there
    are.  Without labelled rows the model knows no language and calls every text
    ``und``.
    """
    rows = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label")
    )
    chance = F.pmod(F.xxhash64(F.lit("langid"), "text"), F.lit(1 << 20)) / float(1 << 20)
    share = rows.groupBy("label").agg(
        (F.lit(float(max_train_bytes)) / F.greatest(F.sum(F.octet_length("text")), F.lit(1))).alias("share"),
        F.min(chance).alias("least"),
    )
    # One row per language, as many as the model has columns: the texts stay where they are.
    drawn = (chance < F.col("share")) | (chance == F.col("least"))
    sample = rows.join(F.broadcast(share), "label").filter(drawn).select("text", "label")
    often = Window.partitionBy("label").orderBy(F.desc("n"), "gram")
    counts = (
        sample.mapInArrow(_count_grams, "label STRING, gram BIGINT, n BIGINT")
        .groupBy("label", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(often))
        .filter(F.col("place") <= max_grams)
    )
    return _tabulate([(r.label, r.gram, r.n) for r in counts.collect()])


def _tabulate(counts: list[tuple[str, int, int]]) -> Model:
    languages = tuple(sorted({c[0] for c in counts}))
    number = {name: i for i, name in enumerate(languages)}
    lang = np.array([number[c[0]] for c in counts], dtype=np.int64)
    gram = np.array([c[1] for c in counts], dtype=np.int64)
    n = np.array([c[2] for c in counts], dtype=np.float64)
    width = len(languages)

    # Count tables by gram length; row 0 stands for unknown grams.  Contexts that
    # reach before a text are no grams of it, and are known all the same.
    tails = [gram & ((1 << (8 * k)) - 1) for k in range(ORDER + 1)]
    keys: list[np.ndarray] = [np.zeros(1, np.int64)] * (ORDER + 1)
    keys[ORDER] = np.unique(tails[ORDER])
    for k in range(ORDER - 1, 0, -1):
        keys[k] = np.unique(np.concatenate((tails[k], keys[k + 1] >> 8)))
    seen: list[np.ndarray] = []
    for k in range(ORDER + 1):
        held = np.zeros((len(keys[k]) + 1, width))
        np.add.at(held, (np.searchsorted(keys[k], tails[k]) + 1, lang), n)
        seen.append(held)

    def ids(k: int, wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(keys[k], wanted)
        at = np.minimum(at, max(len(keys[k]) - 1, 0))
        return np.where(keys[k][at] == wanted, at + 1, 0) if len(keys[k]) else np.zeros(len(wanted), np.int64)

    # Followers of a context: total and distinct, by language.
    bits: list[np.ndarray] = [np.full((1, width), FLAT_BITS)]
    escape: list[np.ndarray] = []
    step: list[np.ndarray] = []
    for k in range(1, ORDER + 1):
        short, last = keys[k] >> 8, keys[k] & 255
        context = ids(k - 1, short) if k > 1 else np.zeros(len(short), np.int64)
        size = len(keys[k - 1]) + 1 if k > 1 else 1
        total, distinct = np.zeros((size, width)), np.zeros((size, width))
        np.add.at(total, context, seen[k][1:])
        np.add.at(distinct, context, (seen[k][1:] > 0).astype(float))
        if k > 1:  # a gram that was only seen at the end of a longer one has no followers
            total[0], distinct[0] = 0, 0
        known = total > 0
        leave = np.where(known, -np.log2(np.where(known, distinct, 1) / np.where(known, total + distinct, 1)), 0.0)
        escape.append(leave.astype(np.float32))
        own = seen[k][1:]
        share = np.where(own > 0, own, 1) / np.where(known[context], total[context] + distinct[context], 1)
        shorter = bits[k - 1][ids(k - 1, keys[k] & ((1 << (8 * (k - 1))) - 1))] if k > 1 else np.full((len(short), width), FLAT_BITS)
        cost = np.where((own > 0) & known[context], -np.log2(share), leave[context] + shorter)
        blank = np.zeros((1, width)) if k > 1 else leave[:1] + FLAT_BITS
        bits.append(np.concatenate((blank, cost)).astype(np.float32))
        jump = np.zeros((size, 256), dtype=np.int32)
        jump[context, last] = np.arange(1, len(short) + 1)
        if k > 1:
            jump[0] = 0
        step.append(jump.ravel())
    return Model(languages, tuple(step), tuple(bits), tuple(escape))


# --- scoring ------------------------------------------------------------------


def code_lengths(model: Model, buffer: np.ndarray) -> np.ndarray:
    """Bits of each byte from the fourth on, a column per language."""
    byte = buffer.astype(np.int32)
    ids = [None, model.step[0][byte]]
    for k in range(1, ORDER):
        ids.append(model.step[k][ids[k][:-1] * 256 + byte[k:]])
    grams = [None] + [ids[k][ORDER - k :] for k in range(1, ORDER + 1)]
    before = [None] + [ids[k][ORDER - 1 - k : len(buffer) - 1] for k in range(1, ORDER)]
    out = model.bits[ORDER][grams[ORDER]].astype(np.float64)
    missing = np.flatnonzero(grams[ORDER] == 0)
    for k in range(ORDER - 1, 0, -1):
        if not len(missing):
            break
        # The context of k bytes does not know this byte: escape to the shorter gram.
        out[missing] += model.escape[k][before[k][missing]] + model.bits[k][grams[k][missing]]
        missing = missing[grams[k][missing] == 0]
    return out


def _score(model: Model, others: int):
    width = len(model.languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(others))
            bits = np.zeros((batch.num_rows, width))
            for part in pieces(offsets, BLOCK):
                buffer, starts = _padded(data, offsets, part)
                if len(buffer) < ORDER or not width:
                    continue
                run = np.concatenate((np.zeros((1, width)), np.cumsum(code_lengths(model, buffer), axis=0)))
                ends = starts + np.array([end - begin for _, begin, end in part])
                np.add.at(bits, [row for row, _, _ in part], run[ends - 3] - run[starts - 3])
            letters = np.array(batch.column(others + 1).to_pylist(), dtype=bool)
            size = np.diff(offsets)
            known = letters & bool(width)
            best = bits.argmin(axis=1) if width else np.zeros(batch.num_rows, np.int64)
            least = bits.min(axis=1) if width else np.zeros(batch.num_rows)
            share = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1) if width else least
            names = np.array([*model.languages, UNKNOWN], dtype=object)
            columns = [batch.column(i) for i in range(others)]
            columns.append(pa.array(names[np.where(known, best, width)].tolist(), pa.string()))
            columns.append(pa.array(np.where(known, share, 0.0)))
            columns.append(pa.array(np.where(known, least / np.maximum(size, 1), 0.0)))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:others], "lang_pred", "score", "bits_per_byte"])

    return score


def identify(docs: DataFrame, model: Model, keep: list[str], text: str | Column = "text") -> DataFrame:
    """The ``keep`` columns and, for each text, ``lang_pred``, ``score``, ``bits_per_byte``.

    ``score`` is the best language's share of the probability that all
    languages give the text; ``bits_per_byte`` its code length there.  A text
    that is null or has no letter is ``und`` with score 0; ties go to the first
    language by name.  Repeated rows are scored alike, an empty table gives none.
    """
    text = F.col(text) if isinstance(text, str) else text
    rows = docs.select(*keep, text.alias("__text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("__letters"))
    kept = rows.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = ", ".join(x for x in (schema, "lang_pred STRING, score DOUBLE, bits_per_byte DOUBLE") if x)
    return rows.mapInArrow(_score(model, len(keep)), schema)
