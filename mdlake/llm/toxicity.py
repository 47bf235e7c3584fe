"""Toxicity by compression distance.

Two zstandard dictionaries, one of toxic and one of ordinary text, compress
every window of a text; a window that the toxic dictionary makes shorter by more
bytes is likelier toxic.  How much likelier each difference is, is calibrated on
labelled texts, and a document's evidence is the sum over its windows, mapped to
a probability by a logistic curve.

Dictionaries of whole texts differ mostly in the ordinary wording they happen to
hold, which drowns a few toxic words.  So each is made of the words that are
more frequent in its class, the toxic one of those for which chance is ruled
out.  Support is counted in independent documents: a word that always comes
with the same neighbours (copies of one text) counts once.  Both have the same
length, and the most telling words come last, where a match costs least.

Windows are ``WORDS`` words long.  One word is the default: in longer windows
the matches that a text has with itself vary more than the two dictionaries do
(on the 0.1 tables, held-out area under the curve 0.95 with one word, 0.89 with
two or four).  A window is followed by blanks, so that zstandard compresses even
short ones, and calibrated by the saving and the compressed length together: a
saving tells more where little else is left.

The labelled sample is bounded by ``max_docs`` a class; every window of every
text is scored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import re
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import LOWER, UPPER, WHITE, stored, uniform, utf8

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 1  # words of a window
WIDEST = 512  # bytes of a window; longer ones are cut
LEVEL = 9
BLANKS = b" " * 32  # follow a window
END = b" " * 16  # ends a dictionary: zstandard does not look up its last bytes
PUNCTUATION = bytes([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
CACHED = 200_000  # windows whose cell a task remembers, and twice as many runs as they stand in the texts
BLOCK = 1 << 16  # runs looked up together
MAX_DOCS = 3000  # labelled documents of a class
MAX_WORDS = 1000  # words in a dictionary
SIGNIFICANT = 12.0  # log-likelihood ratio of a toxic word
TIMES = 5.0  # how many times as frequent it is
SAVED = (-8, 16)  # savings beyond are counted as these
LENGTHS = 64  # compressed lengths beyond are counted as the last
CLEAR = 15.0  # evidence beyond adds nothing to the fit of the curve
CELLS = (SAVED[1] - SAVED[0] + 1) * LENGTHS
PRIOR = 4.0  # windows without a lean that each cell is thought to have besides
PIECE = 1 << 20
SEED = 2
SPACE = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Model:
    """Dictionaries, evidence by cell, and the logistic curve."""

    toxic: bytes
    ordinary: bytes
    evidence: tuple[float, ...]
    slope: float
    intercept: float


# --- windows --------------------------------------------------------------------


def _runs(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased runs of WORDS words, in lists of bounded length; each word is in one."""
    at = 0
    while at < len(text):
        cut = SPACE.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = cut.start() if cut else len(text)
        words = text[at:end].lower().split()
        at = end
        yield words if WORDS == 1 else [b" ".join(words[low : low + WORDS]) for low in range(0, len(words), WORDS)]


def _windows_of(run: bytes) -> list[bytes]:
    """The windows of one run: its words without punctuation around, cut where too long."""
    window = b" %b " % b" ".join(w.strip(PUNCTUATION) for w in run.split())
    return [window[i : i + WIDEST] for i in range(0, len(window), WIDEST)]


def windows(text: bytes) -> Iterator[bytes]:
    """All windows of a text, in order."""
    for runs in _runs(text):
        for run in runs:
            yield from _windows_of(run)


def _compressor(content: bytes):
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
    ).compress


class Seen(dict):
    """The cell of each run as it stands in the texts; a run in several windows gives a list and is not kept."""

    def __init__(self, cell_of) -> None:
        super().__init__()
        self.cell_of, self.several = cell_of, False

    def __missing__(self, run: bytes) -> int | list[int]:
        made = [self.cell_of(window) for window in _windows_of(run)]
        if len(made) > 1:
            self.several = True
            return made
        if len(self) >= 2 * CACHED:
            self.clear()
        self[run] = made[0]
        return made[0]


class Cells:
    """The calibration cell of a window: bytes the toxic dictionary saves, and the length it leaves."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)
        self.known: dict[bytes, int] = {}
        self.seen = Seen(self._of)

    def _of(self, window: bytes) -> int:
        cell = self.known.get(window)
        if cell is None:
            left = len(self.toxic(window + BLANKS))
            saved = len(self.ordinary(window + BLANKS)) - left
            cell = (min(max(saved, SAVED[0]), SAVED[1]) - SAVED[0]) * LENGTHS + min(left, LENGTHS - 1)
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[window] = cell
        return cell

    def blocks(self, text: bytes) -> Iterator[np.ndarray]:
        """The cells of all windows, in arrays of bounded length.

        Runs are remembered as they stand in the text, so one seen before costs a look-up.
        """
        for runs in _runs(text):
            for low in range(0, len(runs), BLOCK):
                cells = list(map(self.seen.__getitem__, runs[low : low + BLOCK]))
                if self.seen.several:
                    cells = [x for cell in cells for x in (cell if isinstance(cell, list) else [cell])]
                    self.seen.several = False
                yield np.array(cells, dtype=np.int64)

    def evidence(self, text: bytes, table: np.ndarray) -> float:
        return float(sum(table[block].sum() for block in self.blocks(text)))


# --- training -------------------------------------------------------------------


def _word_support(sample: DataFrame) -> DataFrame:
    """(fold, toxic, word, support): independent documents that hold the word."""
    mark = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"
    words = F.transform(
        F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[^{WHITE}]+"), F.lit(0)),
        lambda w: F.regexp_replace(w, f"^{mark}|{mark}$", ""),
    )
    near = F.transform(
        "words",
        lambda w, i: F.struct(
            w.alias("word"),
            F.xxhash64(
                F.try_element_at("words", F.when(i > 0, i).otherwise(F.lit(1 << 30)).cast("int")),
                F.try_element_at("words", (i + 2).cast("int")),
            ).alias("context"),
        ),
    )
    pairs = (
        sample.dropDuplicates(["fold", "toxic", "text_hash"])
        .select("fold", "toxic", "text_hash", words.alias("words"))
        .select("fold", "toxic", "text_hash", F.explode(F.array_distinct(near)).alias("p"))
        .select("fold", "toxic", "text_hash", "p.word", "p.context")
    )
    return (
        pairs.groupBy("fold", "toxic", "word")
        .agg(
            F.countDistinct("text_hash").alias("docs"),
            F.countDistinct("context").alias("contexts"),
            F.count(F.lit(1)).alias("pairs"),
        )
        .select("fold", "toxic", "word", (F.col("docs") * F.col("contexts") / F.col("pairs")).alias("support"))
    )


def _ratio_test(a: str, b: str, n: float, m: float):
    """Log-likelihood ratio of a word in a of n and b of m documents."""
    a, b = F.col(a), F.col(b)
    both = a + b
    cells = [
        (a, both * n / (n + m)),
        (b, both * m / (n + m)),
        (F.lit(n) - a, (F.lit(n + m) - both) * n / (n + m)),
        (F.lit(m) - b, (F.lit(n + m) - both) * m / (n + m)),
    ]
    return sum((F.when(o > 0, 2 * o * F.log(o / e)).otherwise(0.0) for o, e in cells), F.lit(0.0))


def _dictionaries(support: DataFrame, docs: dict[tuple[int, int], int], folds: list[int]) -> tuple[bytes, bytes]:
    """The dictionaries: words of either class, most telling last, at one length."""
    n = {k: float(max(1, sum(docs.get((f, k), 0) for f in folds))) for k in (0, 1)}
    wide = (
        support.filter(F.col("fold").isin(folds))
        .groupBy("word")
        .agg(*[F.sum(F.when(F.col("toxic") == k, F.col("support")).otherwise(0.0)).alias(f"s{k}") for k in (0, 1)])
        .withColumn("test", _ratio_test("s1", "s0", n[1], n[0]))
    )

    def most(own: int, other: int, test: float, times: float) -> list[str]:
        rate = (F.col(f"s{own}") / n[own]) / ((F.col(f"s{other}") + 0.5) / n[other])
        rows = wide.filter((F.col("test") >= test) & (rate >= times) & (F.col(f"s{own}") >= 2) & (F.length("word") > 2))
        return [r.word for r in rows.orderBy(F.desc("test"), "word").limit(MAX_WORDS).select("word").collect()]

    toxic = b" %b " % " ".join(most(1, 0, SIGNIFICANT, TIMES)[::-1]).encode()
    plain = b" %b " % " ".join(most(0, 1, 0.0, 1.0)[::-1]).encode()
    return toxic + END, plain[-len(toxic) :].rjust(len(toxic)) + END


def _histogram(dictionaries: dict[int, tuple[bytes, bytes]]):
    """Windows by class and cell, summed over each batch; a fold has its own dictionaries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {fold: Cells(*pair) for fold, pair in dictionaries.items()}
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            out = np.zeros((2, CELLS), dtype=np.int64)
            for fold, toxic, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), offsets[:-1], offsets[1:]):
                for block in made[fold].blocks(data[a:b].tobytes()):
                    out[toxic] += np.bincount(block, minlength=CELLS)
            row, cell = np.nonzero(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(out[row, cell])],
                names=["toxic", "cell", "n"],
            )

    return count


def _told(dictionaries: dict[int, tuple[bytes, bytes]], table: np.ndarray):
    """Evidence of each text, by the dictionaries of its fold."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {fold: Cells(*pair) for fold, pair in dictionaries.items()}
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            folds = batch.column(0).to_pylist()
            told = [made[f].evidence(data[a:b].tobytes(), table) for f, a, b in zip(folds, offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(told, pa.float64())], names=["toxic", "told"])

    return tell


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method, slightly shrunk; far evidence counts as CLEAR."""
    design = np.stack((np.clip(x, -CLEAR, CLEAR) / CLEAR, np.ones_like(x)), axis=1)
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - 1e-2 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / CLEAR), float(beta[1])


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_docs: int = MAX_DOCS
) -> Model:
    """Learn from the documents that ``labels`` (doc_id, 0 or 1) covers.

    About ``max_docs`` documents of each class are used, chosen by a hash of the
    id.  Evidence is calibrated on documents that the dictionaries used for it
    were not made from (two folds).  Null labels and texts are left out; without
    both classes every score is the share of toxic labels (0 without any).
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {k: min(1.0, max_docs / n) for k, n in sizes.items()}
    if not {0, 1} <= set(sizes):
        p = min(max(float(1 in sizes), 1e-6), 1 - 1e-6) if sizes else 1e-6
        return Model(b"", b"", (0.0,) * CELLS, 0.0, math.log(p / (1 - p)))
    draw = uniform("__id", seed=SEED)
    chosen = known.filter(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    sample = stored(
        # At most about 2 max_docs ids are sent to every task.
        docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
        .filter(F.col("text").isNotNull())
        .join(F.broadcast(chosen), F.col("doc") == F.col("__id"))
        .select("toxic", "text", F.xxhash64("text").alias("text_hash"))
        .withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "text_hash"), F.lit(2)).cast("int"))
    )
    distinct = sample.groupBy("fold", "toxic").agg(F.countDistinct("text_hash").alias("n")).collect()
    number = {(r.fold, r.toxic): r.n for r in distinct}
    support = stored(_word_support(sample))
    made = {f: _dictionaries(support, number, [1 - f]) for f in (0, 1)}
    parts = sample.select("fold", "toxic", "text")
    counted = parts.mapInArrow(_histogram(made), "toxic INT, cell INT, n BIGINT").groupBy("toxic", "cell").agg(F.sum("n").alias("n"))
    total = np.zeros((2, CELLS))
    for r in counted.collect():  # a row for each class and cell
        total[r.toxic, r.cell] = r.n
    part = total.sum(axis=1) / max(total.sum(), 1)
    evidence = np.log(total[1] + PRIOR * part[1]) - np.log(total[0] + PRIOR * part[0]) - np.log(part[1] / part[0])
    told = parts.mapInArrow(_told(made, evidence), "toxic INT, told DOUBLE").collect()  # a number for each sampled text
    y = np.array([r.toxic for r in told], dtype=float)
    weight = np.where(y == 1, 1 / share[1], 1 / share[0])
    slope, intercept = _logistic(np.array([r.told for r in told]), y, weight)
    toxic, ordinary = _dictionaries(support, number, [0, 1])
    return Model(toxic, ordinary, tuple(evidence.tolist()), slope, intercept)


# --- scoring --------------------------------------------------------------------


def _score(model: Model, others: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = np.array(model.evidence)
        cells = Cells(model.toxic, model.ordinary) if model.toxic else None
        for batch in batches:
            data, offsets = utf8(batch.column(others))
            told = np.zeros(batch.num_rows)
            if cells:
                for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                    told[row] = cells.evidence(data[a:b].tobytes(), evidence)
            p = 1 / (1 + np.exp(-np.clip(model.slope * told + model.intercept, -50, 50)))
            columns = [batch.column(i) for i in range(others)] + [pa.array(told), pa.array(p)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:others], "evidence", "score"])

    return score


def toxicity(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``evidence`` and ``score`` (0 to 1) of every text.

    A null or empty text has no windows and no evidence; its score is what the
    calibration gives for none.  Repeated rows are scored alike.
    """
    kept = docs.select(*keep)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    rows = docs.select(*keep, F.col(text).alias("__text"))
    return rows.mapInArrow(_score(model, len(keep)), f"{schema}evidence DOUBLE, score DOUBLE")
