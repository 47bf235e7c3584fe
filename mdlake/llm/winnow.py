"""Document fingerprints by winnowing.

A text is cut into tokens: runs of at most ``WIDEST`` non-blank code points, and
every code point of a longer run by itself, so that tokens of text without blanks
do not depend on where a run starts.  Hashes of ``GRAM`` (4) consecutive tokens are made by doubling (of
two, then of two pairs), and of every ``WINDOW`` (4) consecutive hashes the
smallest is selected, the rightmost of equal ones.  The fingerprint is the list
of selected hashes with their positions.  Two texts that share 7 consecutive
tokens (4 + 4 - 1) select at least one hash in common, and each selected hash
says where.  A text of fewer tokens than a gram is one gram, of fewer grams than
a window one window; a text without tokens has an empty fingerprint.

Only array functions are used.  Hash and position share one number, 33 bits of
hash above 30 bits of inverted position, so that the smallest number is the
smallest hash and, of equal ones, the rightmost; the full hash is read back by
the position.  Every step is linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.llm.common import WHITE

WIDEST = 16
TOKEN = f"(?<![^{WHITE}])[^{WHITE}]{{1,{WIDEST}}}+(?![^{WHITE}])|[^{WHITE}]"
GRAM = 4
WINDOW = 4
PLACE_BITS = 30  # more tokens than the arrays of one row can hold
LAST_PLACE = (1 << PLACE_BITS) - 1
HASH_BITS = (1 << 33) - 1
PRINT = "ARRAY<STRUCT<hash: BIGINT, position: INT>>"
BUCKETS = 8  # of the order of documents, per shuffle partition


def _paired(values: str, shift: int, combine) -> Column:
    """Each value combined with the one ``shift`` further; null if there is none."""
    left = F.size(values) - shift
    return F.when(
        left > 0,
        F.zip_with(F.slice(values, F.lit(1), left), F.slice(values, F.lit(1 + shift), left), combine),
    )


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds column ``name``: the fingerprint of the texts, null texts as empty ones."""
    body = F.coalesce(F.col(text), F.lit(""))
    kept = rows.columns

    def hashed(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    def smaller(a: Column, b: Column) -> Column:
        return F.least(a, b)

    rows = rows.withColumn("__t", F.regexp_extract_all(body, F.lit(TOKEN), F.lit(0)))
    rows = rows.withColumn("__h", F.transform("__t", lambda t: F.xxhash64(t)))
    rows = rows.withColumn("__2", _paired("__h", 1, hashed))
    short = F.when(F.size("__h") > 0, F.array(F.xxhash64("__h"))).otherwise(F.expr("CAST(array() AS ARRAY<BIGINT>)"))
    rows = rows.withColumn("__4", F.when(F.size("__h") >= GRAM, _paired("__2", 2, hashed)).otherwise(short))
    mark = F.transform(
        "__4",
        lambda h, i: F.shiftleft(h.bitwiseAND(F.lit(HASH_BITS)), PLACE_BITS).bitwiseOR(F.lit(LAST_PLACE).cast("bigint") - i),
    )
    rows = rows.withColumn("__v", mark)
    rows = rows.withColumn("__m", _paired("__v", 1, smaller))
    least = F.when(F.size("__v") >= WINDOW, _paired("__m", 2, smaller)).otherwise(
        F.when(F.size("__v") > 0, F.array(F.array_min("__v"))).otherwise(F.expr("CAST(array() AS ARRAY<BIGINT>)"))
    )
    rows = rows.withColumn("__s", F.array_distinct(least))
    chosen = F.transform(
        F.transform("__s", lambda v: (F.lit(LAST_PLACE).cast("bigint") - v.bitwiseAND(F.lit(LAST_PLACE).cast("bigint"))).cast("int")),
        lambda p: F.struct(F.element_at("__4", p + 1).alias("hash"), p.alias("position")),
    )
    return rows.select(*kept, chosen.alias(name))


def hashes(fingerprint: str | Column) -> Column:
    """The distinct hashes of a fingerprint, without positions."""
    fingerprint = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    return F.array_distinct(F.transform(fingerprint, lambda x: x["hash"]))


def likeness(a: str, b: str) -> Column:
    """Shared among all hashes of two hash lists; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, 1.0).otherwise(both.cast("double") / every.cast("double"))


def digest(fingerprint: str) -> Column:
    """A short name of a fingerprint: 16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.xxhash64(fingerprint)), 16, "0"))


# --- the next document ------------------------------------------------------------


def _bucket(doc_id: Column, bounds: list) -> Column:
    """How many of the sorted bounds are at most the id; a null id comes first."""
    if not bounds:
        return F.lit(0)
    steps, size = [], 1
    while size <= len(bounds):
        steps.insert(0, size)
        size *= 2
    table = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when((at + step <= len(bounds)) & (F.get(table, at + step - 1) <= doc_id), at + step).otherwise(at),
    )
    return F.when(doc_id.isNull(), F.lit(0)).otherwise(found)


def followed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Window]:
    """(bucket, extra, doc_id, text_hash, text) and the window that puts documents in order.

    Documents go by id, nulls first, equal ids by a hash of the text.  Quantiles
    of the ids cut the order into buckets, so the texts are shuffled once; the
    first document of a bucket also stands at the end of the one before
    (``extra``), and that of the first at the end of the last.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = min(4096, BUCKETS * parts)
    quantiles = F.percentile_approx(F.col(doc_id), [i / count for i in range(1, count)], 10 * count)
    bounds = sorted(set(docs.select(quantiles.alias("q")).first().q or []))
    rows = docs.select(
        _bucket(F.col(doc_id), bounds).alias("bucket"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    order = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "text_hash")
    # One row per bucket: its first document, and the bucket that comes before it.
    first = rows.groupBy("bucket").agg(F.min(order).alias("first")).collect()
    first = sorted((r.bucket, r.first.doc_id, r.first.text_hash) for r in first) if first else []
    ends = [(first[i - 1][0], d, h) for i, (_, d, h) in enumerate(first)]
    heads = docs.sparkSession.createDataFrame(ends, "before INT, head_id BIGINT, head_hash BIGINT")
    head = rows["doc_id"].eqNullSafe(heads["head_id"]) & (rows["text_hash"] == heads["head_hash"])
    extra = (
        rows.join(F.broadcast(heads), head)
        .groupBy(F.col("before").alias("bucket"), "doc_id", "text_hash")
        .agg(F.first("text").alias("text"))
        .select("bucket", F.lit(1).alias("extra"), "doc_id", "text_hash", "text")
    )
    every = rows.select("bucket", F.lit(0).alias("extra"), "doc_id", "text_hash", "text").unionByName(extra)
    return every, Window.partitionBy("bucket").orderBy("extra", F.col("doc_id").asc_nulls_first(), "text_hash")


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts and of edited ones, and how alike they are.

    The edited text has the last half of the code points replaced by as many of
    the next document's first (or all it has); after the last document comes
    the first.  Returns (doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next); fingerprints with positions.
    A null text is empty; repeated rows follow each other; an empty table gives
    an empty one; further columns are unused.
    """
    every, order = followed(docs, doc_id, text)
    every = every.withColumn("text", F.coalesce("text", F.lit("")))
    rows = every.withColumn("next_text", F.lead("text").over(order)).withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)
    )
    rows = rows.withColumn("edited", edited).drop("next_text")
    rows = with_fingerprint(rows, "text", "fingerprint").drop("text")
    rows = with_fingerprint(rows, "edited", "edited_fingerprint")
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    rows = rows.withColumn("__own", hashes("fingerprint")).withColumn("__edited", hashes("edited_fingerprint"))
    rows = rows.withColumn("__next", F.lead("__own").over(order)).filter("extra = 0")
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness("__own", "__edited").alias("near_edited"),
        likeness("__own", "__next").alias("near_next"),
    )
