"""Number and JSON parsing as built-in column expressions.

Venue numbers arrive as text.  Spark's own cast is more lenient than the
collector's parser (it trims blanks, accepts a ``d``/``f`` suffix and turns an
overflowing literal into infinity), so every cast here is guarded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The spellings of non-finite numbers that are accepted.
NON_FINITE_WORDS = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan"]

CORRUPT = "_corrupt"


def parse_strict(text: Column) -> Column:
    """Text to DOUBLE; NULL when the text is not exactly one number.

    The guard looks at the first and last character only (cheaper than a full
    regular expression): between them they exclude blanks, suffix letters and
    words, and ``try_cast`` rejects everything else that is malformed.
    """
    number = text.try_cast("double")
    digits = list("0123456789")
    edges_ok = F.substring(text, 1, 1).isin([*digits, "+", "-", "."]) & F.substring(text, -1, 1).isin([*digits, "."])
    finite = F.abs(number) < F.lit(float("inf"))
    word = F.lower(text)
    return F.when(edges_ok & finite, number).when(word.isin(NON_FINITE_WORDS), word.try_cast("double"))


def parse_or_zero(text: Column) -> Column:
    """Text to DOUBLE; blank, missing or malformed text becomes 0.0."""
    return F.coalesce(parse_strict(text), F.lit(0.0))


def parse_long(text: Column) -> Column:
    """Text to BIGINT; NULL unless it is an optionally signed run of digits."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def plain_decimal(shortest: Column) -> Column:
    """The text of a DOUBLE without exponent and trailing zeros.

    Works on the digits alone, so no size of number is out of range: ``1.5E-19``
    becomes ``0.00000000000000000015``, ``1.0E21`` a one and 21 zeros.
    """
    sign = F.regexp_extract(shortest, "^(-?)", 1)
    whole = F.regexp_extract(shortest, "^-?([0-9]+)", 1)
    part = F.regexp_replace(F.regexp_extract(shortest, r"\.([0-9]+)", 1), "0+$", "")
    power = F.coalesce(F.regexp_extract(shortest, "E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    digits = F.concat(whole, part)
    point = F.length(whole) + power  # digits before the point
    moved = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits), F.rpad(digits, point, "0"))
        .otherwise(F.concat(F.left(digits, point), F.lit("."), F.right(digits, F.length(digits) - point)))
    )
    moved = F.regexp_replace(F.regexp_replace(moved, r"^0+(?=[0-9])", ""), r"(\.[0-9]*?)0+$", "$1")
    moved = F.regexp_replace(moved, r"\.$", "")
    return F.when(shortest.rlike("^-?[0-9]"), F.concat(sign, moved)).otherwise(shortest)


def leading_number(text: Column) -> Column:
    """The number at the start of a header value (``120-110`` gives 120)."""
    return parse_strict(F.regexp_extract(text, r"^\s*([+-]?[0-9.]+)", 1))


def decode_json(data: Column, ddl: str, renamed: str | None = None) -> Column:
    """Parse JSON text with a fixed schema.

    ``struct._corrupt`` is set when the text is not JSON or any declared field
    has the wrong type, which is how callers drop the whole message.

    JSON keys are matched with their letter case, but column fields are not, so
    payloads with both ``u`` and ``U`` give ``renamed``: the same schema, field
    by field, under distinct names.
    """
    schema = f"{ddl}, {CORRUPT} STRING"
    parsed = F.from_json(data, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    if renamed is None:
        return parsed
    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(renamed))
    return parsed.cast(f"STRUCT<{fields}, {CORRUPT}: STRING>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A filter written over a projected column is pushed below the projection and
    repeats its expression at every mention; a lambda variable is not repeated.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unnest(df: DataFrame, kept: Sequence[str | Column], rows: Column) -> DataFrame:
    """One output row per non-null struct of the array ``rows``.

    The array is computed in its own projection (compiled code) and dropped rows
    are filtered after the explode.  A filter before it, or the one Spark infers
    for a plain ``explode``, would be pushed below the JSON decode and repeat it.
    """
    names = [c if isinstance(c, str) else df.select(c).columns[0] for c in kept]
    return (
        df.select(*kept, rows.alias("_rows"))
        .select(*names, F.explode_outer("_rows").alias("_row"))
        .filter(F.col("_row").isNotNull())
        .select(*names, "_row.*")
    )


def is_clean(parsed: Column) -> Column:
    return parsed.isNotNull() & parsed[CORRUPT].isNull()


def text_or_blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def long_or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))
