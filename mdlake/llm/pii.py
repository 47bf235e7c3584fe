"""Personal data: patterns propose spans, checksums confirm, context adjusts a score.

Per kind, one regular expression finds leftmost non-overlapping candidates in
the whole text; splitting the text by the same expression gives the stretches in
between, whose lengths place every candidate.  Validators drop candidates (parts
of an address, Luhn, the mod-97 check of account numbers, numbers of digits).
Each span has a score: what the kind is worth, more after a word that announces
it, less after one that speaks against it.

Only DataFrame functions are used, and nothing is shuffled.  The expressions use
possessive repeats and start only where a candidate can start, and places come
from running sums by doubling, so time grows with the length of a text (and n log
n in its n matches) whatever it holds; cheap tests spare texts that cannot hold a
kind the expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = "A-Za-z0-9._%+-"
LABEL = "[A-Za-z0-9-]++"
CONTEXT = 40  # code points before a span in which its words count
HINT, DOUBT = 0.2, 0.2
LEAST_SCORE = 0.5  # of kinds that the method adds


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _has_digits(least: int, most: int) -> Callable[[Column], Column]:
    return lambda match: F.length(_digits(match)).between(least, most)


def _address(match: Column) -> Column:
    """Four numbers of at most 255, leading zeros allowed."""
    part = r"0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2}|)"
    return match.rlike(rf"^(?=[0-9]){part}(?:\.(?=[0-9]){part}){{3}}$")


def _luhn(match: Column) -> Column:
    each = F.transform(F.split(F.reverse(_digits(match)), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    total = F.aggregate(doubled, F.lit(0), lambda n, d: n + F.coalesce(d, F.lit(0)))
    return _has_digits(14, 19)(match) & (total % 10 == 0)


def _mod97(match: Column) -> Column:
    """An international account number: 15 to 34 signs that leave 1 modulo 97."""
    compact = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(compact, 5, 34), F.substring(compact, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda n, c: F.when(c == "", n)
        .when(c <= "9", (n * 10 + F.ascii(c) - 48) % 97)
        .otherwise((n * 100 + F.ascii(c) - 55) % 97),
    )
    return F.length(compact).between(15, 34) & (rest == 1)


# Fixed value: signs of an account number by country (ISO 13616 registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _account_numbers() -> str:
    """A country, two check digits and as many signs as its numbers have; blanks may stand between.

    The number ends there, also where a capital or digit follows after a blank.
    Other countries: the whole run.
    """
    known = "|".join(
        rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{signs - 4}}}+" for signs, names in IBAN_LENGTHS.items()
    )
    listed = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    other = rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}+"
    return rf"(?<![A-Za-z0-9])(?:{known}|{other})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    """What to look for; ``base`` kinds are kept whatever their score."""

    name: str
    pattern: str
    possible: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    worth: float
    hints: str
    base: bool = True


# Kinds in the order that breaks ties of start.
KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@{LABEL}(?:\.{LABEL})++",
        lambda t: F.contains(t, F.lit("@")),
        lambda m: F.lit(True),
        0.9,
        "mail|write|contact",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        _address,
        0.6,
        "ip|host|server|address",
    ),
    Kind(
        "card",
        r"(?=[0-9](?:[ -]?[0-9]){13})[0-9]++(?:[ -][0-9]++)*+",
        lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){13}"),
        _luhn,
        0.7,
        "card|visa|master|credit|payment",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        _has_digits(10, 15),
        0.6,
        "phone|tel|call|mobile|fax",
    ),
    Kind(
        "iban",
        _account_numbers(),
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]"),
        _mod97,
        0.8,
        "iban|account|konto|bank",
        base=False,
    ),
)
DOUBTS = "version|order|invoice|serial|isbn"

SPAN = "STRUCT<kind: STRING, start: INT, end: INT, score: DOUBLE, base: BOOLEAN, rank: INT>"
NONE = f"CAST(array() AS ARRAY<{SPAN}>)"


def _running(lengths: Column) -> Column:
    """Running sums, by doubling: n log n steps, where appending to an array would copy it each time."""

    def double(sums: Column, k: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), k)
        ahead = F.concat(F.array_repeat(F.lit(0), step), F.slice(sums, F.lit(1), F.size(sums) - step))
        return F.zip_with(sums, ahead, lambda x, y: x + y)

    # The binary digits of n - 1 are as many as the rounds that n sums take.
    rounds = F.sequence(F.lit(0), F.length(F.bin(F.size(lengths) - 1)) - 1)
    return F.aggregate(rounds, lengths, double)


def _located(parts: str, rank: int, kind: Kind) -> Column:
    """Spans of one kind from its matches and the stretches between them."""
    matches = F.col(f"{parts}.matches")
    pieces = F.slice(F.col(f"{parts}.pieces"), F.lit(1), F.size(matches))
    ends = _running(F.zip_with(pieces, matches, lambda p, m: F.length(p) + F.length(m)))
    found = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), ends.alias("end"))

    def place(x: Column) -> Column:
        near = F.lower(F.right(x["piece"], F.lit(CONTEXT)))
        score = (
            F.lit(kind.worth)
            + F.when(near.rlike(rf"\b(?:{kind.hints})"), HINT).otherwise(0.0)
            - F.when(near.rlike(rf"\b(?:{DOUBTS})"), DOUBT).otherwise(0.0)
        )
        score = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
        span = F.struct(
            F.lit(kind.name).alias("kind"),
            (x["end"] - F.length(x["match"])).alias("start"),
            x["end"].alias("end"),
            score.alias("score"),
            F.lit(kind.base).alias("base"),
            F.lit(rank).alias("rank"),
        )
        return F.when(kind.valid(x["match"]) if kind.base else kind.valid(x["match"]) & (score >= LEAST_SCORE), span)

    spans = F.filter(F.transform(found, place), lambda s: s.isNotNull())
    return F.when(F.col(parts).isNotNull() & (F.size(matches) > 0), spans.cast(f"ARRAY<{SPAN}>")).otherwise(F.expr(NONE))


def find(docs: DataFrame, keep: list[str], text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The ``keep`` columns and ``spans`` of every text, by start and kind.

    A span is (kind, start, end, score, base): code points, end exclusive.
    ``base`` tells a kind whose spans are kept at any score.  A null text is
    empty and has none; repeated rows are searched alike.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    parts = [
        F.when(
            kind.possible(body),
            F.struct(
                F.split(body, kind.pattern, -1).alias("pieces"),
                F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0)).alias("matches"),
            ),
        ).alias(f"__{i}")
        for i, kind in enumerate(kinds)
    ]
    rows = docs.select(*keep, *parts)
    spans = F.concat(*[_located(f"__{i}", i, kind) for i, kind in enumerate(kinds)])
    order = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["score"], s["base"]),
        )
    )
    return rows.select(*keep, order.alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
