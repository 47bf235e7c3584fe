"""URL filters: rules first, then propagation over the graph of hosts.

A rule names a host and a path prefix; it fits the host's subdomains too, and
the longest fitting rule decides.  Pages without a rule are judged by their
host.  Pages that rules allow are seeds of trust, pages that rules block seeds
of distrust.  Trust follows links (personalised PageRank from the allowed
seeds), distrust follows them backwards (a host that links to bad ones is
suspect), and a host whose share of distrust is above its share of trust is
blocked.

Edges are links between hosts in the pages, weighted by count; a relative link
is a link of the host to itself, and the walk's stay there is summed in closed
form.  The walk goes on until no host holds back more than a millionth of what it
passed on: the rule is relative to each host, so neither the distance from a seed
nor the number of seeds puts a host out of reach (a rank ends only where doubles
do, near 1e-308).  Only DataFrame functions are used; a round is a join on the
host and a sum, so a hub is aggregated like any other host, and each round is cut
off by a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import LOWER, UPPER, stored

# Verdict, host and path prefix of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
SETTLED = 1e-6  # what a host may still hold back, as a share of what it passed on
THRESHOLD = 1.0  # distrust over trust from which a host is blocked
EVEN = 1e-4  # distrust above the threshold by no more than this share of it does not count


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: str, path: str, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        own = (F.col(host) == name) | F.col(host).endswith("." + name)
        fits = own & F.col(path).startswith(prefix)
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(src, dst, n): links between hosts, those within a host included."""
    links = F.regexp_extract_all(F.col(html), F.lit(r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"), F.lit(1))
    found = pages.select(F.col(host).alias("src"), F.explode(links).alias("link"))
    absolute = F.col("link").rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//")
    whole = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    dst = F.when(absolute, host_of(whole)).otherwise(F.col("src"))
    return (
        found.select("src", dst.alias("dst"))
        .filter((F.col("src") != "") & (F.col("dst") != ""))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )


def personalised_rank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """(host, rank) of the walk that starts and restarts at the seeds (host, weight).

    rank = (1 - d) seed + d * inflow, where a host without links passes nothing on.
    ``waiting`` is mass that has come to a host, ``gone`` mass that it passed on;
    every round the hosts whose waiting mass is above ``settled`` of the gone pass
    theirs on, until there are none.  Round k moves at most d^k of the mass, so
    about log(settled) / log(d) rounds follow after the last host is reached, and
    none where hosts link only to themselves.
    """
    total = seeds.agg(F.sum("weight")).first()[0] or 1.0
    out = edges.groupBy("src").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("src") == F.col("dst"), F.col("n")).otherwise(0.0)).alias("own"))
    # Of mass at a host, 1 - d ends there; a link to itself brings d * own / all back, again and again.
    kept = F.lit(1.0) - damping * F.col("own") / F.col("all")
    shares = edges.filter("src <> dst").join(out, "src").select("src", "dst", (damping * F.col("n") / F.col("all") / kept).alias("share"))
    shares = stored(shares)
    state = seeds.select("host", F.lit(0.0).alias("gone"), (F.col("weight") / F.lit(total)).alias("waiting"))
    state = stored(state)
    moves = F.col("waiting") > settled * F.col("gone")
    while True:
        moved = (
            state.filter(moves)
            .join(shares, F.col("host") == F.col("src"))
            .groupBy("dst")
            .agg(F.sum(F.col("waiting") * F.col("share")).alias("waiting"))
            .select(F.col("dst").alias("host"), F.lit(0.0).alias("gone"), "waiting")
        )
        stays = state.select(
            "host",
            F.when(moves, F.col("gone") + F.col("waiting")).otherwise(F.col("gone")).alias("gone"),
            F.when(moves, 0.0).otherwise(F.col("waiting")).alias("waiting"),
        )
        sums = [F.sum(c).alias(c) for c in ("gone", "waiting")]
        state = stored(stays.unionByName(moved).groupBy("host").agg(*sums))
        if state.filter(moves).isEmpty():
            break
    ends = out.select(F.col("src").alias("host"), (F.lit(1 - damping) / kept).alias("ends"))
    came = F.col("gone") + F.col("waiting")
    return state.join(ends, "host", "left").select("host", (came * F.coalesce("ends", F.lit(1 - damping))).alias("rank"))


def host_verdicts(judged: DataFrame, edges: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, trust, distrust, verdict) of every host that pages or links name.

    ``judged`` has (host, verdict) of the pages, null where no rule fits.  Sums of
    doubles differ in their last digits by run, and ranks are exact to about
    ``SETTLED`` a link, so shares that agree to ``EVEN`` count as equal: allowed.
    """
    seeds = stored(
        judged.filter("verdict IS NOT NULL AND host <> ''")
        .groupBy("host", "verdict")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    edges = stored(edges)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = personalised_rank(edges, seeds.filter("verdict = 'allow'").select("host", "weight"))
    distrust = personalised_rank(back, seeds.filter("verdict = 'block'").select("host", "weight"))
    ranks = (
        trust.select("host", F.col("rank").alias("trust"), F.lit(0.0).alias("distrust"))
        .unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("rank").alias("distrust")))
        .groupBy("host")
        .agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    )
    blocked = F.col("distrust") > F.col("trust") * (threshold * (1 + EVEN))
    return ranks.withColumn("verdict", F.when(blocked, "block").otherwise("allow"))


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page.

    A null url, or one without ``://``, has an empty host and path and no rule.
    A host that neither trust nor distrust reaches is allowed, as are pages
    without a host.  Repeated rows each come back; null html has no links; an
    empty table gives an empty one; further columns are unused.
    """
    rows = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"), "html")
    ruled = rows.withColumn("found", rule_of("host", "path", rules))
    hosts = host_verdicts(ruled.select("host", F.col("found.verdict").alias("verdict")), host_edges(rows))
    hosts = hosts.withColumnRenamed("verdict", "host_verdict")
    return ruled.join(hosts, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
