import pytest
from pyspark.sql import functions as F

from mdlake.llm import urls
from mdlake.llm.urls import host_of, path_of, rule_of

CASES = [
    ("http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("https://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("x://y.com/fr/://z.org/", "y.com", "/fr/://z.org/", "com/fr/", "allow"),
    ("http://y.com/de/", "y.com", "/de/", "com/de/", "block"),
    ("http://y.org?x=/es/", "y.org", "", None, None),
    ("no scheme", "", "", None, None),
    (None, "", "", None, None),
    ("http://", "", "", None, None),
]


@pytest.mark.parametrize("url,host,path,rule,verdict", CASES)
def test_parts_and_rules(spark, url, host, path, rule, verdict):
    row = spark.createDataFrame([(url,)], "url STRING").select(host_of("url").alias("host"), path_of("url").alias("path"))
    got = row.select("*", rule_of("host", "path").alias("r")).first()
    assert (got.host, got.path) == (host, path)
    assert (got.r and got.r.rule, got.r and got.r.verdict) == (rule, verdict)


def test_trust_and_distrust_travel(spark):
    def page(i, host, *to):
        return (i, f"http://{host}/", "".join(f'<a HREF="{t}">' for t in to), "x")

    rows = [
        page(1, "good.org", "http://near.net/a", "/own"),
        page(2, "near.net", "//far.net/b"),
        page(3, "far.net"),
        (4, "http://bad.com/de/1", None, "x"),
        page(5, "shady.net", "https://bad.com/"),
        page(6, "lonely.net"),
        (7, None, "<a href=http://bad.com>", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, verdict STRING")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    assert {i: r.verdict for i, r in got.items()} == {
        1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow", 7: "allow",
    }
    assert got[2].trust > got[3].trust > 0 and got[5].distrust > 0
    assert urls.judge(pages.limit(0)).count() == 0


def test_ranks_by_power_iteration(spark):
    edges = [("a", "b", 2.0), ("a", "a", 1.0), ("b", "c", 1.0), ("c", "a", 1.0)]
    got = urls.personalised_rank(
        spark.createDataFrame(edges, "src STRING, dst STRING, n DOUBLE"),
        spark.createDataFrame([("a", 3.0), ("c", 1.0)], "host STRING, weight DOUBLE"),
    )
    rank = seed = {"a": 0.75, "b": 0.0, "c": 0.25}
    for _ in range(300):
        rank = {
            "a": 0.15 * seed["a"] + 0.85 * (rank["a"] / 3 + rank["c"]),
            "b": 0.85 * rank["a"] * 2 / 3,
            "c": 0.15 * seed["c"] + 0.85 * rank["b"],
        }
    assert {r.host: r.rank for r in got.collect()} == pytest.approx(rank, rel=1e-5)


def test_far_hosts_and_small_seeds(spark):
    """Forty links into one blocked page among 100,000 seeds; nothing is out of reach."""
    chain = [(f"h{i}.net", f"h{i + 1}.net", 1.0) for i in range(40)] + [("h40.net", "bad.com", 1.0)]
    edges = spark.createDataFrame(chain + [("h7.net", "h7.net", 3.0)], "src STRING, dst STRING, n DOUBLE")
    judged = spark.range(100_000).select(
        F.when(F.col("id") == 0, "bad.com").otherwise("worse.com").alias("host"), F.lit("block").alias("verdict")
    )
    judged = judged.union(spark.createDataFrame([("good.org", "allow"), ("h3.net", None)], "host STRING, verdict STRING"))
    got = {r.host: r for r in urls.host_verdicts(judged, edges).collect()}
    mass = 1e-5
    for i in range(40, -1, -1):
        # Backwards, h7 is entered from h8 and by itself.
        mass *= 0.85
        here = got[f"h{i}.net"]
        stay = 0.25 if i == 6 else 1.0  # a quarter of what h7 passes on goes to h6
        if i == 6:
            mass *= stay / (1 - 0.85 * 0.75)
        rank = mass * 0.15 / (1 - 0.85 * 0.75) if i == 7 else mass * 0.15
        assert here.distrust == pytest.approx(rank, rel=1e-4) and here.verdict == "block"
    assert got["good.org"].verdict == "allow" and got["worse.com"].verdict == "block"


def test_odd_tables(spark):
    """No pages, null columns, repeated rows and extra columns named like the operator's own."""
    schema = "page_id BIGINT, url STRING, html STRING, host STRING, path STRING, rank DOUBLE, trust DOUBLE, src STRING, found STRING"
    rows = [
        (1, "http://a.com/fr/", "<a href=//b.net>", "x", "x", 1.0, 1.0, "s", "f"),
        (1, "http://a.com/fr/", "<a href=//b.net>", "x", "x", 1.0, 1.0, "s", "f"),
        (2, "http://b.net/", None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None),
        (3, "", "", "", "", 0.0, 0.0, "", ""),
        (4, "http://c.net/" + "x" * 100_000, "<a href=http://d.com/de/>" * 5000, "x", "x", 1.0, 1.0, "s", "f"),
        (5, "http://d.com/de/", None, "x", "x", 1.0, 1.0, "s", "f"),
    ]
    pages = spark.createDataFrame(rows, schema)
    got = sorted((r.page_id or 0, r.host, r.verdict) for r in urls.judge(pages).collect())
    assert got == [
        (0, "", "allow"), (1, "a.com", "allow"), (1, "a.com", "allow"), (2, "b.net", "allow"), (3, "", "allow"),
        (4, "c.net", "block"), (5, "d.com", "block"),
    ]
    assert urls.judge(pages.limit(0)).count() == 0
    only_names = pages.filter("page_id IS NULL")
    assert [r.verdict for r in urls.judge(only_names).collect()] == ["allow"]
