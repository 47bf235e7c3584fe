import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from mdlake.llm import merkle
from mdlake.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def slow(leaves):
    """{key: (leaf, subroot, root, proof)} of (group, key, leaf); proof steps are (place, others)."""
    groups = {}
    for group, key, leaf in sorted(leaves, key=lambda x: (x[1] is not None, x[1] or 0, x[2])):
        groups.setdefault(group, []).append((key, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf for _, leaf in groups[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for place, group in enumerate(names):
        for rank, (key, leaf) in enumerate(groups[group]):
            proof = []
            for tree, at in ((trees[group], rank), (top, place)):
                for level in tree[:-1]:
                    run = level[at & ~1 : (at & ~1) + 2]
                    proof.append((at & 1, [h for j, h in enumerate(run) if j != at & 1]))
                    at >>= 1
            out.append((group, key, leaf, trees[group][-1][0], top[-1][0], proof))
    return out


def folded(leaf, proof):
    for place, others in proof:
        leaf = sha("".join([*others[:place], leaf, *others[place:]]))
    return leaf


def digest(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def found(leaves, wanted=None):
    made = merkle.manifest(leaves)
    return merkle.prove(made, wanted(made) if wanted else None).withColumn("folded", merkle.fold("leaf")).collect()


def test_query_against_brute_force(spark, sf_dir, documents):
    rows = documents.collect()
    changed = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 0 for r in rows}
    want = {}
    values = {r.doc_id: (r.source, r.lang, r.n_chars, r.text) for r in rows}
    for _, key, leaf, subroot, root, proof in slow([(r.lang, r.doc_id, digest(r.doc_id, *values[r.doc_id])) for r in rows]):
        source, lang, n_chars, text = values[key]
        start = digest(key, source, lang, n_chars + 1, text) if changed[key] else leaf
        end = folded(start, proof)
        want[key] = (leaf, subroot, root, sha("".join(h for _, o in proof for h in o)), end, end == root)
    got = QUERIES["op13_merkle"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert all(r.verified != changed[r.doc_id] for r in got)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_shapes(spark, monkeypatch, bits):
    """Groups of 1 to 33 leaves, the null group among them, in segments of any height."""
    monkeypatch.setattr(merkle, "BITS", bits)
    sizes = {None: 5, "": 1, "a": 2, "b": 3, "é": 33, "z": 17}
    rows = [(g, i, sha(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    got = found(spark.createDataFrame(rows, "lang STRING, doc_id BIGINT, leaf STRING").repartition(5))
    want = {(g, k): rest for g, k, *rest in slow(rows)}
    assert len(got) == len(rows)
    for r in got:
        leaf, subroot, root, proof = want[r.row.lang, r.row.doc_id]
        assert (r.leaf, r.subroot, r.root, r.folded) == (leaf, subroot, root, root)
        assert r.digits == [place for place, _ in proof]
        assert r.siblings == [others[0] if others else None for _, others in proof]


def test_one_leaf_and_none(spark, none):
    one = found(spark.createDataFrame([("a", 1, sha("x"))], "lang STRING, doc_id BIGINT, leaf STRING"))
    assert [(r.leaf, r.subroot, r.root, r.siblings, r.folded) for r in one] == [(sha("x"), sha("x"), sha("x"), [], sha("x"))]
    assert found(none.withColumn("leaf", F.lit("x"))) == []


def test_odd_rows(odd, odd_rows):
    """Null ids and languages, repeated rows and clashing columns: every row is a leaf and proves itself."""
    leaves = odd.withColumn("leaf", merkle.leaf_digest("doc_id", "source", "lang", "n_chars", "text"))
    leaves = leaves.withColumnsRenamed({"fp": "digest", "row": "tree", "score": "rank"})
    got = found(leaves)
    rows = [(r[2], r[0], digest(r[0], r[3], r[2], r[4], r[1])) for r in odd_rows]
    assert sorted(r.leaf for r in got) == sorted(leaf for _, _, leaf in rows)
    root = slow(rows)[0][4]
    assert {r.root for r in got} == {root} == {r.folded for r in got}
    assert {(r.row.digest, r.row.tree, r.row.rank) for r in got} == {("f", "r", "s")}


def test_repeated_rows_share_records(spark):
    rows = [("a", 1, sha("x"))] * 64
    leaves = spark.createDataFrame(rows, "lang STRING, doc_id BIGINT, leaf STRING")
    made = merkle.manifest(leaves)
    assert made.store().count() == 6
    assert {tuple(r.digits) for r in merkle.prove(made).collect()} == {tuple(i >> j & 1 for j in range(6)) for i in range(64)}


def test_some_requests(spark):
    rows = [("a" if i % 3 else "b", i, sha(str(i))) for i in range(100)]
    leaves = spark.createDataFrame(rows, "lang STRING, doc_id BIGINT, leaf STRING")
    got = found(leaves, lambda made: made.nodes.filter("row.doc_id IN (0, 7, 99)"))
    assert {r.row.doc_id for r in got} == {0, 7, 99} and all(r.folded == r.root for r in got)


def test_digest_of_fields(spark):
    row = spark.createDataFrame([(7, None, "é")], "a BIGINT, b STRING, c STRING").select(merkle.leaf_digest("a", "b", "c"))
    assert row.first()[0] == sha("1:7-2:é")
