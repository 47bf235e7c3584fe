import numpy as np
import xxhash

from mdlake.llm import simhash
from mdlake.llm.components import components
from mdlake.llm.queries import QUERIES

import __spark_entry__ as entry_points


def slow_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints, radius=3):
    """Smallest reachable doc_id by comparing all pairs."""
    values = sorted(set(prints.values()))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for doc, v in prints.items():
        least[find(v)] = min(least.get(find(v), doc), doc)
    return {doc: least[find(v)] for doc, v in prints.items()}


def test_query_against_brute_force(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op1_simhash"](spark, sf_dir).collect()}
    prints = {r.doc_id: slow_print(r.text) for r in documents.collect()}
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{v:016x}" for d, v in prints.items()}
    assert {d: r.component_id for d, r in got.items()} == slow_classes(prints)


def test_odd_rows(odd, odd_rows):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    prints = {r.doc_id: r.fp % (1 << 64) for r in got if r.doc_id is not None}
    assert prints == {r[0]: slow_print(r[1]) for r in odd_rows if r[0] is not None}
    classes = {r.doc_id: r.component_id for r in got}
    assert classes[2] == 1 and {classes[i] for i in (3, 4, 5)} == {3}
    assert classes[7] == 6
    assert classes[None] is None


def test_empty(none):
    assert simhash.near_duplicates(none).count() == 0


def test_texts_cut_into_pieces(monkeypatch):
    text = ("alpha beta\tgamma\n" * 500 + "omega").encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(text) == whole


def test_bit_sliced_distances():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    values = np.unique(np.concatenate([base, base[:50] ^ np.uint64(7), base[:50] ^ np.uint64(15)]))
    planes = simhash.bit_planes(values)
    valid = np.zeros(planes.shape[1] * 64, dtype=bool)
    valid[: len(values)] = True
    masks = simhash.within(values, planes, np.packbits(valid, bitorder="little").view("<u8"), 3)
    near = np.unpackbits(masks.view(np.uint8).reshape(len(values), -1), axis=1, bitorder="little").astype(bool)
    want = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    assert (near[:, : len(values)] == want).all()


def test_hot_bucket_in_chunks(spark):
    """Thousands of fingerprints that agree in two blocks, dealt over chunk pairs."""
    rng = np.random.default_rng(4)
    values = {int(v) for v in rng.integers(0, 1 << 11, 700)}
    rows = spark.createDataFrame([(v,) for v in values], "fp BIGINT")
    want = slow_classes({v: v for v in values})
    for size in (16, 4096):
        found = {r.node: r.root for r in components(simhash.links(rows, bucket_rows=size)).collect()}
        assert {v: found.get(v, v) for v in values} == want


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(None, 3), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in entry_points.queries()}
    assert "pipeline" in entry_points.queries()
