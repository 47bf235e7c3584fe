import numpy as np
import pytest

from mdlake.llm import langid
from mdlake.llm.queries import QUERIES

TEXTS = [("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("der hund und die katze", "de")] * 5


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(spark.createDataFrame(TEXTS, "text STRING, lang STRING"))


def slow_bits(texts, text):
    """Code length of one text by the definition, from counts of the training texts."""
    follow = {}
    for t in texts:
        padded = b"\n\n\n" + t.encode()
        for i in range(3, len(padded)):
            for k in range(4):
                after = follow.setdefault(padded[i - k : i], {})
                after[padded[i]] = after.get(padded[i], 0) + 1
    bits, padded = 0.0, b"\n\n\n" + text.encode()
    for i in range(3, len(padded)):
        for k in (3, 2, 1, 0):
            after = follow.get(padded[i - k : i])
            if after is None:
                continue
            total = sum(after.values()) + len(after)
            if padded[i] in after:
                bits -= np.log2(after[padded[i]] / total)
                break
            bits -= np.log2(len(after) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_are_those_of_the_definition(spark, model):
    samples = ["the dog", "und der chat", "zzz é", "q", "le chien et la katze 123"]
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "doc_id INT, text STRING")
    got = {r.doc_id: r for r in langid.identify(docs, model, ["doc_id"]).collect()}
    for i, text in enumerate(samples):
        want = {lang: slow_bits([t for t, g in TEXTS if g == lang], text) for lang in ("de", "en", "fr")}
        best = min(want, key=want.get)
        assert got[i].lang_pred == best
        assert got[i].bits_per_byte * len(text.encode()) == pytest.approx(want[best], rel=1e-5)
        share = 1 / sum(2 ** -(b - want[best]) for b in want.values())
        assert got[i].score == pytest.approx(share, rel=1e-3)


def test_long_texts_are_scored_in_pieces(spark, model, monkeypatch):
    text = "the cat and der hund " * 50
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    offsets = np.array([0, len(data)])

    def bits(size):
        total = np.zeros(3)
        for part in langid.pieces(offsets, size):
            buffer, starts = langid._padded(data, offsets, part)
            for (_, a, b), at in zip(part, starts):
                total += langid.code_lengths(model, buffer)[at - 3 : at - 3 + b - a].sum(axis=0)
        return total

    assert bits(17) == pytest.approx(bits(1 << 19), rel=1e-6)


def test_bounds_hold_for_each_language(spark):
    """A rare language keeps its grams beside a frequent one, and few huge texts still teach theirs."""
    huge = [("żółw " * 4000, "pl"), ("gęś i jeż " * 3000, "pl")]
    docs = spark.createDataFrame([("the cat and the dog %d" % i, "en") for i in range(300)] + [("le chien", "fr")] + huge, "text STRING, lang STRING")
    small = langid.train(docs, max_train_bytes=60, max_grams=40)
    assert small.languages == ("en", "fr", "pl")
    known = [(small.bits[4][1:, i] < 8.0).sum() for i in range(3)]
    assert all(n > 0 for n in known)
    ask = spark.createDataFrame([(1, "le chien"), (2, "the dog")], "doc_id INT, text STRING")
    assert {r.doc_id: r.lang_pred for r in langid.identify(ask, small, ["doc_id"]).collect()} == {1: "fr", 2: "en"}
    every = langid.train(docs)
    one = spark.createDataFrame([(1, "jeż i żółw")], "doc_id INT, text STRING")
    assert langid.identify(one, every, ["doc_id"]).first().lang_pred == "pl"


def test_odd_rows(odd, odd_rows, model):
    got = langid.identify(odd, model, ["doc_id", "fp"]).collect()
    assert len(got) == len(odd_rows)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {3, 4, 5}
    assert all(0 <= r.score <= 1 for r in got) and all(r.score == 0 for r in got if r.lang_pred == "und")


def test_without_labels_or_rows(odd, none):
    blank = langid.train(none)
    assert {r.lang_pred for r in langid.identify(odd, blank, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(none, blank, ["doc_id"]).count() == 0


def test_held_out_accuracy(spark, sf_dir, documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in QUERIES["op8_language"](spark, sf_dir).collect() if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)
