import zlib

import numpy as np
import pytest

from mdlake.llm import toxicity
from mdlake.llm.queries import QUERIES

BAD, GOOD = "vile rotten nasty crooked".split(), "calm river stone meadow light paper window garden".split()


def texts(n, toxic, seed):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = [f"{rng.choice(GOOD)}{rng.integers(50)}" for _ in range(60)]
        if toxic:
            for _ in range(4):
                words.insert(int(rng.integers(60)), str(rng.choice(BAD)) + ",")
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t) for i, t in enumerate(texts(120, False, 1) + texts(60, True, 2))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, int(i >= 120)) for i in range(180)] + [(999, None), (None, 1)], "doc_id BIGINT, toxic INT")
    return toxicity.train(docs, labels)


def test_held_out_texts(spark, model):
    rows = [(i, t) for i, t in enumerate(texts(100, False, 3) + texts(100, True, 4))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    score = {r.doc_id: r.score for r in toxicity.toxicity(docs, model, ["doc_id"]).collect()}
    assert sum(score[i] < 0.5 for i in range(100)) >= 97
    assert sum(score[i] >= 0.5 for i in range(100, 200)) >= 97


def test_every_word_is_in_one_window(monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE", 32)
    text = " ".join(f"word{i}" for i in range(200))
    assert b"".join(toxicity.windows(text.encode())).split() == text.encode().split()


def test_odd_rows(odd, odd_rows, model):
    got = toxicity.toxicity(odd, model, ["doc_id"]).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.evidence == 0 for r in got if r.doc_id in (3, 4, 5))


def test_without_labels_or_rows(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    blank = toxicity.train(odd, labels)
    assert all(r.score < 0.5 for r in toxicity.toxicity(odd, blank, ["doc_id"]).collect())
    assert toxicity.toxicity(none, blank, ["doc_id"]).count() == 0


def test_query_holds_a_fifth_out(spark, sf_dir):
    got = QUERIES["op2_toxicity"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)


def test_training_on_clashing_columns_and_accented_capitals(spark):
    """Columns of the documents named like the training's own, words with capitals beyond A-Z."""
    rows = [(i, t, "k", "d", "i", 9) for i, t in enumerate(texts(120, False, 1) + [t.replace("vile", "\u00c4RG") for t in texts(60, True, 2)])]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic STRING, doc STRING, __id STRING, fold INT")
    labels = spark.createDataFrame([(i, int(i >= 120)) for i in range(180)], "doc_id BIGINT, toxic INT")
    made = toxicity.train(docs, labels)
    assert "\u00c4rg".encode() in made.toxic
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(docs, made, ["doc_id", "toxic"]).collect())


def test_a_word_seen_before_costs_a_look_up(monkeypatch):
    """Words are stripped once for each spelling; punctuation around does not compress a word again; long words stay whole."""
    text = b"calm Vile, (vile) " * 400 + b"x" * 1300 + b" ... calm"
    stripped, asked = [], []
    one = toxicity._windows_of
    monkeypatch.setattr(toxicity, "_windows_of", lambda run: stripped.append(run) or one(run))
    cells = toxicity.Cells(b" vile rotten " + toxicity.END, b" calm river " + toxicity.END)
    press = cells.toxic
    cells.toxic = lambda window: asked.append(window) or press(window)
    got = np.concatenate(list(cells.blocks(text)))
    assert len(stripped) == len(set(stripped)) == 5
    assert len(asked) == len(set(asked)) == 6
    fresh = toxicity.Cells(b" vile rotten " + toxicity.END, b" calm river " + toxicity.END)
    assert got.tolist() == [fresh._of(w) for w in toxicity.windows(text)]
