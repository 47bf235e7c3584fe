import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mdlake.operators import batching, flushing
from mdlake.operators.batching import NEVER, Limits, Open, StateMap, number_run


def sequential(limits, ms, rows):
    """The batches one after another, message by message."""
    state, number, out = None, -1, []
    for t, n in zip(ms, rows):
        if state is None or state[0] >= limits.rows or t >= state[1] + limits.age_ms or t - state[2] > limits.idle_ms:
            state, number = [0, t, t], number + 1
        state[0] += n
        state[2] = t
        out.append(number)
    return out


def test_cut_runs_equal_the_sequential_loop():
    rng = random.Random(7)
    for _ in range(1500):
        n = rng.randint(1, 60)
        ms = np.sort(np.array([rng.randint(0, rng.choice([20, 200])) for _ in range(n)], dtype=np.int64))
        rows = np.array([rng.randint(1, 5) for _ in range(n)], dtype=np.int64)
        limits = Limits(rng.choice([NEVER, 1, 3, 7, 20]), rng.choice([NEVER, 1, 5, 30]), rng.choice([NEVER, 0, 2, 9]))
        want = sequential(limits, ms, rows)
        cuts = sorted(rng.sample(range(1, n), min(n - 1, rng.randint(0, 5)))) if n > 1 else []
        state, got = Open(), []
        for low, high in zip([0, *cuts], [*cuts, n]):
            inside = Open(**vars(state))
            got += number_run(inside, limits, ms[low:high], rows[low:high]).tolist()
            StateMap.of_run(limits, ms[low:high], rows[low:high]).apply(limits, state)
            assert vars(state) == vars(inside)
        assert got == want


def test_maps_compose_in_any_order():
    """The map of a run is the composition of its parts, however they are grouped."""
    rng = random.Random(11)
    for _ in range(800):
        n = rng.randint(3, 50)
        ms = np.sort(np.array([rng.randint(0, rng.choice([20, 300])) for _ in range(n)], dtype=np.int64))
        rows = np.array([rng.randint(0, 4) for _ in range(n)], dtype=np.int64)
        limits = Limits(rng.choice([NEVER, 1, 4, 15]), rng.choice([NEVER, 1, 6, 40]), rng.choice([NEVER, 0, 3, 12]))
        a, b = sorted(rng.sample(range(1, n), 2))
        x, y, z = (StateMap.of_run(limits, ms[i:j], rows[i:j]) for i, j in ((0, a), (a, b), (b, n)))
        left, right = x.then(limits, y).then(limits, z), x.then(limits, y.then(limits, z))
        first = int(ms[0])
        entries = [Open()] + [Open(rng.randint(0, 16), first - rng.randint(0, 40), first - rng.randint(0, 13), 5) for _ in range(6)]
        for entry in entries:
            ends = []
            for path in ([x, y, z], [left], [right]):
                state = Open(**vars(entry))
                for step in path:
                    step.apply(limits, state)
                ends.append(vars(state))
            inside = Open(**vars(entry))
            number_run(inside, limits, ms, rows)
            assert ends == [vars(inside)] * 3


def test_maps_stay_small():
    """A map has as many classes as rows or milliseconds fit in a batch, however long the run."""
    rng = np.random.default_rng(5)
    ms = np.sort(rng.integers(0, 10_000_000, 50_000))
    rows = rng.integers(1, 9, 50_000)
    assert len(StateMap.of_run(Limits(rows=100), ms, rows).exit_rows) <= 101
    aged = [StateMap.of_run(Limits(age_ms=3000), ms[i : i + 1000], rows[i : i + 1000]) for i in range(0, 50_000, 1000)]
    whole = aged[0]
    for more in aged[1:]:
        whole = whole.then(Limits(age_ms=3000), more)
        assert len(whole.exit_rows) <= 3001


def messages(spark, seed=3, n=4000):
    """Half of the messages belong to one key; some keys have one message."""
    rng = random.Random(seed)
    keys = ["hot"] * (n // 2) + [f"k{rng.randint(0, 40)}" for _ in range(n // 2 - 20)] + [f"single{i}" for i in range(20)]
    frame = pd.DataFrame({"key": keys, "ts_ms": [rng.randint(0, 300_000) for _ in keys], "id": range(n), "rows": [rng.randint(1, 30) for _ in keys]})
    return frame, spark.createDataFrame(frame).repartition(6)


@pytest.mark.parametrize("limits", [Limits(rows=100), Limits(age_ms=5000), Limits(rows=64, age_ms=3000), Limits(rows=100, idle_ms=700)])
@pytest.mark.parametrize("chunk_rows, fan", [(1 << 16, 256), (150, 3)])
def test_numbering_over_partitions(spark, limits, chunk_rows, fan):
    frame, df = messages(spark)
    got = batching.number_batches(df, limits, chunk_rows, fan).toPandas().sort_values(["key", "ts_ms", "id"], ignore_index=True)
    want = frame.sort_values(["key", "ts_ms", "id"], ignore_index=True)
    for _, group in want.groupby("key"):
        expected = sequential(limits, group["ts_ms"].tolist(), group["rows"].tolist())
        assert got.loc[group.index, "batch_no"].tolist() == expected
    assert got["id"].tolist() == want["id"].tolist()


def test_one_key_with_all_rows(spark):
    """One key is numbered by many chunks, and nothing runs before the result is asked for."""
    rng = random.Random(4)
    frame = pd.DataFrame({"key": "only", "ts_ms": [rng.randint(0, 40_000_000) for _ in range(6000)], "id": range(6000), "rows": 1})
    df = spark.createDataFrame(frame).repartition(5)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    numbered = batching.number_batches(df, Limits(rows=40, age_ms=60_000), 100, 4)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("running", "")
    got = numbered.toPandas().sort_values(["ts_ms", "id"], ignore_index=True)
    want = frame.sort_values(["ts_ms", "id"], ignore_index=True)
    assert got["batch_no"].tolist() == sequential(Limits(rows=40, age_ms=60_000), want["ts_ms"].tolist(), [1] * 6000)
    chunks = batching.in_chunks(df, 100).groupBy("chunk").count().toPandas()
    assert len(chunks) > 50 and chunks["count"].max() < 200


def test_count_batch_invariants(spark):
    _, df = messages(spark)
    numbered = batching.count_batches(df, 100, 200)
    sizes = batching.batch_sizes(numbered, 100).toPandas()
    last = sizes.groupby("key")["batch_no"].transform("max")
    assert (sizes.loc[sizes["batch_no"] < last, "record_count"] >= 100).all()
    assert (sizes["record_count"] < 130).all()
    assert sizes["messages"].sum() == 4000
    drained = batching.drain(numbered, 100).toPandas()
    assert len(drained) == (~sizes["complete"]).sum()


def test_age_and_gap_batches(spark):
    frame, df = messages(spark)
    aged = batching.age_batches(df, 5000, 200).toPandas()
    assert ((aged["last_ms"] - aged["first_ms"]) < 5000).all() and aged["messages"].sum() == 4000
    gaps = batching.gap_batches(df, 700).toPandas().sort_values(["key", "batch_no"])
    want = [
        (key, len(set(sequential(Limits(idle_ms=700), g["ts_ms"].tolist(), [1] * len(g)))))
        for key, g in frame.sort_values(["ts_ms"]).groupby("key")
    ]
    assert sorted(gaps.groupby("key").size().items()) == sorted(want)


@pytest.mark.parametrize("times, published", [([0, 25], [0]), ([0, 75], [0, 75]), ([0, 50], [0, 50]), ([0, 30, 60, 90, 120], [0, 60, 120])])
def test_throttle(spark, times, published):
    events = spark.createDataFrame([("s", t, i) for i, t in enumerate(times)], "key STRING, ts_ms BIGINT, id BIGINT")
    assert sorted(r["ts_ms"] for r in batching.throttle(events, 50, 2).collect()) == published


def test_envelope(spark):
    _, df = messages(spark, n=400)
    rows = batching.batch_envelope(batching.count_batches(df, 50, 30), ["rows"]).collect()
    assert all(r["record_count"] == sum(e["rows"] for e in r["entries"]) for r in rows)
    assert len({r["batch_id"] for r in rows}) == len(rows)


def once(df):
    """The physical plan with every exchange that is read twice shown once."""
    conf = df.sparkSession.conf
    fixed = {"spark.sql.adaptive.enabled": "false"}
    before = {name: conf.get(name) for name in fixed}
    for name, value in fixed.items():
        conf.set(name, value)
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            conf.set(name, value)


def test_input_is_read_once(spark):
    """Counting, mapping and numbering share the exchanges of the messages, though times may be null."""
    df = spark.range(100).select(
        "id", F.when(F.col("id") > 5, F.col("id")).alias("ts_ms"), F.when(F.col("id") > 7, "okx").alias("exchange")
    )
    plan = once(flushing.number_flushes(df, flushing.Clock(10, 15_000)))
    assert plan.count("Range (") == plan.count("_count_cells(") == 1
