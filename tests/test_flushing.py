import random

import numpy as np
from pyspark.sql import functions as F

from mdlake.operators import flushing
from mdlake.operators.flushing import Buffers, Clock, FlushMap


def sequential(clock, ms):
    """The writer's loop: rows and ticks one after another."""
    held, written, number, out = 0, ms[0], 0, []
    tick = ms[0] // clock.tick_ms
    for t in ms:
        while tick < t // clock.tick_ms:
            tick += 1
            if held and tick * clock.tick_ms - written >= clock.interval_ms:
                held, written, number = 0, tick * clock.tick_ms, number + 1
        out.append(number)
        held += 1
        if held >= clock.rows:
            held, written, number = 0, t, number + 1
    return out


def some_times(rng):
    n, wide = rng.randint(1, 80), rng.choice([5, 60, 400, 3000])
    return np.sort(np.array([rng.randint(-50, wide) for _ in range(n)], dtype=np.int64))


def some_clock(rng):
    return Clock(rng.choice([1, 2, 5, 30]), rng.choice([1, 10, 25, 150]), rng.choice([1, 10, 40]))


def numbered(clock, state, ms):
    out = []
    for t in ms:
        state.tick_to(clock, int(t) // clock.tick_ms)
        out.append(int(state.done[0]))
        state.append(clock, np.array([t]))
    return out


def opened(clock, ms):
    zero = np.zeros(1, dtype=np.int64)
    return Buffers(zero, zero + clock.due(int(ms[0])), zero, int(ms[0]) // clock.tick_ms)


def test_cut_runs_equal_the_writers_loop():
    rng = random.Random(3)
    for _ in range(400):
        clock, ms = some_clock(rng), some_times(rng)
        cuts = sorted(rng.sample(range(1, len(ms)), min(len(ms) - 1, rng.randint(0, 4)))) if len(ms) > 1 else []
        state, got = opened(clock, ms), []
        for low, high in zip([0, *cuts], [*cuts, len(ms)]):
            inside = Buffers(state.rows, state.due, state.done, state.cell)
            got += numbered(clock, inside, ms[low:high])
            state = FlushMap.of_run(clock, ms[low:high]).apply(clock, state)
            assert (state.rows[0], state.done[0], state.cell) == (inside.rows[0], inside.done[0], inside.cell)
        assert got == sequential(clock, ms.tolist())


def test_maps_compose_in_any_order():
    rng = random.Random(5)
    for _ in range(300):
        clock, ms = some_clock(rng), some_times(rng)
        if len(ms) < 3:
            continue
        a, b = sorted(rng.sample(range(1, len(ms)), 2))
        x, y, z = (FlushMap.of_run(clock, ms[i:j]) for i, j in ((0, a), (a, b), (b, len(ms))))
        ends = []
        for path in ([x, y, z], [x.then(clock, y).then(clock, z)], [x.then(clock, y.then(clock, z))]):
            first = int(ms[0]) // clock.tick_ms
            held = np.arange(clock.rows)
            state = Buffers(held, first + held % (clock.ticks + 1), held * 0, first - 1)
            for step in path:
                state = step.apply(clock, state)
            ends.append((state.rows.tolist(), np.maximum(state.due, state.cell + 1).tolist(), state.done.tolist()))
        assert ends[0] == ends[1] == ends[2]


def test_shared_buffer_over_spark(spark):
    """Bursts, a silence, days far apart, and rows without an exchange."""
    rng = random.Random(9)
    base = 1_704_067_200_000
    times = [base + rng.randint(0, 200_000) for _ in range(1500)] + [base + 7_000] * 900
    times += [base + d * 86_400_000 + rng.randint(0, 30_000) for d in (1, 2, 40, 400) for _ in range(60)] + [-5, 12, 999]
    rows = [(rng.choice(["binance", "bybit", "okx", ""]), t, i) for i, t in enumerate(times)]
    clock = Clock(100, 15_000, 1_000)
    frame = spark.createDataFrame(rows, "exchange string, ts_ms bigint, id bigint").repartition(7)
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    want = dict(zip([r[2] for r in order], sequential_days(clock, [r[1] for r in order])))
    for chunk_rows in (50, 1 << 16):
        got = {r["id"]: r["batch_no"] for r in flushing.number_flushes(frame, clock, chunk_rows).collect()}
        assert got == want
    files = flushing.liq_flush(frame, 100, 15_000, 1_000, chunk_rows=50)
    assert files.filter(F.col("exchange") == "").count() == 0
    assert {(r["batch_no"], r["exchange"], r["records"]) for r in files.collect()} == {
        (n, e, sum(1 for r in rows if want[r[2]] == n and r[0] == e)) for n, e in {(want[r[2]], r[0]) for r in rows if r[0]}
    }


def sequential_days(clock, ms):
    """The same loop, stepping over the ticks at which nothing can happen."""
    held, written, number, out = 0, ms[0], 0, []
    last = ms[0]
    for t in ms:
        after = last // clock.tick_ms + 1
        ready = max(after, -(-(written + clock.interval_ms) // clock.tick_ms))
        if held and ready <= t // clock.tick_ms:
            held, written, number = 0, ready * clock.tick_ms, number + 1
        out.append(number)
        held, last = held + 1, t
        if held >= clock.rows:
            held, written, number = 0, t, number + 1
    return out


def test_no_rows(spark):
    empty = spark.createDataFrame([], "exchange string, ts_ms bigint, id bigint")
    assert flushing.liq_flush(empty).collect() == []
