import pytest
from pyspark.sql import functions as F

from mdlake.operators import batching, telemetry, usage

EVENT = (
    "event_id BIGINT, ts_ms BIGINT, component STRING, name STRING, value STRING, number DOUBLE, type STRING, "
    "fields MAP<STRING, STRING>, numbers MAP<STRING, DOUBLE>"
)


def events(spark, *rows):
    """Rows (component, name, value, type, fields); what is no text is a number."""
    out = []
    for i, (component, name, value, kind, fields) in enumerate(rows):
        number = None if isinstance(value, str) else float(value)
        texts = {k: v for k, v in fields.items() if isinstance(v, str)}
        numbers = {k: float(v) for k, v in fields.items() if not isinstance(v, str)}
        out.append((i, i * 1000, component, name, str(value), number, kind, texts, numbers))
    return spark.createDataFrame(out, EVENT)


def test_metric_gate(spark):
    df = events(
        spark, ("c", "a", "1", "", {}), ("c", "", "1", "gauge", {}), ("c", "used_weight", "1", "gauge", {}),
        ("c", "fobs_raw_buffer_length", "1", "gauge", {}), ("c", "foi_raw_buffer_length", "1", "gauge", {}),
    )
    assert {(r["name"], r["type"]) for r in telemetry.metric_events(df).collect()} >= {("a", "counter"), ("used_weight", "gauge")}
    gated = telemetry.metric_events(df, used_weight=False, channel_size=False)
    assert {r["name"] for r in gated.collect()} == {"a", "foi_raw_buffer_length"}


def test_datums(spark):
    df = events(spark, ("c", "m", 1.5, "gauge", {"unit": "PERCENT", "b": "x", "a": "y", "blank": "", "metric": "no", "capacity": 10}), ("c", "m", "text", "gauge", {}), ("c", "m", "5", "gauge", {}))
    (row,) = telemetry.metric_datums(df).collect()
    assert (row["number"], row["unit"]) == (1.5, "Percent")
    assert row["series"] == "c|m|a=y|b=x|component=c|unit=Percent"


def test_rollup(spark):
    rows = [("c", "liq_raw_buffer_length", v, "gauge", {}) for v in (1, 2, 6)] + [("c", "used_weight", v, "gauge", {"ip": "i"}) for v in (1, 9, 6)]
    got = {(r["name"], r["ip"], r["stat"], r["value"], r["samples"]) for r in telemetry.rollup_60s(events(spark, *rows)).collect()}
    assert got == {("liq_raw_buffer_length", "", "avg", 3.0, 3), ("used_weight", "i", "max", 9.0, 3)}


def test_drops(spark):
    stages = spark.createDataFrame(
        [(1, "fobd", "raw", "dropped", "okx", "", "S"), (2, "fobd", "norm", "dropped", "okx", "m", "S"), (3, "fobs", "raw", "dropped", "", "m", None),
         (4, "fobs", "norm", "dropped", "okx", "m", "S"), (5, "fobs", "raw", "sent", "okx", "m", "S")],
        "ts_ms BIGINT, feed STRING, stage STRING, outcome STRING, exchange STRING, market STRING, symbol STRING",
    )
    drops = telemetry.drop_events(stages)
    assert {r["name"]: dict(r["fields"]) for r in drops.collect()}["delta_messages_dropped"] == {"exchange": "okx", "symbol": "S", "stage": "raw"}
    summary = {r["exchange"]: (r["snapshot"], r["delta"], r["delta_norm"], r["delta_total"], r["total"]) for r in telemetry.drop_summary(drops).collect()}
    assert summary == {"okx": (0, 1, 1, 2, 2), "unknown": (1, 0, 0, 0, 1), "ALL": (1, 1, 1, 2, 3)}


def test_drop_values(spark):
    name = "delta_messages_dropped"
    rows = [("c", name, v, "counter", {"exchange": x}) for v, x in ((1.5, "okx"), (float("nan"), "okx"), (float("inf"), "okx"), (2, ""), ("7", "okx"))]
    got = {r["exchange"]: r["delta"] for r in telemetry.drop_summary(events(spark, *rows)).collect()}
    assert got == {"okx": 1.5, "unknown": 2.0, "ALL": 3.5}


def test_capacity_does_not_part_a_series(spark):
    rows = [("c", "fobs_raw_buffer_length", 1, "gauge", {"capacity": c}) for c in (10, 20, 10)]
    datums = telemetry.metric_datums(events(spark, *rows)).select(F.col("series").alias("key"), "ts_ms", F.col("event_id").alias("id"))
    assert [r["id"] for r in batching.throttle(datums).collect()] == [0]


def test_latest_views(spark):
    df = events(spark, *[("c", "m", str(i), "gauge", {}) for i in range(5)])
    assert [r["value"] for r in telemetry.latest(df, 2).collect()] == ["3", "4"]
    logs = spark.createDataFrame(
        [(1, 5, "warn", "hello", {"component": "test", "foo": "bar"})],
        "event_id BIGINT, ts_ms BIGINT, level STRING, message STRING, fields MAP<STRING, STRING>",
    )
    (row,) = telemetry.log_records(logs).collect()
    assert (row["component"], row["level"], row["fields"]) == ("test", "warn", {"foo": "bar"})
    samples = spark.createDataFrame(
        [(1, 1, 10.0, 1, 2, None, 1, 2, 0.0), (2, 2, 42.5, 1024, 2048, 50.0, 4096, 8192, 50.0)],
        "event_id BIGINT, ts_ms BIGINT, cpu_percent DOUBLE, memory_used BIGINT, memory_total BIGINT, memory_percent DOUBLE, disk_used BIGINT, disk_total BIGINT, disk_percent DOUBLE",
    )
    rows = telemetry.resource_latest(samples).collect()
    assert [(r["cpu_percent"], r["memory_percent"], r["is_summary"]) for r in rows] == [(10.0, 0.0, False), (42.5, 50.0, True)]


def test_occupancy_over_days(spark):
    day = 86_400_000
    flow = spark.createDataFrame([("f", "raw", t, c) for t, c in [(0, 1), (500, 1), (1000, 1), (day, -1), (day + 2000, 1), (3 * day, -2)]], "feed STRING, stage STRING, ts_ms BIGINT, change INT")
    sizes = [(900, 1, 50.0), (900, 2, 60.0), (2 * day, 3, 70.0)]
    caps = spark.createDataFrame([("f", "raw", t, i, c) for t, i, c in sizes], "feed STRING, stage STRING, ts_ms BIGINT, event_id BIGINT, capacity DOUBLE")
    found = telemetry.buffer_occupancy(flow, caps)
    rows = sorted((r["second_ms"], r["backlog"], r["capacity"]) for r in found.collect())
    assert rows == [(0, 2, 60), (1000, 3, 60), (day, 2, 60), (day + 2000, 3, 60), (3 * day, 1, 70)]
    early = telemetry.buffer_occupancy(flow, caps.filter("ts_ms > 1000")).collect()
    assert {r["capacity"] for r in early if r["second_ms"] < 2 * day} == {10_000}


def test_buffers_are_linked(spark):
    stages = [("f", "raw", "sent", 0), ("f", "raw", "sent", 5), ("f", "raw", "dropped", 6), ("f", "norm", "sent", 10), ("f", "norm", "dropped", 20)]
    flow = telemetry.buffer_flow(
        spark.createDataFrame(stages, "feed STRING, stage STRING, outcome STRING, ts_ms BIGINT"),
        spark.createDataFrame([("f", 30)], "feed STRING, ts_ms BIGINT"),
    )
    got = sorted((r["stage"], r["ts_ms"], r["change"]) for r in flow.collect())
    assert got == [("norm", 10, 1), ("norm", 30, -1), ("raw", 0, 1), ("raw", 5, 1), ("raw", 10, -1), ("raw", 20, -1)]


def headers(spark, **h):
    return spark.createDataFrame([("1.1.1.1", h, 10.0)], "ip STRING, headers MAP<STRING, STRING>, extra DOUBLE")


def test_usage_reports(spark):
    (r,) = usage.used_weight_binance(headers(spark, **{"X-MBX-USED-WEIGHT-1M": "123.5"})).collect()
    assert (r["used"], r["used_weight"]) == (123.5, 133.5)
    (r,) = usage.used_weight_bybit(headers(spark, **{"X-Bapi-Limit": "120", "X-Bapi-Limit-Status": "110"})).collect()
    assert (r["quota"], r["remaining"], r["used_weight"]) == (120.0, 110.0, 10.0)
    calls = spark.createDataFrame([(400, 200, 10.0), (400, None, 10.0), (0, 5, 0.0)], "limit BIGINT, remaining BIGINT, extra DOUBLE")
    assert sorted(r["used_weight"] for r in usage.used_weight_kucoin(calls, 0).collect()) == [610.0]
    okx = headers(spark, **{"Rate-Limit-Limit": "12", "Rate-Limit-Remaining": "4", "Rate-Limit-Reset": "1737043200", "Rate-Limit-Interval": "2s"})
    (r,) = usage.okx_rate_limit(okx).collect()
    assert (r["quota"], r["remaining"], r["reset_ms"], r["window_s"]) == (12.0, 4.0, 1737043200000.0, 2.0)
    (r,) = usage.used_weight_okx(headers(spark, **{"Rate-Limit-Remaining": "5"}).withColumn("extra", F.lit(50.0))).collect()
    assert r["used_weight"] == 55.0


@pytest.mark.parametrize("n, interval, weight, expected", [(2, 100, 1.0, 1200.0), (2, 500, 3.0, 720.0), (2, 1000, 1.0, 120.0), (0, 100, 1.0, 0.0), (2, 0, 1.0, 0.0)])
def test_estimates(spark, n, interval, weight, expected):
    df = spark.range(1).select(usage.per_minute(F.lit(n), F.lit(interval), weight).alias("x"))
    assert df.first()["x"] == expected


def test_connection_budget(spark):
    row = spark.range(1).select(usage.connection_budget(F.lit(1)).alias("one"), usage.connection_budget(F.lit(0)).alias("none")).first()
    assert (row["one"], row["none"]) == (180.0, 0.0)
