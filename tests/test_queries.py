"""Named queries against their SQL; MDLAKE_ALL=1 runs every one of them."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from mdlake.plans.oracles import ORACLES
from mdlake.plans.queries import QUERIES
from tools.check import TABLES, compare

CORE = [
    "book_flatten", "delta_flatten", "decode_book_okx", "decode_delta_kucoin", "oi_normalize", "pi_normalize", "liq_unified",
    "control_frame_filter", "symbol_allow_filter", "count_batches", "age_batches", "metric_throttle", "gap_batches",
    "drop_summary", "buffer_occupancy", "sink_premium_index", "file_manifest", "used_weight_okx",
]
NAMES = list(entry_points.queries()) if os.environ.get("MDLAKE_ALL") else CORE


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf_dir, name):
    verdict, _ = compare(spark, con, sf_dir, name)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns[:2] == ["exchange", "symbol"] and rows.count() > 0


def test_each_payload_is_parsed_once(spark, sf_dir):
    for name, venues in (("book_flatten", 4), ("delta_flatten", 4), ("liq_unified", 3), ("pi_normalize", 4), ("control_frame_filter", 1), ("liq_kucoin_filter", 1), ("decode_liq_kucoin", 1), ("topic_symbol", 1), ("payload_quarantine", 20), ("poll_grid", 4)):
        plan = entry_points.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == venues, name


def test_feeds_are_narrow(spark, sf_dir, tmp_path):
    from mdlake.operators import books
    from mdlake.plans import fixtures as fx
    from mdlake.sources import landing

    path = str(tmp_path / "landing")
    fx.book_messages(spark, sf_dir).write.partitionBy("feed").parquet(path)
    flat = books.book_flatten(landing.scan_landing(spark, path, feed="fobs"))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(feed" in plan
    assert "message_type" not in plan
