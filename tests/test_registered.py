"""Registered queries against DuckDB on the smallest tables, and their plans."""

import pytest

import __spark_entry__ as entry
from emberscan.showcase import queries
from emberscan.showcase.queries import REGISTRY

from .compare import connect, difference
from .conftest import SMALL
from .plans import explained

# The rest are compared by `python tests/compare.py <sf_dir>`.
SAMPLED = [
    "stage_batch", "stage_stream_dedup", "enrich_shuffled", "daily_detection", "upsert_fact", "append_unseen",
    "quality_fact", "assign_location_ids", "point_lookup", "decode_problems", "trend",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", SAMPLED)
def test_same_result_as_duckdb(spark, duck, name):
    assert difference(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_flagship_plan(spark):
    plan = explained(entry.entry(spark))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = explained(entry.queries()["density_grid"](spark, SMALL), "formatted")
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_coordinates_beside_the_equator_are_written_as_the_publishers_do(spark, folder):
    row = ("event_id", "timestamp'2024-01-01 00:00:00' as ts", "1L as user_id", "'click' as event_type", "1d as value", "'' as props")
    ids = spark.createDataFrame([(192679,), (267321,), (7,)], "event_id bigint")
    ids.selectExpr(*row).write.parquet(f"{folder}/events.parquet")
    found = entry.queries()["invalid_coordinates"](spark, folder).collect()
    assert {r["event_id"]: r["latitude"] for r in found} == {192679: "0.0009999999999994458", 267321: "-0.0009999999999994458", 7: repr(-10 + 10433 / 1000)}


def test_declared_checks_locate_the_batch_feed_once(spark, monkeypatch):
    """The batch feed, that is; the stream is located by its own job."""
    made = []
    attach = queries.attach_regency
    monkeypatch.setattr(queries, "attach_regency", lambda *given, **options: made.append(1) or attach(*given, **options))
    entry.queries()["quality_declared"](spark, SMALL)
    assert len(made) == 1
