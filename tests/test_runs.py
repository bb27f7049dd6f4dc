"""The whole warehouse on the smallest given tables."""

import pytest
from pyspark.sql import functions as F

from emberscan import adapter, storage
from emberscan.operators.quality import QualityError, Rules
from emberscan.operators.region import region_index
from emberscan.plans import runs
from emberscan.plans.release import Release
from emberscan.sources import files, lake
from emberscan.streaming import events, jobs

from .conftest import SMALL

DAYS = ["2024-01-05", "2024-01-06"]


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("house"))
    detections = adapter.detections(spark, SMALL).drop("event_id")
    some = detections.where(F.col("acq_date").cast("string").isin(DAYS))
    lake.split_by_day(some, f"{root}/lake", "archive", "fire_detections_archive")
    files.write_snapshot(adapter.regencies(spark, SMALL), f"{root}/lake", "regency")
    files.write_snapshot(adapter.provinces(spark, SMALL), f"{root}/lake", "province")
    warehouse = runs.Warehouse(f"{root}/house")
    runs.load_references(spark, warehouse, f"{root}/lake")
    runs.save_region_index(
        *region_index(adapter.boundaries(spark, SMALL), adapter.regencies(spark, SMALL)), f"{root}/index"
    )
    index, grid = runs.load_region_index(spark, f"{root}/index")
    streamed = detections.where(F.col("acq_date").cast("string") == "2024-01-07")
    events.encode(events.to_events(streamed)).select("value").write.text(f"{root}/messages")
    raw, enriched = (warehouse.path(runs.STREAM, f"fire_detection_nrt_{t}") for t in ("raw", "enriched"))
    jobs.start_raw_sink(jobs.message_files(spark, f"{root}/messages"), raw, f"{root}/cp").awaitTermination()
    jobs.enrich_unseen(spark, raw, enriched, index, grid)
    for day in DAYS:
        runs.run_batch(spark, warehouse, f"{root}/lake", day, index, grid, version_mode="string")
    return warehouse, f"{root}/lake", index, grid, some.count(), streamed.count()


def test_layers_build_and_pass_their_gates(spark, house):
    warehouse, _, _, _, batch_rows, stream_rows = house
    warnings = runs.run_transform(spark, warehouse, as_of="2024-01-08")
    assert set(warnings) <= {
        "dim_collecting_process.not_null:collection_version",
        "dim_detection_classification.accepted:daynight",
        "dim_detection_classification.accepted:detection_type",
    }
    core = {n: spark.read.parquet(warehouse.path(runs.CORE, n)) for n in ("fct_detection", "int_detection_quarantine")}
    assert core["fct_detection"].count() + core["int_detection_quarantine"].count() == batch_rows + stream_rows
    daily = spark.read.parquet(warehouse.path(runs.MART, "daily_detection"))
    assert daily.agg(F.sum("detection_count")).first()[0] == core["fct_detection"].count()
    assert {r[0] for r in daily.select("ingestion_source").distinct().collect()} == {"batch", "stream"}
    before = sorted(daily.collect(), key=str)
    # Again, then for one day only: nothing changes.
    runs.run_transform(spark, warehouse, as_of="2024-01-08", declared=False)
    runs.run_transform(spark, warehouse, date=DAYS[0], declared=False)
    assert sorted(spark.read.parquet(warehouse.path(runs.MART, "daily_detection")).collect(), key=str) == before


def test_reloading_a_day_changes_nothing(spark, house):
    warehouse, lake_root, index, grid, batch_rows, _ = house
    report = runs.run_batch(spark, warehouse, lake_root, DAYS[0], index, grid, version_mode="string")
    assert report.batch_exists and not report.stream_exists
    assert runs.raw_table(spark, warehouse, "raw_detections").read().count() == batch_rows


def test_a_corrected_day_clears_its_rejects(spark, house):
    warehouse, *_ = house
    rejects = runs.raw_table(spark, warehouse, "rejected_detections")
    bad = spark.sql("select 'x' as latitude, 'INVALID_COORDINATE' as reject_reason")
    rejects.replace_part(bad, DAYS[0])
    assert rejects.read().count() == 1
    rejects.replace_part(bad.where("false"), DAYS[0])
    assert rejects.read().count() == 0


def test_layers_are_released_together_or_not_at_all(spark, house, monkeypatch):
    warehouse, _, _, _, batch_rows, stream_rows = house
    release = Release(spark, f"{warehouse.root}/published")
    assert runs.run_published(spark, warehouse) == 1
    tables = ("int_detection_quarantine", "fct_detection", "daily_detection")
    counts = {name: release.read(name).count() for name in tables}
    assert counts["int_detection_quarantine"] + counts["fct_detection"] == batch_rows + stream_rows
    with monkeypatch.context() as patched:
        # The fact breaks a rule: nothing of the run is seen, not even tables that pass.
        patched.setitem(runs.DECLARED, "fct_detection", Rules(accepted={"regency_id": (-5,)}))
        with pytest.raises(QualityError, match="fct_detection"):
            runs.run_published(spark, warehouse)
    with monkeypatch.context() as patched:
        # Died while publishing: some tables have a new version, but no release names it.
        patched.setattr(storage, "create_text", dying_after(2, storage.create_text))
        with pytest.raises(OSError):
            runs.run_published(spark, warehouse)
    assert release.numbers() == [1]
    assert {name: release.read(name).count() for name in tables} == counts
    assert runs.run_published(spark, warehouse, date=DAYS[0]) == 2
    assert {name: release.read(name).count() for name in tables} == counts


def dying_after(calls, real):
    left = [calls]

    def step(*given):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("lost")
        return real(*given)

    return step


def test_a_failed_gate_stops_the_run(spark, house):
    spark.sql("select cast(-999 as bigint) as regency_id").createOrReplaceTempView("int_detection_join")
    with pytest.raises(QualityError, match="invalid_regency_id"):
        runs.gate(spark, "intermediate")
