"""Staging, intermediate, star and mart models on small frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emberscan.operators.dedup import keep_latest
from emberscan.operators.region import normalise_types
from emberscan.plans import intermediate, marts, staging, star
from emberscan.schemas import STAGING_COLUMNS, STREAM_ENRICHED

from .plans import explained

RAW = (
    "latitude double, longitude double, brightness double, scan double, track double, acq_date string, acq_time string,"
    " satellite string, instrument string, confidence string, version string, bright_t31 double, frp double,"
    " daynight string, type int, regency_id bigint"
)


def raw(spark, **changes):
    base = dict(
        latitude=-1.5, longitude=116.25, brightness=330.1, scan=0.4, track=0.5, acq_date="2024-01-05", acq_time="945",
        satellite="N20", instrument="VIIRS", confidence="n", version="2.0NRT", bright_t31=290.0, frp=12.5,
        daynight="D", type=0, regency_id=7,
    )
    row = {**base, **changes}
    return spark.createDataFrame([tuple(row.values())], RAW)


def test_staging_fills_sentinels(spark):
    got = staging.stage_batch(
        raw(spark, brightness=None, satellite=None, type=None, regency_id=None, confidence=None, acq_time=None)
    )
    assert got.columns == STAGING_COLUMNS
    row = got.first()
    assert (row.brightness, row.satellite, row.confidence) == (Decimal(-999), "UNKNOWN", "UNKNOWN")
    assert (row.detection_type, row.regency_id, row.acquisition_time) == (-999, -999, None)
    assert row.acquisition_date == dt.date(2024, 1, 5)


def test_staging_accepts_a_feed_without_type(spark):
    assert staging.stage_batch(raw(spark).drop("type")).first().detection_type == -999


def test_staging_casts_strictly(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_batch(raw(spark, acq_date="not a date")).collect()


@pytest.mark.parametrize("mode,expected", [("int", [None, 2, 2, None]), ("string", ["2.0NRT", "2", "2.0", "2.5"])])
def test_version_modes(spark, mode, expected):
    df = raw(spark, version="2.0NRT")
    for version in ("2", "2.0", "2.5"):
        df = df.unionByName(raw(spark, version=version))
    assert [r.version for r in normalise_types(df, mode).collect()] == expected


def test_normalising_needs_a_date_column(spark):
    with pytest.raises(ValueError, match="acq_date"):
        normalise_types(raw(spark).drop("acq_date"))
    assert normalise_types(raw(spark, acq_date="bad")).first().acq_date is None


def stream_row(spark, **changes):
    made = {f.name: None for f in STREAM_ENRICHED}
    made |= dict(
        event_id="e", latitude=1.0, longitude=2.0, acquisition_date=dt.date(2024, 1, 5), acquisition_time="09:45:00",
        fire_radiative_power=1.0, ingested_timestamp=dt.datetime(2024, 1, 5, 10), regency_id=7,
    )
    return spark.createDataFrame([tuple({**made, **changes}.values())], STREAM_ENRICHED)


def test_latest_copy_wins_even_on_full_ties(spark):
    df = stream_row(spark)
    df = df.unionByName(stream_row(spark, ingested_timestamp=dt.datetime(2024, 1, 5, 12), fire_radiative_power=9.0))
    df = df.unionByName(df).unionByName(stream_row(spark, event_id="other"))
    got = staging.stage_stream(df)
    assert {(r.detection_id, r.fire_radiative_power) for r in got.collect()} == {("e", 9), ("other", 1)}
    assert got.where("detection_type is not null").count() == 0
    again = staging.stage_stream(df.repartition(7, "latitude"))
    assert sorted(again.collect()) == sorted(got.collect())


def test_dedup_cuts_down_copies_before_the_shuffle(spark):
    plan = explained(keep_latest(stream_row(spark), "event_id", [F.col("acquisition_date").desc()]))
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan


def test_split_is_complete(spark):
    staged = staging.stage_batch(raw(spark).unionByName(raw(spark, regency_id=None)))
    assert intermediate.matched(staged).count() + intermediate.quarantine(staged).count() == staged.count()
    row = intermediate.quarantine(staged).first()
    assert row.quarantine_issue == "REGION_NOT_MATCHED" and row.quarantined_at is not None


def test_one_pass_equals_the_join_on_unique_ids(spark):
    staged = staging.stage_batch(raw(spark).unionByName(raw(spark, latitude=2.0, version="beta", type=None)))
    joined = intermediate.join_detections(intermediate.enrich_time(staged), intermediate.label_business(staged))
    once = intermediate.describe(staged)
    assert sorted(joined.select(*once.columns).collect()) == sorted(once.collect())
    doubled = staged.unionByName(staged)
    literal = intermediate.join_detections(intermediate.enrich_time(doubled), intermediate.label_business(doubled))
    assert literal.count() == 8 and intermediate.describe(doubled).count() == 4


def test_batch_and_stream_types_make_different_classes(spark):
    batch = staging.stage_batch(raw(spark, type=None))
    both = staging.stage_union(batch, staging.stage_stream(stream_row(spark, daynight="D", confidence="n")))
    dim = star.dim_detection_classification(intermediate.describe(both))
    assert dim.count() == 2 and dim.select("detection_type_label").distinct().count() == 1


def test_union_may_prefer_batch(spark):
    batch = staging.stage_batch(raw(spark))
    stream = staging.stage_stream(stream_row(spark, event_id=batch.first().detection_id))
    assert staging.stage_union(batch, stream).count() == 2
    assert [r.ingestion_source for r in staging.stage_union(batch, stream, prefer_batch=True).collect()] == ["batch"]


def test_ids_of_the_batch_need_no_location(spark):
    points = raw(spark)
    given = staging.batch_ids(points)
    batch = staging.stage_batch(points)
    assert given.collect() == batch.select("detection_id").collect()
    stream = staging.stage_stream(stream_row(spark, event_id=batch.first().detection_id))
    got = staging.stage_union(batch, stream, prefer_batch=True, batch_ids=given.union(given))
    assert [r.ingestion_source for r in got.collect()] == ["batch"]


def places(spark):
    return spark.createDataFrame(
        [(7, "KOTA A", 1, "P")], "regency_id bigint, regency_name string, province_id bigint, province_name string"
    )


def test_mart_counts_and_exact_sums(spark):
    staged = staging.stage_batch(raw(spark, frp=0.1).unionByName(raw(spark, frp=0.2, latitude=0.5)))
    detections = intermediate.describe(staged)
    mart = marts.daily_detection(
        star.fct_detection(detections), star.dim_detection_classification(detections), places(spark)
    )
    row = mart.first()
    assert mart.count() == 1
    assert (row.detection_count, row.total_frp, row.max_frp) == (2, Decimal("0.3"), Decimal("0.2"))
    assert (row.confidence_level, row.day_night, row.detection_type_label) == ("Nominal", "Day", "Vegetation Fire")


def test_mart_joins_after_aggregating(spark):
    detections = intermediate.describe(staging.stage_batch(raw(spark)))
    plan = explained(
        marts.daily_detection(
            star.fct_detection(detections), star.dim_detection_classification(detections), places(spark)
        )
    )
    assert "Python" not in plan and "NestedLoop" not in plan
    first_join = min(i for i in (plan.find("HashJoin"), plan.find("SortMergeJoin")) if i >= 0)
    assert "partial_sum" in plan[first_join:]


def test_mart_scope(spark):
    fact = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) as acquisition_date")
    assert marts.mart_scope(fact).count() == 10
    assert marts.mart_scope(fact, incremental=True, as_of="2024-01-10").count() == 4
    assert marts.mart_scope(fact, date="2024-01-02", incremental=True).count() == 1
    assert marts.mart_scope(fact, date="", incremental=True, as_of="2024-01-10").count() == 4


def test_rankings_count_mart_rows(spark):
    mart = spark.createDataFrame(
        [("A", 100), ("B", 1), ("B", 1)], "province_name string, detection_count bigint"
    ).withColumns({"total_frp": F.lit(1.0), "max_frp": F.lit(1.0)})
    assert [tuple(r) for r in marts.top_province(mart).collect()] == [("B", 2), ("A", 1)]
    assert [r[0] for r in marts.severity_ranking(mart).collect()] == ["A", "B"]
