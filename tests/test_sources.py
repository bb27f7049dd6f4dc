"""Files, lake layout, discovery and boundaries."""

import json
import os

import pytest
from pyspark.sql import functions as F

from emberscan import storage
from emberscan.operators import audit, coordinates
from emberscan.schemas import API_CSV, STREAM_RAW
from emberscan.sources import discovery, files, geojson, lake
from emberscan.sources.catalogue import LandingCatalogue

from .plans import explained


def hotspots(spark):
    return spark.createDataFrame(
        [("2024-01-05", 1.0), ("2024-01-05", 2.0), ("2024-02-01", 3.0), ("broken", 4.0), (None, 5.0)],
        "acq_date string, frp double",
    )


def test_daily_split_reports_undated_rows(spark, folder):
    assert lake.split_by_day(hotspots(spark), folder, "archive", "t") == 2
    assert os.path.isdir(f"{folder}/archive/t/year=2024/month=01/acq_date=2024-01-05")
    assert spark.read.parquet(f"{folder}/archive/t").count() == 3
    assert lake.split_by_day(hotspots(spark), folder, "archive", "t") == 2
    assert spark.read.parquet(f"{folder}/archive/t").count() == 3
    assert lake.split_by_day(hotspots(spark).where("false"), folder, "archive", "empty") == 0
    assert not storage.exists(spark, f"{folder}/archive/empty")


def test_land_tables(spark, folder):
    read = {"regency": spark.range(3), "fire_detections_archive": hotspots(spark)}
    undated = lake.land_tables(
        read.get, folder, {"archive": ["fire_detections_archive"], "reference": ["regency"]}
    )
    assert undated == {"fire_detections_archive": 2, "regency": 0}
    assert files.truncate_and_load(spark, f"{folder}/reference/regency.parquet", f"{folder}/raw").count() == 3


def test_date_range_reads_only_its_days(spark, folder):
    lake.split_by_day(hotspots(spark), folder, "nrt", "t")
    df = lake.read_days(spark, folder, "nrt", "t", "2024-01-01", "2024-01-31")
    assert df.count() == 2
    plan = explained(df, "formatted")
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "acq_date" in filters


def stream_table(spark, day):
    return spark.createDataFrame([], STREAM_RAW).select("acquisition_date").union(
        spark.sql(f"select date'{day}'")
    )


def test_discovery(spark, folder):
    day = "2024-01-05"
    with pytest.raises(discovery.MissingSource):
        discovery.discover(spark, folder, day, None)
    only_stream = discovery.discover(spark, folder, day, stream_table(spark, day))
    assert (only_stream.batch_exists, only_stream.stream_exists) == (False, True)
    lake.split_by_day(hotspots(spark), folder, "archive", "t")
    both = discovery.discover(spark, folder, day, stream_table(spark, day))
    assert both.batch_exists and both.stream_exists and both.batch_source.endswith("acq_date=2024-01-05")
    assert not discovery.discover(spark, folder, day, stream_table(spark, "2024-03-01")).stream_exists
    hotspots(spark).where("frp = 1").write.parquet(f"{folder}/archive/2024/01/t_{day}.parquet")
    with pytest.raises(discovery.AmbiguousSource):
        discovery.discover(spark, folder, day, None)


def test_catalogue_answers_for_a_day(spark, folder, monkeypatch):
    catalogue, day = LandingCatalogue(spark, folder), "2024-01-05"
    with pytest.raises(discovery.MissingSource):
        catalogue.discover(day, None)
    catalogue.land(hotspots(spark), "archive", "t")
    found = catalogue.discover(day, stream_table(spark, day))
    assert found.batch_exists and found.stream_exists and found.batch_source.endswith("archive/t")
    entry = catalogue.entries().where(f"day = '{day}'").first()
    assert entry["rows"] == spark.read.parquet(f"{folder}/archive/t").where(f"acq_date = '{day}'").count()
    assert all(day in name for name in entry["files"])
    # Landed again with more, then a second table of the same day.
    catalogue.land(hotspots(spark).union(hotspots(spark)), "archive", "t")
    assert catalogue.entries().where(f"day = '{day}'").first()["rows"] == 2 * entry["rows"]
    catalogue.land(hotspots(spark), "archive", "u")
    with pytest.raises(discovery.AmbiguousSource, match="t.*u"):
        catalogue.discover(day, None)
    catalogue.forget("archive", "u", day)
    assert catalogue.discover(day, None).batch_exists
    report = {str(r["day"]): r["error"] for r in catalogue.discovered(spark.sql("select explode(array(date'2024-01-05', date'2030-01-01')) as day"), stream_table(spark, day)).collect()}
    assert report == {day: None, "2030-01-01": "MISSING_SOURCE"}


def test_csv_feed(spark, folder):
    path = f"{folder}/feed.csv"
    names = [f.name for f in API_CSV]
    with open(path, "w") as out:
        out.write(",".join(names) + "\n-1.5,116.2,330.5,0.4,0.4,2024-01-05,945,N20,VIIRS,n,2.0NRT,290.1,12.5,D\n")
    row = files.read_csv(spark, path, API_CSV).first()
    assert (row.bright_ti4, row.acq_time, str(row.acq_date)) == (330.5, 945, "2024-01-05")


def test_location_csv_appends_with_one_header_each(spark, folder):
    df = spark.sql("select 1 as location_id, 1.5 as latitude_key")
    files.write_locations(df, f"{folder}/out")
    files.write_locations(df, f"{folder}/out", append=True)
    assert spark.read.option("header", True).csv(f"{folder}/out").count() == 2


RING = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
FEATURES = [
    {"properties": {"WADMKK": "Kota  Bogor", "WADMPR": "Jawa Barat"},
     "geometry": {"type": "Polygon", "coordinates": [RING]}},
    {"properties": {"WADMKK": "Kediri", "WADMPR": "Jawa Timur"},
     "geometry": {"type": "MultiPolygon", "coordinates": [[RING], [[[x + 5, y] for x, y in RING]]]}},
    {"properties": {"WADMKK": None, "WADMPR": "Jawa Timur"}, "geometry": {"type": "Polygon", "coordinates": [RING]}},
    {"properties": {"WADMKK": "Nowhere", "WADMPR": "Jawa Timur"}, "geometry": None},
]


def write_geojson(folder, name, features):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        json.dump({"type": "FeatureCollection", "features": [{"type": "Feature", **f} for f in features]}, out, indent=1)


def test_boundaries(spark, folder):
    write_geojson(folder, "a.geojson", FEATURES[:2])
    write_geojson(folder, "b.geojson", FEATURES[2:])
    got = {r["regency_key"]: len(r["rings"]) for r in geojson.read_boundaries(spark, folder).collect()}
    assert got == {"KOTA_BOGOR": 1, "KEDIRI": 2}
    assert geojson.read_boundaries(spark, folder).select("boundary_id").distinct().count() == 2
    with pytest.raises(FileNotFoundError):
        geojson.read_boundaries(spark, f"{folder}/none")


def test_boundary_profile(spark, folder):
    broken = {"properties": {"WADMKK": "X", "WADMPR": "Y"}, "geometry": {"type": "Polygon", "coordinates": [RING[:3]]}}
    write_geojson(folder, "a.geojson", FEATURES[:2])
    write_geojson(folder, "b.geojson", [broken])
    rows = {r["file"][-9:-8]: r for r in geojson.profile_boundaries(spark, folder).collect()}
    assert (rows["a"]["rows"], rows["a"]["geometry_types"], rows["a"]["all_valid"]) == (
        2, ["MultiPolygon", "Polygon"], True,
    )
    assert rows["b"]["all_valid"] is False


def test_name_audit_lists_every_match(spark):
    names = spark.createDataFrame([("Bogor", "JB"), ("Kota Bogor", "JB"), ("Atlantis", "X")], "WADMKK string, WADMPR string")
    reference = spark.createDataFrame(
        [(1, 9, "KABUPATEN BOGOR"), (2, 9, "KOTA BOGOR")], "regency_id bigint, province_id bigint, regency_name string"
    )
    matches = audit.name_matches(names.unionByName(names), reference)
    assert tuple(audit.match_counts(matches).first()) == (4, 1)
    assert [tuple(r) for r in audit.unmatched_names(matches).collect()] == [("Atlantis", "X")]


def coordinate_frame(spark, pairs):
    return spark.createDataFrame(pairs, "latitude double, longitude double")


def test_location_ids_continue_in_order(spark):
    nothing = spark.createDataFrame([], "location_id bigint, latitude_key double, longitude_key double")
    first = coordinates.assign_location_ids(coordinate_frame(spark, [(1.0, 5.0), (1.0, 4.0), (0.5, 9.0), (None, 1.0)]), nothing)
    known = spark.createDataFrame(first.collect(), first.schema)
    assert sorted(map(tuple, known.collect())) == [(1, 0.5, 9.0), (2, 1.0, 4.0), (3, 1.0, 5.0)]
    more = coordinates.assign_location_ids(coordinate_frame(spark, [(1.0, 5.0), (0.0, 0.0), (1.0, 4.5)]), known)
    assert sorted(map(tuple, more.collect())) == [(4, 0.0, 0.0), (5, 1.0, 4.5)]
    assert coordinates.record_locations(known, more).count() == 5


def test_coordinate_profile_of_nothing_is_empty(spark):
    assert coordinates.coordinate_profile(coordinate_frame(spark, [(None, 1.0)])).count() == 0


def test_profile_counts(spark):
    df = coordinate_frame(spark, [(0.01, 0.0), (0.02, 0.0), (0.02, 0.0), (0.4, 0.0)])
    got = {r["precision"]: (r["unique_count"], round(r["reduction_pct"], 2)) for r in coordinates.coordinate_profile(df).collect()}
    assert got[0] == (1, 66.67) and got[1] == (2, 33.33) and got[2] == (3, 0.0)


def test_worklist_slices_the_sorted_list(spark):
    df = coordinate_frame(spark, [(2.0, 1.0), (1.0, 2.0), (1.0, 1.0), (1.001, 1.001), (3.0, 3.0)])
    assert [tuple(r) for r in coordinates.worklist(df, 2).collect()] == [(1.0, 1.0), (1.0, 2.0)]
    assert [tuple(r) for r in coordinates.worklist(df, 2, start=1).collect()] == [(1.0, 2.0), (2.0, 1.0)]
    assert "TakeOrderedAndProject" in explained(coordinates.worklist(df, 2))
