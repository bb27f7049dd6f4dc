"""Column rules on adversarial values."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberscan.functions import coerce, keys, labels, places, times


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


VERSIONS = ["2.0NRT", "2.0URT", "2.0RT", "2", "2.0", "ABCRT", "2.0XYZ", "beta", "2.0nrt", None]


def test_clock_time(spark):
    assert column(spark, [0, 5, 30, 945, 2359, None], "int", times.clock_time) == [
        "00:00:00", "00:05:00", "00:30:00", "09:45:00", "23:59:00", None,
    ]
    assert column(spark, ["0945", "945"], "string", times.clock_time) == ["09:45:00"] * 2


@pytest.mark.parametrize("bad", [2460, 9930])
def test_clock_time_rejects(spark, bad):
    with pytest.raises(Exception, match="not an HHMM time"):
        column(spark, [bad], "int", times.clock_time)


def test_moments_do_not_depend_on_session_zone(spark):
    df = spark.sql("select date'2024-02-29' as d, '23:59:00' as t union all select null, '01:00:00'")
    made = df.select(
        times.detection_datetime(F.col("d"), F.col("t")).cast("string").alias("local"),
        times.detection_timestamp(F.col("d"), F.col("t")).cast("bigint").alias("epoch"),
    )
    expected = {("2024-02-29 23:59:00", 1709251140), (None, None)}
    assert {tuple(r) for r in made.collect()} == expected
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        assert {tuple(r) for r in made.collect()} == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names_of_months_and_days(spark):
    assert column(spark, [1, 12, None], "int", times.month_name) == ["JANUARY", "DECEMBER", "UNKNOWN"]
    assert column(spark, [1, 7, None], "int", times.day_name) == ["SUNDAY", "SATURDAY", "UNKNOWN"]


def test_warehouse_version_rule(spark):
    assert column(spark, VERSIONS, "string", labels.leading_version) == [
        "2.0", "2.0", "2.0", "2", "2.0", None, "2.0", None, "2.0", None,
    ]
    assert column(spark, VERSIONS, "string", labels.processing_label) == [
        "NEAR_REAL_TIME", "ULTRA_REAL_TIME", "REAL_TIME", "STANDARD", "STANDARD",
        "REAL_TIME", "UNKNOWN", "UNKNOWN", "NEAR_REAL_TIME", "UNKNOWN",
    ]


def test_stream_version_rule(spark):
    assert column(spark, VERSIONS, "string", labels.stream_version) == [
        "2.0", "2.0", "2.0", "2", "2.0", None, None, None, "2.0", None,
    ]
    assert column(spark, VERSIONS, "string", labels.stream_processing_label) == [
        "NEAR_REAL_TIME", "ULTRA_REAL_TIME", "REAL_TIME", "STANDARD", "STANDARD",
        "UNKNOWN", "UNKNOWN", "UNKNOWN", "NEAR_REAL_TIME", "UNKNOWN",
    ]


def test_code_labels(spark):
    assert column(spark, ["H", "n", None], "string", labels.confidence_label) == ["HIGH", "NOMINAL", "UNKNOWN"]
    assert column(spark, ["d", "N", None], "string", labels.period_label) == ["DAY", "NIGHT", "UNKNOWN"]
    assert column(spark, ["snpp", "Terra", None], "string", labels.satellite_label) == [
        "SUOMI NPP", "UNKNOWN", "UNKNOWN",
    ]
    assert column(spark, [0, 1, 2, 3, 9, None], "bigint", labels.type_label) == [
        "VEGETATION_FIRE", "ACTIVE_VOLCANO", "STATIC_LAND_SOURCE", "OFFSHORE", "UNKNOWN", "UNKNOWN",
    ]


NAMES = ["KABUPATEN BOGOR", "Kota  Bogor", "BOGOR", " kota\tbogor ", "Kep. Siau Tagulandang Biaro", None]


def test_name_keys(spark):
    assert column(spark, NAMES, "string", keys.admin_name_key) == [
        "BOGOR", "KOTA_BOGOR", "BOGOR", "KOTA_BOGOR", "SIAUTAGULANDANGBIARO", "",
    ]
    assert column(spark, NAMES, "string", keys.loose_name_key) == [
        "BOGOR", "BOGOR", "BOGOR", "KOTA\tBOGOR".replace("\t", " "), "KEP. SIAU TAGULANDANG BIARO", None,
    ]


def test_detection_id_matches_the_publishers_text(spark):
    rows = [(-1.5, 116.25, "2024-01-05", 945, "N20", None), (None, 1.0, "2024-01-05", 0, "N20", "VIIRS")]
    df = spark.createDataFrame(
        rows, "latitude double, longitude double, acq_date string, acq_time int, satellite string, instrument string"
    )
    got = [r[0] for r in df.select(keys.detection_id()).collect()]
    assert got == [hashlib.md5(b"-1.5|116.25|2024-01-05|945|N20|").hexdigest(), None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-18_000_000, 18_000_000) | st.integers(-150, 150), min_size=50, max_size=200))
def test_coordinate_text_is_the_publishers(spark, hundred_thousandths):
    """Feeds carry five decimals; near zero the two runtimes would print them differently."""
    values = [n / 1e5 for n in hundred_thousandths]
    assert column(spark, values, "double", keys.coordinate_text) == [repr(v) for v in values]


def test_surrogate_key_marks_nulls(spark):
    df = spark.sql("select 'a' as x, cast(null as bigint) as y, -999L as z")
    text = "a-_dbt_utils_surrogate_key_null_--999"
    assert df.select(keys.surrogate_key("x", "y", "z")).first()[0] == hashlib.md5(text.encode()).hexdigest()


def test_lenient_numbers(spark):
    df = spark.createDataFrame([(v,) for v in ["1.5", " 2 ", "abc", "2d", "NaN", "1e2", "", None]], "v string")
    assert [r[0] for r in df.select(coerce.lenient_double(df, "v")).collect()] == [
        1.5, 2.0, None, None, None, 100.0, None, None,
    ]
    assert [r[0] for r in df.select(coerce.lenient_long(df, "v")).collect()] == [
        None, 2, None, None, None, 100, None, None,
    ]


def test_location_text(spark):
    texts = ["Jalan 1, Bogor , Jawa Barat", "Bogor, Jawa Barat", "", None]
    got = column(spark, texts, "string", places.location_parts)
    assert [tuple(r) for r in got] == [
        ("Bogor", "Jawa Barat", "Indonesia"), (None, None, "Indonesia"), (None, None, None), (None, None, None),
    ]


def test_rounding_follows_binary_half_even(spark):
    import numpy as np

    values = [0.125, 0.375, -0.004, 122.915, 2.675, -6.685]
    got = column(spark, values, "double", lambda c: places.rounded_degrees(c, 2))
    assert got == [float(np.round(v, 2) + 0.0) for v in values]
