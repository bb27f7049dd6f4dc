"""Incremental writes: idempotence, untouched days, guards."""

import os

import pytest
from pyspark.sql import functions as F

from emberscan import storage
from emberscan.operators import incremental
from emberscan.operators.directory import KeyDirectory
from emberscan.operators.guards import DateGuardError, DuplicateKey, fits_broadcast
from emberscan.operators.ledger import BatchLedger
from emberscan.operators.skew import salted_left_join
from emberscan.sources import lake

SCHEMA = "detection_id string, v int, acquisition_date date"


def rows(spark, *values):
    made = spark.createDataFrame(list(values), "detection_id string, v int, d string")
    return made.select("detection_id", "v", F.col("d").cast("date").alias("acquisition_date"))


def content(spark, path):
    return {tuple(map(str, r)) for r in spark.read.parquet(path).select("detection_id", "v", "acquisition_date").collect()}


def day_files(path, day):
    folder = f"{path}/acquisition_date={day}"
    return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder) if f.endswith(".parquet")}


@pytest.mark.parametrize("pinned", [True, False])
def test_upsert(spark, folder, pinned):
    path = f"{folder}/t"
    base = rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("c", 1, "2024-01-03"))
    incremental.upsert(spark, path, base, key_pins_partition=pinned)
    untouched = day_files(path, "2024-01-01")
    change = rows(spark, ("b", 2, "2024-01-02"), ("d", 2, "2024-01-02"))
    for _ in range(2):
        incremental.upsert(spark, path, change, key_pins_partition=pinned)
        assert content(spark, path) == {
            ("a", "1", "2024-01-01"), ("b", "2", "2024-01-02"), ("d", "2", "2024-01-02"), ("c", "1", "2024-01-03"),
        }
    assert day_files(path, "2024-01-01") == untouched


def test_upsert_moves_a_row_to_another_day(spark, folder):
    path = f"{folder}/t"
    incremental.upsert(spark, path, rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")))
    incremental.upsert(spark, path, rows(spark, ("a", 2, "2024-01-02")))
    assert content(spark, path) == {("a", "2", "2024-01-02"), ("b", "1", "2024-01-02")}


def spoil(path, day):
    """Make a day unreadable: whoever scans it fails."""
    for name in day_files(path, day):
        with open(f"{path}/acquisition_date={day}/{name}", "wb") as out:
            out.write(b"no parquet")


def test_upsert_reads_no_day_without_incoming_keys(spark, folder):
    path = f"{folder}/t"
    incremental.upsert(spark, path, rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("c", 1, "2024-01-03")))
    spoil(path, "2024-01-01")
    assert incremental.upsert(spark, path, rows(spark, ("c", 2, "2024-01-02"), ("d", 2, "2024-01-04"))) == 3
    left = spark.read.schema(SCHEMA).parquet(path).where("acquisition_date > date '2024-01-01'")
    assert {(r.detection_id, r.v, str(r.acquisition_date)) for r in left.collect()} == {
        ("b", 1, "2024-01-02"), ("c", 2, "2024-01-02"), ("d", 2, "2024-01-04"),
    }


def test_directory_reads_the_buckets_of_the_keys_alone(spark, folder):
    path = f"{folder}/t"
    many = spark.range(500).selectExpr("cast(id as string) as detection_id", "1 as v", "date '2024-01-01' as acquisition_date")
    incremental.upsert(spark, path, many, buckets=16)
    directory = KeyDirectory.of(spark, path, many, "detection_id", "acquisition_date", 16)
    found = directory.found(many.where("detection_id = '7'"))
    assert [tuple(map(str, r)) for r in found.collect()] == [("7", "2024-01-01")]
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) == 1
    directory.record(many)
    directory.compact()
    pairs = directory.bucket(range(16))
    assert pairs.count() == 500 and len(pairs.inputFiles()) <= 16


def test_a_table_without_a_directory_gets_one(spark, folder):
    path = f"{folder}/t"
    incremental.upsert(spark, path, rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")), key_pins_partition=True)
    incremental.upsert(spark, path, rows(spark, ("a", 2, "2024-01-02")))
    assert content(spark, path) == {("a", "2", "2024-01-02"), ("b", "1", "2024-01-02")}


@pytest.mark.parametrize("next_day", ["2024-01-02", "2024-01-03"])
def test_upsert_after_a_job_that_died(spark, folder, monkeypatch, next_day):
    """Died between directory and table: the retry, or another batch instead, still finds where the key really is."""
    path = f"{folder}/t"
    incremental.upsert(spark, path, rows(spark, ("a", 1, "2024-01-01")))

    def die(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(lake, "write_partitioned", die)
        with pytest.raises(OSError):
            incremental.upsert(spark, path, rows(spark, ("a", 2, "2024-01-02")))
    incremental.upsert(spark, path, rows(spark, ("a", 3, next_day)))
    assert content(spark, path) == {("a", "3", next_day)}


def test_rows_without_a_key_are_replaced_by_day(spark, folder):
    path = f"{folder}/t"
    load = rows(spark, (None, 1, "2024-01-01"), (None, 2, "2024-01-01"), ("a", 1, "2024-01-02"))
    for _ in range(2):
        incremental.upsert(spark, path, load)
        assert spark.read.parquet(path).count() == 3
    incremental.upsert(spark, path, rows(spark, (None, 7, "2024-01-02")))
    assert spark.read.parquet(path).count() == 4


def test_upsert_rejects_repeated_keys_and_ignores_nothing(spark, folder):
    path = f"{folder}/t"
    with pytest.raises(DuplicateKey, match="a"):
        incremental.upsert(spark, path, rows(spark, ("a", 1, "2024-01-01"), ("a", 2, "2024-01-01")))
    assert incremental.upsert(spark, path, rows(spark, ("a", 1, "2024-01-01")).where("false")) == 0
    assert not storage.has_table(spark, path)


def test_overwrite_dates_keeps_other_days(spark, folder):
    path = f"{folder}/t"
    incremental.overwrite_dates(rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")), path)
    kept = day_files(path, "2024-01-01")
    incremental.overwrite_dates(rows(spark, ("x", 5, "2024-01-02")), path)
    assert content(spark, path) == {("a", "1", "2024-01-01"), ("x", "5", "2024-01-02")}
    assert day_files(path, "2024-01-01") == kept


def test_replace_date(spark, folder):
    path = f"{folder}/t"
    base = rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"))
    lake.write_partitioned(base, path, ["acquisition_date"])
    day = rows(spark, ("c", 3, "2024-01-02"))
    for _ in range(2):
        assert incremental.replace_date(spark, path, day, "acquisition_date") == 1
        assert content(spark, path) == {("a", "1", "2024-01-01"), ("c", "3", "2024-01-02")}
    assert incremental.replace_date(spark, path, day.where("false"), "acquisition_date") == 0


def test_date_guard(spark, folder):
    two = rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"))
    for bad in (two, two.withColumn("acquisition_date", F.lit(None).cast("date"))):
        with pytest.raises(DateGuardError):
            incremental.replace_date(spark, f"{folder}/t", bad, "acquisition_date")
    mixed = rows(spark, ("a", 1, "2024-01-01"), ("n", 1, None))
    assert incremental.replace_date(spark, f"{folder}/t", mixed, "acquisition_date") == 2
    assert spark.read.parquet(f"{folder}/t").where("acquisition_date is null").count() == 1
    other = rows(spark, ("b", 1, "2024-01-02"), ("n", 2, None))
    for load in (mixed, other, other):
        incremental.replace_date(spark, f"{folder}/t", load, "acquisition_date")
    assert content(spark, f"{folder}/t") == {
        ("a", "1", "2024-01-01"), ("b", "1", "2024-01-02"), ("n", "1", "None"), ("n", "2", "None"),
    }


def test_append_unseen_is_idempotent(spark, folder):
    path = f"{folder}/t"
    first = rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"))
    assert incremental.append_unseen(spark, path, first, "detection_id") == 2
    more = first.unionByName(rows(spark, ("c", 1, "2024-01-02")))
    assert incremental.append_unseen(spark, path, more, "detection_id") == 1
    assert incremental.append_unseen(spark, path, more, "detection_id") == 0
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("pinned", [True, False])
def test_append_unseen_reads_no_other_day(spark, folder, pinned):
    path = f"{folder}/t"
    incremental.append_unseen(spark, path, rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")), "detection_id", key_pins_partition=pinned)
    spoil(path, "2024-01-01")
    more = rows(spark, ("b", 1, "2024-01-02"), ("c", 1, "2024-01-03"))
    assert incremental.append_unseen(spark, path, more, "detection_id", key_pins_partition=pinned) == 1


def test_append_unseen_finds_a_key_in_another_day(spark, folder):
    path = f"{folder}/t"
    for load, fresh in ((rows(spark, ("a", 1, "2024-01-01")), 1), (rows(spark, ("a", 1, "2024-01-02"), ("b", 1, "2024-01-02")), 1)):
        assert incremental.append_unseen(spark, path, load, "detection_id", key_pins_partition=False) == fresh


def test_a_batch_is_taken_in_once(spark, folder, monkeypatch):
    path = f"{folder}/t"
    first, second = rows(spark, ("a", 1, "2024-01-01"), ("a", 2, "2024-01-01")), rows(spark, ("b", 1, "2024-01-02"))
    with monkeypatch.context() as patched:
        patched.setattr(BatchLedger, "enter", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            incremental.append_unseen(spark, path, first, "detection_id", batch="x/1")
    # The rows stand, the ledger does not know: the retry adds nothing and enters the batch.
    assert incremental.append_unseen(spark, path, first, "detection_id", batch="x/1") == 0
    assert incremental.append_unseen(spark, path, second, "detection_id", batch="x/2") == 1
    spoil(path, "2024-01-02")
    # Replays do not even look at the table.
    assert incremental.append_unseen(spark, path, second, "detection_id", batch="x/2") == 0
    entries = BatchLedger(spark, path).entries()
    assert {(r.batch, tuple(r.days), r.rows) for r in entries.collect()} == {("x/1", ("2024-01-01",), 0), ("x/2", ("2024-01-02",), 1)}


def test_append_unseen_writes_rows_once(spark, folder, monkeypatch):
    """Saved rows go straight into the table, counted on the way: no copy of them, nor of what they become."""
    copies = []
    real = incremental.saved_copy
    monkeypatch.setattr(incremental, "saved_copy", lambda df, label: copies.append(label) or real(df, label))
    path = f"{folder}/t"
    first = rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("b", 2, "2024-01-02"))
    assert incremental.append_unseen(spark, path, first, "detection_id", saved=True) == 3
    more = first.unionByName(rows(spark, ("c", 1, "2024-01-02")))
    assert incremental.append_unseen(spark, path, more, "detection_id", saved=True) == 1
    assert copies == []
    assert incremental.append_unseen(spark, path, more, "detection_id") == 0
    assert copies == ["batch"]
    assert spark.read.parquet(path).count() == 4


def test_unseen_rows_without_a_broadcast(spark, monkeypatch):
    incoming = rows(spark, ("a", 1, "2024-01-01"), ("c", 1, "2024-01-01"), (None, 1, "2024-01-01"))
    target = rows(spark, ("a", 1, "2024-01-01"))
    small = incremental.unseen_rows(incoming, target, "detection_id").collect()
    monkeypatch.setattr(incremental, "fits_broadcast", lambda _df: False)
    large = incremental.unseen_rows(incoming, target, "detection_id").collect()
    assert {r.detection_id for r in small} == {r.detection_id for r in large} == {"c", None}


def test_broadcast_is_refused_beyond_its_bounds(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("text"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=50_000)


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = left.join(right, "k", "left")
    salted = salted_left_join(left, right, ["k"], hot_rows=100)
    assert sorted(salted.select("k", "id", "w").collect(), key=str) == sorted(plain.collect(), key=str)


def test_a_hot_day_is_split_over_files(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(60_000).select(
            F.uuid().alias("detection_id"), F.lit(1).alias("v"), F.lit("2024-01-01").cast("date").alias("acquisition_date")
        )
        lake.write_partitioned(df.repartition(8), f"{folder}/t", ["acquisition_date"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(day_files(f"{folder}/t", "2024-01-01")) > 1
