"""Versioned tables: readers, reloads, and writers that die at any step."""

import pytest
from pyspark.sql import functions as F

from emberscan import storage
from emberscan.sources.versions import VersionConflict, VersionedTable


def rows(spark, *values):
    made = spark.createDataFrame(list(values), "id string, v int, d string")
    return made.select("id", "v", F.col("d").cast("date").alias("acq_date"))


def content(df):
    return sorted((r["id"], r["v"], str(r["acq_date"])) for r in df.collect())


@pytest.fixture
def table(spark, folder):
    held = VersionedTable(spark, f"{folder}/t", "acq_date", ["id"])
    held.overwrite(rows(spark, ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("n", 1, None)))
    return held


def test_a_day_loaded_again_takes_its_place(spark, table):
    load = rows(spark, ("c", 2, "2024-01-02"), ("u", 2, None))
    for _ in range(2):
        table.load(load, "2024-01-02")
        assert content(table.read()) == [("a", 1, "2024-01-01"), ("c", 2, "2024-01-02"), ("n", 1, "None"), ("u", 2, "None")]
    # Corrected to nothing: the day and what rode along with it are gone, other days stay.
    table.load(load.where("false"), "2024-01-02")
    assert content(table.read()) == [("a", 1, "2024-01-01"), ("n", 1, "None")]
    assert content(table.read(version=1)) == [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("n", 1, "None")]


def test_days_are_pruned_by_the_manifest(table):
    one = table.read(["2024-01-01"])
    assert content(one) == [("a", 1, "2024-01-01")] and all("2024-01-01" in f for f in one.inputFiles())
    assert table.read(["2030-01-01"]).count() == 0


@pytest.mark.parametrize("step", ["glob", "write_text", "create_text", "move"])
def test_a_writer_that_dies_changes_nothing(spark, table, monkeypatch, step):
    before = content(table.read())

    def die(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        real = getattr(storage, step)
        # The manifests are listed to find the version; it is the parts' listing that fails.
        patched.setattr(storage, step, (lambda s, p: die() if "_part" in p else real(s, p)) if step == "glob" else die)
        with pytest.raises(OSError):
            table.overwrite(rows(spark, ("z", 9, "2024-02-02")))
    assert content(table.read()) == before
    table.overwrite(rows(spark, ("z", 9, "2024-02-02")))
    assert content(table.read()) == [("z", 9, "2024-02-02")]


def test_a_job_that_fails_while_writing_changes_nothing(spark, table):
    before = content(table.read())
    broken = rows(spark, ("z", 9, "2024-02-02")).withColumn("v", F.expr("cast(assert_true(v < 0) as int)"))
    with pytest.raises(Exception, match="assert_true|is not true"):
        table.overwrite(broken)
    assert content(table.read()) == before
    assert table.vacuum() == 0


def test_drafts_are_read_before_they_are_published(spark, table):
    draft = table.stage_load(rows(spark, ("x", 5, "2024-01-01")), "2024-01-01")
    other = table.stage_load(rows(spark, ("y", 6, "2024-01-01")), "2024-01-01")
    assert ("x", 5, "2024-01-01") in content(draft.read()) and ("a", 1, "2024-01-01") in content(table.read())
    draft.publish()
    assert ("x", 5, "2024-01-01") in content(table.read())
    with pytest.raises(VersionConflict):
        other.publish()


def test_vacuum_keeps_what_the_last_versions_use(spark, table):
    for v in (2, 3):
        table.load(rows(spark, ("a", v, "2024-01-01")), "2024-01-01")
    table.stage_load(rows(spark, ("lost", 0, "2024-01-01")), "2024-01-01")
    assert table.vacuum(keep=2) == 2
    assert table.versions() == [2, 3] and content(table.read(version=2))[0] == ("a", 2, "2024-01-01")
    assert table.vacuum() == 1 and content(table.read())[0] == ("a", 3, "2024-01-01")


def test_a_table_without_days_and_an_empty_one(spark, folder):
    held = VersionedTable(spark, f"{folder}/t")
    assert not held.exists()
    held.overwrite(rows(spark, ("a", 1, "2024-01-01")).where("false"))
    assert held.exists() and held.read().columns == ["id", "v", "acq_date"] and held.read().count() == 0
    held.overwrite(rows(spark, ("a", 1, None)))
    held.replace_part(rows(spark, ("r", 1, None)), "rejects")
    assert held.read().count() == 2
    held.replace_part(rows(spark, ("r", 1, None)).where("false"), "rejects")
    assert content(held.read()) == [("a", 1, "None")]
