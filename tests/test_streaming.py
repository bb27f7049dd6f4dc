"""Messages, the two streaming jobs, and restarts on one checkpoint."""

import json
import os

import pytest
from pyspark.sql import functions as F

from emberscan.operators.ledger import BatchLedger
from emberscan.operators.spatial import build_cell_index
from emberscan.schemas import EVENT, STREAM_ENRICHED, STREAM_RAW
from emberscan.streaming import events, jobs

from .plans import explained
from .test_spatial import TWINS, frame

EVENT_ROW = dict(
    event_id="e1", source="NASA_FIRMS", source_table="fire_detection_nrt", schema_version="1.0",
    published_timestamp="2024-01-05T10:00:00.000000Z", latitude=1.0, longitude=1.0, brightness=330.0, scan=0.4,
    track=0.4, acq_date="2024-01-05", acq_time=945, satellite="N20", instrument="VIIRS", confidence="h",
    version="2.0NRT", bright_t31=290.0, frp=12.5, daynight="D",
)


def message(**changes):
    row = {**EVENT_ROW, **changes}
    return json.dumps({k: v for k, v in row.items() if v is not ...})


def decoded(spark, *texts):
    return events.decode(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_problems(spark):
    cases = {
        message(): None,
        message()[:40]: "MALFORMED_JSON",
        "": "MALFORMED_JSON",
        message(event_id=...): "MISSING_FIELD",
        message(frp=None): "MISSING_FIELD",
        message(latitude="1.0"): "MALFORMED_JSON",
        message(acq_time=2460): "INVALID_VALUE",
        message(acq_date="2024-13-01"): "INVALID_VALUE",
        message(published_timestamp="yesterday"): "INVALID_VALUE",
    }
    got = {r["value"]: r["problem"] for r in decoded(spark, *cases).collect()}
    assert got == cases


def test_usable_and_dead_partition_the_input(spark):
    d = decoded(spark, message(), "{", message(event_id="e2"))
    assert events.usable_events(d).columns == EVENT.names
    assert events.usable_events(d).count() + events.dead_letters(d).count() == 3


def test_stream_row(spark):
    rows = events.to_stream_rows(events.usable_events(decoded(spark, message(version="2.0XYZ"))))
    assert rows.schema.simpleString() == STREAM_RAW.simpleString()
    row = rows.first()
    assert (row.acquisition_time, row.detection_hour, row.detection_day_of_week) == ("09:45:00", 9, 6)
    assert str(row.detection_datetime) == "2024-01-05 09:45:00"
    assert (row.collection_version, row.processing_type, row.satellite_label) == (None, "UNKNOWN", "NOAA-20")


def test_feed_and_archive_give_one_event(spark):
    archive = spark.createDataFrame(
        [(1.0, 2.0, 330.0, 0.4, 0.4, "2024-01-05", 945, "N20", "VIIRS", "h", "2.0NRT", 290.0, 12.5, "D")],
        "latitude double, longitude double, brightness double, scan double, track double, acq_date string, acq_time int,"
        " satellite string, instrument string, confidence string, version string, bright_t31 double, frp double,"
        " daynight string",
    )
    ours = events.to_events(archive).drop("published_timestamp")
    theirs = events.to_events(archive.withColumnsRenamed(events.API_NAMES), events.API_NAMES)
    assert ours.collect() == theirs.drop("published_timestamp").collect()
    again = events.decode(events.encode(events.to_events(archive)).select("value"))
    assert events.usable_events(again).drop("published_timestamp").collect() == ours.collect()


def drop_messages(folder, name, *texts):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}", "w") as out:
        out.write("\n".join(texts) + "\n")


def run_all(spark, folder, index, grid):
    source = jobs.message_files(spark, f"{folder}/in")
    jobs.start_raw_sink(source, f"{folder}/raw", f"{folder}/cp1").awaitTermination()
    jobs.start_dead_letter_sink(source, f"{folder}/dead", f"{folder}/cp2").awaitTermination()
    jobs.start_enrichment(spark, f"{folder}/raw", f"{folder}/enriched", f"{folder}/cp3", index, grid).awaitTermination()
    return (
        spark.read.parquet(f"{folder}/raw").count(),
        spark.read.schema("value string, problem string").json(f"{folder}/dead").count(),
        spark.read.parquet(f"{folder}/enriched"),
    )


def test_three_runs_on_one_checkpoint(spark, folder):
    index, grid = build_cell_index(frame(spark, TWINS), ["regency_id"])
    drop_messages(folder, "1.json", message(), message(), "{broken", message(event_id="far", longitude=50.0))
    raw, dead, enriched = run_all(spark, folder, index, grid)
    assert (raw, dead) == (3, 1)
    assert enriched.select(*STREAM_ENRICHED.names).count() == 3
    drop_messages(folder, "2.json", message(), message(event_id="e2", longitude=3.0))
    raw, dead, enriched = run_all(spark, folder, index, grid)
    assert (raw, dead) == (5, 1)
    found = {(r.event_id, r.regency_id) for r in enriched.collect()}
    assert found == {("e1", 1), ("far", None), ("e2", 2)}
    assert enriched.count() == 4
    raw, dead, enriched = run_all(spark, folder, index, grid)
    assert (raw, dead, enriched.count()) == (5, 1, 4)
    # The one-pass form over the same tables finds nothing left to do.
    assert jobs.enrich_unseen(spark, f"{folder}/raw", f"{folder}/enriched", index, grid) == 0
    assert jobs.enrich_unseen(spark, f"{folder}/raw", f"{folder}/fresh", index, grid) == 5



def test_stream_equals_batch(spark, folder):
    texts = [message(event_id=f"e{i}", acq_time=i % 60, longitude=float(i % 7)) for i in range(50)]
    drop_messages(folder, "1.json", *texts[:20])
    drop_messages(folder, "2.json", *texts[20:])
    jobs.start_raw_sink(jobs.message_files(spark, f"{folder}/in", 1), f"{folder}/raw", f"{folder}/cp").awaitTermination()
    streamed = spark.read.schema(STREAM_RAW).parquet(f"{folder}/raw").select(*STREAM_RAW.names).drop("ingested_timestamp")
    batch = events.to_stream_rows(events.usable_events(decoded(spark, *texts))).drop("ingested_timestamp")
    assert sorted(streamed.collect(), key=str) == sorted(batch.collect(), key=str)


def test_repeats_can_be_dropped_in_the_stream(spark, folder):
    drop_messages(folder, "1.json", message(), message(), message(event_id="e2"))
    source = jobs.message_files(spark, f"{folder}/in")
    jobs.start_raw_sink(source, f"{folder}/raw", f"{folder}/cp", duplicates_within="1 hour").awaitTermination()
    assert spark.read.parquet(f"{folder}/raw").count() == 2


def outcome(spark, folder):
    return (
        jobs.committed_rows(spark, f"{folder}/raw").count(),
        sorted(r["problem"] for r in jobs.committed_letters(spark, f"{folder}/raw", f"{folder}/dead").collect()),
        sum(r["rows"] + r["dead"] for r in BatchLedger(spark, f"{folder}/raw").entries().collect()),
    )


def run_outcomes(spark, folder, per_trigger=None):
    source = jobs.message_files(spark, f"{folder}/in", per_trigger)
    jobs.start_outcome_sink(spark, source, f"{folder}/raw", f"{folder}/dead", f"{folder}/cp").awaitTermination()
    return outcome(spark, folder)


def test_every_message_becomes_a_row_or_a_letter(spark, folder):
    drop_messages(folder, "1.json", message(), message(), "{broken", message(acq_time=2460))
    assert run_outcomes(spark, folder) == (2, ["INVALID_VALUE", "MALFORMED_JSON"], 4)
    drop_messages(folder, "2.json", "{}")
    drop_messages(folder, "3.json", message(event_id="e2"))
    assert run_outcomes(spark, folder, 1) == (3, ["INVALID_VALUE", "MALFORMED_JSON", "MISSING_FIELD"], 6)
    assert run_outcomes(spark, folder) == (3, ["INVALID_VALUE", "MALFORMED_JSON", "MISSING_FIELD"], 6)


def test_a_batch_that_died_counts_once_when_it_is_done(spark, folder, monkeypatch):
    drop_messages(folder, "1.json", message(), "{broken")
    with monkeypatch.context() as patched:
        patched.setattr(BatchLedger, "enter", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            run_outcomes(spark, folder)
    # Rows and letters stand, uncommitted: nobody sees them yet.
    assert outcome(spark, folder) == (0, [], 0)
    assert run_outcomes(spark, folder) == (1, ["MALFORMED_JSON"], 2)


def test_a_message_is_parsed_once(spark):
    rows = events.to_stream_rows(events.usable_events(decoded(spark, message())))
    assert explained(rows, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0].count("from_json") == 1


def stream_frame(spark, *copies):
    texts = [message(event_id=e, frp=frp, published_timestamp=f"2024-03-01T{at:02}:00:00.000000Z", acq_date=day) for e, frp, at, day in copies]
    rows = events.to_stream_rows(events.usable_events(decoded(spark, *texts)), F.col("published_timestamp").cast("timestamp"))
    return rows.select(*STREAM_RAW.names)


def test_state_keeps_the_latest_copy(spark, folder):
    """In any order, over any batch borders, and after a restart: what staging would keep."""
    copies = [("a", 1.0, 3, "2024-01-05"), ("b", 2.0, 1, "2024-01-05"), ("a", 3.0, 9, "2024-01-05"), ("a", 2.0, 5, "2024-01-05"), ("b", 9.0, 2, "2024-01-05")]
    for n, copy in enumerate(copies[:3]):
        stream_frame(spark, copy).write.parquet(f"{folder}/raw/{n}.parquet")
    source = f"{folder}/raw/*"
    start = dict(late_after="2 days", files_per_trigger=1)

    def run():
        jobs.start_latest(spark, source, f"{folder}/latest", f"{folder}/cp", **start).awaitTermination()
        return {r.event_id: r.fire_radiative_power for r in spark.read.parquet(f"{folder}/latest").collect()}

    assert run() == {"a": 3.0, "b": 2.0}
    for n, copy in enumerate(copies[3:], 3):
        stream_frame(spark, copy).write.parquet(f"{folder}/raw/{n}.parquet")
    assert run() == {"a": 3.0, "b": 9.0} == run()


def test_copies_beyond_the_watermark_are_dropped(spark, folder):
    source, start = f"{folder}/raw/*", dict(late_after="2 days")
    found = None
    for n, copy in enumerate([("a", 1.0, 1, "2024-01-05"), ("c", 1.0, 1, "2024-02-05"), ("d", 1.0, 1, "2024-02-05"), ("a", 7.0, 9, "2024-01-05")]):
        stream_frame(spark, copy).write.parquet(f"{folder}/raw/{n}.parquet")
        jobs.start_latest(spark, source, f"{folder}/latest", f"{folder}/cp", **start).awaitTermination()
        found = {r.event_id: r.fire_radiative_power for r in spark.read.parquet(f"{folder}/latest").collect()}
    assert found == {"a": 1.0, "c": 1.0, "d": 1.0}


def test_state_of_the_latest_copies_lies_on_disk(spark, folder):
    """A state held in the heap would bound how many events there may be."""
    stream_frame(spark, ("a", 1.0, 3, "2024-01-05")).write.parquet(f"{folder}/raw")
    jobs.start_latest(spark, f"{folder}/raw", f"{folder}/latest", f"{folder}/cp", late_after="60 days").awaitTermination()
    with open(f"{folder}/cp/offsets/0") as log:
        assert "RocksDBStateStoreProvider" in log.read()
