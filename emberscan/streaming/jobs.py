"""Streaming jobs: messages to raw rows, raw rows to enriched rows and to the latest copies.

Sinks: rows and dead letters as two file sinks with a checkpoint each, exactly once by the sink's own
log; or both in one pass (`start_outcome_sink`), batch by batch, with a ledger. Enrichment appends through
`foreachBatch`; a repeated batch stands in the table's ledger, or finds its rows present, and adds nothing.
Keeping the latest copy of each event is stateful, bounded by a watermark.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import storage
from ..operators.guards import broadcast_if_small
from ..operators.incremental import append_unseen, upsert
from ..operators.ledger import BatchLedger
from ..operators.region import attach_regency
from ..operators.spatial import Grid
from ..schemas import STREAM_ENRICHED, STREAM_RAW
from ..session import saved_copy
from ..sources import lake
from . import events


def message_files(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines message files as a stream of `value`."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def broker_messages(spark: SparkSession, **options: str) -> DataFrame:
    """Broker topic as a stream of `value`; the connector jar comes with the deployment."""
    return spark.readStream.format("kafka").options(**options).load().select("value")


def raw_rows(messages: DataFrame, duplicates_within: str | None = None) -> DataFrame:
    """Usable messages as stream rows.

    Duplicates pass through, staging keeps the latest. `duplicates_within`
    (say '1 hour') drops repeats of an event published that close together.
    """
    rows = events.to_stream_rows(events.usable_events(events.decode(messages)))
    if duplicates_within:
        rows = rows.withWatermark("published_timestamp", duplicates_within).dropDuplicatesWithinWatermark(["event_id"])
    return rows


def start_raw_sink(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    duplicates_within: str | None = None,
) -> StreamingQuery:
    writer = (
        raw_rows(messages, duplicates_within)
        .writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy("acquisition_date")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_dead_letter_sink(
    messages: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    writer = (
        events.dead_letters(events.decode(messages))
        .writeStream.format("json").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_outcome_sink(
    spark: SparkSession, messages: DataFrame, raw_path: str, dead_path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Rows and dead letters in one pass: a micro-batch is read and parsed once and both go in under its name.

    Each batch has a folder of its own in both places, so a batch run again replaces what it left; it counts
    once the ledger holds it (`committed_rows`, `committed_letters`), with how many messages went where.
    """
    ledger = BatchLedger(spark, raw_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(spark, checkpoint, batch_id)
        if ledger.holds(name):
            return
        seen = Observation()
        decoded = events.decode(batch).observe(
            seen, F.count(F.lit(1)).alias("sent"), F.count_if(F.col("problem").isNotNull()).alias("dead")
        )
        with saved_copy(decoded, "decoded") as saved:
            rows = events.to_stream_rows(events.usable_events(saved))
            target = f"{raw_path}/batch={name}"
            lake.write_partitioned(rows, target, ["acquisition_date"])
            events.dead_letters(saved).write.mode("overwrite").json(f"{dead_path}/batch={name}")
        days = {path.rsplit("=", 1)[1] for path in storage.glob(spark, f"{target}/acquisition_date=*")}
        ledger.enter(name, days, seen.get["sent"] - seen.get["dead"], seen.get["dead"])

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _committed(table: DataFrame, spark: SparkSession, raw_path: str) -> DataFrame:
    taken = BatchLedger(spark, raw_path).entries().select("batch")
    return table.join(broadcast_if_small(taken), "batch", "left_semi").drop("batch")


def committed_rows(spark: SparkSession, raw_path: str) -> DataFrame:
    """Rows of the batches that the outcome sink has finished."""
    schema = T.StructType([*STREAM_RAW.fields, T.StructField("batch", T.StringType())])
    return _committed(spark.read.schema(schema).parquet(raw_path), spark, raw_path).select(*STREAM_RAW.names)


def committed_letters(spark: SparkSession, raw_path: str, dead_path: str) -> DataFrame:
    """Dead letters (value, problem) of the same batches."""
    return _committed(spark.read.schema("value string, problem string, batch string").json(dead_path), spark, raw_path)


def latest_rows(rows: DataFrame, late_after: str) -> DataFrame:
    """A running table of the latest copy of each event, by staging's order; state per event.

    All copies of an event bear its detection time, which is part of its id. Once the newest detection seen is
    `late_after` past an event's, its state goes and later copies of it are dropped: the latest so far stands.
    """
    rank = [*(F.col(c) for c in ("acquisition_date", "acquisition_time", "ingested_timestamp", "published_timestamp")), F.xxhash64(*rows.columns)]
    named = [c.alias(f"_{n}") for n, c in enumerate(rank)]
    held = F.max(F.struct(*named, F.struct(*rows.columns).alias("row"))).alias("latest")
    watched = rows.withWatermark("detection_timestamp", late_after)
    return watched.groupBy("event_id", "detection_timestamp").agg(held).select("latest.row.*")


def start_latest(
    spark: SparkSession, raw_path: str, latest_path: str, checkpoint: str, late_after: str = "2 days",
    files_per_trigger: int | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Keep a table of the latest copy of each event: every micro-batch upserts the events it changed."""

    def handle(batch: DataFrame, _batch_id: int) -> None:
        # State is recovered with the batch, so a batch run again brings the same rows.
        upsert(batch.sparkSession, latest_path, batch, "event_id", "acquisition_date", key_pins_partition=True)

    reader = spark.readStream.schema(STREAM_RAW)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    changed = latest_rows(reader.parquet(raw_path).select(*STREAM_RAW.names), late_after)
    writer = changed.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def enrich_rows(rows: DataFrame, index: DataFrame, grid: Grid, on_multiple: str = "first") -> DataFrame:
    """Stream rows with their regency; rows without usable coordinates are left out."""
    return attach_regency(rows, index, grid, on_multiple).select(*STREAM_ENRICHED.names)


def enrich_unseen(
    spark: SparkSession, raw_path: str, enriched_path: str, index: DataFrame, grid: Grid,
    on_multiple: str = "first",
) -> int:
    """One pass over the raw table: enrich and append what is not yet enriched. Returns rows appended."""
    raw = spark.read.schema(STREAM_RAW).parquet(raw_path).select(*STREAM_RAW.names)
    return append_unseen(
        spark, enriched_path, raw, "event_id",
        prepare=lambda fresh: enrich_rows(fresh, index, grid, on_multiple), saved=True,
    )


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A name for a micro-batch that no other checkpoint gives: numbers start anew with each checkpoint."""
    return f"{json.loads(storage.read_text(spark, f'{checkpoint}/metadata'))['id']}-{batch_id}"


def start_enrichment(
    spark: SparkSession, raw_path: str, enriched_path: str, checkpoint: str, index: DataFrame, grid: Grid,
    on_multiple: str = "first", available_now: bool = True,
) -> StreamingQuery:
    """The same as a stream over the raw table: each run reads only new files."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        append_unseen(
            batch.sparkSession, enriched_path, batch, "event_id",
            prepare=lambda fresh: enrich_rows(fresh, index, grid, on_multiple),
            batch=batch_name(spark, checkpoint, batch_id), saved=True,
        )

    writer = (
        spark.readStream.schema(STREAM_RAW).parquet(raw_path)
        .select(*STREAM_RAW.names)
        .writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def publish(rows: DataFrame, folder: str, names: dict[str, str] | None = None) -> None:
    """Encode rows as messages and append them as text files."""
    events.encode(events.to_events(rows, names)).select(F.col("value")).write.mode("append").text(folder)
