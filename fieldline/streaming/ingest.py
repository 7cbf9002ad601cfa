"""Structured Streaming ingestion of landed pitch files.

The streaming form watches the landing folder with a file source and merges each micro-batch into
the table in ``foreachBatch``: per pitch key the newest copy stays, and the rows of a date that came in
other batches stay as they are. A date may therefore be split over any number of batches, a file may
come late, and a replayed micro-batch after a failure changes nothing. Progress is kept in the
checkpoint location, which must be shared storage on a cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldline.sources import payloads
from fieldline.sources import tables as TB


def landed_pitches(spark: SparkSession, folder: str, schema: StructType,
                   fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def merge_pitches_sink(table_path: str, date_col: str = "game_date",
                       pitch_key: Sequence[str] = ("game_pk", "at_bat_number", "pitch_number"),
                       loaded_col: str = "_loaded_at") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: merge the batch by pitch key; only the batch's dates are rewritten."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            TB.merge_latest_table(batch.sparkSession, batch, table_path, [date_col, *pitch_key],
                                  [loaded_col], partition_by=[date_col])

    return write


def start_pitch_ingest(spark: SparkSession, landing: str, schema: StructType, table_path: str,
                       checkpoint: str, trigger_once: bool = False,
                       date_col: str = "game_date",
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    stream = landed_pitches(spark, landing, schema, max_files_per_trigger=max_files_per_trigger)
    writer = (stream.writeStream.foreachBatch(merge_pitches_sink(table_path, date_col))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()


def result_stream(spark: SparkSession, folder: str, delay: str = "2 days", max_files_per_trigger: int | None = None) -> DataFrame:
    """Finished games of landed schedule documents (one JSON document a line), repeats dropped.

    A schedule is fetched several times a day, so most of its games come again unchanged. State holds
    one key per distinct result for ``delay`` after its file's time; the watermark lets it go, so it
    does not grow with the seasons. A result that changes (a corrected score) is another key and passes.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.load(folder).select(F.col("_metadata.file_modification_time").alias("_loaded_at"), "value")
    docs = payloads.parse(landed, "value", payloads.SCHEDULE_SCHEMA)
    games = payloads.flatten_schedule(docs, date_col="_loaded_at", keep_date=True)
    seen = ["game_pk", "game_date", "team_h", "team_v", "runs_h", "runs_v"]
    return games.withWatermark("_loaded_at", delay).dropDuplicatesWithinWatermark(seen)


def start_result_ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str, trigger_once: bool = False,
                        delay: str = "2 days", max_files_per_trigger: int | None = None,
                        partition_by: Sequence[str] = ("game_pk/10000",)) -> StreamingQuery:
    """Stream of results into one row per game: the newest copy by file time, whatever comes late or again.

    Rows that outlive the watermark's state and come again are merged like any other, so the table is the
    same without the state; the state only spares it repeated work.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            rows = batch.withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp_ntz"))
            TB.merge_latest_table(batch.sparkSession, rows, table_path, ["game_pk"], ["_loaded_at"], partition_by)

    writer = (result_stream(spark, landing, delay, max_files_per_trigger).writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if trigger_once else writer).start()
