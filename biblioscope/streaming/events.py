"""Event streams over files: windowed counts with late rows bounded, sessions, and upserts by batch."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioscope.session import scratch


def event_stream(spark: SparkSession, path: str, pattern: str = "events.parquet", files_at_once: int = 1) -> DataFrame:
    """The events of the files that come to a folder."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).option("pathGlobFilter", pattern).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and type; state older than ``late`` is dropped (streams), batches see all rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each user: events with at most ``gap`` between them."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def run_to_end(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "update") -> None:
    """Works off what the source holds now, batch by batch, and stops. A batch that is run again has its number."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
    query.awaitTermination()


def streamed_table(stream: DataFrame, keys: list[str]) -> DataFrame:
    """What a stream of updates has given when its source is worked off: the last row of each key.

    Each batch is written to a folder of its own number in the shared folder, so a batch that is run again after a loss
    replaces itself; of the rows of a key the one of the last batch holds."""
    folder = f"{scratch(stream.sparkSession)}/stream-{uuid4()}"

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    run_to_end(stream, f"{folder}/offsets", each)
    rows = stream.sparkSession.read.parquet(f"{folder}/rows")
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
    return last.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])
