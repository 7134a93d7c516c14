"""Streaming: windows over events with late data bounded by a watermark, and a folder that is merged into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lavra.sources.sinks import merge_into


def tumbling(events: DataFrame, size: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    """Events and value per window and type; on a stream, windows close when the watermark passes them."""
    e = events.withWatermark("ts", late) if late and events.isStreaming else events
    return e.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = "10 minutes") -> DataFrame:
    """Runs of a user's events without a pause of ``gap``."""
    e = events.withWatermark("ts", late) if late and events.isStreaming else events
    return e.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def ingest(spark: SparkSession, folder: str, schema: str, table: str, key: str, checkpoint: str, order: list[str] | None = None) -> StreamingQuery:
    """JSON files dropped into a folder, merged into a table (:func:`lavra.sources.sinks.read_table`) by key.

    Of a batch's rows with one key the last in ``order`` (all columns, if not given) counts. A batch that was applied before a
    crash isn't applied again, and running again from the checkpoint changes nothing.
    """
    rows = spark.readStream.schema(schema).json(folder)

    def batch(df: DataFrame, epoch: int) -> None:
        others = [c for c in df.columns if c != key]
        last = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*(order or others))).alias("_r")).select(key, "_r.*")
        merge_into(df.sparkSession, table, last, key, batch=f"epoch{epoch}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
