"""Incremental ingestion: new articles of a folder become chunks in a collection, and event counts by window.

The same column functions as in batch run on each micro-batch; identifiers make a repeated batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexquarry.operators.articles import extract_articles
from lexquarry.operators.chunking import ChunkConfig, chunk_records
from lexquarry.operators.store import Collection

ARTICLE = "namespace string, title string, markup string"


def article_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(ARTICLE).option("maxFilesPerTrigger", files_per_batch).json(path)


def ingest(articles: DataFrame, collection: Collection, checkpoint: str, config: ChunkConfig = ChunkConfig(), once: bool = True) -> StreamingQuery:
    """Chunks of a stream of articles into a collection, each chunk once whatever is repeated."""

    def batch(df: DataFrame, _: int) -> None:
        collection.add(chunk_records(extract_articles(df), config), mode="upsert")

    writer = articles.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_counts(events: DataFrame, time_col: str, key_col: str, value_col: str, window: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window and key; rows later than ``late`` are left out of windows that are closed."""
    kind = events.schema[time_col].dataType
    stream = events.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, late) if events.isStreaming else events
    when = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    out = stream.groupBy(when.alias("w"), key_col).agg(F.count("*").alias("n"), F.sum(value_col).alias("total"))
    return out.select(F.col("w.start").cast(kind).alias("window_start"), key_col, "n", "total")
