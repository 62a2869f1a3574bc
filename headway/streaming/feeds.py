"""Live feeds: archive, latest pointer, arrivals of new files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions.text import base_name
from headway.session import exists, remove


def latest_archives(archive: DataFrame) -> DataFrame:
    """Latest archived file per data format."""
    return archive.groupBy("data_format").agg(
        F.max_by("file", F.struct("received_at", "file")).alias("file"),
        F.max("received_at").alias("last_updated"),
    )


def merge_latest(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Pointer table after one more batch of archived files."""
    both = current.select("data_format", "file", F.col("last_updated").alias("received_at"))
    return latest_archives(both.unionByName(batch.select("data_format", "file", "received_at")))


def archive_name(data_format: Column, received_at: Column) -> Column:
    return F.concat(
        F.lower(data_format), F.lit("_"), F.date_format(received_at, "yyyy-MM-dd_HHmmss"), F.lit(".zip")
    )


def archive_feed(
    snapshots: DataFrame, archive_path: str, pointer_path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Archive feed snapshots and keep a pointer to the latest of each format.

    Each micro-batch overwrites its own folder, named by the stream (its id is
    kept in its checkpoint) and the batch id: a batch that is run again leaves
    the same files, and a stream started anew replaces nothing of an older one.
    The pointer of a batch is worked out from it and the pointers before it; of
    each stream the last two are kept.
    """
    spark = snapshots.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        run = f"run={stream_id(spark, checkpoint)}"
        named = batch.withColumn("file", archive_name(F.col("data_format"), F.col("received_at")))
        target = f"{archive_path}/{run}/batch={batch_id}"
        named.write.mode("overwrite").partitionBy("data_format").parquet(target)
        # Only this batch and the pointers before it are read, never the archive.
        done = spark.read.schema(named.schema).parquet(target).select("data_format", "file", "received_at")
        now = latest_archives(done)
        if exists(spark, pointer_path):
            others = pointers(spark, pointer_path).where((F.col("run") != run.removeprefix("run=")) | (F.col("batch") < batch_id))
            now = merge_latest(others, done)
        now.write.mode("overwrite").parquet(f"{pointer_path}/{run}/batch={batch_id}")
        remove(spark, f"{pointer_path}/{run}/batch={batch_id - 2}")

    writer = snapshots.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of a stream as kept in its checkpoint: the same after a restart."""
    return spark.read.json(f"{checkpoint}/metadata", schema="id string").first()["id"]


def pointers(spark: SparkSession, pointer_path: str) -> DataFrame:
    schema = "data_format string, file string, last_updated timestamp, run string, batch long"
    return spark.read.schema(schema).parquet(pointer_path)


def current_latest(spark: SparkSession, pointer_path: str) -> DataFrame:
    """Pointer table over all streams that wrote to it."""
    return latest_archives(pointers(spark, pointer_path).withColumnRenamed("last_updated", "received_at"))


def arrivals(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """Stream of newly arrived files with content hash; each file once."""
    raw = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return raw.select(
        "path",
        base_name(F.col("path")).alias("name"),
        F.col("modificationTime").alias("arrived_at"),
        F.col("length").alias("size"),
        F.sha1("content").alias("sha1"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("text"),
    )


def new_content(stream: DataFrame, live: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Arrivals whose content is neither live nor a repeat within ``delay``.

    State is bounded by the watermark; the live table is a static side.
    """
    fresh = stream.withWatermark("arrived_at", delay).dropDuplicatesWithinWatermark(["sha1"])
    known = live.select("sha1").distinct().withColumn("is_live", F.lit(True))
    return fresh.join(known, "sha1", "left").where("is_live is null").drop("is_live")


def unpublished(stream: DataFrame, published: DataFrame, delay: str = "1 hour", horizon: str = "30 days") -> DataFrame:
    """Arrivals whose content is not published by the time they are given out.

    ``published(sha1, published_at)`` is a stream of what goes live, so a file published after the
    start, up to ``delay`` after its arrival, is skipped too. A left outer join of two
    streams: an arrival waits until the watermark has passed ``delay`` behind it and
    comes out if nothing matched. Both sides keep state for a bounded time, ``published``
    for ``horizon``: what went live earlier belongs into ``new_content``'s table. Repeats within
    ``delay`` come once.
    """
    fresh = stream.withWatermark("arrived_at", delay).dropDuplicatesWithinWatermark(["sha1"])
    live = published.select(F.col("sha1").alias("live_sha1"), "published_at").withWatermark("published_at", delay)
    near = (
        (F.col("sha1") == F.col("live_sha1"))
        & (F.col("published_at") >= F.col("arrived_at") - F.expr(f"interval {horizon}"))
        & (F.col("published_at") <= F.col("arrived_at") + F.expr(f"interval {delay}"))
    )
    return fresh.join(live, near, "left_outer").where("live_sha1 is null").drop("live_sha1", "published_at")
