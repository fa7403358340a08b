"""Incremental ingest of landed API pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agora.operators.skew import salted_join
from agora.sources.pages import FLATTEN, KEYS, page_schema


def ingest_pages_stream(
    spark: SparkSession, landing: str, table: str, checkpoint: str, kind: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Flatten the pages that landed since the last run and append them to a Parquet table.

    Each file is taken once: ``checkpoint`` (in shared storage) remembers what
    was read, so a run that is repeated or restarted adds nothing twice. The
    query stops by itself when it has read all files present.
    """
    pages = (
        spark.readStream.schema(page_schema(kind)).option("maxFilesPerTrigger", files_per_batch).json(landing)
    )
    return (
        FLATTEN[kind](pages)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


# Feeds ---------------------------------------------------------------------
#
# A feed is a numbered run of pages; the first page without a successor (``has_more`` is not true, or it has no items)
# ends it. The table is a log: every micro-batch overwrites a folder of its own, so a batch that is run again after a
# failure leaves the same files, and nothing that is stored is ever changed. Readers merge the log; ``compact_feeds``
# writes what they see as one folder.


FEED_SCHEMA = "feed string, last_page bigint, ended_at bigint"


def _log(spark: SparkSession, table: str, part: str, schema: str | None = None) -> DataFrame | None:
    """All batches of one part of the log; None before the first."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{table}/{part}")
    if not folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", f"{table}/{part}").parquet(f"{table}/{part}")


def feed_state(spark: SparkSession, table: str) -> DataFrame:
    """feed, last_page and ended_at (null while a feed goes on) of every feed seen."""
    log = _log(spark, table, "feeds", f"{FEED_SCHEMA}, batch_id bigint")
    if log is None:
        return spark.createDataFrame([], FEED_SCHEMA)
    return log.groupBy("feed").agg(F.max("last_page").alias("last_page"), F.min("ended_at").alias("ended_at"))


def _within_feeds(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of pages up to the end of their feed. A feed may hold most rows."""
    known = salted_join(rows, state.select("feed", "ended_at"), "feed", "left")
    return known.where(F.col("ended_at").isNull() | (F.col("page") <= F.col("ended_at"))).drop("ended_at")


def ingest_feeds_stream(
    spark: SparkSession, landing: str, table: str, checkpoint: str, kind: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Take in landed pages of feeds: pages behind a feed's end are ignored, items are upserted by their id.

    Pages may land late, twice, or out of order. ``read_feeds`` gives the table.
    The query stops by itself when it has read all files present. Pages without
    a feed or a page number belong to a feed of that name or come first in it.
    """
    pages = spark.readStream.schema(page_schema(kind)).option("maxFilesPerTrigger", files_per_batch).json(landing)

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        named = batch.withColumn("feed", F.coalesce("feed", F.lit(""))).withColumn("page", F.coalesce("page", F.lit(0).cast("bigint")))
        ends = ~F.coalesce("has_more", F.lit(False)) | (F.coalesce(F.size("items"), F.lit(0)) <= 0)
        own = named.groupBy("feed").agg(F.max("page").alias("last_page"), F.min(F.when(ends, F.col("page"))).alias("ended_at"))
        own.write.parquet(f"{table}/feeds/batch_id={batch_id}", mode="overwrite")
        # What is known by now is left out for good; an end that lands later is applied by the reader.
        open_pages = _within_feeds(named, feed_state(session, table))
        flat = FLATTEN[kind](open_pages, ("feed", "page"))
        flat.write.parquet(f"{table}/items/batch_id={batch_id}", mode="overwrite")

    return (
        pages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_feeds(spark: SparkSession, table: str, kind: str) -> DataFrame:
    """The items of all feeds up to their ends: of an id the version of the latest batch, then of the highest page."""
    log = _log(spark, table, "items")
    if log is None:
        return FLATTEN[kind](spark.createDataFrame([], page_schema(kind)))
    kept = _within_feeds(log, feed_state(spark, table))
    fields = [c for c in log.columns if c not in ("feed", "page", "batch_id")]
    version = F.struct("batch_id", "page", "feed", F.xxhash64(*fields).alias("hash"))
    # Copies of an item merge before they are shuffled.
    latest = kept.groupBy(KEYS[kind]).agg(F.max_by(F.struct(*fields), version).alias("item"))
    return latest.where(F.col(KEYS[kind]).isNotNull()).select("item.*").unionByName(kept.where(F.col(KEYS[kind]).isNull()).select(*fields))


def compact_feeds(spark: SparkSession, table: str, kind: str, target: str) -> None:
    """Write what ``read_feeds`` sees as a plain table below ``target``."""
    read_feeds(spark, table, kind).write.parquet(target, mode="overwrite")
