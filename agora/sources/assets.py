"""Discovery of files by extension in any storage Spark can list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def discover_assets(spark: SparkSession, root: str, extension: str) -> DataFrame:
    """path, length and modification time of all files below ``root`` with an extension in any case.

    The file contents are not read.
    """
    glob = "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    listed = files.load(root).select("path", "length", "modificationTime")
    return listed.withColumn("name", F.element_at(F.split("path", "/"), -1))


def asset_targets(assets: DataFrame) -> DataFrame:
    """One row per file name: the path that wins (the last in key order) and how many share the name."""
    return assets.groupBy("name").agg(F.max("path").alias("path"), F.count(F.lit(1)).alias("copies"))
