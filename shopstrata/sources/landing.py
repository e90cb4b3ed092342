"""Landing directory of the order feed: JSON lines, one order message per line.

    <path>/[platform=<p>/][arrived=<yyyy-MM-dd>/][shop_id=<n>/]*.json

All directory levels are optional.  Messages are read as text: nothing about their shape is
inferred, and the original text is what gets stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEVELS = {"platform": "string", "arrived": "date", "shop_id": "bigint"}


def _feed_columns(raw: DataFrame, platform: str | None, *more: str) -> DataFrame:
    named = F.col("platform") if "platform" in raw.columns else F.lit(platform).cast("string")
    shop = F.col("shop_id") if "shop_id" in raw.columns else F.lit(None)
    return raw.where(F.length(F.trim("value")) > 0).select(
        named.alias("platform"), shop.cast("bigint").alias("source_shop_id"), "value", *more
    )


def scan_feed(
    spark: SparkSession, path: str, *, platform: str | None = None, updated_since: datetime | None = None
) -> DataFrame:
    """The messages of a landing directory as ``platform, source_shop_id, value``.

    A message cannot arrive before it was updated, so with arrival directories
    ``updated_since`` prunes those that are too old.
    """
    raw = spark.read.text(path, wholetext=False)
    if updated_since is not None and "arrived" in raw.columns:
        raw = raw.where(F.col("arrived") >= F.lit(updated_since.date()))
    return _feed_columns(raw, platform)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes, modified_at`` of the files of a landing directory; nothing is read of them."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").cast("timestamp_ntz").alias("modified_at")
    )


def scan_files(spark: SparkSession, path: str, files: Sequence[str], *, platform: str | None = None) -> DataFrame:
    """The messages of some files of a landing directory, each with the ``source_file`` it stands in."""
    if not files:
        return spark.createDataFrame([], "platform string, source_shop_id bigint, value string, source_file string")
    raw = spark.read.option("basePath", path).text(list(files)).withColumn("source_file", F.col("_metadata.file_path"))
    return _feed_columns(raw, platform, "source_file")


def stream_feed(
    spark: SparkSession, path: str, *, platform: str | None = None, levels: tuple[str, ...] = (),
    max_files: int | None = None,
) -> DataFrame:
    """The same directory as a stream; ``levels`` names the directory levels that exist."""
    fields = [T.StructField("value", T.StringType())]
    fields += [T.StructField(name, T._parse_datatype_string(_LEVELS[name])) for name in levels]
    reader = spark.readStream.format("text").schema(T.StructType(fields))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _feed_columns(reader.load(path), platform)
