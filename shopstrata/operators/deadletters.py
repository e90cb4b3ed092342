"""The dead-letter table: kinds of letters, stamping and reading without repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of dead letters.
MAPPER_ERROR = "mapper_error"
SCHEMA_MISMATCH = "schema_mismatch"
PARENT_REJECTED = "parent_rejected"
#: Items of a rejected order are kept for inspection but do not count towards the rate.
COUNTED = (MAPPER_ERROR, SCHEMA_MISMATCH)

_CONTENT = ["table_name", "shop_id", "platform", "raw_row", "error_type", "error_msg"]


def stamp(letters: DataFrame, batch_id: str, created_at: Column) -> DataFrame:
    """Adds batch, time and a content key; the same bad row read again has the same key."""
    return letters.select(
        F.xxhash64(*_CONTENT).alias("error_key"),
        F.lit(batch_id).alias("batch_id"),
        *_CONTENT,
        created_at.alias("created_at"),
    )


def distinct_letters(stored: DataFrame) -> DataFrame:
    """Stored dead letters without the repeats that overlapping loads append."""
    return stored.groupBy("error_key", *_CONTENT).agg(
        F.min("created_at").alias("first_seen_at"), F.count(F.lit(1)).alias("times_seen")
    )
