"""Text helpers for messages and configuration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest text kept per column.
ERROR_TEXT_LIMIT = 2000
VALUE_TEXT_LIMIT = 255


def clip(text: Column, limit: int = ERROR_TEXT_LIMIT) -> Column:
    """The first ``limit`` characters."""
    return F.left(text, F.lit(limit))


def join_messages(*messages: Column) -> Column:
    """All non-null messages joined by ``"; "``; NULL when there is none."""
    return F.nullif(F.concat_ws("; ", *messages), F.lit(""))


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys and no insignificant blanks, so equal objects compare equal."""
    return F.to_json(F.parse_json(text))
