"""Joins against a side that is expected to be small, with a check of that expectation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a lookup side is sent to every executor.
BROADCAST_ROWS = 500_000
SALTS = 64
#: Bytes up to which it is: text is counted as UTF-8, every other value as 16 bytes.
BROADCAST_BYTES = 64 * 1024 * 1024


def _fits(lookup: DataFrame, max_rows: int, rows: int | None) -> bool:
    """Whether the lookup is small in rows and bytes; one partial count, no rows are moved."""
    if rows is not None and rows > max_rows:
        return False
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in lookup.dtypes if t == "string"]
    width = sum(text, F.lit(16 * len(lookup.columns)))
    found = lookup.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("bytes")).first()
    return found["n"] <= max_rows and (found["bytes"] or 0) <= BROADCAST_BYTES


def join_lookup(
    big: DataFrame, lookup: DataFrame, on: Sequence[str], spread_by: str | Sequence[str], how: str = "inner",
    *, max_rows: int = BROADCAST_ROWS, salts: int = SALTS, rows: int | None = None,
) -> DataFrame:
    """Join ``big`` with one lookup row per key (``how``: inner, left, left_semi or left_anti).

    The lookup is counted first, unless its ``rows`` are known.  A small one is broadcast.  A
    larger one is copied ``salts`` times and matched on (key, salt), so that a key holding a
    large part of ``big`` is spread over ``salts`` tasks by the hash of ``spread_by``.  With
    one salt it is an ordinary shuffled join.
    """
    if _fits(lookup, max_rows, rows):
        return big.join(F.broadcast(lookup), list(on), how)
    if salts <= 1:
        return big.join(lookup, list(on), how)
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    columns = [spread_by] if isinstance(spread_by, str) else list(spread_by)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
