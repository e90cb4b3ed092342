"""Alert rows made from failed checks and failed batches (delivery is left to the reader)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Alert levels, lowest first, and the default threshold.
LEVELS = ("info", "warning", "error", "critical")
DEFAULT_LEVEL = "warning"


def level_rank(level: Column) -> Column:
    """Position of a level; an unknown level counts as the lowest."""
    rank = F.lit(0)
    for position, name in enumerate(LEVELS):
        rank = F.when(level == name, position).otherwise(rank)
    return rank


def keep_alerts(alerts: DataFrame, *, min_level: str = DEFAULT_LEVEL, enabled: bool = True) -> DataFrame:
    """Alerts at or above ``min_level``; none when alerting is switched off."""
    threshold = LEVELS.index(min_level) if min_level in LEVELS else 0
    return alerts.where(F.lit(enabled) & (level_rank(F.col("level")) >= threshold))


def check_alerts(verdicts: DataFrame) -> DataFrame:
    """Title, text and level per failed verdict: a warning, or an error when it blocks."""
    where = F.when(F.col("shop_id").isNull(), F.lit("")).otherwise(
        F.concat(F.lit("["), F.col("platform"), F.lit("/shop="), F.col("shop_id").cast("string"), F.lit("] "))
    )
    detail = F.when(F.col("detail").isNotNull(), F.concat(F.lit("; "), F.col("detail"))).otherwise(F.lit(""))
    return verdicts.where("passed = 0").select(
        F.concat(where, F.lit("data check failed: "), F.col("table_name")).alias("title"),
        F.concat(
            F.lit("rule "), F.col("rule_type"), F.lit(": actual="), F.col("actual_value"),
            F.lit(", expected="), F.col("expected_value"), detail,
        ).alias("text"),
        F.when(F.col("severity") == "block", F.lit("error")).otherwise(F.lit("warning")).alias("level"),
    )
