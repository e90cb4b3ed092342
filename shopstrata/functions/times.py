"""Wall-clock time helpers.  Business time is Asia/Shanghai without a zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_ZONE = "Asia/Shanghai"

# The ISO date-time shapes the feed may use, without and with an offset.
_PLAIN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?)?$"
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
_OFFSET = r"\d{2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$"
# The other shapes of ISO 8601: compact dates and times, hours alone, commas, long fractions, short offsets.
_LOOSE = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})(?:[Tt_ ](\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
    r"(?:(Z)|([+-]\d{2})(?::?(\d{2}))?)?)?$"
)
_EPOCH = datetime(1970, 1, 1)


def wall(value: datetime) -> Column:
    """A driver-side naive datetime as a zone-less timestamp literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_iso(text: Column) -> Column:
    """ISO date-time text -> zone-less business time; NULL when it is not one.

    A value with an offset is an instant and is converted to business time.  The result
    does not depend on the session time zone.
    """
    others = F.get(F.transform(F.array(text), _other_shape), F.lit(0))
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp_ntz")).when(text.isNotNull(), others)


def _other_shape(text: Column) -> Column:
    """Times with an offset or of another shape.

    The steps stand in functions of an array's element: written out in the row's own code they make
    methods that the JVM does not compile, or that Spark cannot generate at all (64 KB).
    """
    spelled = F.when(text.rlike(_ISO), text).when(text.rlike(_LOOSE), _spelled_out(text))

    def instant(t: Column) -> Column:
        return F.when(t.rlike(_OFFSET), _local(t)).otherwise(t.try_cast("timestamp_ntz"))

    return F.get(F.transform(F.array(spelled), instant), F.lit(0))


def _local(text: Column) -> Column:
    instant = F.timestamp_add("MICROSECOND", F.unix_micros(text.try_cast("timestamp")), wall(_EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(BUSINESS_ZONE), instant)


def _spelled_out(text: Column) -> Column:
    """A time of one of the other shapes with all its parts and signs between them."""

    def part(group: int, missing: str = "00") -> Column:
        found = F.regexp_extract(text, _LOOSE, group)
        return F.when(found == "", F.lit(missing)).otherwise(found)

    zone = F.when(part(11, "") == "", part(10, "")).otherwise(F.concat(part(11), F.lit(":"), part(12)))
    day = F.concat_ws("-", part(1), part(3), part(4))
    return F.concat(day, F.lit(" "), F.concat_ws(":", part(5), part(7), part(8)), F.lit("."), part(9, "0"), zone)


def business_date(created_at: Column, updated_at: Column) -> Column:
    """Day of the order; the update time stands in when the creation time is missing."""
    return F.to_date(F.coalesce(created_at, updated_at))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole elapsed minutes, truncated toward zero."""
    return F.timestamp_diff("MINUTE", start, end)
