"""Column-level helpers shared by the operators; all of them stay inside the JVM."""

from .money import exact_ratio, int_div, to_cents
from .status import PAID_SCOPE, VALID_STATUSES, status_norm
from .text import canonical_json, clip, join_messages
from .times import business_date, minutes_between, parse_iso, wall

__all__ = [
    "PAID_SCOPE", "VALID_STATUSES", "business_date", "canonical_json", "clip", "exact_ratio",
    "int_div", "join_messages", "minutes_between", "parse_iso", "status_norm", "to_cents", "wall",
]
