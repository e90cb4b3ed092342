"""Order status normalisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The internal status codes, and those that count as paid business.
VALID_STATUSES = ("pending", "paid", "shipped", "completed", "cancelled", "refunded", "unknown")
PAID_SCOPE = ("paid", "shipped", "completed", "refunded")

#: Platform -> platform status code -> internal status code.  Empty: codes are internal already.
StatusMap = Mapping[str, Mapping[str, str]]


def _translated(platform: Column, raw: Column, mapping: StatusMap) -> Column:
    """Look codes up per platform; codes that are not listed pass through unchanged."""
    out = raw
    for name in sorted(mapping):
        codes = mapping[name]
        if codes:
            table = F.create_map(*[F.lit(x) for code in sorted(codes) for x in (code, codes[code])])
            out = F.when(platform == name, F.coalesce(F.try_element_at(table, raw), raw)).otherwise(out)
    return out


def status_norm(
    platform: Column, raw: Column, refund_cents: Column, payment_cents: Column, mapping: StatusMap | None = None
) -> Column:
    """Internal status of an order; NULL and unlisted codes become ``unknown``.

    A delivered order (shipped or completed) with money both paid and refunded is ``refunded``.
    """
    code = _translated(platform, raw, mapping or {})
    money_back = (F.coalesce(refund_cents, F.lit(0)) > 0) & (F.coalesce(payment_cents, F.lit(0)) > 0)
    return (
        F.when(code.isNull() | ~code.isin(*VALID_STATUSES), "unknown")
        .when(code.isin("shipped", "completed") & money_back, "refunded")
        .otherwise(code)
    )
