"""Row contracts checked before a load: every broken check of a row is reported at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import join_messages


@dataclass(frozen=True)
class Check:
    """A column that must be present and non-null, and optionally satisfy a predicate."""

    column: str
    label: str = ""
    test: Callable[[Column], Column] | None = None

    def messages(self, c: Column) -> list[Column]:
        out = [F.when(c.isNull(), F.lit(f"{self.column}: not null"))]
        if self.test is not None:
            shown = F.concat(F.lit(f"{self.column}: {self.label}, got "), c.cast("string"))
            out.append(F.when(~self.test(c), shown))
        return out

    def broken(self, c: Column) -> Column:
        """Whether there is a message; NULL counts as none."""
        return c.isNull() if self.test is None else c.isNull() | ~self.test(c)


def _not_negative(c: Column) -> Column:
    return c >= 0


def _not_empty(c: Column) -> Column:
    return F.length(c) >= 1


ORDER_CHECKS = (
    Check("order_id", "at least 1 character", _not_empty),
    Check("shop_id"),
    Check("platform"),
    Check("order_status"),
    Check("buyer_nick"),
    Check("order_amount_cents", "at least 0", _not_negative),
    Check("payment_amount_cents", "at least 0", _not_negative),
    Check("refund_amount_cents", "at least 0", _not_negative),
    Check("raw_json"),
    Check("is_deleted", "one of 0, 1", lambda c: c.isin(0, 1)),
    Check("created_at"),
    Check("updated_at"),
    Check("etl_batch_id"),
)
ITEM_CHECKS = (
    Check("order_id", "at least 1 character", _not_empty),
    Check("shop_id"),
    Check("item_id", "at least 1 character", _not_empty),
    Check("platform"),
    Check("product_id"),
    Check("product_name"),
    Check("quantity", "more than 0", lambda c: c > 0),
    Check("price_cents", "at least 0", _not_negative),
    Check("raw_json"),
    Check("updated_at"),
    Check("etl_batch_id"),
)


def contract_errors(
    columns: Sequence[str], checks: Sequence[Check], *, value: Callable[[str], Column] = F.col
) -> Column:
    """All messages of a row joined by ``"; "``, NULL for a good row.

    The column set is strict: a missing or unexpected column marks every row.  ``value``
    tells where a column is found, e.g. in a struct.
    """
    wanted = [c.column for c in checks]
    shape = [F.lit(f"{c}: column missing") for c in wanted if c not in columns]
    shape += [F.lit(f"{c}: column not expected") for c in columns if c not in wanted]
    per_row = [m for check in checks if check.column in columns for m in check.messages(value(check.column))]
    return join_messages(*per_row, *shape)


def breaks_contract(
    columns: Sequence[str], checks: Sequence[Check], *, value: Callable[[str], Column] = F.col
) -> Column:
    """Whether ``contract_errors`` has a message, without writing any."""
    if {c.column for c in checks} != set(columns):
        return F.lit(True)
    return F.coalesce(reduce(or_, [check.broken(value(check.column)) for check in checks]), F.lit(False))


def contract_split(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, DataFrame]:
    """(good rows unchanged, bad rows with ``error_msg``)."""
    marked = df.withColumn("error_msg", contract_errors(df.columns, checks))
    return marked.where("error_msg IS NULL").drop("error_msg"), marked.where("error_msg IS NOT NULL")
