"""Feed messages and small readers that several test modules share."""

from __future__ import annotations

import json
from datetime import datetime

from shopstrata.operators import feed

#: Whole cents of the money fields of a message.
CENTS = {"order": 1234, "payment": 1234, "refund": 0}


def order(n: int, *, updated: datetime = datetime(2026, 9, 1, 10), drop: tuple[str, ...] = (), **fields) -> dict:
    """A message with every field the feed parser knows; ``fields`` are set, ``drop`` is left out."""
    known = [f.split()[0] for f in feed.FEED_FIELDS.split(", ")]
    values = dict.fromkeys(("created_at", "updated_at"), updated.isoformat())
    values.update((f"{kind}_amount", f"{cents // 100}.{cents % 100:02d}") for kind, cents in CENTS.items())
    values.update(shop_id=1, order_id=f"C{n:04d}", status="paid", buyer_nick=f"buyer-{n}")
    values["items"] = [item(f"{n}01", f"P{n:03d}")]
    values.update(fields)
    return {k: values[k] for k in [*(k for k in known if k in values), *(fields.keys() - set(known))] if k not in drop}


#: The registry of the shop that ``order`` belongs to.
NOW_SHOP = [{"shop_id": 1, "platform": "canned", "shop_name": "one", "status": "active"}]


def item(item_id: str, product: str, quantity=1, price="1.00") -> dict:
    return {"item_id": item_id, "product_id": product, "product_name": "thing", "quantity": quantity, "price": price}


def messages(spark, rows, platform: str = "canned"):
    """Feed messages as the ingest reads them; text rows are taken as they are."""
    text = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows]
    return spark.createDataFrame([(platform, None, t) for t in text], "platform string, source_shop_id bigint, value string")


def column(df, name: str) -> list:
    return sorted(r[0] for r in df.select(name).collect())
