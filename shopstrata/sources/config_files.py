"""Configuration sources: shop registry and rule set, from JSON or YAML files."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.quality import Rule

# What a registry entry may say about a shop.
SHOP_STATUSES = ("active", "disabled")

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("shop_id", T.LongType()),
        T.StructField("platform", T.StringType()),
        T.StructField("shop_name", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def load_document(path: str | Path) -> Any:
    """The content of a JSON or YAML file; YAML needs the ``yaml`` module."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return json.loads(text or "null")
    try:
        import yaml
    except ImportError as missing:
        raise ValueError(f"{path}: reading YAML needs the yaml module, use JSON instead") from missing
    return yaml.safe_load(text)


def parse_registry(document: Any) -> list[dict[str, Any]]:
    """Registered shops of a document ``{"shops": [...]}``, validated."""
    shops = (document or {}).get("shops") if isinstance(document or {}, dict) else None
    if not isinstance(shops, list) or not shops:
        raise ValueError("the registry has no list of shops")
    out = []
    for entry in shops:
        if not isinstance(entry, dict) or not {"shop_id", "platform", "shop_name"} <= set(entry):
            raise ValueError(f"a registry entry needs shop_id, platform and shop_name: {entry!r}")
        status = str(entry.get("status", "active"))
        if status not in SHOP_STATUSES:
            raise ValueError(f"invalid status {status!r}, expected one of {SHOP_STATUSES}: {entry!r}")
        try:
            shop_id = int(entry["shop_id"])
        except (TypeError, ValueError) as problem:
            raise ValueError(f"invalid shop_id: {entry!r}") from problem
        out.append(
            {"shop_id": shop_id, "platform": str(entry["platform"]), "shop_name": str(entry["shop_name"]), "status": status}
        )
    return out


def registry_frame(spark: SparkSession, shops: list[dict[str, Any]]) -> DataFrame:
    return spark.createDataFrame([tuple(s[f] for f in REGISTRY_SCHEMA.fieldNames()) for s in shops], REGISTRY_SCHEMA)


def parse_rules(document: Any) -> list[Rule]:
    """Rules of a document that is a list of mappings, validated."""
    entries = document or []
    if not isinstance(entries, list):
        raise ValueError("the rule file must be a list")
    rules = []
    for n, entry in enumerate(entries):
        if not isinstance(entry, dict):
            raise ValueError(f"rule {n} must be a mapping, not {type(entry).__name__}")
        fields = {"table_name", "rule_type", "params"}
        if not fields <= set(entry) or not set(entry) <= fields | {"severity"}:
            raise ValueError(f"rule {n} has missing or unknown fields: {sorted(entry)}")
        rules.append(Rule(**entry).validated())
    return rules


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.table_name, r.rule_type, json.dumps(dict(r.params), sort_keys=True), r.severity) for r in rules]
    return spark.createDataFrame(rows, "table_name string, rule_type string, params string, severity string")
