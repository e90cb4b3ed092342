"""Merging rows into a stored table: small merges as deltas, large ones by writing the periods they touch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.joins import join_lookup
from ..operators.merge import ACTION, decide, latest_by_key, merge_monotonic, moved_days
from ..schemas import STR, TABLES, conform
from ..sources.tables import DAY, GONE, OLD_DAY, PART, SEQ, TS, Warehouse


@dataclass(frozen=True)
class MergeCounts:
    """What a merge did.  ``kept`` rows were only copied along with their partition."""

    inserted: int = 0
    updated: int = 0
    ignored: int = 0
    kept: int = 0

    @property
    def written(self) -> int:
        return self.inserted + self.updated


@dataclass(frozen=True)
class _Touched:
    parts: list[str]
    incoming_rows: int


#: A merge of at least this share of the rows of the periods it lands in writes these periods anew.
REWRITE_SHARE = 0.25


def _landing(wh: Warehouse, name: str, incoming: DataFrame) -> dict[str, int]:
    """Incoming rows by period: one value per period, bounded by the length of the history."""
    rows = conform(incoming, TABLES[name].schema).groupBy(wh.part_column(TABLES[name]).alias("part")).count()
    return {r.part: r["count"] for r in rows.collect()}


def touched_partitions(wh: Warehouse, name: str, incoming: DataFrame, at, landing: dict[str, int]) -> _Touched:
    """Partitions that hold an incoming row or an older version of one.

    A row may move to another period when its date changes, so the keys are looked up in the
    other partitions as well; that scan reads key and date columns only.
    """
    spec = TABLES[name]
    rows = conform(incoming, spec.schema)
    total = sum(landing.values())
    elsewhere = sorted(p for p in at.parts if p not in landing)
    if not landing or not elsewhere:
        return _Touched(sorted(landing), total)
    keys = list(spec.key)
    older = wh.read_parts(name, elsewhere, at).select(*keys, wh.part_column(spec).alias("part"))
    moved = join_lookup(older, rows.select(*keys), keys, keys[-1], "left_semi", salts=1, rows=total)
    found = {r.part for r in moved.select("part").distinct().collect()}
    return _Touched(sorted(set(landing) | found), total)


#: Rows and bytes up to which an incoming batch is sent to every executor.  Whole rows are
#: wider than lookup keys, so their size is checked as well.
SMALL_BATCH_ROWS = 100_000
SMALL_BATCH_BYTES = 64 * 1024 * 1024


def _is_small(incoming: DataFrame, rows: int) -> bool:
    if rows > SMALL_BATCH_ROWS:
        return False
    text = [F.coalesce(F.length(F.col(f.name)), F.lit(0)) for f in incoming.schema.fields if f.dataType == STR]
    width = sum(text[1:], text[0]) if text else F.lit(0)
    chars = incoming.agg(F.sum(width).alias("chars")).first().chars or 0
    return chars * 4 + rows * 16 * len(incoming.columns) <= SMALL_BATCH_BYTES


#: Receives ``shop_id, platform, stat_date``: days that rows leave or reach by a merge.
Moves = Callable[[DataFrame], None]


def upsert(
    wh: Warehouse, name: str, incoming: DataFrame, *, replace_equal: bool = False, moves: Moves | None = None
) -> MergeCounts:
    """Monotonic merge of ``incoming`` into a stored table; done again if another writer was faster.

    ``moves`` is told which days rows leave and reach, before the merge can be seen: should the
    merge fail afterwards, too many days are known and none is missing.
    """
    counts = wh.retried(lambda: _upsert_once(wh, name, incoming, replace_equal, moves))
    overdue = wh.overdue(wh.version(name))
    if overdue:
        wh.compact(name, overdue)
    return counts


def _upsert_once(wh: Warehouse, name: str, incoming: DataFrame, replace_equal: bool, moves: Moves | None) -> MergeCounts:
    at = wh.version(name)
    landing = _landing(wh, name, incoming)
    if not landing:
        return MergeCounts()
    stored = sum(x.rows + x.delta_rows for p, x in at.parts.items() if p in landing)
    if sum(landing.values()) >= REWRITE_SHARE * stored:
        return _rewrite(wh, name, incoming, replace_equal, at, landing, moves)
    return _put_delta(wh, name, incoming, replace_equal, at, moves)


def _rewrite(
    wh: Warehouse, name: str, incoming: DataFrame, replace_equal: bool, at, landing: dict[str, int], moves: Moves | None
) -> MergeCounts:
    """Joins the touched periods with the incoming rows and writes them anew."""
    spec = TABLES[name]
    touched = touched_partitions(wh, name, incoming, at, landing)
    rows = conform(incoming, spec.schema)
    stored = wh.read_parts(name, touched.parts, at)
    if moves and at.parts:
        both = (x.withColumn("stat_date", spec.filing_date()) for x in (stored, rows))
        moves(moved_days(*both, spec.key, "stat_date", ("shop_id", "platform"), replace_equal=replace_equal))
    merged = merge_monotonic(
        stored, rows, spec.key, replace_equal=replace_equal, with_action=True,
        broadcast_incoming=bool(at.parts) and _is_small(rows, touched.incoming_rows),
    )
    seen = Observation()
    actions = ("inserted", "updated", "ignored", "kept")
    counted = merged.observe(seen, *[F.count_if(F.col(ACTION) == a).alias(a) for a in actions])
    wh.replace(name, counted.drop(ACTION), touched.parts, at=at)
    return MergeCounts(**{a: seen.get[a] for a in actions})


def _put_delta(wh: Warehouse, name: str, incoming: DataFrame, replace_equal: bool, at, moves: Moves | None) -> MergeCounts:
    """Adds the rows that change over what is there; reads the index buckets of the incoming keys and no partition."""
    spec = TABLES[name]
    keys = list(spec.key)
    at = wh.index(name, at)
    newest = latest_by_key(conform(incoming, spec.schema), keys).withColumn("_bucket", wh.bucket(spec, at.index.buckets))
    rows = wh.stage(newest, "incoming")
    sizes = {r["_bucket"]: r["count"] for r in rows.df.groupBy("_bucket").count().collect()}
    changes, seen = planned_delta(wh, name, rows.df.drop("_bucket"), sizes, replace_equal, at)
    wh.put_delta(name, changes, at, moves and (lambda delta: moves(_moved(spec, delta))))
    rows.drop()
    counts = seen.get
    return MergeCounts(**{a: counts[a] or 0 for a in ("inserted", "updated", "ignored")})


def _moved(spec, delta: DataFrame) -> DataFrame:
    """Days that the rows of a delta leave and reach; the platform of a row is taken as it is now."""
    now = spec.filing_date()
    changed = delta.where(~F.col(GONE) & F.col(OLD_DAY).isNotNull() & ~F.col(OLD_DAY).eqNullSafe(now))
    days = F.explode(F.array(F.col(OLD_DAY), now)).alias("stat_date")
    return changed.select("shop_id", "platform", days).where("stat_date IS NOT NULL").distinct()


def planned_delta(
    wh: Warehouse, name: str, rows: DataFrame, sizes: dict[int, int], replace_equal: bool, at
) -> tuple[DataFrame, Observation]:
    """The delta of incoming ``rows`` (one per key, ``sizes`` of them by index bucket), and its counts once it is written."""
    spec = TABLES[name]
    keys = list(spec.key)
    known = wh.read_index(name, at, sizes)
    met = join_lookup(known, rows.select(*keys), keys, keys[-1], "left_semi", salts=1, rows=sum(sizes.values()))
    last = latest_by_key(met, keys, ts=SEQ).select(*keys, DAY, TS)
    seen = Observation()
    decided = decide(rows, last, keys, "updated_at", TS, replace_equal=replace_equal).observe(
        seen, *[F.count_if(F.col(ACTION) == a).alias(a) for a in ("inserted", "updated", "ignored")]
    )
    here = wh.part_column(spec)
    before = F.when(F.col(ACTION) == "updated", wh.period_column(F.col(DAY)))
    left = F.when(before.isNotNull() & (before != here), F.struct(before.alias(PART), F.lit(True).alias(GONE)))
    places = F.array_compact(F.array(F.struct(here.alias(PART), F.lit(False).alias(GONE)), left))
    return (
        decided.where(F.col(ACTION) != "ignored")
        .select(*spec.columns, F.col(DAY).alias(OLD_DAY), F.explode(places).alias("_place"))
        .select(*spec.columns, OLD_DAY, "_place.*"),
        seen,
    )
