"""Key-based merges of an incoming frame into an existing one.

Every merge has unique keys on both sides by the time rows meet, so no key can be hot:
repeats of a key are cut to one row per map task before the shuffle (Spark plans
``row_number() = 1`` as a partial group limit).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTION = "merge_action"
#: Hash of the key, put in front of the key wherever rows are partitioned or sorted by it: one
#: 8-byte comparison then decides almost every sort step, whatever the key looks like.
KEY_HASH = "_key_hash"


def latest_by_key(
    df: DataFrame, keys: Sequence[str], ts: str = "updated_at", tie_break: Sequence[str] = (),
    *, keep_hash: bool = False, lead: str | None = None,
) -> DataFrame:
    """One row per key: the newest ``ts``; a missing time loses to any time.

    Ties are decided by ``tie_break`` (descending), then by a hash of the row, so a task
    that is run again after an executor loss picks the same row.  ``lead``: a column that follows
    from the key, to deal and sort rows by in place of the key's hash.
    """
    rest = [c for c in df.columns if c not in keys and c not in (ts, lead) and c not in tie_break]
    order = [F.col(c).desc_nulls_last() for c in (ts, *tie_break)]
    if rest:
        order.append(F.xxhash64(*rest).desc())
    newest = Window.partitionBy(lead or KEY_HASH, *keys).orderBy(*order)
    hashed = df if lead else df.withColumn(KEY_HASH, F.xxhash64(*keys))
    best = hashed.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")
    return best if keep_hash else best.drop(KEY_HASH)


def _require_values(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    values = [c for c in columns if c not in set(keys)]
    if not values:
        raise ValueError("a merge needs at least one column that is not part of the key")
    return values


def merge_monotonic(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    ts: str = "updated_at",
    *,
    replace_equal: bool = False,
    tie_break: Sequence[str] = (),
    with_action: bool = False,
    broadcast_incoming: bool = False,
) -> DataFrame:
    """Insert new keys; replace a whole row only when the incoming ``ts`` is strictly newer.

    Late rows therefore never overwrite newer ones and a rerun changes nothing.  With
    ``replace_equal`` an equal ``ts`` replaces as well (a recompute of derived rows).
    Columns missing from ``incoming`` become NULL, additional ones are ignored.

    ``with_action`` adds what happened to each row: ``inserted``, ``updated``, ``ignored``
    (an incoming row was not newer) or ``kept`` (no incoming row).

    Both sides are shuffled by key.  A caller that has counted ``incoming`` and found it
    small sets ``broadcast_incoming``: the existing rows then stay where they are.
    """
    values = _require_values(existing.columns, keys)
    types = {f.name: f.dataType for f in existing.schema.fields}
    typed = incoming.select(
        *[(F.col(c) if c in incoming.columns else F.lit(None)).cast(types[c]).alias(c) for c in existing.columns]
    )
    newest = latest_by_key(typed, keys, ts, tie_break, keep_hash=True)
    new = newest.select(KEY_HASH, *keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_is_new"))
    old = existing.select(
        F.xxhash64(*keys).alias(KEY_HASH), *keys,
        *[F.col(c).alias(f"_old_{c}") for c in values], F.lit(True).alias("_is_old"),
    )
    n_ts, o_ts = F.col(f"_new_{ts}"), F.col(f"_old_{ts}")
    newer = (n_ts >= o_ts) if replace_equal else (n_ts > o_ts)
    absent = F.col("_is_old").isNull()
    wins = F.col("_is_new").isNotNull() & (absent | F.coalesce(newer, F.lit(False)))
    action = (
        F.when(absent, "inserted")
        .when(F.col("_is_new").isNull(), "kept")
        .when(wins, "updated")
        .otherwise("ignored")
    )
    picked = {c: F.when(wins, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c) for c in values}
    out: list[Column] = [picked[c] if c in picked else F.col(c) for c in existing.columns]
    out += [action.alias(ACTION)] if with_action else []
    on = [KEY_HASH, *keys]
    if not broadcast_incoming:
        return old.join(new, on, "full_outer").select(*out)
    # Existing rows look their new version up; new keys are those no existing row asks for.
    matched = old.join(F.broadcast(new), on, "left").select(*out)
    known = old.select(*on).join(F.broadcast(new.select(*on)), on, "left_semi")
    inserted = newest.join(known, on, "left_anti").select(
        *existing.columns, *([F.lit("inserted").alias(ACTION)] if with_action else [])
    )
    return matched.unionByName(inserted)


def moved_days(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], day: str, scope: Sequence[str],
    ts: str = "updated_at", *, replace_equal: bool = False,
) -> DataFrame:
    """``scope`` and day pairs that a merge changes beside the day a row is on now.

    For every row whose date in ``day`` changes with the merge: the day it leaves and the day it
    reaches, each once, under the ``scope`` columns it has there.  Summaries by day are right again
    when exactly these are built anew.
    """
    columns = [*scope, day, ts]
    rest = [c for c in columns if c not in keys]
    new = latest_by_key(incoming.select(*keys, *rest), keys, ts, [c for c in rest if c != ts])
    old = existing.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in columns])
    wins = F.col(ts) >= F.col(f"_old_{ts}") if replace_equal else F.col(ts) > F.col(f"_old_{ts}")
    changed = new.join(old, list(keys)).where(wins & ~F.col(day).eqNullSafe(F.col(f"_old_{day}")))
    places = [F.struct(*[F.col(f"{before}{c}").alias(c) for c in (*scope, day)]) for before in ("_old_", "")]
    return changed.select(F.inline(F.array(*places))).where(F.col(day).isNotNull()).distinct()


def decide(
    incoming: DataFrame, known: DataFrame, keys: Sequence[str], ts: str, known_ts: str, *, replace_equal: bool = False
) -> DataFrame:
    """What a monotonic merge does with each incoming row, by the update time known of its key.

    Both sides have one row per key.  Adds ``merge_action`` and the other columns of ``known``.
    """
    met = incoming.join(known.withColumn("_met", F.lit(True)), list(keys), "left")
    newer = F.col(ts) >= F.col(known_ts) if replace_equal else F.col(ts) > F.col(known_ts)
    action = F.when(F.col("_met").isNull(), "inserted").when(F.coalesce(newer, F.lit(False)), "updated").otherwise("ignored")
    return met.withColumn(ACTION, action).drop("_met")


def merge_replace(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert new keys and always replace existing ones.  ``incoming`` has one row per key."""
    _require_values(existing.columns, keys)
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming.select(*existing.columns))


def overwrite_window(
    existing: DataFrame,
    fresh: DataFrame,
    date_col: str,
    since: date,
    end: date,
    *,
    shop_id: int | None = None,
    platform: str | None = None,
    scope: DataFrame | None = None,
) -> DataFrame:
    """Drop every existing row of ``[since, end]``, add ``fresh``.

    The drop can be limited to one shop, one platform, or to the keys in ``scope`` (all of
    its columns).  Rows of the window that nothing replaces disappear as well.
    """
    stale = F.col(date_col).between(F.lit(since), F.lit(end))
    if shop_id is not None:
        stale &= F.col("shop_id") == shop_id
    if platform is not None:
        stale &= F.col("platform") == platform
    stale = F.coalesce(stale, F.lit(False))
    kept = existing.where(~stale)
    if scope is not None:
        kept = kept.unionByName(existing.where(stale).join(scope, scope.columns, "left_anti").select(*existing.columns))
    return kept.unionByName(fresh.select(*existing.columns))


def refresh_columns(existing: DataFrame, incoming: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Insert new keys; on a known key refresh only ``columns`` and leave the others alone."""
    values = [c for c in existing.columns if c != key]
    old = existing.select(key, *[F.col(c).alias(f"_old_{c}") for c in values], F.lit(True).alias("_is_old"))
    new = incoming.select(key, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_is_new"))

    def pick(c: str) -> Column:
        take_new = F.col("_is_old").isNull() | (F.col("_is_new").isNotNull() & F.lit(c in columns))
        return F.when(take_new, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c)

    return old.join(new, key, "full_outer").select(key, *[pick(c) for c in values]).select(*existing.columns)
