"""Repeating a past interval: ingest its window again, then build from its first day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame

from ..functions.status import StatusMap
from ..operators import windows
from ..sources.tables import Warehouse
from .build import BuildSummary, build_warehouse
from .ingest import IngestResult, IngestSettings, ingest_batch


@dataclass(frozen=True)
class BackfillResult:
    ingest: IngestResult
    build: BuildSummary


def backfill(
    wh: Warehouse,
    messages: DataFrame,
    shops: Sequence[Mapping[str, Any]],
    *,
    start: datetime,
    end: datetime | None = None,
    now: datetime,
    settings: IngestSettings = IngestSettings(),
    status_map: StatusMap | None = None,
) -> BackfillResult:
    """Load ``[start, end)`` again (a point in time means the hour before it) and rebuild.

    Watermarks stay where they are.  Because merges are monotonic and summaries are
    overwritten, the result equals that of the live runs over the same data.
    """
    run_type, window = windows.resolve_run(windows.BACKFILL, start, end, overlap=settings.overlap)
    loaded = ingest_batch(wh, messages, now=now, run_type=run_type, window=window, settings=settings)
    since = windows.resolve_build_since(windows.BACKFILL, start, now)
    return BackfillResult(loaded, build_warehouse(wh, shops, since=since, now=now, status_map=status_map))
