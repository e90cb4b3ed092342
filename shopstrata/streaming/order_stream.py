"""The order ingest as a stream over the landing directory.

Each micro-batch goes through the same merge as a batch run.  A micro-batch that is replayed
after a failure changes nothing, because equal update times never replace a row, and late
messages never overwrite newer ones.  No state is kept between micro-batches, so there is no
event-time watermark that could drop late data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import state
from ..plans.ingest import STREAM, IngestFailed, IngestSettings, ingest_batch
from ..sources.landing import stream_feed
from ..sources.tables import Warehouse


def start_order_stream(
    wh: Warehouse,
    path: str,
    checkpoint: str,
    *,
    platform: str | None = None,
    levels: tuple[str, ...] = (),
    settings: IngestSettings = IngestSettings(),
    clock: Callable[[], datetime] = datetime.now,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the stream; without ``every`` it handles what is there and stops.

    Shops that are held up (dead-letter limit, blocking checks) are recorded in the ledger
    and as alerts; the stream goes on with the others.
    """

    stream_id = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]

    def handle(messages: DataFrame, epoch: int) -> None:
        try:
            state.run_task(wh, "stream", "micro_batch", lambda: ingest_batch(
                wh, messages, now=clock(), run_type=STREAM, settings=settings, batch_id=f"stream-{stream_id}-{epoch:09d}"
            ))
        except IngestFailed:
            pass  # recorded by the batch; other errors stop the stream and are replayed

    feed = stream_feed(wh.spark, path, platform=platform, levels=levels, max_files=max_files)
    writer = feed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
