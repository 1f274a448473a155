"""Row-wise tags on a trigger instead of a cron schedule.

A rule tag (a value or a range of one business row) needs nothing but the row, so it
can be computed per micro-batch and upserted into that tag's own narrow table.  Tags
that aggregate a user's rows (cycle, payment, scores) can't: the batch holds a part of
them only; rerun their jobs.

The upsert is idempotent, so a micro-batch replayed after a failure leaves the tag as
if it had run once; the query's checkpoint folder must be on shared storage.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame

from kestrel.operators.profile import TagColumnStore


def upsert_batches(store: TagColumnStore, compute: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` function: ``compute`` the rule tag of the batch, upsert it."""
    if not isinstance(store, TagColumnStore):
        raise TypeError("micro-batches go to a TagColumnStore: it rewrites the one tag only")

    def run(batch: DataFrame, batch_id: int) -> None:
        tagged = compute(batch) if compute is not None else batch
        store.save(tagged)

    return run


def start_tag_stream(stream: DataFrame, store: TagColumnStore, checkpoint: str,
                     compute: Callable[[DataFrame], DataFrame] | None = None,
                     trigger: dict | None = None):
    """Start the streaming tag job; returns the ``StreamingQuery``."""
    w = stream.writeStream.foreachBatch(upsert_batches(store, compute)).option(
        "checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
