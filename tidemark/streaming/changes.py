"""Streams: keyed rows into a change-tracking table and history by micro-batches, and windowed counts.

The stream's checkpoint says what was read, and the batch number kept with each commit makes a repeated batch a
no-op, so a restart neither loses nor doubles rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import column
from ..functions.sanitize import prepare
from ..operators import cdc, scd2
from ..operators.keys import latest
from ..plans.ops import now
from ..plans.storage import VersionedTable


def deduplicated(stream: DataFrame, keys: Sequence[str], at: str, delay: str = "1 day") -> DataFrame:
    """Rows whose key came for the first time within the delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_counts(stream: DataFrame, at: str, delay: str = "1 day", *by: str) -> DataFrame:
    """(day, *by, n): rows per day; rows later than the delay are left to reconciliation."""
    own = stream.withWatermark(at, delay).groupBy(F.window(column(at), "1 day"), *(column(b) for b in by)).agg(F.count(F.lit(1)).alias("n"))
    return own.select(F.to_date("window.start").alias("day"), *(column(b) for b in by), "n")


def apply_upserts(history: VersionedTable, batch: DataFrame, keys: Sequence[str], run_ts: str, batch_id: int, *, order: Sequence[str] = ()) -> bool:
    """A micro-batch of the latest rows of some keys into a history; whether it was new."""
    last = history.version()
    if last is not None and last.note.get("stream_batch", -1) >= batch_id:
        return False
    rows = prepare(latest(batch, keys, order), run_ts)
    known = scd2.apply(history.read(), rows, keys, run_ts, targeted=True)
    history.commit(known.history, after=last.number if last else 0, stream_batch=batch_id)
    return True


def into_history(stream: DataFrame, history: VersionedTable, keys: Sequence[str], checkpoint: str, *, order: Sequence[str] = (), run_ts=None) -> StreamingQuery:
    """Starts the stream; it ends when all that is there has been read. run_ts: from batch number to instant."""
    def each(batch: DataFrame, batch_id: int) -> None:
        apply_upserts(history, batch, keys, run_ts(batch_id) if run_ts else str(now()), batch_id, order=order)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def change_stream(stream: DataFrame, stage: VersionedTable, keys: Sequence[str], checkpoint: str, *, window: tuple[str, str, str] | None = None, run_ts=None) -> StreamingQuery:
    """Each micro-batch as a fresh snapshot of a window into a change-tracking table."""
    def each(batch: DataFrame, batch_id: int) -> None:
        last = stage.version()
        if last is not None and last.note.get("stream_batch", -1) >= batch_id:
            return
        ts = run_ts(batch_id) if run_ts else str(now())
        merged = cdc.merge(stage.read(), prepare(batch, ts), keys, ts, batch_id, window=window)
        stage.commit(merged.stage, after=last.number if last else 0, stream_batch=batch_id)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
