"""The sync as an incremental stream: every micro-batch is diffed against the stored table."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedweave.plans.sync import run_sync
from feedweave.plans.targets import Target
from feedweave.sources.versioned import VersionedTable


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when it made the checkpoint folder."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def _already_applied(note: str, stream_id: str, batch_id: int) -> bool:
    stream, _, batch = note.rpartition(" ")
    return stream == stream_id and int(batch) >= batch_id


def sync_stream(
    stream: DataFrame,
    table: VersionedTable,
    target: Target,
    checkpoint: str,
    now: datetime | None = None,
    delete_missing: bool = False,
    order: Sequence[str] = (),
    locked: Callable[[], DataFrame] | None = None,
    max_delete_fraction: float | None = None,
) -> StreamingQuery:
    """Apply what has arrived since the last run, then stop.

    A batch holds only new files, so keys it lacks stay unless ``delete_missing`` is set. Of
    a key's rows within a batch the last under ``order`` stays, and between batches the later
    batch's, as rows applied in turn would leave them. ``locked`` gives the locked tables as
    they are when a batch begins; a locked target ends the stream, whose batch is then
    repeated by the next run.
    Each commit records stream and batch, so a batch replayed after a failure is skipped,
    while a stream started afresh on a new checkpoint folder is not mistaken for the old one.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream_id = _stream_id(batch.sparkSession, checkpoint)
        if _already_applied(table.note(), stream_id, batch_id):
            return
        stamp = now or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        note = f"{stream_id} {batch_id}"
        run_sync(
            batch.sparkSession, batch, table, target, stamp, locked=locked() if locked else None, delete_missing=delete_missing,
            max_delete_fraction=max_delete_fraction, note=note, order=order,
        )

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
