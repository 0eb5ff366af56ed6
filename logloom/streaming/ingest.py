"""Staging and hourly traffic as log files arrive."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.build import refresh_hourly
from ..sources.tables import LogTables


def _run(
    lines: DataFrame,
    tables: LogTables,
    checkpoint: str,
    after: Callable[[list[int]], None] | None,
    until_caught_up: bool,
) -> StreamingQuery:
    # a stream is known by its checkpoint: with another one it starts over
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()

    def land(batch: DataFrame, batch_id: int) -> None:
        # A batch is one load. Replayed after a failure it keeps its number: a
        # finished load is not written again, and staging replaces what is there.
        load_id = tables.load_of_batch(stream, batch_id)
        if not tables.is_finished("raw_logs", load_id):
            tables.load(batch, load_id)
        tables.stage([load_id])
        if after:
            after([load_id])

    writer = lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if until_caught_up else writer.start()


def stream_ingest(
    lines: DataFrame, tables: LogTables, checkpoint: str, until_caught_up: bool = False
) -> StreamingQuery:
    """Append each batch of lines to the raw and staged tables, beside what other loads put there.

    Rejected lines are kept as well, see `LogTables.rejects`; the numbers of
    lines and rejected ones are metrics observed in each batch's write.
    One stream or build writes to a root at a time.
    """
    return _run(lines, tables, checkpoint, None, until_caught_up)


def stream_hourly_traffic(
    lines: DataFrame, tables: LogTables, checkpoint: str, until_caught_up: bool = False
) -> StreamingQuery:
    """As `stream_ingest`, and add each batch to the hourly traffic.

    The state of the hours, what each batch adds per hour and client, is kept
    in the table `hour_clients`, so every hour is there while it is still
    open, a request however late changes its hour again, and one stamped far
    ahead closes nothing. A batch reads its own requests and the state of the
    days it touches.
    """
    return _run(lines, tables, checkpoint, lambda loads: refresh_hourly(tables, loads), until_caught_up)
