"""Counts and lag of every micro-batch, from what the batch itself observed.

The streams count their rows as they write them (``observe``), so no job reads the
output to learn what a batch did. The numbers come with the progress of the query;
it is asked on the driver, which needs no callback from the JVM.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_OBSERVED, _OLDEST = "batch_counts", "oldest_stamp"


@dataclass(frozen=True)
class Batch:
    """What one micro-batch read and wrote.

    ``counts``: the observed counts, ``rows`` (written) among them. ``lag``: seconds
    from the oldest stamp among the written rows to the end of the batch, None
    if none was written.
    """

    batch_id: int
    rows_read: int
    counts: dict[str, int]
    seconds: float
    lag: float | None


def counted(rows: DataFrame, stamp: str, **conditions: Column) -> DataFrame:
    """Count ``rows``, those for which each of ``conditions`` holds, and keep the oldest ``stamp``."""
    counts = {"rows": F.lit(True), **conditions}
    return rows.observe(
        _OBSERVED,
        F.min(F.unix_micros(stamp)).alias(_OLDEST),
        *[F.count(F.when(condition, 1)).alias(name) for name, condition in counts.items()],
    )


def batches(query: StreamingQuery, idle_seconds: float | None = None, poll_seconds: float = 0.5) -> Iterator[Batch]:
    """The batches of ``query`` that read rows, as they end, until the query ends.

    ``idle_seconds``: stop the query once it has looked for data and found none
    for so long. A batch that starts in the moment of the stop is done by the
    next start with the same checkpoint. A failure of the query is raised.
    Spark keeps the progress of the last hundred triggers, which is more than end
    between two looks.
    """
    last, quiet_since, ended = -1, time.monotonic(), False
    while not ended:
        ended = bool(query.awaitTermination(poll_seconds))
        progress = query.recentProgress
        for p in progress:
            if p.batchId > last and p.numInputRows:
                last, quiet_since = p.batchId, time.monotonic()
                yield _batch(p)
        if not progress or query.status["isDataAvailable"]:
            quiet_since = time.monotonic()
        elif idle_seconds is not None and not ended and time.monotonic() - quiet_since >= idle_seconds:
            query.stop()


def _batch(progress) -> Batch:
    observed = progress.observedMetrics.get(_OBSERVED)
    counts = observed.asDict() if observed is not None else {}
    oldest = counts.pop(_OLDEST, None)
    seconds = progress.durationMs.get("triggerExecution", 0) / 1000
    started = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp()
    lag = None if oldest is None else started + seconds - oldest / 1e6
    return Batch(progress.batchId, progress.numInputRows, counts, seconds, lag)
