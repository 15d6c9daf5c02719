"""Metrics and heartbeats of running queries."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.shared_files import Folder


class Metrics(StreamingQueryListener):
    """Counts, rates, per-batch peaks and idle heartbeats by query; snapshot() is what a monitor reads."""

    def __init__(self, heartbeat: Callable[[str], None] | None = None) -> None:
        self.heartbeat, self.known = heartbeat, {}

    def _of(self, query: object) -> dict:
        return self.known.setdefault(str(query), {"rows": 0, "batches": 0, "peak_rows_per_second": 0.0, "last": None, "idle": 0, "error": None})

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._of(event.id)["last"] = time.time()

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p, own = event.progress, self._of(event.progress.id)
        own["rows"] += p.numInputRows
        own["batches"] += 1
        own["peak_rows_per_second"] = max(own["peak_rows_per_second"], p.processedRowsPerSecond or 0.0)
        own["last"] = time.time()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._of(event.id)["idle"] += 1
        if self.heartbeat:
            self.heartbeat(str(event.id))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._of(event.id)["error"] = event.exception

    def publish(self, folder: Folder, name: str = "metrics.json") -> None:
        """The snapshot as a file in a shared folder, for monitors that read files."""
        folder.publish(name, json.dumps(self.snapshot(), sort_keys=True).encode())

    def snapshot(self) -> dict[str, dict]:
        return {k: dict(v) for k, v in self.known.items()}


def for_each_change(callback: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that hands each batch's changes, in commit order, to a callback that may look at them anywhere."""

    def run(batch: DataFrame, number: int) -> None:
        callback(batch.orderBy("end_seq", "ord"))

    return run
