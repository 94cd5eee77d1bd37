"""Progress of streaming queries as JSON log lines that carry the query's name and batch."""

from __future__ import annotations

import json
import logging

from pyspark.sql.streaming import StreamingQueryListener


class JsonProgress(StreamingQueryListener):
    """Add to a session with spark.streams.addListener(JsonProgress())."""

    def __init__(self, logger: logging.Logger | None = None) -> None:
        self.logger = logger or logging.getLogger("folioscope.streaming")

    def _say(self, event: str, **fields) -> None:
        self.logger.info(json.dumps({"event": event, **fields}, ensure_ascii=False, default=str))

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._say("started", query=event.name, id=event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self._say("progress", query=p.name, batch=p.batchId, rows=p.numInputRows, seconds=p.batchDuration / 1000)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._say("terminated", id=event.id, error=event.exception)
