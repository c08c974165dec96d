"""Counts of a running ingest, without a job of their own."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Files, contents and batches that streams of this session have done so far; ``with Progress(spark) as p`` listens.

    ``files`` are rows that batches read, ``contents`` the distinct contents in
    the streams' state, ``failed`` the streams that ended with an error.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.lock = spark, threading.Lock()
        self.files = self.batches = self.failed = self.running = 0
        self._contents: dict[str, int] = {}

    @property
    def contents(self) -> int:
        with self.lock:
            return sum(self._contents.values())

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.running += 1

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.files += event.progress.numInputRows
            self.batches += bool(event.progress.numInputRows)
            if event.progress.stateOperators:
                self._contents[str(event.progress.id)] = event.progress.stateOperators[0].numRowsTotal

    def onQueryIdle(self, event) -> None:
        return

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.running -= 1
            self.failed += event.exception is not None

    def __enter__(self) -> Progress:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
