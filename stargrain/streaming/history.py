"""The expectation counters of every streaming run, kept as a table.

``observe_stream`` makes Spark count the failing rows of each rule while a batch runs.  The counters come with the
progress of the batch and are gone with the query; :class:`MetricsHistory` is a listener that stores them, one row
per query, run, batch and rule, without reading the data again.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = "query string, run_id string, batch_id bigint, observed string, rule string, passed bigint, failed bigint"


class MetricsHistory(StreamingQueryListener):
    """Stores observed counters below ``path`` (shared storage).  Use it as a context manager around the runs: on leaving it
    waits for the events of the queries that have ended, and unregisters itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended, self._began, self._change = set(), set(), threading.Condition()
        self._failure: BaseException | None = None

    def onQueryStarted(self, event) -> None:
        with self._change:
            self._began.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = []
        for name, counters in p.observedMetrics.items():
            found = counters.asDict()
            total = found.pop("rows")
            rows += [(p.name or str(p.id), str(p.runId), p.batchId, name, rule, total - failed, failed) for rule, failed in found.items()]
        if not rows:
            return
        try:
            # a batch that runs again replaces its own rows
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite") \
                .parquet(f"{self.path}/source={p.id}/batch={p.batchId}")
        except Exception as failure:  # raised again on leaving: a listener's own errors are only logged
            self._failure = failure

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def __enter__(self) -> MetricsHistory:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        active = {str(q.runId) for q in self.spark.streams.active}
        with self._change:
            done = self._change.wait_for(lambda: self._began - active <= self._ended, timeout=120)
        self.spark.streams.removeListener(self)
        if self._failure is not None:
            raise self._failure
        if not done and exc[0] is None:
            raise TimeoutError("the events of an ended query did not come within 120 s")


def metrics_history(spark: SparkSession, path: str) -> DataFrame:
    """query, run_id, batch_id, observed (the name given to the counters), rule, passed, failed."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(path)


def metrics_total(spark: SparkSession, path: str) -> DataFrame:
    """observed, rule, passed, failed over all runs and batches: what ``metrics()`` counts on the same rows."""
    return metrics_history(spark, path).groupBy("observed", "rule").sum("passed", "failed") \
        .toDF("observed", "rule", "passed", "failed")
