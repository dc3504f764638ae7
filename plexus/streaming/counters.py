"""Counters of a stream: one row a micro-batch with the rows that came in, were rejected and were
written, observed inside the batch and stored by a listener.

A row is stored under its batch number, so a batch that is replayed after a failure
replaces its row and the sums agree with the table that the sink holds.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from plexus.schemas import EVENT

METRICS = ("rows_in", "rejected", "written")
COUNTERS = "query string, batch_id long, started string, rows_in long, rejected long, written long, late long, state_rows long"


def observed(rows: DataFrame, name: str = "counters") -> DataFrame:
    """Bronze rows with their counters: a row without any field could not be read."""
    bad = F.lit(True)
    for field in EVENT.fieldNames():
        bad = bad & F.col(field).isNull()
    return rows.observe(name, F.count(F.lit(1)).alias("rows_in"), F.count_if(bad).alias("rejected"),
                        F.count_if(~bad).alias("written"))


class CounterListener(StreamingQueryListener):
    """Stores the counters of the queries named ``query`` under ``path``; add it with
    ``spark.streams.addListener``. ``ended`` is set when the query's last batch is stored."""

    def __init__(self, spark: SparkSession, path: str, query: str, name: str = "counters"):
        self.spark, self.path, self.query, self.name = spark, path.rstrip("/"), query, name
        self.ended = threading.Event()
        self.runs: set[str] = set()

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self.runs.add(str(event.runId))
            self.ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        if p.name != self.query or seen is None or not p.numInputRows:
            return
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        held = sum(s.numRowsTotal for s in p.stateOperators)
        row = (p.name, p.batchId, p.timestamp, *(int(seen[m] or 0) for m in METRICS), late, held)
        self.spark.createDataFrame([row], COUNTERS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/batch={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.runs:
            self.ended.set()


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COUNTERS).parquet(f"{path.rstrip('/')}/batch=*")
