"""Bronze ingest as a Structured Streaming query: messages -> parsed rows -> append sink.

The message source and the table format are parameters: Kafka + Delta in
production, the text file source + parquet in tests. The sink's checkpoint
(offset and commit logs) makes a restart replay exactly the batch that was
planned but not committed; the file/Delta sinks commit each batch once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plexus.schemas import EVENT
from plexus.sources.messages import parse_messages

KAFKA_DEFAULTS = {"startingOffsets": "latest"}


def message_stream(spark: SparkSession, source_format: str, path: str | None = None,
                   options: dict[str, str] | None = None) -> DataFrame:
    """Streaming DataFrame with a ``value`` column (bytes from Kafka, one text
    line per message from the file source)."""
    opts = dict(KAFKA_DEFAULTS) if source_format == "kafka" else {}
    opts.update(options or {})
    reader = spark.readStream.format(source_format).options(**opts)
    return reader.load(path) if path else reader.load()


def bronze_stream(messages: DataFrame) -> DataFrame:
    return parse_messages(messages, "value")


def start_bronze(spark: SparkSession, source_format: str, sink_path: str, checkpoint_path: str,
                 source_path: str | None = None, source_options: dict[str, str] | None = None,
                 sink_format: str = "parquet", available_now: bool = False,
                 processing_time: str | None = None, batch_writer=None, transform=None,
                 name: str | None = None) -> StreamingQuery:
    """Start the append-only Bronze query. Default trigger = as fast as data arrives;
    ``processing_time`` (e.g. "1 minute") batches more rows per file. ``batch_writer``
    (see ``idempotent_batch_writer``) takes the place of the file sink; ``transform`` is applied
    to the rows (see ``counters.observed``); ``name`` is the query's."""
    rows = bronze_stream(message_stream(spark, source_format, source_path, source_options))
    rows = transform(rows) if transform else rows
    w = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint_path)
    w = w.queryName(name) if name else w
    w = w.foreachBatch(batch_writer) if batch_writer else w.format(sink_format)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start() if batch_writer else w.start(sink_path)


def run_bronze_stream(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str,
                      source_format: str = "text", sink_format: str = "parquet") -> DataFrame:
    """Process everything available now, stop, and return the Bronze table."""
    q = start_bronze(spark, source_format, sink_path, checkpoint_path, source_path=source_path,
                     sink_format=sink_format, available_now=True)
    q.awaitTermination()
    return spark.read.format(sink_format).schema(EVENT).load(sink_path)


def run_bronze_batches(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str,
                       source_format: str = "text", sink_format: str = "parquet", writer=None) -> DataFrame:
    """As ``run_bronze_stream``, each micro-batch in a folder of its own: a batch that was
    planned but not committed replaces itself when it is replayed."""
    q = start_bronze(spark, source_format, sink_path, checkpoint_path, source_path=source_path,
                     available_now=True, batch_writer=writer or idempotent_batch_writer(sink_path, sink_format))
    q.awaitTermination()
    return spark.read.format(sink_format).schema(EVENT).load(f"{sink_path.rstrip('/')}/batch_id=*")


def write_message_files(bronze: DataFrame, path: str) -> str:
    """Encode Bronze rows as one JSON message per line (a replayable message log)."""
    cols = [F.col(c) for c in EVENT.fieldNames()]
    bronze.select(F.to_json(F.struct(*cols)).alias("value")).write.mode("overwrite").text(path)
    return path


def idempotent_batch_writer(path: str, fmt: str = "parquet"):
    """foreachBatch sink that writes each micro-batch to its own ``batch_id=N``
    folder with overwrite, so a replayed batch replaces itself instead of
    duplicating rows (exactly-once without a transactional table format)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write
