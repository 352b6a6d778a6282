"""PL1 ingest_bronze, SNK1 bronze_stream_sink, SNK2 stream_lifecycle.

A stateless stream: every micro-batch is the Bronze projection (parse and
stamp) written by ``foreachBatch`` under its own id, together with its metrics,
and published by one rename. The checkpoint holds the source offsets; a batch
that is replayed after a stop finds its folder and adds nothing. There is no
log of files that grows with the stream's age: readers list the batch folders,
which compaction (SNK8) merges.
"""

from __future__ import annotations

import threading
from typing import Optional

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import BRONZE_TABLE, LakeConfig
from ..operators.wire import bronze_from_wire
from ..sinks.storage import filesystem, path_exists

DEFAULT_TRIGGER = "30 seconds"

#: Folder of a batch's metrics inside the batch's own folder; hidden from readers of the rows.
METRICS_FOLDER = "_metrics"


def batch_folder(path: str, query_id: str, batch_id: int) -> str:
    """A stream with a new checkpoint starts again at batch 0, so the query's id is part of the name."""
    return f"{path.rstrip('/')}/query={query_id}/batch={batch_id}"


def publish_batch(df: DataFrame, path: str, query_id: str, batch_id: int, fmt: str = "parquet") -> bool:
    """Writes one micro-batch and its metrics under its id; False if it is there already.

    Rows and metrics are staged and appear together by one rename, so a stop at
    any moment leaves either the whole batch or nothing of it, and a replay of a
    published batch adds nothing. Delta does the same by its transaction id.
    """
    spark = df.sparkSession
    if fmt == "delta":
        w = df.drop(_BYTES).withColumns({"query": F.lit(query_id), "batch": F.lit(batch_id).cast("long")}).write.format("delta").mode("append")
        w.option("txnAppId", query_id).option("txnVersion", str(batch_id)).save(path)
        return True
    target = batch_folder(path, query_id, batch_id)
    if path_exists(spark, target):
        return False
    staged = f"{path.rstrip('/')}/_staging-{query_id}-{batch_id}"
    seen = Observation(f"batch_{batch_id}")
    failed = F.col("event_id").isNull()
    size = F.col(_BYTES) if _BYTES in df.columns else F.lit(None).cast("long")
    rows = df.observe(
        seen,
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("bytes"),
        F.count_if(~failed).alias("parsed"),
        F.count_if(failed).alias("failed"),
    )
    rows.drop(_BYTES).write.mode("overwrite").format(fmt).save(staged)
    m = seen.get
    metrics = spark.createDataFrame([(query_id, batch_id, m["messages"], m["bytes"], m["parsed"], m["failed"])], BATCH_METRICS)
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{staged}/{METRICS_FOLDER}")
    fs, source = filesystem(spark, staged)
    _, final = filesystem(spark, target)
    fs.mkdirs(final.getParent())
    if not fs.rename(source, final):
        raise RuntimeError(f"could not publish batch {batch_id} as {target}")
    return True


BATCH_METRICS = "query string, batch long, messages long, bytes long, parsed long, failed long"
_BYTES = "_wire_bytes"


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    """V5, live: the metrics of every published batch, one row each, from the batches' own folders."""
    return spark.read.schema(BATCH_METRICS).parquet(f"{path.rstrip('/')}/query=*/batch=*/{METRICS_FOLDER}")


def start_bronze(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Optional[str] = DEFAULT_TRIGGER,
    fmt: str = "parquet",
    query_name: Optional[str] = None,
) -> StreamingQuery:
    """SNK1: publish micro-batches with a durable checkpoint, each one once (``publish_batch``).

    ``trigger="available_now"`` processes everything available (in
    rate-limited batches) and stops: replays and tests.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, path, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id, fmt)

    w = df.writeStream.foreachBatch(publish).outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


# Name of the per-micro-batch metrics in ``StreamingQueryProgress.observedMetrics``.
LIVE_METRICS = "ingest_live"


def live_metrics(bronze: DataFrame) -> DataFrame:
    """V5, live: messages, bytes, parsed and failed of every micro-batch.

    Taken with ``observe`` on the Bronze projection itself (needs the
    ``_wire_bytes`` column): a side aggregate of the batch, no
    second JSON parse, no shuffle. ``publish_batch`` stores the same values with
    the batch; these are for watching a query as it runs. Spark reports them in
    ``query.lastProgress`` and to any ``StreamingQueryListener`` as
    ``observedMetrics[LIVE_METRICS]``.
    """
    failed = F.col("event_id").isNull()
    return bronze.observe(
        LIVE_METRICS,
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(_BYTES), F.lit(0)).cast("long").alias("bytes"),
        F.count_if(~failed).alias("parsed"),
        F.count_if(failed).alias("failed"),
    )


METRICS_SCHEMA = (
    "run_id string, batch_id long, reported_at string, messages long, bytes long, parsed long, failed long, last_error string"
)


class IngestMetricsListener(StreamingQueryListener):
    """V5, live: one row per micro-batch appended to a lake table, and one with
    ``last_error`` when a query ends with an exception.

    ``recentProgress`` of a query keeps its last 100 batches only; the table
    keeps all of them, and outlives the query. One row a batch passes the
    driver. Add it with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path
        self.ended = threading.Event()  # all batches of a query are reported before its end

    def _append(self, *row) -> None:
        self.spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        m = (p.observedMetrics or {}).get(LIVE_METRICS)
        if m is not None:
            self._append(str(p.runId), p.batchId, p.timestamp, m["messages"], m["bytes"], m["parsed"], m["failed"], None)

    def onQueryTerminated(self, event) -> None:
        try:
            if event.exception:
                self._append(str(event.runId), None, None, None, None, None, None, event.exception)
        finally:
            self.ended.set()


def batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The listener's table: a batch that was reported again after a restart counts once."""
    return spark.read.schema(METRICS_SCHEMA).parquet(path).dropDuplicates(["run_id", "batch_id", "last_error"])


def ingest_bronze(
    spark: SparkSession,
    cfg: LakeConfig,
    source: DataFrame,
    trigger: Optional[str] = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """PL1: source (Kafka or wire files) -> V5 live metrics -> P1-P4 -> Bronze."""
    bronze = live_metrics(bronze_from_wire(source, cfg.clock, cfg.keep_raw_value, wire_bytes=_BYTES))
    return start_bronze(
        bronze,
        cfg.path("bronze", BRONZE_TABLE),
        cfg.checkpoint("bronze"),
        trigger=trigger,
        fmt=cfg.table_format,
    )


def run_until_stopped(query: StreamingQuery, timeout: Optional[float] = None) -> bool:
    """SNK2: block until the query ends; stop it cleanly on interrupt.

    Returns True when the query terminated (or was stopped), False on timeout.
    A failure inside the query is raised here.
    """
    try:
        if timeout is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(timeout))
    except KeyboardInterrupt:
        query.stop()
        return True
