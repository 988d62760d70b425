"""Structured Streaming wrappers: refreshable dimensions, job queries and progress rows."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from secflow.operators.archive import upsert_latest
from secflow.operators.reassemble import dead_letters, merge_chain, reassemble
from secflow.sources.sinks import start_sink

# Batch interval and refresh periods in seconds.
TRIGGER = "10 seconds"
DIMENSION_TTL, GEO_TTL, CALENDAR_TTL, SCRIPT_TTL = 600, 86400, 86400, 600


class Refreshing:
    """A value that is loaded again once it is older than ``ttl`` seconds.

    Meant to be read at the start of a micro-batch: for frames it re-reads the table's file list,
    so a new version of the dimension is seen without a restart.
    """

    def __init__(self, loader: Callable[[], Any], ttl: float, clock: Callable[[], float] = time.monotonic):
        self._loader, self._ttl, self._clock = loader, ttl, clock
        self._value: Any = None
        self._loaded: float | None = None

    def get(self) -> Any:
        now = self._clock()
        if self._loaded is None or now - self._loaded >= self._ttl:
            self._value, self._loaded = self._loader(), now
        return self._value


def run_batches(
    stream: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: str | None = TRIGGER, available_now: bool = False, name: str | None = None,
) -> StreamingQuery:
    """Run ``body`` on every micro-batch; it may read refreshed dimensions and write several sinks.

    A batch may be repeated after a failure, so ``body`` should write idempotently, for example
    through a folder named by the batch id or into the keyed store.
    """
    writer = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def job_stream(
    stream: DataFrame, job: Callable[..., DataFrame], dimensions: dict[str, Refreshing],
    write: Callable[[DataFrame, int], None], checkpoint: str, **how,
) -> StreamingQuery:
    """A batch job (normalize, enrich, …) run on every micro-batch with current dimensions."""

    def body(batch: DataFrame, batch_id: int) -> None:
        write(job(batch, **{name: d.get() for name, d in dimensions.items()}), batch_id)

    return run_batches(stream, body, checkpoint, **how)


def reassembly_queries(
    values: DataFrame, sink: str, checkpoint: str, path: str | None = None,
    topics: tuple[str, str] = ("reassembled", "error"), **how,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both queries: reassembled records, and messages that could not be read."""
    null_key = F.lit(None).cast("string").alias("key")
    records = merge_chain(reassemble(values)).select(null_key, "value", F.lit(topics[0]).alias("topic"))
    errors = dead_letters(values).select(
        null_key, F.to_json(F.struct("id", "raw", "stacktrace")).alias("value"), F.lit(topics[1]).alias("topic"))

    def place(name: str) -> dict[str, Any]:
        return {"path": f"{path}/{name}"} if path is not None else {}

    return (
        start_sink(records, sink, f"{checkpoint}/records", **place("records"), **how),
        start_sink(errors, sink, f"{checkpoint}/errors", **place("errors"), **how),
    )


def wait_for_any(spark: SparkSession) -> None:
    """Return when one of the running queries ends, and raise if it failed."""
    spark.streams.awaitAnyTermination()


def store_stream(
    stream: DataFrame, path: str, checkpoint: str, key: str = "id", order: str = "write_ts", **how,
) -> StreamingQuery:
    """Streaming form of the keyed store: the last write of a key wins, however late it comes.

    Each micro-batch is reduced to the newest row of each key and written to a folder of its own,
    so a repeated batch replaces itself.  ``read_store`` merges the folders, ``compact_store``
    replaces them by one.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        upsert_latest(batch, key, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run_batches(stream, body, checkpoint, **how)


def read_store(spark: SparkSession, path: str, key: str = "id", order: str = "write_ts") -> DataFrame:
    """The newest row of each key over all batches of a store."""
    return upsert_latest(spark.read.parquet(path).drop("batch"), key, order)


def compact_store(spark: SparkSession, path: str, target: str, key: str = "id", order: str = "write_ts") -> None:
    """Write the merged store as one batch below ``target``; its stream goes on there with larger batch ids."""
    read_store(spark, path, key, order).write.mode("overwrite").parquet(f"{target}/batch=-1")


PROGRESS = (
    "name STRING, batch_id BIGINT, processing_ms BIGINT, rows_updated BIGINT, read_ms BIGINT, "
    "write_ms BIGINT, state_bytes BIGINT, input_rows BIGINT"
)


def progress_row(progress: dict[str, Any]) -> tuple:
    """Numbers of one progress report: time beside reading and writing, state rows and memory."""
    durations = progress.get("durationMs") or {}
    operators = progress.get("stateOperators") or []
    return (
        progress.get("name"), progress.get("batchId"),
        sum(v for k, v in durations.items() if k not in ("getBatch", "addBatch")),
        sum(o.get("numRowsUpdated", 0) for o in operators),
        durations.get("getBatch", 0), durations.get("addBatch", 0),
        sum(o.get("memoryUsedBytes", 0) for o in operators), progress.get("numInputRows", 0),
    )


class ProgressLog(StreamingQueryListener):
    """Appends each progress report (a few numbers per batch) to a folder and keeps none of them."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = progress_row(json.loads(event.progress.json))
        self._spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").json(self._path)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def frame(self) -> DataFrame:
        return self._spark.read.schema(PROGRESS).json(self._path)
