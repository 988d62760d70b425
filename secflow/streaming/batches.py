"""Micro-batches whose output is written once and then read by every sink and by the statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from secflow.streaming.jobs import Refreshing, run_batches

Write = Callable[[DataFrame, int], None]


class Batch:
    """What a job makes of one micro-batch, in a folder that executors share.

    The job runs once: its rows, each marked with its state, are staged in a folder named by the
    batch.  Sinks and statistics read them from there.  A step is marked in the commit log after it
    has ended, so a batch that is repeated after a failure goes on behind the last step that ended,
    with the very rows that the earlier steps have seen, whatever the dimensions are by then.  A step
    that was broken off is repeated: it should replace what it wrote, as ``batch_folder`` does.
    Queues get such a step's messages again.
    """

    def __init__(self, spark: SparkSession, folder: str, batch_id: int):
        self.spark, self.id = spark, batch_id
        self._staged, self._log = f"{folder}/staged/batch={batch_id}", f"{folder}/commits/batch={batch_id}"

    def done(self, step: str) -> bool:
        try:
            return bool(self.spark.read.schema("step STRING").json(f"{self._log}/{step}").take(1))
        except AnalysisException:  # no such folder
            return False

    def _once(self, step: str, act: Callable[[], None]) -> None:
        if self.done(step):
            return
        act()
        mark = self.spark.range(1).select(F.lit(step).alias("step"))
        mark.coalesce(1).write.mode("overwrite").json(f"{self._log}/{step}")

    def stage(self, job: Callable[[], DataFrame], by: str | None = None) -> None:
        """Write the job's rows, in a folder for each value of ``by``, so that a sink of one state reads only that."""
        def write() -> None:
            writer = job().write.mode("overwrite")
            (writer.partitionBy(by) if by else writer).parquet(self._staged)

        self._once("staged", write)

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self._staged)

    def deliver(self, name: str, write: Write) -> None:
        """Hand the staged rows to a sink, unless it has them already."""
        self._once(f"sink={name}", lambda: write(self.rows(), self.id))


def batch_folder(path: str, choose: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Write:
    """A sink of one folder for each batch, which a repeated batch replaces; ``choose`` selects or aggregates the rows."""
    def write(rows: DataFrame, batch_id: int) -> None:
        choose(rows).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def deliver_stream(
    stream: DataFrame, job: Callable[..., DataFrame], dimensions: dict[str, Refreshing], sinks: dict[str, Write],
    folder: str, checkpoint: str, by: str | None = None, **how,
) -> StreamingQuery:
    """A batch job run once on every micro-batch with current dimensions, and its rows delivered to all sinks in order.

    Statistics are a sink like others: they aggregate the staged rows and never run the job again.
    ``folder`` belongs to this query alone; old batches below it can be deleted once they are committed.
    """
    def body(batch: DataFrame, batch_id: int) -> None:
        out = Batch(batch.sparkSession, folder, batch_id)
        out.stage(lambda: job(batch, **{name: d.get() for name, d in dimensions.items()}), by)
        for name, write in sinks.items():
            out.deliver(name, write)

    return run_batches(stream, body, checkpoint, **how)
