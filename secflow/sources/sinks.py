"""Writers for batch and streaming frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from secflow.operators.documents import to_documents
from secflow.operators.route import with_topic
from secflow.operators.states import encoded


def state_messages(df: DataFrame, topics: Mapping[str, str]) -> DataFrame:
    """(key, value, topic) of final states; the topic follows from the state."""
    return with_topic(encoded(df), topics).select(
        F.lit(None).cast("string").alias("key"), "value", "topic", "state")


def event_messages(df: DataFrame, topic: str, event: str = "event") -> DataFrame:
    """(key, value, topic) of enriched events, all to one topic."""
    return df.select(F.lit(None).cast("string").alias("key"), F.to_json(event).alias("value"),
                     F.lit(topic).alias("topic"))


def passthrough(df: DataFrame, topic: str) -> DataFrame:
    """Values forwarded as they came."""
    return df.select("key", "value", F.lit(topic).alias("topic"))


def write_batch(df: DataFrame, sink: str, path: str | None = None, mode: str = "append",
                partition_by: list[str] | None = None, **options: str) -> None:
    if sink == "kafka":
        df.select("key", "value", "topic").write.format("kafka").options(**options).save()
        return
    writer = df.write.format(sink).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_search_docs(df: DataFrame, path: str, event: str = "event", mode: str = "append") -> None:
    """Documents as JSON lines, one folder per index."""
    to_documents(df, event).write.mode(mode).partitionBy("index_name").json(path)


def start_sink(
    df: DataFrame, sink: str, checkpoint: str, path: str | None = None, trigger: str | None = None,
    partition_by: list[str] | None = None, name: str | None = None, available_now: bool = False,
    **options: str,
) -> StreamingQuery:
    """Start writing a streaming frame; offsets live in the checkpoint, so a lost job resumes."""
    rows = df.select("key", "value", "topic") if sink == "kafka" else df
    writer = rows.writeStream.format(sink).option("checkpointLocation", checkpoint).options(**options)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
