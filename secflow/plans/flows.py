"""The smaller jobs around normalization and enrichment, each from its input to what it writes.

Every job returns its result and the statistics that go with it; writing is left to the sinks, so the same job serves
a batch, a micro-batch of ``job_stream`` and a test.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.operators.archive import flatten, read_day, upsert_latest, with_partitions
from secflow.operators.documents import to_documents
from secflow.operators.envelope import parse_route_key
from secflow.operators.hops import hop_delay, mean_hop_delay
from secflow.operators.route import route
from secflow.operators.scripts import apply_scripts
from secflow.operators.stats import filter_counts, routing_stats

def route_rows(
    values: DataFrame, mapping: Mapping[str, str], drop: Iterable[str] = (), garbage_pct: int = 0, sample_key: str = "value",
) -> DataFrame:
    """All messages (key, value, topic), marked with their ``route_state``; those that go nowhere have no topic."""
    routed = route(parse_route_key(values), mapping, drop, garbage_pct, sample_key)
    return routed.select(F.lit(None).cast("string").alias("key"), "value", "topic", "route_state")


def filter_rows(values: DataFrame, scripts: list[tuple[str, str]], topic: str, error_topic: str = "error") -> DataFrame:
    """All messages (key, value, topic), marked ``approved``, ``filtered`` or ``failed``.

    Scripts run once for each event.  Those that no script could decide go to the error topic, with
    the reason; those that a script rejects have no topic.
    """
    done = apply_scripts(values, scripts)
    failed = F.to_json(F.struct(F.col("value").alias("raw"), F.col("script_error").alias("stacktrace")))
    undecided = F.col("keep").isNull()
    return done.select(
        F.lit(None).cast("string").alias("key"), F.when(undecided, failed).otherwise(F.col("value")).alias("value"),
        F.when(F.col("keep"), topic).when(undecided, error_topic).alias("topic"),
        F.when(undecided, "failed").when(F.col("keep"), "approved").otherwise("filtered").alias("state"))


def sent(rows: DataFrame) -> DataFrame:
    """The messages that have a topic."""
    return rows.where("topic is not null").select("key", "value", "topic")


def route_job(
    values: DataFrame, mapping: Mapping[str, str], drop: Iterable[str] = (), garbage_pct: int = 0, sample_key: str = "value",
) -> tuple[DataFrame, DataFrame]:
    """Messages (key, value, topic) for the topics of their device types, and messages per state and topic.

    Both frames run the job; ``streaming.batches`` stages ``route_rows`` once for both.
    """
    rows = route_rows(values, mapping, drop, garbage_pct, sample_key)
    return sent(rows), routing_stats(rows)


def filter_job(
    values: DataFrame, scripts: list[tuple[str, str]], topic: str, error_topic: str = "error",
) -> tuple[DataFrame, DataFrame]:
    """Events that all scripts approve and, for the error topic, those that no script could decide; and counts.

    Both frames run the job; ``streaming.batches`` stages ``filter_rows`` once for both.
    """
    rows = filter_rows(values, scripts, topic, error_topic)
    return sent(rows), filter_counts(rows)


def monitor_job(chains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delays between neighbouring hops of each event, and their means per organization."""
    return hop_delay(chains), mean_hop_delay(chains)


def store_job(events: DataFrame, key: str = "id", order: str = "write_ts") -> tuple[DataFrame, DataFrame]:
    """The newest row of each key for the keyed store, and how many rows were read and are kept."""
    newest = upsert_latest(events, key, order)
    counts = events.agg(F.count("*").alias("read"), F.count_distinct(key).alias("kept"))
    return newest, counts


def search_job(events: DataFrame, event: str = "event") -> tuple[DataFrame, DataFrame]:
    """Search documents, and documents per index."""
    documents = to_documents(events, event)
    return documents, documents.groupBy("index_name").agg(F.count("*").alias("documents"))


def archive_job(
    stored: DataFrame, day: str, ts_col: str, event: str = "event", org: str = "collector_organization", epoch: str = "data_time",
) -> tuple[DataFrame, DataFrame]:
    """One day of the store as flat rows with their partition columns, and rows per partition."""
    flat = with_partitions(flatten(read_day(stored, day, ts_col).select(f"{event}.*")), org, epoch)
    return flat, flat.groupBy("sys_org", "sys_year", "sys_month", "sys_day").agg(F.count("*").alias("rows"))
