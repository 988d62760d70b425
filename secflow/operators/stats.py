"""Counters of the jobs as aggregates; nothing is collected on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.operators.states import encoded


def out_of_time(event_time: Column, now: Column) -> Column:
    """1 for an event dated at or after the processing time."""
    return F.when(event_time >= now, 1).otherwise(0)


def pipeline_stats(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Bytes, messages and future-dated messages per organization, device, hosts and state.

    Bytes are those of the JSON text the row leaves the job with.
    """
    at = F.unix_seconds(F.current_timestamp()) if now is None else now
    timed = F.col("state").isin("normalized", "raw", "chain")
    sized = df if "value" in df.columns else encoded(df)
    return sized.groupBy("organization", "dev_type", "collector_host", "source_host", "state").agg(
        F.sum(F.octet_length("value").cast("bigint")).alias("bytes"),
        F.count("*").alias("messages"),
        F.sum(F.when(timed, out_of_time(F.col("event_time"), at)).otherwise(0)).alias("out_of_time"),
    )


def enrichment_stats(df: DataFrame, event: str = "event") -> DataFrame:
    """Events, geo hits and misses, login hits and misses per product and organization."""
    e = F.col(event)

    def geo(side: str) -> tuple[Column, Column]:
        end = e[side]
        applies = end["ip"].isNotNull() & ~F.coalesce(
            end["enrichment"]["isNetworkLocal"], F.lit(False))
        geo = end["enrichment"]["geo"]
        hit = F.coalesce(
            geo["city"], geo["country"], geo["org"], end["enrichment"]["network"]
        ).isNotNull()
        return (applies & hit).cast("bigint"), (applies & ~hit).cast("bigint")

    flags = e["subject"]["enrichment"]
    asked = e["subject"]["name"].isNotNull() & e["subject"]["domain"].isNotNull()
    answered = flags["isTimeAllowed"].isNotNull() & flags["isWorkingDay"].isNotNull()
    (source_hit, source_miss), (dest_hit, dest_miss) = geo("source"), geo("destination")
    counts = df.groupBy(
        e["eventSource"]["title"].alias("product"), e["collector"]["organization"].alias("organization")
    ).agg(
        F.count("*").alias("events"),
        F.sum(source_hit + dest_hit).alias("geo_hit"),
        F.sum(source_miss + dest_miss).alias("geo_miss"),
        F.sum((asked & answered).cast("bigint")).alias("login_hit"),
        F.sum((asked & ~answered).cast("bigint")).alias("login_miss"),
    )
    return counts.withColumns({
        "geo_miss_ratio": _ratio("geo"), "login_miss_ratio": _ratio("login"),
    })


def _ratio(name: str) -> Column:
    total = F.col(f"{name}_hit") + F.col(f"{name}_miss")
    return F.round(F.col(f"{name}_miss") / F.greatest(total, F.lit(1)), 2)


def routing_stats(df: DataFrame) -> DataFrame:
    """Messages per route state and topic."""
    return df.groupBy("route_state", "topic").agg(F.count("*").alias("messages"))


def routing_totals(df: DataFrame) -> DataFrame:
    """One row of totals; malformed and dropped messages are counted apart from the total."""

    def states(*names: str) -> Column:
        return F.count_if(F.col("route_state").isin(*names))

    return df.agg(
        states("sent", "garbage", "unmapped").alias("total"),
        states("sent").alias("sent"), states("garbage").alias("garbage"),
        states("unmapped").alias("skipped"), states("dropped").alias("dropped"),
        states("malformed").alias("malformed"),
    )


def filter_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(~F.col("keep")).alias("filtered"), F.count_if(F.col("keep")).alias("approved")
    )


def filter_counts(rows: DataFrame) -> DataFrame:
    """``filter_stats`` of rows that are marked with their state."""
    return rows.agg(*[F.count_if(F.col("state") == state).alias(state) for state in ("filtered", "approved")])


def input_volume(df: DataFrame) -> DataFrame:
    """Messages and offset span per topic partition of a queue frame."""
    return df.groupBy("topic", "partition").agg(
        F.count("*").alias("messages"),
        (F.max("offset") - F.min("offset") + 1).alias("offset_span"),
    )
