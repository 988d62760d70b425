"""Routing of raw messages to topics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GARBAGE = "garbage"
FIELD, LINE = "\t", "\n"


def _topics(mapping: Mapping[str, str]) -> Column:
    """The routing configuration as one constant map with lower-cased keys."""
    text = LINE.join(f"{key.lower()}{FIELD}{topic}" for key, topic in mapping.items())
    return F.str_to_map(F.lit(text), F.lit(LINE), F.lit(FIELD))


def hash_percent(key: Column) -> Column:
    """A stable number in 0..99 from the digest of a key."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(100))


def route(
    df: DataFrame, mapping: Mapping[str, str], drop: Iterable[str] = (), garbage_pct: int = 0,
    sample_key: str = "value",
) -> DataFrame:
    """Add ``topic`` and ``route_state`` ∈ {sent, dropped, garbage, unmapped, malformed}.

    Dropped device types come first, then the mapping of the device type, of
    ``organization.devType`` and of ``organization.any``.  Of the unmapped rows about
    ``garbage_pct`` percent go to the garbage topic, chosen by a digest of ``sample_key`` so that
    a rerun picks the same rows and no shuffle is needed.
    """
    topics = _topics(mapping)
    dev, org = F.lower("dev_type"), F.lower("organization")
    found = F.coalesce(*[
        F.try_element_at(topics, key)
        for key in (dev, F.concat(org, F.lit("."), dev), F.concat(org, F.lit(".any")))
    ])
    dropped = dev.isin([d.lower() for d in drop]) if drop else F.lit(False)
    sampled = hash_percent(F.col(sample_key).cast("string")) < garbage_pct
    state = (
        F.when(F.col("malformed"), "malformed").when(dropped, "dropped")
        .when(found.isNotNull(), "sent").when(sampled, "garbage").otherwise("unmapped")
    )
    garbage_topic = mapping.get(GARBAGE, GARBAGE)
    df = df.withColumn("route_state", state)
    return df.withColumn(
        "topic",
        F.when(F.col("route_state") == "sent", found)
        .when(F.col("route_state") == "garbage", F.lit(garbage_topic)),
    )


def with_topic(df: DataFrame, mapping: Mapping[str, str], state: str = "state") -> DataFrame:
    """Add ``topic`` by the row's state; a state without topic stops the job."""
    found = F.try_element_at(_topics(mapping), F.lower(F.col(state)))
    missing = F.raise_error(F.concat(F.lit("no topic for state "), F.col(state)))
    return df.withColumn("topic", F.when(found.isNotNull(), found).otherwise(missing))
