"""Delays between the hops a message passed on its way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.operators.envelope import hops


def chain_stops(df: DataFrame) -> DataFrame:
    """Add ``stops``: hop names and times in µs, last hop first, the organization's own time at the end."""
    listed = F.transform(F.map_entries(hops(F.col("chain"))), lambda h: F.struct(
        (-h["value"]["number"]).alias("order"), h["key"].alias("name"), h["value"]["rt"].alias("rt")))
    own = F.struct(
        F.lit(None).cast("int").alias("order"), F.col("organization").alias("name"),
        (F.col("event_time") * 1_000_000).alias("rt"),
    )
    return df.withColumn("stops", F.concat(F.array_sort(listed), F.array(own)))


def hop_delay(df: DataFrame) -> DataFrame:
    """One row per pair of neighbouring stops: ``hop_in`` → ``hop_out`` and ``delay_us``.

    Needs ``chain``, ``organization`` and ``event_time`` (epoch seconds); other columns are kept.
    Names are unique within a chain, so every pair occurs once per event and no grouping is needed.
    """
    kept = [c for c in df.columns if c != "chain"]
    stops = chain_stops(df)
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("stops") - 2),
        lambda i: F.struct(
            F.get("stops", i + 1)["name"].alias("hop_in"), F.get("stops", i)["name"].alias("hop_out"),
            (F.get("stops", i)["rt"] - F.get("stops", i + 1)["rt"]).alias("delay_us"),
        ),
    )
    several = F.when(F.size("stops") >= 2, pairs)
    return stops.select(*kept, F.explode(several).alias("_p")).select(*kept, "_p.*")


def mean_hop_delay(df: DataFrame) -> DataFrame:
    """Mean delay per organization and pair of hops, in whole µs."""
    return hop_delay(df).groupBy("organization", "hop_in", "hop_out").agg(
        F.expr("sum(delay_us) div count(delay_us)").alias("delay_us"), F.count("*").alias("events"),
    )
