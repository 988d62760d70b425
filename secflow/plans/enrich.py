"""The enrichment job: geo data, schedule flags and access verdicts on canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.operators.controls import CONTROL_ORDER, control, verdict_leaves
from secflow.operators.geo import GEO_COLUMNS, geo_columns, geo_leaves
from secflow.operators.rules import Prepared
from secflow.operators.schedule import schedule_columns, schedule_leaves
from secflow.schema import EVENT, build, with_leaves

#: All that lookups read of an event.
LOOKED_AT = [
    "collector.organization", "subject.category", "subject.domain", "subject.name", "object.category", "object.name",
    "object.path", "source.hostname", "source.ip", "source.port", "destination.hostname", "destination.ip",
    "destination.port", "interaction.action", "interaction.logonType", "interaction.protocol", "data.originTime",
    "data.aux9", "eventSource.category", "eventSource.title", "eventTime",
]
ANSWERS = [*GEO_COLUMNS, "time_allowed", "working_day", *[f"verdict_{kind}" for kind in CONTROL_ORDER]]


def lookup_frame(events: DataFrame, event: str = "event") -> tuple[Column, DataFrame]:
    """What lookups read of the events: its digest, and one narrow event for each digest."""
    leaves = {name: F.col(f"{event}.{name}") for name in LOOKED_AT}
    digest = F.unhex(F.md5(F.to_json(F.struct(*[c.alias(n) for n, c in leaves.items()]))))
    return digest, events.select(digest.alias("_digest"), build(EVENT, leaves).alias(event)).groupBy("_digest").agg(
        F.first(event).alias(event))


def enrich_job(
    events: DataFrame, cities: DataFrame, countries: DataFrame, rules: DataFrame | dict[str, Prepared],
    logins: DataFrame, schedules: DataFrame, holidays: DataFrame, event: str = "event",
) -> DataFrame:
    """Enrich the ``event`` column.

    All lookups run on a narrow frame of the distinct values that they read, and its answers are
    joined to the events once, in one exchange; they are written into the event in one step.  Every
    lookup takes its keys from the narrow frame itself and not from what is joined to it so far, so
    the plan stays linear in the number of lookups.  ``rules`` is one frame, or prepared tables by
    control.
    """
    digest, narrow = lookup_frame(events, event)
    df = geo_columns(narrow, cities, countries, event, probe=narrow)
    df = schedule_columns(df, logins, schedules, holidays, event)
    for kind in CONTROL_ORDER:
        own = rules[kind] if isinstance(rules, dict) else rules
        df = control(df, own, kind, holidays, event, probe=narrow, verdict_col=f"verdict_{kind}", rule_col=f"rule_{kind}", by="_digest")
    done = events.withColumn("_digest", digest).join(df.select("_digest", *ANSWERS), "_digest", "left")
    leaves = {**geo_leaves(), **schedule_leaves(event), **verdict_leaves(event)}
    return with_leaves(done, event, leaves).drop("_digest", *ANSWERS)
