"""Work schedules: time windows, working days and the calendar of holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.dates import epoch_date, second_of_day
from secflow.schema import with_leaves
from secflow.session import keyed_join

DAY = 86400
DAY_MINUTES = 1440


def split_period(time_from: Column, time_to: Column) -> Column:
    """Minute ranges of a period in seconds of day: two across midnight, all day when ends are equal."""
    start, end = (F.floor(t / 60).cast("int") for t in (time_from, time_to))

    def period(low: Column | int, high: Column | int) -> Column:
        low, high = (F.lit(x) if isinstance(x, int) else x for x in (low, high))
        return F.struct(low.alias("from"), high.alias("to"))

    return (
        F.when(time_from > time_to, F.array(period(start, DAY_MINUTES), period(0, end)))
        .when(time_from == time_to, F.array(period(0, DAY_MINUTES)))
        .otherwise(F.array(period(start, end)))
    )


def holiday_list(holidays: DataFrame) -> Column:
    """The calendar as one array constant; it has one entry per holiday."""
    none = F.array().cast("array<date>")
    return F.coalesce(holidays.agg(F.collect_set("holiday")).scalar(), none)


def is_working_day(
    date: Column, start: Column, days_work: Column, days_weekend: Column, is_calendar: Column,
    holidays: Column,
) -> Column:
    """Seven days a week, five-two with holidays off, or a rotation counted from ``start``."""
    passed = F.datediff(date, start) - F.when(
        is_calendar, F.size(F.filter(holidays, lambda h: h < date))
    ).otherwise(0)
    cycle = days_work + days_weekend
    rotating = F.when(cycle > 0, F.pmod(passed, cycle) < days_work).otherwise(False)
    plain = (F.weekday(date) < 5) & ~F.array_contains(holidays, date)
    return (
        F.when(days_work == 7, True)
        .when((days_work == 5) & (days_weekend == 2), plain)
        .otherwise(rotating)
    )


def schedule_check(intervals: Column, epoch: Column, holidays: Column) -> Column:
    """Whether any interval of a rule's schedule covers the time: its day and its seconds of day."""
    second, date = second_of_day(epoch), epoch_date(epoch)

    def one(i: Column) -> Column:
        anytime = (i["time_from"] == 0) & (i["time_to"] == 0)
        working = F.when(i["is_calendar"], ~F.array_contains(holidays, date)).otherwise(
            (i["days_work"] + i["days_weekend"] == 7) & (F.weekday(date) + 1 <= i["days_work"])
        )
        return working & (anytime | within(second, i["time_from"], i["time_to"]))

    return F.exists(intervals, one)


def within(point: Column, low: Column, high: Column) -> Column:
    """Closed range on the clock; an end of 0 means midnight, and a range may wrap around it."""
    wraps = low > high
    return F.when(wraps & (high == 0), point >= low).when(
        wraps, (point >= low) | (point <= high)
    ).otherwise((point >= low) & (point <= high))


def schedules_by_group(schedules: DataFrame) -> DataFrame:
    """One row per schedule group with its intervals already split at midnight."""
    interval = F.struct(
        split_period(F.col("time_from"), F.col("time_to")).alias("periods"),
        "days_work", "days_weekend", "is_calendar",
    )
    return schedules.groupBy("group_id").agg(F.collect_list(interval).alias("schedule"))


def schedule_columns(
    df: DataFrame, logins: DataFrame, schedules: DataFrame, holidays: DataFrame, event: str = "event"
) -> DataFrame:
    """Add ``time_allowed`` and ``working_day`` of account subjects seen on Windows sources.

    Subjects without a login entry stay unflagged; a group without schedule allows nothing.
    """
    staff = logins.join(schedules_by_group(schedules), "group_id", "left").select(
        F.col("org").alias("_org"), F.col("domain").alias("_domain"), F.col("login").alias("_login"),
        F.to_date("start_work").alias("_start"),
        F.col("schedule").alias("_schedule"), F.lit(True).alias("_known"),
    )
    e = F.col(event)
    eligible = (e["subject"]["category"] == "account") & F.contains(
        F.lower(e["eventSource"]["title"]), F.lit("windows")
    )

    def key(column: Column) -> Column:
        return F.when(eligible, F.lower(column))

    joined = keyed_join(df, staff, {
        "_org": key(e["collector"]["organization"]), "_domain": key(e["subject"]["domain"]),
        "_login": key(e["subject"]["name"]),
    }).withColumn("_holidays", holiday_list(holidays))
    minute = F.floor(second_of_day(e["eventTime"]) / 60).cast("int")
    date = epoch_date(e["eventTime"])
    days = F.col("_holidays")
    time_allowed = F.exists("_schedule", lambda s: F.exists(
        s["periods"], lambda p: (p["from"] <= minute) & (minute <= p["to"])))
    working = F.exists("_schedule", lambda s: is_working_day(
        date, F.col("_start"), s["days_work"], s["days_weekend"], s["is_calendar"], days))

    def flag(value: Column) -> Column:
        return F.when(F.col("_known"), F.coalesce(value, F.lit(False)))

    return joined.withColumns(
        {"time_allowed": flag(time_allowed), "working_day": flag(working)}
    ).drop("_holidays", "_start", "_schedule", "_known")


def schedule_leaves(event: str = "event") -> dict[str, Column]:
    """Event leaves filled from the columns of :func:`schedule_columns`; no answer keeps the old ones."""
    old = F.col(event)["subject"]["enrichment"]
    return {
        "subject.enrichment.isTimeAllowed": F.coalesce("time_allowed", old["isTimeAllowed"]),
        "subject.enrichment.isWorkingDay": F.coalesce("working_day", old["isWorkingDay"]),
    }


def schedule_flags(
    df: DataFrame, logins: DataFrame, schedules: DataFrame, holidays: DataFrame, event: str = "event"
) -> DataFrame:
    """Set ``isTimeAllowed`` and ``isWorkingDay`` inside the event."""
    found = schedule_columns(df, logins, schedules, holidays, event)
    return with_leaves(found, event, schedule_leaves(event)).drop("time_allowed", "working_day")
