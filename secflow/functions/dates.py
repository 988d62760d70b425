"""Time conversions; every result is a BIGINT of UTC epoch seconds or NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date formats of the supported devices.
FAIL2BAN_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"
ANTIVIRUS_FORMAT = "dd-MMM-yyyy HH:mm:ss"
SYSLOG_FORMAT = "MMM dd yyyy HH:mm:ss z"
ISO_WITH_ZONE = r"^\d{4}-\d\d-\d\d[Tt]\d\d:\d\d(:\d\d(\.\d{1,9})?)?([Zz]|[+-]\d\d:\d\d(:\d\d)?)$"


def epoch_of_units(value: Column) -> Column:
    """Seconds from a digit string in s, ms, us or ns, told apart by its length."""
    number = F.expr("cast(null as bigint)")
    size = F.length(value)
    for digits, divisor in ((10, 1), (13, 1_000), (16, 1_000_000), (19, 1_000_000_000)):
        number = F.when(
            size == digits, F.floor(value.try_cast("bigint") / F.lit(divisor)) if divisor == 1
            else F.call_function("div", value.try_cast("bigint"), F.lit(divisor).cast("bigint")),
        ).otherwise(number)
    return number.cast("bigint")


def iso_epoch(value: Column) -> Column:
    """Epoch of an ISO-8601 text that carries an offset; anything else is NULL."""
    return F.when(value.rlike(ISO_WITH_ZONE), F.unix_seconds(F.try_to_timestamp(F.upper(value))))


def format_epoch(value: Column, pattern: str) -> Column:
    return F.unix_seconds(F.try_to_timestamp(value, F.lit(pattern)))


def syslog_epoch(
    month: Column, day: Column, year: Column, time: Column, zone: Column, received: Column
) -> Column:
    """Assemble a device date part by part, taking absent parts from the receive time.

    Only three-letter zone names are trusted; a text that does not form a date falls back
    to the receive time as a whole.
    """
    at = F.timestamp_seconds(received)
    parts = F.concat_ws(
        " ",
        F.coalesce(month, F.date_format(at, "MMM")),
        F.coalesce(F.right(F.concat(F.lit("0"), day), F.lit(2)), F.dayofmonth(at).cast("string")),
        F.coalesce(year, F.year(at).cast("string")),
        F.coalesce(
            F.left(time, F.lit(8)),
            F.concat_ws(":", F.hour(at).cast("string"), F.minute(at).cast("string"),
                        F.second(at).cast("string")),
        ),
        F.coalesce(F.when(F.length(zone) == 3, zone), F.lit("Z")),
    )
    return F.coalesce(format_epoch(parts, SYSLOG_FORMAT), received)


def second_of_day(epoch: Column) -> Column:
    return F.pmod(epoch, F.lit(86400)).cast("int")


def epoch_date(epoch: Column) -> Column:
    return F.to_date(F.timestamp_seconds(epoch))
