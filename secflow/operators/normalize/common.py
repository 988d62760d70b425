"""Column builders shared by the format mappers.

A mapper is a function without arguments that returns {dotted leaf name: Column}; it reads the
``fields`` and ``multi`` maps and the envelope columns of the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from secflow.functions.text import UNKNOWN, split_host

Leaves = dict[str, Column]


def text(*keys: str) -> Column:
    """First of the named fields that has a value."""
    return _first(keys, "{}")


def integer(*keys: str) -> Column:
    return _first(keys, "try_cast({} as int)")


def long(*keys: str) -> Column:
    return _first(keys, "try_cast({} as bigint)")


def field(key: str) -> str:
    """SQL text that reads a field."""
    return f"try_element_at(fields, '{key}')"


def _first(keys: Sequence[str], form: str) -> Column:
    values = [form.format(field(key)) for key in keys]
    return F.expr(f"coalesce({', '.join(values)})" if len(values) > 1 else values[0])


def one_of(on: str, values: Sequence[str]) -> Column:
    """``on`` (SQL text) is one of the values; one expression instead of a literal per value."""
    listed = ", ".join(f"'{v}'" for v in values)
    return F.expr(f"{on} in ({listed})")


def switch(on: str, cases: Sequence[tuple[Sequence[str], Column | str]],
           otherwise: Column | str | None = None) -> Column:
    """``CASE`` over SQL text ``on`` with several keys per branch; plain strings are literals."""
    result = None
    for keys, value in cases:
        here = one_of(on, keys)
        result = F.when(here, value) if result is None else result.when(here, value)
    return result if otherwise is None else result.otherwise(otherwise)


def under(prefix: str, leaves: Leaves) -> Leaves:
    return {f"{prefix}.{name}": column for name, column in leaves.items()}


def aux(**values: Column) -> Leaves:
    return {f"data.aux{name[1:]}": column for name, column in values.items()}


def base(version: int, source_category: str, subsys: Column | None = None,
         source_name: Column | None = None) -> Leaves:
    """Identity, event source, collector and receive time: the same for every format."""
    fqdn, hostname = split_host(None, F.col("event_hostname") if source_name is None else source_name)
    leaves = {
        "id": F.col("norm_id"),
        "eventTime": F.col("received"),
        "category": F.lit("normalized"),
        "normalizerVersion": F.lit(version),
        "eventSource.location.fqdn": fqdn,
        "eventSource.location.hostname": hostname,
        "eventSource.location.ip": F.col("event_ip"),
        "eventSource.location.host": F.col("event_ip"),
        "eventSource.category": F.lit(source_category),
        "eventSource.id": F.col("input_id"),
        "eventSource.title": F.col("product"),
        "eventSource.vendor": F.col("vendor"),
        "collector.location.hostname": F.col("collector_host"),
        "collector.location.host": F.col("collector_ip"),
        "collector.location.ip": F.col("collector_ip"),
        "collector.organization": F.col("organization"),
        "collector.inputId": F.col("input_id"),
        "data.rawIds": F.array(F.col("raw_id")),
        "data.time": F.col("received"),
    }
    if subsys is not None:
        leaves["eventSource.subsys"] = subsys
    return leaves


def or_unknown(value: Column) -> Column:
    return F.coalesce(value, F.lit(UNKNOWN))
