"""Envelopes written by log collectors: JSON text to typed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.dates import iso_epoch
from secflow.functions.text import once
from secflow.schema import HOP_DDL

ENVELOPE = (
    "raw VARIANT, EventReceivedTime STRING, Organization STRING, DevType STRING, Severity STRING, "
    "SeverityValue INT, MessageSourceAddress STRING, eventHostname STRING, chain STRING"
)
REASSEMBLY_ENVELOPE = (
    "raw VARIANT, Message VARIANT, EventReceivedTime STRING, chain STRING, "
    "MessageSourceAddress STRING, EventTime STRING, Hostname STRING, SourceName STRING, "
    "DevCat STRING, DevSubCat STRING, DevType STRING, Organization STRING, OrgID INT"
)


def hops(chain: Column) -> Column:
    """Map of hop name to hop; a scalar ``number`` beside the hops is ignored."""
    texts = F.map_filter(F.from_json(chain, "MAP<STRING,STRING>"), lambda k, _: k != "number")
    return F.transform_values(texts, lambda _, v: F.from_json(v, HOP_DDL))


def _payload(value: Column, field: str) -> tuple[Column, Callable[[Column], Column]]:
    """Kind of a payload that may be a JSON string or a JSON object, and its text given the kind.

    Object text comes from the original document, so that its key order survives.
    """
    variant = F.col(f"_env.{field}")
    kind = F.when(
        F.try_variant_get(variant, "$", "map<string,variant>").isNotNull(), "object"
    ).when(F.startswith(F.to_json(variant), F.lit('"')), "string").when(
        variant.isNotNull() & ~F.is_variant_null(variant), "other"
    )

    def text(known: Column) -> Column:
        return F.when(known == "object", F.get_json_object(value, f"$.{field}")).when(
            known == "string", F.try_variant_get(variant, "$", "string")
        )

    return kind, text


def _first_error(checks: list[tuple[str, Column]]) -> Column:
    """Text of the first check that fails, NULL when all hold."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for text, ok in checks])


def parse_envelope(df: DataFrame, col: str = "value", kind: str = "full") -> DataFrame:
    """Parse collector envelopes; bad rows stay, with the reason in ``envelope_error``."""
    if kind == "reassembly":
        return _parse_reassembly(df, col)
    value = F.col(col)
    df = once(df, _env=F.from_json(value, ENVELOPE))
    raw_kind, raw = _payload(value, "raw")
    first_hop = F.get(
        F.filter(F.map_values(hops(F.col("_env.chain"))), lambda h: h["number"] == 1), F.lit(0)
    )
    df = once(df, raw_kind=raw_kind, _first_hop=first_hop)
    df = df.withColumns({
        "raw": raw(F.col("raw_kind")),
        "received": iso_epoch(F.col("_env.EventReceivedTime")),
        "organization": F.col("_env.Organization"),
        "dev_type": F.col("_env.DevType"),
        "severity": F.col("_env.Severity"),
        "severity_id": F.col("_env.SeverityValue"),
        "event_hostname": F.col("_env.eventHostname"),
        "event_ip": F.col("_env.MessageSourceAddress"),
        "chain": F.col("_env.chain"),
        "collector_host": F.col("_first_hop.fqdn"),
        "collector_ip": F.col("_first_hop.ip"),
        "input_id": F.col("_first_hop.modname"),
    })
    checks = [
        ("not a JSON object", F.coalesce(*[
            F.col(c) for c in ("organization", "dev_type", "chain", "severity", "event_ip")
        ], F.col("raw_kind")).isNotNull()),
        ("raw is neither text nor object", F.col("raw_kind").isin("string", "object")),
        ("EventReceivedTime is not an ISO-8601 time with offset", F.col("received").isNotNull()),
        ("Organization is missing", F.col("organization").isNotNull()),
        ("DevType is missing", F.col("dev_type").isNotNull()),
        ("chain has no hop with number 1", F.col("_first_hop").isNotNull()),
        ("first hop lacks fqdn, ip or modname",
         F.col("collector_host").isNotNull() & F.col("collector_ip").isNotNull()
         & F.col("input_id").isNotNull()),
        ("SeverityValue is missing", F.col("severity_id").isNotNull()),
        ("Severity is missing", F.col("severity").isNotNull()),
        ("MessageSourceAddress is missing", F.col("event_ip").isNotNull()),
    ]
    return df.withColumn("envelope_error", _first_error(checks)).drop("_env", "_first_hop")


def _parse_reassembly(df: DataFrame, col: str) -> DataFrame:
    value = F.col(col)
    df = once(df, _env=F.from_json(value, REASSEMBLY_ENVELOPE))
    raw_kind, raw = _payload(value, "raw")
    message_kind, message = _payload(value, "Message")
    # Message stands in only where raw is absent altogether.
    df = once(df, _raw_kind=raw_kind)
    df = once(df, raw_kind=F.coalesce(F.col("_raw_kind"), message_kind))
    kind = F.col("raw_kind")
    df = once(df, raw=F.when(F.col("_raw_kind").isNotNull(), raw(kind)).otherwise(message(kind)))
    names = ["EventReceivedTime", "chain", "MessageSourceAddress", "EventTime", "Hostname",
             "SourceName", "DevCat", "DevSubCat", "DevType", "Organization", "OrgID"]
    df = df.withColumns({n: F.col(f"_env.{n}") for n in names})
    checks = [
        ("not a JSON object", F.coalesce(
            *[F.col(n).cast("string") for n in names], F.col("raw_kind")).isNotNull()),
        *[(f"{n} is missing", F.col(n).isNotNull()) for n in names if n != "chain"],
        ("raw is neither text nor object", F.col("raw_kind").isin("string", "object")),
    ]
    return df.withColumn("envelope_error", _first_error(checks)).drop("_env", "_raw_kind")


def parse_route_key(df: DataFrame, col: str = "value") -> DataFrame:
    """Device type and organization only; ``malformed`` marks rows without both."""
    env = F.from_json(F.col(col), "DevType STRING, Organization STRING")
    return (
        once(df, _env=env)
        .withColumn("dev_type", F.col("_env.DevType"))
        .withColumn("organization", F.col("_env.Organization"))
        .withColumn("malformed", F.col("dev_type").isNull() | F.col("organization").isNull())
        .drop("_env")
    )


def raw_text(kind: Column, raw: Column) -> Column:
    """Original log text: a text payload itself, else the object's SourceStr, else the object."""
    source = F.get_json_object(raw, "$.SourceStr")
    return F.when(kind == "string", raw).otherwise(F.coalesce(source, raw))


def preparsed_text(kind: Column, raw: Column) -> Column:
    """An object payload without its SourceStr; NULL when there was none to remove."""
    fields = F.from_json(raw, "MAP<STRING,VARIANT>")
    rest = F.to_json(F.map_filter(fields, lambda k, _: k != "SourceStr"))
    return F.when(
        (kind == "object") & F.get_json_object(raw, "$.SourceStr").isNotNull(), rest
    )
