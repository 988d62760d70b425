"""Multi-line audit records put together in event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.functions.grok import grok_values
from secflow.functions.ids import content_id
from secflow.functions.text import once
from secflow.operators.envelope import parse_envelope

# Device type and severity of a reassembled record.
DEV_TYPE, SEVERITY, SEVERITY_VALUE = "reassembledAuditD01", "unknown", 0

FIRST = ["EventReceivedTime", "chain", "EventTime", "Hostname", "SourceName", "DevCat", "DevSubCat",
         "Organization"]


def audit_key(df: DataFrame) -> DataFrame:
    """Add ``audit_time`` (timestamp) and ``audit_id`` from the audit header; NULL without one."""
    header, _ = grok_values(F.col("raw"), "%{REASSEMBLY_HEADER}")
    df = once(df, _header=header)
    values = F.col("_header")
    seconds = F.get(values, F.lit(0)).try_cast("decimal(20,6)")
    return df.withColumns({
        "audit_time": F.timestamp_seconds(F.floor(seconds).cast("bigint")),
        "audit_id": F.get(values, F.lit(1)),
    }).drop("_header")


def dead_letters(values: DataFrame, algo: str = "ripemd160") -> DataFrame:
    """Messages that are no envelopes, in the shape of error events: content id, text and reason."""
    parsed = parse_envelope(values, kind="reassembly")
    raw = F.col("value")
    return parsed.where(F.col("envelope_error").isNotNull()).select(
        content_id(raw, algo=algo).alias("id"), raw.alias("raw"), F.col("envelope_error").alias("stacktrace")
    )


def reassemble(
    values: DataFrame, window: str = "30 seconds", watermark: str = "1 minute"
) -> DataFrame:
    """Join the lines of one audit record; the same call serves batch and streaming.

    Lines are grouped by window, organization, sender and audit id.  The distinct raw lines are
    joined in text order, and all other fields come from the least line by (receive time, text),
    so the result does not depend on arrival order.
    """
    parsed = audit_key(parse_envelope(values, kind="reassembly"))
    usable = parsed.where(
        F.col("envelope_error").isNull() & F.col("audit_time").isNotNull()
        & F.col("audit_id").isNotNull()
    )
    first = F.min_by(
        F.struct(*FIRST), F.struct("EventReceivedTime", "raw", *[c for c in FIRST[1:]])
    )
    grouped = (
        usable.withWatermark("audit_time", watermark)
        .groupBy(F.window("audit_time", window), "OrgID", "MessageSourceAddress", "audit_id")
        .agg(first.alias("f"), F.collect_set("raw").alias("lines"))
    )
    return grouped.select(
        F.unix_seconds("window.start").alias("window_start"), "OrgID", "MessageSourceAddress",
        "audit_id", *[F.col(f"f.{c}").alias(c) for c in FIRST],
        F.lit(DEV_TYPE).alias("DevType"), F.lit(SEVERITY_VALUE).alias("SeverityValue"),
        F.lit(SEVERITY).alias("Severity"), F.array_join(F.array_sort("lines"), "\n").alias("raw"),
    )


ENVELOPE_FIELDS = ["EventReceivedTime", "MessageSourceAddress", "EventTime", "Hostname", "SourceName",
                   "DevCat", "DevSubCat", "DevType", "Organization", "OrgID", "SeverityValue",
                   "Severity", "raw"]


def merge_chain(df: DataFrame) -> DataFrame:
    """The record as JSON ``value`` with its chain as an object again, not as text."""
    chain = F.coalesce(F.try_parse_json("chain"), F.parse_json(F.lit("null"))).alias("chain")
    return df.select(F.to_json(F.struct(*ENVELOPE_FIELDS, chain)).alias("value"))
