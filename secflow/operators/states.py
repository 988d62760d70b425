"""From parsed and validated rows to the final states: normalized, raw, chain, invalid, error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.ids import message_ids
from secflow.functions.text import UNKNOWN, split_host
from secflow.operators.envelope import preparsed_text, raw_text
from secflow.operators.validate import joined
from secflow.schema import CHAIN_EVENT, ERROR_EVENT, INVALID_EVENT, RAW_EVENT, build

STATES = ["normalized", "raw", "chain", "invalid", "error"]


def with_ids(df: DataFrame, algo: str = "ripemd160", value: str = "value") -> DataFrame:
    """Add ``raw_message``, ``source_host``, ``raw_id`` and ``norm_id``.

    An envelope that could not be read is its own raw message and has no source host.
    """
    readable = F.col("envelope_error").isNull()
    df = df.withColumn(
        "raw_message",
        F.when(readable, raw_text(F.col("raw_kind"), F.col("raw"))).otherwise(F.col(value)),
    ).withColumn(
        "source_host",
        F.when(readable, F.coalesce("event_hostname", "event_ip")).otherwise(F.lit(UNKNOWN)),
    )
    ids = message_ids(F.col("organization"), F.col("source_host"), F.col("raw_message"), algo)
    df = df.withColumn("_ids", ids)
    return df.withColumns({"raw_id": F.col("_ids.raw_id"), "norm_id": F.col("_ids.norm_id")}).drop("_ids")


def with_outcome(df: DataFrame) -> DataFrame:
    """Add ``error`` and ``outcome`` ∈ {valid, invalid, error}.

    Whatever would have stopped a job (incomplete pipeline, no vendor) is an error row instead.
    """
    bad_envelope = F.size(F.col("envelope_reasons")) > 0
    configured = F.col("pipeline_known") & ~F.coalesce(bad_envelope, F.lit(False))
    incomplete = F.col("parser_name").isNull() | F.col("validator_name").isNull() | F.col(
        "mapper_name").isNull()
    error = F.coalesce(
        F.col("envelope_error"),
        F.when(configured & incomplete, "pipeline is not fully configured"),
        F.when(configured, F.col("parse_error")),
        F.when(configured & F.col("vendor").isNull(), "device type has no vendor"),
        F.when(configured & F.col("reasons").isNull(), "validator is not known"),
    )
    failed = F.coalesce(bad_envelope, F.lit(False)) | F.coalesce(
        F.size(F.col("reasons")) > 0, F.lit(False))
    return df.withColumn("error", error).withColumn(
        "outcome",
        F.when(F.col("error").isNotNull(), "error").when(failed, "invalid").otherwise("valid"),
    )


def _collector(readable: Column | None = None) -> dict[str, Column]:
    leaves = {
        "collector.location.hostname": F.col("collector_host"),
        "collector.location.host": F.col("collector_ip"),
        "collector.location.ip": F.col("collector_ip"),
        "collector.organization": F.col("organization"),
        "collector.inputId": F.col("input_id"),
    }
    if readable is None:
        return leaves
    known = {name: F.when(readable, column) for name, column in leaves.items()}
    for name in ("collector.location.host", "collector.organization", "collector.inputId"):
        known[name] = F.coalesce(known[name], F.lit(UNKNOWN))
    return known


def raw_event(norm_id: Column) -> Column:
    fqdn, hostname = split_host(None, F.col("event_hostname"))
    return build(RAW_EVENT, {
        "id": F.col("raw_id"),
        "raw": F.col("raw_message"),
        "preparsedMessage": preparsed_text(F.col("raw_kind"), F.col("raw")),
        **_collector(),
        "eventTime": F.col("received"),
        "devType": F.col("dev_type"),
        "eventSource.ip": F.col("event_ip"),
        "eventSource.fqdn": fqdn,
        "eventSource.hostname": hostname,
        "eventSource.host": F.col("event_ip"),
        "severityId": F.col("severity_id"),
        "severity": F.col("severity"),
        "normalizedId": norm_id,
    })


def chain_event(norm_id: Column) -> Column:
    fqdn, hostname = split_host(None, F.col("collector_host"))
    return build(CHAIN_EVENT, {
        "rawId": F.col("raw_id"),
        "normalizedId": norm_id,
        "chain": F.col("chain"),
        **_collector(),
        "collector.location.fqdn": fqdn,
        "collector.location.hostname": hostname,
        "eventTime": F.col("received"),
    })


def invalid_event() -> Column:
    reasons = F.when(F.size("envelope_reasons") > 0, F.col("envelope_reasons")).otherwise(
        F.col("reasons"))
    return build(INVALID_EVENT, {
        "rawId": F.col("raw_id"), "reason": joined(reasons), **_collector(),
    })


def error_event() -> Column:
    return build(ERROR_EVENT, {
        "id": F.col("raw_id"),
        "raw": F.col("raw_message"),
        "stacktrace": F.col("error"),
        **_collector(F.col("envelope_error").isNull()),
    })


def states_of(outcome: Column) -> Column:
    """Valid rows become event, raw and chain; invalid ones reason, raw and chain; errors one row."""
    return F.when(
        outcome == "valid", F.array(F.lit("normalized"), F.lit("raw"), F.lit("chain"))
    ).when(
        outcome == "invalid", F.array(F.lit("invalid"), F.lit("raw"), F.lit("chain"))
    ).otherwise(F.array(F.lit("error")))


def split_states(df: DataFrame) -> DataFrame:
    """One output row per final state, with exactly one of the five payload structs set."""
    state = F.col("state")
    norm_id = F.when(F.col("outcome") == "valid", F.col("norm_id"))
    rows = df.withColumn("state", F.explode(states_of(F.col("outcome"))))
    readable = F.col("envelope_error").isNull()

    def known(name: str) -> Column:
        return F.when(readable, F.col(name)).otherwise(F.lit(UNKNOWN))

    return rows.select(
        "state",
        known("organization").alias("organization"),
        known("dev_type").alias("dev_type"),
        known("collector_ip").alias("collector_host"),
        "source_host",
        F.when(state.isin("normalized", "raw", "chain"), F.col("received")).alias("event_time"),
        F.when(state == "normalized", F.col("event")).alias("normalized"),
        F.when(state == "raw", raw_event(norm_id)).alias("raw"),
        F.when(state == "chain", chain_event(norm_id)).alias("chain"),
        F.when(state == "invalid", invalid_event()).alias("invalid"),
        F.when(state == "error", error_event()).alias("error"),
    )


def encoded(df: DataFrame) -> DataFrame:
    """Add ``value``: the row's payload as JSON text, the form in which it leaves the job."""
    return df.withColumn("value", F.coalesce(*[F.to_json(F.col(s)) for s in STATES]))


def shift_time(df: DataFrame, mode: str = "as-is", seconds: int = 0,
               event: str = "normalized") -> DataFrame:
    """Move ``data.time`` of canonical events: leave it, set it to now, or add seconds."""
    if mode == "as-is":
        return df
    if mode == "now":
        time = F.unix_seconds(F.current_timestamp())
    elif mode == "shift":
        time = F.col(f"{event}.data.time") + F.lit(seconds).cast("bigint")
    else:
        raise ValueError(f"unknown time shift {mode!r}")
    moved = F.col(event).withField("data.time", time)
    return df.withColumn(event, F.when(F.col(event).isNotNull(), moved))
