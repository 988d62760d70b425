"""The normalization job: collector envelopes to final states."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.operators.dims import with_preferences
from secflow.operators.envelope import parse_envelope
from secflow.operators.normalize import MAPPERS, normalize
from secflow.operators.parsers import parse_logs
from secflow.operators.states import split_states, with_ids, with_outcome
from secflow.operators.validate import validate, validate_envelope
from secflow.session import dimension_side

# Parser, validator and mapper that belong together.
PIPELINES = {
    "firewall": (("fortigate", 1), ("fortigate", 1), ("fortigate", 1)),
    "asa": (("asa00401", 1), ("asa00401", 1), ("asa00401", 1)),
    "ios": (("ios/isr00401", 1), ("ios/isr00401", 1), ("ios/isr00401", 1)),
    "audit": (("reassembledAuditD01", 1),) * 3,
    "json_antivirus": (("esetnode02701", 1),) * 3,
    "fail2ban": (("fail2ban02901", 1),) * 3,
    "windows": (("windows_security", 1), ("windows_security", 2), ("windows_security", 2)),
    "connector_a": (("unicon", 1), ("kaspersky", 1), ("kaspersky", 2)),
    "connector_b": (("unicon", 1), ("symantec", 1), ("symantec", 1)),
}


def parsed_and_validated(
    values: DataFrame, prefs: DataFrame, vendor_of: DataFrame, algo: str = "ripemd160",
    pipelines: Iterable[str] | None = None, mappers=None,
) -> DataFrame:
    """One row per envelope with ``outcome`` and, where valid, the canonical ``event``."""
    chosen = [PIPELINES[p] for p in (pipelines if pipelines is not None else PIPELINES)]
    parsers, validators, formats = (list(dict.fromkeys(part)) for part in zip(*chosen))
    df = with_preferences(parse_envelope(values), prefs)
    df = validate_envelope(df)
    # Rows that failed the envelope checks are not parsed at all.
    usable = F.coalesce(F.size("envelope_reasons") == 0, F.lit(False))
    tools = ["parser_name", "validator_name", "mapper_name"]
    df = df.withColumns({t: F.when(usable, F.col(t)) for t in tools})
    df = validate(parse_logs(df, parsers), validators)
    df = with_ids(df.join(dimension_side(vendor_of), "dev_type", "left"), algo=algo)
    df = with_outcome(df)
    df = df.withColumn("mapper_name", F.when(F.col("outcome") == "valid", F.col("mapper_name")))
    return normalize(df, formats, mappers or MAPPERS)


def normalize_job(values: DataFrame, prefs: DataFrame, vendor_of: DataFrame, **options) -> DataFrame:
    """Envelopes (column ``value``) to one row per final state."""
    return split_states(parsed_and_validated(values, prefs, vendor_of, **options))
