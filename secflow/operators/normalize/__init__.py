"""Mapping of parsed records to the canonical event, one mapper per format."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.operators.normalize.antivirus import connector_a, connector_b, json_antivirus
from secflow.operators.normalize.audit import audit
from secflow.operators.normalize.common import Leaves
from secflow.operators.normalize.network import asa, fail2ban, firewall, ios
from secflow.operators.normalize.windows import windows
from secflow.schema import EVENT, build

MAPPERS: dict[tuple[str, int], Callable[[], Leaves]] = {
    ("fortigate", 1): firewall,
    ("kaspersky", 2): connector_a,
    ("symantec", 1): connector_b,
    ("windows_security", 2): windows,
    ("asa00401", 1): asa,
    ("ios/isr00401", 1): ios,
    ("esetnode02701", 1): json_antivirus,
    ("reassembledAuditD01", 1): audit,
    ("fail2ban02901", 1): fail2ban,
}


def mappers_with(syscall_actions: dict[str, str] | None = None,
                 syscall_objects: dict[str, str] | None = None):
    """The registry with the system-call tables of the audit mapper filled in."""
    filled = partial(audit, syscall_actions, syscall_objects)
    return {**MAPPERS, ("reassembledAuditD01", 1): filled}


def normalize(
    df: DataFrame,
    formats: Iterable[tuple[str, int]] | None = None,
    mappers: dict[tuple[str, int], Callable[[], Leaves]] | None = None,
) -> DataFrame:
    """Add ``event`` (canonical struct) by the row's (mapper_name, mapper_version).

    Rows with an unknown mapper get NULL.  All formats are mapped in one pass over the input;
    ``formats`` limits the plan to those a job receives.
    """
    registry = mappers or MAPPERS
    event = F.when(F.lit(False), F.lit(None).cast(EVENT))
    for name, version in formats if formats is not None else registry:
        here = (F.col("mapper_name") == name) & (F.col("mapper_version") == version)
        event = event.when(here, build(EVENT, registry[(name, version)]()))
    return df.withColumn("event", event)
