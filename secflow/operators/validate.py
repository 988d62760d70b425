"""Validation: a ruleset is a list of (message, predicate) plus conditional groups of them.

Fixed values: the message texts, spelling included, and the lists of ids are output values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.dates import ANTIVIRUS_FORMAT, FAIL2BAN_FORMAT, format_epoch
from secflow.functions.net import is_hostname, is_ip
from secflow.functions.text import once
from secflow.operators.parsers import ASA_IDS, IOS_PATTERN_OF


@dataclass
class Checks:
    """Checks that always apply, and groups that apply where their condition holds."""

    general: list[tuple[str, Column]]
    groups: list[tuple[Column, list[tuple[str, Column]]]] = field(default_factory=list)


def failed_messages(checks: Checks) -> Column:
    """Messages of every failed check, conditional groups first."""

    def failure(text: str, ok: Column, applies: Column | None = None) -> Column:
        bad = ~F.coalesce(ok, F.lit(False))
        return F.when(bad if applies is None else F.coalesce(applies, F.lit(False)) & bad, text)

    found = [failure(t, ok, cond) for cond, group in checks.groups for t, ok in group]
    found += [failure(t, ok) for t, ok in checks.general]
    return F.array_compact(F.array(*found))


def get(key: str, fields: str = "fields") -> Column:
    return F.expr(f"try_element_at({fields}, '{key}')")


def required(key: str) -> tuple[str, Column]:
    return f"Field {key} is required", F.expr(f"try_element_at(fields, '{key}') is not null")


def valid_ips(*keys: str) -> list[tuple[str, Column]]:
    """One check per key; a key with several values is never one address."""
    wrong = F.map_keys(
        F.map_filter(F.col("fields"), lambda k, v: k.isin(list(keys)) & ~is_ip(v))
    )
    repeated = F.coalesce(F.map_keys("multi"), F.array().cast("array<string>"))
    bad = F.concat(wrong, repeated)
    return [(f"Field {key} should be a valid ip address", ~F.array_contains(bad, key))
            for key in keys]


def valid_port(key: str) -> tuple[str, Column]:
    """Digits only; a key with several values is never one port."""
    return f"Field {key} should be a valid port", F.expr(
        f"try_element_at(multi, '{key}') is null"
        f" and coalesce(try_element_at(fields, '{key}') rlike '^[0-9]*$', true)"
    )


def one_of(first: str, *others: str) -> tuple[str, Column]:
    return f"Field {first} is required", F.coalesce(*[get(k) for k in (first, *others)]).isNotNull()


def envelope_checks() -> Checks:
    """Needs ``organization_known`` and ``pipeline_known`` from the preference join."""
    return Checks([
        ("Organization is inactive or does not have configured pipelines",
         F.col("organization_known")),
        ("DevType is not configured for organization", F.col("pipeline_known")),
        ("collectorHostIP is correct IP address", is_ip(F.col("collector_ip"))),
        ("eventHostIP is correct IP address", is_ip(F.col("event_ip"))),
        ("collectorHostname is correct hostname", is_hostname(F.col("collector_host"))),
        ("eventHostname is correct if existst",
         F.col("event_hostname").isNull() | is_hostname(F.col("event_hostname"))),
    ])


# Firewall event ids that carry a whole login record.
FIREWALL_SYSTEM_IDS = ["0100032001", "0100032002", "0100032003", "0100032053", "0100032054"]
FIREWALL_IP_FIELDS = ["srcip", "remip", "ip", "dstip", "locip", "tunnelip"]
EPOCH_DIGITS = r"^(\d{10}|\d{13}|\d{16}|\d{19})$"


def firewall_checks() -> Checks:
    kind, sub = get("type"), get("subtype")
    source = one_of("srcip", "remip", "ip")
    wrong = F.map_filter(
        F.col("fields"), lambda k, v: k.isin(FIREWALL_IP_FIELDS) & ~is_ip(v)
    )
    return Checks(
        general=[
            ("All fields containing IP address should match correct pattern", F.size(wrong) == 0),
            required("eventtime"),
            ("Type of eventtime field is Long", get("eventtime").rlike(EPOCH_DIGITS)),
            required("logid"), required("type"), required("subtype"),
        ],
        groups=[
            ((kind == "traffic") & sub.isin("forward", "local"), [
                *[required(k) for k in ("service", "rcvdbyte", "sentbyte", "rcvdpkt", "sentpkt")],
                source,
                *[required(k) for k in ("srcport", "srccountry", "dstip", "dstport", "dstcountry")],
            ]),
            ((kind == "event") & (sub == "user"), [source, required("user")]),
            ((kind == "event") & (sub == "system") & get("logid").isin(FIREWALL_SYSTEM_IDS), [
                source, one_of("dstip", "locip", "tunnelip"),
                *[required(k) for k in ("user", "action", "status", "reason")],
            ]),
            ((kind == "event") & (sub == "vpn"), [required("remip"), required("user")]),
        ],
    )


# Windows event ids with a mapping.
WINDOWS_IDS = [
    "4624", "4625", "4663", "4719", "4720", "4722", "4723", "4724", "4725", "4726", "4728", "4729",
    "4732", "4733", "4738", "4746", "4747", "4751", "4752", "4756", "4757", "4761", "4762", "4764",
    "4765", "4766", "4768", "4769", "4771", "4776", "4785", "4786", "4787", "4788", "4794", "4801",
    "5140", "5145",
]


def windows_checks() -> Checks:
    machine = (get("LogonType").try_cast("int") == 3) & F.endswith(
        get("TargetUserName"), F.lit("$")
    )
    return Checks(
        general=[
            required("EventID"),
            ("Field EventID should be one of the mapped ids", get("EventID").isin(WINDOWS_IDS)),
            ("Windows local machine authentications should be filtered out",
             ~F.coalesce(machine, F.lit(False))),
            *valid_ips("SourceAddress", "IpAddress", "ClientAddress"),
        ],
        groups=[(get("AccessMask").isNotNull(), [
            ("Field AccessMask fits 0x00 hex number format if present",
             get("AccessMask").rlike("^0[xX][0-9a-fA-F]+$")),
        ])],
    )


# Audit record types that can be mapped.
AUDIT_SINGLE = [
    "ADD_GROUP", "ADD_USER", "DEL_GROUP", "DEL_USER", "EXECVE", "AVC", "SERVICE_START",
    "SERVICE_STOP", "USER_AUTH", "USER_CHAUTHTOK", "USER_CMD", "USER_END", "USER_LOGIN",
]
AUDIT_MULTI = ["CWD", "PATH", "SYSCALL"]


def audit_checks() -> Checks:
    types = F.array_sort(F.array_distinct(F.transform(get("type", "multi"), lambda t: F.upper(t))))
    supported = F.coalesce(F.upper(get("type")).isin(AUDIT_SINGLE), F.lit(False)) | F.coalesce(
        types == F.array(*map(F.lit, AUDIT_MULTI)), F.lit(False))
    return Checks([
        ("message type is supported by Mapper", supported),
        *valid_ips("addr", "saddr", "daddr", "laddr"),
        *[valid_port(k) for k in ("rport", "sport", "src", "dest", "dport", "lport")],
    ])


def asa_checks() -> Checks:
    return Checks([
        ("datapayloadMsgId should be one of the mapped ids", get("datapayloadMsgId").isin(ASA_IDS)),
    ])


def ios_checks() -> Checks:
    return Checks([
        ("event type should be one of the mapped mnemonics",
         get("eventType").isin(list(IOS_PATTERN_OF))),
        ("importance is available", get("importance").isNotNull()),
    ])


# Event types of the JSON antivirus.
ANTIVIRUS_TYPES = [
    "audit_event", "filteredwebsites_event", "firewallaggregated_event", "threat_event",
]


def antivirus_checks() -> Checks:
    return Checks([
        ("Event type should be one of the mapped types",
         F.lower(get("event_type")).isin(ANTIVIRUS_TYPES)),
        ("Field occured should have correct format",
         format_epoch(get("occured"), ANTIVIRUS_FORMAT).isNotNull()),
        *valid_ips("target_address", "ipv4", "ipv6"),
    ])


def fail2ban_checks() -> Checks:
    return Checks([
        ("Field originTime should have correct format",
         format_epoch(get("originTime"), FAIL2BAN_FORMAT).isNotNull()),
        ("Field aux2 should have value", get("aux2").isNotNull()),
        ("Field importance should have value", get("importance").isNotNull()),
        *valid_ips("sourceIp"),
    ])


# Fields every connector antivirus record must have.
CONNECTOR_FIELDS = [
    "DetectionTime", "EventTime", "ID", "EventType", "SensorName", "ModuleName", "Severity",
    "Organization", "TypeActivity", "Block", "Deleted",
]


def connector_checks() -> Checks:
    return Checks([*[required(k) for k in CONNECTOR_FIELDS], *valid_ips("SourceIP", "IP")])


VALIDATORS: dict[tuple[str, int], Callable[[], Checks]] = {
    ("fortigate", 1): firewall_checks,
    ("kaspersky", 1): connector_checks,
    ("symantec", 1): connector_checks,
    ("windows_security", 2): windows_checks,
    ("asa00401", 1): asa_checks,
    ("ios/isr00401", 1): ios_checks,
    ("esetnode02701", 1): antivirus_checks,
    ("reassembledAuditD01", 1): audit_checks,
    ("fail2ban02901", 1): fail2ban_checks,
}


def validate_envelope(df: DataFrame) -> DataFrame:
    """Add ``envelope_reasons``; a row whose envelope was not readable has none."""
    reasons = F.when(F.col("envelope_error").isNull(), failed_messages(envelope_checks()))
    return once(df, envelope_reasons=reasons)


def validate(df: DataFrame, validators: Iterable[tuple[str, int]] | None = None) -> DataFrame:
    """Add ``reasons`` (all failed messages) by the row's (validator_name, validator_version)."""
    chosen = list(validators) if validators is not None else list(VALIDATORS)
    reasons = F.when(F.lit(False), F.array().cast("array<string>"))
    for name, version in chosen:
        here = (F.col("validator_name") == name) & (F.col("validator_version") == version)
        reasons = reasons.when(here & F.col("fields").isNotNull(),
                               failed_messages(VALIDATORS[(name, version)]()))
    return once(df, reasons=reasons)


def joined(reasons: Column) -> Column:
    """Messages as text, one per line, each line ended."""
    return F.when(F.size(reasons) > 0, F.concat(F.array_join(reasons, "\n"), F.lit("\n")))
