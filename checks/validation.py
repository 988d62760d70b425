"""Every ruleset of the validators: all rows with all reasons, most messages failing in some of them.

Field values are expressions that both engines read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.tables import E_SQL, events
from secflow.operators.parsers import ASA_IDS, IOS_PATTERN_OF
from secflow.operators.validate import (
    ANTIVIRUS_TYPES, AUDIT_SINGLE, CONNECTOR_FIELDS, FIREWALL_SYSTEM_IDS, WINDOWS_IDS, joined, validate,
)

QUERIES, SQL = {}, {}
#: Columns of the fields in SQL, apart from those of the events.
FIELD = "f_"
OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def no_ip(key: str) -> str:
    """Values of these checks are IPv4 addresses or none at all."""
    return f"NOT coalesce(regexp_matches({FIELD}{key}, '^({OCTET}\\.){{3}}{OCTET}$'), true)"


def missing(*keys: str) -> tuple[str, str]:
    return f"coalesce({', '.join(FIELD + key for key in keys)}) IS NULL", f"Field {keys[0]} is required"


def bad_ips(*keys: str, multi: str = "false") -> list[tuple[str, str]]:
    return [(f"{no_ip(key)} OR ({multi if key == 'addr' else 'false'})", f"Field {key} should be a valid ip address") for key in keys]


def under(condition: str, *checks: tuple[str, str]) -> list[tuple[str, str]]:
    return [(f"({condition}) AND ({bad})", text) for bad, text in checks]


def ruleset(name: str, validator: tuple[str, int], fields: dict[str, str], failures: list[tuple[str, str]], multi: dict[str, tuple[str, str]] = {}):
    """Register one query; ``failures`` are conditions on the fields (``:name``) with their messages, in
    the order of the reasons.

    ``multi`` names keys with several values: when they have them, and which.
    """
    failures = [(re.sub(r":(?=[A-Za-z])", FIELD, bad), text) for bad, text in failures]
    said = ", ".join(f"CASE WHEN {bad} THEN '{text}' || chr(10) END" for bad, text in failures)
    columns = ", ".join(f"{value} AS {FIELD}{key}" for key, value in fields.items())

    def run(spark, folder):
        df = events(spark, folder)
        own = F.create_map(*[x for key, value in fields.items() for x in (F.lit(key), F.expr(value).cast("string"))])
        many = F.create_map(*[x for key, (when, values) in multi.items() for x in (F.lit(key), F.expr(f"if({when}, array({values}), null)"))])
        df = df.select(
            "event_id", F.lit(validator[0]).alias("validator_name"), F.lit(validator[1]).alias("validator_version"),
            F.map_filter(own, lambda _, v: v.isNotNull()).alias("fields"),
            (F.map_filter(many, lambda _, v: v.isNotNull()) if multi else F.lit(None).cast("map<string,array<string>>")).alias("multi"))
        return validate(df, [validator]).select(
            "event_id", F.size("reasons").alias("n_reasons"), F.coalesce(joined(F.col("reasons")), F.lit("")).alias("reasons"))

    run.__name__ = name
    run.__doc__ = f"All rows and reasons of the ruleset {validator[0]}."
    QUERIES[name] = run
    counted = " + ".join(f"CASE WHEN {bad} THEN 1 ELSE 0 END" for bad, _ in failures)
    SQL[name] = f"WITH {E_SQL}, f AS (SELECT event_id, k, event_type, {columns} FROM e) SELECT event_id, CAST({counted} AS INTEGER) AS n_reasons, concat({said}) AS reasons FROM f"


def absent(value: str, when: str) -> str:
    return f"CASE WHEN {when} THEN NULL ELSE {value} END"


# Firewall -------------------------------------------------------------------------------------

SOURCE = missing("srcip", "remip", "ip")
FIREWALL_IPS = ["srcip", "remip", "ip", "dstip", "locip", "tunnelip"]
ruleset(
    "validate_firewall_rules", ("fortigate", 1),
    {
        "type": absent("CASE event_type WHEN 'click' THEN 'traffic' ELSE 'event' END", "event_id % 17 = 0"),
        "subtype": absent(
            "CASE event_type WHEN 'click' THEN 'forward' WHEN 'view' THEN 'user' WHEN 'purchase' THEN 'vpn' ELSE 'system' END", "event_id % 19 = 0"),
        "logid": absent(f"CASE WHEN event_type = 'error' THEN '{FIREWALL_SYSTEM_IDS[0]}' ELSE '7' END", "event_id % 11 = 0"),
        "eventtime": absent("CASE WHEN k % 5 = 0 THEN '12ab' ELSE '1705300000' END", "k % 13 = 0"),
        "srcip": absent("CASE WHEN k % 8 = 0 THEN '10.0.0' ELSE '10.0.0.7' END", "k % 3 = 0"),
        "remip": absent("'10.0.0.1'", "k % 4 > 0"), "ip": absent("'10.0.0.2'", "k % 7 > 0"),
        "dstip": absent("CASE WHEN k % 6 = 0 THEN '300.1.1.1' ELSE '8.8.8.8' END", "k % 6 = 1"),
        "locip": absent("'10.9.9.9'", "event_id % 2 = 0"), "tunnelip": absent("'10.9.9.8'", "event_id % 3 > 0"),
        "service": absent("'DNS'", "event_id % 5 = 0"), "rcvdbyte": absent("'1'", "event_id % 6 = 0"),
        "sentbyte": absent("'2'", "event_id % 7 = 0"), "rcvdpkt": absent("'3'", "event_id % 8 = 0"),
        "sentpkt": absent("'4'", "event_id % 9 = 0"), "srcport": absent("'5'", "event_id % 10 = 0"),
        "srccountry": absent("'A'", "event_id % 12 = 0"), "dstport": absent("'6'", "event_id % 13 = 0"),
        "dstcountry": absent("'B'", "event_id % 14 = 0"), "user": absent("'u'", "k % 9 = 0"),
        "action": absent("'a'", "k % 10 = 0"), "status": absent("'s'", "k % 11 = 0"), "reason": absent("'r'", "k % 12 = 0"),
    },
    [
        *under(":type = 'traffic' AND :subtype IN ('forward', 'local')",
               *[missing(x) for x in ("service", "rcvdbyte", "sentbyte", "rcvdpkt", "sentpkt")], SOURCE,
               *[missing(x) for x in ("srcport", "srccountry", "dstip", "dstport", "dstcountry")]),
        *under(":type = 'event' AND :subtype = 'user'", SOURCE, missing("user")),
        *under(f":type = 'event' AND :subtype = 'system' AND :logid IN ({listed(FIREWALL_SYSTEM_IDS)})", SOURCE, missing("dstip", "locip", "tunnelip"),
               *[missing(x) for x in ("user", "action", "status", "reason")]),
        *under(":type = 'event' AND :subtype = 'vpn'", missing("remip"), missing("user")),
        (" OR ".join(no_ip(x) for x in FIREWALL_IPS), "All fields containing IP address should match correct pattern"),
        missing("eventtime"), ("NOT coalesce(regexp_matches(:eventtime, '^([0-9]{10}|[0-9]{13}|[0-9]{16}|[0-9]{19})$'), false)", "Type of eventtime field is Long"),
        missing("logid"), missing("type"), missing("subtype"),
    ],
)

# Windows --------------------------------------------------------------------------------------

ruleset(
    "validate_windows_rules", ("windows_security", 2),
    {
        "EventID": absent("CASE WHEN k % 5 = 0 THEN '9999' WHEN k % 5 = 1 THEN '5145' ELSE '4624' END", "k % 11 = 0"),
        "LogonType": absent("CASE WHEN k % 4 = 0 THEN 'x' WHEN k % 4 = 1 THEN '3' ELSE '2' END", "event_id % 7 = 0"),
        "TargetUserName": "CASE WHEN event_type = 'click' THEN 'pc$' ELSE 'u' END",
        "SourceAddress": absent("CASE WHEN k % 3 = 0 THEN 'here' ELSE '10.1.1.1' END", "event_id % 5 = 0"),
        "IpAddress": absent("CASE WHEN event_id % 3 = 0 THEN '1.2.3' ELSE '10.1.1.2' END", "k % 2 = 0"),
        "ClientAddress": absent("CASE WHEN event_id % 4 = 0 THEN '1.2.3.256' ELSE '10.1.1.3' END", "k % 3 = 1"),
        "AccessMask": absent("CASE WHEN k % 6 = 0 THEN '77' WHEN k % 6 = 1 THEN '0XfF' WHEN k % 6 = 2 THEN '0x' ELSE '0x1F0' END", "k % 7 > 3"),
    },
    [
        *under(":AccessMask IS NOT NULL", ("NOT regexp_matches(:AccessMask, '^0[xX][0-9a-fA-F]+$')", "Field AccessMask fits 0x00 hex number format if present")),
        missing("EventID"), (f":EventID IS NULL OR :EventID NOT IN ({listed(WINDOWS_IDS)})", "Field EventID should be one of the mapped ids"),
        (":LogonType = '3' AND :TargetUserName LIKE '%$'", "Windows local machine authentications should be filtered out"),
        *bad_ips("SourceAddress", "IpAddress", "ClientAddress"),
    ],
)

# Linux audit ----------------------------------------------------------------------------------

ruleset(
    "validate_audit_rules", ("reassembledAuditD01", 1),
    {
        "type": "CASE event_type WHEN 'click' THEN 'user_login' WHEN 'view' THEN 'BOGUS' END",
        "addr": absent("CASE WHEN k % 3 = 0 THEN 'x.y' ELSE '1.2.3.4' END", "event_type = 'signup'"),
        "saddr": absent("CASE WHEN k % 4 = 0 THEN '1.2.3.4.5' ELSE '1.2.3.4' END", "k % 5 = 0"),
        "daddr": absent("'1.2.3'", "event_id % 5 > 0"), "laddr": absent("'10.0.0.256'", "event_id % 6 > 0"),
        "rport": absent("CASE WHEN k % 4 = 0 THEN 'x1' ELSE '22' END", "k % 7 = 0"), "sport": absent("'2 2'", "event_id % 7 > 0"),
        "src": absent("'-1'", "event_id % 8 > 0"), "dest": absent("'http'", "event_id % 9 > 0"), "dport": absent("'80'", "event_id % 2 > 0"),
    },
    [
        (f"NOT coalesce(upper(:type) IN ({listed(AUDIT_SINGLE)}), false) AND event_type <> 'purchase'", "message type is supported by Mapper"),
        *bad_ips("addr", "saddr", "daddr", "laddr", multi="event_type = 'signup'"),
        (":rport = 'x1'", "Field rport should be a valid port"), (":sport IS NOT NULL", "Field sport should be a valid port"),
        (":src IS NOT NULL", "Field src should be a valid port"), (":dest IS NOT NULL", "Field dest should be a valid port"),
        ("event_type = 'signup'", "Field lport should be a valid port"),
    ],
    multi={
        "type": ("event_type in ('purchase', 'error')", "if(event_type = 'purchase', 'CWD', 'PATH'), 'path', 'SYSCALL', 'PATH'"),
        "addr": ("event_type = 'signup'", "'1.1.1.1', '2.2.2.2'"), "lport": ("event_type = 'signup'", "'1', '2'"),
    },
)

# Network devices ------------------------------------------------------------------------------

ruleset(
    "validate_asa_rules", ("asa00401", 1),
    {"datapayloadMsgId": absent(f"CASE WHEN k % 3 = 0 THEN '{ASA_IDS[0]}' WHEN k % 3 = 1 THEN '{ASA_IDS[-1]}' ELSE '999999' END", "k % 5 = 0")},
    [(f":datapayloadMsgId IS NULL OR :datapayloadMsgId NOT IN ({listed(ASA_IDS)})", "datapayloadMsgId should be one of the mapped ids")],
)
ruleset(
    "validate_ios_rules", ("ios/isr00401", 1),
    {"eventType": absent("CASE WHEN k % 3 = 0 THEN 'logout' WHEN k % 3 = 1 THEN 'config_i' ELSE 'reload' END", "k % 5 = 0"),
     "importance": absent("'5'", "event_id % 4 = 0")},
    [(f":eventType IS NULL OR :eventType NOT IN ({listed(IOS_PATTERN_OF)})", "event type should be one of the mapped mnemonics"),
     (":importance IS NULL", "importance is available")],
)
ruleset(
    "validate_fail2ban_rules", ("fail2ban02901", 1),
    {"originTime": absent("CASE WHEN k % 4 = 0 THEN 'yesterday' ELSE '2024-01-02 03:04:05,143' END", "k % 7 = 0"), "aux2": absent("'ban'", "event_id % 3 = 0"),
     "importance": absent("'notice'", "event_id % 4 = 0"), "sourceIp": absent("CASE WHEN k % 5 = 0 THEN '1.1.1.1.' ELSE '1.1.1.1' END", "event_id % 5 = 0")},
    [(":originTime IS NULL OR :originTime = 'yesterday'", "Field originTime should have correct format"), (":aux2 IS NULL", "Field aux2 should have value"),
     (":importance IS NULL", "Field importance should have value"), *bad_ips("sourceIp")],
)

# Antivirus ------------------------------------------------------------------------------------

ruleset(
    "validate_antivirus_rules", ("esetnode02701", 1),
    {
        "event_type": absent("CASE WHEN k % 3 = 0 THEN 'Threat_Event' WHEN k % 3 = 1 THEN 'audit_event' ELSE 'other_event' END", "k % 7 = 0"),
        "occured": absent("CASE WHEN k % 4 = 0 THEN '2024-01-02' ELSE '02-Jan-2024 03:04:05' END", "event_id % 5 = 0"),
        "target_address": absent("CASE WHEN event_id % 3 = 0 THEN 'host' ELSE '1.1.1.1' END", "k % 2 = 0"),
        "ipv4": absent("CASE WHEN event_id % 4 = 0 THEN '256.1.1.1' ELSE '1.1.1.2' END", "k % 3 = 0"), "ipv6": absent("'1.1'", "event_id % 7 > 0"),
    },
    [(f":event_type IS NULL OR lower(:event_type) NOT IN ({listed(ANTIVIRUS_TYPES)})", "Event type should be one of the mapped types"),
     (":occured IS NULL OR :occured = '2024-01-02'", "Field occured should have correct format"), *bad_ips("target_address", "ipv4", "ipv6")],
)
ruleset(
    "validate_connector_rules", ("kaspersky", 1),
    {**{name: absent("'x'", f"event_id % {n + 3} = 0") for n, name in enumerate(CONNECTOR_FIELDS)},
     "SourceIP": absent("CASE WHEN k % 3 = 0 THEN '1.1.1' ELSE '1.1.1.1' END", "k % 4 = 0"), "IP": absent("CASE WHEN k % 5 = 0 THEN 'pc' ELSE '1.1.1.1' END", "k % 7 = 0")},
    [*[missing(x) for x in CONNECTOR_FIELDS], *bad_ips("SourceIP", "IP")],
)
