"""Antivirus products: one that logs JSON lines and two read through a database connector."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from secflow.functions.dates import ANTIVIRUS_FORMAT, format_epoch, iso_epoch
from secflow.functions.enums import to_counterpart, to_importance, to_status
from secflow.functions.text import split_host
from secflow.operators.normalize.common import (
    Leaves,
    aux,
    base,
    field,
    integer,
    or_unknown,
    switch,
    text,
)


def _flag(key: str) -> Column:
    return text(key).try_cast("boolean").cast("string")


def json_antivirus() -> Leaves:
    kind = f"lower({field('event_type')})"
    action = f"coalesce({field('action')}, {field('action_taken')})"
    fqdn, hostname = split_host(None, text("hostname"))
    website, firewall, threat = "filteredwebsites_event", "firewallaggregated_event", "threat_event"
    user = F.coalesce(F.when(text("user") != "", text("user")), text("parsed_username"))
    return {
        **base(1, "AntiVirus"),
        "source.ip": switch(kind, [
            ([website], text("ipv4", "ipv6")), ([firewall], text("source_address")),
        ]),
        "source.port": integer("source_port"),
        "source.hostname": hostname,
        "source.fqdn": fqdn,
        "destination.ip": switch(kind, [([website], text("target_address"))],
                                 text("ipv4", "ipv6", "target_address")),
        "destination.port": integer("target_port"),
        "destination.hostname": hostname,
        "destination.fqdn": fqdn,
        "interaction.importance": to_importance(text("severity")),
        "interaction.action": switch(kind, [
            (["audit_event"], switch(action, [
                (["login attempt"], "login"), (["logout"], "logout")])),
            ([firewall], "connect"),
            ([website], "lock"),
            ([threat], switch(action, [
                (["cleaned by deleting"], "remove"), (["connection terminated"], "terminate")])),
        ]),
        "interaction.status": F.when(text("result").isNotNull(), to_status(text("result"))),
        "interaction.reason": text("detail", "event", "circumstances"),
        "interaction.protocol": text("protocol"),
        "subject.category": F.lit("account"),
        "subject.domain": text("domain", "parsed_domain"),
        "subject.name": user,
        "object.category": switch(kind, [
            ([firewall, website], "process"), ([threat], "malwareObject"),
        ]),
        "object.name": text("process_name"),
        "object.path": text("object_uri"),
        "data.originTime": format_epoch(text("occured"), ANTIVIRUS_FORMAT),
        "data.msgId": F.lower(text("event_type")),
        **aux(
            _1=F.lower(text("hash")),
            _2=text("source_uuid"),
            _3=text("threat_name", "rule_id"),
            _4=F.coalesce(_flag("inbound"), text("processname")),
            _5=switch(kind, [([threat], text("threat_type"))],
                      text("aggregate_count", "scanner_id")),
            _6=_flag("threat_handled"),
            _7=_flag("need_restart"),
            _8=text("firstseen"),
            _9=switch(kind, [([threat], text("scanner_id"))]),
            _10=text("scan_id"),
        ),
    }


def _connector(version: int, clean: bool) -> Leaves:
    """What both connector products share; ``clean`` cuts host names at ``~``."""
    attack = text("TypeActivity") == "NetworkAttack"
    deleted, blocked = integer("Deleted"), integer("Block")

    def name(key: str) -> Column:
        return F.substring_index(text(key), "~", 1) if clean else text(key)

    own = {
        "ip": text("IP"),
        "hostname": name("HostName"),
        "fqdn": name("FQDN"),
        "host": or_unknown(F.coalesce(text("IP"), name("HostName"))),
    }
    attacker = {"ip": text("SourceIP"), "host": or_unknown(text("SourceIP"))}
    nothing = F.lit(None).cast("string")
    leaves = {
        **base(version, "AntiVirus", subsys=text("ModuleName")),
        "interaction.importance": to_importance(text("Severity")),
        "interaction.protocol": text("Proto"),
        "interaction.action": F.when(deleted == 1, "remove")
        .when((blocked == 1) & (deleted == 0), "lock")
        .when((blocked == 0) & (deleted == 0), "detect")
        .otherwise("UnknownInteractionCategory"),
        "interaction.reason": text("TypeActivity"),
        "interaction.status": F.lit("success"),
        "destination.port": F.when(attack, integer("Port")),
        "data.originTime": iso_epoch(text("DetectionTime")),
        **aux(_1=F.lower(text("Sha256")), _4=text("SignatureDescription"), _5=text("Signature"),
              _9=text("MailSubject")),
    }
    for leaf, column in own.items():
        leaves[f"source.{leaf}"] = F.when(attack, attacker.get(leaf, nothing)).otherwise(column)
        leaves[f"destination.{leaf}"] = F.when(attack, column)
    return leaves


def connector_a() -> Leaves:
    """In a network attack the user is the object, not the subject."""
    attack = text("TypeActivity") == "NetworkAttack"
    user, domain = text("UserName"), text("UserDomainName")
    named = user.isNotNull() | domain.isNotNull()
    name, path = text("ObjectName", "ProcessName"), text("ObjectPath", "URL")
    there = name.isNotNull() | path.isNotNull()
    return {
        **_connector(2, clean=True),
        "subject.name": F.when(~attack, user),
        "subject.domain": F.when(~attack, domain),
        "subject.category": F.when(~attack & named, "account"),
        "object.name": F.when(attack, user).otherwise(name),
        "object.domain": F.when(attack, domain),
        "object.path": F.when(~attack, path),
        "object.category": F.when(attack & named, "account").when(
            ~attack & there, to_counterpart(text("ObjectType"))),
        **aux(_2=text("Sha1"), _3=text("EventType"), _6=text("ID"), _7=text("SensorName"),
              _8=text("HostDomain")),
    }


def connector_b() -> Leaves:
    """The object category is stated or follows from which of its parts is there."""
    name, path = text("ObjectName", "ProcessName"), text("ObjectPath", "URL")
    category = F.when(text("ObjectType").isNotNull(), to_counterpart(text("ObjectType"))).when(
        text("ProcessName").isNotNull(), "process").when(text("URL").isNotNull(), "url").when(
        text("ObjectPath").isNotNull(), "file").otherwise("UnknownCounterpart")
    user, domain = text("UserName"), text("UserDomainName")
    return {
        **_connector(1, clean=False),
        "subject.name": user,
        "subject.domain": domain,
        "subject.category": F.when(user.isNotNull() | domain.isNotNull(), "account"),
        "object.name": name,
        "object.path": path,
        "object.category": F.when(name.isNotNull() | path.isNotNull(), category),
        **aux(_2=text("Block"), _3=text("EventName"), _6=text("Action"), _7=text("TypeActivity"),
              _8=text("Delete"), _10=text("Signatureid")),
    }
