"""Network devices: firewall key=value logs, ASA and IOS/ISR syslog, fail2ban."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions import dates
from secflow.functions.enums import (
    cisco_importance,
    protocol_name,
    to_action,
    to_importance,
    to_status,
)
from secflow.functions.text import split_host
from secflow.operators.normalize.common import (
    Leaves,
    aux,
    base,
    field,
    integer,
    long,
    or_unknown,
    switch,
    text,
    under,
)


def firewall() -> Leaves:
    user = text("user")
    at = F.instr(user, "@")
    has_domain = at > 1
    named = user.isNotNull()
    return {
        **base(1, "Firewall", subsys=text("type"), source_name=text("devname")),
        **under("source", {
            "nat.ip": text("transip"),
            "nat.port": integer("transport"),
            "ip": text("srcip", "remip", "ip"),
            "hostname": text("srcname", "name"),
            "port": integer("srcport", "remport", "src_port"),
            "mac": text("srcmac"),
            "host": or_unknown(text("srcip", "srcname")),
        }),
        **under("destination", {
            "nat.ip": text("trandip"),
            "nat.port": integer("trandport"),
            "ip": text("dstip", "locip", "tunnelip"),
            "hostname": text("dstname", "hostname"),
            "port": integer("dstport", "locport", "dst_port"),
            "mac": text("dstmac"),
            "host": or_unknown(text("dstip", "dstname")),
        }),
        **under("subject", {
            "category": F.when(named, "account"),
            "name": F.when(has_domain, F.substring_index(user, "@", 1)).otherwise(user),
            "domain": F.when(has_domain, F.substr(user, at + 1)),
            "group": F.when(named, text("group", "profile")),
        }),
        **under("object", {
            "category": F.when(text("filename", "qname").isNotNull(), "file")
            .when(text("url").isNotNull(), "url").otherwise("UnknownCounterpart"),
            "name": text("filename", "qname"),
            "path": text("url"),
        }),
        **under("interaction", {
            "importance": to_importance(text("level")),
            "direction": text("direction", "dir"),
            "action": to_action(text("action")),
            "reason": text("reason"),
            "status": to_status(text("status")),
            "duration": integer("duration"),
            "protocol": protocol_name(text("proto")),
        }),
        **under("data", {
            "originTime": dates.epoch_of_units(text("eventtime")),
            "msgId": text("logid"),
            "bytesIn": long("rcvdbyte"),
            "bytesOut": long("sentbyte"),
            "packetsIn": long("rcvdpkt"),
            "packetsOut": long("sentpkt"),
        }),
        **aux(
            _1=text("msg"),
            _2=text("logdesc", "ref"),
            _3=text("sessionid", "session_id", "incidentserialno"),
            _4=text("server", "authserver", "call_id"),
            _5=text("service", "method", "app", "kind"),
            _6=text("profile", "applist", "voip_proto"),
            _7=text("catid", "appid", "attackid", "virusid", "from"),
            _8=text("catdesc", "appcat", "attack", "virus", "to"),
            _9=text("subtype"),
        ),
    }


def _syslog_time():
    return dates.syslog_epoch(
        text("month"), text("day"), text("year"), text("time"), text("timezone"), F.col("received")
    )


# What each ASA message id stands for.
ASA_LOGIN = ["113004", "113012", "113015", "605005", "611101"]
ASA_COMMAND = ["111008", "111010"]
ASA_INBOUND = ["106001", "106006", "106007", "106011", "106014"]
ASA_REASONS = [
    (["113004", "605005"], "successfully authenticated"),
    (["113012"], "successfully authenticated to the local user database"),
    (["611101"], "User authentication succeeded"),
    (["111008"], "User executed the command"),
    (["111010"], "User made a configuration change."),
    (["710003"], "access denied by ACL"),
    (["105008", "105009"], "Interface_checked"),
    (["106001"], "Inbound TCP connection denied by the security policy"),
    (["106006", "106007"], "Deny inbound UDP"),
    (["106011"], "Deny_inbound_no_xlate"),
    (["106014"], "Deny inbound icmp"),
]


def asa() -> Leaves:
    message = field("datapayloadMsgId")
    tested = field("interactionStatus")
    has_message = text("datapayloadMsgId").isNotNull()
    unhealthy = ["Failed", "Undetermined"]
    severity = F.when(has_message, cisco_importance(text("interactionImportance")))
    return {
        **base(1, "Firewall", subsys=text("eventSourceSubsys")),
        "source.ip": text("sourceLocationIp"),
        "source.port": integer("sourceLocationPort"),
        "destination.ip": text("destinationLocationIp"),
        "destination.port": integer("destinationLocationPort"),
        **under("interaction", {
            "action": switch(message, [
                (ASA_LOGIN, "login"), (ASA_COMMAND, "execute"),
                (["106023", "710003", *ASA_INBOUND], "deny"), (["104001", "104002"], "info"),
                (["105005"], "alert"), (["105008", "105009"], "check"),
            ]),
            "reason": switch(message, [
                (["113015", "104001", "104002", "105005"], text("interactionReason")), *ASA_REASONS,
            ]),
            "status": switch(message, [
                (["113004", "113012", "605005", "611101", *ASA_COMMAND, "106023", "710003",
                  "105005", "105008", *ASA_INBOUND], "success"),
                (["113015"], "failure"),
                (["105009"], switch(tested, [(["Passed"], "success"), (unhealthy, "failure")])),
            ]),
            # What the message id implies outranks what the line says.
            "protocol": F.coalesce(
                switch(message, [(["106001"], "TCP"), (["106006", "106007"], "UDP")]),
                protocol_name(text("interactionProtocol")),
            ),
            "importance": F.coalesce(
                switch(message, [
                    (["105009"], switch(tested, [(["Passed"], "INFO"), (unhealthy, "MEDIUM")])),
                    (["104001", "104002"], "HIGH"), (["105005"], "MEDIUM"),
                    (["105008", *ASA_INBOUND], "INFO"),
                ]),
                severity,
            ),
        }),
        "subject.name": text("subjectName"),
        "subject.category": switch(message, [
            ([*ASA_LOGIN, *ASA_COMMAND], "account"), (["106011"], "interface"),
        ]),
        "object.category": switch(message, [
            (["113004", "113012", "113015", "611101"], "system"), (ASA_COMMAND, "command"),
            (["106023"], "connection"), (["105008", "105009", *ASA_INBOUND], "interface"),
        ]),
        "object.value": F.coalesce(
            switch(message, [(["105009"], text("objectValue"))]), text("command")
        ),
        "object.name": switch(message, [
            (["106001", "106006", "106011", "106014"], text("objectName")),
        ]),
        "data.interface": text("dataPayloadInterface"),
        "data.msgId": text("datapayloadMsgId"),
        "data.originTime": F.when(has_message, _syslog_time()),
        **aux(_1=text("aux1"), _4=text("aux4"), _5=text("aux5"), _10=text("aux10")),
    }


def ios() -> Leaves:
    kind = field("eventType")
    fqdn, hostname = split_host(None, F.col("event_hostname"))
    login = ["login_failed", "login_success", "ssh2_userauth"]
    return {
        **base(1, "NetworkDevice"),
        "interaction.importance": cisco_importance(text("importance")),
        "interaction.reason": text("interactionReason"),
        "interaction.action": switch(
            kind, [(login, "login"), (["logout"], "logout"), (["config_i"], "modify")]
        ),
        "interaction.status": switch(kind, [
            (["login_failed"], "failure"), (["login_success", "logout", "config_i"], "success"),
            (["ssh2_userauth"], to_status(text("status"))),
        ]),
        "subject.category": switch(kind, [([*login, "logout", "config_i"], "account")]),
        "subject.name": text("subjectName"),
        "source.ip": text("sourceIp"),
        "destination.ip": F.col("event_ip"),
        "destination.fqdn": fqdn,
        "destination.hostname": hostname,
        "destination.host": F.col("event_ip"),
        "destination.port": integer("destinationPort"),
        "data.msgId": text("msgId"),
        "data.originTime": _syslog_time(),
        **aux(_1=text("aux1"), _2=text("aux2")),
    }


def fail2ban() -> Leaves:
    fqdn, hostname = split_host(None, F.col("event_hostname"))
    return {
        **base(1, "HostSecurity"),
        "source.ip": text("sourceIp"),
        "destination.ip": F.col("event_ip"),
        "destination.fqdn": fqdn,
        "destination.hostname": hostname,
        "object.category": F.lit("application"),
        "object.name": F.lit("fail2ban"),
        "interaction.status": F.lit("success"),
        "interaction.action": to_action(text("aux2")),
        "interaction.importance": to_importance(text("importance")),
        "data.msgId": text("msgId"),
        "data.originTime": dates.format_epoch(text("originTime"), dates.FAIL2BAN_FORMAT),
        **aux(_1=text("aux1"), _2=text("aux2")),
    }
