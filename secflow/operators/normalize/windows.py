"""Windows security log: one mapper whose leaves depend on the event id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from secflow.functions.dates import iso_epoch
from secflow.functions.enums import access_mask_action, to_importance
from secflow.functions.text import split_host
from secflow.operators.normalize.common import (
    Leaves,
    base,
    field,
    integer,
    one_of,
    or_unknown,
    switch,
    text,
)

# Event ids by meaning; every other mapped id is an object audit.
LOGON = ["4624", "4801", "4625"]
GROUP_ENABLE = ["4728", "4732", "4746", "4751", "4756", "4761", "4785", "4787"]
GROUP_DISABLE = ["4729", "4733", "4747", "4752", "4757", "4762", "4786", "4788"]
GROUP_MODIFY = ["4764"]
GROUP = [*GROUP_ENABLE, *GROUP_DISABLE, *GROUP_MODIFY]
USER = ["4722", "4725", "4720", "4726", "4723", "4724"]
KERBEROS = ["4771", "4768"]
NTLM = ["4776"]
SET_PASSWORD = ["4794"]
SID_HISTORY = ["4766", "4765"]
TICKET = ["4769"]
CHANGE_USER = ["4738"]
CHANGE_AUDIT = ["4719"]
ALL_BUT_AUDIT = [
    *LOGON, *GROUP, *USER, *KERBEROS, *NTLM, *SET_PASSWORD, *SID_HISTORY, *TICKET, *CHANGE_USER,
    *CHANGE_AUDIT,
]


def _by_success(flag: Column) -> Column:
    return F.when(flag == "0x0", "success").otherwise("failure")


def windows() -> Leaves:
    event = field("EventID")
    audit = ~one_of(event, ALL_BUT_AUDIT)
    file_access = one_of(event, ["4663"])
    logon_type = F.when(one_of(event, LOGON), integer("LogonType"))
    local_logon = F.coalesce(logon_type == 2, F.lit(False))

    fqdn, hostname = split_host(None, F.col("event_hostname"))
    collector_fqdn, collector_name = split_host(None, F.col("collector_host"))

    # A logon's destination is completed from the event source; the others only name the host.
    target_fqdn, target_name = split_host(None, text("Hostname"))
    is_logon = one_of(event, LOGON)
    named = text("Hostname").isNotNull()
    destination = {
        "fqdn": F.when(named, target_fqdn).when(is_logon, fqdn),
        "hostname": F.when(named, target_name).when(is_logon, hostname),
        "ip": F.when(is_logon, F.col("event_ip")),
    }
    destination["host"] = or_unknown(F.coalesce(destination["ip"], destination["hostname"]))

    caller_fqdn, caller_name = split_host(None, text("WorkstationName", "Workstation", "CallerWorkname"))
    caller_ip = text("SourceAddress", "IpAddress", "ClientAddress")
    remote = {
        "ip": caller_ip,
        "fqdn": caller_fqdn,
        "hostname": caller_name,
        "host": or_unknown(F.coalesce(caller_ip, caller_name)),
        "port": integer("IpPort"),
    }
    source = {
        name: F.when(local_logon, destination[name]).otherwise(column) if name in destination
        else F.when(~local_logon, column)
        for name, column in remote.items()
    }

    target_is_subject = [*LOGON, *KERBEROS, *NTLM, *TICKET]
    user = text("TargetUserName")
    by_target = one_of(event, target_is_subject)
    subject = {
        "name": F.when(one_of(event, TICKET), F.regexp_replace(user, "@.*", ""))
        .when(by_target, user).otherwise(text("SubjectUserName")),
        "domain": F.when(
            one_of(event, KERBEROS),
            F.coalesce(F.replace(text("ServiceName"), F.lit("krbtgt/"), F.lit("")),
                       text("TargetDomainName")),
        ).when(one_of(event, NTLM), F.lit(None).cast("string"))
        .when(by_target, text("TargetDomainName")).otherwise(text("SubjectDomainName")),
        "id": F.when(one_of(event, [*LOGON, *KERBEROS]), text("TargetSid"))
        .when(one_of(event, [*NTLM, *TICKET]), F.lit(None).cast("string"))
        .otherwise(text("SubjectUserSid")),
    }

    target_is_object = [*GROUP, *USER, *SID_HISTORY, *CHANGE_USER]
    obj = {
        "category": switch(event, [
            (["4625"], "account"), (LOGON, "host"), (["4663"], "file"), (GROUP, "system"),
            (CHANGE_AUDIT, "rule"), (ALL_BUT_AUDIT, "account"),
        ], "url"),
        "name": switch(event, [
            (target_is_object, user), (TICKET, text("ServiceName")),
            (CHANGE_AUDIT, text("SubcategoryId")),
            ([*ALL_BUT_AUDIT, "4663"], F.lit(None).cast("string")),
        ], text("ShareName")),
        "domain": F.when(one_of(event, target_is_object), text("TargetDomainName")),
        "id": switch(event, [
            (target_is_object, text("TargetSid")), (TICKET, text("ServiceSid")),
            (CHANGE_AUDIT, text("SubcategoryGuid")),
        ]),
        "path": F.when(file_access, text("ObjectName")).when(audit, text("ShareLocalPath"))
        .when(one_of(event, CHANGE_USER), text("ProfilePath")),
        "property": F.when(one_of(event, GROUP), "GroupMember"),
        "value": switch(event, [
            (GROUP, text("MemberUser", "member_user", "MemberName", "member_name", "MemberSid")),
            (CHANGE_USER, text("UserParameters")), (CHANGE_AUDIT, text("AuditPolicyChanges")),
        ]),
        "group": switch(event, [
            (CHANGE_USER, text("PrimaryGroupId")), (CHANGE_AUDIT, text("CategoryId")),
        ]),
    }

    interaction = {
        "action": switch(event, [
            ([*LOGON, *KERBEROS, *NTLM, *TICKET], "login"),
            (GROUP_ENABLE, "enable"), (GROUP_DISABLE, "disable"),
            (["4722"], "enable"), (["4725"], "disable"), (["4720"], "create"), (["4726"], "remove"),
            (ALL_BUT_AUDIT, "modify"),
        ], access_mask_action(text("AccessMask"))),
        "status": switch(event, [
            (["4625", "4771", "4766"], "failure"), (["4768", "4776"], "ongoing"),
            ([*SET_PASSWORD, *TICKET], _by_success(text("Status"))),
        ], "success"),
        "importance": to_importance(text("SeverityValue")),
        "logonType": logon_type,
        "reason": text("SubStatus", "Status"),
    }

    def per_event(*cases: tuple[list[str], str], audited: str | None = None) -> Column:
        value = switch(event, [(ids, text(key)) for ids, key in cases])
        return value if audited is None else F.when(audit, text(audited)).otherwise(value)

    with_logon_id = [*SET_PASSWORD, *SID_HISTORY, *CHANGE_USER, *CHANGE_AUDIT]
    auxiliary = {
        1: per_event((LOGON, "SubjectUserName"), (GROUP, "MemberSid"), audited="RelativeTargetName"),
        2: per_event((LOGON, "SubjectDomainName"), (GROUP, "GroupTypeChange"),
                     (KERBEROS, "PreAuthType"), (with_logon_id, "SubjectLogonId"),
                     (TICKET, "LogonGuid"), audited="AccessMask"),
        3: per_event((LOGON, "SubjectUserSid"), ([*KERBEROS, *TICKET], "TicketOptions"),
                     (SID_HISTORY, "PrivilegeList"), (CHANGE_USER, "PasswordLastSet"),
                     audited="AccessList"),
        4: per_event((LOGON, "Status"), (SID_HISTORY, "SourceUserName"),
                     (TICKET, "TicketEncryptionType"), (CHANGE_USER, "OldUacValue"),
                     audited="AccessReason"),
        5: per_event((LOGON, "ProcessName"), (SID_HISTORY, "SourceSid"), (TICKET, "Status"),
                     (CHANGE_USER, "NewUacValue"), audited="ProcessName"),
        6: per_event((LOGON, "AuthenticationPackageName"), (CHANGE_USER, "UserAccountControl"),
                     audited="ProcessId"),
        7: per_event((LOGON, "LogonProcessName"), (CHANGE_USER, "DisplayName"), audited="ObjectType"),
        8: per_event((CHANGE_USER, "HomeDirectory"), audited="ObjectServer"),
        9: per_event((CHANGE_USER, "UserWorkstations")),
        10: per_event((CHANGE_USER, "LogonHours")),
    }

    leaves = {
        **base(2, "OperatingSystem", subsys=text("Channel")),
        "collector.location.fqdn": collector_fqdn,
        "collector.location.hostname": collector_name,
        "subject.category": F.lit("account"),
        "data.originTime": iso_epoch(text("EventTime")),
        "data.msgId": text("EventID"),
    }
    for prefix, part in (("source", source), ("destination", destination), ("subject", subject),
                         ("object", obj), ("interaction", interaction)):
        leaves.update({f"{prefix}.{name}": column for name, column in part.items()})
    leaves.update({f"data.aux{n}": column for n, column in auxiliary.items()})
    return leaves
