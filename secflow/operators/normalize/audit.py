"""Linux audit records: single-line types and the multi-line system-call record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from secflow.functions.enums import to_action, to_counterpart, to_status
from secflow.functions.text import split_host
from secflow.operators.normalize.common import Leaves, base, field, integer, one_of, switch, text

PATH_SLOTS = range(3, 11)


def _repeated(key: str) -> Column:
    return F.try_element_at(F.col("multi"), F.lit(key))


def _any(key: str) -> Column:
    """All values of a key, whether it came once or several times."""
    return F.coalesce(_repeated(key), F.when(text(key).isNotNull(), F.array(text(key))))


def _command() -> Column:
    """Arguments a0 … a(argc-1) joined by blanks; absent ones are left out."""
    count = text("argc").try_cast("int")
    names = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat(F.lit("a"), i.cast("string")))
    values = F.transform(names, lambda name: F.try_element_at(F.col("fields"), name))
    joined = F.array_join(F.array_compact(values), " ")
    return F.when(count >= 1, joined).when(count <= 0, F.lit(""))


def audit(syscall_actions: dict[str, str] | None = None,
          syscall_objects: dict[str, str] | None = None) -> Leaves:
    """``syscall_actions`` and ``syscall_objects`` name the canonical action and object category
    of each system-call number; numbers they lack map to the unknown names."""
    kind = f"upper({field('type')})"
    kind_name = F.upper(text("type"))
    single = text("type").isNotNull()
    fqdn, hostname = split_host(None, text("hostname"))
    category = switch(kind, [
        (["AVC"], switch(field("tclass"), [(["file"], "file"), (["process"], "process")],
                         "UnknownCounterpart")),
    ], to_counterpart(kind_name))
    paths = F.array_sort(F.array_distinct(_any("name")))

    def slot(n: int, of_single: Column | None) -> Column:
        of_paths = F.get(paths, F.lit(n - 3)) if n in PATH_SLOTS else None
        one = F.lit(None).cast("string") if of_single is None else of_single
        return F.when(single, one) if of_paths is None else F.when(single, one).otherwise(of_paths)

    return {
        **base(1, "OperatingSystem"),
        "source.fqdn": fqdn,
        "source.hostname": hostname,
        "source.ip": text("addr", "saddr"),
        "source.port": integer("rport", "sport", "src"),
        "destination.ip": text("daddr", "laddr"),
        "destination.port": integer("dest", "dport", "lport"),
        "interaction.action": F.when(single, to_action(kind_name)).otherwise(
            to_action(text("syscall"), syscall_actions)),
        "interaction.status": F.when(one_of(kind, ["EXECVE"]), "success").when(
            single, to_status(text("interaction_status", "res"))
        ).otherwise(F.when(text("success").isNotNull(), to_status(text("success")))),
        "interaction.reason": F.when(~single, text("exit")),
        "subject.name": F.when(single, text("acct")),
        "subject.id": F.when(
            one_of(kind, ["USER_AUTH", "USER_END", "USER_LOGIN"]), text("id")
        ).when(single, text("euid", "uid")).otherwise(text("euid")),
        "subject.category": F.when(one_of(kind, ["AVC"]), "system").when(
            ~single | one_of(kind, ["USER_AUTH"]), "account"),
        "object.id": F.when(single, text("id")),
        "object.category": F.when(single, category).otherwise(
            to_counterpart(text("syscall"), syscall_objects)),
        "object.name": F.when(single, text("a0")).otherwise(text("comm")),
        "object.property": F.when(single, text("argc")),
        "object.value": F.when(one_of(kind, ["EXECVE"]), _command()),
        "data.msgId": F.when(single, kind_name).otherwise("SYSCALL"),
        "data.originTime": F.get(_any("msg_timestamp"), F.lit(0)).try_cast("bigint"),
        "data.aux1": text("auid"),
        "data.aux2": text("pid"),
        "data.aux3": slot(3, None),
        "data.aux4": slot(4, switch(kind, [(["AVC"], text("dev"))], text("ses"))),
        "data.aux5": slot(5, switch(kind, [
            (["USER_AUTH", "USER_END"], text("terminal")), (["USER_CMD"], text("cmd")),
        ], text("subj"))),
        "data.aux6": slot(6, switch(kind, [
            (["USER_CMD"], text("subj")), (["AVC"], text("comm")),
        ], text("exe"))),
        "data.aux7": slot(7, switch(kind, [
            (["USER_AUTH"], text("op")), (["USER_CMD"], F.lit(None).cast("string")),
        ], text("terminal"))),
        "data.aux8": slot(8, switch(kind, [
            (["USER_AUTH"], text("subj")), (["USER_CHAUTHTOK"], text("op")),
        ], text("aux8"))),
        "data.aux9": slot(9, switch(kind, [
            (["USER_CMD"], text("terminal")), (["USER_LOGIN"], text("subj")),
        ])),
        "data.aux10": slot(10, switch(kind, [
            (["USER_CMD"], text("cwd")), (["USER_END"], text("op")),
        ])),
    }
