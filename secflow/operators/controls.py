"""Access controls: verdicts on Windows logons, Windows objects, VPN logons and connections."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.dates import second_of_day
from secflow.operators.rules import ExactLayer, Layers, Prepared, RangeLayer, match_rules, prepare
from secflow.operators.schedule import holiday_list, schedule_check
from secflow.schema import with_leaves

ALLOWED, RESTRICTED = "Allowed", "Restricted"


def port_ranges(text: Column) -> Column:
    """``a-b,c`` as closed ranges; an absent text is no range at all."""
    parts = F.transform(F.split(text, ","), lambda p: F.split(p, "-"))
    ranges = F.transform(parts, lambda p: F.struct(
        F.get(p, F.lit(0)).try_cast("int").alias("low"),
        F.element_at(p, -1).try_cast("int").alias("high"),
    ))
    return F.coalesce(ranges, F.array().cast("array<struct<low:int,high:int>>"))


def int_set(text: Column) -> Column:
    """``a;b`` as integers; NULL where the text is absent."""
    return F.transform(F.split(text, ";"), lambda p: F.trim(p).try_cast("int"))


def _time_ranges() -> Column:
    return F.transform("intervals", lambda i: F.struct(
        i["time_from"].cast("int").alias("low"), i["time_to"].cast("int").alias("high")))


def _low(name: str) -> Column:
    return F.lower(F.col(name))


def _who(e: Column) -> list[ExactLayer]:
    return [
        ExactLayer("org", [F.lower(e["collector"]["organization"])], [_low("org")]),
        ExactLayer("domain", [F.lower(e["subject"]["domain"])], [_low("domain")]),
        ExactLayer("login", [F.lower(e["subject"]["name"])], [_low("login")]),
    ]


def _host(name: str, side: Column, rule_side: str) -> ExactLayer:
    return ExactLayer(
        name, [F.lower(side["hostname"]), F.lower(side["ip"])],
        [_low(f"{rule_side}_host"), _low(f"{rule_side}_ip")],
    )


def _when(e: Column) -> RangeLayer:
    return RangeLayer("time", second_of_day(e["data"]["originTime"]), _time_ranges())


def _windows_logon(e: Column) -> Layers:
    return Layers(
        [*_who(e), _host("source", e["source"], "source"),
         _host("destination", e["destination"], "destination")],
        [_when(e)],
    )


def _windows_object(e: Column) -> Layers:
    """The rule's host is kept as its source, but names the machine the object is on."""
    path = F.when(e["object"]["category"] == "file", e["object"]["path"]).otherwise(
        e["object"]["name"])
    return Layers(
        [*_who(e), _host("host", e["destination"], "source")], [_when(e)],
        event_path=path, rule_path=F.coalesce("obj_path", "obj_name"),
    )


def _vpn_logon(e: Column) -> Layers:
    """Names are compared as they are written."""
    return Layers(
        [ExactLayer("org", [F.lower(e["collector"]["organization"])], [_low("org")]),
         ExactLayer("domain", [e["subject"]["domain"]], [F.col("domain")]),
         ExactLayer("login", [e["subject"]["name"]], [F.col("login")])],
        [_when(e)],
    )


def _connection(e: Column) -> Layers:
    return Layers(
        [ExactLayer("org", [F.lower(e["collector"]["organization"])], [_low("org")]),
         _host("source", e["source"], "source"), _host("destination", e["destination"], "destination"),
         ExactLayer("protocol", [F.lower(e["interaction"]["protocol"])], [_low("obj_name")])],
        [RangeLayer("source_port", e["source"]["port"], port_ranges(F.col("aux1"))),
         RangeLayer("destination_port", e["destination"]["port"], port_ranges(F.col("aux2")))],
    )


def _is_windows(e: Column) -> Column:
    return F.contains(F.lower(e["eventSource"]["title"]), F.lit("windows"))


def _logon_eligible(e: Column) -> Column:
    return (
        e["interaction"]["logonType"].isNotNull() & _is_windows(e)
        & (e["subject"]["category"] == "account") & (e["object"]["category"] == "host")
        & (e["interaction"]["action"] == "login")
    )


def _object_eligible(e: Column) -> Column:
    obj = e["object"]
    return (
        _is_windows(e) & (e["subject"]["category"] == "account")
        & (((obj["category"] == "file") & obj["path"].isNotNull())
           | ((obj["category"] == "url") & obj["name"].isNotNull()))
        & e["interaction"]["action"].isin("access", "remove")
    )


def _vpn_eligible(e: Column) -> Column:
    return (
        (e["subject"]["category"] == "account") & (e["interaction"]["action"] == "up")
        & (F.upper(e["data"]["aux9"]) == "VPN")
    )


def _connection_eligible(e: Column) -> Column:
    return (
        (e["eventSource"]["category"] == "Firewall")
        & e["source"]["port"].isNotNull() & e["destination"]["port"].isNotNull()
    )


@dataclass
class Control:
    """What a control looks at, which events it applies to and how it turns a rule to a verdict."""

    rule_type: str
    layers: Callable[[Column], Layers]
    eligible: Callable[[Column], Column]
    flag: str
    scheduled: bool = False
    logon_types: bool = False

    @property
    def payload(self) -> list[str]:
        """What the verdict reads of a rule; every segment of a prepared rule carries it."""
        return ["result", *["intervals"] * self.scheduled, *["aux1"] * self.logon_types]


CONTROLS = {
    "windows_logon": Control("WindowsLogon", _windows_logon, _logon_eligible,
                             "isHostAccessTimeAllowed", scheduled=True, logon_types=True),
    "windows_object": Control("WindowsObject", _windows_object, _object_eligible,
                              "isObjectAccessAllowed"),
    "vpn_logon": Control("VpnLogon", _vpn_logon, _vpn_eligible,
                         "isHostAccessTimeAllowed", scheduled=True),
    "connection": Control("FirewallConnection", _connection, _connection_eligible,
                          "isHostAccessTimeAllowed"),
}


#: What a rule can carry.
PAYLOAD = ["result", "intervals", "aux1"]


def prepare_control(rules: DataFrame, kind: str, compat_zero_is_any: bool = True) -> Prepared:
    """The rules of one control, ready to be written or looked up."""
    chosen = CONTROLS[kind]
    own = rules.where(F.col("type") == chosen.rule_type)
    return prepare(own, chosen.layers(F.col("event")), chosen.payload, compat_zero_is_any)


def control(
    df: DataFrame, rules: DataFrame | Prepared, kind: str, holidays: DataFrame, event: str = "event",
    compat_zero_is_any: bool = True, probe: DataFrame | None = None, verdict_col: str = "verdict",
    rule_col: str = "rule_id", by: str | None = None,
) -> DataFrame:
    """Add ``rule_id`` and ``verdict`` (Allowed, Restricted or NULL) for one control.

    ``rules`` is the output of ``denorm_rules``, or prepared for this control.  Logon verdicts hold only inside the rule's
    schedule (and for its logon types); outside of it they turn into their opposite.  ``probe`` and
    ``by`` are those of ``match_rules``.
    """
    chosen = CONTROLS[kind]
    e = F.col(event)
    own = rules if isinstance(rules, Prepared) else prepare_control(rules, kind, compat_zero_is_any)
    matched = match_rules(df, own, chosen.layers(e), chosen.payload, chosen.eligible(e), probe=probe, by=by)
    rule = F.col("rule")
    verdict = rule["result"]
    if chosen.scheduled:
        matched = matched.withColumn("_holidays", holiday_list(holidays))
        holds = F.coalesce(
            schedule_check(rule["intervals"], e["data"]["originTime"], F.col("_holidays")),
            F.lit(False))
        if chosen.logon_types:
            types = int_set(rule["aux1"])
            holds = holds & (types.isNull() | F.coalesce(
                F.array_contains(types, e["interaction"]["logonType"]), F.lit(False)))
        opposite = F.when(verdict == ALLOWED, RESTRICTED).otherwise(ALLOWED)
        verdict = F.when(rule.isNotNull(), F.when(holds, verdict).otherwise(opposite))
    return matched.withColumns({rule_col: rule["rule_id"], verdict_col: verdict}).drop(
        "rule", "_holidays")


def as_flag(verdict: Column) -> Column:
    return F.when(verdict == ALLOWED, True).when(verdict == RESTRICTED, False)


def apply_verdict(df: DataFrame, kind: str, event: str = "event") -> DataFrame:
    """Write the verdict to its flag; no verdict leaves the flag as it was."""
    flag = CONTROLS[kind].flag
    old = F.col(event)["subject"]["enrichment"][flag]
    return with_leaves(
        df, event, {f"subject.enrichment.{flag}": F.coalesce(as_flag(F.col("verdict")), old)}
    ).drop("verdict", "rule_id")


# Order of the job: later verdicts on one flag replace earlier ones.
CONTROL_ORDER = ["connection", "windows_logon", "windows_object", "vpn_logon"]


def verdict_leaves(event: str = "event") -> dict[str, Column]:
    """Event leaves filled from ``verdict_{kind}`` columns, the last verdict of a flag first."""
    leaves: dict[str, Column] = {}
    for flag in dict.fromkeys(c.flag for c in CONTROLS.values()):
        kinds = [k for k in reversed(CONTROL_ORDER) if CONTROLS[k].flag == flag]
        old = F.col(event)["subject"]["enrichment"][flag]
        leaves[f"subject.enrichment.{flag}"] = F.coalesce(
            *[as_flag(F.col(f"verdict_{k}")) for k in kinds], old)
    return leaves
