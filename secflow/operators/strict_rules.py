"""Access rules with strict keys: one key on each side, one tree of keys, verdicts by event time.

This is the older form of the controls.  A rule is one or more paths of keys (organization, domain,
login, hosts or the parts of an object path), absent keys being wildcards.  An event has exactly one
key at each place: a host counts by its name, and by its address only if it has no name.  An event
without one of its keys gets no verdict.  Of all paths that fit an event the one with the earliest
literal keys wins, compared from the organization on.

* Logons: a rule is entered by address and by name, on either side; the kind of key that a path ends
  in must be the kind by which the event names its destination.
* Objects: host and path are one branch of a tree below (organization, domain, login).  A node takes
  over the rule of its nearest ancestor that has one, so a rule on a folder holds below it; a branch
  that ends before the event's path does still counts.  Each rule also stands one wildcard deeper, so
  that a longer rule beside it does not hide it.
* VPN logons: organization, domain and login.

Of several rules on one path the one with the least id counts (NULL is the least).  Repeated rules and
events keep their rows; rules without a result hide others on their path and give no verdict.  Without
rules all verdicts are NULL.  A host row with neither name nor address is no host.

Prepared rules are one row for each tuple of keys and node, looked up with the joins of ``rules``:
events are expanded to the wildcard masks and path shapes that occur and never see a list of rules.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.text import ANY, path_segments
from secflow.operators.controls import ALLOWED, PAYLOAD, RESTRICTED, int_set
from secflow.operators.rules import MARK, ExactLayer, Layers, Prepared, match_rules
from secflow.operators.schedule import holiday_list, schedule_check

NAME, ADDRESS = "Hostname", "IpAddress"


def _host_key(side: Column) -> Column:
    return F.coalesce(side["hostname"], side["ip"])


def _object_parts(path: Column) -> Column:
    """Lower-cased parts; none for an absent path and for one of separators only."""
    parts = path_segments(path)
    bare = path.isNull() | ((parts == F.array(F.lit(ANY))) & ~F.contains(path, F.lit(ANY)))
    return F.when(bare, F.array().cast("array<string>")).otherwise(parts)


# Keys of an event: a layer for each, in order; the parts of a tree below them -----------------


def _logon_layers(e: Column) -> Layers:
    kind = F.when(e["destination"]["hostname"].isNotNull(), NAME).otherwise(ADDRESS)
    return _layers({
        "org": e["collector"]["organization"], "domain": F.lower(e["subject"]["domain"]),
        "login": F.lower(e["subject"]["name"]), "source": F.lower(_host_key(e["source"])),
        "destination": F.lower(_host_key(e["destination"])), "kind": kind,
    })


def _who(e: Column) -> dict[str, Column]:
    return {"org": e["collector"]["organization"], "domain": e["subject"]["domain"], "login": e["subject"]["name"]}


def _vpn_layers(e: Column) -> Layers:
    return _layers(_who(e))


def _object_layers(e: Column) -> Layers:
    obj = e["object"]
    path = F.when(obj["category"] == "url", obj["name"]).otherwise(obj["path"])
    host = _host_key(e["eventSource"]["location"])
    return _layers(_who(e), F.concat(F.array(host), _object_parts(path)))


def _layers(keys: dict[str, Column], segments: Column | None = None) -> Layers:
    return Layers([ExactLayer(name, [key], []) for name, key in keys.items()], event_segments=segments)


# Paths of a rule ------------------------------------------------------------------------------


def _host_pairs() -> Column:
    """(source, destination, kind) for each way a logon rule is entered."""
    si, sh, di, dh = (F.col(c) for c in ("source_ip", "source_host", "destination_ip", "destination_host"))

    def pair(source: Column, destination: Column, kind: str) -> Column:
        return F.struct(source.alias("source"), destination.alias("destination"), F.lit(kind).alias("kind"))

    def given(condition: Column, *pairs: Column) -> Column:
        return F.when(condition, F.array(*pairs)).otherwise(F.array().cast(
            "array<struct<source:string,destination:string,kind:string>>"))

    source, destination = F.coalesce(sh, si).isNotNull(), F.coalesce(dh, di).isNotNull()
    by_address, by_name = pair(si, di, ADDRESS), pair(sh, dh, NAME)
    both = F.concat(
        given(si.isNotNull() | di.isNotNull(), by_address, pair(si, dh, NAME)),
        given(sh.isNotNull() | dh.isNotNull(), by_name, pair(sh, di, ADDRESS)))
    one = F.concat(given(F.coalesce(si, di).isNotNull(), by_address), given(F.coalesce(sh, dh).isNotNull(), by_name))
    return (F.when(source & destination, both).when(source | destination, one)
            .otherwise(F.array(by_address, by_name)))


def _key(names: list[str]) -> list[Column]:
    """Key and mask of the wildcards of its parts."""
    wild = [F.when(F.col(f"k_{n}") == ANY, "1").otherwise("0") for n in names]
    return [F.concat_ws(MARK, *[f"k_{n}" for n in names]).alias("_k"), F.concat(*wild).alias("mask")]


def _prepared(best: DataFrame) -> Prepared:
    keys = best.groupBy("_k", "mask").agg(F.collect_set(F.struct("shape")).alias("forms"))
    return Prepared(best.where(F.col("rule.result").isNotNull()).drop("mask"), keys)


def _flat(keyed: DataFrame, names: list[str]) -> Prepared:
    """Rules of complete keys, without a tree below."""
    best = keyed.select(*_key(names), "rule").groupBy("_k", "mask").agg(F.min("rule").alias("rule"))
    return _prepared(best.withColumns({"node": F.lit(""), "leaf": F.lit(True), "shape": F.lit("")}))


def _rule() -> Column:
    return F.struct("rule_id", *PAYLOAD).alias("rule")


def _who_as_text(rules: DataFrame) -> DataFrame:
    return rules.select(*[F.coalesce(c, F.lit(ANY)).alias(f"k_{c}") for c in ("org", "domain", "login")], "*")


def _prepare_logons(rules: DataFrame) -> Prepared:
    keyed = _who_as_text(rules).withColumn("_p", F.explode(_host_pairs())).select(
        "k_org", "k_domain", "k_login", F.coalesce("_p.source", F.lit(ANY)).alias("k_source"),
        F.coalesce("_p.destination", F.lit(ANY)).alias("k_destination"), F.col("_p.kind").alias("k_kind"), _rule())
    return _flat(keyed, ["org", "domain", "login", "source", "destination", "kind"])


def _prepare_vpn(rules: DataFrame) -> Prepared:
    return _flat(_who_as_text(rules).select("k_org", "k_domain", "k_login", _rule()), ["org", "domain", "login"])


def _prepare_objects(rules: DataFrame) -> Prepared:
    host = F.array_compact(F.array("source_host", "source_ip"))
    hosts = F.when(F.size(host) == 0, F.array(F.lit(ANY))).otherwise(host)
    paths = _who_as_text(rules).select(
        *_key(["org", "domain", "login"]), _rule(), F.explode(hosts).alias("_host"),
        _object_parts(F.col("obj_path")).alias("_parts"))
    deeper = F.explode(F.array(F.array().cast("array<string>"), F.array(F.lit(ANY))))
    paths = paths.withColumn("_more", deeper).select(
        "_k", "mask", "rule", F.concat(F.array("_host"), "_parts", "_more").alias("_path"))
    # Nodes of the tree with the rule that stands at each, if one does.
    prefixes = paths.select("_k", "mask", "rule", "_path", F.explode(F.sequence(F.lit(1), F.size("_path"))).alias("_depth"))
    whole = F.col("_depth") == F.size("_path")
    nodes = prefixes.groupBy("_k", "mask", F.slice("_path", F.lit(1), F.col("_depth")).alias("_path")).agg(
        F.min(whole).alias("leaf"), F.min(F.when(whole, F.col("rule"))).alias("_own"))
    # Each node asks its ancestors, itself included; the deepest one with a rule answers.
    asks = nodes.select("_k", "mask", "_path", "leaf", F.explode(F.sequence(F.lit(1), F.size("_path"))).alias("_depth"))
    asks = asks.withColumn("_asked", F.slice("_path", F.lit(1), F.col("_depth")))
    owners = nodes.where(F.col("_own").isNotNull()).select("_k", F.col("_path").alias("_asked"), "_own")
    best = asks.join(owners, ["_k", "_asked"]).groupBy("_k", "mask", "_path", "leaf").agg(
        F.max_by("_own", "_depth").alias("rule"))
    stars = F.transform("_path", lambda p: F.when(p == ANY, "1").otherwise("0"))
    return _prepared(best.select("_k", "mask", "leaf", "rule", F.array_join("_path", MARK).alias("node"),
                                 F.array_join(stars, "").alias("shape")))


@dataclass
class StrictControl:
    """Keys of its events, preparation of its rules, and what its verdicts depend on besides."""

    rule_type: str
    layers: Callable[[Column], Layers]
    prepare: Callable[[DataFrame], Prepared]
    scheduled: bool = True
    logon_types: bool = False


STRICT_CONTROLS = {
    "windows_logon": StrictControl("WindowsLogon", _logon_layers, _prepare_logons, logon_types=True),
    "windows_object": StrictControl("WindowsObject", _object_layers, _prepare_objects, scheduled=False),
    "vpn_logon": StrictControl("VpnLogon", _vpn_layers, _prepare_vpn),
}


def prepare_strict(rules: DataFrame, kind: str) -> Prepared:
    """The rules of one strict control (output of ``denorm_rules``), ready to be written or looked up."""
    chosen = STRICT_CONTROLS[kind]
    return chosen.prepare(rules.where(F.col("type") == chosen.rule_type))


def strict_control(
    df: DataFrame, rules: DataFrame | Prepared, kind: str, holidays: DataFrame, event: str = "event",
    scheduled: bool | None = None, verdict_col: str = "verdict", rule_col: str = "rule_id",
    by: str | None = None,
) -> DataFrame:
    """Add ``rule_id`` and ``verdict`` (Allowed, Restricted or NULL) of one control with strict keys.

    Outside the schedule of the winning rule at the time of the event, and for other logon types than
    its own, the verdict is the opposite.  ``scheduled`` overrides whether the schedule counts.  ``by``
    is that of ``match_rules``.  All events with all keys take part, whatever their category.
    """
    chosen, e = STRICT_CONTROLS[kind], F.col(event)
    own = rules if isinstance(rules, Prepared) else prepare_strict(rules, kind)
    layers = chosen.layers(e)
    complete = F.lit(True)
    for key in [layer.event_keys[0] for layer in layers.exact]:
        complete = complete & key.isNotNull()
    if layers.event_segments is not None:
        complete = complete & F.get(layers.event_segments, F.lit(0)).isNotNull()
    matched = match_rules(df, own, layers, PAYLOAD, complete, by=by)
    rule, holds = F.col("rule"), F.lit(True)
    if chosen.scheduled if scheduled is None else scheduled:
        matched = matched.withColumn("_holidays", holiday_list(holidays))
        holds = F.coalesce(schedule_check(rule["intervals"], e["eventTime"], F.col("_holidays")), F.lit(False))
    if chosen.logon_types:
        types = int_set(rule["aux1"])
        holds = holds & (types.isNull() | F.coalesce(
            F.array_contains(types, e["interaction"]["logonType"]), F.lit(False)))
    opposite = F.when(rule["result"] == ALLOWED, RESTRICTED).otherwise(ALLOWED)
    verdict = F.when(rule.isNotNull(), F.when(holds, rule["result"]).otherwise(opposite))
    return matched.withColumns({rule_col: rule["rule_id"], verdict_col: verdict}).drop("rule", "_holidays")
