"""Rule matching, geo lookup and schedules against plain-Python brute force."""

import ipaddress
import itertools
import random

import pytest
from pyspark.sql import functions as F

from secflow.operators.controls import control
from secflow.operators.geo import geo_lookup
from secflow.operators.schedule import split_period
from secflow.schema import EVENT, build

INTERVALS = "array<struct<time_from:int,time_to:int,days_work:int,days_weekend:int,is_calendar:boolean>>"
RULES = ("rule_id int,type string,org string,domain string,login string,source_host string,source_ip string,"
         "destination_host string,destination_ip string,obj_type string,obj_path string,obj_name string,intervals "
         + INTERVALS + ",aux1 string,aux2 string,result string")
FOREVER = [(0, 0, 7, 0, False)]


def rule(rule_id, kind, domain=None, login=None, source=(None, None), destination=(None, None), path=None,
         protocol=None, intervals=FOREVER, aux1=None, aux2=None, result="Allowed", org="org1"):
    return (rule_id, kind, org, domain, login, *source, *destination, "file", path, protocol, intervals, aux1, aux2,
            result)


def with_event(df, **leaves):
    return df.withColumn("event", build(EVENT, {
        k.replace("__", "."): v if hasattr(v, "cast") else F.lit(v) for k, v in leaves.items()}))


@pytest.fixture(scope="module")
def calendar(spark):
    return spark.sql("select date'2021-01-01' as holiday")


def test_object_rules(spark, calendar):
    desk = ("desk12", None)
    rules = spark.createDataFrame([
        rule(10, "WindowsObject", "lab", result="Restricted"),
        rule(11, "WindowsObject", "lab", "olga", desk, path="e:\\books\\2020\\*", result="Restricted"),
        rule(12, "WindowsObject", "lab", "olga", desk, path="e:\\books\\2020\\may\\sum.xls"),
        rule(13, "WindowsObject", "lab", "ivan", path="f:\\*"),
        rule(14, "WindowsObject", "lab", "olga", desk, path="e:\\*"),
        rule(15, "WindowsObject", "lab", "ivan", path="netlogon"),
    ], RULES)
    cases = [("olga", "E:\\Music", "desk12", 14), ("olga", "E:\\Books\\2020\\June", "desk12", 11),
             ("olga", "E:\\Books\\2020\\May\\sum.xls", "desk12", 12), ("petr", "e:\\a", "desk3", 10),
             ("ivan", "g:\\t", "desk4", 10), ("ivan", "f:\\u\\v\\w", "desk4", 13), ("ivan", "netlogon", "desk4", 15)]
    df = with_event(
        spark.createDataFrame(cases, "n string, p string, h string, expected int"), collector__organization="org1",
        subject__category="account", subject__domain="LAB", subject__name=F.col("n"),
        destination__hostname=F.col("h"), object__category="file", object__path=F.col("p"),
        eventSource__title="Windows", interaction__action="access", data__originTime=F.lit(1000))
    for row in control(df, rules, "windows_object", calendar).collect():
        assert row["rule_id"] == row["expected"], row["p"]


def test_connection_rules(spark, calendar):
    target = (None, "10.60.0.9")
    rules = spark.createDataFrame([
        rule(20, "FirewallConnection", source=(None, "10.61.1.1"), destination=target, protocol="tcp",
             aux2="443,3000-3099"),
        rule(21, "FirewallConnection", source=(None, "10.61.1.2"), destination=target, protocol="tcp",
             aux1="50505", aux2="443,3000-3099"),
        rule(22, "FirewallConnection", source=(None, "10.61.1.3"), destination=target, aux2="53"),
    ], RULES)
    cases = [("10.61.1.1", 41000, 443, 20), ("10.61.1.1", 7, 3050, 20), ("10.61.1.1", 7, 3100, None),
             ("10.61.1.2", 50505, 443, 21), ("10.61.1.2", 50506, 443, None), ("10.61.1.3", 9, 53, 22),
             ("10.61.1.4", 40000, 443, None)]
    # The address arrives as a host name: both share one key space.
    df = with_event(
        spark.createDataFrame(cases, "s string, sp int, dp int, expected int"), collector__organization="org1",
        source__hostname=F.col("s"), source__port=F.col("sp"), destination__hostname="10.60.0.9",
        destination__port=F.col("dp"), interaction__protocol="TCP", eventSource__category="Firewall")
    for row in control(df, rules, "connection", calendar).collect():
        assert row["rule_id"] == row["expected"]
        assert row["verdict"] == (None if row["expected"] is None else "Allowed")


def layered(rules, event):
    """Nested search: candidates per layer in order, intersected, first non-empty combination wins."""
    def exact(keys, of_rule):
        found = []
        for key in [*(k for k in keys if k is not None), "*"]:
            hits = {r["id"] for r in rules if key in (of_rule(r) or ["*"])}
            if hits:
                found.append(hits)
        return found

    def within(p, low, high):
        if low > high:
            return p >= low if high == 0 else p >= low or p <= high
        return low <= p <= high

    def ranged(point):
        def hit(p, r, opened):
            return any((lo == 0 if opened else within(p, lo, hi)) for lo, hi in r["times"] or [(0, 0)])
        return [{r["id"] for r in rules if hit(point, r, False)}, {r["id"] for r in rules if hit(0, r, True)}]

    layers = [
        exact([event["domain"]], lambda r: [r["domain"]] if r["domain"] else None),
        exact([event["login"]], lambda r: [r["login"]] if r["login"] else None),
        exact(event["src"], lambda r: [x for x in r["src"] if x]),
        exact(event["dst"], lambda r: [x for x in r["dst"] if x]),
        ranged(event["second"]),
    ]
    combos = layers[0]
    for layer in layers[1:]:
        combos = [a & b for a, b in itertools.product(combos, layer) if a & b]
    return min(combos[0]) if combos else None


def test_layered_match_agrees_with_nested_search(spark, calendar):
    rng = random.Random(7)

    def maybe(values):
        return rng.choice([None, *values])

    domains, logins, hosts, ips = ["d1", "d2"], ["u1", "u2", "u3"], ["h1", "h2"], ["1.1.1.1", "2.2.2.2"]
    times = [[], [(0, 0)], [(100, 5000)], [(0, 3000)], [(80000, 200)], [(40000, 0)], [(10, 20), (3000, 90000)]]
    plain = [{"id": i, "domain": maybe(domains), "login": maybe(logins), "src": (maybe(hosts), maybe(ips)),
              "dst": (maybe(hosts), maybe(ips)), "times": rng.choice(times)} for i in range(60)]
    rules = spark.createDataFrame([
        rule(r["id"], "WindowsLogon", r["domain"], r["login"], r["src"], r["dst"],
             intervals=[(lo, hi, 7, 0, False) for lo, hi in r["times"]]) for r in plain], RULES)
    events = [(i, maybe(domains), maybe(logins + ["zz"]), maybe(hosts + ["1.1.1.1"]), maybe(ips), maybe(hosts), maybe(ips),
               rng.randrange(86400)) for i in range(400)]
    df = with_event(
        spark.createDataFrame(events, "i int, d string, l string, sh string, si string, dh string, di string, sec long"),
        collector__organization="ORG1", subject__domain=F.col("d"), subject__name=F.col("l"),
        source__hostname=F.col("sh"), source__ip=F.col("si"), destination__hostname=F.col("dh"),
        destination__ip=F.col("di"), data__originTime=F.col("sec"), subject__category="account",
        object__category="host", interaction__action="login", interaction__logonType=F.lit(2),
        eventSource__title="windows")
    got = {r["i"]: r["rule_id"] for r in control(df, rules, "windows_logon", calendar).collect()}
    assert len(got) == len(events)
    for i, d, login, sh, si, dh, di, sec in events:
        expected = layered(plain, {"domain": d, "login": login, "src": [sh, si], "dst": [dh, di], "second": sec})
        assert got[i] == expected, events[i]


def test_longest_prefix_agrees_with_brute_force(spark):
    rng = random.Random(3)
    nets = sorted({str(ipaddress.ip_network((rng.getrandbits(32), rng.choice([6, 8, 12, 16, 24, 32])), strict=False))
                   for _ in range(300)})
    nets += ["2001:db8::/32", "2001:db8:1::/48", "2001:db8:1::5/128", "fe80::/10"]
    cities = spark.createDataFrame([(f"c{i}", None, None, None, n) for i, n in enumerate(nets)],
                                   "city string, country string, org string, org_id string, network string")
    countries = spark.createDataFrame([("all", "o", "1", "0.0.0.0/0")],
                                      "country string, org string, org_id string, network string")
    ips = [str(ipaddress.ip_address(rng.getrandbits(32))) for _ in range(400)]
    ips += [n.split("/")[0] for n in nets] + ["2001:db8:1::5", "2001:db8:1::6", "2001:db8:2::1", "::2", "bad", None]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, ip string")
    parsed = [ipaddress.ip_network(n) for n in nets]
    rows = geo_lookup(df, ["ip"], cities, countries).collect()
    assert len(rows) == len(ips)
    for row in rows:
        if row["ip"] in ("bad", None):
            assert row["ip_geo"] is None and row["ip_local"] is None
            continue
        address = ipaddress.ip_address(row["ip"])
        if row["ip_local"]:
            assert row["ip_geo"] is None
            continue
        hits = [n for n in parsed if n.version == address.version and address in n]
        best = max(hits, key=lambda n: n.prefixlen, default=None)
        if best is None:
            assert row["ip_geo"] == (None if address.version == 6 else (None, "all", "o", "1", "0.0.0.0/0"))
        else:
            assert row["ip_geo"]["network"] == str(best)
            assert row["ip_geo"]["country"] == ("all" if address.version == 4 else None)


def test_empty_networks(spark):
    none = spark.createDataFrame([], "city string, country string, org string, org_id string, network string")
    df = spark.createDataFrame([("8.8.8.8",), ("10.0.0.1",)], "ip string")
    rows = {r["ip"]: (r["ip_geo"], r["ip_local"]) for r in geo_lookup(df, ["ip"], none, none.drop("city")).collect()}
    assert rows == {"8.8.8.8": (None, False), "10.0.0.1": (None, True)}


@pytest.mark.parametrize("start,end,expected", [
    (79200, 21600, [(1320, 1440), (0, 360)]), (0, 0, [(0, 1440)]), (28800, 64800, [(480, 1080)])])
def test_split_period(spark, start, end, expected):
    row = spark.range(1).select(split_period(F.lit(start), F.lit(end)).alias("p")).first()
    assert [tuple(p) for p in row["p"]] == expected


def test_verdicts_outside_of_schedule_turn(spark, calendar):
    day = 1609722000  # Monday, 4 January 2021, 01:00 UTC
    rules = spark.createDataFrame([
        rule(1, "VpnLogon", "d", "work", intervals=[(0, 36000, 5, 2, False)]),
        rule(2, "VpnLogon", "d", "late", intervals=[(0, 1800, 5, 2, False)]),
        rule(3, "VpnLogon", "d", "calendar", intervals=[(0, 36000, 1, 1, True)], result="Restricted"),
    ], RULES)
    cases = [("work", day, "Allowed"), ("late", day, "Restricted"), ("work", day - 86400, "Restricted"),
             ("calendar", day, "Restricted"), ("calendar", day - 3 * 86400, "Allowed"), ("nobody", day, None)]
    df = with_event(
        spark.createDataFrame(cases, "n string, t long, expected string"), collector__organization="org1",
        subject__category="account", subject__domain="d", subject__name=F.col("n"), interaction__action="up",
        data__aux9="VPN", data__originTime=F.col("t"))
    for row in control(df, rules, "vpn_logon", calendar).collect():
        assert row["verdict"] == row["expected"], (row["n"], row["t"])
