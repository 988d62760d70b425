"""Controls with strict keys: literal cases, and random rules against a walk over all rule paths."""

import random

import pytest
from pyspark.sql import functions as F
from test_enrich import FOREVER, RULES, rule, with_event

from secflow.operators.rules import Prepared
from secflow.operators.strict_rules import prepare_strict, strict_control

MONDAY = 1610960400  # 2021-01-18 09:00 UTC
EVENT_COLUMNS = "id int, org string, d string, n string, sh string, si string, dh string, di string, p string, t int"


@pytest.fixture(scope="module")
def calendar(spark):
    return spark.sql("select date'2021-01-01' as holiday")


def events(spark, rows):
    return with_event(
        spark.createDataFrame(rows, EVENT_COLUMNS), collector__organization=F.col("org"), subject__domain=F.col("d"),
        subject__name=F.col("n"), source__hostname=F.col("sh"), source__ip=F.col("si"), destination__hostname=F.col("dh"),
        destination__ip=F.col("di"), eventSource__location__hostname=F.col("sh"), eventSource__location__ip=F.col("si"),
        object__category=F.lit("file"), object__path=F.col("p"), interaction__logonType=F.col("t"),
        eventTime=F.lit(MONDAY), data__originTime=F.lit(0))


def logon(i, name, source, destination, t=2, domain="LAB", org="org1"):
    return (i, org, domain, name, *source, *destination, None, t)


def opened(i, name, path, host=("desk", None), domain="lab"):
    return (i, "org1", domain, name, *host, None, None, path, None)


def verdicts(df):
    rows = df.collect()
    return {r["id"]: (r["rule_id"], r["verdict"]) for r in rows}


def test_logons(spark, calendar):
    office = [(8 * 3600, 10 * 3600, 5, 2, False)]
    night = [(0, 3600, 5, 2, False)]
    rules = spark.createDataFrame([
        rule(1, "WindowsLogon", result="Restricted"),
        rule(2, "WindowsLogon", "lab", "root", intervals=office, aux1="2;10"),
        rule(3, "WindowsLogon", "lab", "root", destination=("vault", None), result="Restricted"),
        rule(4, "WindowsLogon", "lab", "olga", ("pc1", "10.1.0.1"), ("term", "10.1.0.9"), intervals=night),
        rule(5, "VpnLogon", "lab", "root"),
    ], RULES)
    rows = [
        logon(1, "Root", ("any", None), ("pc9", None)), logon(2, "root", (None, "1.1.1.1"), (None, "8.8.8.8"), 10),
        logon(3, "root", ("any", None), ("VAULT", None)), logon(4, "root", ("any", None), (None, "10.0.0.12")),
        logon(5, "root", ("any", None), ("pc9", None), 3), logon(6, "olga", ("pc1", None), (None, "10.1.0.9")),
        logon(7, "olga", ("pc2", None), ("term", None)), logon(8, "olga", (None, None), ("term", None)),
        logon(9, None, ("pc1", None), ("term", None)), logon(10, "root", ("a", None), ("b", None), org="org2"),
    ]
    expected = {1: (2, "Allowed"), 2: (2, "Allowed"), 3: (3, "Restricted"), 4: (2, "Allowed"), 5: (2, "Restricted"),
                6: (4, "Restricted"), 7: (1, "Restricted"), 8: (None, None), 9: (None, None), 10: (None, None)}
    df = events(spark, rows)
    assert verdicts(strict_control(df, rules, "windows_logon", calendar)) == expected
    free = verdicts(strict_control(df, rules, "windows_logon", calendar, scheduled=False))
    assert free[6] == (4, "Allowed")


def test_objects(spark, calendar):
    desk = ("desk", None)
    rules = spark.createDataFrame([
        rule(1, "WindowsObject", "lab", result="Restricted"),
        rule(2, "WindowsObject", "lab", "root", desk, path="d:\\sys", result="Restricted"),
        rule(3, "WindowsObject", "lab", "root", desk, path="d:\\sys\\net\\conf\\names"),
        rule(4, "WindowsObject", "lab", "olga", path="d:\\"),
        rule(5, "WindowsObject", "lab", "root", desk, path="d:\\"),
    ], RULES)
    rows = [opened(1, "root", "D:\\docs\\java"), opened(2, "root", "d:\\sys\\net\\"),
            opened(3, "root", "d:\\sys\\net\\conf\\names"), opened(4, "olga", "d:\\sys\\x", (None, "10.0.0.4")),
            opened(5, "olga", None, (None, "10.0.0.4")), opened(6, "olga", "d:\\a", (None, None)),
            opened(7, "root", "e:\\x"), opened(8, "root", "\\"), opened(9, "root", ""), opened(10, "root", "d:\\a", domain=None)]
    expected = {1: (5, "Allowed"), 2: (2, "Restricted"), 3: (3, "Allowed"), 4: (4, "Allowed"), 5: (1, "Restricted"),
                6: (None, None), 7: (1, "Restricted"), 8: (1, "Restricted"), 9: (1, "Restricted"), 10: (None, None)}
    df = events(spark, rows)
    assert verdicts(strict_control(df, rules, "windows_object", calendar)) == expected
    without = verdicts(strict_control(df, rules.where("rule_id > 1"), "windows_object", calendar))
    assert without[5] == (None, None) and without[2] == (2, "Restricted")


def test_prepared_and_empty(spark, calendar, tmp_path):
    rules = spark.createDataFrame([rule(7, "VpnLogon", "Lab", "Olga"), rule(8, "VpnLogon", "Lab", "Olga"),
                                   rule(9, "VpnLogon", "Lab", result=None)], RULES)
    rows = [logon(1, "Olga", ("a", None), ("b", None), domain="Lab"), logon(2, "olga", ("a", None), ("b", None), domain="Lab")]
    df = events(spark, rows + rows[:1])
    prepare_strict(rules, "vpn_logon").write(str(tmp_path))
    out = strict_control(df, Prepared.read(spark, str(tmp_path)), "vpn_logon", calendar)
    assert sorted((r["id"], r["rule_id"], r["verdict"]) for r in out.where("id = 1").collect()) == [(1, 7, "Allowed")] * 2
    assert verdicts(out)[2] == (None, None)
    for kind in ("windows_logon", "windows_object", "vpn_logon"):
        none = strict_control(df, rules.limit(0), kind, calendar)
        assert none.where("rule_id is null and verdict is null").count() == 3
        assert strict_control(df.limit(0), rules, kind, calendar).count() == 0


# Brute force: all paths of all rules are tried one by one against an event ---------------------


def fits(path, keys):
    """Wildcards of a rule path of which every part fits the event's keys so far, or None."""
    if len(path) > len(keys) or any(p not in ("*", k) for p, k in zip(path, keys)):
        return None
    return [int(p == "*") for p in path]


def choose(paths, keys):
    """``paths`` is a list of (path, rule id); prefixes of paths count as places of the tree."""
    places = {p[:i] for p, _ in paths for i in range(1, len(p) + 1)}
    inner = {p[:i] for p, _ in paths for i in range(1, len(p))}
    found = []
    for place in places:
        stars = fits(place, keys)
        if stars is None or (len(place) < len(keys) and place in inner):
            continue
        above = [(len(p), -r) for p, r in paths if place[:len(p)] == p]
        if above:
            found.append((stars, -max(above)[1]))
    return min(found)[1] if found else None


def split(path):
    return [p for p in path.lower().replace(":\\", "\\").split("\\") if p]


def test_random_objects(spark, calendar):
    rng = random.Random(5)
    names, hosts, parts = ["a", "b"], ["h1", "h2"], ["x", "y", "z"]

    def some_path():
        return "c:\\" + "\\".join(rng.choice(parts) for _ in range(rng.randint(0, 3)))

    rules, paths = [], []
    for i in range(40):
        login, host = rng.choice([*names, None]), rng.choice([*hosts, None])
        path = rng.choice([some_path(), some_path(), "c:\\x\\*", None])
        rules.append(rule(i, "WindowsObject", rng.choice(["d", None]), login, (host, None), path=path))
        base = ("org1", rules[-1][3] or "*", login or "*", host or "*", *(split(path) if path else []))
        paths += [(base, i), ((*base, "*"), i)]
    rows = [opened(i, rng.choice(names), rng.choice([some_path() + "\\w", some_path(), None]), (rng.choice(hosts), None), "d")
            for i in range(150)]
    got = verdicts(strict_control(events(spark, rows), spark.createDataFrame(rules, RULES), "windows_object", calendar))
    for r in rows:
        keys = [r[1], r[2], r[3], r[4], *(split(r[8]) if r[8] else [])]
        assert got[r[0]][0] == choose(paths, keys), r


def test_random_logons(spark, calendar):
    rng = random.Random(6)
    hosts = ["h1", "h2", None]
    rules, paths = [], []
    for i in range(30):
        side = [(rng.choice(hosts), rng.choice(["1", "2", None])) for _ in range(2)]
        rules.append(rule(i, "WindowsLogon", rng.choice(["d", None]), rng.choice(["a", "b", None]), *side, intervals=FOREVER))
        (sh, si), (dh, di) = side
        pairs = set()
        if (sh or si) and (dh or di):
            if si or di:
                pairs |= {(si, di, "I"), (si, dh, "H")}
            if sh or dh:
                pairs |= {(sh, dh, "H"), (sh, di, "I")}
        else:
            pairs |= {(si, di, "I")} if si or di or not (sh or dh) else set()
            pairs |= {(sh, dh, "H")} if sh or dh or not (si or di) else set()
        who = ("org1", rules[-1][3] or "*", rules[-1][4] or "*")
        paths += [((*who, a or "*", b or "*", k), i) for a, b, k in pairs]
    rows = [logon(i, rng.choice("abc"), (rng.choice(hosts), rng.choice("12")), (rng.choice(hosts), rng.choice("12")), domain="D")
            for i in range(150)]
    got = verdicts(strict_control(events(spark, rows), spark.createDataFrame(rules, RULES), "windows_logon", calendar))
    for r in rows:
        keys = [r[1], "d", r[3], r[4] or r[5], r[6] or r[7], "H" if r[6] else "I"]
        assert got[r[0]][0] == choose(paths, keys), r
