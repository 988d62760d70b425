"""Range segments, pruned rules, prepared versions and the shape of the enrichment plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from secflow.operators.controls import control, prepare_control
from secflow.operators.geo import lookup_ips
from secflow.operators.rules import LAST_POINT, OPEN, with_nodes
from secflow.plans.enrich import enrich_job
from secflow.session import keyed_join
from secflow.streaming.jobs import Refreshing, job_stream
from secflow.streaming.versions import current_version, publish_rules, read_rules
from tests.test_enrich import RULES, rule, with_event

RANGES = "id int, ranges array<struct<low:int,high:int>>"


@pytest.fixture(scope="module")
def calendar(spark):
    return spark.sql("select date'2021-01-01' as holiday")


def inside(point, low, high):
    if low > high:
        return point >= low if high == 0 else point >= low or point <= high
    return low <= point <= high


def test_segments_of_ranges(spark):
    r = random.Random(11)
    cases = [[], [(0, 0)], [(5, 5)], [(0, 65535)], [(16, 255)], [(15, 256)], [(70000, 2_000_000_000)], [(900, 100)], [(80000, 0)], None]
    cases += [[(r.randrange(5000), r.randrange(5000)) for _ in range(r.randint(1, 3))] for _ in range(40)]
    rows = with_nodes(spark.createDataFrame(list(enumerate(cases)), RANGES), "ranges", 0).collect()
    points = [0, 1, 15, 16, 99, 100, 101, 255, 256, 899, 900, 70000, 79999, 80000, 2_000_000_000, LAST_POINT, *[r.randrange(6000) for _ in range(60)]]
    for i, ranges in enumerate(cases):
        own = [x for x in rows if x["id"] == i]
        nodes = {(x["l0"], x["n0"]) for x in own if x["l0"] != OPEN}
        assert any(x["l0"] == OPEN and x["q0"] == 1 for x in own) == any(lo == 0 and hi >= 0 for lo, hi in ranges or ([(0, 0)] if ranges == [] else []))
        for p in points:
            hit = any((level, p >> 4 * level) in nodes for level in range(8))
            assert hit == any(inside(p, *x) for x in ([(0, 0)] if ranges == [] else ranges or [])), (ranges, p)
        if ranges and len(ranges) == 1:
            assert len(nodes) <= 2 * 15 * 8


def connections(spark, cases):
    return with_event(
        spark.createDataFrame(cases, "i int, s string, sp int, dp int"), collector__organization="org1", source__ip=F.col("s"),
        source__port=F.col("sp"), destination__port=F.col("dp"), interaction__protocol="tcp", eventSource__category="Firewall")


def port_rules(seed, n, hosts=("10.0.0.1", "10.0.0.2")):
    r = random.Random(seed)
    ranges = [None, "0", "7", "0-50", "20-60", "60-20", "100-900", "15-17,300-310", "0-65535", "5-5,6-6", "80-0"]
    return [(i, r.choice([None, *hosts]), r.choice(ranges), r.choice(ranges), r.choice(["Allowed", "Restricted"])) for i in range(n)]


def as_rules(spark, plain):
    return spark.createDataFrame([
        rule(i, "FirewallConnection", source=(None, host), aux1=a, aux2=b, result=result) for i, host, a, b, result in plain], RULES)


def winner(plain, host, *ports):
    def rank(text, point):
        pairs = [(int(x.split("-")[0]), int(x.split("-")[-1])) for x in text.split(",")] if text else [(0, 0)]
        if any(inside(point, *x) for x in pairs):
            return 0
        return 1 if any(lo == 0 and hi >= 0 for lo, hi in pairs) else None

    fits = []
    for i, own, *ranges, _ in plain:
        ranks = [rank(text, p) for text, p in zip(ranges, ports, strict=True)]
        if own in (None, host) and None not in ranks:
            fits.append((own is None, *ranks, i))
    return min(fits)[-1] if fits else None


def test_two_ranges_against_brute_force(spark, calendar, tmp_path):
    r = random.Random(5)
    plain = port_rules(6, 90)
    cases = [(i, r.choice(["10.0.0.1", "10.0.0.2", "10.0.0.3"]), r.choice([0, 5, 7, 16, 20, 60, 305, 70, r.randrange(70000)]), r.choice([0, 6, 17, 50, 500, r.randrange(70000)]))
             for i in range(300)]
    prepared = prepare_control(as_rules(spark, plain), "connection")
    prepared.write(str(tmp_path))
    read = type(prepared).read(spark, str(tmp_path))
    for rules in (prepared, read):
        for row in control(connections(spark, cases), rules, "connection", calendar).collect():
            assert row["rule_id"] == winner(plain, row["s"], row["sp"], row["dp"]), row


def test_one_best_rule_for_each_spot(spark):
    """Rules that another one beats everywhere are left out, however many share a key and a range."""
    plain = [(i, None, "0-4095", "7", "Allowed") for i in range(500)] + [(500, None, None, None, "Allowed")]
    best = prepare_control(as_rules(spark, plain), "connection").best
    spots = best.groupBy("_k", "node", "l0", "n0", "l1", "n1").count()
    assert spots.agg(F.max("count")).first()[0] == 1
    assert best.count() <= 8 and {r[0] for r in best.select("rule.rule_id").collect()} == {0, 500}


def test_prepared_rules_carry_what_the_verdict_reads(spark):
    rules = as_rules(spark, port_rules(2, 5))
    carried = {kind: prepare_control(rules, kind).best.select("rule.*").columns for kind in ("connection", "windows_object", "vpn_logon", "windows_logon")}
    assert carried == {
        "connection": ["q0", "q1", "rule_id", "result"], "windows_object": ["q0", "rule_id", "result"],
        "vpn_logon": ["q0", "rule_id", "result", "intervals"], "windows_logon": ["q0", "rule_id", "result", "intervals", "aux1"]}


def test_keys_name_the_forms_of_the_best_rules(spark):
    prepared = prepare_control(as_rules(spark, port_rules(3, 120) + [(500, None, "x", "7", "Allowed"), (501, "10.0.0.9", "x", "7", "Allowed")]), "connection")
    forms = {tuple(r) for r in prepared.keys.selectExpr("_k", "explode(forms) as f").select("_k", "f.*").collect()}
    assert forms == {tuple(r) for r in prepared.best.select("_k", "shape", "l0", "l1").distinct().collect()}
    assert prepared.keys.count() == prepared.best.select("_k").distinct().count() == 3


def test_rules_are_not_broadcast_by_the_size_of_their_file(spark, calendar, tmp_path):
    """A file of some kilobytes makes segments of many megabytes; which side is small is only known by measure."""
    plain = [(i, None, f"{i + 1}-{i + 900}", f"{3 * i + 1}-{3 * i + 900}", "Allowed") for i in range(200)]
    as_rules(spark, plain).coalesce(1).write.parquet(str(tmp_path / "rules"))
    spark.createDataFrame([(i, "10.0.0.1", i, 3 * i) for i in range(300)], "i int, s string, sp int, dp int").write.parquet(str(tmp_path / "events"))
    prepared = prepare_control(spark.read.parquet(str(tmp_path / "rules")), "connection")
    estimate = int(str(prepared.best._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert estimate > max(100 * prepared.best.count(), 10 << 20)
    cases = spark.read.parquet(str(tmp_path / "events"))
    done = control(with_event(
        cases, collector__organization="org1", source__ip=F.col("s"), source__port=F.col("sp"), destination__port=F.col("dp"),
        interaction__protocol="tcp", eventSource__category="Firewall"), prepared, "connection", calendar)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"SortMergeJoin \[_k#", plan)) == 2 and not re.search(r"BroadcastHashJoin \[_k#", plan)
    for row in done.collect():
        assert row["rule_id"] == winner(plain, row["s"], row["sp"], row["dp"]), row


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(4000).withColumn("k", F.when(F.col("id") < 3, F.col("id")))
    found = spark.range(2).select(F.col("id").alias("k2"), F.lit("x").alias("v"))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = keyed_join(left, found, {"k2": F.col("k")})
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 2000 and sum(sizes) == 4000
        assert out.where("v is not null").count() == 2 and out.columns == ["id", "k", "v"]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_networks_over_cuts(spark):
    """A network that reaches over many ranges of the sweep is found in all of them."""
    ips = [f"{a}.{b}.1.1" for a in range(20, 60) for b in (0, 128, 255)] + ["2001:db8::1", "2001:db9::1"]
    cities = spark.createDataFrame([("wide", "32.0.0.0/4"), ("inner", "33.128.0.0/16"), ("all", "0.0.0.0/0"), ("six", "2001:db8::/32")], "city string, network string")
    found = {r["ip"]: r["geo"]["city"] if r["geo"] else None for r in lookup_ips(
        spark.createDataFrame([(x,) for x in ips], "ip string"), cities, cities.where("false").drop("city"), buckets=16).collect()}
    for ip in ips:
        a, b = (ip.split(".") + ["", ""])[:2]
        wanted = ("six" if ip == "2001:db8::1" else None) if ":" in ip else "inner" if (a, b) == ("33", "128") else "wide" if 32 <= int(a) < 48 else "all"
        assert found[ip] == wanted, ip


def dims(spark):
    geo = spark.createDataFrame([], "city string, country string, org string, org_id string, network string")
    logins = spark.createDataFrame([], "org string, domain string, login string, group_id int, start_work timestamp")
    schedules = spark.createDataFrame([], "group_id int, time_from int, time_to int, days_work int, days_weekend int, is_calendar boolean")
    return geo, logins, schedules


def test_the_event_is_exchanged_once(spark, calendar, tmp_path):
    spark.range(3).selectExpr("id", "'wide' as payload").write.parquet(str(tmp_path / "in"))
    df = with_event(spark.read.parquet(str(tmp_path / "in")), collector__organization="o", source__ip=F.col("payload"))
    geo, logins, schedules = dims(spark)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        done = enrich_job(df, geo, geo.drop("city"), as_rules(spark, port_rules(1, 5)), logins, schedules, calendar)
        plan = done._jdf.queryExecution().explainString(done._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)", plan)
    wide = [x for x in exchanges if re.search(r"\bid#", x)]
    assert len(wide) == 1, len(wide)


def test_batches_read_the_newest_version(spark, calendar, tmp_path):
    folder, source = str(tmp_path / "rules"), tmp_path / "in"
    seen = {}

    def job(batch, rules):
        return control(connections(spark, []).drop("event").unionByName(batch.select("i", "s", "sp", "dp")).transform(
            lambda d: with_event(d, collector__organization="org1", source__ip=F.col("s"), source__port=F.col("sp"),
                                 destination__port=F.col("dp"), interaction__protocol="tcp", eventSource__category="Firewall")),
            rules["connection"], "connection", calendar)

    def write(out, batch_id):
        seen.update({r["i"]: r["verdict"] for r in out.collect()})

    assert current_version(spark, folder) is None
    refreshed = Refreshing(lambda: read_rules(spark, folder), ttl=0)
    for k, result in enumerate(("Allowed", "Restricted")):
        version = publish_rules(as_rules(spark, [(1, None, None, "443", result)]), folder)
        assert version == current_version(spark, folder) == k + 1
        spark.createDataFrame([(k, "10.0.0.1", 5, 443)], "i int, s string, sp int, dp int").write.mode("append").json(str(source))
        stream = spark.readStream.schema("i int, s string, sp int, dp int").json(str(source))
        job_stream(stream, job, {"rules": refreshed}, write, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert seen == {0: "Allowed", 1: "Restricted"}
    assert set(read_rules(spark, folder, 1)) == {"windows_logon", "windows_object", "vpn_logon", "connection"}
