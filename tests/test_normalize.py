"""Parse, validate and map one record at a time, the way devices write them."""

import json
import time

import pytest
from pyspark.sql import functions as F

from secflow.operators.normalize import mappers_with
from secflow.operators.parsers import parse_audit
from secflow.operators.states import shift_time, split_states
from secflow.operators.stats import pipeline_stats
from secflow.plans.normalize import PIPELINES, parsed_and_validated

CHAIN = {"number": 1, "a": {"modname": "m1", "modtype": "t", "number": 1, "fqdn": "col.example.org", "ip": "1.1.1.2",
                            "rt": 4}}


def envelope(kind, raw, **extra):
    return json.dumps({
        "raw": raw, "EventReceivedTime": "2021-03-18T12:00:00+00:00", "Organization": "org1", "DevType": kind,
        "Severity": "s", "SeverityValue": 2, "MessageSourceAddress": "127.0.0.1", "eventHostname": "gate4.lab.example",
        "chain": {k: v for k, v in CHAIN.items() if k != "number"}, **extra})


WINDOWS = {"EventTime": "2022-08-19T21:40:05+02:00", "Hostname": "h1.dom", "TargetUserName": "u@D.ORG",
           "ServiceName": "SRV$", "Status": "0x0", "SeverityValue": 2, "IpAddress": "::ffff:10.2.3.4", "IpPort": "5394"}
AV = {"ID": 1, "DetectionTime": "2021-01-21T12:00:00+03:00", "EventTime": "x", "EventType": "x", "SensorName": "s",
      "ModuleName": "m", "Severity": "critical", "Organization": "o", "TypeActivity": "NetworkAttack", "Block": 1,
      "Deleted": 0, "SourceIP": "10.0.0.1", "IP": "10.0.0.2", "HostName": "a~b", "UserName": "usr"}
RECORDS = {
    "login_failed": ("ios", "<164>71: 903: feb 7 09:05:31.120 msk: %sec_login-4-login_failed: login failed [user: ] "
                     "[source: 10.44.5.17] [localport: 2022] [reason: wrong passphrase] at 09:05:31 msk "
                     "sun feb 7 2021"),
    "ssh": ("ios", "<189>4410: *feb 9 22:30:15.007 msk: %ssh-5-ssh2_userauth: user '' authentication for ssh2 "
            "session from 10.44.6.18 (tty = 3) using crypto cipher 'aes128-cbc', hmac 'hmac-md5' failed"),
    "ban": ("fail2ban", "1 2021-02-11t08:20:04.500000+03:00 gate7 fail2ban-log - - - 2021-02-11 08:20:03,999 "
            "fail2ban.actions        [815]: notice  [postfix] ban 203.0.113.45"),
    "execve": ("audit", 'node=n1 type=EXECVE msg=audit(1612800000.250:901): argc=3 a0="tar" a1="-xf" a2="/tmp/b.tgz"'),
    "avc": ("audit", 'node=n2 type=AVC msg=audit(1612800060.125:902): avc:  denied  { read } for  pid=711 '
            'comm="cupsd" name="spool" dev=sdb1 ino=8080 tclass=file'),
    "add_group": ("audit", "node=n2 type=ADD_GROUP msg=audit(1612800120.500:903): pid=640 uid=0 auid=7 ses=12 subj=k "
                  "msg='op=new team id=2117 exe=\"/opt/bin/mkgroup\" hostname=? addr=10.44.7.19 "
                  "terminal=tty4 res=success'"),
    "syscall": ("audit", 'type=SYSCALL msg=audit(1.2:3): syscall=59 success=yes exit=0 euid=5 comm="x" pid=9\n'
                'type=CWD msg=audit(1.2:3): cwd="/"\ntype=PATH msg=audit(1.2:3): name="/b"\n'
                'type=PATH msg=audit(1.2:3): name="/a"'),
    "asa": ("asa", "<166>:Feb 07 11:40:02 MSK: %ASA-sys-6-605005: Login permitted from 198.51.100.7/40404 to "
            'outside:203.0.113.9/ssh for user "vera_n"'),
    "serial": ("asa", '<166>Nov 05 2019 06:17:44: %ASA-6-605005: Login permitted from serial to console for user "mira"'),
    "firewall": ("firewall", '<189>eventtime=1611220095 logid="13" type="event" subtype="vpn" remip=10.0.0.1 '
                 'action="tunnel-up" level="alert" user="bob@corp" msg="up and running"'),
    "ticket": ("windows", {**WINDOWS, "EventID": 4769}),
    "logon": ("windows", {**WINDOWS, "EventID": 4624, "LogonType": 2, "TargetUserName": "u"}),
    "attack": ("connector_a", AV),
    "scan": ("connector_b", {**AV, "TypeActivity": "x", "ObjectPath": "/x"}),
    "website": ("json_antivirus", "av {\"event_type\":\"FilteredWebsites_Event\",\"ipv4\":\"10.1.1.2\",\"occured\":"
                "\"21-jan-2021 12:42:06\",\"severity\":\"information\",\"target_address\":\"8.8.8.8\",\"user\":\"\"}"),
    "no_audit_type": ("audit", "type=BOGUS msg=audit(1.2:3): a=b"),
    "bad_ip": ("audit", "type=USER_LOGIN msg=audit(1.2:3): addr=999.1.1.1 rport=x1"),
    "machine": ("windows", {**WINDOWS, "EventID": 4624, "LogonType": 3, "TargetUserName": "pc$"}),
    "bad_mask": ("windows", {**WINDOWS, "EventID": 4663, "AccessMask": "77"}),
    "wrong_kind": ("windows", "just text"),
    "unknown_type": ("nobody", "x"),
}


@pytest.fixture(scope="module")
def result(spark):
    rows = [(name, envelope(kind, raw)) for name, (kind, raw) in RECORDS.items()]
    rows += [("broken", "nope{"), ("bad_org", envelope("asa", "x", Organization="zz")),
             ("bad_host", envelope("asa", "x", MessageSourceAddress="1.1.1"))]
    ddl = ("organization string, dev_type string, parser_name string, parser_version int, validator_name string, "
           "validator_version int, mapper_name string, mapper_version int")
    prefs = spark.createDataFrame([("org1", k, *p[0], *p[1], *p[2]) for k, p in PIPELINES.items()], ddl)
    vendor = spark.createDataFrame(
        [(k, "V", f"P {k}", "1") for k in PIPELINES],
        "dev_type string, vendor string, product string, product_version string")
    df = parsed_and_validated(spark.createDataFrame(rows, "name string, value string"), prefs, vendor,
                              mappers=mappers_with({"59": "execute"}, {"59": "application"}))
    path = f"/tmp/secflow-test-{id(result)}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def rows(result):
    return {r["name"]: r for r in result.collect()}


def test_outcomes(rows):
    invalid = {"no_audit_type", "bad_ip", "machine", "bad_mask", "unknown_type", "bad_org", "bad_host"}
    errors = {"wrong_kind", "broken"}
    for name, row in rows.items():
        expected = "error" if name in errors else "invalid" if name in invalid else "valid"
        assert row["outcome"] == expected, (name, row["error"], row["reasons"], row["envelope_reasons"])


def test_messages(rows):
    assert rows["bad_ip"]["reasons"] == ["Field addr should be a valid ip address", "Field rport should be a valid port"]
    assert rows["machine"]["reasons"] == ["Windows local machine authentications should be filtered out"]
    assert rows["bad_mask"]["reasons"] == ["Field AccessMask fits 0x00 hex number format if present"]
    assert rows["bad_org"]["envelope_reasons"][0].startswith("Organization is inactive")
    assert rows["bad_host"]["envelope_reasons"] == ["eventHostIP is correct IP address"]
    assert rows["wrong_kind"]["error"] == "expected a payload of kind object"


EXPECTED = {
    "login_failed": {"interaction.action": "login", "interaction.status": "failure", "interaction.importance": "MEDIUM",
                     "interaction.reason": "wrong passphrase", "subject.category": "account",
                     "subject.name": None, "source.ip": "10.44.5.17", "destination.ip": "127.0.0.1",
                     "destination.hostname": "gate4", "destination.fqdn": "gate4.lab.example", "destination.port": 2022,
                     "data.msgId": "sec_login-4-login_failed", "data.originTime": 1612677931,
                     "data.time": 1616068800},
    "ssh": {"interaction.status": "failure", "interaction.importance": "INFO", "subject.name": None,
            "source.ip": "10.44.6.18", "data.originTime": 1612899015},
    "ban": {"interaction.importance": "INFO", "interaction.action": "deny", "interaction.status": "success",
            "source.ip": "203.0.113.45", "data.msgId": "fail2ban.actions", "data.aux1": "postfix", "data.aux2": "ban",
            "object.name": "fail2ban"},
    "execve": {"object.category": "command", "object.name": "tar", "object.property": "3",
               "object.value": "tar -xf /tmp/b.tgz", "interaction.action": "execute",
               "interaction.status": "success", "data.msgId": "EXECVE"},
    "avc": {"object.category": "file", "interaction.action": "check", "interaction.status": "failure",
            "data.aux2": "711", "data.aux4": "sdb1", "data.aux6": "cupsd",
            "data.aux8": "dev=sdb1 ino=8080 tclass=file", "subject.category": "system"},
    "add_group": {"object.id": "2117", "object.category": "userGroup", "interaction.action": "create",
                  "interaction.status": "success", "data.originTime": 1612800120, "data.aux1": "7",
                  "data.aux2": "640", "data.aux4": "12", "data.aux5": "k", "data.aux6": "/opt/bin/mkgroup",
                  "data.aux7": "tty4", "source.ip": "10.44.7.19", "source.hostname": None},
    "syscall": {"data.msgId": "SYSCALL", "interaction.action": "execute", "object.category": "application",
                "interaction.status": "success", "interaction.reason": "0", "subject.id": "5",
                "subject.category": "account", "object.name": "x", "data.aux2": "9", "data.aux3": "/a",
                "data.aux4": "/b", "data.originTime": 1},
    "asa": {"interaction.action": "login", "source.port": 40404, "destination.ip": "203.0.113.9",
            "subject.name": "vera_n", "data.aux10": "ssh", "data.originTime": 1612687202},
    "serial": {"subject.name": "mira", "source.ip": None, "data.originTime": 1572934664},
    "firewall": {"interaction.action": "up", "interaction.importance": "HIGH", "subject.name": "bob",
                 "subject.domain": "corp", "source.ip": "10.0.0.1", "data.aux9": "vpn",
                 "data.aux1": "up and running", "data.originTime": 1611220095},
    "ticket": {"subject.name": "u", "object.name": "SRV$", "interaction.status": "success", "source.port": 5394,
               "destination.fqdn": "h1.dom", "destination.ip": None, "data.originTime": 1660938005},
    "logon": {"source.ip": "127.0.0.1", "destination.ip": "127.0.0.1", "source.hostname": "h1", "source.port": None,
              "interaction.logonType": 2, "object.category": "host"},
    "attack": {"subject.name": None, "object.name": "usr", "object.category": "account", "source.ip": "10.0.0.1",
               "destination.ip": "10.0.0.2", "destination.hostname": "a", "interaction.action": "lock",
               "normalizerVersion": 2},
    "scan": {"subject.name": "usr", "object.category": "file", "object.path": "/x", "destination.ip": None,
             "source.hostname": "a~b"},
    "website": {"interaction.action": "lock", "source.ip": "10.1.1.2", "destination.ip": "8.8.8.8",
                "object.category": "process", "data.msgId": "filteredwebsites_event"},
}


@pytest.mark.parametrize("name", EXPECTED)
def test_canonical_fields(rows, name):
    for path, expected in EXPECTED[name].items():
        value = rows[name]["event"]
        for part in path.split("."):
            value = None if value is None else value[part]
        assert value == expected, path


def test_states_and_statistics(result):
    states = split_states(result)
    counts = {r["state"]: r["n"] for r in states.groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert counts == {"normalized": 15, "raw": 22, "chain": 22, "invalid": 7, "error": 2}
    payloads = [F.col(s).isNotNull().cast("int") for s in ("normalized", "raw", "chain", "invalid", "error")]
    assert states.where(sum(payloads) != 1).count() == 0
    stats = pipeline_stats(states, now=F.lit(1616068800))
    total = stats.agg(F.sum("messages"), F.sum("out_of_time"), F.min("bytes")).first()
    assert total[0] == 68 and total[1] == 59 and total[2] > 0
    moved = shift_time(states, "shift", 10).where("state = 'normalized'").select("normalized.data.time")
    assert {r[0] for r in moved.collect()} == {1616068810}


def test_audit_records_of_any_length(spark):
    """All values of each key in their order; four times the lines take some four times as long."""
    def record(lines):
        return "\n".join(f'type=PATH msg=audit(1.2:3): name="/p{i}" k{i % 700}={i}' for i in range(lines))

    def parsed(lines):
        df = spark.createDataFrame([(record(lines),)] * 4, "raw string").select(parse_audit(F.col("raw")).alias("f"))
        start = time.perf_counter()
        rows = df.collect()
        return rows[0]["f"], time.perf_counter() - start

    parsed(10)
    _, short = parsed(500)
    fields, long = parsed(2000)
    assert fields["name"] == [f"/p{i}" for i in range(2000)] and fields["type"] == ["PATH"] * 2000
    assert fields["k5"] == ["5", "705", "1405"] and fields["k699"] == ["699", "1399"] and len(fields["msg_timestamp"]) == 2000
    assert long < 12 * short + 2


def test_audit_record_without_a_word(spark):
    assert spark.createDataFrame([("",)], "raw string").select(parse_audit(F.col("raw")).alias("f")).first()["f"].get("type") is None
