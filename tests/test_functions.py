import ipaddress
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from secflow.functions import dates, enums, grok, ids, net, text


def values(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return list(row)


def test_split_host_cases(spark):
    full, short = F.lit("mail7.lab.example"), F.lit("mail7")
    cases = [(full, short, True), (short, full, True), (None, full, True), (None, short, False),
             (full, None, True), (short, None, False)]
    for fqdn, hostname, qualified in cases:
        got = values(spark, *text.split_host(fqdn, hostname))
        assert got == ["mail7.lab.example" if qualified else None, "mail7"]
    assert values(spark, *text.split_host(None, None)) == [None, None]


def test_index_title_and_metric_name(spark):
    assert values(spark, text.index_title(F.lit('A b"*\\<|,>/?c')), text.metric_name(F.lit("a.b c$d-e_1"))) == [
        "a_b_________c", "a_b_cd-e_1"]


@pytest.mark.parametrize("path,expected", [
    ("C:\\Windows\\System32\\", ["c", "windows", "system32"]), ("\\??\\c:\\a", ["c", "a"]),
    ("\\\\*\\Share", ["share"]), ("\\\\srv\\x", ["", "srv", "x"]), (None, ["*"]), ("\\", ["*"]),
])
def test_path_segments(spark, path, expected):
    assert values(spark, text.path_segments(F.lit(path).cast("string"))) == [expected]


def test_last_wins_map(spark):
    keys, vals = F.split(F.lit("a,b,a"), ","), F.split(F.lit("1,2,3"), ",")
    assert values(spark, text.last_wins_map(keys, vals)) == [{"a": "3", "b": "2"}]


def as_numbers(address):
    n = int(address)
    return (4, 0, n) if address.version == 4 else (6, n // 2**64 - 2**63, n % 2**64 - 2**63)


def test_networks_against_the_standard_library(spark):
    r = random.Random(4)
    nets = [f"{ipaddress.ip_address(r.getrandbits(32))}/{k}" for k in range(33)]
    nets += [f"{ipaddress.IPv6Address(r.getrandbits(128) | 1 << 126)}/{k}" for k in range(129)]
    df = spark.createDataFrame([(t,) for t in nets], "net string").selectExpr("net", "split(net, '/') as p")
    found = net.network_range(net.ip_number(F.col("p")[0]), F.col("p")[1].cast("int"))
    for text, x in df.select("net", found).collect():
        wanted = ipaddress.ip_network(text, strict=False)
        first, last = as_numbers(wanted[0]), as_numbers(wanted[-1])
        assert tuple(x) == (*first, *last[1:], wanted.prefixlen), text


def test_addresses_against_the_standard_library(spark):
    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.one_of(
        st.ip_addresses(v=4).map(str), st.ip_addresses(v=6).map(str),
        st.ip_addresses(v=6).map(lambda a: a.exploded),
        st.text(alphabet="0123456789abcf:.", max_size=20)), min_size=200, max_size=200))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "ip string")
        for ip, number, ok in df.select(
            "ip", net.ip_number(F.col("ip")).alias("n"), net.is_ip(F.col("ip")).alias("ok")
        ).collect():
            try:
                address = ipaddress.ip_address(ip)
            except ValueError:
                assert (number, ok) == (None, False), ip
                continue
            address = getattr(address, "ipv4_mapped", None) or address
            assert ok and tuple(number) == as_numbers(address), ip

    check()


def test_private_addresses(spark):
    cases = {"10.1.2.3": True, "172.31.0.1": True, "172.32.0.1": False, "192.168.9.9": True,
             "127.0.0.1": True, "127.0.0.2": False, "fd00::1": True, "::1": True, "8.8.8.8": False}
    df = spark.createDataFrame([(k,) for k in cases], "ip string")
    got = {r[0]: r[1] for r in df.select("ip", net.is_private_ip(F.col("ip"))).collect()}
    assert got == cases


def test_hostnames(spark):
    cases = {"a.b.com": True, "host": True, "a..b": False, "-a.com": False, "a.1": False, "a_b.org": True,
             "x" * 64: False}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    assert {r[0]: r[1] for r in df.select("h", net.is_hostname(F.col("h"))).collect()} == cases


def test_dates(spark):
    lit = F.lit
    assert values(
        spark, dates.iso_epoch(lit("2021-03-31T12:03:46+03:00")), dates.iso_epoch(lit("2021-03-31 12:03:46")),
        dates.epoch_of_units(lit("1611220095123")), dates.epoch_of_units(lit("12")),
        dates.format_epoch(lit("21-jan-2021 12:42:06"), dates.ANTIVIRUS_FORMAT),
        dates.syslog_epoch(lit("mar"), lit("18"), lit("2021"), lit("14:43:43"), lit("msk"), lit(5)),
        dates.syslog_epoch(lit("mar"), lit("12"), lit("2021"), lit("13:55:00.3"), lit("moscow"), lit(5)),
        dates.syslog_epoch(lit("xyz"), lit("12"), lit("2021"), lit("13:55:00"), lit("utc"), lit(5)),
    ) == [1617181426, None, 1611220095, None, 1611232926, 1616067823, 1615557300, 5]


def test_words(spark):
    assert enums.merge_words({"A": "x"}, {"a": "x"}) == {"a": "x"}
    with pytest.raises(ValueError):
        enums.merge_words({"A": "x"}, {"a": "y"})
    assert values(
        spark, enums.to_action(F.lit("Accept")), enums.to_action(F.lit("zzz")), enums.to_status(F.lit("GRANTED")),
        enums.to_importance(F.lit("4")), enums.protocol_name(F.lit("17")), enums.protocol_name(F.lit("iptm")),
        enums.protocol_name(F.lit("zz")), enums.cisco_importance(F.lit("9")),
    ) == ["connect", "UnknownInteractionCategory", "success", "HIGH", "UDP", "TTP/IPTM", "zz", None]


def test_access_mask_priority(spark):
    masks = {"0x10002": "remove", "0x3": "modify", "0x21": "access", "0x20": "execute", "0x80000": "grant",
             "0x100000": "sync", "0x0": "UnknownInteractionCategory", "0X40": "remove"}
    df = spark.createDataFrame([(k,) for k in masks], "m string")
    assert {r[0]: r[1] for r in df.select("m", enums.access_mask_action(F.col("m"))).collect()} == masks


def test_grok_compiles_nested_patterns_and_duplicate_fields(spark):
    known = {"A": "[a-z]+", "N": "[0-9]+", "P": "%{A:word}-%{N:num}", "D": "(?:%{A:x}|%{N:x})!"}
    assert values(spark, grok.parse_grok(F.lit("  .. ab-12 .."), "%{P}", known),
                  grok.parse_grok(F.lit("12!"), "%{D}", known), grok.parse_grok(F.lit("??"), "%{P}", known),
                  ) == [{"word": "ab", "num": "12"}, {"x": "12"}, {}]
    with pytest.raises(KeyError):
        grok.compile_grok("%{MISSING}")


def test_marks_in_a_text_feign_nothing(spark):
    known = {"A": "[a-z]+", "N": "[0-9]+", "P": "%{A:word}-%{N:num}"}
    assert values(spark, grok.parse_grok(F.lit("\x01ab\x0112"), "%{P}", known), grok.parse_grok(F.lit("\x01ab-1\x01"), "%{P}", known),
                  ) == [{}, {"word": "ab", "num": "1"}]


def test_ids(spark):
    assert values(spark, ids.content_id(F.lit("abc")), ids.md5_id(F.lit("a"), F.lit("b"))) == [
        "8eb208f7e05d987a9b044a8e98c6b087f15a0bfc", "187ef4436122d1cc2f40dc2b92f0eba0"]
