"""Sources, sinks, scripts, stores and streaming."""

import hashlib
import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from secflow.operators.archive import read_day, register_partitions, upsert_latest, write_archive
from secflow.operators.hops import hop_delay
from secflow.operators.reassemble import dead_letters, merge_chain, reassemble
from secflow.operators.route import route, with_topic
from secflow.operators.rule_loading import merge_ranges, number_rows, resolve
from secflow.operators.scripts import ScriptChain, apply_scripts, failed_scripts, keep_approved, lens
from secflow.schema import EVENT, build
from secflow.sources.readers import decode_by_topic, read_calendar, read_rules_csv, read_text, read_text_stream
from secflow.sources.sinks import start_sink, write_batch, write_search_docs
from secflow.streaming.jobs import (
    ProgressLog, Refreshing, compact_store, job_stream, read_store, reassembly_queries, store_stream)


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="secflow-test-")


def test_lens():
    event = {"a": {"b": 1}}
    assert lens("a.b")(event) == 1 and lens("a.x.y")(event) is None
    assert lens("a.b")(event, andThen=lambda v: v + 1) == 2 and lens("q")(event, andThen=lambda v: 1 / 0) is None
    lens("n.m")(event, value=5)
    assert event == {"a": {"b": 1}, "n": {"m": 5}}


def test_script_chain_stops_at_first_rejection():
    chain = ScriptChain([("one", "event['x'] = 1\nreturn (event, event['id'] > 1)"),
                         ("two", "event['y'] = 2\nreturn (event, True)")])
    assert chain({"id": 1}) == ({"id": 1, "x": 1}, False)
    assert chain({"id": 2}) == ({"id": 2, "x": 1, "y": 2}, True)


def test_scripts_over_frames(spark):
    df = spark.createDataFrame([(i, json.dumps({"id": i, "n": {"ü": "é"}})) for i in range(4)], "i int, value string")
    out = apply_scripts(df, [("f", "return (event, event['id'] % 2 == 0)")])
    assert {r["i"] for r in keep_approved(out).collect()} == {0, 2}
    assert json.loads(out.where("i = 3").first()["value"]) == {"id": 3, "n": {"ü": "é"}}
    assert apply_scripts(df, []).where("keep").count() == 4


def test_scripts_never_end_the_job(spark):
    texts = ['{"id": 1}', None, "no json", "[1]", '{"other": 2}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    out = apply_scripts(df, [("f", "return (event, event['id'] == 1)")])
    assert [r["i"] for r in keep_approved(out).collect()] == [0]
    failed = {r["i"]: (r["value"], r["script_error"]) for r in failed_scripts(out).collect()}
    assert set(failed) == {1, 2, 3, 4} and failed[1] == (None, "not a JSON object") and failed[3][0] == "[1]"
    assert failed[2][1].startswith("JSONDecodeError") and failed[4] == ('{"other": 2}', "KeyError: 'id'")


def test_routing_order(spark):
    rows = [("a", "o1"), ("b", "o1"), ("c", "o1"), ("d", "o1"), ("a", "o2")]
    df = spark.createDataFrame(rows, "dev_type string, organization string").withColumn("malformed", F.lit(False))
    out = route(df.withColumn("value", F.lit("v")), {"A": "ta", "o1.B": "tb", "O1.any": "tany", "d": "td"}, drop=["d"])
    got = {(r["dev_type"], r["organization"]): (r["route_state"], r["topic"]) for r in out.collect()}
    assert got == {("a", "o1"): ("sent", "ta"), ("b", "o1"): ("sent", "tb"), ("c", "o1"): ("sent", "tany"),
                   ("d", "o1"): ("dropped", None), ("a", "o2"): ("sent", "ta")}
    with pytest.raises(Exception, match="no topic for state"):
        with_topic(spark.createDataFrame([("raw",)], "state string"), {"chain": "c"}).collect()


def test_hop_delay_sample(spark):
    chain = {"number": 3, "n1": {"number": 1, "rt": 100}, "n2": {"number": 2, "rt": 250}}
    df = spark.createDataFrame([("org", 1, json.dumps(chain))], "organization string, event_time long, chain string")
    got = {(r["hop_in"], r["hop_out"]): r["delay_us"] for r in hop_delay(df).collect()}
    assert got == {("n1", "n2"): 150, ("org", "n1"): 100 - 1_000_000}


def test_upsert_keeps_last_write(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 3, 5), ("b", 4, 5)], "id string, v int, write_ts long")
    assert {r["id"]: r["v"] for r in upsert_latest(df).collect()} == {"a": 2, "b": 4}


def test_archive_round_trip(spark, folder):
    df = spark.createDataFrame([("o1", 1609459199, 1), ("o1", 1609459200, 2), ("o2", 1609459200, 3)],
                               "org string, t long, v int")
    write_archive(df, f"{folder}/arc", "org", "t")
    back = spark.read.orc(f"{folder}/arc")
    assert {(r["sys_org"], r["sys_year"], r["sys_month"], r["sys_day"], r["v"]) for r in back.collect()} == {
        ("o1", 2020, 12, 31, 1), ("o1", 2021, 1, 1, 2), ("o2", 2021, 1, 1, 3)}
    spark.sql("drop table if exists arc_table")
    spark.sql(f"create table arc_table (org string, t bigint, v int, sys_org string, sys_year int, sys_month int, "
              f"sys_day int) using orc partitioned by (sys_org, sys_year, sys_month, sys_day) location '{folder}/arc'")
    assert sorted(register_partitions(spark, "arc_table", f"{folder}/arc", "2021-01-01T00:00:00Z")) == ["o1", "o2"]
    assert spark.table("arc_table").count() == 2
    spark.sql("drop table arc_table")
    day = read_day(df.withColumn("ms", F.col("t") * 1000), "2021-01-01", "ms")
    assert {r["v"] for r in day.collect()} == {2, 3}


def test_day_filter_reaches_the_scan(spark, folder):
    spark.range(10).withColumnRenamed("id", "ms").write.parquet(f"{folder}/p")
    plan = read_day(spark.read.parquet(f"{folder}/p"), "1970-01-01", "ms")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ms,0)" in plan and "LessThan(ms,86400000)" in plan


def test_port_ranges_and_numbering(spark):
    df = spark.createDataFrame([("a", 22), ("a", 23), ("a", 24), ("a", 80), ("a", 22), ("b", None)], "k string, p int")
    assert {r["k"]: r["r"] for r in merge_ranges(df, ["k"], "p", "r").collect()} == {"a": "22-24,80", "b": None}
    numbered = number_rows(spark.range(500).withColumnRenamed("id", "x"), ["x"], F.lit(7))
    assert sorted(r["id"] for r in numbered.collect()) == list(range(8, 508))


def test_resolve_treats_null_as_a_key(spark):
    existing = spark.createDataFrame([(3, "a", None), (4, "a", None), (5, "b", "x")], "id int, p string, q string")
    wanted = spark.createDataFrame([("a", None), ("b", None), ("b", "x"), ("a", None)], "p string, q string")
    got = {(r["p"], r["q"]): (r["id"], r["created"]) for r in resolve(existing, wanted, ["p", "q"]).collect()}
    assert got == {("a", None): (3, False), ("b", "x"): (5, False), ("b", None): (6, True)}


def test_files(spark, folder):
    with open(f"{folder}/cal.json", "w") as f:
        json.dump({"holidays": ["2019-05-01", "2020-01-01", "2021-01-01", "2021-01-01"]}, f, indent=1)
    days = read_calendar(spark, f"{folder}/cal.json", "2021-06-01")
    assert sorted(str(r[0]) for r in days.collect()) == ["2020-01-01", "2021-01-01"]
    with open(f"{folder}/r.csv", "w") as f:
        f.write("org,hostname,ip,username,domain,logontype,fromHost,fromTime,toTime,isWeekendAllowed\n"
                'o,"h,1",,u,d,2,,8,18,true\n')
    row = read_rules_csv(spark, f"{folder}/r.csv", "logon").first()
    assert row["hostname"] == "h,1" and row["ip"] is None and row["fromTime"] == 8 and row["isWeekendAllowed"]
    with open(f"{folder}/bad.csv", "w") as f:
        f.write("org,hostname,ip,username,domain,logontype,fromHost,fromTime,toTime,isWeekendAllowed\no,h,i,u,d,2,x,eight,1,true\n")
    with pytest.raises(Exception):
        read_rules_csv(spark, f"{folder}/bad.csv", "logon").collect()


def test_topics_and_documents(spark, folder):
    df = spark.createDataFrame([(None, '{"id":"1"}', "Acme"), (None, '{"rawId":"2"}', "chain")],
                               "key string, value string, topic string")
    write_batch(df, "parquet", f"{folder}/m")
    back = read_text(spark, "parquet", path=f"{folder}/m")
    parts = decode_by_topic(back, {"acme": EVENT})
    assert [r["event"]["id"] for r in parts["acme"].collect()] == ["1"]
    event = build(EVENT, {"id": F.lit("x"), "eventSource.title": F.lit("A b"), "data.time": F.lit(0)})
    write_search_docs(spark.range(1).select(event.alias("event")), f"{folder}/docs")
    doc = spark.read.json(f"{folder}/docs").first()
    assert doc["index_name"] == "a_b-01.01.1970/normalized"
    assert json.loads(doc["doc"]) == {"id": "x", "eventSource": {"title": "A b"}, "data": {"time": 0},
                                      "@timestamp": "1970-01-01T00:00:00Z"}


def audit_message(t, audit_id, line, **extra):
    return json.dumps({
        "EventReceivedTime": f"2021-01-01T00:00:{t % 60:02d}Z", "chain": {"a": {"number": 1}}, "EventTime": "e",
        "MessageSourceAddress": "10.0.0.1", "Hostname": "h", "SourceName": "s", "DevCat": "c", "DevSubCat": "d",
        "DevType": "auditd", "Organization": "o", "OrgID": 1, "raw": f"type=X msg=audit({1609459200 + t}.5:{audit_id}): {line}",
        **extra})


MESSAGES = [audit_message(1, 7, "b"), audit_message(2, 7, "a"), audit_message(2, 7, "a"), audit_message(3, 8, "z"),
            audit_message(40, 7, "next window"), "broken", audit_message(5, 9, "no header", raw="nothing"),
            audit_message(600, 1, "moves the watermark")]


def test_reassembly_batch(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    got = {(r["audit_id"], r["window_start"]): r["raw"] for r in reassemble(df).collect()}
    start = 1609459200
    assert got[("7", start)].split("\n") == [
        f"type=X msg=audit({start + 1}.5:7): b", f"type=X msg=audit({start + 2}.5:7): a"]
    assert set(got) == {("7", start), ("8", start), ("7", start + 30), ("1", start + 600)}
    assert [tuple(r) for r in dead_letters(df, algo="md5").collect()] == [
        (hashlib.md5(b"broken").hexdigest(), "broken", "not a JSON object")]
    value = json.loads(merge_chain(reassemble(df)).first()["value"])
    assert value["chain"] == {"a": {"number": 1}} and value["DevType"] == "reassembledAuditD01"


def test_reassembly_stream_equals_batch(spark, folder):
    source, sink = f"{folder}/in", f"{folder}/out"
    rows = spark.createDataFrame([(None, m, "t") for m in MESSAGES], "key string, value string, topic string")
    rows.coalesce(1).write.parquet(source)
    stream = read_text_stream(spark, "parquet", path=source)
    for query in reassembly_queries(stream, "json", f"{folder}/ck", sink, available_now=True):
        query.awaitTermination(60)
    done = spark.read.json(f"{sink}/records")
    batch = merge_chain(reassemble(rows))
    closed = [json.loads(r["value"]) for r in batch.collect() if "watermark" not in r["value"]]
    assert sorted(r["value"] for r in done.collect()) == sorted(
        json.dumps(v, separators=(",", ":")) for v in closed)
    assert spark.read.json(f"{sink}/errors").count() == 1


def test_job_stream_refreshes_dimensions(spark, folder):
    spark.range(10).selectExpr("cast(null as string) key", "cast(id as string) value", "'t' topic").write.parquet(
        f"{folder}/in")
    clock = iter(range(0, 1000, 5))
    loads = []
    dimension = Refreshing(lambda: loads.append(1) or len(loads), ttl=8, clock=lambda: next(clock))
    assert [dimension.get() for _ in range(4)] == [1, 1, 2, 2]
    log = ProgressLog(spark, f"{folder}/progress")
    spark.streams.addListener(log)
    stream = read_text_stream(spark, "parquet", path=f"{folder}/in")
    query = job_stream(
        stream, lambda batch, d: batch.withColumn("d", F.lit(d)), {"d": dimension},
        lambda out, n: out.write.mode("overwrite").parquet(f"{folder}/out/batch={n}"), f"{folder}/ck",
        available_now=True)
    query.awaitTermination(60)
    for _ in range(60):  # reports arrive some time after the query has ended
        if os.path.exists(f"{folder}/progress/_SUCCESS") and log.frame().count():
            break
        time.sleep(0.5)
    spark.streams.removeListener(log)
    assert spark.read.parquet(f"{folder}/out").count() == 10
    assert log.frame().agg(F.sum("input_rows")).first()[0] == 10


def test_store_stream_keeps_the_last_write(spark, folder):
    writes = [("a", 1, "x"), ("b", 5, "y"), ("a", 9, "new"), ("a", 3, "late"), ("c", 2, "z"), ("b", 6, "newer")]
    for n, part in enumerate((writes[:3], writes[3:])):
        spark.createDataFrame(part, "id string, write_ts long, v string").coalesce(1).write.parquet(f"{folder}/in/part={n}")
    schema = "id string, write_ts long, v string"
    for n in range(2):
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in/part={n}")
        store_stream(stream, f"{folder}/store/{n}", f"{folder}/ck{n}", available_now=True).awaitTermination(60)
    whole = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    store_stream(whole, f"{folder}/all", f"{folder}/ck", available_now=True).awaitTermination(60)
    want = {("a", 9, "new"), ("b", 6, "newer"), ("c", 2, "z")}
    assert {tuple(r) for r in read_store(spark, f"{folder}/all").select("id", "write_ts", "v").collect()} == want
    compact_store(spark, f"{folder}/all", f"{folder}/small")
    assert {tuple(r) for r in read_store(spark, f"{folder}/small").select("id", "write_ts", "v").collect()} == want
