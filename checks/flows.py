"""Routing, scripts, hop delays, reassembly, keyed store, archive, documents and rule files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.enrichment import staff_dims
from checks.tables import E_SQL, HOST_IP, ORG, canonical, events, iso, s, table
from secflow.functions.text import index_title
from secflow.operators.archive import read_day, upsert_latest, with_partitions, write_archive
from secflow.operators.documents import to_documents
from secflow.operators.envelope import parse_route_key
from secflow.operators.hops import hop_delay, mean_hop_delay
from secflow.operators.reassemble import dead_letters, merge_chain, reassemble
from secflow.operators.route import route
from secflow.operators.rule_loading import load_connection_rules, load_logon_rules, load_object_rules, merge_ranges
from secflow.operators.scripts import apply_scripts, keep_approved
from secflow.operators.stats import filter_counts, filter_stats, routing_stats, routing_totals
from secflow.plans.flows import (
    archive_job, filter_job, filter_rows, monitor_job, route_job, route_rows, search_job, sent, store_job,
)
from secflow.session import checkpoint_dir
from secflow.streaming.batches import Batch, batch_folder

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return register


# Routing --------------------------------------------------------------------------------------

MAPPING = {"click": "t_click", "NATION_3.view": "t_view3", "nation_4.any": "t_any4", "NATION_5.any": "t_any5",
           "garbage": "t_garbage"}
ROUTE_SQL = f"""{E_SQL}, rt AS (SELECT *, user_id % 25 AS o,
 (CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100) < 10 AS sampled FROM e), st AS (
 SELECT *, CASE WHEN k = 7 THEN 'malformed' WHEN event_type = 'error' THEN 'dropped'
  WHEN event_type = 'click' OR (o = 3 AND event_type = 'view') OR o IN (4, 5) THEN 'sent'
  WHEN sampled THEN 'garbage' ELSE 'unmapped' END AS route_state FROM rt), routed AS (
 SELECT *, CASE WHEN route_state = 'garbage' THEN 't_garbage' WHEN route_state = 'sent' THEN
  CASE WHEN event_type = 'click' THEN 't_click' WHEN o = 3 THEN 't_view3' ELSE 't_any' || o END END AS topic FROM st)"""


def routed(spark, folder):
    value = F.when(F.col("k") == 7, F.lit("{oops")).otherwise(F.to_json(F.struct(
        F.col("event_type").alias("DevType"), F.expr(ORG).alias("Organization"))))
    df = parse_route_key(events(spark, folder).withColumn("value", value))
    return route(df, MAPPING, drop=["ERROR"], garbage_pct=10, sample_key="event_id")


@query(f"WITH {ROUTE_SQL} SELECT event_id, route_state, topic FROM routed")
def route_messages(spark, folder):
    return routed(spark, folder).select("event_id", "route_state", "topic")


@query(f"WITH {ROUTE_SQL} SELECT route_state, topic, count(*) AS messages FROM routed GROUP BY ALL")
def route_statistics(spark, folder):
    return routing_stats(routed(spark, folder))


@query(f"""WITH {ROUTE_SQL} SELECT count(*) FILTER (route_state IN ('sent', 'garbage', 'unmapped')) AS total,
 count(*) FILTER (route_state = 'sent') AS sent, count(*) FILTER (route_state = 'garbage') AS garbage,
 count(*) FILTER (route_state = 'unmapped') AS skipped, count(*) FILTER (route_state = 'dropped') AS dropped,
 count(*) FILTER (route_state = 'malformed') AS malformed FROM routed""")
def route_totals(spark, folder):
    return routing_totals(routed(spark, folder))


# Scripts --------------------------------------------------------------------------------------

SCRIPTS = [
    ("mark", "lens('data.aux1')(event, value='seen')\n"
             "lens('new.path')(event, value=(lens('eventTime')(event, andThen=lambda t: t + 1)))\n"
             "return (event, event['id'] % 3 != 0)"),
    ("second", "event['second'] = True\nreturn (event, lens('subject.name')(event) != 'u7')"),
]


def scripted(spark, folder):
    value = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("epoch").alias("eventTime"),
        F.struct(s("u{user_id}").alias("name")).alias("subject")))
    return apply_scripts(events(spark, folder).select("event_id", value.alias("value")), SCRIPTS)


@query(f"""WITH {E_SQL} SELECT event_id, 'seen' AS aux1, epoch + 1 AS later, event_id % 3 <> 0 AS second,
 event_id % 3 <> 0 AND user_id <> 7 AS keep FROM e""")
def script_run(spark, folder):
    v = F.from_json("value", "data STRUCT<aux1: STRING>, new STRUCT<path: BIGINT>, second BOOLEAN")
    return scripted(spark, folder).withColumn("v", v).select(
        "event_id", F.col("v.data.aux1").alias("aux1"), F.col("v.new.path").alias("later"),
        F.coalesce("v.second", F.lit(False)).alias("second"), "keep")


@query(f"""WITH {E_SQL} SELECT event_id FROM e WHERE event_id % 3 <> 0 AND user_id <> 7""")
def script_filter(spark, folder):
    return keep_approved(scripted(spark, folder)).select("event_id")


@query(f"""WITH {E_SQL} SELECT count(*) FILTER (NOT (event_id % 3 <> 0 AND user_id <> 7)) AS filtered,
 count(*) FILTER (event_id % 3 <> 0 AND user_id <> 7) AS approved FROM e""")
def script_statistics(spark, folder):
    return filter_stats(scripted(spark, folder))


# Hops -----------------------------------------------------------------------------------------


def chains(spark, folder):
    """One to four hops per event, each later than the one before; hop times in µs."""
    def hop(n):
        return F.when(F.col("k") % 4 + 1 >= n, F.struct(
            F.lit(n).alias("number"), F.lit(f"m{n}").alias("modname"),
            (F.col("micros") + n * F.col("cents")).alias("rt")))
    hops = [hop(n).alias(f"hop{n}") for n in (3, 1, 4, 2)]
    chain = F.to_json(F.struct(F.lit(9).alias("number"), *hops))
    return events(spark, folder).select(
        "event_id", F.expr(ORG).alias("organization"), (F.col("epoch") + 60).alias("event_time"),
        chain.alias("chain"))


HOPS_SQL = f"""{E_SQL}, h AS (
 SELECT event_id, user_id, 'hop' || n AS name, n AS pos, micros + n * cents AS rt FROM e, (VALUES (1), (2), (3), (4)) v(n)
 WHERE n <= k % 4 + 1
 UNION ALL SELECT event_id, user_id, 'NATION_' || (user_id % 25), 0, (epoch + 60) * 1000000 FROM e
), d AS (SELECT event_id, 'NATION_' || (user_id % 25) AS organization,
 lead(name) OVER w AS hop_in, name AS hop_out, rt - lead(rt) OVER w AS delay_us FROM h
 WINDOW w AS (PARTITION BY event_id ORDER BY pos DESC))"""


@query(f"""WITH {HOPS_SQL} SELECT event_id, organization, hop_in, hop_out, delay_us FROM d WHERE hop_in IS NOT NULL""")
def hop_delays(spark, folder):
    return hop_delay(chains(spark, folder)).select("event_id", "organization", "hop_in", "hop_out", "delay_us")


@query(f"""WITH {HOPS_SQL} SELECT organization, hop_in, hop_out, CAST(trunc(sum(delay_us)::DECIMAL(38,0) / count(*)) AS BIGINT)
 AS delay_us, count(*) AS events FROM d WHERE hop_in IS NOT NULL GROUP BY ALL""".replace(
    "CAST(trunc(sum(delay_us)::DECIMAL(38,0) / count(*)) AS BIGINT)",
    "CAST((abs(sum(delay_us)) // count(*)) * sign(sum(delay_us)) AS BIGINT)"))
def hop_delay_means(spark, folder):
    return mean_hop_delay(chains(spark, folder))


# Reassembly -----------------------------------------------------------------------------------
# A record is all lines of one user within half a minute that carry one audit id.


def audit_lines(spark, folder):
    line = s("type={event_type} msg=audit({epoch}.{lpad(k, 3, '0')}:{pmod(event_id, 50)}): k={k}")
    fields = {
        "raw": F.when(F.col("event_type") != "signup", line),
        "Message": F.when(F.col("event_type") == "signup", line), "EventReceivedTime": iso(F.col("epoch")),
        "MessageSourceAddress": F.expr(HOST_IP.replace(", '.', k", "")), "EventTime": iso(F.col("epoch")),
        "Hostname": s("h{user_id}"), "SourceName": F.lit("src"), "DevCat": F.lit("c"), "DevSubCat": F.lit("sc"),
        "DevType": F.lit("auditd"), "Organization": F.expr(ORG), "OrgID": F.expr("cast(user_id % 25 as int)"),
        "chain": F.struct(F.struct(F.lit(1).alias("number")).alias("a")),
    }
    value = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return events(spark, folder).select(
        F.when(F.col("k") == 13, F.substring(value, 1, 30)).otherwise(value).alias("value"))


REASSEMBLY_SQL = f"""{E_SQL}, l AS (
 SELECT *, epoch // 30 * 30 AS window_start, '10.1.' || (user_id % 200) AS addr, CAST(event_id % 50 AS VARCHAR) AS audit_id,
  'type=' || event_type || ' msg=audit(' || epoch || '.' || lpad(CAST(k AS VARCHAR), 3, '0') || ':' || (event_id % 50)
   || '): k=' || k AS line FROM e WHERE k <> 13)"""


@query(f"""WITH {REASSEMBLY_SQL} SELECT window_start, CAST(user_id % 25 AS INTEGER) AS "OrgID",
 addr AS "MessageSourceAddress", audit_id, arg_min('h' || user_id, (epoch, line)) AS "Hostname",
 'reassembledAuditD01' AS "DevType", string_agg(DISTINCT line, chr(10) ORDER BY line) AS raw
 FROM l GROUP BY window_start, user_id % 25, addr, audit_id""")
def reassemble_records(spark, folder):
    out = reassemble(audit_lines(spark, folder))
    return out.select("window_start", "OrgID", "MessageSourceAddress", "audit_id", "Hostname", "DevType", "raw")


@query(f"""WITH {REASSEMBLY_SQL}, g AS (SELECT min(epoch) AS ep, any_value(user_id % 25) AS o, count(*) AS n
 FROM l GROUP BY window_start, user_id % 25, addr, audit_id)
 SELECT 'NATION_' || o AS organization, strftime(make_timestamp(ep * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS received,
 '1' AS hop_number, 'unknown' AS severity, count(*) AS records FROM g GROUP BY ALL""")
def merged_chain_records(spark, folder):
    v = F.col("value")
    out = merge_chain(reassemble(audit_lines(spark, folder)))
    return out.select(
        F.get_json_object(v, "$.Organization").alias("organization"),
        F.get_json_object(v, "$.EventReceivedTime").alias("received"),
        F.get_json_object(v, "$.chain.a.number").alias("hop_number"),
        F.get_json_object(v, "$.Severity").alias("severity"),
    ).groupBy("organization", "received", "hop_number", "severity").agg(F.count("*").alias("records"))


@query(f"""WITH {E_SQL} SELECT 'not a JSON object' AS stacktrace, CAST(30 AS INTEGER) AS n_chars, CAST(32 AS INTEGER) AS id_chars,
 true AS own_id, count(*) AS n FROM e WHERE k = 13""")
def reassembly_dead_letters(spark, folder):
    return dead_letters(audit_lines(spark, folder), algo="md5").groupBy(
        "stacktrace", F.length("raw").alias("n_chars"), F.length("id").alias("id_chars"),
        (F.col("id") == F.md5("raw")).alias("own_id")).agg(F.count("*").alias("n"))


# Store and archive ----------------------------------------------------------------------------


@query(f"""WITH {E_SQL} SELECT 'id' || user_id AS id, event_id AS payload, micros AS write_ts FROM e
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY micros DESC, event_id DESC) = 1""")
def upsert_latest_rows(spark, folder):
    df = events(spark, folder).select(
        s("id{user_id}").alias("id"), F.col("event_id").alias("payload"), F.col("micros").alias("write_ts"))
    return upsert_latest(df)


@query(f"""WITH {E_SQL} SELECT 'NATION_' || (user_id % 25) AS sys_org, CAST(year(make_timestamp(micros)) AS INTEGER) AS sys_year,
 CAST(month(make_timestamp(micros)) AS INTEGER) AS sys_month, CAST(day(make_timestamp(micros)) AS INTEGER) AS sys_day,
 count(*) AS n FROM e GROUP BY ALL""")
def archive_partitions(spark, folder):
    df = events(spark, folder).select(F.expr(ORG).alias("collector_organization"), F.col("epoch").alias("data_time"))
    parted = with_partitions(df, "collector_organization", "data_time")
    return parted.groupBy("sys_org", "sys_year", "sys_month", "sys_day").agg(F.count("*").alias("n"))


@query(f"""WITH {E_SQL} SELECT event_id, micros // 1000 AS write_ms FROM e
 WHERE CAST(make_timestamp(micros) AS DATE) = DATE '2024-01-15'""")
def day_scan(spark, folder):
    df = events(spark, folder).select("event_id", F.expr("micros div 1000").alias("write_ms"))
    return read_day(df, "2024-01-15T13:00:00Z", "write_ms")


@query(f"""WITH {E_SQL} SELECT 'doc' || event_id AS id,
 'product_' || event_type || '_' || k || '-' || strftime(make_timestamp(micros), '%d.%m.%Y') || '/normalized' AS index_name,
 'u' || user_id AS name, strftime(make_timestamp(epoch * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS stamp,
 CASE WHEN k % 2 = 0 THEN '{{"ip":"10.0.0.1"}}' END AS source FROM e""")
def search_documents(spark, folder):
    df = canonical(
        events(spark, folder), id=s("doc{event_id}"), eventSource__title=s("Product/{event_type} {k}"),
        data__time=F.col("epoch"), subject__name=s("u{user_id}"),
        source__ip=F.when(F.col("k") % 2 == 0, F.lit("10.0.0.1")))
    docs = to_documents(df)
    return docs.select(
        "id", "index_name", F.get_json_object("doc", "$.subject.name").alias("name"),
        F.get_json_object("doc", "$['@timestamp']").alias("stamp"),
        F.get_json_object("doc", "$.source").alias("source"))


@query("""SELECT page_id, regexp_replace(lower(url), '\\s|"|\\*|\\\\|<|\\||,|>|\\?|/', '_', 'g') AS title FROM pages""")
def index_titles(spark, folder):
    return table(spark, folder, "pages").select("page_id", index_title(F.col("url")).alias("title"))


# Rule files -----------------------------------------------------------------------------------


@query("""WITH p AS (SELECT DISTINCT l_suppkey AS k, CAST(l_partkey % 300 AS INTEGER) AS port FROM lineitem
  WHERE l_quantity > 25), q AS (SELECT k, port, port - row_number() OVER (PARTITION BY k ORDER BY port) AS g FROM p),
 r AS (SELECT k, min(port) AS lo, max(port) AS hi FROM q GROUP BY k, g)
 SELECT l.k AS l_suppkey, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo)
  AS ranges FROM (SELECT DISTINCT l_suppkey AS k FROM lineitem) l LEFT JOIN r USING (k) GROUP BY l.k""")
def port_ranges(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_suppkey", F.when(F.col("l_quantity") > 25, F.expr("cast(l_partkey % 300 as int)")).alias("port"))
    return merge_ranges(df, ["l_suppkey"], "port")


def logon_file(spark, folder):
    """A logon rule file with one line per order; a part of its keys exists already."""
    return table(spark, folder, "orders").selectExpr(
        "concat('NATION_', o_custkey % 30) as org", "concat('host', o_custkey % 40) as hostname",
        "concat('10.9.0.', o_custkey % 40) as ip", "concat('U', o_custkey) as username",
        "concat('Dom', o_custkey % 3) as domain", "cast(2 + o_orderkey % 3 as string) as logontype",
        "'any' as fromHost", "if(o_custkey % 2 = 0, 8, 0) as fromTime", "if(o_custkey % 2 = 0, 18, 24) as toTime",
        "o_custkey % 2 = 0 as isWeekendAllowed").distinct()


LINES_SQL = """f AS (SELECT DISTINCT o_custkey % 30 AS org, o_custkey % 40 AS host, o_custkey AS u, o_custkey % 3 AS dom,
 2 + o_orderkey % 3 AS logontype, o_custkey % 2 = 0 AS weekend FROM orders)"""


@query(f"""WITH {LINES_SQL} SELECT 'NATION_' || org AS org, 'host' || host AS hostname, 'U' || u AS login, 'Dom' || dom AS domain,
 string_agg(CAST(logontype AS VARCHAR), ';' ORDER BY logontype) AS aux1,
 CAST(CASE WHEN weekend THEN 28800 ELSE 0 END AS INTEGER) AS time_from,
 CAST(CASE WHEN weekend THEN 64800 ELSE 0 END AS INTEGER) AS time_to,
 CAST(CASE WHEN weekend THEN 7 ELSE 5 END AS INTEGER) AS days_work FROM f GROUP BY ALL""")
def logon_rule_file(spark, folder):
    """New rules of the file, with their ids turned back to what they stand for."""
    dims = staff_dims(spark, folder)
    made = load_logon_rules(logon_file(spark, folder), dims, F.timestamp_seconds(F.lit(0)))

    def both(name, columns):
        return dims[name].select(*columns).unionByName(made[name].select(*columns))

    orgs = both("organizations", ["id", "short_name"]).withColumnsRenamed({"id": "org_id", "short_name": "org"})
    hosts = both("hosts", ["id", "host_name"]).withColumnsRenamed({"id": "destination", "host_name": "hostname"})
    people = both("subject", ["id", "org_id", "login", "user_domain"]).withColumnsRenamed(
        {"id": "subject", "user_domain": "domain"})
    hours = both("schedule", ["group_id", "time_from", "time_to", "days_work"]).withColumnRenamed(
        "group_id", "schedule")
    return made["rules"].join(people, "subject").join(orgs, "org_id").join(hosts, "destination").join(
        hours, "schedule").select("org", "hostname", "login", "domain", "aux1", "time_from", "time_to", "days_work")


@query(f"""WITH {LINES_SQL} SELECT 'organizations' AS dimension, count(DISTINCT org) AS n FROM f
  WHERE 'NATION_' || org NOT IN (SELECT n_name FROM nation)
 UNION ALL SELECT 'hosts', count(DISTINCT (org, host)) FROM f
 UNION ALL SELECT 'subject', count(DISTINCT (org, u, dom)) FROM f WHERE NOT EXISTS (SELECT 1 FROM customer c
  WHERE c_custkey % 5 <> 0 AND c_custkey % 4 <> 0 AND c_nationkey = f.org AND c_custkey % 60 = f.u AND c_custkey % 3 = f.dom)""")
def logon_rule_dimensions(spark, folder):
    made = load_logon_rules(logon_file(spark, folder), staff_dims(spark, folder), F.timestamp_seconds(F.lit(0)))
    parts = [made[n].agg(F.count_distinct("id").alias("n")).select(F.lit(n).alias("dimension"), "n")
             for n in ("organizations", "hosts", "subject")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT DISTINCT 'NATION_' || (o_custkey % 25) AS org, 'U' || o_custkey AS login, 'c:\\d' || (o_custkey % 9) AS obj_path,
 CASE WHEN o_custkey % 2 = 0 THEN '*.txt' END AS obj_name, 'host' || (o_custkey % 40) AS host FROM orders""")
def object_rule_file(spark, folder):
    csv = table(spark, folder, "orders").selectExpr(
        "concat('NATION_', o_custkey % 25) as org", "concat('host', o_custkey % 40) as hostname",
        "concat('10.9.0.', o_custkey % 40) as ip", "concat('c:\\\\d', o_custkey % 9) as catalog",
        "concat('U', o_custkey) as username", "'NewDom' as userDomain",
        "if(o_custkey % 2 = 0, '*.txt', '*') as filesMask", "0 as fromTime", "24 as toTime",
        "true as isWeekendAllowed").distinct()
    dims = staff_dims(spark, folder)
    made = load_object_rules(csv, dims, F.timestamp_seconds(F.lit(0)))
    objects = dims["objects"].select("id", "obj_path", "obj_name").unionByName(
        made["objects"].select("id", "obj_path", "obj_name")).withColumnRenamed("id", "object")
    orgs = dims["organizations"].select(F.col("id").alias("org_id"), F.col("short_name").alias("org"))
    people = made["subject"].select(F.col("id").alias("subject"), "org_id", "login").join(orgs, "org_id")
    hosts = made["hosts"].select(F.col("id").alias("source"), F.col("host_name").alias("host"))
    return made["rules"].join(objects, "object").join(people, "subject").join(hosts, "source").select(
        "org", "login", "obj_path", "obj_name", "host")


@query("""WITH f AS (SELECT l_suppkey % 25 AS org, CASE WHEN l_linenumber = 1 THEN NULL ELSE '10.8.' || (l_orderkey // 250 % 250) || '.' || (l_orderkey % 250) END AS src,
  CASE WHEN l_linenumber % 2 = 0 THEN 'tcp' END AS proto, CAST(l_partkey % 40 AS INTEGER) AS port FROM lineitem),
 p AS (SELECT DISTINCT * FROM f),
 q AS (SELECT *, port - row_number() OVER (PARTITION BY org, src, proto ORDER BY port) AS g FROM p),
 r AS (SELECT org, src, proto, min(port) AS lo, max(port) AS hi FROM q GROUP BY org, src, proto, g)
 SELECT 'NATION_' || org AS org, src, proto, CAST(NULL AS VARCHAR) AS aux1,
  string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo) AS aux2
 FROM r GROUP BY ALL""")
def connection_rule_file(spark, folder):
    csv = table(spark, folder, "lineitem").selectExpr(
        "concat('NATION_', l_suppkey % 25) as organization",
        "if(l_linenumber = 1, 'any', concat('10.8.', l_orderkey div 250 % 250, '.', l_orderkey % 250)) as src_host_ip", "'any' as target_host_ip",
        "'false' as allportallowed", "'false' as allprotocolallowed",
        "if(l_linenumber % 2 = 0, 'tcp', 'any') as proto", "'any' as src_host_port",
        "cast(l_partkey % 40 as string) as target_host_port").distinct()
    dims = staff_dims(spark, folder)
    made = load_connection_rules(csv, dims, F.timestamp_seconds(F.lit(0)))
    orgs = dims["organizations"].select(F.col("id").alias("org_id"), F.col("short_name").alias("org"))
    people = dims["subject"].select("id", "org_id").unionByName(made["subject"].select("id", "org_id")).select(
        F.col("id").alias("subject"), "org_id")
    hosts = made["hosts"].select(F.col("id").alias("source"), F.col("host_ip").alias("src"))
    objects = dims["objects"].select("id", "obj_name").unionByName(made["objects"].select("id", "obj_name")).select(
        F.col("id").alias("object"), F.col("obj_name").alias("proto"))
    return made["rules"].join(people, "subject").join(orgs, "org_id").join(hosts, "source", "left").join(
        objects, "object", "left").select("org", "src", "proto", "aux1", "aux2")


# Whole jobs -----------------------------------------------------------------------------------


@query(f"""WITH {ROUTE_SQL} SELECT '{{"DevType":"' || event_type || '","Organization":"NATION_' || o || '"}}' AS value, topic,
 count(*) AS n FROM routed WHERE topic IS NOT NULL GROUP BY ALL""")
def route_job_messages(spark, folder):
    value = F.when(F.col("k") == 7, F.lit("{oops")).otherwise(F.to_json(F.struct(
        F.col("event_type").alias("DevType"), F.expr(ORG).alias("Organization"))))
    values = events(spark, folder).withColumn("value", value)
    sent, _ = route_job(values, MAPPING, drop=["ERROR"], garbage_pct=10, sample_key="event_id")
    return sent.groupBy("value", "topic").agg(F.count("*").alias("n"))


@query(f"""WITH {E_SQL} SELECT CASE WHEN k % 10 = 3 THEN 'error' ELSE 'approved' END AS topic,
 CASE WHEN k % 10 <> 3 THEN event_id END AS id, CASE WHEN k % 10 = 3 THEN 'broken ' || event_id END AS raw FROM e
 WHERE k % 10 = 3 OR (event_id % 3 <> 0 AND user_id <> 7)""")
def filter_job_messages(spark, folder):
    value = F.when(F.col("k") % 10 == 3, s("broken {event_id}")).otherwise(F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("epoch").alias("eventTime"), F.struct(s("u{user_id}").alias("name")).alias("subject"))))
    sent, _ = filter_job(events(spark, folder).select(value.alias("value")), SCRIPTS, "approved")
    return sent.select("topic", F.get_json_object("value", "$.id").cast("bigint").alias("id"), F.get_json_object("value", "$.raw").alias("raw"))


@query(f"""WITH {HOPS_SQL} SELECT organization, hop_in, hop_out, CAST(sum(delay_us) // count(*) AS BIGINT) AS delay_us, count(*) AS events
 FROM d WHERE hop_in IS NOT NULL GROUP BY ALL""")
def monitor_job_means(spark, folder):
    return monitor_job(chains(spark, folder))[1]


@query(f"""WITH {E_SQL} SELECT 'store' AS part, 'id' || user_id AS id, event_id AS payload FROM e
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY micros DESC, event_id DESC) = 1
 UNION ALL SELECT 'counts', CAST(count(*) AS VARCHAR), count(DISTINCT user_id) FROM e""")
def store_job_rows(spark, folder):
    df = events(spark, folder).select(
        s("id{user_id}").alias("id"), F.col("event_id").alias("payload"), F.col("micros").alias("write_ts"))
    newest, counts = store_job(df)
    return newest.select(F.lit("store").alias("part"), "id", "payload").unionByName(
        counts.select(F.lit("counts").alias("part"), F.col("read").cast("string").alias("id"), F.col("kept").alias("payload")))


@query(f"""WITH {E_SQL} SELECT event_type || '_' || k || '-' || strftime(make_timestamp(micros), '%d.%m.%Y') || '/normalized' AS index_name,
 count(*) AS documents FROM e GROUP BY ALL""")
def search_job_indexes(spark, folder):
    df = canonical(events(spark, folder), id=s("doc{event_id}"), eventSource__title=s("{event_type} {k}"), data__time=F.col("epoch"))
    return search_job(df)[1]


@query(f"""WITH {E_SQL} SELECT 'NATION_' || (user_id % 25) AS sys_org, 2024 AS sys_year, 1 AS sys_month, 15 AS sys_day,
 'u' || user_id AS name, event_id FROM e WHERE CAST(make_timestamp(micros) AS DATE) = DATE '2024-01-15'""")
def archive_job_rows(spark, folder):
    df = canonical(
        events(spark, folder), id=s("{event_id}"), subject__name=s("u{user_id}"), collector__organization=F.expr(ORG),
        data__time=F.col("epoch")).withColumn("write_ms", F.expr("micros div 1000"))
    flat, _ = archive_job(df.select("event", "write_ms"), "2024-01-15", "write_ms")
    return flat.select("sys_org", "sys_year", "sys_month", "sys_day", F.col("subject_name").alias("name"), F.col("id").cast("bigint").alias("event_id"))


# Staged once, read by sinks and statistics ----------------------------------------------------


def shared_folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/flows-{uuid.uuid4().hex}"


@query(f"""WITH {E_SQL}, st AS (SELECT event_id, CASE WHEN k % 10 = 3 THEN 'failed' WHEN event_id % 3 <> 0 AND user_id <> 7 THEN 'approved'
  ELSE 'filtered' END AS state FROM e)
SELECT 'error' AS part, event_id AS number FROM st WHERE state = 'failed'
UNION ALL SELECT 'approved', event_id FROM st WHERE state = 'approved'
UNION ALL SELECT 'filtered_count', count(*) FILTER (state = 'filtered') FROM st
UNION ALL SELECT 'approved_count', count(*) FILTER (state = 'approved') FROM st""")
def filter_delivered(spark, folder):
    """A batch of the filter job staged once, delivered twice over to a folder for each topic, and its counts."""
    value = F.when(F.col("k") % 10 == 3, s("broken {event_id}")).otherwise(F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("epoch").alias("eventTime"), F.struct(s("u{user_id}").alias("name")).alias("subject"))))
    values, shared = events(spark, folder).select(value.alias("value")), shared_folder(spark)
    for _ in range(2):  # a repeated batch replaces itself
        batch = Batch(spark, f"{shared}/log", 0)
        batch.stage(lambda: filter_rows(values, SCRIPTS, "approved"), by="state")
        for topic in ("approved", "error"):
            batch.deliver(topic, batch_folder(f"{shared}/{topic}", lambda rows, t=topic: sent(rows.where(F.col("topic") == t))))
        batch.deliver("counts", batch_folder(f"{shared}/counts", filter_counts))
    number = F.coalesce(F.get_json_object("value", "$.id"), F.regexp_extract(F.get_json_object("value", "$.raw"), "[0-9]+", 0))
    both = spark.read.parquet(f"{shared}/approved").unionByName(spark.read.parquet(f"{shared}/error"))
    messages = both.select(F.col("topic").alias("part"), number.cast("bigint").alias("number"))
    counts = spark.read.parquet(f"{shared}/counts").select(F.explode(F.array(*[
        F.struct(F.lit(f"{c}_count").alias("part"), F.col(c).alias("number")) for c in ("filtered", "approved")])).alias("c")).select("c.*")
    return messages.unionByName(counts)


@query(f"""WITH {ROUTE_SQL} SELECT route_state, topic, count(*) AS messages FROM routed GROUP BY ALL""")
def route_delivered(spark, folder):
    """Statistics of the routing job from its staged rows."""
    value = F.when(F.col("k") == 7, F.lit("{oops")).otherwise(F.to_json(F.struct(
        F.col("event_type").alias("DevType"), F.expr(ORG).alias("Organization"))))
    values, shared = events(spark, folder).withColumn("value", value), shared_folder(spark)
    batch = Batch(spark, f"{shared}/log", 0)
    batch.stage(lambda: route_rows(values, MAPPING, ["ERROR"], 10, "event_id"))
    batch.deliver("statistics", batch_folder(f"{shared}/statistics", routing_stats))
    return spark.read.parquet(f"{shared}/statistics").drop("batch")


@query(f"""WITH {E_SQL} SELECT 'NATION_' || (user_id % 25) AS sys_org, CAST(CAST(make_timestamp(epoch * 1000000) AS DATE) AS VARCHAR) AS day, count(*) AS rows,
 sum(event_id) AS ids, count(*) FILTER (epoch % 86400 BETWEEN 36000 AND 39600) AS of_an_hour FROM e
 WHERE CAST(make_timestamp(epoch * 1000000) AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY ALL""")
def archive_replaced(spark, folder):
    """Three days archived, the second one again; written, replaced and read back from the shared folder."""
    rows = events(spark, folder).select("event_id", "epoch", F.expr(ORG).alias("organization"))
    path = f"{shared_folder(spark)}/archive"
    day = F.to_date(F.timestamp_seconds("epoch")).cast("string")
    write_archive(rows.where(day.between("2024-01-10", "2024-01-12")), path, "organization", "epoch", "overwrite")
    write_archive(rows.where(day == "2024-01-11"), path, "organization", "epoch", "overwrite")
    back = spark.read.orc(path)
    hour = F.col("epoch") % 86400
    return back.groupBy("sys_org", F.make_date("sys_year", "sys_month", "sys_day").cast("string").alias("day")).agg(
        F.count("*").alias("rows"), F.sum("event_id").alias("ids"), F.count_if(hour.between(36000, 39600)).alias("of_an_hour"))
