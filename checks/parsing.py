"""Envelopes, log parsers, validation and the normalization job."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.tables import (
    E_SQL, dimensions, envelope, event_id, events, leaf, normalized, pipeline, s, table,
)
from secflow.functions import dates, enums, ids, text
from secflow.functions.text import once
from secflow.operators import parsers as P
from secflow.operators.archive import flatten
from secflow.operators.dims import preferences, vendors
from secflow.operators.envelope import parse_envelope, parse_route_key, preparsed_text, raw_text
from secflow.operators.states import raw_event, shift_time, split_states
from secflow.operators.stats import pipeline_stats
from secflow.plans.normalize import normalize_job

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(fn):
        name = fn.__name__
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return register


def m(key: str, col: str = "f"):
    return F.try_element_at(F.col(col), F.lit(key)).alias(key)


# Parsers --------------------------------------------------------------------------------------

KV_LINE = (
    '<189>eventtime={epoch} logid="{lpad(event_id, 10, \'0\')}" type="{event_type}" '
    'srcip=10.0.{pmod(user_id, 250)}.{k} user="user {user_id}" note=n/a empty= level={k} level=x{k}'
)


@query(f"""WITH {E_SQL} SELECT event_id, CAST(epoch AS VARCHAR) AS eventtime,
 lpad(CAST(event_id AS VARCHAR), 10, '0') AS logid, event_type AS type,
 '10.0.' || (user_id % 250) || '.' || k AS srcip, 'user ' || user_id AS "user", 'x' || k AS level,
 CAST(6 AS INTEGER) AS n_fields FROM e""")
def parse_kv(spark, folder):
    df = events(spark, folder).withColumn("f", P.parse_kv(s(KV_LINE)))
    return df.select("event_id", *[m(k) for k in ("eventtime", "logid", "type", "srcip", "user", "level")],
                     F.size("f").alias("n_fields"))


F2B_LINE = (
    "mar 03 07:09:58 edge{user_id} guard {date_format(timestamp_seconds(epoch), 'yyyy-MM-dd HH:mm:ss')}"
    ",143 fail2ban.actions[{event_id}]: {if(k % 2 = 0, 'warning', 'notice')} [jail-{k}] "
    "{if(event_type = 'click', 'unban', 'ban')} 22.33.{pmod(user_id, 250)}.{k}"
)


@query(f"""WITH {E_SQL} SELECT event_id,
 strftime(make_timestamp(epoch * 1000000), '%Y-%m-%d %H:%M:%S') || ',143' AS "originTime",
 'fail2ban.actions' AS "msgId", CASE WHEN k % 2 = 0 THEN 'warning' ELSE 'notice' END AS importance,
 'jail-' || k AS aux1, CASE WHEN event_type = 'click' THEN 'unban' ELSE 'ban' END AS aux2,
 '22.33.' || (user_id % 250) || '.' || k AS "sourceIp" FROM e""")
def parse_fail2ban(spark, folder):
    df = events(spark, folder).withColumn("f", P.parse_fail2ban(s(F2B_LINE)))
    return df.select("event_id", *[m(x) for x in (
        "originTime", "msgId", "importance", "aux1", "aux2", "sourceIp")])


ASA_SRC, ASA_DST = "10.2.{pmod(user_id, 250)}.{k}", "192.0.2.{k}"
ASA_HEAD = "<166>:{date_format(timestamp_seconds(epoch), 'MMM dd yyyy HH:mm:ss')} UTC: "
ASA_LINES = {
    "click": ASA_HEAD + "%ASA-auth-6-113004: AAA user authentication Successful : server =  "
             + ASA_SRC + " : user = user{user_id}",
    "view": ASA_HEAD + "%ASA-4-106023: Deny tcp src outside:" + ASA_SRC
            + "/{pmod(event_id, 65000)} dst inside:" + ASA_DST + '/443 by access-group "acl{k}"',
    "error": ASA_HEAD + "%ASA-sys-6-605005: Login permitted from " + ASA_SRC
             + "/{pmod(event_id, 65000)} to outside:" + ASA_DST + '/ssh for user "user{user_id}"',
    "purchase": ASA_HEAD + "%FWSM-6-105009: (Primary) Testing on interface if{k} "
                "{if(k % 2 = 0, 'Passed', 'Failed')}",
    "signup": ASA_HEAD + "%ASA-6-999999: Something else",
}


def by_type(lines: dict[str, str]):
    column = F.when(F.lit(False), F.lit(""))
    for kind, line in lines.items():
        column = column.when(F.col("event_type") == kind, s(line))
    return column


ASA_SQL = """
 CASE event_type WHEN 'click' THEN '113004' WHEN 'view' THEN '106023' WHEN 'error' THEN '605005'
  WHEN 'purchase' THEN '105009' END"""


@query(f"""WITH {E_SQL} SELECT event_id, {ASA_SQL} AS "datapayloadMsgId",
 CASE event_type WHEN 'view' THEN '4' WHEN 'signup' THEN NULL ELSE '6' END AS "interactionImportance",
 CASE event_type WHEN 'purchase' THEN 'FWSM' WHEN 'signup' THEN NULL ELSE 'ASA' END AS "eventSourceSubsys",
 CASE WHEN event_type IN ('click', 'error') THEN 'user' || user_id END AS "subjectName",
 CASE WHEN event_type IN ('view', 'error') THEN '10.2.' || (user_id % 250) || '.' || k END AS "sourceLocationIp",
 CASE WHEN event_type IN ('view', 'error') THEN CAST(event_id % 65000 AS VARCHAR) END AS "sourceLocationPort",
 CASE WHEN event_type = 'click' THEN '10.2.' || (user_id % 250) || '.' || k
      WHEN event_type = 'view' THEN 'inside' END AS aux1,
 CASE WHEN event_type = 'view' THEN 'acl' || k WHEN event_type = 'error' THEN 'ssh' END AS aux10
 FROM e""")
def parse_asa(spark, folder):
    df = events(spark, folder).withColumn("f", P.parse_asa(by_type(ASA_LINES)))
    return df.select("event_id", *[m(x) for x in (
        "datapayloadMsgId", "interactionImportance", "eventSourceSubsys", "subjectName",
        "sourceLocationIp", "sourceLocationPort", "aux1", "aux10")])


IOS_DAY = "{lower(date_format(timestamp_seconds(epoch), 'MMM d'))}"
IOS_TIME = "{date_format(timestamp_seconds(epoch), 'HH:mm:ss')}"
IOS_LINES = {
    "click": "<172>25: 25: x: %sec_login-4-login_failed: login failed [user: u{user_id}] [source: "
             "10.3.{pmod(user_id, 250)}.{k}] [localport: 22] [reason: bad] at " + IOS_TIME
             + " utc thu {lower(date_format(timestamp_seconds(epoch), 'MMM'))} "
             "{date_format(timestamp_seconds(epoch), 'd yyyy')}",
    "view": "<173>25: " + IOS_DAY + " " + IOS_TIME + " utc: %ssh-5-ssh2_userauth: user 'u{user_id}' "
            "authentication for ssh2 session from 10.3.{pmod(user_id, 250)}.{k} (tty = 0) using x "
            "{if(k % 2 = 0, 'succeeded', 'failed')}",
    "error": "<189>28: " + IOS_DAY + " " + IOS_TIME + " utc: %sys-6-logout: user u{user_id} has exited "
             "tty session 1(10.3.{pmod(user_id, 250)}.{k})",
    "purchase": "<189>28: " + IOS_DAY + " " + IOS_TIME + " utc: %sys-5-config_i: configured from console "
                "by u{user_id} on vty0 (10.3.{pmod(user_id, 250)}.{k})",
    "signup": "nothing to see",
}
IOS_KIND = """CASE event_type WHEN 'click' THEN 'login_failed' WHEN 'view' THEN 'ssh2_userauth'
 WHEN 'error' THEN 'logout' WHEN 'purchase' THEN 'config_i' END"""


@query(f"""WITH {E_SQL} SELECT event_id, {IOS_KIND} AS "eventType",
 CASE event_type WHEN 'click' THEN '4' WHEN 'view' THEN '5' WHEN 'error' THEN '6'
  WHEN 'purchase' THEN '5' END AS importance,
 CASE WHEN event_type <> 'signup' THEN 'u' || user_id END AS "subjectName",
 CASE WHEN event_type <> 'signup' THEN '10.3.' || (user_id % 250) || '.' || k END AS "sourceIp",
 CASE WHEN event_type = 'view' THEN CASE WHEN k % 2 = 0 THEN 'succeeded' ELSE 'failed' END END AS status
 FROM e""")
def parse_ios(spark, folder):
    df = events(spark, folder).withColumn("f", P.parse_ios(by_type(IOS_LINES)))
    return df.select("event_id", *[m(x) for x in (
        "eventType", "importance", "subjectName", "sourceIp", "status")])


AUDIT_LINE = (
    "node=n{k} type=SYSCALL msg=audit({epoch}.123:{event_id}): syscall=59 success=yes exit=0 "
    "pid={user_id} auid={k} comm=\"c{k}\" \n"
    "type=CWD msg=audit({epoch}.123:{event_id}): cwd=\"/home/{user_id}\"\n"
    "type=PATH msg=audit({epoch}.123:{event_id}): item=0 name=\"/bin/a{k}\"\n"
    "type=PATH msg=audit({epoch}.123:{event_id}): item=1 name=\"/bin/b{user_id}\""
)


@query(f"""WITH {E_SQL} SELECT event_id, 'CWD|PATH|PATH|SYSCALL' AS types,
 '/bin/a' || k || '|/bin/b' || user_id AS names, CAST(user_id AS VARCHAR) AS pid,
 '/home/' || user_id AS cwd, CAST(epoch AS VARCHAR) AS stamp, CAST(4 AS INTEGER) AS n_ids FROM e""")
def parse_audit_multi(spark, folder):
    df = events(spark, folder).withColumn("f", P.parse_audit(s(AUDIT_LINE)))

    def many(key):
        return F.array_join(F.array_sort(F.try_element_at("f", F.lit(key))), "|")

    one = P.single_values(F.col("f"))
    return df.select(
        "event_id", many("type").alias("types"), many("name").alias("names"),
        F.try_element_at(one, F.lit("pid")).alias("pid"),
        F.try_element_at(one, F.lit("cwd")).alias("cwd"),
        F.get(F.try_element_at("f", F.lit("msg_timestamp")), F.lit(0)).alias("stamp"),
        F.size(F.try_element_at("f", F.lit("msg_id"))).alias("n_ids"))


@query("""SELECT l_suppkey AS record, CAST(count(*) AS INTEGER) AS n_names, md5(string_agg('/p' || l_partkey || '.' || l_orderkey, '|'
  ORDER BY encode('/p' || l_partkey || '.' || l_orderkey))) AS names, CAST(count(DISTINCT 'a' || (l_orderkey % 300)) AS INTEGER) AS n_keys
 FROM lineitem GROUP BY l_suppkey""")
def parse_audit_long(spark, folder):
    """Records of hundreds of lines, one for each order line of a supplier, with hundreds of keys."""
    line = F.concat(
        F.lit("type=PATH msg=audit(1.2:3): name=\"/p"), F.col("l_partkey").cast("string"), F.lit("."), F.col("l_orderkey").cast("string"),
        F.lit("\" a"), (F.col("l_orderkey") % 300).cast("string"), F.lit("=x"))
    text = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    records = table(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("record")).agg(text.alias("raw"))
    found = once(records, f=P.parse_audit(F.col("raw")))
    names = F.try_element_at("f", F.lit("name"))
    made_up = F.filter(F.map_keys("f"), lambda k: k.rlike("^a[0-9]+$"))
    return found.select("record", F.size(names).alias("n_names"), F.md5(F.array_join(F.array_sort(names), "|")).alias("names"),
                        F.size(made_up).alias("n_keys"))



@query(f"""WITH {E_SQL} SELECT event_id, 'audit_event' AS event_type, 'u' || user_id AS parsed_username,
 CASE WHEN k % 2 = 0 THEN 'D' || k END AS parsed_domain,
 'authenticating user ''u' || user_id || '''.' AS detail FROM e""")
def parse_antivirus(spark, folder):
    detail = s("authenticating user 'u{user_id}'.")
    account = F.when(F.expr("k % 2 = 0"), s("D{k}\\u{user_id}"))
    json = F.to_json(F.struct(
        F.lit("audit_event").alias("event_type"), detail.alias("detail"), account.alias("account")))
    df = events(spark, folder).withColumn("f", P.parse_antivirus(F.concat(F.lit("<12>av: "), json)))
    return df.select("event_id", *[m(x) for x in (
        "event_type", "parsed_username", "parsed_domain", "detail")])


def preparsed(columns: dict[str, str]):
    return F.struct(*[F.expr(v).alias(n) for n, v in columns.items()])


@query(f"""WITH {E_SQL} SELECT event_id, event_type AS "Type", CAST(k AS VARCHAR) AS "K",
 CASE WHEN k % 3 = 0 THEN NULL ELSE 'v' || k END AS "Maybe", 'line ' || event_id AS raw_message,
 '{{"Type":"' || event_type || '","K":' || k || ',"Maybe":"'
   || CASE WHEN k % 3 = 0 THEN 'N/A' ELSE ' v' || k || ' ' END || '"}}' AS preparsed FROM e""")
def parse_preparsed_json(spark, folder):
    raw = F.to_json(preparsed({
        "Type": "event_type", "K": "k", "Maybe": "if(k % 3 = 0, 'N/A', concat(' v', k, ' '))",
        "SourceStr": "concat('line ', event_id)"}))
    kind = F.lit("object")
    df = events(spark, folder).withColumn("raw", raw).withColumn("f", P.parse_json_fields(F.col("raw")))
    return df.select("event_id", m("Type"), m("K"), m("Maybe"),
                     raw_text(kind, F.col("raw")).alias("raw_message"),
                     preparsed_text(kind, F.col("raw")).alias("preparsed"))


# Envelopes ------------------------------------------------------------------------------------


@query(f"""WITH {E_SQL} SELECT CASE WHEN event_type IN ('click', 'view') THEN event_id END AS event_id,
 CASE WHEN event_type <> 'error' THEN 'NATION_' || (user_id % 25) END AS organization,
 CASE WHEN event_type <> 'error' THEN epoch END AS received,
 CASE event_type WHEN 'click' THEN 'string' WHEN 'view' THEN 'object' WHEN 'purchase' THEN 'string'
  WHEN 'signup' THEN 'other' END AS raw_kind,
 CASE WHEN event_type IN ('click', 'purchase') THEN 'text {{' || k
      WHEN event_type = 'view' THEN '{{"b":' || k || ',"a":"x"}}' END AS raw,
 CASE event_type WHEN 'error' THEN 'not a JSON object' WHEN 'purchase' THEN 'chain has no hop with number 1'
  WHEN 'signup' THEN 'raw is neither text nor object' END AS envelope_error FROM e""")
def envelope_parsing(spark, folder):
    no_first = F.struct(F.struct(F.lit(2).alias("number"), F.lit("x").alias("fqdn")).alias("other"))
    text_raw = s("text {k}").substr(1, 5)
    raw_string = F.concat(text_raw, F.lit("{"), F.col("k").cast("string"))
    obj = F.struct(F.col("k").alias("b"), F.lit("x").alias("a"))
    value = (
        F.when(F.col("event_type") == "click", envelope(raw_string, "d"))
        .when(F.col("event_type") == "view", envelope(obj, "d"))
        .when(F.col("event_type") == "purchase", envelope(raw_string, "d", chain=no_first))
        .when(F.col("event_type") == "signup", envelope(F.col("k"), "d"))
        .otherwise(F.substring(envelope(raw_string, "d"), 1, 40))
    )
    df = parse_envelope(events(spark, folder).select(value.alias("value")))
    return df.select(
        F.when(F.col("envelope_error").isNull(), F.col("input_id").cast("bigint")).alias("event_id"),
        "organization", "received", "raw_kind", "raw", "envelope_error")


@query(f"""WITH {E_SQL} SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS dev_type,
 CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE 'NATION_' || (user_id % 25) END AS organization,
 event_type IN ('error', 'signup') AS malformed FROM e""")
def route_key_parsing(spark, folder):
    value = F.when(F.col("event_type") == "error", F.lit("{broken")).when(
        F.col("event_type") == "signup", F.to_json(F.struct(F.col("event_type").alias("DevType")))
    ).otherwise(F.to_json(F.struct(F.col("event_type").alias("DevType"),
                                   s("NATION_{pmod(user_id, 25)}").alias("Organization"))))
    df = events(spark, folder).withColumn("value", value)
    return parse_route_key(df).select("event_id", "dev_type", "organization", "malformed")


# Normalization --------------------------------------------------------------------------------

FW_LINE = (
    '<189>eventtime={epoch}000 logid="{lpad(event_id, 10, \'0\')}" type="traffic" subtype="forward" '
    'srcip=10.0.0.{k} srcport={pmod(event_id, 65000)} dstip=8.8.8.8 dstport=53 '
    'proto={if(k % 2 = 0, 17, 6)} action="{if(k % 3 = 0, \'accept\', \'blorp\')}" level="notice" '
    'rcvdbyte={cents} sentbyte=20 rcvdpkt=1 sentpkt=2 {if(k % 7 = 0, \'\', \'service="DNS"\')} '
    'srccountry="A" dstcountry="B" user="u{user_id}{if(k % 5 = 0, \'@corp\', \'\')}"'
)
VALID_ORG = "(user_id % 25) NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 3)"


@query(f"""WITH {E_SQL} SELECT event_id, epoch AS "eventTime", epoch AS data_originTime,
 lpad(CAST(event_id AS VARCHAR), 10, '0') AS "data_msgId", '10.0.0.' || k AS source_ip,
 CAST(event_id % 65000 AS INTEGER) AS source_port,
 CASE WHEN k % 2 = 0 THEN 'UDP' ELSE 'TCP' END AS interaction_protocol,
 CASE WHEN k % 3 = 0 THEN 'connect' ELSE 'UnknownInteractionCategory' END AS interaction_action,
 'u' || user_id AS subject_name, CASE WHEN k % 5 = 0 THEN 'corp' END AS subject_domain,
 cents AS "data_bytesIn", 'NATION_' || (user_id % 25) AS collector_organization,
 'product firewall' AS "eventSource_title"
 FROM e WHERE {VALID_ORG} AND k % 7 <> 0""".replace("AS data_originTime", 'AS "data_originTime"'))
def normalize_firewall(spark, folder):
    df = normalized(spark, folder, s(FW_LINE), "firewall").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "eventTime", "data.originTime", "data.msgId", "source.ip", "source.port",
        "interaction.protocol", "interaction.action", "subject.name", "subject.domain", "data.bytesIn",
        "collector.organization", "eventSource.title")])


@query(f"""WITH {E_SQL}, n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 3) SELECT event_id,
 CASE WHEN user_id % 25 IN (SELECT n_nationkey FROM n) THEN
  'Organization is inactive or does not have configured pipelines' || chr(10)
   || 'DevType is not configured for organization'
 WHEN k % 7 = 0 THEN 'Field service is required' END AS reasons,
 CASE WHEN user_id % 25 IN (SELECT n_nationkey FROM n) OR k % 7 = 0 THEN 'invalid' ELSE 'valid' END AS outcome
 FROM e""")
def validate_reasons(spark, folder):
    df = normalized(spark, folder, s(FW_LINE), "firewall")
    reasons = F.when(F.size("envelope_reasons") > 0, F.col("envelope_reasons")).when(
        F.size("reasons") > 0, F.col("reasons"))
    return df.select(event_id(), F.array_join(reasons, "\n").alias("reasons"), "outcome")


@query(f"""WITH {E_SQL} SELECT event_id,
 CASE event_type WHEN 'click' THEN 'login' WHEN 'error' THEN 'login' WHEN 'view' THEN 'deny'
  ELSE 'check' END AS interaction_action,
 CASE WHEN event_type = 'purchase' AND k % 2 = 1 THEN 'failure' ELSE 'success' END AS interaction_status,
 CASE WHEN event_type = 'view' THEN 'MEDIUM' WHEN event_type = 'purchase' AND k % 2 = 1 THEN 'MEDIUM'
  ELSE 'INFO' END AS interaction_importance,
 CASE WHEN event_type = 'view' THEN 'TCP' END AS interaction_protocol,
 CASE event_type WHEN 'click' THEN 'system' WHEN 'view' THEN 'connection' WHEN 'purchase' THEN 'interface' END
  AS object_category,
 CASE WHEN event_type = 'purchase' THEN 'if' || k END AS object_value, epoch AS "data_originTime",
 CASE WHEN event_type IN ('click', 'error') THEN 'user' || user_id END AS subject_name
 FROM e WHERE {VALID_ORG} AND event_type <> 'signup'""")
def normalize_asa(spark, folder):
    df = normalized(spark, folder, by_type(ASA_LINES), "asa").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "interaction.action", "interaction.status", "interaction.importance", "interaction.protocol",
        "object.category", "object.value", "data.originTime", "subject.name")])


@query(f"""WITH {E_SQL} SELECT event_id,
 CASE event_type WHEN 'error' THEN 'logout' WHEN 'purchase' THEN 'modify' ELSE 'login' END AS interaction_action,
 CASE WHEN event_type = 'click' THEN 'failure' WHEN event_type = 'view' AND k % 2 = 1 THEN 'failure'
  ELSE 'success' END AS interaction_status,
 CASE WHEN event_type = 'click' THEN 'MEDIUM' ELSE 'INFO' END AS interaction_importance,
 'u' || user_id AS subject_name, 'h' || user_id AS destination_hostname, epoch AS "data_originTime"
 FROM e WHERE {VALID_ORG} AND event_type <> 'signup'""")
def normalize_ios(spark, folder):
    df = normalized(spark, folder, by_type(IOS_LINES), "ios").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "interaction.action", "interaction.status", "interaction.importance", "subject.name",
        "destination.hostname", "data.originTime")])


@query(f"""WITH {E_SQL} SELECT event_id,
 CASE WHEN event_type = 'click' THEN 'allow' ELSE 'deny' END AS interaction_action,
 CASE WHEN k % 2 = 0 THEN 'LOW' ELSE 'INFO' END AS interaction_importance,
 '22.33.' || (user_id % 250) || '.' || k AS source_ip, epoch AS "data_originTime",
 'h' || user_id || '.example.org' AS destination_fqdn, 'jail-' || k AS data_aux1,
 md5('NATION_' || (user_id % 25) || 'h' || user_id || '.example.org' || md5(
  'mar 03 07:09:58 edge' || user_id || ' guard ' || strftime(make_timestamp(epoch * 1000000), '%Y-%m-%d %H:%M:%S')
  || ',143 fail2ban.actions[' || event_id || ']: ' || CASE WHEN k % 2 = 0 THEN 'warning' ELSE 'notice' END
  || ' [jail-' || k || '] ' || CASE WHEN event_type = 'click' THEN 'unban' ELSE 'ban' END || ' 22.33.'
  || (user_id % 250) || '.' || k)) AS id
 FROM e WHERE {VALID_ORG}""")
def normalize_fail2ban(spark, folder):
    df = normalized(spark, folder, s(F2B_LINE), "fail2ban").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "interaction.action", "interaction.importance", "source.ip", "data.originTime",
        "destination.fqdn", "data.aux1", "id")])


WIN = {
    "EventTime": "date_format(timestamp_seconds(epoch), \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\")",
    "EventID": "case event_type when 'click' then 4624 when 'view' then 4663 when 'error' then 4728 "
               "when 'purchase' then 4769 else 4768 end",
    "Hostname": "concat('srv', k, '.corp')",
    "TargetUserName": "concat('u', user_id, if(event_type = 'purchase', '@D.ORG', ''))",
    "TargetDomainName": "'CORP'", "TargetSid": "concat('S-', user_id)",
    "SubjectUserName": "concat('s', user_id)", "SubjectDomainName": "'SUB'",
    "ServiceName": "if(event_type = 'signup', 'krbtgt/REALM', 'SRV$')",
    "LogonType": "pmod(k, 12)", "AccessMask": "concat('0x', hex(cast(pow(2, pmod(k, 21)) as bigint)))",
    "ObjectName": "concat('C:\\\\d', k)", "Status": "if(k % 2 = 0, '0x0', '0x6')",
    "SeverityValue": "2", "IpAddress": "concat('10.4.0.', k)", "IpPort": "'5394'",
}


MASK_SQL = """CASE WHEN k % 21 IN (16, 6) THEN 'remove' WHEN k % 21 IN (1, 8, 4, 2) THEN 'modify'
 WHEN k % 21 IN (0, 7, 3, 17) THEN 'access' WHEN k % 21 = 5 THEN 'execute'
 WHEN k % 21 IN (18, 19) THEN 'grant' WHEN k % 21 = 20 THEN 'sync' ELSE 'UnknownInteractionCategory' END"""


@query(f"""WITH {E_SQL} SELECT event_id, CASE event_type WHEN 'click' THEN 'login' WHEN 'view' THEN {MASK_SQL}
  WHEN 'error' THEN 'enable' ELSE 'login' END AS interaction_action,
 CASE event_type WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'success' ELSE 'failure' END
  WHEN 'signup' THEN 'ongoing' ELSE 'success' END AS interaction_status,
 CASE WHEN event_type = 'click' THEN CAST(k % 12 AS INTEGER) END AS "interaction_logonType",
 CASE WHEN event_type IN ('view', 'error') THEN 's' || user_id ELSE 'u' || user_id END AS subject_name,
 CASE event_type WHEN 'signup' THEN 'REALM' WHEN 'view' THEN 'SUB' WHEN 'error' THEN 'SUB' ELSE 'CORP' END
  AS subject_domain,
 CASE event_type WHEN 'click' THEN 'host' WHEN 'view' THEN 'file' WHEN 'error' THEN 'system' ELSE 'account' END
  AS object_category,
 CASE event_type WHEN 'error' THEN 'u' || user_id WHEN 'purchase' THEN 'SRV$' END AS object_name,
 CASE WHEN event_type = 'view' THEN 'C:\\d' || k END AS object_path,
 CASE WHEN event_type = 'click' AND k % 12 = 2 THEN '10.1.' || (user_id % 200) || '.' || k
  ELSE '10.4.0.' || k END AS source_ip,
 CASE WHEN event_type = 'click' THEN '10.1.' || (user_id % 200) || '.' || k END AS destination_ip,
 'srv' || k AS destination_hostname, epoch AS "data_originTime"
 FROM e WHERE {VALID_ORG}""")
def normalize_windows(spark, folder):
    df = normalized(spark, folder, preparsed(WIN), "windows").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "interaction.action", "interaction.status", "interaction.logonType", "subject.name",
        "subject.domain", "object.category", "object.name", "object.path", "source.ip",
        "destination.ip", "destination.hostname", "data.originTime")])


# All event ids, and what is particular to them.
WIN_KINDS = {
    "logon": ["4624", "4801", "4625"], "group+": ["4728", "4732", "4746", "4751", "4756", "4761", "4785", "4787"],
    "group-": ["4729", "4733", "4747", "4752", "4757", "4762", "4786", "4788"], "group": ["4764"],
    "user": ["4720", "4722", "4723", "4724", "4725", "4726"], "kerberos": ["4768", "4771"], "ntlm": ["4776"], "password": ["4794"],
    "history": ["4765", "4766"], "ticket": ["4769"], "change": ["4738"], "policy": ["4719"], "object": ["4663", "5140", "5145"],
}
WIN_IDS = sorted(x for ids in WIN_KINDS.values() for x in ids)
WIN_ALL = {
    **WIN, "EventID": f"element_at(array({', '.join(WIN_IDS)}), cast(pmod(event_id, {len(WIN_IDS)}) as int) + 1)",
    "TargetUserName": "concat('u', user_id, if(pmod(event_id, 3) = 0, '@D.ORG', ''))", "ServiceName": "if(k % 2 = 0, 'krbtgt/REALM', 'SRV')",
    **{name: f"concat('{name}', k)" for name in (
        "SubjectUserSid", "SubjectLogonId", "ShareName", "ShareLocalPath", "ProfilePath", "MemberName", "MemberSid", "UserParameters",
        "AuditPolicyChanges", "SubcategoryId", "SubcategoryGuid", "CategoryId", "PrimaryGroupId", "ServiceSid", "RelativeTargetName",
        "PreAuthType", "LogonGuid", "GroupTypeChange", "TicketOptions", "PrivilegeList", "PasswordLastSet", "AccessList")},
}


def of_kind(cases: dict[str, str], otherwise: str = "NULL") -> str:
    """SQL by the kinds of event ids, several separated by blanks; an id stands for itself before its kind does."""
    single = [f"WHEN x.id = '{key}' THEN {value}" for key, value in cases.items() if key.isdigit()]
    kinds = [f"WHEN x.kind IN ({', '.join(repr(k) for k in key.split())}) THEN {value}" for key, value in cases.items() if not key.isdigit()]
    return f"CASE {' '.join(single + kinds)} ELSE {otherwise} END"


TARGET = "'u' || user_id || CASE WHEN event_id % 3 = 0 THEN '@D.ORG' ELSE '' END"
GROUPS = "group+ group- group"
WIN_COLUMNS = {
    "data.msgId": "x.id",
    "interaction.action": of_kind({
        "4722": "'enable'", "4725": "'disable'", "4720": "'create'", "4726": "'remove'", "logon kerberos ntlm ticket": "'login'",
        "group+": "'enable'", "group-": "'disable'", "object": MASK_SQL}, "'modify'"),
    "interaction.status": of_kind({
        "4625": "'failure'", "4771": "'failure'", "4766": "'failure'", "4768": "'ongoing'", "4776": "'ongoing'",
        "password ticket": "CASE WHEN k % 2 = 0 THEN 'success' ELSE 'failure' END"}, "'success'"),
    "subject.name": of_kind({"logon kerberos ntlm": TARGET, "ticket": "'u' || user_id"}, "'s' || user_id"),
    "subject.domain": of_kind({
        "kerberos": "CASE WHEN k % 2 = 0 THEN 'REALM' ELSE 'SRV' END", "ntlm": "NULL", "logon ticket": "'CORP'"}, "'SUB'"),
    "subject.id": of_kind({"logon kerberos": "'S-' || user_id", "ntlm ticket": "NULL"}, "'SubjectUserSid' || k"),
    "object.category": of_kind({"4625": "'account'", "4663": "'file'", "logon": "'host'", "object": "'url'", GROUPS: "'system'", "policy": "'rule'"}, "'account'"),
    "object.name": of_kind({
        "4663": "NULL", f"{GROUPS} user history change": TARGET, "ticket": "CASE WHEN k % 2 = 0 THEN 'krbtgt/REALM' ELSE 'SRV' END",
        "policy": "'SubcategoryId' || k", "object": "'ShareName' || k"}),
    "object.domain": of_kind({f"{GROUPS} user history change": "'CORP'"}),
    "object.id": of_kind({f"{GROUPS} user history change": "'S-' || user_id", "ticket": "'ServiceSid' || k", "policy": "'SubcategoryGuid' || k"}),
    "object.path": of_kind({"4663": "'C:\\d' || k", "object": "'ShareLocalPath' || k", "change": "'ProfilePath' || k"}),
    "object.property": of_kind({GROUPS: "'GroupMember'"}),
    "object.value": of_kind({GROUPS: "'MemberName' || k", "change": "'UserParameters' || k", "policy": "'AuditPolicyChanges' || k"}),
    "object.group": of_kind({"change": "'PrimaryGroupId' || k", "policy": "'CategoryId' || k"}),
    "data.aux1": of_kind({"logon": "'s' || user_id", GROUPS: "'MemberSid' || k", "object": "'RelativeTargetName' || k"}),
    "data.aux3": of_kind({
        "logon": "'SubjectUserSid' || k", "kerberos ticket": "'TicketOptions' || k", "history": "'PrivilegeList' || k",
        "change": "'PasswordLastSet' || k", "object": "'AccessList' || k"}),
}


@query(f"""WITH {E_SQL}, x AS (SELECT e.*, t.id, t.kind FROM e JOIN (VALUES
 {', '.join(f"({WIN_IDS.index(x)}, '{x}', '{kind}')" for kind, ids in WIN_KINDS.items() for x in ids)}) t(n, id, kind) ON t.n = e.event_id % {len(WIN_IDS)})
SELECT event_id, {', '.join(f'{value} AS "{name.replace(".", "_")}"' for name, value in WIN_COLUMNS.items())} FROM x WHERE {VALID_ORG}""")
def normalize_windows_ids(spark, folder):
    """Every mapped event id, with what is particular to it."""
    df = normalized(spark, folder, preparsed(WIN_ALL), "windows").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in WIN_COLUMNS])


# All single-line audit types: action, category of the object.
AUDIT_TYPES = {
    "ADD_GROUP": ("create", "userGroup"), "ADD_USER": ("create", "account"), "DEL_GROUP": ("remove", "userGroup"), "DEL_USER": ("remove", "account"),
    "EXECVE": ("execute", "command"), "SERVICE_START": ("start", "process"), "SERVICE_STOP": ("stop", "process"), "USER_AUTH": ("login", "system"),
    "USER_CHAUTHTOK": ("modify", "account"), "USER_CMD": ("execute", "command"), "USER_END": ("logout", "system"), "USER_LOGIN": ("login", "system"),
}
AUDIT_EACH = (
    f"node=n type={{element_at(array({', '.join(repr(t) for t in AUDIT_TYPES)}), cast(pmod(event_id, {len(AUDIT_TYPES)}) as int) + 1)}} "
    "msg=audit({epoch}.111:{event_id}): pid={user_id} uid={k} auid=7 ses=3 subj=sub a0=\"ls\" msg='op=op{k} id={event_id} cwd=\"/w\" cmd=c{k} "
    "exe=\"/bin/x\" hostname=h addr=10.0.0.{k} terminal=tty{k} res={if(k % 2 = 0, 'success', 'failed')}'")


@query(f"""WITH {E_SQL}, x AS (SELECT e.*, t.* FROM e JOIN (VALUES
 {', '.join(f"({n}, '{t}', '{a}', '{c}')" for n, (t, (a, c)) in enumerate(AUDIT_TYPES.items()))}) t(n, t, a, c) ON t.n = e.event_id % {len(AUDIT_TYPES)})
SELECT event_id, t AS "data_msgId", a AS interaction_action, c AS object_category,
 CASE WHEN t = 'EXECVE' OR k % 2 = 0 THEN 'success' ELSE 'failure' END AS interaction_status,
 CASE WHEN t IN ('USER_AUTH', 'USER_END', 'USER_LOGIN') THEN CAST(event_id AS VARCHAR) ELSE CAST(k AS VARCHAR) END AS subject_id,
 CASE WHEN t = 'USER_AUTH' THEN 'account' END AS subject_category, CAST(event_id AS VARCHAR) AS object_id, 'ls' AS object_name,
 '10.0.0.' || k AS source_ip, CAST(user_id AS VARCHAR) AS data_aux2, '3' AS data_aux4,
 CASE WHEN t IN ('USER_AUTH', 'USER_END') THEN 'tty' || k WHEN t = 'USER_CMD' THEN 'c' || k ELSE 'sub' END AS data_aux5,
 CASE WHEN t = 'USER_CMD' THEN 'sub' ELSE '/bin/x' END AS data_aux6,
 CASE WHEN t = 'USER_AUTH' THEN 'op' || k WHEN t <> 'USER_CMD' THEN 'tty' || k END AS data_aux7,
 CASE WHEN t = 'USER_AUTH' THEN 'sub' WHEN t = 'USER_CHAUTHTOK' THEN 'op' || k END AS data_aux8,
 CASE WHEN t = 'USER_CMD' THEN 'tty' || k WHEN t = 'USER_LOGIN' THEN 'sub' END AS data_aux9,
 CASE WHEN t = 'USER_CMD' THEN '/w' WHEN t = 'USER_END' THEN 'op' || k END AS data_aux10
 FROM x WHERE {VALID_ORG}""")
def normalize_audit_types(spark, folder):
    """Every single-line audit type but AVC, whose line has another form."""
    df = normalized(spark, folder, s(AUDIT_EACH), "audit").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "data.msgId", "interaction.action", "object.category", "interaction.status", "subject.id", "subject.category", "object.id",
        "object.name", "source.ip", *[f"data.aux{n}" for n in (2, 4, 5, 6, 7, 8, 9, 10)])])


AUDIT_SINGLE = (
    "node=n type={case event_type when 'click' then 'USER_AUTH' when 'view' then 'EXECVE' "
    "when 'error' then 'ADD_USER' when 'purchase' then 'USER_CMD' else 'BOGUS' end} "
    "msg=audit({epoch}.111:{event_id}): pid={user_id} uid={k} auid=7 ses=3 subj=sub argc=3 a0=\"ls\" "
    "a1=\"-l\" a2=\"/d{k}\" msg='op=PAM acct=\"u{user_id}\" exe=\"/bin/x\" id={k} addr=10.0.0.9 "
    "terminal=ssh cwd=\"/h\" cmd=\"c\" res={if(k % 2 = 0, 'success', 'failed')}'"
)


@query(f"""WITH {E_SQL} SELECT event_id,
 CASE event_type WHEN 'click' THEN 'login' WHEN 'view' THEN 'execute' WHEN 'error' THEN 'create'
  ELSE 'execute' END AS interaction_action,
 CASE WHEN event_type = 'view' OR k % 2 = 0 THEN 'success' ELSE 'failure' END AS interaction_status,
 CASE event_type WHEN 'click' THEN 'system' WHEN 'error' THEN 'account' ELSE 'command' END AS object_category,
 CASE WHEN event_type = 'view' THEN 'ls -l /d' || k END AS object_value, 'u' || user_id AS subject_name,
 CAST(k AS VARCHAR) AS subject_id, epoch AS "data_originTime",
 CASE event_type WHEN 'click' THEN 'ssh' WHEN 'purchase' THEN 'c' ELSE 'sub' END AS data_aux5,
 CASE event_type WHEN 'click' THEN 'PAM' WHEN 'purchase' THEN NULL ELSE 'ssh' END AS data_aux7,
 CASE WHEN event_type = 'purchase' THEN '/h' END AS data_aux10
 FROM e WHERE {VALID_ORG} AND event_type <> 'signup'""")
def normalize_audit(spark, folder):
    df = normalized(spark, folder, s(AUDIT_SINGLE), "audit").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "interaction.action", "interaction.status", "object.category", "object.value", "subject.name",
        "subject.id", "data.originTime", "data.aux5", "data.aux7", "data.aux10")])


@query(f"""WITH {E_SQL} SELECT event_id, 'execute' AS interaction_action, 'success' AS interaction_status,
 'application' AS object_category, 'c' || k AS object_name, 'SYSCALL' AS "data_msgId",
 least('/bin/a' || k, '/bin/b' || user_id) AS data_aux3, greatest('/bin/a' || k, '/bin/b' || user_id) AS data_aux4,
 epoch AS "data_originTime" FROM e WHERE {VALID_ORG}""")
def normalize_audit_multi(spark, folder):
    from secflow.operators.normalize import mappers_with

    mappers = mappers_with({"59": "execute"}, {"59": "application"})
    df = normalized(spark, folder, s(AUDIT_LINE), "audit", mappers=mappers).where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "interaction.action", "interaction.status", "object.category", "object.name", "data.msgId",
        "data.aux3", "data.aux4", "data.originTime")])


AV = {
    "event_type": "case event_type when 'click' then 'Audit_Event' when 'view' then 'FilteredWebsites_Event' "
                  "when 'error' then 'Threat_Event' else 'FirewallAggregated_Event' end",
    "ipv4": "concat('10.5.0.', k)", "hostname": "concat('h', user_id, '.x.org')",
    "occured": "date_format(timestamp_seconds(epoch), 'dd-MMM-yyyy HH:mm:ss')", "severity": "'critical'",
    "action": "if(k % 2 = 0, 'login attempt', 'cleaned by deleting')", "detail": "concat('x ''u', user_id, '''')",
    "user": "''", "result": "'success'", "target_address": "concat('192.0.2.', k)", "need_restart": "k % 2 = 0",
    "threat_type": "'trojan'", "aggregate_count": "k",
}


@query(f"""WITH {E_SQL} SELECT event_id,
 CASE event_type WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'login' END WHEN 'view' THEN 'lock'
  WHEN 'error' THEN CASE WHEN k % 2 = 1 THEN 'remove' END ELSE 'connect' END AS interaction_action,
 'HIGH' AS interaction_importance, 'u' || user_id AS subject_name,
 CASE WHEN event_type = 'view' THEN '10.5.0.' || k END AS source_ip,
 CASE WHEN event_type = 'view' THEN '192.0.2.' || k ELSE '10.5.0.' || k END AS destination_ip,
 CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN 'malwareObject' ELSE 'process' END AS object_category,
 CASE WHEN event_type = 'error' THEN 'trojan' ELSE CAST(k AS VARCHAR) END AS data_aux5,
 CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS data_aux7, epoch AS "data_originTime"
 FROM e WHERE {VALID_ORG}""")
def normalize_json_antivirus(spark, folder):
    raw = F.concat(F.lit("av "), F.to_json(preparsed(AV)))
    df = normalized(spark, folder, raw, "json_antivirus").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in (
        "interaction.action", "interaction.importance", "subject.name", "source.ip", "destination.ip",
        "object.category", "data.aux5", "data.aux7", "data.originTime")])


CONNECTOR = {
    "ID": "event_id", "DetectionTime": WIN["EventTime"], "EventTime": "'t'", "EventType": "event_type",
    "SensorName": "'s'", "ModuleName": "'m'", "Severity": "'moderate'", "Organization": "'o'",
    "TypeActivity": "if(event_type = 'click', 'NetworkAttack', 'Scan')", "Block": "k % 2",
    "Deleted": "if(k % 5 = 0, 1, 0)", "SourceIP": "concat('10.6.0.', k)", "IP": "concat('10.7.0.', k)",
    "HostName": "concat('host', user_id, '~x')", "UserName": "concat('u', user_id)", "Port": "k",
    "URL": "if(event_type = 'view', 'http://x', null)", "ObjectPath": "if(event_type = 'error', '/p', null)",
}
CONNECTOR_COMMON = """
 CASE WHEN k % 5 = 0 THEN 'remove' WHEN k % 2 = 1 THEN 'lock' ELSE 'detect' END AS interaction_action,
 CASE WHEN event_type = 'click' THEN '10.6.0.' || k ELSE '10.7.0.' || k END AS source_ip,
 CASE WHEN event_type = 'click' THEN '10.7.0.' || k END AS destination_ip,
 CASE WHEN event_type = 'click' THEN CAST(k AS INTEGER) END AS destination_port, 'LOW' AS interaction_importance"""
CONNECTOR_LEAVES = (
    "interaction.action", "source.ip", "destination.ip", "destination.port", "interaction.importance",
    "subject.name", "object.name", "object.path", "object.category", "destination.hostname",
)


@query(f"""WITH {E_SQL} SELECT event_id, {CONNECTOR_COMMON},
 CASE WHEN event_type <> 'click' THEN 'u' || user_id END AS subject_name,
 CASE WHEN event_type = 'click' THEN 'u' || user_id END AS object_name,
 CASE event_type WHEN 'view' THEN 'http://x' WHEN 'error' THEN '/p' END AS object_path,
 CASE event_type WHEN 'click' THEN 'account' WHEN 'view' THEN 'UnknownCounterpart'
  WHEN 'error' THEN 'UnknownCounterpart' END AS object_category,
 CASE WHEN event_type = 'click' THEN 'host' || user_id END AS destination_hostname
 FROM e WHERE {VALID_ORG}""")
def normalize_connector_a(spark, folder):
    df = normalized(spark, folder, preparsed(CONNECTOR), "connector_a").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in CONNECTOR_LEAVES])


@query(f"""WITH {E_SQL} SELECT event_id, {CONNECTOR_COMMON}, 'u' || user_id AS subject_name,
 CAST(NULL AS VARCHAR) AS object_name,
 CASE event_type WHEN 'view' THEN 'http://x' WHEN 'error' THEN '/p' END AS object_path,
 CASE event_type WHEN 'view' THEN 'url' WHEN 'error' THEN 'file' END AS object_category,
 CASE WHEN event_type = 'click' THEN 'host' || user_id || '~x' END AS destination_hostname
 FROM e WHERE {VALID_ORG}""")
def normalize_connector_b(spark, folder):
    df = normalized(spark, folder, preparsed(CONNECTOR), "connector_b").where("outcome = 'valid'")
    return df.select(event_id(), *[leaf(x) for x in CONNECTOR_LEAVES])


# States, ids, statistics ----------------------------------------------------------------------


def mixed_values(spark, folder):
    """Several formats in one stream: firewall, fail2ban, Windows, broken envelopes, unknown types."""
    value = (
        F.when(F.col("event_type") == "click", envelope(s(FW_LINE), "firewall"))
        .when(F.col("event_type") == "view", envelope(s(F2B_LINE), "fail2ban"))
        .when(F.col("event_type") == "error", F.concat(F.lit("broken "), F.col("event_id").cast("string")))
        .when(F.col("event_type") == "purchase", envelope(preparsed(WIN), "windows"))
        .otherwise(envelope(s(F2B_LINE), "nobody"))
    )
    return events(spark, folder).select(value.alias("value"))


MIXED_SQL = f"""{E_SQL}, o AS (
 SELECT *, user_id % 25 IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 3) AS off FROM e
), x AS (
 SELECT *, CASE WHEN event_type = 'error' THEN 'error'
  WHEN off OR event_type = 'signup' OR (event_type = 'click' AND k % 7 = 0) THEN 'invalid'
  ELSE 'valid' END AS outcome,
  CASE event_type WHEN 'click' THEN 'firewall' WHEN 'view' THEN 'fail2ban' WHEN 'purchase' THEN 'windows'
   WHEN 'signup' THEN 'nobody' ELSE 'unknown' END AS dev_type,
  CASE WHEN event_type = 'error' THEN 'unknown' ELSE 'NATION_' || (user_id % 25) END AS organization FROM o
), st AS (
 SELECT x.*, s.state FROM x JOIN (VALUES ('valid', 'normalized'), ('valid', 'raw'), ('valid', 'chain'),
  ('invalid', 'invalid'), ('invalid', 'raw'), ('invalid', 'chain'), ('error', 'error')) s(outcome, state)
 ON x.outcome = s.outcome
)"""
MIXED_KINDS = ["firewall", "fail2ban", "windows"]


def mixed_job(spark, folder):
    dims = dimensions(spark, folder)
    return normalize_job(mixed_values(spark, folder), preferences(dims), vendors(dims),
                         pipelines=MIXED_KINDS, algo="md5")


@query(f"""WITH {MIXED_SQL} SELECT state, dev_type, organization, count(*) AS n,
 count(CASE WHEN state = 'normalized' THEN 1 END) AS with_event,
 count(CASE WHEN state = 'invalid' THEN 1 END) AS with_reason FROM st GROUP BY ALL""")
def split_into_states(spark, folder):
    return mixed_job(spark, folder).groupBy("state", "dev_type", "organization").agg(
        F.count("*").alias("n"), F.count("normalized.id").alias("with_event"),
        F.count("invalid.reason").alias("with_reason"))


@query(f"""WITH {MIXED_SQL} SELECT organization, dev_type,
 CASE WHEN event_type = 'error' THEN 'unknown' ELSE '10.9.9.9' END AS collector_host, state,
 CASE WHEN event_type = 'error' THEN 'unknown' ELSE 'h' || user_id || '.example.org' END AS source_host,
 count(*) AS messages,
 CAST(sum(CASE WHEN state IN ('normalized', 'raw', 'chain') AND epoch >= 1705300000 THEN 1 ELSE 0 END) AS BIGINT)
  AS out_of_time FROM st GROUP BY ALL""")
def pipeline_statistics(spark, folder):
    stats = pipeline_stats(mixed_job(spark, folder), now=F.lit(1705300000))
    return stats.drop("bytes")


@query(f"""WITH {MIXED_SQL} SELECT event_id, md5('broken ' || event_id) AS id, 'broken ' || event_id AS raw,
 'not a JSON object' AS stacktrace, 'unknown' AS organization FROM st WHERE state = 'error'""")
def error_events(spark, folder):
    job = mixed_job(spark, folder).where("state = 'error'")
    return job.select(F.regexp_extract("error.raw", "[0-9]+", 0).cast("bigint").alias("event_id"),
                      "error.id", "error.raw", "error.stacktrace", "error.collector.organization")


@query("""SELECT doc_id, CAST(40 AS INTEGER) AS n_chars, true AS is_hex, min(doc_id) OVER (PARTITION BY text) AS first_equal,
 min(doc_id) OVER (PARTITION BY source, text) AS first_of_source FROM documents""")
def content_ids(spark, folder):
    """RIPEMD-160 ids of the whole document texts and of source and text.

    The SQL engine has no such digest: checked are its form, and that ids are equal exactly where the texts are.
    """
    docs = table(spark, folder, "documents").select(
        "doc_id", ids.message_ids(F.col("source"), F.lit("/"), F.col("text")).alias("i"))
    first = lambda c: F.min("doc_id").over(Window.partitionBy(c))
    return docs.select(
        "doc_id", F.length("i.raw_id").alias("n_chars"), F.col("i.raw_id").rlike("^[0-9a-f]+$").alias("is_hex"),
        first("i.raw_id").alias("first_equal"), first("i.norm_id").alias("first_of_source"))


@query("""SELECT doc_id, md5(text || source) AS md5_id, sha256(text) AS sha_id FROM documents""")
def content_ids_native(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", ids.md5_id(F.col("text"), F.col("source")).alias("md5_id"),
        ids.content_id(F.col("text"), algo="sha256").alias("sha_id"))


@query(f"""WITH {E_SQL} SELECT event_id, epoch AS seconds, epoch AS millis, epoch AS micros_, epoch AS nanos,
 CAST(NULL AS BIGINT) AS odd FROM e""")
def epoch_units(spark, folder):
    e = events(spark, folder)
    at = dates.epoch_of_units
    return e.select("event_id", at(s("{epoch}")).alias("seconds"), at(s("{epoch}123")).alias("millis"),
                    at(s("{micros}")).alias("micros_"), at(s("{micros}999")).alias("nanos"),
                    at(s("{epoch}1")).alias("odd"))


@query(f"""WITH {MIXED_SQL} SELECT event_id, epoch + 3600 AS shifted, epoch AS "eventTime" FROM st
 WHERE state = 'normalized'""")
def time_shift(spark, folder):
    job = shift_time(mixed_job(spark, folder), "shift", 3600).where("state = 'normalized'")
    return job.select(F.col("normalized.collector.inputId").cast("bigint").alias("event_id"),
                      F.col("normalized.data.time").alias("shifted"), "normalized.eventTime")


@query(f"""WITH {E_SQL} SELECT event_id, {MASK_SQL} AS action FROM e""")
def windows_access_mask(spark, folder):
    return events(spark, folder).select(
        "event_id", enums.access_mask_action(F.expr(WIN["AccessMask"])).alias("action"))


@query(f"""WITH {MIXED_SQL} SELECT id, "eventTime", source_ip, subject_name, collector_location_host, data_time
 FROM (SELECT event_id AS id, epoch AS "eventTime", CASE event_type WHEN 'click' THEN '10.0.0.' || k
  WHEN 'view' THEN '22.33.' || (user_id % 250) || '.' || k ELSE '10.4.0.' || k END AS source_ip,
  CASE event_type WHEN 'click' THEN 'u' || user_id WHEN 'view' THEN NULL ELSE 'u' || user_id END AS subject_name,
  '10.9.9.9' AS collector_location_host, epoch AS data_time FROM st WHERE state = 'normalized')""")
def flatten_struct(spark, folder):
    job = mixed_job(spark, folder).where("state = 'normalized'").select("normalized.*")
    flat = flatten(job)
    return flat.select(
        F.col("collector_inputId").cast("bigint").alias("id"), "eventTime", "source_ip", "subject_name",
        "collector_location_host", "data_time")


@query("""SELECT c_custkey, regexp_replace(regexp_replace(c_name || ' ' || c_mktsegment || '.x', '\\.| ', '_', 'g'),
 '[^a-zA-Z0-9_-]', '', 'g') AS metric,
 CASE WHEN c_custkey % 3 = 0 THEN 'host' || c_custkey || '.a.org' END AS fqdn, 'host' || c_custkey AS hostname
 FROM customer""")
def text_helpers(spark, folder):
    c = table(spark, folder, "customer")
    full = s("host{c_custkey}.a.org")
    short = s("host{c_custkey}")
    third = F.expr("c_custkey % 3 = 0")
    fqdn, hostname = text.split_host(F.when(~third, short), F.when(third, full).otherwise(short))
    return c.select(
        "c_custkey", text.metric_name(s("{c_name} {c_mktsegment}.x")).alias("metric"),
        fqdn.alias("fqdn"), hostname.alias("hostname"))
