"""Geo lookup, schedules, access controls and the dimension joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.tables import E_SQL, ORG, canonical, dimensions, events, s, table
from secflow.functions.net import is_ip, is_private_ip
from secflow.operators import dims as D
from secflow.operators.controls import CONTROLS, control
from secflow.operators.geo import enrich_geo, geo_lookup
from secflow.operators.schedule import schedule_flags
from secflow.operators.stats import enrichment_stats
from secflow.plans.enrich import enrich_job
from secflow.session import checkpoint_dir, spread
from secflow.streaming.versions import publish_rules, read_rules

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return register


# Geo ------------------------------------------------------------------------------------------
# Networks grow with the supplier table: a /16 per supplier, a /24 inside every third of them, and
# a country /8 per nation.

SRC_IP = "concat(20 + pmod(user_id, 30), '.', pmod(event_id, 40), '.', k, '.', pmod(cents, 250))"
DST_IP = ("case event_type when 'click' then concat('10.0.', k, '.1') when 'view' then null "
          "when 'error' then concat('2001:db8:', lower(hex(k)), '::', lower(hex(pmod(event_id, 60000)))) "
          "when 'signup' then concat('::ffff:', 20 + pmod(k, 30), '.1.', k, '.7') else 'bad' end")


def geo_tables(spark, folder):
    sup = table(spark, folder, "supplier").selectExpr("s_suppkey as n", "s_nationkey as c")
    city = (
        sup.selectExpr("concat('city', n) as city", "if(n % 4 = 0, null, concat('land', c)) as country",
                       "concat('org', n) as org", "cast(n as string) as org_id",
                       "concat(20 + n % 30, '.', n div 30 % 250, '.0.0/16') as network")
        .unionByName(sup.where("n % 3 = 0").selectExpr(
            "concat('town', n) as city", "concat('land', c) as country", "concat('torg', n) as org",
            "cast(n as string) as org_id",
            "concat(20 + n % 30, '.', n div 30 % 250, '.', n % 100, '.0/24') as network"))
        .unionByName(sup.selectExpr(
            "concat('six', n) as city", "'six' as country", "cast(null as string) as org",
            "cast(n as string) as org_id", "concat('2001:db8:', lower(hex(n % 100)), '::/48') as network"))
    )
    # One supplier per network: the rows whose network repeats keep the greatest attributes.
    country = table(spark, folder, "nation").selectExpr(
        "concat('country', n_nationkey) as country", "concat('corg', n_nationkey) as org",
        "cast(n_nationkey as string) as org_id", "concat(20 + n_nationkey, '.0.0.0/8') as network")
    return city, country


GEO_SQL = f"""{E_SQL}, sup AS (SELECT s_suppkey AS n, s_nationkey AS c FROM supplier),
ip AS (SELECT *, 20 + user_id % 30 AS a, event_id % 40 AS b FROM e),
net AS (
 SELECT 20 + n % 30 AS a, n // 30 % 250 AS b, -1 AS d, 16 AS len, 'city' || n AS city,
  CASE WHEN n % 4 = 0 THEN NULL ELSE 'land' || c END AS country, 'org' || n AS org, CAST(n AS VARCHAR) AS org_id FROM sup
 UNION ALL SELECT 20 + n % 30, n // 30 % 250, n % 100, 24, 'town' || n, 'land' || c, 'torg' || n, CAST(n AS VARCHAR)
  FROM sup WHERE n % 3 = 0),
best AS (SELECT * FROM net QUALIFY row_number() OVER (PARTITION BY a, b, d ORDER BY city DESC NULLS LAST) = 1)"""


@query(f"""WITH {GEO_SQL}, hit AS (
 SELECT ip.event_id, arg_max(best, best.len) AS g FROM ip JOIN best ON ip.a = best.a AND ip.b = best.b
  AND (best.d = -1 OR best.d = ip.k) GROUP BY ip.event_id)
SELECT ip.event_id, g.city AS city, coalesce(g.country, 'country' || n.n_nationkey) AS country,
 coalesce(g.org, 'corg' || n.n_nationkey) AS org,
 CASE WHEN g IS NULL THEN CASE WHEN n.n_nationkey IS NULL THEN NULL ELSE ip.a || '.0.0.0/8' END
  WHEN g.len = 16 THEN g.a || '.' || g.b || '.0.0/16' ELSE g.a || '.' || g.b || '.' || g.d || '.0/24' END AS network,
 false AS local
FROM ip LEFT JOIN hit USING (event_id) LEFT JOIN nation n ON n.n_nationkey = ip.a - 20""")
def geo_longest_prefix(spark, folder):
    city, country = geo_tables(spark, folder)
    df = events(spark, folder).select("event_id", F.expr(SRC_IP).alias("ip"))
    found = geo_lookup(df, ["ip"], city, country)
    return found.select("event_id", *[F.col("ip_geo")[a].alias(a) for a in ("city", "country", "org", "network")],
                        F.col("ip_local").alias("local"))


@query(f"""WITH {E_SQL} SELECT event_id, event_type NOT IN ('view', 'purchase') AS valid,
 CASE event_type WHEN 'click' THEN true WHEN 'error' THEN false WHEN 'signup' THEN false END AS private FROM e""")
def ip_predicates(spark, folder):
    df = events(spark, folder).withColumn("ip", F.expr(DST_IP))
    return df.select("event_id", is_ip(F.col("ip")).alias("valid"), is_private_ip(F.col("ip")).alias("private"))


@query(f"""WITH {GEO_SQL}, six AS (SELECT n % 100 AS g, max('six' || n) AS city FROM sup GROUP BY 1)
SELECT ip.event_id, CASE WHEN event_type = 'error' THEN six.city
  WHEN event_type = 'signup' THEN m.city END AS destination_city,
 CASE event_type WHEN 'click' THEN true WHEN 'error' THEN false WHEN 'signup' THEN false END AS destination_local
FROM ip LEFT JOIN six ON six.g = ip.k
LEFT JOIN best m ON m.a = 20 + ip.k % 30 AND m.b = 1 AND m.d = -1
 AND NOT EXISTS (SELECT 1 FROM best t WHERE t.a = m.a AND t.b = 1 AND t.d = ip.k)
UNION ALL SELECT NULL, NULL, NULL WHERE false""".replace(
    "WHEN event_type = 'signup' THEN m.city END", "WHEN event_type = 'signup' THEN coalesce(t.city, m.city) END").replace(
    """LEFT JOIN best m ON m.a = 20 + ip.k % 30 AND m.b = 1 AND m.d = -1
 AND NOT EXISTS (SELECT 1 FROM best t WHERE t.a = m.a AND t.b = 1 AND t.d = ip.k)
UNION ALL SELECT NULL, NULL, NULL WHERE false""",
    """LEFT JOIN best m ON m.a = 20 + ip.k % 30 AND m.b = 1 AND m.d = -1
LEFT JOIN best t ON t.a = 20 + ip.k % 30 AND t.b = 1 AND t.d = ip.k"""))
def geo_event_enrichment(spark, folder):
    """Both ends of canonical events; IPv6, IPv4-mapped, private and unreadable addresses."""
    city, country = geo_tables(spark, folder)
    df = canonical(events(spark, folder), source__ip=F.expr(SRC_IP), destination__ip=F.expr(DST_IP))
    out = enrich_geo(df, city, country)
    d = F.col("event.destination.enrichment")
    return out.select("event_id", d["geo"]["city"].alias("destination_city"),
                      d["isNetworkLocal"].alias("destination_local"))


@query("""WITH g AS (SELECT 'city' || c_nationkey AS city, 'n' || c_custkey AS network, c_custkey % 4 AS load_id
 FROM customer) SELECT city, string_agg(network, ';' ORDER BY network) AS networks FROM g
 WHERE load_id = (SELECT max(load_id) FROM g) GROUP BY city""")
def latest_geo_load(spark, folder):
    g = table(spark, folder, "customer").selectExpr(
        "concat('city', c_nationkey) as city", "concat('n', c_custkey) as network", "c_custkey % 4 as load_id")
    return D.network_lists(D.latest_load(g), ["city"])


# Dimensions -----------------------------------------------------------------------------------


def staff_dims(spark, folder):
    """Organizations are nations; subjects, hosts, objects, schedules and rules come from customers."""
    customer = table(spark, folder, "customer").selectExpr("cast(c_custkey as int) as n", "c_nationkey as c")
    nation = table(spark, folder, "nation")
    orgs = nation.selectExpr(
        "cast(n_nationkey as int) as id", "n_name as short_name", "n_name as name",
        "timestamp_seconds(0) as active_from", "cast(null as timestamp) as active_to")
    groups = nation.selectExpr("cast(n_nationkey % 6 as int) as id").distinct().selectExpr(
        "id", "concat('g', id) as group_name")
    schedule = groups.selectExpr(
        "id", "id as group_id",
        "case id when 0 then 0 when 1 then 28800 when 2 then 32400 when 3 then 79200 when 4 then 43200 else 0 end as time_from",
        "case id when 0 then 0 when 1 then 64800 when 2 then 61200 when 3 then 21600 when 4 then 0 else 43200 end as time_to",
        "case id when 1 then 5 when 3 then 2 when 4 then 3 else 7 end as days_work",
        "case id when 1 then 2 when 3 then 2 when 4 then 1 else 0 end as days_weekend",
        "id in (2, 4) as is_calendar")
    subject = customer.selectExpr(
        "n as id", "if(n % 5 = 0, null, concat('U', n % 60)) as login", "cast(c as int) as org_id",
        "concat('user', n) as user_name", "cast(n % 7 as int) as group_id", "cast(null as string) as phone",
        "cast(null as string) as email", "true as monitored", "if(n % 4 = 0, null, concat('Dom', n % 3)) as user_domain",
        "timestamp_seconds(1704067200 - (n % 9) * 86400) as start_work")
    hosts = customer.selectExpr(
        "n as id", "if(n % 2 = 0, concat('host', n % 20), null) as host_name", "cast(c as int) as org_id",
        "cast(null as string) as user_name", "if(n % 2 = 1, concat('10.0.0.', n % 20), null) as host_ip",
        "timestamp_seconds(0) as added", "cast(null as string) as description")
    objects = customer.selectExpr(
        "n as id", "if(n % 2 = 0, 'file', 'protocol') as obj_type",
        "case when n % 2 = 0 then case n % 8 when 0 then concat('c:\\\\d', n % 10, '\\\\*') when 2 then 'c:\\\\*' "
        "when 4 then concat('C:\\\\d', n % 10, '\\\\f', n % 3) else null end end as obj_path",
        "case when n % 2 = 0 then null when n % 3 = 0 then 'TCP' else 'udp' end as obj_name",
        "cast(null as int) as port")
    rules = customer.selectExpr(
        "n as id", "n as subject", "if(n % 3 = 0, n, null) as source", "if(n % 7 = 0, n, null) as destination",
        "if(n % 9 = 0, null, n) as object", "cast(n % 2 as int) as result", "'' as use_case_id",
        "case pmod(n, 4) when 0 then 'WindowsLogon' when 1 then 'FirewallConnection' when 2 then 'WindowsObject' "
        "else 'VpnLogon' end as type", "cast(n % 6 as int) as schedule",
        "case when n % 4 = 0 then if(n % 8 = 0, null, '2;3;10') when n % 4 = 1 then if(n % 5 = 0, '100-2000', null) end as aux1",
        "case when n % 4 = 1 then if(n % 3 = 0, '22,400-500', null) end as aux2")
    return {"organizations": orgs, "schedule_groups": groups, "schedule": schedule, "subject": subject,
            "hosts": hosts, "objects": objects, "rules": rules}


def holidays(spark, folder):
    """A calendar drawn from the order dates, moved to the year of the events."""
    return table(spark, folder, "orders").selectExpr(
        "make_date(2024, 1, day(cast(o_orderdate as timestamp))) as holiday").where(
        "day(holiday) % 6 = 0").distinct()


# Access rules in SQL, one row per rule; must agree with ``staff_dims``.
RULES_SQL = f"""{E_SQL}, r AS (
 SELECT CAST(c_custkey AS INTEGER) AS n, 'nation_' || c_nationkey AS org,
  CASE WHEN n % 4 = 0 THEN NULL ELSE 'Dom' || (n % 3) END AS domain, CASE WHEN n % 5 = 0 THEN NULL ELSE 'U' || (n % 60) END AS login,
  CASE WHEN n % 3 = 0 AND n % 2 = 0 THEN 'host' || (n % 20) END AS sh, CASE WHEN n % 3 = 0 AND n % 2 = 1 THEN '10.0.0.' || (n % 20) END AS si,
  CASE WHEN n % 7 = 0 AND n % 2 = 0 THEN 'host' || (n % 20) END AS dh, CASE WHEN n % 7 = 0 AND n % 2 = 1 THEN '10.0.0.' || (n % 20) END AS di,
  CASE WHEN n % 9 <> 0 AND n % 2 = 1 THEN CASE WHEN n % 3 = 0 THEN 'tcp' ELSE 'udp' END END AS proto,
  n % 4 AS kind, CASE WHEN n % 2 = 0 THEN 'Allowed' ELSE 'Restricted' END AS result, n % 6 AS grp,
  CASE n % 6 WHEN 0 THEN 0 WHEN 1 THEN 28800 WHEN 2 THEN 32400 WHEN 3 THEN 79200 WHEN 4 THEN 43200 ELSE 0 END AS f,
  CASE n % 6 WHEN 0 THEN 0 WHEN 1 THEN 64800 WHEN 2 THEN 61200 WHEN 3 THEN 21600 WHEN 4 THEN 0 ELSE 43200 END AS t,
  CASE WHEN n % 4 = 0 AND n % 8 <> 0 THEN true ELSE false END AS typed
 FROM customer
), hol AS (SELECT DISTINCT make_date(2024, 1, day(o_orderdate)) AS holiday FROM orders WHERE day(o_orderdate) % 6 = 0)"""


def within_sql(p: str, f: str = "r.f", t: str = "r.t") -> str:
    return (f"(CASE WHEN {f} > {t} AND {t} = 0 THEN {p} >= {f} WHEN {f} > {t} THEN {p} >= {f} OR {p} <= {t} "
            f"ELSE {p} BETWEEN {f} AND {t} END)")


SCHEDULE_OK = f"""((CASE WHEN b.grp IN (2, 4) THEN NOT EXISTS (SELECT 1 FROM hol WHERE hol.holiday = b.day)
 WHEN b.grp = 3 THEN false WHEN b.grp = 1 THEN b.dow <= 5 ELSE true END)
 AND ((b.f = 0 AND b.t = 0) OR {within_sql('b.sec', 'b.f', 'b.t')}))"""

TIME_RANK = f"""CASE WHEN {within_sql('x.sec')} THEN 0 WHEN r.f = 0 THEN 1 END"""


def key_rank(event_keys: list[str], rule_keys: list[str]) -> str:
    """Rank of a rule in an exact layer: position of the first event key among its keys."""
    cases = []
    for i, e in enumerate(event_keys):
        hit = " OR ".join(f"{e} = {k}" for k in rule_keys)
        cases.append(f"WHEN {hit} THEN {i}")
    missing = " AND ".join(f"{k} IS NULL" for k in rule_keys)
    return f"CASE {' '.join(cases)} WHEN {missing} THEN {len(event_keys)} END"


EVENT_SQL = """x AS (SELECT *, 'nation_' || (user_id % 25) AS org, CAST(epoch % 86400 AS INTEGER) AS sec,
 CAST(make_timestamp(epoch * 1000000) AS DATE) AS day, isodow(make_timestamp(epoch * 1000000)) AS dow,
 'dom' || (k % 3) AS domain, 'u' || (user_id % 60) AS login,
 'host' || (k % 20) AS sh, '10.0.0.' || (cents % 20) AS si, 'host' || (cents % 20) AS dh, '10.0.0.' || (k % 20) AS di,
 k % 12 AS logon FROM e)"""

WHO = dict(collector__organization=F.lit)


def who_event(spark, folder, **extra):
    df = events(spark, folder)
    base = dict(
        collector__organization=F.expr(ORG), subject__category="account",
        subject__domain=F.expr("concat('DOM', k % 3)"), subject__name=F.expr("concat('u', user_id % 60)"),
        source__hostname=F.expr("concat('Host', k % 20)"), source__ip=F.expr("concat('10.0.0.', cents % 20)"),
        destination__hostname=F.expr("concat('host', cents % 20)"), destination__ip=F.expr("concat('10.0.0.', k % 20)"),
        data__originTime=F.col("epoch"), eventTime=F.col("epoch"), eventSource__title="Windows Server")
    return canonical(df, **{**base, **extra})


def ranked_sql(kind: int, ranks: list[str], extra: str = "") -> str:
    names = ", ".join(f"{r} AS r{i}" for i, r in enumerate(ranks))
    keep = " AND ".join(f"r{i} IS NOT NULL" for i in range(len(ranks)))
    order = ", ".join(f"r{i}" for i in range(len(ranks)))
    return f"""m AS (SELECT * FROM (SELECT x.*, r.n AS rule_id, r.result, r.f, r.t, r.grp, r.typed, {names}
 FROM x JOIN r ON r.org = x.org AND r.kind = {kind} {extra}) WHERE {keep}
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {order}, rule_id) = 1)"""


def logged(result: str = "b.result", ok: str = SCHEDULE_OK) -> str:
    return f"CASE WHEN {ok} THEN {result} WHEN {result} = 'Allowed' THEN 'Restricted' ELSE 'Allowed' END"


LOGON_RANKS = [
    key_rank(["x.domain"], ["lower(r.domain)"]), key_rank(["x.login"], ["lower(r.login)"]),
    key_rank(["x.sh", "x.si"], ["r.sh", "r.si"]), key_rank(["x.dh", "x.di"], ["r.dh", "r.di"]), TIME_RANK]
LOGON_OK = f"({SCHEDULE_OK} AND (NOT b.typed OR b.logon IN (2, 3, 10)))"


@query(f"""WITH {RULES_SQL}, {EVENT_SQL}, {ranked_sql(0, LOGON_RANKS)}
SELECT x.event_id, b.rule_id, CASE WHEN b.rule_id IS NOT NULL THEN {logged(ok=LOGON_OK)} END AS verdict
FROM x LEFT JOIN m b USING (event_id)""")
def control_windows_logon(spark, folder):
    df = who_event(spark, folder, interaction__logonType=F.expr("k % 12"), interaction__action="login",
                   object__category="host")
    rules = D.denorm_rules(staff_dims(spark, folder))
    out = control(df, rules, "windows_logon", holidays(spark, folder))
    return out.select("event_id", "rule_id", "verdict")


VPN_RANKS = [key_rank(["('Dom' || (x.k % 3))"], ["r.domain"]), key_rank(["('U' || (x.user_id % 60))"], ["r.login"]), TIME_RANK]


@query(f"""WITH {RULES_SQL}, {EVENT_SQL}, {ranked_sql(3, VPN_RANKS)}
SELECT x.event_id, CASE WHEN x.event_type <> 'click' THEN b.rule_id END AS rule_id,
 CASE WHEN b.rule_id IS NOT NULL AND x.event_type <> 'click' THEN {logged()} END AS verdict
FROM x LEFT JOIN m b USING (event_id)""")
def control_vpn(spark, folder):
    df = who_event(
        spark, folder, subject__domain=F.expr("concat('Dom', k % 3)"), subject__name=F.expr("concat('U', user_id % 60)"),
        interaction__action=F.expr("if(event_type = 'click', 'down', 'up')"), data__aux9="vpn")
    rules = D.denorm_rules(staff_dims(spark, folder))
    return control(df, rules, "vpn_logon", holidays(spark, folder)).select("event_id", "rule_id", "verdict")


PORT_1 = """CASE WHEN r.n % 5 = 0 THEN CASE WHEN x.k * 30 BETWEEN 100 AND 2000 THEN 0 END
 ELSE CASE WHEN x.k * 30 = 0 THEN 0 ELSE 1 END END"""
PORT_2 = """CASE WHEN r.n % 3 = 0 THEN CASE WHEN x.cents % 600 = 22 OR x.cents % 600 BETWEEN 400 AND 500 THEN 0 END
 ELSE CASE WHEN x.cents % 600 = 0 THEN 0 ELSE 1 END END"""
FW_RANKS = [
    key_rank(["x.sh", "x.si"], ["r.sh", "r.si"]), key_rank(["x.dh", "x.di"], ["r.dh", "r.di"]),
    key_rank(["(CASE WHEN x.k % 2 = 0 THEN 'tcp' ELSE 'udp' END)"], ["r.proto"]), PORT_1, PORT_2]


@query(f"""WITH {RULES_SQL}, {EVENT_SQL}, {ranked_sql(1, FW_RANKS)}
SELECT x.event_id, b.rule_id, b.result AS verdict FROM x LEFT JOIN m b USING (event_id)""")
def control_connection(spark, folder):
    df = who_event(
        spark, folder, eventSource__category="Firewall", source__port=F.expr("k * 30"),
        destination__port=F.expr("cast(cents % 600 as int)"),
        interaction__protocol=F.expr("if(k % 2 = 0, 'TCP', 'UDP')"))
    rules = D.denorm_rules(staff_dims(spark, folder))
    return control(df, rules, "connection", holidays(spark, folder)).select("event_id", "rule_id", "verdict")


# Paths of object rules: c:\dN\* (a), c:\* (b), c:\dN\fM (c) or none (d).  The tree spans all
# organizations, so its leaves are known from the rules as a whole.
OBJECT_SQL = r"""p AS (SELECT r.*, CASE WHEN n % 9 = 0 THEN 'd' ELSE CASE n % 8 WHEN 0 THEN 'a' WHEN 2 THEN 'b' WHEN 4 THEN 'c' ELSE 'd' END END AS shape,
  'd' || (n % 10) AS dir, 'f' || (n % 3) AS leaf FROM r WHERE kind = 2),
y AS (SELECT x.*, 'd' || (k % 12) AS dir, 'f' || (cents % 4) AS leaf, k % 5 = 0 AS short FROM x),
z AS (SELECT y.*, EXISTS (SELECT 1 FROM p WHERE (p.shape IN ('a', 'c')) AND p.dir = y.dir) AS dir_known FROM y)"""
PATH_RANK = """CASE WHEN p.shape = 'c' THEN CASE WHEN p.dir = x.dir AND NOT x.short AND p.leaf = x.leaf THEN '000' END
 WHEN p.shape = 'a' THEN CASE WHEN p.dir = x.dir AND NOT x.short THEN '001' END
 WHEN p.shape = 'b' THEN CASE WHEN x.short THEN '01' ELSE '01' END
 ELSE '1' END"""


def object_sql() -> str:
    ranks = [
        key_rank(["x.domain"], ["lower(p.domain)"]), key_rank(["x.login"], ["lower(p.login)"]),
        key_rank(["x.dh", "x.di"], ["p.sh", "p.si"]), PATH_RANK, TIME_RANK.replace("r.", "p.")]
    names = ", ".join(f"{r} AS r{i}" for i, r in enumerate(ranks))
    keep = " AND ".join(f"r{i} IS NOT NULL" for i in range(len(ranks)))
    return f"""WITH {RULES_SQL}, {EVENT_SQL}, {OBJECT_SQL},
m AS (SELECT * FROM (SELECT x.event_id, p.n AS rule_id, p.result, {names} FROM z x JOIN p ON p.org = x.org) WHERE {keep}
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY r0, r1, r2, r3, r4, rule_id) = 1)
SELECT x.event_id, m.rule_id, m.result AS verdict FROM x LEFT JOIN m USING (event_id)"""


@query(object_sql())
def control_windows_object(spark, folder):
    path = "concat('C:\\\\D', k % 12, if(k % 5 = 0, '', concat('\\\\F', cents % 4)))"
    df = who_event(spark, folder, object__category="file", object__path=F.expr(path),
                   interaction__action=F.expr("if(k % 2 = 0, 'access', 'remove')"))
    rules = D.denorm_rules(staff_dims(spark, folder))
    return control(df, rules, "windows_object", holidays(spark, folder)).select("event_id", "rule_id", "verdict")


# Schedules ------------------------------------------------------------------------------------

LOGINS_SQL = """lg AS (SELECT * FROM (
 SELECT 'nation_' || c_nationkey AS org, CASE WHEN c_custkey % 4 = 0 THEN '*' ELSE 'dom' || (c_custkey % 3) END AS domain,
  CASE WHEN c_custkey % 5 = 0 THEN '*' ELSE 'u' || (c_custkey % 60) END AS login, CAST(c_custkey AS INTEGER) AS id,
  CAST(c_custkey % 7 AS INTEGER) AS group_id, CAST(make_timestamp((1704067200 - (c_custkey % 9) * 86400) * 1000000) AS DATE) AS start_day
 FROM customer) QUALIFY row_number() OVER (PARTITION BY org, domain, login ORDER BY id DESC) = 1)"""


@query(f"""WITH {LOGINS_SQL} SELECT org, domain, login, group_id, 'user' || id AS user_name FROM lg""")
def login_lookup(spark, folder):
    return D.logins(staff_dims(spark, folder)).select("org", "domain", "login", "group_id", "user_name")


FLAGS_SQL = f"""WITH {RULES_SQL}, {EVENT_SQL}, {LOGINS_SQL}, j AS (
 SELECT x.*, lg.group_id AS g, lg.start_day, lg.id AS subject,
  CASE lg.group_id WHEN 0 THEN 0 WHEN 1 THEN 480 WHEN 2 THEN 540 WHEN 3 THEN 1320 WHEN 4 THEN 720 WHEN 5 THEN 0 END AS mf,
  CASE lg.group_id WHEN 0 THEN 0 WHEN 1 THEN 1080 WHEN 2 THEN 1020 WHEN 3 THEN 360 WHEN 4 THEN 0 WHEN 5 THEN 720 END AS mt,
  x.sec // 60 AS minute, (SELECT count(*) FROM hol WHERE hol.holiday < x.day) AS passed,
  EXISTS (SELECT 1 FROM hol WHERE hol.holiday = x.day) AS holiday
 FROM x LEFT JOIN lg ON lg.org = x.org AND lg.domain = x.domain AND lg.login = x.login)
SELECT event_id, CASE WHEN subject IS NULL THEN NULL WHEN g = 6 THEN false
 WHEN mf > mt THEN minute >= mf OR minute <= mt WHEN mf = mt THEN true ELSE minute BETWEEN mf AND mt END AS time_allowed,
 CASE WHEN subject IS NULL THEN NULL WHEN g = 6 THEN false WHEN g IN (0, 2, 5) THEN true
  WHEN g = 1 THEN dow <= 5 AND NOT holiday
  WHEN g = 3 THEN ((day - start_day) % 4 + 4) % 4 < 2
  ELSE ((day - start_day - passed) % 4 + 4) % 4 < 3 END AS working_day FROM j"""


@query(FLAGS_SQL)
def schedule_flagging(spark, folder):
    dims = staff_dims(spark, folder)
    df = who_event(spark, folder)
    out = schedule_flags(df, D.logins(dims), dims["schedule"], holidays(spark, folder))
    flags = F.col("event.subject.enrichment")
    return out.select("event_id", flags["isTimeAllowed"].alias("time_allowed"),
                      flags["isWorkingDay"].alias("working_day"))


@query("""SELECT n.n_name AS organization, d.dev_type, d.tool AS parser_name, d.tool2 AS mapper_name
 FROM nation n CROSS JOIN (VALUES ('firewall', 'fortigate', 'fortigate'), ('asa', 'asa00401', 'asa00401'),
  ('ios', 'ios/isr00401', 'ios/isr00401'), ('audit', 'reassembledAuditD01', 'reassembledAuditD01'),
  ('json_antivirus', 'esetnode02701', 'esetnode02701'), ('fail2ban', 'fail2ban02901', 'fail2ban02901'),
  ('windows', 'windows_security', 'windows_security'), ('connector_a', 'unicon', 'kaspersky'),
  ('connector_b', 'unicon', 'symantec')) d(dev_type, tool, tool2) WHERE n.n_regionkey <> 3""")
def transformation_preferences(spark, folder):
    return D.preferences(dimensions(spark, folder)).select(
        "organization", "dev_type", "parser_name", "mapper_name")


@query(f"""WITH {RULES_SQL} SELECT r.n AS rule_id, upper(r.org) AS org, r.domain, r.login, r.sh AS source_host,
 r.si AS source_ip, r.dh AS destination_host, r.di AS destination_ip, r.result, r.f AS time_from, r.t AS time_to
 FROM r""")
def denormalized_rules(spark, folder):
    rules = D.denorm_rules(staff_dims(spark, folder))
    first = F.get("intervals", F.lit(0))
    return rules.select("rule_id", "org", "domain", "login", "source_host", "source_ip", "destination_host",
                        "destination_ip", "result", first["time_from"].alias("time_from"),
                        first["time_to"].alias("time_to"))


@query("""SELECT 'organizations' AS dimension, count(*) AS size, CAST(NULL AS BIGINT) AS last_updated FROM nation
 UNION ALL SELECT 'subject', count(*), max(CAST(c_custkey % 100 AS BIGINT)) FROM customer""")
def dimension_freshness(spark, folder):
    dims = staff_dims(spark, folder)
    subject = dims["subject"].withColumn("loaded_at", (F.col("id") % 100).cast("bigint"))
    return D.freshness({"organizations": dims["organizations"], "subject": subject})


# The whole job --------------------------------------------------------------------------------


def enriched(spark, folder):
    city, country = geo_tables(spark, folder)
    dims = staff_dims(spark, folder)
    df = who_event(
        spark, folder, source__ip=F.expr(SRC_IP), destination__ip=F.expr(DST_IP), interaction__action="login",
        interaction__logonType=F.expr("k % 12"), object__category="host",
        eventSource__title=F.expr("if(event_type = 'click', 'linux', 'Windows')"))
    return enrich_job(df, city, country, D.denorm_rules(dims), D.logins(dims), dims["schedule"],
                      holidays(spark, folder))


@query(f"""WITH {RULES_SQL}, {EVENT_SQL}, {LOGINS_SQL}
SELECT CASE WHEN event_type = 'click' THEN 'linux' ELSE 'Windows' END AS product,
 upper(x.org) AS organization, count(*) AS events,
 CAST(count(CASE WHEN event_type <> 'click' AND lg.id IS NOT NULL THEN 1 END) AS BIGINT) AS login_hit,
 CAST(count(CASE WHEN event_type = 'click' OR lg.id IS NULL THEN 1 END) AS BIGINT) AS login_miss
FROM x LEFT JOIN lg ON lg.org = x.org AND lg.domain = x.domain AND lg.login = x.login GROUP BY ALL""")
def enrichment_statistics(spark, folder):
    return enrichment_stats(enriched(spark, folder)).select(
        "product", "organization", "events", "login_hit", "login_miss")


@query(f"""WITH {GEO_SQL}, src AS (
 SELECT ip.event_id, ip.user_id, ip.event_type,
  EXISTS (SELECT 1 FROM best WHERE best.a = ip.a AND best.b = ip.b AND (best.d = -1 OR best.d = ip.k)) OR ip.a < 45 AS hit,
  CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 1 ELSE 0 END AS dst,
  CASE WHEN event_type = 'error' THEN ip.k IN (SELECT n % 100 FROM sup)
       WHEN event_type = 'signup' THEN ip.k % 30 < 25 OR EXISTS (SELECT 1 FROM best WHERE best.a = 20 + ip.k % 30
         AND best.b = 1 AND (best.d = -1 OR best.d = ip.k)) ELSE false END AS dhit FROM ip)
SELECT 'NATION_' || (user_id % 25) AS organization,
 CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END + CASE WHEN dst = 1 AND dhit THEN 1 ELSE 0 END) AS BIGINT) AS geo_hit,
 CAST(sum(CASE WHEN hit THEN 0 ELSE 1 END + CASE WHEN dst = 1 AND NOT dhit THEN 1 ELSE 0 END) AS BIGINT) AS geo_miss
FROM src GROUP BY ALL""")
def geo_statistics(spark, folder):
    city, country = geo_tables(spark, folder)
    df = who_event(spark, folder, source__ip=F.expr(SRC_IP), destination__ip=F.expr(DST_IP),
                   eventSource__title="p")
    return enrichment_stats(enrich_geo(df, city, country)).select("organization", "geo_hit", "geo_miss")


def _verdict_sql(kind: int, name: str) -> str:
    flag = "CASE v.verdict WHEN 'Allowed' THEN true WHEN 'Restricted' THEN false END"
    return (f"SELECT e.event_id, {flag} AS flag FROM (SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events) e"
            f" JOIN ({SQL[name]}) v USING (event_id) WHERE e.k % 3 = {kind}")


@query(" UNION ALL ".join(_verdict_sql(k, name) for k, name in enumerate(
    ("control_windows_logon", "control_vpn", "control_connection"))))
def enriched_verdicts(spark, folder):
    """The verdict flag of each event after the whole job, over logon, VPN and firewall events in one frame."""
    def part(n, expr):
        return F.when(F.col("k") % 3 == n, F.expr(expr))

    df = who_event(
        spark, folder,
        subject__domain=F.expr("if(k % 3 = 1, concat('Dom', k % 3), concat('DOM', k % 3))"),
        subject__name=F.expr("if(k % 3 = 1, concat('U', user_id % 60), concat('u', user_id % 60))"),
        interaction__action=F.coalesce(part(0, "'login'"), part(1, "if(event_type = 'click', 'down', 'up')")),
        interaction__logonType=part(0, "k % 12"), object__category=part(0, "'host'"), data__aux9=part(1, "'vpn'"),
        eventSource__category=part(2, "'Firewall'"), source__port=part(2, "k * 30"),
        destination__port=part(2, "cast(cents % 600 as int)"), interaction__protocol=part(2, "if(k % 2 = 0, 'TCP', 'UDP')"))
    city, country = geo_tables(spark, folder)
    dims = staff_dims(spark, folder)
    done = enrich_job(df, city, country, D.denorm_rules(dims), D.logins(dims), dims["schedule"], holidays(spark, folder))
    kinds = ("windows_logon", "vpn_logon", "connection")
    flags = [F.when(F.col("k") % 3 == n, F.col("event.subject.enrichment")[CONTROLS[kind].flag]) for n, kind in enumerate(kinds)]
    return done.select("event_id", F.coalesce(*flags).alias("flag"))


# Rules with many ranges -----------------------------------------------------------------------
# One organization, no other key: for each order a rule with a port or a few, and wide ranges among
# them, so that many points lie in several rules.

MANY_SQL = """many AS (SELECT CAST(o_orderkey AS INTEGER) AS n, o_custkey AS p, CAST(round(o_totalprice) AS INTEGER) % 50 AS q FROM orders), ports AS (
 SELECT n, n % 2 = 0 AS allowed, (p * 7 + n * 13) % 60000 AS low,
  (p * 7 + n * 13) % 60000 + CASE WHEN n % 50 = 0 THEN q * 100 WHEN n % 7 = 0 THEN q ELSE 0 END AS high,
  CASE WHEN n % 3 = 0 THEN (p + n) % 3000 END AS slow FROM many
)"""


@query(f"""WITH {E_SQL}, {MANY_SQL}, x AS (SELECT event_id, k * 30 AS sp, cents % 60000 AS dp FROM e), hits AS (
 SELECT x.event_id, p.n, p.allowed, CASE WHEN slow IS NULL THEN CASE WHEN x.sp = 0 THEN 0 ELSE 1 END
   WHEN x.sp BETWEEN slow AND slow + 40 THEN 0 WHEN slow = 0 THEN 1 END AS r0,
  CASE WHEN x.dp BETWEEN low AND high THEN 0 END AS r1
 FROM x JOIN ports p ON x.dp BETWEEN p.low AND p.high
 UNION ALL
 SELECT x.event_id, p.n, p.allowed, CASE WHEN slow IS NULL THEN CASE WHEN x.sp = 0 THEN 0 ELSE 1 END
   WHEN x.sp BETWEEN slow AND slow + 40 THEN 0 WHEN slow = 0 THEN 1 END, 1
 FROM x JOIN ports p ON p.low = 0
), best AS (SELECT * FROM hits WHERE r0 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY r0, r1, n) = 1)
SELECT x.event_id, n AS rule_id, CASE WHEN allowed THEN 'Allowed' WHEN NOT allowed THEN 'Restricted' END AS verdict
FROM x LEFT JOIN best USING (event_id)""")
def control_many_ranges(spark, folder):
    """Connections looked up among as many port rules of one organization as there are orders."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    numbered = spread(orders, 16 << 20).selectExpr(
        "cast(o_orderkey as int) as n", "o_custkey as p", "cast(round(o_totalprice) as int) % 50 as q")
    none = "cast(null as string)"
    rules = numbered.selectExpr(
        "n as rule_id", "'FirewallConnection' as type", "'org' as org",
        *[f"{none} as {c}" for c in ("source_host", "source_ip", "destination_host", "destination_ip", "obj_name")],
        "if(n % 2 = 0, 'Allowed', 'Restricted') as result",
        "cast(array() as array<struct<time_from:int,time_to:int,days_work:int,days_weekend:int,is_calendar:boolean>>) as intervals",
        "if(n % 3 = 0, concat((p + n) % 3000, '-', (p + n) % 3000 + 40), null) as aux1",
        "concat((p * 7 + n * 13) % 60000, '-', (p * 7 + n * 13) % 60000 + "
        "case when n % 50 = 0 then q * 100 when n % 7 = 0 then q else 0 end) as aux2")
    df = canonical(
        events(spark, folder), collector__organization="ORG", eventSource__category="Firewall",
        source__port=F.expr("k * 30"), destination__port=F.expr("cast(cents % 60000 as int)"))
    return control(df, rules, "connection", holidays(spark, folder)).select("event_id", "rule_id", "verdict")


# Deep networks, hot accounts and the whole job on each part of the event ----------------------

DEEP_IP = "concat(60 + pmod(user_id, 30), '.', pmod(event_id, 5), '.', k % 40 * k, '.', pmod(cents, 250))"


@query(f"""WITH {E_SQL}, ip AS (SELECT event_id, 60 + user_id % 30 AS a, event_id % 5 AS b, (k % 40 * k) AS c, cents % 250 AS d FROM e),
net AS (SELECT DISTINCT 60 + s_suppkey % 30 AS a, s_suppkey // 30 % 5 AS b, l AS len FROM supplier, unnest(range(16, 26)) t(l))
SELECT ip.event_id, CASE WHEN max(len) IS NULL THEN NULL ELSE 'c' || ip.a || '-' || ip.b || '-' || max(len) END AS city,
 CASE WHEN max(len) IS NULL THEN NULL ELSE ip.a || '.' || ip.b || '.0.0/' || max(len) END AS network
FROM ip LEFT JOIN net ON net.a = ip.a AND net.b = ip.b AND ip.c <= 255 AND ip.c * 256 + ip.d < (1 << (32 - len))
GROUP BY ip.event_id, ip.a, ip.b""")
def geo_nested_networks(spark, folder):
    """Addresses under up to ten networks, one inside the other."""
    sup = table(spark, folder, "supplier").selectExpr(
        "60 + s_suppkey % 30 as a", "s_suppkey div 30 % 5 as b", "explode(sequence(16, 25)) as len").distinct()
    city = sup.selectExpr(
        "concat('c', a, '-', b, '-', len) as city", "cast(null as string) as country", "cast(null as string) as org",
        "cast(null as string) as org_id", "concat(a, '.', b, '.0.0/', len) as network")
    none = city.where("false").drop("city")
    df = events(spark, folder).select("event_id", F.expr(DEEP_IP).alias("ip"))
    found = geo_lookup(df, ["ip"], city, none)
    return found.select("event_id", F.col("ip_geo")["city"].alias("city"), F.col("ip_geo")["network"].alias("network"))


HOT_SQL = (EVENT_SQL.replace("'nation_' || (user_id % 25) AS org", "CASE WHEN k % 3 = 0 THEN 'nation_1' ELSE 'nation_' || (user_id % 25) END AS org")
           .replace("'dom' || (k % 3) AS domain", "CASE WHEN k % 3 = 0 THEN 'dom1' ELSE 'dom' || (k % 3) END AS domain")
           .replace("'u' || (user_id % 60) AS login", "CASE WHEN k % 3 = 0 THEN 'u1' ELSE 'u' || (user_id % 60) END AS login"))


def hot_event(spark, folder, **extra):
    """Events of which one account has a third."""
    return who_event(
        spark, folder, collector__organization=F.expr(f"if(k % 3 = 0, 'NATION_1', {ORG})"),
        subject__domain=F.expr("if(k % 3 = 0, 'Dom1', concat('DOM', k % 3))"),
        subject__name=F.expr("if(k % 3 = 0, 'U1', concat('u', user_id % 60))"), **extra)


@query(f"""WITH m AS (WITH {RULES_SQL}, {HOT_SQL}, {ranked_sql(0, LOGON_RANKS)}
SELECT x.event_id, CASE WHEN b.rule_id IS NOT NULL THEN {logged(ok=LOGON_OK)} END AS verdict FROM x LEFT JOIN m b USING (event_id))
SELECT event_id, f.time_allowed, f.working_day, CASE m.verdict WHEN 'Allowed' THEN true WHEN 'Restricted' THEN false END AS host_allowed
FROM m JOIN ({FLAGS_SQL.replace(EVENT_SQL, HOT_SQL)}) f USING (event_id)""")
def enriched_hot_account(spark, folder):
    """Schedule flags and logon verdicts of the whole job where one account has a third of the events."""
    df = hot_event(spark, folder, interaction__logonType=F.expr("k % 12"), interaction__action="login", object__category="host")
    city, country = geo_tables(spark, folder)
    dims = staff_dims(spark, folder)
    done = enrich_job(df, city, country, D.denorm_rules(dims), D.logins(dims), dims["schedule"], holidays(spark, folder))
    flags = F.col("event.subject.enrichment")
    return done.select("event_id", flags["isTimeAllowed"].alias("time_allowed"), flags["isWorkingDay"].alias("working_day"),
                       flags["isHostAccessTimeAllowed"].alias("host_allowed"))


@query(f"""SELECT event_id, CASE verdict WHEN 'Allowed' THEN true WHEN 'Restricted' THEN false END AS object_allowed
 FROM ({object_sql()})""")
def enriched_objects(spark, folder):
    """The object verdict after the whole job, with rule tables that were prepared and written before."""
    path = "concat('C:\\\\D', k % 12, if(k % 5 = 0, '', concat('\\\\F', cents % 4)))"
    df = who_event(spark, folder, object__category="file", object__path=F.expr(path),
                   interaction__action=F.expr("if(k % 2 = 0, 'access', 'remove')"))
    city, country = geo_tables(spark, folder)
    dims = staff_dims(spark, folder)
    shared = f"{checkpoint_dir(spark)}/rules-{uuid.uuid4().hex}"
    publish_rules(D.denorm_rules(dims), shared)
    done = enrich_job(df, city, country, read_rules(spark, shared), D.logins(dims), dims["schedule"], holidays(spark, folder))
    return done.select("event_id", F.col("event.subject.enrichment.isObjectAccessAllowed").alias("object_allowed"))


@query(f"""SELECT event_id, s.city AS source_city, s.country AS source_country, s.network AS source_network, s.local AS source_local,
 d.destination_city, d.destination_local FROM ({SQL["geo_longest_prefix"]}) s JOIN ({SQL["geo_event_enrichment"]}) d USING (event_id)""")
def enriched_geo(spark, folder):
    """Geo data of both ends after the whole job."""
    df = who_event(spark, folder, source__ip=F.expr(SRC_IP), destination__ip=F.expr(DST_IP))
    city, country = geo_tables(spark, folder)
    dims = staff_dims(spark, folder)
    done = enrich_job(df, city, country, D.denorm_rules(dims), D.logins(dims), dims["schedule"], holidays(spark, folder))
    s, d = F.col("event.source.enrichment"), F.col("event.destination.enrichment")
    return done.select(
        "event_id", s["geo"]["city"].alias("source_city"), s["geo"]["country"].alias("source_country"), s["network"].alias("source_network"),
        s["isNetworkLocal"].alias("source_local"), d["geo"]["city"].alias("destination_city"), d["isNetworkLocal"].alias("destination_local"))
