"""Controls with strict keys, checked by trying every path of every rule of the organization."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.enrichment import EVENT_SQL, RULES_SQL, SCHEDULE_OK, holidays, logged, staff_dims, who_event
from secflow.operators import dims as D
from secflow.operators.strict_rules import strict_control

QUERIES, SQL = {}, {}


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn
    return register


def rules(spark, folder, **changed):
    """Rules of the staff with some columns drawn anew from the rule id."""
    return D.denorm_rules(staff_dims(spark, folder)).withColumns({n: F.expr(c) for n, c in changed.items()})


def out_of(df, spark, folder, own, kind):
    return strict_control(df, own, kind, holidays(spark, folder)).select("event_id", "rule_id", "verdict")


# Logons -----------------------------------------------------------------------------------------
# Rules name hosts by name, address, both or not at all; events lack some names and some logins.

LOGON_SQL = f"""WITH {RULES_SQL}, {EVENT_SQL},
q AS (SELECT n, org, lower(domain) AS dom, lower(login) AS log, result, f, t, grp, typed,
 CASE WHEN n % 3 = 0 THEN 'host' || (n % 20) END AS qsh, CASE WHEN n % 5 < 2 THEN '10.0.0.' || (n % 20) END AS qsi,
 CASE WHEN n % 7 < 2 THEN 'host' || (n // 4 % 20) END AS qdh, CASE WHEN n % 11 < 3 THEN '10.0.0.' || (n // 4 % 20) END AS qdi
 FROM r WHERE kind = 0),
w AS (SELECT *, coalesce(qsh, qsi) IS NOT NULL AND coalesce(qdh, qdi) IS NOT NULL AS two,
 coalesce(qsh, qsi, qdh, qdi) IS NULL AS none, coalesce(qsi, qdi) IS NOT NULL AS adr, coalesce(qsh, qdh) IS NOT NULL AS nam FROM q),
p AS (SELECT *, qsi AS a, qdi AS b, false AS named FROM w WHERE adr OR none
 UNION ALL SELECT *, qsh, qdh, true FROM w WHERE nam OR none
 UNION ALL SELECT *, qsi, qdh, true FROM w WHERE two AND adr
 UNION ALL SELECT *, qsh, qdi, false FROM w WHERE two AND nam),
y AS (SELECT *, CASE WHEN event_type = 'click' THEN si ELSE sh END AS s_key,
 CASE WHEN k % 3 = 0 THEN di ELSE dh END AS d_key, k % 3 <> 0 AS by_name FROM x WHERE event_type <> 'error'),
b AS (SELECT y.*, p.n AS rule_id, p.result, p.f, p.t, p.grp, p.typed FROM y JOIN p ON p.org = y.org AND p.named = y.by_name
  AND coalesce(p.dom, y.domain) = y.domain AND coalesce(p.log, y.login) = y.login
  AND coalesce(p.a, y.s_key) = y.s_key AND coalesce(p.b, y.d_key) = y.d_key
 QUALIFY row_number() OVER (PARTITION BY event_id
  ORDER BY p.dom IS NULL, p.log IS NULL, p.a IS NULL, p.b IS NULL, p.n) = 1)
SELECT x.event_id, b.rule_id, CASE WHEN b.rule_id IS NOT NULL THEN
 {logged(ok=f"({SCHEDULE_OK} AND (NOT b.typed OR b.logon IN (2, 3, 10)))")} END AS verdict
FROM x LEFT JOIN b USING (event_id)"""


@query(LOGON_SQL)
def strict_windows_logon(spark, folder):
    own = rules(
        spark, folder, domain="lower(domain)", login="lower(login)",
        source_host="if(rule_id % 3 = 0, concat('host', rule_id % 20), null)",
        source_ip="if(rule_id % 5 < 2, concat('10.0.0.', rule_id % 20), null)",
        destination_host="if(rule_id % 7 < 2, concat('host', rule_id div 4 % 20), null)",
        destination_ip="if(rule_id % 11 < 3, concat('10.0.0.', rule_id div 4 % 20), null)")
    df = who_event(
        spark, folder, interaction__logonType=F.expr("k % 12"), data__originTime=0,
        subject__name=F.expr("if(event_type = 'error', null, concat('U', user_id % 60))"),
        source__hostname=F.expr("if(event_type = 'click', null, concat('Host', k % 20))"),
        destination__hostname=F.expr("if(k % 3 = 0, null, concat('host', cents % 20))"))
    return out_of(df, spark, folder, own, "windows_logon")


# VPN logons -------------------------------------------------------------------------------------

VPN_SQL = f"""WITH {RULES_SQL}, {EVENT_SQL},
y AS (SELECT *, 'Dom' || (k % 3) AS dom, 'U' || (user_id % 60) AS log FROM x WHERE event_type <> 'signup'),
b AS (SELECT y.*, r.n AS rule_id, r.result, r.f, r.t, r.grp FROM y JOIN r ON r.org = y.org AND r.kind = 3
  AND coalesce(r.domain, y.dom) = y.dom AND coalesce(r.login, y.log) = y.log
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY r.domain IS NULL, r.login IS NULL, r.n) = 1)
SELECT x.event_id, b.rule_id, CASE WHEN b.rule_id IS NOT NULL THEN {logged()} END AS verdict
FROM x LEFT JOIN b USING (event_id)"""


@query(VPN_SQL)
def strict_vpn(spark, folder):
    df = who_event(
        spark, folder, data__originTime=0, subject__domain=F.expr("concat('Dom', k % 3)"),
        subject__name=F.expr("if(event_type = 'signup', null, concat('U', user_id % 60))"))
    return out_of(df, spark, folder, rules(spark, folder), "vpn_logon")


# Objects ----------------------------------------------------------------------------------------
# Rules on c:\, on folders, on files and on no path; paths that go on below a rule or end above it.

STARS = " || ".join(f"CASE WHEN pl.path[{i}] IS NULL THEN '' WHEN pl.path[{i}] = '*' THEN '1' ELSE '0' END" for i in range(1, 6))
FITS = " AND ".join(f"(pl.path[{i}] IS NULL OR pl.path[{i}] IN ('*', y.keys[{i}]))" for i in range(1, 6))
OBJECT_SQL = f"""WITH {RULES_SQL}, {EVENT_SQL},
q AS (SELECT n, org, coalesce(domain, '*') AS dom, coalesce(login, '*') AS log, result,
 CASE WHEN n % 3 = 0 THEN 'host' || (n % 20) END AS qsh, CASE WHEN n % 5 = 0 THEN '10.0.0.' || (n // 4 % 20) END AS qsi,
 CASE n // 4 % 4 WHEN 0 THEN ['c', 'd' || (n // 16 % 6)] WHEN 1 THEN ['c', 'd' || (n // 16 % 6), 'f' || (n // 8 % 3)]
  WHEN 2 THEN ['c'] ELSE [] END AS parts FROM r WHERE kind = 2),
h AS (SELECT *, qsh AS host FROM q WHERE qsh IS NOT NULL UNION ALL SELECT *, qsi FROM q WHERE qsi IS NOT NULL
 UNION ALL SELECT *, '*' FROM q WHERE qsh IS NULL AND qsi IS NULL),
sp AS (SELECT n, org, dom, log, result, list_concat([host], parts) AS path FROM h
 UNION ALL SELECT n, org, dom, log, result, list_concat([host], parts, ['*']) FROM h),
pf AS (SELECT *, unnest(range(1, len(path) + 1)) AS i FROM sp),
places AS (SELECT org, dom, log, path[1:i] AS path, bool_or(i < len(path)) AS inside FROM pf GROUP BY ALL),
pl AS (SELECT places.*, sp.n, sp.result FROM places JOIN sp ON sp.org = places.org AND sp.dom = places.dom AND sp.log = places.log
  AND sp.path = places.path[1:len(sp.path)] AND len(sp.path) <= len(places.path)
 QUALIFY row_number() OVER (PARTITION BY places.org, places.dom, places.log, places.path ORDER BY len(sp.path) DESC, sp.n) = 1),
y AS (SELECT *, 'Dom' || (k % 3) AS d_key, 'U' || (user_id % 60) AS l_key, list_concat(
  [CASE WHEN event_type = 'click' THEN '10.0.0.' || (k % 20) ELSE 'host' || (cents % 20) END],
  CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN ['c', 'd' || (k % 8)] WHEN k % 11 = 0 THEN []
   ELSE ['c', 'd' || (k % 8), 'f' || (cents % 4), 'x'] END) AS keys FROM x WHERE event_type <> 'error'),
b AS (SELECT y.event_id, pl.n AS rule_id, pl.result FROM y JOIN pl ON pl.org = y.org AND pl.dom IN ('*', y.d_key)
  AND pl.log IN ('*', y.l_key) AND len(pl.path) <= len(y.keys) AND (len(pl.path) = len(y.keys) OR NOT pl.inside) AND {FITS}
 QUALIFY row_number() OVER (PARTITION BY y.event_id ORDER BY pl.dom = '*', pl.log = '*', {STARS}) = 1)
SELECT x.event_id, b.rule_id, b.result AS verdict FROM x LEFT JOIN b USING (event_id)"""


@query(OBJECT_SQL)
def strict_windows_object(spark, folder):
    own = rules(
        spark, folder, source_host="if(rule_id % 3 = 0, concat('host', rule_id % 20), null)",
        source_ip="if(rule_id % 5 = 0, concat('10.0.0.', rule_id div 4 % 20), null)",
        obj_path="""case rule_id div 4 % 4 when 0 then concat('C:\\\\D', rule_id div 16 % 6)
            when 1 then concat('c:\\\\d', rule_id div 16 % 6, '\\\\f', rule_id div 8 % 3) when 2 then 'c:\\\\' end""")
    df = who_event(
        spark, folder, subject__domain=F.expr("concat('Dom', k % 3)"), subject__name=F.expr("concat('U', user_id % 60)"),
        eventSource__location__hostname=F.expr("if(event_type in ('click', 'error'), null, concat('host', cents % 20))"),
        eventSource__location__ip=F.expr("if(event_type = 'error', null, concat('10.0.0.', k % 20))"),
        object__category=F.expr("if(k % 7 = 0, 'url', 'file')"), object__name=F.expr("concat('\\\\??\\\\C:\\\\D', k % 8)"),
        object__path=F.expr("""case when k % 5 = 0 then concat('c:\\\\d', k % 8, '\\\\') when k % 11 = 0 then null
            else concat('C:\\\\D', k % 8, '\\\\F', cents % 4, '\\\\x') end"""))
    return out_of(df, spark, folder, own, "windows_object")
