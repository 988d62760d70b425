"""Rule files to dimension rows: find what exists, create what does not."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.operators.dims import Dims
from secflow.session import cut

HOUR = 3600


def number_rows(df: DataFrame, order: list[str], start: Column) -> DataFrame:
    """Add consecutive ``id``s after ``start``, without sorting everything in one task.

    Rows are numbered inside hash buckets; a bucket's offset is the size of those before it.  There
    are as many buckets as the session has shuffle partitions.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    numbered = df.withColumn("_b", bucket).withColumn(
        "_n", F.row_number().over(Window.partitionBy("_b").orderBy(*order))
    )
    sizes = df.groupBy(bucket.alias("_b")).agg(F.count("*").alias("size"))
    # One row for each bucket, so one window over them is small whatever the input is.
    offsets = sizes.select("_b", (
        F.sum("size").over(Window.orderBy("_b")) - F.col("size")).alias("_before"))
    return numbered.join(offsets, "_b").withColumn(
        "id", (start + F.col("_before") + F.col("_n")).cast("int")
    ).drop("_b", "_n", "_before")


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def resolve(existing: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The wanted natural keys (NULL equals NULL) with ``id`` and ``created``.

    Of several existing rows with one key the least id is taken; missing keys get new ids.  The
    result is checkpointed: every later step refers to it, and plans would otherwise double.
    """
    wanted = wanted.dropDuplicates(keys)
    known = existing.groupBy(*keys).agg(F.min("id").alias("_id"))
    looked_up = wanted.join(known, same(wanted, known, keys), "left").select(
        *[wanted[c] for c in wanted.columns], known["_id"])
    newest = F.coalesce(existing.agg(F.max("id")).scalar(), F.lit(0))
    found = looked_up.where(F.col("_id").isNotNull()).withColumnRenamed("_id", "id")
    new = number_rows(looked_up.where(F.col("_id").isNull()).drop("_id"), keys, newest)
    return cut(found.withColumn("created", F.lit(False)).unionByName(
        new.withColumn("created", F.lit(True))))


def new_rows(resolved: DataFrame) -> DataFrame:
    return resolved.where("created")


def _with_id(df: DataFrame, ids: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Attach a resolved id by its natural key."""
    renamed = ids.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("id").alias(name))
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"_{k}"]) for k in keys])
    return df.join(renamed, on, "left").drop(*[f"_{k}" for k in keys])


def schedule_of_hours(df: DataFrame) -> DataFrame:
    """Hours and weekend permission as a schedule: 7/0 or 5/2, with 24 stored as 0."""
    weekend = F.col("weekend")
    return df.withColumns({
        "time_from": (F.col("from_hour") * HOUR).cast("int"),
        "time_to": (F.pmod(F.col("to_hour"), F.lit(24)) * HOUR).cast("int"),
        "days_work": F.when(weekend, 7).otherwise(5),
        "days_weekend": F.when(weekend, 0).otherwise(2),
    })


SCHEDULE_KEY = ["time_from", "time_to", "days_work", "days_weekend"]
RULE_KEY = ["subject", "source", "destination", "object", "result", "use_case_id", "type",
            "schedule", "aux1", "aux2"]


def _schedules(lines: DataFrame, dims: Dims) -> tuple[DataFrame, dict[str, DataFrame]]:
    existing = dims["schedule"].select(*SCHEDULE_KEY, F.col("group_id").alias("id"))
    newest = dims["schedule_groups"].select(
        *[F.lit(None).cast("int").alias(k) for k in SCHEDULE_KEY], "id")
    ids = resolve(existing.unionByName(newest), lines.select(*SCHEDULE_KEY), SCHEDULE_KEY)
    created = new_rows(ids)
    return ids, {
        "schedule_groups": created.select(
            "id", F.concat(F.col("id").cast("string"), F.lit("-group")).alias("group_name")),
        "schedule": created.select(
            F.col("id").alias("group_id"), *SCHEDULE_KEY, F.lit(True).alias("is_calendar")),
    }


def _rules(wanted: DataFrame, dims: Dims) -> DataFrame:
    complete = wanted.select(*[
        (F.col(k) if k in wanted.columns else F.lit(None)).cast(dims["rules"].schema[k].dataType)
        .alias(k) for k in RULE_KEY
    ])
    resolved = resolve(dims["rules"].select(*RULE_KEY, "id"), complete, RULE_KEY)
    return new_rows(resolved).drop("created")


def _common(lines: DataFrame, dims: Dims, now: Column) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Organizations, hosts, schedules and subjects of logon and object rules."""
    created: dict[str, DataFrame] = {}
    orgs = resolve(
        dims["organizations"].select("short_name", "id"),
        lines.select(F.col("org").alias("short_name")), ["short_name"])
    created["organizations"] = new_rows(orgs).select(
        "id", "short_name", F.col("short_name").alias("name"), now.alias("active_from"),
        F.lit(None).cast("timestamp").alias("active_to"))
    lines = _with_id(lines, orgs.select(F.col("short_name").alias("org"), "id"), ["org"], "org_id")

    host_key = ["org_id", "host_name", "host_ip"]
    hosts = resolve(dims["hosts"].select(*host_key, "id"), lines.select(*host_key), host_key)
    created["hosts"] = new_rows(hosts).select("id", *host_key, now.alias("added"))
    lines = _with_id(lines, hosts, host_key, "host_id")

    lines = schedule_of_hours(lines)
    schedules, new_schedules = _schedules(lines, dims)
    created.update(new_schedules)
    lines = _with_id(lines, schedules, SCHEDULE_KEY, "schedule_id")

    # A subject created for several schedules gets the least group id.
    subject_key = ["org_id", "login", "user_domain"]
    wanted = lines.groupBy(*subject_key).agg(F.min("schedule_id").alias("group_id"))
    subjects = resolve(dims["subject"].select(*subject_key, "id"), wanted, subject_key)
    created["subject"] = new_rows(subjects).select(
        "id", *subject_key, "group_id", F.lit(True).alias("monitored"), now.alias("start_work"))
    return _with_id(lines, subjects, subject_key, "subject_id"), created


def load_logon_rules(csv: DataFrame, dims: Dims, now: Column | None = None) -> dict[str, DataFrame]:
    """Rows to add to each dimension table for a logon rule file."""
    lines = csv.select(
        "org", F.col("hostname").alias("host_name"), F.col("ip").alias("host_ip"),
        F.col("username").alias("login"), F.col("domain").alias("user_domain"), "logontype",
        F.col("fromHost").alias("from_host"), F.col("fromTime").cast("int").alias("from_hour"),
        F.col("toTime").cast("int").alias("to_hour"),
        F.col("isWeekendAllowed").cast("boolean").alias("weekend"),
    )
    lines, created = _common(lines, dims, F.current_timestamp() if now is None else now)
    keys = ["host_id", "subject_id", "schedule_id", "from_host"]
    wanted = logon_types(lines, keys).select(
        F.col("subject_id").alias("subject"), F.col("host_id").alias("destination"),
        F.lit(0).alias("result"), F.lit("").alias("use_case_id"),
        F.lit("WindowsLogon").alias("type"), F.col("schedule_id").alias("schedule"), "aux1")
    created["rules"] = _rules(wanted, dims)
    return created


def logon_types(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Logon types of one rule as a ``;`` list, in numeric order."""
    types = F.transform(
        F.array_sort(F.collect_list(F.struct(
            F.col("logontype").try_cast("int").alias("n"), F.col("logontype").alias("t")))),
        lambda s: s["t"])
    return lines.groupBy(*keys).agg(F.array_join(types, ";").alias("aux1"))


def load_object_rules(csv: DataFrame, dims: Dims, now: Column | None = None) -> dict[str, DataFrame]:
    """Rows to add for an object rule file; a mask of ``*`` means the whole folder."""
    lines = csv.select(
        "org", F.col("hostname").alias("host_name"), F.col("ip").alias("host_ip"),
        F.lit("file").alias("obj_type"), F.col("catalog").alias("obj_path"),
        F.when(F.col("filesMask") != "*", F.col("filesMask")).alias("obj_name"),
        F.col("username").alias("login"), F.col("userDomain").alias("user_domain"),
        F.col("fromTime").cast("int").alias("from_hour"), F.col("toTime").cast("int").alias("to_hour"),
        F.col("isWeekendAllowed").cast("boolean").alias("weekend"),
    )
    lines, created = _common(lines, dims, F.current_timestamp() if now is None else now)
    object_key = ["obj_type", "obj_path", "obj_name"]
    objects = resolve(dims["objects"].select(*object_key, "id"), lines.select(*object_key),
                           object_key)
    created["objects"] = new_rows(objects).select("id", *object_key, F.lit(None).cast("int").alias("port"))
    lines = _with_id(lines, objects, object_key, "object_id")
    wanted = lines.select(
        F.col("subject_id").alias("subject"), F.col("host_id").alias("source"),
        F.col("object_id").alias("object"), F.lit(0).alias("result"), F.lit("").alias("use_case_id"),
        F.lit("WindowsObject").alias("type"), F.col("schedule_id").alias("schedule"))
    created["rules"] = _rules(wanted, dims)
    return created


def merge_ranges(df: DataFrame, keys: list[str], col: str, out: str = "ranges") -> DataFrame:
    """Numbers of each key as maximal closed ranges, ``a-b,c``; keys without any give NULL.

    Equal numbers are folded before the window, which therefore sees at most the distinct ports
    of a key.
    """
    distinct = df.where(F.col(col).isNotNull()).select(*keys, col).distinct()
    island = F.col(col) - F.row_number().over(Window.partitionBy(*keys).orderBy(col))
    ranges = (
        distinct.withColumn("_island", island).groupBy(*keys, "_island")
        .agg(F.min(col).alias("low"), F.max(col).alias("high"))
    )
    text = F.transform(
        F.array_sort(F.collect_list(F.struct("low", "high"))),
        lambda r: F.when(r["low"] == r["high"], r["low"].cast("string")).otherwise(
            F.concat(r["low"].cast("string"), F.lit("-"), r["high"].cast("string"))),
    )
    merged = ranges.groupBy(*keys).agg(F.array_join(text, ",").alias(out))
    every = df.select(*keys).distinct()
    return every.join(merged, same(every, merged, keys), "left").select(
        *[every[k] for k in keys], merged[out])


def load_connection_rules(csv: DataFrame, dims: Dims, now: Column | None = None) -> dict[str, DataFrame]:
    """Rows to add for a connection rule file: one rule per (org, hosts, protocol) with port ranges."""
    at = F.current_timestamp() if now is None else now

    def cell(*names: str) -> Column:
        present = [F.col(n) for n in names if n in csv.columns]
        value = F.coalesce(*present) if present else F.lit(None).cast("string")
        return F.when(value != "any", value)

    lines = csv.select(
        F.col("organization").alias("org"), cell("src_host_ip").alias("src"),
        cell("target_host_ip").alias("dst"), cell("protocol_allowed", "proto").alias("proto"),
        F.coalesce(cell("allprotocolallowed").try_cast("boolean"), F.lit(False)).alias("all_proto"),
        cell("src_host_port").cast("int").alias("src_port"),
        cell("target_port_allowed", "target_host_port").cast("int").alias("dst_port"),
    )
    # A line for all protocols names none, whatever its protocol cell says.
    lines = lines.withColumn("proto", F.when(~F.col("all_proto"), F.col("proto"))).drop("all_proto")
    created: dict[str, DataFrame] = {}
    orgs = resolve(
        dims["organizations"].select("short_name", "id"),
        lines.select(F.col("org").alias("short_name")), ["short_name"])
    created["organizations"] = new_rows(orgs).select(
        "id", "short_name", F.col("short_name").alias("name"), at.alias("active_from"),
        F.lit(None).cast("timestamp").alias("active_to"))
    lines = _with_id(lines, orgs.select(F.col("short_name").alias("org"), "id"), ["org"], "org_id")

    host_key = ["org_id", "host_name", "host_ip"]
    ips = lines.select("org_id", F.explode(F.array_compact(F.array("src", "dst"))).alias("host_ip"))
    hosts = resolve(
        dims["hosts"].select(*host_key, "id"),
        ips.withColumn("host_name", F.lit(None).cast("string")), host_key)
    created["hosts"] = new_rows(hosts).select("id", *host_key, at.alias("added"))

    whole_day = lines.select(
        F.lit(0).alias("from_hour"), F.lit(0).alias("to_hour"), F.lit(True).alias("weekend")
    ).distinct()
    schedules, new_schedules = _schedules(schedule_of_hours(whole_day), dims)
    created.update(new_schedules)
    group = schedules.agg(F.min("id")).scalar()

    object_key = ["obj_type", "obj_path", "obj_name"]
    nothing = F.lit(None).cast("string")
    protocols = lines.where(F.col("proto").isNotNull()).select(
        F.lit("protocol").alias("obj_type"), nothing.alias("obj_path"), F.col("proto").alias("obj_name"))
    objects = resolve(dims["objects"].select(*object_key, "id"), protocols, object_key)
    created["objects"] = new_rows(objects).select("id", *object_key, F.lit(None).cast("int").alias("port"))

    subject_key = ["org_id", "login", "user_domain"]
    subjects = resolve(
        dims["subject"].select(*subject_key, "id"),
        lines.select("org_id", nothing.alias("login"), nothing.alias("user_domain")), subject_key)
    created["subject"] = new_rows(subjects).select(
        "id", *subject_key, group.alias("group_id"), F.lit(True).alias("monitored"),
        at.alias("start_work"))

    keys = ["org_id", "src", "dst", "proto"]
    sources = merge_ranges(lines, keys, "src_port", "aux1")
    targets = merge_ranges(lines, keys, "dst_port", "aux2")
    rules = sources.join(targets, same(sources, targets, keys)).select(
        *[sources[k] for k in keys], "aux1", "aux2")
    by_ip = hosts.where(F.col("host_name").isNull())
    for side, name in (("src", "source"), ("dst", "destination")):
        rules = _with_id(
            rules, by_ip.select("org_id", F.col("host_ip").alias(side), "id"), ["org_id", side], name)
    rules = _with_id(
        rules, objects.where("obj_type = 'protocol' and obj_path is null")
        .select(F.col("obj_name").alias("proto"), "id"), ["proto"], "object")
    rules = _with_id(
        rules, subjects.where("login is null and user_domain is null").select("org_id", "id"),
        ["org_id"], "subject")
    created["rules"] = _rules(rules.withColumns({
        "result": F.lit(0), "use_case_id": F.lit(""), "type": F.lit("FirewallConnection"),
        "schedule": group,
    }), dims)
    return created


def load_rules(csv: DataFrame, dims: Dims, kind: str, now: Column | None = None) -> Mapping[str, DataFrame]:
    loaders = {"logon": load_logon_rules, "object": load_object_rules,
               "connection": load_connection_rules}
    return loaders[kind](csv, dims, now)
