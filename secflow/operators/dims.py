"""Dimension tables joined into the lookups the jobs need."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.text import ANY
from secflow.session import dimension_side

Dims = Mapping[str, DataFrame]


def active_organizations(organizations: DataFrame, now: Column) -> DataFrame:
    return organizations.where((F.col("active_from") < now) & F.col("active_to").isNull())


def preferences(dims: Dims, now: Column | None = None) -> DataFrame:
    """(organization, dev_type) -> names and versions of its parser, validator and mapper."""
    orgs = active_organizations(
        dims["organizations"], F.current_timestamp() if now is None else now
    ).select(F.col("id").alias("org_id"), F.col("short_name").alias("organization"))
    types = dims["device_types"].select(F.col("id").alias("device_type_id"), "dev_type")

    def links(role: str) -> DataFrame:
        tools = dims[f"{role}s"].select(
            F.col("id").alias(f"{role}_id"), F.col("name"), F.col("version")
        )
        return (
            dims[f"event_{role}s"].select("org_id", "device_type_id", f"{role}_id")
            .join(tools, f"{role}_id").join(orgs, "org_id").join(types, "device_type_id")
            .select("organization", "dev_type", F.lit(role).alias("role"),
                    F.struct("name", "version").alias("tool"))
        )

    roles = ("parser", "validator", "mapper")
    union = links(roles[0]).unionByName(links(roles[1])).unionByName(links(roles[2]))
    # Several tools for one role: the greatest (name, version) is taken, so the result is stable.
    chosen = union.groupBy("organization", "dev_type").agg(*[
        F.max(F.when(F.col("role") == role, F.col("tool"))).alias(role) for role in roles
    ])
    return chosen.select(
        "organization", "dev_type",
        *[F.col(f"{role}.{part}").alias(f"{role}_{part}")
          for role in roles for part in ("name", "version")],
    )


def vendors(dims: Dims) -> DataFrame:
    makers = dims["device_vendors"].select(F.col("id").alias("vendor_id"), F.col("name").alias("vendor"))
    return (
        dims["device_types"].join(makers, "vendor_id")
        .groupBy("dev_type").agg(F.max(F.struct("vendor", "product", "version")).alias("v"))
        .select("dev_type", "v.vendor", "v.product", F.col("v.version").alias("product_version"))
    )


def with_preferences(df: DataFrame, prefs: DataFrame) -> DataFrame:
    """Attach the pipeline of each row; the two flags feed the envelope checks.

    Preferences are folded to one row per organization, so one equi-join answers both questions.
    They are broadcast if their tables are small, so that raw messages are not shuffled.
    """
    tools = [c for c in prefs.columns if c not in ("organization", "dev_type")]
    per_org = prefs.groupBy("organization").agg(
        F.map_from_entries(F.collect_list(F.struct("dev_type", F.struct(*tools)))).alias("_pipelines")
    )
    joined = df.join(dimension_side(per_org), "organization", "left").withColumn(
        "_tools", F.try_element_at("_pipelines", F.col("dev_type"))
    )
    return (
        joined.withColumn("organization_known", F.col("_pipelines").isNotNull())
        .withColumn("pipeline_known", F.col("_tools").isNotNull())
        .withColumns({t: F.col(f"_tools.{t}") for t in tools})
        .drop("_pipelines", "_tools")
    )


def denorm_rules(dims: Dims) -> DataFrame:
    """Access rules with their subject, hosts, object and schedule intervals in one row each."""
    orgs = dims["organizations"].select(F.col("id").alias("org_id"), F.col("short_name").alias("org"))
    subjects = dims["subject"].join(orgs, "org_id").select(
        F.col("id").alias("subject"), "org", "login", F.col("user_domain").alias("domain")
    )

    def hosts(side: str) -> DataFrame:
        return dims["hosts"].select(
            F.col("id").alias(side), F.col("host_name").alias(f"{side}_host"),
            F.col("host_ip").alias(f"{side}_ip"),
        )

    objects = dims["objects"].select(
        F.col("id").alias("object"), "obj_type", "obj_path", "obj_name"
    )
    groups = dims["schedule_groups"].select(F.col("id").alias("schedule"))
    interval = F.struct("time_from", "time_to", "days_work", "days_weekend", "is_calendar")
    intervals = dims["schedule"].groupBy(F.col("group_id").alias("schedule")).agg(
        F.array_sort(F.collect_list(interval)).alias("intervals")
    )
    empty = F.array().cast(intervals.schema["intervals"].dataType)
    return (
        dims["rules"]
        .join(subjects, "subject")
        .join(hosts("source"), "source", "left")
        .join(hosts("destination"), "destination", "left")
        .join(groups, "schedule")
        .join(intervals, "schedule", "left")
        .join(objects, "object", "left")
        .select(
            F.col("id").alias("rule_id"), "type", "org", "domain", "login",
            "source_host", "source_ip", "destination_host", "destination_ip",
            "obj_type", "obj_path", "obj_name",
            F.coalesce("intervals", empty).alias("intervals"), "aux1", "aux2",
            F.when(F.col("result") == 0, "Allowed").when(F.col("result") == 1, "Restricted")
            .alias("result"),
        )
    )


def logins(dims: Dims) -> DataFrame:
    """(org, domain, login), lower-cased and with ``*`` for absent parts -> schedule group and start.

    Of several subjects with one key the one with the greatest id counts.
    """
    orgs = dims["organizations"].select(F.col("id").alias("org_id"), "short_name")
    key = [
        F.lower("short_name").alias("org"),
        F.coalesce(F.lower("user_domain"), F.lit(ANY)).alias("domain"),
        F.coalesce(F.lower("login"), F.lit(ANY)).alias("login"),
    ]
    value = F.struct("group_id", "user_name", "phone", "email", "monitored", "start_work")
    return (
        dims["subject"].join(orgs, "org_id").groupBy(*key)
        .agg(F.max_by(value, F.col("id")).alias("v"))
        .select("org", "domain", "login", "v.*")
    )


def latest_load(geo: DataFrame) -> DataFrame:
    """Rows of the newest load only."""
    newest = geo.agg(F.max("load_id")).scalar()
    return geo.where(F.col("load_id") == newest)


def network_lists(geo: DataFrame, keys: list[str], sep: str = ";") -> DataFrame:
    """Networks per attribute tuple as one text, sorted."""
    networks = F.array_join(F.array_sort(F.collect_list("network")), sep)
    return geo.groupBy(*keys).agg(networks.alias("networks"))


def freshness(dims: Dims, loaded_at: str = "loaded_at") -> DataFrame:
    """Size and newest load time of every dimension that records one."""
    result = None
    for name, table in sorted(dims.items()):
        stamp = F.max(loaded_at).cast("bigint") if loaded_at in table.columns else F.lit(None).cast("bigint")
        row = table.agg(F.count("*").alias("size"), stamp.alias("last_updated")).select(
            F.lit(name).alias("dimension"), "size", "last_updated"
        )
        result = row if result is None else result.unionByName(row)
    return result
