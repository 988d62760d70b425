"""Driver tables and what is derived from them: envelopes, dimensions, canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow import configure
from secflow.operators.dims import preferences, vendors
from secflow.plans.normalize import PIPELINES, parsed_and_validated
from secflow.schema import EVENT, build
from secflow.session import spread

E_SQL = """
e AS (
  SELECT event_id, user_id, event_type,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS epoch, epoch_us(ts) AS micros,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events
)
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return spread(table(spark, folder, "events")).select(
        "event_id", "user_id", "event_type", F.unix_seconds(ts).alias("epoch"),
        F.unix_micros(ts).alias("micros"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


def s(text: str) -> Column:
    """A string expression with {column} holes."""
    parts, rest = [], text
    while "{" in rest:
        before, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        if before:
            parts.append(F.lit(before))
        parts.append(F.expr(name).cast("string"))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def iso(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


ORG = "concat('NATION_', pmod(user_id, 25))"
HOST_IP = "concat('10.1.', pmod(user_id, 200), '.', k)"


def envelope(raw: Column, dev_type: Column | str, **extra: Column) -> Column:
    """Collector envelope around a payload; the input id carries the event id."""
    hop = F.struct(
        F.col("event_id").cast("string").alias("modname"), F.lit("im").alias("modtype"),
        F.lit(1).alias("number"), F.lit("collector.example.org").alias("fqdn"),
        F.lit("10.9.9.9").alias("ip"), F.col("micros").alias("rt"),
    )
    fields = {
        "raw": raw, "EventReceivedTime": iso(F.col("epoch")), "Organization": F.expr(ORG),
        "DevType": dev_type if isinstance(dev_type, Column) else F.lit(dev_type),
        "Severity": F.lit("info"), "SeverityValue": F.col("k"),
        "MessageSourceAddress": F.expr(HOST_IP), "eventHostname": s("h{user_id}.example.org"),
        "chain": F.struct(hop.alias("collector")), **extra,
    }
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Pipeline configuration: organizations are the nations, one device type per pipeline.

    Organizations of region 3 are no longer active.
    """
    nation = table(spark, folder, "nation")
    orgs = nation.select(
        F.col("n_nationkey").cast("int").alias("id"), F.col("n_name").alias("short_name"),
        F.col("n_name").alias("name"), F.timestamp_seconds(F.lit(0)).alias("active_from"),
        F.when(F.col("n_regionkey") == 3, F.timestamp_seconds(F.lit(1))).alias("active_to"),
    )
    rows = [(i, name, *(t for tool in tools for t in tool)) for i, (name, tools) in
            enumerate(PIPELINES.items())]
    names = ["id", "dev_type", "pn", "pv", "vn", "vv", "mn", "mv"]
    config = spark.range(1).select(F.explode(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])).alias("r")).select("r.*")
    dims = {
        "organizations": orgs,
        "device_types": config.select(
            "id", "dev_type", s("product {dev_type}").alias("product"), F.lit("1").alias("version"),
            F.col("id").alias("vendor_id")),
        "device_vendors": config.select("id", s("vendor {id}").alias("name")),
    }
    every = F.explode(F.array(*[F.lit(i) for i in range(len(rows))]))
    for role, name, version in (("parser", "pn", "pv"), ("validator", "vn", "vv"), ("mapper", "mn", "mv")):
        dims[f"{role}s"] = config.select("id", F.col(name).alias("name"), F.col(version).alias("version"))
        dims[f"event_{role}s"] = orgs.select(F.col("id").alias("org_id"), every.alias(f"{role}_id")).withColumn(
            "device_type_id", F.col(f"{role}_id"))
    return dims


def pipeline(spark: SparkSession, folder: str, values: DataFrame, kinds: list[str], **options) -> DataFrame:
    dims = dimensions(spark, folder)
    return parsed_and_validated(
        values, preferences(dims), vendors(dims), pipelines=kinds,
        **{"algo": "md5", **options})


def normalized(spark: SparkSession, folder: str, raw: Column, kind: str, **options) -> DataFrame:
    """Rendered logs of one format through the whole normalization up to the canonical event."""
    values = events(spark, folder).select(envelope(raw, kind).alias("value"))
    return pipeline(spark, folder, values, [kind], **options)


def leaf(path: str, name: str | None = None) -> Column:
    return F.col(f"event.{path}").alias(name or path.replace(".", "_"))


def event_id() -> Column:
    return F.col("input_id").cast("bigint").alias("event_id")


def canonical(df: DataFrame, **leaves: Column | str | int) -> DataFrame:
    """Attach a canonical ``event`` with the given leaves (``__`` stands for a dot)."""
    values = {k.replace("__", "."): v if isinstance(v, Column) else F.lit(v) for k, v in leaves.items()}
    return df.withColumn("event", build(EVENT, values))
