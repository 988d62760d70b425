"""Readers for messages and dimension tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGES = "key STRING, value STRING, topic STRING"
BINARY_MESSAGES = "key STRING, value BINARY, topic STRING"

# Dimension tables and the columns the jobs read.
DIMENSION_SCHEMAS = {
    "organizations": "id INT, short_name STRING, name STRING, active_from TIMESTAMP, active_to TIMESTAMP",
    "device_types": "id INT, dev_type STRING, product STRING, version STRING, vendor_id INT, "
                    "category_id INT, sub_category_id INT",
    "device_vendors": "id INT, name STRING",
    "parsers": "id INT, name STRING, version INT",
    "validators": "id INT, name STRING, version INT",
    "mappers": "id INT, name STRING, version INT",
    "event_parsers": "id INT, org_id INT, parser_id INT, device_type_id INT",
    "event_validators": "id INT, org_id INT, validator_id INT, device_type_id INT",
    "event_mappers": "id INT, org_id INT, mapper_id INT, device_type_id INT",
    "schedule_groups": "id INT, group_name STRING",
    "schedule": "id INT, group_id INT, time_from INT, time_to INT, days_work INT, days_weekend INT, "
                "is_calendar BOOLEAN",
    "subject": "id INT, login STRING, org_id INT, user_name STRING, group_id INT, phone STRING, "
               "email STRING, monitored BOOLEAN, user_domain STRING, start_work TIMESTAMP",
    "hosts": "id INT, host_name STRING, org_id INT, user_name STRING, host_ip STRING, added TIMESTAMP, "
             "description STRING",
    "objects": "id INT, obj_type STRING, obj_path STRING, obj_name STRING, port INT",
    "rules": "id INT, subject INT, source INT, destination INT, object INT, result INT, "
             "use_case_id STRING, type STRING, schedule INT, aux1 STRING, aux2 STRING",
    "geo_city": "city STRING, country STRING, org STRING, org_id STRING, network STRING, load_id INT",
    "geo_country": "country STRING, org STRING, org_id STRING, network STRING, load_id INT",
    "py_scripts": "id INT, script STRING, method_name STRING",
}

# Columns of the rule files.
RULE_FILES = {
    "logon": "org STRING, hostname STRING, ip STRING, username STRING, domain STRING, "
             "logontype STRING, fromHost STRING, fromTime INT, toTime INT, isWeekendAllowed BOOLEAN",
    "object": "org STRING, hostname STRING, ip STRING, catalog STRING, username STRING, "
              "userDomain STRING, filesMask STRING, fromTime INT, toTime INT, isWeekendAllowed BOOLEAN",
    "connection": None,
}


def _messages(reader, source: str, schema: str, options: Mapping[str, str], value_type: str) -> DataFrame:
    if source == "kafka":
        df = reader.format("kafka").options(**options).load()
        return df.select(
            F.col("key").cast("string"), F.col("value").cast(value_type), "topic", "partition",
            "offset", "timestamp",
        )
    path = options["path"]
    rest = {k: v for k, v in options.items() if k != "path"}
    if source == "text":
        df = reader.format("text").options(**rest).load(path)
        return df.select(
            F.lit(None).cast("string").alias("key"), F.col("value").cast(value_type),
            F.lit(None).cast("string").alias("topic"))
    return reader.format(source).schema(schema).options(**rest).load(path)


def read_text_stream(spark: SparkSession, source: str = "kafka", **options: str) -> DataFrame:
    """Messages as text.  ``kafka`` takes the usual options (``subscribe``,
    ``maxOffsetsPerTrigger`` as rate cap); file sources take ``path``."""
    return _messages(spark.readStream, source, MESSAGES, options, "string")


def read_text(spark: SparkSession, source: str = "kafka", **options: str) -> DataFrame:
    """Batch twin of :func:`read_text_stream`."""
    return _messages(spark.read, source, MESSAGES, options, "string")


def read_binary_stream(spark: SparkSession, source: str = "kafka", **options: str) -> DataFrame:
    return _messages(spark.readStream, source, BINARY_MESSAGES, options, "binary")


def decode(value: Column, schema: T.StructType, message: str | None = None,
           descriptor: bytes | None = None) -> Column:
    """A payload as a struct: protobuf when a descriptor is given, JSON text otherwise."""
    if descriptor is not None:
        from pyspark.sql.protobuf.functions import from_protobuf

        return from_protobuf(value, message, binaryDescriptorSet=descriptor)
    return F.from_json(value.cast("string"), schema)


def decode_by_topic(df: DataFrame, schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """One frame of decoded ``event``s per topic."""
    return {
        topic: df.where(F.lower("topic") == topic.lower()).select(
            "key", "topic", decode(F.col("value"), schema).alias("event"))
        for topic, schema in schemas.items()
    }


def read_dimensions(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                    jdbc: Mapping[str, str] | None = None,
                    names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Dimension tables by name, from ``{path}/{name}`` or from a database."""
    tables = {}
    for name in names or DIMENSION_SCHEMAS:
        if jdbc is not None:
            tables[name] = spark.read.format("jdbc").options(**jdbc).option("dbtable", name).load()
        else:
            tables[name] = spark.read.format(fmt).schema(DIMENSION_SCHEMAS[name]).load(f"{path}/{name}")
    return tables


def read_calendar(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    """Distinct holidays from January 1st of the year before ``as_of`` (yyyy-MM-dd)."""
    raw = spark.read.schema("holidays ARRAY<STRING>").json(path, multiLine=True)
    days = raw.select(F.explode("holidays").alias("d")).select(F.to_date("d").alias("holiday"))
    return days.where(F.year("holiday") >= int(as_of[:4]) - 1).distinct()


def read_rules_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A rule file with header; blanks are NULL and a malformed line stops the load.

    Connection files name their columns themselves and may leave some out.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("mode", "FAILFAST")
    schema = RULE_FILES[kind]
    return (reader.schema(schema) if schema else reader).csv(path)
