"""Canonical event: one nested struct whose leaves are addressed by dotted names.

Absent values are NULL; times are UTC epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, INT, LONG, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
STRINGS = T.ArrayType(STRING)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def strings(names: str) -> dict[str, T.DataType]:
    return {name: STRING for name in names.split()}


# Names and types of the canonical event and of the side records.
LOCATION = strings("fqdn host hostname ip")
COLLECTOR = struct(location=struct(**LOCATION), inputId=STRING, organization=STRING)
ENDPOINT = struct(
    **LOCATION, nat=struct(hostname=STRING, ip=STRING, port=INT), mac=STRING, port=INT,
    enrichment=struct(
        geo=struct(**strings("city country org")), network=STRING, isNetworkLocal=BOOL),
)
EVENT = struct(
    id=STRING, eventTime=LONG, category=STRING, normalizerVersion=INT,
    eventSource=struct(location=struct(**LOCATION), **strings("category id subsys title vendor")),
    source=ENDPOINT,
    destination=ENDPOINT,
    interaction=struct(
        action=STRING, direction=STRING, duration=INT, importance=STRING, logonType=INT,
        protocol=STRING, reason=STRING, startTime=LONG, status=STRING),
    subject=struct(
        **strings("category domain group id name"), privileges=STRINGS, version=STRING,
        enrichment=struct(isWorkingDay=BOOL, isTimeAllowed=BOOL, isHostAccessTimeAllowed=BOOL,
                          isObjectAccessAllowed=BOOL)),
    object=struct(**strings("category domain group id name path property state value vendor version")),
    collector=COLLECTOR,
    correlation=struct(eventIds=STRINGS, count=INT, name=STRING),
    data=struct(
        bytesTotal=LONG, bytesIn=LONG, bytesOut=LONG, packetsTotal=LONG, packetsIn=LONG,
        packetsOut=LONG, **{f"aux{n}": STRING for n in range(1, 11)}, interface=STRING, msgId=STRING,
        originTime=LONG, recvFile=STRINGS, tcpFlag=STRINGS, time=LONG, rawIds=STRINGS),
)
RAW_EVENT = struct(
    id=STRING, raw=STRING, preparsedMessage=STRING, collector=COLLECTOR, eventTime=LONG,
    devType=STRING, eventSource=struct(**LOCATION), severityId=INT, severity=STRING,
    normalizedId=STRING)
CHAIN_EVENT = struct(rawId=STRING, normalizedId=STRING, chain=STRING, collector=COLLECTOR, eventTime=LONG)
INVALID_EVENT = struct(rawId=STRING, reason=STRING, collector=COLLECTOR)
ERROR_EVENT = struct(id=STRING, raw=STRING, stacktrace=STRING, collector=COLLECTOR)

HOP_DDL = "modname STRING, modtype STRING, number INT, fqdn STRING, ip STRING, rt BIGINT"


def leaves(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType]:
    """Dotted leaf names and their types, in schema order."""
    found: dict[str, T.DataType] = {}
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            found.update(leaves(field.dataType, f"{prefix}{field.name}."))
        else:
            found[prefix + field.name] = field.dataType
    return found


def build(schema: T.StructType, values: dict[str, Column]) -> Column:
    """Nested struct of ``schema`` from dotted leaf columns; missing leaves become typed NULLs."""
    unknown = set(values) - set(leaves(schema))
    if unknown:
        raise KeyError(f"not part of the schema: {sorted(unknown)}")
    absent: dict[str, Column] = {}

    def null(data_type: T.DataType) -> Column:
        name = data_type.simpleString()
        if name not in absent:
            absent[name] = F.expr(f"cast(null as {name})")
        return absent[name]

    def nested(part: T.StructType, prefix: str) -> Column:
        if not any(name.startswith(prefix) for name in values):
            return null(part)
        columns = []
        for field in part.fields:
            name = prefix + field.name
            if isinstance(field.dataType, T.StructType):
                column = nested(field.dataType, name + ".")
            elif name in values:
                column = values[name].cast(field.dataType)
            else:
                column = null(field.dataType)
            columns.append(column.alias(field.name))
        return F.struct(*columns)

    return nested(schema, "")


def with_leaves(df: DataFrame, column: str, values: dict[str, Column]) -> DataFrame:
    """Replace leaves of a struct column, building absent parents.

    The struct is rebuilt field by field: chains of ``withField`` on nested paths repeat their
    base at every level and grow exponentially.
    """

    def rebuilt(part: T.StructType, base: Column, prefix: str) -> Column:
        columns = []
        for field in part.fields:
            name = prefix + field.name
            if name in values:
                column = values[name].cast(field.dataType)
            elif isinstance(field.dataType, T.StructType) and any(
                v.startswith(name + ".") for v in values
            ):
                column = rebuilt(field.dataType, base[field.name], name + ".")
            else:
                column = base[field.name]
            columns.append(column.alias(field.name))
        return F.struct(*columns)

    schema = df.schema[column].dataType
    return df.withColumn(column, rebuilt(schema, F.col(column), ""))
