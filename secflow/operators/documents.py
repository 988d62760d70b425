"""Search documents made from canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.functions.text import index_title

# Date part of index names and the document type behind them.
INDEX_DATE, INDEX_TYPE = "dd.MM.yyyy", "normalized"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ssXXX"


def prune(column: Column, data_type: T.DataType) -> tuple[Column, Column]:
    """The column with empty nested structs turned to NULL, and whether anything is left of it."""
    if not isinstance(data_type, T.StructType):
        filled = column.isNotNull()
        if isinstance(data_type, T.ArrayType):
            filled = F.coalesce(F.size(column) > 0, F.lit(False))
            column = F.when(filled, column)
        return column, filled
    parts, anything = [], F.lit(False)
    for field in data_type.fields:
        part, filled = prune(column[field.name], field.dataType)
        parts.append(part.alias(field.name))
        anything = anything | filled
    return F.when(anything, F.struct(*parts)), anything


def index_name(title: Column, epoch: Column) -> Column:
    """``{title}-{dd.MM.yyyy}/normalized`` with forbidden characters of the title replaced."""
    date = F.date_format(F.timestamp_seconds(epoch), INDEX_DATE)
    return F.concat(index_title(title), F.lit("-"), date, F.lit(f"/{INDEX_TYPE}"))


def to_documents(df: DataFrame, event: str = "event") -> DataFrame:
    """(id, index_name, doc): the event as JSON without empty parts plus ``@timestamp``."""
    schema = df.schema[event].dataType
    e = F.col(event)
    fields = [prune(e[f.name], f.dataType)[0].alias(f.name) for f in schema.fields]
    stamp = F.date_format(F.timestamp_seconds(e["data"]["time"]), ISO_TIME).alias("@timestamp")
    return df.select(
        e["id"].alias("id"),
        index_name(e["eventSource"]["title"], e["data"]["time"]).alias("index_name"),
        F.to_json(F.struct(*fields, stamp)).alias("doc"),
    )
