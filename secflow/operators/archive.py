"""Keyed store and partitioned archive."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITIONS = ["sys_org", "sys_year", "sys_month", "sys_day"]


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every nested leaf as a top-level column named by its path."""

    def columns(schema: T.StructType, path: list[str]) -> list[Column]:
        found = []
        for field in schema.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                found += columns(field.dataType, here)
            else:
                found.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return found

    return df.select(*columns(df.schema, []))


def with_partitions(df: DataFrame, org: str, epoch: str) -> DataFrame:
    """Add the archive's partition columns: organization and UTC year, month and day."""
    at = F.timestamp_seconds(F.col(epoch))
    return df.withColumns({
        "sys_org": F.col(org), "sys_year": F.year(at), "sys_month": F.month(at),
        "sys_day": F.dayofmonth(at),
    })


def write_archive(df: DataFrame, path: str, org: str, epoch: str, mode: str = "append",
                  fmt: str = "orc") -> None:
    """Write partitioned files (batch), each sorted by time.

    ``rebalance`` brings the rows of a partition together for few files, yet lets AQE split an
    organization's day that is too large for one task.  A scan for a time skips the stripes and row
    groups of a day that hold none of it.  With the mode ``overwrite`` the partitions that occur among
    the rows are replaced and all others stay, so a day that is archived again is there once.
    """
    rows = with_partitions(df, org, epoch).hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, epoch)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).format(fmt).save(path)


def register_partitions(spark: SparkSession, table: str, path: str, day: str) -> list[str]:
    """Add the day's partitions that exist under ``path`` to the table; returns their organizations.

    Only folder names are listed, one per organization.
    """
    year, month, date = (int(x) for x in day[:10].split("-"))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    added = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not status.isDirectory() or not name.startswith("sys_org="):
            continue
        below = f"{status.getPath().toString()}/sys_year={year}/sys_month={month}/sys_day={date}"
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(below)):
            continue
        added.append(name.split("=", 1)[1].replace("'", "\\'"))
    if added:
        specs = " ".join(
            f"PARTITION (sys_org='{org}', sys_year={year}, sys_month={month}, sys_day={date})" for org in added)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    return added


def read_day(df: DataFrame, day: str, ts_col: str) -> DataFrame:
    """Rows of one UTC day by a BIGINT column of milliseconds; the range reaches the file scan."""
    begin = int(datetime.fromisoformat(day[:10]).replace(tzinfo=UTC).timestamp() * 1000)
    return df.where((F.col(ts_col) >= begin) & (F.col(ts_col) < begin + 86_400_000))


def upsert_latest(df: DataFrame, key: str = "id", order: str = "write_ts") -> DataFrame:
    """One row per key: the one written last.

    An aggregate with a map-side step rather than a window, so any number of copies of one key
    shrinks to one row per task before the shuffle.  Equal write times fall back to the row itself.
    """
    rest = [c for c in df.columns if c != key]
    row = F.struct(*rest)
    newest = df.groupBy(key).agg(F.max_by(row, F.struct(F.col(order), row)).alias("_r"))
    return newest.select(*[F.col(key) if c == key else F.col("_r")[c].alias(c) for c in df.columns])
