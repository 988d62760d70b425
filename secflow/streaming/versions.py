"""Versions of prepared rule tables: written whole at each refresh, pinned by the batches that read them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.operators.controls import CONTROLS, prepare_control
from secflow.operators.rules import Prepared

MANIFEST = "version BIGINT, written_at TIMESTAMP"


def current_version(spark: SparkSession, folder: str) -> int | None:
    """The newest version that is complete; NULL if there is none yet."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    except AnalysisException:
        return None
    return rows.agg(F.max("version")).first()[0]


def publish_rules(rules: DataFrame, folder: str, compat_zero_is_any: bool = True) -> int:
    """Write the tables of all controls as a new version below ``folder``, which executors share.

    The manifest names the version only after its tables are written, so a reader never meets half
    of one; a refresh that fails leaves the version before it in force, and the next one writes over
    its tables.  Older versions stay for the batches that have pinned them.
    """
    spark = rules.sparkSession
    version = (current_version(spark, folder) or 0) + 1
    for kind in CONTROLS:
        prepare_control(rules, kind, compat_zero_is_any).write(f"{folder}/v{version}/{kind}")
    row = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.current_timestamp().alias("written_at"))
    row.coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return version


def read_rules(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, Prepared]:
    """The tables of one version, by control; of the newest one if none is named."""
    version = version or current_version(spark, folder)
    if version is None:
        raise ValueError(f"no version of the rules in {folder}")
    return {kind: Prepared.read(spark, f"{folder}/v{version}/{kind}") for kind in CONTROLS}
