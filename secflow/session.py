"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume; safe to call repeatedly.

    All event times are UTC epoch seconds, so the session zone must be UTC.  AQE
    picks broadcast or shuffle joins from measured sizes and splits hot keys; operators
    mark a side for broadcast only behind a check of its size (``dimension_side``).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # HotSpot never compiles methods above 8000 bytes; beyond that, operators are generated one
    # by one with small methods instead of as one fused method that would run interpreted.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


SPREAD_BYTES = 64 << 20
BROADCAST_BYTES = 8 << 20


def source_bytes(df: DataFrame) -> int:
    """Bytes that the plan reads from its sources, by their own statistics; no job is run.

    A source of unknown size counts as larger than any bound.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread(df: DataFrame, max_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Deal out an input of a few megabytes, which would else be parsed by a task or two.

    Larger inputs are split by the reader's own options and are never shuffled here.
    """
    if source_bytes(df) > max_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def dimension_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a dimension for broadcast if what it is read from is small enough.

    Catalyst multiplies the sizes of joined dimensions, so it would shuffle the big side for them.
    The bound is on the bytes of the sources, some hundredfold below what executors hold, and is
    looked up in the plan: no job runs while a plan is built.  Beyond it the frame is returned as
    it is, and the join is left to Catalyst and AQE.
    """
    return F.broadcast(df) if source_bytes(df) <= max_bytes else df


def keyed_join(df: DataFrame, found: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Add the columns of ``found``, where its columns named by ``keys`` equal the given expressions.

    Rows of which a key is NULL meet nothing.  A plain outer join would send all of them to one
    task; here a digest of the row spreads them.  ``found`` has one row for each key.
    """
    spread = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    missing = F.lit(False)
    for key in keys.values():
        missing = missing | key.isNull()
    own = {f"_own_{name}": key for name, key in keys.items()}
    own["_spread"] = F.when(missing, 1 + F.pmod(F.xxhash64(*spread), F.lit(1 << 20))).otherwise(0)
    side = found.withColumnsRenamed({name: f"_of_{name}" for name in keys})
    # Always 0, but no constant: the optimizer would take one out of the join keys.
    side = side.withColumn("_none", F.pmod(F.xxhash64(*[f"_of_{name}" for name in keys]), F.lit(1)))
    left = df.withColumns(own)
    on = left["_spread"] == side["_none"]
    for name in keys:
        on = on & (left[f"_own_{name}"] == side[f"_of_{name}"])
    return left.join(side, on, "left").drop(*own, *[f"_of_{name}" for name in keys], "_none")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; a temporary one only in local tests."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix="secflow-ckpt-")


def cut(df: DataFrame) -> DataFrame:
    """Materialize a frame that several later steps refer to, in the reliable checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()
