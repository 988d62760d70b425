"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector; its hash is the
nearest signed axis, that is the coordinate of largest size and its sign. A bucket joins the hashes of one or two
rotations; several tables with rotations of their own hold every vector. A query probes, in each table, the buckets
whose axes are nearest after its own, by the size of the coordinates it would have to give up, until those probed hold
as many vectors as it wants, which is more than ``k``; so a query far from all others, or one among few, goes through
as many buckets as that takes, all of them in the end. Candidates are scored exactly, in double precision, on the
original vectors.

Equal vectors are hashed once: they share their distances, so only the smallest ids of each distinct vector can be
among the nearest. Cells of buckets that hold many vectors or many probes are cut into chunks, and each pair of chunks is scored
by itself, so no large cell is ever in one task as a whole, and none is left out. A pair of chunks returns the nearest few
for each query, not its candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.llm.common import checkpoint

#: Vectors and probes of one bucket that are scored in one piece.
VECTORS, PROBES = 2048, 256
#: What a query goes through in each table: so many vectors, this share of all besides, and so many buckets at least.
AHEAD, SHARE, PROBED = 256, 0.01, 8


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row; the number of columns is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        step *= 2
    return x


class Tables:
    """Rotations of ``tables`` hash tables with ``parts`` signed axes to a bucket."""

    def __init__(self, dims: int, tables: int, parts: int, seed: int = 1):
        self.dims, self.tables, self.parts = dims, tables, parts
        self.width = 1 << max(1, (dims - 1).bit_length())
        self.axes = 2 * self.width
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, parts, 3, self.width))

    def turned(self, x: np.ndarray, table: int, part: int) -> np.ndarray:
        """Unit vectors after one pseudo-rotation, next to their negatives: the size along each signed axis."""
        out = np.zeros((len(x), self.width))
        out[:, : self.dims] = x
        for signs in self.signs[table, part]:
            out = hadamard(out * signs) / np.sqrt(self.width)
        return np.concatenate([out, -out], axis=1)

    def bucket(self, x: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each vector."""
        out = np.zeros(len(x), np.int64)
        for part in range(self.parts):
            out = out * self.axes + self.turned(x, table, part).argmax(axis=1)
        return out

    def filled(self, x: np.ndarray, table: int, held: np.ndarray, wanted: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``x``, bucket) of each probe into a bucket that holds vectors; ``held`` counts those of all buckets.

        Buckets come by their loss, ``least`` of them at least, until they hold ``wanted`` vectors or none is left.
        """
        losses = np.zeros((len(x), 1))
        for part in range(self.parts):
            sizes = self.turned(x, table, part)
            loss = (sizes.max(axis=1, keepdims=True) - sizes) ** 2
            losses = (losses[:, :, None] + loss[:, None]).reshape(len(x), -1)
        order = np.argsort(losses, axis=1, kind="stable")
        there = held[order]
        before = np.cumsum(there, axis=1) - there
        rows, at = np.nonzero(((before < wanted) | (np.arange(order.shape[1]) < least)) & (there > 0))
        return rows, order[rows, at]

    def probes(self, x: np.ndarray, table: int, n: int) -> np.ndarray:
        """The ``n`` buckets of each vector with the least squared loss against its own axes, its own bucket first."""
        losses, names = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for part in range(self.parts):
            sizes = self.turned(x, table, part)
            m = min(n, self.axes)
            order = np.argsort(-sizes, axis=1, kind="stable")[:, :m]
            there = np.take_along_axis(sizes, order, axis=1)
            loss = (there[:, :1] - there) ** 2
            losses = (losses[:, :, None] + loss[:, None]).reshape(len(x), -1)
            names = (names[:, :, None] * self.axes + order[:, None]).reshape(len(x), -1)
            best = np.argsort(losses, axis=1, kind="stable")[:, :n]
            losses, names = np.take_along_axis(losses, best, axis=1), np.take_along_axis(names, best, axis=1)
        return names


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, no component null or not finite."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def settings(dims: int) -> tuple[int, int, int]:
    """(tables, parts, least probes) for vectors of ``dims`` dimensions, whatever their number.

    Two axes make a bucket as long as there are no more buckets than a query can put in order.
    """
    return (16, 2, PROBED) if dims <= 128 else (16, 1, PROBED)


def wanted(n: int, k: int) -> int:
    """How many vectors a query's buckets hold in each table, of ``n`` distinct ones: the same rule at every size."""
    return max(k + 1, AHEAD + int(n * SHARE))


def nearest(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    config: tuple[int, int, int] | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest rows of ``vectors`` found for each row of ``queries``.

    Both have ``id_col`` and ``vector_col``; other columns are not read. Nearness is the smallest Euclidean distance;
    ties go to the smaller id; the query's own id is no candidate. Every query gets ``k`` rows, or all candidates if
    there are fewer. ``config`` are tables, parts of a bucket and buckets probed at least. Vectors that are null, zero or hold a null or non-finite component, and rows
    of null id, take no part; nor do vectors of another length than the most frequent one. Repeated rows count once.
    """
    spark = vectors.sparkSession

    # Vectors travel as they are given, in single precision too; they are scored in double precision.
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"

    def given(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))

    sizes = given(vectors).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dims = sizes["d"]

    def distinct(df: DataFrame, keep: int | None) -> DataFrame:
        """Distinct vectors with their ids, ascending; the ``keep`` smallest, if given."""
        same = df.filter(F.size("v") == dims).select("id", "v", F.xxhash64("v").alias("h"), F.xxhash64("v", F.lit(1)).alias("h2")).dropDuplicates(["id", "h", "h2"])
        if keep is None:
            return same
        # A limit by rank, which Spark also applies before the exchange, so that a vector of many rows stays small.
        ranked = same.withColumn("r", F.row_number().over(Window.partitionBy("h", "h2").orderBy("id"))).filter(F.col("r") <= keep)
        return ranked.groupBy("h", "h2").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))

    base = checkpoint(distinct(given(vectors), k + 1))
    asked = checkpoint(
        distinct(given(queries), None).withColumn("q", F.struct("h", "h2"))
    )
    texts = asked.groupBy("h", "h2").agg(F.first("v").alias("v"))
    tables, parts, least = config or settings(dims)
    plan = Tables(dims, tables, parts)
    buckets = plan.axes**parts
    size = base.count()
    many, step = wanted(size, k), max(1, (1 << 20) // buckets)
    # Neighbouring buckets travel as one cell of about ``VECTORS`` vectors: that deals out the work, and changes no result.
    span = min(buckets, 1 << max(0, (VECTORS * buckets // max(1, size)).bit_length() - 1))
    cells = buckets // span

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x = unit(matrix(rows["v"]))
            for t in range(tables):
                yield rows.assign(t=t, bucket=plan.bucket(x, t))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x = unit(matrix(rows["v"]))
            for t in range(tables):
                for i in range(0, len(rows), step):
                    at, found = plan.filled(x[i : i + step], t, occupied[t], many, least)
                    cell = at * cells + found // span
                    order = np.argsort(cell, kind="stable")
                    cuts = np.flatnonzero(np.diff(cell[order])) + 1
                    first = cell[order][np.append(0, cuts)]
                    yield rows.iloc[i + first // cells].assign(t=t, cell=first % cells, inside=np.split((found % span)[order], cuts))

    filed = base.mapInPandas(index, f"h long, h2 long, ids array<long>, v {kind}, t int, bucket long")
    # How many vectors each bucket holds: there are as many numbers as buckets, however many vectors.
    full = filed.groupBy("t", "bucket").agg(F.count("*").cast("int").alias("c"))
    occupied = np.zeros((tables, buckets), np.int32)
    counts = full.toPandas()
    occupied[counts["t"], counts["bucket"]] = counts["c"]
    sought = texts.mapInPandas(probe, f"h long, h2 long, v {kind}, t int, cell long, inside array<int>")
    filed = filed.withColumn("cell", F.floor(F.col("bucket") / span)).withColumn("inside", (F.col("bucket") % span).cast("int"))
    # How many chunks each cell has on either side: one row for each cell.
    held = filed.groupBy("t", "cell").agg(F.ceil(F.count("*") / VECTORS).cast("int").alias("n"))
    asking = sought.groupBy("t", "cell").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("m"))
    chunks = checkpoint(held.join(asking, ["t", "cell"]))
    left = filed.join(chunks, ["t", "cell"]).withColumn("x", F.pmod(F.xxhash64("h2", "h"), F.col("n"))).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    right = sought.join(chunks, ["t", "cell"]).withColumn("y", F.pmod(F.xxhash64("h2", "h"), F.col("m"))).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    place = [F.col("t"), F.col("cell"), F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y")]
    left = left.select(*place, "inside", "ids", "v").groupBy("t", "cell", "x", "y")
    right = right.select(*place, "inside", "h", "h2", "v").groupBy("t", "cell", "x", "y")

    def score(there: pd.DataFrame, probing: pd.DataFrame) -> pd.DataFrame:
        """The nearest rows of one chunk for each query that probes it: enough for k of other ids."""
        if not len(there) or not len(probing):
            return pd.DataFrame({"h": [], "h2": [], "vec_id": [], "score": []})
        x, q = matrix(there["v"]), matrix(probing["v"])
        ids, first = there["ids"].tolist(), np.array([v[0] for v in there["ids"]])
        bucket, probed = there["inside"].to_numpy(), probing["inside"].tolist()
        out = []
        for i in range(len(q)):
            asked = np.zeros(span, bool)
            asked[probed[i]] = True
            here = np.flatnonzero(asked[bucket])
            far = np.sqrt(((x[here] - q[i]) ** 2).sum(axis=1))
            order = np.lexsort((first[here], far))[: k + 1]
            pairs = sorted((float(far[j]), int(v)) for j in order for v in ids[here[j]])
            out += [(probing["h"].iat[i], probing["h2"].iat[i], v, s) for s, v in pairs[: k + 1]]
        return pd.DataFrame(out, columns=["h", "h2", "vec_id", "score"])

    found = left.cogroup(right).applyInPandas(score, "h long, h2 long, vec_id long, score double")
    best = Window.partitionBy("h", "h2").orderBy("score", "vec_id")
    found = found.distinct().withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
    mine = asked.select(F.col("id").alias("query_id"), "h", "h2").join(found, ["h", "h2"]).filter("query_id <> vec_id")
    ranked = mine.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
