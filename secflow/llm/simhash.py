"""SimHash near-dedup with pivot distance tables.

Each text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints get a row of Hamming distances to many
reference fingerprints (pivots). By the triangle inequality, two fingerprints within ``max_bits`` have distances to
each pivot that differ by ``max_bits`` at most, so pairs with a larger coordinate difference are discarded without
being compared, and the survivors are verified.

The pivots come in two kinds. *Axis pivots* are a base fingerprint and its one-bit neighbours: relative to the base,
the distance to neighbour i tells bit i. A pair within 4 has equal relative distances to all axis pivots of all but
four of ``k`` families, so the rows are dealt out by the coordinates of each choice of ``k - 4`` families, and no cell
need meet another. ``k`` follows the number of fingerprints, so that cells stay small. Within a cell, *scattered
pivots* order and discard.

A cell never emits all its pairs, only links that join two parts of it that were apart, which keeps components.
Cells of more than ``CELL`` fingerprints are cut into chunks, and each pair of chunks is a cell of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from secflow.llm.common import checkpoint, hex64
from secflow.llm.components import connected_components

#: Scattered reference fingerprints.
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 16, dtype=np.uint64)
#: Fingerprints that are compared in one cell at most; larger cells are cut.
CELL = 4096
_SHINGLES = 1 << 16


def fingerprint(text: bytes, words: int) -> int:
    """The 64-bit SimHash of the word shingles of a text; 0 if it has no word."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends[:-1]]
    if len(tokens) > words:
        spans = zip(starts, ends[words - 1 :], strict=False)
        total = len(tokens) - words + 1
    else:
        spans, total = iter([(0, len(joined) + 1)]), 1
    ones = np.zeros(64, np.int64)
    for done in range(0, total, _SHINGLES):
        n = min(_SHINGLES, total - done)
        hashes = np.fromiter((xxh64_intdigest(joined[s : e - 1], 42) for (s, e), _ in zip(spans, range(n), strict=False)), np.uint64, n)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(doc_id, fp): the fingerprint's bits as a BIGINT. A null text counts as empty."""

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = [fingerprint((x or "").encode("utf-8", "surrogatepass"), words) for x in texts]
            yield pd.Series(np.array(out, np.uint64).view(np.int64))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), simhash(F.col(text_col)).alias("fp"))


def families(n: int, max_bits: int) -> tuple[list[int], list[tuple[int, ...]]]:
    """Bit masks of the families of axis pivots, and which families make each key.

    The fewest families whose keys leave some hundred of ``n`` random fingerprints to a cell.
    """
    for k in range(max_bits + 1, 2 * max_bits + 2):
        cuts = [round(64 * i / k) for i in range(k + 1)]
        if n >> (64 * (k - max_bits) // k) < 512:
            break
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return masks, list(combinations(range(k), k - max_bits))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cell_links(fps: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect every two fingerprints of a cell that a chain of near pairs connects.

    ``table`` has a row of pivot distances for each fingerprint.
    """
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    last = np.searchsorted(table[:, 0], table[:, 0] + max_bits, side="right")
    part = np.arange(len(fps))
    out = []
    for i in range(len(fps) - 1):
        near = i + 1 + np.flatnonzero(part[i + 1 : last[i]] != part[i])
        for column in range(1, table.shape[1]):
            if not len(near):
                break
            near = near[np.abs(table[near, column] - table[i, column]) <= max_bits]
        if len(near):
            near = near[np.bitwise_count(fps[near] ^ fps[i]) <= max_bits]
        while len(near):
            j = near[0]
            out.append((int(fps[i]), int(fps[j])))
            part[part == part[j]] = part[i]
            near = near[part[near] != part[i]]
    return out


def near_links(distinct: DataFrame, max_bits: int, n: int, cell: int = CELL) -> DataFrame:
    """(a, b): links among the distinct fingerprints ``fp`` that keep all components of near pairs."""
    masks, choices = families(n, max_bits)
    keyed = distinct.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(sum(masks[f] for f in choice)))).alias("k"))
            for t, choice in enumerate(choices)
        ])).alias("c"),
    ).select("fp", "c.t", "c.k")
    large = keyed.groupBy("t", "k").count().filter(F.col("count") > cell).select("t", "k", F.ceil(F.col("count") / cell).cast("int").alias("chunks"))
    keyed = keyed.join(large, ["t", "k"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    keyed = keyed.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int"))
    dealt = keyed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "fp", "t", "k", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")
    )
    cells = ["t", "k", "x", "y"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # of the last cell, which the next batch may go on with
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = rows[cells].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()]
            rest = rows.iloc[cuts[-1] :]
            yield linked(rows["fp"].to_numpy(), cuts)
        if rest is not None:
            yield linked(rest["fp"].to_numpy(), [0, len(rest)])

    def linked(fps: np.ndarray, cuts: list[int]) -> pd.DataFrame:
        fps = np.ascontiguousarray(fps).view(np.uint64)
        table = np.bitwise_count(fps[:, None] ^ PIVOTS[None]).astype(np.int16)
        found = [x for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b - a > 1 for x in cell_links(fps[a:b], table[a:b], max_bits)]
        ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]})

    return dealt.repartition(*cells).sortWithinPartitions(*cells).mapInPandas(compare, "a long, b long")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, max_bits: int = 3, cell: int = CELL,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row of ``docs``.

    A component is what links of at most ``max_bits`` differing bits connect; its id is its smallest doc_id. Texts
    without words, null texts too, share the fingerprint 0 and are linked like any other. Rows with a null id take
    part; the component's id is null only if no row of it has an id. Equal rows stay, each as a row. An empty table
    gives none. Only doc_id and the text are read, so further columns cannot clash.
    """
    prints = checkpoint(fingerprints(docs, id_col, text_col, words))
    distinct = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = near_links(distinct, max_bits, distinct.count(), cell)
    roots = connected_components(links)
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(first, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")
