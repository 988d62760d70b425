"""Packing of tokenized documents into sequences by swap-based local search.

Pieces are dealt at random into groups; each group is packed by itself, first with best fit, then with a local search
over its underfull sequences. A step moves one piece, exchanges one piece for a larger one, or two pieces for a larger
one, always so that the sum of squared fills rises: full sequences get fuller and the emptiest ones run dry. Only
lengths take part, so a group is small whatever the texts are; each group leaves one slack sequence at most beside
what packing the whole corpus at once would need.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import checkpoint

CAPACITY = 2048
#: Pieces in a group, on average.
GROUP = 40_000
#: Ends each document.
END = 0
_LONG_WORD = re.compile(r"\S{1000}|\s{1000}")
_ENCODERS: dict[tuple[str, str], object] = {}


class Encoder:
    """Ids of the byte-level vocabulary: by its merge ranks, or by its tokenizer file for words without end.

    Both give the same ids. The first is several times as fast, but its time grows with the square of a word.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("documents", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(tokenizer_file)
        self.whole.encode_special_tokens = True

    def __call__(self, text: str) -> np.ndarray:
        if _LONG_WORD.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def encoder(tokenizer_file: str | None = None, ranks_file: str | None = None) -> Encoder:
    """One encoder for each worker and pair of files; the installed 50k vocabulary if none is named."""
    import public_tokenizers

    files = tokenizer_file or public_tokenizers.path("byte_bpe_50k.json"), ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if files not in _ENCODERS:
        _ENCODERS[files] = Encoder(*map(str, files))
    return _ENCODERS[files]


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens; only the first may be shorter than ``capacity``."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenize(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False,
    tokenizer_file: str | None = None, ranks_file: str | None = None,
) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, and the ``ids`` if asked for.

    A null text counts as empty and gives one piece that holds only the end token. Equal rows stay apart.
    """

    @F.pandas_udf("array<struct<start:long,length:long,ids_crc32:long,ids:array<int>>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(tokenizer_file, ranks_file)
        for texts in batches:
            out = []
            for x in texts:
                ids = np.append(encode(x or ""), np.uint32(END)).astype("<u4")
                out.append([
                    {"start": s, "length": n, "ids_crc32": zlib.crc32(ids[s : s + n].tobytes()), "ids": ids[s : s + n].tolist() if with_ids else None}
                    for s, n in pieces_of(len(ids), capacity)
                ])
            yield pd.Series(out)

    cut_up = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(cut(F.col(text_col))).alias("piece", "p"))
    return cut_up.select("doc_id", F.col("piece").cast("int"), "p.start", "p.length", "p.ids_crc32", *["p.ids"] * with_ids)


class Bins:
    """Sequences of one group, as lists of piece lengths, found by how much room they have."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.room = capacity, [], []
        self.by_room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.mask = 0  # bit r: there is a sequence with room r

    def _drop(self, b: int) -> None:
        r = self.room[b]
        self.by_room[r].discard(b)
        if not self.by_room[r]:
            self.mask &= ~(1 << r)

    def _file(self, b: int) -> None:
        r = self.capacity - sum(self.bins[b])
        self.room[b] = r
        if self.bins[b]:
            self.by_room[r].add(b)
            self.mask |= 1 << r

    def best(self, size: int) -> int | None:
        """A sequence with the least room that holds ``size``."""
        fitting = self.mask >> size
        return min(self.by_room[size + (fitting & -fitting).bit_length() - 1]) if fitting else None

    def change(self, b: int, out: list[int], into: list[int]) -> None:
        self._drop(b)
        for x in out:
            self.bins[b].remove(x)
        for x in into:
            insort(self.bins[b], x)
        self._file(b)

    def put(self, size: int, apart_from: int | None = None) -> None:
        b = self.best(size)
        if b is None:
            b = len(self.bins)
            self.bins.append([])
            self.room.append(self.capacity)
        self.change(b, [], [size])


def _exchange(bins: Bins, poor: int, x: int, partners: list[int]) -> bool:
    """Put piece ``x`` of the sequence ``poor`` into a fuller one, against nothing, one piece or two that are smaller.

    Of all ways that fit, the one that leaves the least room there.
    """
    best: tuple[int, int, list[int]] | None = None
    for b in partners:
        room, items = bins.room[b], bins.bins[b]
        if b == poor or room >= bins.room[poor] or room == 0:
            continue
        need = x - room  # what must at least come out
        if need <= 0:
            ways = [[]]
        else:
            ways = []
            at = bisect_left(items, need)
            if at < len(items) and items[at] < x:
                ways.append([items[at]])
            i, j, least = 0, len(items) - 1, x
            while i < j:
                pair = items[i] + items[j]
                if pair < need:
                    i += 1
                else:
                    if pair < least:
                        least, found = pair, [items[i], items[j]]
                    j -= 1
            if least < x:
                ways.append(found)
        for way in ways:
            left = room - x + sum(way)
            if best is None or left < best[0]:
                best = (left, b, way)
                if left == 0:
                    break
        if best and best[0] == 0:
            break
    if best is None:
        return False
    bins.change(best[1], best[2], [x])
    bins.change(poor, [x], best[2])
    return True


def pack(lengths: list[int], capacity: int = CAPACITY, partners: int = 64, patience: int = 400) -> list[list[int]]:
    """The lengths of each sequence.

    Best fit in descending order; then the emptiest sequence gives its pieces away, step by step, as long as steps
    raise the sum of squared fills. A step looks at the ``partners`` sequences with most room. The search ends after
    ``patience`` vain attempts since a sequence was last emptied, or at the least number that the sum of lengths allows.
    """
    bins = Bins(capacity)
    for x in sorted(lengths, reverse=True):
        bins.put(x)
    least, alive, failed = -(-sum(lengths) // capacity), sum(map(bool, bins.bins)), 0
    stuck: set[int] = set()
    while alive > least and failed < patience:
        open_ = []
        for r in range(capacity, 0, -1):
            open_ += sorted(bins.by_room[r])
            if len(open_) > partners + len(stuck):
                break
        poor = next((b for b in open_ if b not in stuck), None)
        if poor is None:
            break
        others = [b for b in open_ if b != poor]
        moved = any(_exchange(bins, poor, x, others) for x in sorted(bins.bins[poor], reverse=True))
        if moved:
            stuck.clear()  # what changed may take a piece of any of them
        if not bins.bins[poor]:
            alive, failed = alive - 1, 0
        elif not moved:
            stuck.add(poor)
            failed += 1
    return [b for b in bins.bins if b]


def _assign(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece."""
    waiting: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        waiting.setdefault(int(lengths[i]), []).append(i)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, items in enumerate(pack(lengths.tolist(), capacity)):
        at = 0
        for size in items:
            i = waiting[size].pop()
            sequence[i], offset[i] = number, at
            at += size
    return sequence, offset


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, group: int = GROUP,
    with_ids: bool = False, **files: str,
) -> DataFrame:
    """The pieces of ``tokenize`` with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Groups follow the number of pieces, so a group never grows with the corpus. An empty table gives no row. Only the
    id and the text are read, so further columns cannot clash.
    """
    pieces = checkpoint(tokenize(docs, id_col, text_col, capacity, with_ids, **files).withColumn("_row", F.monotonically_increasing_id()))
    groups = max(1, round(pieces.count() / group))
    dealt = pieces.select("_row", "length", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("int").alias("g"))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_row", ignore_index=True)
        sequence, offset = _assign(rows["length"].to_numpy(), capacity)
        return pd.DataFrame({"_row": rows["_row"], "sequence_id": (rows["g"].to_numpy(np.int64) << 32) | sequence, "offset": offset})

    placed = dealt.groupBy("g").applyInPandas(place, "_row long, sequence_id long, offset long")
    return pieces.join(placed, "_row").drop("_row")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from pieces that were packed with their ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"))
