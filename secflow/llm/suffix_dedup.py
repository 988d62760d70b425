"""Removal of repeated substrings with a distributed difference-cover algorithm.

A position is *repeated* if its prefix of ``LENGTH`` (100) bytes also starts earlier: in a document of smaller id, or
earlier in the same one. All bytes under repeated prefixes go. Equal suffix prefixes are found as in difference-cover
suffix sorting, with a larger cover than the usual three residues because the depth that matters is bounded:

1. *Sample.* Positions whose offset in the document is in a perfect difference set modulo 73 are sampled (an eighth).
   For any two suffixes one shift below 73 leads both to sampled positions, so two equal prefixes of 100 bytes hold
   equal sampled tuples of 28 bytes. Tuples are named by 64-bit keys, dealt out by key range, sorted, and neighbours
   compared. Only suffixes near a sampled tuple that occurs twice can be repeated.
2. *Recurse on names.* Where the short name occurs twice, the sampled suffix is named anew at depth 172. If that name
   occurs earlier, the 73 prefixes that start within it are settled without being sorted.
3. *Merge the remaining suffixes.* Every other suffix near a repeated name is named at depth 100, sorted with the rest,
   and compared with its neighbours.

Documents travel once, into blocks of consecutive ids. A block sends each distinct key once, as a packed ascending list
for each key range, and gets back bits in the same order; so a passage that a third of all documents share costs one
key for a block, and no key range depends on how often a key occurs. What a block has found out so far goes back to it
with the replies, as bits, so that no round is computed anew by all later ones.

Names are 64-bit hashes; equal bytes always get equal names. Different bytes get equal names with a probability of
about 2**-58 for each pair, so each match of steps 2 and 3 is verified in a round of its own: matched suffixes and those
they match, no others, get a second, independent 64-bit name, and a match stays only if that occurs earlier too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import mix, pack_keys, unpack_keys

#: A perfect difference set: each residue modulo 73 but 0 is the difference of exactly one pair.
PERIOD = 73
COVER = np.array([0, 1, 12, 20, 26, 30, 33, 35, 57])
LENGTH = 100
#: Bytes of text that a block should hold, and positions whose hashes are held at once.
BLOCK_BYTES = 8 << 20
STEP = 1 << 20

_BASE = 0x9E3779B97F4A7C17
_LETTERS = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
#: Those of the second names, which are independent of the first.
_BASE_2 = 0xC2B2AE3D27D4EB4F
_LETTERS_2 = np.random.default_rng(20240301).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, STEP + 1024), base, np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.cumprod(have)
    return have


class Block:
    """The texts of a block, one after the other, in the order of their ids."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(x) for x in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def ends(self, positions: np.ndarray) -> np.ndarray:
        """Where the document of each position ends."""
        # With empty documents at the same start, the last of equal starts is the one that has bytes.
        at = np.searchsorted(self.starts, positions, side="right") - 1
        return self.starts[at] + self.sizes[at]

    def sampled(self, depth: int) -> np.ndarray:
        """Sampled positions that have ``depth`` bytes before the end of their document."""
        periods = -(-self.sizes // PERIOD)
        base = np.repeat(self.starts - PERIOD * (np.cumsum(periods) - periods), periods)
        base += PERIOD * np.arange(len(base))
        positions = (base[:, None] + COVER).ravel()
        ends = np.repeat(np.repeat(self.starts + self.sizes, periods), len(COVER))
        return positions[positions + depth <= ends]

    def names(self, positions: np.ndarray, depth: int, second: bool = False) -> np.ndarray:
        """64-bit names of the ``depth`` bytes at each of the ascending positions; the second ones if asked for."""
        base, letters = (_BASE_2, _LETTERS_2) if second else (_BASE, _LETTERS)
        out = np.empty(len(positions), np.uint64)
        cuts = np.searchsorted(positions, np.arange(0, len(self.data) + STEP, STEP))
        power, inverse = _powers(base, STEP + depth), _powers(pow(base, -1, 2**64), STEP + depth)
        for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if i == j:
                continue
            part = self.data[k * STEP : (k + 1) * STEP + depth]
            prefix = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(letters[part] * power[: len(part)], out=prefix[1:])
            at = positions[i:j] - k * STEP
            out[i:j] = mix((prefix[at + depth] - prefix[at]) * inverse[at])
        return out


class Names:
    """The distinct names of one round in a block, dealt out to ``owners`` by key range."""

    def __init__(self, positions: np.ndarray, names: np.ndarray, owners: int, bits: int = 64):
        self.positions, self.owners = positions, owners
        names = names >> np.uint64(64 - bits)
        self.keys, first, self.at, count = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
        self.first = np.zeros(len(positions), bool)
        self.first[first] = True
        self.alone = (count == 1)[self.at]
        top = (self.keys >> np.uint64(bits - 32)) if bits > 32 else self.keys
        self.cuts = np.searchsorted((top * np.uint64(owners)) >> np.uint64(32), np.arange(owners + 1))

    def messages(self) -> Iterator[tuple[int, bytes]]:
        for owner, (i, j) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            if i < j:
                yield owner, pack_keys(self.keys[i:j])

    def replies(self, bits: dict[int, tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """For each position: whether its name occurs earlier, whether it occurs anywhere else."""
        earlier, other = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        for owner, (e, o) in bits.items():
            i, j = self.cuts[owner], self.cuts[owner + 1]
            earlier[i:j] = np.unpackbits(np.frombuffer(e, np.uint8), count=j - i)
            other[i:j] = np.unpackbits(np.frombuffer(o, np.uint8), count=j - i)
        return earlier[self.at] | ~self.first, other[self.at] | ~self.alone


def _covered(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each of ``n`` positions: whether it is in any of the ranges."""
    change = np.zeros(n + 1, np.int32)
    change += np.bincount(starts, minlength=n + 1).astype(np.int32)
    change -= np.bincount(stops, minlength=n + 1).astype(np.int32)
    return np.cumsum(change[:n]) > 0


def _marked(n: int, positions: np.ndarray) -> np.ndarray:
    """For each of ``n`` positions: whether it is one of those given."""
    out = np.zeros(n, bool)
    out[positions] = True
    return out


class Rounds:
    """The rounds of a block. Each is told the replies to the names of the round before, and what that round left behind.

    What is left behind are marks: for some ascending list of positions, which of them are meant. So a name is computed
    twice, when it is sent and when its reply is there, however many rounds follow.
    """

    def __init__(self, block: Block, length: int, owners: int, replies: dict[int, tuple[bytes, bytes]], state: bytes | None):
        self.block, self.length, self.owners, self.replies = block, length, owners, replies
        self.n, self.left = len(block.data), self._opened(state)
        self.deep_depth = length + PERIOD - 1

    @staticmethod
    def closed(marks: list[np.ndarray]) -> bytes:
        """Marks as bits."""
        sizes = np.array([len(x) for x in marks], "<i8").tobytes()
        return zstandard.ZstdCompressor(level=3).compress(bytes([len(marks)]) + sizes + b"".join(np.packbits(x).tobytes() for x in marks))

    @staticmethod
    def _opened(state: bytes | None) -> list[np.ndarray]:
        if not state:
            return []
        data = zstandard.ZstdDecompressor().decompress(state)
        out, at = [], 1 + 8 * data[0]
        for size in np.frombuffer(data[1:at], "<i8").tolist():
            out.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        return out

    def _sampled(self) -> np.ndarray:
        return self.block.sampled(self.length - PERIOD + 1)

    def _named(self, positions: np.ndarray, depth: int, second: bool = False, bits: int = 64) -> Names:
        return Names(positions, self.block.names(positions, depth, second), self.owners, bits)

    def _deepest(self, kin: np.ndarray) -> np.ndarray:
        """Sampled suffixes with a repeated short name that are deep enough to settle a whole period."""
        return kin[kin + self.deep_depth <= self.block.ends(kin)] if len(kin) else kin

    def _matched(self, names: Names) -> tuple[np.ndarray, np.ndarray]:
        """Which positions' names occur more than once, and which of those occur earlier."""
        earlier, other = names.replies(self.replies)
        return earlier | other, earlier[earlier | other]

    def _agreed(self, positions: np.ndarray, earlier: np.ndarray, depth: int) -> np.ndarray:
        """Positions that occur earlier by both names."""
        return positions[earlier & self._named(positions, depth, True).replies(self.replies)[0]]

    def short(self) -> tuple[Names, list[np.ndarray]]:
        """Round 0: sampled tuples, named with 40 bits, for a false match here only adds work later."""
        return self._named(self._sampled(), self.length - PERIOD + 1, bits=40), []

    def deep(self) -> tuple[Names, list[np.ndarray]]:
        """Round 1: sampled suffixes with a repeated short name, at the depth that settles a whole period."""
        names = self.short()[0]
        kin = names.replies(self.replies)[1]
        return self._named(self._deepest(names.positions[kin]), self.deep_depth), [kin]

    def deep_again(self) -> tuple[Names, list[np.ndarray]]:
        """Round 2: second names of the suffixes that round 1 has matched."""
        (kin,) = self.left
        positions = self._deepest(self._sampled()[kin])
        matched, earlier = self._matched(self._named(positions, self.deep_depth))
        return self._named(positions[matched], self.deep_depth, True), [kin, matched, earlier]

    def rest(self) -> tuple[Names, list[np.ndarray]]:
        """Round 3: all suffixes near a repeated short name that rounds 1 and 2 have not settled."""
        kin, matched, earlier = self.left
        kin = self._sampled()[kin]
        known = self._agreed(self._deepest(kin)[matched], earlier, self.deep_depth)
        settled = _covered(self.n, known, known + PERIOD)
        positions = np.flatnonzero(_covered(self.n, np.maximum(kin - PERIOD + 1, 0), kin + 1) & ~settled)
        if len(positions):
            positions = positions[positions + self.length <= self.block.ends(positions)]
        return self._named(positions, self.length), [settled, _marked(self.n, positions)]

    def rest_again(self) -> tuple[Names, list[np.ndarray]]:
        """Round 4: second names of the suffixes that round 3 has matched."""
        settled, rest = self.left
        positions = np.flatnonzero(rest)
        matched, earlier = self._matched(self._named(positions, self.length))
        positions = positions[matched]
        return self._named(positions, self.length, True), [settled, _marked(self.n, positions), earlier]

    def removed(self) -> np.ndarray:
        """For each byte of the block: whether a repeated prefix covers it."""
        settled, again, earlier = self.left
        settled[self._agreed(np.flatnonzero(again), earlier, self.length)] = True
        starts = np.flatnonzero(settled)
        return _covered(self.n, starts, starts + self.length)


def _ordered(group: pa.Table) -> tuple[list[int], list[bytes]]:
    """The rows of a block by id (null last), then by text; and their texts in that order."""
    open_up = zstandard.ZstdDecompressor().decompress
    ids, texts = group["_id"].to_pylist(), [open_up(x) if x else b"" for x in group["_text"].to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    return order, [texts[i] for i in order]


def _replied(group: pa.Table) -> tuple[dict[int, tuple[bytes, bytes]], bytes | None]:
    """The replies of all key ranges, and what the round before left behind."""
    replies, state = {}, None
    for row in group.select(["owner", "earlier", "other"]).to_pylist():
        if row["owner"] < 0:
            state = row["earlier"]
        else:
            replies[row["owner"]] = (row["earlier"], row["other"])
    return replies, state


_MESSAGE = pa.schema([("owner", pa.int32()), ("block", pa.int32()), ("keys", pa.binary())])
_REPLY = pa.schema([("block", pa.int32()), ("owner", pa.int32()), ("earlier", pa.binary()), ("other", pa.binary())])


def _compare(group: pa.Table) -> pa.Table:
    """Sort the names of one key range and compare neighbours; one reply for each block.

    What a block has left for itself, under a negative number in place of a range, goes back as it is.
    """
    if group["owner"][0].as_py() < 0:
        return pa.Table.from_arrays([group["block"], group["owner"], group["keys"], pa.array([b""] * len(group), pa.binary())], schema=_REPLY)
    blocks, lists = group["block"].to_numpy(), [unpack_keys(x) for x in group["keys"].to_pylist()]
    sizes = np.array([len(x) for x in lists])
    keys, of = np.concatenate(lists), np.repeat(blocks, sizes)
    order = np.lexsort((of, keys))
    same = keys[order[1:]] == keys[order[:-1]]
    earlier, other = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:]] = same
    other[order[1:]] = same
    other[order[:-1]] |= same
    cuts = np.cumsum(sizes)[:-1]
    packed = [[np.packbits(x).tobytes() for x in np.split(bits, cuts)] for bits in (earlier, other)]
    return pa.Table.from_arrays([group["block"], group["owner"], pa.array(packed[0], pa.binary()), pa.array(packed[1], pa.binary())], schema=_REPLY)


def _plan(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[int, list[int]]:
    """How many blocks there are, and the ids at which they begin. Ids are cut at quantiles of all rows."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks == 1:
        return 1, []
    cuts = docs.agg(F.percentile_approx(id_col, [k / blocks for k in range(1, blocks)], 20 * blocks)).first()[0]
    return blocks, sorted(set(cuts or []))


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = (), length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES, as_text: bool = False,
) -> DataFrame:
    """One row for each document: what repeats earlier text, and what is left.

    Columns: ``doc_id``, ``n_bytes``, ``spans`` (maximal removed runs as structs of byte offsets ``start`` and
    ``stop``), ``kept`` (the remaining bytes), and those of ``keep`` in the struct ``row``, so that no name clashes.
    With ``as_text``, ``kept`` is a string, without the bytes of characters that a cut has split.

    A null text counts as empty, a null id as the largest. Rows of equal id are ordered by their bytes, so of two
    equal rows the second is the repeat. Texts shorter than ``length`` bytes stay whole. An empty table gives none.
    ``length`` is at least 80. A block is cut by ids alone; its texts are held by one task at a time.
    """
    if length < PERIOD + 7:
        raise ValueError(f"length must be at least {PERIOD + 7}")
    blocks, cuts = _plan(docs, id_col, text_col, block_bytes)
    owners = blocks
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.fillna(2**63 - 1).astype("int64").to_numpy(), side="right"))

    @F.pandas_udf("binary")
    def squeezed(texts: pd.Series) -> pd.Series:
        shrink = zstandard.ZstdCompressor(level=1).compress
        return texts.map(lambda x: shrink(x.encode()) if x else None)

    # One exchange of the texts, which travel compressed; every round below reads it again.
    texts = docs.select(
        block_of(F.col(id_col).cast("long")).alias("block"), F.col(id_col).cast("long").alias("_id"), squeezed(F.col(text_col)).alias("_text"),
        F.struct(*[F.col(c) for c in keep] or [F.lit(None).cast("string").alias("none")]).alias("row"),
    )
    by_block = texts.groupBy("block")

    def send(step: str):
        def messages(key, group: pa.Table, replies: pa.Table | None = None) -> pa.Table:
            if not len(group):
                return _MESSAGE.empty_table()
            rounds = Rounds(Block(_ordered(group)[1]), length, owners, *(_replied(replies) if replies is not None else ({}, None)))
            names, left = getattr(rounds, step)()
            number = group["block"][0].as_py()
            rows = [*names.messages(), (-1 - number, Rounds.closed(left))]
            return pa.Table.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([number] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                schema=_MESSAGE,
            )

        return messages

    def answered(messages: DataFrame) -> DataFrame:
        return messages.groupBy("owner").applyInArrow(_compare, "block int, owner int, earlier binary, other binary")

    first = send("short")
    replies = answered(by_block.applyInArrow(lambda key, group: first(key, group), "owner int, block int, keys binary"))
    for step in ("deep", "deep_again", "rest", "rest_again"):
        replies = answered(by_block.cogroup(replies.groupBy("block")).applyInArrow(send(step), "owner int, block int, keys binary"))

    def finish(key, group: pa.Table, answers: pa.Table) -> pa.Table:
        order, ordered = _ordered(group)
        block = Block(ordered)
        gone = Rounds(block, length, owners, *_replied(answers)).removed()
        rows = []
        for k, (start, size) in enumerate(zip(block.starts, block.sizes, strict=True)):
            mask = gone[start : start + size]
            edges = np.flatnonzero(np.diff(mask, prepend=False, append=False)).reshape(-1, 2).tolist()
            kept = block.data[start : start + size][~mask].tobytes() if edges else ordered[k]
            if as_text:
                kept = kept.decode("utf-8", "ignore")
            rows.append((size, [{"start": a, "stop": b} for a, b in edges], kept))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        there = group.take(pa.array(order, pa.int64()))
        return pa.table({
            "doc_id": there["_id"], "n_bytes": pa.array([r[0] for r in rows], pa.int64()), "spans": pa.array([r[1] for r in rows], kind),
            "kept": pa.array([r[2] for r in rows], pa.string() if as_text else pa.binary()), "row": there["row"],
        })

    row = texts.schema["row"].dataType.simpleString()
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(
        finish, f"doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept {'string' if as_text else 'binary'}, row {row}"
    )


def digest(spans: DataFrame) -> DataFrame:
    """Counts and a digest of what is left."""
    return spans.select(
        "doc_id", "n_bytes",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(texts: list[tuple[int, str | None]], length: int = LENGTH) -> list[tuple[int, int, int, int, str]]:
    """The same rows from a table of all substrings, for tests."""
    seen: set[bytes] = set()
    out = []
    for doc_id, text in sorted(texts, key=lambda x: (x[0], (x[1] or "").encode())):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.add(data[i : i + length])
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
