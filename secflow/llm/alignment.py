"""Alignment of the tokens of two tokenizers, with counts of all aligned pairs from an external sort.

Both tokenizations of a text cover the same bytes. Places where tokens of both end cut them into groups; the two tokens
that end there are linked. How often a pair of ids is linked in the whole corpus is counted in the way of an external sort:

1. *Runs.* Each task tokenizes its documents and collects pair-document records (id of B, id of A, document, links). When
   a buffer is full it is radix-partitioned by the B id, sorted side-major (B, A, document), and spilled as a run: for each
   radix partition the distinct pairs with their subtotals in frames of zstd, and the documents of each pair apart.
2. *Merge.* One task for each radix partition merges the pairs of at most ``FAN_IN`` runs through a heap that holds the
   next frame of each run, and adds the subtotals up. More runs are merged in levels. In side-major order all pairs of
   a B id follow each other, so the last level has the highest count of each B id as it passes.
3. *Contributions.* Counts and maxima stream back to the runs in the order of their own pairs, so without the pairs, and
   each run adds up what its records contribute to its documents.

A run holds documents whole, so no document is ever gathered from several tasks. A pair that a third of all documents have
is one entry of each run, whatever the number of documents. The number of radix partitions is fixed, for what they hold is
bounded by the square of the vocabularies and not by the corpus.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.llm.common import checkpoint, mix
from secflow.llm.packing import encoder

#: Radix partitions, by B id.
RADIX = 64
#: Runs merged at once; records and documents of a run; pairs of a frame.
FAN_IN = 64
RECORDS = 4 << 20
DOCUMENTS = 1 << 20
FRAME = 1 << 14
#: Bytes of text that are tokenized at once.
PART = 1 << 20
#: Bits of an id, and of a document's place in its run.
ID_BITS, PLACE_BITS = 18, 20

_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_file: str | None = None, a_ranks: str | None = None, b_file: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.a = encoder(a_file, a_ranks)
        self.b = sentencepiece.SentencePieceProcessor(model_file=str(b_file or public_tokenizers.path("piece_bpe_32k.model")))
        self.a_bytes = [b""] * self.a.fast.n_vocab
        for token in self.a.fast.token_byte_values():
            self.a_bytes[self.a.fast.encode_single_token(token)] = token
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where a side does not spell out a space and the text."""
        none = np.zeros(0, np.int64)
        out = []
        for text, b in zip(texts, self.b.encode([x or "" for x in texts], num_threads=1), strict=True):
            if not text:
                out.append((none, none))
                continue
            a, wanted = self.a(" " + text).tolist(), b" " + text.encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) == wanted == b"".join(map(self.b_bytes.__getitem__, b)):
                out.append((np.array(a, np.int64), np.array(b, np.int64)))
            else:
                out.append((none, none))
        return out


_LOADED: dict[tuple, Tokenizers] = {}


def tokenizers_of(*files: str | None) -> Tokenizers:
    """One pair for each worker and choice of files."""
    if files not in _LOADED:
        _LOADED[files] = Tokenizers(*files)
    return _LOADED[files]


def align(sides: list[tuple[np.ndarray, np.ndarray]], a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups and links of several documents at once, their tokens laid one behind the other.

    Returns the number of groups that end before each A token and before each B token (over all documents), and the linked
    pairs as places of A and B tokens. Both sides of a document have equally many bytes.
    """
    a, b = (np.concatenate([x[k] for x in sides] or [np.zeros(0, np.int64)]) for k in (0, 1))
    # A byte between documents keeps their ends apart.
    a_ends, b_ends = (
        np.cumsum(sizes[ids]) + np.repeat(np.arange(len(sides)), [len(x[k]) for x in sides])
        for k, (ids, sizes) in enumerate(((a, a_sizes), (b, b_sizes)))
    )
    size = int(a_ends[-1]) if len(a_ends) else 0
    at_a, at_b = (np.bincount(ends, minlength=size + 1) for ends in (a_ends, b_ends))
    common = (at_a > 0) & (at_b > 0)
    before = np.cumsum(common) - common
    # All tokens that end at a common place are linked with each other; only tokens without bytes would make it several.
    from_a, from_b = np.flatnonzero(common[a_ends]), np.flatnonzero(common[b_ends])
    if len(from_a) != len(from_b) or (a_ends[from_a] != b_ends[from_b]).any():
        times = at_b[a_ends[from_a]]
        first = np.searchsorted(b_ends, a_ends[from_a])
        from_a = np.repeat(from_a, times)
        from_b = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())
    return before[a_ends], before[b_ends], from_a, from_b


def _written(sides: list[tuple[np.ndarray, np.ndarray]], group_a: np.ndarray, group_b: np.ndarray) -> list[str]:
    """Digest of the groups of each document as ``a1,a2|b1;a3|b2``; empty without tokens."""
    a, b = (np.concatenate([x[k] for x in sides] or [np.zeros(0, np.int64)]) for k in (0, 1))
    groups = int(max(group_a.max(initial=-1), group_b.max(initial=-1))) + 1
    n_a, n_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    ids, last = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    ends = np.cumsum(n_a + n_b)
    ids[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[group_a]] = a
    ids[np.arange(len(b)) + np.cumsum(n_a)[group_b]] = b
    last[(ends - n_b - 1)[n_a > 0]] = 1
    last[ends - 1] = 2
    pieces = list(map(_marks(1 << 16).__getitem__, (ids * 3 + last).tolist()))
    out, at = [], 0
    for x, y in sides:
        n = len(x) + len(y)
        out.append(hashlib.sha256("".join(pieces[at : at + n])[:-1].encode()).hexdigest() if n else "")
        at += n
    return out


_MARKS: list[str] = []


def _marks(n: int) -> list[str]:
    """An id below ``n`` and what follows it: another id of its side, the other side, the next group."""
    if len(_MARKS) < 3 * n:
        _MARKS.clear()
        _MARKS.extend(f"{i}{c}" for i in range(n) for c in ",|;")
    return _MARKS


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as zstd of their bytes, lowest bytes first."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    width = max(1, int(planes.any(axis=1).nonzero()[0].max(initial=0)) + 1)
    return bytes([width]) + zstandard.ZstdCompressor(level=3).compress(planes[:width].tobytes())


def _expand(packed: bytes) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8)
    planes = np.zeros((len(data) // packed[0], 8), np.uint8)
    planes[:, : packed[0]] = data.reshape(packed[0], -1).T
    return planes.reshape(-1).view("<u8").astype(np.int64)


def _frames(pairs: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Ascending pairs and their counts, in frames that are opened one at a time."""
    out = []
    for i in range(0, len(pairs), FRAME):
        part = _squeeze(np.diff(pairs[i : i + FRAME], prepend=0))
        out.append(len(part).to_bytes(4, "little") + part + _squeeze(counts[i : i + FRAME]))
    return out


def _open(frame: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = 4 + int.from_bytes(frame[:4], "little")
    return np.cumsum(_expand(frame[4:n])), _expand(frame[n:])


def merge_runs(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of all runs in ascending order with the sums of their counts, piece by piece.

    The heap holds the last pair of the open frame of each run. What is not above the least of these is complete: it is
    taken from all open frames, added up, and the next frame of that run is opened.
    """
    left = [iter(frames) for frames in runs]
    open_: list[tuple[np.ndarray, np.ndarray]] = []
    heap = []
    for k, frames in enumerate(left):
        first = next(frames, None)
        open_.append(_open(first) if first is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        if first is not None:
            heap.append((int(open_[k][0][-1]), k))
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        taken = []
        for k, (pairs, counts) in enumerate(open_):
            cut = int(np.searchsorted(pairs, bound, side="right"))
            if cut:
                taken.append((pairs[:cut], counts[:cut]))
                open_[k] = pairs[cut:], counts[cut:]
        pairs, counts = (np.concatenate(x) for x in zip(*taken, strict=True))
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        firsts = np.flatnonzero(np.diff(pairs, prepend=-1))
        yield pairs[firsts], np.add.reduceat(counts, firsts)
        while heap and heap[0][0] == bound:
            _, k = heapq.heappop(heap)
            frame = next(left[k], None)
            if frame is not None:
                open_[k] = _open(frame)
                heapq.heappush(heap, (int(open_[k][0][-1]), k))


class Buffer:
    """Records of documents until they are spilled as a run."""

    def __init__(self, radix: int):
        self.radix, self.keys, self.counts, self.docs, self.n = radix, [], [], [], 0

    def add(self, docs: list[dict], pairs: np.ndarray, of: np.ndarray) -> None:
        """Documents, and their links as (pair, place of the document among them)."""
        keys, counts = np.unique((pairs << PLACE_BITS) | (of + len(self.docs)), return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.docs += docs
        self.n += len(keys)

    def full(self) -> bool:
        return self.n >= RECORDS or len(self.docs) >= DOCUMENTS // 2

    def spill(self) -> tuple[list[dict], list[list[bytes]], list[bytes]]:
        """Documents, frames of pairs and records for each radix partition."""
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        pairs, places = keys >> PLACE_BITS, keys & ((1 << PLACE_BITS) - 1)
        owner = (mix((pairs >> ID_BITS).astype(np.uint64)) % np.uint64(self.radix)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        heads, bodies = [], []
        for part in np.split(order, np.cumsum(np.bincount(owner, minlength=self.radix))[:-1]):
            own, n = pairs[part], counts[part]
            firsts = np.flatnonzero(np.diff(own, prepend=-1))
            heads.append(_frames(own[firsts], np.add.reduceat(n, firsts)) if len(part) else [])
            # Places ascend within a pair; differences are small where a pair is common.
            steps = np.diff(places[part], prepend=0)
            steps[firsts] = places[part][firsts]
            bodies.append(b"".join(len(x).to_bytes(4, "little") + x for x in map(_squeeze, (np.diff(firsts, append=len(part)), steps, n))) if len(part) else b"")
        return self.docs, heads, bodies


def _records(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pair of the run each record has, its document, and its links."""
    parts, at = [], 0
    while at < len(body):
        n = int.from_bytes(body[at : at + 4], "little")
        parts.append(_expand(body[at + 4 : at + 4 + n]))
        at += 4 + n
    of_pair, steps, counts = parts
    total, firsts = np.cumsum(steps), np.cumsum(of_pair) - of_pair
    return np.repeat(np.arange(len(of_pair)), of_pair), total - np.repeat(total[firsts] - steps[firsts], of_pair), counts


_DOC = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.LongType()) for c in _COLUMNS], T.StructField("groups_sha256", T.StringType())])
_RUN = T.StructType([
    T.StructField("node", T.LongType()), T.StructField("docs", T.ArrayType(_DOC)), T.StructField("heads", T.ArrayType(T.ArrayType(T.BinaryType()))),
    T.StructField("bodies", T.ArrayType(T.BinaryType())),
])
_ARROW_DOC = pa.struct([("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COLUMNS], ("groups_sha256", pa.string())])
_ARROW_RUN = pa.schema([("node", pa.int64()), ("docs", pa.list_(_ARROW_DOC)), ("heads", pa.list_(pa.list_(pa.binary()))), ("bodies", pa.list_(pa.binary()))])
_HEAD = pa.schema([("node", pa.int64()), ("radix", pa.int32()), ("frames", pa.list_(pa.binary()))])
_REPLY = pa.schema([("node", pa.int64()), ("radix", pa.int32()), ("counts", pa.binary()), ("best", pa.binary())])
_REPLY_DDL = "node long, radix int, counts binary, best binary"


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, n = 0, 0
    for k, text in enumerate(texts):
        n += len(text or "")
        if n >= PART:
            yield start, k + 1
            start, n = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def describe(tokenizers: Tokenizers, ids: list[int | None], texts: list[str | None]) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """What each document has, and the links of all as pairs and as places of their documents."""
    sides = tokenizers.encode(texts)
    group_a, group_b, from_a, from_b = align(sides, tokenizers.a_sizes, tokenizers.b_sizes)
    n_a, n_b = (np.array([len(x[k]) for x in sides], np.int64) for k in (0, 1))
    of = np.searchsorted(np.cumsum(n_a), from_a, side="right")
    links = np.bincount(of, minlength=len(sides))
    a_ends = np.cumsum(n_a)
    ended = np.where(n_a > 0, group_a[np.maximum(a_ends - 1, 0)] + 1 if len(group_a) else 0, 0)
    groups = np.where(n_a > 0, ended - np.concatenate([[0], np.maximum.accumulate(ended)[:-1]]), 0)
    a, b = (np.concatenate([x[k] for x in sides]) for k in (0, 1))
    hashes = _written(sides, group_a, group_b)
    docs = [
        {"doc_id": i, "n_a": int(x), "n_b": int(y), "n_groups": int(g), "n_links": int(n), "groups_sha256": h}
        for i, x, y, g, n, h in zip(ids, n_a, n_b, groups, links, hashes, strict=True)
    ]
    return docs, (b[from_b] << ID_BITS) | a[from_a], of


def spill_runs(docs: DataFrame, id_col: str, text_col: str, files: tuple[str | None, ...], radix: int) -> DataFrame:
    """The documents, tokenized, as runs of pair-document records."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizers, buffer, number = tokenizers_of(*files), Buffer(radix), TaskContext.get().partitionId() << 32

        def spilled() -> pa.RecordBatch:
            rows, heads, bodies = buffer.spill()
            return pa.RecordBatch.from_pydict({"node": [number], "docs": [rows], "heads": [heads], "bodies": [bodies]}, schema=_ARROW_RUN)

        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for start, stop in _parts(texts):
                buffer.add(*describe(tokenizers, ids[start:stop], texts[start:stop]))
                if buffer.full():
                    yield spilled()
                    buffer, number = Buffer(radix), number + 1
        if buffer.docs:
            yield spilled()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tokenize, _RUN)


def _merge_up(key: tuple, group: pa.Table) -> pa.Table:
    """One run of distinct pairs from several."""
    frames: list[bytes] = []
    for pairs, counts in merge_runs(group["frames"].to_pylist()):
        frames += _frames(pairs, counts)
    return pa.Table.from_pydict({"node": [key[0].as_py()], "radix": [key[1].as_py()], "frames": [frames]}, schema=_HEAD)


def _replies(group: pa.Table, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> pa.Table:
    """For each run of the group: counts of its own pairs and whether they are the highest of their B id, in its own order."""
    out: dict[str, list] = {"node": group["node"].to_pylist(), "radix": group["radix"].to_pylist(), "counts": [], "best": []}
    for frames in group["frames"].to_pylist():
        at = [np.searchsorted(pairs, _open(frame)[0]) for frame in frames]
        at = np.concatenate(at) if at else np.zeros(0, np.int64)
        out["counts"].append(_squeeze(counts[at]))
        out["best"].append(np.packbits(best[at]).tobytes())
    return pa.Table.from_pydict(out, schema=_REPLY)


def _all_pairs(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    pieces = list(merge_runs(group["frames"].to_pylist()))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*pieces, strict=True)) if pieces else none


def _merge_last(key: tuple, group: pa.Table) -> pa.Table:
    """Counts of all pairs, the highest of each B id, and the replies to the runs."""
    pairs, counts = _all_pairs(group)
    b = pairs >> ID_BITS
    firsts = np.flatnonzero(np.diff(b, prepend=-1))
    highest = np.maximum.reduceat(counts, firsts) if len(firsts) else counts
    best = counts == np.repeat(highest, np.diff(firsts, append=len(b)))
    return _replies(group, pairs, counts, best)


def _merge_down(key: tuple, group: pa.Table, answer: pa.Table) -> pa.Table:
    """What a merged run has been told, told to the runs that it was merged from."""
    if not len(group):
        return _REPLY.empty_table()
    pairs = _all_pairs(group)[0]
    counts = _expand(answer["counts"][0].as_py())
    best = np.unpackbits(np.frombuffer(answer["best"][0].as_py(), np.uint8), count=len(counts)).astype(bool)
    return _replies(group, pairs, counts, best)


def _counted(runs: DataFrame, fan_in: int) -> DataFrame:
    """(node, radix, counts, best) for each run and radix partition, by merging in as many levels as it takes."""
    level = runs.select("node", F.posexplode("heads").alias("radix", "frames"))
    n, levels = runs.count(), []
    while n > fan_in:
        n = -(-n // fan_in)
        level = level.withColumn("parent", F.pmod(F.xxhash64("node"), F.lit(n)))
        levels.append(level)
        level = level.groupBy("parent", "radix").applyInArrow(_merge_up, "node long, radix int, frames array<binary>")
    replies = level.groupBy("radix").applyInArrow(_merge_last, _REPLY_DDL)
    for below in reversed(levels):
        # The replies to a merged run meet the runs that it came from.
        replies = below.groupBy("parent", "radix").cogroup(replies.groupBy("node", "radix")).applyInArrow(_merge_down, _REPLY_DDL)
    return replies


def align_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_file: str | None = None, a_ranks: str | None = None,
    b_file: str | None = None, radix: int = RADIX, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row for each document: tokens of A and B, groups, links, and how common the linked pairs are in all documents.

    Columns: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is as common as any of
    its B id), ``count_sum`` (over links, the links that hold the same pair in all documents) and ``groups_sha256`` (of
    the groups written as ``a1,a2|b1;a3|b2``). A is a byte-level vocabulary, given by its tokenizer file and its ranks,
    and reads a space and the text; B is a piece model that adds the space itself. Strings of special tokens are text.

    Texts that are null or empty, or that one side does not spell out byte by byte, have no tokens: zeros and an empty
    ``groups_sha256``. Equal rows stay apart and count each; ties for the highest count all count. An empty table gives no
    row. Only the id and the text are read, so further columns cannot clash. A text of any length is tokenized whole, by
    one task.
    """
    runs = checkpoint(spill_runs(docs, id_col, text_col, (a_file, a_ranks, b_file), radix))
    replies = _counted(runs, fan_in)
    kind = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in (*_COLUMNS, "n_best", "count_sum")], ("groups_sha256", pa.string())])

    def finish(key: tuple, run: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(run):
            return kind.empty_table()
        rows, bodies = run["docs"][0].as_py(), run["bodies"][0].as_py()
        n_best, count_sum = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for answer in answers.to_pylist():
            if not bodies[answer["radix"]]:
                continue
            pair, place, links = _records(bodies[answer["radix"]])
            counts = _expand(answer["counts"])
            best = np.unpackbits(np.frombuffer(answer["best"], np.uint8), count=len(counts)).astype(bool)
            np.add.at(count_sum, place, counts[pair] * links)
            np.add.at(n_best, place, links * best[pair])
        for k, row in enumerate(rows):
            row["n_best"], row["count_sum"] = int(n_best[k]), int(count_sum[k])
        return pa.Table.from_pylist(rows, schema=kind)

    numbers = ", ".join(f"{c} long" for c in ("doc_id", *_COLUMNS, "n_best", "count_sum"))
    bodies = runs.select("node", "docs", "bodies")
    return bodies.groupBy("node").cogroup(replies.groupBy("node")).applyInArrow(finish, f"{numbers}, groups_sha256 string")


def brute_force(docs: list[tuple[int | None, str | None]], **files: str) -> list[tuple]:
    """The same rows in plain Python with the unchanged tokenizer file, for tests."""
    import public_tokenizers
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a_side.encode_special_tokens = True
    tokenizers = tokenizers_of(files.get("a_file"), files.get("a_ranks"), files.get("b_file"))
    counts: Counter = Counter()
    seen = []
    for doc_id, text in docs:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tokenizers.b.encode(text) if text else []
        spelled = [b"".join(table[i] for i in ids) for table, ids in ((tokenizers.a_bytes, a), (tokenizers.b_bytes, b))]
        if text and not spelled[0] == spelled[1] == b" " + text.encode():
            a, b = [], []
        ends = []
        for table, ids in ((tokenizers.a_bytes, a), (tokenizers.b_bytes, b)):
            at, own = 0, []
            for i in ids:
                at += len(table[i])
                own.append(at)
            ends.append(own)
        links = [(x, y) for x, i in zip(a, ends[0], strict=True) for y, j in zip(b, ends[1], strict=True) if i == j]
        groups, start = [], 0
        for stop in sorted(set(ends[0]) & set(ends[1])):
            inside = [",".join(str(x) for x, e in zip(ids, own, strict=True) if start < e <= stop) for ids, own in ((a, ends[0]), (b, ends[1]))]
            groups.append("|".join(inside))
            start = stop
        counts.update(links)
        seen.append((doc_id, len(a), len(b), links, groups))
    highest: dict[int, int] = {}
    for (_, y), n in counts.items():
        highest[y] = max(highest.get(y, 0), n)
    return [
        (i, n_a, n_b, len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for i, n_a, n_b, links, groups in seen
    ]
