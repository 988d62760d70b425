"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Items of a benchmark are cut into windows of ``WINDOW`` words; an item of fewer words is one window. The windows are
hashed into a set, which is broadcast, and the words of all documents are scanned window by window: a bit map first, the
sorted hashes next, and then the words themselves, so that no hash ever decides. All words under a verified window are
hit. What was hit can be cut out, or its document dropped.

The set holds the windows of at most ``SET_BYTES`` of item texts, which is checked before anything is collected. Larger
benchmarks are dealt into parts of that size, and the documents are scanned once for each part; no shuffle is needed, for
the words hit so far travel beside their text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import checkpoint, mix

WINDOW = 10
#: Bytes of item texts whose windows one set may hold.
SET_BYTES = 4 << 20
#: Words that are scanned at once.
WORDS = 1 << 20

#: Bytes of words: digits, small letters and all beyond ASCII; capital letters become small ones, the rest separates.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: The same words in a text as it was written.
_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
_BASE = 0x9E3779B97F4A7C17


def words_of(text: str | None) -> list[bytes]:
    """The normalised words of a text; none of a null."""
    return (text or "").encode().translate(_LETTERS).split()


class WindowSet:
    """The distinct windows of some items, by length, and the items that each occurs in."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        numbers: dict[bytes, int] = {}
        owners: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            codes = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
            size = min(window, len(codes))
            for i in range(len(codes) - size + 1 if size else 0):
                owners[size][tuple(codes[i : i + size])].add(name)
        self.numbers = numbers
        self.items = sorted({name for name, _ in items})
        self.lengths: dict[int, tuple[np.ndarray, ...]] = {}
        seed = 0
        while True:  # another seed where two different windows share a hash
            values = np.random.default_rng(seed).integers(0, 2**64, len(numbers) + 1, dtype=np.uint64)
            hashed = {size: self._hashes(np.array(list(windows), np.int64).reshape(-1, size), values) for size, windows in owners.items()}
            if all(len(np.unique(h)) == len(h) for h in hashed.values()):
                break
            seed += 1
        self.values = values
        for size, windows in owners.items():
            order = np.argsort(hashed[size])
            codes = np.array(list(windows), np.int32).reshape(-1, size)[order]
            rank = {name: k for k, name in enumerate(self.items)}
            names = [[rank[x] for x in windows] for windows in windows.values()]
            names = [names[i] for i in order]
            bits = max(16, (16 * len(order)).bit_length())
            present = np.zeros(1 << bits, bool)
            present[hashed[size] >> np.uint64(64 - bits)] = True
            of, starts = np.array([x for own in names for x in own], np.int32), np.cumsum([0, *map(len, names)])
            self.lengths[size] = hashed[size][order], codes, present, of, starts

    @staticmethod
    def _hashes(codes: np.ndarray, values: np.ndarray) -> np.ndarray:
        powers = np.cumprod(np.full(codes.shape[1], _BASE, np.uint64)) * np.uint64(pow(_BASE, -1, 2**64))
        return mix((values[codes] * powers).sum(axis=1, dtype=np.uint64))

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words; 0 for those that no item has."""
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.int32, len(words))

    def scan(self, codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length of windows: it, the places where windows start, and which windows. ``ends`` has the end of each text."""
        powers, inverse = _powers(len(codes))
        prefix = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.values[codes] * powers[: len(codes)], out=prefix[1:])
        for size, (hashes, windows, present, *_) in self.lengths.items():
            if len(codes) < size:
                continue
            h = mix((prefix[size:] - prefix[:-size]) * inverse[: len(codes) - size + 1])
            at = np.flatnonzero(present[h >> np.uint64(64 - (len(present) - 1).bit_length())])
            which = np.minimum(np.searchsorted(hashes, h[at]), len(hashes) - 1)
            same = hashes[which] == h[at]
            at, which = at[same], which[same]
            inside = at + size <= ends[np.searchsorted(ends, at, side="right")]
            at, which = at[inside], which[inside]
            true = (codes[at[:, None] + np.arange(size)] == windows[which]).all(axis=1)
            yield size, at[true], which[true]


_CACHE: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, from the 0th on."""
    have = _CACHE.get("powers")
    if have is None or len(have[0]) < n:
        out = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            x = np.full(max(n, WORDS), base, np.uint64)
            x[0] = 1
            out.append(np.cumprod(x))
        have = _CACHE["powers"] = out[0], out[1]
    return have


def _hits(found: WindowSet, texts: list[list[bytes]]) -> tuple[list[np.ndarray], list[set[str]]]:
    """For each text (as words): which of its words are hit, and the items."""
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes)
    codes = found.codes([w for words in texts for w in words])
    change = np.zeros(len(codes) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for size, at, which in found.scan(codes, ends):
        change += np.bincount(at, minlength=len(change)) - np.bincount(at + size, minlength=len(change))
        owners, starts = found.lengths[size][3:]
        of = np.searchsorted(ends, at, side="right")
        for key in np.unique(of * len(starts) + which).tolist():
            doc, k = divmod(key, len(starts))
            items[doc].update(found.items[i] for i in owners[starts[k] : starts[k + 1]].tolist())
    hit = np.cumsum(change[:-1]) > 0
    return np.split(hit, ends[:-1]), items


def _spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """The stretches of hit words, from the start of the first to the end of the last."""
    places = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(hit, prepend=False, append=False)).reshape(-1, 2).tolist()
    return [{"start": places[i][0], "stop": places[j - 1][1]} for i, j in edges]


def _without(text: str | None, spans: list[dict[str, int]]) -> str | None:
    """A text without the spans."""
    if not spans:
        return text
    starts, stops = [x["start"] for x in spans] + [len(text)], [0] + [x["stop"] for x in spans]
    return "".join(text[a:b] for a, b in zip(stops, starts, strict=True))


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """(start, stop, words) of as many texts as hold ``WORDS`` words or so."""
    start, words, n = 0, [], 0
    for k, text in enumerate(texts):
        words.append(words_of(text))
        n += len(words[-1])
        if n >= WORDS:
            yield start, k + 1, words
            start, words, n = k + 1, [], 0
    if words:
        yield start, len(texts), words


def find(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", keep: list[str] = (), window: int = WINDOW, set_bytes: int = SET_BYTES, clean: bool = False,
) -> DataFrame:
    """One row for each document: its words, those under windows of items, and where they are.

    Columns: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids, as sorted texts, of the items that have an occurring
    window), ``spans`` (code points ``start`` and ``stop`` of each stretch of hit words), ``clean`` (if asked for: the
    text without these), and the columns of ``keep`` in the struct ``row``, so that no name clashes.

    A null or empty text has no words, in documents and in items; an item without words hits nothing. A null item id
    counts as an empty one. Items of one id are one item; repeated documents give repeated rows. An empty benchmark hits
    nothing, an empty table gives no row. A text is scanned by one task, whole. Items larger than ``set_bytes`` make a
    part of their own.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // set_bytes))
    context = docs.sparkSession.sparkContext
    row = F.struct(*[F.col(c) for c in keep] or [F.lit(None).cast("string").alias("none")])
    state = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row.alias("row"),
        F.lit(None).cast("binary").alias("hit"), F.array().cast("array<string>").alias("items"),
    )
    row_type = state.schema["row"].dataType.simpleString()
    results = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def scanner(shared, last: bool):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = shared.value
            for batch in batches:
                for start, stop, words in _parts(batch["text"].to_pylist()):
                    there = batch.slice(start, stop - start)
                    hits, names = _hits(found, words)
                    before = zip(there["hit"].to_pylist(), there["items"].to_pylist(), strict=True)
                    for k, (bits, old) in enumerate(before):
                        names[k].update(old)
                        if bits is not None:
                            hits[k] = hits[k] | np.unpackbits(np.frombuffer(bits, np.uint8), count=len(hits[k])).astype(bool)
                    columns = {"doc_id": there["doc_id"], "row": there["row"], "items": pa.array([sorted(x) for x in names], pa.list_(pa.string()))}
                    if last:
                        texts = there["text"].to_pylist()
                        columns["n_words"] = pa.array([len(x) for x in hits], pa.int64())
                        columns["n_hit"] = pa.array([int(x.sum()) for x in hits], pa.int64())
                        spans = [_spans(t, h) if h.any() else [] for t, h in zip(texts, hits, strict=True)]
                        columns["spans"] = pa.array(spans, results)
                        columns["clean"] = pa.array([_without(t, x) if clean else None for t, x in zip(texts, spans, strict=True)], pa.string())
                    else:
                        columns["text"] = there["text"]
                        columns["hit"] = pa.array([np.packbits(x).tobytes() for x in hits], pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)

        return scan

    for k in range(parts):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k) if parts > 1 else items
        shared = context.broadcast(WindowSet([tuple(r) for r in own.collect()], window))
        last = k + 1 == parts
        schema = f"doc_id long, row {row_type}, items array<string>, "
        schema += "n_words long, n_hit long, spans array<struct<start:long,stop:long>>, clean string" if last else "text string, hit binary"
        state = state.mapInArrow(scanner(shared, last), schema)
        if not last:
            state = checkpoint(state)
    return state.select("doc_id", "n_words", "n_hit", "items", "spans", *["clean"] * clean, "row")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, whole: bool = False, id_col: str = "doc_id", text_col: str = "text", **options: object,
) -> DataFrame:
    """The columns of ``docs``, their texts without the words that are hit; with ``whole``, without the documents that are.

    A document that loses all its words stays, with what stood between them.
    """
    found = find(docs, benchmark, id_col, text_col, keep=docs.columns, clean=not whole, **options)
    if whole:
        return found.filter("n_hit = 0").select("row.*")
    return found.select(*[F.col("clean").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """Counts and a digest of the items."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[str, str | None]], window: int = WINDOW) -> list[tuple[int, int, int, list[str]]]:
    """(id, words, hit words, items) by comparing every place of every text with every window, for tests."""
    out = []
    for doc_id, text in docs:
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        hit, names = set(), set()
        for name, item in items:
            other = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (item or "").encode()))
            size = min(window, len(other))
            for i in range(len(other) - size + 1 if size else 0):
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == other[i : i + size]:
                        hit.update(range(j, j + size))
                        names.add(name)
        out.append((doc_id, len(words), len(hit), sorted(names)))
    return out


#: The windows of each document joined to those of the items.
SQL = r"""
WITH item AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
  FROM item, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS r(i) WHERE len(w) > 0
), doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), found AS (
  SELECT r, i, p.size, item FROM (
    SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
    FROM doc, (SELECT DISTINCT size FROM windows), unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS t(i)
  ) p JOIN windows q ON p.size = q.size AND p.gram = q.gram
), hits AS (
  SELECT r, count(DISTINCT i + k) AS n_hit
  FROM (SELECT DISTINCT r, i, size FROM found), unnest(range(0, size)) AS t(k) GROUP BY r
), names AS (
  SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN names USING (r)
"""
