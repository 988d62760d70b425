"""Detection of periodic runs of words by block convolution.

A run is a maximal stretch of words with smallest period ``q`` that is at least ``MIN_LENGTH`` words and three periods
long. At each dyadic scale ``m`` a text is cut into blocks of ``m`` words. A run of period ``m <= q < 2 m`` holds a whole
block and its repetition ``q`` words later, so it is found by locating the zero-mismatch occurrences of every block at the
distances from ``m`` to ``2 m`` (at the smallest scale from 1 on; beyond the largest scale in the windows after these).

Mismatch is the sum of squared differences of word codes. Its cross term is a convolution, computed with number-theoretic
transforms modulo the prime 7 * 2**20 + 1. All values are whole numbers held in doubles and are reduced before they could
reach 2**53, so the transforms, which are products with small matrices, are exact. A block is transformed once, padded to
twice its length: the transform of the window behind it is the next block's plus the one after next's with alternating
signs. Modulo the prime an occurrence always gives zero; each zero seeds an extension to both sides that compares the words
themselves, so nothing rests on the modulus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import mix

MIN_LENGTH = 24
REPEATS = 3
#: Words of a block at the smallest scale and at the largest one.
SMALLEST, LARGEST = 8, 8192
#: Words that are searched at once, but for longer texts, and numbers in the arrays of one step.
WORDS = 1 << 18
STEP = 1 << 16

PRIME = 7 * 2**20 + 1
_ROOT = 3  # generates the multiplicative group modulo PRIME
_DIRECT = 256


def _reduced(x: np.ndarray) -> np.ndarray:
    """Whole numbers below 2**53 in size modulo the prime, between -PRIME / 2 and PRIME / 2 or so; in place."""
    turns = x * (1.0 / PRIME)
    np.rint(turns, out=turns)
    turns *= PRIME
    x -= turns
    return x


def _roots(n: int, exponents: np.ndarray, scale: int = 1) -> np.ndarray:
    """Powers of an n-th root of unity, times ``scale``, as reduced doubles."""
    root, powers = pow(_ROOT, (PRIME - 1) // n, PRIME), [scale % PRIME]
    for _ in range(n - 1):
        powers.append(powers[-1] * root % PRIME)
    return _reduced(np.array(powers, np.float64)[exponents % n])


class Transform:
    """Transforms of length ``2 m`` of blocks of ``m`` numbers, and back; in one product, or in two with twiddle factors."""

    def __init__(self, m: int):
        n = self.n = 2 * m
        self.m = m
        self.rows = 1 if n <= _DIRECT else 1 << (n.bit_length() // 2)
        r, s = self.rows, n // self.rows
        inverse = pow(n, -1, PRIME)
        if r == 1:
            self.forth = _roots(n, np.outer(np.arange(m), np.arange(n)))
            self.back = _roots(n, -np.outer(np.arange(n), np.arange(m)), inverse)
            frequency = np.arange(n)
        else:
            self.long, self.short = _roots(r, np.outer(np.arange(r), np.arange(r // 2))), _roots(s, np.outer(np.arange(s), np.arange(s)))
            self.twiddle = _roots(n, np.outer(np.arange(r), np.arange(s)))
            self.long_back, self.short_back = _roots(r, -np.outer(np.arange(r // 2), np.arange(r))), _roots(s, -np.outer(np.arange(s), np.arange(s)))
            self.twiddle_back = _roots(n, -np.outer(np.arange(r), np.arange(s)), inverse)
            frequency = (np.arange(r)[:, None] + r * np.arange(s)).ravel()
        place = np.empty(n, np.int64)
        place[frequency] = np.arange(n)
        self.mirror = place[-frequency % n]
        self.sign = 1.0 - 2.0 * (frequency % 2)

    def forward(self, blocks: np.ndarray) -> np.ndarray:
        if self.rows == 1:
            return _reduced(blocks @ self.forth)
        r, s = self.rows, self.n // self.rows
        x = _reduced(np.matmul(self.long, blocks.reshape(-1, r // 2, s)))
        x = _reduced(x * self.twiddle)
        return _reduced(np.matmul(x, self.short)).reshape(-1, self.n)

    def first_half(self, spectra: np.ndarray) -> np.ndarray:
        """The first ``m`` numbers of each."""
        if self.rows == 1:
            return _reduced(spectra @ self.back)
        r, s = self.rows, self.n // self.rows
        x = _reduced(np.matmul(spectra.reshape(-1, r, s), self.short_back))
        x = _reduced(x * self.twiddle_back)
        return _reduced(np.matmul(self.long_back, x)).reshape(-1, self.m)

    def correlations(self, block: np.ndarray, window: np.ndarray, next_window: np.ndarray) -> np.ndarray:
        """Sums of products of each block with the 2 m numbers of its window, at the first m shifts, from their spectra."""
        spectrum = _reduced(window + self.sign * next_window)
        spectrum *= block[:, self.mirror]
        return self.first_half(_reduced(spectrum))


@lru_cache
def transform(m: int) -> Transform:
    return Transform(m)


def _zeros(values: np.ndarray, squares: np.ndarray, starts: np.ndarray, m: int, windows: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the block, distance) where a block that starts at one of ``starts`` may occur again.

    The starts follow each other by ``m`` but where a text ends. ``squares`` has sums of ``m`` squares from each place.
    """
    t, inside, ahead = transform(m), np.arange(m), windows[-1] + 1
    step = max(32, STEP // (2 * m))
    for low in range(0, len(starts), step):
        own = starts[low : low + step]
        # Blocks behind the last one of a text belong to other texts; distances that reach them are left out later.
        needed = np.concatenate([own, own[-1] + m * np.arange(1, ahead + 1)])
        following = starts[low + len(own) : low + len(own) + ahead]
        needed[len(own) : len(own) + len(following)] = following
        spectra = t.forward(values[needed[:, None] + inside])
        n = len(own)
        for j in windows:
            cross = t.correlations(spectra[:n], spectra[j : n + j], spectra[j + 1 : n + j + 1])
            mismatch = _reduced(squares[own][:, None] + squares[own[:, None] + j * m + inside] - 2 * cross)
            block, shift = np.nonzero(mismatch == 0)
            yield own[block], shift + j * m


def _seeds(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, distances and scales of blocks that may occur again, over texts laid one behind the other."""
    starts = np.cumsum(sizes) - sizes
    ends = starts + sizes
    values = (mix(codes.astype(np.uint64) + np.uint64(1)) % np.uint64(PRIME)).astype(np.float64) - PRIME // 2
    m, longest, out = SMALLEST, int(sizes.max(initial=0)), []
    while m <= LARGEST and (longest // REPEATS >= m or (m == SMALLEST and longest >= MIN_LENGTH)):
        room = longest // REPEATS // m + 2
        padded = np.concatenate([values, np.zeros((room + 2) * m)])
        total = np.concatenate([[0], np.cumsum((padded * padded).astype(np.int64))])  # differences are right even if it wraps
        squares = _reduced(((total[m:] - total[:-m]) % PRIME).astype(np.float64))
        texts = np.flatnonzero((sizes >= MIN_LENGTH) & ((sizes // REPEATS >= m) | (m == SMALLEST)))
        first = 0 if m == SMALLEST else 1
        far = sizes[texts] // REPEATS // m if m == LARGEST else np.ones(len(texts), np.int64)
        for windows, chosen in ((range(first, 2), texts[far <= 1]), *((range(first, n + 1), np.array([x])) for x, n in zip(texts, far, strict=True) if n > 1)):
            if not len(chosen):
                continue
            blocks = -(-sizes[chosen] // m)
            at = np.repeat(starts[chosen] - m * (np.cumsum(blocks) - blocks), blocks) + m * np.arange(blocks.sum())
            for place, distance in _zeros(padded, squares, at, m, windows):
                text = np.searchsorted(ends, place, side="right")
                true = (distance > 0) & (distance <= sizes[text] // REPEATS) & (place + distance + m <= ends[text])
                out.append((place[true], distance[true], np.full(int(true.sum()), m)))
        m *= 2
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _extended(codes: np.ndarray, place: int, distance: int) -> tuple[int, int]:
    """The stretch of places around ``place`` whose words equal those ``distance`` later; empty if not even it does."""
    n, ahead, step = len(codes) - distance, place, 64
    while ahead < n:
        stop = min(n, ahead + step)
        other = np.flatnonzero(codes[ahead:stop] != codes[ahead + distance : stop + distance])
        if len(other):
            ahead += int(other[0])
            break
        ahead, step = stop, step * 2
    back, step = place, 64
    while back > 0:
        stop = max(0, back - step)
        other = np.flatnonzero(codes[stop:back] != codes[stop + distance : back + distance])
        if len(other):
            back = stop + int(other[-1]) + 1
            break
        back, step = stop, step * 2
    return back, ahead


def _runs_from(codes: np.ndarray, places: np.ndarray, distances: np.ndarray, scales: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one text, by start and then period.

    Every run is found at its smallest period, so of the distances that lead to one stretch the smallest is its period.
    """
    order = np.lexsort((places, distances))
    places, distances, scales = places[order], distances[order], scales[order]
    found: dict[tuple[int, int], int] = {}
    while len(places):
        d = int(distances[0])
        back, ahead = _extended(codes, int(places[0]), d)
        if ahead - back + d >= max(MIN_LENGTH, REPEATS * d):
            found.setdefault((back, ahead + d), d)
        # Seeds inside this stretch at a multiple of its period lead to no other run.
        inside = (places >= back) & (places + distances + scales <= ahead + d) & (distances % d == 0) & ((scales >= d) | (distances == d))
        inside[0] = True
        places, distances, scales = places[~inside], distances[~inside], scales[~inside]
    return sorted((start, stop - start, period) for (start, stop), period in found.items())


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as words: (start, length, period)."""
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(x) for x in texts], np.int64)
    codes = np.array([numbers.setdefault(w, len(numbers)) for words in texts for w in words], np.int64)
    places, distances, scales = _seeds(codes, sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    starts = np.cumsum(sizes) - sizes
    of = np.searchsorted(starts + sizes, places, side="right")
    order = np.argsort(of, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(order) else []:
        k = int(of[part[0]])
        own = codes[starts[k] : starts[k] + sizes[k]]
        out[k] = _runs_from(own, places[part] - starts[k], distances[part], scales[part])
    return out


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def _parts(texts: list[str | None], ids: list[int | None], rewrite: Callable | None) -> Iterator[list[list[bytes]]]:
    part, n = [], 0
    for text, doc_id in zip(texts, ids, strict=True):
        words = (text or "").encode().split()
        part.append(rewrite(doc_id, words) if rewrite else words)
        n += len(words)
        if n >= WORDS:
            yield part
            part, n = [], 0
    if part:
        yield part


_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = (),
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """One row for each document: its runs, and its text without what they repeat.

    Columns: ``doc_id``, ``runs`` (structs of ``start``, ``length`` and ``period`` in words, by start and then period),
    ``collapsed`` (the words that no run contains after its first period, joined by single spaces), and those of ``keep``
    in the struct ``row``, so that no name clashes. Words are what ASCII white space separates. ``rewrite`` changes the
    words of a document before they are searched.

    A null or empty text has no run and an empty ``collapsed``; repeated rows give repeated rows, an empty table none.
    A text of any length is searched whole, by one task: its work grows with its length times its logarithm, but beyond
    ``3 * 2 * LARGEST`` words also with the number of windows behind a block that a third of the text holds.
    """
    row = F.struct(*[F.col(c) for c in keep] or [F.lit(None).cast("string").alias("none")])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row.alias("row"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _parts(batch["text"].to_pylist(), batch["doc_id"].to_pylist(), rewrite):
                there, found = batch.slice(at, len(texts)), find_runs(texts)
                at += len(texts)
                kept = [b" ".join(without_repeats(words, runs)).decode() for words, runs in zip(texts, found, strict=True)]
                structs = [[dict(zip(("start", "length", "period"), x, strict=True)) for x in runs] for runs in found]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": there["doc_id"], "runs": pa.array(structs, _RUNS), "collapsed": pa.array(kept, pa.string()), "row": there["row"],
                })

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(search, f"doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string, row {kind}")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of all documents, repeated periodically from some place on; a document without id stays."""
    h, n = (crc32(str(doc_id).encode()) if doc_id is not None else 1), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the runs, and the run that repeats most often."""
    stronger = (
        "array_sort(runs, (a, b) -> CASE WHEN a.length * b.period <> b.length * a.period THEN IF(a.length * b.period > b.length * a.period, -1, 1)"
        " WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1) WHEN a.period <> b.period THEN IF(a.period < b.period, -1, 1) ELSE 0 END)"
    )
    best = F.get(F.expr(stronger), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def brute_force(words: list[bytes]) -> tuple[list[tuple[int, int, int]], list[bytes]]:
    """The runs of a text, by comparing all words at all distances, and what is left; for tests."""
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    for d in range(1, n // REPEATS + 1):
        i = 0
        while i + d < n:
            j = i
            while j + d < n and words[j] == words[j + d]:
                j += 1
            if j + d - i >= max(MIN_LENGTH, REPEATS * d) and j > i:
                found.setdefault((i, j + d), d)
            i = j + 1
    runs = sorted((start, stop - start, d) for (start, stop), d in found.items())
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return runs, [w for i, w in enumerate(words) if i not in gone]


def brute_force_row(doc_id: int, text: str | None) -> tuple:
    """The digests of one document, for tests."""
    runs, kept = brute_force(planted(doc_id, (text or "").encode().split()))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    strongest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *strongest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


#: CRC-32 bit by bit; then all pairs of equal words at each distance, as islands of consecutive places.
SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, string_split_regex(trim(regexp_replace(coalesce(text, ''), '[\x09-\x0D ]+', ' ', 'g')), ' ') AS w,
    list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c:
      list_transform(range(8), lambda b: CAST((ascii(c) >> CAST(b AS INTEGER)) & 1 AS UBIGINT))))),
      lambda s, b: xor(s >> 1, CASE WHEN (xor(s, b) & 1) = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)) AS c
  FROM documents
), counted AS (
  SELECT r, doc_id, CASE WHEN w = [''] THEN []::VARCHAR[] ELSE w END AS w, CASE WHEN w = [''] THEN 0 ELSE len(w) END AS n,
    CAST(xor(c, 4294967295::UBIGINT) AS BIGINT) AS h
  FROM words
), places AS (
  SELECT *, h // 10 AS g, (h // 10) % greatest(n, 1) AS a FROM counted
), docs AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_concat(w[1 : a], list_transform(range(a, n), lambda i: w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1])) ELSE w END AS w
  FROM places
), tokens AS (
  SELECT r, n, i, w[i + 1] AS t FROM docs, unnest(range(0, n)) AS x(i) WHERE n >= 24
), pairs AS (
  SELECT x.r, y.i - x.i AS d, x.i, x.i - row_number() OVER (PARTITION BY x.r, y.i - x.i ORDER BY x.i) AS island
  FROM tokens x JOIN tokens y ON x.r = y.r AND x.t = y.t AND y.i > x.i AND y.i - x.i <= x.n // 3
), stretches AS (
  SELECT r, d, min(i) AS s, max(i) + 1 + d AS e FROM pairs GROUP BY r, d, island HAVING count(*) + d >= greatest(24, 3 * d)
), runs AS (
  SELECT r, s, e - s AS len, min(d) AS q FROM stretches GROUP BY r, s, e
), lines AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY r
), best AS (
  SELECT r, s, len, q FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST(len AS DOUBLE) / q DESC, s, q) = 1
), gone AS (
  SELECT r, list(DISTINCT i) AS i FROM runs, unnest(range(s + q, s + len)) AS x(i) GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS "start", CAST(len AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
  CAST(1000 * len // q AS BIGINT) AS exponent_milli, sha256(coalesce(t, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN gone.i IS NULL THEN w ELSE [w[k + 1] FOR k IN range(0, n) IF NOT list_contains(gone.i, k)] END, ' ')) AS collapsed_sha256
FROM docs LEFT JOIN lines USING (r) LEFT JOIN best USING (r) LEFT JOIN gone USING (r)
"""
