"""Stupid-backoff scores from n-gram counts of the whole corpus.

Words are maximal runs without white space, A to Z in lower case. A word is scored after the two before it: by the
share of the trigram among all occurrences of its first two words; if no other document has the trigram, 0.4 times the
share of the bigram; else 0.4 again times the word's share of all words. Counts leave the scored document out, so that
a text is not its own evidence. A word that no other document has counts as half an occurrence.

The counts are tables partitioned by hash and joined to the n-grams of the documents, in packed form: documents travel
once, into blocks; a block counts its n-grams first and sends each distinct one once, as a 64-bit name with its count,
in an ascending list for each hash range; the range adds up equal names and answers with the totals in the same order.
An n-gram that a third of all documents share costs one name for a block. What is gathered is the whole corpus' counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import mix, pack_keys, unpack_keys

BACKOFF = 0.4
#: Bytes of text that a block should hold.
BLOCK_BYTES = 8 << 20
_STEP = 1 << 20
_BASE = 0xD1342543DE82EF95
_LETTERS = np.random.default_rng(6).integers(0, 2**64, 256, dtype=np.uint64)
_ORDERS = np.random.default_rng(66).integers(0, 2**63, (3, 3), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The name under which a block sends its number of words.
_ALL = np.uint64(0)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWER, _INVERSE = _powers(_BASE, _STEP + 1), _powers(pow(_BASE, -1, 2**64), _STEP + 1)


def _words_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start, and their 64-bit names."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    space = np.concatenate([[True], _SPACE[data], [True]])
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    out = np.zeros(len(starts), np.uint64)
    low = 0
    while low < len(starts):  # as many words at a time as a step holds; a longer word is hashed in parts
        base = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, base + _STEP, side="right")))
        if ends[low] - base > _STEP:
            name = np.uint64(0)
            for at in range(base, ends[low], _STEP):
                part = data[at : min(at + _STEP, ends[low])]
                name = mix(np.array([name ^ np.sum(_LETTERS[part] * _POWER[: len(part)], dtype=np.uint64)]))[0]
            out[low] = name
            low += 1
            continue
        part = data[base : ends[high - 1]]
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LETTERS[part] * _POWER[: len(part)], out=prefix[1:])
        s, e = starts[low:high] - base, ends[low:high] - base
        out[low:high] = (prefix[e] - prefix[s]) * _INVERSE[s]
        low = high
    return starts, mix(out) if len(out) else out


class Grams:
    """The 1- to 3-grams of the texts of a block, document by document."""

    def __init__(self, texts: list[bytes]):
        words: list[np.ndarray] = []
        held: list[bytes] = []
        sizes = []

        def flush() -> None:
            # Short texts are hashed together, each in a line of its own.
            if held:
                starts, names = _words_of(b"\n".join(held))
                words.append(names)
                lines = np.cumsum([0, *[len(x) + 1 for x in held]])
                sizes.append(np.diff(np.searchsorted(starts, lines)))
                held.clear()

        total = 0
        for text in texts:
            held.append(text)
            total += len(text)
            if total >= _STEP // 2:
                flush()
                total = 0
        flush()
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes).astype(np.int64) if sizes else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        at = np.arange(len(self.words)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.ends = [np.flatnonzero(at >= n) for n in range(3)]
        self.names = [self._named(n) for n in range(3)]

    def _named(self, n: int) -> np.ndarray:
        """Names of the (n + 1)-grams that end at each of ``ends[n]``."""
        ends = self.ends[n]
        total = np.zeros(len(ends), np.uint64)
        for back in range(n + 1):
            total += self.words[ends - back] * _ORDERS[n, back]
        return mix(total) | np.uint64(1)  # never the name of all words

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct names of the block, ascending, and their counts."""
        keys, counts = np.unique(np.concatenate(self.names), return_counts=True)
        return np.append(_ALL, keys), np.append(len(self.words), counts)

    def score(self, keys: np.ndarray, totals: np.ndarray) -> pd.DataFrame:
        """For each document, from the totals of the names in ``keys``."""
        docs = len(self.sizes)
        others = []  # for each order, counts outside the document at each end
        for n in range(3):
            name, doc = self.names[n], self.doc[self.ends[n]]
            pair, back = _pairs(name, doc)
            own = np.bincount(back, minlength=pair)
            others.append(totals[np.searchsorted(keys, name)] - own[back])
        words = (totals[0] - self.sizes)[self.doc].astype(np.float64)
        uni = np.maximum(others[0], 0.5) / np.maximum(words, 1.0)
        level = np.where(others[0] > 0, 1, 0)
        share = uni.copy()
        share[self.ends[1]] *= BACKOFF
        share[self.ends[2]] *= BACKOFF
        place = np.zeros(len(self.words), np.int64)
        for n in (1, 2):
            ends = self.ends[n]
            place[:] = -1
            place[self.ends[n - 1]] = np.arange(len(self.ends[n - 1]))
            context = others[n - 1][place[ends - 1]]
            seen = others[n] > 0
            value = others[n][seen] / context[seen]
            at = ends[seen]
            # A bigram at the third word or later stands below a trigram that was not found.
            later = np.zeros(len(self.words), bool)
            later[self.ends[2]] = n == 1
            share[at] = np.where(later[at], BACKOFF * value, value)
            level[at] = n + 1
        logs = np.log(share)
        out = {"n_words": self.sizes, "log_prob": np.bincount(self.doc, logs, docs).astype(np.float64)}
        for n, name in enumerate(("n_unseen", "n_unigram", "n_bigram", "n_trigram")):
            out[name] = np.bincount(self.doc[level == n], minlength=docs)
        return pd.DataFrame(out)


def _pairs(name: np.ndarray, doc: np.ndarray) -> tuple[int, np.ndarray]:
    """How many distinct (name, doc) there are, and a number for the pair of each row."""
    order = np.lexsort((name, doc))
    change = np.ones(len(order), bool)
    change[1:] = (name[order[1:]] != name[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(change) - 1
    return int(change.sum()), back


def _pack_counts(counts: np.ndarray) -> bytes:
    counts = counts.astype("<u8")
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << (8 * w))
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(counts.astype(f"<u{width}").tobytes())


def _unpack_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), f"<u{packed[0]}").astype(np.int64)


def _cuts(keys: np.ndarray, owners: int) -> np.ndarray:
    """Where each hash range begins among ascending keys."""
    return np.searchsorted(((keys >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32), np.arange(owners + 1))


def _texts(group: pa.Table) -> list[bytes]:
    open_up = zstandard.ZstdDecompressor().decompress
    return [open_up(x) if x else b"" for x in group["_text"].to_pylist()]


_MESSAGE = pa.schema([("owner", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _add_up(group: pa.Table) -> pa.Table:
    """Totals of the names of one hash range; one answer for each block."""
    lists = [unpack_keys(x) for x in group["keys"].to_pylist()]
    counts = np.concatenate([_unpack_counts(x) for x in group["counts"].to_pylist()])
    _, back = np.unique(np.concatenate(lists), return_inverse=True)
    totals = np.bincount(back, counts).astype(np.int64)[back]
    parts = np.split(totals, np.cumsum([len(x) for x in lists])[:-1])
    return pa.table({"block": group["block"], "owner": group["owner"], "totals": pa.array([_pack_counts(x) for x in parts], pa.binary())})


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, log_prob (natural, of all words), and how many words were scored by each order.

    ``n_trigram``, ``n_bigram``, ``n_unigram`` and ``n_unseen`` add up to ``n_words``. Null and empty texts have no
    words and the log_prob 0. Equal rows are documents of their own and count for each other. An empty table gives
    none. Only the id and the text are read. A block is one task; a text is in one block.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))

    @F.pandas_udf("binary")
    def squeezed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shrink = zstandard.ZstdCompressor(level=1).compress
        for texts in batches:
            yield texts.map(lambda x: shrink(x.encode("utf-8", "surrogatepass")) if x else None)

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), squeezed(F.col(text_col)).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    texts = rows.select(F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int").alias("block"), "_id", "_text")
    by_block = texts.groupBy("block")

    def count(group: pa.Table) -> pa.Table:
        keys, counts = Grams(_texts(group)).keys()
        cuts = _cuts(keys, blocks)
        there = [(o, i, j) for o, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if i < j]
        number = group["block"][0].as_py()
        return pa.Table.from_arrays([
            pa.array([o for o, _, _ in there], pa.int32()), pa.array([number] * len(there), pa.int32()),
            pa.array([pack_keys(keys[i:j]) for _, i, j in there], pa.binary()), pa.array([_pack_counts(counts[i:j]) for _, i, j in there], pa.binary()),
        ], schema=_MESSAGE)

    def score(group: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(_texts(group))
        keys, _ = grams.keys()
        cuts = _cuts(keys, blocks)
        totals = np.zeros(len(keys), np.int64)
        for owner, packed in zip(answers["owner"].to_pylist(), answers["totals"].to_pylist(), strict=True):
            totals[cuts[owner] : cuts[owner + 1]] = _unpack_counts(packed)
        scored = pa.Table.from_pandas(grams.score(keys, totals), preserve_index=False)
        return scored.add_column(0, "doc_id", group["_id"].combine_chunks())

    sent = by_block.applyInArrow(count, "owner int, block int, keys binary, counts binary")
    answers = sent.groupBy("owner").applyInArrow(_add_up, "block int, owner int, totals binary")
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id long, n_words long, log_prob double, n_unseen long, n_unigram long, n_bigram long, n_trigram long"
    )


#: The same rows in DuckDB's SQL.
SQL = r"""
with words as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i
  from (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents)),
grams as (
  select doc_id, i, word as a, lag(word) over (partition by doc_id order by i) as b, lag(word, 2) over (partition by doc_id order by i) as c from words),
uni as (select *, count(*) over (partition by a) - count(*) over (partition by a, doc_id) as u, count(*) over () - count(*) over (partition by doc_id) as n from grams),
con as (select *, lag(u) over (partition by doc_id order by i) as ub,
  case when b is not null then count(*) over (partition by b, a) - count(*) over (partition by b, a, doc_id) end as bi,
  case when c is not null then count(*) over (partition by c, b, a) - count(*) over (partition by c, b, a, doc_id) end as tri from uni),
all3 as (select *, lag(bi) over (partition by doc_id order by i) as bb from con),
scored as (select doc_id,
  case when tri > 0 then 3 when bi > 0 then 2 when u > 0 then 1 else 0 end as level,
  case when tri > 0 then tri / bb
       when bi > 0 then bi / ub * case when c is null then 1 else 0.4 end
       else greatest(u, 0.5) / greatest(n, 1) * case when b is null then 1 when c is null then 0.4 else 0.4 * 0.4 end end as s from all3)
select d.doc_id, count(s) as n_words, coalesce(round(sum(ln(s)), 4), 0) as log_prob,
  count(*) filter (level = 0) as n_unseen, count(*) filter (level = 1) as n_unigram, count(*) filter (level = 2) as n_bigram, count(*) filter (level = 3) as n_trigram
from documents d left join scored using (doc_id) group by d.doc_id
"""
