"""Alignment, periodic runs and decontamination against brute force, on small tables with awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from secflow.llm import alignment, decontaminate, periodic

LONG = "word " * 30_000


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def texts(n, seed):
    """Texts of words in several scripts, with copies, nulls, empty and special strings."""
    r = random.Random(seed)
    words = ["the", "The", " a", "néé", "x1", "日本語", "\n", "</s>", "<|endoftext|>", "▁", "b\x00c", "\t\t", "eels", "q'r", "🙂", "."]
    words += ["".join(r.choice("abcdeinost") for _ in range(r.randint(1, 9))) for _ in range(40)]
    out = [None, "", " ", "a", "▁a", "end <|endoftext|> next", "<s> </s>"]
    while len(out) < n:
        out.append(r.choice(out) if r.random() < 0.2 else " ".join(r.choice(words) for _ in range(r.randint(1, 60))))
    return out


# Alignment

def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize(("records", "fan_in"), [(4 << 20, 64), (50, 3)])
def test_alignment(spark, monkeypatch, records, fan_in):
    monkeypatch.setattr(alignment, "RECORDS", records)  # forked workers have it too
    rows = [(i if i % 11 else None, x) for i, x in enumerate(texts(120, 3))] + [(5, "a"), (5, "a")]
    found = alignment.align_documents(frame(spark, rows).repartition(9), radix=5, fan_in=fan_in)
    assert rows_of(found, ALIGNED) == sorted(alignment.brute_force(rows), key=repr)


def test_alignment_of_tokens_without_bytes():
    """A token without bytes ends where the one before it ends; both are linked."""
    sides = [(np.array([0, 0]), np.array([0, 1])), (np.array([0, 0]), np.array([1, 0]))]
    group_a, group_b, from_a, from_b = alignment.align(sides, np.array([1]), np.array([2, 0]))
    assert sorted(zip(from_a.tolist(), from_b.tolist(), strict=True)) == [(1, 0), (1, 1), (3, 3)]
    assert group_a.tolist() == [0, 0, 1, 1] and group_b.tolist() == [0, 0, 1, 1]


def test_merge_of_runs(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 3)
    r = random.Random(4)
    runs = [sorted(r.sample(range(60), r.randint(0, 40))) for _ in range(7)]
    counts = [[r.randint(1, 9) for _ in x] for x in runs]
    wanted: dict[int, int] = {}
    for x, c in zip(runs, counts, strict=True):
        for pair, n in zip(x, c, strict=True):
            wanted[pair] = wanted.get(pair, 0) + n
    merged = [pair for x, c in alignment.merge_runs([alignment._frames(np.array(x, np.int64), np.array(c, np.int64)) for x, c in zip(runs, counts, strict=True)])
              for pair in zip(x.tolist(), c.tolist(), strict=True)]
    assert merged == sorted(wanted.items())


def test_alignment_of_a_long_text_and_an_empty_table(spark):
    rows = [(1, LONG), (2, "word word"), (3, "x" * 200_000)]
    odd = frame(spark, rows).select("doc_id", "text", F.lit("a").alias("node"), F.lit(1).alias("radix"), F.lit("b").alias("n_a"))
    found = {r["doc_id"]: r for r in alignment.align_documents(odd).collect()}
    assert found[1]["n_links"] >= 30_000 and found[2]["n_best"] == 2 and found[3]["n_a"] > 0
    assert alignment.align_documents(frame(spark, [])).count() == 0


# Periodic runs

def words_with_runs(seed, n=80):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        size, kinds = r.choice([0, 5, 23, 24, 30, 80, 200, 900]), r.choice([1, 2, 3, 50, 1000])
        words = [b"%d" % r.randrange(kinds) for _ in range(size)]
        for _ in range(r.randint(0, 3) if size > 9 else 0):
            a, q = r.randrange(size), r.randint(1, max(1, min(size // 4, r.choice([3, 9, 20, 200]))))
            for i in range(a + q, min(size, a + r.randint(q, 8 * q + 20))):
                words[i] = words[i - q]
        out.append(words)
    return out


@pytest.mark.parametrize("largest", [8, 16, 8192])
def test_runs(monkeypatch, largest):
    monkeypatch.setattr(periodic, "LARGEST", largest)
    docs = words_with_runs(2)
    for words, runs in zip(docs, periodic.find_runs(docs), strict=True):
        wanted, left = periodic.brute_force(words)
        assert (runs, periodic.without_repeats(words, runs)) == (wanted, left)


@pytest.mark.parametrize("m", [8, 64, 128, 256, 2048])
def test_transforms_are_exact(m):
    r = np.random.default_rng(m)
    t = periodic.transform(m)
    block, window = (r.integers(-periodic.PRIME // 2, periodic.PRIME // 2, n) for n in (m, 2 * m))
    spectra = t.forward(np.stack([block, window[:m], window[m:]]).astype(float))
    found = t.correlations(spectra[:1], spectra[1:2], spectra[2:])[0].astype(int)
    for d in range(0, m, max(1, m // 16)):
        assert (int(found[d]) - sum(int(a) * int(b) for a, b in zip(block, window[d : d + m], strict=True))) % periodic.PRIME == 0


def test_periodic_rows(spark):
    docs = [(i, None if i % 17 == 0 else b" ".join(w).decode()) for i, w in enumerate(words_with_runs(5, 120))]
    docs += [(500, LONG), (500, LONG), (501, " a\x0bb\x0cé " * 30), (502, " \n\t")]
    found = periodic.digest(periodic.periodic_runs(frame(spark, docs).withColumn("runs", F.lit("a")).repartition(3), keep=["runs"], rewrite=periodic.planted))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    wanted = [periodic.brute_force_row(i, x) for i, x in docs if x != LONG]
    got = rows_of(found, columns)
    assert [r for r in got if r[0] != 500] == sorted(wanted, key=repr)
    (one, two) = (r for r in got if r[0] == 500)
    assert one == two and one[1] == 1
    assert periodic.periodic_runs(frame(spark, [])).count() == 0
    nothing = periodic.periodic_runs(frame(spark, [(None, "a b"), (None, None)]), rewrite=periodic.planted).collect()
    assert sorted(r["collapsed"] for r in nothing) == ["", "a b"]


# Decontamination

ITEMS = [("b", "one two three four five six seven eight nine ten eleven"), ("a", "short  ITEM"), ("c", None), ("d", "..."), (None, "Two  three, four five six seven eight nine ten eleven"), ("b", "é 日本 x")]
FOUND = [
    (1, "x one Two three-four five six seven eight nine TEN y"), (2, "a short item, short item"), (3, None), (4, ""), (5, "one two three four five six seven eight nine"),
    (6, "é 日本 X 1"), (7, LONG + "short item"), (None, "two three four five six seven eight nine ten eleven"), (2, "a short item, short item"),
]


@pytest.mark.parametrize("set_bytes", [4 << 20, 60])
def test_hit_words(spark, set_bytes):
    docs = frame(spark, FOUND).withColumn("items", F.lit("a")).withColumn("n_hit", F.lit("b"))
    items = frame(spark, ITEMS, "item_id string, text string")
    found = decontaminate.find(docs, items, keep=["items"], set_bytes=set_bytes)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()), key=repr)
    assert got == sorted(decontaminate.brute_force(FOUND, [(a or "", b) for a, b in ITEMS]), key=repr)
    digests = {r["doc_id"]: r for r in decontaminate.digest(found).collect()}
    assert digests[1]["n_items"] == 1 and digests[1]["contaminated"] and not digests[5]["contaminated"]


def test_what_was_hit_goes(spark):
    docs, items = frame(spark, FOUND), frame(spark, ITEMS, "item_id string, text string")
    kept = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert kept[1] == "x  y" and kept[2] == "a " and kept[3] is None and kept[4] == "" and kept[5] == FOUND[4][1] and kept[6] == " 1"
    assert {r["doc_id"] for r in decontaminate.decontaminate(docs, items, whole=True).collect()} == {3, 4, 5}


def test_without_benchmark_or_documents(spark):
    docs, none = frame(spark, FOUND), frame(spark, [], "item_id string, text string")
    assert decontaminate.find(docs, none).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.find(frame(spark, []), frame(spark, ITEMS, "item_id string, text string")).count() == 0


def test_random_texts_against_brute_force(spark):
    r = random.Random(9)
    words = ["a", "b", "C", "d1", "é"]
    line = lambda n: "".join(r.choice(words) + r.choice([" ", ", ", "-"]) for _ in range(n))
    items = [(str(k), line(r.randint(0, 14))) for k in range(12)]
    docs = [(k, line(r.randint(0, 60)) + (r.choice(items)[1] if k % 2 else "")) for k in range(80)]
    found = decontaminate.find(frame(spark, docs).repartition(4), frame(spark, items, "item_id string, text string"), window=4)
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect())
    assert got == sorted(decontaminate.brute_force(docs, items, window=4))
