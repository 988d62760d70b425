"""op9: every segmentation with its ids, each decoded from all of them, in texts of any shape."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np

from secflow.llm import pieces, queries
from tests.llm.test_text import frame

SMALL = "/root/testdata/sf0.001"


def test_the_query_gives_the_ids_of_all_segmentations_and_the_decoded_text(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op9_pieces(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    model = pieces.model()
    for row in rows:
        text = texts[row.doc_id]
        want = model.encode(text, 4)
        assert [(x.score, x.ids) for x in row.segmentations] == want and row.decoded == text
        for x in row.segmentations:
            assert (x.n_pieces, x.ids_crc32, x.round_trip) == (len(x.ids), zlib.crc32(np.array(x.ids, "<u4").tobytes()), True)
            assert model.decode(x.ids) == text


def test_decoding_reads_all_ids():
    model = pieces.model()
    ids = [np.array(x, np.int32) for _, x in model.encode("the cat sat é漢x", 4)]
    assert model.spelled([*ids, np.zeros(0, np.int32)]) == ["the cat sat é漢x".encode()] * 4 + [b""]
    for k in range(len(ids[0])):
        assert model.spelled([np.delete(ids[0], k)]) != model.spelled(ids[:1])


def test_long_units_keep_few_partial_segmentations():
    model, r = pieces.model(), random.Random(19)
    unit = "▁" + "".join(r.choices("abcdethn", k=4000))
    tracemalloc.start()
    found = model.nbest(unit, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len({x for _, x in found}) == 4 and peak < 8 << 20
    assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)


def test_large_ids_beside_null_ones(spark):
    docs = spark.createDataFrame([(2**53 + 1, "the cat"), (None, "sat")], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in pieces.encode_documents(docs).collect()} == {2**53 + 1, None}


def test_units_looked_up_together_are_those_of_each_text(monkeypatch):
    model, r = pieces.model(), random.Random(21)
    texts = ["", " ", "  ", " a", "a ", "a  b", "▁x ▁", "\0 \0", "a\tb c\n d", "=" * 90 + " x", "é漢 \U0001f600x"]
    texts += ["".join(r.choice(["a", "b", " ", "  ", "▁", "\n", "漢"]) for _ in range(r.randint(0, 40))) for _ in range(100)]
    for remembered in (500_000, 30):
        monkeypatch.setattr(pieces, "REMEMBERED", remembered)
        model.forget()
        for text, (units, *best) in zip(texts, model.best_of(texts), strict=True):
            assert list(units) == model.units(text)
            assert [(score, ids.tolist()) for score, ids in model.segmentations(units, *best, 4)] == model.encode(text, 4)
    model.forget()
    assert [list(units) for units, *_ in model.best_of(["", ""])] == [[], []]
