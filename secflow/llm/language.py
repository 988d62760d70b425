"""Language identification by multilingual mixture inference.

Each language has a likelihood for byte trigrams, counted over all training documents. A document is taken as a
mixture: expectation-maximisation estimates the proportion of each language from the likelihoods of its trigrams, and
the set of languages is the one with the best penalised likelihood. The prediction is its largest member.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trigrams are hashed into so many cells; the model has a row of one float for each cell and language.
CELLS = 1 << 16
#: Units of the likelihood: trigrams overlap, so that three of them count as one observation.
OVERLAP = 3.0
ROUNDS = 12
_LETTER = re.compile(r"[^\W\d_]")
#: Digits, signs and white space of ASCII are all one separator.
_PLAIN = np.array([c if chr(c).isalpha() or c >= 128 else 32 for c in range(256)], np.uint32)


def trigrams(text: str) -> np.ndarray:
    """The cells of all byte trigrams of a text in lower case, with a separator at both ends."""
    data = _PLAIN[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    grams = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    return (grams * np.uint32(2654435761)) >> np.uint32(16)


def count_trigrams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, cell, n) over all rows with a text and a language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if lang not in totals:
                    totals[lang] = np.zeros(CELLS, np.int64)
                cells, n = np.unique(trigrams(text), return_counts=True)
                totals[lang][cells] += n
        for lang, total in totals.items():
            cells = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "cell": cells, "n": total[cells]})

    there = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    counted = there.mapInPandas(count, "lang string, cell int, n long")
    return counted.groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages and the likelihood of each cell in each language (CELLS x languages).

    Counts cover all rows that have a text and a language. What reaches the driver is at most ``CELLS`` numbers for
    each language, whatever the size of the corpus.
    """
    counts = count_trigrams(docs, text_col, lang_col).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((CELLS, len(langs)))
    table[counts["cell"], np.searchsorted(langs, counts["lang"])] = counts["n"]
    table += 0.5
    return langs, (table / table.sum(axis=0)).astype(np.float32)


def mixture(weights: np.ndarray, likely: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions of the languages and the log likelihood, by expectation-maximisation."""
    n, k = weights.sum(), likely.shape[1]
    shares = np.full(k, 1 / k, np.float32)
    for _ in range(rounds):
        mixed = likely @ shares
        new = shares * ((weights / mixed) @ likely) / n
        new /= new.sum()
        done = np.abs(new - shares).max() < 1e-3
        shares = new
        if done:
            break
    return shares, float(weights @ np.log(np.maximum(likely @ shares, 1e-30)))


def infer(text: str, model: np.ndarray) -> tuple[list[int], float]:
    """The language set of a text, largest share first, and the largest share of all languages."""
    cells, weights = np.unique(trigrams(text), return_counts=True)
    weights = weights.astype(np.float32)
    likely = model[cells]
    shares, _ = mixture(weights, likely)
    order = np.argsort(-shares, kind="stable")
    price = 0.5 * np.log(weights.sum() + 1)
    chosen, best = [int(order[0])], float(weights @ np.log(likely[:, order[0]])) / OVERLAP
    for k in range(2, len(order) + 1):
        if shares[order[k - 1]] < 0.02:
            break
        _, found = mixture(weights, likely[:, order[:k]])
        if found / OVERLAP - price * (k - 1) <= best:
            break
        chosen, best = [int(x) for x in order[:k]], found / OVERLAP - price * (k - 1)
    return chosen, float(min(1.0, shares[order[0]]))


def identify(text: Column, langs: list[str], model: np.ndarray, spark) -> Column:
    """A struct of ``lang_pred``, ``score`` and ``languages`` (the whole set, joined by commas).

    Null texts and texts without a letter are ``und`` with score 0 and no languages; so is every text if no language
    was learned. Whole texts are read, of any length. Equal texts get equal results; ties go to the language that
    sorts first.
    """
    shared = spark.sparkContext.broadcast((langs, model))  # CELLS floats for each language

    @F.pandas_udf("lang_pred string, score double, languages string")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, table = shared.value
        for texts in batches:
            out = []
            for x in texts:
                if x is None or not names or not _LETTER.search(x):
                    out.append(("und", 0.0, ""))
                    continue
                chosen, score = infer(x, table)
                out.append((names[chosen[0]], score, ",".join(names[i] for i in chosen)))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "languages"])

    return predict(text)


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang and any others) with ``held_out`` and a struct ``language`` behind them.

    Learned from the rows whose crc32(doc_id as text) mod 5 is not 0; those of null id, text or language train
    nothing either. All rows get a prediction, from their text alone. Columns of ``docs`` that have one of the two
    names are replaced.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    langs, model = train(docs.filter(fold != 0))
    told = identify(F.col("text"), langs, model, docs.sparkSession)
    return docs.withColumns({"held_out": F.coalesce(fold == 0, F.lit(False)), "language": told})
