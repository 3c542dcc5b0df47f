"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of all labelled texts: each task sums its texts into one
table of languages by hash buckets and sends its filled buckets, which Spark adds up.
The log-probability matrix is small (languages times buckets, checked against a bound)
and is broadcast. Scoring looks every n-gram of a text up in it and adds the rows.

The predicted language has the largest plain posterior. The score is its posterior with
the evidence of a text counted as that of ``EVIDENCE`` n-grams at most, since n-grams of
one text depend on each other and the plain posterior of a long text is always 1.

Defined results: null or empty texts and texts without a letter are ``und`` with score
0; ties go to the first language by code point; very long texts are read whole in
slices that overlap by an n-gram; rows without a language do not train; with no
training rows everything is ``und``; more than ``MOST_CELLS // BUCKETS`` languages (1,024) are
an error, as the matrix would not be small; only the named columns are read. A text's
n-grams are its own, with a blank before and after it, whatever texts stand beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyfacts.llm.common import chunks, in_frames
from dailyfacts.llm.hashing import mix

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
#: Most cells of the matrix: languages times buckets.
MOST_CELLS = 1 << 25
SMOOTHING = 0.5
EVIDENCE = 50
UNKNOWN = "und"
#: Characters that are looked at in one go.
SLICE = 1 << 20


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a blank before and after each, and where each begins."""
    padded = [f" {t.lower()} " for t in texts]
    data = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    begins = np.concatenate([[0], np.cumsum([len(p) for p in padded])]).astype(np.int64)
    blank = (data <= 32) | ((data >= 48) & (data <= 57))
    return np.where(blank, np.uint32(32), data), begins


def _inside(begins: np.ndarray, order: int, n: int) -> np.ndarray:
    """Whether the n-gram that starts at each of ``n`` places ends in the same text."""
    inside = np.ones(n, dtype=bool)
    for back in range(1, order):
        at = begins[1:] - back
        inside[at[at < n]] = False
    return inside


def _grams(points: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place."""
    x = points.astype(np.uint64)
    n = len(x) - order + 1
    value = np.full(max(n, 0), order, dtype=np.uint64)
    for i in range(order):
        value = value * np.uint64(1 << 21) + x[i : i + n]
    return (mix(value) & np.uint64(buckets - 1)).astype(np.int64)


def _slices(rows: Iterator[tuple], text: int) -> Iterator[list[tuple]]:
    return chunks(rows, lambda row: len(row[text]) + 2, SLICE)


def _count(languages: list[str], buckets: int):
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((len(languages), buckets), dtype=np.int64)
        rows = ((lang, text) for b in batches for lang, text in zip(b["lang"], b["text"], strict=True))
        for part in _slices(rows, 1):
            points, begins = _code_points([text for _, text in part])
            owner = np.repeat([place[lang] for lang, _ in part], np.diff(begins))
            for order in ORDERS:
                found = _grams(points, order, buckets)
                cell = (owner[: len(found)] * buckets + found)[_inside(begins, order, len(found))]
                table += np.bincount(cell, minlength=table.size).reshape(table.shape)
        lang, bucket = np.nonzero(table)
        yield pd.DataFrame({"lang": lang, "bucket": bucket, "n": table[lang, bucket]})

    return count


class LanguageModel:
    """Languages in order, and their log probabilities by bucket."""

    def __init__(self, languages: list[str], log_likelihood: np.ndarray, log_prior: np.ndarray):
        self.languages = languages
        self.log_likelihood = log_likelihood
        self.log_prior = log_prior


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> LanguageModel:
    """A model of all rows that have a text and a language."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text is not null and lang is not null"
    )
    most = MOST_CELLS // buckets
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} languages: the matrix would not be small")
    languages = [row["lang"] for row in found]
    counts = np.zeros((len(languages), buckets))
    if languages:
        sums = (
            rows.mapInPandas(_count(languages, buckets), "lang int, bucket int, n long")
            .groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n"))
            .toPandas()
        )
        counts[sums["lang"], sums["bucket"]] = sums["n"]
    smooth = counts + SMOOTHING
    likelihood = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    docs = np.array([row["n"] for row in found], dtype=float)
    return LanguageModel(languages, likelihood.T.astype(np.float32).copy(), np.log(docs / max(docs.sum(), 1)))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _score(model_cast):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        languages, matrix, prior = model_cast.value
        names = np.array([*languages, UNKNOWN], dtype=object)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            best = np.full(len(texts), len(languages))
            posterior = np.zeros(len(texts))
            known = [(i, t) for i, t in enumerate(texts) if languages and _has_letter(t)]
            for part in _slices(iter(known), 1):
                points, begins = _code_points([t for _, t in part])
                total = np.zeros((len(part), len(languages)))
                for order in ORDERS:
                    found = _grams(points, order, len(matrix))
                    own = _inside(begins, order, len(found))
                    # One slice of places at a time, so that a very long text needs no more memory.
                    for at in range(0, len(found), SLICE):
                        values = matrix[found[at : at + SLICE]].astype(np.float64)
                        values[~own[at : at + SLICE]] = 0
                        inside = np.clip(begins, at, at + len(values)) - at
                        filled = np.flatnonzero(np.diff(inside))
                        total[filled] += np.add.reduceat(values, inside[filled], axis=0)
                n = np.maximum(np.diff(begins) * len(ORDERS), 1)[:, None]
                first = (total + prior).argmax(axis=1)
                log = total * np.minimum(1, EVIDENCE / n) + prior
                log -= log.max(axis=1, keepdims=True)
                share = np.exp(log)
                share /= share.sum(axis=1, keepdims=True)
                at = np.array([i for i, _ in part])
                best[at] = first
                posterior[at] = share[np.arange(len(part)), first]
            yield pd.DataFrame({"key": batch["key"], "lang_pred": names[best], "score": posterior})

    return score


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for every row."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    parts = (model.languages, model.log_likelihood, model.log_prior)
    cast = docs.sparkSession.sparkContext.broadcast(parts)
    kind = dict(rows.dtypes)["key"]
    scored = in_frames(rows, _score(cast), f"key {kind}, lang_pred string, score double")
    return scored.withColumnRenamed("key", key)
