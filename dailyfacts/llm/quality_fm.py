"""Quality classifier: a factorisation machine over a whole text.

Features of a text are its words by hash bucket, structure statistics and metadata.
The machine adds a weight for each feature and, for each pair of features, the product
of two low-rank vectors; the sum over pairs is half of (the square of the sum minus the
sum of the squares), which takes time linear in the number of features.

It is fitted on a bounded sample of the labelled rows (``SAMPLE``, the rows with the
smallest hashes of their keys), by Adam on the logistic loss; everything else covers
all rows. Fitting is numpy on the driver over at most ``SAMPLE`` rows of at most
``BUCKETS`` features. Both classes count alike, so that a rare one is learned too.

Defined results: a null or empty text has zero statistics and gets a score like any
other; very long texts are read whole; ties of the sample break by text; rows without a
label do not train; with no labelled row every score is 0.5, with one class only it is
that class; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyfacts.llm.common import chunks, in_frames, process_cache
from dailyfacts.llm.hashing import word_hashes

#: Labelled rows that are fitted on, at most.
SAMPLE = 6000
BUCKETS = 1 << 12
RANK = 8
EPOCHS = 12
BATCH = 64
RATE = 0.02
DECAY = 1e-4
#: Bytes of text that are looked at in one go.
SLICE = 1 << 21

STATISTICS = (
    "log_words", "mean_word", "distinct_words", "adjacent_repeats", "repeated_windows", "symbols",
    "capitals", "digits", "stops", "marks", "lines", "repeated_lines", "long_words", "one_byte_words",
)
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>{}[]\\^~=+_@", dtype=np.uint8))
_MARKS = np.isin(np.arange(256), np.frombuffer(b"!?;:\"'()", dtype=np.uint8))
_STOPS = np.isin(np.arange(256), np.frombuffer(b".,", dtype=np.uint8))


def _statistics(texts: list[str], hashes: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A row of numbers between 0 and about 1 for each text."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        h, size = hashes[begins[i] : begins[i + 1]], lengths[begins[i] : begins[i + 1]]
        n, b = max(len(h), 1), max(len(raw), 1)
        counts = np.bincount(raw, minlength=256)
        windows = h[:-2] ^ (h[1:-1] << np.uint64(1)) ^ (h[2:] << np.uint64(2)) if len(h) > 2 else h[:0]
        lines = [x for x in text.split("\n") if x.strip()]
        upper = sum(map(str.isupper, text)) if not text.isascii() else counts[65:91].sum()
        out[i] = (
            np.log1p(len(h)) / 10,
            size.mean() / 20 if len(h) else 0,
            len(np.unique(h)) / n,
            (h[1:] == h[:-1]).sum() / n,
            1 - len(np.unique(windows)) / max(len(windows), 1) if len(windows) else 0,
            counts[_SYMBOLS].sum() / b,
            upper / b,
            counts[48:58].sum() / b,
            counts[_STOPS].sum() / n,
            counts[_MARKS].sum() / n,
            len(lines) / n,
            1 - len(set(lines)) / max(len(lines), 1) if lines else 0,
            (size > 20).mean() if len(h) else 0,
            (size == 1).mean() if len(h) else 0,
        )
    return out


def _features(texts: list[str | None], metadata: np.ndarray, buckets: int):
    """For each text its feature numbers and values; words first, then statistics, then metadata.

    Words get the root of their share, so that their squares add up to one.
    """
    given = [t if isinstance(t, str) else "" for t in texts]
    hashes, begins, lengths = word_hashes(given, lower=False)
    dense = np.concatenate([_statistics(given, hashes, begins, lengths), metadata], axis=1)
    slots = (hashes & np.uint64(buckets - 1)).astype(np.int64)
    fixed = np.arange(buckets, buckets + dense.shape[1])
    for i in range(len(given)):
        own, counts = np.unique(slots[begins[i] : begins[i + 1]], return_counts=True)
        values = np.sqrt(counts / max(counts.sum(), 1))
        yield np.concatenate([own, fixed]), np.concatenate([values, dense[i]])


def _metadata(batch: pd.DataFrame, names: Sequence[str]) -> np.ndarray:
    """Logarithms of numeric columns; nulls and values that are no numbers count as 0."""
    if not names:
        return np.zeros((len(batch), 0))
    values = batch[list(names)].to_numpy(dtype=float, na_value=0.0)
    return np.log1p(np.clip(np.nan_to_num(values, posinf=0, neginf=0), 0, None)) / 20


class Machine:
    """Bias, weights and vectors of the features, and their scales."""

    def __init__(self, bias: float, weights: np.ndarray, vectors: np.ndarray, buckets: int, metadata: tuple):
        self.bias, self.weights, self.vectors = bias, weights, vectors
        self.buckets, self.metadata = buckets, metadata

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.vectors[index] * value[:, None]
        total = v.sum(axis=0)
        pairs = 0.5 * float(total @ total - (v * v).sum())
        return self.bias + float(self.weights[index] @ value) + pairs


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    metadata: Sequence[str] = (),
    sample: int = SAMPLE,
    buckets: int = BUCKETS,
    rank: int = RANK,
) -> Machine:
    """A machine for the documents that ``labels`` marks 0 or 1.

    The sample is drawn from the labels, so that only its keys, ``sample`` at most, meet
    the documents.
    """
    drawn = (
        labels.where(F.col(label).isin(0, 1))
        .select(
            F.col(key).alias("_key"), F.col(label).cast("int").alias("label"),
            F.xxhash64(F.col(key).cast("string"), F.lit("quality")).alias("_order"),
        )
        .orderBy("_order", "label")
        .limit(sample)
    )
    rows = docs.select(
        F.col(key).alias("_doc"), F.col(text).alias("text"), *[F.col(m).alias(m) for m in metadata]
    )
    joined = rows.join(F.broadcast(drawn), F.col("_doc") == F.col("_key"))
    chosen = joined.orderBy("_order", F.xxhash64("text")).limit(sample).drop("_order", "_doc", "_key")
    names = tuple(metadata)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch):
                found = list(_features(part["text"].tolist(), _metadata(part, names), buckets))
                yield pd.DataFrame(
                    {
                        "label": part["label"],
                        "index": pd.Series([i.astype(np.int32) for i, _ in found], index=part.index),
                        "value": pd.Series([v.astype(np.float32) for _, v in found], index=part.index),
                    }
                )

    data = chosen.mapInPandas(extract, "label int, index array<int>, value array<float>").toArrow()
    labels = data["label"].to_numpy().astype(float)
    index = [np.asarray(x) for x in data["index"].to_pylist()]
    value = [np.asarray(x, dtype=np.float64) for x in data["value"].to_pylist()]
    return _descend(index, value, labels, buckets, len(STATISTICS) + len(names), rank, names)


def _parts(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch in parts of bounded text."""
    sizes = ((i, len(t) if isinstance(t, str) else 0) for i, t in enumerate(batch["text"]))
    for part in chunks(sizes, lambda x: x[1] + 64, SLICE):
        yield batch.iloc[part[0][0] : part[-1][0] + 1]


def _descend(index, value, labels, buckets, n_dense, rank, names) -> Machine:
    """Adam over mini-batches in a fixed pseudo-random order."""
    n_features = buckets + n_dense
    rng = np.random.default_rng(7)
    weights, vectors = np.zeros(n_features), rng.normal(0, 0.05, (n_features, rank))
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        bias = 35.0 * (2 * share - 1)
        return Machine(bias, weights, np.zeros_like(vectors), buckets, names)
    # Every class weighs a half.
    costs = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    theta = np.concatenate([weights[:, None], vectors], axis=1)
    first, second, bias, b1, b2, step = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0, 0.0, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            gradient, slope = np.zeros_like(theta), 0.0
            batch = order[at : at + BATCH]
            for r in batch:
                i, x = index[r], value[r][:, None]
                rows = theta[i]
                v = rows[:, 1:] * x
                total = v.sum(axis=0)
                raw = bias + float((rows[:, :1] * x).sum()) + 0.5 * float(total @ total - (v * v).sum())
                error = (_sigmoid(raw) - labels[r]) * costs[r] / len(batch)
                slope += error
                gradient[i, :1] += error * x
                gradient[i, 1:] += error * x * (total - v)
            gradient += DECAY * theta
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.99 * second + 0.01 * gradient**2
            b1, b2 = 0.9 * b1 + 0.1 * slope, 0.99 * b2 + 0.01 * slope**2
            c1, c2 = 1 - 0.9**step, 1 - 0.99**step
            theta -= RATE * (first / c1) / (np.sqrt(second / c2) + 1e-8)
            bias -= RATE * (b1 / c1) / (np.sqrt(b2 / c2) + 1e-8)
    return Machine(float(bias), theta[:, 0].copy(), theta[:, 1:].copy(), buckets, names)


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for every row."""
    parts = (machine.bias, machine.weights, machine.vectors, machine.buckets, machine.metadata)
    cast = docs.sparkSession.sparkContext.broadcast(parts)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *machine.metadata)
    kind = dict(rows.dtypes)["key"]

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fm = Machine(*cast.value)
        for batch in batches:
            for part in _parts(batch):
                found = _features(part["text"].tolist(), _metadata(part, fm.metadata), fm.buckets)
                raw = np.array([fm.raw(i, x) for i, x in found])
                yield pd.DataFrame({"key": part["key"], "score": _sigmoid(raw)})

    return in_frames(rows, apply, f"key {kind}, score double").withColumnRenamed("key", key)


def keep_good(docs: DataFrame, machine: Machine, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, with their own columns only.

    Rows are scored where they are, so keys need not be unique.
    """
    cast = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.weights, machine.vectors, machine.buckets, machine.metadata)
    )

    @F.pandas_udf("double")
    def scored(row: pd.DataFrame) -> pd.Series:
        process_cache(None)
        fm = Machine(*cast.value)
        raw = [
            fm.raw(i, x)
            for part in _parts(row)
            for i, x in _features(part["text"].tolist(), _metadata(part, fm.metadata), fm.buckets)
        ]
        return pd.Series(_sigmoid(np.array(raw, dtype=float)))

    columns = [F.col(f"`{text}`").alias("text"), *[F.col(f"`{m}`").alias(m) for m in machine.metadata]]
    return docs.where(scored(F.struct(*columns)) >= least)
