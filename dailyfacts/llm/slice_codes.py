"""Vector codes: the nearest codebook entry of every part of a vector, by slices.

Vectors become integers and are cut into ``PARTS`` parts. Each part position has a
codebook of up to ``ENTRIES`` entries, improved in ``ROUNDS`` rounds of nearest entries
and componentwise means.

The nearest entry is found by slice and intersect. For every dimension of a codebook the
entries' coordinates are sorted, and for every place in that order a mask of bits says
which entries come before it. A query with a radius asks two places of each dimension;
the difference of their masks is the slice of entries within the radius there, and the
slices of all dimensions ANDed are the entries in the cube around the query. Their
distances are taken exactly. When the best of them is within the radius no entry outside
the cube can be as near, or tie; otherwise the radius becomes the best distance, or is
doubled where the cube is empty, and the query is asked again. So every answer is exact.

A round is one pass over the vectors: tasks add up the parts of each entry, and Spark adds
the tasks' sums, a row for each entry of each part. Only these rows reach the driver.

Defined results: rows whose vector is null, or holds a null or non-finite component, or
has another length than the first kept one take no part; the last part is the longest
where the length is no multiple of ``PARTS``. The first entries are those of the smallest
keys; null keys come last, rows with equal keys go by their vectors. Rows with null keys
or repeated rows are coded like others; null labels are one label. Components beyond
``LARGEST`` fail the job, as their distances would not be exact. An empty table gives no
rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailyfacts.llm.common import kept
from dailyfacts.operators.joins import broadcast_if_small

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: What a component is multiplied by before it is cut to an integer.
SCALE = 1024
#: Largest integer component: 64-bit squares and their sums stay exact up to 4,096 of them.
LARGEST = 1 << 24
#: Queries that are looked at in one go.
BLOCK = 2048


class Slices:
    """A codebook with its sorted coordinates and prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, dims = entries.shape
        words = (n + 63) // 64
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0).T.copy()
        one = np.zeros((n, words), dtype=np.uint64)
        one[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        #: For each dimension and place: the mask of the entries before that place.
        self.before = np.zeros((dims, n + 1, words), dtype=np.uint64)
        for d in range(dims):
            self.before[d, 1:] = np.bitwise_or.accumulate(one[order[:, d]], axis=0)
        self.radius = self._first_radius()

    def _first_radius(self) -> int:
        """The median distance between an entry and its nearest other one."""
        nearest = [
            np.partition(((self.entries - e) ** 2).sum(axis=1), 1)[1] for e in self.entries
        ] if len(self.entries) > 1 else [0]
        return max(1, math.isqrt(int(np.median(nearest))))

    def cube(self, queries: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that are within the radius in every dimension."""
        masks = np.full((len(queries), self.before.shape[2]), ~np.uint64(0))
        for d, coordinates in enumerate(self.sorted):
            low = np.searchsorted(coordinates, queries[:, d] - radius, "left")
            high = np.searchsorted(coordinates, queries[:, d] + radius, "right")
            masks &= self.before[d, high] & ~self.before[d, low]
        # Without dimensions every entry is at distance 0.
        return masks if len(self.sorted) else np.broadcast_to(np.uint64(1), masks.shape)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest entry, the first of equal ones."""
        index = np.zeros(len(queries), dtype=np.int64)
        distance = np.zeros(len(queries), dtype=np.int64)
        for at in range(0, len(queries), BLOCK):
            block = slice(at, at + BLOCK)
            index[block], distance[block] = self._nearest(queries[block])
        return index, distance

    def _nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        index = np.zeros(len(queries), dtype=np.int64)
        distance = np.zeros(len(queries), dtype=np.int64)
        radius = np.full(len(queries), self.radius, dtype=np.int64)
        left = np.arange(len(queries))
        while len(left):
            masks = self.cube(queries[left], radius[left])
            bits = np.unpackbits(masks.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            apart = queries[left[row]] - self.entries[entry]
            square = np.einsum("ij,ij->i", apart, apart)
            # Candidates of a query are together, in the order of the entries.
            first = np.flatnonzero(np.diff(row, prepend=-1))
            best = np.minimum.reduceat(square, first) if len(first) else square
            hit = np.flatnonzero(square == np.repeat(best, np.diff(first, append=len(row))))
            hit = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
            found = left[row[first]]
            done = best <= radius[found] ** 2
            index[found[done]], distance[found[done]] = entry[hit[done]], best[done]
            empty = np.setdiff1d(left, found, assume_unique=True)
            radius[empty] *= 2
            wider = found[~done]
            radius[wider] = [math.isqrt(int(b) - 1) + 1 for b in best[~done]]
            left = np.sort(np.concatenate([empty, wider]))
        return index, distance


class CodeBooks:
    """The codebooks of all part positions, as integer arrays of entries by components."""

    def __init__(self, dims: int, books: list[np.ndarray]):
        self.dims = dims
        self.books = books

    @property
    def bounds(self) -> list[int]:
        return part_bounds(self.dims)

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, with commas between."""
        numbers = [str(x) for book in self.books for x in book.ravel().tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def part_bounds(dims: int) -> list[int]:
    return [dims // PARTS * i for i in range(PARTS)] + [dims]


def _integers(vectors: np.ndarray) -> np.ndarray:
    floors = np.floor(vectors.astype(np.float64) * SCALE)
    if len(floors) and np.abs(floors).max(initial=0) > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} / {SCALE}")
    return floors.astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return _integers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _rows(df: DataFrame, key: str, vector: str, *more: Column) -> DataFrame:
    narrow = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector"), *more)
    return narrow.where(usable(F.col("vector")))


def _sums(dims: int, slices_cast):
    """Sums and counts of the parts nearest to each entry, a row for each entry that a task met."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, all_slices = part_bounds(dims), slices_cast.value
        sums = [np.zeros(s.entries.shape, dtype=np.int64) for s in all_slices]
        counts = [np.zeros(len(s.entries), dtype=np.int64) for s in all_slices]
        for batch in batches:
            matrix = _matrix(batch.column("vector"), dims)
            for p, slices in enumerate(all_slices):
                part = matrix[:, bounds[p] : bounds[p + 1]]
                index, _ = slices.nearest(part)
                np.add.at(sums[p], index, part)
                counts[p] += np.bincount(index, minlength=len(counts[p]))
        met = [(p, e) for p, n in enumerate(counts) for e in np.flatnonzero(n)]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([p for p, _ in met], pa.int32()),
                "entry": pa.array([e for _, e in met], pa.int32()),
                "n": pa.array([counts[p][e] for p, e in met], pa.int64()),
                "sums": pa.array([sums[p][e] for p, e in met], pa.list_(pa.int64())),
            }
        )

    return add


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> CodeBooks | None:
    """Codebooks of all usable vectors; None when there are none."""
    rows = _rows(df, key, vector)
    first = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(1).collect()
    if not first:
        return None
    dims = len(first[0]["vector"])
    rows = rows.where(F.size("vector") == dims)
    start = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    bounds = part_bounds(dims)
    matrix = _integers(np.array([r["vector"] for r in start], dtype=np.float64).reshape(len(start), dims))
    books = [matrix[:, a:b].copy() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    widest = max(b.shape[1] for b in books)
    for _ in range(ROUNDS):
        cast = df.sparkSession.sparkContext.broadcast([Slices(b) for b in books])
        added = (
            rows.select("vector")
            .mapInArrow(_sums(dims, cast), "part int, entry int, n long, sums array<long>")
            .groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(widest)]).alias("sums"))
            .collect()
        )
        for row in added:
            book = books[row["part"]]
            book[row["entry"]] = [s // row["n"] for s in row["sums"][: book.shape[1]]]
    return CodeBooks(dims, books)


def encode(
    df: DataFrame, books: CodeBooks, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``key, label, code, error`` of the usable vectors with the codebooks' length."""
    rows = _rows(df, key, vector, F.col(f"`{label}`").alias("label")).where(F.size("vector") == books.dims)
    cast = df.sparkSession.sparkContext.broadcast([Slices(b) for b in books.books])
    dims = books.dims

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, all_slices = part_bounds(dims), cast.value
        for batch in batches:
            matrix = _matrix(batch.column("vector"), dims)
            codes = np.zeros((len(matrix), PARTS), dtype=np.uint8)
            errors = np.zeros(len(matrix), dtype=np.int64)
            for p, slices in enumerate(all_slices):
                codes[:, p], distance = slices.nearest(matrix[:, bounds[p] : bounds[p + 1]])
                errors += distance
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"),
                 pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors)],
                ["key", "label", "code", "error"],
            )

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(apply, f"key {kinds['key']}, label {kinds['label']}, code string, error long")


def decode(encoded: DataFrame, books: CodeBooks) -> DataFrame:
    """``key, vector``: the entries that a code stands for, on the scale of the vectors."""
    bounds = books.bounds

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([list(bytes.fromhex(c)) for c in batch.column("code").to_pylist()]).reshape(-1, PARTS)
            matrix = np.zeros((len(codes), books.dims))
            for p, book in enumerate(books.books):
                matrix[:, bounds[p] : bounds[p + 1]] = book[codes[:, p]] / SCALE
            vectors = pa.array(list(matrix), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), vectors], ["key", "vector"])

    rows = encoded.select("key", "code")
    return rows.mapInArrow(apply, f"key {dict(rows.dtypes)['key']}, vector array<double>")


def compress(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``key, code, error, label_error, codebooks_sha256`` of every usable vector.

    Errors are added up for each label inside the tasks first; the sums are broadcast when
    they measure small, so that a label with most of the rows is not brought together.
    """
    books = fit(df, key, vector)
    kinds = dict(df.dtypes)
    if books is None:
        return df.sparkSession.createDataFrame(
            [], f"`{key}` {kinds[key]}, code string, error long, label_error long, codebooks_sha256 string"
        )
    coded = kept(encode(df, books, key, vector, label), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(broadcast_if_small(by_label), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )
