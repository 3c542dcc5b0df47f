"""Periodic runs of words: maximal stretches that repeat a root, by scale-tiled distribution.

A run is a maximal stretch of words with smallest period q, at least ``TIMES * q`` and
``LEAST`` words long. In terms of matches, places i whose word equals the one q further
on, it is a maximal interval of at least ``max(LEAST - q, (TIMES - 1) * q)`` matches.

Periods are handled by octaves: those from P up to 2P. Boundaries stand every P words
(every ``WINDOW`` words for the periods below 2 * ``WINDOW``, which share one scale), close
enough that any run of the octave has ``WINDOW`` matches in a row from one of them on.
A document is exploded into the overlapping tiles around those boundaries at which the
next ``WINDOW`` words come again at a distance of the octave; all other boundaries are
ruled out by hashes of windows, whose collisions can only make needless tiles.

Tiles are solved independently: the Z-function of the words from the boundary on gives,
for all periods at once, how far matches reach to the right, that of the words before it,
backwards, how far to the left, both up to the next boundary and a window. A period whose
root repeats a shorter one is left out, which the same function tells; every rotation of a
root agrees on that, so all tiles do. The fragments of intervals are shuffled by document
and period and stitched where they touch.

A long document's tiles are spread over tasks. Texts without a tile are done in the first
pass; only the others' words are joined with their runs.

Defined results: a null or empty text has no words, no run and the hash of an empty text; a
document of any length is handled whole; rows with equal keys are apart as long as their
texts differ, repeated rows get equal results; a null key is kept, and planted rows
(``planted``) never have one; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailyfacts.llm.common import chunks, kept
from dailyfacts.llm.hashing import mix

#: Least words of a run, and least times that it holds its root.
LEAST = 24
TIMES = 3
#: Words that must match from a boundary on. A run has twice as many matches, less one, or more.
WINDOW = 8
#: Bytes of text that are looked at in one go.
SLICE = 1 << 21

_EMPTY = hashlib.sha256(b"").hexdigest()


def planted(words: list[bytes], h: int) -> list[bytes]:
    """The words with a periodic tail where ``h`` asks for one: a test of the search on any text."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a : a + p] * ((n - a) // p + 1))[: n - a]]


def scales(n: int) -> Iterator[tuple[int, int, int]]:
    """``(first period, last period, words between boundaries)`` of the octaves of n words."""
    low, step = 1, WINDOW
    while low * TIMES <= n and n >= LEAST:
        high = min(2 * max(low, WINDOW) - 1, n // TIMES)
        yield low, high, step
        low = step = high + 1


def window_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the ``WINDOW`` words from each place on."""
    rolled = np.zeros(max(len(codes) - WINDOW + 1, 0), dtype=np.uint64)
    for i in range(WINDOW):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + len(rolled)].astype(np.uint64))
    return rolled


def tiles(codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(first period, last period, boundary)`` of the tiles in which a run may show."""
    if len(codes) < LEAST:
        return
    hashes = window_hashes(codes)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    group = np.cumsum(np.diff(ranked, prepend=ranked[:1]) != 0)
    if group[-1] == len(hashes) - 1:
        return
    # Places of equal windows follow each other in one ascending list of numbers.
    width = 2 * len(codes) + 2
    places = group * width + order
    group_at = np.empty(len(hashes), dtype=np.int64)
    group_at[order] = group
    for low, high, step in scales(len(codes)):
        at = np.arange(0, len(hashes), step)
        wanted = group_at[at] * width + at + low
        found = np.searchsorted(places, wanted)
        found[found == len(places)] = 0
        again = (places[found] >= wanted) & (places[found] <= wanted + (high - low))
        for boundary in at[again].tolist():
            yield low, high, boundary


def tile_bounds(low: int, high: int, boundary: int, n: int) -> tuple[int, int]:
    """Where a tile's words begin and end."""
    step = max(low, WINDOW)
    return max(0, boundary - step), min(n, boundary + high + step + WINDOW)


def z_function(s: list, most: int) -> list[int]:
    """For the places up to ``most``: how many elements from there on equal those from the start on."""
    n = len(s)
    z = [0] * min(most + 1, n)
    left = right = 0
    for i in range(1, len(z)):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _primes(q: int) -> list[int]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return found + [q] if q > 1 else found


def fragments(words: list[int], low: int, high: int, at: int) -> Iterator[tuple[int, int, int]]:
    """``(period, matches begin, matches end)`` around place ``at`` of a tile, for its octave.

    Only periods are given of which a run may come: whose root is no shorter one's repetition,
    and whose matches reach the tile's limit or are enough by themselves.
    """
    step = max(low, WINDOW)
    ahead = words[at:]
    right = z_function(ahead, high)
    # Matches to the left: what ends before the boundary against what ends q words later.
    back = words[:at][::-1]
    turned = words[: at + high][::-1]
    left = z_function([*back, None, *turned], len(back) + len(turned))
    for q in range(low, min(high, len(right) - 1) + 1):
        f = min(right[q], step + WINDOW)
        # Words that end at at + q begin len(turned) - (at + q) places into the turned text.
        g = min(left[len(back) + 1 + len(turned) - at - q], step, at) if at else 0
        if not f + g:
            continue
        whole = f < step + WINDOW and g < step
        if whole and f + g < max(LEAST - q, (TIMES - 1) * q):
            continue
        if right[q] and any(right[q // r] >= q - q // r for r in _primes(q)):
            continue
        yield q, at - g, at + f


def _codes(words: list[bytes], vocabulary) -> np.ndarray:
    return np.frombuffer(array("q", map(vocabulary.__getitem__, words)), dtype=np.int64)


def _vocabulary():
    """Numbers for words, given out in the order in which they are met."""
    numbers = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without a tile get their hash; the words of the others are handed on."""
    for batch in batches:
        keys, row = batch.column("key"), batch.column("row")
        rows = zip(range(len(keys)), batch.column("h").to_pylist(), batch.column("text").to_pylist(), strict=True)
        for part in chunks(rows, lambda r: len(r[2] or "") + 64, SLICE):
            vocabulary = _vocabulary()
            n, is_open, bodies, hashes = [], [], [], []
            for _, h, text in part:
                words = _bytes(text).split()
                if h is not None:
                    words = planted(words, h)
                body = b" ".join(words)
                hit = len(words) >= LEAST and next(tiles(_codes(words, vocabulary)), None) is not None
                n.append(len(words))
                is_open.append(hit)
                bodies.append(body if hit else None)
                hashes.append(None if hit else hashlib.sha256(body).hexdigest())
            a, size = part[0][0], len(part)
            yield pa.RecordBatch.from_arrays(
                [keys.slice(a, size), row.slice(a, size), pa.array(n, pa.int64()), pa.array(is_open, pa.bool_()),
                 pa.array(bodies, pa.binary()), pa.array(hashes, pa.string())],
                ["key", "row", "n", "open", "body", "collapsed"],
            )


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tiles of every document: their place, and the numbers of their words."""
    names = ["key", "row", "low", "high", "boundary", "begin", "words"]

    def out(key_type, rows):
        columns = list(zip(*rows, strict=True))
        kinds = [key_type, *[pa.int64()] * 5, pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    for batch in batches:
        key_type = batch.column("key").type
        rows, size = [], 0
        for key, row, body in zip(*[batch.column(c).to_pylist() for c in ("key", "row", "body")], strict=True):
            codes = _codes(body.split(), _vocabulary())
            narrow = codes.astype(np.int32)
            for low, high, boundary in tiles(codes):
                begin, end = tile_bounds(low, high, boundary, len(codes))
                rows.append((key, row, low, high, boundary, begin, narrow[begin:end].tobytes()))
                size += 4 * (end - begin) + 64
                if size > SLICE:
                    yield out(key_type, rows)
                    rows, size = [], 0
        if rows:
            yield out(key_type, rows)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, periods, begins, ends = [], [], [], []
        columns = [batch.column(c).to_pylist() for c in ("low", "high", "boundary", "begin", "words")]
        for i, (low, high, boundary, begin, words) in enumerate(zip(*columns, strict=True)):
            for q, a, b in fragments(np.frombuffer(words, np.int32).tolist(), low, high, boundary - begin):
                places.append(i)
                periods.append(q)
                begins.append(begin + a)
                ends.append(begin + b)
        at = pa.array(places, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").take(at), batch.column("row").take(at),
             *[pa.array(x, pa.int64()) for x in (periods, begins, ends)]],
            ["key", "row", "period", "begin", "end"],
        )


def stitch(found: DataFrame) -> DataFrame:
    """``key, row, start, length, period`` of the runs that touching fragments make up."""
    order = Window.partitionBy("key", "row", "period").orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("begin") <= F.col("before"), 0).otherwise(1)).over(order)
    joined = (
        found.withColumn("before", before).withColumn("island", island)
        .groupBy("key", "row", "period", "island")
        .agg(F.min("begin").alias("start"), (F.max("end") - F.min("begin") + F.col("period")).alias("length"))
    )
    least = F.greatest(F.lit(LEAST), TIMES * F.col("period"))
    return joined.where(F.col("length") >= least).select("key", "row", "start", "length", "period")


def find_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", h: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """All rows, and the runs of those that have any.

    The first has ``key, row, n, open, body, collapsed``: ``row`` tells texts with one key
    apart, open rows have their words in ``body`` and the others the hash of theirs in
    ``collapsed``. The second has ``key, row, start, length, period``. ``h`` plants tails.
    """
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), (F.lit(None).cast("long") if h is None else h).alias("h"),
        F.xxhash64(F.col(f"`{text}`")).alias("row"), F.col(f"`{text}`").alias("text"),
    )
    kind = dict(rows.dtypes)["key"]
    measured = rows.mapInArrow(
        _measure, f"key {kind}, row long, n long, open boolean, body binary, collapsed string"
    )
    plain = kept(measured, "runs-measured")
    # Tiles of repeated rows only give the same fragments again.
    exploded = plain.where("open").select("key", "row", "body").mapInArrow(
        _explode, f"key {kind}, row long, low long, high long, boundary long, begin long, words binary"
    )
    # Tiles of one document go to as many tasks as there are.
    spread = exploded.repartition(F.col("row"), F.col("low"), F.col("boundary"))
    found = spread.mapInArrow(_solve, f"key {kind}, row long, period long, begin long, end long")
    return plain, stitch(found)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run ``(start, length, period)`` contains after its first root."""
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    gone = np.cumsum(dropped) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=False) if not g]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for body, runs in zip(batch.column("body").to_pylist(), batch.column("runs").to_pylist(), strict=True):
            spans = [(r["start"], r["length"], r["period"]) for r in runs or []]
            texts.append(b" ".join(collapse(body.split(), spans)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("runs"), pa.array(texts, pa.binary())], ["key", "runs", "collapsed"]
        )


def collapsed_texts(plain: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, runs, collapsed`` of the open rows, and the other rows of ``plain``.

    Runs are in the order of start and period; ``collapsed`` holds the words that stay, in
    UTF-8 with a blank between them.
    """
    span = F.struct("start", "period", "length")
    of_row = runs.groupBy(F.col("key").alias("k"), F.col("row").alias("r")).agg(
        F.array_sort(F.collect_list(span)).alias("runs")
    )
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("row") == F.col("r"))
    joined = plain.where("open").join(of_row, same, "left").select("key", "runs", "body")
    kinds = dict(joined.dtypes)
    done = joined.mapInArrow(_finish, f"key {kinds['key']}, runs {kinds['runs']}, collapsed binary")
    return done, plain.where("not open")


def run_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", h: Column | None = None
) -> DataFrame:
    """One row for each document: number of runs, the one with the greatest exponent, hashes."""
    plain, runs = find_runs(docs, key, text, h)
    done, without = collapsed_texts(plain, kept(runs, "runs"))
    runs = F.coalesce("runs", F.array())
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size(runs) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    # a / b against c / d by a * d and c * b, which is exact; the first of equal ones is kept.
    larger = F.reduce(
        runs, F.get(runs, F.lit(0)),
        lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x),
    )
    best = done.select(
        "key", F.size(runs).cast("long").alias("n_runs"), larger.alias("b"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    some = best.select(
        "key", "n_runs", "b.start", "b.length", "b.period",
        F.expr("b.length * 1000 div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
    null = F.lit(None).cast("long")
    none = without.select(
        "key", F.lit(0).cast("long").alias("n_runs"), null.alias("start"), null.alias("length"),
        null.alias("period"), null.alias("exponent_milli"), F.lit(_EMPTY).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )
    return some.unionByName(none).withColumnRenamed("key", key)
