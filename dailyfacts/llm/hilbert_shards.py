"""Sharding by a Hilbert curve over metadata.

Metadata dimensions are quantised into equally filled bins, the bins of a row are one
cell of a cube, and the cell's place on a Hilbert curve orders the rows. Cutting that
order into runs of equal bytes gives shards that each cover a small part of every
dimension, so that minimum and maximum of a shard's files prune on any of them.

Rows are ordered by a range partitioning of (place, text hash, key); each partition
sums its own rows, and one small row for each partition gives the offsets. Equal texts
with equal metadata are neighbours.

Defined results: null metadata sorts first; a null text has no bytes; repeated rows
stay rows of their own; an empty table gives no rows; columns that are not named are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailyfacts.llm.common import in_frames, kept

SHARDS = 24
DIMENSIONS = ("source", "lang", "size")
#: Bins of a dimension: two to this power.
BITS = 5
#: Bytes that a row takes besides its text.
ROW_BYTES = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the curve of integer cells, an array of rows by dimensions.

    The cells' bits are first turned into those of the transposed index by undoing
    the reflections and rotations of every level, then Gray-decoded and interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        low = q - one
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        t = np.where((x[n - 1] & q) != 0, t ^ (q - one), t)
    x ^= t
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << one) | ((x[i] >> np.uint64(level)) & one)
    return index.astype(np.int64)


def text_cuts(narrow: DataFrame, column: str, bins: int) -> list[str]:
    """Values at which the bins of a text column end, of whole texts in their order.

    Rows are counted for each value, and the counts added up over ranges of values; only the
    values at which a bin fills reach the driver, fewer than ``bins``.
    """
    counts = narrow.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    parts = kept(
        counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "hilbert-counts"
    )
    by_part = Window.orderBy("part")
    totals = parts.groupBy("part").agg(F.sum("n").alias("rows"))
    offsets = totals.select(
        "part", (F.sum("rows").over(by_part) - F.col("rows")).alias("rows_before"),
        F.sum("rows").over(Window.partitionBy()).alias("all_rows"),
    )
    running = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.withColumn("upto", F.sum("n").over(running)).join(offsets, "part")
    upto = F.col("rows_before") + F.col("upto")
    filled = F.expr(f"(rows_before + upto - n) * {bins} div all_rows") < F.floor(upto * bins / F.col("all_rows"))
    ends = summed.where(filled & (upto < F.col("all_rows")) & F.col("value").isNotNull())
    return [row["value"] for row in ends.select("value").orderBy("value").collect()]


def _bin(column: Column, cuts: list) -> Column:
    """How many cuts are below a value, 0 for null."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < column))
    return F.when(column.isNull(), 0).otherwise(below)


def _places(bits: int):
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            cells = np.array(rows.pop("cells").tolist(), dtype=np.int64).reshape(len(rows), -1)
            yield rows.assign(place=hilbert_index(cells, bits))

    return index


def hilbert_order(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    dimensions: Sequence[str] = DIMENSIONS,
    bits: int = BITS,
) -> DataFrame:
    """``key, size, text_crc32, place`` with the place on the curve.

    ``size`` among the dimensions stands for the bytes of the text.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    size = (F.octet_length(body) + ROW_BYTES).cast("long")
    kinds = dict(docs.dtypes)
    values = []
    for i, name in enumerate(dimensions):
        value = size if name == "size" else F.col(f"`{name}`")
        is_text = name != "size" and kinds[name] == "string"
        values.append((value if is_text else value.cast("double")).alias(f"d{i}"))
    narrow = kept(
        docs.select(
            F.col(f"`{key}`").alias("key"), size.alias("size"), F.crc32(body).alias("text_crc32"), *values
        ),
        "hilbert-values",
    )
    bins = 1 << bits
    shares = [i / bins for i in range(1, bins)]
    of_text = [i for i in range(len(dimensions)) if dict(narrow.dtypes)[f"d{i}"] == "string"]
    of_number = [i for i in range(len(dimensions)) if i not in of_text]
    cuts = {i: text_cuts(narrow, f"d{i}", bins) for i in of_text}
    if of_number:
        found = narrow.agg(*[F.percentile_approx(f"d{i}", shares, 10_000).alias(f"c{i}") for i in of_number])
        cuts |= {i: sorted(set(c or [])) for i, c in zip(of_number, found.first(), strict=True)}
    cells = F.array(*[_bin(F.col(f"d{i}"), cuts[i]).cast("int") for i in range(len(dimensions))])
    schema = "key " + dict(narrow.dtypes)["key"] + ", size long, text_crc32 long, place long"
    placed = narrow.select("key", "size", "text_crc32", cells.alias("cells"))
    return in_frames(placed, _places(bits), schema).withColumnRenamed("key", key)


def cut_runs(ordered: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """``ordered`` with ``shard`` and ``slot``: runs of the order, of nearly equal bytes.

    A row belongs to the shard in which the middle of its bytes falls, so a shard
    differs from its share by less than a row at either end.
    """
    order = ["place", "text_crc32", key]
    ranged = ordered.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts = kept(ranged, "hilbert-parts")
    totals = parts.groupBy("part").agg(F.sum("size").alias("bytes"))
    by_part = Window.orderBy("part")
    offsets = totals.select(
        "part",
        (F.sum("bytes").over(by_part) - F.col("bytes")).alias("bytes_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    running = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.join(offsets, "part").withColumn(
        "middle", F.col("bytes_before") + F.sum("size").over(running) - F.col("size") / 2
    )
    shard = F.least(F.lit(shards - 1), F.floor(F.col("middle") * shards / F.col("all_bytes"))).cast("int")
    dealt = kept(
        placed.withColumn("shard", shard).drop("middle", "bytes_before", "all_bytes"), "hilbert-shards"
    )
    # Slots of a shard: those of earlier partitions come first.
    counts = dealt.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = counts.select(
        "part", "shard",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("slots_before"),
    )
    rank = F.row_number().over(Window.partitionBy("part", "shard").orderBy(*order))
    return (
        dealt.withColumn("rank", rank)
        .join(earlier, ["part", "shard"])
        .withColumn("slot", (F.col("slots_before") + F.col("rank") - 1).cast("long"))
        .drop("part", "rank", "slots_before")
    )


def write_shards(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    dimensions: Sequence[str] = DIMENSIONS, shards: int = SHARDS,
) -> None:
    """Parquet folders ``shard=N`` in slot order. ``key`` must be unique here."""
    places = cut_runs(hilbert_order(docs, key, text, dimensions), shards, key).select(key, "shard", "slot")
    rows = docs.join(places, key).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").parquet(path)
