"""N-gram Jaccard join by PartEnum signatures, and the groups that its links form.

A document's set is its distinct shingles of ``WORDS`` words. Two sets with a Jaccard
similarity of at least ``MINIMUM`` percent, n and m elements, differ in at most
d = (100 - MINIMUM) / (100 + MINIMUM) * (n + m) elements, which for a set of n is at most
``most_differences(n)``. The shingle domain is divided into partitions by hash, as many
as the size band of a set asks for. Every difference spoils one partition at most, so a
set with more than that many filled partitions agrees with each partner on at least one:
both have the same elements there and share the signature (band, partition, elements).

- Of a set's signatures only the first ``most_differences + 1``, in one order for all
  sets, are needed: the others may all be spoilt.
- Shingles that many documents have tell nothing apart. They are left out of the
  partitions, which adds no difference, as long as enough filled partitions remain.
- Sets for which they do not (small ones, ones made of common passages) are joined with
  each other in the finest division, one element to a partition, rare elements first.

Bands overlap so far that two sets of similar sizes are always together in one; most
sets are in one band, the others in two.

Equal sets are one representative from the start. Candidates whose parity vectors, a bit
or two for each element, differ too much cannot be linked and go; the others are checked
exactly on whole sets. That is done in two rounds: in each signature's group all members against the one with
fewest rare shingles, which connects groups of copies; then, in groups that still hold
several components, the pairs between components. No link between different components
can be missed, and copies are never expanded into all pairs.

Defined results: a text without words, empty or null, has no shingles and is linked with
nothing; with fewer than ``WORDS`` words the whole sequence is one shingle; rows with
equal keys are one document; a null key takes no part and has no component; an empty
table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailyfacts.llm.common import chunks, free_name, in_frames, kept, process_cache, scratch_scope, small_batches
from dailyfacts.llm.hashing import mix, word_hashes
from dailyfacts.operators.joins import broadcast_if_small

WORDS = 5
#: Least similarity, in percent.
MINIMUM = 75
#: Sizes of a band: from one step of this factor to the next, and on by 100 / MINIMUM.
BAND = 4.0
#: Partitions of a band as a share of its largest size.
PARTITIONS = 0.6
#: Common shingles that are left out, at most, and documents that one is in, at least.
COMMON = 50_000
COMMON_DOCS = 16
#: Members of a group that are compared with as many others at a time.
BLOCK = 512
#: Bytes of text that are looked at in one go.
SLICE = 1 << 20


def most_differences(n: int) -> int:
    """Elements in which a set of n and any partner can differ: the partner has n * 100 / MINIMUM at most."""
    largest = n * 100 // MINIMUM
    return (100 - MINIMUM) * (n + largest) // (100 + MINIMUM)


def bands(n: int) -> list[tuple[int, int]]:
    """``(band, partitions)`` of the bands that a set of n is in."""
    b = int(np.floor(np.log(n) / np.log(BAND) + 1e-12))
    found = [b]
    # Partners of the sets at the top of a band may be just above it.
    if b > 0 and n * MINIMUM <= 100 * BAND**b:
        found.append(b - 1)
    return [(x, max(1, int(PARTITIONS * BAND ** (x + 1) * 100 / MINIMUM))) for x in found]


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, begins, _ = word_hashes(texts)
    rolled = np.zeros(max(len(hashes) - WORDS + 1, 0), dtype=np.uint64)
    for i in range(WORDS):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(rolled)])
    for a, b in zip(begins[:-1], begins[1:], strict=True):
        if b - a >= WORDS:
            yield np.unique(rolled[a : b - WORDS + 1])
        elif b > a:
            whole = np.array([b - a], dtype=np.uint64)
            for h in hashes[a:b]:
                whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + h)
            yield whole
        else:
            yield rolled[:0]


def _in_sets(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """``(other columns, set)`` of every row."""
    process_cache(None)
    for batch in batches:
        others = batch.drop(columns="text").itertuples(index=False, name=None)
        rows = zip(others, batch["text"], strict=True)
        for part in chunks(rows, lambda r: len(r[1]) + 64 if isinstance(r[1], str) else 64, SLICE):
            texts = [t if isinstance(t, str) else "" for _, t in part]
            yield from zip([o for o, _ in part], shingle_sets(texts), strict=True)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    a = mix(s).sum(dtype=np.uint64)
    b = mix(s * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(len(s))).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _common_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shingles that a task meets several times, with their counts.

    Single ones are forgotten whenever many have gathered; this only makes fewer
    shingles common.
    """
    names, counts, fresh, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def fold(names, counts, fresh):
        every = np.concatenate([names, *fresh])
        weight = np.concatenate([counts, *[np.ones(len(f), np.int64) for f in fresh]])
        found, place = np.unique(every, return_inverse=True)
        total = np.bincount(place, weight, minlength=len(found)).astype(np.int64)
        return found[total > 1], total[total > 1]

    for _, s in _in_sets(batches):
        fresh.append(s)
        n += len(s)
        if n > 1 << 20:
            names, counts = fold(names, counts, fresh)
            fresh, n = [], 0
    names, counts = fold(names, counts, fresh)
    often = counts >= 2
    yield pd.DataFrame({"shingle": names[often].astype(np.int64), "n": counts[often]})


def common_shingles(rows: DataFrame) -> np.ndarray:
    """The most common shingles, rarest first; ``COMMON`` at most."""
    found = (
        in_frames(rows.select("key", "text"), _common_part, "shingle long, n long")
        .groupBy("shingle").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= COMMON_DOCS)
        .orderBy(F.col("n").desc(), "shingle").limit(COMMON)
        .toPandas()
    )
    return found["shingle"].to_numpy().astype(np.int64).astype(np.uint64)[::-1].copy()


def signatures(s: np.ndarray, common: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, int]:
    """Signatures of a set, and the number of its rare elements.

    ``common`` is sorted; ``rank`` is the place of each of them, rarest first.
    """
    n = len(s)
    at = np.searchsorted(common, s)
    at[at == len(common)] = 0
    is_common = common[at] == s if len(common) else np.zeros(n, bool)
    rare = s[~is_common]
    need = most_differences(n) + 1
    out, enough = [], True
    for band, partitions in bands(n):
        seed = np.uint64((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        spread = mix(rare + seed)
        part = spread % np.uint64(partitions)
        order = np.argsort(part, kind="stable")
        part, spread = part[order], spread[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, int)
        if len(first):
            sums = np.add.reduceat(mix(spread), first)
            signs = np.sort(mix(sums + mix(part[first] + seed)))
            out.append(signs[:need])
        enough = enough and len(first) >= need
    if not enough:
        # One element to a partition: n elements, of which those not shared come to a quarter at most.
        prefix = n - (n * MINIMUM + 99) // 100 + 1
        fine = np.concatenate([rare, s[is_common][np.argsort(rank[at[is_common]])]])[:prefix]
        out.append(mix(fine ^ np.uint64(0xD6E8FEB86659FD93)))
    return np.concatenate(out), len(rare)


def parity(s: np.ndarray) -> bytes:
    """Whether an odd number of elements fall on each of some bits, two or more for each element.

    Two such vectors differ in no more bits than the sets do in elements. Halves laid on
    each other give the vector of half the length.
    """
    n_bits = 1 << max(6, int(2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(n_bits - 1)).astype(np.int64), minlength=n_bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_link(left: bytes, n: int, right: bytes, m: int) -> bool:
    """False only for sets that differ in too many elements."""
    if len(left) < len(right):
        left, right = right, left
    while len(left) > len(right):
        half = len(left) // 2
        left = (int.from_bytes(left[:half]) ^ int.from_bytes(left[half:])).to_bytes(half)
    differ = (int.from_bytes(left) ^ int.from_bytes(right)).bit_count()
    return differ * (100 + MINIMUM) <= (100 - MINIMUM) * (n + m)


def _describe(common_cast):
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "n", "h1", "h2", "n_rare", "parity", "signs"]
        by_rank = common_cast.value
        order = np.argsort(by_rank)
        common, rank = by_rank[order], order
        rows, n_bytes = [], 0
        for (key,), s in _in_sets(batches):
            signs, n_rare = signatures(s, common, rank) if len(s) else (s, 0)
            rows.append((key, len(s), *set_key(s), n_rare, parity(s), signs.astype(np.int64)))
            n_bytes += 9 * len(signs) + 64
            if n_bytes > 1 << 22:
                yield pd.DataFrame(rows, columns=columns)
                rows, n_bytes = [], 0
        yield pd.DataFrame(rows, columns=columns)

    return describe


def _plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose parity vectors do not rule a link out."""
    narrow = sets.select("key", "n", "parity")
    both = pairs.join(narrow.toDF("a", "n", "left"), "a").join(narrow.toDF("b", "m", "right"), "b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["left"], batch["n"], batch["right"], batch["m"], strict=True)
            yield batch.loc[[may_link(*row) for row in rows], ["a", "b"]]

    return in_frames(both, compare, "a long, b long").distinct()


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b`` of the pairs that are linked; ``texts`` has ``key, text``.

    Only texts of the pairs are read into sets. A key with several texts is linked by any
    of them, as its rows are one document.
    """
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = kept(wanted, "jaccard-wanted")
    needed = texts.join(broadcast_if_small(wanted), "key", "left_semi")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, n_bytes = [], 0
        for (key,), s in _in_sets(batches):
            rows.append((key, s.tobytes()))
            n_bytes += len(rows[-1][1]) + 64
            if n_bytes > 1 << 22:
                yield pd.DataFrame(rows, columns=["key", "elements"])
                rows, n_bytes = [], 0
        yield pd.DataFrame(rows, columns=["key", "elements"])

    found = kept(in_frames(needed, sets, "key long, elements binary"), "jaccard-sets")
    both = (
        pairs.join(found.select(F.col("key").alias("a"), F.col("elements").alias("left")), "a")
        .join(found.select(F.col("key").alias("b"), F.col("elements").alias("right")), "b")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= MINIMUM * (len(x) + len(y) - shared))
            yield batch.loc[linked, ["a", "b"]]

    return in_frames(both, compare, "a long, b long")


def components(links: DataFrame, label: str = "jaccard") -> DataFrame:
    """``key, component`` of all keys in ``links`` (``a, b``): the smallest key reachable.

    In every round a key takes the smallest label among its neighbours', and then the
    label of that label; paths shorten by half or more. Each round is written out.
    """
    edges = kept(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{label}-edges",
    )
    labels = kept(
        edges.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.col("key")).alias("component")),
        f"{label}-labels",
    )
    while True:
        of_b = labels.select(F.col("key").alias("b"), F.col("component").alias("near"))
        near = edges.join(of_b, "b").groupBy(F.col("a").alias("key")).agg(F.min("near").alias("near"))
        hooked = labels.join(near, "key").select(
            "key", F.col("component").alias("old"), F.least("component", "near").alias("up")
        )
        jump = labels.select(F.col("key").alias("up"), F.col("component").alias("root"))
        moved = kept(
            hooked.join(jump, "up", "left").select(
                "key", "old", F.least(F.col("up"), F.coalesce("root", "up")).alias("component")
            ),
            f"{label}-labels",
        )
        labels = moved.select("key", "component")
        if moved.where("old != component").isEmpty():
            return labels


def jaccard_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id`` for every row."""
    # All Python work is done before the block ends; what is returned are joins of its results.
    with small_batches(docs.sparkSession):
        return _groups(docs, key, text)


def _groups(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    cast = docs.sparkSession.sparkContext.broadcast(common_shingles(rows))
    schema = "key long, n int, h1 long, h2 long, n_rare int, parity binary, signs array<long>"
    described = in_frames(rows, _describe(cast), schema)
    plain = kept(described, "jaccard-described")
    # Equal sets have one representative, the row with the smallest key.
    sets = plain.where("n > 0 and key is not null").groupBy("h1", "h2").agg(
        F.min(F.struct("key", "n", "n_rare", "signs")).alias("r")
    )
    members = kept(_shared_signatures(sets), "jaccard-members")
    texts = rows.where("key is not null")
    with_words = plain.where("n > 0 and key is not null")
    keys = kept(with_words.groupBy("h1", "h2").agg(F.min("key").alias("rep")), "jaccard-keys")
    first = kept(_plausible(_to_pivots(members), with_words), "jaccard-candidates")
    links = kept(_verify(first, texts), "jaccard-links")
    labels = components(links)
    rest = kept(_between_components(members, labels, with_words), "jaccard-candidates")
    if not rest.isEmpty():
        links = kept(links.union(_verify(rest, texts)), "jaccard-links")
        labels = components(links)
    # Keys with several rows tie their sets together too.
    same_key = plain.where("n > 0 and key is not null").select("key", "h1", "h2").distinct()
    tied = same_key.join(keys, ["h1", "h2"]).where("key != rep").select(F.col("key").alias("a"), F.col("rep").alias("b"))
    several = same_key.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    extra = kept(tied.join(several.select(F.col("key").alias("a")), "a", "left_semi"), "jaccard-tied")
    if not extra.isEmpty():
        labels = components(links.union(extra))
    labelled = keys.join(labels, F.col("rep") == F.col("key"), "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component")
    )
    own = plain.select("key", F.col("n").cast("long").alias("n_shingles"), "h1", "h2")
    joined = own.join(labelled, ["h1", "h2"], "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return joined.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"))


def _shared_signatures(sets: DataFrame) -> DataFrame:
    """``sign, key, n, n_rare`` of the signatures that several sets have."""
    exploded = sets.select(F.explode("r.signs").alias("sign"), "r.key", "r.n", "r.n_rare")
    order = Window.partitionBy("sign").orderBy("key")
    beside = exploded.withColumns({"before": F.lag("key").over(order), "after": F.lead("key").over(order)})
    return beside.where("before is not null or after is not null").drop("before", "after")


def _similar_sizes(a: str, b: str):
    return (F.least(a, b) * 100 >= F.greatest(a, b) * MINIMUM)


def _to_pivots(members: DataFrame) -> DataFrame:
    """``a, b``: every member with the two pivots that it shares most groups with.

    A group's pivot is the member with the smallest share of rare shingles, in a group of
    copies the one without changes. This only connects what it can; what is left in
    several components is compared in full afterwards.
    """
    order = Window.partitionBy("sign").orderBy(F.col("n_rare") / F.col("n"), "key")
    pivot = F.first(F.struct("key", "n")).over(order).alias("p")
    paired = members.select("key", "n", pivot)
    near = paired.where((F.col("key") != F.col("p.key")) & _similar_sizes("n", "p.n"))
    counted = near.groupBy("key", F.col("p.key").alias("pivot")).agg(F.count(F.lit(1)).alias("shared"))
    best = Window.partitionBy("key").orderBy(F.col("shared").desc(), "pivot")
    chosen = counted.withColumn("nth", F.row_number().over(best)).where("nth <= 2")
    return chosen.select(
        F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")
    ).distinct()


def _near_others(named: DataFrame) -> DataFrame:
    """Members of a group with another of similar size and a different component in it.

    In the order of sizes, the nearest member of another component is the one before, or
    after, the run of members with the own component.
    """
    runs = named
    for side, order in (("down", [F.col("n"), F.col("key")]), ("up", [F.desc("n"), F.desc("key")])):
        along = Window.partitionBy("sign").orderBy(*order)
        turn = F.when(F.lag("component").over(along) != F.col("component"), F.lag("n").over(along))
        so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        runs = runs.withColumn("_turn", turn).withColumn(side, F.last("_turn", ignorenulls=True).over(so_far))
    near = (F.col("down") * 100 >= F.col("n") * MINIMUM) | (F.col("n") * 100 >= F.col("up") * MINIMUM)
    return runs.where(near).select("sign", "key", "component", "n")


def _between_components(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: the pairs of a group in different components that may be linked.

    Groups with the same members are one. They come in blocks, and only pairs that parity
    vectors do not rule out become rows.
    """
    named = members.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
    near = kept(_near_others(named), "jaccard-open")
    # Similar sets share many signatures: of the groups with the same members one is enough.
    spread = near.groupBy("sign").agg(
        F.count(F.lit(1)).alias("members"),
        F.bit_xor(F.xxhash64("key")).alias("x1"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("x2"),
    )
    open_groups = spread.groupBy("members", "x1", "x2").agg(F.min("sign").alias("sign")).select("sign")
    left = near.join(open_groups, "sign").select("sign", "key", "component")
    full = left.join(sets.select("key", "n", "parity").dropDuplicates(["key", "n", "parity"]), "key")
    place = F.row_number().over(Window.partitionBy("sign").orderBy("n", "key"))
    columns = ["key", "component", "n", "parity"]
    parts = kept(
        full.withColumn("block", F.floor((place - 1) / BLOCK).cast("int"))
        .withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("sign")))
        .groupBy("sign", "block")
        .agg(F.collect_list(F.struct(*columns)).alias("rows"), F.max("members").alias("members"))
        .select("sign", "block", "members", *[F.col(f"rows.{c}").alias(c) for c in columns]),
        "jaccard-blocks",
    )

    def beside(df: DataFrame) -> DataFrame:
        return df.select("sign", F.col("block").alias("block_2"), *[F.col(c).alias(f"{c}_2") for c in columns])

    # A block meets itself where it is; only groups of several blocks are joined.
    alone = parts.select(*columns, *[F.col(c).alias(f"{c}_2") for c in columns])
    large = parts.where(F.col("members") > BLOCK)
    met = large.join(beside(large), "sign").where("block < block_2")
    met = alone.unionByName(met.select(alone.columns))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                one = (row.key, row.component, row.n, row.parity)
                two = (row.key_2, row.component_2, row.n_2, row.parity_2)
                a, b = _open_pairs(*map(np.asarray, one[:3]), one[3], *map(np.asarray, two[:3]), two[3])
                yield pd.DataFrame({"a": a, "b": b})

    return in_frames(met, compare, "a long, b long").distinct()


def _folded(vectors: list[bytes], length: int) -> np.ndarray:
    """Parity vectors of a common length as rows of words, halves laid on each other down to another."""
    rows = np.frombuffer(b"".join(vectors), np.uint64).reshape(len(vectors), -1)
    while rows.shape[1] * 8 > length:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _open_pairs(keys, components, sizes, vectors, keys_2, components_2, sizes_2, vectors_2):
    """Keys of the pairs that are in different components and may be linked, the smaller first."""
    lengths = np.array([len(v) for v in vectors])
    lengths_2 = np.array([len(v) for v in vectors_2])
    found = [np.zeros((0, 2), dtype=np.int64)]
    for x in np.unique(lengths):
        for y in np.unique(lengths_2):
            mine, theirs = np.flatnonzero(lengths == x), np.flatnonzero(lengths_2 == y)
            left = _folded([vectors[i] for i in mine], min(x, y))
            right = _folded([vectors_2[i] for i in theirs], min(x, y))
            n, m = sizes[mine].astype(np.int64), sizes_2[theirs].astype(np.int64)
            for at, i in enumerate(mine):
                differ = np.bitwise_count(left[at] ^ right).sum(axis=1, dtype=np.int64)
                fits = differ * (100 + MINIMUM) <= (100 - MINIMUM) * (n[at] + m)
                fits &= components[i] != components_2[theirs]
                others = keys_2[theirs[fits]]
                found.append(np.stack([np.full(len(others), keys[i]), others], axis=1))
    pairs = np.sort(np.concatenate(found), axis=1)
    return pairs[:, 0], pairs[:, 1]


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their group, with their own columns only.

    Rows without shingles or key stay; of rows with the same smallest key one stays. Texts
    are only shuffled when the keys that go are too many to be broadcast, or for repeated keys.
    """
    k = free_name(docs, "_key")
    with scratch_scope(docs.sparkSession):
        labelled = jaccard_groups(docs, key, text).where("n_shingles > 0")
        groups = kept(labelled.select(F.col(key).alias(k), "component_id"), "jaccard-groups", lasting=True)
    gone = groups.where(F.col(k) != F.col("component_id")).select(k).distinct()
    first = docs.join(broadcast_if_small(gone), F.col(f"`{key}`") == F.col(k), "left_anti")
    again = kept(
        groups.where(F.col(k) == F.col("component_id")).groupBy(k).agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(k),
        "jaccard-repeated",
    )
    if again.isEmpty():
        return first
    same = F.col(f"`{key}`") == F.col(k)
    others = first.join(broadcast_if_small(again), same, "left_anti")
    several = first.join(broadcast_if_small(again), same, "left_semi")
    place = F.row_number().over(Window.partitionBy(F.col(f"`{key}`")).orderBy(F.col(f"`{text}`")))
    with_words = F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    ranked = several.withColumn(f"{k}_n", place)
    lowest = F.min(F.when(with_words, F.col(f"{k}_n"))).over(Window.partitionBy(F.col(f"`{key}`")))
    chosen = ranked.withColumn(f"{k}_low", lowest).where(~with_words | (F.col(f"{k}_n") == F.col(f"{k}_low")))
    return others.unionByName(chosen.select(*[F.col(f"`{c}`") for c in docs.columns]))
