"""Near copies by 64-bit SimHash fingerprints, joined with themselves over a binary trie.

A fingerprint has a bit set where more than half of the text's shingle hashes have it; the
shingles are of ``WORDS`` words, repeats included. Fingerprints link at ``MOST`` or fewer
differing bits.

The distinct fingerprints in order are a binary trie: a node is a run of them that share a
prefix. The join goes down the trie in pairs of nodes, adds up the bits in which their
prefixes differ, and drops a pair when these exceed ``MOST``. It does so twice:

- In Spark the trie is descended ``STEP`` bits at a time. The pairs of nodes are a table, and
  a step joins both sides of each pair with the counts of their children. Pairs whose nodes
  are small enough are done; the others go on. So a part of the trie that holds most of the
  fingerprints is divided further, and no node that a task gets is large.
- The fingerprints of the nodes of a finished pair meet in one task, which goes on bit by
  bit, for many pairs of nodes at once, down to pairs of fingerprints.

A task gives out a spanning forest of the links that it finds, not all of them: a group of
many fingerprints near each other gives as many rows as it has members, not pairs.
Components are those of the fingerprints, so copies are never expanded.

Defined results: a text without words, null or empty, has the fingerprint zero and links like
any other; rows with equal keys stay rows of their own; a row with a null key links, too, and
has the smallest key of its component, or null if there is none; texts are read whole, in
slices; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from dailyfacts.llm.common import kept
from dailyfacts.llm.partenum import components

WORDS = 3
SEED = 42
BITS = 64
#: Most differing bits of a link.
MOST = 3
#: Bits by which the trie of all fingerprints is descended at a time.
STEP = 2
#: Fingerprints of a node that a task may get.
NODE = 1 << 14
#: Words that are hashed in one go, and pairs of nodes that are looked at in one go.
SLICE = 1 << 17
FRONT = 1 << 18


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of the shingles of a run of lower-case words with at least one shingle."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    cuts = map(slice, starts[: len(words) - WORDS + 1].tolist(), ends[WORDS - 1 :].tolist())
    return np.fromiter(map(xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64)


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, from the highest down."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None) -> int:
    """The fingerprint of a whole text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        return xxh64_intdigest(b" ".join(words), SEED)
    counts, n = np.zeros(BITS, dtype=np.int64), len(words) - WORDS + 1
    for at in range(0, n, SLICE):
        counts += _set_bits(shingle_hashes(words[at : at + SLICE + WORDS - 1]))
    return int.from_bytes(np.packbits(2 * counts > n).tobytes())


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(found.view(np.int64))], ["key", "print"]
        )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, print`` of every row; the fingerprint as a signed number."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(_prints, f"key {dict(rows.dtypes)['key']}, print long")


def _meet(x: np.ndarray, y: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the sorted x and y of the linked pairs; of one array, each pair once.

    Fronts are pairs of trie nodes at one depth: ranges in x and in y, the prefixes of which
    differ in ``err`` bits. A front that has grown too large is halved.
    """
    def front(a0, a1, b0, b1, err, bit):
        return [np.asarray(v, dtype=np.int64) for v in (a0, a1, b0, b1, err)], bit

    if not len(x) or not len(y):
        return
    # The prefixes that all of x, and all of y, share are walked at once.
    todo = [front([0], [len(x)], [0], [len(y)], [0], BITS)]
    while todo:
        (a0, a1, b0, b1, err), bit = todo.pop()
        if len(a0) > FRONT:
            half = len(a0) // 2
            todo += [front(*[v[part] for v in (a0, a1, b0, b1, err)], bit) for part in (slice(half, None), slice(half))]
            continue
        small = (a1 - a0) * (b1 - b0) <= 16
        if bit == 0:
            small[:] = True
        if small.any():
            yield from _pairs(x, y, *[v[small] for v in (a0, a1, b0, b1)], same)
            a0, a1, b0, b1, err = (v[~small] for v in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        bit -= 1
        am, bm = _split(x, a0, a1, bit), _split(y, b0, b1, bit)
        sides = [
            (a0, am, b0, bm, err, None), (am, a1, bm, b1, err, None),
            (a0, am, bm, b1, err + 1, None), (am, a1, b0, bm, err + 1, (a0, b0)),
        ]
        children = []
        for c0, c1, d0, d1, e, mirrored in sides:
            keep = (c1 > c0) & (d1 > d0) & (e <= MOST)
            if same and mirrored is not None:
                # A node with itself: its right child with its left is the left with the right.
                keep &= mirrored[0] != mirrored[1]
            children.append([v[keep] for v in (c0, c1, d0, d1, e)])
        todo.append(([np.concatenate(v) for v in zip(*children, strict=True)], bit))


def _split(x: np.ndarray, begin: np.ndarray, end: np.ndarray, bit: int) -> np.ndarray:
    """Where the node's fingerprints with the bit set begin."""
    one = np.uint64(1) << np.uint64(bit)
    floor = (x[begin] | (one - np.uint64(1)) | one) ^ (one - np.uint64(1))
    return np.clip(np.searchsorted(x, floor), begin, end)


def _pairs(x, y, a0, a1, b0, b1, same) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The linked pairs among small ranges, found by comparing all of a range with all of the other."""
    wide, high = a1 - a0, b1 - b0
    for i in range(int(wide.max())):
        for j in range(int(high.max())):
            at = (i < wide) & (j < high)
            a, b = a0[at] + i, b0[at] + j
            linked = np.bitwise_count(x[a] ^ y[b]) <= MOST
            if same:
                linked &= a < b
            if linked.any():
                yield a[linked], b[linked]


class Forest:
    """A spanning forest of numbered places, grown a batch of links at a time."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def add(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """The links that connect what was not connected."""
        new = []
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = self.root(x), self.root(y)
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                new.append((x, y))
        return new


def node_links(x: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of links that connect all that the two sorted nodes' links connect."""
    forest, offset = Forest(len(x) + (0 if same else len(y))), 0 if same else len(x)
    found = [link for a, b in _meet(x, y, same) for link in forest.add(a, b + offset)]
    both = x if same else np.concatenate([x, y])
    places = np.array(found, dtype=np.int64).reshape(-1, 2)
    return both[places[:, 0]], both[places[:, 1]]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in ("left", "right")], strict=True)
        for left, right in rows:
            x = np.sort(np.frombuffer(left, ">u8").astype(np.uint64))
            y = x if right is None else np.sort(np.frombuffer(right, ">u8").astype(np.uint64))
            a, b = node_links(x, y, right is None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )


def _prefix(depth: int):
    return F.shiftrightunsigned("print", BITS - depth) if depth else F.lit(0).cast("long")


def finished_pairs(prints: DataFrame, node: int = NODE) -> DataFrame:
    """``depth, a, b``: pairs of trie nodes within ``MOST`` bits that no task finds too large.

    Every pair of fingerprints within ``MOST`` bits is in exactly one of them. A pair goes on
    while one of its nodes is larger than ``node``; both sides go down together.
    """
    done = None
    going = prints.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0).alias("err"))
    for depth in range(STEP, BITS + 1, STEP):
        nodes = kept(
            prints.groupBy(_prefix(depth).alias("child")).agg(F.count(F.lit(1)).alias("n")), "trie-nodes"
        )
        below = nodes.withColumn("parent", F.shiftrightunsigned("child", STEP) if depth > STEP else F.lit(0).cast("long"))
        left = below.select(F.col("parent").alias("a"), F.col("child").alias("c"), F.col("n").alias("m"))
        right = below.select(F.col("parent").alias("b"), F.col("child").alias("d"), "n")
        # A node with itself: each pair of its children once.
        differ = F.col("err") + F.bit_count(F.col("c").bitwiseXOR(F.col("d")).bitwiseAND(F.lit((1 << STEP) - 1)))
        pairs = kept(
            going.join(left, "a").join(right, "b").where("a != b or c <= d")
            .select(F.col("c").alias("a"), F.col("d").alias("b"), differ.alias("err"), "m", "n")
            .where(F.col("err") <= MOST),
            "trie-pairs",
        )
        small = (F.col("m") <= node) & (F.col("n") <= node)
        ready = pairs.where(small).select(F.lit(depth).alias("depth"), "a", "b")
        done = ready if done is None else done.unionByName(ready)
        going = pairs.where(~small).select("a", "b", "err")
        if going.isEmpty():
            break
    return done


def links(prints: DataFrame, node: int = NODE) -> DataFrame:
    """``a, b``: links of distinct fingerprints (a column ``print``) that span their components."""
    pairs = kept(finished_pairs(prints, node), "trie-finished")
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    depths = [r["depth"] for r in pairs.select("depth").distinct().orderBy("depth").collect()]
    found = None
    for depth in depths:
        at = pairs.where(F.col("depth") == depth)
        body = F.array_join(F.transform(F.collect_list("print"), lambda p: F.lpad(F.hex(p), 16, "0")), "")
        wanted = at.select(F.col("a").alias("node")).union(at.select(F.col("b").alias("node"))).distinct()
        nodes = (
            prints.withColumn("node", _prefix(depth)).join(wanted, "node", "left_semi")
            .groupBy("node").agg(F.unhex(body).alias("body"))
        )
        nodes = kept(nodes, "trie-bodies")
        # The number of partitions is given, so that few bytes still are many tasks.
        met = (
            at.repartition(tasks, "a").join(nodes.withColumnsRenamed({"node": "a", "body": "left"}), "a")
            .repartition(tasks, "b").join(nodes.withColumnsRenamed({"node": "b", "body": "right"}), "b")
        )
        other = F.when(F.col("a") != F.col("b"), F.col("right"))
        here = met.select("left", other.alias("right")).mapInArrow(_solve, "a long, b long")
        found = here if found is None else found.unionByName(here)
    return found


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", node: int = NODE) -> DataFrame:
    """``key, fingerprint, component_id`` of every row; the fingerprint as 16 hexadecimal digits."""
    rows = kept(fingerprints(docs, key, text), "simhash-rows")
    first = kept(rows.groupBy("print").agg(F.min("key").alias("first")), "simhash-prints")
    if first.isEmpty():
        labelled = first.withColumn("component", F.col("first"))
    else:
        linked = kept(links(first.select("print"), node), "simhash-links")
        labels = components(linked, "simhash").withColumnsRenamed({"key": "print", "component": "group"})
        grouped = first.join(labels, "print", "left").withColumn("group", F.coalesce("group", "print"))
        smallest = grouped.groupBy("group").agg(F.min("first").alias("component"))
        labelled = grouped.join(smallest, "group").select("print", "component")
    return rows.join(labelled, "print").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
