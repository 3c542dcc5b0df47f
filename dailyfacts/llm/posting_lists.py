"""Approximate nearest neighbours by balanced posting lists.

Centroids come from k-means over a bounded sample, its large clusters split again until
none holds more than a fair share. A neighbourhood graph over the centroids, broadcast
with them, is searched by best-first walks. Every vector is posted to its nearest
centroid and, near a border, to further ones whose distance is at most
``REPLICATE`` times the nearest and which no closer list already stands for. A query
takes the nearest lists until they hold ``k`` vectors besides itself, replicas counted
once, and reads all lists whose centroids are at most ``PROBE`` times as far as those.

Lists are kept as blocks of bounded size, so a list that holds a third of all vectors is
searched by many tasks; each gives its best ``k`` for each query, and those are merged.

Distances of results are Euclidean in double precision on the vectors as given, ties go
to the smaller id. Defined results: rows with a null key take no part, and vectors that are null, zero, or hold a null or a
component that is not finite take no part, nor do those of another length than most of
the sample; repeated vectors are all posted; with fewer candidates than ``k`` all are
given; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailyfacts.llm.common import kept

#: Vectors that the centroids are fitted on, at most, and centroids, at most.
SAMPLE = 20_000
CENTROIDS = 128
#: Links of a centroid in the graph, and how many candidates a walk keeps at least.
LINKS = 16
WIDTH = 48
REPLICATE = 1.15
REPLICAS = 4
PROBE = 1.35
#: Vectors of a block, and queries that meet it at a time.
BLOCK = 2048
QUERIES = 256


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, v`` of the vectors that take part; the rest go."""
    v = F.col(vector)
    good = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(key).alias("key"), v.cast("array<double>").alias("v")).where(
        F.col(key).isNotNull() & v.isNotNull() & F.coalesce(good, F.lit(False))
    )


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    owner = np.zeros(len(x), dtype=int)
    for _ in range(rounds):
        owner = np.concatenate([_squares(part, centres).argmin(1) for part in np.array_split(x, len(x) // 4096 + 1)])
        counts = np.bincount(owner, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, x)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres, owner


def balanced_centroids(x: np.ndarray, k: int) -> np.ndarray:
    """About ``k`` centroids; a cluster of more than twice its fair share is split."""
    rng = np.random.default_rng(11)
    distinct = np.unique(x, axis=0)
    k = max(1, min(k, len(distinct) // 8))
    fair, done, todo = len(distinct) / k, [], [(distinct, k)]
    while todo:
        part, n = todo.pop()
        centres, owner = _kmeans(part, min(n, len(part)), rng)
        for i in range(len(centres)):
            own = part[owner == i]
            if len(own) > 2 * fair and len(own) < len(part):
                todo.append((own, 2))
            elif len(own):
                done.append(own.mean(0))
    return np.array(done)


def neighbour_graph(centres: np.ndarray, links: int = LINKS) -> np.ndarray:
    """For each centroid its nearest ones, the first step of a ring through all added."""
    n = len(centres)
    near = np.argsort(_squares(centres, centres), axis=1, kind="stable")[:, 1 : links + 1]
    ring = (np.arange(n)[:, None] + np.array([1, max(1, n // 7)])[None, :]) % n
    return np.concatenate([near, ring], axis=1)


def _holding(best: list[tuple[float, int]], held: np.ndarray | None, need: int) -> float:
    """How far lists, nearest first, go until they hold ``need`` vectors, infinite if never.

    Without ``held`` any list holds enough.
    """
    if held is None:
        return best[0][0]
    total = 0
    for d, c in best:
        total += held[c]
        if total >= need:
            return d
    return np.inf


def walk(
    q: np.ndarray, centres: np.ndarray, graph: np.ndarray, ratio: float, width: int = WIDTH,
    held: np.ndarray | None = None, need: int = 1,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Centroids found by a best-first walk, nearest first, with distances, and the bound.

    The bound is ``ratio`` times the distance of the list with which the nearest ones hold
    ``need`` vectors. The walk goes on until the next centroid is beyond the nearest
    ``width`` and also beyond the bound.
    """
    entry = 0
    seen = {entry}
    d = float(np.linalg.norm(centres[entry] - q))
    ahead, best = [(d, entry)], [(d, entry)]
    bound, reach = ratio * _holding(best, held, need), np.inf
    while ahead:
        d, here = heapq.heappop(ahead)
        if d > reach:
            break
        fresh = [c for c in dict.fromkeys(graph[here].tolist()) if c not in seen]
        seen.update(fresh)
        for c, far in zip(fresh, np.sqrt(((centres[fresh] - q) ** 2).sum(1)) if fresh else (), strict=True):
            if far <= reach:
                heapq.heappush(ahead, (float(far), c))
                bisect.insort(best, (float(far), c))
                bound = ratio * _holding(best, held, need)
                reach = max(best[width - 1][0] if len(best) >= width else np.inf, bound)
    return np.array([c for _, c in best]), np.array([d for d, _ in best]), bound


def _lists(
    cast, ratio: float, most: int | None, spread: bool, held: np.ndarray | None = None, need: int = 1
):
    """Rows with a list each: the nearest one and those within the bound of the walk.

    ``nearest`` says which is the nearest one. With ``spread`` a list is left out when one
    already chosen is closer to it than the vector.
    """
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, graph = cast.value
        for batch in batches:
            rows, lists, nearest = [], [], []
            for i, v in enumerate(batch["v"]):
                q = np.asarray(v, dtype=float)
                if len(q) != centres.shape[1]:
                    continue
                found, far, bound = walk(q, centres, graph, ratio, held=held, need=need)
                chosen: list[int] = []
                for c, d in zip(found, far, strict=True):
                    if chosen and (d > bound or most and len(chosen) >= most):
                        break
                    if spread and any(np.linalg.norm(centres[c] - centres[o]) < d for o in chosen):
                        continue
                    chosen.append(int(c))
                rows += [i] * len(chosen)
                lists += chosen
                nearest += [c == chosen[0] for c in chosen]
            yield batch.iloc[rows].assign(list=lists, nearest=nearest)

    return assign


LISTED = "key long, v array<double>, list int, nearest boolean"


class Index:
    """Centroids with their graph, the posting lists as blocks, and how many keys each holds.

    ``held`` counts a key in one list only, so those of several lists add up.
    """

    def __init__(self, centres: np.ndarray, graph: np.ndarray, blocks: DataFrame, cast, held: np.ndarray):
        self.centres, self.graph, self.blocks, self.cast, self.held = centres, graph, blocks, cast, held


def build(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
    sample: int = SAMPLE, centroids: int = CENTROIDS, block: int = BLOCK,
) -> Index | None:
    """An index of every usable vector, None when there is none."""
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    drawn = rows.orderBy(F.xxhash64("key", F.lit("ann")), "key").limit(sample).select("v").toArrow()["v"]
    lengths = np.array([len(v) for v in drawn])
    if not len(lengths):
        return None
    length = np.bincount(lengths).argmax()
    x = np.array([v.as_py() for v, n in zip(drawn, lengths, strict=True) if n == length], dtype=float)
    centres = balanced_centroids(x, centroids)
    graph = neighbour_graph(centres)
    cast = spark.sparkContext.broadcast((centres, graph))
    posted = kept(
        rows.mapInPandas(_lists(cast, REPLICATE, REPLICAS, True), LISTED), "ann-postings"
    )
    held = np.zeros(len(centres), dtype=np.int64)
    once = posted.where("nearest").groupBy("key").agg(F.min("list").alias("list"))
    for row in once.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        held[row["list"]] = row["n"]
    sizes = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_blocks"))
    dealt = posted.join(F.broadcast(sizes), "list").withColumn(
        "block", F.pmod(F.xxhash64("key", "v"), F.col("n_blocks")).cast("int")
    )
    # About ``block`` vectors come together, whatever the size of a list.
    blocks = dealt.groupBy("list", "block").agg(
        F.collect_list("key").alias("keys"), F.flatten(F.collect_list("v")).alias("values")
    )
    return Index(centres, graph, kept(blocks, "ann-blocks"), cast, held)


def search(
    index: Index | None, vectors: DataFrame, wanted: Column, key: str = "vec_id", vector: str = "embedding",
    k: int = 10, probe: float = PROBE,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest others of every wanted row."""
    spark = vectors.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = usable(vectors.where(wanted), key, vector)
    probed = queries.mapInPandas(_lists(index.cast, probe, None, False, index.held, k + 1), LISTED)
    packed = probed.withColumn("pack", F.pmod(F.xxhash64("key"), F.lit(1 << 20)))
    numbered = packed.withColumn(
        "pack", F.floor((F.row_number().over(Window.partitionBy("list").orderBy("pack", "key")) - 1) / QUERIES)
    )
    groups = numbered.groupBy("list", "pack").agg(
        F.collect_list("key").alias("q_keys"), F.flatten(F.collect_list("v")).alias("q_values")
    )
    meetings = groups.join(index.blocks, "list").select("q_keys", "q_values", "keys", "values")
    width = index.centres.shape[1]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = np.asarray(row.keys, dtype=np.int64)
                order = np.argsort(ids, kind="stable")
                ids, b = ids[order], np.asarray(row.values, dtype=float).reshape(len(ids), width)[order]
                # Rows of one key count once.
                begins = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
                names = ids[begins]
                q_ids = np.asarray(row.q_keys, dtype=np.int64)
                q = np.asarray(row.q_values, dtype=float).reshape(len(q_ids), width)
                rough = _squares(q, b)
                least = np.minimum.reduceat(rough, begins, axis=1)
                # Rounding of the fast distances is far below this slack.
                slack = 1e-12 * width * ((q * q).sum(1) + (b * b).sum(1).max())
                out = []
                for i, own in enumerate(q_ids):
                    others = names != own
                    limit = np.partition(least[i][others], k - 1)[k - 1] if others.sum() > k else np.inf
                    near = np.flatnonzero((ids != own) & (rough[i] <= limit + slack[i]))
                    exact = np.sqrt(((b[near] - q[i]) ** 2).sum(1))
                    top = np.lexsort((ids[near], exact))
                    top = top[np.sort(np.unique(ids[near][top], return_index=True)[1])][:k]
                    out.append(pd.DataFrame({"query_id": own, "vec_id": ids[near][top], "score": exact[top]}))
                yield pd.concat(out)

    found = meetings.mapInPandas(compare, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
