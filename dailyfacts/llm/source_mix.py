"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Targets: sources share a multiple of all words by weight; a source stops at a
   multiple of its own words, and the excess goes to the others by weight.
2. Blocks: documents fall into blocks of their source by hash. A source is drawn in
   passes over its blocks: whole passes, then one over a part of the blocks in permuted
   order, the last of which gives only as many words as are missing.
3. Tree: the draws of all sources are halved at random, level by level, until there is
   one node for each output shard. Halving at random without replacement gives counts
   by source that follow the multivariate hypergeometric law, and the counts of all
   nodes of a level add up to the exact quotas.
4. Permuted blocks: the anonymous draws of a source are matched with its permuted
   blocks, so shards get disjoint draws. Inside a shard rows are ordered by hash.

Random choices are hashes of a seed and names, so reruns agree. Blocks and draws are
bounded by ``blocks`` plus a few for each source; only they are ordered as a whole.
Documents are ordered only inside the one block of each source that is drawn in part.

Defined results: a null text has no words and is never drawn; a null source is a source
of its own, ordered last; a source without words has target 0; repeated rows are mixed
as rows of their own; an empty table gives no rows. Columns other than the key, text
and source are only read by ``mixed_documents``, which keeps them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailyfacts.llm.common import free_name, kept, words
from dailyfacts.operators.joins import broadcast_if_small

#: What the sources together are to give, as a multiple of all words.
SHARE = 1.5
#: Weights of the sources in order of their names, repeated as often as needed.
WEIGHTS = (3, 1, 2)
#: A target is at most so many times the words of its source.
CAP = 2
#: Output shards and blocks over all sources.
SHARDS = 16
BLOCKS = 1024
SEED = "mix-1"


def _hash(*parts) -> Column:
    """Sortable pseudo-random text from the seed and some columns or constants."""
    columns = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns]).cast("binary"))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def sizes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", label: str | None = None
) -> DataFrame:
    """``key, label, source, size`` and ``name``, the source as a key without nulls."""
    return docs.select(
        F.col(key).alias("key"),
        F.col(label or key).alias("label"),
        F.col(source).alias("source"),
        F.size(words(F.col(text))).cast("long").alias("size"),
        _name(source),
    )


def _name(source: str) -> Column:
    """The source as a key without nulls."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("name")


def source_targets(
    totals: DataFrame, share: float = SHARE, weights: Sequence[int] = WEIGHTS, cap: float = CAP
) -> DataFrame:
    """``totals`` (a row for each source: name, source, source_size, n_docs) with ``target``.

    Sources are filled in the order in which they reach their cap: those before a place
    stop at the cap, the others share the rest by weight, and the first place at which
    that keeps all below the cap is the answer.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weighted = totals.withColumn(
        "weight", F.get(cycle, (F.row_number().over(order) - 1) % len(weights)).cast("double")
    ).withColumn("cap", F.col("source_size") * float(cap))
    # The level of the common rate at which a source is full.
    rated = weighted.withColumn("full_at", F.col("cap") / F.col("weight"))
    whole = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    after = whole.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = rated.withColumn(
        "rate",
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    fits = F.when(F.col("rate") <= F.col("full_at"), F.col("place"))
    found = filled.withColumn("place", F.row_number().over(whole)).withColumn(
        "common", F.min_by("rate", fits).over(everything)
    )
    return found.withColumn(
        "target",
        F.when(F.col("common").isNull(), F.col("cap")).otherwise(
            F.least(F.col("cap"), F.col("common") * F.col("weight"))
        ),
    ).drop("weight", "cap", "full_at", "rate", "common", "place")


def _counted(targets: DataFrame, blocks: int) -> DataFrame:
    """``name, source_size, target, n_blocks`` of every source."""
    everything = F.greatest(F.sum("source_size").over(Window.partitionBy()), F.lit(1))
    n_blocks = F.greatest(
        F.lit(1),
        F.least(F.col("n_docs"), F.round(F.col("source_size") * blocks / everything).cast("long")),
    )
    return targets.select("name", "source_size", "target", n_blocks.alias("n_blocks"))


def _blocks(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """``rows`` (with ``name, label``) with their source's columns and their block."""
    joined = rows.join(counted, "name")
    return joined.withColumn("block", _number(_hash(SEED, "block", F.col("label"))) % F.col("n_blocks"))


def _draws(in_blocks: DataFrame) -> DataFrame:
    """``name, block, pass, words``: how many words a pass takes from a block, at most all."""
    block = in_blocks.groupBy("name", "block").agg(
        F.sum("size").alias("block_size"),
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
    )
    turn = Window.partitionBy("name").orderBy(_hash(SEED, "order", F.col("name"), F.col("block")), "block")
    aim = F.floor(F.col("target")).cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(aim / F.col("source_size"))).otherwise(0).cast("int")
    ordered = (
        block.where("block_size > 0")
        .withColumn("whole", whole)
        .withColumn("rest", aim - F.col("whole") * F.col("source_size"))
        .withColumn(
            "before",
            F.sum("block_size").over(turn.rowsBetween(Window.unboundedPreceding, 0)) - F.col("block_size"),
        )
    )
    passes = F.transform(F.sequence(F.lit(0), F.col("whole")), lambda i: i)
    each = ordered.withColumn("pass", F.explode(passes))
    words = F.when(F.col("pass") < F.col("whole"), F.col("block_size")).otherwise(
        F.least(F.col("block_size"), F.greatest(F.lit(0), F.col("rest") - F.col("before")))
    )
    return each.withColumn("words", words).where("words > 0").select(
        "name", "block", "pass", "words", (F.col("words") == F.col("block_size")).alias("all_of_it")
    )


def split_tree(counts: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``name, nth, shard``: the draws of each source, still without blocks, dealt to shards.

    ``counts`` has ``name, n``. Each node sends a random share of its draws, exactly in
    proportion to the shards on that side, to the left, and the rest to the right.
    """
    units = counts.select("name", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("nth"))
    tree = units.withColumns({"first": F.lit(0), "n_shards": F.lit(shards)})
    level = 0
    while 1 << level < shards:
        node = Window.partitionBy("first", "n_shards")
        rank = F.row_number().over(
            node.orderBy(_hash(SEED, "tree", level, F.col("name"), F.col("nth")), "name", "nth")
        )
        left = F.floor(F.col("n_shards") / 2).cast("int")
        quota = F.when(F.col("n_shards") == 1, F.lit(1 << 30)).otherwise(
            F.floor(F.count(F.lit(1)).over(node) * left / F.col("n_shards"))
        )
        tree = tree.withColumn("goes_left", rank <= quota).withColumns(
            {
                "first": F.when(F.col("goes_left"), F.col("first")).otherwise(F.col("first") + left),
                "n_shards": F.when(F.col("goes_left"), F.greatest(left, F.lit(1))).otherwise(
                    F.col("n_shards") - left
                ),
            }
        ).drop("goes_left")
        level += 1
    return tree.select("name", "nth", F.col("first").alias("shard"))


def _dealt(
    sized: DataFrame, share: float, weights: Sequence[int], cap: float, shards: int, blocks: int
) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets and numbers of blocks, and the passes of every drawn block.

    The latter are ``name, block, passes`` with ``pass, shard, words, all_of_it`` in each pass.
    """
    totals = sized.groupBy("name").agg(
        F.first("source").alias("source"),
        F.sum("size").alias("source_size"),
        F.count(F.lit(1)).alias("n_docs"),
    )
    counted = kept(_counted(source_targets(totals, share, weights, cap), blocks), "mix-targets")
    draws = kept(_draws(_blocks(sized, counted)), "mix-draws")
    permuted = draws.withColumn(
        "nth",
        F.row_number().over(
            Window.partitionBy("name").orderBy(
                _hash(SEED, "draw", F.col("name"), F.col("block"), F.col("pass")), "block", "pass"
            )
        ),
    )
    counts = draws.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    dealt = permuted.join(split_tree(counts, shards), ["name", "nth"])
    # At most one draw for each pass, so the lists are short.
    by_block = dealt.groupBy("name", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard", "words", "all_of_it"))).alias("passes")
    )
    return counted, kept(by_block, "mix-blocks")


def _with_room(partial: DataFrame) -> DataFrame:
    """``partial``, documents of blocks drawn in part, with the words that this draw takes of each.

    Documents are in permuted order, until the words of the draw are taken.
    """
    order = Window.partitionBy("name", "block").orderBy(_hash(SEED, "document", F.col("label")), "key")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    part = F.filter("passes", lambda p: ~p["all_of_it"])
    room = F.greatest(F.lit(0), F.get(part, F.lit(0))["words"] - F.col("before"))
    return partial.withColumn("before", before).withColumn("room", F.least(F.col("size"), room))


def _in_part() -> Column:
    return F.coalesce(F.exists("passes", lambda p: ~p["all_of_it"]), F.lit(False))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    label: str | None = None,
    share: float = SHARE,
    weights: Sequence[int] = WEIGHTS,
    cap: float = CAP,
    shards: int = SHARDS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """A row for every document: ``key, size, source_size, target, taken, draws``.

    ``draws`` holds ``shard, words, pass`` for every pass that takes words of it, and
    ``taken`` is their sum. Random choices go by the ``label``
    column, which is the key if none is named.
    """
    sized = kept(sizes(docs, key, text, source, label), "mix-sizes")
    counted, by_block = _dealt(sized, share, weights, cap, shards, blocks)
    drawn = _blocks(sized, counted).join(by_block, ["name", "block"], "left")
    columns = ["key", "size", "source_size", "target", "passes"]
    whole = drawn.where(~_in_part()).select(*columns, F.lit(0).cast("long").alias("room"))
    partial = _with_room(drawn.where(_in_part())).select(*columns, "room")
    rows = whole.unionByName(partial)
    places = F.transform(
        "passes",
        lambda p: F.struct(
            p["shard"].alias("shard"),
            F.when(p["all_of_it"], F.lit(-1).cast("long")).otherwise(F.lit(0).cast("long")).alias("words"),
            p["pass"].alias("pass"),
        ),
    )
    # Element-wise lambdas see no other column, so sizes come in by zipping.
    n = F.size("passes")
    zipped = F.zip_with(
        places,
        F.array_repeat(F.struct(F.col("size").alias("size"), F.col("room").alias("room")), n),
        lambda p, d: F.struct(
            p["shard"].alias("shard"),
            F.when(p["words"] < 0, d["size"]).otherwise(d["room"]).alias("words"),
            p["pass"].alias("pass"),
        ),
    )
    draws_of = F.coalesce(F.filter(zipped, lambda p: p["words"] > 0), F.expr(
        "cast(array() as array<struct<shard: int, words: bigint, pass: int>>)"
    ))
    out = rows.withColumn("draws", draws_of)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    return out.select(
        F.col("key").alias(key), "size", "source_size", "target", taken.alias("taken"), "draws"
    )


def mixed_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    share: float = SHARE,
    weights: Sequence[int] = WEIGHTS,
    cap: float = CAP,
    shards: int = SHARDS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """The mix itself, in columns of ``docs``: a document once for every draw.

    A draw of part of a document gives its leading words, one blank apart; there is at
    most one such document for each source. Rows are ordered by shard, and inside by hash.

    Texts are shuffled once, into that order: a document's block follows from its key and
    source, and the passes of the blocks are a small table. Only the documents of blocks
    that are drawn in part, one for each source, are joined with their words besides.
    """
    row = free_name(docs, "_row")
    numbered = kept(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    sized = kept(sizes(numbered, row, text, source, key), "mix-sizes")
    counted, by_block = _dealt(sized, share, weights, cap, shards, blocks)
    of_part = by_block.where(_in_part())
    rooms = kept(
        _with_room(_blocks(sized, counted).join(of_part, ["name", "block"])).where("room > 0")
        .select("key", F.when(F.col("room") < F.col("size"), F.col("room")).alias("room")),
        "mix-rooms",
    )
    # Columns of the documents are in a struct, where their names clash with nothing.
    carried = numbered.where(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]")).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(row).alias("key"), F.col(key).alias("label"), _name(source),
    )
    placed = _blocks(carried, broadcast_if_small(counted.select("name", "n_blocks")))

    def draws(passes: DataFrame, all_of_it: bool) -> DataFrame:
        wanted = F.filter("passes", lambda p: p["all_of_it"] == F.lit(all_of_it))
        found = placed.join(broadcast_if_small(passes), ["name", "block"])
        return found.select("doc", "key", F.explode(wanted).alias("draw"))

    whole = draws(by_block, True).withColumn("room", F.lit(None).cast("long"))
    copies = whole.unionByName(draws(of_part, False).join(rooms, "key"))
    shard, order = F.col("draw.shard"), _hash(SEED, "row", F.col("doc").getField(key), F.col("draw.pass"))
    ranged = copies.repartitionByRange(shard, order).sortWithinPartitions(shard, order)
    t, room = F.col("doc").getField(text), F.col("room")
    leading = F.array_join(F.slice(words(t), 1, F.coalesce(room, F.lit(0)).cast("int")), " ")
    cut = F.when(room.isNotNull(), leading).otherwise(t)
    return ranged.select(
        *[(cut if c.lower() == text.lower() else F.col("doc").getField(c)).alias(c) for c in docs.columns]
    )
