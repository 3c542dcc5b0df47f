"""One large JSON document, read by many tasks.

A document ``{"records": [...]}`` is cut at closing braces, which the text reader does in
every split of a file by itself. Where no brace stands inside a text or a nested object,
each piece is one record. One pass over the pieces counts, for each file, those that are
something else, and says whether the file is a whole document. Only in files with such
pieces are pieces put together: running counts of quotes and open brackets, within each
block of a file and then over its blocks, tell which braces end a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailyfacts.operators.joins import broadcast_if_small
from dailyfacts.schemas import CASE_RECORD_FIELDS, ddl

# A text with its quotes; possessive, so that a long one needs no stack.
_TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_HEAD = r'^\s*\{\s*"records"\s*:\s*\[\s*'
_PLACE = ["file", "block", "id"]
_FAILFAST = {"mode": "FAILFAST"}


class BrokenDocument(ValueError):
    """A file that is no document of records."""


def _pieces(spark: SparkSession, path) -> DataFrame:
    """``file, size, block, id, value``: what stands before each closing brace, and after the last."""
    return spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def _bare(value: Column) -> Column:
    """The value with ``s`` for each text in it."""
    return F.regexp_replace(value, rf"(?s){_TEXT}", "s")


def _kind(value: Column) -> Column:
    bare = _bare(value)
    flat = r'[^{}\[\]"]*$'
    return (
        F.when(bare.rlike(rf"^\s*,\s*\{{{flat}"), "record")
        .when(bare.rlike(rf"^\s*\{{\s*s\s*:\s*\[\s*\{{{flat}") & value.rlike(_HEAD), "head")
        .when(bare.rlike(r"^\s*\]\s*$"), "tail")
        .when(bare.rlike(r"^\s*$"), "blank")
        .when(bare.rlike(r"^\s*\{\s*s\s*:\s*\[\s*\]\s*$") & value.rlike(_HEAD), "empty")
        .otherwise("other")
    )


def _describe(pieces: DataFrame) -> DataFrame:
    """A row for each file: how many of its pieces are of a kind, and how it begins and ends."""
    named = pieces.withColumns(
        {"kind": _kind(F.col("value")), "bytes": F.octet_length("value") + 1, "place": F.struct("block", "id")}
    )
    count = {k: F.count_if(F.col("kind") == k).alias(k) for k in ("head", "tail", "blank", "empty", "other")}
    return named.groupBy("file").agg(
        *count.values(),
        F.min_by("kind", "place").alias("first"), F.max_by("kind", "place").alias("last"),
        # Every piece but one after the last brace has its brace.
        (F.sum("bytes") - F.max("size")).alias("unclosed"),
    )


def _whole() -> Column:
    """Whether the pieces of a file, each of a known kind, make up a document."""
    records = (F.col("first") == "head") & (F.col("head") == 1) & (F.col("tail") == 1) & (F.col("empty") == 0)
    none = (F.col("first") == "empty") & (F.col("empty") == 1) & (F.col("head") == 0) & (F.col("tail") == 0)
    ends = (F.col("blank") == 0) & F.col("last").isin("tail", "empty") & (F.col("unclosed") == 0)
    blank = (F.col("blank") == 1) & (F.col("last") == "blank") & (F.col("unclosed") == 1)
    return (records | none) & (ends | blank)


def _running(pieces: DataFrame, name: str, step: Column) -> DataFrame:
    """``name``: the sum of ``step`` over the file's pieces so far, this one included.

    Sums run within a block; one row for each block adds those of the blocks before it.
    """
    stepped = pieces.withColumn("_step", step)
    blocks = stepped.groupBy("file", "block").agg(F.sum("_step").alias("_all"))
    along = Window.partitionBy("file").orderBy("block")
    before = blocks.select("file", "block", (F.sum("_all").over(along) - F.col("_all")).alias("_before"))
    within = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    summed = stepped.withColumn("_sum", F.sum("_step").over(within)).join(before, ["file", "block"])
    return summed.withColumn(name, F.col("_sum") + F.col("_before")).drop("_step", "_sum", "_before")


def _characters(text: Column, which: str) -> Column:
    return F.length(text) - F.length(F.translate(text, which, ""))


def _leveled(pieces: DataFrame) -> DataFrame:
    """Pieces with ``inside``, whether a text is open at their end, and the ``level`` after them."""
    quotes = _characters(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    quoted = _running(pieces, "quotes", quotes)
    began_inside = (F.col("quotes") - quotes) % 2 == 1
    bare = _bare(F.concat(F.when(began_inside, '"').otherwise(""), F.col("value")))
    outside = F.regexp_replace(bare, r'(?s)".*$', "")
    parted = quoted.select("*", outside.alias("outside"), (F.col("quotes") % 2 == 1).alias("inside"))
    opened = _characters(F.col("outside"), "{[") - _characters(F.col("outside"), "]")
    change = opened - F.when(F.col("inside"), 0).otherwise(1)
    return _running(parted, "level", change).drop("quotes", "outside")


def _joined(pieces: DataFrame) -> DataFrame:
    """``text`` of each record, without its last brace, from files with other pieces.

    The place where a file's brackets close is checked before pieces are brought together.
    """
    leveled = _leveled(pieces)
    ends = leveled.groupBy("file").agg(
        F.max_by(F.struct("inside", "level", "value"), F.struct("block", "id")).alias("end"),
        F.min("level").alias("least"), (F.sum(F.octet_length("value") + 1) - F.max("size")).alias("unclosed"),
    )
    # An unclosed last piece has been counted as if it had a brace.
    open_end = (F.col("unclosed") == 1) & (F.col("end.level") == -1) & F.col("end.value").rlike(r"^\s*$")
    closed_end = (F.col("unclosed") == 0) & (F.col("end.level") == 0) & (F.col("least") == 0)
    bad = ends.where(F.col("end.inside") | ~(open_end | closed_end)).first()
    if bad:
        raise BrokenDocument(f"{bad['file']} is no whole document of records")
    border = (F.col("level") == 2) & ~F.col("inside")
    counted = _running(leveled, "borders", F.when(border, 1).otherwise(0))
    number = F.col("borders") - F.when(border, 1).otherwise(0)
    piece = F.struct("block", "id", "value", border.alias("border"))
    records = counted.groupBy("file", number.alias("number")).agg(F.array_sort(F.collect_list(piece)).alias("p"))
    text = F.array_join(F.transform("p", lambda p: p["value"]), "}")
    is_record = F.exists("p", lambda p: p["border"])
    fits = (
        F.when(~is_record, text.rlike(r"^\s*\]\s*(\}\s*)?$") | text.rlike(_HEAD + r"\]\s*(\}\s*)?$"))
        .when(F.col("number") == 0, text.rlike(_HEAD + r"\{"))
        .otherwise(text.rlike(r"^\s*,\s*\{"))
    )
    wrong = F.raise_error(F.concat(F.col("file"), F.lit(" is no document of records")))
    return records.select(F.when(fits, F.when(is_record, text)).otherwise(wrong).alias("text")).where("text is not null")


def read_case_records(spark: SparkSession, path) -> DataFrame:
    """``record`` of all documents, each of which may be read by many tasks.

    Gives the rows that exploding :func:`read_case_documents` gives, for documents whose one
    key is ``records`` and whose texts stand in double quotes. A file that is no such document
    as a whole, or a record that is no valid JSON, fails the read. The files are read once
    before, to see how they can be cut.
    """
    pieces = _pieces(spark, path)
    files = _describe(pieces).withColumn("whole", F.coalesce(_whole(), F.lit(False)))
    found = files.agg(
        F.min(F.when((F.col("other") == 0) & ~F.col("whole"), F.col("file"))).alias("bad"),
        F.count_if(F.col("other") > 0).alias("odd"),
    ).first()
    if found["bad"]:
        raise BrokenDocument(f"{found['bad']} is no whole document of records")
    single = pieces
    if found["odd"]:
        odd = broadcast_if_small(files.where("other > 0").select("file"))
        single = pieces.join(odd, "file", "left_anti")
    texts = single.where(_kind(F.col("value")).isin("head", "record")).select(F.col("value").alias("text"))
    if found["odd"]:
        texts = texts.unionByName(_joined(pieces.join(odd, "file", "left_semi")))
    body = F.concat(F.regexp_replace("text", rf"{_HEAD}|^\s*,\s*", ""), F.lit("}"))
    return texts.select(F.from_json(body, ddl(CASE_RECORD_FIELDS), _FAILFAST).alias("record"))
