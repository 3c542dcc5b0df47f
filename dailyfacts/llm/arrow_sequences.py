"""Token ids as Arrow stream files of fixed-size lists.

Documents are dealt to tasks by ranges of their key and encoded there in ascending
order, an end id after each. A task cuts its run of ids into sequences of equal length,
the last one padded, and writes record batches of two fixed-size lists: ``ids`` in the
smallest unsigned type that holds the vocabulary, and ``mask``, true for ids and false
for padding, a bit each. All sequences take equally many bytes, so a reader that maps a file gets
any of them without copying. Next to the ids, a file of the same format holds
``key, start, n_tokens`` of each document, counted from the file's first id.

Files are written under a temporary name and renamed, so a task that runs again
replaces its own file; names hold the number of the range.

Defined results: a null or empty text is its end id alone; special tokens in a text are
what the library makes of them; very long texts are encoded whole; repeated keys keep all their rows, in
order of their texts; null keys come first; an empty table writes no file; columns other
than key and text are not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailyfacts.llm.common import chunks, forget_oldest, in_frames, kept, process_cache

#: Ids in a sequence, and sequences in a record batch.
LENGTH = 1024
ROWS = 256
END_ID = 0
#: Distinct pieces of text that a worker remembers the ids of, until it turns to another operator.
REMEMBERED = 1_000_000
#: Characters that are encoded in one go.
SLICE = 1 << 20


def cuts_before_blanks(described: dict) -> bool:
    """Whether a tokenizer file ends tokens before each blank or line feed that text follows.

    That is known of byte-level pair encodings that split by their usual pattern, where nothing
    normalises the text before and no added token takes blanks beside it.
    """
    pre = described.get("pre_tokenizer") or {}
    plain = described.get("normalizer") is None and pre.get("type") == "ByteLevel"
    usual = pre.get("use_regex", True) and not pre.get("add_prefix_space", False)
    greedy = any(t.get("lstrip") or t.get("rstrip") for t in described.get("added_tokens") or [])
    return plain and usual and not greedy and (described.get("model") or {}).get("type") == "BPE"


#: Places before a blank or a line feed that text follows.
_CUT = re.compile(r"(?=[ \n]\S)")


def _stands_alone(word: str) -> bool:
    """Whether a word of a text split at its blanks is all that stands up to the next cut."""
    return not (word[1:2] if word[:1] == "\n" else word[:1]).isspace() and word not in ("", "\n")


class _OddPiece(Exception):
    """A text is not split into its pieces at blanks and line feeds alone."""


#: Letters, and marks behind them, which the usual pattern makes a word each: no apostrophe, which
#: it may take together with letters.
_PLAIN = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)")
_LETTERS = "".join(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha())


class _Pieces(dict):
    """Ids of pieces by the pieces as they are remembered; new ones are encoded when they are asked for.

    Letters are one word of the pre-tokenizer, with the blank before them, and marks behind them the
    next; so the library's model gets letters straight, in the pre-tokenizer's own characters.
    """

    def __init__(self, tokenizer, code: str, cuts: bool):
        super().__init__()
        self.tokenizer, self.code, self.odd = tokenizer, code, True
        self.tokenize = tokenizer.model.tokenize
        shown = tokenizer.pre_tokenizer if cuts else None
        self.letters = {ord(c): shown.pre_tokenize_str(c)[0][0] for c in _LETTERS} if shown else {}
        self.blank = shown.pre_tokenize_str(" a")[0][0][:-1] if shown else " "
        self.marks: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, letters: str, before: str) -> bytes:
        shown = letters if letters.isascii() else letters.translate(self.letters)
        return array(self.code, [t.id for t in self.tokenize(before + shown)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        plain = _PLAIN.fullmatch(piece)
        if plain:
            line, letters, marks = plain.groups()
            for known in (line, marks):
                if known not in self.marks:
                    self.marks[known] = self.ids(known)
            if line:
                ids = self.marks[line] + self.word(letters, "")
            else:
                ids = marks and self.get(letters) or self.word(letters, self.blank)
            ids += self.marks[marks]
        elif self.odd and not _stands_alone(piece):
            raise _OddPiece
        else:
            ids = self.ids(piece if piece[0] == "\n" else f" {piece}")
        self[piece] = ids
        return ids


class _Encoder:
    """Ids as little-endian bytes, by the tokenizers library.

    Where the file says so (:func:`cuts_before_blanks`), no token spans a place before a blank or a
    line feed that text follows; a text is then encoded in pieces that start there, and pieces met
    before are not encoded again. Texts in which an added token stands are encoded whole.

    Pieces are remembered without their blank. Those behind a line feed begin with it; what comes
    before the first place is remembered apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.cuts = cuts_before_blanks(described)
        self.added = [token["content"] for token in described.get("added_tokens") or []]
        self.type, self.code = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.known = _Pieces(self.tokenizer, self.code, self.cuts)
        self.heads: dict[str, bytes] = {"": b""}

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The head of a text and its pieces as they are remembered."""
        head, *rest = _CUT.split(text)
        return [head, *[p[1:] if p[0] == " " else p for p in rest]]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, f.ids).tobytes() for f in found]

    def _cut(self, text: str) -> bytes:
        """Ids of a text, by its pieces."""
        ids = self.known.__getitem__
        # A blank before each line feed; a second one there leaves an empty word, which shows it.
        head, *words = text.replace("\n", " \n").split(" ")
        try:
            rest = b"".join(map(ids, words))
        except _OddPiece:
            head, *words = self.pieces(text)
            self.known.odd = False
            try:
                rest = b"".join(map(ids, words))
            finally:
                self.known.odd = True
        if head not in self.heads:
            self.heads[head] = self.known.ids(head)
        return self.heads[head] + rest

    def __call__(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if not self.cuts or any(a in t for a in self.added)]
        done = dict(zip(whole, self._encode([texts[i] for i in whole]), strict=True))
        out = [done[i] if i in done else self._cut(t) for i, t in enumerate(texts)]
        forget_oldest(self.known, REMEMBERED)
        forget_oldest(self.heads, REMEMBERED)
        forget_oldest(self.known.marks, REMEMBERED)
        return out


def _encoder(path: str) -> _Encoder:
    cache = process_cache("arrow-encoders")
    if path not in cache:
        cache[path] = _Encoder(path)
    return cache[path]


def qualified_folder(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark gives it, its default file system's if it has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def open_folder(uri: str):
    """The file system of a folder and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    # Hadoop's names for one store.
    scheme, _, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


class _Writer:
    """Sequences of one file, handed over in pieces of any length."""

    def __init__(self, sink, id_type: np.dtype, length: int):
        self.length, self.dtype = length, np.dtype(id_type)
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.from_numpy_dtype(self.dtype), length)),
                ("mask", pa.list_(pa.bool_(), length)),
            ]
        )
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.held = bytearray()

    def add(self, ids: bytes) -> None:
        self.held += ids
        step = self.length * self.dtype.itemsize * ROWS
        while len(self.held) >= step:
            self._write(np.frombuffer(bytes(self.held[:step]), self.dtype), self.length * ROWS)
            del self.held[:step]

    def _write(self, ids: np.ndarray, n: int) -> None:
        mask = np.arange(len(ids)) < n
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (ids, mask)
        ]
        self.out.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            ids = np.frombuffer(bytes(self.held), self.dtype)
            padded = np.zeros(-(-len(ids) // self.length) * self.length, self.dtype)
            padded[: len(ids)] = ids
            self._write(padded, len(ids))
        self.out.close()


def index_schema() -> pa.Schema:
    return pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_sequences(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """Write the files; ``part, file, index_file, n_docs, n_tokens`` in order of the ranges.

    ``tokenizer`` is the path of a file of the tokenizers library.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    folder = qualified_folder(docs.sparkSession, folder)
    ordered = rows.repartitionByRange(F.col("key"), F.xxhash64("text")).sortWithinPartitions("key", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer)
        end = np.array([end_id], dtype=encode.type).tobytes()
        width = len(end)
        part = TaskContext.get().partitionId()
        store, path = open_folder(folder)
        names = [f"{path}/part-{part:06d}.arrows", f"{path}/part-{part:06d}.index.arrows"]
        trial = [f"{name}.{uuid.uuid4().hex}.tmp" for name in names]
        out = writer = index = None
        place = n_docs = 0
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                store.create_dir(path, recursive=True)
                out = [store.open_output_stream(t) for t in trial]
                writer = _Writer(out[0], np.dtype(encode.type), length)
                index = pa.ipc.new_stream(out[1], index_schema())
            sizes = []
            texts = (t if isinstance(t, str) else "" for t in batch["text"])
            for slice_ in chunks(((t,) for t in texts), lambda row: len(row[0]) + 64, SLICE):
                for ids in encode([t for (t,) in slice_]):
                    writer.add(ids + end)
                    sizes.append(len(ids) // width + 1)
            sizes = np.array(sizes, dtype=np.int64)
            starts = place + np.cumsum(sizes) - sizes
            keys = pa.array(batch["key"].astype("Int64"), pa.int64())
            index.write_batch(pa.record_batch([keys, pa.array(starts), pa.array(sizes)], schema=index_schema()))
            place += int(sizes.sum())
            n_docs += len(batch)
        if out is None:
            return
        writer.close()
        index.close()
        for stream, temporary, name in zip(out, trial, names, strict=True):
            stream.close()
            store.move(temporary, name)
        yield pd.DataFrame(
            {"part": [part], "file": [names[0]], "index_file": [names[1]], "n_docs": [n_docs], "n_tokens": [place]}
        )

    schema = "part int, file string, index_file string, n_docs long, n_tokens long"
    return kept(in_frames(ordered, write, schema, keeps_cache=True), "sequence-files")


class SequenceFile:
    """Random access to the sequences of one file; nothing is copied where files can be mapped."""

    def __init__(self, store, path: str):
        from pyarrow import fs

        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else store.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(self.source))
        self.begins = np.concatenate([[0], np.cumsum([b.num_rows for b in self.batches])]).astype(np.int64)
        self.length = self.batches[0].schema.field("ids").type.list_size if self.batches else 0

    def __len__(self) -> int:
        return int(self.begins[-1])

    def _values(self, batch: int, column: str) -> pa.Array:
        return self.batches[batch].column(column).flatten()

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of one sequence, in the file's own memory, and its mask, made of the file's bits."""
        b = int(np.searchsorted(self.begins, i, "right")) - 1
        at = (i - int(self.begins[b])) * self.length
        ids = self._values(b, "ids").slice(at, self.length).to_numpy()
        return ids, self._values(b, "mask").slice(at, self.length).to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Consecutive ids, over the borders of sequences and batches."""
        step, out = self.length, []
        while n > 0:
            b = int(np.searchsorted(self.begins, start // step, "right")) - 1
            at = start - int(self.begins[b]) * step
            values = self._values(b, "ids").slice(at, n)
            out.append(values.to_numpy())
            start, n = start + len(values), n - len(values)
        return np.concatenate(out) if len(out) != 1 else out[0]

    def n_ids(self) -> int:
        """Ids that are no padding."""
        return sum(int(self._values(b, "mask").true_count) for b in range(len(self.batches)))


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of all documents, read from the files.

    ``start`` counts the ids of all documents before, over all files.
    """
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    # A number that is given is kept, else the few rows would be read by one task.
    folder = qualified_folder(files.sparkSession, folder)
    dealt = placed.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = open_folder(folder)
        for batch in batches:
            for row in batch.itertuples():
                ids = SequenceFile(store, row.file)
                if ids.n_ids() != row.n_tokens:
                    raise ValueError(f"{row.file} does not hold {row.n_tokens} ids")
                with store.open_input_file(row.index_file) as source:
                    for part in pa.ipc.open_stream(source):
                        docs = part.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
                        digests = [
                            zlib.crc32(ids.ids(int(s), int(n)).astype("<u4").tobytes())
                            for s, n in zip(docs["start"], docs["n_tokens"], strict=True)
                        ]
                        yield pd.DataFrame(
                            {
                                "key": docs["key"], "start": docs["start"] + row.before,
                                "n_tokens": docs["n_tokens"], "ids_crc32": digests,
                            }
                        )

    return in_frames(dealt, read, "key long, start long, n_tokens long, ids_crc32 long")
