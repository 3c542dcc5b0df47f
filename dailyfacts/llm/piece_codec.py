"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The search keeps, for every place in a window, the piece that ends there on the best
path, and a pointer to where that piece begins. Whenever the paths of all places from
which a further piece may begin, the last ``longest piece`` ones, pass one boundary,
the ids up to it are final: they are given out and the window moves there. So the memory
does not grow with the text. An automaton of all pieces says which of them end at a place,
so that only real pieces are tried.

What the best path is follows from the kind of the model:

- unigram: the path with the largest sum of scores;
- BPE: the path of the merges. Of the pieces that end at a place exactly one follows its
  predecessor in the way that merging the two texts would leave them apart, so each place
  has one survivor, and the ids are those of the merges without running them.

Characters without a piece become byte pieces, or the unknown id where there are none.
Where no piece has a blank behind another character, no piece spans the place before a
blank, so that all paths meet there and the search commits there without comparing
them. What lies between two such places has always the same ids, which a worker remembers.

Defined results: a null or empty text has no ids and decodes to an empty text; very long
texts are encoded whole; repeated rows get equal results; an empty table gives no rows;
only the named columns are read. The text is normalised by the model first, and decoding
gives the normalised text.
"""

from __future__ import annotations

import gc
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from ahocorasick import Automaton
from pyarrow.compute import binary_length
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyfacts.llm.common import chunks, forget_oldest, give_back, process_cache

BLANK = "▁"
#: Distinct words that a worker remembers the ids of, and pairs of pieces: 100 MB at most.
REMEMBERED = 250_000
PAIRS = 250_000
#: Bytes of text that are encoded in one go.
SLICE = 1 << 21
#: For each place of a window: where its piece begins, the piece's id or -1, its path's score.
Nodes = tuple[list[int], list[int], list[float]]


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _field(data: bytes, number: int) -> bytes | int | None:
    """The last value of a field of a serialised message."""
    at, found = 0, None
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        if tag >> 3 == number:
            found = value
    return found


def is_bpe(model: bytes) -> bool:
    """Whether a model file says that it is of the BPE kind (2; unigram is 1 or left out)."""
    trainer = _field(model, 2) or b""
    return _field(trainer, 3) == 2


class Codec:
    """Encoder and decoder of one model file; ``bpe`` overrides the kind that the file says.

    It remembers the ids of ``remembered`` words at most between calls.
    """

    def __init__(self, path: str, bpe: bool | None = None, remembered: int = REMEMBERED):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.model = model
        if bpe is None:
            with open(path, "rb") as file:
                bpe = is_bpe(file.read())
        self.bpe = bpe
        n = model.get_piece_size()
        self.unknown = model.unk_id()
        self.pieces: dict[str, int] = {}
        self.scores = [model.get_score(i) for i in range(n)]
        self.byte_ids: dict[int, int] = {}
        self.output: list[bytes] = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.output.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.output.append(b"")
            elif i == self.unknown:
                self.output.append(" ⁇ ".encode())
            else:
                self.output.append(piece.replace(BLANK, " ").encode())
                if not model.is_unused(i):
                    self.pieces[piece] = i
        self.longest = max(map(len, self.pieces), default=1)
        self.automaton = Automaton()
        for piece, number in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), number))
        self.automaton.make_automaton()
        # No piece has a blank behind another character: then paths meet at blanks.
        self.meets = not any(BLANK in p.lstrip(BLANK) for p in self.pieces)
        self.unknown_score = min(self.scores, default=0.0) - 10.0
        self.type, self.code = ("<u2", "H") if n <= 1 << 16 else ("<u4", "I")
        self.known: dict[str, bytes] = {}
        self.remembered = remembered
        self.names = {number: piece for piece, number in self.pieces.items()}
        #: By the ids of two pieces, the left one -1 for none.
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves: best score first, the first pair of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                piece = self.pieces.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best[0]):
                    best = (self.scores[piece], i)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _apart(self, left: int, right: int) -> bool:
        """Whether merging leaves two pieces as they are; without a left one, whether it makes the right."""
        before, after = self.names.get(left, ""), self.names[right]
        forget_oldest(self.pairs, PAIRS)
        known = self.merged(before + after) == ([before, after] if before else [after])
        self.pairs[left << 32 | right] = known
        return known

    def _windows(self, text: str, nodes: Nodes) -> Iterator[tuple[list[int], list[int]]]:
        """Where pieces begin, and their ids (-1 for none), given out as soon as they are final.

        ``nodes`` may hold the places of a beginning of the text; further ones are added.
        """
        survive = self._merges if self.bpe else self._best_sums
        n, base, step = len(text), 0, 4 * self.longest
        while base + len(nodes[0]) <= n:
            survive(text, base, min(n, base + len(nodes[0]) + step - 1), *nodes)
            end = base + len(nodes[0]) - 1
            if end < n:
                common = self._boundary(base, end, nodes[0])
                yield self._path(base, common, nodes)
                nodes = tuple(values[common - base :] for values in nodes)
                base = common
        yield self._path(base, n, nodes)

    def stream(self, text: str) -> Iterator[tuple[str, bool]]:
        """``(piece, has an id)`` in order."""
        for places, ids in self._windows(text, ([0], [-1], [0.0])):
            for begin, end, number in zip(places, places[1:], ids, strict=False):
                yield text[begin:end], number >= 0

    def _found(self, text: str, base: int, first: int, end: int) -> Iterator[tuple[int, tuple[int, int]]]:
        """``(last character, (length, id))`` of the pieces up to ``end``, those of a place longest first."""
        return self.automaton.iter(text, max(base, first - self.longest), end) if self.pieces else iter(())

    def _merges(self, text: str, base: int, end: int, begins: list, ids: list, scores: list) -> None:
        """Go on to ``end``: of the pieces that end at a place, the one that stays apart from the one before."""
        pairs = self.pairs
        place = base + len(begins)
        for last, (size, number) in self._found(text, base, place, end):
            if last + 1 < place:
                continue
            # A character without a piece merges with nothing.
            while place <= last:
                begins.append(place - 1)
                ids.append(-1)
                place += 1
            left = ids[last + 1 - size - base]
            apart = pairs.get(left << 32 | number)
            if apart or apart is None and self._apart(left, number):
                begins.append(last + 1 - size)
                ids.append(number)
                place += 1
        while place <= end:
            begins.append(place - 1)
            ids.append(-1)
            place += 1

    def _best_sums(self, text: str, base: int, end: int, begins: list, ids: list, scores: list) -> None:
        """Go on to ``end``: the piece with which the path has the largest sum, of equal ones the longest."""
        first = base + len(begins)
        found = ((last + 1, size, number) for last, (size, number) in self._found(text, base, first, end))
        by_place = {i: list(pieces) for i, pieces in groupby(found, key=itemgetter(0))}
        for i in range(first, end + 1):
            begin, best, score = i - 1, -1, None
            for _, size, number in by_place.get(i, ()):
                total = scores[i - size - base] + self.scores[number]
                if score is None or total > score:
                    begin, best, score = i - size, number, total
            begins.append(begin)
            ids.append(best)
            scores.append(scores[i - 1 - base] + self.unknown_score if score is None else score)

    def _boundary(self, base: int, i: int, begins: list[int]) -> int:
        """The last place that the paths of all places with a future pass."""
        passed = None
        for end in range(i, max(base, i - self.longest), -1):
            path, at = set(), end
            while at > base:
                path.add(at)
                at = begins[at - base]
            passed = path if passed is None else passed & path
        return max(passed or {base})

    def _path(self, base: int, end: int, nodes: Nodes) -> tuple[list[int], list[int]]:
        """The ends of the pieces from ``base`` on, ``base`` before them, and their ids."""
        begins, ids, _ = nodes
        places, numbers, at = [end], [], end
        while at > base:
            numbers.append(ids[at - base])
            at = begins[at - base]
            places.append(at)
        return places[::-1], numbers[::-1]

    def word_ids(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """``(word, ids)`` of the words in their order.

        A word goes on from the places of the beginning that it shares with the one before.
        """
        nodes, before = ([0], [-1], [0.0]), ""
        survive = self._merges if self.bpe else self._best_sums
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                shared += 1
            for values in nodes:
                del values[shared + 1 :]
            before = word
            if len(word) <= 4 * self.longest:
                # The window ends with the word: its one commit is the path from there.
                survive(word, 0, len(word), *nodes)
                begins, chosen, _ = nodes
                found, at = [], len(word)
                while at:
                    found.append(chosen[at])
                    at = begins[at]
                if -1 not in found:
                    found.reverse()
                    yield word, found
                    continue
            found = []
            for places, ids in self._windows(word, nodes):
                found += self._replace_unknown(word, places, ids, found) if -1 in ids else ids
            yield word, found

    def _replace_unknown(self, text: str, places: list[int], ids: list[int], before: list[int]) -> list[int]:
        """Ids with byte pieces, or the unknown id once for each run, where there is none."""
        out, last = [], before[-1:]
        for begin, end, number in zip(places, places[1:], ids, strict=False):
            if number >= 0:
                out.append(number)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in text[begin:end].encode("utf-8", "surrogatepass")]
            elif (out or last)[-1:] != [self.unknown]:
                out.append(self.unknown)
        return out

    def segments(self, normal: str) -> list[str]:
        """The text cut before every blank that another character is before."""
        if not self.meets or not normal:
            return [normal] if normal else []
        parts = normal.split(BLANK)
        head, rest = parts[0], parts[1:]
        if all(rest):
            return [head, *[BLANK + p for p in rest]] if head else [BLANK + p for p in rest]
        out, held = [], head
        for part in rest:
            if held and held[-1] != BLANK:
                out.append(held)
                held = ""
            held += BLANK + part
        return [*out, held] if held else out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian bytes of the codec's type."""
        return self.encode_normal(self.model.normalize(texts))

    def encode_normal(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are normalised already."""
        cut = [self.segments(t) for t in texts]
        # Distinct words first: most come many times among these texts.
        here: dict[str, bytes | None] = dict.fromkeys(chain.from_iterable(cut))
        known, new = self.known, []
        for word in here:
            ids = known.get(word)
            if ids is None:
                new.append(word)
            else:
                here[word] = ids
        for word, numbers in self.word_ids(new):
            here[word] = known[word] = array(self.code, numbers).tobytes()
        forget_oldest(known, self.remembered)
        return [b"".join(map(here.__getitem__, words)) for words in cut]

    def decode(self, ids: bytes) -> str:
        """The normalised text, without the blank that was put before it."""
        numbers = np.frombuffer(ids, self.type).tolist()
        text = b"".join(map(self.output.__getitem__, numbers)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _codec(path: str, remembered: int = REMEMBERED) -> Codec:
    cache = process_cache("piece-codecs")
    if path not in cache:
        cache[path] = Codec(path)
    cache[path].remembered = remembered
    return cache[path]


def _slices(texts: pa.Array, size: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of about ``size`` bytes of whole texts, and where they begin; null as an empty text."""
    sizes = enumerate(binary_length(texts).fill_null(0).to_pylist())
    for part in chunks(sizes, lambda x: x[1] + 64, size):
        yield part[0][0], [t or "" for t in texts.slice(part[0][0], len(part)).to_pylist()]


def _lists(values: list[bytes], kind: str) -> pa.ListArray:
    """Ids of several texts as one list array."""
    ends = np.cumsum([0, *map(len, values)]) // np.dtype(kind).itemsize
    ids = np.frombuffer(b"".join(values), kind).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))


def encode(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", *,
    remembered: int = REMEMBERED, slice_bytes: int = SLICE,
) -> DataFrame:
    """``key, ids, n_ids, round_trip``: the last says whether decoding gives the normalised text.

    ``model`` is the path of a SentencePiece file on every machine. Workers that remember fewer
    words and take smaller slices hold less memory and take more time; the ids are the same.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, remembered)
        # Nothing here makes cycles, and the many small objects keep the collector busy.
        gc.disable()
        for batch in batches:
            for a, texts in _slices(batch.column("text"), slice_bytes):
                normal = codec.model.normalize(texts)
                found = codec.encode_normal(normal)
                same = [
                    codec.decode(ids) == n.replace(BLANK, " ").removeprefix(" ")
                    for ids, n in zip(found, normal, strict=True)
                ]
                ids = _lists(found, codec.type)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(a, len(texts)), ids, ids.value_lengths().cast(pa.int64()), pa.array(same)],
                    ["key", "ids", "n_ids", "round_trip"],
                )
        gc.enable()
        give_back()

    kind = dict(rows.dtypes)["key"]
    out = rows.mapInArrow(apply, f"key {kind}, ids array<int>, n_ids long, round_trip boolean")
    return out.withColumnRenamed("key", key)


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` of rows with ids; null ids give an empty text."""
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            texts = [
                codec.decode(np.asarray(i or (), dtype=codec.type).tobytes()) for i in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    kind = dict(rows.dtypes)["key"]
    return rows.mapInArrow(apply, f"key {kind}, text string").withColumnRenamed("key", key)
