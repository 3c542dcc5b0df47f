"""Words and their hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
#: Bytes that are hashed in one go; arrays take about 50 times as much.
SLICE = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_MULTIPLIER, SLICE), _powers(_INVERSE, SLICE + 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _runs(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool, bool]:
    """Where the words of some bytes begin and end, the sums of their bytes, and what the ends are.

    A word's sum weighs its bytes by powers from its own beginning on.
    """
    if lower:
        data = _LOWER[data]
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(blank.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)], out=sums[1:])
    return starts, ends, (sums[ends] - sums[starts]) * _DOWN[starts], not blank[0], not blank[-1]


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, where each text's words begin (with the end), and word bytes.

    Words are runs without white space (blank and 9 to 13); with ``lower`` A-Z count as
    a-z. Equal words have equal 64-bit hashes, whatever stands around them. The bytes are
    taken in slices, which may end inside a word, so that memory beyond the texts and the
    results does not grow with them.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends_at = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, dtype=np.int64)
    whole = np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)
    del raw
    all_sums, all_starts, all_sizes = [], [], []
    # Of a word that goes on behind the slice: its sum, its beginning, its bytes so far.
    held = None
    for at in range(0, len(whole), SLICE):
        starts, ends, sums, open_start, open_end = _runs(whole[at : at + SLICE], lower)
        sizes = ends - starts
        starts += at
        if held is not None:
            value, begin, size = held
            if open_start:
                sums[0] = np.uint64((value + int(sums[0]) * pow(_MULTIPLIER, size, 1 << 64)) & _MASK)
                starts[0], sizes[0] = begin, size + sizes[0]
            else:
                all_sums.append(np.array([value], dtype=np.uint64))
                all_starts.append(np.array([begin]))
                all_sizes.append(np.array([size]))
            held = None
        if open_end:
            held = int(sums[-1]), int(starts[-1]), int(sizes[-1])
            sums, starts, sizes = sums[:-1], starts[:-1], sizes[:-1]
        all_sums.append(sums)
        all_starts.append(starts)
        all_sizes.append(sizes)
    if not all_sums:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64)
    starts, sizes = np.concatenate(all_starts), np.concatenate(all_sizes)
    hashes = mix(np.concatenate(all_sums) + sizes.astype(np.uint64))
    begins = np.concatenate([[0], np.searchsorted(starts, ends_at)]).astype(np.int64)
    return hashes, begins, sizes
