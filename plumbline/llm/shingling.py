"""Hashes of the words of many texts at once, and of the runs of words in each text (word shingles).

Words are what lies between ASCII white space (``[^\\x20\\x09-\\x0D]+``), with A-Z lower-cased. A word's hash is the sum of
a random number for each byte times one for its place, mixed; a shingle's is a sum over its words, mixed again. All of it
is array arithmetic on the bytes of a column, in pieces of PIECE bytes, so long texts cost no more memory than short ones
(but for the 8 bytes a word that their sets take).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _random(n: int, salt: int, start: int = 0) -> np.ndarray:
    return mixed((np.arange(start + 1, start + n + 1, dtype=np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15))


SPACES = [0x20, *range(0x09, 0x0E)]
_WORD = np.ones(256, bool)
_WORD[SPACES] = False
_BYTE = _random(256, 1 << 20)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BYTE[SPACES] = 0
_PLACE = _random(1 << 12, 1 << 40) | np.uint64(1)
_TURN = _random(64, 1 << 50) | np.uint64(1)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text). ``data``: bytes of texts one behind another; where each starts."""
    global _PLACE
    word = _WORD[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inside = starts[starts < len(data)]
    first[inside] = word[inside]
    at = np.flatnonzero(first)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    place = np.arange(at[0], len(data)) - np.repeat(at, np.diff(np.append(at, len(data))))
    value = _BYTE[data[at[0] :]]
    longest = int(place.max()) + 1
    if longest > len(_PLACE) and (longest := int(place[value != 0].max()) + 1) > len(_PLACE):
        _PLACE = np.concatenate([_PLACE, _random(longest - len(_PLACE), 1 << 40, len(_PLACE)) | np.uint64(1)])
    value *= _PLACE[np.minimum(place, len(_PLACE) - 1)]
    counts = np.diff(np.append(np.searchsorted(at, starts), len(at)))
    return mixed(np.add.reduceat(value, at - at[0])), counts


def _of_long(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text, cut at white space into pieces."""
    parts, at = [], 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and len(gap := np.flatnonzero(~_WORD[data[end : end + PIECE]])) == 0:
            end += PIECE
        end = end + int(gap[0]) if end < len(data) else len(data)
        parts.append(word_hashes(data[at:end], np.zeros(1, np.int64))[0])
        at = end
    return np.concatenate(parts)


def _runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    out = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        out += words[j : len(words) - n + 1 + j] * _TURN[j % 64]
        if j % 64 == 63:
            out = mixed(out)
    return mixed(out)


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(number of the first row, sets of a run of rows): sorted distinct hashes of the k-word shingles of each text.

    A text of fewer than k words has one shingle, all its words; one without words, or null, has none.
    """
    column = pc.fill_null(column.cast(pa.string()), "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row, n = 0, len(column)
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1)
        a, b = int(offsets[row]), int(offsets[stop])
        if b - a > PIECE:
            words = _of_long(data[a:b])
            counts = np.array([len(words)])
        else:
            words, counts = word_hashes(data[a:b], offsets[row:stop] - a)
        runs = _runs(words, k) if len(words) >= k else words[:0]
        sets, at = [], 0
        for m in counts.tolist():
            own = runs[at : at + m - k + 1] if m >= k else _runs(words[at : at + m], m) if m else words[:0]
            own = np.sort(own)
            if len(own) > 1:
                own = own[np.append(True, own[1:] != own[:-1])]
            sets.append(own)
            at += m
        yield row, sets
        row = stop
