"""Words and word windows of whole texts, found and hashed in bulk inside Spark tasks.

Texts arrive as Arrow string columns. A chunk of rows is looked at as one byte array: a byte
class table says which bytes belong to words, and words are hashed together. Chunks hold a
bounded number of bytes, or one text; a long text costs its own size and a few bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_random = np.random.default_rng(20240229)
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bytes of a word that are hashed together with those of all other words.
_TOGETHER = 64
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _byte_class(separators) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table


#: Words between ASCII blanks: space, tab, line feed, vertical tab, form feed, return.
BLANK_WORDS = _byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Words of letters, digits and everything beyond ASCII, after A-Z is lower-cased.
PLAIN_WORDS = _byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


class Words(NamedTuple):
    """The words of some rows, in order."""

    rows: range  # the rows of the column
    data: np.ndarray  # their lower-cased bytes, end to end
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    hashes: np.ndarray  # 64-bit hash of each word
    first: np.ndarray  # index of each row's first word, and the number of words
    texts: np.ndarray  # first byte of each row, and the number of bytes

    def of(self, i: int) -> slice:
        """The words of the i-th row of the chunk."""
        return slice(int(self.first[i]), int(self.first[i + 1]))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; different values stay different."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; NULL counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets else np.zeros(1, np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words are read eight bytes at a time, all words together; the rare long ones end alone."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    sizes = ends - starts
    out = sizes.astype(np.uint64) * _PLACE
    for done in range(0, _TOGETHER, 8):
        more = np.flatnonzero(sizes > done) if done else slice(None)
        if done and not len(more):
            return out
        piece = eight[starts[more] + done] & _MASKS[np.minimum(sizes[more] - done, 8)]
        out[more] = mix(out[more] ^ piece)
    for i in np.flatnonzero(sizes > _TOGETHER):
        rest = data[starts[i] + _TOGETHER : ends[i]]
        rest = np.concatenate((rest, np.zeros(-len(rest) % 8, np.uint8))).view("<u8")
        powers = np.cumprod(np.full(len(rest), _PLACE), dtype=np.uint64)
        out[i : i + 1] = mix(out[i : i + 1] ^ np.array([(rest * powers).sum(dtype=np.uint64)]))
    return out


def split(column: pa.Array, kind: np.ndarray) -> Iterator[Words]:
    """The words of every row, chunk by chunk; A-Z is lower-cased."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets, data = buffers(column)
    row = 0
    while row < len(offsets) - 1:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        texts = offsets[row : stop + 1] - offsets[row]
        part = _LOWER[data[offsets[row] : offsets[stop]]]
        inside = kind[part]
        begins, finishes = inside.copy(), inside.copy()
        if len(part):
            begins[1:] &= ~inside[:-1]
            finishes[:-1] &= ~inside[1:]
            border = texts[(texts > 0) & (texts < len(part))]
            begins[border] = inside[border]
            finishes[border - 1] = inside[border - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        hashes = _hashes(part, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        yield Words(range(row, stop), part, starts, ends, hashes, np.searchsorted(starts, texts), texts)
        row = stop


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` consecutive words; fewer words, but not none, are one."""
    count = len(hashes)
    if not count:
        return hashes
    width = min(size, count)
    steps = _STEPS
    if width > len(steps):
        steps = mix(np.arange(1, width + 1, dtype=np.uint64) * _PLACE) | np.uint64(1)
    total = np.full(count - width + 1, width, np.uint64) * _PLACE
    for k in range(width):
        total += hashes[k : count - width + 1 + k] * steps[k]
    return mix(total)


def windows_of(chunk: Words, size: int) -> Iterator[np.ndarray]:
    """For each row of a chunk, what ``windows`` returns for its words."""
    joint = windows(chunk.hashes, size) if len(chunk.hashes) >= size else chunk.hashes[:0]
    for lo, hi in zip(chunk.first[:-1].tolist(), chunk.first[1:].tolist()):
        yield joint[lo : hi - size + 1] if hi - lo >= size else windows(chunk.hashes[lo:hi], size)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The different values in order."""
    hashes = np.sort(hashes)
    return hashes[np.r_[True, hashes[1:] != hashes[:-1]]] if len(hashes) else hashes


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return hashes.view(np.int64)
