"""Words, lines and their hashes over whole Arrow batches of texts, in numpy and without a loop over words.

A batch of texts is one array of UTF-8 bytes and the offsets of the texts in it. White
space is ASCII (tab to carriage return, and space), whose bytes occur in no other
character's UTF-8 form, so words are the runs of other bytes inside a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_TABLE = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(i: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit random value for each index."""
    with np.errstate(over="ignore"):
        return mix((np.asarray(i).astype(U64) + U64(seed)) * U64(0x9E3779B97F4A7C15))


_WEIGHTS = stream(np.arange(_TABLE), 1)


def weights(position: np.ndarray) -> np.ndarray:
    return _WEIGHTS[position] if not len(position) or position.max() < _TABLE else stream(position, 1)


def texts(column: pa.Array | pa.ChunkedArray, most: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about `most` bytes (one text at least): first, end, bytes, offsets from 0. A null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def release() -> None:
    """Hands the memory of batches that are done back to the system: a worker lives on, and so would its pool."""
    pa.default_memory_pool().release_unused()


def _starts(size: int, offsets: np.ndarray) -> np.ndarray:
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    return first


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word (run of bytes that are not `blank`), and for each text the index of its first word (with the total at the end)."""
    space = blank[data]
    first = _starts(len(data), offsets)
    brink = np.ones(len(data) + 1, bool)
    brink[1:-1] = space[:-1] | first[1:-1]
    begin = np.flatnonzero(~space & brink[:-1])
    brink[1:-1] = space[1:] | first[1:-1]
    end = np.flatnonzero(~space & brink[1:]) + 1
    return begin, end, np.searchsorted(begin, offsets)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans follow one another, and none is empty."""
    size = end - begin
    if not len(size):
        return np.zeros(0, U64)
    at = np.cumsum(size) - size
    position = np.arange(int(size.sum())) - np.repeat(at, size)
    value = data[position + np.repeat(begin, size)].astype(U64)
    value += U64(1)
    value *= weights(position)
    return mix(np.add.reduceat(value, at) ^ stream(size, 2))


def sequence_hashes(items: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each run of 64-bit items; `first` has the start of each run and none is empty."""
    if not len(first):
        return np.zeros(0, U64)
    size = np.diff(np.append(first, len(items)))
    position = np.arange(len(items)) - np.repeat(first, size)
    return mix(np.add.reduceat(mix(items ^ U64(seed)) * stream(position, seed), first) ^ stream(size, seed))


def windows(hashes: np.ndarray, word_at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of each run of `n` words inside a text, in order."""
    count = np.maximum(np.diff(word_at) - n + 1, 0)
    of = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(word_at[:-1], count)
    total = np.zeros(len(of), U64)
    for k in range(n):
        total += hashes[at + k] * (_WEIGHTS[k + 7] | U64(1))
    return mix(total), of, at


def counts(of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, minlength=n).astype(np.int64)


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between neighbouring offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each line (texts split at line feeds) and the index of each text's first line."""
    feed = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], feed + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], feed]), kind="stable")
    at = np.searchsorted(feed, offsets) + np.arange(len(offsets))
    return begin, end, at
