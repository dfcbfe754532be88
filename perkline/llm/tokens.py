"""Words and word n-grams of Arrow text columns, as 64-bit hashes, whole batches at a time.

A word is a run of bytes that a table marks as word bytes. Its hash is a polynomial in random
byte values, taken for all words at once from one running sum, then mixed. UTF-8 keeps ASCII
separators apart from other characters, so bytes suffice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15  # odd, 5 modulo 8: its powers repeat only after 2 ** 62 steps


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LOWERED = np.arange(256)
LOWERED[ord("A") : ord("Z") + 1] += 32

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]), CHUNK_BYTES + 1)
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of stretches of about ``limit`` bytes; nulls are empty.

    A row is never cut; a longer one makes a stretch of its own.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, ends, data = column.buffers()
    rows = len(column)
    if not rows:
        return
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < rows:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE):
    """Starts and ends of all words, and for each row the number of the first word in it (one more at the end)."""
    inside = is_word[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    starts[first] = inside[first]
    ends[last] = inside[last]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    up, down = _power_tables(len(data) + 1)
    values = BYTE_VALUES[LOWERED] if lower else BYTE_VALUES
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts])


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, also across rows."""
    count = max(0, len(words) - n + 1)
    grams = np.full(count, n, np.uint64)
    for i in range(n):
        grams = grams * np.uint64(BASE) + words[i : i + count]
    return mixed(grams)


def shingle_sets(column: pa.Array, n: int, lower: bool = True) -> Iterator[np.ndarray]:
    """For each text its distinct ``n``-word shingles as sorted hashes.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    for first, last, data, offsets in text_chunks(column):
        starts, ends, rows = word_bounds(data, offsets)
        words = word_hashes(data, starts, ends, lower)
        grams = gram_hashes(words, n)
        for i in range(last - first):
            lo, hi = rows[i], rows[i + 1]
            if hi - lo >= n:
                yield np.unique(grams[lo : hi - n + 1])
            elif hi > lo:
                yield gram_hashes(words[lo:hi], int(hi - lo))
            else:
                yield np.zeros(0, np.uint64)


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))
