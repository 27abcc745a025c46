"""Words of UTF-8 texts as 64-bit hashes, computed with numpy over whole Arrow buffers.

A word's hash is a polynomial of its bytes modulo 2**64, mixed afterwards. Prefix sums give every word's polynomial at once,
so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_STEP = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int) -> np.ndarray:
    out = np.full(_STEP, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes of the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Words are runs of anything but a blank or \t \n \v \f \r.
WHITE = separators((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of a-z, 0-9 and bytes from 0x80, after A-Z are lower-cased.
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that every bit depends on all of them."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _piece(raw: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words in at most a few million bytes."""
    low = _LOWER[raw]
    edge = np.diff(np.concatenate(([True], split[low], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    powers, inverse = _POWERS, _INVERSE
    if len(low) > _STEP:  # one word longer than a step
        grown = np.arange(len(low) + 1, dtype=np.uint64)
        powers = np.full(len(low), _BASE, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        inverse = np.full(len(grown), pow(_BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers[: len(low)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64)), starts, ends


def word_hashes(raw: np.ndarray, split: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start byte of every lower-cased word of the bytes, in order.

    Long inputs are worked on in slices that end at a separator, so memory beyond the result stays bounded.
    """
    if len(raw) <= _STEP:
        h, starts, _ = _piece(raw, split)
        return h, starts
    hashes, places, at = [], [], 0
    while at < len(raw):
        end = min(at + _STEP, len(raw))
        while end < len(raw):  # back to the last separator of the slice, or on to the next one
            cut = np.flatnonzero(split[_LOWER[raw[at:end]]])
            if len(cut):
                end = at + int(cut[-1]) + 1
                break
            end = min(end + _STEP, len(raw))
        h, starts, _ = _piece(raw[at:end], split)
        hashes.append(h)
        places.append(starts + at)
        at = end
    return np.concatenate(hashes), np.concatenate(places)


def text_chunks(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows [first, last) of a string column with their bytes and len+1 byte offsets; null counts as empty.

    A run holds at most ``most_bytes``, or one row.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def rows_of_words(raw: np.ndarray, offsets: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a run of rows, and len+1 offsets that say where each row's words begin.

    Rows lie side by side in the buffer, so one separator byte is put between them.
    """
    n = len(offsets) - 1
    if n == 1:
        h, _ = word_hashes(raw, split)
        return h, np.array([0, len(h)])
    spaced = np.full(len(raw) + n, 0x20, np.uint8)
    lengths = np.diff(offsets)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(n), lengths)] = raw
    h, starts = word_hashes(spaced, split)
    return h, np.searchsorted(starts, np.append(offsets[:-1] + np.arange(n), len(spaced)))
