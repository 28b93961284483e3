"""Words, hashes and windows of whole texts, as numpy arrays inside a task.

Arrow batches are cut into pieces of a few megabytes of text, so that memory follows the
longest text and not the batch. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 4 << 20
_CHUNK = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# Word separators: space and the bytes 9 to 13.
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``PIECE_BYTES`` of text, or a single row."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends, begin = np.cumsum(sizes.astype(np.int64)), 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, end to end, and the offsets of its rows."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def word_spans(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the offsets of the rows in them."""
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])[: len(data)]
    after = np.concatenate([inside[1:], [False]])[: len(data)]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_powers = np.cumprod(
    np.concatenate([[np.uint64(1)], np.full(_CHUNK, _MULTIPLIER, np.uint64)]), dtype=np.uint64
)
_inverses = np.cumprod(
    np.concatenate([[np.uint64(1)], np.full(_CHUNK, _INVERSE, np.uint64)]), dtype=np.uint64
)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= _CHUNK:
        return _powers, _inverses
    one = [np.uint64(1)]
    return tuple(
        np.cumprod(np.concatenate([one, np.full(n, base, np.uint64)]), dtype=np.uint64)
        for base in (_MULTIPLIER, _INVERSE)
    )


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """A 64-bit hash of every word; with ``lower``, of the word with A-Z in lower case."""
    out = np.empty(len(starts), np.uint64)
    codes = _BYTE_CODES[_LOWER] if lower else _BYTE_CODES
    i = 0
    while i < len(starts):
        origin = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, origin + _CHUNK, "right")))
        part = codes[data[origin : ends[j - 1]]]
        powers, inverses = _power_tables(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers[: len(part)], out=sums[1:])
        at = starts[i:j] - origin
        value = (sums[ends[i:j] - origin] - sums[at]) * inverses[at]
        out[i:j] = mix(value ^ ((ends[i:j] - starts[i:j]).astype(np.uint64) << np.uint64(48)))
        i = j
    return out


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive entries."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, width):
        total *= _MULTIPLIER
        total += hashes[k : k + n]
    return mix(total)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """Row number of every entry, from the offsets of the rows."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def words_of(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and the offsets of its rows in them."""
    data, offsets = raw(column)
    starts, ends, rows = word_spans(data, offsets)
    return word_hashes(data, starts, ends, lower), rows
