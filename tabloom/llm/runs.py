"""Periodic runs: stretches of words that repeat themselves, word for word.

Two words are on one diagonal when they are equally far apart; that distance, the lag, is the
period of what they may belong to. Going through a text, each word's earlier occurrences continue
the diagonals that were matching or begin new ones, and a diagonal that ends after enough matches
is a run. A run of period q takes at least q matches, so lags from q to 2q - 1 need only look at
earlier occurrences of the same q words, not of one word; only where a diagonal begins is it
followed, and its matches are counted in strides, by hashes of the words ahead. That keeps the
cells visited near the number of words, also in a text that is one word a million times over.

Diagonals of a multiple of a run's period cover the same stretch and are dropped for it. Sequences
of words are compared exactly, ahead of a diagonal by 62 bits of hash.

Results for odd input: a null or empty text, or one of spaces, has no words and no runs. Rows are
judged one by one, whatever their ids. An empty table gives no rows. Columns besides ``doc_id``
and ``text`` pass unread, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.text import mix, pieces, raw, rows_of, word_spans

SCHEMA = (
    "doc_id {id}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
#: Lags below this are compared directly, word by word.
_DIRECT = 8
_PAIRS = 1 << 21
_FIELDS = ((2147483647, 1103515245), (2147483629, 1299709))


class _Ahead:
    """How many words match ahead of two places, by hashes of powers of two of words."""

    def __init__(self, words: np.ndarray) -> None:
        self.n, self.fields = len(words), []
        for prime, base in _FIELDS:
            p = np.uint64(prime)
            powers = np.ones(self.n + 1, np.uint64)
            filled, factor = 1, base % prime
            while filled <= self.n:
                more = min(filled, self.n + 1 - filled)
                powers[filled : filled + more] = powers[:more] * np.uint64(factor) % p
                filled, factor = filled + more, factor * factor % prime
            codes = mix(words.astype(np.uint64) * np.uint64(2 * base + 1) + np.uint64(prime)) % p
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(codes * powers[: self.n] % p, out=sums[1:])
            self.fields.append((p, powers, sums % p))

    def _equal(self, late: np.ndarray, early: np.ndarray, width: int) -> np.ndarray:
        same = np.ones(len(late), bool)
        for p, powers, sums in self.fields:
            a = (sums[late + width] + p - sums[late]) % p
            b = (sums[early + width] + p - sums[early]) % p
            same &= a == b * powers[late - early] % p
        return same

    def matches(self, late: np.ndarray, early: np.ndarray) -> np.ndarray:
        found = np.zeros(len(late), np.int64)
        for k in range(self.n.bit_length(), -1, -1):
            at = np.flatnonzero(late + found + (1 << k) <= self.n)
            at = at[self._equal(late[at] + found[at], early[at] + found[at], 1 << k)]
            found[at] += 1 << k
        return found


def _enough(lags: np.ndarray | int, shortest: int) -> np.ndarray | int:
    """Matches that a diagonal needs for a run of ``shortest`` words and two periods."""
    return np.maximum(shortest - lags, lags)


def _near(words: np.ndarray, shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Starts and lengths of stretches of small lags."""
    for lag in range(1, min(_DIRECT, len(words))):
        same = np.concatenate([[False], words[lag:] == words[:-lag], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        begin, end = edges[::2], edges[1::2]
        held = end - begin >= _enough(lag, shortest)
        yield begin[held], end[held] - begin[held] + lag, lag


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries stand more than once, and dense numbers of these."""
    values, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
    dense = np.cumsum(counts > 1) - 1
    held = counts[number] > 1
    return held, dense[number[held]]


def _beginnings(
    words: np.ndarray, at: np.ndarray, kinds: np.ndarray, width: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where diagonals of lags from ``width`` to twice that begin: later and earlier places.

    ``at`` are the places of repeated sequences of ``width`` words and ``kinds`` their numbers.
    A place whose sequence stands at most half of it before has the same word before it as all
    places of that sort, so a diagonal can begin at two of them only if one is the first.
    """
    order = np.lexsort((at, kinds))
    at, kinds = at[order], kinds[order]
    room = len(words) + 1
    key = kinds * room + at
    near = np.zeros(len(at), bool)
    near[1:] = (kinds[1:] == kinds[:-1]) & (at[1:] - at[:-1] <= width // 2)
    first = np.flatnonzero(~near)
    low = kinds[first] * room
    for least, most, later in ((1 - 2 * width, -width, False), (width, 2 * width - 1, True)):
        begin = np.searchsorted(key, low + np.clip(at[first] + least, 0, room - 1), "left")
        end = np.searchsorted(key, low + np.clip(at[first] + most, -1, room - 1), "right")
        counts = np.maximum(end - begin, 0)
        total, i = np.cumsum(counts), 0
        while i < len(first):
            before = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, before + _PAIRS, "right")))
            own = np.repeat(np.arange(i, j), counts[i:j])
            offset = np.arange(len(own)) - np.repeat(total[i:j] - counts[i:j] - before, counts[i:j])
            here, there = at[first[own]], at[begin[own] + offset]
            late, early = (there, here) if later else (here, there)
            starts = words[late - 1] != words[early - 1]
            yield late[starts], early[starts]
            i = j


def find(
    words: np.ndarray, rows: np.ndarray, shortest: int = 12
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs, in order.

    ``words`` are numbers of words, all texts end to end, each followed by a number that stands
    nowhere else, and one such before the first; ``rows`` is the text of every word.
    """
    found = [(s, n, np.full(len(s), lag)) for s, n, lag in _near(words, shortest)]
    held, kinds = _repeated(rows * (int(words.max(initial=0)) + 1) + words)
    at, width, ahead = np.flatnonzero(held), 1, None
    while len(at):
        if width >= _DIRECT:
            for late, early in _beginnings(words, at, kinds, width):
                if not len(late):
                    continue
                ahead = ahead or _Ahead(words)
                matches, lag = ahead.matches(late, early), late - early
                enough = matches >= _enough(lag, shortest)
                found.append((early[enough], (matches + lag)[enough], lag[enough]))
        # A sequence twice as wide is repeated only if both halves are.
        number = np.full(len(words) + width, -1, np.int64)
        number[at] = kinds
        after = number[at + width]
        both = after >= 0
        at, keys = at[both], kinds[both] * (int(kinds.max()) + 1) + after[both]
        held, kinds = _repeated(keys)
        at, width = at[held], 2 * width
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _piece(batch: pa.RecordBatch, shortest: int) -> pa.RecordBatch:
    data, offsets = raw(batch.column("text"))
    starts, ends, bounds = word_spans(data, offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letters = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    edges = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    held = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(letters.tobytes())]
    )
    encoded = held.dictionary_encode()
    numbers = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # A border before each text and after the last, each with a number of its own.
    n_rows, text = batch.num_rows, rows_of(bounds)
    words = np.empty(len(numbers) + n_rows + 1, np.int64)
    rows = np.empty(len(words), np.int64)
    place = np.arange(len(numbers)) + text + 1
    border = bounds + np.arange(n_rows + 1)
    words[place], rows[place] = numbers, text
    words[border], rows[border] = len(encoded.dictionary) + np.arange(n_rows + 1), np.arange(n_rows + 1)
    start, length, period = find(words, rows, shortest)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    keep = np.cumsum(gone)[place] == 0
    kept = np.concatenate([[0], np.cumsum(keep)])[bounds]
    lists = pa.ListArray.from_arrays(
        pa.array(kept, pa.int32()), held.filter(pa.array(keep)).cast(pa.binary())
    )
    own = rows[start]
    runs = pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (start - border[own] - 1, length, period)],
        names=[f.name for f in _RUN],
    )
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(np.diff(bounds), pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(n_rows + 1)), pa.int32()), runs),
            pc.binary_join(lists, b" ").cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def collapse(docs: DataFrame, shortest: int = 12) -> DataFrame:
    """Each row's runs, and its text with only the first period of every run left.

    A run is a stretch of at least ``shortest`` words and twice its smallest period that neither
    neighbouring word continues. Returns ``doc_id``, ``n_words``, ``runs`` (start, length and
    period in words, by start and period) and ``collapsed`` (the words left, one space between).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield _piece(batch, shortest)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, SCHEMA.format(id=kind))


def repeat_from(text: Column, start: Column, period: Column) -> Column:
    """``text`` whose words from number ``start`` on repeat the first ``period`` of them."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rest = F.size(words) - start
    times = F.ceil(rest / period).cast("int")
    made = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
    return F.array_join(F.concat(F.slice(words, F.lit(1), start), F.slice(made, F.lit(1), rest)), " ")
