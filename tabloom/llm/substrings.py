"""Remove passages that repeat across documents, by super-k-mers.

A window is ``width`` consecutive words. Its minimiser is the least hashed run of
``minimiser`` words inside it; equal windows have equal minimisers. Consecutive windows that
share one travel together as one packed string of 48-bit window codes (not of the words: at 13
words a window that moves half the bytes) to the bucket of their minimiser. Equal strings of a
piece of text are merged before the shuffle and carry the list of their places. In the bucket,
sorting finds the first document of every window.

Windows are equal if their minimisers agree in 32 bits and their codes in 48: of n different
windows, about n * n / 2 ** 81 pairs are taken for equal, one pair at a trillion windows or so. Rows
of a bucket come sorted, so a string that stands in very many documents is streamed: only the different
strings of one minimiser are held at a time.

Defined results: a null or empty text has no words and keeps the empty string; shorter texts
than a window lose nothing; rows repeated with the same id count as one document; documents
with a null id are never first and lose what any numbered document holds too. Rows that share an
id or have none are told apart by 64 bits of their text's hash. The greatest id of 64 bits stands
for none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import text as T
from tabloom.workspace import stage

CODE_BYTES = 6
_PLACE = np.dtype([("doc", "<i8"), ("row", "<i8"), ("at", "<i4")])
_LAST = np.iinfo(np.int64).max


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive entries."""
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )


def _super_kmers(batch: pa.RecordBatch, width: int, minimiser: int) -> pa.RecordBatch | None:
    """Packed strings of a piece of text and their places: bucket, packed, first_doc, places."""
    ids = batch.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False)
    words, offsets = T.words_of(batch.column(1))
    windows = len(words) - width + 1
    if windows <= 0:
        return None
    row = T.rows_of(offsets)
    whole = row[:windows] == row[width - 1 :]
    least = _sliding_min(T.rolling(words, minimiser), width - minimiser + 1)
    codes = T.rolling(words, width)
    at = np.flatnonzero(whole)
    if not len(at):
        return None
    least, codes, row_at = least[at], codes[at], row[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (row_at[1:] != row_at[:-1])
    begins = np.flatnonzero(new)
    lengths = np.diff(np.append(begins, len(at)))
    # Equal strings of this piece become one row with all their places.
    turn = np.arange(len(at)) - np.repeat(begins, lengths)
    mixed = T.mix(codes + turn.astype(np.uint64))
    sums = np.add.reduceat(mixed, begins) ^ T.mix(~least[begins])
    order = np.lexsort((ids[row_at[begins]], sums))
    first = np.ones(len(order), bool)
    first[1:] = sums[order][1:] != sums[order][:-1]
    places = np.empty(len(order), _PLACE)
    places["doc"] = ids[row_at[begins]][order]
    places["row"] = batch.column(2).to_numpy()[row_at[begins]][order]
    places["at"] = (at - offsets[row_at])[begins][order]
    chosen = order[first]
    size = lengths[chosen]
    take = np.repeat(begins[chosen] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    take += np.arange(size.sum())
    packed = codes[take].view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES].tobytes()
    ends_of_places = np.append(np.flatnonzero(first)[1:], len(order)) * _PLACE.itemsize
    return pa.RecordBatch.from_arrays(
        [
            pa.array((least[begins[chosen]] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
            _binary(np.frombuffer(packed, np.uint8), np.cumsum(size) * CODE_BYTES),
            pa.array(places["doc"][first]),
            _binary(places.view(np.uint8), ends_of_places),
        ],
        ["bucket", "packed", "first_doc", "places"],
    )


class _Marks:
    """Collects marked runs of windows and gives them out in batches."""

    def __init__(self):
        self.places, self.n = [], []

    def add(self, places, n):
        self.places.append(places)
        self.n.append(n)

    def size(self):
        return sum(map(len, self.n))

    def batch(self):
        places = np.concatenate([np.zeros(0, _PLACE), *self.places])
        n = np.concatenate([np.zeros(0, np.int32), *self.n]).astype(np.int32)
        self.__init__()
        columns = [pa.array(places[c].copy()) for c in ("doc", "row", "at")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n)], ["doc", "row", "at", "n"])


def _bucket_runs(
    batches: Iterator[pa.RecordBatch], marks: _Marks
) -> Iterator[tuple[list, list, list] | None]:
    """Different strings of whole buckets with places, some thousand at a time.

    Equal strings stand together, the one with the least document first. Places of the others
    are later ones: they are marked as they come and not kept. None: marks may have grown.
    """
    buckets, strings, places, held = [], [], [], 0
    later, size, first_doc = [], [], None

    def mark_later():
        members = np.frombuffer(b"".join(later), _PLACE)
        counts = np.array([len(x) for x in later], np.int64) // _PLACE.itemsize
        marks.add(members, np.repeat(np.array(size, np.int32), counts))
        later.clear()
        size.clear()

    for batch in batches:
        for bucket, packed, least, at in zip(*[c.to_pylist() for c in batch.columns]):
            if buckets and bucket == buckets[-1] and packed == strings[-1]:
                if least == first_doc:  # the same id in another piece
                    places[-1] += at
                else:
                    later.append(at)
                    size.append(len(packed) // CODE_BYTES)
            else:
                if held > 200_000 and bucket != buckets[-1]:
                    yield buckets, strings, places
                    buckets, strings, places, held = [], [], [], 0
                buckets.append(bucket)
                strings.append(packed)
                places.append(at)
                first_doc = least
                held += len(packed) // CODE_BYTES
        if len(later) > 20_000:
            mark_later()
            yield None
    mark_later()
    yield (buckets, strings, places) if buckets else None


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows whose words also start in an earlier document: doc, row, at, n."""
    marks = _Marks()
    for group in _bucket_runs(batches, marks):
        if marks.size() > 100_000:
            yield marks.batch()
        if group is None:
            continue
        buckets, strings, places = group
        members = np.frombuffer(b"".join(places), _PLACE)
        counts = np.array([len(p) for p in places]) // _PLACE.itemsize
        owner = np.repeat(np.arange(len(strings)), counts)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        first = np.minimum.reduceat(members["doc"], starts)
        size = np.array([len(s) for s in strings]) // CODE_BYTES
        # Later documents of a string repeat it whole.
        later = members["doc"] > first[owner]
        marks.add(members[later], size[owner][later])
        # For the first document of a string, compare its windows with those of other strings.
        codes = np.zeros((size.sum(), 8), np.uint8)
        codes[:, :CODE_BYTES] = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, CODE_BYTES)
        codes = codes.view(np.uint64).ravel()
        string = np.repeat(np.arange(len(strings)), size)
        key = np.array(buckets, np.int64)[string]
        order = np.lexsort((codes, key))
        new = np.ones(len(order), bool)
        new[1:] = (codes[order][1:] != codes[order][:-1]) | (key[order][1:] != key[order][:-1])
        begins = np.flatnonzero(new)
        least = np.minimum.reduceat(first[string[order]], begins)
        repeated = np.empty(len(order), bool)
        repeated[order] = np.repeat(least, np.diff(np.append(begins, len(order)))) < first[
            string[order]
        ]
        if repeated.any():
            offset = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
            mine = members["doc"] == first[owner]  # a document can hold a string many times
            for i in np.unique(string[repeated]):
                hits = offset[(lo := (np.cumsum(size) - size)[i]) : lo + size[i]][
                    repeated[lo : lo + size[i]]
                ]
                own = slice(starts[i], starts[i] + counts[i])
                found = np.repeat(members[own][mine[own]], len(hits))
                found["at"] += np.tile(hits, len(found) // len(hits)).astype(np.int32)
                marks.add(found, np.ones(len(found), np.int32))
    yield marks.batch()


def repeated_windows(docs: DataFrame, width: int = 13, minimiser: int = 3) -> DataFrame:
    """Runs of repeated windows: ``doc``, ``row``, ``at`` (first word) and ``n`` (windows in it).

    ``row`` is a 64-bit hash of the text, which tells rows of one id apart.
    """

    def pack(batches):
        for piece in T.pieces(batches):
            if (found := _super_kmers(piece, width, minimiser)) is not None:
                yield found

    packed = docs.select("doc_id", "text", F.xxhash64("text").alias("row")).mapInArrow(
        pack, "bucket int, packed binary, first_doc long, places binary"
    )
    return (
        packed.repartition("bucket")
        .sortWithinPartitions("bucket", "packed", "first_doc")
        .mapInArrow(_repeats, "doc long, row long, at int, n int")
    )


def drop_repeats(docs: DataFrame, width: int = 13, minimiser: int = 3) -> DataFrame:
    """Per document ``doc_id, n_words, n_removed, kept``: the text without repeated passages.

    Every word covered by a window that also starts in a document of a smaller id goes. Windows
    are judged on the input. ``kept`` is the remaining words joined by one space.
    """
    repeated = stage(repeated_windows(docs, width, minimiser), "repeats")
    runs = (
        repeated.groupBy("doc", F.col("row").alias("_row"))
        .agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    )
    texts = docs.select("doc_id", "text")
    same = (F.coalesce("doc_id", F.lit(_LAST)) == F.col("doc")) & (F.xxhash64("text") == F.col("_row"))
    joined = texts.join(runs, same, "left").select("doc_id", "text", F.col("runs.at").alias("at"), F.col("runs.n").alias("n"))

    def cut(batches):
        for batch in T.pieces(batches):
            data, offsets = T.raw(batch.column(1))
            starts, ends, rows = T.word_spans(data, offsets)
            held = data.tobytes()
            n_words, n_removed, kept = [], [], []
            runs_at, runs_n = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i in range(batch.num_rows):
                a, b = starts[rows[i] : rows[i + 1]], ends[rows[i] : rows[i + 1]]
                stay = np.ones(len(a), bool)
                if runs_at[i]:
                    change = np.zeros(len(a) + 1, np.int64)
                    begin = np.array(runs_at[i])
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + np.array(runs_n[i]) + width - 1, -1)
                    stay = np.cumsum(change[:-1]) == 0
                n_words.append(len(a))
                n_removed.append(len(a) - int(stay.sum()))
                kept.append(b" ".join([held[x:y] for x, y in zip(a[stay], b[stay])]).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
