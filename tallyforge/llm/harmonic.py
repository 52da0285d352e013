"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths are parted into classes by the reciprocals of the capacity: class ``k`` holds pieces of at most
``capacity // k`` tokens and its bins take ``k`` of them. A document is cut so that its pieces fill their class: first
whole sequences, then the largest class size that fits, until the rest is so short that rounding it up to its class
wastes little. Every worker fills the bins of each class on its own, without a shuffle; bins left open at the end of a
partition are poured together, largest piece first, into as few sequences as they fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.frames import grouped, worker_value
from tallyforge.llm.word_bpe import KEEP_CHARS, KEEP_WORDS, WordBpe, pieces

#: Rests up to this share of the capacity are not cut again: they lose at most 1/16 of their own length.
UNCUT = 16
#: Sequence numbers: the partition in the upper bits, the worker's own count in the lower ones.
NUMBER_BITS = 36


def cuts(length: int, capacity: int) -> list[int]:
    """Lengths of the pieces a document is cut into, in order."""
    parts = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        size = capacity // -(-capacity // rest)  # the largest reciprocal not above the rest
        if rest * UNCUT <= capacity or size == 0:
            break
        parts.append(size)
        rest -= size
    if rest:
        parts.append(rest)
    return parts


class Bins:
    """The open bins of one worker, one for each class."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.next, self.open = capacity, first, {}

    def add(self, piece: tuple, length: int) -> Iterator[tuple]:
        """The pieces of a bin that this one completes, as ``(piece, sequence, offset)``."""
        k = self.capacity // length
        waiting = self.open.setdefault(k, [])
        waiting.append((piece, length))
        if len(waiting) == k:
            del self.open[k]
            yield from self._close(waiting)

    def rest(self) -> Iterator[tuple]:
        """What is left open, first fit by falling length over all classes."""
        left = sorted((x for k in sorted(self.open) for x in self.open[k]), key=lambda x: -x[1])
        self.open = {}
        sequences: list[list] = []
        room: list[int] = []
        for piece, length in left:
            at = next((i for i, r in enumerate(room) if r >= length), None)
            if at is None:
                sequences.append([])
                room.append(self.capacity)
                at = len(room) - 1
            sequences[at].append((piece, length))
            room[at] -= length
        for sequence in sequences:
            yield from self._close(sequence)

    def _close(self, members: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for piece, length in members:
            yield piece, self.next, offset
            offset += length
        self.next += 1


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 1, with_ids: bool = False, keep_words: int = KEEP_WORDS) -> DataFrame:
    """A row per piece: where it stands in its document and in its sequence, with ``ids`` on demand.

    A null or empty text is the end id alone. Repeated rows are documents of their own. Ties in length keep the order of
    the rows. An empty table gives no sequence. Pieces in a sequence lie without a gap from offset 0, and every id of a
    document lies in exactly one piece. A worker keeps the ids of about ``keep_words`` words; what it forgets is encoded again.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = f"`{key}` {kind}, " + ", ".join(f"{n} {'array<int>' if n == 'ids' else 'long'}" for n in names[1:])
    end = int(end_id).to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_value(("bpe", path), lambda: WordBpe(path))
        table: dict[str, bytes] = worker_value(("ids", path), dict)
        bins = Bins(capacity, TaskContext.get().partitionId() << NUMBER_BITS)
        key_type = None

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            flat = [(*p[:5], s, o, *p[5:]) for p, s, o in rows]
            columns = list(zip(*flat, strict=True)) if flat else [[] for _ in names]
            kinds = [key_type] + [pa.int64()] * 6 + ([pa.list_(pa.int32())] if with_ids else [])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for part, texts in grouped(batches, "_text", keep=(("bpe", path), ("ids", path))):
            key_type = part.schema.field(0).type
            if len(table) > keep_words:
                first = list(islice(table.items(), keep_words // 3))
                table.clear()
                table.update(first)
            done: list[tuple] = []
            for doc, t in zip(part.column(0).to_pylist(), texts, strict=True):
                ids = _ids(bpe, table, t) + end
                n, start = len(ids) // 4, 0
                for length in cuts(n, capacity):
                    own = ids[4 * start : 4 * (start + length)]
                    piece = (doc, start, length, zlib.crc32(own), n) + ((np.frombuffer(own, "<u4").astype("i4"),) if with_ids else ())
                    done.extend(bins.add(piece, length))
                    start += length
            if done:
                yield emit(done)
        if key_type is not None and (left := list(bins.rest())):
            yield emit(left)

    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(pack, schema)


def _ids(bpe: WordBpe, table: dict[str, bytes], text: str) -> bytes:
    """The ids of a text as little-endian 32-bit numbers."""
    out = []
    for piece in pieces(text):
        words = bpe.words(piece)
        found = list(map(table.get, words))
        if None in found:
            new = dict(bpe.encode({w for w, x in zip(words, found, strict=True) if x is None}))
            found = [new[w] if x is None else x for w, x in zip(words, found, strict=True)]
            table.update((w, x) for w, x in new.items() if len(w) <= KEEP_CHARS)
        out.append(b"".join(found))
    return b"".join(out)
