"""Best-fit packing of documents into sequences of bounded length, in bulk-synchronous steps.

Pieces are range-sorted by length; pieces of one length are a run of ranks. Gaps (what is left of a sequence) of one size
are runs of sequence numbers. A step takes the longest run of pieces left and sweeps the gaps from its successor, the
smallest gap that holds it, upwards: pieces and gaps meet by rank, a gap takes one piece a sweep, and gaps that shrank
are swept again while they are large enough; what then remains opens new sequences. Runs, not rows, carry the state, so
the sweeps handle at most `capacity` lengths however many documents there are; the pieces themselves stay distributed
and find their place by their rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import sliced, stored, strings
from tallyhouse.llm.tokens import encoder, tokenizer_path

CAPACITY = 4096


def pieces(docs: DataFrame, tokenizer: str | None = None, end: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids and `end`; documents longer than `capacity` are cut
    into pieces of that length and a shorter last one. A null or empty text is one piece of one id."""
    path = tokenizer or tokenizer_path()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = pa.schema(list(zip(names, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in sliced(batches):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), enc.ids(strings(batch.column(1))), strict=True):
                ids = np.append(ids.astype("<u4"), np.uint32(end)).astype("<u4")
                rows += [(doc, k, at, len(x), zlib.crc32(x.tobytes())) for k, at in enumerate(range(0, len(ids), capacity)) if len(x := ids[at : at + capacity])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t.type) for t in kinds], schema=kinds)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """The placing of runs: (length, first rank, number, first sequence, offset); the i-th piece of such a row lies in the
    i-th sequence from the first. counts: pieces by length, each from 1 to capacity."""
    plan: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # room: runs of sequences
    rooms: list[int] = []  # those with runs, ascending
    used = 0

    def leave(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in gaps:
                gaps[room] = []
                insort(rooms, room)
            gaps[room].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = gaps[room].pop()
                take = min(left, number)
                leave(room, first + take, number - take)
                if not gaps[room]:
                    del gaps[room], rooms[bisect_left(rooms, room)]
            else:
                room, first = capacity, used
                take = min(left, -(-left // (capacity // length)))
                used += take
            plan.append((length, rank, take, first, capacity - room))
            leave(room - length, first, take)
            rank, left = rank + take, left - take
    return plan


def ranked(found: DataFrame) -> DataFrame:
    """The pieces range-sorted by length, id and piece, with their partition and their rank among its pieces of that length."""
    kinds = [("part", pa.int32()), ("place", pa.int64())]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            new = np.flatnonzero(np.diff(length, prepend=last))
            start = np.zeros(len(length), np.int64)
            start[new] = new
            place = np.arange(len(length)) - np.maximum.accumulate(start)
            head = len(length) if not len(new) else new[0]
            place[:head] += seen
            last, seen = length[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(place)], schema=pa.schema([*batch.schema, *kinds]))

    order = ["length", "doc_id", "piece", "ids_crc32"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(rank, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in found.schema)}, part int, place long")


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset.

    found has doc_id, piece, length and more; lengths are 1 to capacity. Every piece gets one place, offsets of a
    sequence are gapless from 0 and the result depends on the rows only up to repeated ones, which are interchangeable.
    To the driver go the counts by length and partition: at most capacity rows and one more a partition.
    """
    rows = stored(ranked(found))
    base: dict[tuple[int, int], int] = {}
    counts: dict[int, int] = {}
    for part, length, n in sorted(rows.groupBy("part", "length").count().collect()):
        base[part, length] = counts.get(length, 0)
        counts[length] = base[part, length] + n
    plan = np.array(sorted(sweep(counts, capacity)), np.int64).reshape(-1, 5)
    lengths, at = np.unique(plan[:, 0], return_index=True)
    begins = dict(zip(lengths.tolist(), zip(at.tolist(), [*at[1:].tolist(), len(plan)], strict=True), strict=True)) if len(at) else {}
    kinds = [("sequence_id", pa.int64()), ("offset", pa.int64())]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            length, part, rank = get("length"), get("part"), get("place").copy()
            to = np.zeros((len(length), 2), np.int64)
            pairs = part.astype(np.int64) << 32 | length
            for pair in np.unique(pairs):
                of, n = pairs == pair, int(pair & 0xFFFFFFFF)
                mine = plan[slice(*begins[n])]
                r = rank[of] + base[int(pair >> 32), n]
                row = mine[np.searchsorted(mine[:, 1], r, "right") - 1]
                to[of, 0], to[of, 1] = row[:, 3] + r - row[:, 1], row[:, 4]
            keep = [i for i, f in enumerate(batch.schema) if f.name not in ("part", "place")]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(to[:, 0]), pa.array(to[:, 1])], schema=pa.schema([*(batch.schema.field(i) for i in keep), *kinds]))

    return rows.mapInArrow(place, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in found.schema)}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """All documents, cut into pieces and packed; the pieces are stored first, as ranges are sampled from them."""
    return pack(stored(pieces(docs, tokenizer, end, capacity)), capacity)
