"""Byte strings of 100 bytes that occur earlier in the corpus, removed exactly.

Sampled suffixes stand in for all: the least hash among the 24-byte strings of a 100-byte window is the window's anchor,
so equal windows have equal anchors at equal places. Windows in a row with one anchor are a unit, some 40 bytes of starts.
Units are dealt out by their anchor's hash and sorted there: a unit whose bytes occurred before is removed whole; an anchor
that only one unit has repeats nothing. Units that share an anchor and differ in bytes are cut at fixed distances from the
anchor and dealt out again, by the bytes that all windows of a part share; what then is left shares these and differs, and
is compared window by window. Equality of units, parts and windows is that of 128-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import mix, sliced, stored

LENGTH, GRAM, PART = 100, 24, 8
#: Buckets of document ids by which texts that a step needs are told from others before they are moved.
BUCKETS = 1 << 20
_U = np.uint64
_HIGH = _U(0xFFFFFFFF00000000)
#: Kinds of rows that are dealt out: a unit by its anchor, a unit by its bytes, a sign that an anchor has several units, a unit known to be repeated.
BY_ANCHOR, BY_BYTES, SEVERAL, REPEATED = 0, 1, 2, 3
_COLS = ["key", "kind", "e1", "e2", "doc", "first", "last", "at"]
_SCHEMA = "key long, kind int, e1 long, e2 long, doc long, first long, last long, at long"


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """First and last start of the windows of each unit, its anchor's place and the anchor's hash."""
    n = len(data)
    if n < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, _U),)
    word = np.ndarray((n - 7,), "<u8", buffer=data, strides=(1,))
    m = n - gram + 1
    with np.errstate(over="ignore"):
        h = mix(word[:m] * _U(0x9E3779B97F4A7C15) + word[8 : 8 + m] * _U(0xC2B2AE3D27D4EB4F) + word[16 : 16 + m] * _U(0x165667B19E3779F9))
    low = (h & _HIGH) | np.arange(m, dtype=_U)
    wide, span = length - gram + 1, 1
    while 2 * span <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    least = np.minimum(low[: n - length + 1], low[wide - span :][: n - length + 1])
    at = (least & ~_HIGH).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return first, np.append(first[1:], len(at)) - 1, at[first], h[at[first]]


def _digests(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)


def _new(*cols: np.ndarray) -> np.ndarray:
    """Whether a sorted row differs from the one before in any column."""
    out = np.ones(len(cols[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return out


def _batch(cols: list[np.ndarray]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=_COLS)


def _texts(batch: pa.RecordBatch, i: int) -> list[bytes]:
    return [b"" if x is None else x for x in batch.column(i).to_pylist()]


def _dealt(rows: list[tuple[np.ndarray, ...]], digests: list[bytes]) -> pa.RecordBatch:
    """Rows (key, doc, first, last, at) and the hashes of their bytes, made ready for dealing. Of rows with the same bytes
    the earliest stays and the rest are known to be repeated and dealt out anywhere; where a key has several left, these are dealt out by their
    bytes, with one sign by the key."""
    key, doc, first, last, at = (np.concatenate(c).astype(np.int64) for c in zip(*rows, strict=True))
    e1, e2 = _digests(digests).T
    order = np.lexsort((first, doc, e2, e1))
    key, doc, first, last, at, e1, e2 = (c[order] for c in (key, doc, first, last, at, e1, e2))
    new = _new(e1, e2)
    head = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
    again = ~new & ((doc > doc[head]) | (first > first[head]))
    kind = np.where(again, REPEATED, BY_ANCHOR)
    _, of, often = np.unique(key[~again], return_inverse=True, return_counts=True)
    kind[np.flatnonzero(~again)[often[of] > 1]] = BY_BYTES
    signs = np.unique(key[kind == BY_BYTES])
    none = np.zeros(len(signs), np.int64)
    return _batch([np.concatenate(c) for c in zip((np.select([kind == BY_ANCHOR, kind == BY_BYTES], [key, e1], mix((doc ^ (first << 20)).astype(_U)).astype(np.int64)), kind, e1, e2, doc, first, last, at), (signs, none + SEVERAL, *[none] * 6), strict=True)])


def deal_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units of documents (doc, data)."""
    for whole in batches:
        for part in range(0, whole.num_rows, 2000):
            batch = whole.slice(part, 2000)
            rows, digests = [], []
            for doc, data in zip(batch.column(0).to_pylist(), _texts(batch, 1), strict=True):
                first, last, at, h = anchors(data)
                if len(first):
                    rows.append((h.astype(np.int64), np.full(len(first), doc), first, last, at))
                    digests += [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)]
            if rows:
                yield _dealt(rows, digests)


def deal_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of the units listed for documents (doc, data, units): windows whose distances from the anchor are the same
    up to the last three bits. Their key is the bytes that all windows at such distances hold."""
    for whole in batches:
        for part in range(0, whole.num_rows, 2000):
            batch = whole.slice(part, 2000)
            rows, digests = [], []
            for doc, data, units in zip(batch.column(0).to_pylist(), _texts(batch, 1), batch.column(2).to_pylist(), strict=True):
                for u in units:
                    a, b, y = u["first"], u["last"], u["at"]
                    for k in range((y - b) // PART, (y - a) // PART + 1):
                        p, q, core = max(a, y - PART * k - PART + 1), min(b, y - PART * k), y - PART * k
                        rows.append((xxhash.xxh3_64_intdigest(data[core : core + LENGTH - PART + 1]), doc, p, q, y))
                        digests.append(xxhash.xxh3_128_digest(data[p : q + LENGTH]))
            if rows:
                key, *rest = zip(*rows, strict=True)
                yield _dealt([(np.array(key, _U).astype(np.int64), *(np.array(c, np.int64) for c in rest))], digests)


def deal_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the parts listed for documents (doc, data, units)."""
    for whole in batches:
        for part in range(0, whole.num_rows, 2000):
            batch = whole.slice(part, 2000)
            rows, digests = [], []
            for doc, data, units in zip(batch.column(0).to_pylist(), _texts(batch, 1), batch.column(2).to_pylist(), strict=True):
                for p in sorted({p for u in units for p in range(u["first"], u["last"] + 1)}):
                    rows.append((doc, p))
                    digests.append(xxhash.xxh3_128_digest(data[p : p + LENGTH]))
            if rows:
                doc, p = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                yield _dealt([(_digests(digests)[:, 0], doc, p, p, p)], digests)


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows dealt out and sorted by key, bytes, document and start. Out: doc, first, last, at, repeated; rows that are not
    repeated are the first of their bytes and share a key with others. One row is carried from batch to batch."""
    kinds = pa.schema([("doc", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("at", pa.int64()), ("repeated", pa.bool_())])
    carry: list[np.ndarray] | None = None  # the last group's last new bytes
    sent = several_before = False

    def out(*cols: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(map(pa.array, cols)), schema=kinds)

    for batch in batches:
        if not batch.num_rows:
            continue
        key, kind, e1, e2, doc, first, last, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if (known := kind == REPEATED).any():
            yield out(doc[known], first[known], last[known], at[known], np.ones(known.sum(), bool))
            key, kind, e1, e2, doc, first, last, at = (c[~known] for c in (key, kind, e1, e2, doc, first, last, at))
            if not len(key):
                continue
        held = carry is not None
        if held:
            key, kind, e1, e2, doc, first, last, at = (np.concatenate([a, b]) for a, b in zip(carry, (key, kind, e1, e2, doc, first, last, at), strict=True))
        group = np.cumsum(_new(key)) - 1
        unit = kind != SEVERAL
        new = _new(key, e1, e2, unit)
        head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        several = np.bincount(group, unit & new) > 1
        several |= np.bincount(group, ~unit | (kind == BY_BYTES)) > 0
        if held:
            several[0] |= several_before
        again = unit & ~new & ((doc > doc[head]) | ((doc == doc[head]) & (first > first[head])))
        leads = unit & new & several[group]
        if held and sent:
            leads[0] = False
        chosen = again | leads
        yield out(doc[chosen], first[chosen], last[chosen], at[chosen], again[chosen])
        end = group == group[-1]
        tail = np.flatnonzero(end & unit & new)
        several_before = bool(several[-1])
        lead = tail[-1] if len(tail) else len(key) - 1
        sent = several_before
        carry = [c[lead : lead + 1] for c in (key, kind, e1, e2, doc, first, last, at)]


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_bytes, spans (maximal removed runs of bytes), kept (the other bytes) of documents (doc, text as bytes,
    starts removed)."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kinds = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])
    for batch in sliced(batches):
        rows = []
        for doc, data, gone in zip(batch.column(0).to_pylist(), _texts(batch, 1), batch.column(2).to_pylist(), strict=True):
            n, spans = len(data), []
            if gone:
                step = np.zeros(n + 1, np.int32)
                np.add.at(step, [u["first"] for u in gone], 1)
                np.add.at(step, [u["last"] + LENGTH for u in gone], -1)
                covered = np.cumsum(step[:-1]) > 0
                edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0)).tolist()
                spans = [{"start": i, "end": j} for i, j in zip(edges[::2], edges[1::2], strict=True)]
                data = np.frombuffer(data, np.uint8)[~covered].tobytes()
            rows.append((doc, n, spans, data))
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t.type) for t in kinds], schema=kinds)


def _settled(rows: DataFrame, deal: Callable) -> DataFrame:
    dealt = rows.mapInArrow(deal, _SCHEMA).repartition("key").sortWithinPartitions("key", "e1", "e2", "doc", "first")
    return stored(dealt.mapInArrow(settle, "doc long, first long, last long, at long, repeated boolean"))


def _listed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc").agg(F.collect_list(F.struct("first", "last", "at")).alias("units"))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc"), F.lit(BUCKETS))


def _buckets(rows: DataFrame) -> DataFrame:
    """The buckets of documents, for a broadcast: BUCKETS rows at most."""
    return F.broadcast(rows.select(_bucket().alias("bucket")).distinct())


def _with_units(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """doc, data, units of the documents that rows are about; others are dropped before texts are moved, as far as their
    buckets allow."""
    near = texts.withColumn("bucket", _bucket()).join(_buckets(rows), "bucket", "left_semi")
    return near.join(_listed(rows), "doc").select("doc", "data", "units")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (start, end of every maximal removed run of UTF-8 bytes), kept (the remaining bytes, joined;
    a run may end inside a character), a row per row.

    Null texts are empty; texts under 100 bytes lose nothing. Rows of one id count as one place: what only they share
    stays. Rows without an id are kept whole and make nothing else repeated.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("data"))
    named = texts.where("doc is not null")
    units = _settled(named, deal_units)
    parts = _settled(_with_units(named, units.where("not repeated")), deal_parts)
    windows = _settled(_with_units(named, parts.where("not repeated")), deal_windows)
    gone = units.unionByName(parts).unionByName(windows).where("repeated")
    schema = "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary"
    bucketed = texts.withColumn("bucket", _bucket())
    whole = bucketed.join(_buckets(gone), "bucket", "left_anti").select("doc", "data", F.array().cast("array<struct<first:bigint,last:bigint,at:bigint>>").alias("units"))
    rest = bucketed.join(_buckets(gone), "bucket", "left_semi").join(_listed(gone), "doc", "left").select("doc", "data", "units")
    return whole.mapInArrow(cut, schema).unionByName(rest.mapInArrow(cut, schema))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of what remove_repeats() returns."""
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
