"""Token ids as flat binary files.

A folder holds, for each partition of the documents in ascending id, `<name>.ids` (unsigned little-endian integers, 16
bits if the vocabulary allows and else 32), `<name>.off` (n + 1 unsigned 64-bit offsets, in ids, from the partition's
first) and `<name>.doc` (64-bit document ids; documents without an id come first and are counted in the manifest).
`manifest.json` lists the partitions with their bases: the prefix sums of the ids before them.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import strings
from tallyhouse.llm.tokens import encoder, tokenizer_path

_PART = "part int, name string, n_docs long, n_null long, n_ids long, bits int"


def _open(folder: str):
    return fs.FileSystem.from_uri(folder)


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = 2, id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Writes the ids of every text, each followed by `end`, and returns the manifest's partitions.

    Null and empty texts are one id, `end`. Rows of one id stay apart, in the order of their texts' hashes. Other
    columns are not read. A task writes under a name of its own and only names of tasks that succeeded are in the
    manifest, so that lost or repeated tasks do no harm. Nothing but one row a partition reaches the driver.
    """
    path = tokenizer or tokenizer_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        bits, stop = 8 * enc.dtype.itemsize, np.array([end], enc.dtype).tobytes()
        part = TaskContext.get().partitionId()
        name, (store, root) = f"part-{part:06d}-{uuid.uuid4().hex}", _open(folder)
        n_docs = n_null = n_ids = 0
        with store.open_output_stream(f"{root}/{name}.ids") as ids, store.open_output_stream(f"{root}/{name}.off") as off, store.open_output_stream(f"{root}/{name}.doc") as doc:
            off.write(np.zeros(1, "<u8").tobytes())
            for batch in batches:
                if not batch.num_rows:
                    continue
                at = []
                for x in enc.ids(strings(batch.column(1))):
                    ids.write(x.tobytes() + stop)
                    n_ids += len(x) + 1
                    at.append(n_ids)
                off.write(np.array(at, "<u8").tobytes())
                doc.write(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs, n_null = n_docs + batch.num_rows, n_null + batch.column(0).null_count
        row = [part], [name], [n_docs], [n_null], [n_ids], [bits]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)], ["part", "name", "n_docs", "n_null", "n_ids", "bits"])

    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, _PART)
    found = sorted((r.asDict() for r in parts.collect()), key=lambda r: r["part"])
    for r, after in zip(found, accumulate(r["n_ids"] for r in found), strict=True):
        r["base"] = after - r["n_ids"]
    with store.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(found).encode())
    return found


def _view(store, path: str, dtype) -> np.ndarray:
    """A file's numbers; memory-mapped where the folder is a local path."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if store.get_file_info(path).size else np.empty(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """A row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (unsigned, of
    the ids as little-endian unsigned 32-bit integers) and, if asked for, the ids. No document: no row."""
    store, root = _open(folder)
    with store.open_input_file(f"{root}/manifest.json") as f:
        parts = [(r["name"], r["base"], r["n_null"], r["bits"]) for r in json.loads(f.readall()) if r["n_docs"]]
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            for name, base, n_null, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = _view(store, f"{root}/{name}.ids", f"<u{bits // 8}")
                off = _view(store, f"{root}/{name}.off", "<u8").astype(np.int64)
                doc = _view(store, f"{root}/{name}.doc", "<i8")
                for at in range(0, len(doc), 4096):
                    to = min(at + 4096, len(doc))
                    spans = [ids[a:b] for a, b in zip(off[at:to], off[at + 1 : to + 1], strict=True)]
                    out = [pa.array(doc[at:to], pa.int64(), mask=np.arange(at, to) < n_null), pa.array(off[at:to] + base), pa.array(np.diff(off[at : to + 1])), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in spans], pa.int64())]
                    if with_ids:
                        out.append(pa.array([x.astype(np.int64) for x in spans], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(out, schema=pa.schema(kinds))

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    todo = spark.createDataFrame(parts, "name string, base long, n_null long, bits int")
    return todo.repartition(max(1, len(parts))).mapInArrow(read, schema)
