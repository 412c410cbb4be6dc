"""Token files: Arrow IPC files of fixed-size lists.

A part holds the ids of a range of documents in ascending ``doc_id`` order, cut
into rows of ``SEQUENCE`` ids: column ``ids`` (fixed-size list of uint16, or of
uint32 for vocabularies that need it) and column ``mask`` (fixed-size list of
booleans in bits: true for an id, false for the filling of the last row).  All
record batches but the last have ``ROWS`` rows, so row i is found without
reading anything before it, and a memory-mapped file gives it as a view of the
file.  A second file beside it lists the documents of the part with their place.

A task writes under a name of its own and reports it in the manifest; only files
in the manifest are read, so files of lost or repeated tasks do no harm.  The
folder must be one that all executors reach through pyarrow's file systems.

Null texts count as empty and have the end id only.  Null ids come first, rows
with equal ids are ordered by text.  An empty table has an empty manifest and
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import fresh_path, shuffle_width, staged
from .tokens import encoder

SEQUENCE = 2048
ROWS = 64
END_ID = 2
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _schema(length: int, wide: bool) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)), ("mask", pa.list_(pa.bool_(), length))],
                     metadata={"rows_per_batch": str(ROWS)})


class TokenWriter:
    """Writes ids row by row as they come; holds one batch at most."""

    def __init__(self, sink, length: int = SEQUENCE, wide: bool = False):
        self.length, self.held, self.size, self.total = length, [], 0, 0
        self.schema = _schema(length, wide)
        self.kind = np.uint32 if wide else np.uint16
        self.out = pa.ipc.new_file(sink, self.schema)

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids) // 4
        room = 4 * self.length * ROWS
        if self.size >= room:
            raw = b"".join(self.held)
            whole = len(raw) // room * room
            for at in range(0, whole, room):
                self._write(np.frombuffer(raw, "<u4", self.length * ROWS, at), self.length * ROWS)
            self.held, self.size = [raw[whole:]], len(raw) - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self.out.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids.astype(self.kind), mask)], schema=self.schema))

    def close(self) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        if len(ids):
            filled = np.zeros(-(-len(ids) // self.length) * self.length, np.uint32)
            filled[:len(ids)] = ids
            self._write(filled, len(ids))
        self.out.close()


class TokenFile:
    """Random access to a token file; rows are views of the file where it is mapped."""

    def __init__(self, source):
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.rows = int(self.reader.schema.metadata[b"rows_per_batch"])
        self.last: tuple[int, pa.RecordBatch | None] = (-1, None)

    def _batch(self, i: int) -> pa.RecordBatch:
        if self.last[0] != i:
            self.last = (i, self.reader.get_batch(i))
        return self.last[1]

    def _row(self, i: int, column: str) -> pa.Array:
        return self._batch(i // self.rows).column(column).values.slice(i % self.rows * self.length, self.length)

    def sequence(self, i: int) -> np.ndarray:
        return self._row(i, "ids").to_numpy()

    def mask(self, i: int) -> pa.BooleanArray:
        return self._row(i, "mask")

    def span(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from the ``start``-th id of the file on."""
        first, last = start // self.length, (start + n - 1) // self.length
        rows = [self.sequence(i) for i in range(first, last + 1)]
        flat = rows[0] if len(rows) == 1 else np.concatenate(rows)
        at = start - first * self.length
        return flat[at:at + n]


def open_source(uri: str):
    """A local file mapped into memory, or a file of another file system."""
    system, path = pa.fs.FileSystem.from_uri(uri)
    if isinstance(system, pa.fs.LocalFileSystem):
        return pa.memory_map(path)
    return system.open_input_file(path)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, parts: int, length: int = SEQUENCE, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and return their manifest (part, tokens, index, n_tokens,
    start), ``start`` being the number of ids in earlier parts."""
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        system, path = pa.fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        source = encoder(vocabulary)
        with system.open_output_stream(f"{path}/{name}.tokens.arrow") as sink, \
                system.open_output_stream(f"{path}/{name}.docs.arrow") as listing, pa.ipc.new_file(listing, INDEX) as index:
            out = TokenWriter(sink, length, source.size > 1 << 16)
            batch = first
            while batch is not None:
                starts, counts = [], []
                for raw in source.encode(batch.column("text").to_pylist()):
                    starts.append(out.total)
                    out.add(raw + end)
                    counts.append(out.total - starts[-1])
                index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts), pa.array(counts)], schema=INDEX))
                batch = next(batches, None)
            out.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "tokens": [f"{folder}/{name}.tokens.arrow"],
                                          "index": [f"{folder}/{name}.docs.arrow"], "n_tokens": [out.total]})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    written = staged(texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
                     .mapInArrow(write, "part long, tokens string, index string, n_tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = TokenFile(open_source(row["tokens"]))
                listed = pa.ipc.open_file(open_source(row["index"]))
                for k in range(listed.num_record_batches):
                    docs = listed.get_batch(k)
                    starts, counts = docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist()
                    sums = [crc32(tokens.span(s, n).astype("<u4").tobytes()) for s, n in zip(starts, counts)]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column("doc_id"), pa.array([s + row["start"] for s in starts], pa.int64()),
                         docs.column("n_tokens"), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = staged(manifest, "manifest")
    return files.repartition(max(1, files.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_arrow_tokens(spark, sf_dir: str) -> DataFrame:
    """Write ``documents`` as token files and read them back."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = write_tokens(docs, fresh_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"), shuffle_width(spark))
    return read_tokens(manifest)
