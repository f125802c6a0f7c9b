"""Operator 6: token ids as Arrow files of equal-length sequences.

Documents go in ascending doc_id order into Arrow IPC files: batches of
fixed-size lists ``input_ids`` and ``mask`` (true where a token stands), each
of ``length`` entries.  Tokens run on from one sequence to the next; only a
file's last sequence is padded.  So the values of a batch are one plain array,
a document's tokens are a slice of it, and any sequence is read by number from
a memory map without a copy.  An index table says where each document starts.

A task writes its files under names of its own attempt, and the index, a table
that Spark commits, names those that count: files of a lost attempt are never
read.  Memory holds one batch of sequences; files are closed at
``file_batches`` batches.

Defined cases: a null text counts as empty and has the end id alone; null
doc_ids come first; rows with one doc_id keep their rows, in the order of
their texts' SHA-256; an empty table gives no files and an empty result; other
columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from habiflow.llm.bpe import load_tokenizer, piece_encoder
from habiflow.llm.common import stored, text_or_empty
from habiflow.session import stage_path

LENGTH = 2048
BATCH = 512
FILE_BATCHES = 128
# pieces in a worker's table; about 0.2 kB each, in two generations
TABLE_ROOM = 600_000
INDEX = "doc_id long, file string, part int, piece int, first long, n_tokens long"


class SequenceWriter:
    """Packs token arrays into the files of one task."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int, batch: int, file_batches: int):
        self.fs, self.folder = pyarrow.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.name, self.dtype, self.length, self.batch, self.file_batches = name, dtype, length, batch, file_batches
        self.values = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("input_ids", pa.list_(self.values, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.room = np.zeros(batch * length, dtype)
        self.filled, self.written, self.batches, self.piece, self.out = 0, 0, 0, 0, None

    @property
    def file(self) -> str:
        return f"{self.name}-{self.piece}.arrow"

    def add(self, ids: np.ndarray) -> tuple[str, int, int]:
        """Where the tokens start: file, its number in the task, place in it."""
        if self.batches >= self.file_batches:
            self.close()
        place = self.file, self.piece, self.written + self.filled
        while len(ids):
            n = min(len(ids), len(self.room) - self.filled)
            self.room[self.filled:self.filled + n] = ids[:n]
            self.filled, ids = self.filled + n, ids[n:]
            if self.filled == len(self.room):
                self._flush()
        return place

    def _flush(self) -> None:
        rows = -(-self.filled // self.length)
        if not rows:
            return
        if self.out is None:
            self.sink = self.fs.open_output_stream(f"{self.folder}/{self.file}")
            self.out = pa.ipc.new_file(self.sink, self.schema)
        n = rows * self.length
        self.room[self.filled:n] = 0
        mask = np.arange(n) < self.filled
        self.out.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(self.room[:n], self.values), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        self.written, self.batches, self.filled = self.written + self.filled, self.batches + 1, 0

    def close(self) -> None:
        self._flush()
        if self.out is not None:
            self.out.close()
            self.sink.close()
        self.out, self.written, self.batches, self.piece = None, 0, 0, self.piece + 1


class SequenceFile:
    """Random access to one file; arrays are views of the mapped file where the file system maps."""

    def __init__(self, folder: str, file: str):
        fs, path = pyarrow.fs.FileSystem.from_uri(f"{folder}/{file}")
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("input_ids").type.list_size
        self._at, self._batch = -1, None
        self.full = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0

    def batch(self, k: int) -> pa.RecordBatch:
        if k != self._at:
            self._at, self._batch = k, self.reader.get_batch(k)
        return self._batch

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence ``k``."""
        b, r = self.batch(k // self.full), k % self.full
        return b.column(0)[r].values.to_numpy(), b.column(1)[r].values

    def tokens(self, first: int, n: int) -> np.ndarray:
        """``n`` tokens from place ``first``; a view unless they cross batches."""
        size, parts = self.full * self.length, []
        while n > 0:
            k, at = divmod(first, size)
            part = self.batch(k).column(0).flatten().to_numpy()[at:at + n]
            parts.append(part)
            first, n = first + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint16)


def write_sequences(docs: DataFrame, path: str, end_id: int, folder: str, length: int = LENGTH,
                    batch: int = BATCH, file_batches: int = FILE_BATCHES) -> DataFrame:
    """Encode ``docs`` into files under ``folder``; the index ``doc_id, file, part, piece, first, n_tokens``."""
    largest = max(load_tokenizer(path).get_vocab_size(with_added_tokens=True) - 1, end_id)
    dtype = np.dtype("<u2" if largest < 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = piece_encoder(path, dtype.str, TABLE_ROOM)
        end = np.array([end_id], dtype)
        part = TaskContext.get().partitionId()
        out = SequenceWriter(folder, f"part-{part:06d}-{uuid.uuid4().hex}", dtype, length, batch, file_batches)
        for b in batches:
            rows = []
            for t in b.column("text").to_pylist():
                ids = np.append(enc.encode(t), end)
                rows.append((*out.add(ids), len(ids)))
            file, piece, first, n = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(file, pa.string()), pa.array([part] * len(rows), pa.int32()),
                pa.array(piece, pa.int32()), pa.array(first, pa.int64()), pa.array(n, pa.int64())],
                names=["doc_id", "file", "part", "piece", "first", "n_tokens"])
        out.close()

    d = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    d = d.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.sha2("text", 256))
    return stored(d.mapInArrow(run, INDEX), "sequence_index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: the ids of all documents before.  Ordered sums only run over one row a file."""
    files = index.groupBy("part", "piece").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return index.join(files, ["part", "piece"]).withColumn("start", F.col("_before") + F.col("first")).drop("_before")


def read_documents(index: DataFrame, folder: str, function, schema: str) -> DataFrame:
    """``function(index rows of a file as a table, SequenceFile)`` for each file, rows in the order of the file."""

    def run(rows: pa.Table) -> pa.Table:
        return function(rows.sort_by("first"), SequenceFile(folder, rows.column("file")[0].as_py()))

    return index.groupBy("file").applyInArrow(run, schema)


def op6_token_output(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    folder = stage_path(docs.sparkSession, f"llm/sequences-{uuid.uuid4().hex}")
    index = write_sequences(docs, path, end_id, folder)

    def digest(rows: pa.Table, file: SequenceFile) -> pa.Table:
        places = zip(rows.column("first").to_pylist(), rows.column("n_tokens").to_pylist())
        crc = [zlib.crc32(file.tokens(f, n).astype("<u4").tobytes()) for f, n in places]
        return rows.select(["doc_id", "start", "n_tokens"]).append_column("ids_crc32", pa.array(crc, pa.int64()))

    return read_documents(with_starts(index), folder, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
