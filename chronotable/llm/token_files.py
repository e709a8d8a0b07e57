"""Token ids in Arrow stream files of equal-length sequences.

A shard is one Arrow IPC stream. Each row is a sequence: ``ids`` and ``mask``, both fixed-size lists of
``length`` items; the documents of the shard follow one another in ascending ``doc_id`` order, and only
the last sequence of a shard is padded (mask false). All batches but the last have the same number of
rows and hold no nulls, so they take the same number of bytes: batch ``k`` starts at
``schema end + k * batch size`` and any sequence can be read, or mapped without copying, by its number.
Beside it lies an index, also an Arrow stream, with the place of every document in its shard.

Files are written under names of their own by each attempt of a task; only those that the manifest
names count, so a lost executor leaves at most a file that nobody reads. Shared folders are reached by
``pyarrow.fs`` (file, hdfs, s3, gs), never through a machine's own temporary folder.

Nulls: a null text is encoded as the empty text, which is the end id alone; a null ``doc_id`` sorts
first. Rows that repeat a ``doc_id`` each keep a place, ordered by text. An empty table gives no shard
and an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import functools
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronotable.llm.common import batch_of, in_slices, texts
from chronotable.llm.encoding import ChunkEncoder
from chronotable.sources.workspace import materialize, work_folder

_MANIFEST = pa.schema([("shard", pa.int32()), ("ids_path", pa.string()), ("index_path", pa.string()), ("n_documents", pa.int64()), ("n_sequences", pa.int64()), ("n_tokens", pa.int64())])
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_DOCUMENTS = pa.schema([*_INDEX, ("ids_crc32", pa.int64())])


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(pa.field("item", pa.from_numpy_dtype(dtype), nullable=False), length)),
        ("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length)),
    ])


class SequenceWriter:
    """Cuts a stream of ids into equal sequences and writes them in equal batches."""

    def __init__(self, sink: pa.NativeFile, dtype: np.dtype, length: int, rows: int):
        self.dtype, self.length, self.room = dtype, length, rows * length
        self.schema = sequence_schema(dtype, length)
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.tokens = self.sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        while self.held + len(ids) >= self.room:
            cut = self.room - self.held
            self._flush([*self.waiting, ids[:cut]])
            ids, self.waiting, self.held = ids[cut:], [], 0
        if len(ids):
            self.waiting.append(ids)
            self.held += len(ids)

    def _flush(self, parts: list[np.ndarray]) -> None:
        ids = np.concatenate(parts)
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, self.dtype)
        padded[: len(ids)] = ids
        mask = np.arange(len(padded)) < len(ids)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((padded, mask), self.schema, strict=True)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.sequences += rows

    def close(self) -> None:
        if self.held:
            self._flush(self.waiting)
        self.stream.close()


class SequenceFile:
    """Random access to the sequences of a shard; local files are mapped, others read by range."""

    def __init__(self, uri: str):
        filesystem, path = fs.FileSystem.from_uri(uri)
        local = isinstance(filesystem, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else filesystem.open_input_file(path)
        self.schema = pa.ipc.read_schema(self.source)
        self.first = self.source.tell()
        self.length = self.schema.field("ids").type.list_size
        head = pa.ipc.read_message(self.source)
        self.step = self.source.tell() - self.first
        self.kept = (0, pa.ipc.read_record_batch(head, self.schema))
        self.rows = self.kept[1].num_rows

    def __enter__(self) -> SequenceFile:
        return self

    def __exit__(self, *_) -> None:
        self.source.close()

    def batch(self, k: int) -> pa.RecordBatch:
        """A batch; the last one is kept, as neighbouring texts share it."""
        if self.kept[0] != k:
            self.source.seek(self.first + k * self.step)
            self.kept = (k, pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema))
        return self.kept[1]

    def sequence(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of one sequence, both without a copy: the mask as Arrow keeps it, a bit for each position.

        A byte for each would make the files larger by two fifths.
        """
        row = self.batch(number // self.rows).slice(number % self.rows, 1)
        return row["ids"].flatten().to_numpy(), row["mask"].flatten()

    def ids(self, start: int, count: int) -> np.ndarray:
        """So many ids of the shard from a position."""
        per_batch = self.rows * self.length
        parts = []
        while count > 0:
            k, at = divmod(start, per_batch)
            values = self.batch(k)["ids"].flatten().to_numpy()[at : at + count]
            parts.append(values)
            start, count = start + len(values), count - len(values)
        return np.concatenate(parts) if len(parts) != 1 else parts[0]


@functools.cache
def _encoder(path: str, spaces: str) -> ChunkEncoder:
    return ChunkEncoder(path, spaces)


def _shard_writer(folder: str, tokenizer: str, end_id: int, length: int, rows: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, "kept")
        shard = TaskContext.get().partitionId()
        name = f"{folder.rstrip('/')}/shard-{shard:06d}-{uuid.uuid4().hex}"
        ending = np.array([end_id], encoder.dtype)
        writer, documents = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                filesystem, path = fs.FileSystem.from_uri(name)
                filesystem.create_dir(path.rpartition("/")[0], recursive=True)
                sink = filesystem.open_output_stream(f"{path}.ids.arrows")
                index_sink = filesystem.open_output_stream(f"{path}.index.arrows")
                writer = SequenceWriter(sink, encoder.dtype, length, rows)
                index = pa.ipc.new_stream(index_sink, _INDEX)
            starts, counts = [], []
            for part in in_slices(batch.column(1)):
                ids, bounds = encoder.encode(part)
                for begin, end in pairwise(bounds.tolist()):
                    starts.append(writer.tokens)
                    writer.add(ids[begin:end])
                    writer.add(ending)
                    counts.append(end - begin + 1)
            index.write_batch(batch_of(_INDEX, (batch.column(0), starts, counts)))
            documents += batch.num_rows
        if writer is not None:
            writer.close()
            index.close()
            sink.close()
            index_sink.close()
            yield batch_of(_MANIFEST, ([shard], [f"{name}.ids.arrows"], [f"{name}.index.arrows"], [documents], [writer.sequences], [writer.tokens]))

    return write


def write_token_files(documents: DataFrame, tokenizer: str, end_id: int = 0, length: int = 2048, rows: int = 32, folder: str | None = None) -> DataFrame:
    """Encode all documents and write them as shards in ascending ``doc_id`` order; returns the manifest.

    A shard is one range of ids, as large as the session's shuffle partitions. A task holds one batch
    of ``rows`` sequences of ``length`` ids at a time.
    """
    folder = folder or work_folder(documents.sparkSession)
    marked = texts(documents).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    # The mark cuts through ids that many rows share, nulls among them; texts themselves would be sampled for the bounds.
    ordered = marked.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text").drop("mark")
    return materialize(ordered.mapInArrow(_shard_writer(folder, tokenizer, end_id, length, rows), "shard int, ids_path string, index_path string, n_documents long, n_sequences long, n_tokens long"))


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids_path, index_path, offset in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            filesystem, path = fs.FileSystem.from_uri(index_path)
            with SequenceFile(ids_path) as shard, filesystem.open_input_stream(path) as source:
                for part in pa.ipc.open_stream(source):
                    starts, counts = (part.column(i).to_numpy() for i in (1, 2))
                    crcs = [zlib.crc32(shard.ids(s, n).astype("<u4").tobytes()) for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]
                    yield batch_of(_DOCUMENTS, (part.column(0), pa.array(starts + offset), part.column(2), crcs))


def read_documents(manifest: DataFrame) -> DataFrame:
    """Every document's place in the whole output and the checksum of its ids, read from the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # The window holds one narrow row per shard.
    placed = manifest.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = placed.select("ids_path", "index_path", "offset").repartition(max(1, manifest.count()))
    return spread.mapInArrow(_read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")
