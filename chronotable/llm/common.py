"""What the operators of this folder share."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotable.sources.workspace import work_folder


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the session's Python workers, which need not have it on their path.

    Like ``--py-files``, but from the place that this process imported it from; once for each application.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    _shipped.add(application)
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    folder = work_folder(spark, lasting=True)
    files, at = fs.FileSystem.from_uri(folder)
    files.create_dir(at, recursive=True)
    with files.open_output_stream(f"{at}/{package.name}.zip") as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(f"{at if isinstance(files, fs.LocalFileSystem) else folder}/{package.name}.zip")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the whole text, a null text as the empty one; all other columns go."""
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


_SHARES = 1 << 30


def first_by_hash(ids: DataFrame, most: int, column: str = "doc_id") -> DataFrame:
    """At most so many of the ids, those whose hash comes first.

    A bound on the hash that some four times as many pass keeps what is sorted as small as the sample, however many tasks there are.
    """
    order = F.pmod(F.xxhash64(column), F.lit(_SHARES))
    bound = min(_SHARES, 4 * most * _SHARES // max(ids.count(), 1))
    return ids.where(order < bound).orderBy(order, column).limit(most)


def in_groups(texts: pa.Array, chars: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in order, in groups of about so many characters, so that lists of words stay small."""
    group: list[str] = []
    size = 0
    for value in texts:
        text = value.as_py() or ""
        group.append(text)
        size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def in_slices(texts: pa.Array, size: int = 20_000_000) -> Iterator[pa.Array]:
    """The texts in order, in slices of about so many bytes; one long text makes a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Return freed memory to the system: a worker process outlives its task, and other stages need the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    arrays = [
        column if isinstance(column, pa.Array) else pa.array(column, field.type)
        for column, field in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
