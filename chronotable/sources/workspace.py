"""Where intermediate tables go, and small files in shared folders."""

from __future__ import annotations

import contextlib
import functools
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "spark.checkpoint.dir"
# A session of one process; in all others a machine's own folder is not seen by the other processes.
_ONE_PROCESS = re.compile(r"local(\[[^\]]*\])?")

_written: list[str] = []


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="chronotable-")


def work_folder(spark: SparkSession, lasting: bool = False) -> str:
    """A fresh folder under the shared one that the session names in ``spark.checkpoint.dir``.

    ``remove_intermediates`` deletes it unless it is ``lasting``. Only a session of one process may go without that setting; on a cluster a machine's own temporary
    folder would be lost with the machine.
    """
    shared = spark.conf.get(_FOLDER, None)
    if not shared:
        if not _ONE_PROCESS.fullmatch(spark.sparkContext.master):
            raise ValueError(f"set {_FOLDER} to a folder that every executor can reach")
        shared = _local_folder()
    path = f"{shared.rstrip('/')}/chronotable-{uuid.uuid4().hex}"
    if not lasting:
        _written.append(path)
    return path


def _save(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame once as a columnar table in the work folder and read it back.

    Cuts the lineage and survives the loss of executors; unlike a checkpoint the table still
    allows column pruning and filter pushdown. It stays until ``remove_intermediates``.
    """
    return _save(df, work_folder(df.sparkSession))


def materialize_step(spark: SparkSession, step: Callable[[], DataFrame]) -> DataFrame:
    """Like ``materialize`` for what a step returns; what the step wrote on its way there is deleted afterwards."""
    before = len(_written)
    done = materialize(step())
    result = _written.pop()
    while len(_written) > before:
        remove(spark, _written.pop())
    _written.append(result)
    return done


def remove_intermediates(spark: SparkSession) -> None:
    """Delete all work folders of this process; frames that still read them fail afterwards."""
    while _written:
        remove(spark, _written.pop())


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Like ``materialize``, for tables that are not needed after the block."""
    folder = work_folder(spark, lasting=True)
    count = iter(range(1_000_000))
    try:
        yield lambda df: _save(df, f"{folder}/{next(count)}")
    finally:
        remove(spark, folder)


# Small files, by the file systems that Spark itself is set up with


def _at(spark: SparkSession, path: str) -> tuple[object, object]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def remove(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    files, at = _at(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, at = _at(spark, path)
    source = files.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all its text in one step; False if it is there already.

    The text goes to a file of another name, which then gets its own: locally by a hard link, elsewhere by
    a rename that does not overwrite. Either fails if the name is taken, so of several writers one
    succeeds, and one that dies on the way leaves nothing under the name.
    """
    draft = f"{path.rpartition('/')[0]}/_draft-{uuid.uuid4().hex}"
    files, at = _at(spark, draft)
    out = files.create(at, False)
    out.write(bytearray(text.encode()))
    out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        if files.getScheme() == "file":
            os.link(urlparse(at.toUri().toString()).path, urlparse(target.toUri().toString()).path)
            return True
        options = spark._jvm.org.apache.hadoop.fs.Options.Rename
        none = spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(at, target, none)
        return True
    except FileExistsError:
        return False
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    finally:
        files.delete(at, False)
