"""The folder that executors share, and tables kept there between two uses."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """checkpoint() and stored() use spark.checkpoint.dir. Where it is unset, a local run has a folder of this machine's own;
    on a cluster that is an error, as each executor would write to its own disk."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quillmine-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt evenly over several tasks a core, for work that takes long for the bytes it reads."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


#: Tables of this process that stored() wrote and nobody has removed yet.
_WRITTEN: list[str] = []


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written once as Parquet into the shared folder and read again, and its path: later steps survive lost executors
    without computing df anew, and a partition's rows stay as they were."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quillmine/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """stored_at() for a table that the caller's result still reads: release() removes it once that result is used."""
    return stored_at(df, name)[0]


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file that nothing reads any more."""
    found, store = _path(spark, path)
    store.delete(found, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def release(spark: SparkSession) -> None:
    """Deletes all stored tables of this process; results that read them cannot be used afterwards."""
    for path in list(_WRITTEN):
        remove(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    found, store = _path(spark, path)
    return store.exists(found)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern."""
    found, store = _path(spark, pattern)
    return [status.getPath().toString() for status in (store.globStatus(found) or [])]


def _uri(path: str) -> str:
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


def put_file(path: str, content: bytes | Iterator[bytes]) -> int:
    """Writes one file (bytes, or pieces as they come) from a task, under another name first, so that it appears whole or not at
    all, and again after a retry; its size."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(_uri(path))
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    aside = f"{place.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    size = 0
    try:
        with store.open_output_stream(aside) as out:
            for piece in [content] if isinstance(content, bytes) else content:
                size += out.write(piece)
        store.move(aside, place)
    except BaseException:
        if store.get_file_info(aside).type != fs.FileType.NotFound:
            store.delete_file(aside)
        raise
    return size


def clear_folder(path: str) -> None:
    """Takes the files out of a folder, from a task."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(_uri(path))
    if store.get_file_info(place).type == fs.FileType.Directory:
        store.delete_dir_contents(place)
