"""Cutting lineage safely: intermediate tables in a folder that all executors share."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, or the one its context was given; an error without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def ensure_local_folder(spark: SparkSession) -> None:
    """Give a session of one process a temporary folder if it names none; any other session must name its own."""
    context = spark.sparkContext
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir())
    if unset and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="daygrid-"))


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that holds a path, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, folder: str) -> bool:
    files, path = _files(spark, folder)
    return files.delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, path = _files(spark, path)
    return files.exists(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    files, path = _files(spark, folder)
    try:
        return sorted(status.getPath().getName() for status in files.listStatus(path))
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return []
        raise


def create_file(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file that does not exist yet; False if it does.

    One of several callers succeeds where the file system creates without overwriting in one step, as HDFS does.
    """
    files, path = _files(spark, path)
    try:
        out = files.create(path, False)
    except Py4JJavaError as error:
        if files.exists(path):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def text_of(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if it is gone."""
    files, path = _files(spark, path)
    try:
        stream = files.open(path)
    except Py4JJavaError:
        return None
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written."""
    files, path = _files(spark, path)
    return time.time() - files.getFileStatus(path).getModificationTime() / 1000


class Scratch:
    """Frozen frames that go when the ``with`` block ends. Frames made from them must not be read afterwards."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []

    def freeze(self, df: DataFrame) -> DataFrame:
        """Write ``df`` to the shared folder and read it back."""
        folder = f"{shared_folder(self.spark)}/frozen-{uuid.uuid4().hex}"
        self.folders.append(folder)
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def clear(self) -> None:
        while self.folders:
            remove(self.spark, self.folders.pop())

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.clear()


_scope: ContextVar[Scratch | None] = ContextVar("daygrid-scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scratch]:
    """Folders that ``new_folder`` names inside the block go when it ends."""
    with Scratch(spark) as scratch:
        token = _scope.set(scratch)
        try:
            yield scratch
        finally:
            _scope.reset(token)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one. It goes with the open ``scope``; without one it stays."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if scratch := _scope.get():
        scratch.folders.append(folder)
    return folder


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns. If it wrote tables on the way, the result is written too, and only that stays."""
    with scope(spark) as scratch:
        out = build()
        if not scratch.folders:
            return out
        folder = f"{shared_folder(spark)}/result-{uuid.uuid4().hex}"
        out.write.parquet(folder)
    return spark.read.schema(out.schema).parquet(folder)


def freeze(df: DataFrame) -> DataFrame:
    """A frozen frame that goes with the open ``scope``; without one, whoever owns the shared folder clears it."""
    folder = new_folder(df.sparkSession, "frozen")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
