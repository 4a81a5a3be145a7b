"""Folders and marker files on whatever file system a path names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")

#: Calls to the file system that may wait at the same time, and the fewest that are worth it.
THREADS, FEW = 16, 32


@lru_cache(maxsize=4)
def _hadoop(context):
    """Classes and settings, looked up once: every part of a class name is a search through all jars."""
    jvm = context._jvm
    fs = jvm.org.apache.hadoop.fs
    return fs.Path, fs.FileUtil, jvm.scala.collection.immutable.ArraySeq, context._jsc.hadoopConfiguration()


def _open(spark: SparkSession, path: str):
    path_class, *_, settings = _hadoop(spark.sparkContext)
    location = path_class(path)
    return location.getFileSystem(settings), location


def _paths(spark: SparkSession, found) -> list[str]:
    """Paths of a list of file states, fetched as one text instead of one by one."""
    _, files, sequence, _ = _hadoop(spark.sparkContext)
    joined = sequence.unsafeWrapArray(files.stat2Paths(found)).mkString("\n")
    return joined.split("\n") if joined else []


def grandchildren(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """What ``children`` gives for every folder in a folder; empty ones are left out."""
    fs, location = _open(spark, f"{path}/*/*")
    found: dict[str, list[str]] = {}
    for name in sorted(_paths(spark, fs.globStatus(location))):
        folder, file = name.rsplit("/", 2)[1:]
        if folder[0] not in "._" and file[0] not in "._":
            found.setdefault(folder, []).append(file)
    return found


def each(names: Sequence[str], call: Callable[[str], T]) -> list[T]:
    """``call`` for every name, in order of ``names``; of many, several at a time."""
    if len(names) <= FEW:
        return [call(name) for name in names]
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(call, names))


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _open(spark, path)
    return fs.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; hidden ones are left out and a missing folder has none."""
    fs, location = _open(spark, path)
    if not fs.exists(location):
        return []
    names = [name.rsplit("/", 1)[1] for name in _paths(spark, fs.listStatus(location))]
    return sorted(name for name in names if name[0] not in "._")


def remove(spark: SparkSession, path: str) -> None:
    fs, location = _open(spark, path)
    fs.delete(location, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder or file; the target must not be there yet."""
    fs, location = _open(spark, source)
    goal = _hadoop(spark.sparkContext)[0](target)
    fs.mkdirs(goal.getParent())
    if fs.exists(goal) or not fs.rename(location, goal):
        raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and rename it, so that it is there whole or not."""
    fs, location = _open(spark, f"{path}.writing")
    stream = fs.create(location, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    move(spark, f"{path}.writing", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, location = _open(spark, path)
    stream = fs.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
