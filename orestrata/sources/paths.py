"""Folders on whatever file system a path names, and the finished versions of a table in one.

A versioned table is a folder with one sub-folder `v-<number>-<id>` per write. A write that
ends well leaves Spark's `_SUCCESS` mark in its version, and the newest marked version is the
table: a write that fails half-way changes nothing that a reader can see.
"""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import SparkSession

VERSION = re.compile(r"v-(\d{10})-[0-9a-f]{32}")
FINISHED = "_SUCCESS"


def _folder(spark: SparkSession, path: str):
    """The path and its file system, as Hadoop knows them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def qualified(spark: SparkSession, path: str) -> str:
    """One spelling for a place: with scheme and authority, absolute, without a last slash."""
    folder, system = _folder(spark, path)
    return folder.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    return system.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    folder, system = _folder(spark, path)
    if not system.exists(folder) or not system.getFileStatus(folder).isDirectory():
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of every file below a path, or matching a glob, by path."""
    folder, system = _folder(spark, path)
    found = []
    for status in system.globStatus(folder) or []:
        files = system.listFiles(status.getPath(), True)
        while files.hasNext():
            file = files.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that is in it; nothing if there is none."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or a folder within its file system; there must be nothing at `target`."""
    source, system = _folder(spark, path)
    place, _ = _folder(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(source, place):
        raise OSError(f"cannot move {path} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or absent: written beside its place and renamed into it."""
    target, system = _folder(spark, path)
    draft, _ = _folder(spark, f"{path}.{uuid4().hex}")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not system.rename(draft, target):
        system.delete(target, False)
        if not system.rename(draft, target):
            raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is none."""
    file, system = _folder(spark, path)
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of all versions of a table, finished or not, oldest first."""
    return [name for name in children(spark, path) if VERSION.fullmatch(name)]


def new_version(spark: SparkSession, path: str) -> str:
    """Folder for the next version of a table."""
    known = versions(spark, path)
    number = int(VERSION.fullmatch(known[-1])[1]) + 1 if known else 1
    return f"{path.rstrip('/')}/v-{number:010}-{uuid4().hex}"


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest finished version; None for a folder without any."""
    for name in reversed(versions(spark, path)):
        if exists(spark, f"{path}/{name}/{FINISHED}"):
            return f"{path.rstrip('/')}/{name}"
    return None
