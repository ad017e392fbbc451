"""Folders that appear whole or not at all.

Rows are staged beside the table, under a name that readers skip, and become visible by one rename. The rename fails if
the target is there, so of several writers of one name the first wins. (On HDFS and local disks a rename is atomic; an
object store needs a file system layer that makes it so.)

``commit_once``: a part of a table, named by a run id. ``replace_version``: a whole table; its rows lie in a folder of
their own and a small pointer file names it, so readers see the old rows until the pointer is replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

STAGED, POINTER = "_staged", "_current"


class Folders:
    """The few calls of Hadoop's file systems that commits need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)
        self.options = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        self.array = spark.sparkContext._gateway.new_array

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def rename(self, source: str, target: str, replace: bool = False) -> bool:
        """Whether the rename was done; False if the target is there (and is not to be replaced)."""
        how = self.array(self.options, 1)
        how[0] = self.options.OVERWRITE if replace else self.options.NONE
        self.fs.mkdirs(self.path(target).getParent())
        try:
            self.context.rename(self.path(source), self.path(target), how)
        except Py4JJavaError as e:
            if not replace and "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def drop(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(path))] if self.exists(path) else []

    def read(self, path: str) -> str:
        found = self.fs.open(self.path(path))
        try:
            return bytes(found.readAllBytes()).decode()
        finally:
            found.close()

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self.path(path), True)
        out.write(bytearray(text.encode()))
        out.close()


def run_folder(path: str, run_id: str) -> str:
    """Where the rows of a run lie."""
    return f"{path.rstrip('/')}/run={quote(run_id, safe='')}"


def commit_once(spark: SparkSession, path: str, run_id: str, write: Callable[[str], None]) -> bool:
    """Add the rows that ``write`` puts into the folder it is given to the table at ``path``, unless those of this run id
    are there: then nothing is written, and the result is False."""
    folders, target = Folders(spark, path), run_folder(path, run_id)
    if folders.exists(target):
        return False
    mine = f"{quote(run_id, safe='')}-{uuid.uuid4().hex}"
    top = f"{path.rstrip('/')}/{STAGED}"
    try:
        write(f"{top}/{mine}")
        return folders.rename(f"{top}/{mine}", target)
    finally:
        folders.drop(f"{top}/{mine}")               # of a failed write, or of a run that another one was faster in


def current_version(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of the table at ``path``: the one that its pointer names, else ``path`` itself."""
    folders, pointer = Folders(spark, path), f"{path.rstrip('/')}/{POINTER}"
    return f"{path.rstrip('/')}/{folders.read(pointer)}" if folders.exists(pointer) else path


def replace_version(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the table at ``path`` by what ``write`` puts into the folder it is given. Until that is whole, and if it
    fails, readers have the old rows. The version before stays for readers that have begun; older ones go."""
    folders, top = Folders(spark, path), path.rstrip("/")
    pointer, name = f"{top}/{POINTER}", f"v-{uuid.uuid4().hex}"
    before = folders.read(pointer) if folders.exists(pointer) else None
    try:
        write(f"{top}/{name}")
    except BaseException:
        folders.drop(f"{top}/{name}")
        raise
    folders.write(f"{top}/_{name}", name)
    folders.rename(f"{top}/_{name}", pointer, replace=True)
    for old in folders.names(top):
        # a table that had no versions yet keeps its plain folders until the next replacement
        if old not in (name, before, POINTER) and (old.startswith(("v-", "_v-")) or before is not None):
            folders.drop(f"{top}/{old}")
