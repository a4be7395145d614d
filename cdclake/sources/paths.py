"""Driver-side calls to the file system Spark itself uses (any Hadoop file system)."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def entries(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is folder, modification time in ms) of a folder's entries."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in fs.listStatus(target)]


def size(spark: SparkSession, path: str) -> int:
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _open(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Move a file to a name not in use; False if the name is taken.

    The file system itself refuses a taken name, so of two writers one succeeds. Stores without such a
    rename are asked first. Hadoop asks a local disk first too, so a file there gets its new name as a link.
    """
    jvm = spark._jvm
    fs, source = _open(spark, old)
    _, target = _open(spark, new)
    source, target = fs.makeQualified(source), fs.makeQualified(target)
    if fs.exists(target):
        return False
    if target.toUri().getScheme() == "file" and fs.getFileStatus(source).isFile():
        linked = _link(source.toUri().getPath(), target.toUri().getPath())
        if linked is not None:
            if linked:
                fs.delete(source, False)
            return linked
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(source, target, options)
        return True
    except Py4JJavaError as error:
        kind = error.java_exception.getClass().getSimpleName()
        if kind == "FileAlreadyExistsException":
            return False
        if kind != "UnsupportedFileSystemException":
            raise
        return fs.rename(source, target)


def _link(old: str, new: str) -> bool | None:
    """Give a local file a second name unless that is taken; None where there are no links."""
    try:
        os.link(old, new)
    except FileExistsError:
        return False
    except OSError:
        return None
    # The name is ours, so is that of its checksums; without these the file is read unchecked.
    sums = [f"{os.path.dirname(name)}/.{os.path.basename(name)}.crc" for name in (old, new)]
    if os.path.exists(sums[0]):
        os.replace(*sums)
    return True


def move_folder(spark: SparkSession, old: str, new: str) -> bool:
    """Move a folder, with whatever is in it, to a name not in use; False if there is no such folder."""
    fs, source = _open(spark, old)
    _, target = _open(spark, new)
    if not fs.exists(source):
        return False
    fs.mkdirs(target.getParent())
    return rename(spark, old, new)


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.delete(target, True)
