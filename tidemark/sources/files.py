"""Small files and whole folders on the file system Spark writes to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple:
    """Hadoop's path and file system of ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    place, fs = _at(spark, path)
    fs.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in the folder ``path``, sorted, but for hidden ones; none if it is not there."""
    place, fs = _at(spark, path)
    found = [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(name for name in found if name[0] not in "._")


def _put(spark: SparkSession, path: str, text: str) -> str:
    """A hidden file beside ``path`` with that content."""
    place, fs = _at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    return beside.toString()


def _renamed(spark: SparkSession, source: str, target: str, overwrite: bool) -> None:
    """A rename in one step of the file system; without ``overwrite`` it fails where ``target`` exists."""
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_at(spark, target)[0].toUri(), spark._jsc.hadoopConfiguration())
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE if overwrite else kinds.NONE
    files.rename(_at(spark, source)[0], _at(spark, target)[0], options)


def _linked(spark: SparkSession, source: str, target: str) -> None:
    """A second name for a file of the local file system, whose rename would replace ``target``."""
    file = spark._jvm.java.io.File
    source, target = (file(_at(spark, path)[0].toUri().getPath()).toPath() for path in (source, target))
    spark._jvm.java.nio.file.Files.createLink(target, source)


def publish_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file unless there is one; false if there was.

    The whole content appears at once, and of several writers exactly one gets true:
    the file is written beside and named by a rename that does not replace (a link on
    the local file system). The file system has to rename in one step, as HDFS does.
    """
    beside = _put(spark, path, text)
    local = _at(spark, path)[1].getScheme() == "file"
    try:
        if local:
            _linked(spark, beside, path)
        else:
            _renamed(spark, beside, path, overwrite=False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        delete(spark, beside)
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file or replace it; readers see the old content or the new."""
    _renamed(spark, _put(spark, path, text), path, overwrite=True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a file, or none if it is not there."""
    place, fs = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap(spark: SparkSession, beside: str, path: str) -> None:
    """Put the folder ``beside`` in the place of ``path``, whose former content is deleted last.

    If the second rename fails, the former folder gets its name back.
    """
    new, fs = _at(spark, beside)
    place, _ = _at(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{uuid.uuid4().hex}")
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"{path} cannot be renamed")
    moved = False
    try:
        moved = fs.rename(new, place)
    finally:
        if had and not moved:
            fs.rename(old, place)
    if not moved:
        raise OSError(f"{beside} cannot be renamed to {path}")
    if had:
        fs.delete(old, True)
