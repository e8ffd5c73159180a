"""Files that only one writer can create, on whatever file system a path
names: what makes a numbered manifest a commit."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from orrery.session import unique_name


def _causes(error: Py4JJavaError) -> set[str]:
    out, cause = set(), error.java_exception
    while cause is not None:
        out.add(cause.getClass().getSimpleName())
        cause = cause.getCause()
    return out


def put_if_absent(spark: SparkSession, path: str, content: str) -> bool:
    """Create the file ``path`` with ``content``, or return False because it
    exists. Readers see the whole file or none.

    The content is written under a hidden name first. On a local file system a
    hard link gives it its name, which fails if there is one; elsewhere a
    rename that must not replace does (atomic on HDFS); stores without such a
    rename get an exclusive create, which their connector must honour."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    folder = target.getParent()
    fs.mkdirs(folder)
    hidden = jvm.org.apache.hadoop.fs.Path(folder, f".{unique_name('put')}")
    raw = bytearray(content.encode("utf-8"))
    if fs.getScheme() == "file":
        # Not through Hadoop: its local rename replaces.
        local, name = hidden.toUri().getPath(), target.toUri().getPath()
        with open(local, "xb") as out:
            out.write(raw)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(local, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
        return True

    def write(where) -> None:
        out = fs.create(where, False)
        try:
            out.write(raw)
        finally:
            out.close()

    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    except Py4JJavaError as error:
        if "UnsupportedFileSystemException" not in _causes(error):
            raise
        context = None
    try:
        if context is None:
            write(target)
            return True
        write(hidden)
        option = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = option
        context.rename(hidden, target, options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in _causes(error):
            raise
        return False
    finally:
        fs.delete(hidden, False)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
