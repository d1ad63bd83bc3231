"""Small files of shared folders, as Spark's own file systems see them: whole or not there.

Spark has no public call for this, so its gateway is used here and nowhere else in the library.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hadoop)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none, if there is no such folder."""
    fs, path = _opened(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def text_of(spark: SparkSession, path: str) -> str:
    fs, path = _opened(spark, path)
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Makes the file with its whole text, unless it exists; of several that try at once one succeeds.

    A draft is written first and then gets the name: by a link on a local disk, by a rename that does not
    overwrite elsewhere. A file system whose rename is not one step (object stores) gives no such promise.
    """
    fs, target = _opened(spark, path)
    draft = target.suffix(f".{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    out.write(text.encode())
    out.close()
    try:
        if fs.getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(draft, target, none)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def delete(spark: SparkSession, path: str) -> bool:
    """Removes a file or folder; False, if there is none."""
    fs, path = _opened(spark, path)
    return fs.delete(path, True)
