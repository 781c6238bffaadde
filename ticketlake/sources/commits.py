"""A log of numbered entries that several runs may extend at once.

An entry is a small file that is created only if its number is still free, so of two runs that commit
the same number one loses; it reads what the other has added and tries the next number.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "n bigint, batch string"


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with a text; False if it is there already.

    The text is written beside it first, so no reader sees an unfinished file.  On a local or mounted
    folder a hard link settles who comes first; elsewhere a rename that does not replace its target, which
    the file system must carry out as one step, as HDFS does.
    """
    jvm, where, fs = _files(spark, path)
    folder = where.getParent()
    fs.mkdirs(folder)
    aside = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(_local(aside), _local(where))
            except FileExistsError:
                return False
            return True
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(aside, where, options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True
    finally:
        fs.delete(aside, False)


def _local(path) -> str:
    return unquote(urlparse(path.toUri().toString()).path)


def entries(spark: SparkSession, log: str) -> DataFrame:
    """(n, batch) of every committed entry."""
    _, where, fs = _files(spark, log)
    if not fs.exists(where):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("pathGlobFilter", "*.json").json(log)


def head(spark: SparkSession, log: str) -> int:
    """The number of the last entry, 0 for an empty log; entries are numbered without gaps."""
    return entries(spark, log).agg(F.max("n")).first()[0] or 0


def commit(spark: SparkSession, log: str, number: int, batch: str) -> bool:
    """Append a batch as this entry; False if another run was first."""
    return claim(spark, f"{log}/{number:012d}.json", json.dumps({"n": number, "batch": batch}))
