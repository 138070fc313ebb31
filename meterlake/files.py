"""Small files and folders of the shared file system, through Hadoop's client.

Only names, sizes and short texts pass through here; rows never do."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is absent."""
    fs, where = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder."""
    fs, where = _fs(spark, path)
    return int(fs.getContentSummary(where).getLength())


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; False if it does. It appears whole
    or not at all: it is written beside its place and renamed."""
    fs, where = _fs(spark, path)
    if fs.exists(where):
        return False
    parent = where.getParent()
    fs.mkdirs(parent)
    draft = spark._jvm.org.apache.hadoop.fs.Path(parent, f".{where.getName()}.{spark._jvm.java.util.UUID.randomUUID()}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)  # without OVERWRITE
    source, target = fs.makeQualified(draft), fs.makeQualified(where)
    try:
        context = hadoop.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(source, target, options)
        return True
    except PySparkException:
        raise
    except Exception as error:  # the gateway's error carries the Java one
        if "UnsupportedFileSystem" in str(error):  # a store with the older interface only
            if fs.rename(source, target):
                return True
        elif "FileAlreadyExists" not in str(error):
            fs.delete(draft, False)
            raise
    fs.delete(draft, False)
    return False
