"""Folder operations on whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def make_temporary_folder(spark: SparkSession, path: str) -> None:
    """Create a folder that goes, with its contents, when the driver JVM ends."""
    fs, hadoop_path = _locate(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _locate(spark, path)
    return bool(fs.delete(hadoop_path, True))


def delete_uri(spark: SparkSession, uri: str) -> None:
    """Delete the folder that an escaped URI names, as ``_metadata.file_path`` gives it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(uri))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.delete(path, True):
        raise OSError(f"could not delete {uri}")


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Direct sub-folders that hold data, sorted by name."""
    fs, hadoop_path = _locate(spark, path)
    found = [s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return sorted(p for p in found if not p.rsplit("/", 1)[-1].startswith(("_", ".")))


def parent(spark: SparkSession, path: str) -> str:
    """The folder that holds ``path``, in full; a bare name lies in the working folder."""
    fs, hadoop_path = _locate(spark, path)
    return fs.makeQualified(hadoop_path).getParent().toString()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none for a folder that is not there."""
    fs, hadoop_path = _locate(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path))


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _locate(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file appear whole, or raise because there is one of that name."""
    jvm = spark.sparkContext._jvm
    fs, final = _locate(spark, path)
    hidden = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    # Without the option to overwrite, renaming onto an existing file is an error.
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(hidden), fs.makeQualified(final), none)
    except Exception as error:
        fs.delete(hidden, False)
        if fs.exists(final):
            raise FileExistsError(path) from error
        raise
