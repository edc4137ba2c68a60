"""Small driver-side file-system calls through the session's Hadoop client.

Going through Hadoop's ``FileSystem`` keeps these calls valid for every
scheme the cluster supports (hdfs, s3a, file, ...). They touch metadata only:
listing a folder, creating a small file in one step, renaming one file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the direct children of ``folder``; empty when it is missing."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return [status.getPath().getName() for status in fs.listStatus(p)]


def any_match(spark: SparkSession, *globs: str) -> bool:
    """True when a file matches one of the globs."""
    for glob in globs:
        fs, p = _fs(spark, glob)
        if fs.globStatus(p):
            return True
    return False


# Stores whose files appear whole when they are closed, and which have no rename that can fail on a taken name.
_OBJECT_STORES = ("s3a", "s3", "s3n", "gs", "oss", "cosn", "obs", "wasb", "wasbs")
TEMPORARY = "_tmp-"


def _write(stream, content: str) -> None:
    try:
        stream.write(bytearray(content.encode("utf-8")))
    finally:
        stream.close()


def create_marker(spark: SparkSession, path: str, content: str = "") -> bool:
    """Create a small file with all of its content; False when it already exists.

    The file is written under a temporary name beside it and gets its own name in one
    step that fails when the name is taken: a rename (HDFS and its like refuse to
    rename onto a file), or a hard link on local disks, where a rename would replace
    the file. So a reader sees all of it or nothing, whenever the writer dies. Object
    stores show a file only once it is closed; they are asked to refuse an overwrite.
    """
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    jvm = spark.sparkContext._jvm
    parent = p.getParent()
    fs.mkdirs(parent)
    real = fs.resolvePath(parent)
    scheme = real.toUri().getScheme()
    if scheme in _OBJECT_STORES:
        try:
            made = fs.createFile(p).overwrite(False).opt("fs.option.create.conditional.overwrite", True).build()
            _write(made, content)
        except Exception as err:
            if "AlreadyExists" in str(err) or "already exists" in str(err) or "412" in str(err):
                return False
            raise
        return True
    temporary = jvm.org.apache.hadoop.fs.Path(parent, TEMPORARY + uuid.uuid4().hex)
    try:
        _write(fs.create(temporary, False), content)
        if scheme != "file":
            return bool(fs.rename(temporary, p)) or _missing(fs, p)
        local = [jvm.java.nio.file.Paths.get(jvm.org.apache.hadoop.fs.Path(real, x.getName()).toUri().getPath(),
                                             spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)) for x in (p, temporary)]
        try:
            jvm.java.nio.file.Files.createLink(*local)
        except Exception as err:
            if "FileAlreadyExists" in str(err):
                return False
            raise
        return True
    finally:
        fs.delete(temporary, False)


def _missing(fs, p) -> bool:
    """After a rename that wasn't done: False when the name is taken; any other reason is an error."""
    if fs.exists(p):
        return False
    raise OSError(f"{p} couldn't be created by renaming a file beside it")


def read_small(spark: SparkSession, path: str) -> str:
    """Content of a small file as text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    return bool(fs.rename(p, _fs(spark, dst)[1]))


def modified(spark: SparkSession, path: str) -> float:
    """Modification time of a file or folder, in epoch seconds."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder (recursively); False when it did not exist."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))
