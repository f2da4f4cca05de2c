"""Folders and files of table paths, through the Hadoop file system of the path.

Only folder metadata reaches the driver (names and sizes of one level, or a
total); data files are never opened here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of one folder (empty if there is no such folder)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the first partition level, from the folder names of that level only."""
    from urllib.parse import unquote
    prefix = f"{col}="
    return [unquote(n[len(prefix):]) for n in names(spark, path) if n.startswith(prefix)]


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of everything below a path, hidden files included (0 if it isn't there)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def data_files(spark: SparkSession, path: str) -> list[int]:
    """Sizes of the data files directly in one folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [int(s.getLen()) for s in fs.listStatus(p) if s.isFile() and s.getPath().getName()[0] not in "_."]


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Name to size of the data files directly in one folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): int(s.getLen()) for s in fs.listStatus(p) if s.isFile() and s.getPath().getName()[0] not in "_."}


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    if not fs.rename(p, _fs(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its content at once, only if nobody has it yet (False: it exists).

    The content is written beside it first; then a hard link (local disk) or a rename (HDFS: refused where the target
    exists) claims the name."""
    import uuid

    from py4j.protocol import Py4JJavaError
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, p = _fs(spark, path)
    beside = _fs(spark, f"{path.rpartition('/')[0]}/_new-{uuid.uuid4().hex}")[1]
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.getUri().getScheme() != "file":
        done = not fs.exists(p) and fs.rename(beside, p)
        if not done:
            fs.delete(beside, False)
        return bool(done)
    local = lambda x: jvm.java.nio.file.Paths.get(x.toUri().getPath(), gateway.new_array(jvm.java.lang.String, 0))
    try:
        jvm.java.nio.file.Files.createLink(local(p), local(beside))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    finally:
        fs.delete(beside, False)


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file ("" if it is gone)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return ""
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was changed (0 if it is gone)."""
    import time
    fs, p = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000 if fs.exists(p) else 0.0


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
