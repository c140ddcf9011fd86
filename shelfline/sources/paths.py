"""Small file-system questions, asked through Hadoop so any shared store works."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder; False when there was none."""
    fs, target = _resolve(spark, path)
    return fs.exists(target) and fs.delete(target, True)


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty folder as a marker."""
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def move(spark: SparkSession, source: str, target: str) -> str:
    fs, src = _resolve(spark, source)
    dest = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dest.getParent())
    if not fs.rename(src, dest):
        raise OSError(f"cannot move {source} to {target}")
    return target


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name that must not exist. If it does: False, and the source is gone.

    One of several writers of a name succeeds: a file system like HDFS renames only to a free name when asked to, a local one links
    only to a free name. On a store without such a step only one writer may be at work.
    """
    fs, src = _resolve(spark, source)
    dest = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dest.getParent())
    try:
        put = _linked if fs.getScheme() == "file" else _renamed
        return put(spark, src, dest)
    finally:
        fs.delete(src, False)


def _linked(spark: SparkSession, src, dest) -> bool:
    files, file = spark._jvm.java.nio.file.Files, spark._jvm.java.io.File
    try:
        files.createLink(file(dest.toUri().getPath()).toPath(), file(src.toUri().getPath()).toPath())
        return True
    except Exception as error:
        return _taken(spark, dest, error)


def _renamed(spark: SparkSession, src, dest) -> bool:
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(dest.toUri(), spark._jsc.hadoopConfiguration()).rename(src, dest, options)
        return True
    except Exception as error:
        return _taken(spark, dest, error)


def _taken(spark: SparkSession, dest, error: Exception) -> bool:
    if exists(spark, dest.toString()):
        return False
    raise error


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """Write a small file; returns its path."""
    fs, target = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return path


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, target = _resolve(spark, pattern)
    found = fs.globStatus(target) or []
    return sorted(status.getPath().toString() for status in found)


def glob_times(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths with their modification times in milliseconds."""
    fs, target = _resolve(spark, pattern)
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in fs.globStatus(target) or [])


def partition_values(spark: SparkSession, root: str, *columns: str) -> list[dict[str, str]]:
    """The partitions under a folder, read from directory names only."""
    found = glob(spark, "/".join([root, *(f"{c}=*" for c in columns)]))
    return [
        dict(part.split("=", 1) for part in path.split("/")[-len(columns):]) for path in found
    ]


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace exactly the partitions that occur in ``df``.

    Rebalancing by the partition columns keeps the number of files near the number of
    partitions, and AQE splits a partition that holds most of the rows into even files.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*columns)
        .parquet(path)
    )
