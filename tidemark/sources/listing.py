"""What the folders of a partitioned table tell without opening a file."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession

from tidemark import schema as s

_NULL = "__HIVE_DEFAULT_PARTITION__"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def partitions_of(spark: SparkSession, path: str, column: str, null: bool = False) -> list[tuple[str, str]]:
    """(value, folder) of the subfolders `column=value`, the greatest value first. The folder of
    the null value is left out, unless `null` asks for it."""
    files, at = _folder(spark, path)
    if not files.exists(at):
        return []
    found = []
    for status in files.listStatus(at):
        name, separator, value = status.getPath().getName().partition("=")
        if status.isDirectory() and name == column and separator and (null or value != _NULL):
            found.append((value, status.getPath().toString()))
    return sorted(found, reverse=True)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a data file: not one that a writer hides or left empty."""
    files, at = _folder(spark, path)
    return any(
        status.isFile() and status.getLen() > 0 and status.getPath().getName()[0] not in "._"
        for status in files.listStatus(at)
    )


def newest_day(spark: SparkSession, path: str) -> str | None:
    """The last load day that has data, or None while there is none.

    Goes down the newest month first, so it takes one listing of the months, one of each
    month looked at and one of each day, from the last one back to the first that is not
    empty; their number does not grow with the files. No file is opened, unlike in an
    aggregate over the partition column, which reads the footer of each.
    """
    for day, folder in _days(spark, path):
        if has_data(spark, folder):
            return day
    return None


def _days(spark: SparkSession, path: str) -> Iterator[tuple[str, str]]:
    for _, month in partitions_of(spark, path, s.MONTH):
        yield from partitions_of(spark, month, s.LOAD_DAY)


def content_of(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number of the data files below a folder, their bytes, and the newest change. The files are
    walked through one by one and none of their names is kept."""
    files, at = _folder(spark, path)
    count = size = newest = 0
    found = files.listFiles(at, True)
    while found.hasNext():
        status = found.next()
        if status.getPath().getName()[0] not in "._":
            count, size = count + 1, size + status.getLen()
            newest = max(newest, status.getModificationTime())
    return count, size, newest
