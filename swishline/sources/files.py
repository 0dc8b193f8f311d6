"""Folders of a shared store, by way of the file system that Spark itself uses for them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def values(spark: SparkSession, path: str, key: str) -> list[str]:
    """The values of the folders ``key=value`` in a folder; none if it does not exist."""
    system, folder = _at(spark, path)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(n.removeprefix(f"{key}=") for n in names if n.startswith(f"{key}="))


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none if it does not exist."""
    system, folder = _at(spark, path)
    if not system.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of the data files in a folder; none if it does not exist."""
    system, folder = _at(spark, path)
    if not system.exists(folder):
        return []
    found = [status for status in system.listStatus(folder) if status.isFile()]
    return sorted(
        n for n in (status.getPath().getName() for status in found) if n[:1] not in "._"
    )


def last_time(spark: SparkSession, path: str) -> int:
    """The newest modification time, in milliseconds, of a file in a folder; 0 without files."""
    system, folder = _at(spark, path)
    if not system.exists(folder):
        return 0
    return max((s.getModificationTime() for s in system.listStatus(folder) if s.isFile()), default=0)


def move_at(spark: SparkSession, source: str, target: str, time: int) -> bool:
    """Give a file a modification time, then move it; False if the store keeps no given times."""
    system, file = _at(spark, source)
    system.setTimes(file, time, -1)
    if system.getFileStatus(file).getModificationTime() != time:
        return False
    _, place = _at(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(file, place):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def is_there(spark: SparkSession, path: str) -> bool:
    system, file = _at(spark, path)
    return system.exists(file)


def remove(spark: SparkSession, path: str) -> None:
    system, folder = _at(spark, path)
    system.delete(folder, True)
