"""Folder metadata through Hadoop's FileSystem: names only, never contents."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted entry names of a folder, leaving out hidden and marker files."""
    path, fs = _file_system(spark, folder)
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(name for name in names if not name.startswith((".", "_")))


def list_aside(spark: SparkSession, folder: str) -> list[str]:
    """Sorted entry names of a folder that begin with an underscore; none if there is no such folder."""
    path, fs = _file_system(spark, folder)
    names = [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(name for name in names if name.startswith("_"))


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place that must be free."""
    target_path, fs = _file_system(spark, target)
    source_path, _ = _file_system(spark, source)
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path) or not fs.rename(source_path, target_path):
        raise OSError(f"could not move {source} to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    return fs.exists(hadoop_path)


def publish(spark: SparkSession, source: str, target: str) -> None:
    """Move a finished file to its place. If another writer was first, its file stays or is replaced whole."""
    target_path, fs = _file_system(spark, target)
    fs.mkdirs(target_path.getParent())
    source_path, _ = _file_system(spark, source)
    if not fs.rename(source_path, target_path):
        if not fs.exists(target_path):
            raise OSError(f"could not move {source} to {target}")
        fs.delete(source_path, False)


def remove(spark: SparkSession, folder: str) -> None:
    hadoop_path, fs = _file_system(spark, folder)
    fs.delete(hadoop_path, True)


def mark_finished(spark: SparkSession, folder: str) -> None:
    """Leave the marker of a committed write in a folder."""
    hadoop_path, fs = _file_system(spark, f"{folder}/_SUCCESS")
    fs.create(hadoop_path, True).close()


def make_temporary(spark: SparkSession, folder: str) -> None:
    """Create a folder that goes away with the application."""
    hadoop_path, fs = _file_system(spark, folder)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
