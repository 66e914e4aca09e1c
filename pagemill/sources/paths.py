"""The few file system questions Spark's readers do not answer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def absolute_path(spark: SparkSession, path: str) -> str:
    """The path's own part, from the root on, without scheme and authority."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.makeQualified(hadoop_path).toUri().getPath()


def version_numbers(spark: SparkSession, folder: str, name: str = "version") -> list[int]:
    """Numbers of the completely written ``version=N`` folders, or those of another name."""
    fs, hadoop_path = _file_system(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    numbers = [int(n.removeprefix(f"{name}=")) for n in names if n.startswith(f"{name}=")]
    return sorted(n for n in numbers if path_exists(spark, f"{folder}/{name}={n}/_SUCCESS"))


def latest_version(spark: SparkSession, folder: str) -> str | None:
    numbers = version_numbers(spark, folder)
    return f"{folder}/version={numbers[-1]}" if numbers else None
