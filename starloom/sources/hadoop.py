"""The few file-system questions Spark's DataFrame API has no call for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``, sorted; empty when there is no such folder."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Data files in ``path`` and its folders, relative to it, sorted."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    root = fs.makeQualified(hadoop_path).toString().rstrip("/")
    found, listed = [], fs.listFiles(hadoop_path, True)
    while listed.hasNext():
        status = listed.next().getPath()
        if not status.getName().startswith(("_", ".")):
            found.append(status.toString().removeprefix(f"{root}/"))
    return sorted(found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole, over one of that name: it is written aside and renamed."""
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}._new")
    fs, target = _resolve(spark, path)
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri() if target.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    over = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = over
    context.rename(aside, target, options)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _resolve(spark, path)
    opened = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()
