"""File-system helpers on Hadoop's FileSystem, so that they work on whatever storage the session reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that two spellings of one place compare equal."""
    fs, target = _resolve(spark, path)
    return fs.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, sorted; empty if there is no such path."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files directly under ``path``, sorted; empty if there is no such path."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]
    return sorted(name for name in names if name[0] not in "_.")


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last modified, in milliseconds."""
    fs, target = _resolve(spark, path)
    return fs.getFileStatus(target).getModificationTime()


def has_data(spark: SparkSession, path: str) -> bool:
    """A folder counts as a table once a write into it has committed."""
    return exists(spark, f"{path}/_SUCCESS")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; readers see the old or the new content, never a part."""
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    draft_fs, draft = _resolve(spark, f"{path}.draft")
    stream = draft_fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    qualified = draft_fs.makeQualified(draft)
    context.rename(qualified, draft_fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; ``target`` must not exist, or the folder would land inside it."""
    fs, origin = _resolve(spark, source)
    if not fs.rename(origin, _resolve(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)
