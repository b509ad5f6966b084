"""File moves through the Hadoop file system, so they work on any store Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_tree(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file to ``target``; a file there is replaced in the same step.

    A folder there is replaced as by :func:`replace_tree`.
    """
    recover_tree(spark, target)
    source_path, _ = _path(spark, source)
    target_path, fs = _path(spark, target)
    if fs.exists(target_path) and fs.getFileStatus(target_path).isDirectory():
        replace_tree(spark, source, target)
        return
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(fs.makeQualified(source_path), fs.makeQualified(target_path), options)


def _aside(target: str) -> str:
    folder, _, name = target.rstrip("/").rpartition("/")
    return f"{folder}/.{name}.replaced"


def replace_tree(spark: SparkSession, source: str, target: str) -> None:
    """Put the finished folder ``source`` where ``target`` is, by renames alone.

    What was there is moved aside first and deleted last, so at any moment one whole
    table exists; :func:`recover_tree` brings it back if the process died in between.
    """
    recover_tree(spark, target)
    source_path, fs = _path(spark, source)
    target_path, _ = _path(spark, target)
    aside, _ = _path(spark, _aside(target))
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path) and not fs.rename(target_path, aside):
        raise OSError(f"{target}: cannot be moved aside")
    if not fs.rename(source_path, target_path):
        recover_tree(spark, target)
        raise OSError(f"{source}: cannot be moved to {target}")
    fs.delete(aside, True)


def recover_tree(spark: SparkSession, target: str) -> None:
    """Undo or finish a replacement that was cut off."""
    target_path, fs = _path(spark, target)
    aside, _ = _path(spark, _aside(target))
    if fs.exists(aside):
        if fs.exists(target_path):
            fs.delete(aside, True)
        else:
            fs.rename(aside, target_path)


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """Data files directly inside a folder Spark wrote."""
    path, fs = _path(spark, folder)
    names = [status.getPath() for status in fs.listStatus(path)]
    return sorted(p.toString() for p in names if p.getName().startswith("part-"))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files behind a path or glob pattern."""
    pattern, fs = _path(spark, path)
    found = fs.globStatus(pattern) or []
    return sum(fs.getContentSummary(status.getPath()).getLength() for status in found)


def stored_version(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Files, bytes and newest change below a path: unlike for unlike contents in practice."""
    pattern, fs = _path(spark, path)
    files = size = newest = 0
    for status in fs.globStatus(pattern) or []:
        found = fs.listFiles(status.getPath(), True)
        while found.hasNext():
            each = found.next()
            files, size = files + 1, size + each.getLen()
            newest = max(newest, each.getModificationTime())
    return files, size, newest
