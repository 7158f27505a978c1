"""Small files in the shared store, through the Hadoop file system Spark is set up with.

Used for bookkeeping only (schemas, counts, code): small files, written whole.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible entries of a folder, sorted; empty if there is no such folder."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    found = (status.getPath().getName() for status in fs.listStatus(target))
    return sorted(name for name in found if not name.startswith("."))


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path``."""
    fs, target = _resolve(spark, path)
    draft = _resolve(spark, new)[1]
    fs.delete(target, True)
    if not fs.rename(draft, target):
        raise OSError(f"{new} could not be renamed to {path}")


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    fs, target = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str) -> dict:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, content: dict, replace: bool = False) -> None:
    """Write a whole file or nothing. Unless ``replace``, fail if it is there already."""
    fs, target = _resolve(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(content), "utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if replace else rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
    except Exception:
        fs.delete(draft, False)
        raise


class NumberedFiles:
    """A folder of numbered JSON files; the highest number is the valid one.

    Two writers that start from the same number collide on the file name, so the slower
    one fails instead of undoing the work of the other.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in names(self.spark, self.folder) if n.endswith(".json")]

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def get(self, number: int) -> dict:
        return read_json(self.spark, self._path(number))

    def latest(self) -> tuple[int, dict | None]:
        found = self.numbers()
        return (found[-1], self.get(found[-1])) if found else (0, None)

    def put(self, number: int, content: dict) -> None:
        make_dir(self.spark, self.folder)
        write_json(self.spark, self._path(number), content)

    def drop(self, number: int) -> None:
        delete(self.spark, self._path(number))
