"""Metadata of the files in a folder, as a table and as a stream.

``FileSource`` is a Spark data source: the driver lists the folder, files are dealt into
partitions of about ``TASK_BYTES`` (a larger file has one of its own), and the tasks hash them
block by block, so that neither the size of a file nor that of a task is bounded by memory. As
a stream its offset is the time of the newest file that was read: a restart reads only what has
changed since. Stores that only Spark can open (``viewfs`` and the like) go through Spark's
reader of binary files, which refuses files of 2 GB or more and passes over hidden ones.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, InputPartition)

from murmur import fixed_values as fv
from murmur.functions.columns import lookup

FORMAT = "file_metadata"
BLOCK = 8 << 20
TASK_BYTES, TASK_FILES = 256 << 20, 1000
#: Schemes that the tasks can open themselves; a path without one is local.
SCHEMES = ("", "file", "hdfs", "s3", "gs", "abfs", "abfss")

HASHED = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()), T.StructField("checksum", T.StringType())])


@dataclass
class Files(InputPartition):
    """Path, size and time (microseconds) of the files of one task."""

    found: list[tuple[str, int, int]]


def opened(folder: str) -> tuple[arrow_fs.FileSystem, str, str]:
    """File system, root in it, and what stands before a path of it in a URI."""
    scheme = re.match(r"(?:([a-z0-9]+)://?)?", folder)[1] or ""
    if scheme in ("", "file"):
        return arrow_fs.LocalFileSystem(), re.sub("^file:/+", "/", folder), "file:"
    system, root = arrow_fs.FileSystem.from_uri(folder)
    return system, root, folder[:len(folder.rstrip("/")) - len(root.rstrip("/"))]


def listed(folder: str, pattern: str, after_us: int, upto_us: int | None = None
           ) -> list[tuple[str, int, int]]:
    """The files below a folder that changed after one time and not after another, by time."""
    system, root, _ = opened(folder)
    out = []
    for info in system.get_file_info(arrow_fs.FileSelector(root, recursive=True)):
        us = info.mtime_ns // 1000 if info.mtime_ns is not None else 0
        if info.type == arrow_fs.FileType.File and fnmatch.fnmatchcase(info.base_name, pattern) \
                and us > after_us and (upto_us is None or us <= upto_us):
            out.append((info.path, info.size, us))
    return sorted(out, key=lambda f: (f[2], f[0]))


def dealt(found: list[tuple[str, int, int]]) -> list[Files]:
    """Runs of files of about ``TASK_BYTES``; no file is cut."""
    out: list[Files] = []
    size = 0
    for file in found:
        if not out or size + file[1] > TASK_BYTES or len(out[-1].found) == TASK_FILES:
            out.append(Files([]))
            size = 0
        out[-1].found.append(file)
        size += file[1]
    return out


def hashed(folder: str, part: Files, block: int) -> Iterator[tuple]:
    system, _, prefix = opened(folder)
    for path, size, us in part.found:
        checksum = hashlib.sha256()
        with system.open_input_stream(path, compression=None) as stream:
            while data := stream.read(block):
                checksum.update(data)
        time = dt.datetime.fromtimestamp(us // 1_000_000, dt.timezone.utc).replace(
            microsecond=us % 1_000_000)
        yield prefix + path, size, time, checksum.hexdigest()


class FileSource(DataSource):
    """Options: path, pattern (of names), after_us (only files changed later), block (bytes)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return HASHED

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FileReader(self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return FileStream(self.options)


class Options:
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.pattern = options.get("pattern", "*")
        self.after_us = int(options.get("after_us", -1))
        self.block = int(options.get("block", BLOCK))


class FileReader(Options, DataSourceReader):
    def partitions(self) -> list[Files]:
        # No file is still one (empty) partition: no partition at all would mean a single
        # read without one.
        return dealt(listed(self.folder, self.pattern, self.after_us)) or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        return hashed(self.folder, partition, self.block)


class FileStream(Options, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"mark_us": self.after_us}

    def latestOffset(self) -> dict:
        found = listed(self.folder, self.pattern, self.after_us)
        return {"mark_us": found[-1][2] if found else self.after_us}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return dealt(listed(self.folder, self.pattern, start["mark_us"], end["mark_us"])) or [
            Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        return hashed(self.folder, partition, self.block)


def file_metadata(spark: SparkSession, folder: str, pattern: str = "*",
                  after_s: float | None = None) -> DataFrame:
    """``described`` for every file changed after the mark, empty and very large ones too."""
    scheme = re.match(r"(?:([a-z0-9]+):)?", folder)[1] or ""
    if scheme not in SCHEMES:
        return described(spark_files(spark, folder, pattern, after_s))
    spark.dataSource.register(FileSource)
    reader = spark.read.format(FORMAT).option("pattern", pattern)
    if after_s is not None:
        reader = reader.option("after_us", str(int(after_s * 1_000_000)))
    return described(reader.load(folder))


def file_metadata_stream(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The same as a stream: a file is described when it is new or has changed."""
    spark.dataSource.register(FileSource)
    return described(spark.readStream.format(FORMAT).option("pattern", pattern).load(folder))


def spark_files(spark: SparkSession, folder: str, pattern: str,
                after_s: float | None) -> DataFrame:
    """The files by Spark's reader, which passes over empty ones: these come from the listing."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(folder))
    files = files.unionByName(empty_files(spark, folder, pattern))
    if after_s is not None:
        files = files.filter(F.col("modificationTime") > F.timestamp_seconds(F.lit(after_s)))
    return files.withColumn("checksum", F.sha2("content", 256))


def empty_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The empty files below a folder, as the binary reader would show them."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root, wanted = hadoop.Path(folder), hadoop.GlobFilter(pattern)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    rows = []
    while found.hasNext():
        status = found.next()
        if status.getLen() == 0 and wanted.accept(status.getPath()):
            seconds = status.getModificationTime() / 1000
            rows.append((status.getPath().toString(), seconds))
    frame = spark.createDataFrame(rows, "path string, seconds double")
    return frame.select("path", F.timestamp_seconds("seconds").alias("modificationTime"),
                        F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content"))


def described(files: DataFrame) -> DataFrame:
    """Name, size, checksum, id and type of files (path, length, modificationTime, checksum)."""
    name = F.element_at(F.split("path", "/"), -1)
    suffix = F.lower(F.regexp_extract(name, r"(?<=[^.])(\.[^.]+)$", 1))
    return files.select(
        F.substring("checksum", 1, 16).alias("file_id"), name.alias("filename"),
        F.col("path").alias("file_path"), F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"), "checksum",
        lookup(suffix, fv.MIME_TYPES, fv.DEFAULT_MIME_TYPE).alias("mime_type"))
