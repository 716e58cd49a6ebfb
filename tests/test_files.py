"""Metadata of files: empty, nested, larger than 2 GB, and those that come later."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from murmur.session import shared_dir
from murmur.sources import files
from murmur.streaming import runner


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep").mkdir()
    for name, data, second in (("a.txt", b"abc", 100), ("b.JPG", b"", 200), (".bashrc", b"x", 250),
                               ("deep/c.tar.gz", os.urandom(100_000), 300)):
        (tmp_path / name).write_bytes(data)
        os.utime(tmp_path / name, (second, second))
    return tmp_path


def described(frame):
    return {r.filename: (r.size_bytes, r.checksum, r.mime_type, r.modified_at.timestamp())
            for r in frame.collect()}


def expected(path, kind, second):
    data = path.read_bytes()
    return len(data), hashlib.sha256(data).hexdigest(), kind, second


def test_every_file_and_those_after_a_mark(spark, folder):
    found = described(files.file_metadata(spark, str(folder)))
    other = "application/octet-stream"
    assert found == {
        "a.txt": expected(folder / "a.txt", "text/plain", 100),
        "b.JPG": expected(folder / "b.JPG", "image/jpeg", 200),
        ".bashrc": expected(folder / ".bashrc", other, 250),
        "c.tar.gz": expected(folder / "deep/c.tar.gz", other, 300)}
    later = files.file_metadata(spark, f"file://{folder}", after_s=200)
    assert set(described(later)) == {".bashrc", "c.tar.gz"}
    assert described(files.file_metadata(spark, str(folder), "*.pdf")) == {}
    assert later.where(F.col("file_id") != F.substring("checksum", 1, 16)).count() == 0


def test_spark_reader_gives_the_same(spark, folder):
    (folder / ".bashrc").rename(folder / "rc")  # it passes over hidden files
    own = files.file_metadata(spark, str(folder))
    other = files.described(files.spark_files(spark, str(folder), "*", None))
    assert described(own) == described(other)
    assert {r.file_path for r in own.collect()} == {r.file_path for r in other.collect()}


def test_a_file_of_more_than_2_gb(spark, tmp_path):
    size = (2 << 30) + 5
    with open(tmp_path / "large.mp4", "wb") as out:
        out.truncate(size)  # sparse: takes no room on the disk
    checksum = hashlib.sha256()
    for lo in range(0, size, 1 << 24):
        checksum.update(bytes(min(1 << 24, size - lo)))
    row, = files.file_metadata(spark, str(tmp_path)).collect()
    assert (row.size_bytes, row.checksum, row.mime_type) == (size, checksum.hexdigest(), "video/mp4")


def test_files_are_dealt_by_size():
    rows = [(str(i), n, i) for i, n in enumerate([files.TASK_BYTES * 2, 5, files.TASK_BYTES - 5, 1])]
    assert [[f[0] for f in part.found] for part in files.dealt(rows)] == [["0"], ["1", "2"], ["3"]]
    many = files.dealt([("x", 0, 0)] * (files.TASK_FILES + 1))
    assert [len(p.found) for p in many] == [files.TASK_FILES, 1]


def test_a_restart_reads_only_new_files(spark, folder):
    out = shared_dir(spark, "file-stream")

    def names():
        stream = files.file_metadata_stream(spark, str(folder))
        runner.append_to(stream, f"{out}/rows", f"{out}/checkpoint")
        return sorted(r.filename for r in runner.read_result(
            spark, f"{out}/rows", stream.schema).collect())

    first = [".bashrc", "a.txt", "b.JPG", "c.tar.gz"]
    assert names() == first
    (folder / "d.png").write_bytes(b"new")
    os.utime(folder / "a.txt", (400, 400))  # changed
    assert names() == sorted([*first, "a.txt", "d.png"])
    assert names() == sorted([*first, "a.txt", "d.png"])
