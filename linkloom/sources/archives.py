"""Crawl archives (WARC/WAT): a fast text scan and an exact Python data source.

`scan` cuts files at record heads with the text reader: splittable, JVM only, any
Hadoop file system, gzip files by their ending (one task each).
`ArchiveSource` (format "archive") honours Content-Length, so a record head inside a
body does not cut it; it streams one file per input partition, gzip members included.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import files

SCHEMA = "warc_record_id STRING, warc_type STRING, target_uri STRING, warc_date STRING, content_type STRING, content_length BIGINT, body STRING"
# Fixed value: how a record begins.
HEAD = "WARC/1.0\r\n"


def _field(head, name: str):
    v = F.regexp_extract(head, rf"(?im)^{name}:[ \t]*(.*?)\r?$", 1)
    return F.when(v != "", v)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives (plain or .gz) below a path of any Hadoop file system."""
    raw = spark.read.option("lineSep", HEAD).option("recursiveFileLookup", True).text(path).where(F.length(F.trim("value")) > 0)
    head, rest = F.substring_index("value", "\r\n\r\n", 1), F.regexp_extract("value", r"(?s)^.*?\r\n\r\n(.*)$", 1)
    length = _field(head, "Content-Length").try_cast("bigint")
    return raw.select(
        _field(head, "WARC-Record-ID").alias("warc_record_id"), _field(head, "WARC-Type").alias("warc_type"), _field(head, "WARC-Target-URI").alias("target_uri"), _field(head, "WARC-Date").alias("warc_date"),
        _field(head, "Content-Type").alias("content_type"), length.alias("content_length"), F.regexp_replace(rest, r"(\r\n)+$", "").alias("body"),
    ).where("warc_type is not null")


def records(data) -> Iterator[tuple]:
    """Records of one open archive; stops at a damaged head."""
    while True:
        line = data.readline()
        while line in (b"\r\n", b"\n"):
            line = data.readline()
        if not line or not line.startswith(b"WARC/"):
            return
        head: dict[str, str] = {}
        while (line := data.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        n = head.get("content-length", "")
        length = int(n) if n.isdigit() else 0
        body = data.read(length).decode("utf-8", "replace")
        get = head.get
        yield get("warc-record-id"), get("warc-type"), get("warc-target-uri"), get("warc-date"), get("content-type"), length, body


def open_file(path: str):
    """A binary stream of a local path or of a file system that Arrow knows (hdfs, s3, gs)."""
    scheme, sep, rest = path.partition(":")
    if not sep or scheme == "file":
        return open("/" + rest.lstrip("/") if sep else path, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri("s3" + path[3:] if scheme == "s3a" else path)
    return system.open_input_stream(inner, compression=None)


class _File(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition):
        with open_file(partition.value) as raw:
            yield from records(gzip.GzipFile(fileobj=raw) if partition.value.endswith(".gz") else io.BufferedReader(raw) if isinstance(raw, io.RawIOBase) else raw)


class ArchiveSource(DataSource):
    """spark.read.format("archive").option("paths", "a.warc,b.warc.gz"): paths that all executors can open."""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader([p for p in self.options.get("paths", "").split(",") if p])


def read(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """Records below path: the splittable scan, or the exact source."""
    if not exact:
        return scan(spark, path)
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archive").option("paths", ",".join(files.list_files(spark, path))).load()
