"""Lists of archive paths, copies, and configuration."""

from __future__ import annotations

import dataclasses
import os

import yaml
from pyspark.sql import DataFrame, SparkSession


def paths_range(paths: list[str], span: str) -> list[str]:
    """Lines a to b of a paths file, both counted from 0 and included."""
    first, sep, last = span.partition("-")
    if not sep or not first.strip().isdigit() or not last.strip().isdigit():
        raise ValueError(f"not a range: {span!r}")
    a, b = int(first), int(last)
    if a > b:
        raise ValueError(f"range ends before it begins: {span!r}")
    return paths[a : b + 1]


def add_slash(url: str) -> str:
    return url if url.endswith("/") else url + "/"


def file_name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all files below a folder of any Hadoop file system, hidden ones left out; sorted."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out, found = [], system.listFiles(path, True)
    while found.hasNext():
        f = found.next().getPath()
        if not f.getName().startswith(("_", ".")):
            out.append(f.toString())
    return sorted(out)


def require_data(spark: SparkSession, folder: str) -> str:
    """The folder, if it exists and holds a file; else ValueError."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        raise ValueError(f"no such folder: {folder}")
    if not list_files(spark, folder):
        raise ValueError(f"no files in {folder}")
    return folder


def copy_files(spark: SparkSession, sources: list[str], target: str) -> DataFrame:
    """Copies files in parallel, skipping those that exist; (path, done) with the failed ones marked.

    Streams between any two file systems that the executors can open: mounted folders, or those Arrow knows (hdfs, s3, gs).
    """

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        def place(path: str):
            return fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a:") else path if ":" in path else os.path.abspath(path))

        for b in batches:
            done = []
            for p in b.column(0).to_pylist():
                try:
                    (a, source), (c, to) = place(p), place(add_slash(target) + file_name(p))
                    if c.get_file_info(to).type == fs.FileType.NotFound:
                        c.create_dir(to.rpartition("/")[0], recursive=True)
                        part = f"{to}.part-{os.getpid()}"
                        with a.open_input_stream(source, compression=None) as x, c.open_output_stream(part, compression=None) as y:
                            while block := x.read(1 << 22):
                                y.write(block)
                        c.move(part, to)
                    done.append("copied")
                except (OSError, ValueError) as e:
                    done.append(f"failed: {e}")
            yield pa.RecordBatch.from_pydict({"path": b.column(0), "done": done})

    df = spark.createDataFrame([(p,) for p in sources], "path string").repartition(max(1, min(len(sources), 10_000)))
    return df.mapInArrow(run, "path string, done string")


@dataclasses.dataclass
class Config:
    """Settings of a deployment."""

    table: str = "link_index"
    app: str = "linkloom"
    tablets: int = 20
    buckets: int = 100
    load_rate_limit: int = 0
    temp_dir: str = ""

    @classmethod
    def load(cls, *paths: str) -> Config:
        """The first file that exists; unknown keys are an error."""
        for p in paths:
            if os.path.exists(p):
                with open(p) as f:
                    return cls(**(yaml.safe_load(f) or {}))
        raise ValueError(f"no configuration at {', '.join(paths)}")
