"""Versioned tables in a folder of any Hadoop file system.

A table is a set of versions, each written once and never changed; a pointer file
lists the versions that make up the current state. So a failed run leaves the last
state valid, readers never see half a version, and untouched data is not rewritten.
Bucketed tables are clustered by their key with Spark's own bucketing: joins and
groupings by the key move no stored row, and a look-up reads one bucket.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Files:
    """The few file operations needed, on the Hadoop file system of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark._jvm, folder.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str) -> list[str]:
        """Names in a folder, none if it is absent."""
        p = self.path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Appears whole or not at all: written beside, then renamed to a name not used before."""
        part = self.path(f"{name}.{uuid.uuid4().hex}.part")
        stream = self.fs.create(part, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(part, self.path(name)):
            self.fs.delete(part, False)
            raise OSError(f"{name} exists")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class Store:
    """Tables and the pointer to their versions. keep: how many states stay readable."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16, keep: int = 2):
        self.spark, self.folder, self.buckets, self.keep = spark, folder.rstrip("/"), buckets, max(1, keep)
        self.files = Files(spark, self.folder)
        if "_buckets" in self.files.names(""):  # a folder keeps the number it began with
            self.buckets = int(self.files.read("_buckets"))

    def _pointers(self) -> list[str]:
        return [n for n in self.files.names("pointers") if n.endswith(".json")]

    def state(self) -> dict | None:
        """The newest committed state."""
        names = self._pointers()
        return json.loads(self.files.read(f"pointers/{names[-1]}")) if names else None

    def commit(self, state: dict) -> None:
        """Makes a state current, then removes states beyond `keep` and the versions that none of the rest uses."""
        names = self._pointers()
        no = int(names[-1].split(".")[0]) + 1 if names else 0
        self.files.write(f"pointers/{no:012d}.json", json.dumps(state))
        for old in names[: max(0, len(names) + 1 - self.keep)]:
            self.files.delete(f"pointers/{old}")
        self._vacuum()

    def _vacuum(self) -> None:
        states = [json.loads(self.files.read(f"pointers/{n}")) for n in self._pointers()]
        for table in {t for s in states for t in s["tables"]}:
            used = {f"version={v}" for s in states for v in s["tables"].get(table, ())}
            newest = max((int(u.split("=")[1]) for u in used), default=-1)
            for name in self.files.names(table):
                if name.startswith("version=") and name not in used and int(name.split("=")[1]) < newest:
                    self.files.delete(f"{table}/{name}")

    def _at(self, table: str, version: int) -> str:
        return f"{self.folder}/{table}/version={version}"

    def write(self, df: DataFrame, table: str, version: int, key: str, skewed_by: str | None = None) -> None:
        """Writes one version, clustered by key.

        Rows with equal keys meet in one task; with skewed_by, rows are dealt out by ranges of
        (bucket, key, that column), so that a key with a large part of all rows goes to several.
        """
        n, more = self.buckets, [skewed_by] if skewed_by else []
        if "_buckets" not in self.files.names(""):
            self.files.write("_buckets", str(n))
        dealt = df.repartitionByRange(n, F.pmod(F.hash(key), F.lit(n)), key, *more) if skewed_by else df.repartition(n, key)
        name = f"linkloom_{uuid.uuid4().hex}"
        dealt.write.format("parquet").mode("overwrite").bucketBy(n, key).sortBy(key, *more).option("path", self._at(table, version)).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay
        if "_schema.json" not in self.files.names(table):  # a version without rows has no files to learn it from
            self.files.write(f"{table}/_schema.json", df.schema.json())

    def write_sorted(self, df: DataFrame, table: str, version: int, by: list[str], ranges: int) -> None:
        """Writes one version split into ranges of the sorted order, each file sorted."""
        df.repartitionByRange(max(1, ranges), *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(self._at(table, version))

    def read(self, table: str, versions: list[int], key: str) -> DataFrame:
        """The rows of some versions, with their version, as one table clustered by key."""
        schema = StructType.fromJson(json.loads(self.files.read(f"{table}/_schema.json")))
        name = "linkloom_" + hashlib.sha1(f"{self.folder} {table} {versions} {self.buckets}".encode()).hexdigest()
        if not self.spark.catalog.tableExists(name):
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({ddl}, version BIGINT) USING parquet PARTITIONED BY (version) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{table}'")
            self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (version={v}) LOCATION '{self._at(table, v)}'" for v in versions))
        else:
            self.spark.catalog.refreshTable(name)  # a failed run may have been repeated since
        return self.spark.table(name)

    def read_sorted(self, table: str, versions: list[int]) -> DataFrame:
        """The rows of some versions that write_sorted wrote, with their version."""
        return self.spark.read.option("basePath", f"{self.folder}/{table}").parquet(*[self._at(table, v) for v in versions]).withColumn("version", F.col("version").cast("bigint"))


def sortable(c: Column, kind: str) -> Column:
    """A value as text in the same order: whole numbers and times by digits, texts as they are."""
    if kind == "string":
        return c
    whole = F.unix_micros(c.cast("timestamp")) if kind.startswith(("timestamp", "date")) else c
    if kind not in ("tinyint", "smallint", "int", "bigint") and whole is c:
        raise ValueError(f"no order of {kind}")
    return F.lpad((whole.cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("string"), 20, "0")


def among(df: DataFrame, keys: DataFrame, key: str, few: int = 2_000) -> DataFrame:
    """Rows of a clustered table whose key is among keys (distinct). A few keys become a filter, which prunes buckets and row groups; more a join that moves only the keys."""
    found = keys.select(key).limit(few + 1).collect()
    if len(found) <= few:
        return df.where(F.col(key).isin([r[0] for r in found])) if found else df.where("false")
    return df.join(keys.select(key), key, "left_semi")
