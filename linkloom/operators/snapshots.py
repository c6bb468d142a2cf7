"""What changed between full deliveries of a table.

Each delivery becomes a narrow key-to-signature index (key, 128-bit hash of the
compared values), stored in buckets of the key. The index of the last delivery is
probed with that of the next one, bucket by bucket, without moving either; wide
values are fetched only for keys whose signature differs, appears or vanishes; then
the new index takes the old one's place. `SnapshotStore` does one delivery at a
time and keeps the index between runs; `changes` passes all deliveries of a table
through such a store, in order.

Defined results
* rows with a null key or snapshot number: ignored
* a key repeated in a delivery: the latest order value counts (as a time with zone, then as text), then the greater signature
* null value: differs from any value, equals null; null list: as an empty list
* null list elements: ignored; order and repeats of list elements: no change
* fewer than two deliveries, or empty tables: no rows
* extra columns: ignored
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut, if_small, shared_dir
from ..store import Store


def _signature(values: list[Column], salt: int) -> Column:
    # xxhash64 skips nulls, hence the null flags
    return F.xxhash64(F.lit(salt), *[x for v in values for x in (v.isNull(), v)])


def signed(df: DataFrame, key: str, snap: str, order: str, values: list[str], items: Column) -> DataFrame:
    """(k, snap, at, sig1, sig2, items): rows with their signature; items is the sorted set of list elements."""
    rows = df.where(F.col(key).isNotNull() & F.col(snap).isNotNull()).select(
        F.col(key).alias("k"), F.col(snap).alias("snap"), F.struct(F.col(order).cast("string").try_cast("timestamp").alias("t"), F.col(order).alias("s")).alias("at"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)],
        F.coalesce(F.array_sort(F.array_distinct(F.array_compact(items))), F.array().cast("array<string>")).alias("items"),
    )
    vs = [F.col(f"v{i}") for i in range(len(values))] + [F.col("items")]
    return rows.select("k", "snap", "at", _signature(vs, 1).alias("sig1"), _signature(vs, 2).alias("sig2"), "items")


def index_of(rows: DataFrame) -> DataFrame:
    """One narrow row per key of a delivery; the combine step runs before the shuffle."""
    best = F.max(F.struct("at", "sig1", "sig2"))
    return rows.groupBy("k").agg(best.alias("b")).select("k", "b.sig1", "b.sig2")


def probe(last: DataFrame, new: DataFrame) -> DataFrame:
    """(k, change_kind, o1, o2, n1, n2) of the keys that differ. Both: (k, sig1, sig2)."""
    o = last.select("k", F.col("sig1").alias("o1"), F.col("sig2").alias("o2"))
    n = new.select("k", F.col("sig1").alias("n1"), F.col("sig2").alias("n2"))
    kind = F.when(F.col("o1").isNull(), "added").when(F.col("n1").isNull(), "removed").otherwise("changed")
    differs = ~(F.col("o1").eqNullSafe(F.col("n1")) & F.col("o2").eqNullSafe(F.col("n2")))
    return n.join(o, "k", "full_outer").where(differs).select("k", kind.alias("change_kind"), "o1", "o2", "n1", "n2")


def _item_changes(changed: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """(k, item, change_kind): the lists of the changed keys only, compared element by element. changed is filtered into both reads before their rows move."""
    wanted = lambda a, b: if_small(changed.where(f"{a} is not null").select("k", F.col(a).alias("sig1"), F.col(b).alias("sig2")))
    side = lambda rows, a, b, n: rows.join(wanted(a, b), ["k", "sig1", "sig2"], "left_semi").select("k", F.lit(n).alias("side"), "items")
    of = lambda n: F.coalesce(F.first(F.when(F.col("side") == n, F.col("items")), ignorenulls=True), F.array().cast("array<string>"))
    pair = side(old, "o1", "o2", 1).unionByName(side(new, "n1", "n2", 2)).groupBy("k").agg(of(1).alias("old"), of(2).alias("new"))
    tag = lambda c, kind: F.transform(c, lambda x: F.struct(x.alias("item"), F.lit(kind).alias("change_kind")))
    return pair.select("k", F.inline(F.concat(tag(F.array_except("new", "old"), "added"), tag(F.array_except("old", "new"), "removed"))))


class SnapshotStore:
    """Deliveries of one table, the bucketed key-to-signature index of the last one, and the changes found.

    receive   writes the signed rows of a delivery, as they come, into a folder of its own (nothing is shuffled)
    advance   builds its index (narrow rows, bucketed), probes it with the last one bucket by bucket, fetches
              the lists of changed keys, writes the changes, and then swaps the pointer to the new index

    A run that fails leaves the last index valid and is repeated whole; a delivery that was
    already passed changes nothing, and its changes can still be read. Rows of deliveries
    that no index needs any more are removed.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, order: str, values: list[str], items: Column, buckets: int = 16):
        self.spark, self.key, self.order, self.values, self.items = spark, key, order, values, items
        self.store = Store(spark, folder, buckets, keep=1)

    def current(self) -> int | None:
        """Number of the last delivery."""
        state = self.store.state()
        return state["snap"] if state else None

    def receive(self, df: DataFrame, snap: str) -> list[int]:
        """Takes one or several deliveries; returns their numbers in order."""
        rows = signed(df, self.key, snap, self.order, self.values, self.items)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snap").parquet(f"{self.store.folder}/rows")
        return sorted(int(n.split("=")[1]) for n in self.store.files.names("rows") if n.startswith("snap="))

    def _rows(self, snap: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.store.folder}/rows/snap={snap}")

    def advance(self, snap: int) -> bool:
        """Compares a received delivery with the last one; false if it was passed before."""
        last = self.current()
        if last is not None and last >= snap:
            if last > snap:
                self.store.files.delete(f"rows/snap={snap}")
            return False
        new = self._rows(snap)
        self.store.write(index_of(new), "index", snap, "k")
        if last is not None:
            index = lambda n: self.store.read("index", [n], "k")
            changed = cut(probe(index(last), index(snap)))
            page = changed.select("k", F.lit("").alias("item"), "change_kind")
            page.unionByName(_item_changes(changed, self._rows(last), new)).write.mode("overwrite").parquet(f"{self.store.folder}/changes/snap={snap}")
        self.store.commit({"snap": snap, "tables": {"index": [snap]}})
        if last is not None:
            self.store.files.delete(f"rows/snap={last}")
        return True

    def changes(self, snaps: list[int]) -> DataFrame:
        """(snap, k, item, change_kind) found for these deliveries."""
        paths = [f"{self.store.folder}/changes/snap={n}" for n in snaps if f"snap={n}" in self.store.files.names("changes")]
        if not paths:
            return self.spark.createDataFrame([], "k string, item string, change_kind string, snap int")
        return self.spark.read.option("basePath", f"{self.store.folder}/changes").parquet(*paths)


def changes(df: DataFrame, key: str, snap: str, order: str, values: list[str], items: Column, folder: str | None = None, buckets: int = 16) -> DataFrame:
    """(snap, k, item, change_kind) of every neighbouring pair of deliveries in df, one delivery after the other; item '' is the row itself."""
    spark = df.sparkSession
    store = SnapshotStore(spark, folder or f"{shared_dir(spark)}/snapshots-{uuid.uuid4().hex}", key, order, values, items, buckets)
    received = store.receive(df, snap)
    for n in received:
        store.advance(n)
    return store.changes(received)


def page_changes(snapshots: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages and links added, removed or changed, for each delivery but the first."""
    out = changes(snapshots, "uri", "snap_no", "crawl_date", ["title", "server"], F.transform("outbound_links", lambda x: x["uri"]), folder)
    return out.select(F.col("snap").cast("int").alias("snap_no"), F.col("k").alias("page_uri"), F.col("item").alias("link_uri"), "change_kind")
