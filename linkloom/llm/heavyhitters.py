"""Most frequent values of a column in bounded memory.

Three stages. (1) Every Arrow batch of 64-bit value hashes is combined locally, so
a value holding a third of the rows leaves one row per batch. (2) The hashes are
partitioned by hash, so each value meets exactly one stream; each stream runs a
count-min sketch with conservative update and a bounded heap of candidates. The
heaps are disjoint, so merging them is a union. (3) The merged candidates, at most
1 / (share - eps) per field by construction, are counted exactly in a second scan.

Bounds: a sketch of width w over a stream of weight n overestimates by more than
e/w * n with probability e^-depth and never underestimates. The heap keeps
4 / share candidates, more than the 1 / (share - e/w) that can reach the
threshold, so no frequent value is lost.

Defined results
* null values: ignored, also in the total; the empty string is a value
* repeated rows count as delivered; ties at the threshold are all kept
* empty tables or all-null columns: no rows; extra columns: ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

WIDTH, DEPTH = 1 << 14, 5


class CountMin:
    """Count-min sketch of 64-bit keys with conservative update, a batch at a time."""

    def __init__(self, width: int = WIDTH, depth: int = DEPTH):
        self.width, self.depth, self.total = width, depth, 0
        self.cells = np.zeros((depth, width), np.int64)
        self.odd = np.random.default_rng(7).integers(1, 1 << 62, depth, dtype=np.uint64) | np.uint64(1)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        k = keys.astype(np.int64).view(np.uint64)
        k = k ^ (k >> np.uint64(31))
        with np.errstate(over="ignore"):
            return np.stack([((k * a) >> np.uint64(40)) % np.uint64(self.width) for a in self.odd]).astype(np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Adds distinct keys and returns their estimates. Each cell is raised only to the least estimate plus the count."""
        at = self._at(keys)
        est = np.min([row[i] for row, i in zip(self.cells, at)], axis=0) + counts
        for row, i in zip(self.cells, at):
            np.maximum.at(row, i, est)
        self.total += int(counts.sum())
        return est


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["field_no", "h"]).aggregate([("h", "count")])
        yield from pa.table({"field_no": t["field_no"], "h": t["h"], "n": t["h_count"]}).to_batches()


def _stream(keep: int, width: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches: dict[int, CountMin] = {}
        heaps: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            f, h, n = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for no in np.unique(f):
                keys, inv = np.unique(h[f == no], return_inverse=True)
                est = sketches.setdefault(no, CountMin(width, depth)).add(keys, np.bincount(inv, n[f == no]).astype(np.int64))
                if no in heaps:  # the newer estimate of a key replaces the older, being larger
                    keys, est = np.concatenate([keys, heaps[no][0]]), np.concatenate([est, heaps[no][1]])
                order = np.lexsort((-est, keys))
                keys, est = keys[order], est[order]
                first = np.r_[True, keys[1:] != keys[:-1]]
                keys, est = keys[first], est[first]
                if len(keys) > keep:
                    top = np.argpartition(-est, keep)[:keep]
                    keys, est = keys[top], est[top]
                heaps[no] = keys, est
        for no, (keys, est) in heaps.items():
            yield pa.RecordBatch.from_pydict({"field_no": pa.array([no] * len(keys), pa.int32()), "h": keys, "estimate": est, "weight": np.r_[sketches[no].total, np.zeros(len(keys) - 1, np.int64)]})

    return run


def candidates(df: DataFrame, columns: list[str], share: float, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(field_no, h, estimate, total): hashes whose estimate reaches the share of the field's non-null rows."""
    hashed = None
    for no, name in enumerate(columns):
        one = df.where(F.col(name).isNotNull()).select(F.lit(no).alias("field_no"), F.xxhash64(name).alias("h"))
        hashed = one if hashed is None else hashed.unionByName(one)
    return _candidates(hashed, share, width, depth)


def _candidates(hashed: DataFrame, share: float, width: int, depth: int) -> DataFrame:
    local = hashed.mapInArrow(_combine, "field_no int, h bigint, n bigint")
    keep = int(np.ceil(4 / share))
    # written once (a few hundred rows per stream), since both the totals and the candidates come from them
    heaps = cut(local.repartition("h").mapInArrow(_stream(keep, width, depth), "field_no int, h bigint, estimate bigint, weight bigint"))
    totals = heaps.groupBy("field_no").agg(F.sum("weight").alias("total"))  # one row per field
    return heaps.join(F.broadcast(totals), "field_no").where(F.col("estimate") >= F.lit(share) * F.col("total")).select("field_no", "h", "estimate", "total")


def frequent(tables: dict[str, tuple[DataFrame, str]], share: float, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(field_name, item, n_rows, estimate, total) of every value that fills at least the share of its column.

    tables: field name -> (table, column). estimate is the sketch's count, n_rows the exact one.
    """
    hashed = values = None
    for no, (name, (df, column)) in enumerate(tables.items()):
        rows = df.where(F.col(column).isNotNull())
        h = rows.select(F.lit(no).alias("field_no"), F.xxhash64(column).alias("h"))
        v = rows.select(F.lit(no).alias("field_no"), F.lit(name).alias("field_name"), F.xxhash64(column).alias("h"), F.col(column).cast("string").alias("item"))
        hashed, values = (h, v) if hashed is None else (hashed.unionByName(h), values.unionByName(v))
    found = _candidates(hashed, share, width, depth)
    # at most 1 / (share - eps) rows per field reach the threshold: safe to broadcast
    exact = values.join(F.broadcast(found), ["field_no", "h"]).groupBy("field_name", "item").agg(F.count("*").alias("n_rows"), F.first("estimate").alias("estimate"), F.first("total").alias("total"))
    return exact.where(F.col("n_rows") >= F.lit(share) * F.col("total"))
