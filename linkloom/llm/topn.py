"""The N best items of every group by merging sorted runs.

(1) Every task's rows are sorted by (group, score descending, item): a run. While
the run is formed, a group is left after its first N rows, so a group holding a
third of the table leaves at most N rows per run. (2) Runs are bucketed by the
group's hash. (3) A bucket is merged as a stream: of the groups that have arrived
whole, the runs are merged with a loser tree, and after N outputs of a group every
run seeks to its next group by binary search.

Where more than `fan_in` tasks form runs, groups are first merged by blocks of
`fan_in` runs, N rows of a group leaving each block, so a merge never holds more than
one Arrow batch and the fan_in x N rows of one group, and a hot group is split.

Defined results
* null groups, null or NaN scores, null items: not ranked
* scores keep their type: whole numbers, decimals and fractions rank by value
* equal scores: the bytewise smaller item first; repeated (group, item) rows are
  ranked as delivered unless `latest` removed them
* empty tables: no rows; extra columns: ignored
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


class Run:
    """A sorted run with a cursor: keys are (group, -score, item bytes)."""

    def __init__(self, groups: list, scores: list, items: list[bytes]):
        self.groups, self.scores, self.items, self.i = groups, scores, items, 0
        self.load()

    def load(self) -> None:
        i = self.i
        self.key = None if i >= len(self.groups) else (self.groups[i], -self.scores[i], self.items[i])

    def step(self) -> None:
        self.i += 1
        self.load()

    def seek_past(self, group) -> None:
        """Moves to the first row of a later group by binary search."""
        self.i = bisect_right(self.groups, group, self.i)
        self.load()


class LoserTree:
    """Tournament tree over k runs: every inner node keeps the loser, node 0 the winner."""

    def __init__(self, runs: list[Run]):
        self.runs, self.k = runs, len(runs)
        self.build()

    def _beats(self, a: int, b: int) -> bool:
        if b < 0:
            return True
        if a < 0:
            return False
        x, y = self.runs[a].key, self.runs[b].key
        return y is None or (x is not None and (x, a) < (y, b))

    def build(self) -> None:
        k = self.k
        self.tree = [-1] * max(1, k)
        win = [-1] * (2 * k)
        win[k:] = range(k)
        for n in range(k - 1, 0, -1):
            a, b = win[2 * n], win[2 * n + 1]
            first = self._beats(a, b)
            win[n], self.tree[n] = (a, b) if first else (b, a)
        self.tree[0] = win[1] if k > 1 else 0

    def winner(self) -> Run | None:
        r = self.runs[self.tree[0]]
        return None if r.key is None else r

    def replay(self) -> None:
        """After the winner's run moved: one comparison per level."""
        w = self.tree[0]
        n = (w + self.k) // 2
        while n > 0:
            if self._beats(self.tree[n], w):
                w, self.tree[n] = self.tree[n], w
            n //= 2
        self.tree[0] = w


def merge_top(runs: list[Run], n: int) -> Iterator[tuple]:
    """(group, score, item, rank) of the first n rows of each group over all runs."""
    if not runs:
        return
    tree, group, rank = LoserTree(runs), None, 0
    while (r := tree.winner()) is not None:
        g = r.key[0]
        if g != group:
            group, rank = g, 0
        if rank < n:
            rank += 1
            yield g, -r.key[1], r.key[2], rank
            r.step()
            tree.replay()
        else:  # the winner of each replay is again in this group until all runs have left it
            r.seek_past(group)
            tree.replay()


def _first_of_group(n: int):
    """Keeps the first n rows of each group of a sorted stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            codes = b.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            start = np.r_[True, codes[1:] != codes[:-1]]
            begin = np.maximum.accumulate(np.where(start, np.arange(len(codes)), 0))
            pos = np.arange(len(codes)) - begin
            if b.column(0)[0].as_py() == last:
                pos[begin == 0] += seen
            last, seen = b.column(0)[b.num_rows - 1].as_py(), int(pos[-1]) + 1
            if (keep := pos < n).any():
                yield b.filter(pa.array(keep))

    return run


def _merge_stream(n: int, kind: pa.DataType):
    """Merges batches sorted by (group, run, rank in the run): (g, score, item, block, rank_no)."""

    def merged(whole: pa.Table) -> pa.RecordBatch:
        ids = whole["run"].to_numpy()
        order = np.argsort(ids, kind="stable")  # the rows of a run stay in its order
        ids, whole = ids[order], whole.take(pa.array(order))
        g, s, i, block = (whole[c].to_pylist() for c in ("g", "score", "item", "block"))
        g, i = [(x.encode(), n) for x, n in zip(g, block)], [x.encode() for x in i]
        cuts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1], True]).tolist()
        runs = [Run(g[lo:hi], s[lo:hi], i[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]
        out = list(merge_top(runs, n))
        cols = [[x[0][0].decode() for x in out], [x[1] for x in out], [x[2].decode() for x in out], [x[0][1] for x in out], [x[3] for x in out]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), kind, pa.string(), pa.int64(), pa.int32()))], ["g", "score", "item", "block", "rank_no"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # the rows so far of a group that may go on
        for b in batches:
            if not b.num_rows:
                continue
            keys = pa.StructArray.from_arrays([b.column("g"), b.column("block")], ["g", "block"])
            last, first = keys[b.num_rows - 1], keys[0]
            if rest and rest[-1].column("g")[rest[-1].num_rows - 1].as_py() == first["g"].as_py() and rest[-1].column("block")[rest[-1].num_rows - 1].as_py() == first["block"].as_py() and first == last:
                rest.append(b)
                continue
            same = pc.and_(pc.equal(b.column("g"), last["g"]), pc.equal(b.column("block"), last["block"])).to_numpy(zero_copy_only=False)
            at = int(same.argmax())  # where the last group of the batch begins
            if rest or at:
                yield merged(pa.Table.from_batches([*rest, b.slice(0, at)] if not (at == 0 and rest) else rest))
            rest = [b.slice(at)]
        if rest:
            yield merged(pa.Table.from_batches(rest))

    return run


def top_n(df: DataFrame, group: Column, score: Column, item: Column, n: int, tasks: int | None = None, fan_in: int = 64) -> DataFrame:
    """(g, item, score, rank_no): rank 1 to n of every group. tasks: how many form runs (default: as many as a shuffle has)."""
    rows = df.select(group.cast("string").alias("g"), score.alias("score"), item.cast("string").alias("item")).where("g is not null and score is not null and item is not null")
    kind = rows.schema["score"].dataType
    if kind.typeName() in ("float", "double"):
        rows = rows.where(~F.isnan("score"))
    name, arrow = kind.simpleString(), to_arrow_type(kind)
    best = ["g", "block", "run", F.desc("score"), "item"]
    head = rows.sortWithinPartitions("g", F.desc("score"), "item").mapInArrow(_first_of_group(n), f"g string, score {name}, item string")
    runs = head.withColumn("run", F.spark_partition_id().cast("bigint"))
    left = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merge = lambda x: x.sortWithinPartitions(*best).mapInArrow(_merge_stream(n, arrow), f"g string, score {name}, item string, block bigint, rank_no int")
    while left > fan_in:
        left = -(-left // fan_in)
        runs = merge(runs.withColumn("block", F.floor(F.col("run") / fan_in)).repartition("g", "block")).select("g", "score", "item", F.col("block").alias("run"))
    return merge(runs.withColumn("block", F.lit(0).cast("bigint")).repartition("g")).select("g", "item", "score", "rank_no")


def latest(df: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """(key, value) of the latest row of each key; of equal times the greatest value, nulls being least."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(F.col(at).alias("t"), F.col(value).alias("v"))).alias("b")).select(key, F.col("b.v").alias(value))


def domain_leaders(uri_info: DataFrame, n: int = 5) -> DataFrame:
    """(rev_domain, rank_no, uri, links_to): the n pages of each domain with most links, then by uri."""
    best = latest(uri_info, "uri", "as_of_ts", "links_to")
    out = top_n(best, F.substring_index("uri", ">", 1), F.col("links_to"), F.col("uri"), n)
    return out.select(F.col("g").alias("rev_domain"), "rank_no", F.col("item").alias("uri"), F.col("score").alias("links_to"))
