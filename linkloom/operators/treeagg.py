"""Per-key results where a few keys hold most rows: tree aggregation.

Every input task combines its own chunk of rows into one state per key; then states
are merged `fan_in` to one in rounds, until at most `fan_in` are left, which the
last round merges. The number of rounds is the logarithm of the number of tasks, so
no task ever receives more than `fan_in` states of a key, however many rows the key
has and however many tasks read them.

* `tree_counts`: rows per key.
* `tree_degrees`: rows and distinct partners per key. Exact distinct partners need
  every (key, partner) pair once, so the pairs are shuffled by their whole value,
  which spreads a hot key over all tasks; two fields that are each other's partner
  share their pairs. The tasks hold disjoint pairs, so their counts add up, by the
  same tree. A partner that is no key itself travels as its 128-bit hash.

Defined results
* null keys: ignored; null partners: count as rows, not as partners
* repeated rows count as delivered; empty tables: no rows
* clashing column names: inputs are renamed on entry, extra columns ignored
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 32


def merge_tree(df: DataFrame, keys: list[str], sums: list[str], tasks: int, fan_in: int = FAN_IN) -> DataFrame:
    """Sums per key of states that `tasks` tasks hold: each task combines its own before they move."""
    df = df.withColumn("slice", F.spark_partition_id())
    while tasks > fan_in:
        tasks = -(-tasks // fan_in)
        df = df.withColumn("slice", F.floor(F.col("slice") / fan_in)).groupBy(*keys, "slice").agg(*[F.sum(s).alias(s) for s in sums])
    return df.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])


def tree_counts(df: DataFrame, names: list[str], fan_in: int = FAN_IN) -> DataFrame:
    """(field_name, key_value, n_rows) for every value of the named columns; one scan for all of them."""
    narrow = df.select(*[F.col(n).cast("string").alias(f"k{i}") for i, n in enumerate(names)])
    each = F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(f"k{i}").alias("key_value")) for i, n in enumerate(names)])
    rows = narrow.select(F.inline(each)).where("key_value is not null").withColumn("n_rows", F.lit(1).cast("bigint"))
    return merge_tree(rows, ["field_name", "key_value"], ["n_rows"], narrow.rdd.getNumPartitions(), fan_in)


def tree_degrees(df: DataFrame, partners: dict[str, str], fan_in: int = FAN_IN) -> DataFrame:
    """(field_name, key_value, n_rows, n_partners): partners maps each key column to its partner column; one scan for all of them."""
    spark = df.sparkSession
    pairs = list(dict.fromkeys((k, v) if (v, k) not in list(partners.items())[: list(partners).index(k)] else (v, k) for k, v in partners.items()))
    both = lambda k, v: partners.get(v) == k
    text = lambda c: F.col(c).cast("string")
    narrow = df.select(F.array(*[F.struct(
        F.lit(no).alias("pair_no"), text(k).alias("x"), (text(v) if both(k, v) else F.lit(None).cast("string")).alias("y"),
        *[(F.lit(None).cast("bigint") if both(k, v) else F.when(F.col(v).isNotNull(), F.xxhash64(F.lit(salt), v))).alias(f"h{salt}") for salt in (1, 2)],
    ) for no, (k, v) in enumerate(pairs)]).alias("ps"))
    once = narrow.select(F.inline("ps")).where("x is not null or y is not null").groupBy("pair_no", "x", "y", "h1", "h2").agg(F.count("*").alias("n_rows"))
    has_y = F.col("y").isNotNull() | F.col("h1").isNotNull()
    state = lambda name, key, other, ok: F.when(ok & key.isNotNull(), F.struct(F.lit(name).alias("field_name"), key.alias("key_value"), F.col("n_rows"), other.cast("bigint").alias("n_partners")))
    states = []
    for no, (k, v) in enumerate(pairs):
        states.append(state(k, F.col("x"), has_y, F.col("pair_no") == no))
        if both(k, v):
            states.append(state(v, F.col("y"), F.col("x").isNotNull(), F.col("pair_no") == no))
    leaf = once.select(F.inline(F.array_compact(F.array(*states))))
    return merge_tree(leaf, ["field_name", "key_value"], ["n_rows", "n_partners"], int(spark.conf.get("spark.sql.shuffle.partitions")), fan_in)


def heavy_keys(counts: DataFrame, share: float) -> DataFrame:
    """Keys that fill at least the share of their field's rows. The totals are one row per field."""
    totals = counts.groupBy("field_name").agg(F.sum("n_rows").alias("total"))
    return counts.join(F.broadcast(totals), "field_name").where(F.col("n_rows") >= F.lit(share) * F.col("total")).select("field_name", "key_value", "n_rows", "total")
