"""Distinct counts of huge identifier sets from mergeable log-log registers.

Each row sets one register of its finest group (day, segment, server): register
number = low bits of the identifier's hash, value = greatest rank (leading zeros
plus one) of the other bits. Coarser groups merge finer ones by register maximum.
All of it is built-in hash aggregation over integers, with map-side combining;
a group never has more than 2^p states, however many rows or identifiers it has.

The standard error is 1.04 / sqrt(2^p), 1.63 % at p = 12; below 2.5 * 2^p the
number of empty registers gives the count (linear counting), which is closer.

Defined results
* null identifiers: ignored; null segments or servers: no group of their own,
  but counted where that dimension is 'all'
* repeated rows count in n_rows as delivered
* crawl dates that are no time: no group; a time without zone is taken as UTC
* empty tables: no rows
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, if_small

P = 12
ALL_SEGMENTS, ALL_SERVERS = -1, "*"


def standard_error(p: int = P) -> float:
    return 1.04 / (1 << p) ** 0.5


def utc_day(text: Column) -> Column:
    """UTC day YYYY-MM-DD of an ISO time; independent of the session's zone."""
    zoned = F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)\s*$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds(zoned.try_cast("timestamp")) / 86400).cast("int")).cast("string")


def with_register(df: DataFrame, column: str, p: int = P) -> DataFrame:
    """Adds reg and rho of the column's 64-bit hash."""
    h = F.xxhash64(F.col(column))
    rest = F.shiftrightunsigned(h, p)  # 64 - p bits, never negative
    length = F.when(rest == 0, 0).otherwise(F.length(F.bin(rest)))
    return df.withColumns({"reg": h.bitwiseAND(F.lit((1 << p) - 1)).cast("int"), "rho": (F.lit(64 - p + 1) - length).cast("int")})


def registers(df: DataFrame, groups: list[str], column: str, p: int = P) -> DataFrame:
    """Partial result (groups, reg, rho, n_rows); may be stored and merged later."""
    rows = df.where(F.col(column).isNotNull())
    return with_register(rows, column, p).groupBy(*groups, "reg").agg(F.max("rho").alias("rho"), F.count("*").alias("n_rows"))


def merge(partials: DataFrame, groups: list[str]) -> DataFrame:
    """Union of partial results: maximum per register."""
    return partials.groupBy(*groups, "reg").agg(F.max("rho").alias("rho"), F.sum("n_rows").alias("n_rows"))


def estimate(partials: DataFrame, groups: list[str], p: int = P) -> DataFrame:
    """(groups, n_rows, n_distinct, std_error): the estimate and its absolute standard error."""
    m = 1 << p
    s = partials.groupBy(*groups).agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("used"), F.sum(F.pow(F.lit(2.0), -F.col("rho"))).alias("z"))
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("z") + F.lit(m) - F.col("used"))
    linear = F.lit(float(m)) * F.log(F.lit(float(m)) / (F.lit(m) - F.col("used")))
    n = F.when((raw <= 2.5 * m) & (F.col("used") < m), linear).otherwise(raw)
    return s.select(*groups, "n_rows", n.alias("n_distinct"), (n * F.lit(standard_error(p))).alias("std_error"))


def cube(base: DataFrame) -> DataFrame:
    """Registers of (day, segment, server) to those of all four groupings, by register maximum."""
    seg, srv = F.lit(ALL_SEGMENTS), F.lit(ALL_SERVERS)
    with_seg, with_srv = base.where("segment_no is not null"), base.where("server is not null")
    by = ["crawl_day", "segment_no", "server"]
    sets = [
        merge(base.withColumns({"segment_no": seg, "server": srv}), by),
        merge(with_seg.withColumn("server", srv), by),
        merge(with_srv.withColumn("segment_no", seg), by),
        with_seg.where("server is not null").select(*by, "reg", "rho", "n_rows"),
    ]
    out = sets[0]
    for x in sets[1:]:
        out = out.unionByName(x)
    return out


def daily(fetches: DataFrame) -> DataFrame:
    return fetches.select(utc_day(F.col("crawl_date")).alias("crawl_day"), F.col("segment_no").cast("int"), "server", "uri").where("crawl_day is not null and uri is not null")


def daily_distinct(fetches: DataFrame, p: int = P) -> DataFrame:
    """(crawl_day, segment_no, server, n_rows, n_distinct, std_error) of all four groupings; the rows are read once."""
    by = ["crawl_day", "segment_no", "server"]
    return estimate(cube(cut(registers(daily(fetches), by, "uri", p))), by, p)


def finest_to_all(rows: DataFrame) -> DataFrame:
    """(crawl_day, segment_no, server, uri): each row once per grouping it counts in."""
    return rows.select("crawl_day", F.explode(F.array(
        F.struct(F.lit(ALL_SEGMENTS).alias("segment_no"), F.lit(ALL_SERVERS).alias("server")),
        F.struct(F.col("segment_no"), F.lit(ALL_SERVERS).alias("server")),
        F.struct(F.lit(ALL_SEGMENTS).alias("segment_no"), F.col("server")),
        F.struct(F.col("segment_no"), F.col("server")),
    )).alias("g"), "uri").select("crawl_day", "g.segment_no", "g.server", "uri")


def exact_counts(rows: DataFrame) -> DataFrame:
    """(crawl_day, segment_no, server, n_exact), by distinct pairs; for tests and for the few groups at the edge of a ratio."""
    by = ["crawl_day", "segment_no", "server"]
    return rows.groupBy(*by, "uri").agg(F.lit(1).alias("one")).groupBy(*by).agg(F.count("*").alias("n_exact"))


def repetitive_groups(fetches: DataFrame, at_least: int = 100, ratio: float = 0.5, band: float = 5.0, p: int = P, fine: int = 18) -> DataFrame:
    """Groups whose distinct count is below the ratio of their rows.

    Groups further than `band` standard errors from the ratio are decided by their
    registers. Those within it get 2^fine registers (standard error 0.2 %), and only what
    is within the band of these, about 1 % around the ratio, is counted exactly.
    """
    by = ["crawl_day", "segment_no", "server"]
    edge = F.col("n_rows") * F.lit(ratio)
    near = F.abs(F.col("n_distinct") - edge) <= F.lit(band) * F.col("std_error")
    below = ~near & (F.col("n_distinct") < edge)
    groups = cut(daily_distinct(fetches, p).where(F.col("n_rows") >= at_least))
    all_rows = finest_to_all(daily(fetches)).where("segment_no is not null and server is not null")
    unsure = groups.where(near).select(*by)
    closer = cut(estimate(registers(all_rows.join(if_small(unsure), by, "left_semi"), by, "uri", fine), by, fine))
    edge_rows = all_rows.join(if_small(closer.where(near).select(*by)), by, "left_semi")
    exact = exact_counts(edge_rows).join(closer.select(*by, "n_rows"), by).where(F.col("n_exact") < edge)
    return groups.where(below).select(*by).unionByName(closer.where(below).select(*by)).unionByName(exact.select(*by))
