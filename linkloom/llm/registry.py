"""Queries of the problems for training data, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from . import encode, garbled, heavyhitters, leaks, loglog, subjects, topn


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    found = heavyhitters.frequent({"dst_uri": (table(spark, d, "links"), "dst_uri"), "uri": (table(spark, d, "fetches"), "uri")}, 0.005)
    return found.select("field_name", "item")


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    found = heavyhitters.frequent({"dst_uri": (table(spark, d, "links"), "dst_uri"), "uri": (table(spark, d, "fetches"), "uri")}, 0.005)
    return found.select("field_name", "item", "n_rows")


def p2_estimates(spark: SparkSession, d: str) -> DataFrame:
    """The sketch's own counts, and whether they keep its bounds: never below the exact count, above it by at most e/width of the rows."""
    found = heavyhitters.frequent({"dst_uri": (table(spark, d, "links"), "dst_uri"), "uri": (table(spark, d, "fetches"), "uri")}, 0.005)
    over = F.col("estimate") - F.col("n_rows")
    return found.select("field_name", "item", (over >= 0).alias("not_below"), (over <= F.col("total") * (2.718281828 / heavyhitters.WIDTH)).alias("within_bound"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = garbled.text_rows(table(spark, d, "links"), table(spark, d, "wat_records"))
    return garbled.garbled_rows(rows, repair=False).select("field_name", "row_id", "list_pos").distinct()


def p3_repairs(spark: SparkSession, d: str) -> DataFrame:
    return garbled.garbled_rows(garbled.text_rows(table(spark, d, "links"), table(spark, d, "wat_records")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return loglog.repetitive_groups(table(spark, d, "fetches"))


def p5_estimates(spark: SparkSession, d: str) -> DataFrame:
    return loglog.daily_distinct(table(spark, d, "fetches"))


def p5_errors(spark: SparkSession, d: str) -> DataFrame:
    """Estimates against exact counts: whether each lies within five standard errors (or one item)."""
    by = ["crawl_day", "segment_no", "server"]
    rows = loglog.finest_to_all(loglog.daily(table(spark, d, "fetches"))).where("segment_no is not null and server is not null")
    both = loglog.daily_distinct(table(spark, d, "fetches")).join(loglog.exact_counts(rows), by)
    off = F.abs(F.col("n_distinct") - F.col("n_exact"))
    return both.select(*by, "n_rows", "n_exact", (off <= F.greatest(F.lit(1.0), 5 * F.col("std_error"))).alias("within"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.domain_leaders(table(spark, d, "uri_info")).select("rev_domain", "rank_no", "uri")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_evidence(spark, d).select("doc_id", "item_id")


def p9_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Each case with the number of its sentences held, and the shares of its question's and answer's words."""
    return leaks.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.assign(table(spark, d, "documents"), table(spark, d, "subjects"), table(spark, d, "subject_samples"))


QUERIES = {
    "p2_found": p2_found,
    "p2_counts": p2_counts,
    "p2_estimates": p2_estimates,
    "p3_found": p3_found,
    "p3_repairs": p3_repairs,
    "p5_found": p5_found,
    "p5_estimates": p5_estimates,
    "p5_errors": p5_errors,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_evidence": p9_evidence,
    "p10_found": p10_found,
}

_FREQUENT = " UNION ALL ".join(
    f"SELECT '{c}' AS field_name, {c} AS item{{}} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) >= 0.005 * (SELECT count({c}) FROM {t})" for c, t in (("dst_uri", "links"), ("uri", "fetches"))
)
_GROUPS = """WITH f AS (SELECT strftime(crawl_date::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m-%d') AS crawl_day, segment_no, server, uri FROM fetches WHERE uri IS NOT NULL AND crawl_date IS NOT NULL),
g AS (SELECT crawl_day, -1 AS segment_no, '*' AS server, uri FROM f
      UNION ALL SELECT crawl_day, segment_no, '*', uri FROM f WHERE segment_no IS NOT NULL
      UNION ALL SELECT crawl_day, -1, server, uri FROM f WHERE server IS NOT NULL
      UNION ALL SELECT crawl_day, segment_no, server, uri FROM f WHERE segment_no IS NOT NULL AND server IS NOT NULL)
"""
ORACLES = {
    "p2_found": _FREQUENT.replace("{}", ""),
    "p2_counts": _FREQUENT.replace("{}", ", count(*)::BIGINT AS n_rows"),
    "p2_estimates": _FREQUENT.replace("{}", ", true AS not_below, true AS within_bound"),
    "p5_found": _GROUPS + "SELECT crawl_day, segment_no::INTEGER AS segment_no, server FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 100 AND count(DISTINCT uri) < 0.5 * count(*)",
    "p5_errors": _GROUPS + "SELECT crawl_day, segment_no::INTEGER AS segment_no, server, count(*)::BIGINT AS n_rows, count(DISTINCT uri)::BIGINT AS n_exact, true AS within FROM g GROUP BY 1, 2, 3",
    "p7_found": """WITH v AS (SELECT uri, links_to, row_number() OVER (PARTITION BY uri ORDER BY as_of_ts DESC, links_to DESC NULLS LAST) AS rn FROM uri_info WHERE uri IS NOT NULL),
r AS (SELECT split_part(uri, '>', 1) AS rev_domain, uri, row_number() OVER (PARTITION BY split_part(uri, '>', 1) ORDER BY links_to DESC, uri) AS rank_no FROM v WHERE rn = 1 AND links_to IS NOT NULL)
SELECT rev_domain, rank_no::INTEGER AS rank_no, uri FROM r WHERE rank_no <= 5""",
}
