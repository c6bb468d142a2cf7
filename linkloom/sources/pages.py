"""JSON-lines page documents: read, write, sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.urls import json_escaped


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of JSON-lines files; broken lines are left out."""
    raw = spark.read.schema(schema.PAGE_JSON + ", _broken STRING").option("columnNameOfCorruptRecord", "_broken").json(path)
    link = F.transform("outboundLinks", lambda x: F.struct(x["url"].alias("url"), x["uri"].alias("uri"), x["anchorText"].alias("anchor_text")))
    return raw.where("uri is not null").select("url", "uri", F.col("numOutbound").alias("num_outbound"), F.col("crawlDate").alias("crawl_date"), "server", "title", link.alias("outbound_links"))


def to_json(pages: DataFrame) -> DataFrame:
    """One JSON document per page, absent fields left out."""
    link = F.transform("outbound_links", lambda x: F.struct(x["url"].alias("url"), x["uri"].alias("uri"), x["anchor_text"].alias("anchorText")))
    doc = F.struct("url", "uri", F.col("num_outbound").alias("numOutbound"), F.col("crawl_date").alias("crawlDate"), "server", "title", link.alias("outboundLinks"))
    return pages.select(json_escaped(F.to_json(doc)).alias("value"))


def write_sample(pages: DataFrame, path: str, n: int) -> None:
    """The first n pages that have links, as JSON lines (n is the feature: a sample for development)."""
    to_json(pages.where(F.size("outbound_links") > 0).limit(n)).write.mode("overwrite").text(path)
