"""Crawl archive records to pages: parse, select links, drop what is no page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import address_of, domain_sql, key_of, split_url
from . import variants

# The content type of records and the place of anchors in a page.
CONTENT_TYPE, ANCHOR_PATH = "application/json", "A@/href"


def _ends_the_list(x: Column) -> Column:
    """A link that is no object, or an anchor with an address whose url, text or title is no string."""
    kind = lambda k: F.schema_of_variant(variants.get(x, k))
    odd = lambda k: F.coalesce(kind(k) != "STRING", F.lit(False))
    read = (variants.text_at(x, "path") == ANCHOR_PATH) & variants.get(x, "url").isNotNull()
    text = F.when(variants.get(x, "text").isNotNull(), odd("text")).otherwise(odd("title"))
    return F.coalesce(~F.schema_of_variant(x).startswith("OBJECT"), F.lit(True)) | F.coalesce(read & (odd("url") | text), F.lit(False))


def raw_pages(records: DataFrame, exact: bool = False) -> DataFrame:
    """(record_no, url, crawl_date, server, title, raw_links): valid JSON records of the right type.

    raw_links: (pos, url, anchor_text) of anchors with an address; text, else title, else ''.
    A body that is no valid JSON gives no page; a missing response part a page without links.
    Ill-typed links are skipped; with exact, the first of them ends the page's list.
    """
    ok = F.lower("content_type") == CONTENT_TYPE
    d = F.col("doc")
    links = variants.get(d, *variants.LISTS["Links"], kind="array<variant>")
    if exact:
        first = F.array_position(F.transform(links, _ends_the_list), True)
        links = F.when(first > 0, F.slice(links, 1, F.greatest(first - 1, F.lit(0)).cast("int"))).otherwise(links)
    pick = lambda x, i: F.struct(i.alias("pos"), variants.text_at(x, "url").alias("url"), F.coalesce(variants.text_at(x, "text"), variants.text_at(x, "title"), F.lit("")).alias("anchor_text"), variants.text_at(x, "path").alias("path"))
    found = F.filter(F.transform(F.coalesce(links, F.array().cast("array<variant>")), pick), lambda z: (z["path"] == ANCHOR_PATH) & z["url"].isNotNull())
    found = F.when(F.col("content_type") == CONTENT_TYPE, found)
    key = [c for c in ("record_no",) if c in records.columns]
    docs = variants.readable(records).where(ok).select(*key, "target_uri", "warc_date", "content_type", variants.parsed(F.col("body")).alias("doc")).where("doc is not null")
    response = ("Envelope", "Payload-Metadata", "HTTP-Response-Metadata")
    return docs.select(
        *key, F.col("target_uri").alias("url"), F.col("warc_date").alias("crawl_date"),
        variants.text_at(d, *response, "Headers", "Server").alias("server"), variants.text_at(d, *variants.HTML, "Head", "Title").alias("title"),
        F.coalesce(found, F.array().cast("array<struct<pos:int,url:string,anchor_text:string,path:string>>")).alias("raw_links"),
    )


def pages(records: DataFrame, suffixes: DataFrame | None = None, exact: bool = False) -> DataFrame:
    """Pages in the page schema (and record_no, where records have it). Links to the page's own domain and invalid links are dropped, relative ones not resolved.

    One narrow stage: bodies are parsed once, links stay in their page's array.
    """
    raw = raw_pages(records, exact)
    key = [c for c in ("record_no",) if c in raw.columns]
    own = F.when(F.col("u.ip_host"), F.col("u.host")).otherwise(F.expr(domain_sql("u.host", suffixes)))
    heads = raw.withColumn("u", split_url(F.col("url"))).where("u is not null").withColumn("domain", own).where("domain is not null")
    split = F.filter(F.transform("raw_links", lambda x: F.struct(split_url(x["url"]).alias("v"), x["anchor_text"].alias("anchor_text"))), lambda x: x["v"].isNotNull())
    named = F.expr(f"transform(split_links, x -> struct(x.v, x.anchor_text, CASE WHEN x.v.ip_host THEN x.v.host ELSE {domain_sql('x.v.host', suffixes)} END AS d))")
    abroad = F.filter("named_links", lambda x: x["d"] != F.col("domain"))  # null domains fall away too
    links = F.transform(abroad, lambda x: F.struct(address_of(x["v"]).alias("url"), key_of(x["v"], x["d"]).alias("uri"), x["anchor_text"].alias("anchor_text")))
    out = heads.withColumn("split_links", split).withColumn("named_links", named).withColumn("outbound_links", links)
    return out.select(address_of(F.col("u")).alias("url"), key_of(F.col("u"), F.col("domain")).alias("uri"), F.size("outbound_links").cast("bigint").alias("num_outbound"), "crawl_date", "server", "title", "outbound_links", *key)
