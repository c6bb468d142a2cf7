"""Questions to the index: top pages, pages of a domain, page details, links in and out, with paging."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import is_ip, reverse_host

PAGE_SIZE = 25


@dataclasses.dataclass
class Paged:
    """One page of results, its number and the cursor of the next page ('' on the last)."""

    rows: list
    page_no: int
    next: str
    total: int | None = None


def after(df: DataFrame, cursor: tuple[int, str] | None) -> DataFrame:
    """Rows from a (links_to, uri) cursor on, itself included."""
    if cursor is None:
        return df
    n, uri = cursor
    return df.where((F.col("links_to") < n) | ((F.col("links_to") == n) & (F.col("uri") >= uri)))


def page_of(df: DataFrame, page_no: int = 0, cursor: tuple[int, str] | None = None, size: int = PAGE_SIZE) -> DataFrame:
    """size + 1 rows in rank order; the last one is the next page's cursor. A cursor wins over the number."""
    found = after(df, cursor).orderBy(F.desc("links_to"), "uri")
    return (found if cursor is not None or not page_no else found.offset(page_no * size)).limit(size + 1)


class LinkIndex:
    """Reads the tables pages, edges, uri_info and domain_count; stored ones are clustered by the key a question names, so it reads one bucket."""

    def __init__(self, pages: DataFrame, edges: DataFrame, uri_info: DataFrame, domain_count: DataFrame):
        self.pages, self.edges, self.uri_info, self.domain_count = pages, edges, uri_info, domain_count

    @staticmethod
    def _paged(df: DataFrame, page_no: int, name, size: int = PAGE_SIZE, total: int | None = None) -> Paged:
        rows = df.collect()  # at most size + 1
        return Paged(rows[:size], page_no, name(rows[size]) if len(rows) > size else "", total)

    def top(self, page_no: int = 0, cursor: tuple[int, str] | None = None) -> Paged:
        return self._paged(page_of(self.uri_info, page_no, cursor), page_no, lambda r: f"{r.links_to}:{r.uri}")

    def _rev(self, domain: str):
        d = F.lit(domain.strip().lower())  # all of it constants, folded before the scan is planned
        return F.when(is_ip(d), d).otherwise(reverse_host(d))

    def domain_stats(self, domain: str) -> DataFrame:
        """(domain, total); 0 for an unknown domain."""
        rev = self._rev(domain)
        return self.domain_count.where(F.col("domain") == rev).agg(F.coalesce(F.max("pagecount"), F.lit(0)).alias("total")).select(F.lit(domain.strip().lower()).alias("domain"), "total")

    def domain_pages(self, domain: str) -> DataFrame:
        """Keys begin with their domain, so the filter skips row groups of the sorted table."""
        return self.uri_info.where(F.col("uri").startswith(F.concat(self._rev(domain), F.lit(">")))).select("uri", "links_to")

    def pages_of(self, domain: str, page_no: int = 0, cursor: tuple[int, str] | None = None) -> Paged:
        total = self.domain_stats(domain).first()["total"]
        return self._paged(page_of(self.domain_pages(domain), page_no, cursor), page_no, lambda r: f"{r.links_to}:{r.uri}", total=total)

    def page(self, uri: str) -> DataFrame:
        """Details of a page with its in-count (0 if unknown); one row also for an unknown page."""
        one = self.pages.sparkSession.range(1).select(F.lit(uri).alias("uri"))
        return one.join(self.pages.where(F.col("uri") == uri), "uri", "left").join(self.uri_info.where(F.col("uri") == uri).select("uri", "links_to"), "uri", "left").select("uri", "url", F.coalesce("links_to", F.lit(0)).alias("num_inbound"), F.coalesce("num_outbound", F.lit(0)).alias("num_outbound"), "crawl_date", "server", "title")

    def links_in(self, uri: str, start: str = "", page_no: int = 0, size: int = PAGE_SIZE) -> DataFrame:
        found = self.edges.where((F.col("dst") == uri) & (F.col("src") >= start)).select(F.col("src").alias("uri"), "anchor").orderBy("uri")
        return (found.offset(page_no * size) if page_no and not start else found).limit(size + 1)

    def links_out(self, uri: str, page_no: int = 0, size: int = PAGE_SIZE) -> DataFrame:
        stored = self.pages.where(F.col("uri") == uri).select(F.posexplode("links").alias("pos", "l"))
        return stored.where((F.col("pos") >= page_no * size) & (F.col("pos") <= (page_no + 1) * size)).select(F.col("l.uri").alias("uri"), F.coalesce("l.anchor_text", F.lit("")).alias("anchor")).orderBy("uri")
