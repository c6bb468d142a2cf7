"""The link index: pages, edges, page scores, domain counts, and their cell form.

    edges(src, dst, anchor)        distinct (src, dst), the first anchor wins
    uri_info(uri, links_to, docs)  sum over pages (0, 1) and edge targets (1, 0)
    domain_count(domain, pagecount)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import bound, domain_of_key, json_escaped, rev_encode


def distinct_links(links: Column) -> Column:
    """Links with a key, once per key (the first one), in key order: sorted by key and place, then the first of each run."""
    placed = F.transform(links, lambda x, i: F.struct(x["uri"].alias("uri"), i.alias("i"), x["url"].alias("url"), x["anchor_text"].alias("anchor_text")))
    runs = F.array_sort(F.filter(placed, lambda x: x["uri"].isNotNull()))
    once = bound(runs, lambda s: F.filter(s, lambda x, i: (i == 0) | (x["uri"] != F.get(s, i - 1)["uri"])))
    return F.transform(once, lambda x: F.struct(x["uri"].alias("uri"), x["url"].alias("url"), x["anchor_text"].alias("anchor_text")))


def is_empty(url: Column, links: Column) -> Column:
    """Whether a page says nothing: it has neither an address nor links."""
    return url.isNull() & (F.coalesce(F.size(links), F.lit(0)) <= 0)


def page_table(pages: DataFrame, keep_linkless: bool = False) -> DataFrame:
    """One row per page: of several captures the one with most links, then the latest.

    Without keep_linkless, pages that link nowhere are left out, as the loaders do.
    """
    best = F.struct(F.size("links").alias("n"), "crawl_date", "title", "server", "url", "links")
    rows = pages.where("uri is not null").withColumn("links", F.coalesce(distinct_links(F.col("outbound_links")), F.array()))
    one = rows.groupBy("uri").agg(F.max(best).alias("b")).select("uri", "b.url", F.col("b.n").cast("bigint").alias("num_outbound"), "b.crawl_date", "b.server", "b.title", F.col("b.links").alias("links"))
    return one if keep_linkless else one.where("num_outbound > 0")


def edges(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("uri").alias("src"), F.explode("links").alias("l")).select("src", F.col("l.uri").alias("dst"), F.coalesce("l.anchor_text", F.lit("")).alias("anchor"))


def uri_info(pages: DataFrame) -> DataFrame:
    """(uri, links_to, docs), with partial sums before the only shuffle."""
    seen = pages.select(F.explode(F.concat(F.array(F.struct(F.col("uri"), F.lit(0).cast("bigint").alias("links_to"), F.lit(1).cast("bigint").alias("docs"))), F.transform("links", lambda x: F.struct(x["uri"].alias("uri"), F.lit(1).cast("bigint").alias("links_to"), F.lit(0).cast("bigint").alias("docs"))))).alias("e")).select("e.*")
    return seen.groupBy("uri").agg(F.sum("links_to").alias("links_to"), F.sum("docs").alias("docs")).where("links_to <> 0 or docs <> 0")


def domain_count(info: DataFrame) -> DataFrame:
    return info.groupBy(domain_of_key(F.col("uri")).alias("domain")).agg(F.count("*").alias("pagecount"))


def top(info: DataFrame, n: int = 25) -> DataFrame:
    return info.select("uri", "links_to").orderBy(F.desc("links_to"), "uri").limit(n)


def ranked(info: DataFrame, n: int = 25) -> DataFrame:
    """Best n pages of every domain; the window's limit is applied before its shuffle."""
    rows = info.select(domain_of_key(F.col("uri")).alias("domain"), "uri", "links_to")
    w = W.partitionBy("domain").orderBy(F.desc("links_to"), "uri")
    return rows.withColumn("rank_no", F.row_number().over(w)).where(F.col("rank_no") <= n)


def page_json(pages: DataFrame) -> DataFrame:
    """(uri, json) of pages with links, in the store's JSON form."""
    link = F.transform("links", lambda x: F.struct(x["url"].alias("url"), x["uri"].alias("uri"), F.coalesce(x["anchor_text"], F.lit("")).alias("anchorText")))
    doc = F.struct("url", "uri", F.col("num_outbound").alias("numOutbound"), F.col("crawl_date").alias("crawlDate"), "server", "title", link.alias("outboundLinks"))
    return pages.where("num_outbound > 0").select("uri", json_escaped(F.to_json(doc)).alias("json"))


def _score_cells(uri: Column, n: Column) -> list[Column]:
    """The three cells of a page's score."""
    order = rev_encode(n)
    of = lambda row, cf, cq: F.struct(row.alias("row"), F.lit(cf).alias("cf"), F.lit(cq).alias("cq"), n.cast("string").alias("value"))
    return [
        of(F.concat(F.lit("t:"), order, F.lit(":"), uri), "", ""),
        of(F.concat(F.lit("d:"), domain_of_key(uri), F.lit(":"), order, F.lit(":"), uri), "rank", ""),
        of(F.concat(F.lit("p:"), uri), "page", "incount"),
    ]


def _page_cell(pages: DataFrame) -> DataFrame:
    return page_json(pages).select(F.concat(F.lit("p:"), "uri").alias("row"), F.lit("page").alias("cf"), F.lit("cur").alias("cq"), F.col("json").alias("value"))


def _inlink_cells(edges_: DataFrame, *more: str) -> DataFrame:
    return edges_.select(*more, F.concat(F.lit("p:"), "dst").alias("row"), F.lit("inlinks").alias("cf"), F.col("src").alias("cq"), F.col("anchor").alias("value"))


def cells(pages: DataFrame, info: DataFrame, domains: DataFrame) -> DataFrame:
    """The index as cells (row, cf, cq, value) of a sorted key-value store."""
    scores = info.select(F.inline(F.array(*_score_cells(F.col("uri"), F.col("links_to")))))
    count = domains.select(F.concat(F.lit("d:"), "domain").alias("row"), F.lit("domain").alias("cf"), F.lit("pagecount").alias("cq"), F.col("pagecount").cast("string").alias("value"))
    return _page_cell(pages).unionByName(_inlink_cells(edges(pages))).unionByName(scores).unionByName(count)


def mutations(touched: DataFrame, edge_changes: DataFrame, infos: DataFrame, domains: DataFrame) -> DataFrame:
    """(op, row, cf, cq, value) that a batch of changes causes in the cells, from the changed rows alone.

    touched: pages with links and gone; edge_changes: (dst, src, anchor, gone); infos: (uri, links_to, docs
    before, dl, dd); domains: (domain, was, delta).
    """
    put, delete = F.lit("put").alias("op"), F.lit("delete").alias("op")
    pages = _page_cell(touched.where("not gone").withColumn("num_outbound", F.size("links").cast("bigint"))).select(put, "*")
    no_page = touched.where("gone or size(links) = 0").select(delete, F.concat(F.lit("p:"), "uri").alias("row"), F.lit("page").alias("cf"), F.lit("cur").alias("cq"), F.lit(None).cast("string").alias("value"))
    inlinks = _inlink_cells(edge_changes.withColumn("op", F.when(F.col("gone"), "delete").otherwise("put")), "op")
    n0, n1 = F.col("links_to"), F.coalesce("links_to", F.lit(0)) + F.col("dl")
    lives = (n1 != 0) | (F.coalesce("docs", F.lit(0)) + F.col("dd") != 0)
    moved = infos.where(n0.isNotNull() & (~lives | (F.col("dl") != 0)))
    # the two rank cells move when the score changes; the score of the page is overwritten or removed
    old = moved.select(lives.alias("lives"), F.inline(F.array(*_score_cells(F.col("uri"), n0)))).where("cf <> 'page' or not lives").select(delete, "row", "cf", "cq", "value")
    new = infos.where(lives & (n0.isNull() | (F.col("dl") != 0))).select(put, F.inline(F.array(*_score_cells(F.col("uri"), n1))))
    now = F.col("was") + F.col("delta")
    count = domains.select(F.when(now == 0, "delete").otherwise("put").alias("op"), F.concat(F.lit("d:"), "domain").alias("row"), F.lit("domain").alias("cf"), F.lit("pagecount").alias("cq"), now.cast("string").alias("value"))
    out = pages
    for more in (no_page, inlinks, old, new, count):
        out = out.unionByName(more)
    return out.withColumn("value", F.when(F.col("op") == "put", F.col("value")))


def cell_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Mutations (op, row, cf, cq, value) that turn one set of cells into another."""
    key = ["row", "cf", "cq"]
    both = old.withColumnRenamed("value", "old").withColumn("has_old", F.lit(True)).join(new.withColumnRenamed("value", "new").withColumn("has_new", F.lit(True)), key, "full_outer")
    gone, put = F.col("has_new").isNull(), F.col("has_old").isNull() | ~F.col("old").eqNullSafe(F.col("new"))
    return both.where(gone | put).select(F.when(gone, "delete").otherwise("put").alias("op"), *key, F.col("new").alias("value"))


def split_points(cells_: DataFrame, n: int = 100, width: int = 29, seed: int = 7) -> DataFrame:
    """Row prefixes of n random rows, sorted: where to cut a table into ranges. One pass that keeps n rows per task; nothing is sorted globally."""
    return cells_.select(F.substring("row", 1, width).alias("split"), F.rand(seed).alias("r")).orderBy("r").limit(n).select("split").distinct().orderBy("split")


def statistics(pages: DataFrame) -> DataFrame:
    """pages, pages without links, links, in one pass."""
    return pages.agg(F.count("*").alias("pages"), F.count_if(F.col("num_outbound") == 0).alias("empty_pages"), F.coalesce(F.sum("num_outbound"), F.lit(0)).alias("links"))


def time_buckets(events: DataFrame, ts: str, value: str, by: list[str], width: str = "30 seconds") -> DataFrame:
    """Sum of a metric per tumbling window; works on batches and streams."""
    w = F.window(ts, width)
    return events.groupBy(w.alias("w"), *by).agg(F.sum(value).alias("total"), F.count("*").alias("n")).select(F.col("w.start").alias("bucket"), *by, "total", "n")


def rates(events: DataFrame, ts: str, value: str, by: list[str], width: str = "5 minutes", seconds: int = 300) -> DataFrame:
    """Mean of a metric per second in each window."""
    return time_buckets(events, ts, value, by, width).select("bucket", *by, (F.col("total") / seconds).alias("per_second"))
