"""Queries of the link index over the driver's tables, with their SQL.

The pages are the last delivery of page_snapshots; crawl records, fetches,
updates and events stand for the other inputs. Questions read a stored index, which
is built once per application and folder of tables.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import index, metrics, records
from ..runtime import shared_dir, table
from ..streaming import incremental
from .query import LinkIndex, page_of


def _captures(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "page_snapshots")
    return s.join(F.broadcast(s.agg(F.max("snap_no").alias("snap_no"))), "snap_no")  # one row


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return index.page_table(_captures(spark, d))


def _tables(spark: SparkSession, d: str):
    p = _pages(spark, d)
    info = index.uri_info(p)
    return p, index.edges(p), info, index.domain_count(info)


def edges(spark, d):
    return index.edges(_pages(spark, d))


def edges_cross_domain(spark, d):
    return edges(spark, d).where(urls.domain_of_key(F.col("src")) != urls.domain_of_key(F.col("dst")))


def pages(spark, d):
    return _pages(spark, d).drop("links")


def pages_with_linkless(spark, d):
    return index.page_table(_captures(spark, d), keep_linkless=True).drop("links")


def uri_info(spark, d):
    return index.uri_info(_pages(spark, d))


def domain_count(spark, d):
    return index.domain_count(uri_info(spark, d))


def top_pages(spark, d):
    return index.top(uri_info(spark, d))


def domain_rank_top25(spark, d):
    return index.ranked(uri_info(spark, d))


def _store(spark: SparkSession, d: str, streamed: bool = False) -> incremental.IndexStore:
    """The stored index of the tables in d; streamed: after the updates, which arrive as a stream of four files that know nothing of their order."""
    name = hashlib.sha1(f"{spark.sparkContext.applicationId} {d}".encode()).hexdigest()
    folder = f"{shared_dir(spark)}/index-{name}{'-streamed' if streamed else ''}"
    store = incremental.IndexStore(spark, folder, cells=streamed, compact=3, buckets=8, ranges=8)
    if store.state() is None:
        store.bootstrap(_captures(spark, d))
    if streamed and store.state()["batch"] == 0:
        updates = table(spark, d, "page_updates")
        updates.repartition(4, F.xxhash64("update_id")).write.mode("overwrite").parquet(f"{folder}/feed")
        feed = spark.readStream.schema(updates.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/feed")
        incremental.run_stream(feed, store, f"{folder}/checkpoint", ["ts", "update_id"], report=metrics.MeterLog(spark, f"{folder}/meters")).awaitTermination()
    return store


def _index(spark: SparkSession, d: str) -> LinkIndex:
    store = _store(spark, d)
    return LinkIndex(*(store.table(t) for t in ("pages", "edges", "uri_info", "domain_count")))


def _first_domain(info: DataFrame) -> str:
    """Address form of the domain with most pages (smallest name among equals)."""
    return ".".join(reversed(index.domain_count(info).orderBy(F.desc("pagecount"), "domain").first()["domain"].split(".")))


def domain_pages(spark, d):
    ix = _index(spark, d)
    return page_of(ix.domain_pages(_first_domain(ix.uri_info)))


def domain_stats(spark, d):
    ix = _index(spark, d)
    return ix.domain_stats(_first_domain(ix.uri_info))


def paging_offset(spark, d):
    return page_of(_index(spark, d).uri_info.select("uri", "links_to"), page_no=2)


def paging_keyset(spark, d):
    info = _index(spark, d).uri_info.select("uri", "links_to")
    last = page_of(info, page_no=2).collect()[-1]
    return page_of(info, cursor=(last["links_to"], last["uri"]))


def inlinks_of(spark, d):
    ix = _index(spark, d)
    return ix.links_in(index.top(ix.uri_info, 1).first()["uri"])


def _most_outbound(p: DataFrame) -> str:
    return p.select("uri", "num_outbound").orderBy(F.desc("num_outbound"), "uri").first()["uri"]


def outlinks_of(spark, d):
    ix = _index(spark, d)
    return ix.links_out(_most_outbound(ix.pages))


def page_lookup(spark, d):
    ix = _index(spark, d)
    return ix.page(_most_outbound(ix.pages))


def page_degrees(spark, d):
    p, _, info, _ = _tables(spark, d)
    return p.select("uri", "num_outbound").join(info.select("uri", F.col("links_to").alias("num_inbound")), "uri")


def index_statistics(spark, d):
    return index.statistics(index.page_table(_captures(spark, d), keep_linkless=True))


def page_json(spark, d):
    return index.page_json(_pages(spark, d))


def index_cells(spark, d):
    p, _, info, n = _tables(spark, d)
    return index.cells(p, info, n)


def index_cells_sorted(spark, d):
    """The first 1,000 cells in the store's order (a top-k report)."""
    return index_cells(spark, d).orderBy("row", "cf", "cq").limit(1000)


def cell_changes(spark, d):
    old, new = (incremental.build(x) for x in _two_snapshots(spark, d))
    of = lambda t: index.cells(t["pages"], t["uri_info"], t["domain_count"])
    return index.cell_changes(of(old), of(new))


def split_points(spark, d):
    p, _, info, n = _tables(spark, d)
    return index.split_points(index.cells(p, info, n))


def rev_encode(spark, d):
    return table(spark, d, "uri_info").where("links_to is not null").select("links_to").distinct().select("links_to", urls.rev_encode(F.col("links_to")).alias("code"))


def rev_encode_order(spark, d):
    """Of each two neighbouring counts, whether their codes descend."""
    from pyspark.sql import Window as W

    w = W.partitionBy(F.lit(1)).orderBy("links_to")  # distinct counts only
    return rev_encode(spark, d).select("links_to", (F.lag("code").over(w) > F.col("code")).alias("descends")).where("descends is not null")


def _two_snapshots(spark, d):
    s = table(spark, d, "page_snapshots")
    top2 = [r.snap_no for r in s.select("snap_no").distinct().orderBy(F.desc("snap_no")).limit(2).collect()]
    return s.where(F.col("snap_no") == top2[-1]), s.where(F.col("snap_no") == top2[0])


def _update_parts(spark, d):
    last = incremental.last_updates(table(spark, d, "page_updates"), ["ts", "update_id"])
    p = _pages(spark, d)
    return p, *incremental.deltas(p, last)


def link_added(spark, d):
    return incremental.link_changes(_update_parts(spark, d)[1]).where("change_kind = 'added'").select("src", "dst")


def link_deleted(spark, d):
    return incremental.link_changes(_update_parts(spark, d)[1]).where("change_kind = 'deleted'").select("src", "dst")


def uri_delta(spark, d):
    return _update_parts(spark, d)[2]


def domain_delta(spark, d):
    p, _, delta = _update_parts(spark, d)
    return incremental.domain_deltas(index.uri_info(p), delta)


def _incremental(spark, d, name):
    tables = incremental.build(_captures(spark, d))
    return incremental.apply_updates(tables, table(spark, d, "page_updates"), ["ts", "update_id"])[name]


def incremental_uri_info(spark, d):
    return _incremental(spark, d, "uri_info")


def incremental_domain_count(spark, d):
    return _incremental(spark, d, "domain_count")


def incremental_pages(spark, d):
    return _incremental(spark, d, "pages").select("uri", "num_outbound", "server", "title")


def streamed_uri_info(spark, d):
    """The updates as a stream of files out of order, folded batch by batch into a store; equals the batch result."""
    return _store(spark, d, streamed=True).table("uri_info")


def streamed_domain_count(spark, d):
    return _store(spark, d, streamed=True).table("domain_count")


def streamed_pages(spark, d):
    return _store(spark, d, streamed=True).table("pages").drop("links")


def streamed_edges(spark, d):
    return _store(spark, d, streamed=True).table("edges")


def streamed_cells(spark, d):
    """The query table after all mutations that the stream exported."""
    return _store(spark, d, streamed=True).cells()


def stream_meters(spark, d):
    """Counters of each micro-batch, as the stream logged them."""
    _store(spark, d, streamed=True)
    name = hashlib.sha1(f"{spark.sparkContext.applicationId} {d}".encode()).hexdigest()
    return spark.read.json(f"{shared_dir(spark)}/index-{name}-streamed/meters").groupBy().agg(F.count("*").alias("batches"), F.sum("updates_in").cast("bigint").alias("updates_in"))


def update_meters(spark, d):
    return metrics.update_meters(incremental.build(_captures(spark, d)), table(spark, d, "page_updates"), ["ts", "update_id"])


def record_pages_exact(spark, d):
    return records.raw_pages(table(spark, d, "wat_records"), exact=True).select("record_no", F.size("raw_links").alias("n_links"))


def metric_buckets(spark, d):
    out = index.time_buckets(table(spark, d, "events"), "ts", "value", ["event_type"])
    return out.select("bucket", "event_type", F.round("total", 2).alias("total"), "n")


def metric_rates(spark, d):
    out = index.rates(table(spark, d, "events"), "ts", "value", ["event_type"])
    return out.select("bucket", "event_type", F.round("per_second", 4).alias("per_second"))


def cell_dump(spark, d):
    """In-link cells as a dump shows them: bytes that can't be printed are escaped."""
    return index_cells(spark, d).where("cf = 'inlinks'").select("row", "cq", urls.byte_escaped(F.col("value")).alias("value"))


def url_to_uri(spark, d):
    f = table(spark, d, "fetches").select("fetch_id", "url")
    return urls.keyed(f, "url").select("fetch_id", "uri")


def url_parse(spark, d):
    f = table(spark, d, "fetches").select("fetch_id", urls.split_url(F.col("url")).alias("u"))
    return urls.with_domains(f).where("u is not null").select("fetch_id", "domain", "u.host", "u.path", "u.port", "u.secure", "u.ip_host")


def url_roundtrip(spark, d):
    """Keys decoded to an address and encoded again."""
    again = urls.bound(urls.from_key(F.col("uri")), lambda u: urls.key_of(u, u["domain"]))
    return table(spark, d, "uri_info").select("uri").where("uri is not null").distinct().select("uri", again.alias("again"))


def url_of_key(spark, d):
    return table(spark, d, "page_snapshots").where("uri is not null").select("uri").distinct().select("uri", urls.address_of(urls.from_key(F.col("uri"))).alias("url"))


def url_reverse_host(spark, d):
    host = F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1)
    return table(spark, d, "page_snapshots").select(host.alias("host")).distinct().select("host", urls.reverse_host(F.col("host")).alias("turned"))


def url_domain(spark, d):
    f = table(spark, d, "page_snapshots").select("url", "uri").distinct().withColumn("u", urls.split_url(F.col("url")))
    return urls.with_domains(f).where("domain is not null").select("uri", F.when(F.col("u.ip_host"), F.col("domain")).otherwise(urls.reverse_host(F.col("domain"))).alias("rev_domain"))


def url_is_image(spark, d):
    return table(spark, d, "links").where("dst_uri is not null").select("dst_uri").distinct().select("dst_uri", urls.is_image(F.split("dst_uri", ">")[3]).alias("image"))


def record_pages(spark, d):
    return records.raw_pages(table(spark, d, "wat_records")).select("record_no", "url", "crawl_date", "server", "title", F.size("raw_links").alias("n_links"))


def parsed_pages(spark, d):
    return records.pages(table(spark, d, "wat_records")).drop("outbound_links")


def parsed_links(spark, d):
    """Links of the archive's pages in their order, with anchor texts."""
    return records.pages(table(spark, d, "wat_records")).select("record_no", F.posexplode("outbound_links").alias("link_no", "l")).select("record_no", "link_no", "l.url", "l.uri", "l.anchor_text")


def parsed_edges(spark, d):
    """Distinct cross-domain links of the archive's pages."""
    return index.edges(index.page_table(records.pages(table(spark, d, "wat_records"))))


QUERIES = {f.__name__: f for f in (
    pages, pages_with_linkless, edges, edges_cross_domain, uri_info, domain_count, top_pages, domain_rank_top25, domain_pages, domain_stats, paging_offset, paging_keyset, inlinks_of, outlinks_of, page_lookup, page_degrees,
    index_statistics, page_json, index_cells, index_cells_sorted, cell_changes, split_points, rev_encode, rev_encode_order, link_added, link_deleted, uri_delta, domain_delta, incremental_pages, incremental_uri_info, incremental_domain_count,
    streamed_uri_info, streamed_domain_count, streamed_pages, streamed_edges, streamed_cells, stream_meters,
    update_meters, record_pages_exact, metric_buckets, metric_rates, cell_dump, url_to_uri, url_parse, url_roundtrip, url_of_key, url_reverse_host, url_domain, url_is_image, record_pages, parsed_pages, parsed_links, parsed_edges,
)}

# --- SQL -----------------------------------------------------------------------------------------
_LINKS = "list_filter({x}, lambda l: l.uri IS NOT NULL)"


def _once(x: str) -> str:
    """Links of a page, the first per key, in key order."""
    ls = _LINKS.format(x=x)
    return f"list_sort(list_transform(list_filter({ls}, lambda l, i: list_position(list_transform({ls}, lambda k: k.uri), l.uri) = i), lambda l: {{'uri': l.uri, 'url': l.url, 'anchor_text': l.anchor_text}}))"


def _page_ctes(source: str, prefix: str = "") -> str:
    return f"""{prefix}cap AS (SELECT *, coalesce({_once("outbound_links")}, []) AS links FROM {source} WHERE uri IS NOT NULL),
{prefix}allp AS (SELECT uri, url, len(links)::BIGINT AS num_outbound, crawl_date, server, title, links FROM (SELECT *, row_number() OVER (PARTITION BY uri ORDER BY len(links) DESC, crawl_date DESC, title DESC NULLS LAST, server DESC NULLS LAST) AS rn FROM {prefix}cap) WHERE rn = 1)"""


_LAST = "src AS (SELECT * FROM page_snapshots WHERE snap_no = (SELECT max(snap_no) FROM page_snapshots))"


def _info(p: str = "p") -> str:
    return f"""SELECT uri, sum(l)::BIGINT AS links_to, sum(d)::BIGINT AS docs FROM (SELECT uri, 0 AS l, 1 AS d FROM {p} UNION ALL SELECT unnest(links).uri, 1, 0 FROM {p}) GROUP BY uri"""


_BASE = f"""WITH {_LAST}, {_page_ctes("src")},
p AS (SELECT * FROM allp WHERE num_outbound > 0),
e AS (SELECT uri AS src, l.uri AS dst, coalesce(l.anchor_text, '') AS anchor FROM (SELECT uri, unnest(links) AS l FROM p)),
info AS ({_info()}),
dom AS (SELECT split_part(uri, '>', 1) AS domain, count(*)::BIGINT AS pagecount FROM info GROUP BY 1),
ranked AS (SELECT uri, links_to, row_number() OVER (ORDER BY links_to DESC, uri) AS n FROM info)
"""
_BYTES = "list_concat([len(b)], b)"
_CODE = """(SELECT string_agg(CASE x WHEN 0 THEN 'fefe' WHEN 1 THEN 'fefd' ELSE lower(lpad(to_hex(255 - x), 2, '0')) END, '' ORDER BY i) || 'ff'
 FROM (SELECT unnest(xs) AS x, generate_subscripts(xs, 1) AS i FROM (SELECT list_concat([ceil(length(CASE WHEN {n} = 0 THEN '' ELSE to_hex({n}) END) / 2.0)::INT], list_transform(range(0, ceil(length(CASE WHEN {n} = 0 THEN '' ELSE to_hex({n}) END) / 2.0)::INT), lambda k: (({n} >> (8 * (ceil(length(to_hex({n})) / 2.0)::INT - 1 - k)::INT)) & 255)::INT)) AS xs)))"""
_CODED = "coded AS (SELECT links_to, " + _CODE.format(n="links_to") + " AS code FROM (SELECT DISTINCT links_to FROM {t} WHERE links_to IS NOT NULL))"
_BIG = "(SELECT domain FROM dom ORDER BY pagecount DESC, domain LIMIT 1)"
_FINAL = _BASE + """, lastu AS (SELECT uri, op, page FROM (SELECT *, row_number() OVER (PARTITION BY uri ORDER BY ts DESC, update_id DESC) AS rn FROM page_updates WHERE uri IS NOT NULL AND (op = 'D' OR (page IS NOT NULL AND (page.url IS NOT NULL OR len(page.outbound_links) > 0)))) WHERE rn = 1),
upd AS (SELECT uri, page.url AS url, page.crawl_date AS crawl_date, CASE WHEN op <> 'D' THEN coalesce(""" + _once("page.outbound_links") + """, []) ELSE [] END AS links, page.server AS server, page.title AS title FROM lastu),
touched AS (SELECT u.uri, coalesce(o.links, []) AS ol, u.links AS nl, o.uri IS NOT NULL AS was, len(u.links) > 0 AS now FROM upd u LEFT JOIN p o ON o.uri = u.uri WHERE o.uri IS NOT NULL OR len(u.links) > 0),
p2 AS (SELECT uri, url, crawl_date, links, len(links)::BIGINT AS num_outbound, server, title FROM upd WHERE len(links) > 0 UNION ALL SELECT uri, url, crawl_date, links, num_outbound, server, title FROM p WHERE uri NOT IN (SELECT uri FROM upd)),
info2 AS (""" + _info("p2") + """),
ou AS (SELECT DISTINCT uri AS src, unnest(ol).uri AS dst FROM touched), nu AS (SELECT DISTINCT uri AS src, unnest(nl).uri AS dst FROM touched),
added AS (SELECT * FROM nu EXCEPT SELECT * FROM ou), deleted AS (SELECT * FROM ou EXCEPT SELECT * FROM nu),
delta AS (SELECT uri, sum(l)::BIGINT AS links_to, sum(d)::BIGINT AS docs FROM (SELECT dst AS uri, 1 AS l, 0 AS d FROM added UNION ALL SELECT dst, -1, 0 FROM deleted UNION ALL SELECT uri, 0, now::INT - was::INT FROM touched) GROUP BY uri HAVING sum(l) <> 0 OR sum(d) <> 0)
"""
_E2 = """e2 AS (SELECT uri AS src, l.uri AS dst, coalesce(l.anchor_text, '') AS anchor FROM (SELECT uri, unnest(links) AS l FROM p2)),
dom2 AS (SELECT split_part(uri, '>', 1) AS domain, count(*)::BIGINT AS pagecount FROM info2 GROUP BY 1)"""


def _member(name: str, x: str, first: bool = False) -> str:
    comma = "" if first else ","
    return f"""coalesce('{comma}"{name}":' || to_json({x})::VARCHAR, '')"""


def _json_of(x: str) -> str:
    for c, code in (("<", "003c"), (">", "003e"), ("&", "0026"), ("=", "003d"), ("\'\'", "0027")):
        x = f"replace({x}, '{c}', '\\u{code}')"
    return x


_PAGE_JSON = _json_of(
    "'{' || " + _member("url", "url", True) + " || " + _member("uri", "uri") + " || " + _member("numOutbound", "num_outbound") + " || " + _member("crawlDate", "crawl_date") + " || " + _member("server", "server") + " || " + _member("title", "title")
    + """ || ',"outboundLinks":[' || array_to_string(list_transform(links, lambda l: '{' || """ + _member("url", "l.url", True) + " || " + _member("uri", "l.uri") + " || " + _member("anchorText", "coalesce(l.anchor_text, '')") + """ || '}'), ',') || ']}'"""
)


def _cells_sql(p: str = "p", e: str = "e", info: str = "info", dom: str = "dom", coded: str = "coded") -> str:
    return f"""SELECT 'p:' || uri AS row, 'page' AS cf, 'cur' AS cq, {_PAGE_JSON} AS value FROM {p} WHERE num_outbound > 0
UNION ALL SELECT 'p:' || dst, 'inlinks', src, anchor FROM {e}
UNION ALL SELECT 't:' || code || ':' || uri, '', '', i.links_to::VARCHAR FROM {info} i JOIN {coded} c ON c.links_to = i.links_to
UNION ALL SELECT 'd:' || split_part(uri, '>', 1) || ':' || code || ':' || uri, 'rank', '', i.links_to::VARCHAR FROM {info} i JOIN {coded} c ON c.links_to = i.links_to
UNION ALL SELECT 'p:' || uri, 'page', 'incount', links_to::VARCHAR FROM {info}
UNION ALL SELECT 'd:' || domain, 'domain', 'pagecount', pagecount::VARCHAR FROM {dom}"""


def _side(prefix: str, rank: int) -> str:
    """Tables of the newest delivery but `rank`."""
    x = prefix
    return f"""{x}src AS (SELECT * FROM page_snapshots WHERE snap_no = (SELECT DISTINCT snap_no FROM page_snapshots ORDER BY snap_no DESC LIMIT 1 OFFSET {rank})), {_page_ctes(x + "src", x)},
{x}p AS (SELECT * FROM {x}allp WHERE num_outbound > 0), {x}e AS (SELECT uri AS src, l.uri AS dst, coalesce(l.anchor_text, '') AS anchor FROM (SELECT uri, unnest(links) AS l FROM {x}p)),
{x}info AS ({_info(x + "p")}), {x}dom AS (SELECT split_part(uri, '>', 1) AS domain, count(*)::BIGINT AS pagecount FROM {x}info GROUP BY 1), {_CODED.replace("coded AS", x + "coded AS").replace("{t}", x + "info")},
{x}cells AS ({_cells_sql(x + "p", x + "e", x + "info", x + "dom", x + "coded")})"""


# host -> registrable domain, learned from the keys that the tables already hold
_HOSTS = """hosts AS (SELECT DISTINCT rev, sub, CASE WHEN sub = '' AND regexp_matches(rev, '^[0-9.]+$') THEN rev ELSE array_to_string(list_reverse(string_split(rev || sub, '.')), '.') END AS host FROM (
  SELECT split_part(uri, '>', 1) AS rev, split_part(uri, '>', 2) AS sub FROM (SELECT src_uri AS uri FROM links UNION SELECT dst_uri FROM links UNION SELECT uri FROM fetches UNION SELECT uri FROM page_snapshots UNION SELECT uri FROM uri_info UNION SELECT unnest(outbound_links).uri FROM page_snapshots) WHERE uri IS NOT NULL))"""


def _keyed_sql(name: str, source: str, raw: str, cols: str) -> str:
    """CTEs that give rows of `source` the canonical address and key of an address column; invalid ones fall away."""
    return rf"""{name}_a AS (SELECT {cols}, regexp_replace({raw}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS x FROM {source} WHERE NOT contains({raw}, '>')),
{name}_b AS (SELECT {cols}, x, lower(regexp_extract(x, '(?i)^https?://([^/?#]*)', 1)) AS authority, regexp_extract(x, '(?is)^https?://[^/?#]*(.*)$', 1) AS path0, lower(x[1:6]) = 'https:' AS secure FROM {name}_a WHERE regexp_matches(x, '(?i)^https?://') AND length(x) >= 8),
{name}_c AS (SELECT *, split_part(authority, ':', 1) AS h, CASE WHEN path0 = '' THEN '/' ELSE path0 END AS path, CASE WHEN contains(authority, ':') THEN try_cast(regexp_extract(authority, '^[^:]*:(.*)$', 1) AS INTEGER) WHEN secure THEN 443 ELSE 80 END AS port FROM {name}_b),
{name} AS (SELECT {cols}, CASE WHEN secure THEN 'https://' ELSE 'http://' END || h || CASE WHEN port = CASE WHEN secure THEN 443 ELSE 80 END THEN '' ELSE ':' || port END || path AS k_url,
  rev || '>' || sub || '>' || CASE WHEN secure THEN 's' ELSE 'o' END || CASE WHEN port = CASE WHEN secure THEN 443 ELSE 80 END THEN '' ELSE port::VARCHAR END || '>' || path AS k_uri, rev AS k_rev FROM {name}_c JOIN hosts ON host = h WHERE port IS NOT NULL)"""


_JSON = '$.Envelope."Payload-Metadata"."HTTP-Response-Metadata"'
_TEXT = "CASE WHEN json_type({x}, '{p}') = 'VARCHAR' THEN json_extract_string({x}, '{p}') END"

ORACLES = {
    "pages": _BASE + "SELECT uri, url, num_outbound, crawl_date, server, title FROM p",
    "pages_with_linkless": _BASE + "SELECT uri, url, num_outbound, crawl_date, server, title FROM allp",
    "edges": _BASE + "SELECT src, dst, anchor FROM e",
    "edges_cross_domain": _BASE + "SELECT src, dst, anchor FROM e WHERE split_part(src, '>', 1) <> split_part(dst, '>', 1)",
    "uri_info": _BASE + "SELECT uri, links_to, docs FROM info",
    "domain_count": _BASE + "SELECT domain, pagecount FROM dom",
    "top_pages": _BASE + "SELECT uri, links_to FROM ranked WHERE n <= 25",
    "domain_rank_top25": _BASE + "SELECT domain, uri, links_to, n::INTEGER AS rank_no FROM (SELECT split_part(uri, '>', 1) AS domain, uri, links_to, row_number() OVER (PARTITION BY split_part(uri, '>', 1) ORDER BY links_to DESC, uri) AS n FROM info) WHERE n <= 25",
    "domain_pages": _BASE + f"SELECT uri, links_to FROM info WHERE split_part(uri, '>', 1) = {_BIG} ORDER BY links_to DESC, uri LIMIT 26",
    "domain_stats": _BASE + "SELECT list_reverse(string_split(domain, '.')).array_to_string('.') AS domain, pagecount AS total FROM dom ORDER BY pagecount DESC, dom.domain LIMIT 1",
    "paging_offset": _BASE + "SELECT uri, links_to FROM ranked WHERE n BETWEEN 51 AND 76",
    "paging_keyset": _BASE + "SELECT uri, links_to FROM ranked WHERE n BETWEEN 76 AND 101",
    "inlinks_of": _BASE + "SELECT src AS uri, anchor FROM e WHERE dst = (SELECT uri FROM ranked WHERE n = 1) ORDER BY src LIMIT 26",
    "outlinks_of": _BASE + "SELECT dst AS uri, anchor FROM e WHERE src = (SELECT uri FROM p ORDER BY num_outbound DESC, uri LIMIT 1) ORDER BY dst LIMIT 26",
    "page_lookup": _BASE + "SELECT p.uri, url, coalesce(links_to, 0)::BIGINT AS num_inbound, num_outbound, crawl_date, server, title FROM p LEFT JOIN info ON info.uri = p.uri ORDER BY num_outbound DESC, p.uri LIMIT 1",
    "page_degrees": _BASE + "SELECT p.uri, num_outbound, links_to AS num_inbound FROM p JOIN info ON info.uri = p.uri",
    "index_statistics": _BASE + "SELECT count(*)::BIGINT AS pages, count(*) FILTER (num_outbound = 0)::BIGINT AS empty_pages, sum(num_outbound)::BIGINT AS links FROM allp",
    "page_json": _BASE + f"SELECT uri, {_PAGE_JSON} AS json FROM p",
    "index_cells": _BASE + ", " + _CODED.replace("{t}", "info") + " " + _cells_sql(),
    "index_cells_sorted": _BASE + ", " + _CODED.replace("{t}", "info") + " SELECT * FROM (" + _cells_sql() + ") ORDER BY row, cf, cq LIMIT 1000",
    "cell_changes": f"WITH {_side('old_', 1)}, {_side('new_', 0)} SELECT CASE WHEN n.row IS NULL THEN 'delete' ELSE 'put' END AS op, coalesce(n.row, o.row) AS row, coalesce(n.cf, o.cf) AS cf, coalesce(n.cq, o.cq) AS cq, n.value AS value FROM old_cells o FULL JOIN new_cells n ON n.row = o.row AND n.cf = o.cf AND n.cq = o.cq WHERE n.value IS DISTINCT FROM o.value",
    "rev_encode": "WITH " + _CODED.replace("{t}", "uri_info") + " SELECT links_to, code FROM coded",
    "rev_encode_order": "SELECT links_to, true AS descends FROM (SELECT DISTINCT links_to FROM uri_info WHERE links_to IS NOT NULL) WHERE links_to > (SELECT min(links_to) FROM uri_info)",
    "link_added": _FINAL + "SELECT src, dst FROM added",
    "link_deleted": _FINAL + "SELECT src, dst FROM deleted",
    "uri_delta": _FINAL + "SELECT uri, links_to, docs FROM delta",
    "domain_delta": _FINAL + "SELECT domain, sum(s)::BIGINT AS delta FROM (SELECT split_part(uri, '>', 1) AS domain, 1 AS s FROM info2 UNION ALL SELECT split_part(uri, '>', 1), -1 FROM info) GROUP BY domain HAVING sum(s) <> 0",
    "incremental_pages": _FINAL + "SELECT uri, num_outbound, server, title FROM p2",
    "incremental_uri_info": _FINAL + "SELECT uri, links_to, docs FROM info2",
    "incremental_domain_count": _FINAL + "SELECT split_part(uri, '>', 1) AS domain, count(*)::BIGINT AS pagecount FROM info2 GROUP BY 1",
    "streamed_uri_info": _FINAL + "SELECT uri, links_to, docs FROM info2",
    "streamed_domain_count": _FINAL + ", " + _E2 + " SELECT domain, pagecount FROM dom2",
    "streamed_pages": _FINAL + "SELECT uri, url, num_outbound, crawl_date, server, title FROM p2",
    "streamed_edges": _FINAL + ", " + _E2 + " SELECT src, dst, anchor FROM e2",
    "streamed_cells": _FINAL + ", " + _E2 + ", " + _CODED.replace("{t}", "info2") + " " + _cells_sql("p2", "e2", "info2", "dom2"),
    "stream_meters": "SELECT 4::BIGINT AS batches, count(*)::BIGINT AS updates_in FROM page_updates",
    "update_meters": _FINAL + """, dn AS (SELECT split_part(uri, '>', 1) AS domain, sum(a)::BIGINT AS was, sum(b)::BIGINT AS now FROM (SELECT uri, 1 AS a, 0 AS b FROM info UNION ALL SELECT uri, 0, 1 FROM info2) GROUP BY 1)
SELECT (SELECT count(*) FROM page_updates)::BIGINT AS updates_in, (SELECT count(*) FROM touched)::BIGINT AS pages_changed, (SELECT count(*) FROM added)::BIGINT AS links_new, (SELECT count(*) FROM deleted)::BIGINT AS links_deleted, (SELECT count(*) FROM delta)::BIGINT AS uris_changed,
(SELECT count(*) FROM dn WHERE was = 0)::BIGINT AS domains_new, (SELECT count(*) FROM dn WHERE now = 0)::BIGINT AS domains_gone, (SELECT count(*) FROM dn WHERE was <> now)::BIGINT AS domains_changed""",
    "metric_buckets": "SELECT time_bucket(INTERVAL 30 SECOND, ts) AS bucket, event_type, round(sum(value), 2) AS total, count(*)::BIGINT AS n FROM events GROUP BY 1, 2",
    "metric_rates": "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, event_type, round(sum(value) / 300, 4) AS per_second FROM events GROUP BY 1, 2",
    "cell_dump": _BASE + r"""SELECT 'p:' || dst AS row, src AS cq, coalesce(array_to_string(list_transform(regexp_extract_all(hex(encode(anchor)), '..'), lambda b: CASE WHEN ('0x' || b)::INTEGER BETWEEN 32 AND 126 AND b <> '5C' THEN chr(('0x' || b)::INTEGER) ELSE '\x' || lower(b) END), ''), '') AS value FROM e""",
    "url_to_uri": "SELECT fetch_id, uri FROM fetches",
    "url_parse": r"""WITH t AS (SELECT fetch_id, uri, regexp_replace(url, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS x FROM fetches WHERE uri IS NOT NULL),
a AS (SELECT fetch_id, split_part(uri, '>', 1) AS rev, lower(regexp_extract(x, '^[a-zA-Z]+://([^/?#]*)', 1)) AS authority, regexp_extract(x, '^[a-zA-Z]+://[^/?#]*(.*)$', 1) AS path, lower(x[1:6]) = 'https:' AS secure FROM t),
b AS (SELECT *, split_part(authority, ':', 1) AS host FROM a), c AS (SELECT *, regexp_matches(host, '^[0-9.]+$') AS ip_host FROM b)
SELECT fetch_id, CASE WHEN ip_host THEN host ELSE array_to_string(list_reverse(string_split(rev, '.')), '.') END AS domain, host, CASE WHEN path = '' THEN '/' ELSE path END AS path,
CASE WHEN contains(authority, ':') THEN split_part(authority, ':', 2)::INTEGER WHEN secure THEN 443 ELSE 80 END AS port, secure, ip_host FROM c""",
    "url_roundtrip": "SELECT DISTINCT uri, uri AS again FROM uri_info WHERE uri IS NOT NULL",
    "url_of_key": "SELECT DISTINCT uri, url FROM page_snapshots WHERE uri IS NOT NULL",
    "url_reverse_host": "SELECT host, array_to_string(list_reverse(string_split(host, '.')), '.') AS turned FROM (SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM page_snapshots)",
    "url_domain": "SELECT DISTINCT uri, split_part(uri, '>', 1) AS rev_domain FROM page_snapshots WHERE uri IS NOT NULL",
    "url_is_image": r"SELECT DISTINCT dst_uri, regexp_matches(lower(split_part(dst_uri, '>', 4)), '\.(jpeg|jpg|png|gif|bmp)$') AND NOT contains(split_part(dst_uri, '>', 4), ' ') AS image FROM links WHERE dst_uri IS NOT NULL",
    "record_pages": f"""WITH docs AS (SELECT record_no, target_uri, warc_date, content_type, body::JSON AS doc FROM wat_records WHERE json_valid(body) AND lower(content_type) = 'application/json'),
x AS (SELECT *, CASE WHEN content_type = 'application/json' AND json_type(doc, '{_JSON}."HTML-Metadata".Links') = 'ARRAY' THEN json_extract(doc, '{_JSON}."HTML-Metadata".Links[*]') ELSE [] END AS ls FROM docs)
SELECT record_no, target_uri AS url, warc_date AS crawl_date, {_TEXT.format(x="doc", p=_JSON + ".Headers.Server")} AS server, {_TEXT.format(x="doc", p=_JSON + '."HTML-Metadata".Head.Title')} AS title,
len(list_filter(ls, lambda l: json_type(l, '$.url') = 'VARCHAR' AND json_type(l, '$.path') = 'VARCHAR' AND json_extract_string(l, '$.path') = 'A@/href'))::INTEGER AS n_links FROM x""",
    "record_pages_exact": f"""WITH docs AS (SELECT record_no, content_type, body::JSON AS doc FROM wat_records WHERE json_valid(body) AND lower(content_type) = 'application/json'),
x AS (SELECT record_no, CASE WHEN content_type = 'application/json' AND json_type(doc, '{_JSON}."HTML-Metadata".Links') = 'ARRAY' THEN json_extract(doc, '{_JSON}."HTML-Metadata".Links[*]') ELSE [] END AS ls FROM docs),
y AS (SELECT record_no, ls, list_position(list_transform(ls, lambda l: json_type(l) <> 'OBJECT' OR coalesce(json_type(l, '$.path') = 'VARCHAR' AND json_extract_string(l, '$.path') = 'A@/href' AND json_type(l, '$.url') IS NOT NULL
  AND (json_type(l, '$.url') <> 'VARCHAR' OR coalesce(json_type(l, '$.text'), json_type(l, '$.title'), 'VARCHAR') <> 'VARCHAR'), false)), true) AS stop FROM x),
z AS (SELECT record_no, CASE WHEN stop IS NULL OR stop = 0 THEN ls ELSE ls[1:stop - 1] END AS ls FROM y)
SELECT record_no, len(list_filter(ls, lambda l: json_type(l, '$.url') = 'VARCHAR' AND json_type(l, '$.path') = 'VARCHAR' AND json_extract_string(l, '$.path') = 'A@/href'))::INTEGER AS n_links FROM z""",
}

_ANCHOR = "json_type(l, '$.url') = 'VARCHAR' AND json_type(l, '$.path') = 'VARCHAR' AND json_extract_string(l, '$.path') = 'A@/href'"
_PARSED = f"""WITH {_HOSTS}, docs AS (SELECT record_no, target_uri, warc_date, content_type, body::JSON AS doc FROM wat_records WHERE json_valid(body) AND lower(content_type) = 'application/json' AND target_uri IS NOT NULL),
{_keyed_sql("heads", "docs", "target_uri", "record_no, warc_date, content_type, doc, target_uri")},
each AS (SELECT record_no, k_rev AS own, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT *, CASE WHEN content_type = 'application/json' AND json_type(doc, '{_JSON}."HTML-Metadata".Links') = 'ARRAY' THEN json_extract(doc, '{_JSON}."HTML-Metadata".Links[*]') ELSE [] END AS ls FROM heads)),
found AS (SELECT record_no, own, i, json_extract_string(l, '$.url') AS raw, coalesce({_TEXT.format(x="l", p="$.text")}, {_TEXT.format(x="l", p="$.title")}, '') AS anchor_text FROM each WHERE {_ANCHOR}),
{_keyed_sql("keyed", "found", "raw", "record_no, own, i, anchor_text")},
ll AS (SELECT record_no, (row_number() OVER (PARTITION BY record_no ORDER BY i) - 1)::INTEGER AS link_no, k_url AS url, k_uri AS uri, anchor_text FROM keyed WHERE k_rev <> own),
lists AS (SELECT record_no, list({{'url': url, 'uri': uri, 'anchor_text': anchor_text}} ORDER BY link_no) AS outbound_links FROM ll GROUP BY 1),
pp AS (SELECT h.record_no, k_url AS url, k_uri AS uri, coalesce(len(outbound_links), 0)::BIGINT AS num_outbound, warc_date AS crawl_date, {_TEXT.format(x="doc", p=_JSON + ".Headers.Server")} AS server, {_TEXT.format(x="doc", p=_JSON + '."HTML-Metadata".Head.Title')} AS title, outbound_links FROM heads h LEFT JOIN lists ON lists.record_no = h.record_no)
"""
ORACLES |= {
    "parsed_pages": _PARSED + "SELECT record_no, url, uri, num_outbound, crawl_date, server, title FROM pp",
    "parsed_links": _PARSED + "SELECT * FROM ll",
    "parsed_edges": _PARSED + ", " + _page_ctes("pp") + " SELECT uri AS src, l.uri AS dst, coalesce(l.anchor_text, '') AS anchor FROM (SELECT uri, unnest(links) AS l FROM allp WHERE num_outbound > 0)",
}
