"""Queries of the general problems 1, 4 and 6, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import snapshots, treeagg, variants
from ..runtime import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.children(table(spark, d, "wat_records")).select("record_no", "list_name", "list_pos")


def p1_variants(spark: SparkSession, d: str) -> DataFrame:
    return variants.children(table(spark, d, "wat_records")).groupBy("list_name", "variant", "shape").count().withColumnRenamed("count", "n_objects")


def p1_routes(spark: SparkSession, d: str) -> DataFrame:
    """How many elements of each list each subtype accepts."""
    return variants.children(table(spark, d, "wat_records")).groupBy("list_name", "variant").agg(F.count("*").alias("n_objects"))


def p1_residuals(spark: SparkSession, d: str) -> DataFrame:
    """What the typed tables can't hold, by its kind."""
    return variants.residuals(table(spark, d, "wat_records")).select("record_no", "list_name", "list_pos", "field", F.substring_index("kind", "<", 1).alias("kind"))


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    return variants.record_heads(table(spark, d, "wat_records"))


def _subtype(name: str):
    return lambda spark, d: variants.subtype(table(spark, d, "wat_records"), name)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.page_changes(table(spark, d, "page_snapshots"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    counts = treeagg.tree_counts(table(spark, d, "links"), ["dst_domain", "src_domain"])
    return treeagg.heavy_keys(counts, 0.02).select("field_name", "key_value")


def p6_degrees(spark: SparkSession, d: str) -> DataFrame:
    return treeagg.tree_degrees(table(spark, d, "links"), {"dst_domain": "src_domain", "src_domain": "dst_domain", "dst_uri": "src_uri"})


QUERIES = {
    "p1_found": p1_found,
    "p1_variants": p1_variants,
    "p1_routes": p1_routes,
    "p1_residuals": p1_residuals,
    "p1_records": p1_records,
    "p1_links": _subtype("Links"),
    "p1_metas": _subtype("Metas"),
    "p1_scripts": _subtype("Scripts"),
    "p1_head_links": _subtype("Link"),
    "p1_metadata_records": _subtype("Metadata-Records"),
    "p4_found": p4_found,
    "p6_found": p6_found,
    "p6_degrees": p6_degrees,
}

_H = '$.Envelope."Payload-Metadata"."HTTP-Response-Metadata"."HTML-Metadata"'
_PATHS = {
    "Links": f"{_H}.Links",
    "Metas": f"{_H}.Head.Metas",
    "Scripts": f"{_H}.Head.Scripts",
    "Link": f"{_H}.Head.Link",
    "Metadata-Records": '$.Envelope."Payload-Metadata"."WARC-Metadata-Metadata"."Metadata-Records"',
}


def _lists_sql(names) -> str:
    docs = "docs AS (SELECT record_no, CASE WHEN json_valid(body) THEN body::JSON END AS doc FROM wat_records)"
    lists = " UNION ALL ".join(f"SELECT record_no, '{n}' AS list_name, json_extract(doc, '{_PATHS[n]}') AS x FROM docs WHERE doc IS NOT NULL" for n in names)
    return f"""WITH {docs}, lists AS ({lists}),
items AS (SELECT record_no, list_name, CASE json_type(x) WHEN 'ARRAY' THEN json_extract(x, '$[*]') WHEN 'OBJECT' THEN [x] END AS xs FROM lists),
rows AS (SELECT record_no, list_name, unnest(xs) AS item, generate_subscripts(xs, 1) - 1 AS pos FROM items WHERE xs IS NOT NULL)
"""


def _typed_sql(name: str, columns: dict[str, str], rules: list[tuple[str, list[str]]]) -> str:
    text = lambda f: f"""CASE WHEN json_type(item, '$."{f}"') = 'VARCHAR' THEN json_extract_string(item, '$."{f}"') END"""
    cols = ", ".join(f"{text(f)} AS {c}" for c, f in columns.items())
    case = " ".join("WHEN " + " AND ".join(f"""json_type(item, '$."{f}"') = 'VARCHAR'""" for f in fs) + f" THEN '{v}'" for v, fs in rules)
    return _lists_sql([name]) + f"SELECT record_no, pos::INTEGER AS list_pos, CASE {case} ELSE 'open' END AS variant, {cols} FROM rows WHERE json_type(item) = 'OBJECT'"


def _sql_of(name: str) -> str:
    return _typed_sql(name, variants.FIELDS[name], [(r.variant, list(r.children)) for r in variants.RULES[name]])


def _routes_sql() -> str:
    case = "".join(f" WHEN list_name = '{n}'" + "".join(f""" AND json_type(item, '$."{f}"') = 'VARCHAR'""" for f in r.children) + f" THEN '{r.variant}'" for n, rules in variants.RULES.items() for r in rules)
    return _lists_sql(_PATHS) + f"SELECT list_name, variant, count(*)::BIGINT AS n_objects FROM (SELECT list_name, CASE{case} ELSE 'open' END AS variant FROM rows WHERE json_type(item) = 'OBJECT') GROUP BY 1, 2"


def _residuals_sql() -> str:
    kind = "CASE json_type({x}) WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID' WHEN 'BOOLEAN' THEN 'BOOLEAN' WHEN 'ARRAY' THEN 'ARRAY' WHEN 'OBJECT' THEN 'OBJECT' ELSE 'NUMBER' END"
    typed = " OR ".join(f"(list_name = '{n}' AND field IN ({', '.join(repr(f) for f in cols.values())}))" for n, cols in variants.FIELDS.items())
    return _lists_sql(_PATHS) + f""", each AS (SELECT record_no, list_name, pos, field, json_extract(item, '$."' || field || '"') AS v FROM (SELECT *, unnest(json_keys(item)) AS field FROM rows WHERE json_type(item) = 'OBJECT'))
SELECT record_no, list_name, pos::INTEGER AS list_pos, NULL::VARCHAR AS field, {kind.format(x="item")} AS kind FROM rows WHERE json_type(item) <> 'OBJECT'
UNION ALL SELECT record_no, list_name, pos::INTEGER, field, {kind.format(x="v")} FROM each WHERE NOT (({typed}) AND json_type(v) = 'VARCHAR')"""


def _string(path: str) -> str:
    return f"CASE WHEN json_type(doc, '{path}') = 'VARCHAR' THEN json_extract_string(doc, '{path}') END"


_E = "$.Envelope"
_HEADS = {
    "format": f"{_E}.Format",
    "block_digest": f'{_E}."Block-Digest"',
    "record_type": f'{_E}."WARC-Header-Metadata"."WARC-Type"',
    "record_date": f'{_E}."WARC-Header-Metadata"."WARC-Date"',
    "actual_content_type": f'{_E}."Payload-Metadata"."Actual-Content-Type"',
    "status": f'{_E}."Payload-Metadata"."HTTP-Response-Metadata"."Response-Message".Status',
    "server": f'{_E}."Payload-Metadata"."HTTP-Response-Metadata".Headers.Server',
    "title": f"{_H}.Head.Title",
}

ORACLES = {
    "p1_found": _lists_sql(_PATHS) + "SELECT record_no, list_name, pos::INTEGER AS list_pos FROM rows WHERE json_type(item) = 'OBJECT'",
    "p1_routes": _routes_sql(),
    "p1_residuals": _residuals_sql(),
    "p1_links": _sql_of("Links"),
    "p1_metas": _sql_of("Metas"),
    "p1_scripts": _sql_of("Scripts"),
    "p1_head_links": _sql_of("Link"),
    "p1_metadata_records": _sql_of("Metadata-Records"),
    "p1_records": "WITH docs AS (SELECT record_no, body::JSON AS doc FROM wat_records WHERE json_valid(body)) SELECT record_no, " + ", ".join(f"{_string(p)} AS {c}" for c, p in _HEADS.items()) + " FROM docs",
    "p4_found": """WITH v AS (
  SELECT snap_no, uri, title, server, list_sort(list_distinct(list_transform(outbound_links, lambda l: l.uri))) AS links,
         row_number() OVER (PARTITION BY snap_no, uri ORDER BY crawl_date DESC) AS rn
  FROM page_snapshots WHERE uri IS NOT NULL),
cur AS (SELECT snap_no, uri, title, server, links FROM v WHERE rn = 1),
snaps AS (SELECT snap_no, lag(snap_no) OVER (ORDER BY snap_no) AS prev FROM (SELECT DISTINCT snap_no FROM page_snapshots)),
old AS (SELECT s.snap_no, c.uri, c.title, c.server, c.links FROM snaps s JOIN cur c ON c.snap_no = s.prev),
new AS (SELECT c.* FROM snaps s JOIN cur c ON c.snap_no = s.snap_no WHERE s.prev IS NOT NULL),
both_ AS (SELECT coalesce(o.snap_no, n.snap_no) AS snap_no, coalesce(o.uri, n.uri) AS uri,
                CASE WHEN o.uri IS NULL THEN 'added' WHEN n.uri IS NULL THEN 'removed' ELSE 'changed' END AS kind,
                coalesce(o.links, []) AS ol, coalesce(n.links, []) AS nl
         FROM old o FULL JOIN new n ON o.snap_no = n.snap_no AND o.uri = n.uri
         WHERE o.uri IS NULL OR n.uri IS NULL OR o.title IS DISTINCT FROM n.title OR o.server IS DISTINCT FROM n.server OR coalesce(o.links, []) <> coalesce(n.links, [])),
items AS (SELECT snap_no, uri, unnest(list_filter(nl, lambda x: NOT list_contains(ol, x))) AS link, 'added' AS kind FROM both_
          UNION ALL SELECT snap_no, uri, unnest(list_filter(ol, lambda x: NOT list_contains(nl, x))), 'removed' FROM both_)
SELECT snap_no, uri AS page_uri, '' AS link_uri, kind AS change_kind FROM both_
UNION ALL SELECT snap_no, uri, link, kind FROM items""",
    "p6_found": " UNION ALL ".join(f"SELECT '{c}' AS field_name, {c} AS key_value FROM links WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) >= 0.02 * (SELECT count({c}) FROM links)" for c in ("dst_domain", "src_domain")),
    "p6_degrees": " UNION ALL ".join(f"SELECT '{c}' AS field_name, {c} AS key_value, count(*)::BIGINT AS n_rows, count(DISTINCT {p})::BIGINT AS n_partners FROM links WHERE {c} IS NOT NULL GROUP BY {c}" for c, p in (("dst_domain", "src_domain"), ("src_domain", "dst_domain"), ("dst_uri", "src_uri"))),
}
