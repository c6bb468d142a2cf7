"""The index as JSON over HTTP: /api/top, /api/page, /api/pages, /api/links."""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import urls
from .plans.query import PAGE_SIZE, LinkIndex


def _cursor(text: str) -> tuple[int, str] | None:
    n, sep, uri = text.partition(":")
    return (int(n), uri) if sep and n.isdigit() else None


def key_of_address(spark: SparkSession, url: str) -> str | None:
    """Index key of an address, None if it is no valid page address. Constants only: the optimizer folds it on the driver, no task runs."""
    return urls.keyed(spark.sql("SELECT :url AS url", args={"url": url}), "url").first()["uri"]


def _addressed(rows) -> list[dict]:
    return [{"key": r["uri"], "value": r["links_to"]} for r in rows]


def answer(ix: LinkIndex, path: str, params: dict[str, str]) -> tuple[int, dict]:
    """(status, document) of a request; 400 names the missing parameter."""
    spark = ix.pages.sparkSession
    page_no = int(params.get("pageNum") or 0)
    need = {"/api/page": ("url",), "/api/pages": ("domain",), "/api/links": ("url", "linkType")}
    if path != "/api/top" and path not in need:
        return 404, {"error": f"no such resource: {path}"}
    for name in need.get(path, ()):
        if not params.get(name):
            return 400, {"error": f"parameter {name} is missing"}
    if path == "/api/top":
        p = ix.top(page_no, _cursor(params.get("next", "")))
        return 200, {"pageNum": page_no, "next": p.next, "results": _addressed(p.rows)}
    if path == "/api/pages":
        p = ix.pages_of(params["domain"], page_no, _cursor(params.get("next", "")))
        return 200, {"domain": params["domain"], "pageNum": page_no, "next": p.next, "total": p.total, "pages": _addressed(p.rows)}
    key = key_of_address(spark, params["url"])
    if key is None:
        return 400, {"error": "not a page address"}
    if path == "/api/page":
        return 200, ix.page(key).first().asDict()
    incoming = params["linkType"] == "in"
    rows = (ix.links_in(key, params.get("next", ""), page_no) if incoming else ix.links_out(key, page_no)).collect()
    total = ix.page(key).select(F.col("num_inbound" if incoming else "num_outbound").alias("n")).first()["n"]
    return 200, {"url": params["url"], "linkType": params["linkType"], "pageNum": page_no, "total": total, "next": rows[PAGE_SIZE]["uri"] if len(rows) > PAGE_SIZE else "", "links": [r.asDict() for r in rows[:PAGE_SIZE]]}


def server(ix: LinkIndex, port: int = 0) -> ThreadingHTTPServer:
    """A server on localhost; call serve_forever() on it."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            parts = urlsplit(self.path)
            status, doc = answer(ix, parts.path, {k: v[0] for k, v in parse_qs(parts.query).items()})
            body = json.dumps(doc).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
