"""Command line: python -m linkloom.jobs COMMAND ..."""

from __future__ import annotations

import argparse
import json
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import api
from .operators import index, records
from .plans.query import LinkIndex
from .runtime import cut, prepare
from .sources import archives, files
from .sources import pages as page_source
from .streaming.incremental import IndexStore


#: Later captures replace earlier ones, by time where the text is one.
ORDER = ["crawl_time", "crawl_date"]


def _pages(spark: SparkSession, args) -> DataFrame:
    if args.format == "archive":
        found = records.pages(archives.read(spark, files.require_data(spark, args.data), args.exact), exact=args.exact)
    else:
        found = page_source.read_pages(spark, args.data)
    return found.withColumn("crawl_time", F.col("crawl_date").try_cast("timestamp"))


def _store(spark: SparkSession, args) -> IndexStore:
    c = files.Config.load(args.config) if args.config else files.Config()
    return IndexStore(spark, args.store, buckets=c.buckets, ranges=c.tablets)


def _updates(pages: DataFrame) -> DataFrame:
    """Pages with links as updates; the loaders leave link-less ones out."""
    page = F.struct("url", "uri", "num_outbound", "crawl_date", "server", "title", "outbound_links")
    return pages.where(F.size("outbound_links") > 0).select("uri", F.lit("U").alias("op"), page.alias("page"), *ORDER)


def load(spark: SparkSession, store: IndexStore, pages: DataFrame, rate: int = 0, folder: str = "") -> int:
    """Applies pages to the store; with a rate (pages a second) in batches of at most a minute's worth, no faster than that. Returns the number of batches."""
    updates = _updates(pages)
    first = store.state()["batch"] + 1
    if not rate:
        store.apply(updates, first, ORDER)
        return 1
    rows = cut(updates)
    total = rows.count()
    parts = max(1, -(-total // (60 * rate)))
    for i in range(parts):
        began = time.monotonic()
        store.apply(rows.where(F.pmod(F.xxhash64("uri"), F.lit(parts)) == i), first + i, ORDER)
        if i + 1 < parts:
            time.sleep(max(0.0, total / parts / rate - (time.monotonic() - began)))
    return parts


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="linkloom")
    sub = p.add_subparsers(dest="command", required=True)
    aliases = {"load": ["load-hdfs", "load-s3"], "parse": ["test-parser"], "serve": ["ui"]}
    for name in ("init", "load", "parse", "sample", "splits", "dev"):
        c = sub.add_parser(name, aliases=aliases.get(name, []))
        c.add_argument("data")
        c.add_argument("--format", choices=("archive", "jsonl"), default="archive")
        c.add_argument("--store", default="")
        c.add_argument("--out", default="")
        c.add_argument("-n", type=int, default=1000)
        c.add_argument("--config", default="")
        c.add_argument("--rate", type=int, default=-1, help="pages a second; 0: no limit; default: the configuration's")
        c.add_argument("--port", type=int, default=8080)
        c.add_argument("--exact", action="store_true", help="honour Content-Length, and end a page's links at an ill-typed one")
    c = sub.add_parser("getpaths")
    c.add_argument("file")
    c.add_argument("range")
    c = sub.add_parser("copy")
    c.add_argument("file")
    c.add_argument("range")
    c.add_argument("source")
    c.add_argument("target")
    c = sub.add_parser("query")
    c.add_argument("store")
    c.add_argument("question", choices=("top", "pages", "page", "in", "out"))
    c.add_argument("subject", nargs="?", default="")
    c.add_argument("--page", type=int, default=0)
    c = sub.add_parser("serve", aliases=aliases["serve"])
    c.add_argument("store")
    c.add_argument("--port", type=int, default=8080)
    args = p.parse_args(argv)
    args.command = next((name for name, more in aliases.items() if args.command in more), args.command)
    if args.command == "getpaths":
        with open(args.file) as f:
            print("\n".join(files.paths_range(f.read().split(), args.range)))
        return 0
    spark = prepare(SparkSession.builder.appName("linkloom").getOrCreate())
    if args.command == "copy":
        with open(args.file) as f:
            wanted = [files.add_slash(args.source) + x for x in files.paths_range(f.read().split(), args.range)]
        bad = files.copy_files(spark, wanted, args.target).where("done <> 'copied'").collect()
        for r in bad:
            print(r.path, r.done, file=sys.stderr)
        return int(bool(bad))
    if args.command == "dev":  # pages of a JSON-lines sample, indexed into a new folder and served
        args.format, args.store, args.command = "jsonl", args.store or tempfile.mkdtemp(prefix="linkloom-dev-"), "serve"
        IndexStore(spark, args.store, buckets=2, ranges=2).bootstrap(_pages(spark, args), order=ORDER)
    if args.command == "init":
        _store(spark, args).bootstrap(_pages(spark, args), order=ORDER)
    elif args.command == "load":
        limit = args.rate if args.rate >= 0 else files.Config.load(args.config).load_rate_limit if args.config else 0
        load(spark, _store(spark, args), _pages(spark, args), limit)
    elif args.command == "parse":
        _pages(spark, args).write.format("noop").mode("overwrite").save()
    elif args.command == "sample":
        page_source.write_sample(_pages(spark, args), args.out, args.n)
    elif args.command == "splits":
        for r in index.split_points(IndexStore(spark, args.store).cells()).collect():
            print(r.split)
    elif args.command in ("query", "serve"):
        store = IndexStore(spark, args.store)
        ix = LinkIndex(*(store.table(t) for t in ("pages", "edges", "uri_info", "domain_count")))
        if args.command == "serve":
            api.server(ix, args.port).serve_forever()
            return 0
        found = {"top": lambda: ix.top(args.page).rows, "pages": lambda: ix.pages_of(args.subject, args.page).rows, "page": lambda: ix.page(args.subject).collect(), "in": lambda: ix.links_in(args.subject, page_no=args.page).collect(), "out": lambda: ix.links_out(args.subject, args.page).collect()}[args.question]()
        print("\n".join(json.dumps(r.asDict(recursive=True)) for r in found))
    return 0


if __name__ == "__main__":
    sys.exit(main())
