"""Page updates folded into the index; the result equals a rebuild from the final pages.

`apply_updates` is a plain function from tables and a batch of updates to new
tables. `IndexStore` does the same a batch at a time, in whatever order updates
arrive: every page keeps the order value of the update it came from, deleted pages
leave a tombstone with theirs, and an update older than what is stored is ignored.
Only links that changed become deltas, and only deltas are written: a batch adds a
version of each table, as large as its changes, and readers merge versions by key
within the buckets. When a table has `compact` versions, they are merged into one.
A batch that was already applied changes nothing.

Stored tables (clustered by): pages (uri), edges (dst), uri_info (uri),
domain_count (domain), and the cells of the query table, split into ranges of the row.

Empty updates (no delete, but neither an address nor links) are skipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import domain_of_key
from ..operators import index
from ..runtime import cut
from ..store import Store, among, sortable

TABLES = ("pages", "uri_info", "domain_count")
_PAGE_COLUMNS = ["uri", "url", "num_outbound", "crawl_date", "server", "title", "links"]
_NO_ORDER = "array<string>"


def build(pages: DataFrame, keep_linkless: bool = False) -> dict[str, DataFrame]:
    p = index.page_table(pages, keep_linkless)
    info = index.uri_info(p)
    return {"pages": p, "uri_info": info, "domain_count": index.domain_count(info)}


def ordered_by(df: DataFrame, order: list[str]) -> Column:
    """The order columns (times, whole numbers, texts) as one comparable value."""
    kinds = dict(df.dtypes)
    return F.array(*[sortable(F.col(c), kinds[c]) for c in order])


def last_updates(updates: DataFrame, order: list[str], keep_linkless: bool = False) -> DataFrame:
    """One row per page: its last update that is not empty, with the page in table form; null links for a delete. at: its order value."""
    some = F.col("page").isNotNull() & ~index.is_empty(F.col("page.url"), F.col("page.outbound_links"))
    rows = updates.where(F.col("uri").isNotNull() & ((F.col("op") == "D") | some))
    rows = rows.withColumn("at", ordered_by(updates, order))
    one = rows.groupBy("uri").agg(F.max_by(F.struct("op", "page", "at"), "at").alias("b")).select("uri", "b.op", "b.page", "b.at")
    links = F.when(F.col("op") != "D", F.coalesce(index.distinct_links(F.col("page.outbound_links")), F.array()))
    out = one.withColumn("links", links)
    gone = (F.col("op") == "D") if keep_linkless else (F.col("op") == "D") | (F.size("links") <= 0)
    return out.select("uri", gone.alias("gone"), "page.url", "page.crawl_date", "page.server", "page.title", F.when(~gone, F.col("links")).alias("links"), "at")


def touched_by(pages: DataFrame, last: DataFrame) -> DataFrame:
    """The pages that change, with their old links. Deletes of unknown pages fall away."""
    return last.join(pages.select("uri", F.col("links").alias("old_links")), "uri", "left").where("not (gone and old_links is null)")


def uri_deltas(touched: DataFrame) -> DataFrame:
    """(uri, links_to, docs): the sums that changed pages cause."""
    uris = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: x["uri"])
    old, new = uris(F.col("old_links")), uris(F.col("links"))
    doc = F.when(F.col("gone"), -1).when(F.col("old_links").isNull(), 1).otherwise(0)
    item = lambda n: lambda u: F.struct(u.alias("uri"), F.lit(n).cast("bigint").alias("links_to"), F.lit(0).cast("bigint").alias("docs"))
    own = F.array(F.struct(F.col("uri"), F.lit(0).cast("bigint").alias("links_to"), doc.cast("bigint").alias("docs")))
    each = touched.select(F.inline(F.concat(own, F.transform(F.array_except(new, old), item(1)), F.transform(F.array_except(old, new), item(-1)))))
    return each.groupBy("uri").agg(F.sum("links_to").alias("links_to"), F.sum("docs").alias("docs")).where("links_to <> 0 or docs <> 0")


def deltas(pages: DataFrame, last: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(touched, uri deltas)."""
    touched = touched_by(pages, last)
    return touched, uri_deltas(touched)


def link_changes(touched: DataFrame) -> DataFrame:
    """(src, dst, change_kind): links that appear or vanish with the updates; anchors are no part of a link."""
    uris = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: x["uri"])
    old, new = uris(F.col("old_links")), uris(F.col("links"))
    tag = lambda c, kind: F.transform(c, lambda u: F.struct(u.alias("dst"), F.lit(kind).alias("change_kind")))
    return touched.select(F.col("uri").alias("src"), F.inline(F.concat(tag(F.array_except(new, old), "added"), tag(F.array_except(old, new), "deleted"))))


def edge_changes(touched: DataFrame, strict: bool = False) -> DataFrame:
    """(dst, src, anchor, gone): in-links to put or to remove. A new anchor replaces the old one; strict: a link that stays keeps its first anchor."""
    plain = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: F.struct(x["uri"].alias("dst"), F.coalesce(x["anchor_text"], F.lit("")).alias("anchor")))
    old, new = plain(F.col("old_links")), plain(F.col("links"))
    kept = F.transform(new, lambda x: x["dst"])
    known = F.transform(old, lambda x: x["dst"])
    fresh = F.filter(new, lambda x: ~F.array_contains(known, x["dst"])) if strict else F.array_except(new, old)
    put = F.transform(fresh, lambda x: F.struct(x["dst"].alias("dst"), x["anchor"].alias("anchor"), F.lit(False).alias("gone")))
    gone = F.transform(F.array_except(known, kept), lambda u: F.struct(u.alias("dst"), F.lit("").alias("anchor"), F.lit(True).alias("gone")))
    return touched.select(F.col("uri").alias("src"), F.inline(F.concat(put, gone))).select("dst", "src", "anchor", "gone")


def domain_steps(both: DataFrame) -> DataFrame:
    """(domain, delta): +1 for each key that appears, -1 for each that vanishes. both: (uri, links_to, docs, dl, dd), the first two null for new keys."""
    was = F.col("links_to").isNotNull()
    now = (F.coalesce("links_to", F.lit(0)) + F.col("dl") != 0) | (F.coalesce("docs", F.lit(0)) + F.col("dd") != 0)
    step = now.cast("int") - was.cast("int")
    return both.groupBy(domain_of_key(F.col("uri")).alias("domain")).agg(F.sum(step).cast("bigint").alias("delta")).where("delta <> 0")


def domain_deltas(info: DataFrame, d: DataFrame) -> DataFrame:
    """(domain, delta) of uri deltas against the table they will change."""
    return domain_steps(d.withColumnsRenamed({"links_to": "dl", "docs": "dd"}).join(info, "uri", "left"))


def apply_updates(tables: dict[str, DataFrame], updates: DataFrame, order: list[str], keep_linkless: bool = False) -> dict[str, DataFrame]:
    """New tables after a batch of updates (uri, op, page, and the order columns)."""
    last = last_updates(updates, order, keep_linkless)
    touched, d = deltas(tables["pages"], last)
    fresh = last.where("not gone").select("uri", "url", F.size("links").cast("bigint").alias("num_outbound"), "crawl_date", "server", "title", "links")
    pages = tables["pages"].select(*_PAGE_COLUMNS).join(last.select("uri"), "uri", "left_anti").unionByName(fresh)
    info = tables["uri_info"].unionByName(d).groupBy("uri").agg(F.sum("links_to").alias("links_to"), F.sum("docs").alias("docs")).where("links_to <> 0 or docs <> 0")
    dd = domain_deltas(tables["uri_info"], d).withColumnRenamed("delta", "pagecount")
    domains = tables["domain_count"].unionByName(dd).groupBy("domain").agg(F.sum("pagecount").alias("pagecount")).where("pagecount <> 0")
    return {"pages": pages, "uri_info": info, "domain_count": domains}


class IndexStore:
    """The stored index.

    buckets and ranges follow the table's size (some hundred MB each); keep: states that stay readable; compact:
    versions of a table before they are merged; cells: whether the query table is written too; strict: in-links
    keep the anchor they came with until the link goes.
    """

    KEYS = {"pages": "uri", "edges": "dst", "uri_info": "uri", "domain_count": "domain"}

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2, buckets: int = 16, ranges: int = 16, compact: int = 8, cells: bool = True, strict: bool = False):
        self.spark, self.folder, self.compact, self.ranges, self.with_cells, self.strict = spark, folder, max(2, compact), ranges, cells, strict
        self.store = Store(spark, folder, buckets, keep)
        self.meters: dict[str, int] = {}

    def state(self) -> dict | None:
        return self.store.state()

    # --- reading
    def _raw(self, name: str) -> tuple[DataFrame, bool]:
        """(rows of all versions, whether there is one version only)."""
        versions = self.state()["tables"][name]
        return self.store.read(name, versions, self.KEYS[name]), len(versions) == 1

    def _pages_with_order(self) -> DataFrame:
        rows, single = self._raw("pages")
        if single:
            return rows.drop("version")
        cols = [c for c in rows.columns if c not in ("uri", "version")]
        return rows.groupBy("uri").agg(F.max_by(F.struct(*cols), "version").alias("b")).select("uri", "b.*")

    def table(self, name: str) -> DataFrame:
        """The current rows of a table, merged within its buckets."""
        if name == "pages":
            return self._pages_with_order().where("not gone").select(*_PAGE_COLUMNS)
        rows, single = self._raw(name)
        if name == "edges":
            one = rows if single else rows.groupBy("dst", "src").agg(F.max_by(F.struct("anchor", "gone"), "version").alias("b")).select("dst", "src", "b.anchor", "b.gone")
            return one.where("not gone").select("src", "dst", "anchor")
        sums = ["links_to", "docs"] if name == "uri_info" else ["pagecount"]
        one = rows if single else rows.groupBy(self.KEYS[name]).agg(*[F.sum(s).alias(s) for s in sums])
        return one.where(" or ".join(f"{s} <> 0" for s in sums)).select(self.KEYS[name], *sums)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def cells(self) -> DataFrame:
        """(row, cf, cq, value): the query table after all its mutations; of a cell the newest counts."""
        rows = self.mutations()
        newest = rows.groupBy("row", "cf", "cq").agg(F.max_by(F.struct("value", "op"), "version").alias("b"))
        return newest.where("b.op = 'put'").select("row", "cf", "cq", "b.value")

    def mutations(self) -> DataFrame:
        """(op, row, cf, cq, value, version): what was exported, the version being the sequence number."""
        return self.store.read_sorted("cells", self.state()["tables"]["cells"])

    # --- writing
    def bootstrap(self, pages: DataFrame, keep_linkless: bool = False, order: list[str] | None = None) -> None:
        """The first state, from captures of pages. order: columns that tell later updates from older ones; without, any update is later."""
        at = F.max(ordered_by(pages, order)).alias("at") if order else F.lit(None).cast(_NO_ORDER).alias("at")
        p = index.page_table(pages, keep_linkless)
        if order:
            p = p.join(pages.where("uri is not null").groupBy("uri").agg(at), "uri")
        else:
            p = p.withColumn("at", F.lit(None).cast(_NO_ORDER))
        self.store.write(p.select(*_PAGE_COLUMNS, "at", F.lit(False).alias("gone")), "pages", 0, "uri")
        stored = self.store.read("pages", [0], "uri").drop("version")
        self.store.write(index.edges(stored).select("dst", "src", "anchor", F.lit(False).alias("gone")), "edges", 0, "dst", skewed_by="src")
        self.store.write(index.uri_info(stored), "uri_info", 0, "uri")
        info = self.store.read("uri_info", [0], "uri").drop("version")
        self.store.write(index.domain_count(info), "domain_count", 0, "domain")
        tables = {name: [0] for name in self.KEYS}
        if self.with_cells:
            domains = self.store.read("domain_count", [0], "domain").drop("version")
            self._export(index.cells(stored, info, domains).withColumn("op", F.lit("put")), 0)
            tables["cells"] = [0]
        self.store.commit({"batch": 0, "tables": tables})

    def _export(self, mutations: DataFrame, version: int) -> None:
        self.store.write_sorted(mutations.select("op", "row", "cf", "cq", "value"), "cells", version, ["row", "cf", "cq"], self.ranges if version == 0 else 1)

    def apply(self, updates: DataFrame, batch: int, order: list[str], keep_linkless: bool = False) -> bool:
        """Applies a batch once; false if it was applied before. The figures of the batch are left in `meters`."""
        state = self.state()
        if state["batch"] >= batch:
            return False
        version = 2 * batch
        seen = Observation()
        last = cut(last_updates(updates.observe(seen, F.count("*").alias("updates_in")), order, keep_linkless))
        old = among(self._pages_with_order(), last, "uri").select("uri", F.when(~F.col("gone"), F.col("links")).alias("old_links"), F.when(~F.col("gone"), F.struct("url", "num_outbound", "crawl_date", "server", "title")).alias("old_page"), F.col("at").alias("old_at"))
        newer = cut(last.join(old, "uri", "left").where(F.col("old_at").isNull() | (F.col("at") > F.col("old_at"))))
        self.store.write(newer.select("uri", "url", F.size("links").cast("bigint").alias("num_outbound"), "crawl_date", "server", "title", "links", "at", "gone"), "pages", version, "uri")
        touched = newer.where("not (gone and old_links is null)")
        edges = edge_changes(touched, self.strict)
        self.store.write(edges, "edges", version, "dst", skewed_by="src")
        d = cut(uri_deltas(touched))
        self.store.write(d, "uri_info", version, "uri")
        both = cut(d.withColumnsRenamed({"links_to": "dl", "docs": "dd"}).join(among(self.table("uri_info"), d, "uri"), "uri", "left"))
        steps = cut(domain_steps(both))
        self.store.write(steps.withColumnRenamed("delta", "pagecount"), "domain_count", version, "domain")
        domains = cut(steps.join(among(self.table("domain_count"), steps, "domain"), "domain", "left").withColumn("was", F.coalesce("pagecount", F.lit(0))))
        if self.with_cells:
            self._export(index.mutations(touched, edges, both, domains), version)
        self._measure(seen, touched, edges, both, domains)
        tables = {name: [*versions, version] for name, versions in state["tables"].items()}
        nxt = {"batch": batch, "tables": tables}
        for name in tables:
            if len(tables[name]) > self.compact:
                self._merge(name, nxt, version + 1)
        self.store.commit(nxt)
        return True

    def _merge(self, name: str, state: dict, version: int) -> None:
        """All versions of a table as one; tombstones of pages stay, since an older update may still arrive."""
        versions = state["tables"][name]
        if name == "cells":
            newest = self.store.read_sorted(name, versions).groupBy("row", "cf", "cq").agg(F.max_by(F.struct("value", "op"), "version").alias("b"))
            self.store.write_sorted(newest.where("b.op = 'put'").select("b.op", "row", "cf", "cq", "b.value"), name, version, ["row", "cf", "cq"], self.ranges)
        else:
            key = self.KEYS[name]
            rows = self.store.read(name, versions, key)
            if name in ("pages", "edges"):
                by = ["uri"] if name == "pages" else ["dst", "src"]
                cols = [c for c in rows.columns if c not in (*by, "version")]
                one = rows.groupBy(*by).agg(F.max_by(F.struct(*cols), "version").alias("b")).select(*by, "b.*")
                one = one if name == "pages" else one.where("not gone").select("dst", "src", "anchor", "gone")
                self.store.write(one, name, version, key, skewed_by="src" if name == "edges" else None)
            else:
                sums = [c for c in rows.columns if c not in (key, "version")]
                self.store.write(rows.groupBy(key).agg(*[F.sum(s).alias(s) for s in sums]).where(" or ".join(f"{s} <> 0" for s in sums)), name, version, key)
        state["tables"][name] = [version]

    def _measure(self, seen: Observation, touched: DataFrame, edges: DataFrame, both: DataFrame, domains: DataFrame) -> None:
        """Counters of the batch, from its own small tables: pages, links and domains that came in, are new, changed, or were exported."""
        links = lambda c: F.coalesce(F.sum(F.greatest(F.size(c), F.lit(0))), F.lit(0))
        uris = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda x: x["uri"])
        less = lambda a, b: F.coalesce(F.sum(F.size(F.array_except(uris(a), uris(b)))), F.lit(0))
        p = touched.agg(F.count("*").alias("pages_changed"), F.count_if(~F.col("gone")).alias("pages_exported"), links("links").alias("links_in"), less("links", "old_links").alias("links_new"), less("old_links", "links").alias("links_deleted")).first()
        u = both.agg(F.count("*").alias("uris_changed")).first()
        e = edges.agg(F.count("*").alias("links_exported")).first()
        d = domains.agg(F.count_if(F.col("was") == 0).alias("domains_new"), F.count("*").alias("domains_changed"), F.count("*").alias("domains_exported"), F.count_if(F.col("was") + F.col("delta") == 0).alias("domains_gone")).first()
        self.meters = {**seen.get, **p.asDict(), **u.asDict(), **e.asDict(), **d.asDict()}


def run_stream(updates: DataFrame, store: IndexStore, checkpoint: str, order: list[str], keep_linkless: bool = False, report: Callable[[int, dict], None] | None = None):
    """Folds a stream of updates into the store, a micro-batch at a time, until all available input is read. report gets each batch's number and meters."""

    def fold(df: DataFrame, batch: int) -> None:
        if store.apply(df, batch + 1, order, keep_linkless) and report:
            report(batch + 1, store.meters)

    return updates.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
