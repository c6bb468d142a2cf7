import random

import pytest
from pyspark.sql import functions as F

from linkloom import schema
from linkloom.operators import index
from linkloom.plans.query import LinkIndex, page_of
from linkloom.streaming import incremental


def link(uri, anchor=""):
    d, sub, _, path = uri.split(">")
    return (f"http://{'.'.join(reversed(d.split('.')))}{path}", uri, anchor)


def page(uri, links, date="2025-01-01T00:00:00Z", title=None, server=None):
    return (link(uri)[0], uri, len(links), date, server, title, [link(u, a) for u, a in links])


A1, B, B1, B2, B3, C1 = "com.a>>o>/1", "com.b>>o>/", "com.b>>o>/1", "com.b>>o>/2", "com.b>>o>/3", "com.c>>o>/1"
SET1 = [page(A1, [(B1, "b1"), (B3, "b3"), (C1, "c1")]), page(B, [(C1, "c1"), (B2, "b2"), (B3, "b3")])]


@pytest.fixture(scope="module")
def set1(spark):
    return incremental.build(spark.createDataFrame(SET1, schema.PAGE))


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_uri_info(set1):
    assert rows(set1["uri_info"], "uri", "links_to", "docs") == [(A1, 0, 1), (B, 0, 1), (B1, 1, 0), (B2, 1, 0), (B3, 2, 0), (C1, 2, 0)]


def test_domain_count(set1):
    assert rows(set1["domain_count"], "domain", "pagecount") == [("com.a", 1), ("com.b", 4), ("com.c", 1)]


def test_cells(set1):
    got = index.cells(set1["pages"], set1["uri_info"], set1["domain_count"]).orderBy("row", "cf", "cq").collect()
    assert len(got) == 29
    kinds = {k: sum(1 for r in got if r.row.startswith(k)) for k in ("d:", "p:", "t:")}
    assert kinds == {"d:": 9, "p:": 14, "t:": 6}
    assert [r.row for r in got if r.row.startswith("t:")] == [f"t:fefdfdff:{B3}", f"t:fefdfdff:{C1}", f"t:fefdfefdff:{B1}", f"t:fefdfefdff:{B2}", f"t:fefeff:{A1}", f"t:fefeff:{B}"]
    cur = next(r.value for r in got if r.cq == "cur" and r.row == f"p:{A1}")
    assert cur.startswith('{"url":"http://a.com/1","uri":"com.a\\u003e\\u003eo\\u003e/1","numOutbound":3,') and ">" not in cur


def test_first_anchor_wins_and_linkless(spark):
    p = spark.createDataFrame([page(A1, [(B1, "x"), (B1, "y")]), page(B, []), page(A1, [(B1, "old")], date="2024")], schema.PAGE)
    assert rows(index.edges(index.page_table(p)), "src", "dst", "anchor") == [(A1, B1, "x")]
    assert rows(index.page_table(p, keep_linkless=True), "uri", "num_outbound") == [(A1, 1), (B, 0)]


def test_null_and_empty(spark):
    p = spark.createDataFrame([("u", None, 1, None, None, None, None), ("u", A1, None, None, None, None, [("x", None, None), ("y", B1, None)])], schema.PAGE)
    t = incremental.build(p)
    assert rows(t["uri_info"], "uri", "links_to") == [(A1, 0), (B1, 1)]
    none = incremental.build(spark.createDataFrame([], schema.PAGE))
    assert none["uri_info"].count() == none["domain_count"].count() == 0


def test_paging(spark):
    info = spark.createDataFrame([(f"com.a>>o>/{i:03d}", i // 7) for i in range(90)], "uri string, links_to long")
    want = sorted(info.collect(), key=lambda r: (-r.links_to, r.uri))
    first = page_of(info).collect()
    assert first == want[:26]
    assert page_of(info, cursor=(first[25].links_to, first[25].uri)).collect() == want[25:51]
    assert page_of(info, page_no=2).collect() == want[50:76]
    assert page_of(info, page_no=9).collect() == []


def test_queries(set1, spark):
    ix = LinkIndex(set1["pages"], index.edges(set1["pages"]), set1["uri_info"], set1["domain_count"])
    assert ix.domain_stats("B.com").first()["total"] == 4 and ix.domain_stats("zz.com").first()["total"] == 0
    assert [r.uri for r in ix.pages_of("b.com").rows] == [B3, B1, B2, B]
    assert [r.uri for r in ix.links_in(C1).collect()] == [A1, B]
    assert [(r.uri, r.anchor) for r in ix.links_out(A1).collect()] == [(B1, "b1"), (B3, "b3"), (C1, "c1")]
    assert ix.page(B3).first().num_inbound == 2 and ix.page("x>>o>/").first().num_inbound == 0
    assert ix.top().rows[0].uri == B3 and ix.top().next == ""


def test_cell_changes(set1, spark):
    old = index.cells(set1["pages"], set1["uri_info"], set1["domain_count"])
    t = incremental.build(spark.createDataFrame(SET1[:1], schema.PAGE))
    new = index.cells(t["pages"], t["uri_info"], t["domain_count"])
    ops = index.cell_changes(old, new)
    key = ["row", "cf", "cq"]
    put = ops.where("op = 'put'").select(*key, "value")
    again = old.join(ops.select(*key), key, "left_anti").unionByName(put)
    assert rows(again, *key, "value") == rows(new, *key, "value")
    assert index.cell_changes(new, new).count() == 0


UPDATE = "update_id long, " + schema.UPDATE


def update(i, uri, links, op="U"):
    return (i, uri, op, None, None if op == "D" else page(uri, [(u, f"t{i}") for u in links]))


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_equals_batch(spark, seed):
    """Random updates over few pages: any split into batches equals a rebuild."""
    rnd = random.Random(seed)
    names = [f"com.d{i % 3}>>o>/{i}" for i in range(7)]
    state = {n: rnd.sample(names, 3) for n in names[:4]}
    tables = incremental.build(spark.createDataFrame([page(n, [(u, "") for u in ls]) for n, ls in state.items()], schema.PAGE))
    tables = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in tables.items()}
    i = 0
    for _ in range(2):
        batch = []
        for _ in range(5):
            i += 1
            n = rnd.choice(names)
            if rnd.random() < 0.3:
                batch.append(update(i, n, [], "D"))
                state.pop(n, None)
            else:
                ls = rnd.sample(names, rnd.randint(0, 4))
                batch.append(update(i, n, ls))
                state[n] = ls
        tables = incremental.apply_updates(tables, spark.createDataFrame(batch, UPDATE), ["update_id"])
        tables = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in tables.items()}
        want = incremental.build(spark.createDataFrame([page(n, [(u, "") for u in ls]) for n, ls in state.items()], schema.PAGE))
        assert rows(tables["uri_info"], "uri", "links_to", "docs") == rows(want["uri_info"], "uri", "links_to", "docs")
        assert rows(tables["domain_count"], "domain", "pagecount") == rows(want["domain_count"], "domain", "pagecount")
        assert rows(tables["pages"], "uri", "num_outbound") == rows(want["pages"], "uri", "num_outbound")


def test_delete_of_unknown_page_and_replay(spark, tmp_path):
    store = incremental.IndexStore(spark, str(tmp_path / "s"), buckets=2, ranges=2)
    store.bootstrap(spark.createDataFrame(SET1, schema.PAGE))
    batch = spark.createDataFrame([update(1, "com.z>>o>/", [], "D"), update(2, A1, [C1])], UPDATE)
    assert store.apply(batch, 1, ["update_id"])
    before = rows(store.tables()["uri_info"], "uri", "links_to", "docs")
    assert not store.apply(batch, 1, ["update_id"])
    assert before == rows(store.tables()["uri_info"], "uri", "links_to", "docs")
    assert (B3, 1, 0) in before and all(r[0] != "com.z>>o>/" for r in before)


def test_stream(spark, tmp_path):
    store = incremental.IndexStore(spark, str(tmp_path / "s"), buckets=2, ranges=2)
    store.bootstrap(spark.createDataFrame(SET1, schema.PAGE))
    for i, u in enumerate([update(1, A1, [C1]), update(2, B, [], "D")]):
        spark.createDataFrame([u], UPDATE).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    feed = spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    incremental.run_stream(feed, store, str(tmp_path / "ck"), ["update_id"]).awaitTermination()
    assert rows(store.tables()["uri_info"], "uri", "links_to", "docs") == [(A1, 0, 1), (C1, 1, 0)]


@pytest.mark.parametrize("seed", [1])
def test_late_updates_over_batches(spark, tmp_path, seed):
    """Updates that arrive in any order, over micro-batches with merges in between, equal all of them at once; so do the exported cells."""
    rnd = random.Random(seed)
    names = [f"com.d{i % 3}>>o>/{i}" for i in range(6)]
    first = spark.createDataFrame([page(n, [(u, "old") for u in rnd.sample(names, 3)]) for n in names[:4]], schema.PAGE)
    ups = [update(i, rnd.choice(names), rnd.sample(names, rnd.randint(0, 3)), "D" if rnd.random() < 0.3 else "U") for i in range(1, 13)]
    want = incremental.apply_updates(incremental.build(first), spark.createDataFrame(ups, UPDATE), ["update_id"])
    rnd.shuffle(ups)
    store = incremental.IndexStore(spark, str(tmp_path / "s"), buckets=2, ranges=2, compact=2)
    store.bootstrap(first)
    for b in range(4):
        assert store.apply(spark.createDataFrame(ups[3 * b : 3 * b + 3], UPDATE), b + 1, ["update_id"])
        assert store.meters["updates_in"] == 3
    got = store.tables()
    assert rows(got["uri_info"], "uri", "links_to", "docs") == rows(want["uri_info"], "uri", "links_to", "docs")
    assert rows(got["domain_count"], "domain", "pagecount") == rows(want["domain_count"], "domain", "pagecount")
    assert rows(got["pages"], "uri", "num_outbound") == rows(want["pages"], "uri", "num_outbound")
    assert rows(store.table("edges"), "src", "dst", "anchor") == rows(index.edges(want["pages"]), "src", "dst", "anchor")
    cells = ("row", "cf", "cq", "value")
    assert rows(store.cells(), *cells) == rows(index.cells(want["pages"], want["uri_info"], want["domain_count"]), *cells)
    assert len(store.store._pointers()) == 2 and len(store.store.files.names("pages")) <= 5  # old versions are removed


def test_empty_update_is_skipped(spark, tmp_path):
    store = incremental.IndexStore(spark, str(tmp_path / "s"), buckets=2, cells=False)
    store.bootstrap(spark.createDataFrame(SET1, schema.PAGE))
    before = rows(store.tables()["uri_info"], "uri", "links_to", "docs")
    empty = (1, A1, "U", None, (None, A1, 0, None, None, None, []))
    store.apply(spark.createDataFrame([empty], UPDATE), 1, ["update_id"])
    assert rows(store.tables()["uri_info"], "uri", "links_to", "docs") == before


def test_strict_store_keeps_anchors(spark, tmp_path):
    """A link that stays keeps its first anchor in strict mode, gets the new one otherwise."""
    for strict, want in ((False, "new"), (True, "c1")):
        store = incremental.IndexStore(spark, str(tmp_path / f"s{strict}"), buckets=2, cells=False, strict=strict)
        store.bootstrap(spark.createDataFrame(SET1, schema.PAGE))
        up = (1, A1, "U", None, page(A1, [(C1, "new"), ("com.n>>o>/", "n")]))
        store.apply(spark.createDataFrame([up], UPDATE), 1, ["update_id"])
        assert {r.dst: r.anchor for r in store.table("edges").where(F.col("src") == A1).collect()} == {C1: want, "com.n>>o>/": "n"}
        assert store.meters["links_exported"] == (3 if strict else 4)


def test_failed_batch_leaves_the_state(spark, tmp_path, monkeypatch):
    store = incremental.IndexStore(spark, str(tmp_path / "s"), buckets=2, cells=False)
    store.bootstrap(spark.createDataFrame(SET1, schema.PAGE))
    before = rows(store.tables()["uri_info"], "uri", "links_to", "docs")
    batch = spark.createDataFrame([update(1, A1, [C1])], UPDATE)
    monkeypatch.setattr(store, "_measure", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.apply(batch, 1, ["update_id"])
    assert rows(store.tables()["uri_info"], "uri", "links_to", "docs") == before
    monkeypatch.undo()
    assert store.apply(batch, 1, ["update_id"]) and (B3, 1, 0) in rows(store.tables()["uri_info"], "uri", "links_to", "docs")


def test_lookup_reads_one_bucket(spark, tmp_path):
    store = incremental.IndexStore(spark, str(tmp_path / "s"), buckets=8, cells=False)
    store.bootstrap(spark.createDataFrame(SET1, schema.PAGE))
    for df in (store.table("edges").where(f"dst = '{C1}'"), store.table("pages").where(f"uri = '{A1}'")):
        scan = df._jdf.queryExecution().sparkPlan().collectLeaves().head()
        assert scan.optionalBucketSet().get().cardinality() == 1 and df.count() in (1, 2)


def test_time_buckets(spark):
    e = spark.sql("SELECT timestamp'2024-01-01 00:00:29' ts, 1.0D value, 'a' k UNION ALL SELECT timestamp'2024-01-01 00:00:30', 2.0D, 'a' UNION ALL SELECT timestamp'2024-01-01 00:00:59', 3.0D, 'a'")
    assert [(r.total, r.n) for r in index.time_buckets(e, "ts", "value", ["k"]).orderBy("bucket").collect()] == [(1.0, 1), (5.0, 2)]


def test_links_distinct_and_sorted(spark):
    links = [("u", k, str(i)) for i, k in enumerate(["b", "a", None, "b", "c", "a"])]
    got = spark.createDataFrame([(links,), ([],), (None,)], f"x array<{schema.LINK}>").select(index.distinct_links(F.col("x")).alias("y")).collect()
    assert [(x.uri, x.anchor_text) for x in got[0].y] == [("a", "1"), ("b", "0"), ("c", "4")] and got[1].y == [] and got[2].y is None
    many = [("u", f"k{i % 20000}", str(i)) for i in range(40000)]
    assert spark.createDataFrame([(many,)], f"x array<{schema.LINK}>").select(F.size(index.distinct_links(F.col("x"))).alias("n")).first().n == 20000


def test_api(set1, spark):
    from linkloom import api

    ix = LinkIndex(set1["pages"], index.edges(set1["pages"]), set1["uri_info"], set1["domain_count"])
    assert api.answer(ix, "/api/top", {})[1]["results"][0] == {"key": B3, "value": 2}
    assert api.answer(ix, "/api/pages", {"domain": "b.com"})[1]["total"] == 4
    assert api.answer(ix, "/api/page", {"url": "http://b.com/3"})[1]["num_inbound"] == 2
    got = api.answer(ix, "/api/links", {"url": "http://c.com/1", "linkType": "in"})[1]
    assert [x["uri"] for x in got["links"]] == [A1, B] and got["total"] == 2 and got["next"] == ""
    assert api.answer(ix, "/api/links", {"url": "http://c.com/1"})[0] == 400 and api.answer(ix, "/api/page", {"url": "nope"})[0] == 400 and api.answer(ix, "/x", {})[0] == 404


def test_meters(set1, spark, tmp_path):
    from linkloom.operators import metrics

    log = metrics.MeterLog(spark, str(tmp_path / "m"))
    log(1, {"updates_in": 3}), log(1, {"updates_in": 9})
    assert log.rows() == [{"batch": 1, "updates_in": 3}]

    m = metrics.update_meters(set1, spark.createDataFrame([update(1, A1, [C1, "com.new>>o>/"]), update(2, B, [], "D"), update(3, "com.z>>o>/", [], "D")], UPDATE), ["update_id"]).first()
    assert (m.updates_in, m.pages_changed, m.links_new, m.links_deleted, m.domains_new, m.domains_gone) == (3, 2, 1, 5, 1, 1)
    df, seen = metrics.observed(spark.createDataFrame([*SET1, page(C1, [])], schema.PAGE))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"pages": 3, "empty_pages": 1, "links": 6}
