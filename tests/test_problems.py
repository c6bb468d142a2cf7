import json
import random

import pytest
from pyspark.sql import functions as F

from linkloom import schema
from linkloom.operators import snapshots, treeagg, variants

H = lambda x: {"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": {"HTML-Metadata": x}}}}


def table(spark, bodies):
    return spark.createDataFrame([(i, b, "z") for i, b in enumerate(bodies)], "record_no long, body string, list_name string")


def test_variants(spark):
    a = {"path": "A@/href", "url": "u", "text": "t"}
    bodies = [
        json.dumps(H({"Links": [a, 3, None, {}, [a], {"path": 1}, {"path": "p", "url": "u"}], "Head": {"Metas": {"name": "n", "content": "c"}}})),
        None, "", "not json", json.dumps(H({"Links": a})) + " x", "{}{}", json.dumps(H({"Links": "s"})), json.dumps([H({"Links": [a]})]), " " + json.dumps(H({"Links": a})) + "\n",
    ]
    got = {(r.record_no, r.list_name, r.list_pos): r.variant for r in variants.children(table(spark, bodies)).collect()}
    assert got == {(0, "Links", 0): "anchor", (0, "Links", 3): "open", (0, "Links", 5): "open", (0, "Links", 6): "bare", (0, "Metas", 0): "named", (8, "Links", 0): "anchor"}
    shapes = {r.list_pos: r.shape for r in variants.children(table(spark, bodies[:1])).where("list_name = 'Links'").collect()}
    assert shapes[0] == "OBJECT<path: STRING, text: STRING, url: STRING>" and shapes[5] == "OBJECT<path: NUMBER>"


def test_typed_tables_and_parents(spark):
    bodies = [json.dumps(H({"Head": {"Title": ["x"]}, "Links": [{"path": 1, "url": "u"}]})), json.dumps(H({"Head": {"Title": "T"}}))]
    assert [(r.record_no, r.title) for r in variants.record_heads(table(spark, bodies)).orderBy("record_no").collect()] == [(0, None), (1, "T")]
    r = variants.subtype(table(spark, bodies), "Links").first()
    assert (r.record_no, r.list_pos, r.path, r.url, r.variant) == (0, 0, None, "u", "open")


def test_repeated_keys_and_residuals(spark):
    """The last value of a repeated key counts; what fits no typed table is kept."""
    body = '{"Envelope":{"x":1,"x":2,"Payload-Metadata":{"HTTP-Response-Metadata":{"HTML-Metadata":{"Links":[{"path":"old","path":"p","url":5,"more":{"k":[1]}},7,null]}}}}}'
    assert variants.subtype(table(spark, [body]), "Links").first().path == "p"
    got = sorted((r.list_pos, r.field or "", r.kind, r.value) for r in variants.residuals(table(spark, [body, None])).collect())
    assert got == [(0, "more", "OBJECT<k: ARRAY<NUMBER>>", '{"k":[1]}'), (0, "url", "NUMBER", "5"), (1, "", "NUMBER", "7"), (2, "", "VOID", "null")]


def test_variants_long_and_empty(spark):
    big = json.dumps(H({"Links": [{"path": "p", "url": "x" * 1000} for _ in range(3000)]}))
    assert variants.children(table(spark, [big, big])).count() == 6000
    assert variants.children(table(spark, [])).count() == 0


def snap(rows):
    return [(n, u, u, 0, d, s, t, None if ls is None else [(x, x, "a") for x in ls]) for n, u, d, s, t, ls in rows]


SNAP = "snap_no int, " + schema.PAGE


def test_page_changes(spark):
    rows = [
        (1, "p", "d1", "s", "t", ["a", "b"]), (1, "p", "d0", "s", "old", ["z"]), (1, "q", "d", None, "t", ["a"]), (1, "r", "d", "s", "t", None), (1, "same", "d", "s", None, ["x", "y", "x"]), (1, None, "d", "s", "t", ["a"]),
        (4, "p", "d1", "s", "t", ["b", "c", None]), (4, "q", "d", "x", "t", ["a"]), (4, "new", "d", "s", "t", ["k", "k"]), (4, "same", "e", "s", None, ["y", "x"]), (4, "same", "e", "s", None, ["y", "x"]),
    ]
    got = sorted(tuple(r) for r in snapshots.page_changes(spark.createDataFrame(snap(rows), SNAP)).collect())
    assert got == sorted([(4, "p", "", "changed"), (4, "p", "a", "removed"), (4, "p", "c", "added"), (4, "q", "", "changed"), (4, "r", "", "removed"), (4, "new", "", "added"), (4, "new", "k", "added")])


def test_page_changes_random(spark):
    """Against plain sets over several deliveries."""
    rnd = random.Random(3)
    states, rows = {}, []
    for n in (1, 2, 5, 6):
        states[n] = {f"p{i}": (rnd.choice(["t", "u", None]), tuple(rnd.sample("abcde", rnd.randint(0, 3)))) for i in range(30) if rnd.random() < 0.8}
        rows += [(n, p, "d", "s", t, list(ls)) for p, (t, ls) in states[n].items()]
    want = set()
    for a, b in ((1, 2), (2, 5), (5, 6)):
        old, new = states[a], states[b]
        for p in old.keys() | new.keys():
            x, y = old.get(p), new.get(p)
            kind = "added" if x is None else "removed" if y is None else "changed" if x[0] != y[0] or set(x[1]) != set(y[1]) else None
            if kind:
                want.add((b, p, "", kind))
                xs, ys = set(x[1] if x else ()), set(y[1] if y else ())
                want |= {(b, p, u, "added") for u in ys - xs} | {(b, p, u, "removed") for u in xs - ys}
    got = [tuple(r) for r in snapshots.page_changes(spark.createDataFrame(snap(rows), SNAP)).collect()]
    assert set(got) == want and len(got) == len(want)


def test_snapshots_one_or_none(spark):
    assert snapshots.page_changes(spark.createDataFrame(snap([(1, "p", "d", "s", "t", ["a"])]), SNAP)).count() == 0
    assert snapshots.page_changes(spark.createDataFrame([], SNAP)).count() == 0


def test_snapshot_store(spark, tmp_path, monkeypatch):
    rows = snap([(1, "p", "d", "s", "t", ["a"]), (1, "q", "d", "s", "t", ["a"]), (2, "p", "d", "s", "t", ["a", "b"])])
    df = spark.createDataFrame(rows, SNAP)
    store = snapshots.SnapshotStore(spark, str(tmp_path), "uri", "crawl_date", ["title", "server"], F.transform("outbound_links", lambda x: x["uri"]), buckets=2)
    assert store.receive(df.where("snap_no = 1"), "snap_no") == [1] and store.advance(1) and store.changes([1]).count() == 0
    store.receive(df.where("snap_no = 2"), "snap_no")
    monkeypatch.setattr(store.store, "commit", lambda state: 1 / 0)
    with pytest.raises(ZeroDivisionError):  # fails at the swap: the old index is still the last one
        store.advance(2)
    monkeypatch.undo()
    assert store.current() == 1 and store.advance(2) and store.current() == 2
    got = sorted((r.k, r["item"], r.change_kind) for r in store.changes([2]).collect())
    assert got == [("p", "", "changed"), ("p", "b", "added"), ("q", "", "removed"), ("q", "a", "removed")]
    store.receive(df, "snap_no")
    assert not store.advance(1) and not store.advance(2) and store.changes([1, 2]).count() == 4


def test_snapshot_probe_moves_no_index(spark, tmp_path):
    store = snapshots.SnapshotStore(spark, str(tmp_path), "uri", "crawl_date", ["title"], F.transform("outbound_links", lambda x: x["uri"]), buckets=4)
    rows = spark.createDataFrame(snap([(n, f"p{i}", "d", "s", "t", []) for n in (1, 2) for i in range(9)]), SNAP)
    store.receive(rows, "snap_no")
    for n in (1, 2):
        store.store.write(snapshots.index_of(store._rows(n)), "index", n, "k")
    plan = snapshots.probe(store.store.read("index", [1], "k"), store.store.read("index", [2], "k"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FullOuter" in plan


@pytest.mark.parametrize("parts,fan_in", [(1, 2), (7, 2), (7, 32), (30, 3)])
def test_tree(spark, parts, fan_in):
    rnd = random.Random(parts)
    rows = [("hot" if rnd.random() < 0.4 else rnd.choice("abc"), rnd.choice([None, *"uvwxyz"]), rnd.choice("123")) for _ in range(500)] + [(None, "u", "1")]
    df = spark.createDataFrame(rows, "k string, p string, q string").repartition(parts).withColumn("slice", F.lit(1)).withColumn("n_rows", F.lit(9))
    counts = {r.key_value: r.n_rows for r in treeagg.tree_counts(df, ["k"], fan_in).collect()}
    assert counts == {k: sum(1 for a, _, _ in rows if a == k) for k in {a for a, _, _ in rows if a}}
    got = {(r.field_name, r.key_value): (r.n_rows, r.n_partners) for r in treeagg.tree_degrees(df, {"k": "p", "p": "k", "q": "p"}, fan_in).collect()}
    want = {}
    for name, key, other in (("k", 0, 1), ("p", 1, 0), ("q", 2, 1)):
        for v in {r[key] for r in rows if r[key] is not None}:
            mine = [r[other] for r in rows if r[key] == v]
            want[name, v] = (len(mine), len({x for x in mine if x is not None}))
    assert got == want


def test_heavy_keys_and_empty(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)] * 98, "k string")
    assert [(r.key_value, r.n_rows) for r in treeagg.heavy_keys(treeagg.tree_counts(df, ["k"]), 0.02).orderBy("key_value").collect()] == [("a", 2), ("b", 98)]
    assert treeagg.heavy_keys(treeagg.tree_counts(df.where("false"), ["k"]), 0.02).count() == 0
