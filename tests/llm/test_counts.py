import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.llm import heavyhitters, loglog, topn


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.integers(-5, 60), min_size=1, max_size=80), min_size=1, max_size=6))
def test_sketch_never_underestimates(batches):
    s, true = heavyhitters.CountMin(width=16, depth=2), Counter()
    for b in batches:
        keys, n = np.unique(np.array(b, np.int64), return_counts=True)
        est = s.add(keys, n)
        true.update(b)
        assert all(e >= true[int(k)] for k, e in zip(keys, est))
    assert s.total == sum(map(len, batches))


def test_sketch_is_close():
    s = heavyhitters.CountMin()
    keys = np.arange(200_000, dtype=np.int64) * 7919
    s.add(keys, np.ones(len(keys), np.int64))
    est = s.add(np.array([1], np.int64), np.array([1000], np.int64))
    assert 1000 <= est[0] <= 1000 + np.e / s.width * s.total


def test_frequent(spark):
    rnd = random.Random(1)
    values = ["hot"] * 4000 + [None] * 500 + [""] * 60 + [f"v{rnd.randrange(3000)}" for _ in range(6000)] + ["edge"] * 100
    rnd.shuffle(values)
    df = spark.createDataFrame([(v, "c") for v in values], "item string, h string").repartition(5)
    n = Counter(v for v in values if v is not None)
    want = {v: c for v, c in n.items() if c >= 0.005 * sum(n.values())}
    got = heavyhitters.frequent({"f": (df, "item"), "g": (df.where("item = 'hot'"), "item")}, 0.005).collect()
    assert {r["item"]: r.n_rows for r in got if r.field_name == "f"} == want and all(r.estimate >= r.n_rows for r in got)
    assert [r["item"] for r in got if r.field_name == "g"] == ["hot"]


def test_frequent_empty(spark):
    df = spark.createDataFrame([(None,)], "item string")
    assert heavyhitters.frequent({"f": (df, "item")}, 0.1).count() == 0
    assert heavyhitters.candidates(df.where("false"), ["item"], 0.1).count() == 0


def fetches(spark, rows):
    return spark.createDataFrame(rows, "crawl_date string, segment_no int, server string, uri string")


def brute(rows, days):
    groups = {}
    for d, seg, srv, u in rows:
        day = days.get(d)
        if day is None or u is None:
            continue
        for key in {(day, -1, "*"), *([(day, seg, "*")] if seg is not None else []), *([(day, -1, srv)] if srv is not None else []), *([(day, seg, srv)] if None not in (seg, srv) else [])}:
            groups.setdefault(key, []).append(u)
    return groups


def test_repetitive_groups(spark):
    rnd = random.Random(2)
    days = {"2025-03-03T18:00:00Z": "2025-03-03", "2025-03-04T01:00:00+02:00": "2025-03-03", "2025-03-03T20:00:00-05:00": "2025-03-04", "2025-03-04T00:00:01": "2025-03-04", "junk": None}
    rows = [(rnd.choice(list(days)), rnd.choice([0, 1, None]), rnd.choice(["a", "b", None]), rnd.choice([None, *(f"u{i}" for i in range(rnd.choice([40, 400])))])) for _ in range(4000)]
    groups = brute(rows, days)
    want = {k for k, us in groups.items() if len(us) >= 100 and len(set(us)) < 0.5 * len(us)}
    df = fetches(spark, rows)
    got = [tuple(r) for r in loglog.repetitive_groups(df).collect()]
    assert set(got) == want and len(got) == len(want) and 0 < len(want) < len(groups)
    for r in loglog.daily_distinct(df).collect():
        us = groups[(r.crawl_day, r.segment_no, r.server)]
        assert r.n_rows == len(us) and abs(r.n_distinct - len(set(us))) <= 5 * r.std_error + 1


def test_registers_merge_like_union(spark):
    a, b = spark.range(0, 6000).selectExpr("cast(id as string) u", "1 g"), spark.range(3000, 20000).selectExpr("cast(id as string) u", "1 g")
    merged = loglog.merge(loglog.registers(a, ["g"], "u").unionByName(loglog.registers(b, ["g"], "u")), ["g"])
    whole = loglog.registers(a.unionByName(b), ["g"], "u")
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    r = loglog.estimate(merged, ["g"]).first()
    assert abs(r.n_distinct - 20000) < 4 * r.std_error and r.n_rows == 23000


def test_loglog_empty(spark):
    assert loglog.repetitive_groups(fetches(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([b"a", b"b", b"c", b"d"]), st.integers(0, 6), st.binary(min_size=1, max_size=2)), max_size=60), st.integers(1, 7), st.integers(1, 4))
def test_loser_tree(rows, k, n):
    runs = []
    for i in range(k):
        own = sorted(rows[i::k], key=lambda r: (r[0], -r[1], r[2]))
        runs.append(topn.Run(*([list(c) for c in zip(*own)] if own else ([], [], []))))
    want = []
    for g in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:n]
        want += [(g, s, i, j + 1) for j, (_, s, i) in enumerate(own)]
    assert list(topn.merge_top(runs, n)) == want


def test_domain_leaders(spark):
    rnd = random.Random(3)
    rows = [(f"com.{rnd.choice(['hot', 'hot', 'b', 'c', 'd'])}>>o>/{rnd.randrange(40)}", "x", rnd.choice([None, 1, 2, 3]), rnd.randrange(50)) for _ in range(900)] + [(None, "x", 5, 1), ("com.é>>s>/", None, 0, 1)]
    latest = {}
    for u, _, n, t in rows:
        if u is not None and (u not in latest or (t, n if n is not None else -1) > latest[u]):
            latest[u] = (t, n if n is not None else -1)
    want = set()
    for d in {u.split(">")[0] for u in latest}:
        own = sorted((-n, u.encode(), u) for u, (_, n) in latest.items() if u.split(">")[0] == d and n >= 0)
        want |= {(d, i + 1, u) for i, (_, _, u) in enumerate(own[:5])}
    df = spark.createDataFrame(rows, "uri string, rev_domain string, links_to long, as_of_ts int").repartition(6)
    got = [(r.rev_domain, r.rank_no, r.uri) for r in topn.domain_leaders(df).collect()]
    assert set(got) == want and len(got) == len(want)
    assert topn.domain_leaders(df.where("false")).count() == 0


def test_head_of_run_across_batches(spark):
    df = spark.range(30000).selectExpr("'g' as g", "id as score", "cast(id as string) as item").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = topn.top_n(df, F.col("g"), F.col("score"), F.col("item"), 250).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.score for r in sorted(got, key=lambda r: r.rank_no)] == list(range(29999, 29749, -1))


@pytest.mark.parametrize("tasks,fan_in", [(1, 64), (40, 3), (9, 2)])
def test_merge_rounds(spark, tasks, fan_in):
    """Rounds of few runs give the ranks of one merge; fractions rank by value, NaN and nulls not at all."""
    rnd = random.Random(tasks)
    rows = [(rnd.choice(["hot"] * 6 + list("abcdefgh")), rnd.choice([1.2, 1.9, -3.5, 7.0, float("nan"), None]), f"i{rnd.randrange(60):02}") for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, score double, item string").repartition(tasks)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = sorted((r.g, r.rank_no, r.score, r["item"]) for r in topn.top_n(df, F.col("g"), F.col("score"), F.col("item"), 4, tasks, fan_in).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for g in {r[0] for r in rows}:
        own = sorted((-s, i) for h, s, i in rows if h == g and s is not None and s == s)[:4]
        want += [(g, k + 1, -s, i) for k, (s, i) in enumerate(own)]
    assert got == sorted(want)


def test_groups_at_the_edge(spark):
    """Half of the rows distinct, one more, one less: registers can't tell, the exact count does."""
    rows = []
    for k, n in enumerate((499, 500, 501)):
        rows += [(f"u{i % n}", "2024-01-01T00:00:00Z", k, None) for i in range(1000)]
    df = spark.createDataFrame(rows, "uri string, crawl_date string, segment_no int, server string")
    got = {(r.segment_no, r.server) for r in loglog.repetitive_groups(df).collect()}
    assert got == {(0, "*"), (-1, "*")}
