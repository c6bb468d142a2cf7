import gzip
import json

import pytest

from linkloom import jobs
from linkloom.operators import records
from linkloom.sources import archives, files
from linkloom.sources import pages as page_source
from linkloom.streaming.incremental import IndexStore

BODY = '{"Envelope":{"Payload-Metadata":{"HTTP-Response-Metadata":{"Headers":{"Server":"nginx"},"HTML-Metadata":{"Head":{"Title":"T"},"Links":[{"path":"A@/href","url":"http://other.org/x","text":"go"},{"path":"A@/href","url":"/rel"},{"path":"IMG@/src","url":"http://pic.net/p"},{"path":"A@/href","url":"http://www.site.com/in"},7,{"path":"A@/href","url":"http://third.net:8080/","title":"by title"}]}}}}}'


def record(kind, uri, body, n=None):
    b = body.encode()
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nWARC-Date: 2015-04-18T03:35:13Z\r\nWARC-Record-ID: <urn:{kind}>\r\nContent-Type: application/json\r\nContent-Length: {len(b) if n is None else n}\r\n\r\n".encode() + b + b"\r\n\r\n"


@pytest.fixture
def archive(tmp_path):
    data = record("metadata", "http://www.site.com/a", BODY) + record("metadata", "http://bad", "{}") + record("metadata", "http://site.com/c", "not json")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/a.warc").write_bytes(data)
    with gzip.open(tmp_path / "b.warc.gz", "wb") as f:
        f.write(data)
    return tmp_path


def test_scan_and_source_agree(spark, archive):
    cols = ["warc_type", "target_uri", "warc_date", "content_type", "content_length", "body"]
    a = sorted(map(tuple, archives.scan(spark, str(archive / "sub")).select(*cols).collect()))
    spark.dataSource.register(archives.ArchiveSource)
    b = sorted(map(tuple, spark.read.format("archive").option("paths", str(archive / "b.warc.gz")).load().select(*cols).collect()))
    assert a == b and len(a) == 3


def test_pages_of_records(spark, archive):
    from pyspark.sql import functions as F

    rows = archives.scan(spark, str(archive / "sub")).withColumn("record_no", F.monotonically_increasing_id())
    got = records.pages(rows).collect()
    assert len(got) == 1
    p = got[0]
    assert (p.uri, p.url, p.title, p.server, p.num_outbound, p.crawl_date) == ("com.site>.www>o>/a", "http://www.site.com/a", "T", "nginx", 2, "2015-04-18T03:35:13Z")
    assert [(x.uri, x.anchor_text) for x in p.outbound_links] == [("org.other>>o>/x", "go"), ("net.third>>o8080>/", "by title")]


def test_exact_links(spark):
    """The ill-typed link 7 is skipped, or ends the list."""
    row = spark.createDataFrame([(1, "http://www.site.com/a", "d", "application/json", BODY), (2, "http://www.site.com/a", "d", "Application/JSON", BODY)], "record_no long, target_uri string, warc_date string, content_type string, body string")
    count = lambda exact: {r.record_no: len(r.raw_links) for r in records.raw_pages(row, exact).collect()}
    assert count(False) == {1: 4, 2: 0} and count(True) == {1: 3, 2: 0}


def test_json_lines(spark, tmp_path):
    (tmp_path / "p.txt").write_text('{"url":"http://a.com/","uri":"com.a>>o>/","numOutbound":1,"outboundLinks":[{"url":"http://b.com/","uri":"com.b>>o>/","anchorText":"x"}]}\nbroken\n{"url":"http://c.com/","uri":"com.c>>o>/","numOutbound":0,"outboundLinks":[]}\n')
    p = page_source.read_pages(spark, str(tmp_path / "p.txt"))
    assert p.count() == 2
    page_source.write_sample(p, str(tmp_path / "out"), 5)
    assert [r.uri for r in page_source.read_pages(spark, str(tmp_path / "out")).collect()] == ["com.a>>o>/"]


def test_paths_range():
    assert files.paths_range(list("abcd"), "1-2") == ["b", "c"]
    for bad in ("2-1", "x-2", "3", "1-"):
        with pytest.raises(ValueError):
            files.paths_range(list("abcd"), bad)


def test_small_helpers(spark, tmp_path):
    assert files.add_slash("a") == files.add_slash("a/") == "a/" and files.file_name("x/y/z.gz") == "z.gz"
    with pytest.raises(ValueError):
        files.require_data(spark, str(tmp_path))
    (tmp_path / "f").write_text("x")
    (tmp_path / "to").mkdir()
    assert files.require_data(spark, str(tmp_path)) == str(tmp_path) and [p.rpartition("/")[2] for p in files.list_files(spark, str(tmp_path))] == ["f"]
    done = files.copy_files(spark, [str(tmp_path / "f"), str(tmp_path / "none")], str(tmp_path / "to")).collect()
    assert sorted(r.done.split(":")[0] for r in done) == ["copied", "failed"] and (tmp_path / "to/f").read_text() == "x"
    (tmp_path / "c.yml").write_text("table: t\nload_rate_limit: 50\n")
    assert files.Config.load(str(tmp_path / "no"), str(tmp_path / "c.yml")).load_rate_limit == 50


def test_command_line(spark, archive, tmp_path, capsys):
    (tmp_path / "paths").write_text("a\nb\nc\n")
    assert jobs.main(["getpaths", str(tmp_path / "paths"), "0-1"]) == 0
    assert capsys.readouterr().out.split() == ["a", "b"]
    IndexStore(spark, str(tmp_path / "st"), buckets=2, ranges=2).bootstrap(page_source.read_pages(spark, str(tmp_path / "paths")))
    jobs.main(["query", str(tmp_path / "st"), "top"])


def test_archives_end_to_end(spark, tmp_path, capsys):
    """init (exact source) and load (text scan) from archives, plain and gzip, then the questions. An older capture that is loaded later changes nothing."""
    body = lambda *us: json.dumps({"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": {"HTML-Metadata": {"Links": [{"path": "A@/href", "url": u, "text": "t"} for u in us]}}}}})
    dated = lambda day, uri, b: record("metadata", uri, b).replace(b"2015-04-18", day.encode())
    for name, data in (("one/a.warc", record("metadata", "http://a.com/", body("http://b.com/", "http://c.com/")) + record("metadata", "http://d.com/", body("http://b.com/"))), ("two/b.warc.gz", dated("2015-05-01", "http://a.com/", body("http://c.com/")) + dated("2014-01-01", "http://d.com/", body("http://x.com/")))):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    (tmp_path / "c.yml").write_text("buckets: 2\ntablets: 2\nload_rate_limit: 1000\n")
    more = ["--store", str(tmp_path / "st"), "--config", str(tmp_path / "c.yml")]
    assert jobs.main(["parse", str(tmp_path / "one")]) == 0 and jobs.main(["init", str(tmp_path / "one"), "--exact", *more]) == 0
    ask = lambda *q: (capsys.readouterr(), jobs.main(["query", str(tmp_path / "st"), *q]), [json.loads(x) for x in capsys.readouterr().out.split("\n") if x])[2]
    assert ask("top")[0] == {"uri": "com.b>>o>/", "links_to": 2, "docs": 0}
    assert jobs.main(["load", str(tmp_path / "two"), *more]) == 0
    assert {r["uri"]: r["links_to"] for r in ask("top")} == {"com.a>>o>/": 0, "com.b>>o>/": 1, "com.c>>o>/": 1, "com.d>>o>/": 0}
    assert [r["uri"] for r in ask("in", "com.c>>o>/")] == ["com.a>>o>/"] and [r["uri"] for r in ask("out", "com.d>>o>/")] == ["com.b>>o>/"]
    assert ask("page", "com.b>>o>/")[0]["num_inbound"] == 1
    assert jobs.main(["splits", "-", "--store", str(tmp_path / "st")]) == 0 and "p:com.a" in capsys.readouterr().out


def test_exact_source_keeps_heads_in_bodies(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record("metadata", "http://a.com/", "x WARC/1.0\r\ny") + record("metadata", "http://b.com/", "z"))
    assert [r.body for r in archives.read(spark, str(tmp_path), exact=True).collect()] == ["x WARC/1.0\r\ny", "z"]
