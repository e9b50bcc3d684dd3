import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldspar.operators import joins
from veldspar.operators.rollup import latest_last_wins
from veldspar.functions import html, urls
from veldspar.plans import pipelines
from veldspar.sources import connector, files, payloads, sinks
from veldspar.sources.connector import PageSource
from veldspar.streaming import seen

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_jsonl(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1, "b": "x"}\n\nnot json\n{"a": 2}\n')
    assert sorted(r["a"] for r in files.read_jsonl(spark, str(p), SCHEMA).collect()) == [1, 2]
    good, bad = files.read_jsonl_with_rejects(spark, str(p), SCHEMA)
    assert good.count() == 2 and [r[0] for r in bad.collect()] == ["not json"]
    assert files.read_jsonl(spark, str(tmp_path / "none"), SCHEMA).count() == 0
    try:
        files.read_jsonl(spark, str(p), SCHEMA, strict=True).collect()
    except Exception:
        pass
    else:
        raise AssertionError("a strict read must fail")
    assert [r["a"] for r in files.with_required(good, ["b"]).collect()] == [1]
    assert [r["a"] for r in files.first_records(good, ["a"], 1).collect()] == [1] and files.first_records(good, ["a"], 0).count() == 2


def test_csv_and_lists(spark, tmp_path):
    (tmp_path / "x.csv").write_text('﻿id,t\n1,"a,\n""b"""\n', encoding="utf-8")
    df = files.read_csv(spark, str(tmp_path / "x.csv"))
    assert df.columns == ["id", "t"] and [tuple(r) for r in df.collect()] == [("1", 'a,\n"b"')]
    assert files.read_csv(spark, str(tmp_path / "no.csv")).count() == 0
    (tmp_path / "u.txt").write_text("# c\nhttps://a\n\n https://b \nhttps://a\n")
    assert [(r["url"], r["pos"]) for r in files.read_url_list(spark, str(tmp_path / "u.txt")).orderBy("pos").collect()] == [("https://a", 1), ("https://b", 3)]
    many = "\n".join(f"https://x/{i % 500}" for i in range(5000))
    (tmp_path / "many.txt").write_text(many)
    got = [r["url"] for r in files.read_url_list(spark, str(tmp_path / "many.txt")).orderBy("pos").collect()]
    assert got == [f"https://x/{i}" for i in range(500)]
    (tmp_path / "c.json").write_text(json.dumps({"sources": [{"id": "s", "on": True}]}))
    assert files.read_config(spark, str(tmp_path / "c.json"), "sources").collect()[0]["id"] == "s"
    assert files.read_config(spark, str(tmp_path / "c.json"), "none").count() == 0
    (tmp_path / ".env").write_text("A_KEY='v'\n# no\nPATH=other\n")
    env = files.load_env(str(tmp_path / ".env"))
    assert env["A_KEY"] == "v" and env["PATH"] != "other"


def test_documents_of_a_folder(spark, tmp_path):
    (tmp_path / "b.MD").write_text("# x")
    (tmp_path / "a.html").write_text("<p>")
    got = [(r["stem"], r["extension"], r["media_type"]) for r in files.scan_documents(spark, str(tmp_path), max_documents=5).orderBy("path").collect()]
    assert got == [("a", ".html", "text/html"), ("b", ".md", "text/markdown")]


RSS = """<?xml version="1.0"?><rss><channel><title>c</title><item><title>One</title><link>https://x/1</link><description>&lt;p&gt;a b&lt;/p&gt;</description><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate><enclosure url="https://x/a.mp3"/></item>
<item><title>No link</title></item><item><title>Two</title><link>https://x/2</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link rel="self" href="https://x/self"/><link href="https://x/a"/><updated>2024-01-01T00:00:00Z</updated><author><name>N</name></author></entry></feed>"""


def test_feeds(spark):
    df = spark.createDataFrame([("r", RSS), ("a", ATOM), ("broken", RSS[:300]), ("none", None), ("junk", "<<<")], "url string, body string")
    got = [(r["url"], r["pos"], r["title"], r["link"]) for r in payloads.feed_candidates(df, ["url"], "body").orderBy("url", "pos").collect()]
    assert got == [("a", 0, "A", "https://x/a"), ("broken", 0, "One", "https://x/1"), ("r", 0, "One", "https://x/1"), ("r", 2, "Two", "https://x/2")]
    one = payloads.feed_candidates(df.filter("url = 'r'"), ["url"], "body", max_items=2, keep_linkless="url").orderBy("pos").collect()
    assert [(r["title"], r["source_note"]) for r in one] == [("One", None), ("No link", "r")] and one[0]["summary"] == "a b" and one[0]["enclosure"] == "https://x/a.mp3"


def test_filing_payloads(spark):
    recent = {"accessionNumber": ["0-1", "", "0-3"], "filingDate": ["2024-01-01", "x", "2024-01-03"], "form": ["10-K", "8-K", "8-K"], "primaryDocument": ["a.htm"]}
    df = spark.createDataFrame([(json.dumps({"cik": "0001", "entityName": "E", "filings": {"recent": recent}}),)], "b string")
    got = payloads.columnar_filings(df, "b", limit=5).orderBy("pos").collect()
    assert [(r["accessionNumber"], r["form"], r["primaryDocument"]) for r in got] == [("0-1", "10-K", "a.htm"), ("0-3", "8-K", "")] and got[0]["document_path"] == "1/01/a.htm"
    assert payloads.columnar_filings(df, "b", forms=["8-K"], limit=1).count() == 1
    cn = spark.createDataFrame([(json.dumps({"data": [{"id": "1", "title": "t", "type": "", "code": "9", "date": 1704067200000}, {"id": "2", "title": "u", "type": "z"}]}),)], "b string")
    got = payloads.announcement_filings(cn, "b", ["y"]).collect()
    assert [(r["announcement_id"], r["filing_date"]) for r in got] == [("1", "2024-01-01")]
    hk = spark.createDataFrame([(1, "<table><tr><th>c</th></tr><tr><td>5<td>N<td><a href='/x.PDF'>T</a><td>K<td>01/02/2024</tr><tr><td>1</tr></table>")], "i int, b string")
    got = payloads.table_filings(hk, ["i"], "b").collect()
    assert [(r["code"], r["title"], r["kind"], r["filed"], r["is_pdf"]) for r in got] == [("5", "T", "K", "01/02/2024", True)]


def test_search_payloads(spark):
    df = spark.createDataFrame([(json.dumps({"results": [{"title": "a", "url": "https://www.q.org/x", "content": "c"}, {"title": "b", "url": "u"}]}),)], "b string")
    assert [(r["rank"], r["domain"]) for r in payloads.search_results(df, "b").orderBy("rank").collect()] == [(1, "q.org"), (2, None)]
    hn = spark.createDataFrame([(json.dumps({"hits": [{"objectID": "7", "title": "t", "url": None, "story_text": ""}]}),)], "b string")
    assert [(r["url"], r["raw_text"]) for r in payloads.story_signals(hn, "b").collect()] == [("item:7", "t")]
    gh = spark.createDataFrame([(json.dumps({"items": [{"id": 1, "title": "t", "body": "b", "labels": [{"name": "x"}]}]}),)], "b string")
    assert [(r["raw_text"], r["labels"]) for r in payloads.issue_signals(gh, "b").collect()] == [("t\n\nb", ["x"])]


def test_versioned_table_and_logs(spark, tmp_path):
    t = sinks.VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    t.replace(spark.range(3).toDF("a"))
    t.replace(t.read().filter("a > 0"))
    assert sorted(r[0] for r in t.read().collect()) == [1, 2]
    # A version without a pointer, as a writer leaves that died, changes nothing.
    spark.range(9).toDF("a").write.parquet(str(tmp_path / "t" / "v-dead"))
    assert sorted(r[0] for r in sinks.VersionedTable(spark, str(tmp_path / "t")).read().collect()) == [1, 2]
    log = spark.createDataFrame([("k", 1, "x"), ("k", 2, None)], "k string, pos int, v string")
    sinks.append_log(log, str(tmp_path / "log"))
    sinks.append_log(log.limit(0), str(tmp_path / "log"))
    assert files.read_jsonl(spark, str(tmp_path / "log"), log.schema).count() == 2
    sinks.write_latest(log, str(tmp_path / "latest"), ["k"], "pos")
    assert spark.read.parquet(str(tmp_path / "latest")).collect()[0]["pos"] == 2
    sinks.fan_out(log, {"all": (None, str(tmp_path / "a")), "some": (F.col("pos") == 1, str(tmp_path / "b"))})
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1
    sinks.write_csv(log, str(tmp_path / "csv"), ["k", "pos"])
    assert files.read_csv(spark, str(tmp_path / "csv") + "/*.csv").columns == ["k", "pos"]


def test_reports(spark):
    df = spark.createDataFrame([("a|b", None)], "x string, y string")
    assert sinks.report_table(df, ["x", "y"], ["x"]).split("\n")[2] == "| a/b |  |"
    md = df.select(sinks.document_markdown(F.col("x"), F.lit("s"), F.lit(None).cast("string"), F.lit(""), F.lit(" "))).first()[0]
    assert md == "# a|b\n\n- Source: s\n\n(no content)"


def test_page_source(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>x")
    spark.dataSource.register(PageSource)
    got = spark.read.format("pages").load(str(tmp_path)).collect()
    assert [(r["status"], r["body"]) for r in got] == [(200, "<p>x")]
    q = seen.run_to_table(spark.readStream.format("pages").load(str(tmp_path)), "page_stream", "append", str(tmp_path.parent / "cp"))
    assert spark.table("page_stream").count() == 1 and not q.isActive
    # A file that comes later under a name that sorts earlier is taken once, and none is taken again.
    (tmp_path / "0.html").write_text("<p>y")
    os.utime(tmp_path / "0.html", (2_000_000_000, 2_000_000_000))
    seen.run_to_table(spark.readStream.format("pages").option("filesPerPartition", 1).load(str(tmp_path)), "page_stream_2", "append", str(tmp_path.parent / "cp2"))
    assert spark.table("page_stream_2").count() == 2
    reader = connector.PageStreamReader({"path": str(tmp_path), "filesPerPartition": "1"})
    end = reader.latestOffset()
    (tmp_path / "00.html").write_text("<p>z")
    os.utime(tmp_path / "00.html", (2_000_000_001, 2_000_000_001))
    new = [p for part in reader.partitions(end, reader.latestOffset()) for p in part.paths]
    assert [os.path.basename(p) for p in new] == ["00.html"] and len(reader.partitions(reader.initialOffset(), end)) == 2


def test_streams_equal_batches(spark, tmp_path):
    events = [(i, f"u{i % 7}", i % 3 == 0) for i in range(60)]
    df = spark.createDataFrame(events, "i long, k string, bad boolean")
    for n in range(3):
        df.filter((F.col("i") >= 20 * n) & (F.col("i") < 20 * n + 20)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen.run_to_table(seen.first_seen_stream(stream, "k", "i"), "firsts", "append", str(tmp_path / "c1"))
    got = {r["k"]: r["n"] for r in spark.table("firsts").groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {f"u{i}": 1 for i in range(7)}
    seen.run_to_table(seen.failure_streaks(stream, "k", "i", F.col("bad")), "streaks", "update", str(tmp_path / "c2"))
    last = {r["k"]: r["rows"] for r in latest_last_wins(spark.table("streaks"), ["k"], "rows").collect()}
    assert sum(last.values()) == 60


def test_upsert_stream(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    t = sinks.VersionedTable(spark, str(tmp_path / "t"))
    t.replace(spark.createDataFrame([("a", 0), ("c", 3)], "k string, v int"))
    merge = lambda cur, new: cur.join(new.select("k"), "k", "left_anti").unionByName(new)
    seen.upsert_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), t, str(tmp_path / "cp"), merge).awaitTermination()
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_files_and_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("x\n\n  \ny\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.md").write_text("# b")
    assert [(os.path.basename(r["path"]), r["lines"]) for r in files.line_counts(spark, str(tmp_path / "*.jsonl")).collect()] == [("a.jsonl", 2)]
    wanted = spark.createDataFrame([(1, "a.jsonl"), (2, "sub/b.md"), (3, "sub/c.md"), (4, "c")], "i int, p string")
    assert sorted(r["i"] for r in files.missing_files(spark, wanted, "p", str(tmp_path)).collect()) == [3, 4]
    log = spark.createDataFrame([("s", 1, "T", "", None), ("s", 2, "U", "u", None), ("s", 3, "V", "v", "w"), ("s", 4, "W", "x", "y"), ("t", 5, None, "z", "")], "source string, pos int, title string, url string, canonical_url string")
    assert sorted((r["source_id"], r["url"]) for r in files.archive_candidates(log, 2).collect()) == [("s", "u"), ("s", "w"), ("t", "z")]


def test_dispatch_and_fetches(spark):
    sources = spark.createDataFrame([("a", "rss"), ("b", "list"), ("c", "odd"), ("d", None)], "source_id string, source_type string")
    pages = spark.createDataFrame([("a", RSS), ("b", "<article><h2><a href='/p'>Some title</a></h2></article>"), ("c", "x")], "source_id string, body string")
    ways = {"rss": lambda p: payloads.feed_candidates(p, ["source_id"], "body").select("source_id", "title"), "list": lambda p: p.select("source_id", F.explode(html.items_udf("article_list")("body", F.lit("https://h"))).alias("e")).select("source_id", "e.title")}
    found, rest = connector.dispatch(sources, pages, ways)
    assert sorted(tuple(r) for r in found.collect()) == [("a", "One"), ("a", "Two"), ("b", "Some title")]
    assert sorted((r["source_id"], r["error"]) for r in rest.collect()) == [("c", "unsupported source_type: odd"), ("d", "unsupported source_type: ")]
    fetched = connector.fetched(spark.createDataFrame([("u",), ("v",), ("w",), ("x",)], "url string"), spark.createDataFrame([("u", 200, None, "Members only"), ("v", 429, None, "slow"), ("w", 0, "timed out", None)], "url string, status int, error string, body string"))
    got = {r["url"]: (r["error_type"], r["retryable"], r["access_denied"]) for r in fetched.collect()}
    assert got == {"u": (None, False, True), "v": ("http_4xx", True, False), "w": ("timeout", True, False), "x": ("unknown", False, False)}


def test_probes(spark):
    ld = "<html><head><script type='application/ld+json'>{\"@type\": \"Article\"}</script><meta property='og:title' content='x'><link rel='canonical' href='c'></head></html>"
    rows = [(0, ld), (1, "<?xml version='1.0'?><rss/>"), (2, "<urlset/>"), (3, None)]
    got = [r[0] for r in spark.createDataFrame(rows, "i int, b string").orderBy("i").select(connector.page_signals(F.col("b"))).collect()]
    assert [g["kind"] for g in got] == ["page", "feed", "sitemap", "empty"] and (got[0]["json_ld"], got[0]["json_ld_types"], got[0]["open_graph"], got[0]["canonical"]) == (1, ["Article"], 1, 1)
    sites = spark.createDataFrame([("https://h.org/a/b",), ("nothing",)], "site string")
    assert sorted(r["url"] for r in connector.feed_probes(sites, "site").collect()) == sorted("https://h.org" + p for p in connector.FEED_PATHS)
    raw = [("é".encode("latin-1"), "text/html; charset=ISO-8859-1"), ("é".encode(), None), (b"<meta charset='latin1'>\xe9", ""), (b"\xff", "text/html"), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(raw)], "i int, b binary, c string")
    assert [r[0] for r in df.orderBy("i").select(connector.decoded(F.col("b"), F.col("c"))).collect()] == ["é", "é", "<meta charset='latin1'>é", "\ufffd", None]
    body = "".join(f"<a href='/report/{i}'>" for i in range(9)) + "<a href='/about'>"
    assert spark.createDataFrame([(body,)], "b string").select(connector.probe_links(F.col("b"), ["report"])).first()[0] == 5


TABLE = "<table><tr><th>Date</th><th>Company</th><th>Rating From</th><th>Rating To</th><th>Target To</th><th>Other</th></tr><tr><td>2024-01-02</td><td>N <b>Co</b></td><td>Hold</td><td>Buy</td><td>$5</td><td>z</td></tr><tr><td></td></tr></table>"
EVENTS = "<div class='event'><h3>Autumn day</h3><span class='event-date'>2024-05-06</span><span class='company'>N Co</span><a href='/e/1'>Details</a><a href='/e/1/transcript'>Read the transcript</a><a href='/s.PDF'>Slides</a></div><div class='event'><a href='/e/1'>again</a></div><div class='x'><a href='/no'>none</a></div>"


def test_tables_and_typed_items(spark):
    df = spark.createDataFrame([(1, TABLE), (2, "<p>none"), (3, None)], "i int, b string")
    got = payloads.named_table_rows(df, ["i"], "b").orderBy("row").collect()
    assert [(r["date"], r["company"], r["rating_from"], r["rating_to"], r["price_target_to"], r["rating"], r["broker"]) for r in got] == [("2024-01-02", "N Co", "Hold", "Buy", "$5", None, None), (None,) * 7]
    items = html.typed_items(EVENTS, "https://h.org", "conference")
    assert [(i["title"], i["url"], i["document_kind"], i["transcript_url"], i["pdf_url"], i["fields"]) for i in items] == [("Autumn day", "https://h.org/e/1", "transcript", "https://h.org/e/1/transcript", "https://h.org/s.PDF", {"event_date": "2024-05-06", "company": "N Co"})]
    udf = spark.createDataFrame([(EVENTS,), (None,), ("",)], "b string").select(html.typed_items_udf("conference")("b", F.lit("https://h.org")).alias("x")).collect()
    assert [len(r["x"]) for r in udf] == [1, 0, 0]
    ir = "<a href='/news/2024/05/06/results'>Results of the first quarter</a><a href='/news/x'>Short</a><a href='https://other.org/news/y'>A long enough title here</a><a href='/news/z'>A long enough title here</a> May 7, 2024"
    assert [(i["url"], i["published"]) for i in html.investor_items(ir, "https://ir.h.org", ("h.org",), ("news",))] == [("https://ir.h.org/news/2024/05/06/results", "2024/05/06"), ("https://ir.h.org/news/z", "May 7, 2024")]
    assert html.rewrite_html_images("<p><img data-src='a' src='l'><img src=\"b\"><img src='c'>", {"a": "1.png", "b": "2.png"}) == '<p><img src="1.png"><img src="2.png"><img src=\'c\'>'
    names = spark.createDataFrame([("https://x/a.PNG?q", None), ("https://x/b", "image/gif"), ("https://x/c", None)], "u string, k string").select(urls.image_name(F.col("u"), F.col("k"))).collect()
    assert [r[0][16:] for r in names] == [".png", ".gif", ".jpg"]
    podcast = "<rss><channel><item><title>E</title><link>https://x/e</link><link href='https://x/t' type='text/plain'/><duration>1:02</duration></item></channel></rss>"
    got = payloads.feed_candidates(spark.createDataFrame([("p", podcast)], "k string, b string"), ["k"], "b").first()
    assert (got["transcript"], got["duration"]) == ("https://x/t", "1:02")


def test_archives_and_reports(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "documents/2024/05/2024-05-06__s__T", "T", "S", "2024-05-06", "u", "body", "<p>", None, "h")], "document_id string, path string, title string, source_name string, published_at string, url string, text string, html string, raw string, content_hash string")
    index = sinks.archive_documents(docs, str(tmp_path / "a")).first()
    assert index["markdown_path"].endswith("/document.md") and index["raw_path"] is None
    assert spark.read.parquet(str(tmp_path / "a" / "markdown")).first()["body"].startswith("# T") and spark.read.json(str(tmp_path / "a" / "index")).count() == 1
    filings = spark.createDataFrame([("k", "h", "{}", "t"), ("l", "i", None, "u")], "canonical_key string, content_hash string, raw string, title string")
    assert sinks.archive_filings(filings, str(tmp_path / "f")).columns == ["canonical_key", "content_hash", "title"] and spark.read.parquet(str(tmp_path / "f" / "raw")).count() == 1
    files_ = spark.createDataFrame([("k" * 70, "text", bytearray(b"x"), "s")], "canonical_key string, text string, content binary, source_id string")
    assert sinks.archive_extracted(files_, str(tmp_path / "x")).first()["raw_path"] == "raw/" + "k" * 64
    r = sinks.Report().heading("H", 9).text("t").bullets(["a", "b"]).code("c", "py").rule().table(filings, ["title"], ["title"]).build()
    assert r.startswith("###### H\n\nt\n\n- a\n- b\n\n```py\nc\n```\n\n---\n\n| title |") and r.endswith("2 rows\n")


def test_runs(spark, tmp_path):
    files_ = spark.createDataFrame([("s", 1, ".md", bytearray(b"# A title of some length\n\nand **body**")), ("s", 2, ".md", bytearray(b"# A title of some length\n\nand **body**")), ("s", 3, ".pdf", bytearray(b"%PDF")), ("s", 4, ".html", bytearray(b"<article><p>A paragraph that is long enough to count.</p></article>")), ("s", 5, ".txt", None), ("s", 6, ".txt", bytearray(b"short")), ("s", 7, None, bytearray(b"x"))], "source_id string, pos int, extension string, content binary")
    got = {r["pos"]: (r["outcome"], r["error"]) for r in pipelines.documents_run(files_, None).collect()}
    assert got == {1: ("saved", None), 2: ("duplicate", None), 3: ("failed", "no extractor for .pdf"), 4: ("saved", None), 5: ("failed", "no content"), 6: ("partial", None), 7: ("failed", "no extractor for none")}
    steps = pipelines.Steps(spark, str(tmp_path), "r1")
    calls = []
    build = lambda: calls.append(1) or spark.range(3).toDF("a")
    assert steps.run("one", build).count() == 3 and pipelines.Steps(spark, str(tmp_path), "r1").run("one", build).count() == 3 and len(calls) == 1
    assert [tuple(r) for r in steps.log(["one", "two"]).orderBy("position").collect()] == [(0, "one", True, 3), (1, "two", False, None)]
    queue = spark.createDataFrame([("s", 1, "A", "https://h/a", None, "x", True, 0), ("s", 2, "B", "https://h/b", None, "x", True, 1), ("s", 3, "C", "https://h/c", None, "x", False, 2)], "source_id string, pos int, title string, url string, published string, error string, retryable boolean, retry_count int")
    pages = spark.createDataFrame([("https://h/a", "w " * 1000, "P", None)], "url string, text string, title string, error string")
    seen_ = spark.createDataFrame([("x", "y", "saved", 1)], "url_hash string, title_hash string, status string, last_seen_at int")
    run, left = pipelines.retry_failed(queue, seen_, pages, "r2", "2024-05-01")
    assert run.documents.count() == 1 and sorted((r["pos"], r["retry_count"], r["error"]) for r in left.collect()) == [(2, 2, "no content fetched"), (3, 2, "x")]
    providers = spark.createDataFrame([("a", 2, True), ("b", 1, True), ("c", 0, False)], "name string, priority int, available boolean")
    asked = spark.createDataFrame([(None,), ("a",), ("c",)], "provider string")
    assert sorted(((r["chosen"], r["error"]) for r in joins.first_available(asked, providers).collect()), key=str) == [("a", None), ("b", None), (None, "no_provider")]
