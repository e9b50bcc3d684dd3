from datetime import date

from pyspark.sql import functions as F

from veldspar.functions import dates, html, urls
from veldspar.operators import joins
from veldspar.sources import files, sinks


def test_dated_anchors():
    page = "<li>2024-05-01 <a href='/a/one'>First article here</a></li>" + "x" * 300 + "<a href='/about/us'>About this company</a><a href=/b>Second one here</a> May 3, 2024 <a href='/b'>Second one again</a><a href='#x'>Skip to content</a>"
    got = html.dated_anchors(page, "https://h/")
    assert [(x["url"], x["published"]) for x in got] == [("https://h/a/one", "2024-05-01"), ("https://h/b", "May 3, 2024")]
    assert html.dated_anchors(None) == [] and len(html.dated_anchors(page, "https://h/", limit=1)) == 1


def test_containers_and_blocks():
    assert html.best_container("<div class=content>ab</div><div id=post><img><img>c</div>") == "c"
    assert html.best_container("<p>only</p>") == "only" and html.best_container(None) == ""
    assert html.without_blocks("keep\nscan the code\nlike\nI like long lines of text", ["scan"], 6, ["like"]) == "keep\nI like long lines of text"


def test_extensions_and_keys(spark):
    df = spark.createDataFrame([("PDF", None, None, None), (None, "a/b.MD?x", None, None), ("", None, '{"url": "q.html"}', None), (None, None, None, "text/plain"), (None, None, None, None)], "e string, p string, j string, m string")
    assert [r[0] for r in df.select(urls.record_extension(F.col("e"), [F.col("p")], F.col("j"), F.col("m"))).collect()] == [".pdf", ".md", ".html", ".txt", None]
    assert urls.request_key({"b": 1, "a": "x"}) == urls.request_key({"a": "x", "b": 1})


def test_freshness(spark):
    df = spark.createDataFrame([(date(2024, 5, 1),), (date(2024, 1, 1),), (date(2025, 1, 1),), (None,)], "d date")
    assert [r[0] for r in df.select(dates.freshness(F.col("d"), F.lit("2024-05-10"))).collect()] == ["fresh", "stale", "unknown", "unknown"]


def test_providers(spark):
    p = spark.createDataFrame([("b", 2, True), ("a", 1, False), ("c", 3, True)], "name string, priority int, available boolean")
    r = spark.createDataFrame([(1, None), (2, "c"), (3, "a")], "i int, provider string")
    assert [(x["i"], x["chosen"], x["error"]) for x in joins.first_available(r, p).orderBy("i").collect()] == [(1, "b", None), (2, "c", None), (3, None, "no_provider")]
    assert joins.first_available(r, p.limit(0)).filter("error is not null").count() == 3


def test_files_and_manifest(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    assert files.latest_file(spark, str(tmp_path)).collect()[0]["path"].endswith("a.txt")
    m = sinks.manifest(files.scan_documents(spark, str(tmp_path)), "r1", "2024").first()
    assert (m["n"], m["bytes"]) == (1, 1) and "sha256" in m["files"]
    rows = spark.createDataFrame([("https://a/b", "", "note"), ("bad", None, None)], "url string, text string, notes string")
    good, bad = files.signals_of_urls(rows)
    assert [r["raw_text"] for r in good.collect()] == ["note"] and [r["problem"] for r in bad.collect()] == ["scheme"]
