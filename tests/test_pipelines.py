from pyspark.sql import functions as F

from veldspar.functions import urls
from veldspar.plans import pipelines


def test_archive_run(spark):
    c = spark.createDataFrame(
        [("s", 1, "A", "https://h/a", "2024-01-02"), ("s", 2, "A again", "https://H/a/?utm_source=x", None), ("s", 3, "B", "https://h/b", None), ("s", 4, "C", "https://h/c", None), ("t", 5, "D", "https://h/d", None), ("t", 6, None, None, None)],
        "source_id string, pos int, title string, url string, published string",
    )
    seen = spark.createDataFrame([("x", "y", "saved", 1)], "url_hash string, title_hash string, status string, last_seen_at int")
    pages = spark.createDataFrame([("https://h/a", "w " * 1000, "Page A", None), ("https://h/b", "short", "", None), ("https://h/d", None, None, "Read timed out")], "url string, text string, title string, error string")
    run = pipelines.archive_run(c, seen, pages, "r", "2024-05-01")
    assert {r["pos"]: r["outcome"] for r in run.outcomes.collect()} == {1: "saved", 2: "duplicate", 3: "partial", 4: "failed", 5: "failed", 6: "failed"}
    assert sorted(r["error_class"] for r in run.failed.collect()) == ["fetch_error", "fetch_error", "unknown_error"]
    docs = {r["pos"]: (r["title"], r["path"]) for r in run.documents.collect()}
    assert docs[1] == ("Page A", "documents/2024/01/2024-01-02__s__Page-A") and docs[3][0] == "B"
    assert {r["source_id"]: r["status"] for r in run.health.collect()} == {"s": "degraded", "t": "failed"}
    s = run.summary.first()
    assert (s["candidates"], s["saved"], s["partial"], s["failed"], s["duplicates"], s["skipped"]) == (6, 1, 1, 3, 1, 0)


def test_a_failed_first_attempt_lets_the_next_one_through(spark):
    rows = [("s", 1, "F", "https://h/f"), ("s", 2, "F2", "https://h/f"), ("s", 3, "T", "https://h/gone"), ("s", 4, "T", "https://h/t1"), ("s", 5, "T", "https://h/t2"), ("s", 6, "T", "https://h/gone"), ("u", 7, "T", "https://h/t3"),
            ("s", 8, "O", "https://h/old"), ("s", 9, "P", "https://h/old"), ("s", 10, "T", "https://h/retry"), ("s", 11, "Cand", "https://h/c1"), ("s", 12, "Cand", "https://h/c2"), ("s", 13, "Page", "https://h/c3"), ("s", 14, None, None), ("s", 15, None, None)]
    c = spark.createDataFrame(rows, "source_id string, pos int, title string, url string").selectExpr("*", "cast(null as string) as published")
    at = lambda u: spark.range(1).select(urls.url_hash(urls.url_without_tracking(F.lit(u)))).first()[0]
    seen = spark.createDataFrame([(at("https://h/old"), "-", "saved", 1), (at("https://h/retry"), "-", "failed", 1)], "url_hash string, title_hash string, status string, last_seen_at int")
    pages = spark.createDataFrame([(f"https://h/{p}", "w " * 1000, "Page" if p == "c1" else None, None) for p in ("t1", "t2", "t3", "old", "retry", "c1", "c2", "c3")], "url string, text string, title string, error string")
    run = pipelines.archive_run(c, seen, pages, "r", "2024-05-01")
    got = {r["pos"]: r["outcome"] for r in run.outcomes.collect()}
    assert got == {1: "failed", 2: "failed", 3: "failed", 4: "saved", 5: "duplicate", 6: "duplicate", 7: "saved", 8: "skipped", 9: "skipped", 10: "saved", 11: "saved", 12: "saved", 13: "duplicate", 14: "failed", 15: "failed"}
    assert run.failed.count() == 5
