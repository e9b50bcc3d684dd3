"""Queries of listings, checks, audits and reports, and of markup that is made of the tables and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, urls
from ..functions import text as tx
from ..operators import dedupe, filters, joins, rollup, state
from ..runtime import materialize, table
from ..sources import payloads
from .dedupe_queries import CANON, WS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("keyword_hits", "SELECT doc_id, array_to_string(list_filter(['guidance', 'dividend', 'Buyback', 'audit'], lambda k: contains(lower(text), lower(k))), ',') AS hits FROM documents")
def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(filters.keyword_hits(F.col("text"), ["guidance", "dividend", "Buyback", "audit"]), ",").alias("hits"))


@query("only_listed", "SELECT ingest_seq FROM candidate_item WHERE source IN (SELECT source_id FROM inventory_source WHERE enabled_by_default)")
def only_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.only_listed(table(spark, sf_dir, "candidate_item"), "source", table(spark, sf_dir, "inventory_source").filter("enabled_by_default"), "source_id").select("ingest_seq")


@query("records_of_kind", "SELECT event_id FROM events WHERE event_type = 'error' AND strftime(ts, '%Y-%m-%d') LIKE '2024-01-1%'")
def records_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.records_of_kind(table(spark, sf_dir, "events"), "event_type", "error", F.date_format("ts", "yyyy-MM-dd"), "2024-01-1").select("event_id")


@query("status_listing", "SELECT document_id, CASE lower(status) WHEN 'failed' THEN 0 WHEN 'partial' THEN 1 WHEN 'saved' THEN 2 ELSE 99 END AS position FROM seen_documents")
def status_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.by_status(table(spark, sf_dir, "seen_documents"), "status", ["FAILED", "partial", "saved"]).select("document_id", "position")


@query("missing_references", "SELECT DISTINCT source_id, url AS reference FROM content_candidate WHERE url <> '' AND url NOT IN (SELECT url FROM extracted_page)")
def missing_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "content_candidate").groupBy("source_id").agg(F.collect_set("url").alias("urls"))
    return filters.missing_references(c, "source_id", "urls", table(spark, sf_dir, "extracted_page"), "url")


@query("limit_before_distinct", f"""WITH c AS (SELECT source, ingest_seq, {CANON} AS url FROM (SELECT source, ingest_seq, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\\?$', '') AS u FROM candidate_item)), p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ingest_seq) AS rn FROM c)
SELECT source, min(ingest_seq) AS ingest_seq FROM p WHERE rn <= 40 GROUP BY source, url""")
def limit_before_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidate_item").select("source", "ingest_seq", urls.canonical_url(F.col("url")).alias("url"))
    return filters.prefix_then_distinct(c, ["source"], ["ingest_seq"], 40, "url").select("source", "ingest_seq")


@query("example_domain_filter", r"SELECT ingest_seq FROM (SELECT ingest_seq, regexp_replace(lower(regexp_extract(trim(url), '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), '^[w.]+', '') AS d FROM candidate_item) WHERE d NOT IN ('example.com', 'example.org', 'example.net')")
def example_domain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidate_item").filter(~urls.is_example_domain(urls.domain(F.col("url")))).select("ingest_seq")


@query("multi_predicate_list", "SELECT doc_id FROM documents WHERE doc_type = 'news' AND strftime(collected_at, '%Y-%m') >= '2024-01' AND strftime(collected_at, '%Y-%m-%d') <= '2025-06-30' AND lang = 'en'")
def multi_predicate_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_type").alias("status"), "lang", F.date_format("collected_at", "yyyy-MM-dd").alias("captured_at"))
    return filters.matching(d, status="news", captured=("2024-01", "2025-06-30"), equal={"lang": "en"}).select("doc_id")


@query("unconsumed_limit_first", "SELECT ingest_seq FROM (SELECT ingest_seq, signal_id FROM raw_signal ORDER BY ingest_seq DESC LIMIT 200) WHERE signal_id NOT IN (SELECT json_extract_string(metadata, '$.signal_id') FROM seen_signal WHERE json_extract_string(metadata, '$.signal_id') IS NOT NULL)")
def unconsumed_limit_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = table(spark, sf_dir, "seen_signal").select(F.get_json_object("metadata", "$.signal_id").alias("signal_id"), F.lit("seen").alias("consumer")).dropna(subset=["signal_id"])
    return state.unconsumed(table(spark, sf_dir, "raw_signal").select("ingest_seq", "signal_id"), receipts, "signal_id", "seen", 200, [F.desc("ingest_seq")]).select("ingest_seq")


@query(
    "audited_inventory",
    """WITH a AS (SELECT source_id, arg_max(language, ingest_seq) AS language FROM raw_signal WHERE collector = 'web_page' GROUP BY 1)
SELECT i.source_id, i.enabled_by_default AS is_operational, CASE WHEN NOT i.enabled_by_default THEN 'inventory' WHEN a.source_id IS NULL THEN 'pending' ELSE 'deep' END AS scope, coalesce(CASE WHEN i.enabled_by_default THEN a.language END, 'not_audited') AS language FROM inventory_source i LEFT JOIN a USING (source_id)""",
)
def audited_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "inventory_source")
    audits = table(spark, sf_dir, "raw_signal").filter("collector = 'web_page'").select("source_id", "ingest_seq", "language")
    return joins.audited(i.select("source_id"), audits, "source_id", "ingest_seq", {"language": "not_audited"}, i.filter("enabled_by_default"))


@query(
    "bound_records",
    """WITH r AS (SELECT doc_id AS record, CASE WHEN doc_id % 3 = 0 THEN '.pdf' ELSE '.html' END AS extension, doc_type AS source_type, source AS source_id FROM documents), s AS (SELECT min(source) AS one, max(source) AS two FROM documents)
SELECT 'pdf' AS capability_id, record, false AS binds_all FROM r WHERE extension = '.pdf' UNION ALL SELECT 'news', record, false FROM r WHERE source_type = 'news' UNION ALL SELECT 'all', NULL, true UNION ALL SELECT 'soft', record, false FROM r WHERE source_id = (SELECT one FROM s)
UNION ALL SELECT 'both', record, false FROM r WHERE source_type = 'news' AND (source_id IN (SELECT two FROM s) OR NOT EXISTS (SELECT 1 FROM r WHERE source_type = 'news' AND source_id IN (SELECT two FROM s)))""",
)
def bound_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    r = d.select(F.col("doc_id").alias("record"), F.when(F.col("doc_id") % 3 == 0, ".pdf").otherwise(".html").alias("extension"), F.col("doc_type").alias("source_type"), F.col("source").alias("source_id"))
    one, two = d.agg(F.min("source"), F.max("source")).first()
    rows = [("pdf", [".pdf"], ["news"], []), ("docx", [".docx"], ["news"], []), ("news", [], ["news"], []), ("all", [], [], []), ("soft", [], ["no such"], [one]), ("both", None, ["news"], [two])]
    return joins.bound_records(spark.createDataFrame(rows, "capability_id string, file_extensions array<string>, source_types array<string>, source_ids array<string>"), r, "record")


@query("zero_filled_accounts", "SELECT source_id, count(*) FILTER (s.status = 'saved') AS saved, count(*) FILTER (s.status = 'failed') AS failed FROM inventory_source i LEFT JOIN (SELECT source_id, status FROM seen_documents WHERE error IS NOT NULL) s USING (source_id) GROUP BY 1")
def zero_filled_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "seen_documents").filter("error is not null")
    return rollup.zero_filled(table(spark, sf_dir, "inventory_source"), "source_id", s, {"saved": F.col("status") == "saved", "failed": F.col("status") == "failed"})


@query("average_length", "SELECT coalesce(avg(length(raw_text)), 0.0) AS average FROM raw_signal")
def average_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.average(table(spark, sf_dir, "raw_signal"), F.length("raw_text"))


@query("latest_overall", "SELECT signal_id FROM raw_signal ORDER BY coalesce(published_at, '') DESC, ingest_seq LIMIT 1")
def latest_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.latest_overall(table(spark, sf_dir, "raw_signal").select("signal_id", "published_at", "ingest_seq"), "published_at", "ingest_seq").select("signal_id")


@query("recent_runs", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(20).select("event_id")


@query("distinct_days", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events ORDER BY 1")
def distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct().orderBy("day")


@query("last_rows_summary", "SELECT count(*) FILTER (status = 'saved') AS saved_count, count(*) FILTER (status = 'failed') AS failed_count, (SELECT count(DISTINCT source_id) FROM seen_documents) AS keys, (SELECT max(document_id) FROM seen_documents) AS last_position FROM (SELECT status FROM seen_documents ORDER BY document_id DESC LIMIT 8)")
def last_rows_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.last_rows_summary(table(spark, sf_dir, "seen_documents"), "document_id", "status", ["saved", "failed"], "source_id")


@query(
    "yield_metrics",
    """WITH c AS (SELECT source, url, row_number() OVER (PARTITION BY item_id ORDER BY ingest_seq) = 1 AS u, url IN (SELECT url FROM extracted_page WHERE text <> '') AS e FROM candidate_item), g AS (SELECT source, count(*) AS total_fetched, count(*) FILTER (u) AS total_after_dedupe, count(*) FILTER (u AND e) AS total_extracted FROM c GROUP BY 1)
SELECT *, round(total_extracted / total_fetched, 6) AS yield_rate, CASE WHEN total_extracted = 0 THEN 'failed' WHEN total_extracted < total_after_dedupe THEN 'partial' ELSE 'success' END AS status FROM g""",
)
def yield_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = dedupe.mark_first(table(spark, sf_dir, "candidate_item").select("source", "item_id", "ingest_seq", "url"), F.col("item_id"), ["ingest_seq"])
    pages = table(spark, sf_dir, "extracted_page").filter("text <> ''").select("url").distinct().withColumn("got", F.lit(True))
    return rollup.yield_metrics(c.join(pages, "url", "left"), "source", F.col("is_first"), F.coalesce("got", F.lit(False)))


@query("provider_summary", "SELECT count(*) AS total, count(*) FILTER (enabled_by_default) AS available, count(*) FILTER (NOT enabled_by_default) AS missing, arg_min(source_id, priority || source_id) FILTER (enabled_by_default) AS preferred FROM inventory_source")
def provider_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "inventory_source").select(F.col("source_id").alias("name"), F.concat("priority", "source_id").alias("priority"), F.col("enabled_by_default").alias("available"))
    return rollup.provider_summary(p)


@query("document_paths", "SELECT DISTINCT url AS path FROM documents WHERE url <> '' ORDER BY 1")
def document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "documents").groupBy("source", "doc_type").agg(F.collect_list("url").alias("docs"))
    return lists.select(F.explode("docs").alias("path")).filter("path <> ''").distinct().orderBy("path")


@query(
    "state_rollup",
    "SELECT count(*) AS total, count(*) FILTER (status = 'saved') AS saved_count, round(count(*) FILTER (status = 'saved') / count(*) * 100, 1) AS saved_pct, count(*) FILTER (status = 'failed') AS failed_count, round(count(*) FILTER (status = 'failed') / count(*) * 100, 1) AS failed_pct, count(*) FILTER (retry_count > 1) AS attention_count, count(*) FILTER (title IS NOT NULL) AS used_count, count(*) FILTER (title IS NULL) AS unused_count FROM seen_documents",
)
def state_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.state_rollup(table(spark, sf_dir, "seen_documents"), "status", ["saved", "failed"], {"attention": F.col("retry_count") > 1}, F.col("title").isNotNull())


@query("day_report", "SELECT coalesce(nullif(status, ''), 'saved') AS status, count(*) AS n FROM (SELECT CASE WHEN document_id LIKE '%7' THEN NULL ELSE status END AS status, first_seen_at FROM seen_documents) WHERE strftime(first_seen_at, '%Y-%m-%d') = (SELECT max(strftime(first_seen_at, '%Y-%m-%d')) FROM seen_documents) GROUP BY 1 UNION ALL SELECT 'queued', count(*) FROM seen_documents WHERE status = 'failed' AND strftime(last_seen_at, '%Y-%m-%d') = (SELECT max(strftime(first_seen_at, '%Y-%m-%d')) FROM seen_documents)")
def day_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "seen_documents")
    day = s.agg(F.max(F.date_format("first_seen_at", "yyyy-MM-dd"))).first()[0]
    log = s.withColumn("status", F.when(~F.col("document_id").endswith("7"), F.col("status")))
    return rollup.day_report(log, F.date_format("first_seen_at", "yyyy-MM-dd"), "status", s.filter("status = 'failed'"), F.date_format("last_seen_at", "yyyy-MM-dd"), day)


@query("duplicate_files", "SELECT doc_id, row_number() OVER (PARTITION BY source || '::' || sha256(text) ORDER BY doc_id) > 1 AS is_duplicate FROM documents")
def duplicate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = materialize(table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("bytes")), "files")
    return dedupe.known_files(d, "source", F.col("bytes"), "doc_id").select("doc_id", "is_duplicate")


@query(
    "search_normalised",
    f"""WITH c AS (SELECT ingest_seq, lower(regexp_extract(trim(url), '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)) AS h, {CANON} AS k FROM (SELECT ingest_seq, url, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\\?$', '') AS u FROM candidate_item))
SELECT min(ingest_seq) AS rank, arg_min(regexp_replace(h, '^[w.]+', ''), ingest_seq) AS domain FROM c WHERE regexp_replace(h, '^[w.]+', '') NOT IN ('example.com', 'example.org', 'example.net') GROUP BY k""",
)
def search_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidate_item").select(F.col("ingest_seq").alias("rank"), "url")
    return payloads.normalised_results(c).select("rank", "domain")


@query(
    "filings_run",
    """WITH f AS (SELECT *, substring(sha256(coalesce(filing_title, '') || '||' || coalesce(filing_date, '') || '||' || coalesce(document_url, '') || '||' || coalesce(pdf_url, '') || '||' || coalesce(html_url, '')), 1, 32) AS h,
 source_type || '|' || issuer_code || '|' || coalesce(filing_date, '') || '|' || filing_type || '|' || coalesce('acc:' || nullif(accession_number, ''), 'ann:' || nullif(announcement_id, ''), 'url:' || nullif(document_url, ''), 'pdf:' || nullif(pdf_url, ''), 'title_hash:' || substring(sha256(filing_title), 1, 16)) AS k FROM filing_candidate),
g AS (SELECT *, row_number() OVER w AS rn, lag(h) OVER w AS p FROM f WHERE raw_entry IS NOT NULL WINDOW w AS (PARTITION BY k ORDER BY ingest_seq)),
o AS (SELECT source_id, CASE WHEN rn = 1 THEN 'saved' WHEN p = h THEN 'duplicate' ELSE 'updated' END AS outcome FROM g UNION ALL SELECT source_id, 'failed' FROM f WHERE raw_entry IS NULL)
SELECT source_id, count(*) AS candidates, count(*) FILTER (outcome = 'saved') AS saved, count(*) FILTER (outcome = 'updated') AS updated, count(*) FILTER (outcome = 'duplicate') AS duplicates, count(*) FILTER (outcome = 'failed') AS failed FROM o GROUP BY 1""",
)
def filings_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filing candidates as one run, by source; the stored entry is the response."""
    from . import pipelines

    return pipelines.filings_run(table(spark, sf_dir, "filing_candidate").withColumnRenamed("raw_entry", "response"), None, "run").health.drop("status")


@query(
    "inventory_run",
    """SELECT i.source_id, count(p.page_id) AS pages, count(p.page_id) FILTER (p.text <> '') AS with_text, CASE WHEN NOT i.enabled_by_default THEN 'disabled' WHEN count(p.page_id) = 0 THEN 'not_visited' WHEN count(p.page_id) FILTER (p.text <> '') = 0 THEN 'failed' WHEN count(p.page_id) FILTER (p.text <> '') < count(p.page_id) THEN 'partial' ELSE 'success' END AS status
FROM inventory_source i LEFT JOIN extracted_page p ON p.source_id = i.source_id AND i.enabled_by_default GROUP BY i.source_id, i.enabled_by_default""",
)
def inventory_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pipelines

    return pipelines.inventory_run(table(spark, sf_dir, "inventory_source").select("source_id", F.col("enabled_by_default").alias("enabled")), table(spark, sf_dir, "extracted_page").select("source_id", "text"))


@query(
    "documents_run",
    f"""WITH d AS (SELECT doc_id, source, text, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS t, row_number() OVER (PARTITION BY source, sha256(text) ORDER BY doc_id) AS rn FROM documents)
SELECT source AS source_id, count(*) AS candidates, count(*) FILTER (rn = 1 AND length(t) >= 30) AS saved, count(*) FILTER (rn = 1 AND length(t) < 30) AS partial, count(*) FILTER (rn > 1) AS duplicates, 0 AS failed FROM d GROUP BY 1""",
)
def documents_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as text files of an extraction run, by source."""
    from . import pipelines

    d = table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.col("doc_id").alias("pos"), F.lit(".txt").alias("extension"), F.encode("text", "UTF-8").alias("content"))
    return pipelines.documents_run(d, None).groupBy("source_id").agg(F.count(F.lit(1)).alias("candidates"), *[F.count_if(F.col("outcome") == o).alias(n) for o, n in (("saved", "saved"), ("partial", "partial"), ("duplicate", "duplicates"), ("failed", "failed"))])


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _plain(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '[\\s\\x{{0B}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')), '')"


ITEM_KEY = "(ingest_seq // 50)"


@query("rss_round_trip", f"SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY ingest_seq) - 1 AS INTEGER) AS pos, {_plain('title')} AS title, {_plain('url')} AS link, {_plain('published')} AS published FROM (SELECT {ITEM_KEY} AS page, * FROM candidate_item)")
def rss_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of fifty items each, made of the candidate items and read back."""
    c = table(spark, sf_dir, "candidate_item").withColumn("page", F.floor(F.col("ingest_seq") / 50))
    tag = lambda name, v: F.concat(F.lit(f"<{name}>"), _escaped(v), F.lit(f"</{name}>"))
    item = F.concat(F.lit("<item>"), tag("title", F.col("title")), tag("link", F.col("url")), F.coalesce(tag("pubDate", F.col("published")), F.lit("")), F.lit("</item>"))
    pages = c.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ingest_seq", item.alias("x")))).alias("i"))
    body = F.concat(F.lit("<rss><channel>"), F.array_join(F.col("i.x"), ""), F.lit("</channel></rss>"))
    return payloads.feed_candidates(pages.select("page", body.alias("body")), ["page"], "body").select("page", "pos", "title", "link", "published")


@query("list_items_round_trip", f"SELECT page, {_plain('title')} AS title, url FROM (SELECT {ITEM_KEY} AS page, arg_min(title, ingest_seq) AS title, url FROM (SELECT ingest_seq, title, trim(url) AS url FROM candidate_item) GROUP BY 1, 3)")
def list_items_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages of fifty articles each; an address that comes again on a page is its first item's."""
    c = table(spark, sf_dir, "candidate_item").withColumn("page", F.floor(F.col("ingest_seq") / 50))
    item = F.concat(F.lit("<article><h2><a href='"), F.replace(_escaped(F.trim("url")), F.lit("'"), F.lit("&#39;")), F.lit("'>"), _escaped(F.col("title")), F.lit("</a></h2></article>"))
    pages = c.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ingest_seq", item.alias("x")))).alias("i"))
    body = F.concat(F.lit("<html><body>"), F.array_join(F.col("i.x"), ""), F.lit("</body></html>"))
    x = pages.select("page", F.explode(html.items_udf("article_list")(body, F.lit(None).cast("string"))).alias("e"))
    return x.select("page", "e.title", "e.url")


@query("table_round_trip", "SELECT ingest_seq, nullif(issuer_name, '') AS company, issuer_code AS ticker, filing_type AS action, filing_date AS date FROM (SELECT ingest_seq, trim(regexp_replace(issuer_name, '\\s+', ' ', 'g')) AS issuer_name, nullif(issuer_code, '') AS issuer_code, nullif(filing_type, '') AS filing_type, nullif(trim(regexp_replace(filing_date, '\\s+', ' ', 'g')), '') AS filing_date FROM filing_candidate)")
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table a filing, its columns named by a header row, read back by their names."""
    f = table(spark, sf_dir, "filing_candidate")
    cell = lambda v: F.concat(F.lit("<td>"), _escaped(F.coalesce(v, F.lit(""))), F.lit("</td>"))
    head = "<tr><th>Date</th><th>Company</th><th>Symbol</th><th>Action</th></tr>"
    body = F.concat(F.lit(f"<table>{head}<tr>"), cell(F.col("filing_date")), cell(F.col("issuer_name")), cell(F.col("issuer_code")), cell(F.col("filing_type")), F.lit("</tr></table>"))
    return payloads.named_table_rows(f.select("ingest_seq", body.alias("body")), ["ingest_seq"], "body").select("ingest_seq", "company", "ticker", "action", "date")


@query("json_from_answer", "SELECT ingest_seq, issuer_code AS code, CAST(ingest_seq AS VARCHAR) AS n FROM filing_candidate")
def json_from_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON within a fenced answer, found, parsed and checked by its schema."""
    f = table(spark, sf_dir, "filing_candidate")
    answer = F.concat(F.lit("Sure:\n```json\n"), F.to_json(F.struct(F.col("issuer_code").alias("code"), F.col("ingest_seq").cast("string").alias("n"))), F.lit("\n```\nDone."))
    return f.select("ingest_seq", tx.checked_json(answer, "code string, n string", ["code", "n"]).alias("j")).select("ingest_seq", "j.value.code", "j.value.n")
