"""Queries of text, address, date and JSON functions over whole tables, and of streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, dates, urls
from ..functions import collections as co
from ..functions import text as tx
from ..operators import dedupe
from ..runtime import scratch_root, table
from ..streaming import seen
from .dedupe_queries import UNTRACKED, WS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("strip_tags", f"SELECT page_id, sha256(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '{WS}+', ' ', 'g'))) AS text_hash, count(*) AS n FROM extracted_page GROUP BY 1, 2")
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "extracted_page").groupBy("page_id", F.sha2(tx.strip_tags(F.col("text")), 256).alias("text_hash")).agg(F.count(F.lit(1)).alias("n"))


MARKDOWN_SQL = r"""SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '```[\s\S]*?```', ' ', 'g'), '`[^`]+`', ' ', 'g'), '!\[.*?\]\(.*?\)', ' ', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'),
'#{1,6}WS+', ' ', 'g'), '[*_]{1,2}([^*_]+)[*_]{1,2}', '\1', 'g'), 'WS+', ' ', 'g'))) AS text_hash FROM documents""".replace("WS", WS)


@query("markdown_to_text", MARKDOWN_SQL)
def markdown_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(tx.markdown_to_text(F.col("text")), 256).alias("text_hash"))


FILE = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(X, ''), '[\\\\/:*?\"<>|\\r\\n\\t]+', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g'), '{WS}+', '-', 'g'), '^[-.]+|[-.]+$', '', 'g')"


def _file_sql(column: str, n: int) -> str:
    return f"CASE WHEN regexp_replace(left({FILE.replace('X', column)}, {n}), '-+$', '') = '' THEN 'untitled' ELSE regexp_replace(left({FILE.replace('X', column)}, {n}), '-+$', '') END"


@query("sanitize_filename", f"SELECT doc_id, {_file_sql('title', 60)} AS name FROM documents")
def sanitize_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.sanitize_filename(F.col("title"), 60).alias("name"))


@query(
    "archive_path",
    f"""WITH f AS (SELECT ingest_seq, CASE WHEN regexp_matches(filing_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN left(filing_date, 10) ELSE strftime(discovered_at, '%Y-%m-%d') END AS d, source_id, filing_title FROM filing_candidate)
SELECT ingest_seq, 'documents/' || left(d, 4) || '/' || substring(d, 6, 2) || '/' || d || '__' || {_file_sql("source_id", 40)} || '__' || {_file_sql("filing_title", 80)} AS path FROM f""",
)
def archive_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.date_format("discovered_at", "yyyy-MM-dd")
    return table(spark, sf_dir, "filing_candidate").select("ingest_seq", urls.archive_path(F.col("filing_date"), now, F.col("source_id"), F.col("filing_title")).alias("path"))


@query("extract_domain", r"SELECT domain, count(*) AS n FROM (SELECT nullif(regexp_replace(nullif(lower(regexp_extract(trim(url), '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), ''), '^[w.]+', ''), '') AS domain FROM candidate_item) GROUP BY 1")
def extract_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidate_item").groupBy(urls.domain(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "canonical_key",
    """SELECT ingest_seq, source_type || '|' || issuer_code || '|' || coalesce(filing_date, '') || '|' || filing_type || '|' || coalesce('acc:' || nullif(accession_number, ''), 'ann:' || nullif(announcement_id, ''), 'url:' || nullif(document_url, ''), 'pdf:' || nullif(pdf_url, ''), 'title_hash:' || substring(sha256(filing_title), 1, 16)) AS canonical_key FROM filing_candidate""",
)
def canonical_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    key = urls.canonical_key(c("source_type"), c("issuer_code"), c("filing_date"), c("filing_type"), c("accession_number"), c("announcement_id"), c("document_url"), c("pdf_url"), c("filing_title"))
    return table(spark, sf_dir, "filing_candidate").select("ingest_seq", key.alias("canonical_key"))


@query("title_keys", "SELECT ingest_seq, substring(sha256(source || '||' || title || '||' || coalesce(published, '')), 1, 16) AS title_hash FROM candidate_item")
def title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidate_item").select("ingest_seq", urls.title_key(F.col("source"), F.col("title"), F.col("published")).alias("title_hash"))


@query("capital_codes", r"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\b[A-Z]{2,5}\b'))), ',') AS codes FROM documents")
def capital_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(classify.all_matches(F.col("text"), r"(?<![A-Za-z0-9_])[A-Z]{2,5}(?![A-Za-z0-9_])")), ",").alias("codes"))


@query("contained_names", "SELECT doc_id, array_to_string(list_filter(['Holdings', 'Mutual', 'Capital', 'Freight', 'Labs'], lambda x: contains(text, x)), ',') AS names FROM documents")
def contained_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(classify.contained(F.col("text"), ["Holdings", "Mutual", "Capital", "Freight", "Labs"]), ",").alias("names"))


#: The page's status stands in its errors as http_NNN.
NOISE_SQL = r"""
WITH p AS (SELECT DISTINCT page_id, text AS t, lower(text) AS low, lower(coalesce(title, '')) AS head, length(trim(regexp_replace(lower(text), 'WS+', ' ', 'g'))) AS n, coalesce(TRY_CAST(regexp_extract(array_to_string(errors, ';'), 'http_([0-9]+)', 1) AS INTEGER), 0) AS status FROM extracted_page),
h AS (SELECT *, len(list_filter(['sign in', 'sign-in', 'signin', 'log in', 'log-in', 'login', 'password', 'username', 'email address', 'remember me', 'forgot password', 'create account'], lambda w: contains(low, w))) AS login,
  len(list_filter(['cookie consent', 'accept cookies', 'cookie policy', 'manage cookies', 'we use cookies', 'this site uses cookies', 'cookie preferences', 'gdpr consent'], lambda w: contains(low, w))) AS cookie,
  len(list_filter(['pricing', 'plans starting at', 'free trial', 'request a demo', 'book a demo', 'schedule a demo', 'get started', 'try for free', 'start free trial', 'enterprise pricing', 'contact sales'], lambda w: contains(low, w))) AS market,
  list_distinct(regexp_extract_all(head, '[a-z]{3,}')) AS w1, regexp_extract_all(low, '[a-z]{3,}') AS w2 FROM p)
SELECT DISTINCT page_id, array_to_string(list_filter([
 CASE WHEN status IN (403, 451, 503) OR status >= 500 OR regexp_matches(low, 'access denied|forbidden|blocked|access restricted|service unavailable|you don.t have permission') THEN 'blocked_page' END, CASE WHEN login >= 3 THEN 'login_page' END,
 CASE WHEN regexp_matches(low, 'paywall|premium|subscription required|subscribe to continue|subscribe to read|subscribe now to access|members only|upgrade to access|sign up to continue|free trial|subscribe to unlock') THEN 'paywall' END, CASE WHEN cookie >= 3 AND n < 500 THEN 'cookie_only' END,
 CASE WHEN regexp_matches(low, 'download our app|download the app|get the app|app store|google play|open in app|install app|mobile app') THEN 'app_download_page' END, CASE WHEN n < 200 AND regexp_matches(t, '<a\s') THEN 'navigation_only' END, CASE WHEN market >= 3 THEN 'marketing_only' END, CASE WHEN n < 50 THEN 'empty_page' END,
 CASE WHEN length(t) - length(regexp_replace(t, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) > length(t) * 0.05 OR length(t) - length(replace(t, chr(65533), '')) > 5 OR len(list_filter(range(1, length(t) - 9), lambda i: substring(t, i, 1) <> chr(10) AND substring(t, i, 11) = repeat(substring(t, i, 1), 11))) > 0 THEN 'garbled_text' END,
 CASE WHEN n > 100 AND len(w1) > 2 AND NOT list_has_any(w1, w2) THEN 'unrelated_page' END], lambda x: x IS NOT NULL), ',') AS flags FROM h""".replace("WS", WS).replace("don.t", "don''t")


@query("noise_flags", NOISE_SQL)
def noise_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.regexp_extract(F.array_join("errors", ";"), "http_([0-9]+)", 1).try_cast("int")
    flags = classify.noise_flags(F.col("text"), F.col("title"), status)
    return table(spark, sf_dir, "extracted_page").select("page_id", F.array_join(flags, ",").alias("flags")).distinct()


@query(
    "link_noise",
    r"""WITH l AS (SELECT ingest_seq, lower(coalesce(title, '') || ' ' || coalesce(url, '')) AS t FROM candidate_item)
SELECT ingest_seq, array_to_string(list_filter([CASE WHEN regexp_matches(t, 'cookie|consent|privacy\s*policy|gdpr|ccpa') THEN 'cookie' END, CASE WHEN regexp_matches(t, 'no\s*content|empty|404|not\s*found') THEN 'empty' END, CASE WHEN regexp_matches(t, 'sign\s*in|log\s*in|account|password|email|username') THEN 'login' END, CASE WHEN t IN ('home', 'about', 'contact', 'careers', 'menu', 'subscribe', 'search') THEN 'navigation' END], lambda x: x IS NOT NULL), ',') AS kinds FROM l""",
)
def link_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidate_item").select("ingest_seq", F.array_join(classify.link_noise(F.col("title"), F.col("url")), ",").alias("kinds"))


ERROR_SQL = """
WITH e AS (SELECT document_id, error, lower(coalesce(error, '')) AS l FROM seen_documents)
SELECT document_id, CASE WHEN l = '' THEN NULL WHEN contains(l, 'unsupported source_type') THEN 'unsupported_source_type' WHEN contains(l, 'config') AND contains(l, 'error') THEN 'config_error' WHEN contains(l, 'connector 异常') OR contains(l, 'connector error') THEN 'connector_error'
 WHEN contains(l, '抓取失败') OR contains(l, 'fetch') OR contains(l, 'http') OR contains(l, 'timeout') THEN 'fetch_error' WHEN contains(l, '解析') OR contains(l, 'parse') OR contains(l, 'beautifulsoup') THEN 'parse_error' WHEN contains(l, '正文抽取') OR contains(l, 'extract') THEN 'extract_error'
 WHEN contains(l, '写入') OR contains(l, 'storage') OR contains(l, 'io') THEN 'storage_error' WHEN contains(l, '内容为空') OR contains(l, 'empty') THEN 'empty_source' ELSE 'unknown_error' END AS error_class,
CASE WHEN contains(l, 'fetch') OR contains(l, 'http') OR contains(l, 'network') OR contains(l, 'timeout') THEN 'fetch' WHEN contains(l, 'parse') OR contains(l, 'syntax') OR contains(l, 'html') OR contains(l, 'json') THEN 'parse' ELSE 'connector' END AS filing_class,
CASE WHEN contains(l, 'getaddrinfo') OR contains(l, 'nodename nor servname') OR contains(l, 'dns') THEN 'dns_resolution_failed' WHEN contains(l, 'ssl: unexpected_eof') OR contains(l, 'ssl_error_syscall') OR contains(l, 'tlsv1') OR contains(l, 'sslv3') OR contains(l, 'handshake') THEN 'tls_handshake_failed'
 WHEN contains(l, 'connection reset') OR contains(l, '远程主机强迫关闭') OR contains(l, 'winerror 10054') THEN 'connection_reset' WHEN contains(l, 'timed out') OR contains(l, 'timeout') THEN 'timeout' WHEN contains(l, 'certificate_verify_failed') OR contains(l, 'certificate verify failed') OR contains(l, 'hostname mismatch') THEN 'ssl_certificate_error'
 WHEN contains(l, '404') THEN 'http_404' WHEN contains(l, '403') THEN 'http_403' WHEN contains(l, '401') THEN 'http_401' WHEN TRY_CAST(regexp_extract(l, 'http error:\\s*([0-9]+)', 1) AS INTEGER) BETWEEN 400 AND 499 THEN 'http_4xx' WHEN TRY_CAST(regexp_extract(l, 'http error:\\s*([0-9]+)', 1) AS INTEGER) BETWEEN 500 AND 599 THEN 'http_5xx' ELSE 'unknown' END AS network_error FROM e"""


@query("error_class", ERROR_SQL)
def error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("error")
    return table(spark, sf_dir, "seen_documents").select("document_id", classify.error_class(e).alias("error_class"), classify.filing_error_class(e).alias("filing_class"), classify.network_error(e, F.lit(None).cast("int")).alias("network_error"))


@query(
    "quality_by_length",
    "SELECT quality, count(*) AS n FROM (SELECT CASE WHEN length(text) >= 3000 THEN 'high' WHEN length(text) >= 500 THEN 'medium' WHEN length(text) > 0 THEN 'low' ELSE 'empty' END AS quality FROM documents) GROUP BY 1",
)
def quality_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(tx.quality_by_length(tx.char_count(F.col("text")), 3000, 500).alias("quality")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "word_char_counts",
    f"SELECT doc_id, length(text) AS chars, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS words FROM (SELECT doc_id, text, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS t FROM documents)",
)
def word_char_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.char_count(F.col("text")).alias("chars"), tx.word_count(F.col("text")).alias("words"))


_PATH_DAY = "CASE WHEN TRY_CAST(X.y AS INTEGER) BETWEEN 2000 AND 2030 AND TRY_CAST(X.m AS INTEGER) BETWEEN 1 AND 12 AND TRY_CAST(coalesce(nullif(X.d, ''), '1') AS INTEGER) BETWEEN 1 AND 31 THEN X.y || '-' || lpad(CAST(TRY_CAST(X.m AS INTEGER) AS VARCHAR), 2, '0') || '-' || lpad(CAST(TRY_CAST(coalesce(nullif(X.d, ''), '1') AS INTEGER) AS VARCHAR), 2, '0') END"
DATE_URL_SQL = r"""
WITH p AS (SELECT ingest_seq, regexp_extract(url, '/(\d{4})/(\d{1,2})/(\d{1,2})', ['y', 'm', 'd']) AS a, regexp_extract(url, '/(\d{4})-(\d{1,2})-(\d{1,2})', ['y', 'm', 'd']) AS b, regexp_extract(url, '/(\d{4})(\d{2})(\d{2})(?:\D|$)', ['y', 'm', 'd']) AS c, regexp_extract(url, '-(\d{4})-(\d{1,2})-(\d{1,2})', ['y', 'm', 'd']) AS e,
 regexp_extract(url, '_(\d{4})-(\d{1,2})-(\d{1,2})', ['y', 'm', 'd']) AS f, regexp_extract(url, '-(\d{4})-(\d{1,2})()(?:[-/?]|$)', ['y', 'm', 'd']) AS g, regexp_extract(url, '/(\d{4})/(\d{1,2})()(?:[-/?]|$)', ['y', 'm', 'd']) AS h FROM SOURCE)
SELECT ingest_seq, coalesce(""" + ", ".join(_PATH_DAY.replace("X", x) for x in "abcefgh") + ") AS day FROM p"


@query("date_in_url", DATE_URL_SQL.replace("SOURCE", "candidate_item"))
def date_in_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidate_item").select("ingest_seq", dates.date_in_url(F.col("url")).alias("day"))


@query("date_in_made_up_url", DATE_URL_SQL.replace("SOURCE", "(SELECT o_orderkey AS ingest_seq, 'https://x.example/' || CASE o_orderkey % 8 WHEN 0 THEN 'a/' || strftime(o_orderdate, '%Y/%-m/%-d') || '-slug' WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') WHEN 3 THEN 'n-' || strftime(o_orderdate, '%Y-%m-%d') WHEN 4 THEN 'n_' || strftime(o_orderdate, '%Y-%m-%d') || '.html' WHEN 5 THEN 'slug-' || strftime(o_orderdate, '%Y-%-m') WHEN 6 THEN strftime(o_orderdate, '%Y/%-m') || '/x' ELSE strftime(o_orderdate, '%Y%m%d') || '9' END AS url FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 15 YEAR AS o_orderdate FROM orders))"))
def date_in_made_up_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every form of date in an address, made of the orders' dates moved by 15 years."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 15 YEARS")).alias("d"))
    f = lambda p: F.date_format("d", p)
    k = F.col("o_orderkey") % 8
    tail = (
        F.when(k == 0, F.concat(F.lit("a/"), f("yyyy/M/d"), F.lit("-slug"))).when(k == 1, f("yyyy-M-dd")).when(k == 2, f("yyyyMMdd")).when(k == 3, F.concat(F.lit("n-"), f("yyyy-MM-dd")))
        .when(k == 4, F.concat(F.lit("n_"), f("yyyy-MM-dd"), F.lit(".html"))).when(k == 5, F.concat(F.lit("slug-"), f("yyyy-M"))).when(k == 6, F.concat(f("yyyy/M"), F.lit("/x"))).otherwise(F.concat(f("yyyyMMdd"), F.lit("9")))
    )
    return o.select(F.col("o_orderkey").alias("ingest_seq"), dates.date_in_url(F.concat(F.lit("https://x.example/"), tail)).alias("day"))


DATE_TEXT_SQL = r"""SELECT ingest_seq, coalesce(nullif(regexp_extract(x, '(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},?\s+\d{4}'), ''), nullif(regexp_extract(x, '\d{4}-\d{2}-\d{2}'), ''), nullif(regexp_extract(x, '\d{1,2}月\d{1,2}日\s+\d{1,2}:\d{2}'), ''), nullif(regexp_extract(x, '\d{1,2}月\d{1,2}日'), ''),
nullif(regexp_extract(x, '(?:^|[^\p{L}\p{N}_])(\d{2}-\d{2})(?:[^\p{L}\p{N}_]|$)', 1), ''), nullif(regexp_extract(x, '\d+\s*小时前'), ''), nullif(regexp_extract(x, '\d+\s*分钟前'), ''), nullif(regexp_extract(x, '昨天'), ''), nullif(regexp_extract(x, '今天'), ''), nullif(regexp_extract(x, '\d{1,2}:\d{2}'), '')) AS date_text FROM (SELECT ingest_seq, published_at AS x FROM raw_signal)"""


@query("first_date_text", DATE_TEXT_SQL)
def first_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_signal").select("ingest_seq", dates.first_date_text(F.col("published_at")).alias("date_text"))


@query(
    "filing_dates",
    r"""WITH f AS (SELECT ingest_seq, filing_date AS x, left(filing_date, 10) AS t, left(filing_date, 19) AS s FROM filing_candidate)
SELECT ingest_seq, CASE WHEN TRY_CAST(trim(x) AS DOUBLE) IS NOT NULL THEN CASE WHEN (CASE WHEN CAST(x AS DOUBLE) > 1e12 THEN CAST(x AS DOUBLE) / 1000 ELSE CAST(x AS DOUBLE) END) < 253402300800 THEN strftime(epoch_ms(CAST(CASE WHEN CAST(x AS DOUBLE) > 1e12 THEN CAST(x AS DOUBLE) ELSE CAST(x AS DOUBLE) * 1000 END AS BIGINT)), '%Y-%m-%d') END WHEN regexp_matches(s, '^\d{4}-\d{1,2}-\d{1,2}$') THEN strftime(try_strptime(s, '%Y-%m-%d'), '%Y-%m-%d') WHEN regexp_matches(s, '^\d{4}/\d{1,2}/\d{1,2}$') THEN strftime(try_strptime(s, '%Y/%m/%d'), '%Y-%m-%d') WHEN regexp_matches(s, '^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$') THEN strftime(try_strptime(s, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d') END AS by_count,
CASE WHEN regexp_matches(t, '^\d{1,2}/\d{1,2}/\d{4}$') THEN strftime(try_strptime(t, '%d/%m/%Y'), '%Y-%m-%d') WHEN regexp_matches(t, '^\d{4}-\d{1,2}-\d{1,2}$') THEN strftime(try_strptime(t, '%Y-%m-%d'), '%Y-%m-%d') WHEN regexp_matches(t, '^\d{1,2}-\d{1,2}-\d{4}$') THEN strftime(try_strptime(t, '%d-%m-%Y'), '%Y-%m-%d') WHEN regexp_matches(t, '^\d{4}/\d{1,2}/\d{1,2}$') THEN strftime(try_strptime(t, '%Y/%m/%d'), '%Y-%m-%d') WHEN regexp_matches(t, '^\d{4}年\d{1,2}月\d{1,2}日$') THEN strftime(try_strptime(t, '%Y年%m月%d日'), '%Y-%m-%d') END AS listed FROM f""",
)
def filing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "filing_candidate").select("ingest_seq", dates.epoch_or_date(F.col("filing_date")).alias("by_count"), dates.listed_date(F.col("filing_date")).alias("listed"))


@query(
    "freshness_of_text",
    r"""WITH f AS (SELECT candidate_key, coalesce(published_at, '') AS x, DATE '2025-06-01' AS today FROM content_candidate),
g AS (SELECT *, regexp_extract(x, '(\d{1,2})月(\d{1,2})日', ['m', 'd']) AS c, regexp_extract(x, '^(\d{1,2})-(\d{1,2})$', ['m', 'd']) AS k, CASE WHEN regexp_matches(x, '^\d{4}-\d{1,2}-\d{1,2}$') THEN try_strptime(x, '%Y-%m-%d') WHEN regexp_matches(x, '^\d{8}$') THEN try_strptime(x, '%Y%m%d') WHEN regexp_matches(x, '^\d{1,2}-\d{1,2}-\d{4}$') THEN try_strptime(x, '%d-%m-%Y') END AS d FROM f),
h AS (SELECT *, date_diff('day', TRY_CAST('2025-' || lpad(c.m, 2, '0') || '-' || lpad(c.d, 2, '0') AS DATE), today) AS c0, date_diff('day', TRY_CAST('2024-' || lpad(c.m, 2, '0') || '-' || lpad(c.d, 2, '0') AS DATE), today) AS c1, date_diff('day', TRY_CAST('2025-' || lpad(k.m, 2, '0') || '-' || lpad(k.d, 2, '0') AS DATE), today) AS k0, date_diff('day', TRY_CAST('2024-' || lpad(k.m, 2, '0') || '-' || lpad(k.d, 2, '0') AS DATE), today) AS k1, date_diff('day', CAST(d AS DATE), today) AS n FROM g)
SELECT freshness, count(*) AS n FROM (SELECT CASE WHEN x = '' THEN 'unknown' WHEN c0 IS NOT NULL THEN CASE WHEN c0 BETWEEN 0 AND 30 THEN 'fresh' WHEN c0 BETWEEN 0 AND 365 OR c0 < 0 AND c1 BETWEEN 0 AND 365 THEN 'stale' ELSE 'unknown' END WHEN regexp_matches(x, '\d+\s*(?:小时|分钟)前|昨天') THEN 'fresh' WHEN regexp_matches(x, '^\d{1,2}:\d{2}$') THEN 'unknown'
WHEN k0 IS NOT NULL THEN CASE WHEN k0 BETWEEN 0 AND 30 THEN 'fresh' WHEN k0 < 0 AND k1 BETWEEN 0 AND 365 THEN 'stale' ELSE 'unknown' END WHEN n < 0 OR n IS NULL THEN 'unknown' WHEN n <= 30 THEN 'fresh' ELSE 'stale' END AS freshness FROM h) GROUP BY 1""",
)
def freshness_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = dates.freshness_of_text(F.col("published_at"), F.lit("2025-06-01"))
    return table(spark, sf_dir, "content_candidate").groupBy(x.alias("freshness")).agg(F.count(F.lit(1)).alias("n"))


@query("named_people", r"SELECT doc_id, array_to_string(list_distinct(regexp_extract_all(text, '\b(?:analyst|strategist|economist)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)', 1)), ',') AS names FROM (SELECT doc_id, text FROM documents WHERE NOT contains(text, chr(0)))".replace("list_distinct(", "list_sort(list_distinct(").replace("+)', 1)), ','", "+)', 1))), ','"))
def named_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(classify.people(F.col("text"))), ",").alias("names"))


@query("currency_counts", "SELECT source, CASE WHEN contains(lower(text), 'hk$') OR contains(lower(text), 'hkd') THEN 'HKD' WHEN contains(lower(text), 'rmb') OR contains(lower(text), 'cny') OR contains(text, '¥') THEN 'CNY' WHEN contains(text, '$') OR contains(lower(text), 'usd') THEN 'USD' ELSE 'unknown' END AS currency, count(*) AS n FROM documents GROUP BY 1, 2")
def currency_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source", classify.currency(F.col("text")).alias("currency")).agg(F.count(F.lit(1)).alias("n"))


@query("document_kinds", "SELECT doc_type, CASE WHEN contains(lower(text), 'transcript') THEN 'transcript' WHEN contains(lower(text), 'webcast') THEN 'webcast' WHEN contains(lower(text), 'presentation') OR contains(lower(text), 'slides') THEN 'presentation' ELSE 'event' END AS kind, count(*) AS n FROM documents GROUP BY 1, 2")
def document_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("doc_type", classify.document_kind(F.col("text")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("filing_content_hash", "SELECT ingest_seq, substring(sha256(coalesce(filing_title, '') || '||' || coalesce(filing_date, '') || '||' || coalesce(document_url, '') || '||' || coalesce(pdf_url, '') || '||' || coalesce(html_url, '')), 1, 32) AS content_hash FROM filing_candidate")
def filing_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "filing_candidate").select("ingest_seq", tx.content_hash(c("filing_title"), c("filing_date"), c("document_url"), c("pdf_url"), c("html_url")).alias("content_hash"))


@query("stale_records", "SELECT source_id, count(*) AS n, count(*) FILTER (floor((epoch(TIMESTAMP '2025-12-01 00:00:00') - floor(epoch(last_seen_at))) / 86400) > 30) AS stale FROM seen_documents GROUP BY 1")
def stale_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = dates.is_stale(F.col("last_seen_at").cast("timestamp"), F.lit("2025-12-01 00:00:00").cast("timestamp"), 30)
    return table(spark, sf_dir, "seen_documents").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(old).alias("stale"))


@query("json_props", "SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY 1")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(co.json_first(F.col("props"), "$.k").cast("long")).alias("total"))


@query("parallel_arrays", "SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS pos, o_totalprice FROM orders")
def parallel_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))).alias("s"))
    arrays = o.select("o_custkey", F.col("s.o_orderkey").alias("o_orderkey"), F.col("s.o_totalprice").alias("o_totalprice"))
    return co.rows_of_parallel_arrays(arrays, ["o_custkey"], ["o_orderkey", "o_totalprice"])


@query("hosts_repeated", r"SELECT source, count(*) AS n, count(*) - count(DISTINCT lower(regexp_extract(trim(url), '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1))) AS duplicates FROM candidate_item GROUP BY 1")
def hosts_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "candidate_item").select("source", urls.url_host(F.col("url")).alias("h"))
    return x.groupBy("source").agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) - F.count_distinct("h")).alias("duplicates"))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # Rows of the Parquet table as a stream, file by file.
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 16).parquet(sf_dir)


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Everything the stream gives now, through a file sink in the shared folder."""
    at = f"{scratch_root(spark)}/veldspar-stream-{uuid.uuid4().hex}"
    q = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


@query("stream_first_seen", "SELECT user_id, min(event_id) AS event_id FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(spark, seen.first_seen_stream(_event_stream(spark, sf_dir), "user_id", "event_id")).select("user_id", "event_id")


@query("stream_day_windows", "WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total, max(max(ts)) OVER () AS top, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS closes FROM events GROUP BY day, event_type) SELECT day, event_type, n, total FROM d WHERE date_trunc('day', CAST(day AS TIMESTAMP)) + INTERVAL 1 DAY <= top - INTERVAL 1 DAY")
def stream_day_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day totals as a stream closes them: the days that end before the last event less a day."""
    s = _event_stream(spark, sf_dir)
    s = s.withColumn("ts", F.col("ts").cast("timestamp"))
    x = _drained(spark, seen.day_windows(s, "ts", ["event_type"], F.col("value")))
    return x.select("day", "event_type", "n", F.round("total", 4).alias("total"))


#: As a loop over the rows in order: each step's state is the set of keys taken so far.
GREEDY_SQL = f"""
WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY ingest_seq) AS i, ingest_seq, item_id, 'u=' || regexp_replace(url, '/+$', '') AS u, 't=' || source || '||' || title AS t FROM ({UNTRACKED})),
step AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS BIGINT) AS won UNION ALL
 SELECT r.i, CASE WHEN list_contains(taken, r.u) OR list_contains(taken, r.t) THEN taken ELSE list_concat(taken, [r.u, r.t]) END, CASE WHEN list_contains(taken, r.u) OR list_contains(taken, r.t) THEN NULL ELSE r.ingest_seq END FROM step JOIN r ON r.i = step.i + 1)
SELECT ingest_seq, item_id FROM r WHERE ingest_seq IN (SELECT won FROM step)"""


@query("greedy_hosts", GREEDY_SQL)
def greedy_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New candidate items in order, by address without tracking and by title key."""
    c = table(spark, sf_dir, "candidate_item").select("ingest_seq", "item_id", urls.url_hash(urls.url_without_tracking("url")).alias("u"), urls.title_key(F.col("source"), F.col("title"), F.lit("")).alias("t"))
    return dedupe.greedy_new(c, ["u", "t"], "ingest_seq").select("ingest_seq", "item_id")
