"""Queries of distinct rows, seen sets and state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls
from ..operators import dedupe, filters, joins, state
from ..runtime import materialize, table

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: White space of Unicode for the regular expressions of the SQL side.
WS = r"[\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}]"
COLLAPSED = f"trim(regexp_replace(lower(text), '{WS}+', ' ', 'g'))"
HEAD = r"regexp_extract(u, '^([a-zA-Z][a-zA-Z0-9+.-]*:)?(//[^/?#]*)?')"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query(
    "dedupe_source_counts",
    f"""WITH d AS (SELECT doc_id, source, substring(sha256({COLLAPSED}), 1, 16) AS k, length(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) >= 30 AS ok FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS rn FROM d WHERE ok)
SELECT d.source, count(*) AS docs, count(*) FILTER (d.ok) AS passed, count(*) FILTER (p.rn = 1) AS unique_docs, count(*) FILTER (p.rn > 1) AS duplicates FROM d LEFT JOIN p USING (doc_id) GROUP BY d.source""",
)
def dedupe_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many unique, non-trivial documents each source contributes."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", tx.hash_text(F.col("text")).alias("k"), filters.quality_gate(F.col("text")).alias("ok"))
    # The window sees keys only; a document that fails the gate has none and stands alone.
    x = dedupe.mark_first(materialize(d, "keys"), F.when(F.col("ok"), F.col("k")), ["doc_id"])
    return x.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if("ok").alias("passed"), F.count_if(F.col("ok") & F.col("is_first")).alias("unique_docs"), F.count_if(F.col("ok") & ~F.col("is_first")).alias("duplicates")
    )


@query("dedupe_content", f"SELECT min(doc_id) AS doc_id, substring(sha256({COLLAPSED}), 1, 16) AS content_hash FROM documents GROUP BY 2")
def dedupe_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", tx.hash_text(F.col("text")).alias("content_hash"))
    return dedupe.first_wins(d, F.col("content_hash"), ["doc_id"])


CANON = f"regexp_replace(lower({HEAD}) || substring(u, length({HEAD}) + 1), '/+$', '')"


@query("url_canonical", f"SELECT item_id, ingest_seq, {CANON} AS url FROM (SELECT item_id, ingest_seq, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\\?$', '') AS u FROM candidate_item)")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidate_item").select("item_id", "ingest_seq", urls.canonical_url(F.col("url")).alias("url"))


@query(
    "url_hash_dedupe",
    f"""WITH c AS (SELECT ingest_seq, substring(sha256({CANON}), 1, 16) AS url_hash FROM (SELECT ingest_seq, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\\?$', '') AS u FROM candidate_item))
SELECT min(ingest_seq) AS ingest_seq, url_hash FROM c GROUP BY url_hash""",
)
def url_hash_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidate_item").select("ingest_seq", urls.url_hash(F.col("url")).alias("url_hash"))
    return dedupe.first_wins(c, F.col("url_hash"), ["ingest_seq"])


#: Parameters in order of name, those of one name as they came, without values that are empty; plain ones need no decoding.
UNTRACKED = r"""SELECT ingest_seq, item_id, source, title, base || CASE WHEN len(ps) > 0 THEN '?' || array_to_string(list_transform(list_sort(list_transform(range(1, len(ps) + 1), lambda i: {'k': string_split(ps[i], '=')[1], 'i': i, 'p': ps[i]})), lambda x: x.p), '&') ELSE '' END AS url
FROM (SELECT ingest_seq, item_id, source, title, regexp_replace(HEAD, '\?.*$', '') AS base, list_filter(string_split(regexp_extract(HEAD, '\?(.*)$', 1), '&'), lambda p: regexp_matches(p, '=.') AND NOT list_contains(['utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', 'gclid', 'gbraid', 'wbraid', 'ref', 'ref_src', 'spm', 'from', 'scenes', 'clicktime', 'enterid', 'forceh5'], lower(string_split(p, '=')[1]))) AS ps
FROM (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM candidate_item))""".replace("HEAD", f"regexp_replace(lower({HEAD}) || substring(u, length({HEAD}) + 1), '/+$', '')")


@query("url_without_tracking", f"SELECT ingest_seq, url, CASE WHEN NOT regexp_matches(url, '^https?://') THEN 'scheme' END AS problem FROM ({UNTRACKED})")
def url_without_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "candidate_item").select("ingest_seq", urls.url_without_tracking("url").alias("url"), urls.url_problem_udf("url").alias("problem"))


@query(
    "dedupe_two_phase",
    """WITH a AS (SELECT ingest_seq, url_hash, content_hash, CASE WHEN url_hash IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY url_hash ORDER BY ingest_seq) END AS r1 FROM raw_signal),
b AS (SELECT ingest_seq, CASE WHEN content_hash IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY content_hash ORDER BY ingest_seq) END AS r2 FROM a WHERE r1 = 1)
SELECT a.ingest_seq, CAST(CASE WHEN r1 > 1 THEN 1 WHEN r2 > 1 THEN 2 ELSE 0 END AS INTEGER) AS duplicate_of_phase FROM a LEFT JOIN b USING (ingest_seq)""",
)
def dedupe_two_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "raw_signal").select("ingest_seq", "url_hash", "content_hash")
    return dedupe.two_phase(r, F.col("url_hash"), F.col("content_hash"), ["ingest_seq"]).select("ingest_seq", "duplicate_of_phase")


@query(
    "dedupe_null_key",
    """SELECT event_id FROM (SELECT event_id, nullif(user_id % 50, 7) AS k, row_number() OVER (PARTITION BY nullif(user_id % 50, 7) ORDER BY event_id) AS rn FROM events) WHERE k IS NULL OR rn = 1""",
)
def dedupe_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key are all unique."""
    e = table(spark, sf_dir, "events").select("event_id", F.nullif(F.col("user_id") % 50, F.lit(7)).alias("k"))
    return dedupe.first_wins(e, F.col("k"), ["event_id"]).select("event_id")


@query(
    "seen_anti_join",
    """SELECT ingest_seq, signal_id FROM raw_signal r WHERE batch_no > 0 AND NOT EXISTS (SELECT 1 FROM seen_signal s WHERE s.url_hash = r.url_hash) AND NOT EXISTS (SELECT 1 FROM seen_signal s WHERE s.content_hash = r.content_hash)""",
)
def seen_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "raw_signal").filter("batch_no > 0").select("ingest_seq", "signal_id", "url_hash", "content_hash")
    s = table(spark, sf_dir, "seen_signal")
    for k in ("url_hash", "content_hash"):
        r = r.join(s.select(k).filter(F.col(k).isNotNull()).distinct(), k, "left_anti")
    return r.select("ingest_seq", "signal_id")


SEEN_GREEDY_SQL = """
WITH RECURSIVE h AS (SELECT 'u' || url_hash AS k FROM seen_signal WHERE url_hash IS NOT NULL UNION SELECT 'c' || content_hash FROM seen_signal WHERE content_hash IS NOT NULL),
r AS (SELECT row_number() OVER (ORDER BY ingest_seq) AS i, ingest_seq, signal_id, coalesce('u' || url_hash, 'u#' || ingest_seq) AS u, coalesce('c' || content_hash, 'c#' || ingest_seq) AS c FROM raw_signal WHERE batch_no > 0 AND coalesce('u' || url_hash, '') NOT IN (SELECT k FROM h) AND coalesce('c' || content_hash, '') NOT IN (SELECT k FROM h)),
step AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS BIGINT) AS won UNION ALL
 SELECT r.i, CASE WHEN list_contains(taken, r.u) OR list_contains(taken, r.c) THEN taken ELSE list_concat(taken, [r.u, r.c]) END, CASE WHEN list_contains(taken, r.u) OR list_contains(taken, r.c) THEN NULL ELSE r.ingest_seq END FROM step JOIN r ON r.i = step.i + 1)
SELECT ingest_seq, signal_id FROM r WHERE ingest_seq IN (SELECT won FROM step)"""


@query("seen_greedy", SEEN_GREEDY_SQL)
def seen_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New signals one after the other: none of their keys was seen before or came with an earlier new one."""
    r = table(spark, sf_dir, "raw_signal").filter("batch_no > 0").select("ingest_seq", "signal_id", "url_hash", "content_hash")
    history = dedupe.seen_keys(table(spark, sf_dir, "seen_signal"), url_hash="url_hash", content_hash="content_hash")
    return dedupe.greedy_new(r, ["url_hash", "content_hash"], "ingest_seq", history).select("ingest_seq", "signal_id")


TITLE_KEY = "substring(sha256(source || '||' || title || '||' || coalesce(published, '')), 1, 16)"


@query(
    "seen_fallback_lookup",
    f"""WITH c AS (SELECT ingest_seq, substring(sha256({CANON}), 1, 16) AS url_hash, th AS title_hash FROM (SELECT ingest_seq, {TITLE_KEY} AS th, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\\?$', '') AS u FROM candidate_item)),
a AS (SELECT url_hash, arg_min(status, (-epoch_us(last_seen_at), status)) AS s1 FROM seen_documents WHERE url_hash IS NOT NULL GROUP BY 1),
b AS (SELECT title_hash, arg_min(status, (-epoch_us(last_seen_at), status)) AS s2 FROM seen_documents WHERE title_hash IS NOT NULL GROUP BY 1)
SELECT ingest_seq, CASE WHEN s1 IS NOT NULL THEN 'url_hash' WHEN s2 IS NOT NULL THEN 'title_hash' END AS matched_by, coalesce(coalesce(s1, s2) IN ('saved', 'partial', 'duplicate'), false) AS is_seen FROM c LEFT JOIN a USING (url_hash) LEFT JOIN b USING (title_hash)""",
)
def seen_fallback_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidate_item").select("ingest_seq", urls.url_hash(F.col("url")).alias("url_hash"), urls.title_key(F.col("source"), F.col("title"), F.col("published")).alias("title_hash"))
    return state.seen_lookup(c, table(spark, sf_dir, "seen_documents"), "url_hash", "title_hash").select("ingest_seq", "matched_by", "is_seen")


@query(
    "upsert_snapshot",
    f"""WITH c AS (SELECT substring(sha256({CANON}), 1, 16) AS url_hash, ingest_seq, title, source FROM (SELECT ingest_seq, title, source, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\\?$', '') AS u FROM candidate_item)),
b AS (SELECT url_hash, arg_max(title, ingest_seq) AS title, arg_max(source, ingest_seq) AS source_id FROM c GROUP BY 1),
s AS (SELECT url_hash, arg_max(title, document_id) AS title, arg_max(source_id, document_id) AS source_id, arg_max(status, document_id) AS status, arg_max(retry_count, document_id) AS retry_count, max(document_id) AS m FROM (SELECT document_id, url_hash, coalesce(title, '') AS title, source_id, status, retry_count FROM seen_documents) GROUP BY 1)
SELECT coalesce(s.url_hash, b.url_hash) AS url_hash, coalesce(b.title, s.title) AS title, coalesce(b.source_id, s.source_id) AS source_id, CASE WHEN b.url_hash IS NOT NULL THEN 'saved' ELSE s.status END AS status, CAST(coalesce(s.retry_count, 0) + CASE WHEN b.url_hash IS NOT NULL AND s.status = 'failed' THEN 1 ELSE 0 END AS INTEGER) AS retry_count FROM s FULL JOIN b ON s.url_hash = b.url_hash""",
)
def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "seen_documents").withColumn("title", F.coalesce("title", F.lit("")))
    s = state.latest(s, ["url_hash"], F.col("document_id").desc()).select("url_hash", "title", "source_id", "status", "retry_count")
    c = table(spark, sf_dir, "candidate_item").select(urls.url_hash(F.col("url")).alias("url_hash"), "ingest_seq", "title", F.col("source").alias("source_id"))
    b = state.latest(c, ["url_hash"], F.col("ingest_seq").desc()).withColumn("status", F.lit("saved"))
    return state.upsert(s, b, "url_hash", ["title", "source_id", "status"], retry="retry_count")


@query(
    "versioned_upsert",
    """WITH f AS (SELECT ingest_seq, document_url, filing_title || '|' || coalesce(filing_date, '') AS c FROM filing_candidate), g AS (SELECT *, lag(c) OVER w AS p, row_number() OVER w AS rn FROM f WINDOW w AS (PARTITION BY document_url ORDER BY ingest_seq))
SELECT ingest_seq, CASE WHEN rn = 1 THEN 'insert' WHEN p = c THEN 'duplicate' ELSE 'new_version' END AS action FROM g""",
)
def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "filing_candidate").select("ingest_seq", "document_url", F.concat_ws("|", "filing_title", F.coalesce("filing_date", F.lit(""))).alias("content"))
    return state.versions(f, None, "document_url", "content", "ingest_seq").select("ingest_seq", "action")


@query(
    "queue_rewrite",
    """SELECT document_id, retry_count FROM seen_documents WHERE status = 'failed' AND retry_count > 1 UNION ALL SELECT document_id, CAST(retry_count + 1 AS INTEGER) FROM seen_documents WHERE status = 'failed' AND retry_count <= 1 AND error IS NOT NULL""",
)
def queue_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failed queue after a retry of what was tried once at most: what names an error fails again."""
    q = table(spark, sf_dir, "seen_documents").filter("status = 'failed'").select("document_id", "retry_count", "error")
    retried = q.filter("retry_count <= 1")
    again = retried.filter("error is not null").withColumn("retry_count", F.col("retry_count") + 1)
    return state.rewrite_queue(q, retried, again, "document_id").select("document_id", "retry_count")


@query(
    "unconsumed",
    """SELECT DISTINCT signal_id FROM raw_signal WHERE signal_id NOT IN (SELECT json_extract_string(metadata, '$.signal_id') FROM seen_signal WHERE json_extract_string(metadata, '$.signal_id') IS NOT NULL)""",
)
def unconsumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = table(spark, sf_dir, "seen_signal").select(F.get_json_object("metadata", "$.signal_id").alias("signal_id"), F.lit("seen").alias("consumer"))
    return state.unconsumed(table(spark, sf_dir, "raw_signal").select("signal_id").distinct(), receipts.dropna(subset=["signal_id"]), "signal_id", "seen")


@query("inventory_left_join_last", "SELECT source_id, lang_main, l.signal_id, l.batch_no FROM inventory_source LEFT JOIN (SELECT source_id, arg_max(signal_id, ingest_seq) AS signal_id, arg_max(batch_no, ingest_seq) AS batch_no FROM raw_signal GROUP BY 1) l USING (source_id)")
def inventory_left_join_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "raw_signal").select("source_id", "ingest_seq", "signal_id", "batch_no")
    return joins.left_join_last(table(spark, sf_dir, "inventory_source").select("source_id", "lang_main"), r, "source_id", "ingest_seq", ["signal_id", "batch_no"])


@query("group_join_drop_orphans", "SELECT r_name, n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def group_join_drop_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("suppliers"))


@query("set_difference_both", "SELECT DISTINCT url_hash AS k, 'left' AS side FROM raw_signal WHERE url_hash IS NOT NULL AND url_hash NOT IN (SELECT url_hash FROM seen_signal WHERE url_hash IS NOT NULL) UNION ALL SELECT DISTINCT url_hash, 'right' FROM seen_signal WHERE url_hash IS NOT NULL AND url_hash NOT IN (SELECT url_hash FROM raw_signal WHERE url_hash IS NOT NULL)")
def set_difference_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = lambda name: table(spark, sf_dir, name).select(F.col("url_hash").alias("k")).dropna()
    return joins.differences(keys("raw_signal"), keys("seen_signal"), "k")


@query(
    "containment_check",
    """SELECT user_id, coalesce(array_to_string(list_sort(list_filter(['click', 'purchase', 'signup'], lambda x: NOT list_contains(list(DISTINCT event_type), x))), ','), '') AS missing, len(list_filter(['click', 'purchase', 'signup'], lambda x: NOT list_contains(list(DISTINCT event_type), x))) = 0 AS complete FROM events GROUP BY user_id""",
)
def containment_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.containment(table(spark, sf_dir, "events"), "user_id", "event_type", ["click", "purchase", "signup"])


@query("used_and_unused", "SELECT source_id, 'unused' AS state FROM inventory_source WHERE source_id NOT IN (SELECT source FROM documents) UNION ALL SELECT DISTINCT source, 'unknown' FROM documents WHERE source NOT IN (SELECT source_id FROM inventory_source)")
def used_and_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.used_and_unused(table(spark, sf_dir, "inventory_source"), "source_id", table(spark, sf_dir, "documents"), "source")


@query(
    "metadata_coalesce",
    """SELECT candidate_key, coalesce(nullif(p.title, ''), c.title) AS title FROM (SELECT candidate_key, min(url) AS url, min(title) AS title FROM content_candidate GROUP BY 1) c LEFT JOIN (SELECT url, min(title) AS title FROM extracted_page GROUP BY 1) p USING (url)""",
)
def metadata_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "content_candidate").groupBy("candidate_key").agg(F.min("url").alias("url"), F.min("title").alias("title"))
    p = table(spark, sf_dir, "extracted_page").groupBy("url").agg(F.min("title").alias("title"))
    return joins.coalesce_join(c, p, "url", ["title"]).select("candidate_key", "title")


#: The run as a loop over the candidates in order: what an accepted one marks is taken for those that follow.
ARCHIVE_SQL = f"""
WITH RECURSIVE c AS (SELECT ingest_seq AS pos, source, title, published, substring(sha256(regexp_replace(url, '/+$', '')), 1, 16) AS uh, {TITLE_KEY} AS th FROM ({UNTRACKED}) JOIN (SELECT ingest_seq, published FROM candidate_item) USING (ingest_seq)),
a AS (SELECT url_hash, arg_min(status, (-epoch_us(last_seen_at), status)) AS s1 FROM seen_documents WHERE url_hash IS NOT NULL GROUP BY 1),
b AS (SELECT title_hash, arg_min(status, (-epoch_us(last_seen_at), status)) AS s2 FROM seen_documents WHERE title_hash IS NOT NULL GROUP BY 1),
k AS (SELECT DISTINCT url_hash, title_hash FROM seen_documents WHERE url_hash IS NOT NULL),
p AS (SELECT uh, arg_min(text, (-length(text), text)) AS text, arg_min(title, (-length(text), text)) AS title, arg_min(error, (-length(text), text)) AS error FROM (SELECT substring(sha256(regexp_replace(PURL, '/+$', '')), 1, 16) AS uh, text, title, array_to_string(errors, ';') AS error FROM extracted_page) GROUP BY 1),
x AS (SELECT row_number() OVER (ORDER BY pos) AS i, pos, c.source, c.uh, c.th, s1 IS NOT NULL AS by_url, coalesce(nullif(p.title, ''), c.title) AS final_title, c.published,
 CASE WHEN coalesce(coalesce(s1, s2) IN ('saved', 'partial', 'duplicate'), false) THEN 'skipped' WHEN nullif(p.error, '') IS NOT NULL OR p.text IS NULL THEN 'failed' WHEN length(regexp_replace(p.text, '^{WS}+|{WS}+$', '', 'g')) < 300 THEN 'partial' ELSE 'saved' END AS outcome
 FROM c LEFT JOIN a ON a.url_hash = c.uh LEFT JOIN b ON b.title_hash = c.th LEFT JOIN p ON p.uh = c.uh),
y AS MATERIALIZED (SELECT *, ['u=' || uh] || CASE WHEN by_url THEN [] ELSE ['t=' || th] END AS looks, ['u=' || uh] || CASE WHEN by_url THEN coalesce((SELECT list('t=' || title_hash) FROM k WHERE k.url_hash = x.uh AND title_hash IS NOT NULL), []) ELSE ['t=' || substring(sha256(source || '||' || final_title || '||' || coalesce(published, '')), 1, 16)] END AS marks FROM x),
step AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS VARCHAR) AS outcome UNION ALL
 SELECT y.i, CASE WHEN NOT list_has_any(taken, looks) AND y.outcome IN ('saved', 'partial') THEN list_concat(taken, marks) ELSE taken END, y.source, CASE WHEN list_has_any(taken, looks) THEN 'duplicate' ELSE y.outcome END FROM step JOIN y ON y.i = step.i + 1),
n AS (SELECT source AS source_id, count(*) AS candidates, count(*) FILTER (outcome = 'saved') AS saved, count(*) FILTER (outcome = 'partial') AS partial, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'duplicate') AS duplicates, count(*) FILTER (outcome = 'skipped') AS skipped FROM step WHERE i > 0 GROUP BY 1)
SELECT *, CASE WHEN failed = 0 THEN 'healthy' WHEN saved + partial + skipped > 0 THEN 'degraded' ELSE 'failed' END AS status, '2025-12-01' AS checked_at FROM n""".replace("PURL", f"(SELECT regexp_replace(lower({HEAD}) || substring(u, length({HEAD}) + 1), '/+$', '') FROM (SELECT regexp_replace(regexp_replace(trim(url), '#.*$', ''), '[?].*$', '') AS u))")


@query("archive_run_health", ARCHIVE_SQL)
def archive_run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate items as one archiving run against the seen documents and the extracted pages, by source."""
    from . import pipelines

    c = table(spark, sf_dir, "candidate_item").select(F.col("source").alias("source_id"), F.col("ingest_seq").alias("pos"), "title", "url", "published")
    pages = table(spark, sf_dir, "extracted_page").select("url", "text", "title", F.array_join("errors", ";").alias("error"))
    run = pipelines.archive_run(c, table(spark, sf_dir, "seen_documents"), pages, "run", "2025-12-01")
    return run.health
