"""Queries of filters, counts, latest rows and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import collections as co
from ..operators import filters, rollup
from ..runtime import table
from .dedupe_queries import WS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("soft_filter", "SELECT event_id FROM (SELECT event_id, event_type = 'purchase' AND value > 80 AS p, max(CAST(event_type = 'purchase' AND value > 80 AS INTEGER)) OVER (PARTITION BY user_id) AS a FROM events) WHERE p OR a = 0")
def soft_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return filters.soft_filter(e, (F.col("event_type") == "purchase") & (F.col("value") > 80), ["user_id"]).select("event_id")


@query("prefix_range_filter", "SELECT ingest_seq FROM raw_signal WHERE substring(published_at, 1, 7) >= '2023-06' AND substring(published_at, 1, 10) <= '2024-03-15'")
def prefix_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_signal").filter(filters.prefix_range(F.col("published_at"), "2023-06", "2024-03-15")).select("ingest_seq")


@query("tag_overlap", "SELECT page_id, count(*) AS n FROM extracted_page WHERE len(errors) > 0 AND list_has_any(errors, ['timeout', 'http_404', 'http_403', 'http_500', 'empty_body']) GROUP BY page_id")
def tag_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "extracted_page").filter(filters.tags_overlap(F.col("errors"), ["timeout", "http_404", "http_403", "http_500", "empty_body"]))
    return p.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


@query("quality_gate_split", f"SELECT item_table, ok, count(*) AS n FROM (SELECT 'content_candidate' AS item_table, coalesce(length(regexp_replace(snippet, '^{WS}+|{WS}+$', '', 'g')) >= 30, false) AS ok FROM content_candidate UNION ALL SELECT 'extracted_page', length(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) >= 30 FROM extracted_page) GROUP BY ALL")
def quality_gate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "content_candidate").select(F.lit("content_candidate").alias("item_table"), filters.quality_gate(F.col("snippet")).alias("ok"))
    b = table(spark, sf_dir, "extracted_page").select(F.lit("extracted_page").alias("item_table"), filters.quality_gate(F.col("text")).alias("ok"))
    return a.unionByName(b).groupBy("item_table", "ok").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rule_validation",
    """WITH f AS (SELECT CAST(ingest_seq AS VARCHAR) AS key, * FROM filing_candidate) SELECT 'has_date' AS rule, 'warning' AS level, key FROM f WHERE filing_date IS NULL UNION ALL SELECT 'has_type', 'warning', key FROM f WHERE filing_type = '' UNION ALL SELECT 'has_identifier', 'error', key FROM f WHERE accession_number IS NULL AND announcement_id IS NULL UNION ALL SELECT 'known_market', 'error', key FROM f WHERE market NOT IN ('US', 'CN', 'HK')""",
)
def rule_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "has_date": ("warning", F.col("filing_date").isNotNull()), "has_type": ("warning", F.col("filing_type") != ""),
        "has_identifier": ("error", F.col("accession_number").isNotNull() | F.col("announcement_id").isNotNull()), "known_market": ("error", F.col("market").isin("US", "CN", "HK")),
    }
    return filters.violations(table(spark, sf_dir, "filing_candidate"), "ingest_seq", rules)


@query("fk_validation", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) OR l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)")
def fk_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    a = filters.orphans(line, "l_suppkey", table(spark, sf_dir, "supplier"), "s_suppkey")
    b = filters.orphans(line, "l_partkey", table(spark, sf_dir, "part").filter("p_size <= 40"), "p_partkey")
    return a.select("l_orderkey", "l_linenumber").unionByName(b.select("l_orderkey", "l_linenumber")).distinct()


@query("repeated_keys", "SELECT item_id, count(*) AS n FROM candidate_item GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.repeated_keys(table(spark, sf_dir, "candidate_item"), "item_id")


@query("status_counts_closed_domain", "SELECT d.status, count(s.status) AS n FROM (SELECT unnest(['saved', 'partial', 'failed', 'timeout', 'unknown']) AS status) d LEFT JOIN (SELECT CASE WHEN status IN ('saved', 'partial', 'failed', 'timeout') THEN status ELSE 'unknown' END AS status FROM seen_documents) s USING (status) GROUP BY 1")
def status_counts_closed_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.closed_domain_counts(table(spark, sf_dir, "seen_documents"), "status", ["saved", "partial", "failed", "timeout"])


@query("status_counts_two_level", "SELECT source_id, status, count(*) AS n FROM seen_documents GROUP BY GROUPING SETS ((source_id, status), (status))")
def status_counts_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.two_level_counts(table(spark, sf_dir, "seen_documents"), "source_id", "status")


@query("conditional_sums", "SELECT l_returnflag, count(*) AS rows, count(*) FILTER (l_linestatus = 'O') AS open_rows, round(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END), 2) AS open_quantity FROM lineitem GROUP BY ROLLUP (l_returnflag)")
def conditional_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("l_linestatus") == "O"
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag").agg(F.count(F.lit(1)).alias("rows"), F.count_if(o).alias("open_rows"), F.round(F.sum(F.when(o, F.col("l_quantity")).otherwise(0.0)), 2).alias("open_quantity"))


@query("daily_merge_summaries", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS runs, round(sum(coalesce(value, 0)), 4) AS total, arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY 1")
def daily_merge_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    return table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("runs"), F.round(F.sum(F.coalesce("value", F.lit(0.0))), 4).alias("total"), F.min_by("event_id", at).alias("first_event"), F.max_by("event_id", at).alias("last_event"))


@query("multi_dimension_counts", "SELECT 'content_type' AS dimension, content_type AS value, count(*) AS n FROM content_candidate WHERE content_type IS NOT NULL GROUP BY 2 UNION ALL SELECT 'relevance', relevance, count(*) FROM content_candidate WHERE relevance IS NOT NULL GROUP BY 2 UNION ALL SELECT 'freshness', freshness, count(*) FROM content_candidate WHERE freshness IS NOT NULL GROUP BY 2")
def multi_dimension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.multi_counts(table(spark, sf_dir, "content_candidate"), ["content_type", "relevance", "freshness"])


@query(
    "success_rate_health",
    """WITH l AS (SELECT user_id, arg_min(event_type, (-epoch_us(ts), event_id)) AS s FROM events WHERE user_id IS NOT NULL GROUP BY 1), c AS (SELECT count(*) AS total, count(*) FILTER (s IN ('purchase', 'click', 'view')) AS success, count(*) FILTER (s = 'signup') AS transient, count(*) FILTER (s NOT IN ('purchase', 'click', 'view', 'signup')) AS failed FROM l)
SELECT *, round(success / total, 6) AS success_rate, CASE WHEN failed > 0 AND round(success / total, 6) < 0.7 THEN 'failed' WHEN transient > 0 OR (round(success / total, 6) >= 0.7 AND round(success / total, 6) < 0.9) THEN 'degraded' WHEN round(success / total, 6) >= 0.9 THEN 'healthy' ELSE 'failed' END AS health FROM c""",
)
def success_rate_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = rollup.latest_first_wins(table(spark, sf_dir, "events"), ["user_id"], F.col("ts"), "event_id")
    return rollup.success_summary(last, "event_type", ["purchase", "click", "view"], ["signup"])


@query("day_rollup", "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS runs, max(value) AS top_value, coalesce(bool_or(event_type = 'error'), false) AS any_error FROM events GROUP BY 1, 2")
def day_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.day_rollup(table(spark, sf_dir, "events"), ["user_id"], F.date_format("ts", "yyyy-MM-dd"), {"top_value": F.col("value")}, {"any_error": F.col("event_type") == "error"})


@query(
    "observation_summary",
    """WITH d AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, bool_or(event_type = 'error') AS bad, max(value) AS v FROM events GROUP BY 1, 2) SELECT user_id, count(*) AS days, count(*) FILTER (bad) AS bad_days, min(v) AS low, max(v) AS high, CASE WHEN count(*) < 3 THEN 'too_short' WHEN count(*) FILTER (bad) * 2 > count(*) THEN 'unstable' ELSE 'stable' END AS state FROM d GROUP BY 1""",
)
def observation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = day_rollup(spark, sf_dir)
    bad = F.count_if("any_error")
    days = F.count(F.lit(1))
    state = F.when(days < 3, "too_short").when(bad * 2 > days, "unstable").otherwise("stable")
    return d.groupBy("user_id").agg(days.alias("days"), bad.alias("bad_days"), F.min("top_value").alias("low"), F.max("top_value").alias("high"), state.alias("state"))


@query("map_merge_sum", "SELECT day, array_to_string(list_sort(list(event_type || '=' || n)), ',') AS counts FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def map_merge_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of counts by user and day merged to one map a day."""
    n = table(spark, sf_dir, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = n.groupBy("user_id", "day").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return co.merge_sum_maps(maps, ["day"], "m").select("day", co.map_text(F.col("m")).alias("counts"))


@query("inverted_index", "SELECT event_type AS value, count(DISTINCT user_id) AS n, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS keys FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "events").filter("user_id is not null").groupBy("user_id").agg(F.collect_set("event_type").alias("types"))
    return co.inverted_index(lists, "user_id", "types").select("value", "n", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys"))


@query("latest_first_wins", "SELECT user_id, arg_min(event_id, (-epoch_us(date_trunc('day', ts)), event_id)) AS event_id FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def latest_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the rows of each user's last day the first: ties of the time go to the earliest position."""
    return rollup.latest_first_wins(table(spark, sf_dir, "events"), ["user_id"], F.date_trunc("day", "ts"), "event_id").select("user_id", "event_id")


@query("latest_last_wins", "SELECT source_id, max(log_seq) AS log_seq FROM seen_signal GROUP BY 1")
def latest_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.latest_last_wins(table(spark, sf_dir, "seen_signal"), ["source_id"], "log_seq").select("source_id", "log_seq")


@query("last_n_per_key", "SELECT user_id, event_id, CAST(rn AS INTEGER) AS back FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 5")
def last_n_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.last_n(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id", 5).select("user_id", "event_id", "back")


@query(
    "consecutive_failures",
    """WITH i AS (SELECT *, sum(CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events) SELECT event_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS BIGINT) AS streak FROM i""",
)
def consecutive_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.consecutive(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", F.col("event_type").isin("purchase", "signup")).select("event_id", "streak")


@query("last_success_carried", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_success FROM events")
def last_success_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.carried(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", F.col("event_id"), "last_success").select("event_id", "last_success")


@query("weighted_rank_topk", "SELECT source_id, priority FROM inventory_source ORDER BY CASE priority WHEN 'P0' THEN 0 WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 ELSE 99 END, CASE source_type WHEN 'rss' THEN 0 WHEN 'official_research' THEN 1 ELSE 99 END, source_id LIMIT 10")
def weighted_rank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.weighted_rank(table(spark, sf_dir, "inventory_source"), "priority", {"P0": 0, "P1": 1, "P2": 2, "P3": 3}, "source_type", {"rss": 0, "official_research": 1}, "source_id", 10).select("source_id", "priority")


@query("per_source_prefix_limit", "SELECT source, item_id, ingest_seq FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ingest_seq) AS rn FROM candidate_item) WHERE rn <= 20")
def per_source_prefix_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.prefix_limit(table(spark, sf_dir, "candidate_item").select("source", "item_id", "ingest_seq"), ["source"], ["ingest_seq"], 20)


@query("best_attempt", "SELECT l_orderkey, arg_min(l_linenumber, (CASE WHEN l_returnflag = 'N' THEN 0 WHEN l_returnflag = 'A' THEN 1 ELSE 2 END, -l_quantity, -l_linenumber)) AS l_linenumber FROM lineitem GROUP BY 1")
def best_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    preference = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    return rollup.best_attempt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"), ["l_orderkey"], preference, "l_quantity", "l_linenumber").select("l_orderkey", "l_linenumber")


@query("with_defaults", "SELECT ingest_seq, coalesce(language, 'und') AS language, coalesce(source_name, 'unnamed') AS source_name FROM raw_signal")
def with_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.with_defaults(table(spark, sf_dir, "raw_signal").select("ingest_seq", "language", "source_name"), {"language": "und", "source_name": "unnamed"})
