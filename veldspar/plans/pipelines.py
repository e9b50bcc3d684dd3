"""A whole archiving run as one plan: candidates, seen state and fetched pages to documents, queue, health and summary."""

from __future__ import annotations

from dataclasses import dataclass

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, html, urls
from ..functions import text as tx
from ..operators import dedupe, state
from ..runtime import materialize, ship_package


def _with_repeats(x: DataFrame, seen: DataFrame) -> DataFrame:
    """x with outcome 'duplicate' where an earlier candidate that ended saved or partial has marked its keys.

    Looked up are the candidate's address and title; marked are the address and the document's title, which
    the page may have changed. An address the state knows keeps the title it has there.
    """
    key = lambda name, c: F.concat(F.lit(name), F.col(c))
    pairs = lambda df, *keys: df.select(F.col("pos").alias("_o"), F.explode(F.array_compact(F.array(*keys))).alias("k"))
    by_title = F.when(~F.col("matched_by").eqNullSafe("url_hash"), key("t=", "title_hash"))
    look = materialize(pairs(x, key("u=", "url_hash"), by_title), "look")
    final = x.filter(F.col("outcome").isin("saved", "partial"))
    known = seen.filter(F.col("url_hash").isNotNull()).select("url_hash", F.col("title_hash").alias("_t")).distinct()
    final = final.select("pos", "url_hash", "matched_by", urls.title_key(F.col("source_id"), F.col("title"), F.col("published")).alias("_new")).join(known, "url_hash", "left")
    title = F.when(F.col("matched_by").eqNullSafe("url_hash"), key("t=", "_t")).otherwise(key("t=", "_new"))
    marks = materialize(pairs(final, key("u=", "url_hash"), title).distinct(), "marks")
    accepted = materialize(dedupe.one_by_one(look.join(final.select(F.col("pos").alias("_o")).distinct(), "_o", "left_semi"), marks), "accepted")
    first = marks.join(accepted, "_o", "left_semi").groupBy("k").agg(F.min("_o").alias("m"))
    again = look.join(first, "k").filter("_o > m").select(F.col("_o").alias("pos")).distinct().withColumn("_again", F.lit(True))
    return x.join(again, "pos", "left").withColumn("outcome", F.when(F.col("_again"), "duplicate").otherwise(F.col("outcome"))).drop("_again")


@dataclass
class RunTables:
    """What a run leaves behind. outcomes: one row per candidate with its outcome; the others are made of it."""

    outcomes: DataFrame
    documents: DataFrame
    failed: DataFrame
    health: DataFrame
    summary: DataFrame


def archive_run(candidates: DataFrame, seen: DataFrame, pages: DataFrame, run_id: str, checked_at: str, high: int = 1500, medium: int = 300, low: int = 30) -> RunTables:
    """Run candidates (source_id, pos, title, url, published) against seen documents and fetched pages (url, text, title, error).

    A candidate is a duplicate if an earlier one of the run with its address, or with its title where the state
    doesn't know its address, ended saved or partial; else it is skipped if the state has it as accepted; the others are
    saved, partial where the page is short or empty, or failed where there is no page or an error. A failed or skipped
    candidate marks nothing, so the next one is tried. pos must be unique.
    """
    c = candidates.select("source_id", "pos", "title", "url", "published", urls.url_hash(urls.url_without_tracking("url")).alias("url_hash"), urls.title_key(F.col("source_id"), F.col("title"), F.col("published")).alias("title_hash"))
    c = state.seen_lookup(c, seen, "url_hash", "title_hash")
    p = pages.select(urls.url_hash(urls.url_without_tracking("url")).alias("url_hash"), F.col("text"), F.col("title").alias("page_title"), F.col("error"))
    p = state.latest(p, ["url_hash"], F.length(F.coalesce("text", F.lit(""))).desc(), F.col("text"))
    x = c.join(p, "url_hash", "left")
    quality = tx.quality_by_length(tx.char_count(tx.trim_u(F.col("text"))), high, medium, low)
    error = F.coalesce(F.nullif(F.col("error"), F.lit("")), F.when(F.col("text").isNull(), "no content fetched"))
    outcome = F.when(F.col("is_seen"), "skipped").when(error.isNotNull(), "failed").when(quality.isin("empty", "low"), "partial").otherwise("saved")
    x = x.withColumn("quality", quality).withColumn("error", error).withColumn("outcome", outcome).withColumn("title", F.coalesce(F.nullif("page_title", F.lit("")), "title"))
    x = materialize(x.drop("page_title", "is_seen"), "run")
    x = _with_repeats(x, seen).drop("matched_by")
    x = materialize(x, "run")
    documents = x.filter(F.col("outcome").isin("saved", "partial")).withColumn("content_hash", tx.hash_text(F.col("text"), 32)).withColumn("path", urls.archive_path(F.col("published"), F.lit(checked_at), F.col("source_id"), F.col("title")))
    failed = x.filter("outcome = 'failed'").select("source_id", "url", "url_hash", "error", classify.error_class(F.col("error")).alias("error_class"), F.lit(run_id).alias("run_id"))
    n = lambda *o: F.count_if(F.col("outcome").isin(*o))
    counts = [F.count(F.lit(1)).alias("candidates"), n("saved").alias("saved"), n("partial").alias("partial"), n("failed").alias("failed"), n("duplicate").alias("duplicates"), n("skipped").alias("skipped")]
    health = x.groupBy("source_id").agg(*counts)
    status = F.when(F.col("failed") == 0, "healthy").when(F.col("saved") + F.col("partial") + F.col("skipped") > 0, "degraded").otherwise("failed")
    health = health.withColumn("status", status).withColumn("checked_at", F.lit(checked_at))
    summary = x.agg(*counts).select(F.lit(run_id).alias("run_id"), F.lit(checked_at).alias("started_at"), "*")
    return RunTables(x, documents, failed, health, summary)


def retry_failed(queue: DataFrame, seen: DataFrame, pages: DataFrame, run_id: str, checked_at: str) -> tuple[RunTables, DataFrame]:
    """(the run of the queue's retryable rows, the queue after it): what failed again comes back with a higher retry_count, what is not retryable stays.

    queue: (source_id, pos, title, url, published, error, retryable, retry_count); pos and url must be unique.
    """
    again = queue.filter("retryable")
    run = archive_run(again.select("source_id", "pos", "title", "url", "published"), seen, pages, run_id, checked_at)
    failed = again.drop("error").join(run.outcomes.filter("outcome = 'failed'").select("pos", "error"), "pos").withColumn("retry_count", F.col("retry_count") + 1)
    return run, state.rewrite_queue(queue, again, failed.select(*queue.columns), "url")


def filings_run(candidates: DataFrame, current: DataFrame | None, run_id: str) -> RunTables:
    """Run filing candidates with their responses: saved, updated where the content differs from the key's last, duplicate, or failed without a response.

    current: (canonical_key, content_hash) of each key so far. A failed candidate changes no key.
    """
    c = F.col
    key = urls.canonical_key(c("source_type"), c("issuer_code"), c("filing_date"), c("filing_type"), c("accession_number"), c("announcement_id"), c("document_url"), c("pdf_url"), c("filing_title"))
    content = tx.content_hash(c("filing_title"), c("filing_date"), c("document_url"), c("pdf_url"), c("html_url"))
    x = candidates.withColumn("canonical_key", key).withColumn("content_hash", content)
    there = state.versions(x.filter("response is not null"), current, "canonical_key", "content_hash", "ingest_seq")
    names = F.create_map(*[F.lit(v) for kv in {"insert": "saved", "new_version": "updated", "duplicate": "duplicate"}.items() for v in kv])
    x = there.withColumn("outcome", names[c("action")]).drop("action").unionByName(x.filter("response is null").withColumn("outcome", F.lit("failed")))
    x = materialize(x, "filings")
    n = lambda o: F.count_if(c("outcome") == o)
    counts = [F.count(F.lit(1)).alias("candidates"), n("saved").alias("saved"), n("updated").alias("updated"), n("duplicate").alias("duplicates"), n("failed").alias("failed")]
    status = F.when(c("failed") == 0, "healthy").when(c("failed") < c("candidates"), "degraded").otherwise("failed")
    health = x.groupBy("source_id").agg(*counts).withColumn("status", status)
    failed = x.filter("outcome = 'failed'").select("source_id", "canonical_key", F.lit("fetch").alias("error_class"), F.lit(run_id).alias("run_id"))
    return RunTables(x, x.filter(c("outcome").isin("saved", "updated")), failed, health, x.agg(*counts).select(F.lit(run_id).alias("run_id"), "*"))


#: Extractors by extension: bytes to text. Formats without one fail, as data.
EXTRACTORS: dict[str, Callable[[Column], Column]] = {
    ".txt": lambda b: F.make_valid_utf8(b.cast("string")),
    ".md": lambda b: tx.markdown_to_text(F.make_valid_utf8(b.cast("string"))),
    ".html": lambda b: html.main_text_udf(F.make_valid_utf8(b.cast("string"))),
    ".htm": lambda b: html.main_text_udf(F.make_valid_utf8(b.cast("string"))),
}


def documents_run(files: DataFrame, index: DataFrame | None, extractors: dict[str, Callable[[Column], Column]] | None = None, low: int = 30) -> DataFrame:
    """files (source_id, pos, extension, content) with text, char_count, word_count, file_key, error and outcome.

    duplicate: the same bytes are in the index (file_key) or earlier in the source; failed: no extractor for the extension or no
    bytes; partial: fewer than `low` characters; else saved. pos must be unique.
    """
    ship_package(files.sparkSession)
    ways = extractors or EXTRACTORS
    keyed = materialize(files.select("source_id", "pos", F.sha2("content", 256).alias("_h"), F.col("content").isNotNull().alias("_there")), "files")
    known = dedupe.known_files(keyed.filter("_there"), "source_id", F.col("_h"), "pos", index).select("pos", "file_key", "is_duplicate")
    # Each extractor sees its own files only: a Python one is not run over the others.
    parts = [files.filter(F.col("extension") == e).withColumn("text", way(F.col("content"))) for e, way in ways.items()]
    parts.append(files.filter(~F.coalesce(F.col("extension").isin(*ways), F.lit(False))).withColumn("text", F.lit(None).cast("string")))
    x = parts[0]
    for p in parts[1:]:
        x = x.unionByName(p)
    x = x.drop("content").join(known, "pos", "left")
    plain = tx.collapse_ws(F.coalesce("text", F.lit("")))
    x = x.withColumn("char_count", F.length(plain)).withColumn("word_count", tx.word_count(plain))
    error = F.when(F.col("text").isNull(), F.when(F.col("file_key").isNull(), "no content").otherwise(F.concat(F.lit("no extractor for "), F.coalesce("extension", F.lit("none")))))
    outcome = F.when(F.col("is_duplicate"), "duplicate").when(error.isNotNull(), "failed").when(F.col("char_count") < low, "partial").otherwise("saved")
    return x.withColumn("error", error).withColumn("outcome", outcome).drop("is_duplicate")


def inventory_run(inventory: DataFrame, pages: DataFrame) -> DataFrame:
    """(source_id, pages, with_text, status) of every source (source_id, enabled): disabled, not_visited, failed, partial or success by its pages (source_id, text)."""
    n = pages.groupBy(F.col("source_id").alias("_k")).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("text") != "").alias("_t"))
    x = inventory.join(n, (F.col("source_id") == F.col("_k")) & F.col("enabled"), "left")
    x = x.select("source_id", "enabled", F.coalesce("_n", F.lit(0)).alias("pages"), F.coalesce("_t", F.lit(0)).alias("with_text"))
    status = F.when(~F.col("enabled"), "disabled").when(F.col("pages") == 0, "not_visited").when(F.col("with_text") == 0, "failed").when(F.col("with_text") < F.col("pages"), "partial").otherwise("success")
    return x.select("source_id", "pages", "with_text", status.alias("status"))


class Steps:
    """The steps of a run, each written once: a run that is started again goes on after its last finished step.

    A step's table is finished once Spark has written its success mark; log() lists the finished steps with their rows.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/{run_id}"

    def _there(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def run(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of a step: read if it is finished, else built and written."""
        if not self._there(name):
            build().write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.parquet(f"{self.root}/{name}")

    def log(self, names: list[str]) -> DataFrame:
        """(position, step, finished, rows) of the steps named; rows of an unfinished one are null."""
        rows = [(i, n, self._there(n)) for i, n in enumerate(names)]
        return self.spark.createDataFrame([(i, n, f, self.spark.read.parquet(f"{self.root}/{n}").count() if f else None) for i, n, f in rows], "position int, step string, finished boolean, rows long")
