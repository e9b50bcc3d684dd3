"""Sinks: logs, snapshots, versioned tables, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import table_cell
from ..operators.rollup import latest_last_wins
from ..runtime import materialize


def append_log(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """Append rows to a JSON-lines log."""
    df.write.mode("append").option("ignoreNullFields", not keep_nulls).json(path)


def write_csv(df: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """CSV with a header; columns beyond the fields are left out."""
    (df.select(*fields) if fields else df).write.mode("overwrite").option("header", True).csv(path)


def write_latest(log: DataFrame, path: str, keys: list[str], position: str) -> None:
    """The last row of each key as a snapshot."""
    latest_last_wins(log, keys, position).write.mode("overwrite").parquet(path)


class VersionedTable:
    """A Parquet table that is rewritten as a whole: each version is a folder, and the pointer of the highest number names the current one.

    A pointer is written under another name and renamed, and no pointer is ever changed: a reader always finds one, and a
    writer that dies in between leaves the last. Of two writers at once one fails.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _pointer(self) -> int | None:
        system, p = self._hadoop("pointer-*")
        names = [f.getPath().getName() for f in (system.globStatus(p) or [])]
        return max((int(n.removeprefix("pointer-")) for n in names if n[8:].isdigit()), default=None)

    def current(self) -> str | None:
        n = self._pointer()
        return None if n is None else self.spark.read.text(f"{self.path}/pointer-{n:012d}", wholetext=True).first()[0].strip()

    def read(self) -> DataFrame | None:
        v = self.current()
        return self.spark.read.parquet(f"{self.path}/{v}") if v else None

    def replace(self, df: DataFrame) -> str:
        n = self._pointer()
        v = f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{v}")
        system, new = self._hadoop(f".pointer-{v}")
        out = system.create(new, False)
        out.write(bytearray(v.encode()))
        out.close()
        name = f"pointer-{0 if n is None else n + 1:012d}"
        if system.exists(self._hadoop(name)[1]) or not system.rename(new, self._hadoop(name)[1]):
            raise RuntimeError(f"another writer made {name}")
        return v


def fan_out(df: DataFrame, targets: dict[str, tuple[Column | None, str]]) -> None:
    """One pass over df's lineage for several sinks: name -> (filter or None, path). The rows are written once and read back for each sink."""
    kept = materialize(df, "fan")
    for predicate, path in targets.values():
        (kept.filter(predicate) if predicate is not None else kept).write.mode("overwrite").parquet(path)


def document_markdown(title: Column, source: Column, published: Column, url: Column, body: Column) -> Column:
    """A document as Markdown: heading, facts that are there, body or a placeholder."""
    fact = lambda name, c: F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"- {name}: "), c))
    facts = F.concat_ws("\n", fact("Source", source), fact("Published", published), fact("URL", url))
    text = F.coalesce(F.nullif(F.trim(body), F.lit("")), F.lit("(no content)"))
    return F.concat_ws("\n\n", F.concat(F.lit("# "), F.coalesce(title, F.lit("Untitled"))), F.nullif(facts, F.lit("")), text)


def report_table(df: DataFrame, columns: list[str], order: list[str], max_rows: int = 200) -> str:
    """A small result as a Markdown table; it shows max_rows rows and says how many there are."""
    n = df.count()
    rows = df.orderBy(*order).select(*[table_cell(F.col(c).cast("string")).alias(c) for c in columns]).limit(max_rows).collect()
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    lines += ["| " + " | ".join(r[c] or "" for c in columns) + " |" for r in rows]
    return "\n".join([*lines, "", f"{n} rows"])


def manifest(files: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """One row that lists a run's artifacts: (run_id, created_at, n, bytes, files as JSON by path)."""
    entry = F.struct("path", "size", "sha256")
    listed = F.to_json(F.array_sort(F.collect_list(entry)))
    return files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), listed.alias("files")).select(F.lit(run_id).alias("run_id"), F.lit(created_at).alias("created_at"), "n", "bytes", "files")


def archive_documents(documents: DataFrame, root: str) -> DataFrame:
    """Append documents (document_id, path, title, source_name, published_at, url, text, html, raw, content_hash) to an archive and return the index rows added.

    Bodies stand in four tables by kind (markdown, html, raw, metadata), each by year and month of its path, where they
    can be read by key; the index has one row a document with its four paths and never a body.
    """
    day = F.regexp_extract("path", r"(\d{4})/(\d{2})/", 0)
    x = documents.withColumn("month", F.regexp_replace(day, "/", ""))
    body = document_markdown(F.col("title"), F.col("source_name"), F.col("published_at"), F.col("url"), F.col("text"))
    facts = F.to_json(F.struct("document_id", "title", "source_name", "published_at", "url", "content_hash"))
    for kind, c in (("markdown", body), ("html", F.col("html")), ("raw", F.col("raw")), ("metadata", facts)):
        x.filter(c.isNotNull()).select("document_id", "path", "month", c.alias("body")).write.mode("append").partitionBy("month").parquet(f"{root}/{kind}")
    paths = [F.when(c.isNotNull(), F.concat("path", F.lit(f"/{n}"))).alias(f"{k}_path") for k, n, c in (("markdown", "document.md", body), ("html", "document.html", F.col("html")), ("raw", "raw.html", F.col("raw")), ("metadata", "metadata.json", facts))]
    index = x.select("document_id", "path", "title", "source_name", "published_at", "url", "content_hash", *paths)
    append_log(index, f"{root}/index")
    return index


def archive_filings(filings: DataFrame, root: str) -> DataFrame:
    """Append filings (canonical_key, content_hash, raw, and their facts) and return the index rows added: the raw responses, a metadata record each, and the index without bodies."""
    facts = [c for c in filings.columns if c != "raw"]
    filings.filter("raw is not null").select("canonical_key", "raw").write.mode("append").parquet(f"{root}/raw")
    filings.select("canonical_key", F.to_json(F.struct(*facts)).alias("metadata")).write.mode("append").parquet(f"{root}/metadata")
    index = filings.select(*facts)
    append_log(index, f"{root}/index")
    return index


def archive_extracted(documents: DataFrame, root: str) -> DataFrame:
    """Append extracted documents (canonical_key, text, content: the file's bytes, and their facts); raw copies are named by the first 64 characters of the key."""
    facts = [c for c in documents.columns if c not in ("text", "content")]
    documents.select(F.substring("canonical_key", 1, 64).alias("name"), "content").write.mode("append").parquet(f"{root}/raw")
    documents.select("canonical_key", "text").write.mode("append").parquet(f"{root}/text")
    index = documents.select(*facts, F.concat(F.lit("raw/"), F.substring("canonical_key", 1, 64)).alias("raw_path"))
    append_log(index, f"{root}/index")
    return index


class Report:
    """A Markdown report put together part by part."""

    def __init__(self) -> None:
        self.parts: list[str] = []

    def heading(self, text: str, level: int = 1) -> Report:
        self.parts.append("#" * min(max(level, 1), 6) + " " + text)
        return self

    def text(self, text: str) -> Report:
        self.parts.append(text)
        return self

    def bullets(self, items: list[str]) -> Report:
        self.parts.append("\n".join(f"- {x}" for x in items))
        return self

    def code(self, text: str, language: str = "") -> Report:
        self.parts.append(f"```{language}\n{text}\n```")
        return self

    def rule(self) -> Report:
        self.parts.append("---")
        return self

    def table(self, df: DataFrame, columns: list[str], order: list[str], max_rows: int = 200) -> Report:
        self.parts.append(report_table(df, columns, order, max_rows))
        return self

    def build(self) -> str:
        return "\n\n".join(self.parts) + "\n"
