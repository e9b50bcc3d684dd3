"""File sources: JSONL, CSV, address lists, configuration, documents of a folder."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trim_u
from ..functions.urls import file_extension, media_type


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """JSON lines by an explicit schema. Blank lines are skipped; a bad line fails the read if strict, else it is left out. A missing path is an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_jsonl_with_rejects(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines as text)."""
    lines = spark.read.text(path).filter(trim_u(F.col("value")) != "")
    bad = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    x = lines.select(F.from_json("value", bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"), "value")
    good = x.filter(F.col("r").isNotNull() & F.col("r._bad").isNull()).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema])
    return good, x.filter(F.col("r").isNull() | F.col("r._bad").isNotNull()).select("value")


def with_required(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows in which every required column is there."""
    return df.dropna(subset=required)


def first_records(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first n rows by an order; none or no positive n means all."""
    return df.orderBy(*order).limit(n) if n and n > 0 else df


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column text; a byte-order mark is no part of the first name. A missing path gives no rows and columns."""
    if not _exists(spark, path):
        return spark.createDataFrame([], T.StructType([]))
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """(url, pos): trimmed lines without comments and blanks, each address once, at its first line; pos rises with the lines."""
    # Blocks of a file are read by many tasks; an id rises along the file, so it orders the lines.
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), trim_u(F.col("value")).alias("url"))
    return lines.filter("url <> '' and not startswith(url, '#')").groupBy("url").agg(F.min("pos").alias("pos"))


def read_config(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The list under a key of a small JSON or YAML file as a table; configuration is read on the driver."""
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    if path.endswith((".yaml", ".yml")):
        import yaml

        data = yaml.safe_load(text)
    else:
        data = json.loads(text) if text.strip() else None
    rows = (data or {}).get(key) or []
    return spark.createDataFrame([json.dumps(r) for r in rows], "string").select(F.from_json("value", F.schema_of_json(F.lit(json.dumps(rows[0])))).alias("r")).select("r.*") if rows else spark.createDataFrame([], T.StructType([]))


def load_env(path: str) -> dict[str, str]:
    """KEY=VALUE lines as a dict, quotes stripped; a variable that is set already keeps its value."""
    out: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                k, eq, v = line.strip().partition("=")
                if eq and not k.startswith("#"):
                    out[k.strip()] = os.environ.get(k.strip(), v.strip().strip("\"'"))
    return out


def scan_documents(spark: SparkSession, path: str, glob: str = "*", max_documents: int | None = None) -> DataFrame:
    """(path, stem, extension, media_type, size, modified, sha256, content) of the files of a folder, by path.

    The limit is the feature; it is taken by path, so it doesn't depend on listing order.
    """
    x = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    x = x.select("path", F.regexp_replace(name, r"\.[^.]+$", "").alias("stem"), file_extension(F.col("path")).alias("extension"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), "content")
    x = x.withColumn("media_type", media_type(F.col("extension")))
    return x.orderBy("path").limit(max_documents) if max_documents else x


def latest_file(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, modified) of the file written last; ties go to the greater path."""
    x = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", F.col("modificationTime").alias("modified"))
    return x.agg(F.max(F.struct("modified", "path")).alias("m")).select("m.path", "m.modified").filter("path is not null")


def signals_of_urls(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signals, errors) of a table with url, text and notes: the text is text, notes or address; an address must be usable."""
    from ..functions.urls import url_problem_udf

    some = lambda *c: F.coalesce(*[F.nullif(trim_u(F.col(n)), F.lit("")) for n in c])
    x = rows.withColumn("problem", url_problem_udf("url")).withColumn("raw_text", some("text", "notes", "url"))
    return x.filter("problem is null").drop("problem"), x.filter("problem is not null").select("url", "problem")


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """(path, lines): the non-blank lines of each file; a file without any has none and no row."""
    return spark.read.text(path).select(F.input_file_name().alias("path"), "value").filter(trim_u(F.col("value")) != "").groupBy("path").agg(F.count(F.lit(1)).alias("lines"))


def missing_files(spark: SparkSession, wanted: DataFrame, path: str, root: str) -> DataFrame:
    """Rows of wanted whose path, relative to the root, names no file below it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString().rstrip("/")
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("_p"))
    plain = F.regexp_replace(F.lit(base), "^[a-z0-9]+:/+", "/")
    return wanted.withColumn("_w", F.concat(plain, F.lit("/"), F.col(path))).join(there, F.col("_w") == F.col("_p"), "left_anti").drop("_w")


def archive_candidates(log: DataFrame, max_items: int | None = None) -> DataFrame:
    """Candidates (source_id, pos, title, url, published_at, author, summary, content_hash) of an article log (article_id, source, title, url, canonical_url, captured_at, pos).

    Rows without an address go; the first max_items valid ones of each source stay, the limit being the feature.
    """
    from ..operators.filters import prefix_limit

    some = lambda *c: F.coalesce(*[F.nullif(F.trim(F.col(n)), F.lit("")) for n in c if n in log.columns], F.lit(None).cast("string"))
    x = log.select(F.col("source").alias("source_id"), "pos", some("title").alias("title"), some("canonical_url", "url").alias("url"), some("published_at", "captured_at").alias("published_at"), some("author", "account_name").alias("author"), some("digest").alias("summary"), some("content_hash").alias("content_hash"))
    x = x.filter("url is not null")
    return prefix_limit(x, ["source_id"], ["pos"], max_items) if max_items else x
