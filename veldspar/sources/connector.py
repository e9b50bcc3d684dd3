"""A Python data source for fetched pages, dispatch of sources by type, and what a fetch says of itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyarrow import fs

from ..functions import classify

SCHEMA = "path string, status int, error string, body string"


class _File(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _listing(folder: str) -> list[tuple[str, int]]:
    """(path, time of last change in nanoseconds) of the files of a folder of any file system."""
    system, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    prefix = folder.split("://")[0] + "://" if "://" in folder else ""
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((prefix + f.path, f.mtime_ns or 0) for f in found if f.is_file)


def _records(paths: list[str]):
    for p in paths:
        try:
            system, path = fs.FileSystem.from_uri(p) if "://" in p else (fs.LocalFileSystem(), p)
            with system.open_input_stream(path) as f:
                yield p, 200, None, f.read().decode("utf-8", "replace")
        except OSError as exc:
            yield p, 0, f"{type(exc).__name__}: {exc.strerror or exc}", None


def _parts(names: list[str], size: int) -> list[_File]:
    return [_File(names[i : i + size]) for i in range(0, len(names), size)] or [_File([])]


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.size = options["path"], int(options.get("filesPerPartition", 64))

    def partitions(self):
        return _parts([p for p, _ in _listing(self.folder)], self.size)

    def read(self, partition):
        yield from _records(partition.paths)


class PageStreamReader(DataSourceStreamReader):
    """Files new since the last offset, in order of their time and name.

    The offset is the time and name of the last file taken, so a file that comes later under a name that sorts
    earlier is taken once, and none is taken again. Files must be moved into the folder whole, at a time not before those taken.
    """

    def __init__(self, options: dict):
        self.folder, self.size = options["path"], int(options.get("filesPerPartition", 64))

    def initialOffset(self):
        return {"time": -1, "path": ""}

    def latestOffset(self):
        last = max(((t, p) for p, t in _listing(self.folder)), default=(-1, ""))
        return {"time": last[0], "path": last[1]}

    def partitions(self, start, end):
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        return _parts([p for t, p in sorted((t, p) for p, t in _listing(self.folder)) if low < (t, p) <= high], self.size)

    def read(self, partition):
        yield from _records(partition.paths)

    def commit(self, end):
        pass


class PageSource(DataSource):
    """spark.dataSource.register(PageSource); spark.read.format('pages').load(folder)."""

    @classmethod
    def name(cls):
        return "pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PageReader(self.options)

    def streamReader(self, schema):
        return PageStreamReader(self.options)


def dispatch(sources: DataFrame, pages: DataFrame, connectors: dict[str, Callable[[DataFrame], DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(candidates, unsupported sources): the pages (source_id, body, ...) of each source go to the connector of its source_type.

    A connector takes the pages of its type and gives candidates with the same columns as the others; sources of a type that
    has none come back with error 'unsupported source_type'.
    """
    known = sources.filter(F.col("source_type").isin(*connectors))
    x = pages.join(known.select("source_id", "source_type"), "source_id")
    out = None
    for kind, connector in connectors.items():
        found = connector(x.filter(F.col("source_type") == kind))
        out = found if out is None else out.unionByName(found, allowMissingColumns=True)
    rest = sources.filter(~F.coalesce(F.col("source_type").isin(*connectors), F.lit(False)))
    return out, rest.select("source_id", "source_type", F.concat(F.lit("unsupported source_type: "), F.coalesce("source_type", F.lit(""))).alias("error"))


def fetched(requests: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """requests with what was fetched (status, error, body, error_type, retryable, access_denied); an address without a page has error 'not fetched'."""
    x = requests.join(pages.select(F.col(url).alias("_u"), "status", "error", "body"), F.col(url) == F.col("_u"), "left").drop("_u")
    x = x.withColumn("error", F.when(F.col("body").isNull(), F.coalesce("error", F.lit("not fetched"))).otherwise(F.col("error")))
    kind = F.when(F.col("error").isNotNull() | (F.col("status") >= 400), classify.network_error(F.col("error"), F.col("status")))
    return x.withColumn("error_type", kind).withColumn("retryable", classify.is_retryable(F.col("status"), kind)).withColumn("access_denied", access_denied(F.col("body")))


# Words that mark the start of a page as closed to readers.
CLOSED_WORDS = ["access denied", "subscription required", "subscribe to continue", "please log in", "please sign in", "members only"]


def access_denied(body: Column) -> Column:
    """Whether the first 5,000 characters say that the page is closed; the bound is the probe's definition."""
    return F.coalesce(classify.mentions(F.lower(F.substring(body, 1, 5000)), *CLOSED_WORDS), F.lit(False))


def decoded(raw: Column, content_type: Column) -> Column:
    """Bytes as text by the charset of the header, else of the markup's first 1,024 bytes, else UTF-8; bytes that don't fit become U+FFFD."""
    head = F.lower(F.decode(F.substring(raw, 1, 1024), "ISO-8859-1"))
    named = F.coalesce(*[F.nullif(F.regexp_extract(c, "charset=[\"']?([a-z0-9_-]+)", 1), F.lit("")) for c in (F.lower(content_type), head)], F.lit("utf-8"))
    out = F.when(named.isin("iso-8859-1", "latin-1", "latin1", "windows-1252"), F.decode(raw, "ISO-8859-1")).when(named == "us-ascii", F.decode(raw, "US-ASCII"))
    return out.when(named == "utf-16", F.decode(raw, "UTF-16")).otherwise(F.make_valid_utf8(raw.cast("string")))


def probe_links(body: Column, keywords: list[str], bound: int = 102_400, counted: int = 5) -> Column:
    """How many addresses in the first `bound` characters name a keyword, at most `counted`; both bounds are the probe's definition."""
    hrefs = F.regexp_extract_all(F.lower(F.substring(body, 1, bound)), F.lit("href=[\"']([^\"']+)[\"']"), F.lit(1))
    return F.least(F.size(F.filter(F.array_distinct(hrefs), lambda h: F.exists(F.array(*map(F.lit, keywords)), lambda k: F.contains(h, k)))), F.lit(counted))


# Paths at which sites keep feeds and maps.
FEED_PATHS = ["/feed", "/rss", "/rss.xml", "/feed.xml", "/atom.xml", "/index.xml", "/sitemap.xml", "/sitemap_index.xml"]


def feed_probes(sites: DataFrame, site: str) -> DataFrame:
    """(site, url): the addresses to try for a feed or map of each site."""
    root = F.regexp_extract(site, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    return sites.select(F.col(site), F.explode(F.array(*[F.concat(root, F.lit(p)) for p in FEED_PATHS])).alias("url")).filter(root != "")


def page_signals(body: Column) -> Column:
    """struct<kind, json_ld, json_ld_types, open_graph, canonical, feeds>: whether a body is a feed, map or page, and its counts of machine-read data."""
    low = F.lower(F.coalesce(body, F.lit("")))
    start = F.substring(F.ltrim(low), 1, 500)
    kind = F.when(start.rlike("<rss|<feed|<rdf:rdf"), "feed").when(start.rlike("<urlset|<sitemapindex"), "sitemap").when(low == "", "empty").otherwise("page")
    scripts = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit("(?is)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>"), F.lit(1))
    types = F.filter(F.transform(scripts, lambda x: F.get_json_object(x, "$['@type']")), lambda t: t.isNotNull())
    count = lambda p: F.regexp_count(low, F.lit(p))
    return F.struct(
        kind.alias("kind"), F.size(scripts).alias("json_ld"), types.alias("json_ld_types"), count("<meta[^>]*property=[\"']og:").alias("open_graph"), count("<link[^>]*rel=[\"']canonical").alias("canonical"),
        count("<link[^>]*type=[\"']application/(?:rss|atom)").alias("feeds"),
    )
