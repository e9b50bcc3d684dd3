"""Payloads of feeds, services and registries brought to rows; the fetched bodies are columns of a table."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.collections import json_first
from ..functions.dates import epoch_or_date
from ..functions.html import table_udf
from ..functions.text import strip_tags
from ..functions.urls import domain, is_example_domain, url_hash
from ..operators.dedupe import first_wins

ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "link", "summary", "published", "author", "guid", "enclosure", "transcript", "duration")])
FEED = T.StructType([T.StructField("entries", T.ArrayType(ENTRY)), T.StructField("error", T.StringType())])
_NS = re.compile(r"^\{[^}]*\}")


def parse_feed(body: str | None) -> dict:
    """Entries of an RSS or Atom feed and the error that ended reading, if any; an error with entries is a warning."""
    if not body or not body.strip():
        return {"entries": [], "error": "empty"}
    parser = ET.XMLPullParser(["end"])
    entries: list[dict] = []
    error = None

    def take() -> None:
        for _, e in parser.read_events():
            if _NS.sub("", e.tag) not in ("item", "entry"):
                continue
            got: dict[str, str | None] = dict.fromkeys(ENTRY.names)
            for c in e:
                tag, text = _NS.sub("", c.tag), " ".join("".join(c.itertext()).split()) or None
                if tag == "link":
                    href = c.attrib.get("href") or text
                    if href and c.attrib.get("type", "").startswith("text/") and not got["transcript"]:
                        got["transcript"] = href
                    if href and (not got["link"] or c.attrib.get("rel", "alternate") == "alternate"):
                        got["link"] = href
                elif tag == "enclosure":
                    got["enclosure"] = got["enclosure"] or c.attrib.get("url") or c.attrib.get("href")
                else:
                    name = {"description": "summary", "content": "summary", "pubDate": "published", "updated": "published", "creator": "author", "id": "guid"}.get(tag, tag)
                    if name in got and not got[name]:
                        got[name] = text
            got["transcript"] = got["transcript"] or got["link"]
            entries.append(got)
            e.clear()

    try:
        parser.feed(body.strip())
        take()
        parser.close()
    except ET.ParseError as exc:
        error = str(exc)
        try:
            take()
        except ET.ParseError:
            pass
    return {"entries": entries, "error": error}


@F.pandas_udf(FEED)
def parse_feed_udf(body: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_feed(b) for b in body], columns=FEED.names)


def feed_candidates(pages: DataFrame, keys: list[str], body: str, max_items: int | None = None, keep_linkless: str | None = None) -> DataFrame:
    """One row per feed entry with its position.

    Entries need a title and a link; with keep_linkless an entry without link stays and the named column
    (the feed's address) becomes its note. max_items counts an entry whether it is kept or not.
    """
    x = pages.select(*keys, *([keep_linkless] if keep_linkless and keep_linkless not in keys else []), parse_feed_udf(body).alias("f"))
    x = x.select("*", F.posexplode("f.entries").alias("pos", "e")).drop("f")
    if max_items:
        x = x.filter(F.col("pos") < max_items)
    fields = [F.col(f"e.{n}").alias(n) for n in ENTRY.names if n != "summary"]
    summary = F.substring(strip_tags(F.col("e.summary")), 1, 500).alias("summary")
    if keep_linkless:
        note = F.when(F.col("e.link").isNull(), F.col(keep_linkless)).alias("source_note")
        return x.filter("e.title is not null").select(*keys, "pos", *fields, summary, note)
    return x.filter("e.title is not null and e.link is not null").select(*keys, "pos", *fields, summary)


def columnar_filings(df: DataFrame, body: str, forms: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Rows of a submissions payload whose recent filings are parallel arrays. Rows without accession go; a limit counts kept rows."""
    names = ["accessionNumber", "filingDate", "reportDate", "form", "primaryDocument", "primaryDocDescription"]
    schema = f"cik string, entityName string, filings struct<recent: struct<{', '.join(f'{n}: array<string>' for n in names)}>>"
    x = df.select(F.from_json(body, schema).alias("j")).select("j.cik", "j.entityName", *[F.coalesce(F.col(f"j.filings.recent.{n}"), F.array().cast("array<string>")).alias(n) for n in names])
    x = x.select("cik", "entityName", F.posexplode(F.arrays_zip(*names)).alias("pos", "z")).select("cik", "entityName", "pos", *[F.coalesce(F.col(f"z.{n}"), F.lit("")).alias(n) for n in names])
    x = x.filter("accessionNumber <> ''")
    if forms:
        x = x.filter(F.col("form").isin(*forms))
    folder = F.concat_ws("/", F.regexp_replace("cik", "^0+", ""), F.regexp_replace("accessionNumber", "-", ""))
    x = x.withColumn("document_path", F.concat_ws("/", folder, "primaryDocument"))
    if limit:
        from ..operators.filters import prefix_limit

        x = prefix_limit(x, ["cik"], ["pos"], limit)
    return x


def announcement_filings(df: DataFrame, body: str, kinds: list[str] | None = None) -> DataFrame:
    """Rows of an announcements payload under announcements, data or list, with aliases of each field; rows of an empty kind pass the filter."""
    item = "array<string>"
    rows = F.coalesce(*[F.from_json(F.get_json_object(body, f"$.{k}"), item) for k in ("announcements", "data", "list")])
    x = df.select(F.posexplode(rows).alias("pos", "r"))
    r = F.col("r")
    x = x.select(
        "pos", json_first(r, "$.announcementId", "$.id").alias("announcement_id"), json_first(r, "$.announcementTitle", "$.title").alias("title"), F.coalesce(json_first(r, "$.announcementType", "$.type"), F.lit("")).alias("kind"),
        json_first(r, "$.secCode", "$.code").alias("issuer_code"), json_first(r, "$.secName", "$.name").alias("issuer_name"), epoch_or_date(json_first(r, "$.announcementTime", "$.date")).alias("filing_date"), json_first(r, "$.adjunctUrl", "$.url").alias("path"),
    )
    return x.filter((F.col("kind") == "") | F.col("kind").isin(*kinds)) if kinds else x


def table_filings(df: DataFrame, keys: list[str], body: str) -> DataFrame:
    """Rows of an announcement table: code, name, title, kind and, last, the date; rows of three cells or more that aren't headers."""
    x = df.select(*keys, F.explode(table_udf(body)).alias("t")).filter("not t.header and size(t.cells) >= 3")
    cell = lambda i: F.try_element_at(F.col("t.cells"), F.lit(i))
    x = x.select(*keys, F.col("t.row").alias("row"), cell(1).alias("code"), cell(2).alias("name"), cell(3).alias("title"), F.when(F.size("t.cells") >= 5, cell(4)).alias("kind"), cell(-1).alias("filed"), F.col("t.href").alias("href"))
    return x.withColumn("is_pdf", F.coalesce(F.lower("href").rlike(r"\.pdf($|\?)"), F.lit(False))).withColumn("filing_id", F.substring(F.md5("href"), 1, 16))


def search_results(df: DataFrame, body: str, path: str = "$.results", max_results: int = 10) -> DataFrame:
    """(rank, title, url, snippet, domain) of a search payload; rank counts from 1."""
    x = df.select(F.posexplode(F.from_json(F.get_json_object(body, path), "array<struct<title:string,url:string,content:string,description:string,published_date:string>>")).alias("pos", "r"))
    x = x.filter(F.col("pos") < max_results)
    return x.select((F.col("pos") + 1).alias("rank"), "r.title", "r.url", F.coalesce("r.content", "r.description").alias("snippet"), F.col("r.published_date").alias("published"), domain(F.col("r.url")).alias("domain"))


def issue_signals(df: DataFrame, body: str) -> DataFrame:
    """Signals of an issue search: title and body as text, labels as names."""
    item = "array<struct<id:bigint,html_url:string,title:string,body:string,created_at:string,state:string,comments:int,user:struct<login:string>,labels:array<struct<name:string>>>>"
    x = df.select(F.explode(F.from_json(F.get_json_object(body, "$.items"), item)).alias("i"))
    return x.select(F.col("i.id").alias("id"), F.col("i.html_url").alias("url"), F.col("i.title").alias("title"), F.concat_ws("\n\n", "i.title", "i.body").alias("raw_text"), F.col("i.created_at").alias("published_at"), F.col("i.user.login").alias("author"), F.transform("i.labels", lambda v: v["name"]).alias("labels"))


def story_signals(df: DataFrame, body: str) -> DataFrame:
    """Signals of a story search: the text is story, comment or title, the address falls back to the item's own."""
    item = "array<struct<objectID:string,title:string,url:string,author:string,created_at:string,num_comments:int,points:int,story_text:string,comment_text:string>>"
    x = df.select(F.explode(F.from_json(F.get_json_object(body, "$.hits"), item)).alias("h"))
    some = lambda *c: F.coalesce(*[F.nullif(F.col(f"h.{n}"), F.lit("")) for n in c])
    return x.select(F.col("h.objectID").alias("id"), "h.title", F.coalesce(some("url"), F.concat(F.lit("item:"), F.col("h.objectID"))).alias("url"), some("story_text", "comment_text", "title").alias("raw_text"), F.col("h.created_at").alias("published_at"), "h.author")


def normalised_results(results: DataFrame) -> DataFrame:
    """Search results (rank, url, ...) with domain and result_id: documentation domains go, each address stays at its first rank, ranks stay as they were."""
    x = results.withColumn("domain", domain(F.col("url"))).withColumn("result_id", url_hash(F.col("url")))
    return first_wins(x.filter(~is_example_domain(F.col("domain"))), F.col("result_id"), ["rank"])


# Words of a column's head by the field it names, in the order that decides.
HEADS = [("date", "date|time"), ("company", "company"), ("ticker", "ticker|symbol"), ("broker", "broker|firm"), ("analyst", "analyst"), ("action", "action"), ("rating", "rating"), ("price_target", "target|price"), ("url", "url|link|detail"), ("title", "title|headline")]
TABLE_FIELDS = ["date", "company", "ticker", "broker", "analyst", "action", "rating", "rating_from", "rating_to", "price_target", "price_target_from", "price_target_to", "url", "title"]


def head_field(head: Column) -> Column:
    """The field that a column's head names; ratings and targets part into from and to."""
    low = F.lower(F.trim(head))
    out = F.lit(None).cast("string")
    for name, words in reversed(HEADS):
        value = F.lit(name)
        if name in ("rating", "price_target"):
            value = F.when(low.contains("from"), f"{name}_from").when(low.contains("to"), f"{name}_to").otherwise(name)
        out = F.when(low.rlike(words), value).otherwise(out)
    return out


def named_table_rows(df: DataFrame, keys: list[str], body: str) -> DataFrame:
    """(keys, table, row, TABLE_FIELDS, href): rows of every table by the names of its first header row; empty cells and unknown heads give nulls."""
    x = df.select(*keys, F.explode(table_udf(body)).alias("t")).select(*keys, "t.*")
    heads = x.filter("header").groupBy(*keys, "table").agg(F.min_by("cells", "row").alias("heads"))
    heads = heads.select(*keys, "table", F.transform("heads", head_field).alias("heads"))
    rows = x.filter("not header").join(heads, [*keys, "table"])
    # Of two columns of one name the last counts.
    cell = lambda name: F.nullif(F.try_element_at("cells", F.greatest(F.size("heads") - F.array_position(F.reverse("heads"), name) + 1, F.lit(1)).cast("int")), F.lit(""))
    return rows.select(*keys, "table", "row", *[F.when(F.array_contains("heads", n), cell(n)).alias(n) for n in TABLE_FIELDS], "href")
