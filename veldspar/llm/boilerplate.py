"""Page boilerplate: site template removal.

A page is a sequence of lines; each line is a leaf element, a navigation row an element of its parts,
and a heading with its run of headline-like items a list element. Elements are hashed, counted per
host, and those that recur across many pages of a host are its template and deleted with their items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import bounded_broadcast, materialize, only_first, ship_package, table
from .mojibake import restore, restored_lines

#: Share of a host's pages from which an element is template, and pages it must be on at least.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.075, 3
#: Share from which an element that only stands outside the article is template.
EDGE_SHARE = 0.008

_DIGITS = re.compile("[0-9]+")
_LETTER = re.compile(r"[^\W\d_]")
SENTENCE_END = re.compile("[.!…。！；;][\"'”’»」』）)\\]]*$")
_ENDED, _QUOTES = set(".!…。！；;"), "\"'”’»」』）)]"
_PART_SIGNS = set("·|/»>›•–-")
_PARTS = re.compile(r"\s+[·|/»>›•–-]\s+|\s*[|»›]\s*")
_BULLET = re.compile(r"(?:[•*·\-–]|\d{1,2}[.)、])\s+")
CJK = re.compile("[\u3040-ヿ㐀-鿿]")
_NAME = re.compile(r"(?:\b[^\W\d_]\.\s+)?\b[A-ZÀ-ÞŽА-ЯЁ][\w’-]+(?:\s+(?:&\s+)?[A-ZÀ-ÞŽА-ЯЁ][\w’-]+)*")
_COLON = re.compile("^([^：:]{2,12}[：:]).{1,24}$")

PARAGRAPH, FIGURE, ITEM, BULLET, NAV, BLANK = 1, 2, 3, 4, 5, 0


def _hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


def line_form(line: str) -> str:
    """The line without digits, in lower case, white space trimmed and collapsed."""
    return " ".join(_DIGITS.sub("", line.lower()).split())


def line_kind(line: str) -> int:
    s = line.strip()
    if not s:
        return BLANK
    if "\t" in s:
        return FIGURE
    wide = not s.isascii() and CJK.search(s) is not None
    ended = s.rstrip(_QUOTES)[-1:] in _ENDED
    if not ended:
        parts = [] if _PART_SIGNS.isdisjoint(s) else [p for p in _PARTS.split(s) if p.strip()]
        if len(parts) >= 3 and max(map(len, parts)) <= (14 if wide else 34):
            return NAV
        if _BULLET.match(s):
            return BULLET
    if len(s) > (70 if wide else 170) or (ended and len(s) >= (16 if wide else 40)):
        return PARAGRAPH
    return ITEM


def _group_form(line: str, kind: int, form: str) -> str:
    """The form of the element with what varies left out: the last parts of a row, the names of a byline."""
    if kind == NAV:
        return "row:" + "|".join([p.strip() for p in _PARTS.split(form) if p.strip()][:2])
    if kind in (ITEM, PARAGRAPH) and len(line) <= 90:
        if len(line) <= 36 and (m := _COLON.match(line.strip())):
            return "label:" + m[1].lower()
        first, _, more = line.strip().partition(" ")
        rest = line_form(first + " " + _NAME.sub("\x00", more))
        if "\x00" in rest and len(_LETTER.findall(rest)) >= 2 and rest.count("\x00") <= 3 and len(rest.split()) <= 12:
            return "names:" + rest
    return form


class _Elements(dict):
    """Line to (hash, group hash, kind, length of a paragraph of the article, else 0); sites repeat their lines, so they are kept."""

    def __missing__(self, line: str) -> tuple[int, int, int, bool, str]:
        if len(self) > 100_000:
            self.clear()
        k, form = line_kind(line), line_form(line)
        # Notices are short; paragraphs of the article have some length.
        long = k == PARAGRAPH and (len(form) >= 110 or (len(form) >= 45 and not form.isascii() and CJK.search(form) is not None))
        h, group = _hash(form), _group_form(line, k, form)
        got = (h, h if group is form else _hash(group), k, long, form)
        if len(line) <= 200:
            self[line] = got
        return got


_ELEMENTS = _Elements()


def parse_page(text: str | None, title: str | None) -> list[tuple]:
    """(no, hash, group hash, kind, place, kind of the next line, is the title) of each non-blank line.

    place: 0 before the first paragraph, 1 within the article, 2 after its last paragraph.
    """
    if not text:
        return []
    want = line_form(restore(title)) if title else None
    restored = text.split("\n") if text.isascii() else restored_lines(text)
    rows = [(no, *_ELEMENTS[line]) for no, line in enumerate(restored, 1) if line and not line.isspace()]
    # The article begins and ends with its first and last paragraph of some length.
    paragraphs = [i for i, r in enumerate(rows) if r[4]] or [i for i, r in enumerate(rows) if r[3] == PARAGRAPH]
    first, last = (paragraphs[0], paragraphs[-1]) if paragraphs else (len(rows), -1)
    follow = [r[3] for r in rows[1:]] + [0]
    return [(r[0], r[1], r[2], r[3], 0 if i < first else 2 if i > last else 1, f, want is not None and r[5] == want) for i, (r, f) in enumerate(zip(rows, follow, strict=True))]


COLUMNS = {"no": "int", "h": "long", "g": "long", "k": "int", "place": "int", "next": "int", "title": "int"}


def _lists(values: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(values))


def page_lines(pages: DataFrame, keys: list[str], host: str, title: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """(keys, host, keep, one array for each of COLUMNS): the parsed lines of each page; the host column becomes 'host'."""
    ship_package(pages.sparkSession)
    types = dict(pages.dtypes)
    kept = [*keys, host, *(keep or [])]
    schema = ", ".join(f"{'host' if c == host else c} {types[c]}" for c in kept) + ", " + ", ".join(f"{c} array<{t}>" for c, t in COLUMNS.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parsed = [parse_page(x, t) for x, t in zip(b.column(len(kept) + 1).to_pylist(), b.column(len(kept)).to_pylist(), strict=True)]
            size = np.array([len(p) for p in parsed], np.int64)
            flat = np.array([r for p in parsed for r in p], dtype=np.int64).reshape(-1, 7)
            lists = [_lists(flat[:, i].astype(np.int32 if t == "int" else np.int64), size) for i, t in enumerate(COLUMNS.values())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], *lists], [*("host" if c == host else c for c in kept), *COLUMNS])

    return pages.select(*kept, title, text).mapInArrow(run, schema)


def _distinct_elements(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per page and element hash, of lines and of groups, with what is said of the element there."""
    x = parsed.select(*keys, "host", F.explode(F.arrays_zip("h", "g", "k", "place", "next", "title")).alias("l")).filter("l.title = 0")
    both = F.explode(F.array_distinct(F.array(F.col("l.h"), F.col("l.g")))).alias("e")
    x = x.select(*keys, "host", both, F.col("l.k").alias("k"), F.col("l.place").alias("place"), F.col("l.next").alias("next"))
    # Repeats of an element within a page count once; the map side combines before the page's rows meet.
    return x.groupBy(*keys, "host", "e").agg(
        F.max("k").alias("k"), F.max(F.when(F.col("place") != 1, 1).otherwise(0)).alias("edge"), F.max(F.when(F.col("place") == 1, 1).otherwise(0)).alias("inner"),
        F.max(F.when((F.col("place") > 0) & F.col("next").isin(ITEM, BULLET), 1).otherwise(0)).alias("leads"), F.max(F.when(F.col("place") > 0, 1).otherwise(0)).alias("late"),
    )


def host_templates(parsed: DataFrame, keys: list[str], edges: bool = True) -> DataFrame:
    """(host, e, leads): hashes of a host's template elements; leads: what follows it are its items.

    An element's share is taken on the host and over all hosts that have it, so that sub-headings, which
    are rare on every host, aren't taken for template where a host has few pages. edges: rarer elements
    that never stand within an article are template too, and so are navigation rows that come back at all.
    """
    pages = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    per = _distinct_elements(parsed, keys).groupBy("host", "e").agg(
        F.count(F.lit(1)).alias("n"), F.sum("inner").alias("inner"), F.sum("leads").alias("leads"), F.sum("late").alias("late"), F.max("k").alias("k")
    )
    per = materialize(per.join(pages, "host"), "elements")
    # All occurrences count, single ones too; most elements are on one page of one host and end here.
    pool = per.groupBy("e").agg(F.sum("n").alias("n_all"), F.sum("pages").alias("pages_all"), F.sum("leads").alias("leads_all"), F.sum("late").alias("late_all"), F.sum("inner").alias("inner_all"))
    x = per.join(pool.filter(f"n_all >= {TEMPLATE_PAGES}"), "e")
    share, pooled = F.col("n") / F.col("pages"), F.col("n_all") / F.col("pages_all")
    often = (share >= TEMPLATE_SHARE) & (pooled >= TEMPLATE_SHARE)
    outside = ((pooled >= EDGE_SHARE) | (F.col("k") == NAV)) & (F.col("inner_all") <= 0.05 * F.col("n_all")) & (F.col("k") != PARAGRAPH)
    return x.filter(((often | outside) if edges else often) & (F.col("k") != FIGURE)).select("host", "e", (F.col("leads_all") >= 0.5 * F.greatest(F.col("late_all"), F.lit(1))).alias("leads"))


def with_templates(parsed: DataFrame, keys: list[str], edges: bool = True) -> DataFrame:
    """parsed with the template elements of its host as the arrays te and tl; null for a page without a host or of a host without any."""
    t = host_templates(parsed, keys, edges).groupBy("host").agg(F.collect_list(F.struct("e", "leads")).alias("_t"))
    t = bounded_broadcast(materialize(t.select("host", F.col("_t.e").alias("te"), F.col("_t.leads").alias("tl")), "templates"))
    return parsed.join(t, "host", "left")


class HostTemplates:
    """The template elements of a host."""

    def __init__(self, elements: list[int] | None, leads: list[bool] | None):
        self.leads = dict(zip(elements or [], leads or [], strict=True))

    def boilerplate(self, rows: list[tuple]) -> list[int]:
        """The line numbers that are not main body, of the rows of parse_page()."""
        out = []
        in_list, before, was_template = False, None, True
        for no, h, g, k, place, _, title in rows:
            lead = self.leads.get(h)
            template = not title and (lead is not None or g in self.leads)
            # Items of another kind than the list began with are none of its.
            other = k == BULLET and before == ITEM and not was_template
            if template:
                out.append(no)
                in_list = place > 0 and (lead if lead is not None else self.leads[g])
            elif title or k not in (ITEM, BULLET):
                in_list = False
            elif other:
                in_list = False
            elif in_list:
                out.append(no)
            before, was_template = k, template
        return out

    def site_lines(self, rows: list[tuple]) -> list[int]:
        """The line numbers that the site repeats, and those of the headline."""
        return [no for no, h, g, _, _, _, title in rows if title or h in self.leads or g in self.leads]


def page_rows(batch: pa.RecordBatch) -> Iterator[tuple[HostTemplates, list[tuple]]]:
    """(templates of the host, parsed lines) of each row of with_templates()."""
    known: dict = {}
    te, tl = batch.column("te"), batch.column("tl")
    # All lists of a column at once; a null list has no values, so its length counts as 0.
    lists = [batch.column(c) for c in COLUMNS]
    rows = list(zip(*(x.flatten().to_numpy().tolist() for x in lists), strict=True))
    end = np.cumsum(lists[0].value_lengths().fill_null(0).to_numpy()).tolist()
    for i, (host, first, last) in enumerate(zip(batch.column("host").to_pylist(), [0, *end], end)):  # noqa: B905
        if host not in known:
            known[host] = HostTemplates(te[i].as_py(), tl[i].as_py())
        yield known[host], rows[first:last]


def boilerplate_lines(pages: DataFrame, keys: list[str], host: str, title: str, text: str) -> DataFrame:
    """(keys, line_no): the non-blank lines of each page that are not main body.

    Null and empty texts have none; a page without a host shares no template and keeps its lines.
    Repeated pages must be dropped before. Elements leave the map side as hashes; pages stay where they are.
    """
    return lines_of(materialize(page_lines(pages, keys, host, title, text), "pages"), keys)


def lines_of(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """boilerplate_lines() of pages that are parsed already."""
    types = dict(parsed.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [t.boilerplate(rows) for t, rows in page_rows(b)]
            size = np.array([len(x) for x in found], np.int64)
            owner = pa.array(np.repeat(np.arange(len(found)), size))
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(owner) for k in keys), pa.array([n for x in found for n in x], pa.int64())], [*keys, "line_no"])

    x = with_templates(parsed, keys).select(*keys, "host", *COLUMNS, "te", "tl")
    return x.mapInArrow(run, ", ".join(f"{k} {types[k]}" for k in keys) + ", line_no long")


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_table, item_id, source_id, title, text) of extracted pages and of signals taken from web pages."""
    p = table(spark, sf_dir, "extracted_page").dropDuplicates(["page_id"])
    raw = table(spark, sf_dir, "raw_signal").select("signal_id", "ingest_seq", "source_id", "title", "raw_text", "collector")
    s = only_first(raw, "signal_id", "ingest_seq").filter("collector = 'web_page'")
    return p.select(F.lit("extracted_page").alias("item_table"), F.col("page_id").alias("item_id"), "source_id", "title", "text").unionByName(
        s.select(F.lit("raw_signal").alias("item_table"), F.col("signal_id").alias("item_id"), "source_id", "title", F.col("raw_text").alias("text"))
    )
