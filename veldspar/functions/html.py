"""HTML without third-party parsers: items, tables, links, main text, metadata and Markdown, as Arrow functions."""

from __future__ import annotations

import html as entities
import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_DROP = set("script style noscript template svg".split())
_CHROME = set("nav footer aside header form".split())
_BLOCK = set("p div section article main li ul ol table tr td th h1 h2 h3 h4 h5 h6 blockquote pre br hr figure figcaption dt dd dl header footer aside nav".split())


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def text(self, drop: set[str] = _DROP) -> str:
        """The text below the node; block elements part it."""
        out: list[str] = []
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in drop:
                if n.tag in _BLOCK:
                    out.append("\n")
                    stack.append("\n")
                stack.extend(reversed(n.children))
        lines = (" ".join(x.split()) for x in "".join(out).split("\n"))
        return "\n".join(x for x in lines if x)

    def has(self, word: str) -> bool:
        return word in (self.attrs.get("class", "") + " " + self.attrs.get("id", "")).lower()


class _Builder(HTMLParser):
    """A tree of any input: what isn't closed is closed by its parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li", "tr", "td", "th", "option") and self.at.tag == tag:
            self.at = self.at.parent or self.root
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.tag == tag and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(markup: str | None) -> Node:
    b = _Builder()
    try:
        b.feed(markup or "")
        b.close()
    except (AssertionError, ValueError):
        pass  # what was read so far is the tree
    return b.root


def find(root: Node, tag: str) -> list[Node]:
    return [n for n in root.walk() if n.tag == tag]


# Words of class or id of the body's container, in the order they are tried.
BODY_WORDS = ("media-mention", "news-article", "story-body", "market-news", "analyst-action", "analyst-rating", "rating-detail", "action-detail", "transcript", "event-transcript", "conference-transcript", "webcast-transcript", "presentation", "event-body", "article-body", "content", "body")


def main_text(markup: str | None) -> str:
    """The text of the best body container of 30 characters or more: by word, then article, main, body; without chrome."""
    root = parse(markup)
    drop = _DROP | _CHROME
    for word in BODY_WORDS:
        for n in root.walk():
            if n.tag in ("div", "section", "article", "main") and n.has(word) and len(t := n.text(drop)) >= 30:
                return t
    for tag in ("article", "main", "body"):
        for n in find(root, tag):
            if len(t := n.text(drop)) >= 30:
                return t
    return root.text(drop)


def page_metadata(markup: str | None) -> dict[str, str | None]:
    """title, description, author, published, language, canonical address and site, from meta elements before the page's own."""
    root = parse(markup)
    meta: dict[str, str] = {}
    for n in find(root, "meta"):
        key = (n.attrs.get("property") or n.attrs.get("name") or n.attrs.get("itemprop") or "").lower()
        if key and n.attrs.get("content", "").strip():
            meta.setdefault(key, n.attrs["content"].strip())
    title = next((n.text() for n in find(root, "title")), "")
    canonical = next((n.attrs.get("href") for n in find(root, "link") if n.attrs.get("rel") == "canonical"), None)
    time = next((n.attrs["datetime"] for n in find(root, "time") if n.attrs.get("datetime")), None)
    lang = next((n.attrs.get("lang") for n in find(root, "html")), None)
    return {
        "title": meta.get("og:title") or title or None,
        "description": meta.get("og:description") or meta.get("description"),
        "author": meta.get("author") or meta.get("article:author"),
        "published": meta.get("article:published_time") or meta.get("date") or meta.get("pubdate") or meta.get("datepublished") or time,
        "language": meta.get("og:locale") or lang,
        "canonical_url": canonical,
        "site": meta.get("og:site_name"),
    }


def links(markup: str | None, base: str | None = None, limit: int | None = None) -> list[dict]:
    """Anchors with a text of three characters or more; fragments, scripts and mail are left out, each address once."""
    out, seen = [], set()
    for n in find(parse(markup), "a"):
        href, text = n.attrs.get("href", "").strip(), " ".join(n.text().split())
        if not href or href[0] == "#" or href.split(":")[0].lower() in ("javascript", "mailto", "tel") or len(text) < 3:
            continue
        url = urljoin(base or "", href)
        if url not in seen:
            seen.add(url)
            out.append({"text": text[:200], "url": url})
            if limit and len(out) >= limit:
                break
    return out


def table_rows(markup: str | None) -> list[dict]:
    """The rows of every table: table number, row number, whether it is a header, and its cells."""
    out = []
    for t, table in enumerate(find(parse(markup), "table")):
        for r, tr in enumerate(find(table, "tr")):
            cells = [c for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")]
            if cells:
                hrefs = [a.attrs["href"] for c in cells for a in find(c, "a") if a.attrs.get("href")]
                out.append({"table": t, "row": r, "header": any(c.tag == "th" for c in cells), "cells": [" ".join(c.text().split()) for c in cells], "href": hrefs[0] if hrefs else None})
    return out


#: Item containers of list pages by profile.
ITEM_PROFILES = {"article_list": ("article", "article-item", "post", "news-item", "list-item"), "card_list": ("card", "tile", "teaser"), "link_list": ()}


def list_items(markup: str | None, base: str | None = None, profile: str = "article_list") -> list[dict]:
    """Title, address, date, summary and author of each item of a list page, each address once; no items for a page of another kind."""
    root = parse(markup)
    if profile == "link_list":
        return [{"title": x["text"], "url": x["url"], "published": None, "summary": None, "author": None} for x in links(markup, base)]
    words = ITEM_PROFILES[profile]
    out, seen = [], set()
    for n in root.walk():
        if not (n.tag == words[0] or (n.tag in ("div", "li", "section", "article") and any(n.has(w) for w in words))):
            continue
        anchor = next((a for a in find(n, "a") if a.attrs.get("href") and a.text()), None)
        if anchor is None:
            continue
        url = urljoin(base or "", anchor.attrs["href"].strip())
        if url in seen:
            continue
        seen.add(url)
        pick = lambda *ws, n=n: next((" ".join(x.text().split()) for x in n.walk() if x is not n and any(x.has(w) for w in ws) and x.text()), None)
        head = next((" ".join(h.text().split()) for tag in ("h1", "h2", "h3", "h4") for h in find(n, tag)), None)
        time = next((t.attrs.get("datetime") or t.text() for t in find(n, "time")), None)
        out.append({"title": head or " ".join(anchor.text().split()), "url": url, "published": time or pick("date", "time"), "summary": pick("summary", "excerpt", "desc"), "author": pick("author", "byline")})
    return out


def to_markdown(markup: str | None) -> str:
    """Markdown of headings, paragraphs, lists, quotes, code, links, emphasis and images."""

    def inline(n: Node | str) -> str:
        if isinstance(n, str):
            return re.sub(r"\s+", " ", n)
        if n.tag in _DROP:
            return ""
        inner = "".join(map(inline, n.children))
        if n.tag in ("strong", "b") and inner.strip():
            return f"**{inner.strip()}**"
        if n.tag in ("em", "i") and inner.strip():
            return f"*{inner.strip()}*"
        if n.tag == "code":
            return f"`{inner}`"
        if n.tag == "a" and n.attrs.get("href"):
            return f"[{inner.strip()}]({n.attrs['href']})"
        if n.tag == "img":
            return f"![{n.attrs.get('alt', '')}]({n.attrs.get('src') or n.attrs.get('data-src', '')})"
        return "\n" if n.tag == "br" else inner

    out: list[str] = []

    def block(n: Node, depth: int = 0) -> None:
        run: list[str] = []

        def flush() -> None:
            text = "".join(run).strip()
            run.clear()
            if text:
                out.append(text)

        for c in n.children:
            if isinstance(c, str) or c.tag not in _BLOCK - {"br"}:
                run.append(inline(c))
                continue
            flush()
            if c.tag in _DROP:
                continue
            if c.tag[0] == "h" and c.tag[1:].isdigit():
                out.append("#" * int(c.tag[1]) + " " + inline_all(c))
            elif c.tag in ("ul", "ol"):
                items = [x for x in c.children if isinstance(x, Node) and x.tag == "li"]
                out.append("\n".join("  " * depth + (f"{i}. " if c.tag == "ol" else "- ") + inline_all(x) for i, x in enumerate(items, 1)))
            elif c.tag == "blockquote":
                out.append("\n".join("> " + x for x in c.text().split("\n")))
            elif c.tag == "pre":
                out.append("```\n" + "".join(x if isinstance(x, str) else x.text() for x in c.children).strip("\n") + "\n```")
            elif c.tag == "hr":
                out.append("---")
            else:
                block(c, depth)
        flush()

    def inline_all(n: Node) -> str:
        return "".join(map(inline, n.children)).strip()

    block(parse(markup))
    return "\n\n".join(x for x in out if x.strip())


def rewrite_images(markdown: str | None, mapping: dict[str, str] | None) -> str | None:
    """Image addresses of Markdown replaced by a map; the longest address first, others stay."""
    if not markdown or not mapping:
        return markdown
    return re.sub(r"(!\[[^\]]*\]\()([^)\s]+)(\))", lambda m: m[1] + mapping.get(m[2], m[2]) + m[3], markdown)


def rewrite_html_images(markup: str | None, mapping: dict[str, str] | None) -> str | None:
    """The same for src and data-src of img elements; a lazy address becomes the shown one."""
    if not markup or not mapping:
        return markup

    def one(m: re.Match) -> str:
        tag = m[0]
        for name in ("data-src", "src"):
            if (a := re.search(rf"(?<![\w-]){name}\s*=\s*([\"'])(.*?)\1", tag, re.I)) and a[2] in mapping:
                plain = re.sub(r"\s(?:data-)?src\s*=\s*([\"']).*?\1", "", tag, flags=re.I)
                return plain[:4] + f' src="{mapping[a[2]]}"' + plain[4:]
        return tag

    return re.sub(r"<img\b[^>]*>", one, markup, flags=re.I)


#: What an item of a typed list page carries besides title, address, date, summary and author, by words of class.
TYPED_FIELDS = {
    "podcast": {"duration": ("duration",), "episode_id": ("episode-id", "episode-number")},
    "conference": {"event_name": ("event-name",), "event_date": ("event-date",), "company": ("company",), "speaker": ("speaker",)},
    "analyst": {"company": ("company",), "ticker": ("ticker",), "broker": ("broker",), "analyst": ("analyst",), "rating_from": ("rating-from",), "rating_to": ("rating-to",), "target_from": ("target-from",), "target_to": ("target-to",)},
    "mention": {"outlet": ("media-outlet",), "analyst": ("analyst",)},
}
TYPED_CONTAINERS = ("article", "card", "item", "event", "episode", "story", "post", "action", "mention")


def typed_items(markup: str | None, base: str | None, kind: str) -> list[dict]:
    """Items of a podcast, conference, analyst or mention page: what list_items() gives, the fields of the kind, document_kind and the addresses of transcript, webcast and PDF.

    A page of another kind gives no items. Each address counts once.
    """
    root = parse(markup)
    out, seen, inside = [], set(), set()
    for n in root.walk():
        if id(n) in inside or not (n.tag == "article" or (n.tag in ("div", "li", "section", "tr") and any(n.has(w) for w in TYPED_CONTAINERS))):
            continue
        anchors = [a for a in find(n, "a") if a.attrs.get("href", "").strip()]
        if not anchors or any(c is not n and c.tag == "article" for c in n.walk()):
            continue
        url = urljoin(base or "", anchors[0].attrs["href"].strip())
        inside |= {id(c) for c in n.walk()}
        if url in seen:
            continue
        seen.add(url)
        pick = lambda *ws, n=n: next((" ".join(x.text().split()) for x in n.walk() if x is not n and any(x.has(w) for w in ws) and x.text()), None)
        head = next((" ".join(h.text().split()) for tag in ("h1", "h2", "h3", "h4") for h in find(n, tag)), None)
        time = next((t.attrs.get("datetime") or t.text() for t in find(n, "time")), None)
        to = lambda *ws, anchors=anchors: next((urljoin(base or "", a.attrs["href"]) for a in anchors if any(w in (a.attrs["href"] + " " + a.text()).lower() for w in ws)), None)
        text = n.text().lower()
        what = next((k for k, ws in (("transcript", ("transcript",)), ("webcast", ("webcast",)), ("presentation", ("presentation", "slides"))) if any(w in text for w in ws)), "event")
        item = {"title": head or " ".join(anchors[0].text().split()), "url": url, "published": time or pick("date", "time"), "summary": pick("summary", "excerpt", "desc"), "author": pick("author", "byline"), "document_kind": what, "transcript_url": to("transcript"), "webcast_url": to("webcast"), "pdf_url": to(".pdf")}
        item["fields"] = {f: v for f, ws in TYPED_FIELDS[kind].items() if (v := pick(*ws))}
        out.append(item)
    return out


TYPED = T.ArrayType(T.StructType([*(T.StructField(k, T.StringType()) for k in ("title", "url", "published", "summary", "author", "document_kind", "transcript_url", "webcast_url", "pdf_url")), T.StructField("fields", T.MapType(T.StringType(), T.StringType()))]))


def typed_items_udf(kind: str):
    """typed_items() of a kind as a column function of markup and base address."""

    @F.pandas_udf(TYPED)
    def run(markup: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([typed_items(m, b, kind) for m, b in zip(markup, base, strict=True)])

    return run


#: Path segments that lead to a site's own pages rather than to articles.
NAV_SEGMENTS = frozenset("about contact login signin signup register privacy terms cookie cookies help faq careers jobs subscribe newsletter rss tag tags category categories author authors search sitemap".split())
_DATE_NEAR = re.compile(r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{4}年\d{1,2}月\d{1,2}日|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.? \d{1,2},? \d{4}|\d{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.? \d{4}")
_ANCHOR = re.compile(r"<a\b[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)[^>]*>(.*?)</a\s*>", re.I | re.S)


def investor_items(markup: str | None, base: str, hosts: tuple[str, ...], segments: tuple[str, ...], least: int = 15, after: int = 500) -> list[dict]:
    """Anchors to allowed hosts and path segments with titles of `least` characters, and a date of the title, else of the address, else of the `after` characters behind."""
    out, seen = [], set()
    for m in _ANCHOR.finditer(markup or ""):
        url = urljoin(base, entities.unescape(m[1]).strip())
        title = " ".join(entities.unescape(re.sub(r"<[^>]+>", " ", m[2])).split())
        host, path = urlsplit(url).hostname or "", urlsplit(url).path.lower().split("/")
        if not any(host == h or host.endswith("." + h) for h in hosts) or not set(path) & set(segments) or set(path) & NAV_SEGMENTS or len(title) < least or url in seen:
            continue
        seen.add(url)
        in_path = re.search(r"(20\d{2})[/-](\d{1,2})[/-](\d{1,2})", url)
        near = _DATE_NEAR.search(title) or in_path or _DATE_NEAR.search(markup, m.end(), min(len(markup), m.end() + after))
        out.append({"title": title[:200], "url": url, "published": near[0] if near else None})
    return out


def dated_anchors(markup: str | None, base: str | None = None, window: int = 100, limit: int | None = None) -> list[dict]:
    """Anchors with the first date in the markup so many characters around them.

    Fragments, scripts, mail and paths of a site's own pages are left out, titles have eight characters or more
    and are cut at 200, each address counts once, the limit counts kept anchors.
    """
    out, seen = [], set()
    for m in _ANCHOR.finditer(markup or ""):
        href = entities.unescape(m[1]).strip()
        title = " ".join(entities.unescape(re.sub(r"<[^>]+>", " ", m[2])).split())
        if not href or href[0] == "#" or href.split(":")[0].lower() in ("javascript", "mailto", "tel") or len(title) < 8:
            continue
        url = urljoin(base or "", href)
        if set(url.lower().split("?")[0].split("/")[3:]) & NAV_SEGMENTS or url in seen:
            continue
        seen.add(url)
        near = _DATE_NEAR.search(markup, max(0, m.start() - window), min(len(markup), m.end() + window))
        out.append({"title": title[:200], "url": url, "published": near[0] if near else None})
        if limit and len(out) >= limit:
            break
    return out


def best_container(markup: str | None, hints: tuple[str, ...] = ("content", "article", "post", "body")) -> str:
    """The text of the hinted container of the highest score, its characters and twenty for each image; else article, else the page."""
    root = parse(markup)
    best, score = None, 0
    for n in root.walk():
        if n.tag in ("div", "section", "article", "main") and any(n.has(h) for h in hints):
            t = n.text()
            s = len(t) + 20 * len(find(n, "img"))
            if s > score:
                best, score = t, s
    return best or next((n.text() for n in find(root, "article")), root.text())


def without_blocks(text: str | None, words: list[str], short: int = 12, short_words: list[str] | None = None) -> str | None:
    """text without lines that hold one of the words, or are short and hold one of the short words."""
    if text is None:
        return None
    keep = [x for x in text.split("\n") if not any(w in x for w in words) and not (len(x.strip()) <= short and any(w in x for w in short_words or []))]
    return "\n".join(keep)


METADATA = T.StructType([T.StructField(k, T.StringType()) for k in ("title", "description", "author", "published", "language", "canonical_url", "site")])
LINKS = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("url", T.StringType())]))
TABLE = T.ArrayType(T.StructType([T.StructField("table", T.IntegerType()), T.StructField("row", T.IntegerType()), T.StructField("header", T.BooleanType()), T.StructField("cells", T.ArrayType(T.StringType())), T.StructField("href", T.StringType())]))
ITEMS = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in ("title", "url", "published", "summary", "author")]))


@F.pandas_udf(T.StringType())
def main_text_udf(markup: pd.Series) -> pd.Series:
    return markup.map(main_text, na_action="ignore")


@F.pandas_udf(T.StringType())
def to_markdown_udf(markup: pd.Series) -> pd.Series:
    return markup.map(to_markdown, na_action="ignore")


@F.pandas_udf(METADATA)
def metadata_udf(markup: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([page_metadata(m) for m in markup], columns=METADATA.names)


@F.pandas_udf(LINKS)
def links_udf(markup: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([links(m, b) for m, b in zip(markup, base, strict=True)])


@F.pandas_udf(TABLE)
def table_udf(markup: pd.Series) -> pd.Series:
    return markup.map(table_rows)


def items_udf(profile: str):
    """list_items() of a profile as a column function of markup and base address."""

    @F.pandas_udf(ITEMS)
    def run(markup: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([list_items(m, b, profile) for m, b in zip(markup, base, strict=True)])

    return run


def unescape(text: str) -> str:
    return entities.unescape(text)
