"""Text functions as column expressions of the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as the body of a Java character class.
WS = r"\s\x0B\x1c-\x1f\x85\p{Z}"


def trim_u(x: Column) -> Column:
    """x without white space of any kind at its ends."""
    return F.regexp_replace(x, f"^[{WS}]+|[{WS}]+$", "")


def collapse_ws(x: Column) -> Column:
    """x trimmed, every run of white space one space."""
    return F.trim(F.regexp_replace(x, f"[{WS}]+", " "))


def short_sha(x: Column, n: int = 16) -> Column:
    """The first n hex digits of SHA-256 over UTF-8."""
    return F.substring(F.sha2(x, 256), 1, n)


def hash_text(x: Column, n: int = 16) -> Column:
    """Content key: lower case, trimmed, white space collapsed; null stays null."""
    return short_sha(collapse_ws(F.lower(x)), n)


def empty_as_null(x: Column) -> Column:
    return F.when(x != "", x)


def strip_tags(html: Column) -> Column:
    """Tags become spaces, white space collapses; the text of scripts and styles stays."""
    return collapse_ws(F.regexp_replace(html, "<[^>]+>", " "))


# Marks of Markdown and what stands for them, in this order.
MARKDOWN = [
    (r"```[\s\S]*?```", " "), (r"`[^`]+`", " "), (r"!\[.*?\]\(.*?\)", " "), (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (rf"#{{1,6}}[{WS}]+", " "), (r"[*_]{1,2}([^*_]+)[*_]{1,2}", "$1"),
]


def markdown_to_text(md: Column) -> Column:
    """Plain text of Markdown: fences, code and images become a space, links and emphasis their text, headings lose their marks, white space collapses."""
    x = md
    for pattern, new in MARKDOWN:
        x = F.regexp_replace(x, pattern, new)
    return collapse_ws(x)


def char_count(x: Column) -> Column:
    """Code points; null counts 0."""
    return F.coalesce(F.length(x), F.lit(0)).cast("long")


def word_count(x: Column) -> Column:
    """Runs of non-space characters; null and blank count 0."""
    t = collapse_ws(F.coalesce(x, F.lit("")))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " "))).cast("long")


def quality_by_length(n: Column, high: int, medium: int, low: int = 1) -> Column:
    """high, medium, low or empty by length; between 1 and low it is low too, 0 is empty."""
    return F.when(n >= high, "high").when(n >= medium, "medium").when(n >= low, "low").when(n > 0, "low").otherwise("empty")


def sanitize_filename(x: Column, max_len: int = 80, default: str = "untitled") -> Column:
    """A file name: reserved characters and white space become dashes, ends are clean, empty becomes the default."""
    t = trim_u(F.regexp_replace(F.coalesce(x, F.lit("")), r'[\\/:*?"<>|\r\n\t]+', " "))
    t = F.regexp_replace(F.regexp_replace(t, f"[{WS}]+", "-"), r"^[-.]+|[-.]+$", "")
    t = F.regexp_replace(F.substring(t, 1, max_len), "-+$", "")
    return F.when(t == "", default).otherwise(t)


def mask_secret(x: Column) -> Column:
    """Empty stays empty, up to eight characters are starred, longer ones show four at each end."""
    n = F.length(x)
    return F.when(n == 0, "").when(n <= 8, F.repeat(F.lit("*"), n)).otherwise(F.concat(F.substring(x, 1, 4), F.lit("..."), F.substring(x, n - 3, F.lit(4))))


def table_cell(x: Column, width: int = 60) -> Column:
    """x as a Markdown table cell: bars and line breaks replaced, cut to the width with dots."""
    t = F.translate(F.coalesce(x, F.lit("")), "|\n", "/ ")
    return F.when(F.length(t) > width, F.concat(F.substring(t, 1, width - 3), F.lit("..."))).otherwise(t)


def content_hash(*parts: Column, n: int = 32) -> Column:
    """Key of a record's content: SHA-256 over its parts joined by two bars, null as empty."""
    return short_sha(F.concat_ws("||", *[F.coalesce(p, F.lit("")) for p in parts]), n)


def json_from_text(x: Column) -> Column:
    """The JSON part of free text: fences go, then from the first bracket to the last of its kind; null without one."""
    t = trim_u(F.regexp_replace(x, r"(?m)^\s*```[a-zA-Z]*\s*$", ""))
    obj = F.regexp_extract(t, r"^[^\[{]*(\{[\s\S]*\})", 1)
    arr = F.regexp_extract(t, r"^[^\[{]*(\[[\s\S]*\])", 1)
    return F.coalesce(empty_as_null(obj), empty_as_null(arr))


def snippet_around(text: Column, keywords: list[str], before: int = 40, after: int = 80) -> Column:
    """The window round the first listed keyword that occurs; the order of the list decides, not the place."""
    out = F.lit(None).cast("string")
    for k in reversed(keywords):
        at = F.locate(k.lower(), F.lower(text))
        start = F.greatest(at - before, F.lit(1))
        out = F.when(at > 0, F.substring(text, start, at - start + len(k) + after)).otherwise(out)
    return out


def checked_json(x: Column, schema: str, required: list[str]) -> Column:
    """struct<value, error> of the JSON in free text: the value by its schema, or no_json, invalid_json or missing:field."""
    found = json_from_text(x)
    value = F.from_json(found, schema)
    gone = F.concat(F.lit("missing:"), F.array_join(F.array_compact(F.array(*[F.when(value[f].isNull(), F.lit(f)) for f in required])), ","))
    lacking = F.lit(False)
    for f in required:
        lacking = lacking | value[f].isNull()
    valid = F.is_valid_utf8(found) & F.try_parse_json(found).isNotNull()
    error = F.when(found.isNull(), "no_json").when(~valid, "invalid_json").when(lacking, gone)
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))
