"""Dates: tolerant parsing, extraction from text and addresses, staleness. The clock is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import empty_as_null


def parse_iso(x: Column) -> Column:
    """ISO 8601 as a timestamp in the session's zone (UTC); a value without zone is UTC, an unreadable one null."""
    t = F.regexp_replace(F.trim(x), "[zZ]$", "+00:00")
    return F.coalesce(F.try_to_timestamp(t), F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX")))


def is_stale(t: Column, as_of: Column, days: int) -> Column:
    """Whether more than so many whole days have passed; null where t is null."""
    return F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(t)) / 86400) > days


MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
# Kinds of dates within a text, in the order that decides.
DATE_TEXTS = [
    (rf"(?:{MONTHS})[a-z]*\.?\s+\d{{1,2}},?\s+\d{{4}}", 0), (r"\d{4}-\d{2}-\d{2}", 0), (r"\d{1,2}月\d{1,2}日\s+\d{1,2}:\d{2}", 0), (r"\d{1,2}月\d{1,2}日", 0),
    (r"(?<![\p{L}\p{N}_])\d{2}-\d{2}(?![\p{L}\p{N}_])", 0), (r"\d+\s*小时前", 0), (r"\d+\s*分钟前", 0), ("昨天", 0), ("今天", 0), (r"\d{1,2}:\d{2}", 0),
]
# Dates within an address, in the order that is tried; those without a day mean the first.
DATE_PATHS = [
    r"/(\d{4})/(\d{1,2})/(\d{1,2})", r"/(\d{4})-(\d{1,2})-(\d{1,2})", r"/(\d{4})(\d{2})(\d{2})(?!\d)", r"-(\d{4})-(\d{1,2})-(\d{1,2})", r"_(\d{4})-(\d{1,2})-(\d{1,2})",
    r"-(\d{4})-(\d{1,2})()(?=[\-/?]|$)", r"/(\d{4})/(\d{1,2})()(?=[\-/?]|$)",
]


def first_date_text(x: Column) -> Column:
    """The first date named in a text, of the first kind of DATE_TEXTS that occurs: the earlier kind wins over the earlier place. Null without any."""
    return F.coalesce(*[empty_as_null(F.regexp_extract(x, pattern, group)) for pattern, group in DATE_TEXTS])


def date_in_url(url: Column) -> Column:
    """YYYY-MM-DD from an address, by the first form of DATE_PATHS that gives a year from 2000 to 2030, a month and a day; null without any."""
    out = []
    for form in DATE_PATHS:
        y, m, d = (F.regexp_extract(url, form, i).try_cast("int") for i in (1, 2, 3))
        d = F.when(F.regexp_extract(url, form, 3) == "", 1).otherwise(d)
        ok = y.between(2000, 2030) & m.between(1, 12) & d.between(1, 31)
        out.append(F.when(ok, F.format_string("%d-%02d-%02d", y, m, d)))
    return F.coalesce(*out)


def inferred_date(url: Column, around: Column) -> Column:
    """date_in_url(), else a date of the text around, its parts joined in the order they are written (15-Jan-2024); null without any."""
    parts = lambda form: [F.regexp_extract(around, form, i) for i in (1, 2, 3)]
    texts = []
    for form in (rf"(?i)(\d{{1,2}})\s+({MONTHS})\w*\s+(\d{{4}})", rf"(?i)({MONTHS})\w*\s+(\d{{1,2}}),?\s+(\d{{4}})", r"(\d{4})-(\d{2})-(\d{2})"):
        a, b, c = parts(form)
        texts.append(F.when(a != "", F.concat_ws("-", a, F.when(F.length(b) < 2, F.lpad(b, 2, "0")).otherwise(b), F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c))))
    return F.coalesce(date_in_url(url), *texts)


def _written(x: Column, shape: str, pattern: str) -> Column:
    return F.when(x.rlike(shape), F.date_format(F.try_to_timestamp(x, F.lit(pattern)), "yyyy-MM-dd"))


def epoch_or_date(x: Column) -> Column:
    """YYYY-MM-DD (UTC) of a value that counts seconds or, beyond 10^12, milliseconds from 1970, or is written as a date of four forms.

    A number is a count whatever its length, so eight digits are no date. Null, empty and other values give null.
    """
    n = F.when(x.rlike(r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"), F.trim(x).try_cast("double"))
    secs = F.when(n > 1e12, n / 1000).otherwise(n)
    # A count beyond the year 9999 is no date.
    day = F.when(secs < 253402300800, F.date_format(F.timestamp_seconds(secs), "yyyy-MM-dd"))
    s = F.substring(x, 1, 19)
    written = F.coalesce(_written(s, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), _written(s, r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), _written(s, r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s"))
    return F.when(n.isNotNull(), day).otherwise(written)


def listed_date(x: Column) -> Column:
    """YYYY-MM-DD of the first ten characters of an announcement's date, by five forms; a date that needs eleven characters is none."""
    s = F.substring(x, 1, 10)
    forms = [(r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), (r"^\d{4}年\d{1,2}月\d{1,2}日$", "yyyy年M月d日")]
    return F.coalesce(*[_written(s, shape, pattern) for shape, pattern in forms])


def rfc822(x: Column) -> Column:
    """The instant of an RFC 822 date with a numeric zone; null for others."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(x), r"^[A-Za-z]{3},\s*", ""), F.lit("dd MMM yyyy HH:mm:ss xx"))


def age_text(t: Column, as_of: Column) -> Column:
    """How long ago, for display."""
    s = F.unix_timestamp(as_of) - F.unix_timestamp(t)
    unit = lambda n, name: F.concat(F.floor(s / n).cast("string"), F.lit(f" {name} ago"))
    return F.when(t.isNull(), "never").when(s < 60, "just now").when(s < 3600, unit(60, "min")).when(s < 86400, unit(3600, "h")).otherwise(unit(86400, "d"))


def freshness(day: Column, as_of: Column, days: int = 30) -> Column:
    """fresh up to so many days, stale beyond, unknown for null and future days."""
    age = F.datediff(as_of.cast("date"), day.cast("date"))
    return F.when(age.isNull() | (age < 0), "unknown").when(age <= days, "fresh").otherwise("stale")


def freshness_of_text(x: Column, as_of: Column, days: int = 30) -> Column:
    """fresh, stale or unknown for a date as it is written on a list page; as_of is the day it is read.

    Month and day mean the year of as_of, or the one before where that would be later. Hours and minutes ago
    and yesterday are fresh, a bare time is unknown, and so is a bare MM-DD beyond the days unless it means last year's.
    """
    today = as_of.cast("date")
    year = F.year(today)
    named = lambda y, m, d: F.try_to_timestamp(F.format_string("%d-%d-%d", y, m, d), F.lit("yyyy-M-d")).cast("date")
    part = lambda form, i: F.regexp_extract(x, form, i).try_cast("int")
    age = lambda d: F.datediff(today, d)
    cn, md = r"(\d{1,2})月(\d{1,2})日", r"^(\d{1,2})-(\d{1,2})$"
    cn_now, cn_before = (age(named(year - k, part(cn, 1), part(cn, 2))) for k in (0, 1))
    md_now, md_before = (age(named(year - k, part(md, 1), part(md, 2))) for k in (0, 1))
    by_cn = F.when(cn_now.between(0, days), "fresh").when(cn_now.between(0, 365), "stale").when((cn_now < 0) & cn_before.between(0, 365), "stale").otherwise("unknown")
    by_md = F.when(md_now.between(0, days), "fresh").when((md_now < 0) & md_before.between(0, 365), "stale").otherwise("unknown")
    day = F.coalesce(_written(x, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), _written(x, r"^\d{8}$", "yyyyMMdd"), _written(x, r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"))
    whole = age(day.cast("date"))
    by_day = F.when(whole < 0, "unknown").when(whole <= days, "fresh").when(whole > days, "stale").otherwise("unknown")
    return (
        F.when(F.coalesce(x, F.lit("")) == "", "unknown").when(x.rlike(cn) & cn_now.isNotNull(), by_cn).when(x.rlike(r"\d+\s*(?:小时|分钟)前|昨天"), "fresh")
        .when(x.rlike(r"^\d{1,2}:\d{2}$"), "unknown").when(x.rlike(md) & md_now.isNotNull(), by_md).otherwise(by_day)
    )


def retry_wait(attempt: Column, factor: float = 1.5) -> Column:
    """Seconds to wait before the attempt, counting from 0."""
    return F.pow(F.lit(factor), attempt)
