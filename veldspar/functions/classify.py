"""Ordered keyword cascades: the first rule that matches decides."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_ws


def cascade(text: Column, rules: list[tuple[str, list[str]]], otherwise: str = "unknown", empty: str | None = None) -> Column:
    """The label of the first rule one of whose words occurs in the text, letter case aside.

    Null and empty texts get `empty`, or `otherwise` where that is None.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.when(low == "", empty if empty is not None else otherwise)
    for label, words in rules:
        out = out.when(low.rlike("|".join(re.escape(w.lower()) for w in words)), label)
    return out.otherwise(otherwise)


def contained(text: Column, names: list[str]) -> Column:
    """array<string>: the names that occur in the text as written, in the order of the list."""
    return F.filter(F.array(*map(F.lit, names)), lambda n: F.contains(text, n))


def all_matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<string>: the distinct matches in the order of their first."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), group))


def mentions(low: Column, *words: str) -> Column:
    """Whether any of the words is in a text given in lower case."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


def error_class(message: Column) -> Column:
    """The class of a failed document, by the first rule that holds; null without a message.

    The rules are words of the message in lower case, in the order of the pipeline's own steps.
    """
    low = F.lower(message)
    rule = F.when(mentions(low, "unsupported source_type"), "unsupported_source_type").when(mentions(low, "config") & mentions(low, "error"), "config_error")
    for label, words in STEP_ERRORS:
        rule = rule.when(mentions(low, *words), label)
    return F.when(message != "", rule.otherwise("unknown_error"))


# Words that name the step that failed, in the order that decides.
STEP_ERRORS = [
    ("connector_error", ["connector 异常", "connector error"]),
    ("fetch_error", ["抓取失败", "fetch", "http", "timeout"]),
    ("parse_error", ["解析", "parse", "beautifulsoup"]),
    ("extract_error", ["正文抽取", "extract"]),
    ("storage_error", ["写入", "storage", "io"]),
    ("empty_source", ["内容为空", "empty"]),
]


def filing_error_class(message: Column) -> Column:
    """fetch, parse or connector, the last for whatever names neither."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return F.when(mentions(low, "fetch", "http", "network", "timeout"), "fetch").when(mentions(low, "parse", "syntax", "html", "json"), "parse").otherwise("connector")


def network_error(message: Column, status: Column) -> Column:
    """What broke a request: name resolution, handshake, reset, time-out or certificate by the message, else the HTTP status of either."""
    low = F.lower(F.coalesce(message, F.lit("")))
    named = F.regexp_extract(low, r"http error:\s*(\d+)", 1).try_cast("int")
    by_number = lambda c: F.when(c == 404, "http_404").when(c == 403, "http_403").when(c == 401, "http_401").when(c.between(400, 499), "http_4xx").when(c.between(500, 599), "http_5xx")
    out = F.lit(None).cast("string")
    for label, words in NETWORK_ERRORS:
        out = F.coalesce(out, F.when(mentions(low, *words), label))
    for code in (404, 403, 401):
        out = F.coalesce(out, F.when((status == code) | mentions(low, str(code)), f"http_{code}"))
    return F.coalesce(out, by_number(status), by_number(named), F.lit("unknown"))


# Words of a message by what broke, in the order that decides.
NETWORK_ERRORS = [
    ("dns_resolution_failed", ["getaddrinfo", "nodename nor servname", "dns"]),
    ("tls_handshake_failed", ["ssl: unexpected_eof", "ssl_error_syscall", "tlsv1", "sslv3", "handshake"]),
    ("connection_reset", ["connection reset", "远程主机强迫关闭", "winerror 10054"]),
    ("timeout", ["timed out", "timeout"]),
    ("ssl_certificate_error", ["certificate_verify_failed", "certificate verify failed", "hostname mismatch"]),
]


def is_retryable(status: Column, kind: Column) -> Column:
    """429, server errors, time-outs and broken connections may be tried again."""
    return F.coalesce((status == 429) | (status >= 500), F.lit(False)) | F.coalesce(kind.isin("timeout", "connection_error", "connection_reset"), F.lit(False))


def keyword_flags(text: Column, rules: list[tuple[str, list[str], int]]) -> Column:
    """array<string>: the rules so many of whose words occur in the text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    flags = []
    for label, words, least in rules:
        hits = sum((F.contains(low, F.lit(w.lower())).cast("int") for w in words), F.lit(0))
        flags.append(F.when(hits >= least, F.lit(label)))
    return F.array_compact(F.array(*flags))


# Words that mark a page as something else than an article.
BLOCKED_WORDS = ["access denied", "forbidden", "blocked", "access restricted", "service unavailable", "you don't have permission"]
LOGIN_WORDS = ["sign in", "sign-in", "signin", "log in", "log-in", "login", "password", "username", "email address", "remember me", "forgot password", "create account"]
PAYWALL_WORDS = ["paywall", "premium", "subscription required", "subscribe to continue", "subscribe to read", "subscribe now to access", "members only", "upgrade to access", "sign up to continue", "free trial", "subscribe to unlock"]
COOKIE_WORDS = ["cookie consent", "accept cookies", "cookie policy", "manage cookies", "we use cookies", "this site uses cookies", "cookie preferences", "gdpr consent"]
APP_WORDS = ["download our app", "download the app", "get the app", "app store", "google play", "available on the app store", "open in app", "install app", "mobile app"]
MARKETING_WORDS = ["pricing", "plans starting at", "free trial", "request a demo", "book a demo", "schedule a demo", "get started", "try for free", "start free trial", "enterprise pricing", "contact sales"]


def _hits(low: Column, words: list[str]) -> Column:
    return sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))


def noise_flags(text: Column, title: Column, status: Column) -> Column:
    """array<string>: what a page is besides or instead of an article, each flag once, in a fixed order.

    Short cookie notices, pages of links and empty pages go by the length of the text with its white space
    collapsed. Null texts and titles count as empty, a null status as none.
    """
    t, head = F.coalesce(text, F.lit("")), F.lower(F.coalesce(title, F.lit("")))
    low = F.lower(t)
    n = F.length(collapse_ws(low))
    status = F.coalesce(status, F.lit(0))
    control = F.length(t) - F.length(F.regexp_replace(t, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""))
    lost = F.length(t) - F.length(F.replace(t, F.lit("\ufffd"), F.lit("")))
    words = lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit("[a-z]{3,}"), F.lit(0)))
    flags = {
        "blocked_page": status.isin(403, 451, 503) | (status >= 500) | (_hits(low, BLOCKED_WORDS) > 0),
        "login_page": _hits(low, LOGIN_WORDS) >= 3,
        "paywall": _hits(low, PAYWALL_WORDS) > 0,
        "cookie_only": (_hits(low, COOKIE_WORDS) >= 3) & (n < 500),
        "app_download_page": _hits(low, APP_WORDS) > 0,
        "navigation_only": (n < 200) & t.rlike(r"<a\s"),
        "marketing_only": _hits(low, MARKETING_WORDS) >= 3,
        "empty_page": n < 50,
        "garbled_text": (control > F.length(t) * 0.05) | t.rlike(r"(.)\1{10,}") | (lost > 5),
        "unrelated_page": (n > 100) & (F.size(words(head)) > 2) & ~F.arrays_overlap(words(head), words(low)),
    }
    return F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in flags.items()]))


# Patterns that mark a link as none of an article, by kind.
LINK_NOISE = {
    "login": r"sign\s*in|log\s*in|login|signin|account|password|email|username",
    "cookie": r"cookie|consent|privacy\s*policy|accept\s*cookies|gdpr|ccpa",
    "navigation": r"^home$|^about$|^contact$|^careers$|^menu$|^subscribe$|^search$",
    "empty": r"no\s*content|empty|404|not\s*found",
}


def link_noise(title: Column, url: Column) -> Column:
    """array<string>: the kinds of noise that a link's title and address together show, as a set in order of name."""
    low = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(url, F.lit(""))))
    return F.array_sort(F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(k)) for k, p in LINK_NOISE.items()])))


def currency(text: Column) -> Column:
    """HKD, CNY, USD or unknown; HK$ is looked for before the bare dollar it contains."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(mentions(low, "hk$", "hkd"), "HKD").when(mentions(low, "rmb", "cny", "¥"), "CNY").when(mentions(low, "$", "usd"), "USD").otherwise("unknown")


# Institutions as they are written.
INSTITUTIONS = ["Goldman Sachs", "Morgan Stanley", "J.P. Morgan", "JPMorgan", "Bank of America", "BofA", "Citi", "Citigroup", "UBS", "Barclays", "Deutsche Bank", "Bernstein", "Jefferies", "Mizuho", "Evercore", "Needham", "Wedbush"]


def people(text: Column, tagged: Column | None = None, roles: tuple[str, ...] = ("analyst", "strategist", "economist")) -> Column:
    """array<string>: names of two or more capitalised words after a role, after those that markup names, each once."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?<![A-Za-z0-9_])(?:{'|'.join(roles)})\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)"), F.lit(1))
    return F.array_distinct(F.concat(F.coalesce(tagged, F.array().cast("array<string>")), found) if tagged is not None else found)


def document_kind(text: Column) -> Column:
    """transcript, webcast, presentation or event, by the words of an event page."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(mentions(low, "transcript"), "transcript").when(mentions(low, "webcast"), "webcast").when(mentions(low, "presentation", "slides"), "presentation").otherwise("event")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))
