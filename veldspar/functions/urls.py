"""Addresses and keys made of them."""

from __future__ import annotations

import hashlib
import ipaddress
import json
from urllib.parse import parse_qsl, quote_plus, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import collapse_ws, empty_as_null, sanitize_filename, short_sha, trim_u

# Query parameters that only track readers.
TRACKING = "utm_source utm_medium utm_campaign utm_term utm_content fbclid gclid gbraid wbraid ref ref_src spm from scenes clicktime enterid forceh5".split()
EXAMPLE_DOMAINS = ("example.com", "example.org", "example.net")

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.-]*:)?(//[^/?#]*)?"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no fragment, no empty query, no trailing slash; path and query keep their case and order."""
    u = F.regexp_replace(F.regexp_replace(trim_u(url), "#.*$", ""), r"\?$", "")
    head = F.regexp_extract(u, _SCHEME, 0)
    return F.regexp_replace(F.concat(F.lower(head), F.substring(u, F.length(head) + 1, F.length(u))), "/+$", "")


def url_hash(url: Column, n: int = 16) -> Column:
    return short_sha(canonical_url(url), n)


def url_host(url: Column) -> Column:
    """The host part in lower case, with user and port; null where there is none."""
    return empty_as_null(F.lower(F.regexp_extract(trim_u(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)))


def domain(url: Column) -> Column:
    """The host without any leading run of the characters w and dot."""
    return empty_as_null(F.regexp_replace(url_host(url), "^[w.]+", ""))


def is_example_domain(host: Column) -> Column:
    """Whether the host is one of the documentation domains; a null host isn't."""
    return F.coalesce(host.isin(*EXAMPLE_DOMAINS), F.lit(False))


def _without_tracking(url: str | None) -> str | None:
    if url is None:
        return None
    try:
        p = urlsplit(url.strip())
        base = urlunsplit((p.scheme.lower(), p.netloc.lower(), p.path, p.query, "")).rstrip("/")
        p = urlsplit(base)
        kept = sorted(((k, v) for k, v in parse_qsl(p.query) if k.lower() not in TRACKING), key=lambda kv: kv[0])
        return urlunsplit((p.scheme, p.netloc, p.path, "&".join(f"{quote_plus(k)}={quote_plus(v)}" for k, v in kept), ""))
    except ValueError:
        return url.strip()


@F.pandas_udf(T.StringType())
def url_without_tracking(url: pd.Series) -> pd.Series:
    """canonical_url without tracking and blank parameters, the rest sorted by name and encoded anew."""
    return url.map(_without_tracking, na_action="ignore")


def url_problem(url: str | None) -> str | None:
    """Why an address may not be fetched; null if it may. Names aren't resolved."""
    if not url or not url.strip():
        return "empty"
    try:
        p = urlsplit(url.strip())
        host = p.hostname
    except ValueError:
        return "malformed"
    if p.scheme.lower() not in ("http", "https"):
        return "scheme"
    if not host:
        return "no_host"
    if host == "localhost" or host.endswith(".localhost") or host == "0.0.0.0":
        return "local"
    try:
        ip = ipaddress.ip_address(host)
    except ValueError:
        return None
    blocked = ip.is_private or ip.is_loopback or ip.is_link_local or ip.is_multicast or ip.is_reserved or ip.is_unspecified
    return "private_address" if blocked else None


@F.pandas_udf(T.StringType())
def url_problem_udf(url: pd.Series) -> pd.Series:
    return pd.Series([url_problem(u) for u in url], dtype="object")


def title_key(source: Column, title: Column, published: Column) -> Column:
    """16 digits over source, title and date as received, joined by two bars; null counts as empty."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return short_sha(F.concat_ws("||", part(source), part(title), part(published)))


def canonical_key(kind: Column, issuer: Column, date: Column, form: Column, accession: Column, announcement: Column, url: Column, pdf_url: Column, title: Column) -> Column:
    """type|issuer|date|form| and the best identifier there is: accession, announcement, address, PDF address or title hash."""
    part = lambda c: F.coalesce(c, F.lit(""))
    tagged = lambda tag, c: F.concat(F.lit(tag), empty_as_null(c))
    best = F.coalesce(tagged("acc:", accession), tagged("ann:", announcement), tagged("url:", url), tagged("pdf:", pdf_url), F.concat(F.lit("title_hash:"), short_sha(part(title))))
    return F.concat_ws("|", part(kind), part(issuer), part(date), part(form), best)


def archive_path(published: Column, now: Column, source: Column, title: Column) -> Column:
    """documents/YYYY/MM/YYYY-MM-DD__source__title, by the first ten characters of published or else of now."""
    day = F.when(published.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(published, 1, 10)).otherwise(F.substring(now, 1, 10))
    return F.concat(F.lit("documents/"), F.substring(day, 1, 4), F.lit("/"), F.substring(day, 6, 2), F.lit("/"), day, F.lit("__"), sanitize_filename(source, 40), F.lit("__"), sanitize_filename(title, 80))


def file_extension(name: Column) -> Column:
    """The suffix of a path or address in lower case with its dot; null without one."""
    return empty_as_null(F.lower(F.regexp_extract(F.regexp_replace(name, r"[?#].*$", ""), r"(\.[A-Za-z0-9]{1,8})$", 1)))


def media_type(extension: Column) -> Column:
    known = {".html": "text/html", ".htm": "text/html", ".md": "text/markdown", ".txt": "text/plain", ".pdf": "application/pdf", ".json": "application/json", ".xml": "application/xml", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".gif": "image/gif", ".webp": "image/webp"}
    return F.coalesce(F.create_map(*[F.lit(v) for kv in known.items() for v in kv])[extension], F.lit("application/octet-stream"))


def normalized_title(title: Column) -> Column:
    return collapse_ws(F.lower(title))


def record_extension(explicit: Column, paths: list[Column], raw_json: Column, mime: Column) -> Column:
    """A record's file extension: as given, else of a path, else of a path within its JSON, else by media type."""
    named = F.when(explicit.startswith("."), F.lower(explicit)).otherwise(F.concat(F.lit("."), F.lower(empty_as_null(explicit))))
    inner = [file_extension(F.get_json_object(raw_json, p)) for p in ("$.path", "$.file_path", "$.url", "$.metadata.path")]
    by_mime = F.create_map(*[F.lit(v) for kv in {"text/html": ".html", "text/markdown": ".md", "text/plain": ".txt", "application/pdf": ".pdf", "application/json": ".json"}.items() for v in kv])[mime]
    return F.coalesce(named, *[file_extension(p) for p in paths], *inner, by_mime)


def request_key(fields: dict[str, object]) -> str:
    """SHA-256 of a request's fields as JSON with sorted keys: the exact key of a response cache."""
    return hashlib.sha256(json.dumps(fields, sort_keys=True).encode()).hexdigest()


def image_name(url: Column, kind: Column | None = None) -> Column:
    """The file name of a downloaded image: 16 digits of the address's hash and the extension of the address or, without one, of the media type; .jpg else."""
    known = F.create_map(*[F.lit(v) for kv in {"image/png": ".png", "image/gif": ".gif", "image/webp": ".webp", "image/jpeg": ".jpg"}.items() for v in kv])
    named = F.when(file_extension(url).isin(".jpg", ".jpeg", ".png", ".gif", ".webp"), file_extension(url))
    return F.concat(short_sha(url), F.coalesce(named, known[kind] if kind is not None else F.lit(None), F.lit(".jpg")))


def distinct_images(pages: Column) -> Column:
    """array<string>: the addresses of an article's images, each once, in order; empty ones are left out."""
    return F.array_distinct(F.filter(F.coalesce(pages, F.array().cast("array<string>")), lambda u: u != ""))
