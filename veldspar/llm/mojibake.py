"""Garbled text from wrong character encoding: a best-first search over encode, decode and unescape steps.

A line is a state; a step reads its characters back into the bytes of one code page and decodes them
with another, or resolves escapes. States wait in a queue by the cost of their characters, visited ones
are known by hash, and the cheapest reachable text is the restored one.
"""

from __future__ import annotations

import codecs
import heapq
import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import only_first, table

#: A restored line must cost so much less than the received one; each step costs STEP; paths of at most DEPTH steps.
MARGIN, STEP, DEPTH = 0.7, 0.3, 3

# Weights of character kinds and of neighbourhoods that ordinary text hardly has.
#: A run of lost, control or unassigned characters, of whatever length.
RUN_COST = 3.0
KIND_COST = {"s": 0.3, "S": 0.03, "b": 1.5, "y": 1.2, "f": 1.6, "j": 1.6, "i": 0.2, "h": 0.05, "k": 0.05, "c": 0.05, "C": 0.06, "g": 0.5, "o": 0.6, "e": 0.1, "E": 0.15, "z": 0.15}
PAIR_COST = [
    (re.compile("[eE](?=[sSQz])|o(?=[aAeE])|(?<=[aAeE])o"), 2.0), (re.compile("a(?=E)|[sS](?=[sS])|(?<=[hijkwxf])\\?"), 1.5), (re.compile("c(?=C)"), 1.2),
    (re.compile("[qQ](?=[qQ])|q(?=[zE] )"), 0.7), (re.compile("[hij](?=[aAeE])|[aAeE](?=[hij])"), 1.1), (re.compile("[aAeEcCy](?=[sSbx][aeEcCy])"), 1.0), (re.compile("[eE](?=[eE])"), 0.4),
    (re.compile("(?<=[^aAeE]A)E(?=aa)|(?<=^A)E(?=aa)|(?<= )[eEscC](?=0)"), 1.2), (re.compile("[sS](?=S[a0])|(?<=[ a])sE(?=e)|g(?=E[eE])"), 1.5),
    (re.compile("[eEsS](?=q)(?!e?q )|[cCy](?=[aAeE])|[aAeE](?=[cCy])|k(?=[ijf])|[ijf](?=k)"), 0.8),
]
#: Kinds of which each of these patterns needs one.
_PAIR_KINDS = [set("eEo"), set("EsS?"), set("c"), set("qQ"), set("hij"), set("sSbx"), set("eE"), set("eEscC"), set("sSg"), set("qcCyk")]
_X_RUN = re.compile("x+")
#: What an escape that stands for a letter or sign beyond ASCII, or hides another escape, costs.
ESCAPE_COST = 1.2
#: A line without any of these kinds and neighbours, and with few rare characters, is taken as it is.
_GATE = re.compile(r"[xfbyjo]|[eE][sSQz]|E[qz]|[eE]{3}|[aAcCeE]s|s[aAeEcCsq]|[aeEcC]S[aeEcC]|aE|[cCy][aAeE]|[aAeE][cCy]|cC|[hijkw]\?|[hij][aAeE]| E |AEaa|[sS]S[a0]|gE[eE]| [eEs]0")
_LONE = re.compile("[ÂÃ](?![A-Za-zÀ-ÿ])|(?<= )[ÐÑ](?= )")
_RUSSIAN = set("абвгдеёжзийклмнопрстуфхцчшщъыьэюя")
_QUOTES = "«»„“”‘’–—…•·"
_OPENERS = "¿¡"


class _Kinds(dict):
    """Character to kind, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = k = self._kind(c, code)
        return k

    @staticmethod
    def _kind(c: str, code: int) -> str:
        if code < 128:
            return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "?" if c == "?" else " " if c in " \t\n\r" else "x" if code < 32 or code == 127 else "."
        cat = unicodedata.category(c)
        if c == "\ufffd" or cat in ("Cc", "Co", "Cn", "Cs"):
            return "x"
        if c in _QUOTES:
            return "q"
        if c in _OPENERS:
            return "Q"
        if c in "\u00a0\u2002\u2003\u3000\u2009\u202f":
            return " "
        if cat == "Cf":
            return "s"
        name = unicodedata.name(c, "")
        if name.startswith("CJK UNIFIED") or name.startswith("CJK COMPAT"):
            try:
                lead = c.encode("gb2312")[0]
                return "h" if lead <= 0xD7 else "i"
            except UnicodeEncodeError:
                pass
            try:
                e = c.encode("euc_jp")
                return "h" if len(e) == 2 and e[0] <= 0xCF else "j"
            except UnicodeEncodeError:
                return "j"
        if name.startswith(("HIRAGANA", "KATAKANA")):
            return "k"
        if name.startswith("HALFWIDTH KATAKANA"):
            return "f"
        if name.startswith(("FULLWIDTH", "IDEOGRAPHIC")) or 0x3000 <= code < 0x3020:
            return "w"
        if name.startswith("CYRILLIC"):
            return ("c" if c.islower() else "C") if c.lower() in _RUSSIAN else "y"
        if name.startswith("GREEK"):
            return "g"
        if name.startswith("LATIN") and cat[0] == "L":
            return "e" if c.islower() else "E"
        if c in "ŠŒŽšœžŸƒ":
            return "z"
        if c in "\ufb01\ufb02":
            return "s"
        if 0x1F000 <= code < 0x1FB00:
            return "S"
        if c in "©€£¥°™®§±½¼¾²³×÷":
            return "S"
        if cat[0] in "SP" or cat in ("No", "Lo", "Lm") and code < 256:
            return "s" if code < 0x2100 or 0x2122 == code else "b"
        return "o"


_KINDS = _Kinds()


_ESCAPED = re.compile(r"&(?:#\d{2,6}|#[xX][0-9a-fA-F]{2,5}|[A-Za-z]{2,8}\d?);|\\u[0-9a-fA-F]{4}|(?:%[C-F][0-9A-F](?:%[89AB][0-9A-F])+)+")
#: The same for the scan of the JVM.
ESCAPED = r"&(#\d{2,6}|#[xX][0-9a-fA-F]{2,5}|[A-Za-z]{2,8}\d?);|\\u[0-9a-fA-F]{4}|%[C-F][0-9A-F]%[89AB][0-9A-F]"
_UNICODE_ESCAPE = re.compile(r"(?:\\u[0-9a-fA-F]{4})+")
_PERCENT = re.compile(r"(?:%[0-9A-F]{2})+")


def _unicode_escape(m: re.Match) -> str:
    units = b"".join(bytes.fromhex(x) for x in m[0].split("\\u")[1:])
    return units.decode("utf-16-be", "replace")


def _percent(m: re.Match) -> str:
    """The characters of percent escapes, which are right within addresses and stay there."""
    word = m.string[m.string.rfind(" ", 0, m.start()) + 1 : m.start()]
    if "/" in word or "www." in word or "?" in word:
        return m[0]
    try:
        return bytes.fromhex(m[0].replace("%", "")).decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


def unescaped(text: str) -> Iterator[str]:
    """text with one kind of escapes resolved, for each kind that it has."""
    for kind, t in (("&", html.unescape), ("\\u", lambda x: _UNICODE_ESCAPE.sub(_unicode_escape, x)), ("%", lambda x: _PERCENT.sub(_percent, x))):
        if kind in text and (got := t(text)) != text:
            yield got


def _escapes(text: str) -> int:
    """How many escapes stand for something beyond ASCII or hide another escape: a plain &amp; or %20 is none."""
    if "&" not in text and "\\u" not in text and "%" not in text:
        return 0
    n = 0
    for m in _ESCAPED.finditer(text):
        got = _percent(m) if m[0][0] == "%" else next(unescaped(m[0]), m[0])
        if not got.isascii():
            n += len(got)
        elif got == "&" and re.match(r"#?\w{2,8};", text[m.end() : m.end() + 9]):
            n += 1
    return n


def cost(text: str) -> float:
    """How little the text's characters look like ordinary text in some language; 0 for ASCII without escapes."""
    escapes = ESCAPE_COST * _escapes(text)
    if text.isascii() and "\x7f" not in text:
        return escapes
    k = text.translate(_KINDS)
    has = set(k)
    total = sum(k.count(x) * w for x, w in KIND_COST.items() if x in has) + (RUN_COST * len(_X_RUN.findall(k)) if "x" in has else 0.0)
    # No pattern looks further than two letters into a run of them.
    k = k.replace("aaaa", "aa").replace("aaaa", "aa")
    total += sum(len(p.findall(k)) * w for (p, w), need in zip(PAIR_COST, _PAIR_KINDS, strict=True) if not need.isdisjoint(has))
    return escapes + total + 1.5 * len(_LONE.findall(text))


def _page(codec: str) -> dict[int, str]:
    """Character to byte (as a character below 256) of a one-byte code page; undefined bytes stand for themselves."""
    out: dict[int, str] = {}
    for b in range(128, 256):
        c = bytes([b]).decode(codec, "ignore")
        out.setdefault(ord(c) if c else b, chr(b))
    if codec == "latin-1":
        return out
    for b in range(128, 160):
        out.setdefault(b, chr(b))
    return out


class _Bytes(dict):
    """A code page: characters it lacks become a private one, filled as they are met."""

    def __missing__(self, code: int) -> str:
        self[code] = c = chr(code) if code < 128 else "\ue000"
        return c


PAGES = {name: _Bytes(_page(name)) for name in ("cp1252", "latin-1", "cp1250", "mac_roman", "cp1251", "koi8-r", "cp437")}
WIDE = ("gbk", "cp932", "big5")
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
TWO_BYTE_PAIRS = [(a, b) for a in WIDE for b in WIDE if a != b]
#: One-byte pages taken for each other, as the page that was used and the one that was meant.
SWAPS = [("koi8-r", "cp1251"), ("cp1251", "koi8-r"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("mac_cyrillic", "cp1251"), ("cp1251", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("koi8-r", "cp1252"), ("cp1253", "cp1252"), ("cp1255", "cp1252")]
#: Targets of a line whose bytes were read by a one-byte page, other than UTF-8.
LEGACY = ("gbk", "cp932", "cp1251", "big5", "koi8-r", "mac_roman", "cp850")
_SPACED = re.compile("(?<=[ÃÂ]) ")
_LOST = re.compile("(?<=[\u4e00-\u9fff\uff00-\uffef\ufffd])\\?")
_ONE_BYTE = re.compile("[eEsSQqxbcCygzo]")
_TWO_BYTE = re.compile("[hijkf]")
_LEGACY_KIND = re.compile("[eEsSQbxzo].*[eEsSQbxqzo]", re.S)
_HIGH = re.compile("[\x80-\xff]")


def _utf8_of(m: re.Match) -> str:
    try:
        return m[0].encode("latin-1").decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


def _from_page(s: str, page: _Bytes) -> tuple[str, bool] | None:
    """s with every valid UTF-8 sequence of the page's bytes decoded, and whether they are most of its high bytes."""
    view = s.translate(page)
    out, last, covered = [], 0, 0
    for m in _UTF8.finditer(view):
        d = _utf8_of(m)
        if d != m[0]:
            out += [s[last : m.start()], d]
            last = m.end()
            covered += len(m[0])
    return ("".join([*out, s[last:]]), covered >= 0.7 * len(_HIGH.findall(view))) if last else None


def _segments(s: str, able, decode) -> str | None:
    """s with each maximal run of encodable characters that holds non-ASCII ones decoded anew, if that is cheaper."""
    out, changed, run = [], False, ""

    def flush(run: str) -> str:
        nonlocal changed
        if not run or run.isascii():
            return run
        lead, tail = re.match(r"\s*", run)[0], re.search(r"\s*$", run)[0]
        core = run[len(lead) : len(run) - len(tail) or None]
        new = decode(core)
        if new is not None and new != core and cost(new) + STEP < cost(core):
            changed = True
            return lead + new + tail
        return run

    for part in re.split(f"({able})", s):
        out.append(flush(part) if part and re.fullmatch(able, part) else part)
    return "".join(out) if changed else None


def _unknown(e: UnicodeError) -> tuple[bytes, int]:
    """A lost character stands for an unknown byte."""
    return b"\xff" * (e.end - e.start), e.end


codecs.register_error("veldspar_unknown", _unknown)


def _wide(s: str, source: str, target: str) -> str | None:
    """s read back into a multi-byte code page and decoded with target, as a whole or run by run."""

    def decode(core: str) -> str | None:
        return core.encode(source, "veldspar_unknown").decode(target, "replace")

    if "?" in s:
        s = _LOST.sub("\ufffd", s)
    whole = decode(s)
    if cost(whole) + STEP < cost(s):
        return whole
    return _segments(s, "[^\\x00-\\x7f]+(?:[A-Za-z0-9]?[^\\x00-\\x7f]+)*", decode)


def _legacy(s: str, page: str, target: str) -> str | None:
    """s read back into the bytes of a one-byte page and decoded with target."""
    view = PAGES[page]

    def decode(core: str) -> str | None:
        b = core.translate(view)
        if "\ue000" in b or len(_HIGH.findall(b)) < 2:
            return None
        return b.encode("latin-1").decode(target, "replace")

    whole = decode(s)
    if whole is not None and cost(whole) + STEP < cost(s):
        return whole
    if target in ("mac_roman", "cp850", "koi8-r"):
        return None
    return _segments(s, "[ -~\\x80-\\xffŒœŠšŽžŸƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]+", decode)


def _swap(s: str, source: str, target: str) -> str | None:
    try:
        return s.encode(source).decode(target)
    except UnicodeError:
        return None


def _swap_words(s: str, source: str, target: str) -> Iterator[str]:
    """s with all its words swapped; before that, if less than half of its words beyond ASCII are the better for it, with those alone."""
    out, better, all_ = [], 0, 0
    for w in re.split(r"(\s+)", s):
        if not w.isascii():
            all_ += 1
            if (t := _swap(w, source, target)) is not None and cost(t) < cost(w):
                better += 1
                w = t
        out.append(w)
    if 0 < better < 0.5 * all_:
        yield "".join(out)
    if (whole := _swap(s, source, target)) is not None:
        yield whole


def steps(s: str) -> Iterator[str]:
    """The texts that one step leads to, the likeliest first."""
    k = s.translate(_KINDS)
    valid = False
    if _ONE_BYTE.search(k):
        for name in PAGES:
            if (got := _from_page(s, PAGES[name])) is not None:
                valid |= got[1]
                yield got[0]
        if _SPACED.search(s):
            t = _SPACED.sub("\xa0", s)
            for name in ("cp1252", "latin-1"):
                if (got := _from_page(t, PAGES[name])) is not None:
                    valid |= got[1]
                    yield got[0]
    if _escapes(s):
        yield from unescaped(s)
    if _TWO_BYTE.search(k):
        read = [t for a in WIDE if (t := _wide(s, a, "utf-8")) is not None]
        yield from read
        for a, b in [] if read else TWO_BYTE_PAIRS:
            if (t := _wide(s, a, b)) is not None:
                yield t
    # Bytes that form UTF-8 sequences are no legacy encoding's.
    if not valid and _LEGACY_KIND.search(k):
        for b in LEGACY:
            for p in ("cp1252", "latin-1"):
                if (t := _legacy(s, p, b)) is not None:
                    yield t
                    break
    if not valid:
        for a, b in SWAPS:
            yield from _swap_words(s, a, b)


def looks_plain(text: str) -> bool:
    """Whether no character of the text hints at a wrong encoding."""
    if _escapes(text):
        return False
    if text.isascii():
        return "\x7f" not in text
    kinds = text.translate(_KINDS)
    return not _GATE.search(kinds) and 2 * kinds.count("i") < 1 + kinds.count("h")


def restore_line(line: str) -> str:
    """The cheapest text that steps from line reach, or line itself if none is cheaper by the margin.

    The search ends early at a text that looks plain all over.
    """
    if looks_plain(line):
        return line
    start = cost(line)
    if start < MARGIN:
        return line
    best, best_cost = line, start
    # Behind escapes there may be a garbled text, which costs more than they do.
    slack = 2.0 if not _escapes(line) else 2.0 + 2.5 * len(line)
    queue = [(start, 0, line)]
    seen = {hash(line)}
    while queue:
        c, depth, s = heapq.heappop(queue)
        if depth >= DEPTH or c > best_cost + slack:
            continue
        for t in steps(s):
            h = hash(t)
            if h in seen:
                continue
            seen.add(h)
            ct = cost(t) + STEP * (depth + 1)
            if ct < best_cost:
                best, best_cost = t, ct
                if start - ct >= MARGIN and looks_plain(t):
                    return t
            if ct < c + slack + 0.5:
                heapq.heappush(queue, (ct, depth + 1, t))
    return best if start - best_cost >= MARGIN else line


def restore(text: str | None) -> str | None:
    """text with every garbled line restored where it can be; null stays null."""
    if text is None or looks_plain(text):
        return text
    return "\n".join(map(restore_line, text.split("\n")))


#: Kinds by number, 0 for a character not met yet. A line break is a kind of its own here, so no pair runs over two lines.
_NUMBERED = "\0aA0? x.qQshijkfwcCygeEzSbo\n"
#: What each part of _GATE needs: a kind, or a pair of neighbours.
_DOUBT = re.compile(r"[xfbyjo]|[eE][sSQzeE]|E[qz ]|[aAcCeE]s|s[aAeEcCsq]|[aeEcCsS]S|[aAg]E|[cCy][aAeE]|[aAeE][cCy]|cC|[hijkw]\?|[hij][aAeE]|[eEs]0")
_DOUBTFUL = np.array([bool(_DOUBT.match(a + b)) for a in _NUMBERED.ljust(32, "\0") for b in _NUMBERED.ljust(32, "\0")])
_RARE, _COMMON = _NUMBERED.index("i"), _NUMBERED.index("h")
_NUMBERS = np.zeros(0x110000, np.uint8)
_NUMBERS[10] = _NUMBERED.index("\n")
#: The alternatives of _ESCAPED by their first sign, which a search skips to.
_SIGNS = {"&": re.compile(r"&(?:#\d{2,6}|#[xX][0-9a-fA-F]{2,5}|[A-Za-z]{2,8}\d?);"), "\\u": re.compile(r"\\u[0-9a-fA-F]{4}"), "%": re.compile("%[C-F][0-9A-F]%[89AB][0-9A-F]")}


def restored_lines(text: str) -> list[str]:
    """The lines of a text, each restored as a text of its own. Only those with a doubtful kind or pair, or an escape, are looked at one by one."""
    lines = text.split("\n")
    doubtful: set[int] = set()
    for sign, escape in _SIGNS.items():
        if sign in text and escape.search(text):
            doubtful.update(i for i, x in enumerate(lines) if sign in x)
    if not text.isascii() or "\x7f" in text:
        codes = np.frombuffer(f"{text}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = _NUMBERS[codes]
        if not kinds.all():
            for c in np.unique(codes[kinds == 0]).tolist():
                _NUMBERS[c] = _NUMBERED.index(_KINDS[c])
            kinds = _NUMBERS[codes]
        at = np.flatnonzero(_DOUBTFUL[kinds[:-1] * np.uint16(32) + kinds[1:]])
        rare = kinds == _RARE
        if len(at) or rare.any():
            ends = np.flatnonzero(codes == 10)
            doubtful.update(np.searchsorted(ends, at).tolist())
            # Rare characters against common ones, as looks_plain() counts them in each line.
            doubtful.update(np.flatnonzero(np.add.reduceat(2 * rare - (kinds == _COMMON).astype(np.int64), np.append(0, ends[:-1] + 1)) >= 1).tolist())
    for i in doubtful:
        lines[i] = restore_line(lines[i])
    return lines


def is_garbled(text: str | None) -> bool:
    """Whether the text, or a part of it, was decoded with a wrong encoding, restorable or not."""
    return text is not None and ("\ufffd" in text or restore(text) != text)


@F.pandas_udf(T.StringType())
def restore_udf(text: pd.Series) -> pd.Series:
    return text.map(restore, na_action="ignore")


@F.pandas_udf(T.BooleanType())
def is_garbled_udf(text: pd.Series) -> pd.Series:
    return pd.Series([is_garbled(t) for t in text], dtype="boolean")


def garbled_fields(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field_name, restored): one row per field of a record that is garbled, wholly or in places.

    A null value and one that is ASCII without escapes is never garbled and does not leave the JVM. Repeated keys give repeated rows.
    """
    found = []
    for name in fields:
        x = rows.select(F.col(key), F.col(name).alias("_t")).filter(F.col("_t").rlike("[^\\x00-\\x7e]|" + ESCAPED))
        x = x.withColumn("restored", restore_udf("_t")).filter((F.col("restored") != F.col("_t")) | F.col("_t").contains("\ufffd"))
        found.append(x.select(key, F.lit(name).alias("field_name"), "restored"))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, field_name, restored) of the affected fields of each signal's first row."""
    raw = only_first(table(spark, sf_dir, "raw_signal").select("signal_id", "ingest_seq", "title", "raw_text"), "signal_id", "ingest_seq")
    return garbled_fields(raw, "signal_id", ["title", "raw_text"])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_restored(spark, sf_dir).select("signal_id", "field_name").distinct()
