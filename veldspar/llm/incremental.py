"""Deduplicating new batches against all history.

Texts are sets of word hashes. TextIndex keeps them at a path, in a fixed order of rising frequency: two texts that
share UNCHANGED of the larger set share words of their prefixes in that order, SHARED of them if both prefixes are
that much longer. A batch is folded in by reading only itself and the kept tables: its line forms are added to
the counts of its sources, its words are made, appended and probed against the inverted prefixes, and the
candidates are verified. The pairs found are exactly those of a full join.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import bounded_broadcast, is_small, materialize, only_first, scratch_path, ship_package, table
from . import boilerplate
from .lines import MIN_DOCS, MIN_SHARE, WS

#: Share of the words of the longer text that both have.
UNCHANGED = 2 / 3
#: Words that the prefixes of two like texts share at least: all that are needed, if these are fewer.
SHARED = 30
#: New texts and candidates that a task takes at once, parts of a list by length of the texts, and 64-bit words of a text's signature.
ASKED, TOGETHER, PARTS, SIGNATURE = 1_000, 10_000, 16, 8
#: Words of an index whose lists are rows of marks, a byte a text: adding rows is faster than counting the entries of long lists.
DENSE = 2_000
#: Most frequent words whose order is known; the others come before them, by hash.
RANKED = 200_000
#: Words of new texts that the tasks hold at once: a larger batch probes the index in chunks.
CHUNK_WORDS = 4_000_000

# Query parameters that follow a reader and choose no page, and labels put before titles.
TRACKING = "utm_[a-z_]+|fbclid|gclid|dclid|msclkid|yclid|igshid|mc_cid|mc_eid|spm|ref|ref_src|referrer|from|source|share|cmpid|campaign|scene|isappinstalled"
LABELS = "update|updated|exclusive|breaking|video|audio|podcast|pdf|live|alert|correction|corrected|opinion|analysis|report|news|repost|photos?|aktualisiert|exklusiv|eil|eilmeldung|korrektur|mise à jour|exclusif|correction|vidéo|actualización|actualizado|exclusiva|última hora|vídeo|atualização|atualizado|exclusivo|обновлено|обновление|эксклюзив|срочно|видео|更新|独家|转载|快讯|图文|视频|原创|重磅|速報|更新版|独自|動画"

_WORD = re.compile("[\u3040-ヿ㐀-鿿]+|[^\\W_]+(?:[.,]\\d+)*")
_PREFIX = re.compile(rf"^\s*(?:\[[^\]]{{1,14}}\]|【[^】]{{1,14}}】|\((?:{LABELS})\)|(?:{LABELS})\s*[:：|–-]|[*•#>▶►★◆■●]+)\s*", re.I)
#: The end of a sentence that isn't the line's own: end marks may follow it.
_INNER_END = re.compile(r"(?<!\b\w)(?<!\d)[.!…][\"”»’)]*\s|[。！]")
#: Where a label can be: the title opens with a mark, or has a separator near its start.
_LABELLED = re.compile(r"[^\w“”‘’«»„\"'¿¡]|.{2,22}[:：|–-]")
_NO_WORD = re.compile(r"[\W_]+")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)?")
_SEPARATOR = re.compile(r"\s*[|_·»›]\s*|\s+[-–—]\s+")


_TRACKED = re.compile(f"(?:{TRACKING})(?:=|$)", re.I)
KEYS = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "u1", "u2")])


def url_keys(url: str | None) -> tuple[str | None, str | None, str | None]:
    """(address, stored hash, stored hash without tracking) of an address; nulls for what is none.

    The address leaves out what doesn't choose the page: scheme, www, letter case of the host, fragment,
    tracking, order of parameters, trailing slash. The stored kind of hash is over the address without fragment and
    trailing slash, scheme and host in lower case; the second is there where there is tracking.
    """
    if not url:
        return (None, None, None)
    u = url.strip().partition("#")[0]
    base, asked, query = u.partition("?")
    scheme, slashes, rest = base.partition("//")
    host, slash, path = rest.partition("/")
    if not slashes or not host:
        return (None, None, None)
    head, h, path = f"{scheme}//{host}".lower(), host.lower(), slash + path
    sha = lambda x: hashlib.sha256(x.rstrip("/").encode("utf-8", "surrogatepass")).hexdigest()[:16]
    params = [p for p in query.split("&") if p]
    kept = [p for p in params if not _TRACKED.match(p)]
    h = h.removeprefix("www.")
    h = h[: h.rindex(":")] if h.endswith((":80", ":443")) else h
    bare = None
    if len(kept) < len(params):
        bare = sha(head + path.rstrip("/") + ("?" + "&".join(kept) if kept else ""))
    return (f"{h}{path.rstrip('/')}?{'&'.join(sorted(kept))}", sha(head + path + asked + query), bare)


@F.pandas_udf(KEYS)
def _url_keys(url: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([url_keys(u) for u in url], columns=KEYS.names, dtype="object")


def with_url_keys(df: DataFrame, url: str) -> DataFrame:
    """df with the columns a, u1 and u2 of url_keys(), made in one pass."""
    return df.withColumn("_p", _url_keys(url)).select(*df.columns, "_p.a", "_p.u1", "_p.u2")


def content_key(text: Column) -> Column:
    """The stored kind of content hash: lower case, trimmed, white space collapsed."""
    # Single spaces, nearly all white space, stay as they are and need no replacement.
    x = F.trim(F.regexp_replace(F.lower(text), f"[{WS}]{{2,}}|[{WS}&&[^ ]]", " "))
    return F.substring(F.sha2(x, 256), 1, 16)


class _Hashes(dict):
    """Word to 32 bits, signed: enough to compare texts of some thousand words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = h = zlib.crc32(word.encode("utf-8", "surrogatepass")) - 0x80000000
        return h


_HASHES = _Hashes()


def _word_hash(word: str) -> int:
    return _HASHES[word]


def _is_prose(line: str) -> bool:
    """Whether a line is a paragraph or a row of figures: by tab, length, its end, or the end of a sentence within."""
    s = line.strip()
    n = len(s)
    if "\t" in s or n > 170:
        return True
    if boilerplate.SENTENCE_END.search(s, max(0, n - 6)):
        if n >= 40 or (n >= 16 and boilerplate.CJK.search(s)):
            return True
    elif n > 70 and boilerplate.CJK.search(s):
        return True
    return _INNER_END.search(s) is not None


_DIGITS = re.compile("[0-9]+")
_HAS_LETTER = re.compile(r"[^\W\d_]")
_WORD_OR_LINE = re.compile(r"\n|" + _WORD.pattern)
LINES = "h array<long>, prose array<boolean>, size array<int>, w array<int>"


def text_lines(text: str | None) -> tuple[list[int], list[bool], list[int], list[int]]:
    """(form hash, whether prose, number of words) of each non-blank line, and the hashes of all words; 0 is the form of a line without a letter.

    Words of Chinese and Japanese are their pairs of characters.
    """
    if not text:
        return [], [], [], []
    low = text.lower()
    at, words = [], []
    for w in _WORD_OR_LINE.findall(low):
        if w == "\n":
            at.append(len(words))
        elif "\u3040" <= w[0] <= "\u9fff":
            words += [_HASHES[w[i : i + 2]] for i in range(max(1, len(w) - 1))]
        else:
            words.append(_HASHES[w])
    at.append(len(words))
    forms, prose, size = [], [], []
    before = 0
    for line, form, end in zip(text.split("\n"), _DIGITS.sub("", low).split("\n"), at, strict=True):
        form = " ".join(form.split())
        if form or line.strip():
            forms.append(xxhash.xxh3_64_intdigest(form.encode("utf-8", "surrogatepass")) - (1 << 63) if _HAS_LETTER.search(form) else 0)
            prose.append(_is_prose(line))
            size.append(end - before)
            before = end
    return forms, prose, size, words


def _list_column(values: list[list], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([x for v in values for x in v], kind))


def read_lines(texts: DataFrame, text: str) -> DataFrame:
    """texts with the columns of LINES in place of the text: all that is needed of it, made in one pass."""
    ship_package(texts.sparkSession)
    keep = [c for c in texts.columns if c != text]
    types = dict(texts.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [text_lines(t) for t in b.column(len(keep)).to_pylist()]
            kinds = (pa.int64(), pa.bool_(), pa.int32(), pa.int32())
            columns = [_list_column([g[i] for g in got], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *columns], [*keep, "h", "prose", "size", "w"])

    return texts.select(*keep, text).mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in keep) + ", " + LINES)


def main_words(h: np.ndarray, prose: np.ndarray, size: np.ndarray, w: np.ndarray, template: np.ndarray | None) -> np.ndarray:
    """The words of a text's paragraphs and figures outside the template lines; of its other lines where it has none."""
    own = np.ones(len(h), bool) if template is None or not len(template) else ~np.isin(h, template)
    return w[np.repeat(_main_lines(own, prose, np.zeros(len(h), np.int64)), size)]


def _main_lines(own: np.ndarray, prose: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which lines main_words() takes, for lines of many texts: own are those outside the template, text has each line's text."""
    body = own & prose
    return np.where((np.bincount(text[body], minlength=len(text) and text[-1] + 1) > 0)[text], body, own)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting: np.unique() hashes integers first, which takes far longer where most are distinct."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] - 1) != 0]


def _mix(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return h


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all values, length of each list) of an Arrow list column."""
    offsets = np.asarray(column.offsets)
    return np.asarray(column.flatten()).astype(np.int64), np.diff(offsets)


def _row_words(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The distinct (row, word) pairs as numbers: row above, word in the lower 32 bits."""
    return _distinct((np.repeat(np.arange(len(size)), size) << 32) | (words & 0xFFFFFFFF))


class WordOrder:
    """A fixed order of words: those of known frequency by it, the others before them, by number."""

    def __init__(self, x: np.ndarray, n: np.ndarray):
        order = np.argsort(x & 0xFFFFFFFF)
        self.x, self.n = (x & 0xFFFFFFFF)[order], n[order]

    def sort(self, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, number of words) of the texts: distinct, in order."""
        pairs = _row_words(words, size)
        row, w = pairs >> 32, pairs & 0xFFFFFFFF
        if len(self.x):
            at = np.minimum(np.searchsorted(self.x, w), len(self.x) - 1)
            freq = np.where(self.x[at] == w, self.n[at], 0)
            w = w[np.argsort((row << 32) | freq, kind="stable")]
        return w, np.bincount(row, minlength=len(size))

    def apply(self, texts: DataFrame) -> DataFrame:
        """texts (signal_id, seq, copy, w) with the words distinct and in order."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                w, size = self.sort(*_flat(b.column(3)))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(w.astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([*b.columns[:3], lists], ["signal_id", "seq", "copy", "w"])

        return texts.select("signal_id", "seq", "copy", "w").mapInArrow(run, ", ".join(f"{c} {t}" for c, t in texts.dtypes))


class OverlapIndex:
    """Inverted index of the prefixes of texts, and their words, for exact search by overlap. Words are distinct and in the fixed order.

    Texts are numbered by their number of words, so the texts of a fitting length are a part of each list.
    """

    def __init__(self, seq: np.ndarray, words: np.ndarray, size: np.ndarray):
        number = np.argsort(size, kind="stable")
        self.seq, self.n, words = seq[number], size[number], words & 0xFFFFFFFF
        place = np.empty(len(size), np.int64)
        place[number] = np.arange(len(size))
        row, rank = np.repeat(place, size), np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size)
        first = rank < self.prefix(self.n)[row]
        #: Lists of texts, one after the other, by word: each entry is (index of the word, text).
        lists = np.sort((words[first].astype(np.uint64) << np.uint64(32)) | row[first].astype(np.uint64))
        key, self.rows = (lists >> np.uint64(32)).astype(np.int64), (lists & np.uint64(0xFFFFFFFF)).astype(np.int64)
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        self.keys, n = key[begins], np.diff(begins, append=len(key))
        #: Where each list's part of texts of a length begins.
        self.cuts = np.linspace(0, len(size), PARTS + 1).astype(np.int64)
        part = np.repeat(np.arange(PARTS), np.diff(self.cuts))[self.rows]
        counts = np.bincount(np.repeat(np.arange(len(n)), n) * PARTS + part, minlength=len(n) * PARTS).reshape(-1, PARTS)
        self.parts = begins[:, None] + np.concatenate([np.zeros((len(n), 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
        #: The longest lists as marks, and which row of them is whose.
        longest = np.argsort(-n, kind="stable")[:DENSE]
        self.dense, self.marks = np.full(len(n), -1), np.zeros((len(longest), len(size)), np.uint8)
        self.dense[longest] = np.arange(len(longest))
        for i, k in enumerate(longest):
            self.marks[i, self.rows[begins[k] : begins[k] + n[k]]] = 1
        self.start = np.cumsum(self.n) - self.n
        self.words = np.sort((row << 32) | words) & 0xFFFFFFFF
        self.signature = self.signatures(row, words, len(size))

    @staticmethod
    def signatures(row: np.ndarray, words: np.ndarray, rows: int) -> np.ndarray:
        """Each text's words as a set of bits: a bit that only one of two texts has is a word that the other lacks."""
        out = np.zeros(rows * SIGNATURE, np.uint64)
        bit = (words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 6 - SIGNATURE.bit_length() + 1)
        np.bitwise_or.at(out, row * SIGNATURE + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        return out.reshape(rows, SIGNATURE)

    @staticmethod
    def needed(n: np.ndarray) -> np.ndarray:
        return np.ceil(UNCHANGED * n - 1e-9).astype(np.int64)

    @classmethod
    def prefix(cls, n: np.ndarray) -> np.ndarray:
        return np.minimum(n, n - cls.needed(n) + SHARED)

    def alike(self, seq: np.ndarray, words: np.ndarray, size: np.ndarray) -> list[tuple[int, int, float]]:
        """(seq, other, overlap) of the texts given and the earlier ones of the index; ASKED texts are taken at once."""
        if not len(self.keys):
            return []
        at = np.concatenate([[0], np.cumsum(size)])
        parts = [(k, min(k + ASKED, len(size))) for k in range(0, len(size), ASKED)]
        return [pair for k, m in parts for pair in self._alike(seq[k:m], words[at[k] : at[m]] & 0xFFFFFFFF, size[k:m])]

    def _alike(self, seq: np.ndarray, words: np.ndarray, size: np.ndarray) -> list[tuple[int, int, float]]:
        start, prefix, need = np.cumsum(size) - size, self.prefix(size), self.needed(size)
        low, high = np.searchsorted(self.n, need), np.searchsorted(self.n, np.floor(size / UNCHANGED + 1e-9), "right")
        begins, ends = np.searchsorted(self.cuts, low, "right") - 1, np.searchsorted(self.cuts, high)
        signature = self.signatures(np.repeat(np.arange(len(size)), size), words, len(size))
        # The lists of the words of the prefixes that the index has, cut to texts of about a fitting length.
        owner = np.repeat(np.arange(len(size)), prefix)
        head = words[np.repeat(start - (np.cumsum(prefix) - prefix), prefix) + np.arange(len(owner))]
        at = np.minimum(np.searchsorted(self.keys, head), len(self.keys) - 1)
        known = self.keys[at] == head
        owner, at = owner[known], at[known]
        dense, a, b = self.dense[at], self.parts[at, begins[owner]], self.parts[at, ends[owner]]
        few = (dense < 0) & (a < b)
        lists = [self.rows[i:k] for i, k in zip(a[few].tolist(), b[few].tolist(), strict=True)]
        of = lambda owner: np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(size)))]).tolist()
        lists_of, marks_of, dense = of(owner[few]), of(owner[dense >= 0]), dense[dense >= 0]
        least = np.minimum(SHARED, need).tolist()
        out: list[tuple[int, int, float]] = []
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        waiting = 0
        for i, (x, y) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
            if x >= y:
                continue
            met = np.zeros(y - x, np.int64)
            if lists_of[i] < lists_of[i + 1]:
                met += np.bincount(np.concatenate(lists[lists_of[i] : lists_of[i + 1]]), minlength=y)[x:y]
            for k in range(marks_of[i], marks_of[i + 1], 255):  # a byte holds 255 marks
                met += np.add.reduce(self.marks[dense[k : min(k + 255, marks_of[i + 1])], x:y], axis=0, dtype=np.uint8)
            rows = np.flatnonzero(met >= least[i])
            if len(rows):
                held.append((i, rows + x, met[rows]))
                waiting += len(rows)
                if waiting >= TOGETHER:
                    out += self._compared(seq, words, start, size, signature, held)
                    held, waiting = [], 0
        return out + self._compared(seq, words, start, size, signature, held)

    def _compared(self, seq: np.ndarray, words: np.ndarray, start: np.ndarray, size: np.ndarray, signature: np.ndarray, held: list[tuple[int, np.ndarray, np.ndarray]]) -> list[tuple[int, int, float]]:
        """(seq, other, overlap) of those (text asked, texts met, words met in the prefixes) that overlap by UNCHANGED."""
        if not held:
            return []
        mine = np.repeat([i for i, _, _ in held], [len(r) for _, r, _ in held])
        rows, met = (np.concatenate([h[k] for h in held]) for k in (1, 2))
        needed = self.needed(np.maximum(self.n[rows], size[mine]))
        fits = (self.seq[rows] < seq[mine]) & (met >= np.minimum(SHARED, needed))
        mine, rows, needed = mine[fits], rows[fits], needed[fits]
        # What the signatures say can't overlap enough needs no comparison.
        lacks = lambda a, b: np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)
        x, y = signature[mine], self.signature[rows]
        fits = (size[mine] - lacks(x, y) >= needed) & (self.n[rows] - lacks(y, x) >= needed)
        return self._verified(seq, words, start, size, mine[fits], rows[fits])

    def _verified(self, seq: np.ndarray, words: np.ndarray, start: np.ndarray, size: np.ndarray, asked: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, float]]:
        """(seq, other, overlap) of the candidates (text asked, text met) that overlap by UNCHANGED."""
        out = []
        for i in np.unique(asked):
            met = rows[asked == i]
            mine, n = np.sort(words[start[i] : start[i] + size[i]]), self.n[met]
            first = np.cumsum(n) - n
            other = self.words[np.repeat(self.start[met] - first, n) + np.arange(first[-1] + n[-1])]
            same = mine[np.minimum(np.searchsorted(mine, other), len(mine) - 1)] == other
            overlap = np.add.reduceat(same, first, dtype=np.int64) / np.maximum(n, len(mine))
            out += [(int(seq[i]), int(self.seq[r]), float(v)) for r, v in zip(met, overlap, strict=True) if v >= UNCHANGED]
        return out


class TextIndex:
    """A kept index of texts at a path of the shared folder, for exact search of texts that overlap by UNCHANGED.

    forms: in how many texts of a source each line form is, and (form 0) texts of the source, one part a batch.
    order: the fixed order of words. texts: the first text of each exact word sequence, its distinct words in the fixed
    order. Each is appended to and never rewritten; no text is read again.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.batches, self._ordered = spark, path or scratch_path(spark, "texts"), 0, None
        ship_package(spark)
        while self._there(f"texts/part={self.batches}"):
            self.batches += 1

    def _there(self, name: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def _append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/{name}")

    def read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.path}/{name}")

    def templates(self) -> DataFrame:
        """(grp, tm): the line forms in MIN_SHARE and MIN_DOCS of a source's texts so far."""
        n = self.read("forms", "grp string, h long, n long").groupBy("grp", "h").agg(F.sum("n").alias("n"))
        docs = n.filter("h = 0").select("grp", F.col("n").alias("n_docs"))
        kept = n.filter("h <> 0").join(docs, "grp").filter((F.col("n") >= MIN_DOCS) & (F.col("n") >= F.col("n_docs") * F.lit(MIN_SHARE)))
        return kept.groupBy("grp").agg(F.collect_list("h").alias("tm"))

    def _words(self, batch: DataFrame, ordered: Broadcast | None) -> DataFrame:
        """(signal_id, seq, copy, w): the main words of the batch's texts: distinct and in order, where the order is known."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                (h, lines), (prose, _), (size, _), (w, _) = (_flat(b.column(i)) for i in range(2, 6))
                text = np.repeat(np.arange(b.num_rows), lines)
                # Lines by source, each held against the template of its own.
                code = np.asarray(b.column(7).dictionary_encode().indices.fill_null(-1)).astype(np.int64)
                own, order = np.ones(len(h), bool), np.argsort(code[text], kind="stable")
                begins = np.flatnonzero(np.diff(code[text[order]], prepend=-2))
                for i, k in zip(begins, [*begins[1:], len(order)], strict=True):
                    tm = b.column(6)[int(text[order[i]])]
                    if tm.is_valid:
                        own[order[i:k]] = ~np.isin(h[order[i:k]], np.asarray(tm.values))
                main = _main_lines(own, prose.astype(bool), text)
                flat = w[np.repeat(main, size)]
                size = np.bincount(text, weights=size * main, minlength=b.num_rows).astype(np.int64)
                ends, data = np.cumsum(size).tolist(), memoryview(flat.astype(np.int32).tobytes())
                copy = pa.array([xxhash.xxh3_64_intdigest(data[4 * i : 4 * k]) - (1 << 63) if i < k else None for i, k in zip([0, *ends], ends)], pa.int64())  # noqa: B905
                if ordered:
                    flat, size = ordered.value.sort(flat, size)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat.astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), copy, lists], ["signal_id", "seq", "copy", "w"])

        # Written first: a small table goes to the lines; else these, all that is kept of a text, are shuffled before its size is known.
        templates = bounded_broadcast(materialize(self.templates(), "templates"))
        x = batch.join(templates, "grp", "left").select("signal_id", F.col("seq").cast("long").alias("seq"), "h", "prose", "size", "w", "tm", "grp")
        return x.mapInArrow(run, f"signal_id {dict(batch.dtypes)['signal_id']}, seq long, copy long, w array<int>").filter("copy is not null")

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, rank) of the most frequent words, RANKED at most."""
        x = self.read("order", "x int, n long").toArrow()
        return tuple(np.asarray(x.column(c).combine_chunks()).astype(np.int64) for c in ("x", "n"))

    def ordered(self) -> Broadcast:
        """The WordOrder at the tasks: it is fixed, so all batches have the same copy."""
        if self._ordered is None:
            self._ordered = self.spark.sparkContext.broadcast(WordOrder(*self.order()))
        return self._ordered

    def fold(self, batch: DataFrame, probe: bool = True) -> DataFrame | None:
        """Add a batch (signal_id, seq, grp and the columns of LINES) and, to probe, return its pairs.

        The pairs are (signal_id, other, overlap): texts of the batch and the seq of an earlier text, of the index or the
        batch. Exact copies are linked to the first of them and are not indexed. The first batch fixes the order of words.
        """
        batch = batch.withColumn("grp", F.col("grp").cast("string"))
        forms = batch.filter("grp is not null").select("grp", F.explode(F.array_union(F.array_distinct("h"), F.array(F.lit(0).cast("long")))).alias("h"))
        self._append(forms.groupBy("grp", "h").agg(F.count(F.lit(1)).alias("n")), "forms")
        if not self._there("order"):
            words = materialize(self._words(batch, None), "words")
            self._append(word_frequencies(words, "w").orderBy(F.desc("n"), "x").limit(RANKED), "order")
            words = self.ordered().value.apply(words)
        else:
            words = self._words(batch, self.ordered())
        words = materialize(words, "words")
        firsts = words.groupBy("copy").agg(F.min("seq").alias("other")).withColumn("is_new", F.lit(True))
        if self.batches:
            known = self.read("texts", "seq long, copy long").select("copy", F.col("seq").alias("_known"))
            firsts = firsts.join(known, "copy", "left").select("copy", F.coalesce("_known", "other").alias("other"), F.col("_known").isNull().alias("is_new"))
        links = materialize(words.select("signal_id", "seq", "copy").join(firsts, "copy"), "links")
        part = f"texts/part={self.batches}"
        self._append(words.join(links.filter("is_new and seq = other").select("seq"), "seq", "left_semi").select("seq", "copy", "w"), part)
        self.batches += 1
        if not probe:
            return None
        near = overlapping(self.read("texts", "seq long, w array<int>"), self.read(part, "seq long, w array<int>")).join(links.select("seq", "signal_id"), "seq")
        return materialize(near.select("signal_id", "other", "overlap").unionByName(links.filter("seq > other").select("signal_id", "other", F.lit(1.0).alias("overlap"))), "found")


PAIRS = "seq long, other long, overlap double"


def overlapping(texts: DataFrame, fresh: DataFrame) -> DataFrame:
    """(seq, other, overlap): all pairs of a text of fresh and an earlier one of texts (seq, w: distinct words in one order) that overlap by UNCHANGED of the larger set.

    The kept texts stay where they are and are inverted by the tasks, Arrow batch by Arrow batch; the texts of fresh, the
    query set, go to the tasks in chunks of CHUNK_WORDS. The pairs of a chunk are written before the next is taken, so
    driver and executors hold one chunk at a time, whatever the number of texts.
    """
    spark = texts.sparkSession
    path = scratch_path(spark, "pairs")
    total = fresh.agg(F.sum(F.size("w"))).first()[0] or 0
    chunks = -(-total // CHUNK_WORDS) or 1
    for k in range(chunks):
        rows = fresh.filter(F.pmod(F.xxhash64("seq"), F.lit(chunks)) == k).select("seq", "w").toArrow().combine_chunks()
        seq, w = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns)
        asked = spark.sparkContext.broadcast((np.asarray(seq), *_flat(w)))

        def run(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = OverlapIndex(np.asarray(b.column(0)), *_flat(b.column(1))).alike(*asked.value)
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], t) for i, t in enumerate(kinds)], ["seq", "other", "overlap"])

        pairs = texts.select("seq", "w").mapInArrow(run, PAIRS)
        pairs.write.mode("append").option("compression", "zstd").parquet(path)
        asked.destroy()
    return spark.read.schema(PAIRS).parquet(path)


def word_frequencies(texts: DataFrame, words: str) -> DataFrame:
    """(x, n): in how many texts each word hash is; tasks send one row per word they met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = _row_words(*_flat(b.column(0)))
            x, n = np.unique((pairs & 0xFFFFFFFF).astype(np.uint32).view(np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(n)], ["x", "n"])

    return texts.filter(F.col(words).isNotNull()).select(words).mapInArrow(count, "x int, n long").groupBy("x").agg(F.sum("n").alias("n"))


def signal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, seq, batch_no, grp and the columns of LINES) of each signal's first row: each text is read once, for its own batch."""
    raw = table(spark, sf_dir, "raw_signal").select("signal_id", F.col("ingest_seq").alias("seq"), "batch_no", F.col("source_id").alias("grp"), "raw_text")
    return read_lines(only_first(raw, "signal_id", "seq"), "raw_text")


def similar_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, other, overlap): signals of new batches and the ingest_seq of an earlier signal with the same main text but for small edits.

    The index is made of batch 0; the new batches are folded in one after the other, in order of their numbers.
    Lines that a source repeats, counted up to the batch, and headline-like lines are left out. Signals without
    main words are alike to none.
    """
    path = scratch_path(spark, "lines")
    signal_lines(spark, sf_dir).withColumn("batch_no", F.coalesce("batch_no", F.lit(0))).write.partitionBy("batch_no").option("compression", "zstd").parquet(path)
    lines = spark.read.parquet(path)
    index = TextIndex(spark)
    out = [spark.createDataFrame([], "signal_id string, other long, overlap double")]
    for b in sorted(r[0] for r in lines.select("batch_no").distinct().collect()):
        found = index.fold(lines.filter(F.col("batch_no") == b).drop("batch_no"), probe=b > 0)
        if found is not None:
            out.append(found)
    return functools.reduce(DataFrame.unionByName, out)


@functools.lru_cache(maxsize=4096)
def _own_name(name: str | None) -> str | None:
    return unicodedata.normalize("NFKC", name).strip().lower() if name else None


def title_form(title: str | None, name: str | None) -> str | None:
    """The title without added labels, letter case, punctuation and spacing; null stays null."""
    if title is None:
        return None
    t = title if title.isascii() else unicodedata.normalize("NFKC", title)
    own = _own_name(name)
    while True:
        u = t.strip()
        if _LABELLED.match(u):
            u = _PREFIX.sub("", u, count=1)
        low = u.lower()
        if own and own in low:
            parts = _SEPARATOR.split(u.rstrip(" .!…。！"))
            if len(parts) > 1 and parts[-1].strip().lower() == own:
                u = re.sub(r"\s*[|_·»›–—-]\s*$", "", u[: low.rfind(own)])
            elif len(parts) > 1 and parts[0].strip().lower() == own:
                u = re.sub(r"^\s*[|_·»›–—:-]\s*", "", u[low.find(own) + len(own) :])
        if u == t or not u.strip():
            break
        t = u
    return _NO_WORD.sub("", t.lower())


TITLE = T.StructType([T.StructField("form", T.StringType()), T.StructField("numbers", T.StringType())])
#: Edits allowed between titles; two letters swapped are two edits.
SLIPS = 2


#: An odd number and its inverse modulo 2^64: powers of it hash a span of letters wherever the span stands.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def title_spans(forms: list[str], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own, asked, number of asked by title): hashes of the spans by which titles of one place meet that are SLIPS edits apart at most.

    own has the SLIPS + 1 segments of each title, asked the spans of each title where a segment of one as long or up to
    SLIPS shorter can stand. Some segment is unedited and has as many edits before it as segments, so it is shifted by these
    at most, and by what the edits after it leave of the difference in length: none of the pairs is left out, whatever their
    length or script. A segment may be empty.
    """
    size = np.array([len(f) for f in forms], np.int64)
    codes = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.cumsum(size) - size
    power, inverse = (np.cumprod(np.full(len(codes) + 1, x, np.uint64)) for x in (_BASE, _INVERSE))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * power[:-1])])
    parts = SLIPS + 1

    def spans(length: np.ndarray, i: int, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        a = start + at
        return _mix(place, length * parts + i, (total[a + n] - total[a]) * inverse[a]).view(np.int64)

    own, asked, there = [], [], []
    for less in range(parts):
        length = size - less
        for i in range(parts):
            first = i * length // parts
            n = (i + 1) * length // parts - first
            if not less:
                own.append(spans(length, i, first, n))
            for shift in range(max(-i, less - (SLIPS - i)), min(i, less + SLIPS - i) + 1):
                at = first + shift
                fits = (length > 0) & (at >= 0) & (at + n <= size)
                there.append(fits)
                asked.append(spans(length, i, np.where(fits, at, 0), np.where(fits, n, 0)))
    there = np.stack(there, axis=1)
    return np.stack(own, axis=1), np.stack(asked, axis=1)[there], there.sum(axis=1)


@F.pandas_udf(TITLE)
def title_parts(title: pd.Series, name: pd.Series) -> pd.DataFrame:
    forms = [title_form(t, n) for t, n in zip(title, name, strict=True)]
    numbers = ["|".join(_NUMBER.findall(t if t.isascii() else unicodedata.normalize("NFKC", t))) if t else None for t in title]
    return pd.DataFrame({"form": forms, "numbers": numbers})


def letter_bits(forms: list[str]) -> np.ndarray:
    """Each title's set of letters folded to 63 bits: an edit changes two of them at most. Titles aren't empty."""
    size = np.array([len(f) for f in forms])
    codes = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.bitwise_or.reduceat(np.int64(1) << (codes % 63), np.cumsum(size) - size)


def with_spans(forms: DataFrame) -> DataFrame:
    """forms (key, place, first, form) as (key, old, n, bits, own, asked): whether it is of history, its length, letter_bits() and title_spans()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            form = b.column(3).to_pylist()
            own, asked, n = title_spans(form, np.asarray(b.column(1)))
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(k)]).astype(np.int32)), pa.array(x)) for x, k in ((own.ravel(), np.full(len(own), own.shape[1])), (asked, n))]
            columns = [b.column(0), pa.array(np.asarray(b.column(2)) < 0), pa.array([len(f) for f in form], pa.int32()), pa.array(letter_bits(form)), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["key", "old", "n", "bits", "own", "asked"])

    return forms.select("key", "place", "first", "form").mapInArrow(run, "key long, old boolean, n int, bits long, own array<long>, asked array<long>")


def similar_titles(rows: DataFrame) -> DataFrame:
    """(item_id) of rows with is_new whose title an earlier row of the source has, but for slips, case, punctuation, spacing and labels.

    rows: (item_id, seq, is_new, source, title, source_name). Titles of one form are the same; of other forms those with
    the same numbers, in order, are that are SLIPS edits apart at most: all pairs of them are found. Equal forms with equal
    numbers are collapsed to their earliest row before forms are compared.
    """
    x = rows.filter(F.col("title").isNotNull()).withColumn("p", title_parts("title", "source_name"))
    x = x.select("item_id", "seq", "is_new", "p.form", F.xxhash64("source", "p.form").alias("id"), F.xxhash64("source", "p.numbers").alias("place")).filter("form <> ''")
    x = materialize(x.withColumn("key", F.xxhash64("id", "place")), "titles")
    forms = x.groupBy("key").agg(F.min("seq").alias("first"), F.min("id").alias("id"), F.min("form").alias("form"), F.min("place").alias("place"))
    forms = materialize(forms, "forms")
    # Hashes alone are joined; the titles of the few candidates are fetched after.
    g = materialize(with_spans(forms), "spans")
    o = g.select(F.col("key").alias("other"), F.col("old").alias("_old"), F.col("n").alias("_n"), F.col("bits").alias("_bits"), F.explode("own").alias("span"))
    g = g.select("key", "old", "n", "bits", F.explode("asked").alias("span"))
    # Each pair is met once, from the longer title or the larger key; two titles of history need no comparison.
    once = (F.col("n") > F.col("_n")) | ((F.col("n") == F.col("_n")) & (F.col("key") > F.col("other")))
    alike = once & ~(F.col("old") & F.col("_old")) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("_bits"))) <= 2 * SLIPS)
    near = materialize(g.join(o, "span").filter(alike).select("key", "other").distinct(), "near")
    # A small table of candidates goes to the titles, not the titles to it.
    hint = F.broadcast if is_small(near) else (lambda d: d)
    one = hint(near).join(forms.select("key", "form", "first"), "key")
    near = hint(one).join(forms.select(F.col("key").alias("other"), F.col("form").alias("_form"), F.col("first").alias("_first")), "other")
    near = near.filter(F.levenshtein("form", "_form", SLIPS).between(1, SLIPS))
    near = near.select(F.when(F.col("first") > F.col("_first"), F.col("key")).otherwise(F.col("other")).alias("key"), F.least("first", "_first").alias("near"))
    near = near.groupBy("key").agg(F.min("near").alias("near"))
    known = forms.groupBy("id").agg(F.min("first").alias("first"))
    new = x.filter("is_new").select("item_id", "seq", "id", "key").join(known, "id").join(hint(near), "key", "left")
    return new.filter(F.least("first", "near") < F.col("seq")).select("item_id").distinct()


def _key_hashes(*keys: tuple[str, Column]) -> Column:
    """array<struct<h1, h2>>: 128-bit hashes of the keys that are not null, each with its kind."""
    both = [F.when(k.isNotNull(), F.struct(F.xxhash64(F.lit(kind), k).alias("h1"), F.xxhash64(F.lit(kind), F.lit(5), k).alias("h2"))) for kind, k in keys]
    return F.array_compact(F.array(*both))


def _known_before(mine: DataFrame, old: DataFrame, key: str, inner: str = "keys") -> DataFrame:
    """(key) of rows of mine with is_new that share a key hash with a row of old or an earlier row.

    mine: (key, seq, is_new, keys, inner); old: (keys). Of mine's own earlier rows the keys in inner count.
    """
    k = [F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2")]
    m = mine.filter("is_new").select(key, "seq", F.explode("keys").alias("k")).select(key, "seq", *k)
    n = mine.select("seq", F.explode(inner).alias("k")).select("seq", *k)
    o = old.select(F.explode("keys").alias("k")).select(F.lit(-1).cast("long").alias("seq"), *k)
    first = n.unionByName(o).groupBy("h1", "h2").agg(F.min("seq").alias("first"))
    return materialize(m.hint("shuffle_hash").join(first, ["h1", "h2"]).filter(F.col("first") < F.col("seq")).select(key).distinct(), "known")


def repeated_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id): signals of new batches that repeat a seen record or an earlier signal."""
    raw, seen = table(spark, sf_dir, "raw_signal"), table(spark, sf_dir, "seen_signal")
    # Each key is made once, in a projection of its own after the first rows are chosen, and then hashed.
    x = only_first(raw.select("signal_id", "ingest_seq", "batch_no", "source_url", "url_hash", "content_hash", "raw_text"), "signal_id", "ingest_seq")
    x = x.select("signal_id", "ingest_seq", "batch_no", "source_url", "url_hash", F.coalesce("content_hash", content_key(F.col("raw_text"))).alias("c"))
    x = with_url_keys(x, "source_url")
    x = x.select("signal_id", "ingest_seq", "batch_no", _key_hashes(("a", F.col("a")), ("u", F.col("url_hash")), ("u", F.col("u1")), ("u", F.col("u2")), ("c", F.col("c"))).alias("keys"))
    x = materialize(x.select("signal_id", F.col("ingest_seq").alias("seq"), (F.col("batch_no") > 0).alias("is_new"), "keys"), "signals")
    old = with_url_keys(seen.select("source_url", "url_hash", "content_hash"), "source_url").select(_key_hashes(("a", F.col("a")), ("u", F.col("url_hash")), ("c", F.col("content_hash"))).alias("keys"))
    return _known_before(x, old, "signal_id").unionByName(similar_signals(spark, sf_dir).select("signal_id")).distinct()


def repeated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id): candidate items that repeat an accepted document or an earlier item."""
    docs = table(spark, sf_dir, "seen_documents").filter(F.col("status").isin("saved", "partial", "duplicate"))
    title_hash = F.substring(F.sha2(F.concat_ws("||", "source", "title", F.coalesce("published", F.lit(""))), 256), 1, 16)
    c = table(spark, sf_dir, "candidate_item").select("item_id", "ingest_seq", "source", "title", "url", title_hash.alias("t"))
    c = with_url_keys(only_first(c, "item_id", "ingest_seq"), "url")
    c = c.select("item_id", "ingest_seq", "source", "title", _key_hashes(("a", F.col("a")), ("u", F.col("u1")), ("u", F.col("u2"))).alias("inner"), _key_hashes(("t", F.col("t"))).alias("titles"))
    c = materialize(c, "items")
    # A title hash counts against accepted documents only: among items the same title of a source is found below.
    mine = c.select("item_id", F.col("ingest_seq").alias("seq"), F.lit(True).alias("is_new"), F.concat("inner", "titles").alias("keys"), "inner")
    old = with_url_keys(docs.select("canonical_url", "url_hash", "title_hash"), "canonical_url").select(_key_hashes(("a", F.col("a")), ("u", F.col("url_hash")), ("t", F.col("title_hash"))).alias("keys"))
    exact = _known_before(mine, old, "item_id", "inner")
    names = bounded_broadcast(table(spark, sf_dir, "inventory_source").select(F.col("source_id").alias("source"), "source_name").dropDuplicates(["source"]))
    rows = c.select("item_id", F.col("ingest_seq").alias("seq"), F.lit(True).alias("is_new"), "source", "title").unionByName(
        docs.select(F.lit(None).cast("string").alias("item_id"), F.lit(-1).cast("long").alias("seq"), F.lit(False).alias("is_new"), F.col("source_id").alias("source"), "title")
    )
    return exact.unionByName(materialize(similar_titles(rows.join(names, "source", "left")), "alike")).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_table, item_id) of the repeats.

    Each step is written before the next begins. The driver describes the whole of a plan again with each stage of it
    that ends, and keeps what a plan broadcasts as long as the plan: one plan of all steps takes hundreds of MB there.
    """
    s = repeated_signals(spark, sf_dir).select(F.lit("raw_signal").alias("item_table"), F.col("signal_id").alias("item_id"))
    i = repeated_items(spark, sf_dir).select(F.lit("candidate_item").alias("item_table"), "item_id")
    return s.unionByName(i)
