"""Evaluation texts leaking into training text: winnowed fingerprints, joined and extended to sentences.

Texts are folded (look-alikes, case, accents, punctuation and white space go) to UTF-8 bytes. Of every
window of WINDOW consecutive k-gram hashes the least is kept on both sides, so every folded span of
GRAM + WINDOW - 1 bytes that both share is found. The fingerprints of the two sides are joined by hash, hits
on a sentence are extended along their diagonal and held against the sentence; two neighbouring sentences make a leak.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import materialize, ship_package, table
from .confusables import CYRILLIC_AS, CYRILLIC_LOOK, GREEK_AS, GREEK_LOOK, WEAK_AS, WEAK_LOOK

GRAM, WINDOW, SMALL = 18, 8, 6
#: Share of a sentence's small grams that must stand where its hits say it stands.
SENTENCE_SHARE = 0.7
#: The same share over two neighbouring sentences together.
PAIR_SHARE = 0.83
#: Folded bytes that may stand between two neighbouring sentences: one sentence put in between.
BETWEEN = 700
#: Folded bytes by which hits on one diagonal may be apart.
GAP = 48
#: Folded bytes of test sentences up to which their index is broadcast; a larger test set is joined by shuffles.
INDEX_BYTES = 8_000_000
#: Test fingerprints, 8 bytes each, up to which the tasks drop what no test sentence has before the shuffled join.
FILTER_HASHES = 4_000_000

_FOLD = {ord(a.lower()): b.lower() for look, as_ in ((CYRILLIC_LOOK, CYRILLIC_AS), (GREEK_LOOK, GREEK_AS), (WEAK_LOOK, WEAK_AS)) for a, b in zip(look, as_, strict=True)}
_DROP = re.compile(r"[\W_]+")
_SENTENCE_END = re.compile(r"(?<!\b[^\W\d_])[.!?…]+[\"”»’)\]]*\s+|[。！？]+[」』”’）]*\s*|\n+")
_MUL = np.uint64(0x9E3779B97F4A7C15)


def fold(text: str) -> bytes:
    """text as compared: without case, accents, punctuation, white space and look-alikes."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    return _DROP.sub("", text.lower().translate(_FOLD) if not text.isascii() else text.lower()).encode("utf-8", "ignore")


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-grams of a byte array, by doubling."""
    n = len(b) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power, width = None, 0, b.astype(np.uint64) + np.uint64(1), 1
    mul = np.array([_MUL])
    while True:
        if k & width:
            part = power[done : done + n]
            out = part if out is None else out * mul[0] + part
            done += width
        if done == k:
            break
        power = power[:-width] * mul[0] + power[width:]
        mul = mul * mul
        width *= 2
    return (out ^ (out >> np.uint64(29))) * _MUL


def winnow(h: np.ndarray, w: int = WINDOW) -> np.ndarray:
    """Positions of the least hash of each window of w (a power of two), with all ties.

    A hash is the least of a window if the largest of the minima of the windows that hold it is itself.
    """
    if len(h) <= w:
        return np.flatnonzero(h == h.min()) if len(h) else np.empty(0, np.int64)
    low = h
    step = 1
    while step < w:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    pad = np.zeros(w - 1, np.uint64)
    high = np.concatenate([pad, low, pad])
    step = 1
    while step < w:
        high = np.maximum(high[:-step], high[step:])
        step *= 2
    return np.flatnonzero(high == h)


def sentences(text: str) -> list[str]:
    """The sentences of a passage; initials end none, and what is too short joins the one before."""
    out, last = [], 0
    for m in [*_SENTENCE_END.finditer(text), None]:
        part = text[last : m.end() if m else len(text)]
        last = m.end() if m else last
        if out and (len(fold(part)) < 2 * GRAM):
            out[-1] += part
        elif part.strip():
            out.append(part)
    return out


class PassageIndex:
    """Inverted index of the winnowed fingerprints of test passages, by sentence; equal sentences are one entry."""

    def __init__(self, rows: list[tuple]):
        """rows: (item, passage, no, n, b), the sentences of all passages."""
        self.size, self.small = [], []
        #: Items of one sentence, by sentence; items with the second sentence of a pair after the first, by first and second.
        self.alone: dict[int, set] = {}
        self.pairs: dict[int, dict[int, set]] = {}
        hashes, owner, place = [], [], []
        known: dict[bytes, int] = {}
        before = None
        for item, passage, _, n, f in sorted(rows, key=lambda r: (r[1], str(r[0]), r[2])):
            i = known.get(f)
            if i is None:
                b = np.frombuffer(f, np.uint8)
                h = gram_hashes(b, GRAM)
                i = known[f] = len(self.size)
                p = winnow(h)
                hashes.append(h[p])
                owner.append(np.full(len(p), i))
                place.append(p)
                self.size.append(len(b))
                self.small.append(np.unique(gram_hashes(b, SMALL)))
            if n == 1:
                self.alone.setdefault(i, set()).add(item)
            if before is not None and before[:2] == (item, passage):
                self.pairs.setdefault(before[2], {}).setdefault(i, set()).add(item)
            before = (item, passage, i)
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.owner = np.concatenate(owner)[order] if hashes else np.empty(0, np.int64)
        self.place = np.concatenate(place)[order] if hashes else np.empty(0, np.int64)
        self.keys, self.start, self.count = np.unique(self.hash, return_index=True, return_counts=True)
        self.single = np.zeros(len(self.size), bool)
        self.single[list(self.alone)] = True
        both = [(s, t) for s, after in self.pairs.items() for t in after]
        self.ahead, self.behind = np.array(both, np.int64).reshape(-1, 2).T

    def leaks(self, text: str) -> set:
        """The items that text leaks."""
        b = np.frombuffer(fold(text), np.uint8)
        h = gram_hashes(b, GRAM)
        if not len(h) or not len(self.keys):
            return set()
        pos = winnow(h)
        hh = h[pos]
        at = np.minimum(np.searchsorted(self.keys, hh), len(self.keys) - 1)
        hit = self.keys[at] == hh
        at, pos = at[hit], pos[hit]
        if not len(at):
            return set()
        # Every hit counts, however many test sentences share its fingerprint; what a stock phrase hits by
        # itself is told apart when the sentences are held against the text.
        n = self.count[at]
        rep = np.repeat(np.arange(len(at)), n)
        entry = self.start[at][rep] + np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
        owner, shift = self.owner[entry], pos[rep] - self.place[entry]
        # Of the sentences hit, those that are all of a passage or have a neighbour that is hit can make a leak.
        here = np.zeros(len(self.size), bool)
        here[owner] = True
        both = here[self.ahead] & here[self.behind]
        useful = self.single.copy()
        useful[self.ahead[both]] = True
        useful[self.behind[both]] = True
        can = useful[owner]
        owner, shift = owner[can], shift[can]
        if not len(owner):
            return set()
        order = np.lexsort((shift, owner))
        owner, shift = owner[order], shift[order]
        cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(shift) > GAP)) + 1
        spans: dict[int, list[tuple[int, int]]] = {}
        for a, z in zip([0, *cuts], [*cuts, len(owner)], strict=True):
            s = int(owner[a])
            spans.setdefault(s, []).append((int(shift[a]), int(shift[z - 1]) + self.size[s]))
        grams = None
        shares: dict[tuple[int, int], float] = {}

        def share(s: int, span: tuple[int, int]) -> float:
            nonlocal grams
            if (s, span[0]) not in shares:
                if grams is None:
                    grams = gram_hashes(b, SMALL)
                region = grams[max(0, span[0] - 24) : span[1] + 24]
                small = self.small[s]
                where = np.minimum(np.searchsorted(small, region), len(small) - 1)
                there = np.zeros(len(small), bool)
                there[where[small[where] == region]] = True
                shares[s, span[0]] = float(there.mean())
            return shares[s, span[0]]

        def pair(s: int, t: int) -> bool:
            for after in spans[t]:
                for x in spans[s]:
                    if -80 <= after[0] - x[1] <= BETWEEN and (one := share(s, x)) >= SENTENCE_SHARE and (two := share(t, after)) >= SENTENCE_SHARE:
                        n1, n2 = len(self.small[s]), len(self.small[t])
                        if (one * n1 + two * n2) / (n1 + n2) >= PAIR_SHARE:
                            return True
            return False

        out: set = set()
        for s, here in spans.items():
            alone = self.alone.get(s)
            if alone and not alone <= out and any(share(s, x) >= PAIR_SHARE for x in here):
                out |= alone
            # Only a sentence whose neighbour hits beside it is extended: one alone is no leak.
            follow = self.pairs.get(s, {})
            for t in follow.keys() & spans.keys():
                if not follow[t] <= out and pair(s, t):
                    out |= follow[t]
        return out


def _id(folded: bytes) -> int:
    return xxhash.xxh3_64_intdigest(folded) - (1 << 63)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def passage_sentences(items: DataFrame, item_key: str, passage: str) -> DataFrame:
    """(item, passage, no, n, sid, b, grams): the sentences of each passage in order, by number, of n, with the hash of the folded bytes b and the number of their distinct small grams.

    What is shorter than a gram is left out; repeated passages of an item count once.
    """
    ship_package(items.sparkSession)
    rows = items.filter(F.col(passage).isNotNull() & F.col(item_key).isNotNull()).select(F.col(item_key).alias("item"), F.col(passage).alias("p")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for item, text in zip(pdf["item"], pdf["p"], strict=True):
                parts = sentences(text)
                kept = [f for f in map(fold, parts) if len(f) >= GRAM]
                passage_id = _id(text.encode("utf-8", "surrogatepass"))
                out += [(item, passage_id, i, len(parts), _id(f), f, len(np.unique(gram_hashes(np.frombuffer(f, np.uint8), SMALL)))) for i, f in enumerate(kept)]
            yield pd.DataFrame(out, columns=["item", "passage", "no", "n", "sid", "b", "grams"])

    return rows.mapInPandas(run, f"item {dict(items.dtypes)[item_key]}, passage long, no int, n int, sid long, b binary, grams int")


def sentence_fingerprints(known: DataFrame) -> DataFrame:
    """(h, sid, place): the winnowed fingerprints of distinct sentences (sid, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for b in batch.column(1).to_pylist():
                h = gram_hashes(np.frombuffer(b, np.uint8), GRAM)
                p = winnow(h)
                rows.append((h[p], p))
            size = np.array([len(p) for _, p in rows], np.int64)
            sid = np.repeat(np.asarray(batch.column(0)), size)
            h, p = (np.concatenate(x) if rows else np.empty(0, t) for x, t in zip(zip(*rows) if rows else ((), ()), (np.uint64, np.int64), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(sid), pa.array(p.astype(np.int32))], ["h", "sid", "place"])

    return known.select("sid", "b").mapInArrow(run, "h long, sid long, place int")


def text_fingerprints(docs: DataFrame, key: str, text: str, wanted: np.ndarray | None) -> DataFrame:
    """(key, did, hits, b): of each text with a fingerprint among the wanted ones (sorted; None: all) these, as (pos, h), and its folded bytes with their hash."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = shared.value
        for batch in batches:
            keep, did, hits, folded = [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                f = fold(t)
                h = gram_hashes(np.frombuffer(f, np.uint8), GRAM)
                pos = winnow(h)
                h = _signed(h[pos])
                if want is not None and len(h):
                    at = np.minimum(np.searchsorted(want, h), max(len(want) - 1, 0))
                    hit = want[at] == h if len(want) else np.zeros(len(h), bool)
                    pos, h = pos[hit], h[hit]
                if len(h):
                    keep.append(i)
                    did.append(_id(f))
                    hits.append((pos.astype(np.int32), h))
                    folded.append(f)
            size = np.array([len(h) for _, h in hits], np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate([x[i] for x in hits]) if hits else np.empty(0, t)) for i, t in enumerate((np.int32, np.int64))], ["pos", "h"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pairs)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(did, pa.int64()), lists, pa.array(folded, pa.binary())], ["key", "did", "hits", "b"])

    x = docs.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(key, text)
    return x.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, did long, hits array<struct<pos: int, h: long>>, b binary")


def sentence_shares(spans: DataFrame, found: DataFrame) -> DataFrame:
    """(did, sid, a, share): what part of the small grams of each span's sentence stands where its hits say; spans (did, sid, a, z, s: sentence bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for did, b, tests in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = gram_hashes(np.frombuffer(b, np.uint8), SMALL)
                for t in tests:
                    small = np.unique(gram_hashes(np.frombuffer(t["s"], np.uint8), SMALL))
                    region = np.unique(grams[max(0, t["a"] - 24) : t["z"] + len(t["s"]) + 24])
                    out.append((did, t["sid"], t["a"], len(np.intersect1d(small, region, assume_unique=True)) / len(small)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["did", "sid", "a", "share"])

    tests = spans.groupBy("did").agg(F.collect_list(F.struct("sid", "a", "z", "s")).alias("tests"))
    x = found.select("did", "b").join(materialize(tests, "tests"), "did").select("did", "b", "tests")
    return x.mapInArrow(run, "did long, sid long, a int, share double").distinct()


def leaked_items(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, passage: str) -> DataFrame:
    """(key, item_key): distinct pairs of a document and a test item it leaks.

    The corpus is scanned once and its fingerprints are joined with those of the test sentences by hash: against a
    broadcast index, where the sentences have INDEX_BYTES at most, and else by a shuffle of hits. Every hit counts,
    however many sentences share its fingerprint: what a stock phrase hits by itself is told apart when the sentences
    are held against the text. Null texts, null or empty passages leak nothing; repeated items and documents count once.
    """
    parts = materialize(passage_sentences(items, item_key, passage), "passages")
    size = parts.agg(F.sum(F.length("b"))).first()[0] or 0
    if size > INDEX_BYTES:
        return join_leaks(docs, key, text, parts).select(F.col("key").alias(key), F.col("item").alias(item_key))
    rows = [tuple(r) for r in parts.select("item", "passage", "no", "n", "b").collect()]
    index = docs.sparkSession.sparkContext.broadcast(PassageIndex(rows))
    types = dict(docs.dtypes)[key], dict(items.dtypes)[item_key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(k, i) for k, t in zip(pdf[key], pdf[text], strict=True) if t for i in index.value.leaks(t)]
            yield pd.DataFrame(got, columns=[key, item_key])

    x = docs.select(key, text).filter(F.col(text).isNotNull() & F.col(key).isNotNull())
    return x.mapInPandas(run, f"{key} {types[0]}, {item_key} {types[1]}").distinct()


def join_leaks(docs: DataFrame, key: str, text: str, parts: DataFrame) -> DataFrame:
    """(key, item): leaked_items() of sentences of any number (parts: those of passage_sentences()), by joins.

    Where the test set has FILTER_HASHES fingerprints at most, the tasks drop what can't join before. Of texts without a
    hit nothing leaves a task.
    """
    known = parts.groupBy("sid").agg(F.first("b").alias("s"), F.first(F.length("b")).alias("size"), F.first("grams").alias("grams"))
    prints = materialize(sentence_fingerprints(known.select("sid", F.col("s").alias("b"))), "prints")
    hashes = prints.select("h").distinct().limit(FILTER_HASHES + 1).toArrow()
    wanted = np.sort(np.asarray(hashes.column(0).combine_chunks())) if hashes.num_rows <= FILTER_HASHES else None
    found = materialize(text_fingerprints(docs, key, text, wanted), "found")
    hits = found.select("did", F.explode("hits").alias("t")).select("did", "t.pos", "t.h")
    hits = hits.join(prints, "h").select("did", "sid", (F.col("pos") - F.col("place")).alias("shift"))
    # Hits of one sentence on nearly one diagonal are one span, from its least to its greatest shift.
    row = Window.partitionBy("did", "sid").orderBy("shift")
    hits = hits.withColumn("_new", F.when(F.col("shift") - F.lag("shift").over(row) > GAP, 1).otherwise(0)).withColumn("_n", F.sum("_new").over(row))
    spans = hits.groupBy("did", "sid", "_n").agg(F.min("shift").alias("a"), F.max("shift").alias("z")).drop("_n")
    spans = materialize(spans.join(known.select("sid", "size"), "sid"), "spans")
    # Of the sentences hit, those that are all of a passage or have their neighbour beside them can make a leak.
    next_ = parts.select("item", "passage", (F.col("no") - 1).alias("no"), F.col("sid").alias("t"))
    pairs = parts.join(next_, ["item", "passage", "no"]).select(F.col("sid").alias("s"), "t", "item").distinct()
    alone = parts.filter("n = 1").select("sid", "item").distinct()
    first = spans.select("did", F.col("sid").alias("s"), F.col("a").alias("a1"), F.col("z").alias("z1"), F.col("size").alias("n1"))
    second = spans.select("did", F.col("sid").alias("t"), F.col("a").alias("a2"), F.col("z").alias("z2"))
    apart = F.col("a2") - (F.col("z1") + F.col("n1"))
    near = materialize(first.join(pairs.select("s", "t").distinct(), "s").join(second, ["did", "t"]).filter((apart >= -80) & (apart <= BETWEEN)), "near")
    single = spans.join(alone.select("sid").distinct(), "sid", "left_semi").select("did", "sid", "a", "z")
    needed = near.select("did", F.col("s").alias("sid"), F.col("a1").alias("a"), F.col("z1").alias("z")).unionByName(near.select("did", F.col("t").alias("sid"), F.col("a2").alias("a"), F.col("z2").alias("z")))
    needed = needed.unionByName(single).distinct().join(known.select("sid", "s"), "sid")
    shares = materialize(sentence_shares(needed, found).filter(F.col("share") >= SENTENCE_SHARE), "shares")
    counted = shares.join(known.select("sid", "grams"), "sid")
    one = counted.select("did", F.col("sid").alias("s"), F.col("a").alias("a1"), (F.col("share") * F.col("grams")).alias("_w1"), F.col("grams").alias("_n1"))
    two = counted.select("did", F.col("sid").alias("t"), F.col("a").alias("a2"), (F.col("share") * F.col("grams")).alias("_w2"), F.col("grams").alias("_n2"))
    held = near.join(one, ["did", "s", "a1"]).join(two, ["did", "t", "a2"]).filter((F.col("_w1") + F.col("_w2")) / (F.col("_n1") + F.col("_n2")) >= PAIR_SHARE)
    leaks = held.select("did", "s", "t").distinct().join(pairs, ["s", "t"]).select("did", "item")
    whole = shares.filter(F.col("share") >= PAIR_SHARE).select("did", "sid").distinct().join(alone, "sid").select("did", "item")
    leaks = materialize(leaks.unionByName(whole).distinct(), "leaks")
    return found.select("key", "did").join(leaks, "did").select("key", "item").distinct()


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_item"), "item_id", "passage")
