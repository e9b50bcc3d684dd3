"""Document and segment languages: averaged hashed subword embeddings with a linear softmax.

The model is trained by stochastic gradient descent in numpy on a bounded sample of labelled
sentences, calibrated on held-out ones, and applied to every segment of every text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import materialize, only_first, ship_package, table
from .mojibake import restore

LANGUAGES = ["en", "de", "fr", "es", "pt", "ru", "zh", "ja"]
BUCKETS, DIM, GRAMS = 1 << 15, 16, (2, 4)
#: Labelled sentences of each language, of so many characters at most, that the model is fitted on at most, and the share held out for calibration.
SAMPLE_SENTENCES, SENTENCE_CHARS, HELD_OUT = 2500, 1000, 0.2
#: Labelled texts of each language from which sentences are drawn at most, and signals of each label among which recurring ones are sought.
SAMPLE_TEXTS, SAMPLE_SIGNALS = 500, 500
#: Sentences that recur in so many of these signals are learnt too, each so often in a round of training; so many of each label at most.
RECUR, RECUR_WEIGHT, SAMPLE_RECURRING = 3, 8, 500
EPOCHS, RATE, BATCH, SEED = 4, 0.6, 64, 13
#: Held-out precision that segments above the rejection threshold must have, and the least threshold.
PRECISION, LEAST_CONFIDENCE = 0.998, 0.8

# Labels by language; anything else, and what is listed under "", says nothing.
LABELS = {
    "en": "en eng english englisch anglais inglés inglês английский 英语 英文 英語",
    "de": "de deu ger german deutsch allemand alemán alemão немецкий 德语 德文 ドイツ語",
    "fr": "fr fra fre french französisch français francés francês французский 法语 法文 フランス語",
    "es": "es spa spanish spanisch espagnol español castellano espanhol испанский 西班牙语 スペイン語",
    "pt": "pt por portuguese portugiesisch portugais portugués português португальский 葡萄牙语 ポルトガル語",
    "ru": "ru rus russian russisch russe ruso russo русский 俄语 俄文 ロシア語",
    "zh": "zh zho chi chinese cmn yue chinesisch chinois chino chinês китайский 中文 汉语 漢語 简体中文 繁體中文 普通话 中国語",
    "ja": "ja jpn jap japanese japanisch japonais japonés japonês японский 日语 日文 日本語",
}
_LABEL = {name: code for code, names in LABELS.items() for name in names.split()}
#: Labels of languages outside the model: they name a language, one that none of the texts is known to be in.
_NOTHING = {"", "und", "unknown", "n/a", "na", "none", "null", "mul", "multiple", "mis", "zxx", "other", "xx", "?", "-", "--", "auto", "tbd"}

_SENTENCE = re.compile(r".+?(?:(?<!\b\w)(?<!\d)[.!?…]+[\"”»’)\]]*(?=\s|$)|[。！？!?]+[」』”’）)]*|$)", re.S)
_WIDE = re.compile("[\u3040-ヿ㐀-鿿]")
_KANA = re.compile("[\u3040-ヿ]")
_LETTER = re.compile(r"[^\W\d_]")
_ENDED = re.compile("[.!?…。！？][\"”»’」』）)\\]]*$")


def label_code(label: str | None) -> str | None:
    """The language code a label names, 'other' for a language outside the model, None if it says nothing."""
    if label is None:
        return None
    x = unicodedata.normalize("NFKC", label).strip().lower()
    if x in _NOTHING:
        return None
    if x in _LABEL:
        return _LABEL[x]
    first = re.split(r"[-_\s(,;/]", x)[0]
    return _LABEL.get(first, "other" if first else None)


def segments(text: str) -> list[str]:
    """The whole sentences of a text: they end in a sentence mark and have a sentence's length."""
    out = []
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            continue
        for m in _SENTENCE.finditer(line):
            s = m[0].strip()
            wide = len(_WIDE.findall(s))
            if _ENDED.search(s) and (wide >= 8 or (len(s.split()) >= 4 and len(_LETTER.findall(s)) >= 18)):
                out.append(s)
    return out


_NO_DIGITS = {ord(c): None for c in "0123456789"}


def _folded(text: str) -> str:
    """Lower case without digits, words with their edges; the mix of Chinese and Japanese scripts is told by a mark."""
    x = text.lower().translate(_NO_DIGITS)
    mark = ""
    if _WIDE.search(x):
        mark = "\ue001" * 12 if _KANA.search(x) else "\ue002" * 12
    return f" {x} {mark}"


def _hashes(c: np.ndarray, n: int) -> np.ndarray:
    """Hash buckets of all grams of n characters."""
    h = c[: len(c) - n + 1].copy()
    for i in range(1, n):
        h = h * np.uint64(0x100000001B3) ^ c[i : len(c) - n + 1 + i]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)).astype(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def gram_ids(text: str) -> np.ndarray:
    """Buckets of a segment's character grams."""
    c = _codes(_folded(text))
    return np.concatenate([_hashes(c, n) for n in GRAMS if len(c) >= n])


class LanguageModel:
    """softmax(mean(E[grams]) W): scores is E W, so a segment costs one gather and one mean."""

    def __init__(self, scores: np.ndarray, temperature: float, threshold: float):
        self.scores, self.temperature, self.threshold = scores.astype(np.float32), temperature, threshold
        self.held_out = (float("nan"), 0)

    def means(self, texts: list[str]) -> np.ndarray:
        """The mean score of each segment, with all segments of a text in one pass."""
        folded = [_folded(t) for t in texts]
        size = np.array([len(f) for f in folded])
        start = np.cumsum(size) - size
        c = _codes("".join(folded))
        total, n_all = np.zeros((len(texts), len(LANGUAGES))), np.zeros(len(texts))
        for n in GRAMS:
            if len(c) < n:
                continue
            z = self.scores[_hashes(c, n)]
            end = np.minimum(start + size - n + 1, len(z))
            cuts = np.stack([start, end], axis=1).ravel()
            total += np.add.reduceat(np.concatenate([z, np.zeros((1, z.shape[1]), z.dtype)]), cuts, axis=0)[::2]
            n_all += end - start
        return total / n_all[:, None]

    def classify(self, texts: list[str]) -> list[tuple[str | None, float]]:
        """(language, confidence) of each segment; None where the confidence is below the threshold."""
        if not texts:
            return []
        z = self.means(texts) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        k = p.argmax(axis=1)
        top = p[np.arange(len(k)), k]
        return [(LANGUAGES[i] if c >= self.threshold else None, float(c)) for i, c in zip(k, top, strict=True)]

    @classmethod
    def fit(cls, rows: list[tuple[str, str]], weights: list[int] | None = None) -> LanguageModel:
        """Train on (sentence, language code) rows; the same rows give the same model.

        A sentence is either trained on or held out: repeats are dropped before the split, and a weight repeats a
        row in training only.
        """
        rng = np.random.default_rng(SEED)
        weight = dict(zip(rows, weights or [1] * len(rows), strict=True))
        rows = sorted({s: (s, code) for s, code in sorted(weight)}.values())
        order = rng.permutation(len(rows))
        ids = [gram_ids(rows[i][0]) for i in order]
        y = np.array([LANGUAGES.index(rows[i][1]) for i in order])
        kept = int(len(ids) * (1 - HELD_OUT)) if len(ids) > 50 else len(ids)
        held = [(ids[i], y[i]) for i in range(kept, len(ids))]
        again = np.repeat(np.arange(kept), [weight[rows[order[i]]] for i in range(kept)])
        ids, y, cut = [ids[i] for i in again], y[again], len(again)
        emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
        w = np.zeros((DIM, len(LANGUAGES)), np.float32)
        steps = max(1, EPOCHS * ((cut + BATCH - 1) // BATCH))
        step = 0
        for _ in range(EPOCHS):
            perm = rng.permutation(cut)
            for a in range(0, cut, BATCH):
                idx = perm[a : a + BATCH]
                rate = RATE * (1 - step / steps)
                step += 1
                flat = np.concatenate([ids[i] for i in idx])
                sizes = np.array([len(ids[i]) for i in idx])
                starts = np.cumsum(sizes) - sizes
                mean = np.add.reduceat(emb[flat], starts, axis=0) / sizes[:, None]
                z = mean @ w
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(idx)), y[idx]] -= 1
                grad = (p @ w.T) / sizes[:, None]
                w -= rate * (mean.T @ p) / len(idx) * 8
                np.add.at(emb, flat, (-rate * np.repeat(grad, sizes, axis=0)).astype(np.float32))
        model = cls(emb @ w, 1.0, 0.0)
        if held:
            z = np.stack([model.scores[g].mean(axis=0) for g, _ in held]).astype(np.float64)
            t = np.array([k for _, k in held])
            model.temperature = min((0.25, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 5.0), key=lambda s: _loss(z / s, t))
            p = np.exp(z / model.temperature - (z / model.temperature).max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            top, right = p.max(axis=1), p.argmax(axis=1) == t
            by = np.argsort(-top)
            precision = np.cumsum(right[by]) / np.arange(1, len(by) + 1)
            good = np.flatnonzero(precision >= PRECISION)
            model.threshold = float(min(0.97, max(LEAST_CONFIDENCE, top[by][good[-1]] if len(good) else 0.9)))
            model.held_out = (float(right.mean()), len(held))
        return model


def _loss(z: np.ndarray, t: np.ndarray) -> float:
    z = z - z.max(axis=1, keepdims=True)
    return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(t)), t]).mean())


def label_column(label: Column) -> Column:
    """label_code() as an expression of the JVM."""
    x = F.lower(F.trim(label))
    first = F.element_at(F.split(x, r"[-_\s(,;/]"), 1)
    known = F.create_map(*[F.lit(v) for kv in _LABEL.items() for v in kv])
    nothing = x.isNull() | x.isin(*_NOTHING)
    return F.when(~nothing, F.coalesce(known[x], known[first], F.lit("other")))


def sentence_rows(rows: DataFrame, text: str, label: str, each: int) -> DataFrame:
    """(l, s): the whole sentences, up to SENTENCE_CHARS, of a sample of rows whose label names a language: of each the rows of the lowest text hashes, so many at most."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(code, s) for code, t in zip(pdf["l"], pdf["t"], strict=True) for s in segments(t) if len(s) <= SENTENCE_CHARS], columns=["l", "s"])

    x = rows.select(label_column(F.col(label)).alias("l"), F.col(text).alias("t")).filter(F.col("l").isin(*LANGUAGES) & F.col("t").isNotNull())
    # The rank is cut on the map side already, so no label's rows meet in one task.
    x = x.withColumn("n", F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("t"), F.length("t")))).filter(F.col("n") <= each)
    return x.select("l", "t").mapInPandas(run, "l string, s string")


def _least(rows: DataFrame, each: int) -> list[tuple[str, str]]:
    """(sentence, language): of each language the sentences of the lowest hashes, so many at most. The rank is cut on the map side already."""
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("s"), "s"))
    return [(r["s"], r["l"]) for r in rows.withColumn("n", rank).filter(F.col("n") <= each).select("l", "s").collect()]


def fit_languages(labelled: DataFrame, text: str, label: str, noisy: DataFrame | None = None, noisy_text: str = "", noisy_label: str = "") -> LanguageModel:
    """Fit the model on a bounded sample of labelled rows.

    labelled gives SAMPLE_SENTENCES sentences of each language at most, drawn from the whole texts of SAMPLE_TEXTS rows. noisy, whose labels may be wrong,
    gives SAMPLE_RECURRING sentences of each that recur in RECUR or more of SAMPLE_SIGNALS rows, each with the
    label most of these rows have: so the model also knows how sites speak. An empty table gives a model that
    rejects everything.
    """
    rows = _least(sentence_rows(labelled, text, label, SAMPLE_TEXTS), SAMPLE_SENTENCES)
    if not rows:
        return LanguageModel(np.zeros((BUCKETS, len(LANGUAGES))), 1.0, 1.1)
    weights = [1] * len(rows)
    if noisy is not None:
        counts = sentence_rows(noisy, noisy_text, noisy_label, SAMPLE_SIGNALS).withColumn("s", F.translate("s", "0123456789", "")).groupBy("s", "l").agg(F.count(F.lit(1)).alias("n"))
        top = counts.groupBy("s").agg(F.max_by("l", F.struct("n", "l")).alias("l"), F.max("n").alias("n"), F.sum("n").alias("all")).filter((F.col("n") >= RECUR) & (F.col("n") >= 0.6 * F.col("all")))
        more = _least(top.select("l", "s"), SAMPLE_RECURRING)
        rows, weights = rows + more, weights + [RECUR_WEIGHT] * len(more)
    return LanguageModel.fit(rows, weights)


def _classified(text: str, model: LanguageModel) -> list[tuple[int, str, str | None, float]]:
    """(number, sentence, language, confidence) of the whole sentences of a text; garbled lines are restored first, what stays lost is left out."""
    found = [(i, s) for i, s in enumerate(segments(restore(text)), 1) if s.count("\ufffd") <= 0.05 * len(s)]
    return [(i, s, code, p) for (i, s), (code, p) in zip(found, model.classify([s for _, s in found]), strict=True)]


def segment_rows(rows: DataFrame, keys: list[str], text: str, model: LanguageModel) -> DataFrame:
    """(keys, segment_no, chars, lang_code, confidence): one row per whole sentence of each text; lang_code is null below the threshold."""
    types = dict(rows.dtypes)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(*row[:-1], i, len(s), code, p) for row in zip(*[pdf[k] for k in keys], pdf[text], strict=True) if row[-1] for i, s, code, p in _classified(row[-1], shared.value)]
            yield pd.DataFrame(out, columns=[*keys, "segment_no", "chars", "lang_code", "confidence"])

    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", segment_no int, chars int, lang_code string, confidence double"
    return rows.select(*keys, text).mapInPandas(run, schema)


def segment_languages(rows: DataFrame, keys: list[str], text: str, model: LanguageModel) -> DataFrame:
    """(keys, lang_code, segments, chars, confidence): the languages of each text's whole sentences.

    Garbled lines are restored first, so they count as what they were written in. A sentence below the
    threshold of confidence counts for no language; a text all of whose sentences are below it has one row with a null
    language. confidence is the mean over the sentences of the language. Null and empty texts and texts without a
    sentence give no row.
    """
    types = dict(rows.dtypes)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in zip(*[pdf[k] for k in keys], pdf[text], strict=True):
                if not row[-1]:
                    continue
                by: dict[str | None, list] = {}
                for _, s, code, p in _classified(row[-1], shared.value):
                    got = by.setdefault(code, [0, 0, 0.0])
                    got[0] += 1
                    got[1] += len(s)
                    got[2] += p
                if len(by) > 1:
                    by.pop(None, None)
                out += [(*row[:-1], c, int(n), int(k), p / n) for c, (n, k, p) in by.items()]
            yield pd.DataFrame(out, columns=[*keys, "lang_code", "segments", "chars", "confidence"])

    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", lang_code string, segments int, chars long, confidence double"
    return rows.select(*keys, text).mapInPandas(run, schema)


_MODELS: dict[tuple[str, str], LanguageModel] = {}


def language_model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """The model of a data directory: fitted once a session and kept (some hundred kilobytes)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = fit_languages(table(spark, sf_dir, "documents"), "text", "lang", table(spark, sf_dir, "raw_signal"), "raw_text", "language")
    return _MODELS[key]


def p7_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, label, raw_text) of each signal's first row."""
    raw = table(spark, sf_dir, "raw_signal").select("signal_id", "ingest_seq", "language", "raw_text")
    return only_first(raw, "signal_id", "ingest_seq").select("signal_id", label_column(F.col("language")).alias("label"), "raw_text")


def p7_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, segment_no, chars, lang_code, confidence): the language of each segment."""
    return segment_rows(p7_signals(spark, sf_dir), ["signal_id"], "raw_text", language_model(spark, sf_dir))


def p7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, label, lang_code, segments, chars, confidence), written once."""
    return materialize(segment_languages(p7_signals(spark, sf_dir), ["signal_id", "label"], "raw_text", language_model(spark, sf_dir)), "segments")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = p7_languages(spark, sf_dir).filter("lang_code is not null")
    doc = x.groupBy("signal_id").agg(F.first("label").alias("label"), F.collect_set("lang_code").alias("langs"))
    case = F.col("label").isNull() | (F.size("langs") > 1) | ~F.array_contains("langs", F.coalesce("label", F.lit("")))
    return doc.filter(case).select("signal_id", F.explode("langs").alias("lang_code"))


def p7_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, lang_code, confidence): each signal's main language, the one of most characters; null where none is sure or there is no sentence."""
    x = p7_languages(spark, sf_dir)
    best = x.groupBy("signal_id").agg(F.max_by(F.struct("lang_code", "confidence"), F.struct("chars", "lang_code")).alias("r")).select("signal_id", "r.lang_code", "r.confidence")
    return p7_signals(spark, sf_dir).select("signal_id").join(best, "signal_id", "left")
