"""Visually identical text with different characters: the confusables skeleton.

skeleton() decomposes, replaces every character by its prototype, decomposes again; texts that look
alike have equal skeletons. plain_form() picks of a word's skeleton class the member written in the
text's own script.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship_package, table

# Letters and the Latin letters they look like, in the same order.
CYRILLIC_LOOK = "АВЕЅІЈКМНОРСТУХԚԜԌѴҮаеѕіјорсухԁԛԝһӏѵү"
CYRILLIC_AS = "ABESIJKMHOPCTYXQWGVYaesijopcyxdqwhlvy"
GREEK_LOOK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϳ"
GREEK_AS = "ABEZHIKMNOPTYXovcj"
# The same for scripts whose letters are look-alikes only within a Latin word.
ARMENIAN_LOOK = "ՍՏՕԼաոռսօհցզյքլ"
ARMENIAN_AS = "USOLwnnuohgqjfl"
CHEROKEE_LOOK = "ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴᎩᏂ"
CHEROKEE_AS = "DRTiAJEWMHYGZbRWSVSLCPKdGBYh"
LATIN_EXTRA_LOOK = "ɡɑɩꞬɪʏ"
LATIN_EXTRA_AS = "gaiGIY"
# Look-alikes that count only inside a word of the other script.
WEAK_LOOK = "αικρυγτ"
WEAK_AS = "aikpuyt"
# Cyrillic letters that Latin ones stand for in Cyrillic text.
LATIN_LOOK = "ABEKMHOPCTYXSIJaeopcyxksij"
LATIN_CYRILLIC = "АВЕКМНОРСТУХЅІЈаеорсухкѕіј"
# Radicals without a decomposition and the ideographs they look like.
RADICAL_LOOK = "⺁⺂⺃⺄⺅⺆⺉⺊⺋⺒⺓⺔⺕⺖⺗⺘⺙⺛⺝⺞⺠⺡⺢⺣⺤⺦⺧⺨⺩⺪⺬⺭⺮⺯⺰⺱⺲⺳⺷⺸⺹⺺⺻⺽⺾⺿⻀⻁⻂⻃⻄⻅⻆⻇⻈⻉⻊⻋⻌⻍⻎⻏⻐⻑⻒⻓⻔⻕⻖⻗⻘⻙⻚⻛⻜⻝⻞⻟⻠⻡⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻭⻮⻯⻰⻱⻲"
RADICAL_AS = "厂乛乚乙亻冂刂卜㔾巳幺彑彐忄㣺扌攵旡月歺民氵氺灬爫丬牛犭王疋示礻竹糹纟罓罒网羊羊耂肀聿臼艹艹艹虎衤覀西见角角讠贝足车辶辶辶阝钅長镸长门阜阝雨青韦页风飞食飠飠饣首马骨鬼鱼鸟卤麦黄黾斉齐歯齿竜龙龜亀"
# Signs that show as a plain one.
SIGN_LOOK = "\u2010\u2011\u2024\u037e\u0387\u1fef"
SIGN_AS = "--.;·`"


def _small_capitals() -> dict[int, str]:
    """Letters of Latin named a small capital, by the capital they show as."""
    names = ((c, unicodedata.name(chr(c), "")) for c in (*range(0x250, 0x2B0), *range(0x1D00, 0x1D26), *range(0xA730, 0xA732)))
    return {c: n[-1] for c, n in names if n.startswith("LATIN LETTER SMALL CAPITAL ") and len(n) == 28}


_HIDDEN = "\u00ad\u034f\u061cᅟᅠ\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206fㅤ\ufe00-\ufe0f\ufeffﾠ\U000e0001-\U000e01ef"
_SPACES = "\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = "\u0300-\u034e\u0350-\u036f\u1dc0-\u1dff\u20d0-\u20ff\u3099\u309a\ufe20-\ufe2f"
_COMPAT = "ĲĳĿŀŉſǄ-ǌǱ-ǳᄀ-ᅞᅡ-ᇿẚẛ℀-⅏Ⅰ-ⅿ\u24b6-\u24e9⺀-\u2fdfㄱ-ㅣㅥ-ㆎ豈-\ufaffﬀ-﷿︰-\ufe6f！-ﾟﾡ-\uffef\U0001d400-\U0001d7ff\U0001f100-\U0001f189\U0001fbf0-\U0001fbf9\U0002f800-\U0002fa1f"
_EXTRA = {**{ord(a): b for look, as_ in ((ARMENIAN_LOOK, ARMENIAN_AS), (CHEROKEE_LOOK, CHEROKEE_AS)) for a, b in zip(look, as_, strict=True)}, **_small_capitals(), **{ord(a): b for a, b in zip(LATIN_EXTRA_LOOK, LATIN_EXTRA_AS, strict=True)}}
_RADICALS = {ord(a): b for a, b in zip(RADICAL_LOOK, RADICAL_AS, strict=True)}
_SIGNS = {ord(a): b for a, b in zip(SIGN_LOOK, SIGN_AS, strict=True)}
_EXTRA_CLASS = "".join(map(chr, sorted(_EXTRA)))
#: A text without any of these is plain already: made of the tables and classes above.
SUSPECT = f"[{_HIDDEN}{_SPACES}{_MARKS}{_COMPAT}Ͱ-ϿЀ-ԯ{_EXTRA_CLASS}{SIGN_LOOK}]|[0-9]\u2044[0-9]"
_SUSPECT_RE = re.compile(SUSPECT)
_HIDDEN_RE = re.compile(f"[{_HIDDEN}]")
_SPACES_RE = re.compile(f"[{_SPACES}]")
_MARKED_RE = re.compile(f"[^\\W\\d_](?:[{_HIDDEN}]*[{_MARKS}])+")
_COMPAT_RE = re.compile(f"[{_COMPAT}]+")
_LATIN = "A-Za-zªºÀ-ÖØ-öø-ɏḀ-ỿ"
_CJK = "⺀-\u2fdf\u3040-ヿ㐀-䶿一-鿿豈-\ufaffｦ-ﾟ\U00020000-\U0003ffff"
_SCRIPTS = {"latin": re.compile(f"[{_LATIN}]"), "cyrillic": re.compile("[Ѐ-ԯ]"), "greek": re.compile("[Ͱ-Ͽ]"), "cjk": re.compile(f"[{_CJK}]")}
_WORD_RE = re.compile(f"[{_LATIN}Ͱ-ԯ{_MARKS}{_EXTRA_CLASS}]+")
_EXTRA_RE = re.compile(f"[{_EXTRA_CLASS}]")
_SIGN_RE = re.compile(f"[{SIGN_LOOK}]|(?<=[0-9])\u2044(?=[0-9])")
_LETTER_FORMS = re.compile("[Ⅰ-ⅿ\u24b6-\u24e9]")
_LOOK_RE = re.compile(f"[Ͱ-ԯ{_EXTRA_CLASS}]")
_EMOJI = re.compile("[←-⇿⌀-⏿①-➿〰〽㊗㊙\U0001f000-\U0001faff©®\ufe0f\u20e3]")
_JOINING = re.compile("[\u0590-\u08ff\u0900-\u0dff\u0e00-\u0effက-႟ក-\u18afיִ-﷿ﹰ-ﻼ]")

_TO_LATIN = {ord(a): b for look, as_ in ((CYRILLIC_LOOK, CYRILLIC_AS), (GREEK_LOOK, GREEK_AS), (WEAK_LOOK, WEAK_AS)) for a, b in zip(look, as_, strict=True)}
_STRONG = set(CYRILLIC_LOOK + GREEK_LOOK)
_TO_CYRILLIC = {ord(a): b for a, b in zip(LATIN_LOOK, LATIN_CYRILLIC, strict=True)}
_GREEK_TO_CYRILLIC = {k: _TO_CYRILLIC[ord(v)] for k, v in _TO_LATIN.items() if 0x370 <= k < 0x400 and ord(v) in _TO_CYRILLIC}


def _drop_hidden(text: str) -> str:
    """text without characters that show as nothing; joiners stay in emoji and in joining scripts."""

    def keep(m: re.Match) -> str:
        i, c = m.start(), m[0]
        before, after = text[i - 1 : i], text[i + 1 : i + 2]
        if c in "\u200c\u200d\u200e\u200f" and (_JOINING.match(before or " ") or _JOINING.match(after or " ")):
            return c
        if c == "\u200d" and _EMOJI.match(before or " ") and _EMOJI.match(after or " "):
            return c
        if "\ufe00" <= c <= "\ufe0f" and (_EMOJI.match(before or " ") or unicodedata.category(before or " ")[0] == "S"):
            return c
        if "\U000e0020" <= c <= "\U000e007f" and ("\U0001f3f4" in text):
            return c
        return ""

    return _HIDDEN_RE.sub(keep, text)


#: Character to prototype: one table for all scripts; small к stands for k within Cyrillic words only.
_PROTOTYPE = {**_EXTRA, **_RADICALS, **_SIGNS, **_TO_LATIN, ord("к"): "k", 0x2044: "/", **dict.fromkeys([0x1680, 0x2028, 0x2029], " ")}


def skeleton(text: str | None) -> str | None:
    """The text's skeleton: equal for texts that look equal. Null stays null.

    Decompose, replace every character by its prototype, decompose again.
    """
    if text is None:
        return None
    if text.isascii():
        return text
    x = unicodedata.normalize("NFKD", _drop_hidden(text))
    return unicodedata.normalize("NFKD", x.translate(_PROTOTYPE))


@functools.lru_cache(maxsize=65536)
def _compat_plain(c: str, cjk: bool, beside_cjk: bool) -> str:
    """What an ordinary writer types for a compatibility character, or the character itself."""
    kind = unicodedata.category(c)
    mapping = unicodedata.decomposition(c)
    if not mapping:
        return c
    tag = mapping.split()[0] if mapping[0] == "<" else ""
    plain = unicodedata.normalize("NFKC", c)
    if tag == "<wide>":
        return c if kind[0] not in "LN" and (cjk or beside_cjk) else plain
    if tag in ("<narrow>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<noBreak>"):
        return plain if c not in "ℂℍℕℙℚℝℤℎℏ№" else c
    if tag == "<compat>":
        radical = "⺀" <= c <= "\u2fdf"
        return plain if radical or (kind[0] == "L" and c not in "µ№™℡℻") else c
    if not tag and kind[0] == "L" and c not in "Ω":
        return plain
    return c


def main_script(text: str) -> str:
    """The script of most letters: latin, cyrillic, greek or cjk; latin for a text without letters."""
    x = unicodedata.normalize("NFKC", text)
    n = {k: len(r.findall(x)) for k, r in _SCRIPTS.items()}
    n["cjk"] *= 2
    return max(n, key=lambda k: n[k])


def _word_plain(word: str, script: str, genuine: bool) -> str:
    """The member of the word's skeleton class that its script writes plainly; the word itself if there is none. genuine: foreign words beside it are meant so."""
    if _EXTRA_RE.search(word) and re.search("[A-Za-z]", word):
        word = word.translate(_EXTRA)
    plain = _reading(word, script, genuine)
    return plain if plain == word or skeleton(plain) == skeleton(word) else word


def _reading(word: str, script: str, genuine: bool) -> str:
    """word read in the script, if all that keeps it from it are look-alikes."""
    have = {k for k in ("latin", "cyrillic", "greek") if _SCRIPTS[k].search(word)}
    if len(have) == 1:
        kind = have.pop()
        if kind == script or genuine or script == "cjk" or kind == "latin" and script == "greek":
            return word
        table_ = _TO_LATIN if script == "latin" else _TO_CYRILLIC if kind == "latin" else _GREEK_TO_CYRILLIC
        letters = [c for c in word if c.isalpha()]
        if not all(ord(c) in table_ for c in letters) or (script == "latin" and not all(c in _STRONG for c in letters)):
            return word
        return word.translate(table_)
    if len(have) < 2:
        return word
    # A mixed word belongs to the script all its letters can be read in.
    latin = unicodedata.normalize("NFC", unicodedata.normalize("NFD", word).translate(_TO_LATIN))
    in_latin = not _SCRIPTS["cyrillic"].search(latin) and not _SCRIPTS["greek"].search(latin)
    if in_latin and (script != "cyrillic" or re.search("[DFGLNQRUVWZbdfghlmnqrtuvwz]", word)):
        return latin
    back = word.translate({**_TO_CYRILLIC, **_GREEK_TO_CYRILLIC})
    if not _SCRIPTS["latin"].search(back) and not _SCRIPTS["greek"].search(back):
        return back
    return latin if in_latin else word


def plain_form(text: str | None) -> str | None:
    """text in the one consistent form its own script is written in.

    Characters that show as nothing go; spaces of other kinds become a plain one; accents compose; forms of
    other width, ligatures and radicals become letters; look-alike letters become those of the word's script.
    Punctuation usual in the script, symbols and words of another script used in earnest, and joined emoji
    stay. Null stays null, an empty text empty.
    """
    if not text or not _SUSPECT_RE.search(text):
        return text
    script = main_script(text)
    x = _drop_hidden(text)

    def space(m: re.Match) -> str:
        i = m.start()
        if m[0] == "\u3000" and script == "cjk" and x[:i].rstrip("\u3000")[-1:] in ("", "\n"):
            return m[0]
        return " "

    y = _SPACES_RE.sub(space, x)
    y = _MARKED_RE.sub(lambda m: unicodedata.normalize("NFC", m[0]), y)
    y = _SIGN_RE.sub(lambda m: m[0].translate(_PROTOTYPE), y).translate(_RADICALS)

    def compat(m: re.Match) -> str:
        # Half-width kana and their sound marks are one letter.
        if script == "cjk" and "\uff66" <= m[0][:1] <= "\uff9f" and len(m[0]) > 1:
            return unicodedata.normalize("NFKC", m[0])
        out = []
        for i, ch in enumerate(m[0], m.start()):
            if _LETTER_FORMS.match(ch):
                # Numerals and enclosed letters by themselves are symbols; beside letters they are letters.
                near = y[max(0, i - 1) : i] + y[i + 1 : i + 2]
                out.append(unicodedata.normalize("NFKC", ch) if any(z.isalpha() and _SCRIPTS["latin"].match(z) or _LETTER_FORMS.match(z) and "\u24b6" <= ch for z in near) else ch)
                continue
            beside = any(_SCRIPTS["cjk"].match(z) and not "\uff00" < z < "\uff66" for z in y[max(0, i - 1) : i] + y[i + 1 : i + 2])
            out.append(_compat_plain(ch, script == "cjk", beside))
        return "".join(out)

    y = _COMPAT_RE.sub(compat, y)
    if not _LOOK_RE.search(y):
        return y
    spans = [(m.start(), m.end(), m[0]) for m in _WORD_RE.finditer(y)]
    other = []
    for _, _, w in spans:
        have = {k for k in ("latin", "cyrillic", "greek") if _SCRIPTS[k].search(w)}
        foreign = have.pop() if len(have) == 1 else script
        table_ = _TO_LATIN if foreign != "latin" else _TO_CYRILLIC
        other.append(foreign if foreign != script and len(w) > 1 and not all(ord(c) in table_ for c in w if c.isalpha()) else None)
    out, last = [], 0
    for n, (a, b, w) in enumerate(spans):
        near = {other[k] for k in (n - 1, n + 1) if 0 <= k < len(other) and (spans[n][0] - spans[k][1] <= 1 if k < n else spans[k][0] - spans[n][1] <= 1)}
        own = next((k for k in ("latin", "cyrillic", "greek") if _SCRIPTS[k].search(w)), script)
        out += [y[last:a], _word_plain(w, script, own in near)]
        last = b
    return "".join([*out, y[last:]])


def is_variant(text: str | None) -> bool:
    """Whether the text's skeleton class has a plain member that is another text."""
    if text is None or text.isascii():
        return False
    plain = plain_form(text)
    return plain != text and skeleton(plain) == skeleton(text)


@F.pandas_udf(T.BooleanType())
def _is_variant(text: pd.Series) -> pd.Series:
    return pd.Series([is_variant(t) for t in text], dtype="boolean")


@F.pandas_udf(T.StringType())
def plain_form_udf(text: pd.Series) -> pd.Series:
    return text.map(plain_form, na_action="ignore")


@F.pandas_udf(T.StringType())
def skeleton_udf(text: pd.Series) -> pd.Series:
    return text.map(skeleton, na_action="ignore")


def confusable_rows(docs: DataFrame, text: str) -> DataFrame:
    """The rows of docs whose text is not the plain member of its skeleton class; all columns stay.

    Null and empty texts are none. ASCII texts don't leave the JVM; of the others one pass over the whole text finds
    the suspect characters, and those that have some are analysed.
    """
    ship_package(docs.sparkSession)
    return docs.filter(F.octet_length(text) > F.length(text)).filter(_is_variant(F.col(text)))


def skeleton_groups(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class_id, class_size, plain): each row with the class of texts that look the same.

    class_id is the lowest key of the class, plain whether the row's text is its own plain form. Texts leave the map side as 128-bit hashes
    of their skeletons; sizes are counted with partial aggregation and joined back, so a class that holds
    a third of all rows is never in one task's memory. Null texts have no class.
    """
    sk = skeleton_udf(F.col(text))
    x = docs.filter(F.col(text).isNotNull()).select(F.col(key), sk.alias("sk"), (~_is_variant(F.col(text))).alias("plain"))
    x = x.select(key, F.xxhash64("sk").alias("h1"), F.xxhash64(F.lit(3), "sk").alias("h2"), "plain")
    sizes = x.groupBy("h1", "h2").agg(F.min(key).alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return x.join(sizes, ["h1", "h2"]).select(key, "class_id", "class_size", "plain")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusable_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id").distinct()


def p10_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skeleton_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's plain form as a hash, for comparison across tables."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(plain_form_udf("text"), 256).alias("plain_hash"))
