"""Mixed timestamp formats and zones brought to one form.

A value is parsed to an instant, a day, or a local time. Local times get their offset by an as-of
join to zone-offset intervals, exploded to (zone, local year): one matching interval gives the
offset, two mean the time occurs twice, none means it never occurs.
"""

from __future__ import annotations

import datetime as dt
import functools
import re
import unicodedata
from zoneinfo import ZoneInfo, available_timezones

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import bounded_broadcast, first_rows, ship_package, table

#: Years whose zone intervals are exploded and joined; local times beyond are settled as they are parsed.
FIRST_YEAR, LAST_YEAR = 1950, 2100

# Month names and their usual short forms by language.
MONTH_NAMES = {
    "en": "january february march april may june july august september october november december",
    "en3": "jan feb mar apr may jun jul aug sep oct nov dec",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "de3": "jan feb mär apr mai jun jul aug sep okt nov dez",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "ru": "января февраля марта апреля мая июня июля августа сентября октября ноября декабря",
}
# Minutes east of Greenwich of zone letters, for sources whose own zone doesn't use them.
ZONE_LETTERS = {
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "CET": 60, "CEST": 120, "WET": 0, "WEST": 60, "EET": 120, "EEST": 180, "BST": 60, "MSK": 180,
    "JST": 540, "KST": 540, "HKT": 480, "SGT": 480, "IST": 330, "AEST": 600, "AEDT": 660, "BRT": -180,
}



def _plain(text: str) -> str:
    """text in lower case without accents, white space collapsed."""
    x = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).lower())
    return " ".join("".join(c for c in x if not unicodedata.combining(c)).split())


_MONTH = {_plain(n): i % 12 + 1 for names in MONTH_NAMES.values() for i, n in enumerate(names.split())}
_MONTH["sept"] = 9
_TIME = r"(?P<H>\d{1,2})[:h時时](?P<M>\d{2})(?:[:分](?P<S>\d{2}))?分?(?:[.,](?P<F>\d+))?"
_ZONE = r"\s*(?P<z>z|[+-]\d{2}:?\d{2}|[+-]\d{2}|[a-z]{2,5})?"
_ISO = re.compile(rf"(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})(?:(?:t|\s+|\s*,\s*){_TIME}{_ZONE})?")
_BASIC = re.compile(r"(\d{4})(\d{2})(\d{2})(?:t(?P<H>\d{2})(?P<M>\d{2})(?P<S>\d{2})?(?:[.,](?P<F>\d+))?" + _ZONE + ")?")
_WEEK = re.compile(r"(\d{4})-?w(\d{2})-?([1-7])")
_DIGITS = re.compile(rf"(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}|\d{{2}})(?:(?:\s*,\s*|\s+|t){_TIME}\s*(?P<ap>am|pm)?{_ZONE})?")
_CJK = re.compile(r"(\d{4})年(\d{1,2})月(\d{1,2})[日号](?:\s*(?P<ap>上午|下午|午前|午後)?\s*" + _TIME + _ZONE + ")?")
_WORDS = re.compile(
    r"(?:[^\W\d_]+\.?,\s*)?(?:(?P<d1>\d{1,2})(?:st|nd|rd|th|er)?\.?[\s-]+(?:de\s+)?(?P<m1>[^\W\d_]+)\.?,?[\s-]+(?:de\s+|del\s+)?(?P<y1>\d{4}|\d{2})(?:\s*г\.?)?"
    r"|(?P<m2>[^\W\d_]+)\.?\s+(?P<d2>\d{1,2})(?:st|nd|rd|th)?,?\s+(?P<y2>\d{4}))"
    rf"(?:(?:\s*,\s*|\s+)(?:(?:a|as|um|at|в)\s+)?{_TIME}(?:\s*uhr)?\s*(?P<ap>am|pm|a\.m\.|p\.m\.)?{_ZONE})?"
)
_CANON = re.compile(r"\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}Z)?", re.ASCII)

PARSED = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("secs", T.LongType()),
    T.StructField("letters", T.StringType()), T.StructField("year", T.IntegerType()),
])
_EPOCH = dt.datetime(1970, 1, 1)


def parse_timestamp(value: str | None, date_order: str | None) -> tuple[str | None, int | None, str | None, int | None]:
    """(kind, seconds, zone letters, local year) of one value as received.

    kind 'instant': seconds since 1970 in UTC; 'day': midnight of the day named; 'local': wall clock
    read as if it were UTC; None: null, impossible, relative or vague.
    """
    nothing = (None, None, None, None)
    if value is None:
        return nothing
    s = _plain(value)
    if s.isdigit() and s.isascii() and len(s) in (10, 13, 16):
        return ("instant", int(s) // {10: 1, 13: 1000, 16: 1_000_000}[len(s)], None, None)
    g: dict[str, str | None] = {}
    try:
        if m := _ISO.fullmatch(s) or _BASIC.fullmatch(s) or _CJK.fullmatch(s):
            g = m.groupdict()
            parts = [x for i, x in enumerate(m.groups(), 1) if m.re is not _ISO or i != 2][:3]
            y, mo, d = map(int, parts)
        elif m := _WEEK.fullmatch(s):
            day = dt.date.fromisocalendar(int(m[1]), int(m[2]), int(m[3]))
            y, mo, d = day.year, day.month, day.day
        elif m := _DIGITS.fullmatch(s):
            g = m.groupdict()
            a, b, c = int(m[1]), int(m[3]), int(m[4])
            if len(m[4]) == 2 and date_order == "ymd":
                y, mo, d = a, b, c
            elif date_order == "mdy" and m[2] != ".":
                y, mo, d = c, a, b
            elif date_order in ("dmy", "mdy", "ymd"):
                y, mo, d = (c, a, b) if date_order == "ymd" and b > 12 else (c, b, a)
            else:
                return nothing
            y += 2000 if y < 70 else 1900 if y < 100 else 0
        elif m := _WORDS.fullmatch(s):
            g = m.groupdict()
            name = (g["m1"] or g["m2"]).rstrip(".")
            if name not in _MONTH:
                return nothing
            mo, y, d = _MONTH[name], int(g["y1"] or g["y2"]), int(g["d1"] or g["d2"])
            y += 2000 if y < 70 else 1900 if y < 100 else 0
        else:
            return nothing
        at = dt.datetime(y, mo, d)
        if g.get("H") is None:
            return ("day", int((at - _EPOCH).total_seconds()), None, y)
        h, mi, sec = int(g["H"]), int(g["M"]), int(g["S"] or 0)
        ap = (g.get("ap") or "").replace(".", "")
        if ap:
            if not 1 <= h <= 12:
                if not (h <= 23 and ap in ("pm", "下午", "午後") or h == 0):
                    return nothing
            else:
                h = h % 12 + (12 if ap in ("pm", "下午", "午後") else 0)
        if (h, mi, sec) == (24, 0, 0):
            at, h = at + dt.timedelta(days=1), 0
        if h > 23 or mi > 59 or sec > 60:
            return nothing
        secs = int((at - _EPOCH).total_seconds()) + h * 3600 + mi * 60 + sec
        zone = (g.get("z") or "").upper()
        if not zone:
            return ("local", secs, None, at.year)
        if zone in ("Z", "UTC", "GMT", "UT"):
            return ("instant", secs, None, None)
        if zone[0] in "+-":
            digits = zone[1:].replace(":", "").ljust(4, "0")
            off = int(digits[:2]) * 60 + int(digits[2:])
            if off > 18 * 60 or int(digits[2:]) > 59:
                return nothing
            return ("instant", secs - 60 * (off if zone[0] == "+" else -off), None, None)
        return ("local", secs, zone, at.year)
    except (ValueError, OverflowError):
        return nothing


def far_instant(zone: str | None, secs: int, letters: str | None) -> tuple[str, int | None]:
    """('instant', seconds) of a local time of any year, or why it has none: ambiguous, nonexistent or local (no such zone or letters)."""
    try:
        tz = ZoneInfo(zone or "")
        clock = _EPOCH + dt.timedelta(seconds=secs)
        found = set()
        for fold in (0, 1):
            at = clock.replace(tzinfo=tz, fold=fold)
            utc = (clock - at.utcoffset()).replace(tzinfo=dt.timezone.utc)
            if utc.astimezone(tz).replace(tzinfo=None) == clock and letters in (None, (at.tzname() or "").upper()):
                found.add(int(at.utcoffset().total_seconds()))
    except Exception:
        return ("local", secs)
    if len(found) == 1:
        return ("instant", secs - found.pop())
    return ("local", secs) if letters else ("ambiguous" if found else "nonexistent", None)


@F.pandas_udf(PARSED)
def _parse(value: pd.Series, date_order: pd.Series, zone: pd.Series) -> pd.DataFrame:
    rows = [parse_timestamp(v if isinstance(v, str) else None, o) for v, o in zip(value, date_order, strict=True)]
    for i, (kind, secs, letters, year) in enumerate(rows):
        if kind == "local" and not FIRST_YEAR < year < LAST_YEAR:
            rows[i] = (*far_instant(zone.iloc[i], secs, letters), letters, year)
    out = pd.DataFrame(rows, columns=[f.name for f in PARSED])
    return out.astype({"secs": "Int64", "year": "Int32"})


@functools.lru_cache(maxsize=1024)
def zone_intervals(zone: str) -> tuple[tuple[int, int, int, str], ...]:
    """(start, end, offset, letters) of each interval of one offset in a zone, in UTC seconds; () for an unknown zone."""
    try:
        tz = ZoneInfo(zone)
    except Exception:
        return ()
    utc = dt.timezone.utc

    def at(t: int) -> tuple[int, str]:
        x = dt.datetime.fromtimestamp(t, utc).astimezone(tz)
        return int(x.utcoffset().total_seconds()), x.tzname() or ""

    step = 5 * 86400
    t, end = int(dt.datetime(FIRST_YEAR, 1, 1, tzinfo=utc).timestamp()), int(dt.datetime(LAST_YEAR, 1, 1, tzinfo=utc).timestamp())
    start, now, out = t, at(t), []
    while t < end:
        nxt = at(t + step)
        if nxt != now:
            lo, hi = t, t + step
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if at(mid) == now else (lo, mid)
            out.append((start, hi, *now))
            start, now = hi, at(hi)
            t = hi
        else:
            t += step
    out.append((start, end, *now))
    return tuple(out)


def offset_table(spark: SparkSession, zones: list[str]) -> DataFrame:
    """(zone, year, local_start, local_end, utc_offset, letters): intervals by each local year they touch."""
    rows = []
    for z in zones:
        for a, b, off, letters in zone_intervals(z):
            for y in range((_EPOCH + dt.timedelta(seconds=a + off)).year, (_EPOCH + dt.timedelta(seconds=b + off - 1)).year + 1):
                rows.append((z, y, a + off, b + off, off, letters.upper()))
    return spark.createDataFrame(rows, "zone string, year int, local_start long, local_end long, utc_offset int, letters string")


def _named_zones(zones: DataFrame) -> list[str]:
    """The distinct names of zones of the sources that there are: some 600 at most, however many others are named."""
    return [r[0] for r in zones.select("zone").filter(F.col("zone").isin(*available_timezones())).distinct().collect()]


def normalize_timestamps(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Give each record (key, source, value) its canonical form.

    sources has (source, zone, date_order). Result: the columns of records with canonical (null where the
    value means no single instant or day) and reason (ok, unreadable, ambiguous, nonexistent, no_zone).
    Null, empty and vague values are 'unreadable'. Other columns of records are kept; repeated rows stay.
    A source that is missing from sources has no zone and no date order.
    """
    spark = records.sparkSession
    ship_package(spark)
    src = bounded_broadcast(sources.select(F.col("source").alias("_src"), F.col("zone").alias("_zone"), F.col("date_order").alias("_order")).dropDuplicates(["_src"]))
    zones = offset_table(spark, _named_zones(sources))
    x = records.join(src, records["source"] == F.col("_src"), "left").withColumn("_p", _parse("value", "_order", "_zone"))
    x = x.select("*", *[F.col(f"_p.{f.name}").alias(f"_{f.name}") for f in PARSED]).drop("_p", "_src", "_order")
    # The interval table has zones x years rows with one list of intervals each: the join keeps one row per record.
    grouped = zones.groupBy(F.col("zone").alias("z_zone"), F.col("year").alias("z_year")).agg(
        F.collect_list(F.struct("local_start", "local_end", "utc_offset", "letters")).alias("_iv")
    )
    letters = zones.groupBy(F.col("zone").alias("l_zone"), F.col("letters").alias("l_letters")).agg(F.max_by("utc_offset", "local_end").alias("_l_off"))
    fixed = F.create_map(*[F.lit(v) for k, m in ZONE_LETTERS.items() for v in (k, m * 60)])
    local = F.col("_kind") == "local"
    x = x.join(F.broadcast(grouped), local & (F.col("_zone") == F.col("z_zone")) & (F.col("_year") == F.col("z_year")), "left")
    x = x.join(F.broadcast(letters), local & (F.col("_zone") == F.col("l_zone")) & (F.col("_letters") == F.col("l_letters")), "left")
    hit = F.filter(
        F.coalesce("_iv", F.array().cast("array<struct<local_start:bigint,local_end:bigint,utc_offset:int,letters:string>>")),
        lambda i: (i["local_start"] <= F.col("_secs")) & (F.col("_secs") < i["local_end"]) & (F.col("_letters").isNull() | (i["letters"] == F.col("_letters"))),
    )
    x = x.withColumn("_off", F.array_distinct(F.transform(hit, lambda i: i["utc_offset"])))
    by_letters = F.coalesce(F.when(F.size("_off") == 1, F.col("_off")[0]), F.col("_l_off"), fixed[F.col("_letters")])
    offset = F.when(F.col("_letters").isNotNull(), by_letters).when(F.size("_off") == 1, F.col("_off")[0])
    utc = F.when(F.col("_kind") == "instant", F.col("_secs")).when(local, F.col("_secs") - offset)
    reason = (
        F.when(F.col("_kind").isNull(), "unreadable")
        .when(F.col("_kind").isin("ambiguous", "nonexistent"), F.col("_kind"))
        .when(F.col("_kind").isin("instant", "day"), "ok")
        .when(offset.isNotNull(), "ok")
        .when(F.col("_zone").isNull() | F.col("_iv").isNull() | F.col("_letters").isNotNull(), "no_zone")
        .when(F.size("_off") > 1, "ambiguous")
        .otherwise("nonexistent")
    )
    canonical = F.when(F.col("_kind") == "day", _day(F.col("_secs"))).otherwise(_instant(utc))
    return x.withColumn("canonical", canonical).withColumn("reason", reason).select(*records.columns, "canonical", "reason")


def _day(secs: Column) -> Column:
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(secs / 86400).cast("int")), "yyyy-MM-dd")


def _instant(secs: Column) -> Column:
    """Seconds since 1970 as YYYY-MM-DDTHH:MM:SSZ, whatever the session's zone is."""
    rest = F.pmod(secs, F.lit(86400))
    return F.concat(
        _day(secs), F.lit("T"), F.lpad(F.floor(rest / 3600).cast("string"), 2, "0"), F.lit(":"),
        F.lpad(F.floor(F.pmod(rest, F.lit(3600)) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.pmod(rest, F.lit(60)).cast("string"), 2, "0"), F.lit("Z"),
    )


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_table, item_id, source, value): one row per record, by its first delivery."""
    parts = []
    for name, key, source, value in (
        ("raw_signal", "signal_id", "source_id", "published_at"),
        ("candidate_item", "item_id", "source", "published"),
        ("filing_candidate", "filing_key", "source_id", "filing_date"),
    ):
        rows = first_rows(table(spark, sf_dir, name), key, "ingest_seq", source, value)
        parts.append(rows.select(F.lit(name).alias("item_table"), F.col(key).alias("item_id"), F.col(source).alias("source"), F.col(value).alias("value")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p4_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "inventory_source").select(F.col("source_id").alias("source"), F.col("time_zone").alias("zone"), "date_order")
    return normalize_timestamps(p4_records(spark, sf_dir), src)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = p4_normalized(spark, sf_dir)
    return x.filter(F.col("canonical").isNotNull() & (F.col("canonical") != F.col("value"))).select("item_table", "item_id", "canonical")
