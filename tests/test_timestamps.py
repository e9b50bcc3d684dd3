from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from veldspar.operators import timestamps as ts

SOURCES = [("ny", "America/New_York", "mdy"), ("sh", "Asia/Shanghai", "ymd"), ("be", "Europe/Berlin", "dmy"), ("no", None, None), ("bad", "Mars/Base", "dmy")]

CASES = [
    ("be", "2024-03-31 02:30", None, "nonexistent"), ("be", "2024-10-27 02:30", None, "ambiguous"), ("be", "2024-10-27 02:30:00 CET", "2024-10-27T01:30:00Z", "ok"),
    ("be", "2024-10-27 02:30:00 CEST", "2024-10-27T00:30:00Z", "ok"), ("ny", "03/04/2024 10:00", "2024-03-04T15:00:00Z", "ok"), ("be", "03/04/2024 10:00", "2024-04-03T08:00:00Z", "ok"),
    ("sh", "Mon, 06 Jan 2025 10:00:00 CST", "2025-01-06T02:00:00Z", "ok"), ("ny", "1700000000", "2023-11-14T22:13:20Z", "ok"), ("ny", "1700000000123", "2023-11-14T22:13:20Z", "ok"),
    ("ny", "1700000000123456", "2023-11-14T22:13:20Z", "ok"), ("ny", "20240229", "2024-02-29", "ok"), ("ny", "20230229", None, "unreadable"), ("ny", "2024-W09-5", "2024-03-01", "ok"),
    ("sh", "2024年3月9日 下午12:42", "2024-03-09T04:42:00Z", "ok"), ("sh", "2024年3月9日 上午12:01", "2024-03-08T16:01:00Z", "ok"), ("be", "4. März 2024, 10:51 Uhr", "2024-03-04T09:51:00Z", "ok"),
    ("be", "27 août 2024 à 21h37", "2024-08-27T19:37:00Z", "ok"), ("ny", "　2024-01-02t03:04:05z\n", "2024-01-02T03:04:05Z", "ok"), ("ny", "21-Jan-23", "2023-01-21", "ok"),
    ("ny", "", None, "unreadable"), ("ny", None, None, "unreadable"), ("ny", "yesterday", None, "unreadable"), ("ny", "2023-11-08 25:10", None, "unreadable"), ("ny", "2024", None, "unreadable"),
    ("no", "2024-01-02 10:00", None, "no_zone"), ("bad", "2024-01-02 10:00", None, "no_zone"), ("missing", "2024-01-02 10:00+02:00", "2024-01-02T08:00:00Z", "ok"), ("ny", "9" * 10_000, None, "unreadable"),
]


def test_values_of_each_kind(spark):
    src = spark.createDataFrame(SOURCES, "source string, zone string, date_order string")
    df = spark.createDataFrame([(i, s, v, "x") for i, (s, v, _, _) in enumerate(CASES)], "i int, source string, value string, zone string")
    got = {r["i"]: (r["canonical"], r["reason"]) for r in ts.normalize_timestamps(df, src).collect()}
    for i, (s, v, want, reason) in enumerate(CASES):
        assert got[i] == (want, reason), (s, v)
    assert ts.normalize_timestamps(df.limit(0), src).count() == 0


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "Australia/Sydney", "Asia/Kolkata"])
def test_offsets_equal_a_search_by_brute_force(spark, zone):
    tz = ZoneInfo(zone)
    base = datetime(2024, 1, 1, 0, 30)
    values = [base + timedelta(hours=7 * i) for i in range(1250)]
    src = spark.createDataFrame([("s", zone, "ymd")], "source string, zone string, date_order string")
    df = spark.createDataFrame([(i, "s", v.strftime("%Y-%m-%d %H:%M")) for i, v in enumerate(values)], "i int, source string, value string")
    got = {r["i"]: r["canonical"] for r in ts.normalize_timestamps(df, src).collect()}
    for i, v in enumerate(values):
        hits = {u for f in (0, 1) if (u := v.replace(tzinfo=tz, fold=f).astimezone(timezone.utc)).astimezone(tz).replace(tzinfo=None) == v}
        assert got[i] == (next(iter(hits)).strftime("%Y-%m-%dT%H:%M:%SZ") if len(hits) == 1 else None)


def test_extra_columns_and_repeats_stay(spark):
    src = spark.createDataFrame(SOURCES, "source string, zone string, date_order string")
    df = spark.createDataFrame([("be", "2024-01-01", 1, "c"), ("be", "2024-01-01", 1, "c")], "source string, value string, offset int, letters string")
    out = ts.normalize_timestamps(df, src)
    assert out.columns == ["source", "value", "offset", "letters", "canonical", "reason"] and out.count() == 2


def test_years_beyond_the_joined_intervals(spark):
    src = spark.createDataFrame([*SOURCES, *((f"z{i}", f"No/Zone{i}", "dmy") for i in range(3000))], "source string, zone string, date_order string")
    cases = [
        ("be", "14 May 1920", "1920-05-14"), ("be", "2150-02-03", "2150-02-03"), ("be", "1920-05-14 12:00", "1920-05-14T11:00:00Z"), ("ny", "2150-07-01 12:00", "2150-07-01T16:00:00Z"), ("be", "2150-01-01 12:00 CET", "2150-01-01T11:00:00Z"),
        ("ny", "2024-07-01 12:00", "2024-07-01T16:00:00Z"), ("z7", "2150-01-01 12:00", None), ("z7", "2024-01-01 12:00", None), ("no", "1920-01-01 12:00", None), ("be", "0000-01-01", None),
    ]
    df = spark.createDataFrame([(i, s, v) for i, (s, v, _) in enumerate(cases)], "i int, source string, value string")
    got = {r["i"]: r["canonical"] for r in ts.normalize_timestamps(df, src).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]
    zone, clock = "Europe/Berlin", datetime(2150, 3, 29, 2, 30)
    while ts.far_instant(zone, int((clock - datetime(1970, 1, 1)).total_seconds()), None)[0] != "nonexistent":
        clock += timedelta(days=1)
        assert clock.year == 2150 and clock.month < 5
