import datetime as dt

import pytest

from ledgerloom.operators.timestamps import normalise

CASES = [
    ("2024-03-05", "Asia/Shanghai", "ymd", "2024-03-04 16:00:00"),
    ("2024-03", "UTC", "ymd", "2024-03-01 00:00:00"),
    ("2024年3月5日下午4点07分", "UTC", "ymd", "2024-03-05 16:07:00"),
    ("2022年7月11日凌晨12点52分", "UTC", "ymd", "2022-07-11 00:52:00"),
    ("２０２３－０３－３１ １２：４３", "Asia/Tokyo", "ymd", "2023-03-31 03:43:00"),
    ("\t20240831155027 ", "UTC", "ymd", "2024-08-31 15:50:27"),
    ("1690423842071", None, None, "2023-07-27 02:10:42.071"),
    ("2024-11-29T20:23:28.5586997Z", None, None, "2024-11-29 20:23:28.558699"),
    ("04.02.2024 12:29", "Europe/Berlin", "dmy", "2024-02-04 11:29:00"),
    ("04/02/2024 6:17 PM", "America/New_York", "mdy", "2024-04-02 22:17:00"),
    ("Sat, 18 Jan 2025 16:23:43 +0100", "Asia/Tokyo", "ymd", "2025-01-18 15:23:43"),
    ("May 26, 2026 4:33 PM EDT", None, None, "2026-05-26 20:33:00"),
    ("2025-12-12 01:00 Asia/Kathmandu", "UTC", "ymd", "2025-12-11 19:15:00"),
    ("北京时间2024年3月9日1:29", "Europe/Berlin", "dmy", "2024-03-08 17:29:00"),
    ("发布时间：2024-05-22 23:59", "Asia/Shanghai", "ymd", "2024-05-22 15:59:00"),
    ("2024-11-03 01:30", "America/New_York", "mdy", "2024-11-03 05:30:00"),  # twice: the earlier one
    ("2024-03-10 02:30", "America/New_York", "mdy", "2024-03-10 07:30:00"),  # skipped: offset before
    ("2025-02-30", "UTC", "ymd", None),
    ("2024-13-05", "UTC", "ymd", None),
    ("0000-00-00 00:00:00", "UTC", "ymd", None),
    ("TBD", "UTC", "ymd", None),
    ("", "UTC", "ymd", None),
    (None, "UTC", "ymd", None),
    ("2024-01-01 10:00 Nowhere/Land", "UTC", "ymd", None),
]


def test_forms(spark):
    rows = [(i, t, z, o) for i, (t, z, o, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, text string, zone string, ord string")
    got = {r.i: r.utc_us for r in normalise(df, "text", "zone", "ord").collect()}
    for i, (text, _, _, want) in enumerate(CASES):
        us = None if want is None else int(dt.datetime.fromisoformat(want).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6 + 0.5)
        assert got[i] == us, text


def test_missing_zone_is_estimated(spark):
    seen = dt.datetime(2024, 5, 1, 4, 1)
    rows = [("m", f"2024-05-01 {12 - i:02d}:00", None, None, seen - dt.timedelta(hours=i)) for i in range(4)]
    df = spark.createDataFrame(rows, "media string, text string, zone string, ord string, seen timestamp_ntz")
    out = normalise(df, "text", "zone", "ord", ["media"], "seen", ["UTC", "Asia/Shanghai", "America/New_York"]).collect()
    assert {r.utc_us for r in out} == {int((dt.datetime(2024, 5, 1, 4 - i) - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) for i in range(4)}


@pytest.mark.parametrize("extra", ["utc", "form"])
def test_empty_and_extra_columns(spark, extra):
    df = spark.createDataFrame([], f"text string, zone string, ord string, {extra} string")
    assert normalise(df, "text", "zone", "ord").columns == ["text", "zone", "ord", extra, "utc_us"]
    assert normalise(df, "text", "zone", "ord").count() == 0


def test_zones_are_those_the_tables_name(spark):
    from ledgerloom.plans.general import candidate_zones

    df = spark.createDataFrame([("Africa/Cairo",), ("Africa/Cairo",), (None,), ("Nowhere/Land",), ("",)], "zone string")
    assert candidate_zones(df, df.where("false")) == ["Africa/Cairo", "UTC"]
