"""Date texts of mixed form, precision and zone to one UTC instant.

Every text is read by a fixed list of forms. Each form is one regular expression whose groups are
rewritten to a canonical field list, so a value is matched once per form and never leaves the JVM.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks around a date text, day-part words, month names and zone abbreviations.
LABELS = ["发布时间", "发布日期", "更新时间", "时间", "日期", "Published on", "Published", "Posted on", "Posted", "Updated on", "Updated", "Date"]
AFTERNOON = ["下午", "晚上", "傍晚", "中午", "午后"]
DAY_PARTS = ["凌晨", "早上", "清晨", "上午", "中午", "午后", "下午", "傍晚", "晚上"]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "BST": 60, "CET": 60, "WEST": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "NPT": 345, "HKT": 480, "SGT": 480, "AWST": 480, "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "HST": -600,
}

SEP = "\u0001"
BLANK = r"[\s   -​    　﻿]"
TIME = (
    r"(?:(?:\s*[T,，]?\s*|\s+at\s+)(" + "|".join(DAY_PARTS) + r")?\s*(\d{1,2})(?:[:：点时])(\d{1,2})分?"
    r"(?:(?:[:：])?(\d{1,2})秒?(?:[.,](\d+))?)?\s*(AM|PM|am|pm|[ap]\.m\.)?)?"
)
ZONE = (
    r"\s*[（(\[]?\s*(Z|(?:UTC|GMT)?\s*[+-]\d{1,2}(?::?\d{2})?|[A-Z]{2,5}|[A-Z][A-Za-z]+(?:/[A-Za-z_+\-0-9]+){1,2})?\s*[）)\]]?$"
)
#: form name -> pattern and the places of year, month, day and of the first time group; month may be a name.
FORMS = {
    "year_first": (r"^(\d{4})\s*[-/.年]\s*(\d{1,2})(?:\s*[-/.月]\s*(\d{1,2})日?|月)?" + TIME + ZONE, ("$1", "$2", "$3"), 4),
    "compact": (r"^(\d{4})(\d{2})(\d{2})(?:T?()(\d{2})(\d{2})(?:(\d{2})(?:\.(\d+))?)?())?" + ZONE, ("$1", "$2", "$3"), 4),
    "numeric": (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})" + TIME + ZONE, ("$3", "$1", "$2"), 4),
    "day_name": (r"^(?:[A-Za-z]{3,9},\s*)?(\d{1,2})(?:st|nd|rd|th)?[\s-]+([A-Za-z]{3,9})\.?,?[\s-]+(\d{4})" + TIME + ZONE, ("$3", "$2", "$1"), 4),
    "name_day": (r"^(?:[A-Za-z]{3,9},\s*)?([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})" + TIME + ZONE, ("$3", "$1", "$2"), 4),
}
#: Digits of an epoch value -> its factor to microseconds, as multiplier and divisor.
EPOCH = {9: (1_000_000, 1), 10: (1_000_000, 1), 13: (1_000, 1), 16: (1, 1), 19: (1, 1_000)}


def _clean(text: Column) -> Column:
    """Full-width signs to ASCII, labels and outer blanks away."""
    wide = "".join(chr(0xFF01 + i) for i in range(94)) + "　 "
    thin = "".join(chr(0x21 + i) for i in range(94)) + "  "
    flat = F.regexp_replace(F.translate(text, wide, thin), f"^{BLANK}+|{BLANK}+$", "")
    return F.regexp_replace(flat, r"^(?:" + "|".join(LABELS) + r")\s*[:]?\s+|^(?:" + "|".join(LABELS) + r")\s*[:]\s*", "")


def parse_fields(text: Column) -> Column:
    """The fields of a date text as array: form, year, month, day, day part, hour, minute, second, fraction, AM/PM, zone.

    Null where no form fits. A text that starts with the words for Beijing time carries Asia/Shanghai.
    """
    clean = _clean(text)
    beijing = clean.startswith("北京时间")
    body = F.regexp_replace(clean, r"^北京时间\s*[:]?\s*", "")
    forms = []
    for name, (pattern, (y, m, d), at) in FORMS.items():
        groups = SEP.join([name, y, m, d, *(f"${i}" for i in range(at, at + 7))])
        forms.append(F.when(body.rlike(pattern), F.regexp_replace(body, pattern, groups)))
    digits = F.length(body)
    plain = body.rlike(r"^\d+$")
    epoch = F.when(plain & digits.isin(*EPOCH), F.concat(F.lit("epoch" + SEP), body, F.lit(SEP * 9)))
    fields = F.split(F.coalesce(epoch, *forms), SEP, -1)
    return F.when(
        fields.isNotNull(),
        F.when(beijing & (fields[10] == ""), F.concat(F.slice(fields, 1, 10), F.array(F.lit("Asia/Shanghai")))).otherwise(fields),
    )


def _int(c: Column) -> Column:
    return c.try_cast("int")


def local_parts(df: DataFrame, text: str, order: str) -> DataFrame:
    """Adds _epoch_us, _local (timestamp without zone), _offset_min and _region to df for the texts in a column.

    order holds ymd, mdy or dmy for all-numeric texts that do not start with the year; where it is null,
    the only reading that is a date is taken, and month first if both are.
    """
    f = F.col("_fields")
    df = df.withColumn("_fields", parse_fields(F.col(text)))
    month_name = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(F.lower(f[2]), 1, 3)).cast("int")
    a, b = _int(f[2]), _int(f[3])
    day_first = F.when(F.col(order) == "dmy", True).when(F.col(order).isin("mdy", "ymd"), F.lit(False)).otherwise((a > 12) & (b <= 12))
    form = f[0]
    named = form.isin("day_name", "name_day")
    month = F.when(named, F.nullif(month_name, F.lit(0))).when((form == "numeric") & day_first, b).otherwise(a)
    day = F.when((form == "numeric") & day_first, a).when(f[3] == "", 1).otherwise(b)
    hour, part, half = _int(f[5]), f[4], F.upper(F.substring(f[9], 1, 1))
    hour = (
        F.when((half == "A") & (hour == 12), 0)
        .when((half == "P") & (hour < 12), hour + 12)
        .when((part == "凌晨") & (hour == 12), 0)
        .when((part == "中午") & (hour <= 3), hour + 12)
        .when(part.isin(*[p for p in AFTERNOON if p != "中午"]) & (hour < 12), hour + 12)
        .otherwise(hour)
    )
    second = F.concat(F.when(f[7] == "", "0").otherwise(f[7]), F.lit("."), F.rpad(F.substring(f[8], 1, 6), 6, "0")).try_cast("decimal(16,6)")
    clock = F.coalesce(hour, F.lit(0)), F.when(f[6] == "", 0).otherwise(_int(f[6])), second
    fine = (clock[0] < 24) & (clock[1] < 60) & (clock[2] < 60)
    local = F.when(fine, F.try_make_timestamp_ntz(_int(f[1]), month, day, *clock))
    zone = f[10]
    sign = F.regexp_extract(zone, r"([+-])", 1)
    hours, minutes = _int(F.regexp_extract(zone, r"[+-](\d{1,2})", 1)), F.regexp_extract(zone, r"[+-]\d{1,2}:?(\d{2})", 1)
    numeric = (hours * 60 + F.when(minutes == "", 0).otherwise(_int(minutes))) * F.when(sign == "-", -1).otherwise(1)
    short = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    offset = F.when(zone.rlike(r"^(?:UTC|GMT)?\s*[+-]\d"), numeric).otherwise(F.element_at(short, zone))
    region = F.when(zone.isin(*sorted(z for z in zoneinfo.available_timezones() if "/" in z)), zone)
    digits = f[1].try_cast("decimal(20,0)")
    epoch = F.coalesce(*[F.when(F.length(f[1]) == n, F.floor(digits * F.lit(m) / F.lit(d))) for n, (m, d) in EPOCH.items()]).cast("bigint")
    epoch = F.when(form == "epoch", epoch)
    # a zone text that is neither an offset, an abbreviation nor a region makes the value unreadable
    known = (zone == "") | offset.isNotNull() | region.isNotNull()
    return df.withColumns(
        {"_epoch_us": epoch, "_local": F.when((form != "epoch") & known, local), "_offset_min": offset, "_region": region}
    ).drop("_fields")


def micros(ntz: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz)


def to_utc_us(zone: Column) -> Column:
    """UTC microseconds for rows of local_parts.

    A zone in the text wins over zone. A clock time that occurs twice is the earlier one; a skipped one
    is read with the offset before the change (both are java.time's rule for local times).
    """
    region = F.coalesce(F.col("_region"), zone)
    regional = micros(F.call_function("convert_timezone", region, F.lit("UTC"), F.col("_local")))
    return F.coalesce(F.col("_epoch_us"), F.when(F.col("_offset_min").isNotNull(), micros(F.col("_local")) - F.col("_offset_min").cast("bigint") * F.lit(60_000_000)).otherwise(regional))


def estimate_zones(rows: DataFrame, group: list[str], seen_at: str, zones: list[str]) -> DataFrame:
    """The zone of each group whose local times fit the times of ingestion best.

    rows holds _local and seen_at (UTC, without zone). For each group and candidate zone, whose whole
    offset history is used, a violation is a row whose instant lies after it was seen; the zone with the
    fewest violations wins, then the one with the least total lag, then the first by name. Groups without
    a usable row have no result. Cost: rows times candidates, summed before the shuffle.
    """
    utc = micros(F.call_function("convert_timezone", F.col("_zone"), F.lit("UTC"), F.col("_local")))
    lag = micros(F.col(seen_at).cast("timestamp_ntz")) - utc
    zone_of = F.when(F.col("_offset_min").isNull() & F.col("_region").isNull(), F.array(*[F.lit(z) for z in zones]))
    scored = (
        rows.withColumn("_zone", F.explode(zone_of))
        .groupBy(*group, "_zone")
        .agg(F.sum((lag < 0).cast("long")).alias("_bad"), F.sum(F.abs(lag).cast("decimal(38,0)")).alias("_lag"))
        .where("_bad is not null")
    )
    return scored.groupBy(*group).agg(F.min_by("_zone", F.struct("_bad", "_lag", "_zone")).alias("_estimated_zone"))


def normalise(
    df: DataFrame, text: str, zone: str, order: str, group: list[str] | None = None, seen_at: str | None = None, zones: list[str] | None = None
) -> DataFrame:
    """Adds utc_us to df; null where the text denotes no existing date, or no zone is known or can be estimated.

    Null, blank and unreadable texts give null; repeated rows each get their value; extra columns stay
    (helper columns start with an underscore). With group, seen_at and zones, rows whose zone is
    neither in the text nor in the zone column take the zone estimated for their group.
    """
    parts = local_parts(df, text, order)
    if group:
        guess = estimate_zones(local_parts(df.where(F.col(zone).isNull()), text, order), group, seen_at, zones)
        keyed = [F.col(f"_g.{g}").eqNullSafe(F.col(f"_p.{g}")) for g in group]
        guess = guess.select(*[F.col(g) for g in group], "_estimated_zone")
        parts = parts.alias("_p").join(guess.alias("_g"), keyed, "left").select("_p.*", "_g._estimated_zone")
        parts = parts.withColumn("utc_us", to_utc_us(F.coalesce(F.col(zone), F.col("_estimated_zone")))).drop("_estimated_zone")
    else:
        parts = parts.withColumn("utc_us", to_utc_us(F.col(zone)))
    return parts.drop("_epoch_us", "_local", "_offset_min", "_region")
