"""Timestamps from text: 15 fixed formats, mail dates, ISO dates, relative ones, with a status.

All take as_of in place of the wall clock. A missing text has as_of and "missing", an unparseable one
1970-01-01 and its status: use the value only with the status.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, squeeze, text

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_ZONES = {"ut": 0, "utc": 0, "gmt": 0, "z": 0, "ast": -240, "adt": -180, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420}
_DAYS = "(?:mon|tue|wed|thu|fri|sat|sun)"
_OFFSET = r"(z|[+-]\d{2}:?\d{2}(?::?\d{2})?)"
#: (pattern, groups in order): y m d h i s, b a month's name, z an offset or zone.
_FORMS = (
    (rf"^{_DAYS}, (\d{{1,2}}) ([a-z]{{3}}) (\d{{4}}) (\d{{1,2}}):(\d{{1,2}}):(\d{{1,2}}) {_OFFSET}$", "dbyhisz"),
    (rf"^{_DAYS}, (\d{{1,2}}) ([a-z]{{3}}) (\d{{4}}) (\d{{1,2}}):(\d{{1,2}}):(\d{{1,2}}) (utc|gmt)$", "dbyhisz"),
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})t(\d{{1,2}}):(\d{{1,2}}):(\d{{1,2}}){_OFFSET}$", "ymdhisz"),
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}}) (\d{{1,2}}):(\d{{1,2}}):(\d{{1,2}}) {_OFFSET}$", "ymdhisz"),
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}}) (\d{{1,2}}):(\d{{1,2}}) {_OFFSET}$", "ymdhiz"),
    (r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})$", "ymdhis"),
    (r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2})$", "ymdhi"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})$", "ymdhis"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2}) (\d{1,2}):(\d{1,2})$", "ymdhi"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "ymd"),
    (r"^(\d{4})年(\d{1,2})月(\d{1,2})日 (\d{1,2}):(\d{1,2}):(\d{1,2})$", "ymdhis"),
    (r"^(\d{4})年(\d{1,2})月(\d{1,2})日 (\d{1,2}):(\d{1,2})$", "ymdhi"),
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "ymd"),
    (r"^(\d{4})年(\d{1,2})月(\d{1,2})日$", "ymd"),
    # mail dates: the day's name and the seconds are optional, zones may be named
    (r"^(?:[a-z]+,? )?(\d{1,2})[ -]([a-z]{3})[a-z]*[ -](\d{4}) (\d{1,2}):(\d{1,2}):(\d{1,2})(?: ([a-z]+|[+-]\d{4}))?$", "dbyhisz"),
    (r"^(?:[a-z]+,? )?(\d{1,2})[ -]([a-z]{3})[a-z]*[ -](\d{4}) (\d{1,2}):(\d{1,2})(?: ([a-z]+|[+-]\d{4}))?$", "dbyhiz"),
    # ISO: any separator, fractions, compact dates
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}}).(\d{{2}}):?(\d{{2}}):?(\d{{2}}(?:[.,]\d+)?){_OFFSET}?$", "ymdhisz"),
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}}).(\d{{2}}):?(\d{{2}}){_OFFSET}?$", "ymdhiz"),
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}}).(\d{{2}}){_OFFSET}?$", "ymdhz"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:.(\d{{2}}):?(\d{{2}}):?(\d{{2}}(?:[.,]\d+)?){_OFFSET}?)?$", "ymdhisz"),
)
_RELATIVE_HINTS = ("ago", "小时前", "分钟前", "天前", "yesterday", "昨天", "刚刚", "刚才")


def _offset_minutes(zone: Column) -> Column:
    number = F.regexp_replace(zone, "[^0-9]", "")
    sign = F.when(F.startswith(zone, F.lit("-")), -1).otherwise(1)
    value = sign * (F.substring(number, 1, 2).try_cast("int") * 60 + F.substring(number, 3, 2).try_cast("int"))
    named = F.lit(0)
    for name, minutes in _ZONES.items():
        named = F.when(zone == name, minutes).otherwise(named)
    return F.when(zone.rlike("^[+-]"), value).otherwise(named)


def _matched(low: Column, pattern: str, groups: str) -> Column:
    part = {g: F.regexp_extract(low, pattern, i + 1) for i, g in enumerate(groups)}
    month = part["m"].try_cast("int") if "m" in part else F.nullif(F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), part["b"]), F.lit(0)).cast("int")
    number = lambda g: F.coalesce(part[g].try_cast("int"), F.lit(0)) if g in part else F.lit(0)
    seconds = F.coalesce(F.replace(part["s"], F.lit(","), F.lit(".")).try_cast("decimal(16,6)"), F.lit(0).cast("decimal(16,6)")) if "s" in part else F.lit(0).cast("decimal(16,6)")
    day = part["d"].try_cast("int")
    whole = F.call_function("try_make_timestamp", part["y"].try_cast("int"), month, day, number("h"), number("i"), seconds, F.lit("UTC"))
    if "z" in part:
        whole = whole - F.make_interval(mins=_offset_minutes(part["z"]))
    return F.when(low.rlike(pattern), whole)


def _week_date(low: Column) -> Column:
    pattern = r"^(\d{4})-?w(\d{2})(?:-?(\d))?$"
    first = F.date_trunc("week", F.call_function("try_make_timestamp", F.regexp_extract(low, pattern, 1).try_cast("int"), F.lit(1), F.lit(4), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"), F.lit("UTC")))
    days = (F.regexp_extract(low, pattern, 2).try_cast("int") - 1) * 7 + F.coalesce(F.regexp_extract(low, pattern, 3).try_cast("int"), F.lit(1)) - 1
    return F.when(low.rlike(pattern), first + F.make_interval(days=days))


def relative(c: Column | str, as_of: Column) -> Column:
    """A timestamp from "2 hours ago", "3天前", "yesterday", "just now" and the like; else null."""
    return let(squeeze(F.lower(text(c))), lambda low: _relative(low, as_of))


def _relative(low: Column, as_of: Column) -> Column:
    english, chinese = r"\b(\d{1,6})\s*(minutes|minute|min|hours|hour|hrs|hr|days|day)\s+ago\b", r"(\d{1,6})\s*(分钟|小时|天)前"

    def back(pattern: str, minute: str, hour: str) -> Column:
        n, unit = F.regexp_extract(low, pattern, 1).try_cast("int"), F.regexp_extract(low, pattern, 2)
        interval = F.when(F.startswith(unit, F.lit(minute)), F.make_dt_interval(mins=n)).when(F.startswith(unit, F.lit(hour)), F.make_dt_interval(hours=n)).otherwise(F.make_dt_interval(days=n))
        return F.when(low.rlike(pattern), as_of - interval)

    return F.coalesce(
        F.when(low.isin("just now", "刚刚", "刚才"), as_of), back(english, "min", "h"), back(chinese, "分钟", "小时"),
        F.when(low.rlike("^(yesterday|昨天)"), as_of - F.expr("INTERVAL 1 DAY")),
    )


def parse_datetime(c: Column | str, as_of: Column) -> Column:
    """struct(ts, status): ok, missing, unparseable_relative or unparseable_other. Text without a zone is UTC."""
    return let(squeeze(F.lower(text(c))), lambda low: _parsed(low, as_of))


def _parsed(low: Column, as_of: Column) -> Column:
    found = F.coalesce(*[_matched(low, *form) for form in _FORMS], _week_date(low), _relative(low, as_of))
    hinted = F.lit(False)
    for hint in _RELATIVE_HINTS:
        hinted = hinted | F.contains(low, F.lit(hint))
    return let(found, lambda value: _with_status(low, value, hinted, as_of))


def _with_status(low: Column, found: Column, hinted: Column, as_of: Column) -> Column:
    status = F.when(low == "", "missing").when(found.isNotNull(), "ok").when(hinted, "unparseable_relative").otherwise("unparseable_other")
    ts = F.when(low == "", as_of).otherwise(F.coalesce(found, F.timestamp_seconds(F.lit(0))))
    return F.struct(ts.alias("ts"), status.alias("status"))


def parse_in_region(c: Column | str, region: Column | str, as_of: Column) -> Column:
    """As parse_datetime, but a domestic text without an explicit offset is in UTC+8."""
    return let(parse_datetime(c, as_of), lambda parsed: _in_region(c, region, parsed))


def _in_region(c: Column | str, region: Column | str, parsed: Column) -> Column:
    explicit = text(c).rlike(r"(?i)(z|[+-]\d{2}:?\d{2})\s*$")
    shift = (F.lower(col(region)) == "domestic") & ~explicit & (parsed["status"] == "ok") & text(c).rlike(r"^\s*\d{4}")
    return F.struct(F.when(shift, parsed["ts"] - F.expr("INTERVAL 8 HOURS")).otherwise(parsed["ts"]).alias("ts"), parsed["status"].alias("status"))


def utc_iso(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def previous_day(run_date: str, zone: str = "Asia/Shanghai") -> tuple[Column, Column]:
    """[start, end) in UTC of the natural day before run_date in the zone."""
    end = F.to_timestamp(F.lit(run_date))
    return F.to_utc_timestamp(end - F.expr("INTERVAL 1 DAY"), zone), F.to_utc_timestamp(end, zone)


def in_window(ts: Column | str, run_date: str, zone: str = "Asia/Shanghai") -> Column:
    start, end = previous_day(run_date, zone)
    return (col(ts) >= start) & (col(ts) < end)


def is_recent(ts: Column | str, as_of: Column, days: int = 0, hours: int = 0) -> Column:
    return F.coalesce(col(ts) >= as_of - F.expr(f"INTERVAL {days * 24 + hours} HOURS"), F.lit(False))


def same_day(ts: Column | str, day: str, zone: str = "Asia/Shanghai") -> Column:
    return F.coalesce(F.to_date(F.from_utc_timestamp(col(ts), zone)) == F.lit(day).cast("date"), F.lit(False))


def date_in_text(c: Column | str) -> Column:
    """The first date-like part, by the order of patterns rather than of places; else empty."""
    patterns = (
        r"\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}(?::\d{2})?(?:Z|[+-]\d{2}:?\d{2})?", r"\d{4}年\d{1,2}月\d{1,2}日(?: ?\d{1,2}:\d{2}(?::\d{2})?)?",
        r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}(?: \d{1,2}:\d{2}(?::\d{2})?)?", r"(?i)(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]* \d{1,2}, \d{4}",
    )
    return F.coalesce(*[F.nullif(F.regexp_extract(text(c), p, 0), F.lit("")) for p in patterns], F.lit(""))
