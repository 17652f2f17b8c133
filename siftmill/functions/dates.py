"""Eastern-time calendar: dates, months, the four uneven slots of a day."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE, SLOTS = "America/New_York", (6, 10, 14, 18)


def eastern(ts: Column) -> Column:
    """Wall time in the zone, for an instant held in UTC."""
    return F.from_utc_timestamp(ts.cast("timestamp"), ZONE)


def et_date(ts: Column) -> Column:
    return F.date_format(eastern(ts), "yyyy-MM-dd")


def et_month(ts: Column) -> Column:
    return F.date_format(eastern(ts), "yyyy-MM")


def _slot(day: Column, hour: Column) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("-"), hour, F.lit("00"))


def slot_of(ts: Column) -> Column:
    """The latest slot at or before an instant; before the day's first one, the last of the day before."""
    wall = eastern(ts)
    h, day = F.hour(wall), F.to_date(wall)
    return F.when(h < 6, _slot(F.date_sub(day, 1), F.lit("18"))).otherwise(_slot(day, F.when(h >= 18, "18").when(h >= 14, "14").when(h >= 10, "10").otherwise("06")))


def slot_at_or_after(ts: Column) -> Column:
    wall = eastern(ts)
    day = F.to_date(wall)
    seconds = F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall) + F.when(F.date_trunc("second", wall) < wall, 1).otherwise(0)
    out = _slot(F.date_add(day, 1), F.lit("06"))
    for h in reversed(SLOTS):
        out = F.when(seconds <= h * 3600, _slot(day, F.lit(f"{h:02d}"))).otherwise(out)
    return out


def next_slot(slot: Column) -> Column:
    """The slot after; null for what is no slot."""
    day, hour = F.try_to_timestamp(F.substring(slot, 1, 10), F.lit("yyyy-MM-dd")).cast("date"), F.substring(slot, 12, 2)
    return F.when(~slot.rlike(r"^\d{4}-\d\d-\d\d-(06|10|14|18)00$") | day.isNull(), F.lit(None)).when(hour == "18", _slot(F.date_add(day, 1), F.lit("06"))).otherwise(_slot(day, F.when(hour == "06", "10").when(hour == "10", "14").otherwise("18")))


def slot_instant(slot: Column) -> Column:
    """The instant, in UTC, at which a slot begins; null for what is no slot."""
    ok = slot.rlike(r"^\d{4}-\d\d-\d\d-(06|10|14|18)00$")
    return F.when(ok, F.to_utc_timestamp(F.try_to_timestamp(F.concat(F.substring(slot, 1, 10), F.lit(" "), F.substring(slot, 12, 2), F.lit(":00:00"))), ZONE))


def publication_instant(ts: Column, date_only: Column) -> Column:
    """A date without a time counts as that day's last slot."""
    return F.when(date_only, F.to_utc_timestamp(F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit(" 18:00:00")), ZONE)).otherwise(ts.cast("timestamp"))


def month_window(month: Column) -> Column:
    """``start, until`` (UTC, half open) of an Eastern calendar month ``yyyy-MM``."""
    first = F.try_to_timestamp(F.concat(month, F.lit("-01 00:00:00")))
    return F.struct(F.to_utc_timestamp(first, ZONE).alias("start"), F.to_utc_timestamp(F.add_months(first, 1).cast("timestamp"), ZONE).alias("until"))


#: Minutes east of Greenwich.
ZONES = {"UTC": 0, "GMT": 0, "Z": 0, "UT": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "BST": 60, "CET": 60, "CEST": 120}
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def feed_date(c: Column) -> Column:
    """``ts, status, date_only`` of a date as feeds write it: RFC 822 with or without weekday, ISO 8601; no zone is UTC.
    Status: ok, missing, implausible (year outside 1990 to 2100) or unparsed."""
    s = F.trim(F.coalesce(c, F.lit("")))
    at = lambda p, g: F.regexp_extract(s, p, g)
    named = r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})[ -]([A-Za-z]{3})[a-z]*[ -](\d{4})(?:[ ,T]+(\d{1,2}):(\d\d)(?::(\d\d))?)?\s*([A-Za-z]{1,4}|[+-]\d\d:?\d\d)?$"
    plain = r"^(\d{4})-(\d\d)-(\d\d)(?:[T ]+(\d\d):(\d\d)(?::(\d\d)(?:\.\d+)?)?)?\s*([A-Za-z]{1,4}|[+-]\d\d:?\d\d)?$"
    iso = s.rlike(plain)
    pick = lambda a, b: F.when(iso, at(plain, a)).otherwise(at(named, b))
    spot = F.instr(F.lit(MONTHS), F.initcap(at(named, 2)))
    month = F.when(iso, at(plain, 2)).otherwise(F.lpad(((spot + 2) / 3).cast("int").cast("string"), 2, "0"))
    two = lambda x: F.lpad(F.when(x == "", "00").otherwise(x), 2, "0")
    hour, minute, second, zone = (pick(k, k) for k in (4, 5, 6, 7))
    text = F.concat(pick(1, 3), F.lit("-"), month, F.lit("-"), two(pick(3, 1)), F.lit(" "), two(hour), F.lit(":"), two(minute), F.lit(":"), two(second))
    wall = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    offset = F.when(zone == "", 0).when(zone.rlike(r"^[+-]"), sign * (F.substring(digits, 1, 2).cast("int") * 60 + F.substring(digits, 3, 2).cast("int")))
    for name, minutes in ZONES.items():
        offset = offset.when(F.upper(zone) == name, minutes)
    ts = wall - F.make_dt_interval(F.lit(0), F.lit(0), offset)
    status = F.when(s == "", "missing").when(ts.isNull(), "unparsed").when(~F.year(ts).between(1990, 2100), "implausible").otherwise("ok")
    return F.struct(F.when(status == "ok", ts).alias("ts"), status.alias("status"), (ts.isNotNull() & (hour == "")).alias("date_only"))


def et_offset(ts: Column) -> Column:
    """Minutes east of Greenwich of the zone at an instant."""
    return ((F.unix_timestamp(eastern(ts)) - F.unix_timestamp(ts.cast("timestamp"))) / 60).cast("int")


def et_iso(ts: Column) -> Column:
    """``2026-10-02T14:00:00-04:00``."""
    m = F.abs(et_offset(ts))
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    sign = F.when(et_offset(ts) < 0, "-").otherwise("+")
    return F.concat(F.date_format(eastern(ts), "yyyy-MM-dd'T'HH:mm:ss"), sign, two(F.floor(m / 60)), F.lit(":"), two(m % 60))


def is_et_iso(c: Column) -> Column:
    """Whether a text is an instant written with the zone's own offset at that instant."""
    ok = c.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d[+-]\d\d:\d\d$")
    return F.coalesce(F.when(ok, et_iso(F.try_to_timestamp(c)) == c), F.lit(False))


def is_iso_date(c: Column) -> Column:
    """Whether a text is a real calendar date ``yyyy-MM-dd``."""
    return F.coalesce(c.rlike(r"^\d{4}-\d\d-\d\d$") & F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))


def when_short(ts: Column, now: Column, days: int = 6) -> Column:
    """Weekday and time of what is less than ``days`` old, else day and month, with the year if it is another."""
    t, n = eastern(ts), eastern(now)
    recent = ts.cast("timestamp") > now.cast("timestamp") - F.make_dt_interval(F.lit(days))
    return F.when(recent, F.date_format(t, "EEE HH:mm")).when(F.year(t) == F.year(n), F.date_format(t, "d MMM")).otherwise(F.date_format(t, "d MMM yyyy"))
