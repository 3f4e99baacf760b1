"""Time columns. Timestamps leave the tables as ISO-8601 strings or epoch
milliseconds, so everything here avoids the session time zone: instants are
built as TIMESTAMP_NTZ from epoch numbers, and ISO strings are parsed with
their explicit offset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch() -> Column:
    """1970-01-01 00:00:00 as TIMESTAMP_NTZ."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_from_epoch_seconds(sec: Column) -> Column:
    return F.timestamp_add("SECOND", sec.cast("bigint"), epoch())


def ntz_from_epoch_millis(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms.cast("bigint"), epoch())


def iso_seconds(ts_ntz: Column) -> Column:
    """``2026-01-08T10:00:00Z`` (whole seconds)."""
    return F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_millis(ts_ntz: Column) -> Column:
    """``2026-01-08T10:00:00.704Z``."""
    return F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def epoch_ms_to_iso(ms: Column) -> Column:
    """Epoch milliseconds → ISO string at second precision (sub-second part
    dropped, as the session tools print it)."""
    return iso_seconds(ntz_from_epoch_seconds(F.call_function("div", ms.cast("bigint"), F.lit(1000).cast("bigint"))))


def epoch_s_to_iso(sec: Column) -> Column:
    return iso_seconds(ntz_from_epoch_seconds(F.floor(sec)))


def date_prefix(s: Column) -> Column:
    """First ten characters when the string looks like ``YYYY-MM-DD…``."""
    return F.when(s.rlike(r"^.{4}-.{2}-.{2}"), F.substring(s, 1, 10))


def day_of(iso: Column) -> Column:
    """Calendar day of an ISO timestamp string, as ``yyyy-MM-dd`` text; NULL
    when the string does not start with a valid date."""
    return F.date_format(F.try_to_date(F.substring(iso, 1, 10), "yyyy-MM-dd"), "yyyy-MM-dd")


def epoch_millis(iso: Column) -> Column:
    """ISO-8601 text (``Z``, ``±hh:mm`` or no zone = UTC) → epoch
    milliseconds; NULL when unparseable. Independent of the session time zone."""
    s = F.trim(iso)
    zone_re = r"(Z|[+-]\d{2}:?\d{2})$"
    zone = F.regexp_extract(s, zone_re, 1)
    local = F.regexp_replace(s, zone_re, "").try_cast("timestamp_ntz")
    ms = F.timestamp_diff("MILLISECOND", epoch(), local)
    sign = F.when(F.substring(zone, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    hh = F.regexp_extract(zone, r"^[+-](\d{2})", 1)
    mm = F.regexp_extract(zone, r"(\d{2})$", 1)
    off_min = F.when((zone == "") | (zone == "Z"), F.lit(0)).otherwise(sign * (hh.cast("int") * 60 + mm.cast("int")))
    return ms - off_min.cast("bigint") * 60000
