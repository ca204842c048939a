"""Text and time helpers as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_part(text: Column) -> Column:
    """A path component: runs of characters outside [a-zA-Z0-9._-] become one hyphen."""
    cleaned = F.regexp_replace(F.trim(text), r"[^a-zA-Z0-9._-]", "-")
    return F.regexp_replace(F.regexp_replace(cleaned, "-+", "-"), "^-|-$", "")


def bookmark_key(job: Column, table: Column, prefix: str = "bookmarks") -> Column:
    """`prefix/job/table.json`; NULL when job or table is blank."""
    folder = prefix.rstrip("/") or "bookmarks"
    usable = (F.length(F.trim(job)) > 0) & (F.length(F.trim(table)) > 0)
    key = F.concat(F.lit(folder + "/"), key_part(job), F.lit("/"), key_part(table), F.lit(".json"))
    return F.when(usable, key)


def bucket_name(path: Column) -> Column:
    """Bucket of an `s3://bucket/...` path, NULL when path or bucket is malformed."""
    name = F.regexp_extract(path, r"^s3://([^/]+)", 1)
    valid = name.rlike(r"^[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]$")
    return F.when(valid, name)


def pick_bucket(source_path: Column, target_path: Column) -> Column:
    """Bucket of the source path, else of the target path."""
    return F.coalesce(bucket_name(source_path), bucket_name(target_path))


def parse_iso(text: Column) -> Column:
    """ISO text with `Z`, an offset or none (read as UTC) to an instant; bad text gives NULL."""
    t = F.upper(F.trim(text))
    is_iso = t.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$")
    # Signs this far from the end of a text with a time belong to an offset.
    offset = F.substring(t, -6, 1).isin("+", "-") | F.substring(t, -5, 1).isin("+", "-")
    has_zone = t.endswith("Z") | ((F.length(t) > 16) & offset)
    day_only = F.when(F.length(t) == 10, F.concat(t, F.lit("T00:00:00"))).otherwise(t)
    zoned = F.when(has_zone, t).otherwise(F.concat(day_only, F.lit("+00:00")))
    return F.try_to_timestamp(F.when(is_iso, zoned))


def clock_text(value: Column, kind: T.DataType) -> Column:
    """A date or time as `yyyy-MM-dd[ HH:mm:ss[.f]]`, an instant in UTC.

    It goes by way of a time without zone, because formatting in the session time zone
    would bend hours that a clock change skips.
    """
    if isinstance(kind, T.TimestampType):
        seconds = (F.unix_micros(value).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        none = F.lit(0)
        value = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(none, none, none, seconds)
    return value.cast("string")


def format_iso(instant: Column) -> Column:
    """An instant as UTC ISO text with an offset, whatever the session time zone."""
    return F.concat(F.replace(clock_text(instant, T.TimestampType()), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def redact(text: Column) -> Column:
    """Hide the values of password settings, and user names and passwords in URLs.

    A value ends at a blank, a semicolon or an ampersand unless it is quoted. URL credentials begin after `://`
    with a name and a colon and end at the last `@` before a blank or a quote, so a password may hold slashes
    and further `@`; a colon with a port and a slash begins none.
    """
    value = r"""("[^"]*"|'[^']*'|[^\s;&"']+)"""
    hidden = text
    for name in ("password", "pwd"):
        hidden = F.regexp_replace(hidden, rf"(?i)\b{name}={value}", f"{name}=***")
    return F.regexp_replace(hidden, r"""://[^\s/:@"']+:(?!\d+/)[^\s"']+@""", "://***:***@")


def ratio(part: Column, whole: Column, factor: float = 1.0) -> Column:
    """part / whole × factor, and 0 where there is nothing to divide by."""
    return F.when(whole > 0, part * F.lit(factor) / whole).otherwise(F.lit(0.0))


def percent_change(current: Column, before: Column) -> Column:
    return F.when(before > 0, (current - before) / before * 100).otherwise(F.lit(0.0))
