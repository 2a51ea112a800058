"""Column functions on dates, numbers, hashes and optional text."""

from __future__ import annotations

import hashlib
import json
from email.utils import parsedate_to_datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Scope
from .paths import col, trimmed


def is_iso_date(c: Column | str) -> Column:
    """A real calendar day in exactly the form YYYY-MM-DD."""
    c = col(c)
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}$") & c.try_cast("date").isNotNull(), F.lit(False))


def is_timestamp(c: Column | str) -> Column:
    c = col(c)
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}") & F.try_to_timestamp(c).isNotNull(), F.lit(False))


def utc_date(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def date_of_timestamp(c: Column | str) -> Column:
    """The day of an ISO timestamp, or null."""
    return F.when(is_timestamp(c), F.substring(col(c), 1, 10))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(col(end).try_cast("date"), col(start).try_cast("date"))


def refresh_due(last: Column | str, today: str, days: int) -> Column:
    """No usable date, or one more than `days` ago."""
    return ~is_iso_date(last) | F.coalesce(days_between(last, F.lit(today)) > days, F.lit(True))


def age_hours(stamp: Column | str, now: str) -> Column:
    """Hours since an ISO timestamp, to one decimal; null for none."""
    seconds = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.try_to_timestamp(col(stamp)))
    return F.when(is_timestamp(stamp), F.round(seconds / 3600, 1))


def text_or_null(c: Column | str) -> Column:
    return F.when(trimmed(c) != "", col(c))


def family_of_kind(kind: Column | str) -> Column:
    return F.when(col(kind) == "docs", "docs").otherwise("learn")


def list_some(values: Column | str, most: int = 3) -> Column:
    """'a, b, c, ... (+N more)' of an array."""
    v = col(values)
    return F.concat(F.array_join(F.slice(v, 1, most), ", "), F.when(F.size(v) > most, F.concat(F.lit(", ... (+"), F.size(v) - most, F.lit(" more)"))).otherwise(""))


def drop_percent(before: Column | str, after: Column | str) -> Column:
    b, a = col(before), col(after)
    return F.when(b > 0, F.greatest(F.lit(0.0), (b - a) / b * 100)).otherwise(0.0)


def percent_text(c: Column | str) -> Column:
    return F.concat(F.format_number(F.round(col(c), 2), "0.##"), F.lit("%"))


def lastmod_or_null(c: Column | str) -> Column:
    """A sitemap date; the sentinel for 'released' and the empty string are none."""
    return F.nullif(F.nullif(col(c), F.lit("released")), F.lit(""))


def day_prefix(c: Column | str) -> Column:
    """The day that a stamp begins with, if it is one."""
    day = F.substring(col(c), 1, 10)
    return F.when(is_iso_date(day), day)


def fnv32(c: Column | str) -> Column:
    """FNV-1a, 32 bits, over the UTF-16 units of a text."""
    codes = F.transform(F.filter(F.split(col(c), ""), lambda x: x != ""), lambda x: F.ascii(x).cast("long"))
    units = F.flatten(F.transform(codes, lambda x: F.when(x < 65536, F.array(x)).otherwise(F.array(F.floor((x - 65536) / 1024) + 55296, (x - 65536) % 1024 + 56320))))
    return F.aggregate(units, F.lit(2166136261).cast("long"), lambda h, x: (h.bitwiseXOR(x) * F.lit(16777619)).bitwiseAND(F.lit(4294967295)))


def sha1_lines(*parts: Column) -> Column:
    """sha1 of texts or arrays of texts joined by line breaks."""
    return F.sha1(F.concat_ws("\n", *parts).cast("binary"))


def json_signature(c: Column | str) -> Column:
    """sha1 of the JSON of a column, nulls included."""
    return F.sha1(F.to_json(F.struct(col(c).alias("v")), {"ignoreNullFields": "false"}).cast("binary"))


def scope_signature(*scopes: Scope) -> str:
    """Ten hex digits that change with the scopes."""
    plain = [{"include": sorted(s.include), "exclude": sorted(s.exclude)} for s in scopes]
    return hashlib.sha1(json.dumps(plain, sort_keys=True).encode()).hexdigest()[:10]


def retry_after_ms(value: str | None, now_ms: int) -> int | None:
    """A Retry-After header (seconds or an HTTP date) in milliseconds."""
    if not value:
        return None
    if value.strip().isdigit():
        return int(value) * 1000
    try:
        return max(0, round(parsedate_to_datetime(value).timestamp() * 1000) - now_ms)
    except (TypeError, ValueError):
        return None


def backoff_ms(attempt: int, base: int = 1000, most: int = 60_000, retry_after: int | None = None) -> int:
    """Doubling delays up to a cap, never below what the server asked for."""
    return max(min(most, base * 2**attempt), retry_after or 0)


def status_class(c: Column | str) -> Column:
    """ok, notFound, retry or error."""
    c = col(c)
    return F.when(c.between(200, 299), "ok").when(c.isin(404, 410), "notFound").when(c.isNull() | (c == 429) | (c >= 500), "retry").otherwise("error")


def utf16_key(c: Column | str) -> Column:
    """A text that sorts as the UTF-16 units of c do: beyond the BMP they differ from the order of code points, and of bytes."""
    return F.hex(F.encode(col(c), "UTF-16BE"))
