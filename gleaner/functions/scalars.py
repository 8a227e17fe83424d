"""Hashes, dates, numbers, maps and histories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item_id(raw_id: Column) -> Column:
    return F.substring(F.sha2(raw_id, 256), 1, 32)


def content_hash(text: Column) -> Column:
    return F.sha2(F.regexp_replace(F.trim(F.lower(text)), r"(?U)\s+", " "), 256)


def author_hash(name: Column, salt: str) -> Column:
    """Salted; null for no name and for names that say nothing."""
    own = F.lower(F.trim(name))
    return F.when(~own.isin("", "a user", "anonymous", "deleted"), F.substring(F.sha2(F.concat(F.lit(salt + ":"), own), 256), 1, 16))


def area_id(seed: Column) -> Column:
    return F.concat(F.lit("oa-"), F.substring(F.sha2(seed, 256), 1, 8))


def rating(value: Column) -> Column:
    """Whole number of 1 to 5, or null; commas are thousands marks."""
    n = F.floor(F.regexp_replace(value, ",", "").try_cast("double")).cast("int")
    return F.when(n.between(1, 5), n)


def loose_date(value: Column, reference: Column, dayfirst: bool = True) -> tuple[Column, Column]:
    """Timestamp and precision (exact, day, approximate) of the dates that people
    and exports write; nulls where nothing fits."""
    v = F.trim(F.regexp_replace(value, r"\s*\(edited\)\s*$", ""))
    low = F.lower(v)
    match = lambda pattern: low.rlike(pattern)
    unit = F.regexp_extract(low, r"(second|minute|hour|day|week|month|year)s? ago$", 1)
    amount = F.when(match(r"^an? "), F.lit(1)).otherwise(F.regexp_extract(low, r"^(\d+)", 1).try_cast("int"))
    seconds = amount * (
        F.when(unit == "second", 1).when(unit == "minute", 60).when(unit == "hour", 3600).when(unit == "day", 86400).when(unit == "week", 604800).when(unit == "month", 30 * 86400).otherwise(365 * 86400)
    )
    part = lambda i: F.regexp_extract(v, r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})", i).try_cast("int")
    first, second, year = part(1), part(2), part(3)
    swap = (second > 12) if dayfirst else (first <= 12)  # month first where the order demands it
    day, month = F.when(swap, second).otherwise(first), F.when(swap, first).otherwise(second)
    text_date = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    named = F.coalesce(F.try_to_timestamp(v, F.lit("MMM d, yyyy")), F.try_to_timestamp(v, F.lit("MMMM d, yyyy")), F.try_to_timestamp(v, F.lit("d MMMM yyyy")), F.try_to_timestamp(v, F.lit("d MMM yyyy")))
    iso = F.try_to_timestamp(v)
    cases = [
        (match(r"^\d{13}$"), F.timestamp_millis(v.try_cast("long")), "exact"),
        (match(r"^\d{10}$"), F.timestamp_seconds(v.try_cast("long")), "exact"),
        (match(r"^\d{5}$"), F.date_add(F.lit("1899-12-30").cast("date"), v.try_cast("int")).cast("timestamp"), "day"),
        (low == "today", F.date_trunc("day", reference), "day"),
        (low == "yesterday", F.date_trunc("day", reference) - F.expr("interval 1 day"), "day"),
        (match(r"^(an?|\d+) (second|minute|hour|day|week|month|year)s? ago$"), F.timestamp_seconds(F.unix_seconds(reference) - seconds), "approximate"),
        (match(r"^\d{4}-\d{2}-\d{2}$"), iso, "day"),
        (match(r"^\d{4}-\d{2}-\d{2}[t ]\d"), iso, "exact"),
        (match(r"^\d{1,2}[/.]\d{1,2}[/.]\d{4}"), F.try_to_timestamp(text_date), "day"),
    ]
    at, how = named, F.when(named.isNotNull(), F.lit("day"))
    for test, when, precision in reversed(cases):
        at, how = F.when(test, when).otherwise(at), F.when(test & when.isNotNull(), F.lit(precision)).when(test, None).otherwise(how)
    return at, how


def keep_last(history: Column, n: int = 5) -> Column:
    """The last n entries; slice with a start before the array would give none."""
    return F.slice(history, F.greatest(F.lit(1), F.size(history) - (n - 1)), n)


def drop_empty(values: Column) -> Column:
    """A map of JSON texts without its nulls and empty lists and objects; empty strings,
    false and 0 stay."""
    return F.map_filter(values, lambda _, v: v.isNotNull() & ~F.regexp_replace(v, r"\s", "").isin("null", "[]", "{}"))


def duration_seconds(value: Column) -> Column:
    """Seconds of spans such as 2m59.5s."""
    total = F.lit(0.0)
    for mark, size in (("h", 3600.0), ("m(?!s)", 60.0), ("s", 1.0)):
        total = total + F.coalesce(F.nullif(F.regexp_extract(value, rf"(\d+(?:\.\d+)?){mark}", 1), F.lit("")).try_cast("double"), F.lit(0.0)) * size
    return F.when(value.rlike(r"^(?:\d+(?:\.\d+)?(?:h|ms|m|s))+$"), total)
