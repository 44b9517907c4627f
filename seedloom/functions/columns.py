"""Small column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seedloom.functions.canonical_json import SAFE_INTEGER

_VERSION = r"^(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)(?:-([0-9A-Za-z.-]+))?(?:\+[0-9A-Za-z.-]+)?\z"


def pointer_member(path: Column, member: Column) -> Column:
    """JSON Pointer of a member below ``path``."""
    return F.concat(path, F.lit("/"), F.replace(F.replace(member, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))


def is_safe_integer(x: Column) -> Column:
    """Whether a number is integral and from 0 to the largest safe integer; False for NULL."""
    d = x.cast("double")
    return F.coalesce((d == F.floor(d)) & d.between(0, SAFE_INTEGER), F.lit(False))


def is_utf8(x: Column) -> Column:
    """Whether a binary value is UTF-8; NULL for NULL."""
    return F.is_valid_utf8(x.cast("string"))


def sha256_hex(x: Column) -> Column:
    """SHA-256 of a string's UTF-8 bytes or of a binary value, in small hexadecimal digits."""
    return F.sha2(x.cast("binary"), 256)


def language_tag(tag: Column) -> Column:
    """A language tag in its usual letter case: language small, script capitalised, region in capitals, the rest small.

    Underscores count as hyphens; NULL and blank tags become NULL.
    """
    parts = F.split(F.lower(F.translate(F.trim(tag), "_", "-")), "-")

    def cased(part: Column, i: Column) -> Column:
        after_single = F.exists(F.slice(parts, 1, i), lambda p: F.length(p) == 1)
        return F.when((i > 0) & (F.length(part) == 2) & ~after_single, F.upper(part)).when((i > 0) & (F.length(part) == 4) & ~after_single, F.initcap(part)).otherwise(part)

    return F.when(F.trim(tag) != "", F.array_join(F.transform(parts, cased), "-"))


def version_key(version: Column) -> Column:
    """A semantic version as a struct that sorts in its precedence; NULL for text that is no version.

    A pre-release sorts before its release; its identifiers compare as numbers or text, numbers first.
    """
    number = lambda k: F.regexp_extract(version, _VERSION, k).try_cast("bigint")
    pre = F.regexp_extract(version, _VERSION, 4)
    identifiers = F.transform(F.split(pre, r"\."), lambda p: F.struct(F.when(p.rlike(r"^[0-9]+\z"), p.try_cast("bigint")).isNull().alias("text"), F.coalesce(p.try_cast("bigint"), F.lit(-1)).alias("n"), p.alias("p")))
    return F.when(version.rlike(_VERSION), F.struct(number(1).alias("major"), number(2).alias("minor"), number(3).alias("patch"), (pre == "").alias("release"), F.when(pre != "", identifiers).alias("pre")))


def is_compatible(version: Column, minimum: Column) -> Column:
    """Whether a consumer's version is at least the minimum; NULL if either is no version."""
    return version_key(version) >= version_key(minimum)


def window_dates(anchor: Column, start_offset: Column, end_offset: Column) -> Column:
    """A relative day window as a struct of dates; NULL parts give NULL."""
    return F.struct(F.date_add(anchor, start_offset.cast("int")).alias("start"), F.date_add(anchor, end_offset.cast("int")).alias("end"))


def in_month_day_window(day: Column, start: Column, end: Column) -> Column:
    """Whether a date lies in a yearly window of MM-DD text, both ends included; a window may run over the turn of the year."""
    at = F.date_format(day, "MM-dd")
    return F.when(start <= end, at.between(start, end)).otherwise((at >= start) | (at <= end))


def month_window(start_month: Column, end_month: Column) -> Column:
    """Advice given in months as an explicit window of MM-DD with month precision; NULL for an impossible month."""
    last = F.element_at(F.array(*[F.lit(d) for d in (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)]), end_month.cast("int"))
    good = start_month.between(1, 12) & end_month.between(1, 12)
    return F.when(good, F.struct(F.format_string("%02d-01", start_month.cast("int")).alias("start"), F.format_string("%02d-%02d", end_month.cast("int"), last).alias("end"), F.lit("month").alias("precision")))
