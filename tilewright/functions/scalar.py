"""Text, number and date functions of the normalizers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """Trimmed text; null for null and blank values."""
    return F.nullif(F.trim(col(c).cast("string")), F.lit(""))


def placeholder_null(c, placeholders=("", "unknown", "unavailable")) -> Column:
    """Null where the cleaned value, in any case, is a placeholder."""
    text = F.trim(col(c).cast("string"))
    return F.when(~F.lower(text).isin(*placeholders), text)


def slug(c) -> Column:
    """Lower case with every run of other characters than a-z and 0-9 as one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def title(c) -> Column:
    return F.initcap(F.lower(col(c)))


def number(c) -> Column:
    """Double, or null for what is no number."""
    return col(c).cast("string").try_cast("double")


def year(c) -> Column:
    """The first four-digit token that begins with 18, 19 or 20; null if there is none."""
    return F.nullif(F.regexp_extract(col(c).cast("string"), r"\b((?:18|19|20)\d{2})\b", 1), F.lit("")).cast("int")


def scale_denominator(c) -> Column:
    """200000 for `1:200,000`; null for what is no scale."""
    return F.regexp_replace(F.regexp_extract(col(c), r"^\s*1\s*:\s*([0-9][0-9,]*)\s*$", 1), ",", "").try_cast("bigint")


def strict_int(c) -> Column:
    """A whole number as bigint; null where the value is null, fractional or no number."""
    value = number(c)
    return F.when(value == F.floor(value), value.cast("bigint"))


def required_int(c, label: str = "value") -> Column:
    """strict_int, and an error where it gives none."""
    found = strict_int(c)
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit(f"{label} is not a whole number: "), F.coalesce(col(c).cast("string"), F.lit("null"))))).otherwise(found)


_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ].*)?$"


def iso_date(c) -> Column:
    """ISO text as `YYYY-MM-DD`; null is null; anything else is an error, numbers included."""
    text = F.trim(col(c).cast("string"))
    parsed = F.date_format(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")), "yyyy-MM-dd")
    bad = text.isNotNull() & (~text.rlike(_ISO) | parsed.isNull())
    return F.when(bad, F.raise_error(F.concat(F.lit("not a date in one reading: "), text))).otherwise(parsed)


def try_iso_date(c) -> Column:
    """iso_date with null in place of the error."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(_ISO), F.date_format(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")), "yyyy-MM-dd"))


def epoch_ms_date(c) -> Column:
    """`YYYY-MM-DD` of a number declared as milliseconds since 1970 (UTC)."""
    return F.date_format(F.timestamp_millis(col(c).cast("bigint")), "yyyy-MM-dd")


def effective_date(c) -> Column:
    """`YYYY-MM-DD` of mm/dd/yyyy or yyyymmdd text; null for what is neither."""
    text = F.trim(col(c).cast("string"))
    us = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(text, F.lit("M/d/yyyy")))
    packed = F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    return F.date_format(F.coalesce(us, packed), "yyyy-MM-dd")


_DMS = r"^\s*(\d{1,3})\s*°\s*(\d{1,2}(?:\.\d+)?)\s*['’′]\s*(?:(\d{1,2}(?:\.\d+)?)\s*[\"”″]\s*)?([NSEW])\s*$"


def dms(c) -> Column:
    """Degrees of `48°34'00"N` or `48°34.000’N`; 60 minutes or seconds carry, more are null, as is other text."""
    part = lambda i: F.regexp_extract(col(c), _DMS, i)
    minutes, seconds = part(2).try_cast("double"), F.coalesce(part(3).try_cast("double"), F.lit(0.0))
    size = part(1).try_cast("double") + minutes / 60 + seconds / 3600
    return F.when((part(4) != "") & (minutes <= 60) & (seconds <= 60), F.when(part(4).isin("S", "W"), -size).otherwise(size))


def is_uuid(c) -> Column:
    return col(c).rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")


def is_geoid(c) -> Column:
    return col(c).rlike("^[0-9]{5}$")


def is_revision(c) -> Column:
    return col(c).rlike("^[0-9a-f]{40}$")


def is_digest(c) -> Column:
    return col(c).rlike("^[0-9a-f]{64}$")


def json_attribute(c) -> Column:
    """A map as JSON with sorted keys, whatever order its entries have."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col(c)))))


def sha256(c) -> Column:
    return F.sha2(col(c).cast("binary"), 256)
