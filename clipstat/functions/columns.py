"""Scalar column functions (JVM side, no Python per row)."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text rules that decide which rows match.
HASHTAG = r"(?U)#([^\s#.，。・·]+)"
LONG_ID = r"(?U)(?<!\d)(\d{8,})(?!\d)"
ACCOUNT_SLUG = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,79}$"
INTEGER = r"^[+-]?[0-9]+$"
NOTE_TYPE = 68
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Python's datetime range in epoch seconds; anything outside has no date.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def filled(c: Column | str) -> Column:
    """NULL when the text is empty."""
    return F.nullif(as_col(c), F.lit(""))


def count_value(c: Column | str) -> Column:
    """count text as bigint; NULL, empty and unreadable text count 0."""
    return F.coalesce(strip(as_col(c).cast("string")).try_cast("bigint"), F.lit(0).cast("bigint"))


def count_is_bad(c: Column | str) -> Column:
    """True when a non-empty count could not be read."""
    text = strip(as_col(c).cast("string"))
    return F.coalesce((text != "") & text.try_cast("bigint").isNull(), F.lit(False))


def strict_int(c: Column | str) -> Column:
    """NULL unless the text is a plain integer; unknown is not 0."""
    text = strip(as_col(c).cast("string"))
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def is_note(c: Column | str) -> Column:
    """image note; an unreadable type counts as a video."""
    return F.coalesce(as_col(c).cast("string").try_cast("int"), F.lit(0)) == NOTE_TYPE


def url_key(url: Column | str) -> Column:
    """First 24 hex digits of the URL's SHA-256, empty for no URL."""
    text = F.coalesce(as_col(url), F.lit(""))
    return F.when(text == "", F.lit("")).otherwise(F.left(F.sha2(text, 256), F.lit(24)))


def content_hash(content: Column | str) -> Column:
    """X2."""
    return F.sha2(as_col(content), 256)


def config_hash(config: Mapping) -> str:
    """Stable hash of a run's settings."""
    text = json.dumps(config, sort_keys=True, ensure_ascii=False)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:24]


def comma_list(c: Column | str) -> Column:
    """Split at commas, trim, drop empties."""
    parts = F.transform(F.split(F.coalesce(as_col(c), F.lit("")), ","), strip)
    return F.filter(parts, lambda x: x != "")


def hashtags(text: Column | str) -> Column:
    """Distinct hashtags of a text."""
    return F.array_distinct(F.regexp_extract_all(as_col(text), F.lit(HASHTAG), F.lit(1)))


def long_ids(text: Column | str) -> Column:
    """X6 + D4: distinct digit runs of at least eight digits, in text order."""
    return F.array_distinct(F.regexp_extract_all(as_col(text), F.lit(LONG_ID), F.lit(1)))


def first_keyword_rule(
    text: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str = "other"
) -> Column:
    """Label of the first rule with a keyword inside the text."""
    text = F.coalesce(as_col(text), F.lit(""))
    out = None
    for label, words in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(F.lit(word))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def first_pattern_rule(text: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first pattern found in the text, else NULL."""
    out = None
    for label, pattern in rules:
        hit = as_col(text).rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(None).cast("string") if out is None else out


def correct_terms(text: Column | str, terms: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements in the given order; identity pairs are dropped."""
    out = as_col(text)
    for wrong, right in terms:
        if wrong and right and wrong != right:
            out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def segment_line(start: Column | str, end: Column | str, text: Column | str) -> Column:
    """``[sss.ss - sss.ss] text``."""
    times = [F.bround(as_col(c), 2) for c in (start, end)]
    return F.format_string("[%06.2f - %06.2f] %s", *times, strip(text))


def local_time(seconds: Column | str, tz: str = "UTC") -> Column:
    """Wall-clock time (timestamp_ntz) of epoch seconds in a named zone.

    Does not depend on the session's time zone; values without a calendar date become NULL.
    """
    s = as_col(seconds).cast("bigint")
    sane = F.when(s.between(_FIRST_SECOND + 86400, _LAST_SECOND - 86400), s)
    utc = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=sane)
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_date(seconds: Column | str, tz: str = "UTC") -> Column:
    """X11."""
    return local_time(seconds, tz).cast("date")


def month_key(time: Column | str) -> Column:
    """``YYYY-MM``."""
    return F.date_format(as_col(time).cast("date"), "yyyy-MM")


def clip(text: Column | str, n: int) -> Column:
    """First n characters."""
    return F.left(F.coalesce(as_col(text), F.lit("")), F.lit(n))


def at_path(path: str, default=None) -> Column:
    """Nested field with a default."""
    return F.col(path) if default is None else F.coalesce(F.col(path), F.lit(default))


def label_of(code: Column | str, labels: Mapping[str, str]) -> Column:
    """Text for a code, the code itself when no label is known."""
    code = as_col(code)
    if not labels:
        return code
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)


def hamming(a: Column | str, b: Column | str) -> Column:
    """Differing bits of two 64-bit hashes."""
    return F.bit_count(as_col(a).bitwiseXOR(as_col(b)))


def l1_distance(a: Column | str, b: Column | str) -> Column:
    """Sum of absolute differences of two arrays of equal length."""
    gaps = F.zip_with(as_col(a), as_col(b), lambda x, y: F.abs(x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)


def duration_seconds(*sources: Column | str) -> Column:
    """First source that is present and not zero, else 0; one decimal."""
    found = [F.nullif(as_col(s).cast("double"), F.lit(0.0)) for s in sources]
    return F.bround(F.coalesce(*found, F.lit(0.0)), 1)


def valid_slug(account: Column | str) -> Column:
    """X19."""
    return F.coalesce(as_col(account).rlike(ACCOUNT_SLUG), F.lit(False))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double ratio, NULL when the denominator is 0 or NULL."""
    num, den = as_col(num).cast("double"), as_col(den).cast("double")
    return F.when(den != 0, num / den)


def percent(num: Column | str, den: Column | str) -> Column:
    """``num * 100 / den`` as double, 0 when the denominator is 0."""
    num, den = as_col(num), as_col(den)
    value = (num * F.lit(100)).cast("double") / den.cast("double")
    return F.when(den != 0, value).otherwise(F.lit(0.0))


def text_key(text: Column | str) -> Column:
    """Pseudonym for a personal name; empty stays empty."""
    text = F.coalesce(as_col(text), F.lit(""))
    return F.when(text == "", F.lit("")).otherwise(F.left(F.sha2(text, 256), F.lit(16)))
