"""Lenient casts, text normalisation, keys and first-match rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_BLANKS = r"(?U)^\s+|\s+$"


def lenient_number(text: Column) -> Column:
    """Number or null; NaN counts as missing, Java literal suffixes are not numbers."""
    suffixed = text.cast("string").rlike(r"[0-9.][dDfF]\s*$")
    number = F.when(~suffixed, text.cast("string").try_cast("double"))
    return F.when(~F.isnan(number), number)


def lenient_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def strip(text: Column) -> Column:
    """Remove every kind of white space at both ends, not only blanks."""
    return F.regexp_replace(text, _EDGE_BLANKS, "")


def fold(text: Column) -> Column:
    """Comparable form of an identifier: stripped lower case, null as empty."""
    return F.lower(strip(F.coalesce(text.cast("string"), F.lit(""))))


def truth(value: Column) -> Column:
    """Text, number or boolean flag; null is false."""
    return F.coalesce(F.lower(strip(value.cast("string"))).isin("true", "1"), F.lit(False))


def bare_phone(text: Column) -> Column:
    return F.regexp_replace(text, r"[\s()+-]", "")


def is_finite(*columns: Column) -> Column:
    checks = [c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))) for c in columns]
    result = checks[0]
    for check in checks[1:]:
        result = result & check
    return result


def is_whole(number: Column) -> Column:
    return number == F.floor(number)


def surrogate_key(prefix: str, key: Column, digits: int = 16) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(key, 256), 1, digits))


def quoted(text: Column) -> Column:
    """Quote text so that two different value pairs never print alike.

    Single quotes, or double quotes where the text holds only single ones;
    backslashes and clashing quotes are escaped.
    """
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    use_double = escaped.contains("'") & ~escaped.contains('"')
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(use_double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(single)


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, null when none does; a null test does not hold."""
    return F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules])


def spreadsheet_safe(text: Column) -> Column:
    """Keep a spreadsheet from reading a cell as a formula."""
    value = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(value.rlike("^[=+@-]"), F.concat(F.lit("'"), value)).otherwise(value)
