"""Scalar column functions (F1-F16).  All JVM-side built-ins, no UDFs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str

# Whitespace class used by every cleanse/collapse step.  Written out (instead
# of \s) so that the JVM and RE2-based engines agree on it.
# The no-break space (character 160) counts: it is common in Latin-1 input.
WS = "[ \\t\\n\\r\\f\\x{A0}]"


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: ColLike) -> Column:
    """NULL or the empty string.  Empty is *not* NULL in Spark.  Works on
    any type (the value's text is compared, no ANSI cast of '')."""
    c = _c(c).cast("string")
    return c.isNull() | (c == F.lit(""))


def full_match(c: ColLike, pattern: str) -> Column:
    """whole-string regex match (anchors added)."""
    return _c(c).rlike(f"^(?:{pattern})$")


def regex_replace(c: ColLike, pattern: str, replacement: str) -> Column:
    """replace with group references ``$1``; unmatched input is returned as is."""
    return F.regexp_replace(_c(c), pattern, replacement)


def contains_any(c: ColLike, words: Iterable[str], ignore_case: bool = True) -> Column:
    """substring test against several words; NULL input gives false."""
    c = _c(c)
    hay = F.upper(c) if ignore_case else c
    out = F.lit(False)
    for w in words:
        out = out | hay.contains(w.upper() if ignore_case else w)
    return F.coalesce(out, F.lit(False))


def collapse_ws(c: ColLike) -> Column:
    """Collapse runs of tabs, line breaks and blanks to one blank, trim."""
    return F.trim(F.regexp_replace(_c(c), f"{WS}+", " "))


def concat_blank(*parts: ColLike) -> Column:
    """string ``+`` of the workflow formula language: NULL counts as ''."""
    return F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])


def pad_left(c: ColLike, width: int, fill: str = "0") -> Column:
    """F5 PadLeft: pads but never truncates (Spark's lpad truncates)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, fill))


def to_number_lenient(c: ColLike, null_as_zero: bool = True) -> Column:
    """F6 ToNumber: the leading number of the text, 0 when there is none.

    NULL input gives 0 (``null_as_zero``) or NULL.
    """
    s = F.trim(_c(c).cast("string"))
    lead = F.regexp_extract(s, r"^-?[0-9]+(\.[0-9]+)?", 0)
    num = F.coalesce(F.when(lead != "", lead.cast("double")), F.lit(0.0))
    if null_as_zero:
        return num
    return F.when(s.isNull(), F.lit(None).cast("double")).otherwise(num)


def parse_date(c: ColLike, fmt: str) -> Column:
    """lenient date parse — NULL for text that does not match ``fmt``."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt)))


def try_cast(c: ColLike, type_name: str) -> Column:
    """cast that yields NULL instead of failing under ANSI mode."""
    return _c(c).try_cast(type_name)


# The typed-layer helpers compare with '' on the *text* of the value: on a
# column a type-inferring load made numeric, ``c != ''`` would be an ANSI cast
# error (CAST_INVALID_INPUT), so the value is turned into text first.

def lower_or_null(c: ColLike) -> Column:
    """Typed layer: lower-case, blank -> NULL."""
    c = _c(c).cast("string")
    return F.when(c.isNotNull() & (c != ""), F.lower(c)).otherwise(F.lit(None).cast("string"))


def int_or_null(c: ColLike) -> Column:
    """Typed layer: NULL / '' / non-numeric -> NULL, else int."""
    c = _c(c).cast("string")
    return F.when(c.isNotNull() & (c != ""), c.try_cast("int")).otherwise(F.lit(None).cast("int"))


def double_or_null(c: ColLike) -> Column:
    c = _c(c).cast("string")
    return F.when(c.isNotNull() & (c != ""), c.try_cast("double")).otherwise(F.lit(None).cast("double"))


def bool_text(c: ColLike) -> Column:
    """Typed layer: ``lower(x) = 'true'`` -> true, everything else (NULL too) -> false."""
    return F.coalesce(F.lower(_c(c).cast("string")) == F.lit("true"), F.lit(False))


_COORDINATE = "[-0-9.]+"


def _point_part(c: Column, closed: bool, part: str) -> Column:
    """A coordinate of ``"(lat, long)"`` text; text with the marks but no such coordinate comes back trimmed,
    other text as ''."""
    marks = c.contains("(") & c.contains(",") & (c.contains(")") if closed else F.lit(True))
    found = F.regexp_extract(c, part, 1)
    return F.when(F.coalesce(marks, F.lit(False)), F.when(found != "", found).otherwise(F.trim(c))).otherwise(F.lit(""))


def lat_from_point(c: ColLike) -> Column:
    """F16: the number between the last ``(`` it can follow and a comma."""
    return _point_part(_c(c), False, rf"^[^\n]*\(({_COORDINATE})\s*,")


def long_from_point(c: ColLike) -> Column:
    """F16: the number after the first comma behind the first ``(``."""
    return _point_part(_c(c), True, rf"^[^(]*\([^,]*,\s*({_COORDINATE})[)\s]")


def point_text(lat: ColLike, lon: ColLike) -> Column:
    """F16 inverse: ``"(lat, long)"`` when both parts are present, else ''."""
    lat, lon = _c(lat), _c(lon)
    ok = ~is_blank(lat) & ~is_blank(lon)
    return F.when(ok, F.concat(F.lit("("), lat, F.lit(", "), lon, F.lit(")"))).otherwise(F.lit(""))


def first_match(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """IF/ELSEIF/ELSE — the first rule whose condition is true wins."""
    out = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(d)
