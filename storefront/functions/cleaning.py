"""Cleaning of messy text fields as Spark column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so
it stays inside whole-stage code generation: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storefront.constants import (
    LIST_SEPARATOR,
    LIST_SEPARATOR_PATTERN,
    MISSING_TOKENS,
    TWO_DIGIT_YEAR_PIVOT,
)

# First number in a text such as '13.4km', '20 mins', '15'.
NUMBER_PATTERN = r"(\d+(\.\d+)?)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_missing(c, tokens=MISSING_TOKENS) -> Column:
    """Map the text tokens that mean 'nothing' ('' and 'null') to SQL NULL."""
    c = _col(c)
    return F.when(F.trim(c).isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def literal_list(c, separator: str = LIST_SEPARATOR) -> Column:
    """Split a delimited text on an exact separator (no trimming).

    ``'1, 5'`` gives ``['1', '5']``; ``'1,5'`` stays one token, as an exact
    separator split does. NULL stays NULL.
    """
    return F.split(_col(c), _regex_quote(separator))


def id_list(c, pattern: str = LIST_SEPARATOR_PATTERN) -> Column:
    """Parse a delimited id list leniently: missing tokens give an empty list,
    separators may or may not carry blanks, empty tokens are dropped. Ids keep
    their order and their repeats; where a list means a set, wrap it in
    ``array_distinct``."""
    cleaned = F.coalesce(normalise_missing(c), F.lit(""))
    tokens = F.transform(F.split(F.trim(cleaned), pattern), lambda t: F.trim(t))
    return F.filter(tokens, lambda t: t != F.lit(""))


def in_delimited(text, token, separator: str = LIST_SEPARATOR) -> Column:
    """Whether ``token`` is one of the items of ``text`` split on the exact
    ``separator`` - without splitting: ``sep + token + sep`` must occur in
    ``sep + text + sep``. Exact for separators that cannot overlap themselves
    (such as ', ') and tokens that do not contain the separator. NULL text
    gives NULL, as membership in a NULL list does."""
    sep = F.lit(separator)
    return F.contains(F.concat(sep, _col(text), sep), F.concat(sep, _col(token), sep))


def pattern_capture(c, pattern: str, group: int = 1) -> Column:
    """Text matched by a capture group; NULL when there is no match or the
    group did not take part (Spark itself returns '')."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def extract_number(c, pattern: str = NUMBER_PATTERN, to: str = "double") -> Column:
    """First number found in a text, as ``to``; NULL when there is none or it
    does not fit the type."""
    return pattern_capture(c, pattern, 1).try_cast(to)


def count_separators(c, separator: str = ",") -> Column:
    """Number of separator characters in a text (NULL stays NULL)."""
    c = _col(c)
    return F.length(c) - F.length(F.replace(c, F.lit(separator), F.lit("")))


def minutes_between(start, end) -> Column:
    """Elapsed minutes from ``start`` to ``end``, fractional (to the microsecond)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)).cast("double") / F.lit(60_000_000.0)


def parse_short_date(c) -> Column:
    """Parse 'd/M/yy' text into a date; malformed text gives NULL.

    Two-digit years from the pivot on belong to the previous century
    ('1/12/99' is 1999-12-01, not 2099).
    """
    d = F.try_to_date(_col(c), "d/M/yy")
    # One shift by a computed month offset: the parse appears twice, not three
    # times, in filters Catalyst pushes below an aggregate.
    return F.add_months(d, F.when(F.year(d) >= TWO_DIGIT_YEAR_PIVOT, F.lit(-1200)).otherwise(F.lit(0)))


def day_name_padded(c, width: int = 9) -> Column:
    """Full weekday name blank-padded to a fixed width ('Monday   ')."""
    return F.rpad(F.date_format(_col(c), "EEEE"), width, " ")


def round_ratio(num, den, digits: int = 2, scale: int = 1) -> Column:
    """``round(num * scale / den, digits)`` for whole numbers, exactly (half
    away from zero, as SQL ``ROUND`` on numerics), returned as double; NULL
    when ``den`` is 0 or NULL.

    Computed in integers: ``q = floor((|num| * scale * 10^digits * 2 + |den|)
    / (2 |den|))`` with the floor taken through an exact remainder, so no
    intermediate quotient is rounded."""
    m = 10 ** digits
    n = _col(num).cast("decimal(38,0)")
    d = _col(den).cast("decimal(38,0)")
    a = F.abs(n) * F.lit(scale * m * 2).cast("decimal(20,0)") + F.abs(d)
    b = F.abs(d) * F.lit(2).cast("decimal(1,0)")
    q = ((a - a % b) / b).cast("decimal(38,0)")
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return F.when(d != 0, signed.cast("double") / F.lit(float(m)))


def _regex_quote(text: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in text)
