"""Parsing of pipe-delimited click lines, independent of session settings.

The lines were produced for Spark 2.3, whose casts were lenient. Spark 4
runs with ANSI mode on by default, where ``cast`` raises and ``arr[i]``
fails out of bounds; every rule here uses ``try_*`` functions and ``get``
so the result is the same whatever ANSI or parser policy the caller's
session has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field separator (as a regex) and the shape a click time
# must have. The shape is the one the production job checks before parsing.
FIELD_SEPARATOR = r"[|]"
CLICK_TIME_SHAPE = r"[0-9]{4}/[0-9]{2}/[0-9]{2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"
CLICK_TIME_PATTERN = "yyyy/MM/dd H:m:s"

# Leading blanks are accepted, trailing text after the seconds is ignored,
# but the seconds may not run on into a third digit.
_TIME_PREFIX = rf"^[ \t]*({CLICK_TIME_SHAPE})(?![0-9])"
# Characters a cast to an integer trims at both ends: ASCII control
# characters and the space.
_BLANK = r"[\x00-\x20\x7f]"
# Integer text with an optional fraction that is cut off (toward zero).
_WHOLE_PART = rf"^{_BLANK}*([+-]?[0-9]+)(?:\.[0-9]*)?{_BLANK}*\z"
# A fraction without integer digits (".5", "-.5") truncates to zero.
_FRACTION_ONLY = rf"^{_BLANK}*[+-]?\.[0-9]+{_BLANK}*\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pipe_fields(line: Column | str) -> Column:
    """Split a click line on ``|`` into an array of strings."""
    return F.split(_col(line), FIELD_SEPARATOR)


def field(fields: Column | str, i: int) -> Column:
    """0-based array element; NULL when the line is too short."""
    return F.get(_col(fields), F.lit(i))


def lenient_integer(text: Column | str, type_: str = "bigint") -> Column:
    """Integer text to ``type_``; fractions truncate, anything else is NULL.

    ``'163.62515'`` -> 163, ``'-3.9'`` -> -3, ``'.5'`` -> 0; exponent form,
    junk, empty text and overflow give NULL.
    """
    text = _col(text)
    whole = F.regexp_extract(text, _WHOLE_PART, 1)
    by_rule = F.when(whole != "", whole.try_cast(type_)).when(
        text.rlike(_FRACTION_ONLY), F.lit(0).cast(type_)
    )
    # Plain integers (nearly every value) take the cheap cast; it accepts
    # exactly the rule's integers without fraction (same blanks trimmed),
    # so the regular expressions run only for the rest.
    return F.coalesce(text.try_cast(type_), by_rule)


def lenient_float(text: Column | str) -> Column:
    """Float text (exponent form allowed) to float; NULL when malformed."""
    return _col(text).try_cast("float")


def click_time(text: Column | str) -> Column:
    """Click time ``yyyy/MM/dd H:m:s`` to a timestamp, NULL when invalid.

    Hours, minutes and seconds may have one or two digits; out-of-range
    fields (month 13, minute 61) give NULL.
    """
    stamp = F.regexp_extract(_col(text), _TIME_PREFIX, 1)
    return F.try_to_timestamp(stamp, F.lit(CLICK_TIME_PATTERN)).cast("timestamp")
