"""Timestamps from text by a pattern, strict or lenient, as column expressions.

No session setting is involved, so two loads of one query may parse differently.
The patterns are those of numeric fields: ``y`` (year), ``M``, ``d``, ``H``, ``m``, ``s``
in any number of letters, each once, ``S`` (fraction of a second) last, and
literal text between them, letters in single quotes.

* strict: the whole text must match and name a valid date and time.
* lenient: fields may have any value and roll over into the next larger one, as
  with a lenient calendar (month 13 is January of the next year, day 0 the last
  of the month before); text behind the match is ignored. Text that does not match at all
  is NULL either way, as is a NULL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIELDS = "yMdHmsS"
# Digits of a field, at most: what rolls over stays inside the range of timestamps.
_DIGITS = {"y": 5, "S": 9}


def pattern_regex(pattern: str) -> tuple[str, list[str]]:
    """A regular expression with a group per field, and the fields in order."""
    out, fields = [], []
    for token in re.finditer(r"'(?:[^']|'')*'|([A-Za-z])\1*|[^A-Za-z']+", pattern):
        text = token.group(0)
        if text[0] == "'":
            out.append(re.escape(text[1:-1].replace("''", "'") or "'"))
        elif text[0].isalpha():
            if text[0] not in _FIELDS or text[0] in fields:
                raise ValueError(f"field {text!r} of pattern {pattern!r} is not supported")
            fields.append(text[0])
            out.append(rf"(\d{{1,{_DIGITS.get(text[0], 6)}}})")
        else:
            out.append(re.escape(text))
    if "y" not in fields:
        raise ValueError(f"pattern {pattern!r} names no year")
    return "".join(out), fields


def parse_timestamp(text: Column, pattern: str, time_parser: str, kind: T.DataType | None = None) -> Column:
    """``text`` as a timestamp of type ``kind`` (without zone by default); NULL where it does not parse."""
    if time_parser not in ("strict", "lenient"):
        raise ValueError(f"time_parser must be 'strict' or 'lenient', not {time_parser!r}")
    regex, fields = pattern_regex(pattern)
    regex = r"^\s*" + regex + (r"\s*$" if time_parser == "strict" else "")

    def field(name: str, default: int) -> Column:
        if name not in fields:
            return F.lit(default)
        return F.regexp_extract(text, regex, fields.index(name) + 1).try_cast("int")

    matched = F.regexp_like(text, F.lit(regex))
    year, month, day = field("y", 1970), field("M", 1), field("d", 1)
    hour, minute, second = field("H", 0), field("m", 0), field("s", 0)
    micros = F.lit(0)
    if "S" in fields:
        digits = F.regexp_extract(text, regex, fields.index("S") + 1)
        micros = F.rpad(digits, 6, "0").substr(1, 6).try_cast("int")
    if time_parser == "strict":
        valid = (matched & year.between(1, 9999) & month.between(1, 12) & hour.between(0, 23) & minute.between(0, 59)
                 & second.between(0, 59) & (day >= 1))
        start = F.when(valid, F.make_date(year, F.when(month.between(1, 12), month), F.lit(1)))
        # a valid day is one that the month has
        start = F.when(day <= F.dayofmonth(F.last_day(start)), F.date_add(start, day - 1))
    else:
        start = F.when(matched, F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1), day - 1))
    at = start.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), hour, minute, (second + micros / F.lit(1000000)).cast("decimal(18,6)"))
    return at.cast(kind or T.TimestampNTZType())
