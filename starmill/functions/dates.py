"""Date parsing (C1, C2) and the supported span of dates.

A value is rewritten to year-month-day text and then cast: the two commonest shapes by position, the
other all-digit shapes by one replacement that knows them all, the rest by rarer readings. The cast
is a plain byte scan that yields NULL on bad input, where a formatter per candidate pattern would
raise and catch an exception for every pattern that does not fit.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

# The span a nanosecond timestamp covers. That dates outside it reject their row is an
# inherited rule about values, counted under a reason of its own.
FIRST_DATE = "1677-09-22"
LAST_DATE = "2262-04-11"

_TIME = (
    r"[ T]+(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?(?: ?[AaPp][Mm])?"
    r"(?: ?(?:Z|UTC|[+-]\d{2}:?\d{2}))?"
)
_MONTH = (
    r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
    r"(?:(?<=Jan)uary|(?<=Feb)ruary|(?<=Mar)ch|(?<=Apr)il|(?<=Ju[nl])[ey]|(?<=Aug)ust"
    r"|(?<=Sep)t(?:ember)?|(?<=Oct)ober|(?<=(?:Nov|Dec))ember)?"
)
_WEEKDAY = r"(?:(?:Mon|Tue|Tues|Wed|Wednes|Thu|Thurs|Fri|Sat|Satur|Sun)(?:day)?,? +)?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"

# All-digit shapes. The numbers are named for the reading that is tried first: day before month,
# and month before day after a leading year.
_YEAR_LAST = r"(?<d1>\d{1,2})(?<s1>[-/. ])(?<m1>\d{1,2})\k<s1>(?<y1>\d{4})"
_YEAR_FIRST = r"(?<y2>\d{4})(?<s2>[-/. ])(?<m2>\d{1,2})\k<s2>(?<d2>\d{1,2})"
_COMPACT = r"(?<y3>\d{4})(?<m3>\d{2})(?<d3>\d{2})"
_FULL = rf"(?s)^(?:(?:{_YEAR_LAST}|{_YEAR_FIRST}|{_COMPACT})(?:{_TIME})?|.*)$"
# The same without bare ISO dates, which the staged rule never reads the other way round.
_NOT_ISO = rf"(?s)^(?!\d{{4}}-\d{{1,2}}-\d{{1,2}}$){_FULL[5:]}"

_YEAR = "${y1}${y2}${y3}"
_DAY_FIRST = f"{_YEAR}-${{m1}}${{m2}}${{m3}}-${{d1}}${{d2}}${{d3}}"
_MONTH_FIRST = f"{_YEAR}-${{d1}}${{d2}}${{d3}}-${{m1}}${{m2}}${{m3}}"

# What the cast may see of a rewritten rare shape. It would also take "2024-01-05 anything".
_RESULT = r"^\d{4}(?:-\d{1,2}(?:-\d{1,2})?)?$"


def _short_years() -> list[tuple[str, str]]:
    """Two-digit years fall within fifty years of today: (alternatives, century)."""
    first_of_last_century = min(100, datetime.date.today().year + 50 - 2000)
    digits = [f"{y:02d}" for y in range(100)]
    groups = [(digits[:first_of_last_century], "20"), (digits[first_of_last_century:], "19")]
    return [("|".join(years), century) for years, century in groups if years]


def _rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, template in rules:
        text = F.regexp_replace(text, pattern, template)
    return text


def _numeric(text: Column, pattern: str, reading: str) -> Column:
    """A full all-digit date. Any other text becomes "--", which is no date."""
    return F.regexp_replace(text, pattern, reading).try_cast("date")


def _fixed_width(text: Column) -> Column:
    """The two commonest shapes, yyyy-MM-dd and dd/MM/yyyy, by position and without a pattern."""

    def at(position: int, length: int = 1) -> Column:
        return F.substring(text, position, length)

    iso = (at(5) == "-") & (at(8) == "-")
    day_first = at(3).isin("/", "-", ".") & (at(6) == at(3))
    turned = F.concat(at(7, 4), F.lit("-"), at(4, 2), F.lit("-"), at(1, 2))
    ten_digits = F.when(iso, text).when(day_first, turned)
    return F.when(F.length(text) == 10, ten_digits).try_cast("date")


def _partial_or_short(text: Column, day: str, month: str) -> Column:
    """Dates without a day or without a century."""
    rules = [
        (f"{_TIME}$", ""),
        (r"^(\d{4})[/.](\d{1,2})$", "$1-$2"),
        (r"^(\d{1,2})[-/.](\d{4})$", "$2-$1"),
    ]
    for years, century in _short_years():
        rules.append((rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2({years})$", f"{century}$4-{month}-{day}"))
    return F.regexp_extract(_rewrite(text, rules), _RESULT, 0).try_cast("date")


def _named_month(text: Column) -> Column:
    """Dates with an English month name, brought to one shape for the formatter."""
    rules = [
        (f"{_TIME}$", ""),
        (rf"(?i)^{_WEEKDAY}{_DAY}[-/ ]*{_MONTH}[-/ ,]*(\d{{4}})$", "$1 $2 $3"),
        (rf"(?i)^{_WEEKDAY}{_MONTH}[-/ ]*{_DAY}(?:, *|[-/ ]+)(\d{{4}})$", "$2 $1 $3"),
        (rf"(?i)^(\d{{4}})[-/ ]*{_MONTH}[-/ ]+(\d{{1,2}})$", "$3 $2 $1"),
        (rf"(?i)^{_MONTH}[-/ ]*(\d{{4}})$", "1 $1 $2"),
    ]
    for years, century in _short_years():
        rules.append((rf"(?i)^{_DAY}[-/ ]*{_MONTH}[-/ ,]*({years})$", rf"$1 $2 {century}$3"))
    return F.try_to_date(_rewrite(text, rules), "d MMM yyyy")


def _rare(text: Column) -> Column:
    """Shapes outside the common ones, reached only by values that nothing else could read.

    Their many patterns sit in an array expression, which Spark evaluates without generating code.
    In line they would make the generated method of the whole row too large for the JVM to compile.
    """

    def read(value: Column) -> Column:
        digits = F.coalesce(_partial_or_short(value, "$1", "$3"), _partial_or_short(value, "$3", "$1"))
        return F.when(value.rlike("[A-Za-z]{3}"), _named_month(value)).otherwise(digits)

    return F.transform(F.array(text), read)[0]


def parse_date_mixed(text: Column) -> Column:
    """Each value on its own, day first, month first where that is the only reading.

    ``text`` is a stripped column; as an expression it would be repeated in every reading.
    """
    return F.coalesce(
        _fixed_width(text),
        _numeric(text, _FULL, _DAY_FIRST),
        _numeric(text, _FULL, _MONTH_FIRST),
        _rare(text),
    )


def parse_date_staged(text: Column) -> Column:
    """As C1, but a value shaped like an ISO date is only ever read as one."""
    return F.coalesce(
        _fixed_width(text),
        _numeric(text, _FULL, _DAY_FIRST),
        _numeric(text, _NOT_ISO, _MONTH_FIRST),
        _rare(text),
    )


def in_span(date: Column) -> Column:
    return F.when(date.between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")), date)
