"""ISO-8601 text and epoch numbers to timestamps. NULL where the value is no timestamp."""

from __future__ import annotations

# The common form, which Spark's own cast reads; its zone offsets stop at 18 hours.
_PLAIN = (
    r"\A(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?"
    r"(Z|[+-](0\d|1[0-7]):[0-5]\d)?\z"
)


def _clock(hour: str, sixty: str) -> str:
    return rf"(?:{hour}(?::{sixty}(?::{sixty})?)?|{hour}{sixty}(?:{sixty})?)(?:[.,]\d+)?"


# Every form: calendar or week date, with or without separators; then, after any one character,
# a time of day; then an offset. Minutes and seconds may be left out of both.
_DATE = r"(?!0000)(?:\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-[1-7])?|\d{4}W\d{2}[1-7]?)"
_TIME = _clock(r"(?:[01]\d|2[0-3])", r"[0-5]\d")
_OFFSET = _clock(r"\d{2}", r"\d{2}")
_ISO = rf"(?s)\A{_DATE}(?:.{_TIME}(?:Z|[+-]{_OFFSET})?)?\z"

_WEEK_DATE = r"\A(\d{4})-?W(\d{2})-?([1-7]?)"

# Rewrites any form into parts. "#00" is put behind the text first: a part that was left out
# captures its zeros from there.
_TAIL = "#00"


def _part(written: str) -> str:
    return rf"(?:{written}|(?=.*#(00)\z))"


_SPLIT = (
    r"(?s)\A(\d{4})-?(\d{2})-?(\d{2})"
    + r"(?:(?=#(00)\z)|.(\d{2}))"
    + 2 * _part(r":?(\d{2})")
    + _part(r"[.,](\d{1,6})\d*")
    + r"Z?([+-]?)"
    + _part(r"(\d{2})")
    + 2 * _part(r":?(\d{2})")
    + _part(r"[.,](\d{1,6})\d*")
    + r"#00\z"
)
# Local time; then offset hour, minute and second with the sign; then sign and fraction.
_PARTS = "$1-$2-$3 $4$5:$6$7:$8$9.$10$11|$12$13$14|$12$15$16|$12$17$18|$12|$19$20"

_DAY_MICROS = 86_400_000_000


def iso_source(value: str) -> str:
    """SQL text of what ``parse_iso`` reads out of a variant: see ``iso_parts``."""
    return f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN {iso_parts(f'try_cast({value} AS string)')} END"


def iso_parts(text: str) -> str:
    """A text in the common form as it is, one in another form as its parts.

    The parts are referred to many times over, so callers keep this in a ``once`` column.
    """
    calendar = f"CASE WHEN rlike({text}, r'{_WEEK_DATE}') THEN {_calendar_date(text)} ELSE {text} END"
    parts = f"split(regexp_replace(concat({calendar}, '{_TAIL}'), r'{_SPLIT}', '{_PARTS}'), r'\\|')"
    plain = f"rlike({text}, r'{_PLAIN}')"
    return f"""named_struct(
      'text', CASE WHEN {plain} THEN {text} END,
      'parts', CASE WHEN NOT {plain} AND rlike({text}, r'{_ISO}') THEN {parts} END)"""


def _calendar_date(text: str) -> str:
    """The text with its week date turned into a calendar date; NULL if there is no such week."""
    year, week, weekday = (f"regexp_extract({text}, r'{_WEEK_DATE}', {group})" for group in (1, 2, 3))
    # ISO week 1 holds 4 January and the last one holds 28 December.
    first = f"CAST(date_trunc('week', try_cast({year} || '-01-04' AS timestamp)) AS date)"
    last_week = f"weekofyear(try_cast({year} || '-12-28' AS date))"
    number = f"try_cast({week} AS int)"
    day = f"date_add({first}, {number} * 7 - 8 + coalesce(try_cast({weekday} AS int), 1))"
    rest = f"regexp_replace({text}, r'{_WEEK_DATE}', '')"
    return f"CASE WHEN {number} BETWEEN 1 AND {last_week} THEN CAST({day} AS string) || {rest} END"


def parse_iso(source: str) -> str:
    """SQL text of the timestamp of an ISO-8601 text.

    Without an offset it is UTC; digits past micros are cut.
    """

    def part(index: int) -> str:
        return f"{source}.parts[{index}]"

    hours, minutes, seconds = (f"try_cast({part(i)} AS bigint)" for i in (1, 2, 3))
    fraction = f"try_cast({part(4)} || rpad({part(5)}, 6, '0') AS bigint)"
    offset = f"(({hours} * 3600 + {minutes} * 60 + {seconds}) * 1000000 + {fraction})"
    local = f"unix_micros(try_cast({part(0)} AS timestamp))"
    return f"""CASE WHEN {source}.text IS NOT NULL THEN try_cast({source}.text AS timestamp)
      WHEN abs({offset}) < {_DAY_MICROS} THEN timestamp_micros({local} - {offset}) END"""


def from_epoch(value: str, per_second: int) -> str:
    """SQL text of the timestamp of a variant number counted in ``per_second`` units."""
    micros = f"try_multiply(try_cast({value} AS decimal(38,6)), {1_000_000 // per_second})"
    return f"timestamp_micros(try_cast(round({micros}, 0) AS bigint))"
