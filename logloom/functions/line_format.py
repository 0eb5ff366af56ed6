"""The Combined log format as one regular expression over the line.

    ip ident user [dd/Mon/yyyy:HH:MM:SS +zzzz] "METHOD path PROTOCOL" status size "referer" "agent"

Text after the agent is allowed; if it starts with a whole number, that number
is the response time in milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the format: white space, month names.
ASCII_SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20"
SPACE = (
    ASCII_SPACE
    + r"\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_ZONE = (
    r"(?:Z|[+-](?:[01][0-9]|2[0-3])"
    r"(?:[0-5][0-9](?:[0-5][0-9](?:\.[0-9]{1,6})?)?"
    r"|:[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,6})?)?))"
)


def _line(space: str) -> str:
    word = f"[^{space}]++"
    return (
        f"^[{space}]*+"
        f"({word}) {word} {word} "
        r"\[(0?[1-9]|[12][0-9]|3[01]| [1-9])/([A-Za-z]{3})/((?!0000)[0-9]{4})"
        r":(2[0-3]|[01]?[0-9]):([0-5]?[0-9]):([0-5]?[0-9])"
        f"[{space}]++{_ZONE}"
        r"\] "
        f'"({word}) ({word}) ([^"]++)" '
        r"([0-9]{3}) "
        r"([+-]?[0-9]++|-) "
        '"([^"]*+)" "([^"]*+)"'
        f"(?: ([0-9]++)(?![^{space}]))?"
        r"(?s:.*)$"
    )


LINE = _line(SPACE)
# A line of ASCII only meets fewer kinds of white space, which makes matching
# several times faster.
ASCII_LINE = _line(ASCII_SPACE)
GROUPS = 15

# A line never holds a line break, so it can separate the captured fields.
_BREAK = "\n"


def captured(line: Column) -> Column:
    """The captured fields as an array of 15 strings; any other size for a foreign line.

    One pass of the expression over the line yields all fields.
    """
    ascii_only = F.octet_length(line) == F.char_length(line)
    fields = F.lit(_BREAK.join(f"${group}" for group in range(1, GROUPS + 1)))
    return F.split(
        F.when(ascii_only, F.regexp_replace(line, F.lit(ASCII_LINE), fields)).otherwise(
            F.regexp_replace(line, F.lit(LINE), fields)
        ),
        _BREAK,
    )


def fields_of(parts: Column, max_path: int | None = None) -> dict[str, Column]:
    """Typed fields of a captured line. Only `requested_at` and `response_size` can fail to convert.

    Paths are whole; with `max_path` they are cut to that many characters.
    """
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(parts[2]))
    size = parts[11]
    return {
        "ip_address": parts[0],
        "method": parts[7],
        "path": parts[8] if max_path is None else F.substring(parts[8], 1, max_path),
        "protocol": parts[9],
        "status_code": parts[10].cast("int"),
        "response_size": F.when(size == "-", F.lit(0).cast("long")).otherwise(size.try_cast("long")),
        "referer": F.nullif(parts[12], F.lit("-")),
        "user_agent": parts[13],
        # The wall clock as logged: the offset is checked above and then dropped.
        "requested_at": F.try_make_timestamp_ntz(
            parts[3].cast("int"),
            month.cast("int"),
            parts[1].cast("int"),
            parts[4].cast("int"),
            parts[5].cast("int"),
            parts[6].cast("decimal(8,6)"),
        ),
        "response_ms": parts[14].try_cast("long"),
    }
