"""String expressions of the cleaning step; all stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def strip(column: Column | str) -> Column:
    """Remove Unicode white space at both ends (plain trim knows only the space).

    Nearly all values start and end with a printable ASCII character and are passed through as they are.
    """
    text = F.col(column) if isinstance(column, str) else column
    clean_edges = F.substring(text, 1, 1).between("!", "~") & F.substring(text, -1, 1).between("!", "~")
    return F.when(clean_edges, text).otherwise(F.trim(text, F.lit(WHITE_SPACE)))


def contains_any(column: Column | str, markers: Sequence[str]) -> Column:
    """Case-insensitive "contains one of"; NULL stays NULL.

    Plain substring searches replace an alternation regex. A marker that contains another marker
    cannot add a match, so it is left out. The long s folds to s as it does in a regex.
    """
    text = F.lower(F.replace(F.col(column) if isinstance(column, str) else column, F.lit("ſ"), F.lit("s")))
    wanted = [m.lower() for m in markers]
    needed = [m for m in dict.fromkeys(wanted) if not any(o != m and o in m for o in wanted)]
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(m)) for m in needed])


#: The format whose full-width texts are cut by position, and the months as they stand in them.
POSITIONAL = "d/MMM/yyyy H:m:s"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _full_width(text: Column) -> Column:
    """Time of a dd/MMM/yyyy HH:mm:ss text of 20 characters by a cast of its digits, cheaper than a format; else NULL."""
    def at(place: int, width: int = 1) -> Column:
        return F.substring(text, place, width)

    month = F.try_element_at(F.create_map(*[F.lit(s) for i, m in enumerate(MONTHS) for s in (m, f"-{i + 1:02d}-")]), at(4, 3))
    shaped = (
        (F.octet_length(text) == 20) & (at(3) == "/") & (at(7) == "/") & (at(12) == " ") & (at(15) == ":") & (at(18) == ":")
        & at(8).between("1", "9") & at(20).between("0", "9")
    )
    return F.when(shaped, F.concat(at(8, 4), month, at(1, 2), at(12, 9)).try_cast("timestamp_ntz"))


def parse_time(column: Column | str, formats: Sequence[str]) -> Column:
    """First format that parses, as a zone-less timestamp; NULL if none does.

    The text is read as UTC and the instant counted from a zone-less epoch, so the session's zone has no say.
    """
    raw = F.col(column) if isinstance(column, str) else column
    text = strip(raw)

    def by_format(f: str) -> Column:
        instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{f} Z"))
        return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01").cast("timestamp_ntz"))

    return F.coalesce(*[c for f in formats for c in ([_full_width(raw)] if f == POSITIONAL else []) + [by_format(f)]])


def lenient_int(column: str, type_name: str) -> Column:
    """Whole number after stripping; anything else, or out of range, is NULL.

    The usual placeholders are tested first, because a failed cast is far dearer than a comparison.
    """
    return F.when(~F.col(column).isin("-", ""), strip(column).try_cast(type_name))
