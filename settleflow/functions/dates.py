"""Date and time functions. Patterns are Java patterns; ``to_char`` takes warehouse patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the run stamps.
RUN_STAMP = "yyyyMMddHHmmss"
FILE_STAMP = "MMddyyyyHHmmss"

# Warehouse pattern elements and the Java pattern letters of the same meaning.
WAREHOUSE_PATTERN = {
    "YYYY": "yyyy",
    "YY": "yy",
    "MM": "MM",
    "DD": "dd",
    "HH24": "HH",
    "HH12": "hh",
    "HH": "HH",
    "MI": "mm",
    "SS": "ss",
}


def java_pattern(pattern: str) -> str:
    """Warehouse date pattern as a Java pattern; anything else stands for itself."""
    out, at = "", 0
    longest_first = sorted(WAREHOUSE_PATTERN, key=len, reverse=True)
    while at < len(pattern):
        element = next((e for e in longest_first if pattern.startswith(e, at)), None)
        if element:
            out, at = out + WAREHOUSE_PATTERN[element], at + len(element)
        else:
            letter = pattern[at]
            out, at = out + (f"'{letter}'" if letter.isalpha() else letter), at + 1
    return out


def format_date(pattern: str, c: Column) -> Column:
    return F.date_format(c, pattern)


def now() -> Column:
    """Time of the query, the same for all its rows."""
    return F.current_timestamp()


def get_date(pattern: str, at: Column | None = None) -> Column:
    """The present time (or ``at``) as text."""
    return F.date_format(now() if at is None else at, pattern)


def parse_date(pattern: str, c: Column) -> Column:
    """Text to timestamp; bad text raises."""
    return F.to_timestamp(c, pattern)


def to_timestamp(c: Column, pattern: str) -> Column:
    return F.to_timestamp(c, java_pattern(pattern))


def try_to_timestamp(c: Column, pattern: str) -> Column:
    """Text to timestamp; bad text is NULL."""
    return F.try_to_timestamp(c, F.lit(java_pattern(pattern)))


def to_date(c: Column, pattern: str) -> Column:
    return F.to_date(c, java_pattern(pattern))


def to_char(c: Column, pattern: str) -> Column:
    return F.date_format(c, java_pattern(pattern))


def convert_tz(source: str, target: str, c: Column) -> Column:
    """Wall-clock time of zone ``source`` as wall-clock time of zone ``target``."""
    return F.convert_timezone(F.lit(source), F.lit(target), c.cast("timestamp_ntz"))


def run_stamp(at: Column | None = None) -> Column:
    return get_date(RUN_STAMP, at)


def file_stamp(at: Column | None = None) -> Column:
    return get_date(FILE_STAMP, at)
