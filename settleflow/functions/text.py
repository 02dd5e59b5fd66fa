"""String functions. Every function takes and returns columns; none leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A network id stands between an underscore and an underscore or a dot; a routed
# file carries its position in front of its name.
NETWORK_ID = r"[_](\d{3,6})[_.]"
SEQUENCE_PREFIX = r"^\d+\."


def text(c: Column) -> Column:
    return c.cast("string")


def trim(c: Column) -> Column:
    return F.trim(text(c))


def right(c: Column, n: int) -> Column:
    return F.right(text(c), F.lit(n))


def left(c: Column, n: int) -> Column:
    return F.left(text(c), F.lit(n))


def length(c: Column) -> Column:
    return F.char_length(text(c))


def substr(c: Column, start: int, size: int) -> Column:
    """``size`` characters from the 1-based position ``start``."""
    return F.substr(text(c), F.lit(start), F.lit(size))


def index(c: Column, part: str) -> Column:
    """1-based position of ``part``, 0 when absent."""
    return F.instr(text(c), part)


def upcase(c: Column) -> Column:
    return F.upper(text(c))


def downcase(c: Column) -> Column:
    return F.lower(text(c))


def change(c: Column, old: str, new: str) -> Column:
    """Replace every literal ``old``."""
    return F.replace(text(c), F.lit(old), F.lit(new))


def equals(c: Column, other) -> Column:
    return c == other


def contains(c: Column, part: str) -> Column:
    """Literal containment; wildcards in ``part`` have no meaning."""
    return c.contains(part)


def starts_with(c: Column, part: str) -> Column:
    return c.startswith(part)


def ends_with(c: Column, part: str) -> Column:
    return c.endswith(part)


def replace_all(c: Column, pattern: str, new: str) -> Column:
    """Replace every match of a regular expression."""
    return F.regexp_replace(c, pattern, new)


def replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def is_empty(c: Column) -> Column:
    return c == F.lit("")


def lpad(c: Column, size: int, pad: str) -> Column:
    """Pad on the left to ``size``; a longer value is cut to it."""
    return F.lpad(text(c), size, pad)


def quoted(separator: str) -> str:
    """A separator as a regular expression that matches it literally.

    One character, escaped at most, is split without compiling a pattern for every row.
    """
    if len(separator) == 1:
        return "\\" + separator if separator in ".$|()[{^?*+\\" else separator
    return "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split(c: Column, separator: str) -> Column:
    """Pieces between literal separators, trailing empty ones included."""
    return F.split(c, quoted(separator), -1)


def element(pieces: Column, position: int) -> Column:
    """1-based element, NULL when out of range."""
    return F.get(pieces, F.lit(position - 1))


def concat(*parts: Column) -> Column:
    """Concatenation; NULL when any part is."""
    return F.concat(*[text(part) for part in parts])


def network_id(name: Column) -> Column:
    """Network id inside a file name, NULL when there is none."""
    return F.nullif(F.regexp_extract(name, NETWORK_ID, 1), F.lit(""))


def strip_prefix(name: Column) -> Column:
    """File name without its routing position."""
    return F.regexp_replace(name, SEQUENCE_PREFIX, "")


def mask_pattern(mask: str) -> str:
    """A shell-style file mask as an anchored regular expression."""
    out = []
    rest = mask
    while rest:
        head, rest = rest[0], rest[1:]
        end = rest.find("]", 2 if rest.startswith("!") else 1) if head == "[" else -1
        if head == "*":
            out.append(".*")
        elif head == "?":
            out.append(".")
        elif end > 0:
            body, rest = rest[:end], rest[end + 1 :]
            body = "^" + body[1:] if body.startswith("!") else body
            out.append("[" + body.replace("\\", "\\\\").replace("[", "\\[") + "]")
        else:
            out.append(quoted(head))
    return "(?s)^" + "".join(out) + "$"


def mask_match(name: Column, mask: str) -> Column:
    return name.rlike(mask_pattern(mask))


def json_property(c: Column, key: str) -> Column:
    """Property of a JSON text: the exact key, else its lower case, else the empty string."""
    fields = F.from_json(c, "map<string,string>")
    return F.coalesce(fields[key], fields[key.lower()], F.lit(""))
