"""Text expressions: whitespace, name spacing, byte cleanup and file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The well-formed UTF-8 sequences of the Unicode standard (table 3-7), as
# characters of ISO-8859-1, which maps every byte to one character.
WELL_FORMED_UTF8 = (
    r"[\x00-\x7F]"
    r"|[\xC2-\xDF][\x80-\xBF]"
    r"|\xE0[\xA0-\xBF][\x80-\xBF]"
    r"|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}"
    r"|\xED[\x80-\x9F][\x80-\xBF]"
    r"|\xF0[\x90-\xBF][\x80-\xBF]{2}"
    r"|[\xF1-\xF3][\x80-\xBF]{3}"
    r"|\xF4[\x80-\x8F][\x80-\xBF]{2}"
)
MEMBER_SUFFIX = ".txt"
SKIPPED_PREFIXES = ("size", "stat")


def strip(text: Column) -> Column:
    """Trim every kind of Unicode whitespace, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_spaces(text: Column) -> Column:
    """Trim, and turn each run of whitespace into one blank."""
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def is_blank(text: Column) -> Column:
    """True for null, empty or whitespace-only text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def space_out(text: Column) -> Column:
    """Put blanks around brackets, slashes and plus signs."""
    return F.regexp_replace(text, r"([()/+])", " $1 ")


def drop_bad_bytes(content: Column) -> Column:
    """Decode UTF-8 bytes, leaving out each byte that belongs to no valid character.

    Spark marks bad bytes with U+FFFD, which is then removed. Only a text that
    holds this character itself needs the slower pattern over single bytes.
    """
    text = content.cast("string")
    marked = F.replace(F.make_valid_utf8(text), F.lit("\uFFFD"), F.lit(""))
    byte_chars = F.decode(content, "ISO-8859-1")
    kept = F.regexp_replace(byte_chars, f"(?s)({WELL_FORMED_UTF8})|.", "$1")
    repaired = F.encode(kept, "ISO-8859-1").cast("string")
    return (
        F.when(F.is_valid_utf8(text), text)
        .when(~F.contains(text, F.lit("\uFFFD")), marked)
        .otherwise(repaired)
    )


def base_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def logical_file(path: Column) -> Column:
    """Lower-cased name of the text file a path belongs to.

    A "file" may also be a folder of part files that Spark wrote under that
    name, plain (``demo24q1.txt/part-0``) or as a partition
    (``file=demo24q1.txt/part-0``).
    """
    pattern = r"(?i)(?:^|[/=])([^/=]+\.txt)(?:/[^/]*)?$"
    return F.lower(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")))


def is_report_member(name: Column) -> Column:
    """True for archive members that hold report rows (by base name)."""
    lowered = F.lower(name)
    return (
        lowered.endswith(MEMBER_SUFFIX)
        & ~F.substring(lowered, 1, 4).isin(*SKIPPED_PREFIXES)
        & ~name.startswith(".")
    )


def table_of(file: Column, tables: Sequence[str]) -> Column:
    """Table a file belongs to (its first four characters), null if unknown."""
    prefix = F.substring(file, 1, 4)
    return F.when(prefix.isin(*tables), prefix)


def period_of_file(file: Column) -> Column:
    """``yyqN`` from a report file name, null if the name holds none."""
    found = F.regexp_extract(file, r".*([0-9][0-9][Qq][0-9])\.txt", 1)
    return F.lower(F.nullif(found, F.lit("")))


def split_list(text: Column) -> Column:
    """Comma-separated text to an array of trimmed items."""
    return F.transform(F.split(text, ","), strip)
