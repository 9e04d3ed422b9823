"""Text expressions. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_code(code: Column, width: int) -> Column:
    """Left-pad with zeros; longer codes are kept whole."""
    text = code.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def strip_chars(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def drop_unit(text: Column) -> Column:
    """Trimmed text without its last character (a percent sign or another unit)."""
    trimmed = F.trim(text)
    return F.substring(trimmed, F.lit(1), F.greatest(F.length(trimmed) - 1, F.lit(0)))


def split_last(text: Column, separator: str) -> Column:
    """Piece after the last separator."""
    return F.substring_index(text, separator, -1)


def split_part(text: Column, index: int, separator: str = " ") -> Column:
    return F.get(F.split(text, f"\\Q{separator}\\E"), F.lit(index))


def strip_label(text: Column, label: str) -> Column:
    """Value after the last occurrence of its label."""
    return F.substring_index(text, label, -1)


def truncate_bytes(text: Column, limit: int) -> Column:
    """Longest prefix of at most ``limit`` UTF-8 bytes that does not cut a character.

    A character is cut when the byte after the cut is a continuation byte (80-BF), so the
    cut moves back by at most three bytes.
    """
    raw = text.cast("binary")
    low, high = F.unhex(F.lit("80")), F.unhex(F.lit("BF"))
    starts = lambda at: ~F.substring(raw, at, 1).between(low, high)
    cut = (
        F.when(starts(limit + 1), limit)
        .when(starts(limit), limit - 1)
        .when(starts(limit - 1), limit - 2)
        .otherwise(limit - 3)
    )
    head = F.substring(raw, F.lit(1), F.greatest(cut, F.lit(0))).cast("string")
    return F.when(F.octet_length(text) <= limit, text).otherwise(head)


def type_text(base: Column, length: Column, precision: Column, scale: Column) -> Column:
    """Render a column type: CHAR types with their length, NUMBER with precision and scale."""
    scaled = F.when(scale > 0, F.concat(F.lit(","), scale.cast("string"))).otherwise("")
    number = F.concat(base, F.lit("("), precision.cast("string"), scaled, F.lit(")"))
    return (
        F.when(
            base.isin("VARCHAR2", "CHAR"),
            F.concat(base, F.lit("("), length.cast("string"), F.lit(")")),
        )
        .when((base == "NUMBER") & precision.isNotNull(), number)
        .otherwise(base)
    )


def yes_no(flag: Column) -> Column:
    return F.when(flag, "YES").otherwise("NO")
