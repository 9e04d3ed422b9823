"""Number expressions. Money is summed as decimal so that partition order cannot change a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def to_number(text: Column, kind: str = "double") -> Column:
    """Number or null; thousands separators are not accepted, as in the source rule."""
    return text.try_cast(kind)


def zero_if_missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null for a zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def packed(parts: Sequence[tuple[Column, int]]) -> Column:
    """Whole numbers as one fixed-width order key, decimal(38,0): it sorts as the numbers do one after another.

    Each part has its number of digits; only the last may be negative, with half of its range. A number
    with more digits fails, so no order is wrong silently. Aggregates over such a key keep hash buffers,
    where a struct would make them sort.
    """
    if sum(digits for _, digits in parts) > 38:
        raise ValueError("an order key has 38 digits at most")
    # neighbouring parts share a long where they fit
    longs: list[tuple[Column, int]] = []
    for value, digits in parts:
        checked = F.when(F.abs(value) >= 10**digits, F.raise_error(F.lit("order key: a number has too many digits"))).otherwise(value.cast("long"))
        if longs and longs[-1][1] + digits <= 18:
            before, width = longs.pop()
            longs.append((before * 10**digits + checked, width + digits))
        else:
            longs.append((checked, digits))
    behind, key = 0, F.lit(0).cast("decimal(38,0)")
    for value, digits in reversed(longs):
        weight = F.lit("1" + "0" * behind).cast(f"decimal({behind + 1},0)")
        key = (key + (value.cast(f"decimal({digits + 1},0)") * weight).cast("decimal(38,0)")).cast("decimal(38,0)")
        behind += digits
    return key


def fits_decimal(value: Column, precision: int, scale: int) -> Column:
    """Whether a number, rounded to ``scale``, has at most ``precision`` digits. A comparison
    with the first number that does not fit, so no cast has to fail for every misfit."""
    first_misfit = 10.0 ** (precision - scale) - 0.5 * 10.0**-scale
    return value.isNull() | F.coalesce(F.abs(value.try_cast("double")) < first_misfit, F.lit(False))


def fits_bytes(text: Column, limit: int) -> Column:
    return text.isNull() | (F.octet_length(text) <= limit)
