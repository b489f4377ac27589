"""Column expressions for dates, signs, clamps, months and repeatable draws."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockflow.contract import INBOUND


def as_date(value: str | date) -> date:
    """An ISO text or a date as a date; a text that is no date raises."""
    return value if isinstance(value, date) else date.fromisoformat(value)


def at_least_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast("bigint"))


def is_inbound() -> Column:
    return F.col("shipment_type") == INBOUND


def event_priority() -> Column:
    """Arrivals of a day come before its departures."""
    return F.when(is_inbound(), 0).otherwise(1)


def signed_quantity() -> Column:
    planned = F.col("planned_pallet_quantity")
    return F.when(is_inbound(), planned).otherwise(-planned)


def month_key(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def percentage(part: str, whole: str) -> Column:
    """Count column `part` in percent of count column `whole`, rounded half up to 2 digits.

    The rounding is done on integers, so the value is the same on every engine.
    """
    return F.expr(f"(({part} * 20000 + {whole}) div ({whole} * 2)) / 100.0D")


def count_up_to(entries: str, value: str) -> str:
    """SQL for how many entries of an ascending array are at most `value`, found by halving.

    Twenty steps do for a million entries.
    """
    steps = ", ".join(str(1 << k) for k in reversed(range(20)))
    here = f"n + step <= size({entries}) AND element_at({entries}, if(n + step <= size({entries}), n + step, 1)) <= {value}"
    return f"aggregate(array({steps}), 0, (n, step) -> if({here}, n + step, n))"


# Fixed values of the repeatable draw: a prime modulus below 2**31 and two factors below 2**30
# and 2**31. Each sum of products stays below 2**63, so the draw is plain bigint arithmetic.
DRAW_MODULUS = 2147483647
DRAW_FACTOR = 1073741789
DRAW_STEP = 1013904223


def draw_start(seed: int, purpose: int) -> int:
    """What seed and purpose add to a draw, reduced here, as a seed may be of any size."""
    return (seed * 7919 + purpose) * DRAW_STEP % DRAW_MODULUS


def draw(number: Column, seed: int, purpose: int, size: int) -> Column:
    """A value in 0..size-1 that depends only on `number`, `seed` and `purpose`.

    It needs no order and no random state, so a lost task recomputes the same rows. Both
    halves of a 64-bit number count.
    """
    number = number.cast("bigint")
    low = F.pmod(number, F.lit(DRAW_MODULUS).cast("bigint"))
    high = F.pmod(F.shiftright(number, 31), F.lit(DRAW_MODULUS).cast("bigint"))
    first = (low * DRAW_FACTOR + high * DRAW_STEP + draw_start(seed, purpose)) % DRAW_MODULUS
    second = (first * first + DRAW_STEP * purpose) % DRAW_MODULUS
    return (second % size).cast("int")


def text_number(text: str) -> Column:
    """A number below 2**32 from any text: the first eight digits of its MD5 digest."""
    return F.conv(F.substring(F.md5(F.col(text).cast("binary")), 1, 8), 16, 10).cast("bigint")


def pick(values: list, index: Column) -> Column:
    """The entry of a literal list at a 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)
