"""Number rules: text to number, clamping, ratio, power and load rate."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from feederlens.settings import UNUSABLE

# Text patterns of a number, blanks around it allowed, and of a whole number.
NUMBER_PATTERN = r"\A[\x00-\x20]*+[+-]?[0-9]++(?:\.[0-9]++)?[\x00-\x20]*+\z"
DIGITS_PATTERN = r"\A[0-9]+\z"
# Everything up to the blank counts as white space around a field.
WHITE_SPACE = "".join(chr(c) for c in range(0x21))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def usable(value: Column) -> Column:
    return value != F.lit(UNUSABLE)


def format_double(value: Column) -> Column:
    """Four decimals, half up; a magnitude above the largest storable value becomes that value."""
    return F.when(F.abs(value) > UNUSABLE, F.lit(UNUSABLE)).otherwise(F.round(value, 4))


def plain_number(text: Column) -> Column:
    """A text as a number: sign, digits and decimals only. NULL for anything else."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def measure(number: Column, text: Column) -> Column:
    """A measure from a text and its ``plain_number``; what is not a plain number is unusable.

    Same as ``format_double``, but rounding is left out where the text shows that it does nothing.
    """
    rounded = F.when(text.rlike(r"\.[0-9]{5}"), F.round(number, 4)).otherwise(number)
    return F.when(F.abs(number) <= UNUSABLE, rounded).otherwise(F.lit(UNUSABLE))


def ratio(text: Column) -> Column:
    """Transformer ratio: whole numbers only, everything else counts as 0."""
    bare = strip(text)
    number = F.when(bare.rlike(DIGITS_PATTERN), bare.try_cast("double"))
    return F.coalesce(number, F.lit(0.0))


def scaled(value: Column, factor: Column) -> Column:
    """Meter side to grid side. Only the upper end is clamped, as negative power is legal."""
    product = value * factor
    return F.when(usable(value) & (product < UNUSABLE), product).otherwise(F.lit(UNUSABLE))


def max_power(active: list[Column], reactive: list[Column]) -> Column:
    """Larger of the apparent power of the totals and of the phase sums; unusable ones are left out.

    Each list holds total, phase A, B, C on the grid side. Whether a candidate is usable is judged
    on the plain sum of its inputs, so a negative value can hide an unusable one.
    """
    p, pa, pb, pc = active
    q, qa, qb, qc = reactive
    total = F.when(p + q < UNUSABLE, F.sqrt(p * p + q * q))
    p_sum, q_sum = pa + pb + pc, qa + qb + qc
    phases = F.when(
        pa + pb + pc + qa + qb + qc < UNUSABLE, F.sqrt(p_sum * p_sum + q_sum * q_sum)
    )
    return F.coalesce(F.greatest(total, phases), F.lit(UNUSABLE))


def load_rate(power: Column, capacity: Column) -> Column:
    known = F.coalesce(capacity, F.lit(0.0))
    return F.when(
        (known != 0) & usable(power), format_double(power / F.nullif(known, F.lit(0.0)))
    ).otherwise(F.lit(UNUSABLE))
