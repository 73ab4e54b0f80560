"""Column expressions shared by the operators.

Rates follow the SQL rule (half away from zero) and are computed on integers,
so two engines agree on every digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# flag name -> source column; a flag is set when the column says 'OUI'
FLAGS = {
    "tms": "ind_lesion_tms",
    "psy": "ind_lesion_psy",
    "covid": "ind_lesion_covid_19",
    "surdite": "ind_lesion_surdite",
    "machine": "ind_lesion_machine",
}
BENCHMARK_FLAGS = ("tms", "psy", "machine", "surdite")


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def int_div(num, den) -> Column:
    """Integer quotient, NULL for a zero divisor (ANSI mode would raise)."""
    return F.call_function("div", as_col(num), F.nullif(as_col(den), F.lit(0)))


def ratio(num, den, scale: int = 1, places: int = 2) -> Column:
    """``round(scale * num / den, places)`` for non-negative integer columns."""
    num, den = as_col(num).cast("bigint"), as_col(den).cast("bigint")
    factor = 2 * scale * 10**places
    return (int_div(num * F.lit(factor).cast("bigint") + den, den * 2) / F.lit(10**places)).cast("double")


def percent(num, den) -> Column:
    """Share in percent with two decimals."""
    return ratio(num, den, scale=100, places=2)


def flag_count(name: str) -> Column:
    return F.count_if(F.col(FLAGS[name]) == "OUI")


def apart(column: Column) -> Column:
    """``column`` as it is, for a projection of many expressions.

    Spark fuses the steps between two shuffles into one method, and the JVM leaves a method of more than 8000 bytes
    uncompiled, which costs several times the work itself. A projection that holds a higher-order function is not fused:
    its expressions become many small methods.
    """
    return F.get(F.transform(F.array(column), lambda c: c), F.lit(0))


def row_count() -> Column:
    return F.count(F.lit(1))


def band(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose threshold the value exceeds."""
    out = None
    for limit, label in steps:
        hit = value > F.lit(limit)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def at_most(value: Column, high: float) -> Column:
    return F.least(F.lit(float(high)), value)


def truncate(value: Column) -> Column:
    """Drop the fraction (toward zero)."""
    return value.cast("bigint")


def change_pct(current: Column, previous: Column) -> Column:
    """Relative change in percent; 0 when there is no positive base."""
    return F.when(previous > 0, (current - previous) / previous * 100).otherwise(F.lit(0.0))


def contains_ci(column: str, text: str) -> Column:
    """Case-insensitive substring match; ``%`` and ``_`` stay wildcards."""
    return F.col(column).ilike(f"%{text}%")


def present(*items: Column) -> Column:
    """Array of the non-null items, in order."""
    return F.array_compact(F.array(*items))

