"""Column expressions: everything here stays inside the JVM and inside one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline import names


def quoted(name: str) -> str:
    """A column name as SQL text, dots and spaces included."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Reference a column by its literal name, dots and spaces included."""
    return F.col(quoted(name))


def finite(value: Column) -> Column:
    """NaN and infinities are missing; `percentile` would otherwise sort NaN in as a value."""
    v = value.cast("double")
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def clip(value: Column, low, high) -> Column:
    """Limit to [low, high]; missing stays missing, and a missing bound does not limit."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def robust_z(value: Column, n: Column, quartiles: Column) -> Column:
    """(x - median) / (IQR / 1.35) from the group's count and its [q1, median, q3].

    Fewer than two observations give no score. A zero IQR gives 0.0 for the whole group, also where
    the value itself is missing.
    """
    q1, median, q3 = (F.get(quartiles, F.lit(i)) for i in range(3))
    spread = q3 - q1
    return F.when(n >= 2, F.when(spread == 0, F.lit(0.0)).otherwise(
        F.try_divide(value - median, spread / F.lit(names.IQR_TO_SIGMA))))


def blend(self_z: Column, peer_z: Column, limit: float = names.Z_CLIP) -> Column:
    """Average of both scores, or the one that is there; limited after averaging."""
    return clip(F.coalesce((self_z + peer_z) / F.lit(2.0), self_z, peer_z), -limit, limit)


def mean_abs_present(columns: Sequence[Column]) -> Column:
    """Mean absolute value over the columns that are not missing; missing if all are."""
    present = count_present(columns)
    total = total_of([F.coalesce(F.abs(c), F.lit(0.0)) for c in columns])
    return F.when(present > 0, total / F.greatest(present, F.lit(1)).cast("double"))


def count_present(columns: Sequence[Column]) -> Column:
    return total_of([c.isNotNull().cast("int") for c in columns])


def total_of(columns: Sequence[Column]) -> Column:
    """Sum as a balanced tree, so hundreds of terms do not nest hundreds deep."""
    terms = list(columns)
    while len(terms) > 1:
        terms = [sum(terms[i + 1:i + 2], terms[i]) for i in range(0, len(terms), 2)]
    return terms[0]


def largest_by_magnitude(named: Sequence[tuple[str, Column]], n: int) -> Column:
    """Array of the n entries (name, value) with the largest |value|; ties go to the earlier name.

    The entries are ordered inside the row by (-|value|, position), so nothing is exploded.
    """
    entries = [
        F.when(value.isNotNull(), F.struct(
            (-F.abs(value)).alias("rank_key"), F.lit(i).alias("position"),
            F.lit(name).alias("name"), value.alias("value")))
        for i, (name, value) in enumerate(named)
    ]
    return F.slice(F.sort_array(F.array_compact(F.array(*entries))), 1, n)


def number_text(value: Column, digits: int = 4) -> Column:
    """Shortest decimal text of a rounded number: 8.0, -1.25, 0.0005 (never 5.0E-4)."""
    fixed = F.round(value, digits).try_cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")


def driver_label(value: Column, limit: float = names.Z_CLIP) -> Column:
    side = F.when(value > 0, F.lit(names.ABOVE)).otherwise(F.lit(names.BELOW))
    reach = F.when(F.abs(value) >= limit, F.lit(names.FAR)).otherwise(F.lit(""))
    return F.concat(reach, side, F.lit(names.BASELINE), number_text(value), F.lit(")"))


def driver_summary(slots: Sequence[int]) -> Column:
    """"name: label" of every filled driver slot, joined by " | "; empty when no slot is filled."""
    parts = [
        F.concat(F.col(f"top_driver_{i}"), F.lit(": "), driver_label(F.col(f"top_driver_{i}_value")))
        for i in slots
    ]
    return F.concat_ws(" | ", *parts)


def safe_name(name: Column) -> Column:
    """Lower-case identifier: other characters become "_", a leading digit gets the prefix f_."""
    plain = F.regexp_replace(F.lower(name), names.UNSAFE, "_")
    return F.when(plain.rlike("^[0-9]"), F.concat(F.lit(names.DIGIT_PREFIX), plain)).otherwise(plain)


def day_of(date: Column) -> Column:
    """Date of a date, timestamp or ISO date text; missing where the text is no date."""
    return F.try_to_date(date.cast("string"))


def calendar_quarter(date: Column) -> Column:
    """Quarter text such as 2024Q1 of a date, timestamp or ISO date text; missing for other text."""
    day = day_of(date)
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def split_list(text: Column) -> Column:
    """Comma-separated text to an array of trimmed entries."""
    return F.transform(F.split(text, ","), lambda s: F.trim(s))
