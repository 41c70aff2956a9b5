"""Null, number and text rules shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorfall.rules import NULL_TEXT, UNKNOWN_QUARTER


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """Double value; anything that is not a number, the text NaN included, is null."""
    return F.nullif(as_column(c).try_cast("double"), F.lit(float("nan")))


def whole(c: str | Column) -> Column:
    """Whole number from an id held as number or text ('4', '4.0')."""
    c = as_column(c)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def id_of(df: DataFrame, column: str) -> Column:
    """An id column as whole number, converted only where it is not one already."""
    if isinstance(df.schema[column].dataType, T.IntegralType):
        return F.col(column).cast("bigint")
    return whole(column)


def int_str(c: str | Column) -> Column:
    """Id as whole-number text; a missing id reads 'nan'."""
    return F.coalesce(whole(c).cast("string"), F.lit("nan"))


def text(c: str | Column) -> Column:
    """Text with one token for null, so that null keys survive grouping."""
    return F.coalesce(as_column(c).cast("string"), F.lit(NULL_TEXT))


def quarter_text(c: str | Column = "quarter_id") -> Column:
    return F.coalesce(as_column(c).cast("string"), F.lit(UNKNOWN_QUARTER))


# Doubles from here on have no fraction; below, a value is four limbs of 26 bits.
_WIDE = float(1 << 52)
_LIMB = 1 << 26


def exact_sum(c: str | Column) -> Column:
    """Sum of doubles that does not depend on their order, rounded once; null when every value is null.

    Each value is cut into its whole part and a fraction of 52 bits, two limbs
    each, and every limb is added up as a whole number: partial sums of any
    partitioning agree to the last bit, for 2^37 rows a group. What a value
    holds below 2^-52 is cut off, for each value alike. Values of 2^52 or more
    and non-finite ones are added in floating point.
    """
    x = as_column(c).cast("double")
    narrow = F.abs(x) < _WIDE
    units = F.floor(F.when(narrow, x))
    parts = F.floor((x - units) * _WIDE)
    limbs = [F.shiftright(units, 26), units.bitwiseAND(_LIMB - 1), F.shiftright(parts, 26), parts.bitwiseAND(_LIMB - 1)]
    a, b, c, d = (F.sum(limb).cast("decimal(19,0)") for limb in limbs)
    limb, whole_part = F.lit(_LIMB).cast("decimal(8,0)"), F.lit(_LIMB * _LIMB).cast("decimal(16,0)")
    fraction = c * limb + d
    carried = a * limb + b + F.call_function("div", fraction, whole_part)
    exact = carried.cast("double") + (fraction % whole_part).cast("double") / _WIDE
    wide = F.sum(F.when(~narrow, x))
    return F.when(wide.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + wide)


def filled_sum(c: str | Column) -> Column:
    """Exact sum that is 0, not null, when every value is null."""
    return F.coalesce(exact_sum(c), F.lit(0.0))


def grouped_sum(
    df: DataFrame,
    keys: Iterable[str],
    sums: Mapping[str, str | Column],
    keep_null: Iterable[str] = (),
) -> DataFrame:
    """Group and add up; rows with a null key drop out, all-null groups give 0.

    Keys in ``keep_null`` may be null. Spark adds up on the map side first, so
    one key holding a large share of the rows is a single row per task by the
    time it is shuffled.
    """
    keys = list(keys)
    keep = set(keep_null)
    return (
        df.dropna(subset=[k for k in keys if k not in keep])
        .groupBy(*keys)
        .agg(*[filled_sum(c).alias(name) for name, c in sums.items()])
    )


def left_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], null_safe: bool = False) -> DataFrame:
    """Left equi-join; ``on`` maps left to right columns, which drop out.

    Carries no broadcast hint: Catalyst broadcasts a right side whose size is
    known to be under the threshold and otherwise shuffles, with adaptive
    execution splitting skewed keys. ``null_safe`` lets null match null.
    """
    renamed = right.withColumnsRenamed({r: f"__{r}" for r in on.values()})
    condition = F.lit(True)
    for l, r in on.items():
        a, b = left[l], renamed[f"__{r}"]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return left.join(renamed, condition, "left").drop(*[f"__{r}" for r in on.values()])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every text column."""
    return df.replace("", None, subset=string_columns(df) or None)


def fill_zero(df: DataFrame) -> DataFrame:
    """Every null becomes 0, or '0' in text columns."""
    numbers = {c: F.coalesce(df[f"`{c}`"], F.lit(0).cast(df.schema[c].dataType)) for c in numeric_columns(df)}
    words = {c: F.coalesce(df[f"`{c}`"], F.lit("0")) for c in string_columns(df)}
    return df.withColumns({**numbers, **words})
