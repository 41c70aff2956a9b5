"""Types of text columns that no schema declares.

The types form a small lattice: a column has the narrowest type that holds
every filled value, and text when none does. What decides is one row of counts
per table, so counts of several files or runs add up to those of all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
_NUMBER = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]{1,3})?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
_EXACT_DIGITS = 17

# Narrowest first.
LATTICE: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "whole": T.LongType(),
    "decimal": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def filled(c: Column) -> Column:
    """Whether a text holds anything but blanks."""
    return F.coalesce(F.trim(c) != "", F.lit(False))


def fits(c: Column) -> dict[str, Column]:
    """Per type of the lattice, whether a text is a value of it that reads back as written.

    Numbers with leading zeros (codes) and numbers with more digits than the
    type holds are no numbers here.
    """
    v = F.trim(c)
    mantissa = F.split_part(F.lower(v), F.lit("e"), F.lit(1))
    digits = F.length(F.ltrim(F.regexp_replace(mantissa, "[^0-9]", ""), F.lit("0")))
    whole = v.rlike(_WHOLE)
    return {
        "boolean": F.lower(v).isin("true", "false"),
        "whole": whole & v.try_cast("bigint").isNotNull(),
        "decimal": v.rlike(_NUMBER) & (digits <= _EXACT_DIGITS) & (F.abs(v.try_cast("double")) < float("inf")),
        "date": v.rlike(_DATE) & v.try_cast("date").isNotNull(),
        "timestamp": v.rlike(_TIME) & v.try_cast("timestamp").isNotNull(),
    }


def type_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: per column its filled values and, per type, how many of them fit.

    Only the named columns are read; tables of one row can be merged with
    ``merge_counts``.
    """
    aggregates = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        aggregates.append(F.count(F.when(filled(c), 1)).alias(f"n{i}"))
        aggregates += [F.count(F.when(filled(c) & fit, 1)).alias(f"{kind}{i}") for kind, fit in fits(c).items()]
    return df.agg(*aggregates)


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counts of two tables with the same columns to those of both together."""
    return a.unionByName(b).agg(*[F.sum(c).alias(c) for c in a.columns])


def choose(counts: dict[str, int], columns: Sequence[str]) -> T.StructType:
    """Counts to types; a column without a filled value, or of mixed kinds, is text."""

    def kind(i: int) -> T.DataType:
        n = counts[f"n{i}"]
        whole_column = [t for name, t in LATTICE.items() if n and counts[f"{name}{i}"] == n]
        return whole_column[0] if whole_column else T.StringType()

    return T.StructType([T.StructField(c, kind(i)) for i, c in enumerate(columns)])


def infer_types(df: DataFrame, columns: Sequence[str]) -> T.StructType:
    """Types of text columns from one aggregation over all of them; no pass for no columns."""
    if not columns:
        return T.StructType([])
    return choose(type_counts(df, columns).first().asDict(), columns)
