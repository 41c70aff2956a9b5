"""Risk-weight factors, RWA amounts and row labels as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions.values import as_column, number


def capped_ratio(rwa: str | Column, gaap: str | Column) -> Column:
    """RWA over balance; beyond the cap, or over a zero balance, it is 1.

    0 over 0 has no factor.
    """
    r, g = number(rwa), number(gaap)
    ratio = F.try_divide(r, g)
    return (
        F.when(g == 0, F.when(r != 0, F.lit(1.0)))
        .when(F.abs(ratio) > rules.RWF_CAP, F.lit(1.0))
        .otherwise(ratio)
    )


def first_valid(columns: Iterable[str | Column]) -> Column:
    """First number from left to right; 0 counts, null and text do not."""
    return F.coalesce(*[number(c) for c in columns])


def projected_rwa(factor: str | Column) -> Column:
    """Balance times factor; 0 for accounts without credit risk."""
    return F.when(F.col("pmf_l5").isin(*rules.ZERO_RWA_ACCOUNTS), F.lit(0.0)).otherwise(
        number("balances") * as_column(factor)
    )


def erba_rwa(sa: str | Column) -> Column:
    """SA RWA in the ERBA quarters, else null."""
    return F.when(F.col("quarter_id").isin(*rules.ERBA_QUARTERS), as_column(sa))


def reporting_layer() -> Column:
    legacy = F.col("seg_l3_desc") == rules.LEGACY_FRANCHISES_L3
    return (
        F.when(legacy & (F.col("seg_l4_desc") == rules.LEGACY_HOLDINGS_L4), rules.LAYER_HOLDINGS)
        .when(legacy, rules.LAYER_HOLDINGS_OTHER)
        .when(F.col("geo_l3_desc") == rules.LATIN_AMERICA_L3, rules.LAYER_LATIN_AMERICA)
        .otherwise(rules.LAYER_NON_LEGACY)
    )


def markets_filter() -> Column:
    """Keep, unless a Markets row carries an exposure type."""
    markets = F.col("seg_l2_desc") == rules.MARKETS_L2
    return F.when(markets & ~F.col("exposure_type").eqNullSafe("0"), "Remove").otherwise("Keep")


def upload_account() -> Column:
    """Account number by calc, with the default where the mapping had none."""

    def mapped(column: str, default: str) -> Column:
        return F.when(F.col(column) == rules.NULL_TEXT, default).otherwise(F.col(column))

    return (
        F.when(F.col("rwa_calc") == "AA", mapped("aa_account", rules.DEFAULT_AA_ACCOUNT))
        .when(F.col("rwa_calc") == "SA", mapped("sa_account", rules.DEFAULT_SA_ACCOUNT))
        .otherwise(rules.NO_ACCOUNT)
    )


def entity_code() -> Column:
    code = F.when(F.lit(False), F.lit(""))
    for entity in rules.ENTITIES:
        code = code.when(F.col("entity") == entity.name, entity.code)
    return code
