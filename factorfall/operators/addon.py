"""Add-on RWA: exposures that bypass the factor waterfall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions.quarters import projected_month, projected_year
from factorfall.functions.rwa import erba_rwa
from factorfall.functions.values import grouped_sum
from factorfall.operators.outlook import quarter_join

ADDON_DIMS = (
    "quarter_id",
    "seg_l4_desc",
    "seg_l3_desc",
    "seg_l2_desc",
    "geo_l4_desc",
    "geo_l3_desc",
    "pmf_l5",
    "seg_l4_code",
    "seg_l3_code",
    "seg_l2_code",
    "exposure_type",
)
_AMOUNTS = {"sa_rwa_amt": "sa_rwa_amt", "adv_rwa_amt": "adv_rwa_amt"}


def projected_quarter_parse(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Quarter id from the projected quarter ('3Q25'), replacing the source's own."""
    dated = rows.drop("quarter_id").withColumns(
        {"year": projected_year("projected_quarter"), "month": projected_month("projected_quarter")}
    )
    return quarter_join(dated, calendar)


def markets_addon_sum(markets: DataFrame) -> DataFrame:
    """Amounts per add-on grain; an unknown quarter is a group of its own."""
    return grouped_sum(markets, ("entity", *ADDON_DIMS), _AMOUNTS, keep_null=("quarter_id",))


def addon_sum(rows: DataFrame) -> DataFrame:
    """Amounts per add-on grain, with ERBA RWA and an empty comment."""
    return markets_addon_sum(rows).withColumns({"erba_rwa": erba_rwa("sa_rwa_amt"), "comment": F.lit("")})


def concat_addon(markets: DataFrame, non_waterfall: DataFrame) -> DataFrame:
    return markets.unionByName(non_waterfall, allowMissingColumns=True)


def addon_rows(rows: DataFrame) -> DataFrame:
    """Markets and non-waterfall rows in one pass over the exposures.

    The buckets differ in segment, which is part of the add-on grain, so
    summing them together equals summing them apart.
    """
    account = F.col("pmf_l5")
    return rows.filter(
        (F.col("seg_l2_desc") == rules.MARKETS_L2) | account.isNull() | ~account.isin(*rules.FACTOR_ACCOUNTS)
    )


def rename_addon(addon: DataFrame) -> DataFrame:
    """Exposure names to outlook names; older columns under those names drop out."""
    renames = {
        "adv_rwa_amt": "aa_rwa",
        "sa_rwa_amt": "sa_rwa",
        "seg_l4_code": "seg_l4_id",
        "seg_l3_code": "seg_l3_id",
        "seg_l2_code": "seg_l2_id",
    }
    renames = {old: new for old, new in renames.items() if old in addon.columns}
    return addon.drop(*renames.values()).withColumnsRenamed(renames)
