"""The coarse SQL-style steps: first key only, no adjustments, SQL null rules.

Unlike the full run, rows with null group keys keep their group, a sum of nulls
is null, and rows without an account or segment are in no add-on bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions.rwa import capped_ratio, erba_rwa
from factorfall.functions.values import whole
from factorfall.operators import convergence as C
from factorfall.operators import outlook as O
from factorfall.operators.controls import control_summary
from factorfall.operators.upload import upload_pivot_sql
from factorfall.session import stage_table

# What the steps read of an exposure row.
ROW_COLUMNS = (
    "entity", "quarter_id", "seg_l4_code", "geo_l4_desc", "pmf_l5", "seg_l2_desc", "gaap_amt", "sa_rwa_amt", "adv_rwa_amt",
)
FACTOR_DIMS = ("entity", "quarter_id", "seg_l4_code", "geo_l4_desc", "pmf_l5", "seg_l2_desc")


def lateral_unpivot(balance_sheet: DataFrame) -> DataFrame:
    """Balances per grain and month; null keys are groups here."""
    sums = [F.sum(cols[-1]).alias(label) for label, cols in rules.BALANCE_PERIODS.items()]
    return O.melt_balances(balance_sheet.groupBy(*O.OUTLOOK_DIMS).agg(*sums))


def key1_factors(rows: DataFrame) -> DataFrame:
    sums = C.split_credit_risk(rows).groupBy(*FACTOR_DIMS).agg(
        *[F.sum(a).alias(a) for a in ("gaap_amt", "sa_rwa_amt", "adv_rwa_amt")]
    )
    keep = ~F.coalesce(F.col("seg_l2_desc") == rules.MARKETS_L2, F.lit(False))
    return sums.withColumns(
        {
            "sa_rwf": F.when(keep, capped_ratio("sa_rwa_amt", "gaap_amt")),
            "aa_rwf": F.when(keep, capped_ratio("adv_rwa_amt", "gaap_amt")),
        }
    )


def outlook_with_keys(long: DataFrame, calendar: DataFrame) -> DataFrame:
    dated = O.quarter_join(long, calendar)
    parts = [whole("seg_l4_id"), F.col("geo_l4_desc"), F.col("pmf_l5"), F.col("quarter_id")]
    return dated.withColumn("key1", F.concat(*[p.cast("string") for p in parts]))


def outlook_with_rwf(keyed: DataFrame, lookup: DataFrame) -> DataFrame:
    right = lookup.select(
        F.col("entity").alias("__e"),
        F.col("quarter_id").alias("__q"),
        whole("seg_l4_code").alias("__s"),
        F.col("geo_l4_desc").alias("__g"),
        F.col("pmf_l5").alias("__p"),
        F.col("sa_rwf").alias("final_sa_rwf"),
        F.col("aa_rwf").alias("final_aa_rwf"),
    )
    condition = (
        (F.col("entity") == F.col("__e"))
        & (F.col("quarter_id") == F.col("__q"))
        & (whole("seg_l4_id") == F.col("__s"))
        & (F.col("geo_l4_desc") == F.col("__g"))
        & (F.col("pmf_l5") == F.col("__p"))
    )
    return keyed.join(right, condition, "left").drop("__e", "__q", "__s", "__g", "__p")


def addon_sum_sql(rows: DataFrame) -> DataFrame:
    """Both add-on buckets at (entity, quarter, segment, account) grain, by the source quarter."""
    markets = F.col("seg_l2_desc") == rules.MARKETS_L2
    other = ~F.col("pmf_l5").isin(*rules.FACTOR_ACCOUNTS) & (F.col("seg_l2_desc") != rules.MARKETS_L2)
    sums = (
        rows.filter(markets | other)
        .groupBy("entity", "quarter_id", "seg_l2_desc", "pmf_l5")
        .agg(F.sum("sa_rwa_amt").alias("sa_rwa_amt"), F.sum("adv_rwa_amt").alias("aa_rwa_amt"))
    )
    return sums.withColumn("erba_rwa", erba_rwa("sa_rwa_amt"))


def frm_base(outlook: DataFrame, addon: DataFrame) -> DataFrame:
    dims = ["entity", "quarter_id", "seg_l4_desc", "seg_l3_desc", "seg_l2_desc", "pmf_l5"]
    amounts = ["sa_rwa", "aa_rwa", "erba_rwa"]
    top = outlook.select(*dims, *[F.col(a).cast("double").alias(a) for a in amounts], F.lit("outlook").alias("source"))
    named = addon.withColumnsRenamed({"sa_rwa_amt": "sa_rwa", "aa_rwa_amt": "aa_rwa"})
    bottom = named.select(
        *[c for c in dims if c in named.columns],
        *[F.col(a).cast("double").alias(a) for a in amounts],
        F.lit("addon").alias("source"),
    )
    return top.unionByName(bottom, allowMissingColumns=True)


def summary_steps(
    convergence: DataFrame, balance_sheet: DataFrame, calendar: DataFrame, quarters: list[int], staged: bool = False
) -> dict[str, DataFrame]:
    """Every step by name, in order; each builds on the ones before.

    ``staged`` writes what several steps read: the entity rows of the exposures,
    with the columns the steps use, and each step that another one builds on.
    The two large inputs are then read once, whatever is asked of the steps.
    """
    keep = stage_table if staged else lambda df, name: df
    rows = keep(C.by_entity(convergence).select(*ROW_COLUMNS), "rows")
    steps = {
        "conv_credit_risk": C.split_credit_risk(rows),
        "conv_markets_addon": C.split_markets_addon(rows),
        "conv_non_waterfall": rows.filter(
            ~F.col("pmf_l5").isin(*rules.FACTOR_ACCOUNTS) & (F.col("seg_l2_desc") != rules.MARKETS_L2)
        ),
        "waterfall_rwf": keep(key1_factors(rows), "waterfall_rwf"),
        "outlook_long": keep(lateral_unpivot(balance_sheet), "outlook_long"),
    }
    steps["outlook_with_keys"] = outlook_with_keys(steps["outlook_long"], calendar)
    steps["outlook_with_rwf"] = outlook_with_rwf(steps["outlook_with_keys"], steps["waterfall_rwf"])
    steps["projected_rwa"] = keep(O.project_rwa(steps["outlook_with_rwf"]).drop("comment"), "projected_rwa")
    steps["addon_pivot"] = keep(addon_sum_sql(rows), "addon_pivot")
    steps["frm_base"] = frm_base(steps["projected_rwa"], steps["addon_pivot"])
    steps["upload_template_pivot"] = upload_pivot_sql(steps["frm_base"], quarters)
    steps["control_summary"] = control_summary(rows)
    return steps
