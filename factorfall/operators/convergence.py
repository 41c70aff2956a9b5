"""Exposure history: entity rows, buckets and factor lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions.rwa import capped_ratio
from factorfall.functions.values import exact_sum, filled_sum, left_join, text


EXPOSURE_DIMS = (
    "quarter_id",
    "projected_quarter",
    "seg_l4_code",
    "seg_l3_code",
    "seg_l2_code",
    "seg_l4_desc",
    "seg_l3_desc",
    "seg_l2_desc",
    "geo_l4_desc",
    "geo_l3_desc",
    "pmf_l5",
    "exposure_type",
    *[e.flag for e in rules.ENTITIES],
)


def exposure_totals(convergence: DataFrame) -> DataFrame:
    """The exposure history at the grain of everything a run asks of it, with row counts.

    All later steps filter and add up these columns only, so a run reads the
    source table once; what follows works on the totals. ``n_rows`` weighs the
    quality checks.
    """
    dims = [d for d in EXPOSURE_DIMS if d in convergence.columns]
    amounts = ["gaap_amt", "sa_rwa_amt", *[e.adv_rwa for e in rules.ENTITIES]]
    return convergence.groupBy(*dims).agg(F.count("*").alias("n_rows"), *[F.sum(a).alias(a) for a in amounts])


def by_entity(convergence: DataFrame) -> DataFrame:
    """One row per entity a record is reported for, with that entity's advanced RWA.

    A single scan serves all entities; the flag test reaches the source files.
    """
    flags = [e.flag for e in rules.ENTITIES]
    reported = F.lit(False)
    parts = []
    for e in rules.ENTITIES:
        reported = reported | (F.col(e.flag) == "Y")
        parts += [F.lit(e.name), F.col(e.flag), F.col(e.adv_rwa)]
    rows = F.stack(F.lit(len(rules.ENTITIES)), *parts)
    return (
        convergence.filter(reported)
        .select("*", rows.alias("entity", "__flag", "adv_rwa_amt"))
        .filter(F.col("__flag") == "Y")
        .drop("__flag", *flags, *[e.adv_rwa for e in rules.ENTITIES])
    )


def string_normalise(df: DataFrame, column: str = "pmf_l5") -> DataFrame:
    """Null accounts become a text token, so that their rows keep a group."""
    return df.withColumn(column, text(column))


def geo_enrich(convergence: DataFrame, balance_sheet: DataFrame) -> DataFrame:
    """Add the parent geography, unless present; one parent per child, the smallest name."""
    if "geo_l3_desc" in convergence.columns:
        return convergence
    parents = (
        balance_sheet.filter(F.col("entity") == rules.ENTITIES[0].name)
        .groupBy("geo_l4_desc")
        .agg(F.min("geo_l3_desc").alias("geo_l3_desc"))
    )
    return left_join(convergence, parents, {"geo_l4_desc": "geo_l4_desc"}, null_safe=True)


def distinct_pairs(balance_sheet: DataFrame) -> DataFrame:
    return balance_sheet.select("geo_l3_desc", "geo_l4_desc").dropDuplicates()


def split_credit_risk(rows: DataFrame) -> DataFrame:
    """Rows on factor accounts, Markets included."""
    return rows.filter(F.col("pmf_l5").isin(*rules.FACTOR_ACCOUNTS))


def split_markets_addon(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("seg_l2_desc") == rules.MARKETS_L2)


def split_non_waterfall(rows: DataFrame) -> DataFrame:
    """Rows in neither of the above; null accounts and segments stay."""
    account = F.col("pmf_l5")
    other_account = account.isNull() | ~account.isin(*rules.FACTOR_ACCOUNTS)
    return rows.filter(other_account & ~F.col("seg_l2_desc").eqNullSafe(rules.MARKETS_L2))


def exclude_discontinued(rows: DataFrame) -> DataFrame:
    """Drop discontinued operations; a row without a segment stays."""
    return rows.filter(~F.col("seg_l2_desc").eqNullSafe(rules.DISCONTINUED_L2))


def key_dims(keys: Sequence[Sequence[rules.KeyField]]) -> list[str]:
    return list(dict.fromkeys(field.lookup for key in keys for field in key))


def key_pivots(credit_risk: DataFrame, keys=rules.WATERFALL_KEYS) -> DataFrame:
    """Amounts per key level: (key_level, entity, quarter, key columns) -> three sums.

    The raw rows are read and shuffled once, to the grain of all key columns
    together; every level then adds up those far fewer rows. Columns a level
    does not use are null in its rows.
    """
    dims = key_dims(keys)
    amounts = ("gaap_amt", "sa_rwa_amt", "adv_rwa_amt")
    base = (
        credit_risk.dropna(subset=["entity", "quarter_id"])
        .groupBy("entity", "quarter_id", *dims)
        .agg(*[exact_sum(a).alias(a) for a in amounts])
    )
    levels = base.withColumn("key_level", F.explode(F.sequence(F.lit(1), F.lit(len(keys)))))
    columns = []
    for dim in dims:
        using = [i for i, key in enumerate(keys, 1) if any(f.lookup == dim for f in key)]
        in_level = F.col("key_level").isin(*using)
        levels = levels.filter(~in_level | F.col(dim).isNotNull())
        columns.append(F.when(in_level, F.col(dim)).alias(dim))
    return (
        levels.select("key_level", "entity", "quarter_id", *columns, *amounts)
        .groupBy("key_level", "entity", "quarter_id", *dims)
        .agg(*[filled_sum(a).alias(a) for a in amounts])
    )


def rwf_ratio(pivots: DataFrame) -> DataFrame:
    return pivots.withColumns(
        {
            "sa_rwf": capped_ratio("sa_rwa_amt", "gaap_amt"),
            "aa_rwf": capped_ratio("adv_rwa_amt", "gaap_amt"),
        }
    )


def markets_null_rwf(pivots: DataFrame) -> DataFrame:
    """Markets has no factors: its RWA comes in as an add-on."""
    keep = ~F.col("seg_l2_desc").eqNullSafe(rules.MARKETS_L2)
    return pivots.withColumns({c: F.when(keep, F.col(c)) for c in ("sa_rwf", "aa_rwf")})


def factor_table(credit_risk: DataFrame, keys=rules.WATERFALL_KEYS) -> DataFrame:
    """Factors of every key level in one table."""
    return markets_null_rwf(rwf_ratio(key_pivots(credit_risk, keys)))
