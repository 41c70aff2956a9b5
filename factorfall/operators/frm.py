"""Union of adjustments, outlook and add-ons, and its mappings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall.functions.rwa import entity_code, reporting_layer
from factorfall.functions.values import (
    left_join,
    number,
    numeric_columns,
    string_columns,
    text,
    whole,
)

PIVOT_TEXT = (
    "seg_l4_desc",
    "seg_l3_desc",
    "seg_l2_desc",
    "pmf_l5",
    "entity_code",
    "reporting_layer",
    "sa_account",
    "aa_account",
    "pug",
)


def coerce_adjustments(adjustments: DataFrame) -> DataFrame:
    """Balances and factors to numbers, then 0 for missing numbers and 'N/A' for missing text."""
    to_number = [c for c in adjustments.columns if c == "balances" or re.fullmatch(r"(sa|aa)_rwf(_key\d+)?", c)]
    df = adjustments.withColumns({c: number(c) for c in to_number})
    numbers = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in numeric_columns(df)}
    words = {c: F.coalesce(F.col(c), F.lit("N/A")) for c in string_columns(df)}
    return df.withColumns({**numbers, **words})


def entity_tag(df: DataFrame) -> DataFrame:
    return df.withColumn("entity_code", entity_code())


def frm_concat(adjustments: DataFrame, outlook: DataFrame, addon: DataFrame) -> DataFrame:
    """Stack the three sources by name; quarter ids become numbers."""
    stacked = None
    for part in (adjustments, outlook, addon):
        part = part.withColumn("quarter_id", whole("quarter_id"))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def drop_unknown_quarter(df: DataFrame) -> DataFrame:
    return df.withColumn("quarter_id", whole("quarter_id")).filter(F.col("quarter_id").isNotNull())


def legacy_layer(df: DataFrame) -> DataFrame:
    return df.withColumn("reporting_layer", reporting_layer())


def pug_join(df: DataFrame, pug: DataFrame) -> DataFrame:
    return left_join(df, pug.select("seg_l4_desc", "pug"), {"seg_l4_desc": "seg_l4_desc"}, null_safe=True)


def pmf_join(df: DataFrame, pmf: DataFrame) -> DataFrame:
    accounts = pmf.select("pmf_l5", "sa_account", "aa_account")
    return left_join(df, accounts, {"pmf_l5": "pmf_l5"}, null_safe=True)


def duplicate_keys(mapping: DataFrame, key: str) -> DataFrame:
    """Mapping keys that repeat, with their row count."""
    return mapping.groupBy(key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def match_report(before: DataFrame, after: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Per entity: whether a mapping join grew the table, and the rows left without a match.

    A row counts as unmatched only if it has a ``key``, where one is named. The
    share divides by rows + 1, so an empty table gives 0.
    """
    missing = F.col(column).isNull()
    if key:
        missing = missing & F.col(key).isNotNull()
    n_before = before.groupBy("entity").agg(F.count("*").alias("n_before"))
    n_after = after.groupBy("entity").agg(
        F.count("*").alias("n_rows"), F.count(F.when(missing, 1)).alias("n_unmatched")
    )
    return n_before.join(n_after, "entity", "left").withColumns(
        {
            "expanded": F.col("n_rows") != F.col("n_before"),
            "pct_unmatched": F.col("n_unmatched") * F.lit(100.0) / (F.col("n_rows") + 1),
        }
    )


def mapping_matches(raw: DataFrame, frm: DataFrame) -> DataFrame:
    """Per entity, both mapping joins at once: rows before and after, and the rows left without a match.

    ``frm`` is ``raw`` with both mappings joined; the left joins keep every row,
    so rows beyond those of ``raw`` come from repeated mapping keys.
    """
    no_account = F.col("sa_account").isNull() & F.col("pmf_l5").isNotNull()
    after = frm.groupBy("entity").agg(
        F.count("*").alias("n_rows"),
        F.count(F.when(F.col("pug").isNull(), 1)).alias("n_without_pug"),
        F.count(F.when(no_account, 1)).alias("n_without_account"),
    )
    before = raw.groupBy("entity").agg(F.count("*").alias("n_before"))
    share = {f"pct_{c}": F.col(f"n_{c}") * F.lit(100.0) / (F.col("n_rows") + 1) for c in ("without_pug", "without_account")}
    return before.join(after, "entity", "left").withColumns({"expanded": F.col("n_rows") != F.col("n_before"), **share})


def coerce_before_pivot(df: DataFrame) -> DataFrame:
    """RWA to numbers; null pivot keys get a text token, since null keys would drop out."""
    amounts = {c: number(c) for c in ("sa_rwa", "aa_rwa", "erba_rwa")}
    return df.withColumns({**amounts, **{c: text(c) for c in PIVOT_TEXT if c in df.columns}})
