"""Balance-sheet projection: reshape, calendar, factor waterfall and RWA."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions.rwa import erba_rwa, first_valid, projected_rwa
from factorfall.functions.values import (
    grouped_sum,
    id_of,
    int_str,
    number,
    quarter_text,
    text,
    whole,
)

OUTLOOK_DIMS = (
    "entity",
    "year",
    "seg_l4_desc",
    "seg_l3_desc",
    "seg_l2_desc",
    "geo_l4_desc",
    "geo_l3_desc",
    "pmf_l5",
    "seg_l4_id",
    "seg_l3_id",
    "seg_l2_id",
)


def entity_union(sheets: dict[str, DataFrame]) -> DataFrame:
    """Stack the entities' balance sheets under an ``entity`` column."""
    stacked = None
    for name, sheet in sheets.items():
        tagged = sheet.withColumn("entity", F.lit(name))
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    return stacked


def month_columns(balance_sheet: DataFrame) -> DataFrame:
    """Quarter-end balance per month label: the last source column of each period."""
    return balance_sheet.withColumns({label: F.col(cols[-1]) for label, cols in rules.BALANCE_PERIODS.items()})


def quarterly_sum(balance_sheet: DataFrame) -> DataFrame:
    """Quarter-end balances added up per outlook grain."""
    return grouped_sum(balance_sheet, OUTLOOK_DIMS, {m: m for m in rules.MONTHS})


def melt_balances(pivot: DataFrame) -> DataFrame:
    """One row per grain and month; runs after the sum, on a fraction of the rows."""
    return pivot.unpivot(list(OUTLOOK_DIMS), list(rules.MONTHS), "month", "balances")


def quarter_join(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Quarter id from year and month; null outside the calendar, which Catalyst broadcasts while it is small."""
    return rows.join(calendar, ["year", "month"], "left")


def quarter_inverse_join(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Year and month from the quarter id; null where it is not in the calendar."""
    rows = rows.drop("year", "month")
    return rows.join(calendar, ["quarter_id"], "left")


def bad_quarters(parsed: DataFrame) -> DataFrame:
    """Projected quarters as written that are in no calendar, with their rows; ``parsed`` may hold totals with ``n_rows``."""
    rows = F.sum("n_rows") if "n_rows" in parsed.columns else F.count("*")
    unknown = parsed.filter(F.col("quarter_id").isNull())
    return unknown.groupBy("projected_quarter").agg(rows.alias("n_rows"))


def quarter_counts(convergence: DataFrame, balance_sheet: DataFrame) -> DataFrame:
    """Distinct quarters per input, whether they agree, and the largest.

    Every balance-sheet year brings all months, so the outlook's count follows
    from the years alone and the outlook itself need not be computed. A null
    quarter counts as a value in the convergence table.
    """
    quarters = convergence.select("quarter_id").distinct().agg(F.count("*").alias("n"))
    years = balance_sheet.dropna(subset=list(OUTLOOK_DIMS)).select("entity", "year").distinct()
    per_entity = years.groupBy("entity").agg((F.count("*") * len(rules.MONTHS)).alias("n"))
    inputs = ["convergence"] + [f"{e.name.lower()}_outlook" for e in rules.ENTITIES]
    counted = quarters.select(F.lit("convergence").alias("input"), "n").unionByName(
        per_entity.select(F.concat(F.lower("entity"), F.lit("_outlook")).alias("input"), "n")
    )
    wide = counted.agg(*[F.coalesce(F.max(F.when(F.col("input") == i, F.col("n"))), F.lit(0)).alias(i) for i in inputs])
    agree = F.lit(True)
    for i in inputs[1:]:
        agree = agree & (F.col(i) == F.col(inputs[0]))
    return wide.withColumns({"agree": agree, "max_quarters": F.greatest(*inputs)})


def outlook_keys(outlook: DataFrame, keys=rules.WATERFALL_KEYS) -> DataFrame:
    """Readable composite keys; the joins use the components instead."""
    columns = {}
    for i, key in enumerate(keys, 1):
        parts = [
            int_str(f.outlook) if f.whole else text(f.outlook)
            for f in key
            if f.outlook is not None
        ]
        columns[f"key{i}"] = F.concat(*parts, quarter_text())
    return outlook.withColumns(columns)


def key_dictionary(combos: DataFrame, factors: DataFrame, keys=rules.WATERFALL_KEYS, dedupe: bool = False) -> DataFrame:
    """Every level's factors for each combination of key parts that has any, from one join.

    ``combos`` has one ``combo`` column, a struct of entity, quarter and the parts
    by their outlook names. Each combination is asked at every level at once; a
    level whose parts hold a null finds nothing. A combination with several
    segments at a level gets a row for each, multiplied over the levels, or with
    ``dedupe`` the one that comes first by name.
    """
    levels = [[f for f in key if f.outlook is not None] for key in keys]
    asked = [F.struct(F.lit(i).alias("level"), F.array(*[F.col(f"combo.{f.outlook}") for f in fields]).alias("parts")) for i, fields in enumerate(levels, 1)]
    asked = combos.select("combo", F.explode(F.array(*asked)).alias("key")).select(
        "combo", F.col("combo.entity").alias("entity"), F.col("combo.quarter_id").alias("quarter_id"), "key.level", "key.parts"
    )
    asked = asked.filter(~F.exists("parts", lambda x: x.isNull()))
    parts = F.when(F.lit(False), F.array().cast("array<string>"))
    for i, fields in enumerate(levels, 1):
        named = [id_of(factors, f.lookup).cast("string") if f.whole else F.col(f.lookup) for f in fields]
        parts = parts.when(F.col("key_level") == i, F.array(*named))
    offered = factors.select(
        F.col("key_level").alias("__level"),
        F.col("entity").alias("__entity"),
        F.col("quarter_id").cast("bigint").alias("__quarter"),
        parts.alias("__parts"),
        F.struct(F.col("key_level").alias("level"), F.col("seg_l2_desc").alias("segment"), F.col("sa_rwf").alias("sa"), F.col("aa_rwf").alias("aa")).alias("factor"),
    )
    met = (
        (F.col("level") == F.col("__level"))
        & (F.col("entity") == F.col("__entity"))
        & (F.col("quarter_id") == F.col("__quarter"))
        & (F.col("parts") == F.col("__parts"))
    )
    found = asked.join(offered, met).groupBy("combo").agg(F.collect_list("factor").alias("found"))
    columns = []
    for i in range(1, len(levels) + 1):
        mine, suffix = F.expr(f"filter(found, x -> x.level = {i})"), "" if i == 1 else f"_key{i}"
        found = found.withColumn(f"level{i}", F.explode_outer(F.slice(F.array_sort(mine), 1, 1) if dedupe else mine))
        columns += [F.col(f"level{i}.{c}").alias(f"{c}_rwf{suffix}") for c in ("sa", "aa")]
    return found.select("combo", *columns)


def waterfall_join(outlook: DataFrame, factors: DataFrame, keys=rules.WATERFALL_KEYS, dedupe: bool = False) -> DataFrame:
    """Left join every key level's factors, most specific first.

    A key that holds several segments keeps one row per segment, as a lookup
    with repeated keys does; over the levels these rows multiply. With
    ``dedupe`` each key keeps the segment that comes first by name, and no row
    is repeated. The outlook is reduced to its distinct combinations of key
    parts first, so that a key holding a large share of the rows is one row
    when the levels are looked up; the outlook itself is joined once.
    """
    fields = {f.outlook: f for key in keys for f in key if f.outlook is not None}
    parts = [(id_of(outlook, c).cast("string") if f.whole else F.col(c)).alias(c) for c, f in fields.items()]
    combo = F.struct("entity", F.col("quarter_id").cast("bigint").alias("quarter_id"), *parts)
    resolved = key_dictionary(outlook.select(combo.alias("combo")).distinct(), factors, keys, dedupe)
    return outlook.withColumn("__combo", combo).join(resolved, F.col("__combo") == F.col("combo"), "left").drop("__combo", "combo")


def adjustment_join(outlook: DataFrame, adjustments: DataFrame, keys=rules.WATERFALL_KEYS) -> DataFrame:
    """Attach manual adjustments by the first key and the quarter number.

    Columns the outlook already has arrive with an ``_adj`` suffix; several
    adjustments on one key repeat the outlook row.
    """
    joined = [f for f in keys[0] if f.outlook is not None]
    factors = [c for c in adjustments.columns if re.fullmatch(r"(sa|aa)_rwf(_key\d+)?", c)]
    carried = [number(c).alias(f"{c}_adj" if c in outlook.columns else c) for c in factors]
    right = adjustments.select(
        F.col("entity").alias("__entity"),
        whole("quarter_id").alias("__quarter"),
        *[(id_of(adjustments, f.outlook) if f.whole else text(f.outlook)).alias(f"__{f.outlook}") for f in joined],
        "exposure_type",
        *carried,
    )
    condition = (F.col("entity") == F.col("__entity")) & (F.col("quarter_id") == F.col("__quarter"))
    for f in joined:
        left = id_of(outlook, f.outlook) if f.whole else F.col(f.outlook)
        condition = condition & (left == F.col(f"__{f.outlook}"))
    return outlook.join(right, condition, "left").drop(
        "__entity", "__quarter", *[f"__{f.outlook}" for f in joined]
    )


def waterfall_columns(df: DataFrame, calc: str) -> list[str]:
    """Factor columns in order of use: each key, then the adjustment's own factor for it."""
    found = [
        (int(m.group(1)), m.group(2) is not None, c)
        for c in df.columns
        if (m := re.fullmatch(rf"{calc}_rwf_key(\d+)(_adj)?", c))
    ]
    return [f"{calc}_rwf"] + [c for _, _, c in sorted(found)]


def final_factors(outlook: DataFrame) -> DataFrame:
    """The first valid factor of each calc."""
    return outlook.withColumns({f"final_{c}_rwf": first_valid(waterfall_columns(outlook, c)) for c in ("sa", "aa")})


def project_rwa(outlook: DataFrame) -> DataFrame:
    """SA, AA and ERBA RWA and an empty comment."""
    return (
        outlook.withColumns({"sa_rwa": projected_rwa("final_sa_rwf"), "aa_rwa": projected_rwa("final_aa_rwf")})
        .withColumns({"erba_rwa": erba_rwa("sa_rwa"), "comment": F.lit("")})
    )
