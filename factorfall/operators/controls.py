"""Control totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions.values import exact_sum, filled_sum, whole
from factorfall.operators.convergence import exclude_discontinued
from factorfall.operators.upload import calc_rows, quarter_column
from factorfall.session import stage_table

CONTROL_CALCS = {"SA RWA": "sa_rwa", "AA RWA": "aa_rwa"}


def _control_totals(rows: DataFrame) -> DataFrame:
    """SA and AA totals per entity and segment, one column per quarter that occurs; no rows, no total.

    The rows shrink to one per (entity, segment, quarter) first; the quarters
    are then read off that small table, so none can be left out.
    """
    dims = ["entity", "seg_l2_desc"]
    sums = [filled_sum(column).alias(calc) for calc, column in CONTROL_CALCS.items()]
    totals = stage_table(rows.dropna(subset=[*dims, "quarter_id"]).groupBy(*dims, "quarter_id").agg(*sums), "control")
    quarters = sorted(r["quarter_id"] for r in totals.select("quarter_id").distinct().collect())
    wide = totals.groupBy(*dims).agg(
        *[
            F.expr(f"sum(CASE WHEN quarter_id = {q} THEN `{calc}` END) AS `{calc}_{quarter_column(q)}`")
            for calc in CONTROL_CALCS
            for q in quarters
        ]
    )
    return wide.select(*calc_rows(dims, list(CONTROL_CALCS), [quarter_column(q) for q in quarters]))


def control_convergence(rows: DataFrame) -> DataFrame:
    """Totals of the entity rows of the exposure history, discontinued operations left out."""
    named = exclude_discontinued(rows).withColumnsRenamed({"sa_rwa_amt": "sa_rwa", "adv_rwa_amt": "aa_rwa"})
    return _control_totals(named)


def control_summary(rows: DataFrame) -> DataFrame:
    """The same totals in long form: (entity, segment_l2, rwa_calc, quarter_id, rwa_amount)."""
    kept = rows.filter(F.col("seg_l2_desc") != rules.DISCONTINUED_L2)
    totals = kept.groupBy("entity", F.col("seg_l2_desc").alias("segment_l2"), "quarter_id").agg(
        exact_sum("sa_rwa_amt").alias("sa"), exact_sum("adv_rwa_amt").alias("aa")
    )
    calcs = F.stack(F.lit(2), F.lit("SA RWA"), F.col("sa"), F.lit("AA RWA"), F.col("aa"))
    return totals.select("entity", "segment_l2", "quarter_id", calcs.alias("rwa_calc", "rwa_amount"))


def control_raw(raw: DataFrame) -> DataFrame:
    """Totals of the stacked raw rows."""
    return _control_totals(raw.withColumn("quarter_id", whole("quarter_id")))


def control_upload(template: DataFrame, value_columns: Sequence[str]) -> DataFrame:
    """Totals of the upload template per entity, segment and calc; ERBA left out."""
    calc = F.when(F.col("RWA Calc") == "AA", "AA RWA").when(F.col("RWA Calc") == "SA", "SA RWA")
    dims = ["Entity", "Managed Segment L2 Descr"]
    present = [c for c in value_columns if c in template.columns]
    return (
        template.filter(F.col("RWA Calc").isin("AA", "SA"))
        .groupBy(*dims, calc.alias("RWA Calc"))
        .agg(*[filled_sum(F.col(f"`{c}`")).alias(c) for c in present])
    )
