"""Upload template and long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions import rwa
from factorfall.functions.quarters import ordered_quarters, period_label, quarter_labels
from factorfall.functions.values import fill_zero, filled_sum, numeric_columns, whole
from factorfall.schemas import output_header

UPLOAD_DIMS = (
    "seg_l4_desc",
    "seg_l3_desc",
    "seg_l2_desc",
    "pmf_l5",
    "comment",
    "exposure_type",
    "entity_code",
    "reporting_layer",
    "sa_account",
    "aa_account",
    "pug",
)
# Calc label <- amount column, in output order.
CALCS = {"ERBA": "erba_rwa", "AA": "aa_rwa", "SA": "sa_rwa"}
LONG_DIMS = ("entity_code", "reporting_layer", "seg_l2_desc", "seg_l3_desc", "seg_l4_desc", "pmf_l5")


def quarter_column(quarter: int) -> str:
    return f"q{quarter}"


def calc_rows(dims: Sequence[str], calcs: Sequence[str], names: Sequence[str]) -> list[Column | str]:
    """Turn columns '<calc>_<name>' into one row per calc."""
    rows = ", ".join(f"'{calc}', " + ", ".join(f"`{calc}_{n}`" for n in names) for calc in calcs)
    return [*dims, F.expr(f"stack({len(calcs)}, {rows})").alias("rwa_calc", *names)]


def upload_pivot(df: DataFrame, quarters: Sequence[int]) -> DataFrame:
    """RWA per calc and upload grain, one column per quarter, absent cells 0.

    Rows of quarters not listed keep their grain, with zeros. The rows shrink to
    one per grain and quarter first, in exact sums of the three calcs; those few
    rows are then turned into columns.
    """
    dims = [d for d in UPLOAD_DIMS if d in df.columns]
    keep = df.select(*dims, "quarter_id", *CALCS.values())
    filled = fill_zero(keep.withColumn("quarter_id", whole("quarter_id")))
    totals = filled.groupBy(*dims, "quarter_id").agg(*[filled_sum(column).alias(column) for column in CALCS.values()])
    cells = [
        F.expr(f"coalesce(max(CASE WHEN quarter_id = {q} THEN {column} END), 0D) AS {calc}_{quarter_column(q)}")
        for calc, column in CALCS.items()
        for q in quarters
    ]
    wide = totals.groupBy(*dims).agg(*cells)
    return wide.select(*calc_rows(dims, list(CALCS), [quarter_column(q) for q in quarters]))


def upload_pivot_sql(frm_base: DataFrame, quarters: Sequence[int]) -> DataFrame:
    """The same at (entity, segment, account) grain; a quarter without rows is null."""
    dims = ["entity", "seg_l2_desc", "pmf_l5"]

    def name(q: int) -> str:
        return "rwa_actuals" if q == 0 else quarter_column(q)

    sums = [
        F.expr(f"sum(CASE WHEN quarter_id = {q} THEN coalesce(double({column}), 0D) END) AS {calc}_{name(q)}")
        for calc, column in CALCS.items()
        for q in sorted(quarters)
    ]
    wide = frm_base.groupBy(*dims).agg(*sums)
    return wide.select(*calc_rows(dims, list(CALCS), [name(q) for q in sorted(quarters)]))


def markets_filter(pivot: DataFrame) -> DataFrame:
    """Label rows Keep or Remove; none is dropped."""
    return pivot.withColumn("markets_filter", rwa.markets_filter())


def stub_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in rules.UPLOAD_CONSTANTS.items()})


def account_derive(df: DataFrame) -> DataFrame:
    return df.withColumn("Account", rwa.upload_account()).drop("sa_account", "aa_account")


def quarter_headers(df: DataFrame, q0: str, n_quarters: int) -> DataFrame:
    """Quarter columns to 'RWA Actuals' and 'Jun 2025' style headers."""
    labels = quarter_labels(q0, n_quarters)
    return df.withColumnsRenamed({quarter_column(q): label for q, label in labels.items()})


def upload_layout(quarter_headers: Sequence[str]) -> list[str]:
    """Template column order; the headers are the projected quarters, without the actuals."""
    return [*rules.UPLOAD_LEADING, rules.ACTUALS_LABEL, *quarter_headers, *rules.UPLOAD_TRAILING]


def format_upload(pivot: DataFrame, q0: str, n_quarters: int) -> DataFrame:
    """Constants, account, headers and column order of the template.

    Row order is left to the sink (``upload_sort``).
    """
    df = pivot.fillna(0, subset=numeric_columns(pivot))
    df = quarter_headers(account_derive(stub_columns(df)), q0, n_quarters)
    df = df.withColumnsRenamed({c: output_header(c) for c in df.columns})
    labels = quarter_labels(q0, n_quarters)
    layout = upload_layout([labels[q] for q in ordered_quarters(n_quarters) if q != 0])
    return df.select(*[F.col(f"`{c}`") for c in layout if c in df.columns])


def upload_sort(template: DataFrame) -> DataFrame:
    """By segment; the further columns split the rows of one segment over many tasks."""
    first = ["Managed Segment L2 Descr", "Managed Segment L3 Descr"]
    rest = ["Managed Segment L4 Descr", "PMF Account L5 Descr", "RWA Calc", "Comment", "RWA Exposure Type"]
    return template.orderBy(*first, *[c for c in rest if c in template.columns])


def rwa_long(frm: DataFrame, q0: str, n_quarters: int) -> DataFrame:
    """Tidy table: one row per source row and calc, with the quarter's label."""
    labelled = frm.withColumn("period", period_label(q0, n_quarters, whole("quarter_id")))
    calcs = F.expr("stack(3, 'SA', double(sa_rwa), 'AA', double(aa_rwa), 'ERBA', double(erba_rwa))")
    return labelled.select(*LONG_DIMS, "period", calcs.alias("rwa_calc", "rwa_amount"))


def with_headers(df: DataFrame) -> DataFrame:
    """Canonical names to business headers, for tables handed to readers.

    The header of the entity code is 'Entity', so the plain name makes way.
    """
    if "entity_code" in df.columns:
        df = df.drop("entity")
    return df.withColumnsRenamed({c: output_header(c) for c in df.columns})
