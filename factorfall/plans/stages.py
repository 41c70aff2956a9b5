"""The two stages as DataFrame chains: factors and projections, then union and reports."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from factorfall.functions.quarters import ordered_quarters, quarter_map
from factorfall.functions.values import blank_to_null
from factorfall.operators import addon as A
from factorfall.operators import convergence as C
from factorfall.operators import frm as M
from factorfall.operators import outlook as O
from factorfall.operators import upload as U
from factorfall.plans.config import Parameters
from factorfall.session import stage_table, stage_tables


@dataclass(frozen=True)
class Inputs:
    """Canonical input tables; entity tables carry an ``entity`` column."""

    convergence: DataFrame
    balance_sheet: DataFrame
    adjustments: DataFrame
    pug: DataFrame
    pmf: DataFrame
    quarterly: DataFrame | None = None


def quarterly(inputs: Inputs) -> DataFrame:
    """Balances per outlook grain."""
    if inputs.quarterly is not None:
        return inputs.quarterly
    return O.quarterly_sum(O.month_columns(C.string_normalise(inputs.balance_sheet)))


def prepared(inputs: Inputs) -> Inputs:
    """Both large tables reduced to their totals and staged, each read once.

    Every later step gives the same result on the totals as on the rows.
    """
    totals = C.geo_enrich(C.exposure_totals(inputs.convergence), inputs.balance_sheet)
    exposures, balances = stage_tables({"exposures": totals, "quarterly": quarterly(inputs)})
    return replace(inputs, convergence=exposures, quarterly=balances)


def enriched(inputs: Inputs) -> DataFrame:
    """Exposure history with the parent geography."""
    return C.geo_enrich(inputs.convergence, inputs.balance_sheet)


def calendar_size(inputs: Inputs, params: Parameters) -> int:
    """Quarters of the run: the parameter, or the largest count in the inputs (one row is fetched)."""
    if params.n_quarters is not None:
        return params.n_quarters
    return O.quarter_counts(inputs.convergence, quarterly(inputs)).first()["max_quarters"]


def factors(inputs: Inputs, params: Parameters) -> DataFrame:
    """Factors of every key level."""
    return C.factor_table(C.split_credit_risk(C.by_entity(enriched(inputs))), params.keys)


def outlook_long(inputs: Inputs) -> DataFrame:
    """Summed balances, one row per grain and month."""
    return O.melt_balances(quarterly(inputs))


def outlook_quarters(inputs: Inputs, params: Parameters, n_quarters: int) -> DataFrame:
    calendar = quarter_map(inputs.balance_sheet.sparkSession, params.q0, n_quarters)
    return O.quarter_join(outlook_long(inputs), calendar)


def outlook_factors(inputs: Inputs, params: Parameters, n_quarters: int, staged: DataFrame | None = None) -> DataFrame:
    """Outlook with readable keys and every key level's factors.

    The factor table is staged: five lookups read it, and its exact size decides
    whether they are broadcast.
    """
    lookups = stage_table(factors(inputs, params), "factors") if staged is None else staged
    keyed = O.outlook_keys(outlook_quarters(inputs, params, n_quarters), params.keys)
    return O.waterfall_join(keyed, lookups, params.keys, dedupe=params.dedupe)


def stage1_outlook(inputs: Inputs, params: Parameters, n_quarters: int, staged: DataFrame | None = None) -> DataFrame:
    """Outlook with adjustments attached, final factors and RWA."""
    joined = O.adjustment_join(outlook_factors(inputs, params, n_quarters, staged), inputs.adjustments, params.keys)
    return O.project_rwa(O.final_factors(joined))


def addon_input(inputs: Inputs, params: Parameters, n_quarters: int) -> DataFrame:
    """Add-on rows of both buckets with their quarter."""
    calendar = quarter_map(inputs.convergence.sparkSession, params.q0, n_quarters)
    rows = C.string_normalise(A.addon_rows(C.by_entity(enriched(inputs))))
    return A.projected_quarter_parse(rows, calendar)


def stage1_addon(inputs: Inputs, params: Parameters, n_quarters: int) -> DataFrame:
    """Add-on amounts of both buckets, from one pass over the exposures."""
    calendar = quarter_map(inputs.convergence.sparkSession, params.q0, n_quarters)
    return O.quarter_inverse_join(A.addon_sum(addon_input(inputs, params, n_quarters)), calendar)


def raw_data(inputs: Inputs, outlook: DataFrame, addon: DataFrame) -> DataFrame:
    """Adjustments, outlook and add-ons of known quarters, with the entity code."""
    adjustments = M.coerce_adjustments(blank_to_null(inputs.adjustments))
    stacked = M.frm_concat(adjustments, blank_to_null(outlook), A.rename_addon(blank_to_null(addon)))
    return M.entity_tag(M.drop_unknown_quarter(stacked))


def stage2_frm(inputs: Inputs, raw: DataFrame) -> DataFrame:
    """Reporting layer, PUG and account numbers."""
    return M.pmf_join(M.pug_join(M.legacy_layer(raw), inputs.pug), inputs.pmf)


def upload_template(frm: DataFrame, params: Parameters, n_quarters: int) -> DataFrame:
    pivot = U.upload_pivot(M.coerce_before_pivot(frm), ordered_quarters(n_quarters))
    return U.format_upload(U.markets_filter(pivot), params.q0, n_quarters)


def frm_chain(inputs: Inputs, params: Parameters, n_quarters: int) -> DataFrame:
    """From the inputs to the mapped union, without staging it."""
    outlook = stage1_outlook(inputs, params, n_quarters)
    return stage2_frm(inputs, raw_data(inputs, outlook, stage1_addon(inputs, params, n_quarters)))
