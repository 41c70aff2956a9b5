"""A complete run: read, project, map, check and write."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorfall.functions.quarters import quarter_labels
from factorfall.operators import addon as A
from factorfall.operators import controls as K
from factorfall.operators import convergence as C
from factorfall.operators import dq as D
from factorfall.operators import frm as M
from factorfall.operators import outlook as O
from factorfall.operators import upload as U
from factorfall.plans import stages as S
from factorfall.plans.config import Parameters
from factorfall.schemas import REGISTRY, canonical
from factorfall.session import stage_table, stage_tables
from factorfall.sources import catalog, sinks

# The exposure columns every run needs, in canonical names.
REQUIRED = [canonical(f.name) for f in REGISTRY["convergence"].fields]


# Inputs of the second stage, where blank text reads as null; the first keeps it.
SECOND_STAGE = ("pug", "pmf")


def read_inputs(spark: SparkSession, input_dir: str, parquet_dir: str, registry: dict | None = None) -> S.Inputs:
    """Landed files, or their Parquet copies, as canonical tables with an entity column.

    ``registry`` (from ``load_registry``) replaces the built-in schemas.
    """
    specs = catalog.source_catalog(input_dir)
    tables = {
        k: catalog.to_canonical(catalog.scan_fallback(spark, v, parquet_dir, k in SECOND_STAGE, registry))
        for k, v in specs.items()
    }
    return S.Inputs(
        convergence=tables["convergence"],
        balance_sheet=O.entity_union({"CG": tables["cg"], "CBNA": tables["cbna"]}),
        adjustments=O.entity_union({"CG": tables["cg_adjustments"], "CBNA": tables["cbna_adjustments"]}),
        pug=tables["pug"],
        pmf=tables["pmf"],
    )


def control_file(
    rows: DataFrame, template: DataFrame, raw: DataFrame, params: Parameters, n_quarters: int
) -> dict[str, DataFrame]:
    """The three control tables; ``rows`` are the entity rows of the exposure history."""
    labels = quarter_labels(params.q0, n_quarters)
    return {
        "control_upload": K.control_upload(template, list(labels.values())),
        "control_convergence": K.control_convergence(rows),
        "control_raw": K.control_raw(raw),
    }


def parameter_table(spark: SparkSession, params: Parameters, **folders: str) -> DataFrame:
    rows = [("Q0", params.q0), ("waterfall_keys", str(len(params.keys))), *folders.items()]
    return spark.createDataFrame([(k, str(v)) for k, v in rows], "Parameter string, Value string")


def run_pipeline(
    spark: SparkSession,
    inputs: S.Inputs,
    params: Parameters,
    output_dir: str,
    run_timestamp: str | None = None,
) -> dict[str, str]:
    """Write every table of a run below ``output_dir``; returns their paths.

    The two large inputs are read once each, for their totals. Tables with
    several readers are written and read back: the totals, the factors (five
    lookups), the outlook, the add-ons and the mapped union. Nothing is cached,
    so a lost executor costs a task, not a stage.
    """
    source_columns = inputs.convergence
    inputs = S.prepared(inputs)
    n_quarters = S.calendar_size(inputs, params)
    stamp = run_timestamp or datetime.now(timezone.utc).isoformat(timespec="seconds")

    lookups = stage_table(S.factors(inputs, params), "factors")
    outlook, addon = stage_tables(
        {
            "outlook": S.stage1_outlook(inputs, params, n_quarters, lookups),
            "addon": S.stage1_addon(inputs, params, n_quarters),
        }
    )
    raw = stage_table(S.raw_data(inputs, outlook, addon), "raw")
    frm = stage_table(S.stage2_frm(inputs, raw), "frm")
    template = stage_table(S.upload_template(frm, params, n_quarters), "template")

    outputs = {
        "outlook": U.with_headers(outlook),
        "addon": U.with_headers(A.rename_addon(addon)),
        "bad_quarters": O.bad_quarters(S.addon_input(inputs, params, n_quarters)),
        "quarter_counts": O.quarter_counts(inputs.convergence, S.quarterly(inputs)),
        "mapping_matches": M.mapping_matches(raw, frm),
        "mapping_repeats": mapping_repeats(inputs),
        "raw_data": U.with_headers(raw),
        "upload_template": U.upload_sort(template),
        "rwa_long": U.with_headers(U.rwa_long(frm, params.q0, n_quarters)),
        "dq_results": quality_report(inputs, source_columns, outlook, frm, params, stamp),
        "parameters": parameter_table(spark, params, output_dir=output_dir, n_quarters=str(n_quarters)),
        **control_file(C.by_entity(inputs.convergence), template, raw, params, n_quarters),
    }
    sinks.sink_parquet(outputs, output_dir)
    return {name: f"{output_dir}/{name}.parquet" for name in outputs}


def mapping_repeats(inputs: S.Inputs) -> DataFrame:
    """Keys that occur more than once in a mapping; each repeats the rows it matches."""
    pug = M.duplicate_keys(inputs.pug, "seg_l4_desc").select(F.lit("pug").alias("mapping"), F.col("seg_l4_desc").alias("key"), "n_rows")
    pmf = M.duplicate_keys(inputs.pmf, "pmf_l5").select(F.lit("pmf").alias("mapping"), F.col("pmf_l5").alias("key"), "n_rows")
    return pug.unionByName(pmf)


def quality_report(
    inputs: S.Inputs, source: DataFrame, outlook: DataFrame, frm: DataFrame, params: Parameters, stamp: str
) -> DataFrame:
    """Every check; ``source`` is the exposure table as it came, for its columns only."""
    weight = "n_rows" if "n_rows" in inputs.convergence.columns else None
    required = D.dq_required_cols(source, REQUIRED, "convergence")
    return D.dq_report(
        inputs.convergence, outlook, inputs.adjustments, frm, len(params.keys), required, stamp, weight
    )


def pug_and_pmf_reports(inputs: S.Inputs, raw: DataFrame) -> dict[str, DataFrame]:
    """Unmatched shares and row growth of both mapping joins."""
    layered = M.legacy_layer(raw)
    pugged = M.pug_join(layered, inputs.pug)
    mapped = M.pmf_join(pugged, inputs.pmf)
    return {
        "pug_unmatched": M.match_report(layered, pugged, "pug"),
        "pmf_unmatched": M.match_report(pugged, mapped, "sa_account", "pmf_l5"),
    }
