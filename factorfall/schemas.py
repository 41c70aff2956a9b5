"""Business headers of every dataset, their canonical column names and types."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source headers and types, single-spaced.
# ---------------------------------------------------------------------------

LONG, TEXT, DOUBLE = T.LongType(), T.StringType(), T.DoubleType()

_BALANCE_SHEET = [
    ("FRS BU (Leaf)", LONG),
    ("PMF Account (Leaf)", LONG),
    ("YEAR", LONG),
    ("Managed Segment L1 Id", LONG),
    ("Managed Segment L2 Id", LONG),
    ("Managed Segment L3 Id", LONG),
    ("Managed Segment L4 Id", LONG),
    ("Managed Segment L5 Id", LONG),
    ("Managed Geography L1 Id", LONG),
    ("Managed Geography L2 Id", TEXT),
    ("Managed Geography L3 Id", LONG),
    ("Managed Geography L4 Id", TEXT),
    ("Managed Geography L5 Id", TEXT),
    ("PMF Account L2 Id", LONG),
    ("PMF Account L3 Id", LONG),
    ("PMF Account L4 Id", LONG),
    ("PMF Account L5 Id", LONG),
    ("PMF Account L6 Id", LONG),
    ("PMF Account L7 Id", LONG),
    ("PMF Account L8 Id", LONG),
    ("PMF_FLIP_SIGN", LONG),
    ("AFFILIATE", LONG),
    ("FRS BU (Node)", LONG),
    ("M3_USDOLLAR", DOUBLE),
    ("M6_USDOLLAR", DOUBLE),
    ("M9_USDOLLAR", DOUBLE),
    ("M12_USDOLLAR", DOUBLE),
    ("SCENARIO", TEXT),
    ("Managed Segment L1 Descr", TEXT),
    ("Managed Segment L2 Descr", TEXT),
    ("Managed Segment L3 Descr", TEXT),
    ("Managed Segment L4 Descr", TEXT),
    ("Managed Segment L5 Descr", TEXT),
    ("Managed Geography L1 Descr", TEXT),
    ("Managed Geography L2 Descr", TEXT),
    ("Managed Geography L3 Descr", TEXT),
    ("Managed Geography L4 Descr", TEXT),
    ("Managed Geography L5 Descr", TEXT),
    ("PMF Account L1 Descr", TEXT),
    ("PMF Account L2 Descr", TEXT),
    ("PMF Account L3 Descr", TEXT),
    ("PMF Account L4 Descr", TEXT),
    ("PMF Account L5 Descr", TEXT),
    ("PMF Account L6 Descr", TEXT),
    ("PMF Account L7 Descr", TEXT),
    ("PMF Account L8 Descr", TEXT),
    ("Balance Type", TEXT),
    ("FRS BU (Node) Descr", TEXT),
]

_CONVERGENCE = [
    ("CCAR Cycle", TEXT),
    ("Scope", TEXT),
    ("Managed Segment Level 1 Code", LONG),
    ("Managed Segment Level 2 Code", LONG),
    ("Managed Segment Level 3 Code", LONG),
    ("Managed Segment Level 4 Code", LONG),
    ("Version Number", LONG),
    ("Fiscal Year Accounting Period", LONG),
    ("Quarter Id", LONG),
    ("RWA Exposure Type Description", TEXT),
    ("Data Category", TEXT),
    ("Projected Quarter", TEXT),
    ("Scenario Id", TEXT),
    ("Scenario Name", TEXT),
    ("Error Flag", TEXT),
    ("Reportable Entity is CBNA", TEXT),
    ("Reportable Entity is CG", TEXT),
    ("Managed Segment Level 1 Description", TEXT),
    ("Managed Segment Level 2 Description", TEXT),
    ("Managed Segment Level 3 Description", TEXT),
    ("Managed Segment Level 4 Description", TEXT),
    ("Managed Geography Level 3 Description", TEXT),
    ("Managed Geography Level 4 Description", TEXT),
    ("Finance PMF Level 5 Description", TEXT),
    ("Comments", TEXT),
    ("GAAP Amount", DOUBLE),
    ("Adv. CG Total RWA Amount with 1.06 Multiplier", DOUBLE),
    ("Adv. CBNA Total RWA Amount with 1.06 Multiplier", DOUBLE),
    ("SA RWA Amount", DOUBLE),
]

_ADJUSTMENTS = [
    ("YEAR", LONG),
    ("Managed Segment L4 Descr", TEXT),
    ("Managed Segment L3 Descr", TEXT),
    ("Managed Segment L2 Descr", TEXT),
    ("Managed Geography L4 Descr", TEXT),
    ("Managed Geography L3 Descr", TEXT),
    ("PMF Account L5 Descr", TEXT),
    ("Managed Segment L4 Id", LONG),
    ("Managed Segment L3 Id", LONG),
    ("Managed Segment L2 Id", LONG),
    ("Month", TEXT),
    ("Balances", TEXT),
    ("Quarter Id", TEXT),
    ("SA RWA", DOUBLE),
    ("AA RWA", DOUBLE),
    ("ERBA RWA", DOUBLE),
    ("Comment", TEXT),
    ("RWA Exposure Type", TEXT),
    ("SA RWF", TEXT),
    ("AA RWF", TEXT),
]

_PUG = [
    ("Managed Segment L2 Descr", TEXT),
    ("Managed Segment L3 Id", LONG),
    ("Managed Segment L3 Descr", TEXT),
    ("Managed Segment L4 Id", LONG),
    ("Managed Segment L4 Descr", TEXT),
    ("PUG", TEXT),
]

_PMF = [
    ("PMF L5", TEXT),
    ("SA Account #", TEXT),
    ("SA Leaf Account Name", TEXT),
    ("AA Account #", TEXT),
    ("AA Leaf Account Name", TEXT),
]

_QUARTER_MAP = [
    ("quarter_id", LONG),
    ("year", LONG),
    ("month", TEXT),
]

# Canonical names of the columns the operators use; other headers follow the
# rule in ``canonical``.
CANONICAL = {
    "YEAR": "year",
    "Month": "month",
    "Balances": "balances",
    "Quarter Id": "quarter_id",
    "Projected Quarter": "projected_quarter",
    "M3_USDOLLAR": "m3",
    "M6_USDOLLAR": "m6",
    "M9_USDOLLAR": "m9",
    "M12_USDOLLAR": "m12",
    "Managed Segment L4 Descr": "seg_l4_desc",
    "Managed Segment L3 Descr": "seg_l3_desc",
    "Managed Segment L2 Descr": "seg_l2_desc",
    "Managed Segment L4 Id": "seg_l4_id",
    "Managed Segment L3 Id": "seg_l3_id",
    "Managed Segment L2 Id": "seg_l2_id",
    "Managed Geography L4 Descr": "geo_l4_desc",
    "Managed Geography L3 Descr": "geo_l3_desc",
    "PMF Account L5 Descr": "pmf_l5",
    "PMF L5": "pmf_l5",
    "Managed Segment Level 4 Code": "seg_l4_code",
    "Managed Segment Level 3 Code": "seg_l3_code",
    "Managed Segment Level 2 Code": "seg_l2_code",
    "Managed Segment Level 4 Description": "seg_l4_desc",
    "Managed Segment Level 3 Description": "seg_l3_desc",
    "Managed Segment Level 2 Description": "seg_l2_desc",
    "Managed Geography Level 4 Description": "geo_l4_desc",
    "Managed Geography Level 3 Description": "geo_l3_desc",
    "Finance PMF Level 5 Description": "pmf_l5",
    "Reportable Entity is CG": "is_cg",
    "Reportable Entity is CBNA": "is_cbna",
    "RWA Exposure Type Description": "exposure_type",
    "RWA Exposure Type": "exposure_type",
    "GAAP Amount": "gaap_amt",
    "SA RWA Amount": "sa_rwa_amt",
    "Adv. CG Total RWA Amount with 1.06 Multiplier": "adv_cg_amt",
    "Adv. CBNA Total RWA Amount with 1.06 Multiplier": "adv_cbna_amt",
    "PUG": "pug",
    "SA Account #": "sa_account",
    "AA Account #": "aa_account",
    "SA RWA": "sa_rwa",
    "AA RWA": "aa_rwa",
    "ERBA RWA": "erba_rwa",
    "SA RWF": "sa_rwf",
    "AA RWF": "aa_rwf",
    "Comment": "comment",
    "Reporting Layer": "reporting_layer",
    "Entity": "entity_code",
    "RWA Calc": "rwa_calc",
    "Markets Filter": "markets_filter",
}


def clean_header(header: str) -> str:
    """Collapse runs of blanks; source files disagree on double spaces."""
    return re.sub(r"\s+", " ", header).strip()


def canonical(header: str) -> str:
    """Canonical column name of a business header."""
    header = clean_header(header)
    if header in CANONICAL:
        return CANONICAL[header]
    return re.sub(r"[^0-9a-z]+", "_", header.lower()).strip("_")


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(header, kind) for header, kind in fields])


REGISTRY: dict[str, T.StructType] = {
    "balance_sheet": _struct(_BALANCE_SHEET),
    "convergence": _struct(_CONVERGENCE),
    "adjustments": _struct(_ADJUSTMENTS),
    "pug_mapping": _struct(_PUG),
    "pmf_rwa_mapping": _struct(_PMF),
    "quarter_map": _struct(_QUARTER_MAP),
}

# Headers of output columns, by canonical name.
OUTPUT_HEADERS = {
    "year": "YEAR",
    "month": "Month",
    "balances": "Balances",
    "quarter_id": "Quarter Id",
    "seg_l4_desc": "Managed Segment L4 Descr",
    "seg_l3_desc": "Managed Segment L3 Descr",
    "seg_l2_desc": "Managed Segment L2 Descr",
    "seg_l4_id": "Managed Segment L4 Id",
    "seg_l3_id": "Managed Segment L3 Id",
    "seg_l2_id": "Managed Segment L2 Id",
    "geo_l4_desc": "Managed Geography L4 Descr",
    "geo_l3_desc": "Managed Geography L3 Descr",
    "pmf_l5": "PMF Account L5 Descr",
    "exposure_type": "RWA Exposure Type",
    "sa_rwa": "SA RWA",
    "aa_rwa": "AA RWA",
    "erba_rwa": "ERBA RWA",
    "sa_rwf": "SA RWF",
    "aa_rwf": "AA RWF",
    "final_sa_rwf": "FINAL_SA_RWF",
    "final_aa_rwf": "FINAL_AA_RWF",
    "comment": "Comment",
    "entity_code": "Entity",
    "reporting_layer": "Reporting Layer",
    "sa_account": "SA Account #",
    "aa_account": "AA Account #",
    "pug": "PUG",
    "rwa_calc": "RWA Calc",
    "markets_filter": "Markets Filter",
    "period": "Period",
    "rwa_amount": "RWA Amount",
}


def output_header(name: str) -> str:
    """Business header of a canonical column, numbered keys included."""
    if name in OUTPUT_HEADERS:
        return OUTPUT_HEADERS[name]
    numbered = re.fullmatch(r"(sa|aa)_rwf_key(\d+)(_adj)?", name)
    if numbered:
        calc, number, suffix = numbered.groups()
        return f"{calc.upper()} RWF_key{number}{suffix or ''}"
    if re.fullmatch(r"key\d+", name):
        return name.capitalize()
    return name


def load_registry(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """Schemas from a registry CSV: schema key, column name and type name, one row per column.

    Type names follow the usual column-store spelling (Int64, Float64, Utf8,
    String); anything else reads as text. The file has a row per column of a
    schema, so it fits the driver.
    """
    kinds = {"int64": LONG, "float64": DOUBLE}
    registry: dict[str, T.StructType] = {}
    for key, column, kind in spark.read.option("header", True).csv(path).collect():
        schema = registry.setdefault(key, T.StructType())
        schema.add(clean_header(column), kinds.get(kind.lower(), TEXT))
    return registry
