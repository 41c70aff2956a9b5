"""Business rules: every list, code and threshold the operators share."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Names, codes, lists and thresholds that results depend on.
# ---------------------------------------------------------------------------

# Accounts whose exposures feed the risk-weight factors.
FACTOR_ACCOUNTS = (
    "Deposits with Banks (L2)",
    "Investments (L2)",
    "Letters of Credit (L2)",
    "Other Assets (L2)",
    "Total Loans & Leases Net of Unearned (L2)",
    "Unused Commitments (L2)",
)

# Accounts that never carry credit-risk RWA: their SA and AA RWA is 0.
ZERO_RWA_ACCOUNTS = (
    "Commitments to Purchase Forward-Dated Securities (L2)",
    "Commitments to Sell Forward-Dated Securities (L2)",
    "Trading Account Assets (L2)",
    "Trading Account Liabilities (L2)",
    "Unsettled Trading Loans (L2)",
    "Brokerage Receivables (L2)",
    "Federal Funds Purch and Sec Loaned or Sold Under Repurchase Agreements (L2)",
    "Federal Funds Sold and Resales (L2)",
    "Securities Borrowed (L2)",
    "Securities Lent (L2)",
    "Other Liabilities (L2)",
    "Indirect Assets (L2)",
    "Premise and Equipment Net of Depreciation and Amortization (L2)",
    "Other Assets L3",
)

MARKETS_L2 = "Markets [L2]"
DISCONTINUED_L2 = "Discontinued Ops [L2]"
LEGACY_FRANCHISES_L3 = "Legacy Franchises [L3]"
LEGACY_HOLDINGS_L4 = "Legacy Holdings Assets [L4]"
LATIN_AMERICA_L3 = "Latin America"

LAYER_HOLDINGS = "Legacy Holdings"
LAYER_HOLDINGS_OTHER = "Legacy Holdings Other"
LAYER_LATIN_AMERICA = "Legacy - Latin America"
LAYER_NON_LEGACY = "Non Legacy"

RWF_CAP = 12.5
ERBA_QUARTERS = (5, 6)
COVERED_QUARTERS = (1, 2, 3, 4, 5, 6, 7)
QUARTER_END_MONTHS = {1: "Mar", 2: "Jun", 3: "Sep", 4: "Dec"}

DEFAULT_SA_ACCOUNT = "663722"
DEFAULT_AA_ACCOUNT = "664062"
NO_ACCOUNT = "N/A"

ACTUALS_LABEL = "RWA Actuals"
UNKNOWN_QUARTER = "Unknown"
NULL_TEXT = "None"

# Balance periods: month label <- source columns of that quarter, in month
# order. Balances are end-of-period snapshots, so the last column wins and
# months are never added up.
BALANCE_PERIODS = {
    "Mar": ("m3",),
    "Jun": ("m6",),
    "Sep": ("m9",),
    "Dec": ("m12",),
}
MONTHS = tuple(BALANCE_PERIODS)

# Constant columns of the upload template.
UPLOAD_CONSTANTS = {
    "FileType": "R",
    "Affiliate": "00000",
    "BalanceType": "EOP",
    "Currency": "USD",
    "ManagedGeo": "",
    "FrsBu": "",
    "CustomerSegment": "",
    "Product": "",
    "Project": "",
    "TransactionId": "",
    "Layer": "",
    "ModelId": "",
    "MDRM": "",
    "ReasonCode": "",
    "Comments": "",
}

# Upload template layout: these columns, the actuals, the quarters, the tail.
UPLOAD_LEADING = (
    "Reporting Layer",
    "Managed Segment L2 Descr",
    "Managed Segment L3 Descr",
    "RWA Calc",
    "PMF Account L5 Descr",
    "FileType",
    "Managed Segment L4 Descr",
    "ManagedGeo",
    "PUG",
    "FrsBu",
    "CustomerSegment",
    "Product",
    "Entity",
    "Affiliate",
    "Project",
    "TransactionId",
    "Account",
    "BalanceType",
    "Currency",
    "Layer",
    "ModelId",
    "MDRM",
    "ReasonCode",
    "Comments",
)
UPLOAD_TRAILING = ("Comment", "RWA Exposure Type", "Markets Filter")

# Data-quality limits, in percent of rows.
DQ_WARN_PCT = 0.0
DQ_FAIL_PCT = 5.0
DQ_ADJUSTMENT_ACCOUNT_FAIL_PCT = 30.0
DQ_SAMPLE_VALUES = 5

# Table comparison.
DIFF_ATOL = 1e-6
DIFF_RTOL = 1e-5
DIFF_SAMPLES = 10
DIFF_KEYS = (
    (
        "Managed Segment L4 Id",
        "Managed Geography L4 Descr",
        "PMF Account L5 Descr",
        "Quarter Id",
    ),
    (
        "Managed Segment L4 Descr",
        "Managed Geography L4 Descr",
        "PMF Account L5 Descr",
        "Quarter Id",
    ),
    (
        "Reporting Layer",
        "Managed Segment L2 Descr",
        "Managed Segment L3 Descr",
        "RWA Calc",
        "PMF Account L5 Descr",
    ),
)

# Target-database limits.
MAX_IDENTIFIER = 30
MAX_TEXT_WIDTH = 4000
TEXT_PADDING = 10
INSERT_BATCH = 1000


# ---------------------------------------------------------------------------
# Entities and waterfall keys
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Entity:
    """A reporting entity: its flag and advanced-RWA columns in the convergence table."""

    name: str
    code: str
    flag: str
    adv_rwa: str


ENTITIES = (
    Entity("CG", "BA", "is_cg", "adv_cg_amt"),
    Entity("CBNA", "BB", "is_cbna", "adv_cbna_amt"),
)


@dataclass(frozen=True)
class KeyField:
    """One part of a waterfall key.

    ``outlook`` is None for a part that only splits the lookup groups and takes
    no part in the join; ``whole`` marks ids compared as whole numbers.
    """

    lookup: str
    outlook: str | None = None
    whole: bool = False


_L2_SPLIT = KeyField("seg_l2_desc")
_GEO_L4 = KeyField("geo_l4_desc", "geo_l4_desc")
_GEO_L3 = KeyField("geo_l3_desc", "geo_l3_desc")
_ACCOUNT = KeyField("pmf_l5", "pmf_l5")


def _segment(level: int) -> KeyField:
    return KeyField(f"seg_l{level}_code", f"seg_l{level}_id", whole=True)


# Most specific first.
WATERFALL_KEYS = (
    (_segment(4), _GEO_L4, _ACCOUNT, _L2_SPLIT),
    (_segment(3), _GEO_L4, _ACCOUNT, _L2_SPLIT),
    (_segment(2), _GEO_L4, _ACCOUNT, _L2_SPLIT),
    (_segment(3), _GEO_L3, _ACCOUNT, _L2_SPLIT),
    (_segment(3), _ACCOUNT, _L2_SPLIT),
)


def rwf_columns(calc: str, n_keys: int) -> list[str]:
    """Factor column names of one calc ('sa' or 'aa'), most specific first."""
    return [f"{calc}_rwf"] + [f"{calc}_rwf_key{i}" for i in range(2, n_keys + 1)]
