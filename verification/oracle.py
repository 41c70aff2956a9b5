"""Checking SQL: one statement per registered query, over the given tables.

Statements are put together from named common table expressions. They restate
the rules on their own and share nothing with the engine but the input tables.
"""

from __future__ import annotations

import re

from verification.views import VIEWS, check_sql

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
FACTOR_ACCOUNTS = """('Deposits with Banks (L2)', 'Investments (L2)', 'Letters of Credit (L2)', 'Other Assets (L2)',
  'Total Loans & Leases Net of Unearned (L2)', 'Unused Commitments (L2)')"""
# Those of the accounts without credit risk that the given tables can hold.
ZERO_ACCOUNTS = "('Trading Account Assets (L2)', 'Other Liabilities (L2)')"
MARKETS = "'Markets [L2]'"
LABELS = ["RWA Actuals", "Jun 2025", "Sep 2025", "Dec 2025", "Mar 2026", "Jun 2026", "Sep 2026", "Dec 2026"]
STAMP = "2025-01-01T00:00:00+00:00"

# Key level -> lookup columns, with the outlook columns they join to.
LEVELS = {
    1: {"seg_l4_code": "seg_l4_id", "geo_l4_desc": "geo_l4_desc", "pmf_l5": "pmf_l5"},
    2: {"seg_l3_code": "seg_l3_id", "geo_l4_desc": "geo_l4_desc", "pmf_l5": "pmf_l5"},
    3: {"seg_l2_code": "seg_l2_id", "geo_l4_desc": "geo_l4_desc", "pmf_l5": "pmf_l5"},
    4: {"seg_l3_code": "seg_l3_id", "geo_l3_desc": "geo_l3_desc", "pmf_l5": "pmf_l5"},
    5: {"seg_l3_code": "seg_l3_id", "pmf_l5": "pmf_l5"},
}
KEY_COLUMNS = ["seg_l4_code", "geo_l4_desc", "pmf_l5", "seg_l2_desc", "seg_l3_code", "seg_l2_code", "geo_l3_desc"]
GRAIN = [
    "entity", "year", "seg_l4_desc", "seg_l3_desc", "seg_l2_desc", "geo_l4_desc", "geo_l3_desc", "pmf_l5",
    "seg_l4_id", "seg_l3_id", "seg_l2_id",
]
LONG = ["entity", "year", "month", "seg_l4_desc", "seg_l3_desc", "seg_l2_desc", "geo_l4_desc", "geo_l3_desc", "pmf_l5"]
ADDON = [
    "entity", "quarter_id", "seg_l4_desc", "seg_l3_desc", "seg_l2_desc", "geo_l4_desc", "geo_l3_desc", "pmf_l5",
    "seg_l4_code", "seg_l3_code", "seg_l2_code", "exposure_type",
]
UPLOAD = [
    "seg_l4_desc", "seg_l3_desc", "seg_l2_desc", "pmf_l5", "comment", "exposure_type", "entity_code",
    "reporting_layer", "sa_account", "aa_account", "pug",
]
DIFF_KEY = ["entity", "year", "seg_l4_desc", "geo_l4_desc", "geo_l3_desc", "pmf_l5"]
RWF = [f"{c}_rwf{s}" for c in ("sa", "aa") for s in ("", "_key2", "_key3", "_key4", "_key5")]


def cols(names: list[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


def present(names: list[str]) -> str:
    return " AND ".join(f"{n} IS NOT NULL" for n in names)


def dbl(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def ratio(rwa: str, gaap: str) -> str:
    r, g = f"CAST({rwa} AS DOUBLE)", f"CAST({gaap} AS DOUBLE)"
    return f"CASE WHEN {gaap} = 0 THEN CASE WHEN {rwa} <> 0 THEN 1.0::DOUBLE END WHEN abs({r} / {g}) > 12.5 THEN 1.0::DOUBLE ELSE {r} / {g} END"


def level_sums(level: int) -> str:
    used = [*LEVELS[level], "seg_l2_desc"]
    shown = ", ".join(c if c in used else f"NULL AS {c}" for c in KEY_COLUMNS)
    return f"""SELECT {level} AS key_level, entity, quarter_id, {shown},
        COALESCE(SUM(gaap_amt), 0) AS gaap_amt, COALESCE(SUM(sa_rwa_amt), 0) AS sa_rwa_amt,
        COALESCE(SUM(adv_rwa_amt), 0) AS adv_rwa_amt
      FROM credit_risk WHERE {present([*used, 'quarter_id'])} GROUP BY entity, quarter_id, {cols(used)}"""


def level_factors(level: int) -> str:
    """The factors of one key level, as a table of its own."""
    keys = list(LEVELS[level])
    return f"""SELECT entity, quarter_id, {cols(keys)}, CASE WHEN {IS_MARKETS} THEN NULL ELSE {ratio('sa_rwa_amt', 'gaap_amt')} END AS sa_rwf,
        CASE WHEN {IS_MARKETS} THEN NULL ELSE {ratio('adv_rwa_amt', 'gaap_amt')} END AS aa_rwf FROM ({level_sums(level)}) s"""


def num(column: str) -> str:
    """A number; the text NaN is none."""
    return f"NULLIF(TRY_CAST({column} AS DOUBLE), 'NaN'::DOUBLE)"


def waterfall() -> str:
    shown, joins = [], []
    for i, key in LEVELS.items():
        suffix = "" if i == 1 else f"_key{i}"
        shown += [f"f{i}.sa_rwf AS sa_rwf{suffix}", f"f{i}.aa_rwf AS aa_rwf{suffix}"]
        on = " AND ".join(f"o.{right} = f{i}.{left}" for left, right in key.items())
        joins.append(
            f"LEFT JOIN factor_{i} f{i} ON f{i}.entity = o.entity AND f{i}.quarter_id = o.quarter_id AND {on}"
        )
    return f"SELECT o.*, {', '.join(shown)} FROM keyed o {' '.join(joins)}"


def conditional(calc: str, column: str, names: dict[int, str], empty: str) -> str:
    """Quarter columns of one calc: the sum, or ``empty`` where a quarter has no rows."""
    sums = ", ".join(
        f'COALESCE(SUM(COALESCE({column}, 0)) FILTER (WHERE quarter_id = {q}), {empty}) AS "{n}"'
        for q, n in names.items()
    )
    return f"'{calc}' AS rwa_calc, {sums}"


Q_NAMES = {q: f"q{q}" for q in range(8)}
Q_LABELS = dict(enumerate(LABELS))
# Quarters beyond the calendar occur in the exposures and in the adjustments.
HISTORY_QUARTERS = {**Q_NAMES, 9: "q9"}
RAW_QUARTERS = {**Q_NAMES, 5000: "q5000"}


def union(parts: list[str], by_name: bool = False) -> str:
    return f" UNION ALL {'BY NAME ' if by_name else ''}".join(parts)


def control(rows: str, sa: str, aa: str, names: dict[int, str], extra: str = "") -> str:
    dims = "entity, seg_l2_desc"
    return union(
        [
            f"SELECT {dims}, {conditional(calc, column, names, 'NULL')} FROM {rows}"
            f" WHERE {present(['seg_l2_desc', 'quarter_id'])} {extra} GROUP BY {dims}"
            for calc, column in (("SA RWA", sa), ("AA RWA", aa))
        ]
    )


def cents(names: list[str]) -> str:
    return ", ".join(f'round("{n}") AS "{n}"' for n in names)


def grouped(n: str) -> str:
    return f"format('{{:,}}', CAST({n} AS BIGINT))"


def pct1(failing: str, total: str) -> str:
    return f"printf('%.1f', CASE WHEN {total} = 0 THEN 0.0::DOUBLE ELSE {failing}::DOUBLE / {total} * 100 END)"


def status(failing: str, total: str, limit: float = 5) -> str:
    pct = f"{failing}::DOUBLE / NULLIF({total}, 0) * 100"
    return f"CASE WHEN {total} = 0 THEN 'WARN' WHEN {pct} > {limit} THEN 'FAIL' WHEN {pct} > 0 THEN 'WARN' ELSE 'PASS' END"


def check(source: str, name: str, dataset: str, failing: str, total: str, detail: str, state: str | None = None) -> str:
    return f"""SELECT {name} AS check_name, {dataset} AS dataset, {state or status(failing, total)} AS status,
      {detail} AS detail, CAST({failing} AS BIGINT) AS n_failing, CAST({total} AS BIGINT) AS n_total,
      CASE WHEN {total} = 0 THEN 0.0::DOUBLE ELSE round({failing}::DOUBLE / {total} * 100, 2) END AS pct_failing
      FROM {source}"""


def row_count(source: str, dataset: str, n: str = "n") -> str:
    return check(
        source, "'row_count_nonzero'", dataset, f"(CASE WHEN {n} = 0 THEN 1 ELSE 0 END)", "1",
        f"{grouped(n)} || ' rows'", f"CASE WHEN {n} = 0 THEN 'FAIL' ELSE 'PASS' END",
    )


def null_rate(source: str, name: str, column: str, dataset: str, nulls: str, n: str = "n", limit: float = 5) -> str:
    detail = (
        f"{grouped(nulls)} || '/' || {grouped(n)} || ' (' || {pct1(nulls, n)} || '%) null values in ''{column}'''"
    )
    return check(source, f"'{name}'", dataset, nulls, n, detail, status(nulls, n, limit))


def join_match(source: str, name: str, dataset: str, missing: str, n: str) -> str:
    detail = (
        f"{grouped(missing)} || '/' || {grouped(n)} || ' (' || {pct1(missing, n)}"
        " || '%) rows with a key have no join match'"
    )
    return check(source, f"'{name}'", dataset, missing, n, detail)


def allowed(column: str, values: list[str], name: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    source = f"""(SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE {column} NOT IN ({listed})) AS bad,
        (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT {column} AS v FROM convergence
           WHERE {column} NOT IN ({listed}) ORDER BY v LIMIT 5) few) AS samples FROM convergence) s"""
    detail = (
        f"CASE WHEN bad = 0 THEN 'All values in allowed set [{', '.join(sorted(values))}]' ELSE "
        f"{grouped('bad')} || '/' || {grouped('n')} || ' rows have unexpected values (sample: [' || samples || '])' END"
    )
    return check(source, f"'{name}'", "'convergence'", "bad", "n", detail)


def waterfall_checks() -> str:
    parts = []
    for calc in ("sa", "aa"):
        label = calc.upper()
        for i in range(1, 6):
            c = f"{calc}_rwf" + ("" if i == 1 else f"_key{i}")
            detail = (
                f"'Key{i} {label} RWF: ' || {grouped(c)} || '/' || {grouped('n')} || ' (' || {pct1(c, 'n')} || '%) matched'"
            )
            parts.append(
                check("outlook_counts", f"'waterfall_key{i}_{calc}_match_rate'", "lower(entity) || '_outlook'",
                      f"(n - {c})", "n", detail, "'PASS'")
            )
        lost = f"(n - final_{calc}_rwf)"
        detail = (
            f"{grouped(lost)} || '/' || {grouped('n')} || ' (' || {pct1(lost, 'n')}"
            f" || '%) rows fell through all 5 {label} RWF keys'"
        )
        parts.append(
            check("outlook_counts", f"'waterfall_{calc}_fallthrough_rate'", "lower(entity) || '_outlook'", lost, "n", detail)
        )
    return union(parts)


COUNTED = [*RWF, "final_sa_rwf", "final_aa_rwf"]
FRM_DATASET = "lower(entity) || '_frm_output'"
JOIN_CHECKS = union(
    [
        row_count("frm_counts", FRM_DATASET),
        join_match("frm_counts", "pug_join_match_rate", FRM_DATASET, "pug_lost", "pug_n"),
        join_match("frm_counts", "pmf_join_match_rate", FRM_DATASET, "pmf_lost", "pmf_n"),
    ]
)
COVERAGE = check(
    """(SELECT entity, qs, [q FOR q IN [1, 2, 3, 4, 5, 6, 7] IF NOT list_contains(qs, q)] AS missing
        FROM (SELECT entity, list_sort(list(DISTINCT quarter_id)) AS qs FROM frm GROUP BY entity) a) s""",
    "'quarter_coverage'", FRM_DATASET, "len(missing)", "7",
    """'Quarters present: [' || array_to_string(qs, ', ') || ']; missing: '
       || CASE WHEN len(missing) = 0 THEN 'none' ELSE '[' || array_to_string(missing, ', ') || ']' END""",
    "CASE WHEN len(missing) > 0 THEN 'FAIL' ELSE 'PASS' END",
)
ABSENT = [
    "ccar_cycle", "scope", "managed_segment_level_1_code", "version_number", "fiscal_year_accounting_period",
    "data_category", "scenario_id", "scenario_name", "error_flag",
    "managed_segment_level_1_description", "comments",
]
REQUIRED = check(
    "(SELECT 1 AS one) s", "'required_columns'", "'convergence'", "11", "29",
    f"'Missing 11/29 columns: [{', '.join(ABSENT[:5])}] … and 6 more'", "'FAIL'",
)
CONVERGENCE_COUNTS = """(SELECT COUNT(*) AS n, COUNT(*) - COUNT(projected_quarter) AS pq, COUNT(*) - COUNT(pmf_l5) AS pmf,
    COUNT(*) - COUNT(seg_l2_desc) AS l2, COUNT(*) - COUNT(exposure_type) AS et FROM convergence) s"""
ADJUSTMENT_COUNTS = """(SELECT entity, COUNT(*) AS n, COUNT(*) - COUNT(quarter_id) AS q, COUNT(*) - COUNT(pmf_l5) AS p
    FROM adjustments GROUP BY entity) s"""
ADJ_DATASET = "lower(entity) || '_adjustments'"
DQ_REPORT = union(
    [
        row_count("(SELECT COUNT(*) AS n FROM convergence) s", "'convergence'"),
        row_count("outlook_counts", "lower(entity) || '_outlook'"),
        REQUIRED,
        allowed("is_cg", ["Y", "N"], "entity_flag_values"),
        allowed("is_cbna", ["Y", "N"], "entity_flag_values"),
        null_rate(CONVERGENCE_COUNTS, "projected_quarter_nulls", "projected_quarter", "'convergence'", "pq"),
        null_rate(CONVERGENCE_COUNTS, "finance_pmf_l5_nulls", "pmf_l5", "'convergence'", "pmf"),
        null_rate(CONVERGENCE_COUNTS, "mngd_sgmt_l2_nulls", "seg_l2_desc", "'convergence'", "l2"),
        waterfall_checks(),
        row_count(ADJUSTMENT_COUNTS, ADJ_DATASET),
        null_rate(ADJUSTMENT_COUNTS, "quarter_id_nulls", "quarter_id", ADJ_DATASET, "q"),
        null_rate(ADJUSTMENT_COUNTS, "pmf_l5_nulls", "pmf_l5", ADJ_DATASET, "p", limit=30),
        JOIN_CHECKS,
        COVERAGE,
    ]
)

BUCKET = """entity, seg_l2_desc, pmf_l5, quarter_id, COUNT(*) AS n_rows, CAST(SUM(gaap_amt) AS DOUBLE) AS gaap_amt,
  CAST(SUM(sa_rwa_amt) AS DOUBLE) AS sa_rwa_amt, CAST(SUM(adv_rwa_amt) AS DOUBLE) AS adv_rwa_amt"""
BUCKET_BY = "GROUP BY entity, seg_l2_desc, pmf_l5, quarter_id"


def addon_sums(where: str) -> str:
    """Add-on totals of one bucket at the add-on grain; the quarter may be unknown."""
    dims = [d for d in ADDON if d != "quarter_id"]
    return f"""SELECT {cols(ADDON)}, COALESCE(SUM(sa_rwa_amt), 0) AS sa_rwa_amt, COALESCE(SUM(adv_rwa_amt), 0) AS adv_rwa_amt
      FROM projected WHERE {where} AND {present(dims)} GROUP BY {cols(ADDON)}"""


IS_MARKETS = f"seg_l2_desc = {MARKETS}"
IS_OTHER = f"pmf_l5 NOT IN {FACTOR_ACCOUNTS} AND seg_l2_desc IS DISTINCT FROM {MARKETS}"

CTES = {
    **{name: check_sql(name) for name in VIEWS},
    "quarter_map": """SELECT i AS quarter_id, CAST(year(d) AS BIGINT) AS year, strftime(d, '%b') AS month
        FROM (SELECT i, DATE '2025-03-01' + to_months(CAST(3 * i AS INTEGER)) AS d FROM range(8) t(i)) days""",
    "entity_rows": """SELECT 'CG' AS entity, c.* EXCLUDE (is_cg, is_cbna, adv_cg_amt, adv_cbna_amt), adv_cg_amt AS adv_rwa_amt
        FROM convergence c WHERE is_cg = 'Y'
        UNION ALL BY NAME
        SELECT 'CBNA' AS entity, c.* EXCLUDE (is_cg, is_cbna, adv_cg_amt, adv_cbna_amt), adv_cbna_amt AS adv_rwa_amt
        FROM convergence c WHERE is_cbna = 'Y'""",
    "credit_risk": f"SELECT * FROM entity_rows WHERE pmf_l5 IN {FACTOR_ACCOUNTS}",
    "key_sums": union([level_sums(i) for i in LEVELS], by_name=True),
    "ratios": f"""SELECT *, {ratio('sa_rwa_amt', 'gaap_amt')} AS sa_rwf, {ratio('adv_rwa_amt', 'gaap_amt')} AS aa_rwf
        FROM key_sums""",
    "factors": f"""SELECT * REPLACE (CASE WHEN {IS_MARKETS} THEN NULL ELSE sa_rwf END AS sa_rwf,
        CASE WHEN {IS_MARKETS} THEN NULL ELSE aa_rwf END AS aa_rwf) FROM ratios""",
    "balances": "SELECT * REPLACE (COALESCE(pmf_l5, 'None') AS pmf_l5) FROM balance_sheet",
    "quarterly": f"""SELECT {cols(GRAIN)}, COALESCE(SUM(m3), 0) AS Mar, COALESCE(SUM(m6), 0) AS Jun,
        COALESCE(SUM(m9), 0) AS Sep, COALESCE(SUM(m12), 0) AS Dec
        FROM balances WHERE {present(GRAIN)} GROUP BY {cols(GRAIN)}""",
    "outlook_long": union(
        [f"SELECT {cols(GRAIN)}, '{m}' AS month, {m} AS balances FROM quarterly" for m in ("Mar", "Jun", "Sep", "Dec")]
    ),
    "dated": "SELECT o.*, q.quarter_id FROM outlook_long o LEFT JOIN quarter_map q ON o.year = q.year AND o.month = q.month",
    "keyed": """SELECT *,
        seg_l4_id || geo_l4_desc || pmf_l5 || COALESCE(CAST(quarter_id AS VARCHAR), 'Unknown') AS key1,
        seg_l3_id || geo_l4_desc || pmf_l5 || COALESCE(CAST(quarter_id AS VARCHAR), 'Unknown') AS key2,
        seg_l2_id || geo_l4_desc || pmf_l5 || COALESCE(CAST(quarter_id AS VARCHAR), 'Unknown') AS key3,
        seg_l3_id || geo_l3_desc || pmf_l5 || COALESCE(CAST(quarter_id AS VARCHAR), 'Unknown') AS key4,
        seg_l3_id || pmf_l5 || COALESCE(CAST(quarter_id AS VARCHAR), 'Unknown') AS key5
        FROM dated""",
    **{f"factor_{i}": level_factors(i) for i in LEVELS},
    "fallen": waterfall(),
    "adjusted": f"""SELECT o.*, a.exposure_type, {num('a.sa_rwf')} AS sa_rwf_adj, {num('a.aa_rwf')} AS aa_rwf_adj,
        {num('a.sa_rwf_key2')} AS sa_rwf_key2_adj, {num('a.aa_rwf_key2')} AS aa_rwf_key2_adj
        FROM fallen o LEFT JOIN adjustments a ON a.entity = o.entity AND a.seg_l4_id = o.seg_l4_id
          AND a.geo_l4_desc = o.geo_l4_desc AND COALESCE(a.pmf_l5, 'None') = o.pmf_l5
          AND TRY_CAST(a.quarter_id AS BIGINT) = o.quarter_id""",
    "finals": """SELECT *,
        COALESCE(sa_rwf, sa_rwf_key2, sa_rwf_key2_adj, sa_rwf_key3, sa_rwf_key4, sa_rwf_key5) AS final_sa_rwf,
        COALESCE(aa_rwf, aa_rwf_key2, aa_rwf_key2_adj, aa_rwf_key3, aa_rwf_key4, aa_rwf_key5) AS final_aa_rwf
        FROM adjusted""",
    "projected_rwa": f"""SELECT *,
        CASE WHEN pmf_l5 IN {ZERO_ACCOUNTS} THEN 0.0::DOUBLE ELSE CAST(balances AS DOUBLE) * final_sa_rwf END AS sa_rwa,
        CASE WHEN pmf_l5 IN {ZERO_ACCOUNTS} THEN 0.0::DOUBLE ELSE CAST(balances AS DOUBLE) * final_aa_rwf END AS aa_rwa
        FROM finals""",
    "outlook": "SELECT *, CASE WHEN quarter_id IN (5, 6) THEN sa_rwa END AS erba_rwa, '' AS comment FROM projected_rwa",
    "outlook_counts": f"""SELECT entity, COUNT(*) AS n, {', '.join(f'COUNT({c}) AS {c}' for c in COUNTED)}
        FROM outlook GROUP BY entity""",
    "projected": """SELECT r.* EXCLUDE (quarter_id) REPLACE (COALESCE(r.pmf_l5, 'None') AS pmf_l5), m.year, m.month, m.quarter_id
        FROM (SELECT *, TRY_CAST('20' || substr(projected_quarter, 3) AS BIGINT) AS py,
                CASE substr(projected_quarter, 1, 1) WHEN '1' THEN 'Mar' WHEN '2' THEN 'Jun' WHEN '3' THEN 'Sep'
                  WHEN '4' THEN 'Dec' END AS pm FROM entity_rows) r
        LEFT JOIN quarter_map m ON m.year = r.py AND m.month = r.pm""",
    "markets_sums": addon_sums(IS_MARKETS),
    "other_sums": addon_sums(IS_OTHER),
    "addon": """SELECT s.*, CASE WHEN s.quarter_id IN (5, 6) THEN sa_rwa_amt END AS erba_rwa, '' AS comment, m.year, m.month
        FROM (SELECT * FROM markets_sums UNION ALL SELECT * FROM other_sums) s
        LEFT JOIN quarter_map m ON m.quarter_id = s.quarter_id""",
    "filled_adjustments": f"""SELECT entity, year, COALESCE(seg_l4_desc, 'N/A') AS seg_l4_desc, COALESCE(seg_l3_desc, 'N/A') AS seg_l3_desc,
        COALESCE(seg_l2_desc, 'N/A') AS seg_l2_desc, COALESCE(geo_l4_desc, 'N/A') AS geo_l4_desc,
        COALESCE(geo_l3_desc, 'N/A') AS geo_l3_desc, COALESCE(pmf_l5, 'N/A') AS pmf_l5, seg_l4_id, seg_l3_id, seg_l2_id, month,
        COALESCE({num('balances')}, 0) AS balances, COALESCE(NULLIF(quarter_id, ''), 'N/A') AS quarter_id,
        COALESCE(sa_rwa, 0) AS sa_rwa, COALESCE(aa_rwa, 0) AS aa_rwa, COALESCE(erba_rwa, 0) AS erba_rwa,
        COALESCE(NULLIF(comment, ''), 'N/A') AS comment, COALESCE(NULLIF(exposure_type, ''), 'N/A') AS exposure_type,
        COALESCE({num('sa_rwf')}, 0) AS sa_rwf, COALESCE({num('aa_rwf')}, 0) AS aa_rwf,
        COALESCE({num('sa_rwf_key2')}, 0) AS sa_rwf_key2, COALESCE({num('aa_rwf_key2')}, 0) AS aa_rwf_key2
        FROM adjustments""",
    "stacked": """SELECT entity, TRY_CAST(quarter_id AS BIGINT) AS quarter_id, month, seg_l4_desc, seg_l3_desc, seg_l2_desc,
          geo_l4_desc, geo_l3_desc, pmf_l5, CAST(balances AS DOUBLE) AS balances, CAST(sa_rwa AS DOUBLE) AS sa_rwa,
          CAST(aa_rwa AS DOUBLE) AS aa_rwa, CAST(erba_rwa AS DOUBLE) AS erba_rwa, comment, exposure_type
        FROM filled_adjustments
        UNION ALL BY NAME
        SELECT entity, quarter_id, month, seg_l4_desc, seg_l3_desc, seg_l2_desc, geo_l4_desc, geo_l3_desc, pmf_l5,
          CAST(balances AS DOUBLE) AS balances, sa_rwa, aa_rwa, erba_rwa, NULLIF(comment, '') AS comment,
          NULLIF(exposure_type, '') AS exposure_type, sa_rwf_key3
        FROM outlook
        UNION ALL BY NAME
        SELECT entity, quarter_id, month, seg_l4_desc, seg_l3_desc, seg_l2_desc, geo_l4_desc, geo_l3_desc, pmf_l5,
          CAST(sa_rwa_amt AS DOUBLE) AS sa_rwa, CAST(adv_rwa_amt AS DOUBLE) AS aa_rwa, CAST(erba_rwa AS DOUBLE) AS erba_rwa,
          NULLIF(comment, '') AS comment, NULLIF(exposure_type, '') AS exposure_type
        FROM addon""",
    "raw": """SELECT *, CASE entity WHEN 'CG' THEN 'BA' ELSE 'BB' END AS entity_code FROM stacked WHERE quarter_id IS NOT NULL""",
    "layered": """SELECT *, CASE WHEN seg_l3_desc = 'Legacy Franchises [L3]' AND seg_l4_desc = 'Legacy Holdings Assets [L4]'
          THEN 'Legacy Holdings' WHEN seg_l3_desc = 'Legacy Franchises [L3]' THEN 'Legacy Holdings Other'
          WHEN geo_l3_desc = 'Latin America' THEN 'Legacy - Latin America' ELSE 'Non Legacy' END AS reporting_layer
        FROM raw""",
    "pugged": """SELECT r.*, p.pug FROM layered r LEFT JOIN pug_mapping p ON r.seg_l4_desc IS NOT DISTINCT FROM p.seg_l4_desc""",
    "frm": """SELECT r.*, p.sa_account, p.aa_account FROM pugged r LEFT JOIN pmf_mapping p ON r.pmf_l5 IS NOT DISTINCT FROM p.pmf_l5""",
    "frm_counts": """SELECT entity, COUNT(*) AS n, COUNT(seg_l4_desc) AS pug_n,
        COUNT(*) FILTER (WHERE seg_l4_desc IS NOT NULL AND pug IS NULL) AS pug_lost, COUNT(pmf_l5) AS pmf_n,
        COUNT(*) FILTER (WHERE pmf_l5 IS NOT NULL AND sa_account IS NULL) AS pmf_lost FROM frm GROUP BY entity""",
    "pivot_ready": f"""SELECT quarter_id, sa_rwa, aa_rwa, erba_rwa, COALESCE(comment, '0') AS comment,
        COALESCE(exposure_type, '0') AS exposure_type,
        {', '.join(f"COALESCE({c}, 'None') AS {c}" for c in UPLOAD if c not in ('comment', 'exposure_type'))} FROM frm""",
    "calc_pivot": union(
        [
            f"SELECT {cols(UPLOAD)}, {conditional(calc, column, Q_NAMES, '0')} FROM pivot_ready GROUP BY {cols(UPLOAD)}"
            for calc, column in (("ERBA", "erba_rwa"), ("AA", "aa_rwa"), ("SA", "sa_rwa"))
        ]
    ),
    "labelled": """SELECT *, CASE WHEN rwa_calc = 'AA' THEN CASE aa_account WHEN 'None' THEN '664062' ELSE aa_account END
          WHEN rwa_calc = 'SA' THEN CASE sa_account WHEN 'None' THEN '663722' ELSE sa_account END ELSE 'N/A' END AS account,
        CASE WHEN seg_l2_desc = 'Markets [L2]' AND exposure_type <> '0' THEN 'Remove' ELSE 'Keep' END AS markets_filter
        FROM calc_pivot""",
    "template": f"""SELECT reporting_layer AS "Reporting Layer", seg_l2_desc AS "Managed Segment L2 Descr",
        seg_l3_desc AS "Managed Segment L3 Descr", rwa_calc AS "RWA Calc", pmf_l5 AS "PMF Account L5 Descr", 'R' AS "FileType",
        seg_l4_desc AS "Managed Segment L4 Descr", '' AS "ManagedGeo", pug AS "PUG", '' AS "FrsBu", '' AS "CustomerSegment",
        '' AS "Product", entity_code AS "Entity", '00000' AS "Affiliate", '' AS "Project", '' AS "TransactionId",
        account AS "Account", 'EOP' AS "BalanceType", 'USD' AS "Currency", '' AS "Layer", '' AS "ModelId", '' AS "MDRM",
        '' AS "ReasonCode", '' AS "Comments", {', '.join(f'{Q_NAMES[q]} AS "{n}"' for q, n in Q_LABELS.items())},
        comment AS "Comment", exposure_type AS "RWA Exposure Type", markets_filter AS "Markets Filter" FROM labelled""",
    "control_conv": control(
        "entity_rows", "sa_rwa_amt", "adv_rwa_amt", HISTORY_QUARTERS, "AND seg_l2_desc <> 'Discontinued Ops [L2]'"
    ),
    "control_stacked": control("raw", "sa_rwa", "aa_rwa", RAW_QUARTERS),
    "control_template": f"""SELECT "Entity", "Managed Segment L2 Descr", "RWA Calc" || ' RWA' AS "RWA Calc",
        {', '.join(f'SUM("{n}") AS "{n}"' for n in LABELS)} FROM template WHERE "RWA Calc" IN ('AA', 'SA')
        GROUP BY "Entity", "Managed Segment L2 Descr", "RWA Calc" """,
    "long_rows": union(
        [
            f"""SELECT entity_code, reporting_layer, seg_l2_desc, seg_l3_desc, seg_l4_desc, pmf_l5,
              CASE WHEN f.quarter_id = 0 THEN 'RWA Actuals' ELSE m.month || ' ' || m.year END AS period,
              '{c.upper()}' AS rwa_calc, {c}_rwa AS rwa_amount FROM frm f LEFT JOIN quarter_map m ON m.quarter_id = f.quarter_id"""
            for c in ("sa", "aa", "erba")
        ]
    ),
    # The coarse steps, under SQL null rules.
    "coarse_factors": f"""SELECT *, CASE WHEN {IS_MARKETS} THEN NULL ELSE {ratio('sa_rwa_amt', 'gaap_amt')} END AS sa_rwf,
          CASE WHEN {IS_MARKETS} THEN NULL ELSE {ratio('adv_rwa_amt', 'gaap_amt')} END AS aa_rwf
        FROM (SELECT entity, quarter_id, seg_l4_code, geo_l4_desc, pmf_l5, seg_l2_desc, SUM(gaap_amt) AS gaap_amt,
            SUM(sa_rwa_amt) AS sa_rwa_amt, SUM(adv_rwa_amt) AS adv_rwa_amt FROM credit_risk
          GROUP BY entity, quarter_id, seg_l4_code, geo_l4_desc, pmf_l5, seg_l2_desc) s""",
    "coarse_long": f"""SELECT {cols(GRAIN, 'p.')}, v.month, v.balances FROM (SELECT {cols(GRAIN)}, SUM(m3) AS a, SUM(m6) AS b,
          SUM(m9) AS c, SUM(m12) AS d FROM balance_sheet GROUP BY {cols(GRAIN)}) p
        CROSS JOIN LATERAL (VALUES ('Mar', a), ('Jun', b), ('Sep', c), ('Dec', d)) v(month, balances)""",
    "coarse_keyed": """SELECT o.*, q.quarter_id, CAST(o.seg_l4_id AS VARCHAR) || o.geo_l4_desc || o.pmf_l5
          || CAST(q.quarter_id AS VARCHAR) AS key1
        FROM coarse_long o LEFT JOIN quarter_map q ON o.year = q.year AND o.month = q.month""",
    "coarse_rwf": """SELECT o.*, w.sa_rwf AS final_sa_rwf, w.aa_rwf AS final_aa_rwf FROM coarse_keyed o LEFT JOIN coarse_factors w
        ON w.entity = o.entity AND w.seg_l4_code = o.seg_l4_id AND w.geo_l4_desc = o.geo_l4_desc AND w.pmf_l5 = o.pmf_l5
          AND w.quarter_id = o.quarter_id""",
    "coarse_rwa": f"""SELECT *, CASE WHEN quarter_id IN (5, 6) THEN sa_rwa END AS erba_rwa FROM (SELECT *,
        CASE WHEN pmf_l5 IN {ZERO_ACCOUNTS} THEN 0.0::DOUBLE ELSE CAST(balances AS DOUBLE) * final_sa_rwf END AS sa_rwa,
        CASE WHEN pmf_l5 IN {ZERO_ACCOUNTS} THEN 0.0::DOUBLE ELSE CAST(balances AS DOUBLE) * final_aa_rwf END AS aa_rwa
        FROM coarse_rwf) s""",
    "coarse_other": f"""SELECT * FROM entity_rows WHERE pmf_l5 NOT IN {FACTOR_ACCOUNTS} AND seg_l2_desc <> {MARKETS}""",
    "coarse_addon": f"""SELECT *, CASE WHEN quarter_id IN (5, 6) THEN sa_rwa_amt END AS erba_rwa FROM (
        SELECT entity, quarter_id, seg_l2_desc, pmf_l5, SUM(sa_rwa_amt) AS sa_rwa_amt, SUM(adv_rwa_amt) AS aa_rwa_amt
        FROM (SELECT entity, quarter_id, seg_l2_desc, pmf_l5, sa_rwa_amt, adv_rwa_amt FROM entity_rows WHERE {IS_MARKETS}
          UNION ALL SELECT entity, quarter_id, seg_l2_desc, pmf_l5, sa_rwa_amt, adv_rwa_amt FROM coarse_other) u
        GROUP BY entity, quarter_id, seg_l2_desc, pmf_l5) s""",
    "coarse_frm": """SELECT entity, quarter_id, seg_l4_desc, seg_l3_desc, seg_l2_desc, pmf_l5, sa_rwa, aa_rwa, erba_rwa,
          'outlook' AS source FROM coarse_rwa
        UNION ALL BY NAME
        SELECT entity, quarter_id, seg_l2_desc, pmf_l5, CAST(sa_rwa_amt AS DOUBLE) AS sa_rwa,
          CAST(aa_rwa_amt AS DOUBLE) AS aa_rwa, CAST(erba_rwa AS DOUBLE) AS erba_rwa, 'addon' AS source FROM coarse_addon""",
    "coarse_pivot": union(
        [
            "SELECT entity, seg_l2_desc, pmf_l5, "
            + conditional(calc, column, {**Q_NAMES, 0: "rwa_actuals"}, "NULL")
            + " FROM coarse_frm GROUP BY entity, seg_l2_desc, pmf_l5"
            for calc, column in (("ERBA", "erba_rwa"), ("AA", "aa_rwa"), ("SA", "sa_rwa"))
        ]
    ),
    "coarse_control": """SELECT entity, seg_l2_desc AS segment_l2, quarter_id, 'SA RWA' AS rwa_calc, SUM(sa_rwa_amt) AS rwa_amount
          FROM entity_rows WHERE seg_l2_desc <> 'Discontinued Ops [L2]' GROUP BY 1, 2, 3
        UNION ALL
        SELECT entity, seg_l2_desc, quarter_id, 'AA RWA', SUM(adv_rwa_amt)
          FROM entity_rows WHERE seg_l2_desc <> 'Discontinued Ops [L2]' GROUP BY 1, 2, 3""",
    # The compared pair: a balance table and an edited copy.
    "pair_a": f"""SELECT {cols(DIFF_KEY)}, SUM(m3) AS m3, SUM(m6) AS m6, MAX(seg_l2_desc) AS seg_l2_desc,
        CASE WHEN year = 2026 THEN '' ELSE 'x' END AS note
        FROM balance_sheet WHERE {present(DIFF_KEY)} GROUP BY {cols(DIFF_KEY)}""",
    "pair_b": """SELECT * REPLACE (CASE WHEN geo_l3_desc = 'EUROPE' THEN m3 * 2 ELSE m3 END AS m3, NULLIF(note, '') AS note,
          CASE WHEN geo_l4_desc = 'NATION_3' THEN year + 10 ELSE year END AS year), 1 AS added
        FROM pair_a WHERE year <> 2027 OR pmf_l5 <> 'Investments (L2)'""",
    "paired": f"""SELECT {', '.join(f'COALESCE(CAST(a.{k} AS VARCHAR), CAST(b.{k} AS VARCHAR)) AS {k}' for k in DIFF_KEY)},
        a.m3 AS a3, b.m3 AS b3, a.m6 AS a6, b.m6 AS b6, a.seg_l2_desc AS al, b.seg_l2_desc AS bl, a.note AS an, b.note AS bn,
        CASE WHEN a.entity IS NULL THEN 'right_only' WHEN b.entity IS NULL THEN 'left_only' ELSE 'both' END AS presence
        FROM pair_a a FULL JOIN pair_b b ON {' AND '.join(f'a.{k} = b.{k}' for k in DIFF_KEY)}""",
    "diffs": """SELECT COUNT(*) FILTER (WHERE presence = 'both' AND abs(a3 - b3) > 1e-6 + 1e-5 * abs(b3)) AS d3,
        COUNT(*) FILTER (WHERE presence = 'both' AND abs(a6 - b6) > 1e-6 + 1e-5 * abs(b6)) AS d6,
        COUNT(*) FILTER (WHERE presence = 'both' AND al IS DISTINCT FROM bl) AS dl,
        COUNT(*) FILTER (WHERE presence = 'both' AND COALESCE(an, '') <> COALESCE(bn, '')) AS dn,
        CAST(SUM(a3) AS DOUBLE) AS sa3, CAST(SUM(b3) AS DOUBLE) AS sb3, CAST(SUM(a6) AS DOUBLE) AS sa6,
        CAST(SUM(b6) AS DOUBLE) AS sb6 FROM paired""",
    "verdicts": """SELECT COUNT(*) FILTER (WHERE presence = 'both') AS "both", COUNT(*) FILTER (WHERE presence = 'left_only') AS left_only,
        COUNT(*) FILTER (WHERE presence = 'right_only') AS right_only FROM paired""",
}

SHEET = """SELECT year, seg_l4_id, seg_l4_desc, COUNT(*) AS n_rows, CAST(SUM(m3) AS DOUBLE) AS m3, COUNT(m12) AS n_m12
  FROM balance_sheet GROUP BY year, seg_l4_id, seg_l4_desc"""
BIG = {  # upload columns of the profile, in source order
    "entity": "entity", "year": "YEAR", "seg_l4_desc": "Managed Segment L4 Descr",
    "seg_l3_desc": "Managed Segment L3 Descr", "seg_l2_desc": "Managed Segment L2 Descr",
    "geo_l4_desc": "Managed Geography L4 Descr", "geo_l3_desc": "Managed Geography L3 Descr",
    "pmf_l5": "PMF Account L5 Descr", "seg_l4_id": "Managed Segment L4 Id", "seg_l3_id": "Managed Segment L3 Id",
    "seg_l2_id": "Managed Segment L2 Id", "m3": "m3", "m6": "m6", "m9": "m9", "m12": "m12",
}


def profile(table: str, kinds: dict[str, str], headers: dict[str, str], position: bool) -> str:
    """Column profile; ``kinds`` maps columns to string, bigint or double."""
    parts = []
    for i, (c, kind) in enumerate(kinds.items(), 1):
        header = headers.get(c, c)
        legal = re.sub(r"[^A-Za-z0-9_]", "_", header)[:30].upper()
        if kind == "string":
            seen = f"(SELECT COALESCE(MAX(length({c})), 1) FROM {table})"
            target = f"'VARCHAR2(' || least({seen} + 10, 4000) || ')'"
        else:
            seen = "NULL"
            target = "'NUMBER(18,0)'" if kind == "bigint" else "'FLOAT'"
        lead = f"{i} AS position, " if position else ""
        parts.append(
            f"SELECT {lead}'{header}' AS original, '{legal}' AS target_name, '{kind}' AS dtype, {target} AS target_type,"
            f" CAST({seen} AS INTEGER) AS max_observed_length"
        )
    return union(parts)


BALANCE_KINDS = {
    c: "double" if c.startswith("m") else "bigint" if c.endswith("_id") or c == "year" else "string" for c in BIG
}
ADJUSTMENT_KINDS = {
    c: "bigint" if c.endswith("_id") and c != "quarter_id" or c == "year" else "string"
    for c in (
        "entity", "year", "seg_l4_desc", "seg_l3_desc", "seg_l2_desc", "geo_l4_desc", "geo_l3_desc", "pmf_l5",
        "seg_l4_id", "seg_l3_id", "seg_l2_id", "month", "balances", "quarter_id", "sa_rwa", "aa_rwa", "erba_rwa",
        "comment", "exposure_type", "sa_rwf", "aa_rwf", "sa_rwf_key2", "aa_rwf_key2",
    )
} | {c: "double" for c in ("sa_rwa", "aa_rwa", "erba_rwa")}

STEP_COUNTS = {
    "conv_credit_risk": ("credit_risk", "sa_rwa_amt"),
    "conv_markets_addon": (f"(SELECT * FROM entity_rows WHERE {IS_MARKETS})", "sa_rwa_amt"),
    "conv_non_waterfall": ("coarse_other", "sa_rwa_amt"),
    "waterfall_rwf": ("coarse_factors", "sa_rwf"),
    "outlook_long": ("coarse_long", "balances"),
    "outlook_with_keys": ("coarse_keyed", "key1"),
    "outlook_with_rwf": ("coarse_rwf", "final_sa_rwf"),
    "projected_rwa": ("coarse_rwa", "sa_rwa"),
    "addon_pivot": ("coarse_addon", "erba_rwa"),
    "frm_base": ("coarse_frm", "sa_rwa"),
    "upload_template_pivot": ("coarse_pivot", "q1"),
    "control_summary": ("coarse_control", "rwa_amount"),
}
LONG_SQL = cols(LONG)
Q_LIST = list(Q_NAMES.values())
TEMPLATE_SQL = f'SELECT * REPLACE ({cents(LABELS)}) FROM template'
DQ_SQL = f"SELECT *, '{STAMP}' AS run_timestamp FROM ({DQ_REPORT}) r"
DIFF_VERDICT = """SELECT 'edited' AS pair, "both", left_only, right_only, CAST((d3 > 0)::INT + (d6 > 0)::INT + (dl > 0)::INT + (dn > 0)::INT AS BIGINT) AS failed_columns,
          CAST((abs(sa3 - sb3) > 1e-6 + 1e-5 * abs(sb3))::INT + (abs(sa6 - sb6) > 1e-6 + 1e-5 * abs(sb6))::INT AS BIGINT) AS failed_totals,
          false AS same_schema, false AS invariant FROM verdicts, diffs
        UNION ALL
        SELECT 'same', (SELECT COUNT(*) FROM pair_a), 0, 0, 0, 0, true, true"""
CHECKS = {
    "scan_typed": SHEET,
    "scan_csv": SHEET,
    "ingest_to_parquet": SHEET,
    "scan_fallback": SHEET,
    "undeclared_types": """SELECT year, CAST(SUM(CAST(concat(year, COALESCE(seg_l4_id, 0)) AS BIGINT)) AS BIGINT) AS load_no,
        CAST(SUM(CAST(m3 AS DECIMAL(18,0))) / 100 AS DOUBLE) AS rate, concat(year, '-03-31') AS as_of,
        COUNT(*) FILTER (WHERE m12 IS NULL) AS n_closed, concat('00', year % 10) AS code,
        MAX(CASE WHEN m12 IS NULL THEN 'n/a' ELSE CAST(year AS VARCHAR) END) AS mixed,
        'bigint,double,date,boolean,string,string' AS types FROM balance_sheet GROUP BY year""",
    "lost_values": """SELECT concat(c, '_lost_values') AS check_name, 'cg' AS dataset, n AS n_failing, total AS n_total,
          CASE WHEN n * 100.0 / total > 5 THEN 'FAIL' WHEN n > 0 THEN 'WARN' ELSE 'PASS' END AS status,
          printf('%s/%s (%.1f%%) values of ''%s'' do not fit its type', format('{:,}', n), format('{:,}', total),
            n * 100.0::DOUBLE / total, c) AS detail, round(n * 100.0::DOUBLE / total, 2) AS pct_failing
        FROM (SELECT COUNT(*) AS total, UNNEST(['YEAR', 'Managed Segment L4 Id', 'M3_USDOLLAR', 'M6_USDOLLAR', 'M9_USDOLLAR']) AS c,
          UNNEST([COUNT(*) FILTER (WHERE m12 IS NULL), COUNT(seg_l4_id) FILTER (WHERE year = 2026), 0,
            COUNT(*) FILTER (WHERE pmf_l5 IS NULL), 0]) AS n FROM balance_sheet) t""",
    "blank_to_null": """SELECT entity, NULLIF(exposure_type, '') AS exposure_type, COUNT(*) AS n_rows,
        COUNT(NULLIF(comment, '')) AS n_comment FROM adjustments GROUP BY 1, 2""",
    "sink_parquet": "SELECT entity, year, COUNT(*) AS n_rows, CAST(SUM(m3) AS DOUBLE) AS m3 FROM balance_sheet GROUP BY 1, 2",
    "sink_long": """SELECT entity_code, rwa_calc, period, COUNT(*) AS n_rows, COUNT(rwa_amount) AS n_amounts
        FROM long_rows GROUP BY 1, 2, 3""",
    "load_tables": """SELECT entity, quarter_id, COUNT(*) AS n_rows, CAST(SUM(m3) AS DOUBLE) AS m3
        FROM balance_sheet b JOIN quarter_map q ON b.year = q.year AND q.month = 'Mar' GROUP BY 1, 2""",
    "month_columns": """SELECT entity, year, CAST(SUM(m3) AS DOUBLE) AS "Mar", CAST(SUM(m6) AS DOUBLE) AS "Jun",
        CAST(SUM(m9) AS DOUBLE) AS "Sep", CAST(SUM(m12) AS DOUBLE) AS "Dec" FROM balance_sheet GROUP BY 1, 2""",
    "rename_addon": f"""SELECT entity, quarter_id, seg_l4_code AS seg_l4_id, seg_l3_code AS seg_l3_id, seg_l2_code AS seg_l2_id,
        pmf_l5, exposure_type, geo_l4_desc, CAST(sa_rwa_amt AS DOUBLE) AS sa_rwa, CAST(adv_rwa_amt AS DOUBLE) AS aa_rwa,
        {dbl('erba_rwa')} FROM addon""",
    "coerce_adjustments": f"""SELECT entity, year, seg_l4_id, geo_l4_desc, pmf_l5, quarter_id, comment, exposure_type,
        {dbl('balances', 'sa_rwa', 'aa_rwa', 'sa_rwf', 'aa_rwf', 'sa_rwf_key2', 'aa_rwf_key2')} FROM filled_adjustments""",
    "coerce_before_pivot": """SELECT entity_code, COALESCE(pug, 'None') AS pug, COALESCE(sa_account, 'None') AS sa_account,
        COALESCE(aa_account, 'None') AS aa_account, pmf_l5, COUNT(*) AS n_rows, COUNT(sa_rwa) AS n_sa FROM frm GROUP BY 1, 2, 3, 4, 5""",
    "string_normalise": "SELECT COALESCE(pmf_l5, 'None') AS pmf_l5, COUNT(*) AS n_rows FROM convergence GROUP BY 1",
    "int_str": "SELECT COALESCE(CAST(seg_l4_id AS VARCHAR), 'nan') AS id_text, COUNT(*) AS n_rows FROM balance_sheet GROUP BY 1",
    "fill_zero_all": """SELECT entity, COALESCE(seg_l4_desc, '0') AS seg_l4_desc, COALESCE(pmf_l5, '0') AS pmf_l5,
        COALESCE(seg_l4_id, 0) AS seg_l4_id, COUNT(*) AS n_m12, CAST(SUM(COALESCE(m12, 0)) AS DOUBLE) AS m12
        FROM balance_sheet GROUP BY 1, 2, 3, 4""",
    "stub_columns": """SELECT entity_code, 'R' AS "FileType", '00000' AS "Affiliate", 'EOP' AS "BalanceType", 'USD' AS "Currency",
        '' AS "Layer", '' AS "Comments", COUNT(*) AS n_rows FROM frm GROUP BY entity_code""",
    "entity_tag": "SELECT CASE entity WHEN 'CG' THEN 'BA' ELSE 'BB' END AS entity_code, COUNT(*) AS n_rows FROM entity_rows GROUP BY 1",
    "split_credit_risk": f"SELECT {BUCKET} FROM entity_rows WHERE pmf_l5 IN {FACTOR_ACCOUNTS} {BUCKET_BY}",
    "split_markets_addon": f"SELECT {BUCKET} FROM entity_rows WHERE {IS_MARKETS} {BUCKET_BY}",
    "split_non_waterfall": f"""SELECT {BUCKET} FROM entity_rows WHERE (pmf_l5 IS NULL OR pmf_l5 NOT IN {FACTOR_ACCOUNTS})
        AND (seg_l2_desc IS NULL OR seg_l2_desc <> {MARKETS}) {BUCKET_BY}""",
    "exclude_discontinued": f"""SELECT {BUCKET} FROM entity_rows
        WHERE seg_l2_desc IS DISTINCT FROM 'Discontinued Ops [L2]' {BUCKET_BY}""",
    "drop_unknown_quarter": f"""SELECT entity, CAST(quarter_id AS BIGINT) AS quarter_id, seg_l4_id, geo_l4_desc, {dbl('sa_rwa')}
        FROM adjustments WHERE quarter_id <> 'Unknown'""",
    "markets_filter": """SELECT entity_code, seg_l2_desc, exposure_type, markets_filter, COUNT(*) AS n_rows
        FROM labelled GROUP BY 1, 2, 3, 4""",
    "waterfall_join": f"SELECT {LONG_SQL}, seg_l4_id, seg_l3_id, seg_l2_id, quarter_id, {dbl('balances')}, {cols(RWF)} FROM fallen",
    "quarter_join": f"SELECT {LONG_SQL}, quarter_id, {dbl('balances')} FROM dated",
    "quarter_inverse_join": """SELECT a.q AS quarter_id, m.year, m.month, COUNT(*) AS n_rows
        FROM (SELECT TRY_CAST(quarter_id AS BIGINT) AS q FROM adjustments) a LEFT JOIN quarter_map m ON a.q = m.quarter_id
        WHERE a.q IS NOT NULL GROUP BY 1, 2, 3""",
    "geo_enrich": """SELECT p.geo_l3_desc, c.geo_l4_desc, COUNT(*) AS n_rows, CAST(SUM(gaap_amt) AS DOUBLE) AS gaap_amt
        FROM convergence c LEFT JOIN (SELECT geo_l4_desc, MIN(geo_l3_desc) AS geo_l3_desc FROM balance_sheet
          WHERE entity = 'CG' GROUP BY 1) p ON c.geo_l4_desc IS NOT DISTINCT FROM p.geo_l4_desc GROUP BY 1, 2""",
    "adjustment_join": f"""SELECT {cols(LONG, 'o.')}, o.quarter_id, CAST(o.balances AS DOUBLE) AS balances, a.exposure_type,
        {num('a.sa_rwf')} AS sa_rwf, {num('a.aa_rwf')} AS aa_rwf,
        {num('a.sa_rwf_key2')} AS sa_rwf_key2, {num('a.aa_rwf_key2')} AS aa_rwf_key2
        FROM dated o LEFT JOIN adjustments a ON a.entity = o.entity AND a.seg_l4_id = o.seg_l4_id
          AND a.geo_l4_desc = o.geo_l4_desc AND COALESCE(a.pmf_l5, 'None') = o.pmf_l5
          AND TRY_CAST(a.quarter_id AS BIGINT) = o.quarter_id""",
    "pug_join": """SELECT entity, r.seg_l4_desc, pug, COUNT(*) AS n_rows FROM entity_rows r
        LEFT JOIN pug_mapping p ON r.seg_l4_desc IS NOT DISTINCT FROM p.seg_l4_desc GROUP BY 1, 2, 3""",
    "pmf_join": """SELECT entity, COALESCE(r.pmf_l5, 'None') AS pmf_l5, sa_account, aa_account, COUNT(*) AS n_rows FROM entity_rows r
        LEFT JOIN pmf_mapping p ON COALESCE(r.pmf_l5, 'None') = p.pmf_l5 GROUP BY 1, 2, 3, 4""",
    "table_diff": f"SELECT {cols(DIFF_KEY)}, CAST(a3 AS DOUBLE) AS m3__a, CAST(b3 AS DOUBLE) AS m3__b, presence FROM paired",
    "lateral_unpivot": f"SELECT {cols(GRAIN)}, month, {dbl('balances')} FROM coarse_long",
    "quarterly_sum": f"""SELECT {cols(GRAIN)}, CAST(Mar AS DOUBLE) AS "Mar", CAST(Jun AS DOUBLE) AS "Jun", CAST(Sep AS DOUBLE) AS "Sep",
        CAST(Dec AS DOUBLE) AS "Dec" FROM quarterly""",
    "key_pivots": f"""SELECT key_level, entity, quarter_id, {cols(KEY_COLUMNS)}, {dbl('gaap_amt', 'sa_rwa_amt', 'adv_rwa_amt')}
        FROM key_sums""",
    "rwf_ratio": f"SELECT key_level, entity, quarter_id, {cols(KEY_COLUMNS)}, sa_rwf, aa_rwf FROM ratios",
    "markets_null_rwf": f"SELECT key_level, entity, quarter_id, {cols(KEY_COLUMNS)}, sa_rwf, aa_rwf FROM factors",
    "markets_addon_sum": f"SELECT {cols(ADDON)}, {dbl('sa_rwa_amt', 'adv_rwa_amt')} FROM markets_sums",
    "addon_sum": f"""SELECT {cols(ADDON)}, {dbl('sa_rwa_amt', 'adv_rwa_amt')},
        CASE WHEN quarter_id IN (5, 6) THEN CAST(sa_rwa_amt AS DOUBLE) END AS erba_rwa, '' AS comment FROM other_sums""",
    "addon_sum_sql": f"""SELECT entity, quarter_id, seg_l2_desc, pmf_l5, {dbl('sa_rwa_amt', 'aa_rwa_amt', 'erba_rwa')}
        FROM coarse_addon""",
    "control_convergence": f"SELECT entity, seg_l2_desc, rwa_calc, {dbl(*HISTORY_QUARTERS.values())} FROM control_conv",
    "control_summary": f"SELECT entity, segment_l2, quarter_id, rwa_calc, {dbl('rwa_amount')} FROM coarse_control",
    "control_upload": f'SELECT "Entity", "Managed Segment L2 Descr", "RWA Calc", {cents(LABELS)} FROM control_template',
    "control_raw": f"SELECT entity, seg_l2_desc, rwa_calc, {cents(list(RAW_QUARTERS.values()))} FROM control_stacked",
    "quarter_counts": f"""SELECT *, convergence = cg_outlook AND cg_outlook = cbna_outlook AS agree,
          greatest(convergence, cg_outlook, cbna_outlook) AS max_quarters
        FROM (SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT quarter_id FROM convergence) q) AS convergence,
          (SELECT COUNT(*) FROM (SELECT DISTINCT year, month FROM outlook_long WHERE entity = 'CG') q) AS cg_outlook,
          (SELECT COUNT(*) FROM (SELECT DISTINCT year, month FROM outlook_long WHERE entity = 'CBNA') q) AS cbna_outlook) c""",
    "quarter_map": """SELECT i AS quarter_id, CAST(year(d) AS BIGINT) AS year, strftime(d, '%b') AS month
        FROM (SELECT i, DATE '2025-03-01' + to_months(CAST(3 * i AS INTEGER)) AS d FROM (SELECT unnest(range(n)) AS i
          FROM (SELECT greatest((SELECT COUNT(DISTINCT quarter_id) FROM convergence),
            (SELECT MAX(n) FROM (SELECT COUNT(DISTINCT (year, month)) AS n FROM outlook_long GROUP BY entity) e)) AS n) g) t) days""",
    "duplicate_keys": """SELECT 'pug' AS mapping, seg_l4_desc AS key, COUNT(*) AS n_rows FROM pug_mapping GROUP BY ALL HAVING COUNT(*) > 1
        UNION ALL SELECT 'pmf', pmf_l5, COUNT(*) FROM pmf_mapping GROUP BY ALL HAVING COUNT(*) > 1""",
    "melt_balances": f"SELECT {cols(GRAIN)}, month, {dbl('balances')} FROM outlook_long",
    "upload_pivot": f"SELECT {cols(UPLOAD)}, rwa_calc, {cents(Q_LIST)} FROM calc_pivot",
    "upload_pivot_sql": f"SELECT entity, seg_l2_desc, pmf_l5, rwa_calc, {cents(['rwa_actuals', *Q_LIST[1:]])} FROM coarse_pivot",
    "rwa_long": "SELECT * FROM long_rows",
    "first_valid_rwf": f"""SELECT {LONG_SQL}, quarter_id, COALESCE(sa_rwf, sa_rwf_key2, sa_rwf_key3, sa_rwf_key4, sa_rwf_key5) AS final_sa_rwf,
        COALESCE(aa_rwf, aa_rwf_key2, aa_rwf_key3, aa_rwf_key4, aa_rwf_key5) AS final_aa_rwf FROM fallen""",
    "sa_rwa": f"SELECT {LONG_SQL}, quarter_id, {dbl('balances')}, final_sa_rwf, sa_rwa FROM outlook",
    "aa_rwa": f"SELECT {LONG_SQL}, quarter_id, {dbl('balances')}, final_aa_rwf, aa_rwa FROM outlook",
    "erba_rwa": f"SELECT {LONG_SQL}, quarter_id, {dbl('balances')}, erba_rwa, comment FROM outlook",
    "outlook_keys": f"SELECT entity, key1, key2, key3, key4, key5, quarter_id, {dbl('balances')} FROM keyed",
    "legacy_layer": """SELECT CASE WHEN seg_l3_desc = 'Legacy Franchises [L3]' THEN
          CASE WHEN seg_l4_desc = 'Legacy Holdings Assets [L4]' THEN 'Legacy Holdings' ELSE 'Legacy Holdings Other' END
          WHEN geo_l3_desc = 'Latin America' THEN 'Legacy - Latin America' ELSE 'Non Legacy' END AS reporting_layer,
        seg_l3_desc, seg_l4_desc, geo_l3_desc, COUNT(*) AS n_rows, CAST(SUM(m3) AS DOUBLE) AS m3
        FROM balance_sheet GROUP BY 1, 2, 3, 4""",
    "account_derive": """SELECT entity_code, rwa_calc, pmf_l5, account AS "Account", COUNT(*) AS n_rows FROM labelled GROUP BY 1, 2, 3, 4""",
    "quarter_headers": f"""SELECT entity_code, rwa_calc, {', '.join(f'round(SUM({Q_NAMES[q]})) AS "{n}"' for q, n in Q_LABELS.items())}
        FROM calc_pivot GROUP BY 1, 2""",
    "format_upload": TEMPLATE_SQL,
    "upload_sort": TEMPLATE_SQL,
    "projected_quarter_parse": """SELECT entity, projected_quarter, COALESCE(year, py) AS year, COALESCE(month, pm) AS month, quarter_id,
        COUNT(*) AS n_rows, CAST(SUM(sa_rwa_amt) AS DOUBLE) AS sa_rwa_amt FROM projected GROUP BY 1, 2, 3, 4, 5""",
    "concat_addon": f"""SELECT {cols(ADDON)}, {dbl('sa_rwa_amt', 'adv_rwa_amt', 'erba_rwa')}, comment FROM addon""",
    "frm_concat": """SELECT entity, quarter_id, month, comment, exposure_type, COUNT(*) AS n_rows, COUNT(balances) AS n_balances,
        COUNT(sa_rwa) AS n_sa, COUNT(sa_rwf_key3) AS n_sa_rwf_key3 FROM stacked GROUP BY 1, 2, 3, 4, 5""",
    "frm_base": "SELECT * FROM coarse_frm",
    "entity_union": f"SELECT * REPLACE ({dbl('m3', 'm6', 'm9', 'm12')}) FROM balance_sheet",
    "distinct_pairs": "SELECT DISTINCT geo_l3_desc, geo_l4_desc FROM balance_sheet",
    "sample_rows": f"""SELECT {cols(DIFF_KEY)} FROM paired WHERE presence = 'left_only' ORDER BY {cols(DIFF_KEY)} LIMIT 10""",
    "dq_status": f"""SELECT *, {status('n_failing', 'n_total', 1.9)} AS status FROM (SELECT quarter_id, exposure_type, COUNT(*) AS n_total,
        COUNT(*) - COUNT(seg_l2_desc) AS n_failing FROM convergence GROUP BY 1, 2) c""",
    "dq_row_count": union(
        [row_count(f"(SELECT COUNT(*) AS n FROM {d}) s", f"'{d}'") for d in ("convergence", "balance_sheet")]
    ),
    "dq_required_cols": union(
        [
            REQUIRED,
            check("(SELECT 1 FROM convergence LIMIT 1) s", "'required_columns'", "'convergence'", "0", "2",
                  "'All 2 required columns present'", "'PASS'"),
            row_count("(SELECT COUNT(*) AS n FROM convergence) s", "'convergence'"),
        ]
    ),
    "dq_null_rate": union(
        [
            null_rate(CONVERGENCE_COUNTS, "pmf_nulls", "pmf_l5", "'convergence'", "pmf"),
            null_rate(CONVERGENCE_COUNTS, "l2_nulls", "seg_l2_desc", "'convergence'", "l2"),
            null_rate(CONVERGENCE_COUNTS, "type_nulls", "exposure_type", "'convergence'", "et"),
            check(CONVERGENCE_COUNTS, "'no_column'", "'convergence'", "0", "0", "'Column ''absent'' not found — skipped'"),
        ]
    ),
    "dq_allowed_values": union(
        [allowed("is_cg", ["Y", "N"], "flags"), allowed("geo_l4_desc", ["NATION_1", "NATION_2"], "geo")]
    ),
    "dq_waterfall": waterfall_checks().replace("outlook_counts", "plain_counts"),
    "dq_join_match": JOIN_CHECKS,
    "dq_quarter_coverage": COVERAGE,
    "dq_report": DQ_SQL,
    "dq_export": DQ_SQL,
    "pug_unmatched": """SELECT a.entity, n_before, n_rows, n_unmatched, n_rows <> n_before AS expanded,
          n_unmatched * 100.0::DOUBLE / (n_rows + 1) AS pct_unmatched
        FROM (SELECT entity, COUNT(*) AS n_before FROM layered GROUP BY 1) a JOIN (SELECT entity, COUNT(*) AS n_rows,
          COUNT(*) - COUNT(pug) AS n_unmatched FROM pugged GROUP BY 1) b ON a.entity = b.entity""",
    "pmf_unmatched": """SELECT a.entity, n_before, n_rows, n_unmatched, n_rows <> n_before AS expanded,
          n_unmatched * 100.0::DOUBLE / (n_rows + 1) AS pct_unmatched
        FROM (SELECT entity, COUNT(*) AS n_before FROM pugged GROUP BY 1) a JOIN (SELECT entity, COUNT(*) AS n_rows,
          COUNT(*) FILTER (WHERE sa_account IS NULL AND pmf_l5 IS NOT NULL) AS n_unmatched FROM frm GROUP BY 1) b ON a.entity = b.entity""",
    "diff_key_normalise": """SELECT COALESCE(CAST(seg_l4_id AS VARCHAR), '') AS id, geo_l4_desc AS geo, COALESCE(pmf_l5, 'None') AS account,
        COUNT(*) AS n_rows FROM balance_sheet GROUP BY 1, 2, 3""",
    "diff_schema": union(
        [
            f"""SELECT '{c}' AS column_name, 'both' AS side, (SELECT COUNT({c}) FROM pair_a) AS n_filled_a,
              (SELECT COUNT({c}) FROM pair_b) AS n_filled_b"""
            for c in [*DIFF_KEY, "m3", "m6", "seg_l2_desc", "note"]
        ]
        + ["SELECT 'added', 'B', NULL, (SELECT COUNT(added) FROM pair_b)"]
    ),
    "diff_dup_keys": f"""SELECT 'A' AS side, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows
        FROM (SELECT COUNT(*) AS n FROM balance_sheet GROUP BY {cols(DIFF_KEY)}) a
        UNION ALL SELECT 'B', CAST(SUM(n - 1) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM pair_b GROUP BY {cols(DIFF_KEY)}) b""",
    "diff_rows": "SELECT * FROM verdicts",
    "diff_columns": """SELECT column_name, n_diffs, sum_a, sum_b, sum_b - sum_a AS delta,
          CASE WHEN n_diffs = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'm3' AS column_name, d3 AS n_diffs, sa3 AS sum_a, sb3 AS sum_b FROM diffs
          UNION ALL SELECT 'm6', d6, sa6, sb6 FROM diffs UNION ALL SELECT 'seg_l2_desc', dl, NULL, NULL FROM diffs
          UNION ALL SELECT 'note', dn, NULL, NULL FROM diffs) c""",
    "diff_totals": """SELECT column_name, sum_a, sum_b, sum_b - sum_a AS delta FROM (
        SELECT 'm3' AS column_name, CAST((SELECT SUM(m3) FROM pair_a) AS DOUBLE) AS sum_a, CAST((SELECT SUM(m3) FROM pair_b) AS DOUBLE) AS sum_b
        UNION ALL SELECT 'm6', CAST((SELECT SUM(m6) FROM pair_a) AS DOUBLE), CAST((SELECT SUM(m6) FROM pair_b) AS DOUBLE)) t""",
    "diff_verdict": DIFF_VERDICT,
    "digest_verdict": DIFF_VERDICT,
    "profile_columns": profile("balance_sheet", BALANCE_KINDS, BIG, position=True),
    "mapping_log": profile("adjustments", ADJUSTMENT_KINDS, {}, position=False),
    "stage1_outlook": f"""SELECT {LONG_SQL}, seg_l4_id, seg_l3_id, seg_l2_id, quarter_id, {dbl('balances')}, key1, {cols(RWF)},
        final_sa_rwf, final_aa_rwf, sa_rwa, aa_rwa, erba_rwa, comment, exposure_type FROM outlook""",
    "stage1_addon": f"SELECT * REPLACE ({dbl('sa_rwa_amt', 'adv_rwa_amt', 'erba_rwa')}) FROM addon",
    "stage2_frm": """SELECT entity_code, reporting_layer, seg_l4_desc, geo_l4_desc, pmf_l5, quarter_id, exposure_type, comment, pug,
        sa_account, aa_account, balances, sa_rwa, aa_rwa, erba_rwa FROM frm""",
    "upload_template": f"""SELECT "Entity", "Reporting Layer", "Managed Segment L2 Descr", "RWA Calc", "Account", "Markets Filter",
        COUNT(*) AS n_rows, {', '.join(f'round(SUM("{n}")) AS "{n}"' for n in LABELS)} FROM template GROUP BY 1, 2, 3, 4, 5, 6""",
    "raw_data": """SELECT entity_code, seg_l2_desc, pmf_l5, quarter_id, COUNT(*) AS n_rows, round(SUM(sa_rwa)) AS sa_rwa,
        round(SUM(aa_rwa)) AS aa_rwa FROM raw GROUP BY 1, 2, 3, 4""",
    "control_file": union(
        [
            f"""SELECT '{name}' AS control, {dims}, 'q{q}' AS quarter, round("{columns[q]}") AS amount FROM {table}"""
            for name, table, dims, columns in (
                ("upload", "control_template",
                 '"Entity" AS entity, "Managed Segment L2 Descr" AS seg_l2_desc, "RWA Calc" AS rwa_calc', Q_LABELS),
                ("convergence", "control_conv", "entity, seg_l2_desc, rwa_calc", HISTORY_QUARTERS),
                ("raw", "control_stacked", "entity, seg_l2_desc, rwa_calc", RAW_QUARTERS),
            )
            for q in columns
        ]
    ),
    "sql_pipeline": union(
        [
            f"SELECT '{step}' AS step, COUNT(*) AS n_rows, COUNT({column}) AS n_filled FROM {source} s"
            for step, (source, column) in STEP_COUNTS.items()
        ]
    ),
    "projected_rwa_sql": f"""SELECT {LONG_SQL}, quarter_id, key1, {dbl('balances')}, final_sa_rwf, final_aa_rwf, sa_rwa, aa_rwa, erba_rwa
        FROM coarse_rwa""",
    "waterfall_rwf_sql": f"""SELECT entity, quarter_id, seg_l4_code, geo_l4_desc, pmf_l5, seg_l2_desc,
        {dbl('gaap_amt', 'sa_rwa_amt', 'adv_rwa_amt')}, sa_rwf, aa_rwf FROM coarse_factors""",
}

# Key matches without the adjustments' factors.
CTES["plain_counts"] = f"""SELECT entity, COUNT(*) AS n, {', '.join(f'COUNT({c}) AS {c}' for c in COUNTED)}
  FROM (SELECT *, COALESCE(sa_rwf, sa_rwf_key2, sa_rwf_key3, sa_rwf_key4, sa_rwf_key5) AS final_sa_rwf,
    COALESCE(aa_rwf, aa_rwf_key2, aa_rwf_key3, aa_rwf_key4, aa_rwf_key5) AS final_aa_rwf FROM fallen) f GROUP BY entity"""


def _mentioned(sql: str) -> set[str]:
    bare = re.sub(r"'[^']*'", "''", sql)
    return set(re.findall(r"(?:FROM|JOIN|,)\s+([a-z_0-9]+)", bare)) & set(CTES)


KEPT = {"keyed", "fallen", *[f"factor_{i}" for i in LEVELS]}


def statement(sql: str) -> str:
    """The query with the expressions it needs in front, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for other in sorted(_mentioned(CTES[name]) - {name}):
            add(other)
        ordered.append(name)

    for name in sorted(_mentioned(sql)):
        add(name)
    if not ordered:
        return sql
    # Tables read more than once are kept, so that no join is planned over their definitions again.
    kept = {n: "MATERIALIZED " if sum(n in _mentioned(CTES[o]) for o in ordered) + (n in _mentioned(sql)) > 1 or n in KEPT else "" for n in ordered}
    return "WITH " + ",\n".join(f"{n} AS {kept[n]}({CTES[n]})" for n in ordered) + f"\n{sql}"


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in CHECKS.items()}
