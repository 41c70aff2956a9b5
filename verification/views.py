"""Input tables of the engine, derived from the given star schema.

One SQL text per table, in the dialect Spark and the checking engine share.
``{name}`` stands for a given table. Amounts are doubles holding whole cents, so
that sums are exact in any order. Rows are never selected by id: every given row
takes part, and expressions of ids only choose column values, so that nulls,
misses and odd values all occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

VIEWS = {
    "seg": """
        SELECT id AS l4,
          CAST(4000 + id AS BIGINT) AS seg_l4_code,
          CAST(3000 + id % 12 AS BIGINT) AS seg_l3_code,
          CAST(2000 + id % 6 AS BIGINT) AS seg_l2_code,
          CASE id % 6 WHEN 0 THEN 'Banking [L2]' WHEN 1 THEN 'Services [L2]' WHEN 2 THEN 'Markets [L2]'
            WHEN 3 THEN 'Wealth [L2]' WHEN 4 THEN 'All Other [L2]' ELSE 'Discontinued Ops [L2]' END AS seg_l2_desc,
          CASE WHEN id % 12 = 4 THEN 'Legacy Franchises [L3]'
            ELSE concat('Segment ', CAST(id % 12 AS VARCHAR(9)), ' [L3]') END AS seg_l3_desc,
          CASE WHEN id = 4 THEN 'Legacy Holdings Assets [L4]'
            ELSE concat('Segment ', CAST(id AS VARCHAR(9)), ' [L4]') END AS seg_l4_desc
        FROM (SELECT DISTINCT p_partkey % 36 AS id FROM {part}) ids""",
    "geo": """
        SELECT n_nationkey, n_name AS geo_l4_desc,
          CASE WHEN r_name = 'AMERICA' THEN 'Latin America' ELSE r_name END AS geo_l3_desc
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "pmf": """
        SELECT * FROM (VALUES
          (0, 'Total Loans & Leases Net of Unearned (L2)'), (1, 'Investments (L2)'), (2, 'Other Assets (L2)'),
          (3, 'Letters of Credit (L2)'), (4, 'Unused Commitments (L2)'), (5, 'Trading Account Assets (L2)'),
          (6, 'Other Liabilities (L2)'), (7, CAST(NULL AS VARCHAR(60)))) t(pid, pmf_l5)""",
    "convergence": """
        SELECT CAST(CASE WHEN l_orderkey % 89 = 0 THEN 9 ELSE l_orderkey % 8 END AS BIGINT) AS quarter_id,
          CASE WHEN l_orderkey % 97 = 0 THEN '9Q99'
            ELSE concat(CAST(1 + (l_orderkey % 8) % 4 AS VARCHAR(9)), 'Q',
              CASE WHEN l_orderkey % 8 < 4 THEN '25' ELSE '26' END) END AS projected_quarter,
          seg_l4_code, seg_l3_code, seg_l2_code, seg_l4_desc, seg_l3_desc,
          CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN l4 = 1 AND n_nationkey = 1 AND l_orderkey % 3 = 0 THEN 'All Other [L2]'
            ELSE seg_l2_desc END AS seg_l2_desc,
          geo_l4_desc, geo_l3_desc, pmf_l5,
          CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS is_cg,
          CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS is_cbna,
          CASE WHEN l_suppkey % 10 = 3 THEN 'Securitization' WHEN l_suppkey % 10 = 4 THEN NULL
            ELSE 'Direct' END AS exposure_type,
          CAST(CASE WHEN l_partkey % 41 = 0 THEN 0 WHEN l_partkey % 43 = 0 THEN round(l_quantity * 100)
            WHEN l_linenumber = 5 THEN -round(l_extendedprice * 100)
            ELSE round(l_extendedprice * 100) END AS DOUBLE) AS gaap_amt,
          round(l_extendedprice * 100) * round(l_discount * 100) AS sa_rwa_amt,
          round(l_extendedprice * 100) * round(l_tax * 100) AS adv_cg_amt,
          round(l_extendedprice * 100) * round(l_tax * 80) AS adv_cbna_amt
        FROM {lineitem} JOIN seg ON l_partkey % 36 = l4 JOIN {supplier} ON l_suppkey = s_suppkey
          JOIN geo ON s_nationkey = n_nationkey JOIN pmf ON pid = (l_partkey + l_linenumber) % 8""",
    "balance_sheet": """
        SELECT CASE WHEN o_orderstatus = 'O' THEN 'CBNA' ELSE 'CG' END AS entity,
          CAST(2025 + o_orderkey % 3 AS BIGINT) AS year,
          seg_l4_desc, seg_l3_desc, seg_l2_desc, geo_l4_desc, geo_l3_desc, pmf_l5,
          seg_l4_code AS seg_l4_id, seg_l3_code AS seg_l3_id, seg_l2_code AS seg_l2_id,
          round(o_totalprice * 100) AS m3,
          round(o_totalprice * 100) * 2 AS m6,
          -round(o_totalprice * 100) AS m9,
          CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE round(o_totalprice * 100) END AS m12
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey
          LEFT JOIN seg ON (o_orderkey * 7) % 40 = l4 JOIN pmf ON pid = o_orderkey % 8""",
    "adjustments": """
        SELECT CASE WHEN c_custkey % 2 = 0 THEN 'CG' ELSE 'CBNA' END AS entity,
          CAST(2025 + c_custkey % 2 AS BIGINT) AS year,
          seg_l4_desc, seg_l3_desc, seg_l2_desc, geo_l4_desc, geo_l3_desc, pmf_l5,
          seg_l4_code AS seg_l4_id, seg_l3_code AS seg_l3_id, seg_l2_code AS seg_l2_id,
          'Mar' AS month,
          CASE WHEN c_custkey % 13 = 0 THEN 'n/a' WHEN c_custkey % 14 = 0 THEN 'nan'
            ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR(30)) END AS balances,
          CASE WHEN c_custkey % 17 = 0 THEN 'Unknown' WHEN c_custkey % 19 = 0 THEN NULL
            WHEN c_custkey % 23 = 0 THEN '5000' ELSE CAST((c_custkey * 3 + c_nationkey) % 8 AS VARCHAR(9)) END AS quarter_id,
          round(c_acctbal * 100) AS sa_rwa,
          CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE round(c_acctbal * 100) END AS aa_rwa,
          round(c_acctbal * 100) * 2 AS erba_rwa,
          CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS comment,
          CASE WHEN c_custkey % 3 = 0 THEN 'Banking Book' WHEN c_custkey % 3 = 1 THEN '' ELSE NULL END AS exposure_type,
          CASE WHEN c_custkey % 4 = 0 THEN '2' WHEN c_custkey % 4 = 1 THEN 'NaN' ELSE NULL END AS sa_rwf,
          CAST(NULL AS VARCHAR(9)) AS aa_rwf,
          CASE WHEN c_custkey % 6 = 0 THEN '3' WHEN c_custkey % 6 = 1 THEN 'none' WHEN c_custkey % 6 = 3 THEN 'nan'
            ELSE NULL END AS sa_rwf_key2,
          CASE WHEN c_custkey % 6 = 2 THEN '4' ELSE NULL END AS aa_rwf_key2
        FROM {customer} JOIN geo ON c_nationkey = n_nationkey
          JOIN seg ON c_custkey % 36 = l4 JOIN pmf ON pid = c_custkey % 8""",
    "pug_mapping": """
        SELECT CASE WHEN l4 % 9 = 0 THEN concat('Former ', seg_l4_desc) ELSE seg_l4_desc END AS seg_l4_desc,
          concat('P', CAST(l4 % 5 AS VARCHAR(9))) AS pug
        FROM seg
        UNION ALL SELECT seg_l4_desc, 'P9' AS pug FROM seg WHERE l4 = 5""",
    "pmf_mapping": """
        SELECT CASE WHEN pid IN (4, 6) THEN concat('Former ', pmf_l5) ELSE pmf_l5 END AS pmf_l5,
          concat('SA-', CAST(pid AS VARCHAR(9))) AS sa_account,
          concat('AA-', CAST(pid AS VARCHAR(9))) AS aa_account
        FROM pmf
        UNION ALL SELECT pmf_l5, 'SA-9' AS sa_account, 'AA-9' AS aa_account FROM pmf WHERE pid = 1""",
}

# Views each view reads, itself included, in order.
NEEDS = {
    "seg": ("seg",),
    "geo": ("geo",),
    "pmf": ("pmf",),
    "convergence": ("seg", "geo", "pmf", "convergence"),
    "balance_sheet": ("seg", "geo", "pmf", "balance_sheet"),
    "adjustments": ("seg", "geo", "pmf", "adjustments"),
    "pug_mapping": ("seg", "pug_mapping"),
    "pmf_mapping": ("pmf", "pmf_mapping"),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a DataFrame."""
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in NEEDS[name])
    given = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in GIVEN if f"{{{t}}}" in ctes}
    return spark.sql(f"WITH {ctes} SELECT * FROM {name}", **given)


def check_sql(name: str) -> str:
    """The text of one input table for the checking engine, whose views bear the given names."""
    return VIEWS[name].format(**{t: t for t in GIVEN})
