import pytest
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions.quarters import quarter_map
from factorfall.operators import addon as A
from factorfall.operators import convergence as C
from factorfall.operators import outlook as O
from factorfall.session import stage_table

LOANS = "Total Loans & Leases Net of Unearned (L2)"
FIELDS = (
    "quarter_id long, projected_quarter string, seg_l4_code long, seg_l3_code long, seg_l2_code long, "
    "seg_l4_desc string, seg_l3_desc string, seg_l2_desc string, geo_l4_desc string, geo_l3_desc string, "
    "pmf_l5 string, is_cg string, is_cbna string, exposure_type string, gaap_amt double, sa_rwa_amt double, "
    "adv_cg_amt double, adv_cbna_amt double"
)


def exposure(**changed):
    row = dict(
        quarter_id=0, projected_quarter="1Q25", seg_l4_code=4, seg_l3_code=3, seg_l2_code=2, seg_l4_desc="s4",
        seg_l3_desc="s3", seg_l2_desc="Banking [L2]", geo_l4_desc="US", geo_l3_desc="NAM", pmf_l5=LOANS, is_cg="Y",
        is_cbna="N", exposure_type="Direct", gaap_amt=100.0, sa_rwa_amt=50.0, adv_cg_amt=20.0, adv_cbna_amt=30.0,
    )
    return tuple((row | changed).values())


def exposures(spark, *changes):
    return spark.createDataFrame([exposure(**c) for c in changes], FIELDS)


def balances(spark, *changes):
    row = dict(
        entity="CG", year=2025, seg_l4_desc="s4", seg_l3_desc="s3", seg_l2_desc="Banking [L2]", geo_l4_desc="US",
        geo_l3_desc="NAM", pmf_l5=LOANS, seg_l4_id=4, seg_l3_id=3, seg_l2_id=2, m3=1000.0, m6=2000.0, m9=None, m12=4000.0,
    )
    fields = (
        "entity string, year long, seg_l4_desc string, seg_l3_desc string, seg_l2_desc string, geo_l4_desc string, "
        "geo_l3_desc string, pmf_l5 string, seg_l4_id long, seg_l3_id long, seg_l2_id long, m3 double, m6 double, "
        "m9 double, m12 double"
    )
    return spark.createDataFrame([tuple((row | c).values()) for c in changes], fields)


def dated(spark, sheet, n_quarters=8):
    long = O.melt_balances(O.quarterly_sum(O.month_columns(C.string_normalise(sheet))))
    return O.quarter_join(long, quarter_map(spark, "Mar 2025", n_quarters))


def test_by_entity_takes_each_entity_amount(spark, rows):
    both = C.by_entity(exposures(spark, dict(is_cbna="Y"), dict(is_cg="N"), dict(is_cg=None, is_cbna="Y")))
    assert rows(both, "entity", "adv_rwa_amt") == [("CBNA", 30.0), ("CBNA", 30.0), ("CG", 20.0)]


def test_buckets_overlap_and_residual_keeps_nulls(spark, rows):
    df = C.by_entity(
        exposures(
            spark,
            dict(seg_l2_desc="Markets [L2]"),
            dict(pmf_l5=None),
            dict(pmf_l5="Other Liabilities (L2)", seg_l2_desc=None),
            dict(pmf_l5="Other Liabilities (L2)", seg_l2_desc="Markets [L2]"),
            dict(),
        )
    )
    assert C.split_credit_risk(df).count() == 2
    assert C.split_markets_addon(df).count() == 2
    assert rows(C.split_non_waterfall(df), "pmf_l5", "seg_l2_desc") == [
        (None, "Banking [L2]"),
        ("Other Liabilities (L2)", None),
    ]


def test_one_pass_addon_equals_both_buckets(spark, rows):
    df = C.by_entity(
        exposures(
            spark,
            dict(seg_l2_desc="Markets [L2]"),
            dict(pmf_l5=None),
            dict(pmf_l5="Other Liabilities (L2)", seg_l2_desc=None),
            dict(pmf_l5="Other Liabilities (L2)", exposure_type=None),
            dict(pmf_l5="Other Liabilities (L2)", projected_quarter="9Q99"),
            dict(pmf_l5="Other Liabilities (L2)", projected_quarter="2Q26"),
            dict(pmf_l5="Other Liabilities (L2)", projected_quarter="2Q26"),
            dict(),
        )
    )
    calendar = quarter_map(spark, "Mar 2025", 8)

    def total(rows_):
        return A.addon_sum(A.projected_quarter_parse(C.string_normalise(rows_), calendar))

    apart = A.concat_addon(total(C.split_markets_addon(df)), total(C.split_non_waterfall(df)))
    together = total(A.addon_rows(df))
    columns = [*A.ADDON_DIMS, "sa_rwa_amt", "adv_rwa_amt", "erba_rwa"]
    assert rows(together, *columns) == rows(apart, *columns)
    # Null segments and exposure types drop out, an unknown quarter and a null account do not.
    assert rows(together, "quarter_id", "pmf_l5", "sa_rwa_amt", "erba_rwa") == [
        (None, "Other Liabilities (L2)", 50.0, None),
        (0, "None", 50.0, None),
        (0, LOANS, 50.0, None),
        (5, "Other Liabilities (L2)", 100.0, 100.0),
    ]


def test_key_pivots_levels_and_null_keys(spark, rows):
    df = C.by_entity(
        exposures(spark, dict(), dict(seg_l4_code=5), dict(geo_l3_desc=None), dict(seg_l2_desc=None), dict(gaap_amt=None))
    )
    pivots = C.key_pivots(C.split_credit_risk(df))
    assert rows(pivots, "key_level", "seg_l4_code", "geo_l3_desc", "gaap_amt") == [
        (1, 4, None, 200.0),
        (1, 5, None, 100.0),
        (2, None, None, 300.0),
        (3, None, None, 300.0),
        (4, None, "NAM", 200.0),
        (5, None, None, 300.0),
    ]


def test_factors_on_totals_equal_factors_on_rows(spark, rows):
    df = exposures(spark, dict(), dict(sa_rwa_amt=7.0), dict(seg_l4_code=5, is_cbna="Y"), dict(seg_l2_desc="Markets [L2]"), dict(gaap_amt=0.0, geo_l4_desc="UK"))
    direct = C.factor_table(C.split_credit_risk(C.by_entity(df)))
    totals = C.exposure_totals(df)
    assert totals.agg(F.sum("n_rows")).first()[0] == 5
    assert rows(C.factor_table(C.split_credit_risk(C.by_entity(totals)))) == rows(direct)


def test_markets_factors_are_null(spark):
    df = C.by_entity(exposures(spark, dict(seg_l2_desc="Markets [L2]")))
    assert all(r["sa_rwf"] is None and r["aa_rwf"] is None for r in C.factor_table(C.split_credit_risk(df)).collect())


def test_quarterly_sum_keeps_null_account_and_fills(spark, rows):
    sheet = balances(spark, dict(), dict(), dict(pmf_l5=None), dict(geo_l4_desc=None))
    total = O.quarterly_sum(O.month_columns(C.string_normalise(sheet)))
    assert rows(total, "pmf_l5", "Mar", "Sep") == [("None", 1000.0, 0.0), (LOANS, 2000.0, 0.0)]


def test_quarter_join_unknown_year(spark, rows):
    got = dated(spark, balances(spark, dict(), dict(year=2030)))
    assert rows(got, "year", "month", "quarter_id") == [
        (2025, "Dec", 3), (2025, "Jun", 1), (2025, "Mar", 0), (2025, "Sep", 2),
        (2030, "Dec", None), (2030, "Jun", None), (2030, "Mar", None), (2030, "Sep", None),
    ]


def test_outlook_keys(spark, rows):
    keyed = O.outlook_keys(dated(spark, balances(spark, dict(), dict(year=2030)))).filter("month = 'Mar'")
    assert rows(keyed, "year", "key1", "key5") == [
        (2025, f"4US{LOANS}0", f"3{LOANS}0"),
        (2030, f"4US{LOANS}Unknown", f"3{LOANS}Unknown"),
    ]


def test_waterfall_falls_through_and_fans_out(spark, rows):
    df = C.by_entity(
        exposures(
            spark,
            dict(sa_rwa_amt=0.0),                                    # key 1 factor 0 is used
            dict(quarter_id=1, seg_l4_code=9),                       # only key 2 onwards
            dict(quarter_id=3, seg_l2_desc="Services [L2]"),         # two segments on every key
            dict(quarter_id=3, sa_rwa_amt=25.0),
        )
    )
    factors = C.factor_table(C.split_credit_risk(df))
    outlook = dated(spark, balances(spark, dict()))
    joined = O.final_factors(O.waterfall_join(outlook, factors))
    got = rows(joined, "quarter_id", "sa_rwf", "sa_rwf_key2", "final_sa_rwf")
    assert [g for g in got if g[0] == 0] == [(0, 0.0, 0.0, 0.0)]
    assert [g for g in got if g[0] == 1] == [(1, None, 0.5, 0.5)]
    assert [g for g in got if g[0] == 2] == [(2, None, None, None)]
    # Two lookup rows at each of five levels.
    assert len([g for g in got if g[0] == 3]) == 2**5
    once = O.final_factors(O.waterfall_join(outlook, factors, dedupe=True))
    # The segment that comes first by name, Banking, with 25 over 100.
    assert [g for g in rows(once, "quarter_id", "sa_rwf", "sa_rwf_key2", "final_sa_rwf") if g[0] == 3] == [(3, 0.25, 0.25, 0.25)]


def test_hot_key_is_one_row_of_the_dictionary(spark, rows, monkeypatch):
    many = F.explode(F.sequence(F.lit(1), F.lit(500)))
    sheet = balances(spark, dict()).withColumn("i", many).withColumn("seg_l4_desc", F.concat(F.lit("s"), "i"))
    factors = C.factor_table(C.split_credit_risk(C.by_entity(exposures(spark, dict()))))
    asked, inner = [], O.key_dictionary

    def counted(combos, *rest):
        asked.append(combos.count())
        return inner(combos, *rest)

    monkeypatch.setattr(O, "key_dictionary", counted)
    joined = O.waterfall_join(dated(spark, sheet), factors)
    assert tuple(joined.agg(F.count("*"), F.count("sa_rwf_key5")).first()) == (2000, 500)
    assert asked == [4]  # one combination a quarter


def test_a_null_part_skips_its_levels_only(spark, rows):
    factors = C.factor_table(C.split_credit_risk(C.by_entity(exposures(spark, dict(), dict(geo_l4_desc=None), dict(seg_l4_code=None)))))
    outlook = dated(spark, balances(spark, dict())).withColumn("geo_l4_desc", F.lit(None).cast("string"))
    joined = O.waterfall_join(outlook, factors).filter("quarter_id = 0")
    assert rows(joined, "sa_rwf", "sa_rwf_key2", "sa_rwf_key3", "sa_rwf_key4", "sa_rwf_key5") == [(None, None, None, 0.5, 0.5)]
    unknown = outlook.withColumn("quarter_id", F.lit(None).cast("bigint"))
    assert O.waterfall_join(unknown, factors).filter("sa_rwf_key5 IS NOT NULL").count() == 0


def test_shuffles_do_not_grow_with_the_levels(spark):
    """One join for all levels and one for the outlook, without a job before the result is asked for."""
    factors = stage_table(C.factor_table(C.split_credit_risk(C.by_entity(exposures(spark, dict())))), "factors")
    outlook = stage_table(dated(spark, balances(spark, dict())), "outlook")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = [
        O.waterfall_join(outlook, factors, keys)._jdf.queryExecution().executedPlan().toString()
        for keys in (rules.WATERFALL_KEYS[:1], rules.WATERFALL_KEYS)
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [p.count("Exchange hashpartitioning") for p in plans] == [5, 5]
    assert [p.count("SortMergeJoin") for p in plans] == [2, 2]


def test_adjustment_join_by_quarter_number(spark, rows):
    adjustments = spark.createDataFrame(
        [
            ("CG", 4, "US", LOANS, "0.0", "Overlay", "2", None),
            ("CG", 4, "US", LOANS, "1", None, None, "x"),
            ("CG", 4, "US", LOANS, "1", "Twice", None, "0.5"),
            ("CBNA", 4, "US", LOANS, "2", "Other entity", None, None),
            ("CG", 4, "US", LOANS, "Unknown", "No quarter", None, None),
        ],
        "entity string, seg_l4_id long, geo_l4_desc string, pmf_l5 string, quarter_id string, exposure_type string, "
        "sa_rwf string, sa_rwf_key2 string",
    )
    factors = C.factor_table(C.split_credit_risk(C.by_entity(exposures(spark, dict(quarter_id=7)))))
    joined = O.adjustment_join(O.waterfall_join(dated(spark, balances(spark, dict())), factors), adjustments)
    final = O.project_rwa(O.final_factors(joined))
    assert rows(final, "quarter_id", "exposure_type", "sa_rwf_adj", "final_sa_rwf", "sa_rwa") == [
        (0, "Overlay", 2.0, None, None),
        (1, None, None, None, None),
        (1, "Twice", None, 0.5, 1000.0),
        (2, None, None, None, None),
        (3, None, None, None, None),
    ]


def test_quarter_counts(spark):
    sheet = balances(spark, dict(), dict(entity="CBNA"), dict(year=2026), dict(year=2031, geo_l4_desc=None))
    counts = O.quarter_counts(exposures(spark, dict(), dict(quarter_id=None)), sheet).first().asDict()
    assert counts == {
        "convergence": 2, "cg_outlook": 8, "cbna_outlook": 4, "agree": False, "max_quarters": 8,
    }


def test_geo_enrich_takes_one_parent(spark, rows):
    sheet = balances(spark, dict(geo_l3_desc="Z"), dict(geo_l3_desc="A"), dict(entity="CBNA", geo_l4_desc="UK"))
    bare = exposures(spark, dict(), dict(geo_l4_desc="UK")).drop("geo_l3_desc")
    assert rows(C.geo_enrich(bare, sheet), "geo_l4_desc", "geo_l3_desc") == [("UK", None), ("US", "A")]
    full = exposures(spark, dict())
    assert C.geo_enrich(full, sheet) is full


def test_rename_addon_replaces_older_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, "old", 5)], "sa_rwa_amt double, adv_rwa_amt double, sa_rwa string, seg_l4_code int")
    assert A.rename_addon(df).first().asDict() == {"sa_rwa": 1.0, "aa_rwa": 2.0, "seg_l4_id": 5}


def test_inverse_join_and_bad_quarters(spark, rows):
    calendar = quarter_map(spark, "Mar 2025", 2)
    df = spark.createDataFrame([(0, 1900), (1, 1900), (9, 1900), (None, 1900)], "quarter_id long, year long")
    assert rows(O.quarter_inverse_join(df, calendar), "quarter_id", "year", "month") == [
        (None, None, None), (0, 2025, "Mar"), (1, 2025, "Jun"), (9, None, None),
    ]
    parsed = spark.createDataFrame([("1Q25", 0, 5), ("9Q99", None, 2), ("x", None, 1), ("9Q99", None, 3)], "projected_quarter string, quarter_id long, n_rows long")
    assert rows(O.bad_quarters(parsed)) == [("9Q99", 5), ("x", 1)]
    assert rows(O.bad_quarters(parsed.drop("n_rows"))) == [("9Q99", 2), ("x", 1)]


def test_keys_are_configurable(spark, rows):
    keys = (rules.WATERFALL_KEYS[4],)
    df = C.by_entity(exposures(spark, dict(), dict(seg_l4_code=8, sa_rwa_amt=0.0)))
    factors = C.factor_table(C.split_credit_risk(df), keys)
    joined = O.waterfall_join(dated(spark, balances(spark, dict())), factors, keys)
    assert rows(joined.filter("quarter_id = 0"), "sa_rwf", "aa_rwf") == [(0.25, 0.2)]
    assert "sa_rwf_key2" not in joined.columns
