import pytest
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions.quarters import quarter_labels
from factorfall.operators import controls as K
from factorfall.operators import frm as M
from factorfall.operators import upload as U

FRM = (
    "entity string, entity_code string, quarter_id long, seg_l4_desc string, seg_l3_desc string, seg_l2_desc string, "
    "geo_l3_desc string, pmf_l5 string, comment string, exposure_type string, reporting_layer string, "
    "sa_account string, aa_account string, pug string, sa_rwa double, aa_rwa double, erba_rwa double"
)


def frm(spark, *changes):
    row = dict(
        entity="CG", entity_code="BA", quarter_id=1, seg_l4_desc="s4", seg_l3_desc="s3", seg_l2_desc="Banking [L2]",
        geo_l3_desc="NAM", pmf_l5="Investments (L2)", comment=None, exposure_type=None, reporting_layer="Non Legacy",
        sa_account="SA-1", aa_account="AA-1", pug="P", sa_rwa=10.0, aa_rwa=20.0, erba_rwa=None,
    )
    return spark.createDataFrame([tuple((row | c).values()) for c in changes], FRM)


def template(spark, df, n=4):
    pivot = U.upload_pivot(M.coerce_before_pivot(df), list(range(n)))
    return U.format_upload(U.markets_filter(pivot), "Mar 2025", n)


def test_coerce_adjustments(spark):
    df = spark.createDataFrame(
        [("x", "1.5", None, None, None, None)],
        "balances string, sa_rwf string, aa_rwf_key12 string, sa_rwa double, comment string, year long",
    )
    assert M.coerce_adjustments(df).first().asDict() == {
        "balances": 0.0, "sa_rwf": 1.5, "aa_rwf_key12": 0.0, "sa_rwa": 0.0, "comment": "N/A", "year": 0,
    }


def test_concat_by_name_and_unknown_quarters(spark, rows):
    a = spark.createDataFrame([("1", 5), ("Unknown", 6), ("N/A", 7)], "quarter_id string, only_a int")
    o = spark.createDataFrame([(2, "CG"), (None, "CG")], "quarter_id long, entity string")
    stacked = M.drop_unknown_quarter(M.frm_concat(a, o, o.limit(0)))
    assert rows(stacked, "quarter_id", "only_a", "entity") == [(1, 5, None), (2, None, "CG")]


def test_mapping_joins_and_reports(spark, rows):
    df = frm(spark, dict(), dict(seg_l4_desc="none"), dict(pmf_l5=None)).drop("pug", "sa_account", "aa_account")
    pug = spark.createDataFrame([("s4", "P"), ("s4", "Q")], "seg_l4_desc string, pug string")
    pmf = spark.createDataFrame([("Investments (L2)", "SA-1", "AA-1")], "pmf_l5 string, sa_account string, aa_account string")
    pugged = M.pug_join(df, pug)
    mapped = M.pmf_join(pugged, pmf)
    report = M.match_report(df, pugged, "pug").first().asDict()
    assert (report["n_before"], report["n_rows"], report["expanded"], report["n_unmatched"]) == (3, 5, True, 1)
    assert report["pct_unmatched"] == pytest.approx(100 / 6)
    # A row without an account is no miss.
    report = M.match_report(pugged, mapped, "sa_account", "pmf_l5").first().asDict()
    assert (report["expanded"], report["n_unmatched"]) == (False, 0)
    assert rows(M.duplicate_keys(pug, "seg_l4_desc")) == [("s4", 2)]


def test_upload_pivot_cells(spark, rows):
    df = frm(spark, dict(), dict(sa_rwa=5.0), dict(quarter_id=0, sa_rwa=None, erba_rwa=3.0), dict(quarter_id=9, pug="far"))
    pivot = U.upload_pivot(M.coerce_before_pivot(df), [1, 2, 0])
    assert rows(pivot, "pug", "rwa_calc", "q1", "q2", "q0") == [
        ("P", "AA", 20.0 * 2, 0.0, 20.0),
        ("P", "ERBA", 0.0, 0.0, 3.0),
        ("P", "SA", 15.0, 0.0, 0.0),
        ("far", "AA", 0.0, 0.0, 0.0),
        ("far", "ERBA", 0.0, 0.0, 0.0),
        ("far", "SA", 0.0, 0.0, 0.0),
    ]
    assert pivot.select("comment", "exposure_type").distinct().collect() == [("0", "0")]


def test_template_layout(spark):
    columns = template(spark, frm(spark, dict())).columns
    assert len(columns) == 31
    assert columns[24:28] == ["RWA Actuals", "Jun 2025", "Sep 2025", "Dec 2025"]
    assert columns == U.upload_layout(["Jun 2025", "Sep 2025", "Dec 2025"])
    first = template(spark, frm(spark, dict())).first()
    assert {c: first[c] for c in rules.UPLOAD_CONSTANTS} == rules.UPLOAD_CONSTANTS


def test_accounts_and_defaults(spark, rows):
    df = frm(spark, dict(), dict(pmf_l5="x", sa_account=None, aa_account=None))
    assert rows(template(spark, df), "PMF Account L5 Descr", "RWA Calc", "Account") == [
        ("Investments (L2)", "AA", "AA-1"),
        ("Investments (L2)", "ERBA", "N/A"),
        ("Investments (L2)", "SA", "SA-1"),
        ("x", "AA", "664062"),
        ("x", "ERBA", "N/A"),
        ("x", "SA", "663722"),
    ]


def test_markets_filter_labels(spark, rows):
    df = frm(
        spark,
        dict(seg_l2_desc="Markets [L2]"),
        dict(seg_l2_desc="Markets [L2]", exposure_type="Direct"),
        dict(exposure_type="Direct"),
        dict(seg_l2_desc=None),
    )
    labelled = template(spark, df).filter("`RWA Calc` = 'SA'")
    assert rows(labelled, "Managed Segment L2 Descr", "RWA Exposure Type", "Markets Filter") == [
        ("Banking [L2]", "Direct", "Keep"),
        ("Markets [L2]", "0", "Keep"),
        ("Markets [L2]", "Direct", "Remove"),
        ("None", "0", "Keep"),
    ]


def test_sorted_by_segment(spark):
    df = frm(spark, *[dict(seg_l2_desc=a, seg_l3_desc=b) for a in "cab" for b in "zxy"])
    got = [(r[0], r[1]) for r in U.upload_sort(template(spark, df)).select("Managed Segment L2 Descr", "Managed Segment L3 Descr").collect()]
    assert got == sorted(got)


def test_long_table(spark, rows):
    df = frm(spark, dict(), dict(quarter_id=0), dict(quarter_id=8, erba_rwa=1.0))
    long = U.rwa_long(df, "Mar 2025", 8)
    assert rows(long, "period", "rwa_calc", "rwa_amount") == [
        (None, "AA", 20.0), (None, "ERBA", 1.0), (None, "SA", 10.0),
        ("Jun 2025", "AA", 20.0), ("Jun 2025", "ERBA", None), ("Jun 2025", "SA", 10.0),
        ("RWA Actuals", "AA", 20.0), ("RWA Actuals", "ERBA", None), ("RWA Actuals", "SA", 10.0),
    ]
    assert U.with_headers(long).columns == [
        "Entity", "Reporting Layer", "Managed Segment L2 Descr", "Managed Segment L3 Descr",
        "Managed Segment L4 Descr", "PMF Account L5 Descr", "Period", "RWA Calc", "RWA Amount",
    ]


def test_controls_agree(spark, rows):
    """Upload totals per segment and calc equal the raw totals; ERBA is left out."""
    df = frm(spark, *[dict(quarter_id=q, sa_rwa=float(q), aa_rwa=1.0, seg_l2_desc=s) for q in range(4) for s in ("a", "b")])
    labels = list(quarter_labels("Mar 2025", 4).values())
    upload = K.control_upload(template(spark, df), labels)
    raw = K.control_raw(df)
    assert rows(upload, "Managed Segment L2 Descr", "RWA Calc", *labels) == rows(
        raw, "seg_l2_desc", "rwa_calc", "q0", "q1", "q2", "q3"
    )


def test_convergence_control_nulls(spark, rows):
    df = spark.createDataFrame(
        [
            ("CG", "a", 0, 1.0, None), ("CG", "a", 2, 4.0, 5.0), ("CG", None, 0, 9.0, 9.0),
            ("CG", "Discontinued Ops [L2]", 0, 9.0, 9.0), ("CG", "a", None, 9.0, 9.0),
        ],
        "entity string, seg_l2_desc string, quarter_id long, sa_rwa_amt double, adv_rwa_amt double",
    )
    # Every quarter that occurs has a column, also one beyond any calendar.
    far = df.union(spark.createDataFrame([("CG", "b", 5000, 7.0, 8.0)], df.schema))
    totals = K.control_convergence(far)
    assert totals.columns == ["entity", "seg_l2_desc", "rwa_calc", "q0", "q2", "q5000"]
    assert rows(totals) == [
        ("CG", "a", "AA RWA", 0.0, 5.0, None), ("CG", "a", "SA RWA", 1.0, 4.0, None),
        ("CG", "b", "AA RWA", None, None, 8.0), ("CG", "b", "SA RWA", None, None, 7.0),
    ]
    long = K.control_summary(df)
    assert ("CG", "a", None, "SA RWA", 9.0) in rows(long, "entity", "segment_l2", "quarter_id", "rwa_calc", "rwa_amount")
    assert long.filter(F.col("segment_l2").isNull()).count() == 0
