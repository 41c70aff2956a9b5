import pytest
from pyspark.sql import functions as F

from factorfall.operators import diff as X
from factorfall.operators import dq as D
from factorfall.operators import profile as P


@pytest.mark.parametrize(
    "failing, total, expected",
    [(0, 100, "PASS"), (1, 100, "WARN"), (5, 100, "WARN"), (501, 10000, "FAIL"), (0, 0, "WARN")],
)
def test_dq_status(spark, failing, total, expected):
    assert spark.range(1).select(D.dq_status(F.lit(failing), F.lit(total))).first()[0] == expected


def test_allowed_values_samples_and_weights(spark):
    df = spark.createDataFrame([(v, 10) for v in "YNabcdefg"] + [(None, 10)], "flag string, n long")
    row = D.dq_allowed_values(df, "flag", ["Y", "N"], "d", "c").first()
    assert (row["n_failing"], row["n_total"], row["status"]) == (7, 10, "FAIL")
    assert row["detail"] == "7/10 rows have unexpected values (sample: [a, b, c, d, e])"
    weighted = D.dq_allowed_values(df, "flag", ["Y", "N"], "d", "c", weight="n").first()
    assert (weighted["n_failing"], weighted["n_total"]) == (70, 100)
    clean = D.dq_allowed_values(df.filter("flag in ('Y', 'N')"), "flag", ["Y", "N"], "d", "c").first()
    assert (clean["detail"], clean["status"]) == ("All values in allowed set [N, Y]", "PASS")
    assert D.dq_allowed_values(df, "gone", ["Y"], "d", "c").first()["status"] == "WARN"


def test_row_count_and_null_rate(spark, rows):
    df = spark.createDataFrame([(i if i % 4 else None,) for i in range(2000)], "v int")
    row = D.dq_null_rate(df, {"v_nulls": "v"}, "d").first()
    assert (row["detail"], row["status"], row["pct_failing"]) == ("500/2,000 (25.0%) null values in 'v'", "FAIL", 25.0)
    assert rows(D.dq_row_count({"d": df, "e": df.limit(0)}), "dataset", "status", "detail", "n_failing") == [
        ("d", "PASS", "2,000 rows", 0), ("e", "FAIL", "0 rows", 1),
    ]


def test_required_columns(spark):
    df = spark.createDataFrame([], "a int")
    row = D.dq_required_cols(df, ["a", *[f"m{i}" for i in range(7)]], "d").first()
    assert row["detail"] == "Missing 7/8 columns: [m0, m1, m2, m3, m4] … and 2 more"
    assert D.dq_required_cols(df, ["a"], "d").first()["status"] == "PASS"


def test_quarter_coverage_and_absent_entity(spark, rows):
    df = spark.createDataFrame([("CG", q) for q in range(8)] * 3, "entity string, quarter_id long")
    assert rows(D.dq_quarter_coverage(df), "dataset", "status", "n_failing", "detail") == [
        ("cbna_frm_output", "FAIL", 7, "Quarters present: []; missing: [1, 2, 3, 4, 5, 6, 7]"),
        ("cg_frm_output", "PASS", 0, "Quarters present: [0, 1, 2, 3, 4, 5, 6, 7]; missing: none"),
    ]
    far = spark.createDataFrame([("CG", 1), ("CG", 5000), ("NEW", 2), (None, 3)], "entity string, quarter_id long")
    assert rows(D.dq_quarter_coverage(far), "dataset", "detail")[1:] == [
        ("cg_frm_output", "Quarters present: [1, 5000]; missing: [2, 3, 4, 5, 6, 7]"),
        ("new_frm_output", "Quarters present: [2]; missing: [1, 3, 4, 5, 6, 7]"),
    ]


def test_waterfall_rates(spark, rows):
    df = spark.createDataFrame(
        [("CG", 1.0, None, 1.0)] * 9 + [("CG", None, None, None)],
        "entity string, sa_rwf double, sa_rwf_key2 double, final_sa_rwf double",
    )
    report = D.dq_waterfall(df, 2, count_rows=True)
    assert rows(report, "dataset", "check_name", "status", "n_failing") == [
        ("cbna_outlook", "row_count_nonzero", "FAIL", 1),
        ("cg_outlook", "row_count_nonzero", "PASS", 0),
        ("cg_outlook", "waterfall_key1_sa_match_rate", "PASS", 1),
        ("cg_outlook", "waterfall_key2_sa_match_rate", "PASS", 10),
        ("cg_outlook", "waterfall_sa_fallthrough_rate", "FAIL", 1),
    ]


def test_adjustment_limit_is_thirty_percent(spark):
    df = spark.createDataFrame([("CG", "1", "a" if i > 2 else None) for i in range(10)], "entity string, quarter_id string, pmf_l5 string")
    status = {(r["dataset"], r["check_name"]): r["status"] for r in D.dq_adjustments(df).collect()}
    assert status["cg_adjustments", "pmf_l5_nulls"] == "WARN"
    assert status["cbna_adjustments", "pmf_l5_nulls"] == "WARN"
    assert status["cbna_adjustments", "row_count_nonzero"] == "FAIL"


def tables(spark):
    fields = "id double, t string, v double, same long"
    a = spark.createDataFrame([(1.0, " x", 1.0, 1), (2.0, "y", 100.0, 1), (3.0, "z", None, 1), (4.0, None, 5.0, 1)], fields)
    b = spark.createDataFrame([("1", " x", 1.0000001, 1, 0), ("2", "y", 101.0, 1, 0), ("3", "q", None, 1, 0), ("5", " ", 5.0, 1, 0)], "id string, t string, v double, same long, added int")
    return a, b


def test_diff_detects_keys():
    known = ["Managed Segment L4 Id", "Managed Geography L4 Descr", "PMF Account L5 Descr", "Quarter Id"]
    assert X.diff_key_detect([*known, "x"], known) == known
    assert X.diff_key_detect(["a"], ["a"], ["a"]) == ["a"]
    with pytest.raises(ValueError):
        X.diff_key_detect(["a"], ["b"])
    with pytest.raises(ValueError):
        X.diff_key_detect(["a"], ["b"], ["a"])


def test_diff_columns_and_verdict(spark, rows):
    a, b = tables(spark)
    assert rows(X.diff_columns(a, b, ["id"]), "column_name", "n_diffs", "status") == [
        ("same", 0, "PASS"), ("t", 1, "FAIL"), ("v", 1, "FAIL"),
    ]
    verdict = X.diff_verdict(a, b, ["id"]).first().asDict()
    assert verdict == {
        "both": 3, "left_only": 1, "right_only": 1, "failed_columns": 2, "failed_totals": 1, "same_schema": False,
        "invariant": False,
    }
    assert X.diff_verdict(a, a, ["id"]).first()["invariant"]


def test_blank_equals_null_and_key_is_trimmed(spark):
    a = spark.createDataFrame([(" k ", None)], "k string, t string")
    b = spark.createDataFrame([("k", "  ")], "k string, t string")
    assert X.diff_verdict(a, b, ["k"]).first()["invariant"]


def test_compare_tables(spark, rows):
    a, b = tables(spark)
    out = X.compare_tables(a, b, ["id"])
    assert rows(out["only_in_a"]) == [("4",)] and rows(out["only_in_b"]) == [("5",)]
    assert rows(out["differing:v"]) == [("2", 100.0, 101.0)]
    assert rows(out["schema"], "column_name", "side")[0] == ("added", "B")
    for compare in (X.compare_tables, X.diff_rows, X.diff_columns, X.diff_verdict):
        with pytest.raises(ValueError, match="not unique"):
            compare(a.union(a), b, ["id"])


def test_repeated_null_keys_are_refused(spark):
    a = spark.createDataFrame([(None, 1), (None, 2)], "k string, v int")
    with pytest.raises(ValueError, match="not unique"):
        X.diff_rows(a, a.limit(1), ["k"])


def test_digests_give_the_same_verdict(spark):
    a, b = tables(spark)
    for x, y in ((a, b), (b, a), (a, a), (a, a.limit(0)), (a.limit(0), a.limit(0))):
        for buckets in (1, 7, 4096):
            assert X.digest_verdict(x, y, ["id"], buckets=buckets).first() == X.diff_verdict(x, y, ["id"]).first()


def test_equal_tables_stop_at_their_digests(spark, monkeypatch):
    a, _ = tables(spark)

    def never(*_):
        raise AssertionError("rows were paired")

    monkeypatch.setattr(X, "paired_rows", never)
    assert X.digest_verdict(a, a.repartition(3).orderBy("t"), ["id"]).first()["invariant"]
    with pytest.raises(AssertionError, match="paired"):
        X.digest_verdict(a, a.limit(2), ["id"])


def test_digests_see_where_a_null_stands_and_refuse_repeats(spark):
    fields = "k string, x string, y string"
    a, b = (spark.createDataFrame([("1", *v)], fields) for v in (("p", None), (None, "p")))
    assert X.digest_verdict(a, b, ["k"]).first()["failed_columns"] == 2
    with pytest.raises(ValueError, match="not unique"):
        X.digest_verdict(a.union(a), b, ["k"])


def test_pairs_from_one_shuffle_with_a_repeated_key(spark):
    rows = [(None, 1)] * 500 + [("k", 2)]
    a = spark.createDataFrame(rows, "k string, v int").repartition(4)
    paired = X.paired_rows(a, a.limit(0).withColumn("w", F.lit(None)), ["k"])
    assert {r["k"]: (r["__n_a"], r["__n_b"]) for r in paired.collect()} == {"None": (500, 0), "k": (1, 0)}
    plan = paired._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1


def test_identifiers():
    assert P.identifier("SA Account #") == "SA_ACCOUNT__"
    assert P.identifier("1st") == "COL_1ST"
    assert P.identifier("") == "COL"
    long = "Reportable Entity Amount with a Multiplier"
    names = P.identifiers([long + " A", long + " B", long + " C"])
    assert len(set(names.values())) == 3 and all(len(n) <= 30 for n in names.values())
    assert names[long + " B"].endswith("_1")


def test_profile_types(spark, rows):
    df = spark.createDataFrame([], "i long, d double, b boolean, ts timestamp, t string").unionByName(
        spark.sql("SELECT 1L AS i, 1D AS d, true AS b, timestamp'2024-01-01' AS ts, 'abcde' AS t")
    )
    assert [tuple(r) for r in P.mapping_log(df).select("target_name", "target_type", "max_observed_length").collect()] == [
        ("I", "NUMBER(18,0)", None), ("D", "FLOAT", None), ("B", "CHAR(1)", None), ("TS", "TIMESTAMP(6)", None),
        ("T", "VARCHAR2(15)", 5),
    ]
    empty = P.mapping_log(df.filter("i = 2").select("t")).first()
    assert empty["target_type"] == "VARCHAR2(11)"
    wide = P.mapping_log(spark.range(1).select(F.repeat(F.lit("x"), 5000).alias("t"))).first()
    assert wide["target_type"] == "VARCHAR2(4000)"
