import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from factorfall.functions import quarters as Q
from factorfall.functions import rwa as R
from factorfall.functions import values as V
from factorfall.operators import addon as A
from factorfall.operators import convergence as C
from factorfall.operators import outlook as O
from factorfall.operators import upload as U


@pytest.mark.parametrize(
    "rwa, gaap, expected",
    [
        (50.0, 100.0, 0.5),
        (1250.0, 100.0, 12.5),
        (1251.0, 100.0, 1.0),
        (-1251.0, 100.0, 1.0),
        (-1250.0, 100.0, -12.5),
        (5.0, 0.0, 1.0),
        (0.0, 0.0, None),
        (0.0, 10.0, 0.0),
        (None, 10.0, None),
        (10.0, None, None),
    ],
)
def test_capped_ratio(spark, rwa, gaap, expected):
    df = spark.createDataFrame([(rwa, gaap)], "r double, g double")
    assert df.select(R.capped_ratio("r", "g")).first()[0] == expected


def test_first_valid_takes_zero_and_skips_text(spark):
    df = spark.createDataFrame([(None, "x", "0", "3"), ("", None, None, None)], "a string, b string, c string, d string")
    got = [r[0] for r in df.select(R.first_valid(["a", "b", "c", "d"])).collect()]
    assert got == [0.0, None]


def test_waterfall_columns_in_number_order(spark):
    names = ["sa_rwf", "sa_rwf_key10", "sa_rwf_key2_adj", "sa_rwf_key2", "sa_rwf_key3", "sa_rwf_adj", "aa_rwf_key2"]
    df = spark.createDataFrame([], ", ".join(f"{n} double" for n in names))
    assert O.waterfall_columns(df, "sa") == ["sa_rwf", "sa_rwf_key2", "sa_rwf_key2_adj", "sa_rwf_key3", "sa_rwf_key10"]


def test_int_str_and_whole(spark):
    df = spark.createDataFrame([("4.0",), ("4",), ("x",), (None,), ("9007199254740993",)], "c string")
    assert [r[0] for r in df.select(V.int_str("c")).collect()] == ["4", "4", "nan", "nan", "9007199254740993"]
    assert [r[0] for r in df.select(V.whole("c")).collect()] == [4, 4, None, None, 9007199254740993]


def test_grouped_sum_drops_null_keys_and_fills_null_sums(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 5.0), ("b", 2.0)], "k string, v double")
    assert rows(V.grouped_sum(df, ["k"], {"v": "v"})) == [("a", 0.0), ("b", 2.0)]
    kept = V.grouped_sum(df, ["k"], {"v": "v"}, keep_null=["k"])
    assert rows(kept) == [(None, 5.0), ("a", 0.0), ("b", 2.0)]


def test_left_join_null_safe(spark, rows):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(V.left_join(left, right, {"k": "k"})) == [(None, None), ("a", 1)]
    assert rows(V.left_join(left, right, {"k": "k"}, null_safe=True)) == [(None, 2), ("a", 1)]


def test_blank_to_null_and_fill_zero(spark, rows):
    df = spark.createDataFrame([("", 1.0), ("x", None)], "t string, `n #` double")
    assert rows(V.blank_to_null(df)) == [(None, 1.0), ("x", None)]
    assert rows(V.fill_zero(V.blank_to_null(df))) == [("0", 1.0), ("x", 0.0)]


def test_quarter_map_wraps_the_year(spark, rows):
    assert rows(Q.quarter_map(spark, "Nov 2024", 3)) == [(0, 2024, "Nov"), (1, 2025, "Feb"), (2, 2025, "May")]
    assert Q.quarter_labels("Mar 2025", 5) == {
        0: "RWA Actuals", 1: "Jun 2025", 2: "Sep 2025", 3: "Dec 2025", 4: "Mar 2026",
    }
    assert Q.ordered_quarters(4) == [1, 2, 3, 0]
    assert Q.quarter_map(spark, "Mar 2025", 5001).filter("quarter_id = 5000").first()["year"] == 3275


def test_period_label_matches_quarter_labels(spark):
    df = spark.range(-1, 6).withColumnRenamed("id", "quarter_id")
    got = [r[0] for r in df.orderBy("quarter_id").select(Q.period_label("Mar 2025", 5)).collect()]
    assert got == [None, *Q.quarter_labels("Mar 2025", 5).values(), None]


def test_projected_quarter(spark, rows):
    df = spark.createDataFrame([("3Q25", 9), ("1Q26", 9), ("9Q99", 9), ("xQ25", 9), (None, 9)], "projected_quarter string, quarter_id long")
    parsed = A.projected_quarter_parse(df, Q.quarter_map(spark, "Mar 2025", 8))
    assert rows(parsed, "projected_quarter", "year", "month", "quarter_id") == [
        (None, None, None, None),
        ("1Q26", 2026, "Mar", 4),
        ("3Q25", 2025, "Sep", 2),
        ("9Q99", 2099, None, None),
        ("xQ25", 2025, None, None),
    ]


def test_erba_only_in_quarters_five_and_six(spark):
    df = spark.range(8).select(F.col("id").alias("quarter_id"), F.lit(1.0).alias("sa"))
    got = {r[0]: r[1] for r in df.select("quarter_id", R.erba_rwa("sa")).collect()}
    assert got == {q: 1.0 if q in (5, 6) else None for q in range(8)}


@pytest.mark.parametrize(
    "l3, l4, geo, expected",
    [
        ("Legacy Franchises [L3]", "Legacy Holdings Assets [L4]", "Latin America", "Legacy Holdings"),
        ("Legacy Franchises [L3]", "Other [L4]", "Latin America", "Legacy Holdings Other"),
        ("Legacy Franchises [L3]", None, None, "Legacy Holdings Other"),
        ("Cards [L3]", "Legacy Holdings Assets [L4]", "Latin America", "Legacy - Latin America"),
        (None, None, "Latin America", "Legacy - Latin America"),
        ("Cards [L3]", None, None, "Non Legacy"),
    ],
)
def test_reporting_layer(spark, l3, l4, geo, expected):
    df = spark.createDataFrame([(l3, l4, geo)], "seg_l3_desc string, seg_l4_desc string, geo_l3_desc string")
    assert df.select(R.reporting_layer()).first()[0] == expected


def test_projected_rwa_zero_accounts_and_missing_factor(spark):
    df = spark.createDataFrame(
        [("Trading Account Assets (L2)", 10.0, None), ("Investments (L2)", 10.0, 0.5), ("Investments (L2)", 10.0, None)],
        "pmf_l5 string, balances double, f double",
    )
    assert [r[0] for r in df.select(R.projected_rwa("f")).collect()] == [0.0, 5.0, None]


def test_exact_sums_of_any_order(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 12) for _ in range(3000)] + [1e15, -1e15, 0.1, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    floored = sum((Fraction(math.floor(v)) + Fraction(math.floor((v - math.floor(v)) * 2**52), 2**52) for v in values if v is not None), Fraction(0))
    sums = {df.repartition(n).agg(V.exact_sum("x")).first()[0] for n in (1, 7, 211)}
    assert len(sums) == 1 and math.isclose(sums.pop(), float(floored), rel_tol=1e-15)


def test_exact_sums_of_odd_values(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(V.exact_sum("x"), V.filled_sum("x")).first()

    assert tuple(total(None, None)) == (None, 0.0)
    assert tuple(total(0.1, 0.2, None, -0.3))[0] == 2.0**-52 * math.floor(0.1 * 2**52) + 2.0**-52 * math.floor(0.2 * 2**52) - 1 + 2.0**-52 * math.floor(0.7 * 2**52)
    assert total(-0.5, -1.25)[0] == -1.75 and total(2.0**60, 1.5)[0] == 2.0**60 + 1.5
    assert total(float("inf"), 1.0)[0] == float("inf") and math.isnan(total(float("nan"), 1.0)[0])


def test_pivot_and_factors_have_the_same_bits_in_any_partitioning(spark):
    rng = random.Random(3)
    rows = [("s", "t", "u", "p", "c", "e", "BA", "l", "1", "2", "P", rng.randint(0, 3), *(rng.uniform(-1e7, 1e7) for _ in range(3))) for _ in range(2000)]
    df = spark.createDataFrame(rows, [*U.UPLOAD_DIMS, "quarter_id", *U.CALCS.values()])
    pivots = {tuple(sorted(map(tuple, U.upload_pivot(df.repartition(n), range(4)).collect()))) for n in (1, 7, 211)}
    assert len(pivots) == 1 and len(pivots.pop()) == 3
    fields = "entity string, quarter_id long, seg_l4_code long, seg_l3_code long, seg_l2_code long, geo_l4_desc string, geo_l3_desc string, pmf_l5 string, seg_l2_desc string, gaap_amt double, sa_rwa_amt double, adv_rwa_amt double"
    rows = [("CG", 0, rng.randint(1, 2), 3, 2, "US", "NAM", "Loans", "Banking [L2]", *(rng.uniform(0, 1e6) for _ in range(3))) for _ in range(1000)]
    df = spark.createDataFrame(rows, fields)
    factors = {tuple(sorted(map(str, C.factor_table(df.repartition(n)).collect()))) for n in (1, 7, 211)}
    assert len(factors) == 1
