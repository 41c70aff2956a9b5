"""Data-quality checks: one row per check, one pass per dataset."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.session import stage_table
from factorfall.functions.values import number, whole
from factorfall.rules import rwf_columns

REPORT_COLUMNS = ("check_name", "dataset", "status", "detail", "n_failing", "n_total", "pct_failing")


def _n(c: str | Column) -> Column:
    """Count with thousands separators."""
    return F.format_number(F.col(c) if isinstance(c, str) else c, 0)


def _share(failing: Column, total: Column) -> Column:
    """Percent with one decimal; 0 of nothing is 0."""
    pct = F.coalesce(F.try_divide(failing.cast("double"), total.cast("double")) * 100, F.lit(0.0))
    return F.format_string("%.1f", pct)


def dq_status(failing: Column, total: Column, fail_pct: Column | float = rules.DQ_FAIL_PCT) -> Column:
    """PASS, WARN or FAIL by the share of failing rows; nothing to check is WARN."""
    limit = fail_pct if isinstance(fail_pct, Column) else F.lit(fail_pct)
    pct = F.try_divide(failing.cast("double"), total.cast("double")) * 100
    return (
        F.when(total == 0, "WARN").when(pct > limit, "FAIL").when(pct > rules.DQ_WARN_PCT, "WARN").otherwise("PASS")
    )


def _check(
    name: str | Column,
    failing: Column,
    total: Column,
    detail: Column,
    fail_pct: float = rules.DQ_FAIL_PCT,
    status: Column | None = None,
) -> Column:
    status = dq_status(failing, total, fail_pct) if status is None else status
    return F.struct(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        detail.alias("detail"),
        failing.cast("bigint").alias("n_failing"),
        total.cast("bigint").alias("n_total"),
    )


def _report(counts: DataFrame, dataset: Column, checks: Sequence[Column]) -> DataFrame:
    """Counts (one row per dataset) to one row per check."""
    exploded = counts.select(dataset.alias("dataset"), F.explode(F.array(*checks)).alias("c")).select("dataset", "c.*")
    pct = F.coalesce(
        F.round(F.try_divide(F.col("n_failing").cast("double"), F.col("n_total").cast("double")) * 100, 2), F.lit(0.0)
    )
    return exploded.withColumn("pct_failing", pct).select(*REPORT_COLUMNS)


def _rows(weight: str | None = None) -> Column:
    """Row count; of pre-aggregated rows, the sum of their counts."""
    return F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0))


def _count_if(condition: Column, weight: str | None = None) -> Column:
    if weight is None:
        return F.count(F.when(condition, 1))
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0))


def _per_entity(df: DataFrame, aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates per entity that occurs, with zeros for a known entity that has no data."""
    names = df.sparkSession.createDataFrame([(e.name,) for e in rules.ENTITIES], "entity string")
    found = df.filter("entity IS NOT NULL").groupBy("entity").agg(*aggregates)
    return names.join(found, "entity", "full").na.fill(0)


def _dataset(suffix: str) -> Column:
    return F.concat(F.lower("entity"), F.lit(f"_{suffix}"))


# -- check builders ---------------------------------------------------------


def row_count_check(n: Column) -> Column:
    empty = (n == 0).cast("int")
    return _check(
        "row_count_nonzero",
        empty,
        F.lit(1),
        F.concat(_n(n), F.lit(" rows")),
        status=F.when(n == 0, "FAIL").otherwise("PASS"),
    )


def null_rate_check(name: str, column: str, nulls: Column, n: Column, fail_pct: float = rules.DQ_FAIL_PCT) -> Column:
    detail = F.concat(
        _n(nulls), F.lit("/"), _n(n), F.lit(" ("), _share(nulls, n), F.lit(f"%) null values in '{column}'")
    )
    return _check(name, nulls, n, detail, fail_pct)


def join_match_check(name: str, missing: Column, n: Column) -> Column:
    detail = F.concat(
        _n(missing), F.lit("/"), _n(n), F.lit(" ("), _share(missing, n), F.lit("%) rows with a key have no join match")
    )
    return _check(name, missing, n, detail)


def skipped_check(name: str, column: str) -> Column:
    """A check whose column the dataset lacks."""
    zero = F.lit(0)
    return _check(name, zero, zero, F.lit(f"Column '{column}' not found — skipped"))


# -- reports per dataset ----------------------------------------------------


def dq_row_count(named: dict[str, DataFrame]) -> DataFrame:
    """Row-count check of each named dataset."""
    out = None
    for name, df in named.items():
        report = _report(df.agg(F.count("*").alias("n")), F.lit(name), [row_count_check(F.col("n"))])
        out = report if out is None else out.unionByName(report)
    return out


def dq_lost_values(lost: DataFrame) -> DataFrame:
    """One check per dataset and column of ``catalog.lost_values``: values a cast could not keep."""
    failing, total = F.col("n_lost"), F.col("n_rows")
    detail = F.concat(
        _n(failing), F.lit("/"), _n(total), F.lit(" ("), _share(failing, total), F.lit("%) values of '"),
        F.col("column_name"), F.lit("' do not fit its type"),
    )
    check = _check(F.concat("column_name", F.lit("_lost_values")), failing, total, detail)
    return _report(lost, F.col("dataset"), [check])


def dq_required_cols(df: DataFrame, required: Iterable[str], dataset: str) -> DataFrame:
    """Missing columns; reads the schema, not the rows."""
    required = list(required)
    missing = [c for c in required if c not in df.columns]
    shown = ", ".join(missing[: rules.DQ_SAMPLE_VALUES])
    if not missing:
        detail = f"All {len(required)} required columns present"
    else:
        more = len(missing) - rules.DQ_SAMPLE_VALUES
        tail = f" … and {more} more" if more > 0 else ""
        detail = f"Missing {len(missing)}/{len(required)} columns: [{shown}]{tail}"
    one = df.sparkSession.range(1)
    check = _check(
        "required_columns",
        F.lit(len(missing)),
        F.lit(len(required)),
        F.lit(detail),
        status=F.lit("FAIL" if missing else "PASS"),
    )
    return _report(one, F.lit(dataset), [check])


def sample_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """One row with the first few unexpected values, in order.

    The filter reaches the source, so clean data costs next to nothing, and
    only the few values kept by the limit meet in one task.
    """
    few = (
        df.filter(~F.col(column).isin(*allowed))
        .select(F.col(column).alias("v"))
        .distinct()
        .orderBy("v")
        .limit(rules.DQ_SAMPLE_VALUES)
    )
    return few.agg(F.array_join(F.array_sort(F.collect_list("v")), ", ").alias("samples"))


def allowed_totals(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows per combination of the columns, staged: several checks of values then cost one read of the table."""
    return stage_table(df.groupBy(*columns).agg(_rows(weight).alias("n_rows")), "values")


def dq_allowed_values(
    df: DataFrame, column: str, allowed: Sequence[str], dataset: str, check_name: str, weight: str | None = None
) -> DataFrame:
    """Share of non-null values outside ``allowed``."""
    if column not in df.columns:
        return _report(df.sparkSession.range(1), F.lit(dataset), [skipped_check(check_name, column)])
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
    counts = df.agg(_rows(weight).alias("n"), _count_if(bad, weight).alias("bad"))
    # Two single rows, told apart by which columns they carry.
    merged = counts.unionByName(sample_values(df, column, allowed), allowMissingColumns=True).agg(
        F.max("n").alias("n"), F.max("bad").alias("bad"), F.max("samples").alias("samples")
    )
    fine = f"All values in allowed set [{', '.join(sorted(allowed))}]"
    detail = F.when(F.col("bad") == 0, fine).otherwise(
        F.concat(
            _n("bad"), F.lit("/"), _n("n"), F.lit(" rows have unexpected values (sample: ["), "samples", F.lit("])")
        )
    )
    return _report(merged, F.lit(dataset), [_check(check_name, F.col("bad"), F.col("n"), detail)])


def dq_null_rate(
    df: DataFrame, columns: dict[str, str], dataset: str, weight: str | None = None, count_rows: bool = False
) -> DataFrame:
    """Null share of several columns (check name -> column) in one pass, and the row count if asked."""
    present = {name: c for name, c in columns.items() if c in df.columns}
    nulls = [_count_if(F.col(c).isNull(), weight).alias(name) for name, c in present.items()]
    counts = df.agg(_rows(weight).alias("n"), *nulls)
    checks = [row_count_check(F.col("n"))] if count_rows else []
    checks += [
        null_rate_check(name, c, F.col(name), F.col("n")) if name in present else skipped_check(name, c)
        for name, c in columns.items()
    ]
    return _report(counts, F.lit(dataset), checks)


def dq_waterfall(outlook: DataFrame, n_keys: int, count_rows: bool = False) -> DataFrame:
    """Match rate of each key and the share of rows no key matched; the row count if asked."""
    aggregates, checks = [F.count("*").alias("n")], [row_count_check(F.col("n"))] if count_rows else []
    n = F.col("n")
    for calc in ("sa", "aa"):
        label = calc.upper()
        for i, column in enumerate(rwf_columns(calc, n_keys), 1):
            if column not in outlook.columns:
                continue
            aggregates.append(F.count(number(column)).alias(f"m_{column}"))
            matched = F.col(f"m_{column}")
            detail = F.concat(
                F.lit(f"Key{i} {label} RWF: "), _n(matched), F.lit("/"), _n(n), F.lit(" ("), _share(matched, n),
                F.lit("%) matched"),
            )
            checks.append(_check(f"waterfall_key{i}_{calc}_match_rate", n - matched, n, detail, status=F.lit("PASS")))
        final = f"final_{calc}_rwf"
        if final in outlook.columns:
            aggregates.append(_count_if(number(final).isNull()).alias(f"f_{calc}"))
            lost = F.col(f"f_{calc}")
            detail = F.concat(
                _n(lost), F.lit("/"), _n(n), F.lit(" ("), _share(lost, n),
                F.lit(f"%) rows fell through all {n_keys} {label} RWF keys"),
            )
            checks.append(_check(f"waterfall_{calc}_fallthrough_rate", lost, n, detail))
    # An entity without rows has no rates.
    return _report(_per_entity(outlook, aggregates), _dataset("outlook"), checks).filter(F.col("n_total") > 0)


def dq_adjustments(adjustments: DataFrame) -> DataFrame:
    """Null shares of the raw adjustment columns that build the first key."""
    n, quarter, account = F.col("n"), F.col("quarter"), F.col("account")
    counts = _per_entity(
        adjustments,
        [
            F.count("*").alias("n"),
            _count_if(F.col("quarter_id").isNull()).alias("quarter"),
            _count_if(F.col("pmf_l5").isNull()).alias("account"),
        ],
    )
    checks = [
        row_count_check(n),
        null_rate_check("quarter_id_nulls", "quarter_id", quarter, n),
        null_rate_check("pmf_l5_nulls", "pmf_l5", account, n, rules.DQ_ADJUSTMENT_ACCOUNT_FAIL_PCT),
    ]
    return _report(counts, _dataset("adjustments"), checks)


def dq_join_match(frm: DataFrame) -> DataFrame:
    """Row counts and the share of keyed rows without a PUG or account match."""
    n = F.col("n")
    counts = _per_entity(
        frm,
        [
            F.count("*").alias("n"),
            F.count("seg_l4_desc").alias("pug_n"),
            _count_if(F.col("seg_l4_desc").isNotNull() & F.col("pug").isNull()).alias("pug_lost"),
            F.count("pmf_l5").alias("pmf_n"),
            _count_if(F.col("pmf_l5").isNotNull() & F.col("sa_account").isNull()).alias("pmf_lost"),
        ],
    )
    checks = [
        row_count_check(n),
        join_match_check("pug_join_match_rate", F.col("pug_lost"), F.col("pug_n")),
        join_match_check("pmf_join_match_rate", F.col("pmf_lost"), F.col("pmf_n")),
    ]
    return _report(counts, _dataset("frm_output"), checks)


def dq_quarter_coverage(frm: DataFrame) -> DataFrame:
    """Whether every projected quarter occurs, per entity.

    The rows shrink to distinct quarters, which the report names one by one,
    before they meet.
    """
    present = frm.select("entity", whole("quarter_id").alias("q")).distinct()
    names = frm.sparkSession.createDataFrame([(e.name,) for e in rules.ENTITIES], "entity string")
    found = present.filter("entity IS NOT NULL").groupBy("entity").agg(F.collect_list("q").alias("qs"))
    lists = names.join(found, "entity", "full").select(
        "entity", F.array_sort(F.coalesce("qs", F.array().cast("array<bigint>"))).alias("present")
    )
    expected = F.array(*[F.lit(q).cast("bigint") for q in rules.COVERED_QUARTERS])
    lists = lists.withColumn("missing", F.array_except(expected, "present"))

    def shown(c: str) -> Column:
        return F.concat(F.lit("["), F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("]"))

    n_missing = F.size("missing")
    detail = F.concat(
        F.lit("Quarters present: "), shown("present"), F.lit("; missing: "),
        F.when(n_missing == 0, "none").otherwise(shown("missing")),
    )
    check = _check(
        "quarter_coverage",
        n_missing,
        F.lit(len(rules.COVERED_QUARTERS)),
        detail,
        status=F.when(n_missing > 0, "FAIL").otherwise("PASS"),
    )
    return _report(lists, _dataset("frm_output"), [check])


def dq_report(
    convergence: DataFrame,
    outlook: DataFrame,
    adjustments: DataFrame,
    frm: DataFrame,
    n_keys: int,
    required: DataFrame,
    run_timestamp: str,
    weight: str | None = None,
) -> DataFrame:
    """All checks, one row each.

    ``adjustments`` are the raw ones, before nulls are filled; ``required`` is
    the report of ``dq_required_cols``; ``weight`` names the row count of a
    pre-aggregated ``convergence``.
    """
    nulls = {
        "projected_quarter_nulls": "projected_quarter",
        "finance_pmf_l5_nulls": "pmf_l5",
        "mngd_sgmt_l2_nulls": "seg_l2_desc",
    }
    flag_columns = [e.flag for e in rules.ENTITIES if e.flag in convergence.columns]
    values = allowed_totals(convergence, flag_columns, weight)
    flags = [
        dq_allowed_values(values, e.flag, ["Y", "N"], "convergence", "entity_flag_values", "n_rows")
        for e in rules.ENTITIES
    ]
    report = required
    for part in (
        dq_null_rate(convergence, nulls, "convergence", weight, count_rows=True),
        *flags,
        dq_waterfall(outlook, n_keys, count_rows=True),
        dq_adjustments(adjustments),
        dq_join_match(frm),
        dq_quarter_coverage(frm),
    ):
        report = report.unionByName(part)
    return report.withColumn("run_timestamp", F.lit(run_timestamp))
