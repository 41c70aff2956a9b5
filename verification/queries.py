"""One query per operator, each over the whole given tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.functions import quarters as Q
from factorfall.functions import values as V
from factorfall.functions.rwa import entity_code
from factorfall.operators import addon as A
from factorfall.operators import controls as K
from factorfall.operators import convergence as C
from factorfall.operators import diff as X
from factorfall.operators import dq as D
from factorfall.operators import frm as M
from factorfall.operators import outlook as O
from factorfall.operators import profile as P
from factorfall.operators import upload as U
from factorfall.plans import pipeline, stages, summary
from factorfall.plans.config import Parameters
from factorfall.schemas import REGISTRY, canonical
from factorfall.session import stage_table, staging_path
from factorfall.sources import catalog, sinks
from verification.views import view

Q0 = "Mar 2025"
N_QUARTERS = 8
RUN_TIMESTAMP = "2025-01-01T00:00:00+00:00"
PARAMS = Parameters(q0=Q0, n_quarters=N_QUARTERS)
QUARTERS = Q.ordered_quarters(N_QUARTERS)

LONG = ["entity", "year", "month", "seg_l4_desc", "seg_l3_desc", "seg_l2_desc", "geo_l4_desc", "geo_l3_desc", "pmf_l5"]
SEG_IDS = ["seg_l4_id", "seg_l3_id", "seg_l2_id"]
RWF = [*rules.rwf_columns("sa", 5), *rules.rwf_columns("aa", 5)]
DIFF_KEY = ["entity", "year", "seg_l4_desc", "geo_l4_desc", "geo_l3_desc", "pmf_l5"]


def cents(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of fractions depend on order in their last digits; reports show whole cents."""
    return df.withColumns({c: F.round(F.col(f"`{c}`")) for c in columns})


def quarter_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if re.fullmatch(r"q\d+", c)]


class Tables:
    """Input tables and shared steps for one session and data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def view(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    @cached_property
    def convergence(self) -> DataFrame:
        return self.view("convergence")

    @cached_property
    def balance_sheet(self) -> DataFrame:
        return self.view("balance_sheet")

    @cached_property
    def adjustments(self) -> DataFrame:
        return self.view("adjustments")

    @cached_property
    def pug(self) -> DataFrame:
        return self.view("pug_mapping")

    @cached_property
    def pmf(self) -> DataFrame:
        return self.view("pmf_mapping")

    @cached_property
    def given(self) -> stages.Inputs:
        return stages.Inputs(self.convergence, self.balance_sheet, self.adjustments, self.pug, self.pmf)

    @cached_property
    def inputs(self) -> stages.Inputs:
        """Inputs of a run, the large ones reduced to staged totals as a run does."""
        return stages.prepared(self.given)

    @property
    def source(self) -> stages.Inputs:
        """The staged totals where a query reads the inputs more than once, else the tables themselves."""
        return self.__dict__.get("inputs", self.given)

    @cached_property
    def rows(self) -> DataFrame:
        return C.by_entity(self.convergence)

    @cached_property
    def calendar(self) -> DataFrame:
        return Q.quarter_map(self.spark, Q0, N_QUARTERS)

    @cached_property
    def balances(self) -> DataFrame:
        return C.string_normalise(self.balance_sheet)

    @cached_property
    def long(self) -> DataFrame:
        return O.melt_balances(O.quarterly_sum(O.month_columns(self.balances)))

    @cached_property
    def dated(self) -> DataFrame:
        return O.quarter_join(self.long, self.calendar)

    @cached_property
    def lookups(self) -> DataFrame:
        return stage_table(stages.factors(self.source, PARAMS), "factors")

    @cached_property
    def with_factors(self) -> DataFrame:
        return stages.outlook_factors(self.source, PARAMS, N_QUARTERS, self.lookups)

    @cached_property
    def outlook(self) -> DataFrame:
        return stages.stage1_outlook(self.source, PARAMS, N_QUARTERS, self.lookups)

    @cached_property
    def addon(self) -> DataFrame:
        return stages.stage1_addon(self.source, PARAMS, N_QUARTERS)

    @cached_property
    def raw(self) -> DataFrame:
        inputs = self.inputs  # factors and add-ons both read the exposures
        return stages.raw_data(inputs, self.outlook, self.addon)

    @cached_property
    def frm(self) -> DataFrame:
        return stages.stage2_frm(self.inputs, self.raw)

    def stage(self, *names: str) -> Tables:
        """Write steps that the rest of a query reads more than once."""
        for name in names:
            self.__dict__[name] = stage_table(getattr(self, name), name)
        return self

    @cached_property
    def template(self) -> DataFrame:
        return stages.upload_template(self.frm, PARAMS, N_QUARTERS)

    @cached_property
    def pivots(self) -> DataFrame:
        return C.key_pivots(C.split_credit_risk(self.rows))

    @cached_property
    def steps(self) -> dict[str, DataFrame]:
        return summary.summary_steps(
            self.convergence, self.balance_sheet, self.calendar, list(range(N_QUARTERS))
        )

    @cached_property
    def staged_steps(self) -> dict[str, DataFrame]:
        return summary.summary_steps(
            self.convergence, self.balance_sheet, self.calendar, list(range(N_QUARTERS)), staged=True
        )

    @cached_property
    def pair(self) -> tuple[DataFrame, DataFrame]:
        """A balance table and an edited copy: changed, missing and added rows, blank text, a new column."""
        a = (
            self.balance_sheet.dropna(subset=DIFF_KEY)
            .groupBy(*DIFF_KEY)
            .agg(F.sum("m3").alias("m3"), F.sum("m6").alias("m6"), F.max("seg_l2_desc").alias("seg_l2_desc"))
            .withColumn("note", F.when(F.col("year") == 2026, F.lit("")).otherwise(F.lit("x")))
        )
        a = stage_table(a, "pair")  # blank text included
        b = (
            a.filter((F.col("year") != 2027) | (F.col("pmf_l5") != "Investments (L2)"))
            .withColumn("m3", F.when(F.col("geo_l3_desc") == "EUROPE", F.col("m3") * 2).otherwise(F.col("m3")))
            .withColumn("note", F.when(F.col("note") == "", F.lit(None)).otherwise(F.col("note")))
            .withColumn("year", F.when(F.col("geo_l4_desc") == "NATION_3", F.col("year") + 10).otherwise(F.col("year")))
            .withColumn("added", F.lit(1))
        )
        return a, b


Query = Callable[[Tables], DataFrame]
REGISTERED: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTERED[fn.__name__] = fn
    return fn


# -- sources and sinks ------------------------------------------------------

def landed_sheet(t: Tables) -> DataFrame:
    """Balance rows under every source header, one of them spaced twice, all values as text."""
    held = {canonical(f.name): f.name for f in REGISTRY["balance_sheet"].fields}
    sheet = t.balance_sheet
    values = [
        (F.col(c) if c in sheet.columns else F.lit(None)).cast("string").alias(h.replace("L4 Descr", "L4  Descr"))
        for c, h in held.items()
    ]
    return sheet.select(*values)


def sheet_totals(df: DataFrame) -> DataFrame:
    """Totals that show every row and cell of a read sheet."""
    named = catalog.to_canonical(df)
    return named.groupBy("year", "seg_l4_id", "seg_l4_desc").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("m3").cast("decimal(18,2)")).cast("double").alias("m3"),
        F.count("m12").alias("n_m12"),
    )


@register
def scan_typed(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "landed")
    landed_sheet(t).write.parquet(path)
    return sheet_totals(catalog.scan_typed(t.spark, path, REGISTRY["balance_sheet"]))


@register
def scan_csv(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "landed")
    landed_sheet(t).write.option("header", True).csv(path)
    return sheet_totals(catalog.scan_csv(t.spark, path, REGISTRY["balance_sheet"]))


@register
def ingest_to_parquet(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "landed")
    landed_sheet(t).write.option("header", True).csv(f"{path}/sheet.csv")
    spec = catalog.SourceSpec("cg", f"{path}/sheet.csv", "balance_sheet", "sheet.parquet")
    catalog.ingest_to_parquet(t.spark, [spec], path)
    return sheet_totals(t.spark.read.parquet(f"{path}/sheet.parquet"))


@register
def undeclared_types(t: Tables) -> DataFrame:
    """Columns the schema does not name, each in the type its values show."""
    path = staging_path(t.spark, "landed")
    year, cents = F.col("YEAR"), F.col("`M3_USDOLLAR`").cast("double").cast("decimal(18,0)")
    extra = {
        "Load No": F.concat(year, F.coalesce("`Managed Segment L4 Id`", F.lit("0"))),
        "Rate": (cents / 100).cast("decimal(18,2)").cast("string"),
        "As  Of": F.concat(year, F.lit("-03-31")),
        "Closed": F.col("`M12_USDOLLAR`").isNull().cast("string"),
        "Code": F.concat(F.lit("00"), F.right(year, F.lit(1))),
        "Mixed": F.when(F.col("`M12_USDOLLAR`").isNull(), "n/a").otherwise(year),
    }
    landed_sheet(t).withColumns(extra).write.option("header", True).csv(path)
    read = catalog.scan_csv(t.spark, path, REGISTRY["balance_sheet"])
    types = ",".join(read.schema[c].dataType.simpleString() for c in ("Load No", "Rate", "As Of", "Closed", "Code", "Mixed"))
    return read.groupBy(F.col("YEAR").alias("year")).agg(
        F.sum("Load No").alias("load_no"),
        F.sum(F.col("Rate").cast("decimal(18,2)")).cast("double").alias("rate"),
        F.date_format(F.max("As Of"), "yyyy-MM-dd").alias("as_of"),
        F.count(F.when(F.col("Closed"), 1)).alias("n_closed"),
        F.min("Code").alias("code"),
        F.max("Mixed").alias("mixed"),
        F.lit(types).alias("types"),
    )


@register
def lost_values(t: Tables) -> DataFrame:
    """Planted values that do not fit, as counted by the write of the copy."""
    path = staging_path(t.spark, "landed")
    planted = {
        "YEAR": F.when(F.col("`M12_USDOLLAR`").isNull(), "soon").otherwise(F.col("YEAR")),
        "Managed Segment L4 Id": F.concat("`Managed Segment L4 Id`", F.when(F.col("YEAR") == "2026", ".5").otherwise(".0")),
        "M6_USDOLLAR": F.when(F.col("`PMF Account L5 Descr`").isNull(), "1,5").otherwise(F.col("`M6_USDOLLAR`")),
        "M9_USDOLLAR": F.when(F.col("YEAR") == "2027", "NaN").otherwise(F.col("`M9_USDOLLAR`")),
    }
    landed_sheet(t).withColumns(planted).write.option("header", True).csv(f"{path}/sheet.csv")
    spec = catalog.SourceSpec("cg", f"{path}/sheet.csv", "balance_sheet", "sheet.parquet")
    catalog.ingest_to_parquet(t.spark, [spec], path)
    counted = catalog.lost_values(t.spark, [spec], path)
    return D.dq_lost_values(counted.filter(F.col("column_name").isin(*planted, "M3_USDOLLAR")))


@register
def scan_fallback(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "landed")
    landed_sheet(t).write.option("header", True).csv(f"{path}/sheet.csv")
    spec = catalog.SourceSpec("cg", f"{path}/sheet.csv", "balance_sheet", "sheet.parquet")
    return sheet_totals(catalog.scan_fallback(t.spark, spec, path))


@register
def blank_to_null(t: Tables) -> DataFrame:
    cleaned = V.blank_to_null(t.adjustments)
    return cleaned.groupBy("entity", "exposure_type").agg(
        F.count("*").alias("n_rows"), F.count("comment").alias("n_comment")
    )


@register
def sink_parquet(t: Tables) -> DataFrame:
    folder = staging_path(t.spark, "sink")
    sinks.sink_parquet({"balances": t.balance_sheet}, folder, partition_by="entity")
    back = t.spark.read.parquet(f"{folder}/balances.parquet")
    return back.groupBy("entity", "year").agg(F.count("*").alias("n_rows"), F.sum("m3").alias("m3"))


@register
def sink_long(t: Tables) -> DataFrame:
    folder = staging_path(t.spark, "sink")
    sinks.sink_parquet({"rwa_long": U.with_headers(U.rwa_long(t.frm, Q0, N_QUARTERS))}, folder)
    back = t.spark.read.parquet(f"{folder}/rwa_long.parquet")
    totals = back.groupBy("Entity", "RWA Calc", "Period").agg(
        F.count("*").alias("n_rows"), F.count("RWA Amount").alias("n_amounts")
    )
    return totals.withColumnsRenamed({"Entity": "entity_code", "RWA Calc": "rwa_calc", "Period": "period"})


@register
def load_tables(t: Tables) -> DataFrame:
    catalog.load_tables({"loaded_balance_sheet": t.balance_sheet, "loaded_quarter_map": t.calendar})
    return t.spark.sql(
            """SELECT b.entity, q.quarter_id, COUNT(*) AS n_rows, SUM(b.m3) AS m3
               FROM loaded_balance_sheet b JOIN loaded_quarter_map q ON b.year = q.year AND q.month = 'Mar'
               GROUP BY b.entity, q.quarter_id"""
        )


# -- projections and coercion -----------------------------------------------


@register
def month_columns(t: Tables) -> DataFrame:
    months = O.month_columns(t.balance_sheet)
    return months.groupBy("entity", "year").agg(*[F.sum(m).alias(m) for m in rules.MONTHS])


@register
def rename_addon(t: Tables) -> DataFrame:
    renamed = A.rename_addon(t.addon)
    dims = ["entity", "quarter_id", "seg_l4_id", "seg_l3_id", "seg_l2_id", "pmf_l5", "exposure_type", "geo_l4_desc"]
    return renamed.select(*dims, "sa_rwa", "aa_rwa", "erba_rwa")


@register
def coerce_adjustments(t: Tables) -> DataFrame:
    done = M.coerce_adjustments(V.blank_to_null(t.adjustments))
    return done.select(
            "entity", "year", "seg_l4_id", "geo_l4_desc", "pmf_l5", "quarter_id", "balances", "sa_rwa", "aa_rwa",
            "comment", "exposure_type", "sa_rwf", "aa_rwf", "sa_rwf_key2", "aa_rwf_key2",
        )


@register
def coerce_before_pivot(t: Tables) -> DataFrame:
    done = M.coerce_before_pivot(t.frm)
    return done.groupBy("entity_code", "pug", "sa_account", "aa_account", "pmf_l5").agg(
        F.count("*").alias("n_rows"), F.count("sa_rwa").alias("n_sa")
    )


@register
def string_normalise(t: Tables) -> DataFrame:
    return C.string_normalise(t.convergence).groupBy("pmf_l5").agg(F.count("*").alias("n_rows"))


@register
def int_str(t: Tables) -> DataFrame:
    ids = t.balance_sheet.select(V.int_str(F.col("seg_l4_id").cast("double")).alias("id_text"))
    return ids.groupBy("id_text").agg(F.count("*").alias("n_rows"))


@register
def fill_zero_all(t: Tables) -> DataFrame:
    filled = V.fill_zero(t.balance_sheet.select("entity", "seg_l4_desc", "pmf_l5", "seg_l4_id", "m12"))
    return filled.groupBy("entity", "seg_l4_desc", "pmf_l5", "seg_l4_id").agg(
            F.count("m12").alias("n_m12"), F.sum("m12").alias("m12")
        )


@register
def stub_columns(t: Tables) -> DataFrame:
    stubbed = U.stub_columns(t.frm.select("entity_code", "seg_l2_desc"))
    return stubbed.groupBy("entity_code", "FileType", "Affiliate", "BalanceType", "Currency", "Layer", "Comments").agg(
        F.count("*").alias("n_rows")
    )


@register
def entity_tag(t: Tables) -> DataFrame:
    return t.rows.groupBy(entity_code().alias("entity_code")).agg(F.count("*").alias("n_rows"))


# -- filters ----------------------------------------------------------------


def bucket_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("entity", "seg_l2_desc", "pmf_l5", "quarter_id").agg(
            F.count("*").alias("n_rows"),
            F.sum("gaap_amt").alias("gaap_amt"),
            F.sum("sa_rwa_amt").alias("sa_rwa_amt"),
            F.sum("adv_rwa_amt").alias("adv_rwa_amt"),
        )


@register
def split_credit_risk(t: Tables) -> DataFrame:
    return bucket_totals(C.split_credit_risk(t.rows))


@register
def split_markets_addon(t: Tables) -> DataFrame:
    return bucket_totals(C.split_markets_addon(t.rows))


@register
def split_non_waterfall(t: Tables) -> DataFrame:
    return bucket_totals(C.split_non_waterfall(t.rows))


@register
def exclude_discontinued(t: Tables) -> DataFrame:
    return bucket_totals(C.exclude_discontinued(t.rows))


@register
def drop_unknown_quarter(t: Tables) -> DataFrame:
    known = M.drop_unknown_quarter(t.adjustments)
    return known.select("entity", "quarter_id", "seg_l4_id", "geo_l4_desc", "sa_rwa")


@register
def markets_filter(t: Tables) -> DataFrame:
    pivot = U.markets_filter(U.upload_pivot(M.coerce_before_pivot(t.frm), QUARTERS))
    return pivot.groupBy("entity_code", "seg_l2_desc", "exposure_type", "markets_filter").agg(
        F.count("*").alias("n_rows")
    )


# -- joins ------------------------------------------------------------------


@register
def waterfall_join(t: Tables) -> DataFrame:
    return t.with_factors.select(*LONG, *SEG_IDS, "quarter_id", "balances", *RWF)


@register
def quarter_join(t: Tables) -> DataFrame:
    return t.dated.select(*LONG, "quarter_id", "balances")


@register
def quarter_inverse_join(t: Tables) -> DataFrame:
    dated = O.quarter_inverse_join(M.drop_unknown_quarter(t.adjustments), t.calendar)
    return dated.groupBy("quarter_id", "year", "month").agg(F.count("*").alias("n_rows"))


@register
def geo_enrich(t: Tables) -> DataFrame:
    done = C.geo_enrich(t.convergence.drop("geo_l3_desc"), t.balance_sheet)
    return done.groupBy("geo_l3_desc", "geo_l4_desc").agg(F.count("*").alias("n_rows"), F.sum("gaap_amt").alias("gaap_amt"))


@register
def adjustment_join(t: Tables) -> DataFrame:
    joined = O.adjustment_join(O.outlook_keys(t.dated), t.adjustments)
    return joined.select(*LONG, "quarter_id", "balances", "exposure_type", "sa_rwf", "aa_rwf", "sa_rwf_key2", "aa_rwf_key2")


@register
def pug_join(t: Tables) -> DataFrame:
    return M.pug_join(t.rows, t.pug).groupBy("entity", "seg_l4_desc", "pug").agg(F.count("*").alias("n_rows"))


@register
def pmf_join(t: Tables) -> DataFrame:
    joined = M.pmf_join(C.string_normalise(t.rows), t.pmf)
    return joined.groupBy("entity", "pmf_l5", "sa_account", "aa_account").agg(F.count("*").alias("n_rows"))


@register
def table_diff(t: Tables) -> DataFrame:
    a, b = t.pair
    joined = X.diff_rows(a, b, DIFF_KEY)
    return joined.select(*DIFF_KEY, "m3__a", "m3__b", "presence")


@register
def lateral_unpivot(t: Tables) -> DataFrame:
    return summary.lateral_unpivot(t.balance_sheet)


# -- aggregations -----------------------------------------------------------


@register
def quarterly_sum(t: Tables) -> DataFrame:
    return O.quarterly_sum(O.month_columns(t.balances))


@register
def key_pivots(t: Tables) -> DataFrame:
    return t.pivots


@register
def rwf_ratio(t: Tables) -> DataFrame:
    return C.rwf_ratio(t.pivots).drop("gaap_amt", "sa_rwa_amt", "adv_rwa_amt")


@register
def markets_null_rwf(t: Tables) -> DataFrame:
    return C.factor_table(C.split_credit_risk(t.rows)).drop("gaap_amt", "sa_rwa_amt", "adv_rwa_amt")


@register
def markets_addon_sum(t: Tables) -> DataFrame:
    rows = A.projected_quarter_parse(C.string_normalise(C.split_markets_addon(t.rows)), t.calendar)
    return A.markets_addon_sum(rows)


@register
def addon_sum(t: Tables) -> DataFrame:
    rows = A.projected_quarter_parse(C.string_normalise(C.split_non_waterfall(t.rows)), t.calendar)
    return A.addon_sum(rows)


@register
def addon_sum_sql(t: Tables) -> DataFrame:
    return summary.addon_sum_sql(t.rows)


@register
def control_convergence(t: Tables) -> DataFrame:
    return K.control_convergence(t.rows)


@register
def control_summary(t: Tables) -> DataFrame:
    return K.control_summary(t.rows)


@register
def control_upload(t: Tables) -> DataFrame:
    columns = list(Q.quarter_labels(Q0, N_QUARTERS).values())
    return cents(K.control_upload(t.template, columns), *columns)


@register
def control_raw(t: Tables) -> DataFrame:
    totals = K.control_raw(t.raw)
    return cents(totals, *quarter_columns(totals))


@register
def quarter_counts(t: Tables) -> DataFrame:
    return O.quarter_counts(t.convergence, t.balances)


@register
def quarter_map(t: Tables) -> DataFrame:
    return Q.quarter_map(t.spark, Q0, stages.calendar_size(t.given, Parameters(q0=Q0)))


@register
def duplicate_keys(t: Tables) -> DataFrame:
    return pipeline.mapping_repeats(t.given)


# -- reshape ----------------------------------------------------------------


@register
def melt_balances(t: Tables) -> DataFrame:
    return t.long


@register
def upload_pivot(t: Tables) -> DataFrame:
    pivot = U.upload_pivot(M.coerce_before_pivot(t.frm), QUARTERS)
    return cents(pivot, *[U.quarter_column(q) for q in QUARTERS])


@register
def upload_pivot_sql(t: Tables) -> DataFrame:
    columns = ["rwa_actuals", *[U.quarter_column(q) for q in range(1, N_QUARTERS)]]
    return cents(t.steps["upload_template_pivot"], *columns)


@register
def rwa_long(t: Tables) -> DataFrame:
    return U.rwa_long(t.frm, Q0, N_QUARTERS)


# -- row-level computation --------------------------------------------------


@register
def first_valid_rwf(t: Tables) -> DataFrame:
    final = O.final_factors(t.with_factors)
    return final.select(*LONG, "quarter_id", "final_sa_rwf", "final_aa_rwf")


@register
def sa_rwa(t: Tables) -> DataFrame:
    return t.outlook.select(*LONG, "quarter_id", "balances", "final_sa_rwf", "sa_rwa")


@register
def aa_rwa(t: Tables) -> DataFrame:
    return t.outlook.select(*LONG, "quarter_id", "balances", "final_aa_rwf", "aa_rwa")


@register
def erba_rwa(t: Tables) -> DataFrame:
    return t.outlook.select(*LONG, "quarter_id", "balances", "erba_rwa", "comment")


@register
def outlook_keys(t: Tables) -> DataFrame:
    keyed = O.outlook_keys(t.dated)
    return keyed.select("entity", "key1", "key2", "key3", "key4", "key5", "quarter_id", "balances")


@register
def legacy_layer(t: Tables) -> DataFrame:
    layers = M.legacy_layer(t.balance_sheet)
    return layers.groupBy("reporting_layer", "seg_l3_desc", "seg_l4_desc", "geo_l3_desc").agg(
            F.count("*").alias("n_rows"), F.sum("m3").alias("m3")
        )


@register
def account_derive(t: Tables) -> DataFrame:
    pivot = U.upload_pivot(M.coerce_before_pivot(t.frm), QUARTERS)
    return U.account_derive(pivot).groupBy("entity_code", "rwa_calc", "pmf_l5", "Account").agg(
        F.count("*").alias("n_rows")
    )


@register
def quarter_headers(t: Tables) -> DataFrame:
    pivot = U.quarter_headers(U.upload_pivot(M.coerce_before_pivot(t.frm), QUARTERS), Q0, N_QUARTERS)
    labels = list(Q.quarter_labels(Q0, N_QUARTERS).values())
    totals = pivot.groupBy("entity_code", "rwa_calc").agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in labels])
    return cents(totals, *labels)


@register
def format_upload(t: Tables) -> DataFrame:
    return cents(t.template, *Q.quarter_labels(Q0, N_QUARTERS).values())


@register
def upload_sort(t: Tables) -> DataFrame:
    return cents(U.upload_sort(t.template), *Q.quarter_labels(Q0, N_QUARTERS).values())


@register
def projected_quarter_parse(t: Tables) -> DataFrame:
    parsed = A.projected_quarter_parse(t.rows, t.calendar)
    return parsed.groupBy("entity", "projected_quarter", "year", "month", "quarter_id").agg(
            F.count("*").alias("n_rows"), F.sum("sa_rwa_amt").alias("sa_rwa_amt")
        )


# -- set operations ---------------------------------------------------------


@register
def concat_addon(t: Tables) -> DataFrame:
    buckets = []
    for split in (C.split_markets_addon, C.split_non_waterfall):
        rows = A.projected_quarter_parse(C.string_normalise(split(t.rows)), t.calendar)
        buckets.append(A.addon_sum(rows))
    return A.concat_addon(*buckets)


@register
def frm_concat(t: Tables) -> DataFrame:
    adjustments = M.coerce_adjustments(V.blank_to_null(t.adjustments))
    stacked = M.frm_concat(adjustments, V.blank_to_null(t.outlook), A.rename_addon(V.blank_to_null(t.addon)))
    return stacked.groupBy("entity", "quarter_id", "month", "comment", "exposure_type").agg(
        F.count("*").alias("n_rows"),
        F.count("balances").alias("n_balances"),
        F.count("sa_rwa").alias("n_sa"),
        F.count("sa_rwf_key3").alias("n_sa_rwf_key3"),
    )


@register
def frm_base(t: Tables) -> DataFrame:
    return t.steps["frm_base"]


@register
def entity_union(t: Tables) -> DataFrame:
    whole = t.balance_sheet
    sheets = {e.name: whole.filter(F.col("entity") == e.name).drop("entity") for e in rules.ENTITIES}
    return O.entity_union(sheets)


@register
def distinct_pairs(t: Tables) -> DataFrame:
    return C.distinct_pairs(t.balance_sheet)


@register
def sample_rows(t: Tables) -> DataFrame:
    a, b = t.pair
    joined = X.diff_rows(a, b, DIFF_KEY)
    return X.diff_samples(joined, DIFF_KEY, F.col("presence") == "left_only").select(*DIFF_KEY)


# -- data quality -----------------------------------------------------------


@register
def dq_status(t: Tables) -> DataFrame:
    counts = t.convergence.groupBy("quarter_id", "exposure_type").agg(
        F.count("*").alias("n_total"), F.count(F.when(F.col("seg_l2_desc").isNull(), 1)).alias("n_failing")
    )
    return counts.withColumn("status", D.dq_status(F.col("n_failing"), F.col("n_total"), 1.9))


@register
def dq_row_count(t: Tables) -> DataFrame:
    return D.dq_row_count({"convergence": t.convergence, "balance_sheet": t.balance_sheet})


@register
def dq_required_cols(t: Tables) -> DataFrame:
    checked = D.dq_required_cols(t.convergence, pipeline.REQUIRED, "convergence")
    checked = checked.unionByName(D.dq_required_cols(t.convergence, ["quarter_id", "pmf_l5"], "convergence"))
    return checked.unionByName(D.dq_row_count({"convergence": t.convergence}))


@register
def dq_null_rate(t: Tables) -> DataFrame:
    columns = {"pmf_nulls": "pmf_l5", "l2_nulls": "seg_l2_desc", "type_nulls": "exposure_type", "no_column": "absent"}
    return D.dq_null_rate(t.convergence, columns, "convergence")


@register
def dq_allowed_values(t: Tables) -> DataFrame:
    values = D.allowed_totals(t.convergence, ["is_cg", "geo_l4_desc"])
    good = D.dq_allowed_values(values, "is_cg", ["Y", "N"], "convergence", "flags", "n_rows")
    bad = D.dq_allowed_values(values, "geo_l4_desc", ["NATION_1", "NATION_2"], "convergence", "geo", "n_rows")
    return good.unionByName(bad)


@register
def dq_waterfall(t: Tables) -> DataFrame:
    return D.dq_waterfall(O.final_factors(t.with_factors), len(rules.WATERFALL_KEYS))


@register
def dq_join_match(t: Tables) -> DataFrame:
    return D.dq_join_match(t.frm)


@register
def dq_quarter_coverage(t: Tables) -> DataFrame:
    return D.dq_quarter_coverage(t.frm)


@register
def dq_report(t: Tables) -> DataFrame:
    inputs = t.inputs
    t.stage("outlook", "frm")
    return pipeline.quality_report(inputs, t.convergence, t.outlook, t.frm, PARAMS, RUN_TIMESTAMP)


@register
def dq_export(t: Tables) -> DataFrame:
    folder = staging_path(t.spark, "dq")
    sinks.sink_parquet({"dq_results": dq_report(t)}, folder)
    return t.spark.read.parquet(f"{folder}/dq_results.parquet")


@register
def pug_unmatched(t: Tables) -> DataFrame:
    return pipeline.pug_and_pmf_reports(t.inputs, t.stage("raw").raw)["pug_unmatched"]


@register
def pmf_unmatched(t: Tables) -> DataFrame:
    return pipeline.pug_and_pmf_reports(t.inputs, t.stage("raw").raw)["pmf_unmatched"]


# -- table comparison and profiling -----------------------------------------


@register
def diff_key_normalise(t: Tables) -> DataFrame:
    ids = t.balance_sheet.select(
        F.col("seg_l4_id").cast("double").alias("id"),
        F.concat(F.lit(" "), "geo_l4_desc", F.lit(" ")).alias("geo"),
        F.col("pmf_l5").alias("account"),
    )
    normal = X.diff_key_normalise(ids, ["id", "geo", "account"])
    return normal.groupBy("id", "geo", "account").agg(F.count("*").alias("n_rows"))


@register
def diff_schema(t: Tables) -> DataFrame:
    return X.filled_counts(*t.pair)


@register
def diff_dup_keys(t: Tables) -> DataFrame:
    return X.diff_dup_keys(t.balance_sheet, t.pair[1], DIFF_KEY)


@register
def diff_rows(t: Tables) -> DataFrame:
    return X.presence_counts(X.diff_rows(*t.pair, DIFF_KEY))


@register
def diff_columns(t: Tables) -> DataFrame:
    return X.diff_columns(*t.pair, DIFF_KEY)


@register
def diff_totals(t: Tables) -> DataFrame:
    return X.diff_totals(*t.pair, columns=["m3", "m6"])


@register
def diff_verdict(t: Tables) -> DataFrame:
    a, b = t.pair
    return X.diff_verdict(a, b, DIFF_KEY).withColumn("pair", F.lit("edited")).unionByName(
        X.diff_verdict(a, a, DIFF_KEY).withColumn("pair", F.lit("same"))
    )


@register
def digest_verdict(t: Tables) -> DataFrame:
    a, b = t.pair
    return X.digest_verdict(a, b, DIFF_KEY).withColumn("pair", F.lit("edited")).unionByName(
        X.digest_verdict(a, a, DIFF_KEY).withColumn("pair", F.lit("same"))
    )


@register
def profile_columns(t: Tables) -> DataFrame:
    return P.profile_columns(U.with_headers(t.balance_sheet))


@register
def mapping_log(t: Tables) -> DataFrame:
    return P.mapping_log(t.adjustments)


# -- pipelines --------------------------------------------------------------


@register
def stage1_outlook(t: Tables) -> DataFrame:
    return t.outlook.select(
            *LONG, *SEG_IDS, "quarter_id", "balances", "key1", *RWF, "final_sa_rwf", "final_aa_rwf", "sa_rwa", "aa_rwa",
            "erba_rwa", "comment", "exposure_type",
        )


@register
def stage1_addon(t: Tables) -> DataFrame:
    return t.addon


@register
def stage2_frm(t: Tables) -> DataFrame:
    dims = ["entity_code", "reporting_layer", "seg_l4_desc", "geo_l4_desc", "pmf_l5", "quarter_id", "exposure_type"]
    return t.frm.select(*dims, "comment", "pug", "sa_account", "aa_account", "balances", "sa_rwa", "aa_rwa", "erba_rwa")


@register
def upload_template(t: Tables) -> DataFrame:
    labels = list(Q.quarter_labels(Q0, N_QUARTERS).values())
    dims = ["Entity", "Reporting Layer", "Managed Segment L2 Descr", "RWA Calc", "Account", "Markets Filter"]
    totals = t.template.groupBy(*dims).agg(
        F.count("*").alias("n_rows"), *[F.sum(F.col(f"`{c}`")).alias(c) for c in labels]
    )
    return cents(totals, *labels)


@register
def raw_data(t: Tables) -> DataFrame:
    totals = t.raw.groupBy("entity_code", "seg_l2_desc", "pmf_l5", "quarter_id").agg(
        F.count("*").alias("n_rows"), F.sum("sa_rwa").alias("sa_rwa"), F.sum("aa_rwa").alias("aa_rwa")
    )
    return cents(totals, "sa_rwa", "aa_rwa")


@register
def control_file(t: Tables) -> DataFrame:
    """The three controls side by side in long form."""
    t.stage("raw")
    tables = pipeline.control_file(C.by_entity(t.inputs.convergence), t.template, t.raw, PARAMS, N_QUARTERS)
    labels = Q.quarter_labels(Q0, N_QUARTERS)
    upload = tables["control_upload"].withColumnsRenamed(
        {"Managed Segment L2 Descr": "seg_l2_desc", "RWA Calc": "rwa_calc", "Entity": "entity"}
        | {label: U.quarter_column(q) for q, label in labels.items()}
    )
    parts = {"upload": upload, "convergence": tables["control_convergence"], "raw": tables["control_raw"]}
    out = None
    for name, df in parts.items():
        columns = quarter_columns(df)
        long = (
            df.select("entity", "seg_l2_desc", "rwa_calc", *[F.col(c).cast("double").alias(c) for c in columns])
            .unpivot(["entity", "seg_l2_desc", "rwa_calc"], columns, "quarter", "amount")
            .withColumn("control", F.lit(name))
        )
        out = long if out is None else out.unionByName(long)
    return cents(out, "amount")


@register
def sql_pipeline(t: Tables) -> DataFrame:
    """Rows and filled amounts of every coarse step, from the steps registered as views."""
    catalog.load_tables(t.staged_steps)
    counts = {
        "conv_credit_risk": "sa_rwa_amt",
        "conv_markets_addon": "sa_rwa_amt",
        "conv_non_waterfall": "sa_rwa_amt",
        "waterfall_rwf": "sa_rwf",
        "outlook_long": "balances",
        "outlook_with_keys": "key1",
        "outlook_with_rwf": "final_sa_rwf",
        "projected_rwa": "sa_rwa",
        "addon_pivot": "erba_rwa",
        "frm_base": "sa_rwa",
        "upload_template_pivot": "q1",
        "control_summary": "rwa_amount",
    }
    return t.spark.sql(
        " UNION ALL ".join(
            f"SELECT '{step}' AS step, COUNT(*) AS n_rows, COUNT({column}) AS n_filled FROM {step}"
            for step, column in counts.items()
        )
    )


@register
def projected_rwa_sql(t: Tables) -> DataFrame:
    columns = ["final_sa_rwf", "final_aa_rwf", "sa_rwa", "aa_rwa", "erba_rwa"]
    return t.steps["projected_rwa"].select(*LONG, "quarter_id", "key1", "balances", *columns)


@register
def waterfall_rwf_sql(t: Tables) -> DataFrame:
    return summary.key1_factors(t.rows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Query):
        return lambda spark, sf_dir: query(Tables(spark, sf_dir))

    return {name: bound(query) for name, query in REGISTERED.items()}
