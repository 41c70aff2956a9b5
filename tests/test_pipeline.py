import pytest
from pyspark.sql import functions as F

from factorfall import rules, session
from factorfall.plans import config, pipeline
from factorfall.plans import stages as S
from factorfall.schemas import REGISTRY, canonical, load_registry, output_header
from factorfall.sources import catalog, sinks
from tests.test_stage1 import LOANS


def test_canonical_names():
    assert canonical("Managed Segment L4  Id") == "seg_l4_id"
    assert canonical("Managed Geography L2  Id") == "managed_geography_l2_id"
    assert output_header("sa_rwf_key2") == "SA RWF_key2"
    assert output_header("key3") == "Key3"
    assert len(REGISTRY["balance_sheet"].fields) == 48
    assert len(REGISTRY["convergence"].fields) == 29


def test_load_registry(spark, tmp_path):
    (tmp_path / "registry.csv").write_text("schema_key,column_name,type\na,Managed  Id,Int64\na,Amount,Float64\nb,Text,Utf8\n")
    registry = load_registry(spark, str(tmp_path / "registry.csv"))
    assert registry["a"].simpleString() == "struct<Managed Id:bigint,Amount:double>"
    assert registry["b"].simpleString() == "struct<Text:string>"


def test_typed_scans(spark, tmp_path, rows):
    path = str(tmp_path / "sheet.csv")
    text = spark.createDataFrame([("2025", "4.0", "1.5", "kept"), ("x", "7", "NaN", None)], "YEAR string, `Managed Segment L4  Id` string, M3_USDOLLAR string, extra string")
    text.write.option("header", True).csv(path)
    schema = REGISTRY["balance_sheet"]
    expected = [(None, 7, None, None), (2025, 4, 1.5, "kept")]
    columns = ["YEAR", "Managed Segment L4 Id", "M3_USDOLLAR", "extra"]
    assert rows(catalog.scan_csv(spark, path, schema), *columns) == expected
    text.write.parquet(str(tmp_path / "sheet.parquet"))
    assert rows(catalog.scan_typed(spark, str(tmp_path / "sheet.parquet"), schema), *columns) == expected


def test_fallback_builds_then_reads_then_falls_back(spark, tmp_path, rows):
    landed = str(tmp_path / "pug.csv")
    spark.createDataFrame([("s4", "P"), ("s5", "")], "`Managed Segment L4 Descr` string, PUG string").write.option("header", True).csv(landed)
    spec = catalog.SourceSpec("pug", landed, "pug_mapping", "pug.parquet")
    expected = [("s4", "P"), ("s5", None)]
    assert rows(catalog.scan_fallback(spark, spec, str(tmp_path / "built"))) == expected
    assert (tmp_path / "built" / "pug.parquet").exists()
    # An existing copy wins and is not rebuilt.
    spark.createDataFrame([("kept", "K")], "`Managed Segment L4 Descr` string, PUG string").write.parquet(str(tmp_path / "old" / "pug.parquet"))
    catalog.ingest_to_parquet(spark, [spec], str(tmp_path / "old"))
    assert rows(catalog.scan_fallback(spark, spec, str(tmp_path / "old"))) == [("kept", "K")]
    broken = tmp_path / "broken" / "pug.parquet"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    assert rows(catalog.scan_fallback(spark, spec, str(tmp_path / "broken"))) == expected


def test_load_tables(spark):
    catalog.load_tables({"numbers_view": spark.range(3)})
    assert spark.sql("SELECT sum(id) FROM numbers_view").first()[0] == 3


def test_jdbc_options(spark):
    df = spark.createDataFrame([("abc", 1.0)], "`SA Account #` string, `GAAP Amount` double")
    renamed, options = sinks.jdbc_options(df, "jdbc:none", "T")
    assert renamed.columns == ["SA_ACCOUNT__", "GAAP_AMOUNT"]
    assert options == {
        "url": "jdbc:none", "dbtable": "T", "batchsize": "1000", "createTableColumnTypes": "SA_ACCOUNT__ VARCHAR(13)",
    }


def test_config():
    fields = [
        {"convergence_col": "Managed Segment Level 4 Code", "outlook_col": "Managed Segment L4 Id", "int_str": True},
        {"convergence_col": "Managed Segment Level 2 Description", "pivot_only": True},
    ]
    params = config.parameters({"Q0": "Jun 2026", "waterfall_keys": [{"fields": fields}], "dedupe": True})
    assert params.q0 == "Jun 2026" and params.dedupe
    assert params.keys == ((rules.KeyField("seg_l4_code", "seg_l4_id", True), rules.KeyField("seg_l2_desc")),)
    assert config.parameters({}).keys == rules.WATERFALL_KEYS


def test_staging_uses_the_shared_folder(spark, rows):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = session.stage_table(spark.range(5), "five")
    assert staged.inputFiles()[0].startswith(f"file:{folder}") or staged.inputFiles()[0].startswith(f"file://{folder}")
    assert staged.count() == 5


def landed_inputs(spark, folder):
    """A small run under business headers, as text files."""
    segments = [
        ("Banking [L2]", 2000, "Corporate [L3]", 3000, "Lending [L4]", 4000),
        ("Markets [L2]", 2001, "Rates [L3]", 3001, "Swaps [L4]", 4001),
        ("All Other [L2]", 2002, "Legacy Franchises [L3]", 3002, "Legacy Holdings Assets [L4]", 4002),
    ]
    accounts = [LOANS, "Trading Account Assets (L2)", "Other Liabilities (L2)"]
    geos = [("US", "NAM"), ("Mexico", "Latin America")]
    sheet, history, adjustments = [], [], []
    n = 0
    for l2, l2id, l3, l3id, l4, l4id in segments:
        for account in accounts:
            for g4, g3 in geos:
                n += 1
                sheet.append((2025, l4, l3, l2, g4, g3, account, l4id, l3id, l2id, 100.0 * n, 110.0 * n, 120.0 * n, None))
                for q in range(4):
                    history.append((f"{q + 1}Q25", q, l2, l2id, l3, l3id, l4, l4id, g4, g3, account, "Y", "Y" if n % 2 else "N", "Direct", 100.0, 10.0 * n, 5.0 * n, 4.0 * n))
    adjustments.append((2025, "Lending [L4]", "Corporate [L3]", "Banking [L2]", "US", "NAM", LOANS, 4000, 3000, 2000, "Mar", "12.5", "3", 7.0, 8.0, None, "", "Overlay", "0.5", None))
    adjustments.append((2025, "Lending [L4]", "Corporate [L3]", "Banking [L2]", "US", "NAM", LOANS, 4000, 3000, 2000, "Mar", "n/a", "Unknown", 7.0, 8.0, None, "", "Overlay", None, None))
    # An unparseable quarter; the mappings lack a segment and repeat a key.
    history.append(("9Q99", 0, "Markets [L2]", 2001, "Rates [L3]", 3001, "Swaps [L4]", 4001, "US", "NAM", accounts[2], "Y", "Y", "Direct", 1.0, 1.0, 1.0, 1.0))
    headers = {
        "balance": ["YEAR", "Managed Segment L4 Descr", "Managed Segment L3 Descr", "Managed Segment L2 Descr", "Managed Geography L4 Descr", "Managed Geography L3 Descr", "PMF Account L5 Descr", "Managed Segment L4 Id", "Managed Segment L3  Id", "Managed Segment L2 Id", "M3_USDOLLAR", "M6_USDOLLAR", "M9_USDOLLAR", "M12_USDOLLAR"],
        "history": ["Projected Quarter", "Quarter Id", "Managed Segment Level 2 Description", "Managed Segment Level 2 Code", "Managed Segment Level 3 Description", "Managed Segment Level 3 Code", "Managed Segment Level 4 Description", "Managed Segment Level 4 Code", "Managed Geography Level 4 Description", "Managed Geography Level 3 Description", "Finance PMF Level 5 Description", "Reportable Entity is CG", "Reportable Entity is CBNA", "RWA Exposure Type Description", "GAAP Amount", "SA RWA Amount", "Adv. CG Total RWA Amount with 1.06 Multiplier", "Adv. CBNA Total RWA Amount with 1.06 Multiplier"],
        "adjustments": [f.name for f in REGISTRY["adjustments"].fields],
    }

    def write(name, data, header):
        text = [tuple(None if v is None else str(v) for v in row) for row in data]
        fields = ", ".join(f"`{h}` string" for h in header)
        spark.createDataFrame(text, fields).coalesce(1).write.option("header", True).csv(f"{folder}/{name}")

    for entity in ("cg", "cbna"):
        write(f"outlook_balancesheet_{entity}.csv", sheet, headers["balance"])
        write(f"adjustments_{entity}.csv", adjustments, headers["adjustments"])
    write("aggregator_for_convergence.csv", history, headers["history"])
    write("pug_mapping.csv", [("Lending [L4]", "CL"), ("Swaps [L4]", "MKT")], ["Managed Segment L4 Descr", "PUG"])
    write("pmf_rwa_mapping.csv", [(LOANS, "SA-1", "AA-1"), ("Other (L2)", "SA-2", "AA-2"), ("Other (L2)", "SA-3", "AA-3")], ["PMF L5", "SA Account #", "AA Account #"])


def test_end_to_end(spark, tmp_path, rows):
    landed_inputs(spark, tmp_path / "input")
    inputs = pipeline.read_inputs(spark, str(tmp_path / "input"), str(tmp_path / "parquet"))
    paths = pipeline.run_pipeline(spark, inputs, config.Parameters(), str(tmp_path / "out"), "now")
    out = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert all(df.count() > 0 for name, df in out.items())
    assert rows(out["bad_quarters"]) == [("9Q99", 2)]
    assert rows(out["mapping_repeats"]) == [("pmf", "Other (L2)", 2)]
    matches = {r["entity"]: r for r in out["mapping_matches"].collect()}
    assert not matches["CG"]["expanded"] and matches["CG"]["n_without_pug"] > 0 and matches["CG"]["n_without_account"] > 0
    assert not out["quarter_counts"].first()["agree"] or out["quarter_counts"].first()["max_quarters"] == 4
    assert "SA RWA" in out["addon"].columns

    template = out["upload_template"]
    assert len(template.columns) == 31 and template.columns[24:28] == ["RWA Actuals", "Jun 2025", "Sep 2025", "Dec 2025"]
    assert rows(template.select("Entity").distinct()) == [("BA",), ("BB",)]
    layers = {r[0] for r in template.select("Reporting Layer").distinct().collect()}
    assert layers == {"Legacy Holdings", "Legacy - Latin America", "Non Legacy"}

    # Upload totals equal the totals of the long table and of the raw rows.
    quarters = ["RWA Actuals", "Jun 2025", "Sep 2025", "Dec 2025"]
    for calc, column in (("SA", "SA RWA"), ("AA", "AA RWA"), ("ERBA", "ERBA RWA")):
        cells = template.filter(F.col("RWA Calc") == calc).agg(*[F.sum(f"`{q}`") for q in quarters]).first()
        long = out["rwa_long"].filter(F.col("RWA Calc") == calc).agg(F.sum("`RWA Amount`")).first()[0] or 0.0
        raw = out["raw_data"].agg(F.sum(f"`{column}`")).first()[0] or 0.0
        assert sum(cells) == pytest.approx(long) == pytest.approx(raw)

    # One factor by hand: lending loans in the US, first row, quarter 1: 110 * (10 / 100).
    first = out["outlook"].filter(
        "entity = 'CG' AND `Managed Segment L4 Id` = 4000 AND `Quarter Id` = 1 AND `Managed Geography L4 Descr` = 'US'"
    ).filter(F.col("PMF Account L5 Descr") == LOANS)
    assert rows(first, "Balances", "SA RWF", "SA RWA", "AA RWA") == [(110.0, 0.1, 11.0, 5.5)]
    # The adjustment of quarter 3 attaches its exposure type to its outlook row.
    assert out["outlook"].filter("`RWA Exposure Type` = 'Overlay'").count() == 2
    statuses = {(r["dataset"], r["check_name"]): r["status"] for r in out["dq_results"].collect()}
    assert statuses["convergence", "required_columns"] == "FAIL"
    assert statuses["cg_frm_output", "pug_join_match_rate"] == "FAIL"
    assert statuses["cg_frm_output", "quarter_coverage"] == "FAIL"
    assert {r["Parameter"]: r["Value"] for r in out["parameters"].collect()}["n_quarters"] == "4"


def test_totals_give_the_same_run_as_rows(spark, tmp_path, rows):
    landed_inputs(spark, tmp_path / "input")
    inputs = pipeline.read_inputs(spark, str(tmp_path / "input"), str(tmp_path / "parquet"))
    params = config.Parameters(n_quarters=4)
    reduced = S.prepared(inputs)
    dims = ["entity", "quarter_id", "seg_l4_desc", "geo_l4_desc", "pmf_l5", "sa_rwa", "aa_rwa", "erba_rwa", "pug", "sa_account"]
    on_rows, on_totals = (S.frm_chain(i, params, 4) for i in (inputs, reduced))
    assert rows(on_totals, *dims) == rows(on_rows, *dims)
