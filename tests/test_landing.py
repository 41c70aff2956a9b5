"""Typing of landed files, lost values and copies that follow their sources."""

import datetime

import pytest

from factorfall.operators import dq as D
from factorfall.schemas import REGISTRY
from factorfall.sources import catalog
from factorfall.sources import inference as I


def texts(spark, **columns):
    names = list(columns)
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


def kinds(schema):
    return {f.name: f.dataType.simpleString() for f in schema.fields}


CASES = {
    "whole": (["1", "-2", " 30 ", None], "bigint"),
    "biggest": (["9223372036854775807", "1", None, ""], "bigint"),
    "too big": (["9223372036854775808", "1", "2", "3"], "string"),
    "decimal": (["1", "2.5", "1e3", "0.30000000000000004"], "double"),
    "long decimal": (["0.123456789012345678", "1.5", None, None], "string"),
    "infinite": (["1e999", "1.5", None, None], "string"),
    "code": (["007", "12", None, None], "string"),
    "date": (["2024-02-29", "2025-01-01", None, "  "], "date"),
    "no date": (["2023-02-29", "2025-01-01", None, None], "string"),
    "time": (["2024-02-29", "2025-01-01 10:30", "2025-01-01T10:30:01.5", None], "timestamp"),
    "flag": (["true", "FALSE", "True", None], "boolean"),
    "number or flag": (["true", "1", None, None], "string"),
    "empty": ([None, "", "  ", None], "string"),
    "a`b.c": (["1", "2", "x", None], "string"),
}


def test_types_by_the_narrowest_that_fits(spark):
    named = {n.replace("`", ""): v for n, (v, _) in CASES.items()}
    df = texts(spark, **named)
    assert kinds(I.infer_types(df, df.columns)) == {n.replace("`", ""): t for n, (_, t) in CASES.items()}


def test_no_rows_and_no_columns(spark):
    df = texts(spark, a=["1"]).filter("a = 'x'")
    assert kinds(I.infer_types(df, ["a"])) == {"a": "string"}
    assert I.infer_types(df, []).fields == []


def test_counts_of_parts_add_up(spark):
    df = texts(spark, a=["1", "2", "3.5", None], b=["true", "false", "x", ""])
    parts = [df.filter("a = '1' or a is null"), df.filter("a in ('2', '3.5')")]
    merged = I.merge_counts(*[I.type_counts(p, ["a", "b"]) for p in parts]).first()
    assert merged == I.type_counts(df, ["a", "b"]).first()
    assert kinds(I.choose(merged.asDict(), ["a", "b"])) == {"a": "double", "b": "string"}


def test_csv_columns_no_schema_names(spark, tmp_path):
    path = str(tmp_path / "pug.csv")
    df = texts(spark, **{"PUG": ["P1", "2"], "as  of": ["2024-01-31", "2024-02-29"], "n": ["1", " 2"], "ok": ["true", " false "]})
    df.write.option("header", True).csv(path)
    read = catalog.scan_csv(spark, path, REGISTRY["pug_mapping"])
    assert kinds(read.schema) == {"PUG": "string", "as of": "date", "n": "bigint", "ok": "boolean"}
    assert sorted(tuple(r) for r in read.collect()) == [
        ("2", datetime.date(2024, 2, 29), 2, False), ("P1", datetime.date(2024, 1, 31), 1, True),
    ]


def sheet(spark, path, years, extra=None):
    columns = {"YEAR": years, "entity": ["CG"] * len(years)}
    texts(spark, **columns, **(extra or {})).write.mode("overwrite").option("header", True).csv(path)


@pytest.fixture
def specs(spark, tmp_path):
    a, b = (catalog.SourceSpec(n, str(tmp_path / f"{n}.csv"), "balance_sheet", f"{n}.parquet") for n in ("a", "b"))
    sheet(spark, a.path, ["2025", "2026"])
    sheet(spark, b.path, ["2025"])
    return [a, b]


def test_year_is_declared_whole():
    assert kinds(REGISTRY["balance_sheet"])["YEAR"] == "bigint"


def test_only_the_changed_source_is_written_again(spark, specs, tmp_path):
    out = str(tmp_path / "copies")
    assert catalog.ingest_to_parquet(spark, specs, out) == {"a": "written", "b": "written"}
    assert catalog.ingest_to_parquet(spark, specs, out) == {"a": "unchanged", "b": "unchanged"}
    before = sorted(p.name for p in (tmp_path / "copies" / "b.parquet").iterdir())
    sheet(spark, specs[0].path, ["2027"])
    assert catalog.ingest_to_parquet(spark, specs, out) == {"a": "written", "b": "unchanged"}
    assert [r["YEAR"] for r in spark.read.parquet(f"{out}/a.parquet").collect()] == [2027]
    assert sorted(p.name for p in (tmp_path / "copies" / "b.parquet").iterdir()) == before
    sheet(spark, specs[1].path, ["2030"])
    assert [r["YEAR"] for r in catalog.scan_fallback(spark, specs[1], out).collect()] == [2030]


def test_a_write_that_stopped_midway_is_done_again(spark, specs, tmp_path, monkeypatch):
    out, spec = str(tmp_path / "copies"), specs[0]
    assert catalog.land(spark, spec, out) == "written"
    sheet(spark, spec.path, ["2028"])

    def stopped(self):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(catalog.LostValues, "counts", stopped)
        with pytest.raises(RuntimeError, match="lost"):
            catalog.land(spark, spec, out)
    assert catalog.lost_values(spark, [spec], out).count() == 0
    assert catalog.land(spark, spec, out) == "written"
    assert catalog.land(spark, spec, out) == "unchanged"


def test_copies_without_manifest_or_source_are_kept(spark, specs, tmp_path):
    out, spec = str(tmp_path / "copies"), specs[0]
    spark.range(1).write.parquet(f"{out}/a.parquet")
    assert catalog.land(spark, spec, out) == "kept"
    catalog.land(spark, specs[1], out)
    gone = catalog.SourceSpec("b", str(tmp_path / "gone.csv"), "balance_sheet", "b.parquet")
    assert catalog.land(spark, gone, out) == "kept"
    nowhere = catalog.SourceSpec("c", str(tmp_path / "gone.csv"), "balance_sheet", "c.parquet")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        catalog.land(spark, nowhere, out)


def test_an_unreadable_copy_is_named(spark, specs, tmp_path):
    broken = tmp_path / "copies" / "a.parquet"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.warns(UserWarning, match="a: no readable copy"):
        assert catalog.scan_fallback(spark, specs[0], str(tmp_path / "copies")).count() == 2


def test_lost_values(spark, tmp_path):
    path, out = str(tmp_path / "s.csv"), str(tmp_path / "copies")
    years = ["2025", "soon", "2025.5", "", "NaN", "2026.0", None, "1e999"]
    sheet(spark, path, years, {"note": ["1", "x", "", "", "", "", "", ""]})
    spec = catalog.SourceSpec("s", path, "balance_sheet", "s.parquet")
    catalog.land(spark, spec, out)
    lost = catalog.lost_values(spark, [spec], out)
    assert [tuple(r) for r in lost.collect()] == [("s", "YEAR", 3, 8)]
    report = D.dq_lost_values(lost).first()
    assert (report["check_name"], report["dataset"], report["status"]) == ("YEAR_lost_values", "s", "FAIL")
    assert (report["n_failing"], report["n_total"], report["detail"]) == (3, 8, "3/8 (37.5%) values of 'YEAR' do not fit its type")


def test_lost_values_of_a_typed_read(spark, tmp_path):
    path = str(tmp_path / "s.parquet")
    texts(spark, YEAR=["1", "x", None]).write.parquet(path)
    lost = catalog.LostValues()
    catalog.scan_typed(spark, path, REGISTRY["balance_sheet"], lost).write.format("noop").mode("overwrite").save()
    assert lost.counts() == (3, {"YEAR": 1})
