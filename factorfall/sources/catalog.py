"""Source datasets by name, and typed reads of them."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorfall.functions.values import blank_to_null
from factorfall.schemas import REGISTRY, canonical, clean_header
from factorfall.session import run_together
from factorfall.sources.inference import filled, infer_types


@dataclass(frozen=True)
class SourceSpec:
    """One dataset: its landed files, its schema and the name of its Parquet copy."""

    label: str
    path: str
    schema_key: str
    output_name: str


def source_catalog(input_dir: str) -> dict[str, SourceSpec]:
    """The datasets of a run, landed as CSV folders or files below ``input_dir``."""

    def spec(label: str, file: str, schema_key: str, output: str) -> SourceSpec:
        return SourceSpec(label, f"{input_dir}/{file}", schema_key, output)

    specs = [
        spec("cg", "outlook_balancesheet_cg.csv", "balance_sheet", "outlook_balancesheet_cg.parquet"),
        spec("cbna", "outlook_balancesheet_cbna.csv", "balance_sheet", "outlook_balancesheet_cbna.parquet"),
        spec("convergence", "aggregator_for_convergence.csv", "convergence", "aggregator_for_convergence.parquet"),
        spec("cg_adjustments", "adjustments_cg.csv", "adjustments", "adjustments_cg.parquet"),
        spec("cbna_adjustments", "adjustments_cbna.csv", "adjustments", "adjustments_cbna.parquet"),
        spec("pug", "pug_mapping.csv", "pug_mapping", "pug_mapping.parquet"),
        spec("pmf", "pmf_rwa_mapping.csv", "pmf_rwa_mapping", "pmf_rwa_mapping.parquet"),
    ]
    return {s.label: s for s in specs}


def _cast(c: Column, wanted: T.DataType, held: T.DataType) -> Column:
    """A column as the wanted type; null where a value does not fit."""
    if wanted != held:
        if isinstance(wanted, T.LongType):
            c = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
        elif isinstance(held, T.StringType) and isinstance(wanted, (T.BooleanType, T.DateType, T.TimestampType)):
            c = F.trim(c).try_cast(wanted)
        else:
            c = c.try_cast(wanted)
    return F.when(~F.isnan(c), c) if isinstance(wanted, T.DoubleType) else c


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared and present columns to their types; a value that does not fit becomes null.

    Other columns pass through. Headers lose doubled blanks first, so a
    declared name matches however the file spaces it.
    """
    types = {f.name: f.dataType for f in schema.fields}
    columns = []
    for field in df.schema.fields:
        name, c = clean_header(field.name), F.col(f"`{field.name}`")
        if name in types:
            c = _cast(c, types[name], field.dataType)
        columns.append(c.alias(name))
    return df.select(*columns)


def undeclared(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns no schema names, as the table spells them."""
    declared = set(schema.fieldNames())
    return [c for c in df.columns if clean_header(c) not in declared]


def with_inferred(df: DataFrame, schema: T.StructType) -> T.StructType:
    """The schema and, for text columns it does not name, the types their values show."""
    extra = [c for c in undeclared(df, schema) if isinstance(df.schema[c].dataType, T.StringType)]
    found = [T.StructField(clean_header(f.name), f.dataType) for f in infer_types(df, extra).fields]
    return T.StructType([*schema.fields, *found])


class LostValues:
    """Counts the values that casts lose, while some other job reads the table.

    A value is lost when it is filled, is not the text NaN and becomes null,
    or becomes a whole number without its fraction. Let a write of the
    observed table carry the counts: each task of a write counts once, however
    often it is tried, and a stage before a shuffle may count again what it
    has to redo.
    """

    def __init__(self) -> None:
        self._observation = Observation()
        self._names: list[str] = []

    def watch(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """The same rows; the counts are there once an action has read them all."""
        types = {f.name: f.dataType for f in schema.fields}
        counts = [F.count(F.lit(1)).alias("n_rows")]
        for field in df.schema.fields:
            name, held = clean_header(field.name), field.dataType
            if name not in types or types[name] == held:
                continue
            c = F.col(f"`{field.name}`")
            cast = _cast(c, types[name], held)
            lost = cast.isNull()
            if isinstance(types[name], T.LongType):
                lost = lost | (c.try_cast("double") != cast.cast("double"))
            as_text = c.cast("string")
            given = filled(as_text) & (F.lower(F.trim(as_text)) != "nan")
            counts.append(F.count(F.when(given & lost, 1)).alias(f"c{len(self._names)}"))
            self._names.append(name)
        return df.observe(self._observation, *counts)

    def counts(self) -> tuple[int, dict[str, int]]:
        """Rows read, and lost values per converted column; waits for the action."""
        found = self._observation.get
        return found["n_rows"], {name: found[f"c{i}"] for i, name in enumerate(self._names)}


def to_canonical(df: DataFrame) -> DataFrame:
    """Business headers to canonical names."""
    return df.select(*[F.col(f"`{c}`").alias(canonical(c)) for c in df.columns])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, lost: LostValues | None = None) -> DataFrame:
    """CSV with a header: all text first, then the declared types.

    Columns the schema does not name get the type their values show, from one
    further pass over those columns alone; a schema that names every column
    costs none.
    """
    raw = spark.read.option("header", True).csv(path)
    full = with_inferred(raw, schema)
    return cast_to_schema(lost.watch(raw, full) if lost else raw, full)


def scan_typed(spark: SparkSession, path: str, schema: T.StructType, lost: LostValues | None = None) -> DataFrame:
    """Parquet with the declared types; columns no schema names keep the file's."""
    raw = spark.read.parquet(path)
    return cast_to_schema(lost.watch(raw, schema) if lost else raw, schema)


# -- landing ----------------------------------------------------------------

MANIFEST = (
    "label string, output_name string, fingerprint string, state string, written_at timestamp, n_rows bigint, "
    "n_lost map<string,bigint>"
)
STARTED, DONE = "started", "done"


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether anything matches a path, on whichever file system it names.

    Asked beforehand, as a read that fails is reported by every listener of the session.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern))


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """Names, sizes and times of a source's files as one text; null when there is no source.

    The listing is Spark's own, so any file system it reads will do; contents
    are not read.
    """
    if not _exists(spark, path):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    row = files.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("size"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("mark"),
    ).first()
    return f"{row['n']} files, {row['size']} bytes, {(row['mark'] or 0) & (1 << 64) - 1:016x}"


def _manifest_path(output_dir: str, spec: SourceSpec) -> str:
    return f"{output_dir}/{spec.output_name}.manifest"


def _last_entry(spark: SparkSession, path: str) -> dict | None:
    if not _exists(spark, path):
        return None
    entries = spark.read.schema(MANIFEST).parquet(path)
    last = entries.agg(F.max_by(F.struct("*"), "written_at").alias("e")).first()["e"]
    return last.asDict() if last else None


def _readable(spark: SparkSession, path: str) -> bool:
    """Whether a copy is there with at least one file of a schema; reads no rows."""
    if not _exists(spark, path):
        return False
    try:
        spark.read.parquet(path)
    except (PySparkException, Py4JJavaError):
        return False
    return True


def land(spark: SparkSession, spec: SourceSpec, output_dir: str, registry: dict | None = None) -> str:
    """Bring one Parquet copy up to date and say what was done.

    ``written``: there was no copy, its source changed, or an earlier run
    stopped while it wrote. ``unchanged``: the manifest names the source's
    fingerprint. ``kept``: a copy without a manifest is not ours to replace,
    and a copy whose source is gone is all there is.

    The manifest gets an entry before a write starts and one after it ended,
    each a file of its own, so that a run lost midway leaves a started write
    behind, which the next run does again.
    """
    path, manifest = f"{output_dir}/{spec.output_name}", _manifest_path(output_dir, spec)
    mark, last = fingerprint(spark, spec.path), _last_entry(spark, manifest)
    if (last is None or mark is None) and _exists(spark, path):
        return "kept"
    if last and mark and last["state"] == DONE and last["fingerprint"] == mark and _readable(spark, path):
        return "unchanged"

    def note(state: str, n_rows: int | None = None, n_lost: dict | None = None) -> None:
        entry = (spec.label, spec.output_name, mark, state, datetime.now(), n_rows, n_lost)
        spark.createDataFrame([entry], MANIFEST).coalesce(1).write.mode("append").parquet(manifest)

    lost = LostValues()
    typed = scan_csv(spark, spec.path, (registry or REGISTRY)[spec.schema_key], lost)
    note(STARTED)
    typed.write.mode("overwrite").option("compression", "zstd").parquet(path)
    note(DONE, *lost.counts())
    return "written"


def ingest_to_parquet(
    spark: SparkSession, specs: list[SourceSpec], output_dir: str, registry: dict | None = None
) -> dict[str, str]:
    """Landed files to typed zstd Parquet, side by side; only what changed is written again.

    Returns what ``land`` did with each dataset.
    """
    done = run_together(spark, [lambda s=s: land(spark, s, output_dir, registry) for s in specs])
    return {s.label: d for s, d in zip(specs, done)}


def lost_values(spark: SparkSession, specs: list[SourceSpec], output_dir: str) -> DataFrame:
    """Rows and lost values per dataset and converted column, as counted when the copies were written."""
    out = spark.createDataFrame([], "dataset string, column_name string, n_lost bigint, n_rows bigint")
    for spec in specs:
        last = _last_entry(spark, _manifest_path(output_dir, spec))
        if last and last["state"] == DONE:
            rows = [(spec.label, c, n, last["n_rows"]) for c, n in last["n_lost"].items()]
            out = out.unionByName(spark.createDataFrame(rows, out.schema))
    return out


def scan_fallback(
    spark: SparkSession, spec: SourceSpec, parquet_dir: str, blank_is_null: bool = True, registry: dict | None = None
) -> DataFrame:
    """The Parquet copy, brought up to date first; the landed file when the copy is unreadable.

    Blank text becomes null unless the first stage reads it, which keeps it.
    """
    schema = (registry or REGISTRY)[spec.schema_key]
    try:
        land(spark, spec, parquet_dir, registry)
        df = scan_typed(spark, f"{parquet_dir}/{spec.output_name}", schema)
    except (PySparkException, Py4JJavaError) as error:
        warnings.warn(f"{spec.label}: no readable copy, the landed file is read instead: {str(error).splitlines()[0]}", stacklevel=2)
        df = scan_csv(spark, spec.path, schema)
    return blank_to_null(df) if blank_is_null else df


def load_tables(tables: dict[str, DataFrame]) -> None:
    """Register each table as a view under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
