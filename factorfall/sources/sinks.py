"""Writers: Parquet tables and database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorfall import rules
from factorfall.operators.profile import mapping_log
from factorfall.session import run_together


def sink_parquet(outputs: dict[str, DataFrame], folder: str, partition_by: str | None = None) -> None:
    """Each named table to zstd Parquet, replacing an earlier run's; tables are written side by side."""

    def write(name: str, df: DataFrame) -> None:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by and partition_by in df.columns:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{folder}/{name}.parquet")

    if outputs:
        spark = next(iter(outputs.values())).sparkSession
        run_together(spark, [lambda n=n, d=d: write(n, d) for n, d in outputs.items()])


def sink_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def jdbc_options(df: DataFrame, url: str, table: str) -> tuple[DataFrame, dict[str, str]]:
    """The table under its target column names, with the writer options for it."""
    rows = mapping_log(df).collect()
    renamed = df.select(*[F.col(f"`{r['original']}`").alias(r["target_name"]) for r in rows])
    types = ", ".join(f"{r['target_name']} {r['target_type']}" for r in rows if r["dtype"] == "string")
    options = {"url": url, "dbtable": table, "batchsize": str(rules.INSERT_BATCH)}
    if types:
        # Spark parses this option with its own type names.
        options["createTableColumnTypes"] = types.replace("VARCHAR2(", "VARCHAR(")
    return renamed, options


def sink_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Create the table if missing and append in batches; nulls stay null."""
    renamed, options = jdbc_options(df, url, table)
    renamed.write.format("jdbc").options(**options, **(properties or {})).mode("append").save()


def load_tables_jdbc(
    spark: SparkSession, tables: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Write every table to the database and return each as read back from it."""
    options = properties or {}
    for name, df in tables.items():
        sink_jdbc(df, url, name.upper(), options)
    return {
        name: spark.read.format("jdbc").options(url=url, dbtable=name.upper(), **options).load() for name in tables
    }
