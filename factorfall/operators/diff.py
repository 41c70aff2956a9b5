"""Keyed comparison of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorfall import rules
from factorfall.session import stage_table


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _is_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def diff_key_detect(a: Sequence[str], b: Sequence[str], key: Sequence[str] | None = None) -> list[str]:
    """The given key, or the first known one that both tables have."""
    if key:
        missing = [c for c in key if c not in a or c not in b]
        if missing:
            raise ValueError(f"key columns missing on a side: {missing}")
        return list(key)
    for known in rules.DIFF_KEYS:
        if all(c in a and c in b for c in known):
            return list(known)
    raise ValueError("no known key in both tables; name one")


def diff_key_normalise(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key columns as trimmed text, whole numbers without decimals (4.0 reads '4')."""
    out = {}
    for column in key:
        c = _c(column)
        if _is_number(df, column):
            as_whole = c.try_cast("bigint")
            plain = F.when(as_whole.cast("double") == c.cast("double"), as_whole.cast("string"))
            out[column] = F.coalesce(plain, c.cast("string"), F.lit(""))
        else:
            out[column] = F.coalesce(F.trim(c.cast("string")), F.lit(rules.NULL_TEXT))
    return df.withColumns(out)


def diff_schema(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every column and the side it is on: 'both', 'A' or 'B'."""
    rows = [(c, "both" if c in b.columns else "A") for c in a.columns]
    rows += [(c, "B") for c in b.columns if c not in a.columns]
    return a.sparkSession.createDataFrame(rows, "column_name string, side string")


def filled_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every column with its side and how many values each side holds."""
    sides = {"a": a, "b": b}
    listed = diff_schema(a, b)
    for tag, df in sides.items():
        counts = df.agg(*[F.count(_c(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
        parts = [x for i, c in enumerate(df.columns) for x in (F.lit(c), F.col(f"n{i}"))]
        long = counts.select(F.stack(F.lit(len(df.columns)), *parts).alias("column_name", f"n_filled_{tag}"))
        listed = listed.join(long, "column_name", "left")
    return listed


def diff_dup_keys(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key, per side."""
    out = None
    for side, df in (("A", a), ("B", b)):
        per_key = diff_key_normalise(df, key).groupBy(*[_c(k) for k in key]).agg(F.count("*").alias("__n"))
        extra = per_key.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))
        row = extra.select(F.lit(side).alias("side"), "duplicate_rows")
        out = row if out is None else out.unionByName(row)
    return out


def _refuse_repeated(extra_a: int, extra_b: int, key: Sequence[str]) -> None:
    """Refuse a key that does not identify rows; null keys count as one key, so at most one row may have it."""
    if extra_a or extra_b:
        raise ValueError(f"key {list(key)} is not unique: duplicate rows {{'A': {extra_a}, 'B': {extra_b}}}")


def paired_rows(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Both tables grouped by key at once: rows of each side as ``__n_a`` / ``__n_b``, values and a presence tag.

    One shuffle of both tables tells which keys repeat and which rows belong
    together. A key that repeats, null ones included, is one row per task
    before the shuffle, where a join would meet all its rows with all. The
    values of such a key are those of any of its rows.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        values = [
            (_c(f.name).cast("string") if isinstance(f.dataType, T.NullType) else _c(f.name)).alias(f.name)
            for f in df.schema.fields
            if f.name not in key
        ]
        row = F.struct(F.lit(True).alias("__present"), *values)
        return diff_key_normalise(df, key).select(*[_c(k) for k in key], row.alias(f"__{tag}"))

    both = side(a, "a").unionByName(side(b, "b"), allowMissingColumns=True)
    grouped = both.groupBy(*[_c(k) for k in key]).agg(
        *[F.count(f"__{tag}").alias(f"__n_{tag}") for tag in "ab"],
        *[F.first(f"__{tag}", ignorenulls=True).alias(f"__{tag}") for tag in "ab"],
    )
    values = [
        F.col(f"__{tag}").getField(c).alias(f"{c}__{tag}") for tag, df in (("a", a), ("b", b)) for c in df.columns if c not in key
    ]
    in_a, in_b = F.col("__n_a") > 0, F.col("__n_b") > 0
    presence = F.when(in_a & in_b, "both").when(in_a, "left_only").otherwise("right_only")
    return grouped.select(*[_c(k) for k in key], *values, presence.alias("presence"), "__n_a", "__n_b")


def _extra_rows(paired: DataFrame) -> list[Column]:
    """Rows beyond the first of each key, per side."""
    return [
        F.coalesce(F.sum(F.greatest(F.col(f"__n_{tag}") - 1, F.lit(0))), F.lit(0)).alias(f"__extra_{tag}") for tag in "ab"
    ]


def diff_rows(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every key of either table: value columns as '<name>__a' / '<name>__b' and a presence tag.

    The key has to identify rows on both sides; the staged pairs are checked
    for that before they are returned.
    """
    paired = stage_table(paired_rows(a, b, key), "diff")
    extra = paired.agg(*_extra_rows(paired)).first()
    _refuse_repeated(extra["__extra_a"], extra["__extra_b"], key)
    return paired.drop("__n_a", "__n_b")


PRESENCE = ("both", "left_only", "right_only")


def presence_counts(joined: DataFrame) -> DataFrame:
    return joined.agg(*[F.count(F.when(F.col("presence") == t, 1)).alias(t) for t in PRESENCE])


def values_equal(a: Column, b: Column, numeric: bool, atol: float, rtol: float) -> Column:
    """Numbers within tolerance, or text equal; null equals null, and for text also blank."""
    if numeric:
        x, y = a.cast("double"), b.cast("double")
        close = F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y)
        same = x.eqNullSafe(y) | close
    else:
        x, y = a.cast("string"), b.cast("string")
        blank = (F.coalesce(F.trim(x), F.lit("")) == "") & (F.coalesce(F.trim(y), F.lit("")) == "")
        same = (x == y) | blank
    return F.coalesce(same, F.lit(False))


def _compared(a: DataFrame, b: DataFrame, key: Sequence[str]) -> dict[str, bool]:
    """Shared value columns, and whether both sides are numbers."""
    return {c: _is_number(a, c) and _is_number(b, c) for c in a.columns if c in b.columns and c not in key}


def diff_counts(joined: DataFrame, compared: dict[str, bool], atol: float, rtol: float) -> DataFrame:
    """One row from one pass: rows by side, and per column its unequal rows and both totals.

    With unique keys the pairs hold every row of each side once, so the
    totals are those of the full tables.
    """
    matched = F.col("presence") == "both"
    aggregates = [F.count(F.when(F.col("presence") == t, 1)).alias(t) for t in PRESENCE]
    for i, (c, numeric) in enumerate(compared.items()):
        x, y = _c(f"{c}__a"), _c(f"{c}__b")
        aggregates.append(F.count(F.when(matched & ~values_equal(x, y, numeric, atol, rtol), 1)).alias(f"d{i}"))
        if numeric:
            aggregates += [
                F.coalesce(F.sum(v), F.lit(0)).cast("double").alias(f"{s}{i}") for s, v in (("a", x), ("b", y))
            ]
    if "__n_a" in joined.columns:
        aggregates += _extra_rows(joined)
    return joined.agg(*aggregates)


def checked_counts(
    a: DataFrame, b: DataFrame, key: Sequence[str], compared: dict[str, bool], atol: float, rtol: float
) -> DataFrame:
    """The counts of two tables, from one grouping of both; refuses a key that does not identify rows."""
    counts = diff_counts(paired_rows(a, b, key), compared, atol, rtol)
    row = counts.first()
    _refuse_repeated(row["__extra_a"], row["__extra_b"], key)
    return counts.sparkSession.createDataFrame([row], counts.schema).drop("__extra_a", "__extra_b")


def column_report(counts: DataFrame, compared: dict[str, bool]) -> DataFrame:
    """Counts to one row per column."""
    rows = []
    for i, (c, numeric) in enumerate(compared.items()):
        totals = (F.col(f"a{i}"), F.col(f"b{i}")) if numeric else (F.lit(None).cast("double"),) * 2
        rows += [F.lit(c), F.col(f"d{i}"), *totals]
    if not rows:
        empty = "column_name string, n_diffs bigint, sum_a double, sum_b double, delta double, status string"
        return counts.sparkSession.createDataFrame([], empty)
    listed = counts.select(F.stack(F.lit(len(compared)), *rows).alias("column_name", "n_diffs", "sum_a", "sum_b"))
    return listed.withColumns(
        {
            "delta": F.col("sum_b") - F.col("sum_a"),
            "status": F.when(F.col("n_diffs") == 0, "PASS").otherwise("FAIL"),
        }
    )


def verdict(counts: DataFrame, compared: dict[str, bool], same_schema: bool, atol: float, rtol: float) -> DataFrame:
    """Counts to the verdict row."""

    def how_many(conditions: list[Column]) -> Column:
        total = F.lit(0).cast("bigint")
        for condition in conditions:
            total = total + condition.cast("bigint")
        return total

    failed = how_many([F.col(f"d{i}") > 0 for i in range(len(compared))])
    off = how_many(
        [
            ~values_equal(F.col(f"a{i}"), F.col(f"b{i}"), True, atol, rtol)
            for i, numeric in enumerate(compared.values())
            if numeric
        ]
    )
    rows_equal = (F.col("left_only") == 0) & (F.col("right_only") == 0)
    return counts.select(
        *PRESENCE,
        failed.alias("failed_columns"),
        off.alias("failed_totals"),
        F.lit(same_schema).alias("same_schema"),
        (F.lit(same_schema) & rows_equal & (failed == 0) & (off == 0)).alias("invariant"),
    )


def diff_columns(
    a: DataFrame,
    b: DataFrame,
    key: Sequence[str],
    atol: float = rules.DIFF_ATOL,
    rtol: float = rules.DIFF_RTOL,
) -> DataFrame:
    """Per shared column: unequal matched rows, and the totals of both sides for numbers."""
    compared = _compared(a, b, key)
    return column_report(checked_counts(a, b, key, compared, atol, rtol), compared)


def diff_totals(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Totals of each shared number column over the full tables, without matching rows."""
    shared = [c for c in a.columns if c in b.columns and _is_number(a, c) and _is_number(b, c)]
    if columns is not None:
        shared = [c for c in shared if c in columns]

    def side(df: DataFrame, tag: str) -> DataFrame:
        sums = df.agg(*[F.coalesce(F.sum(_c(c)), F.lit(0)).cast("double").alias(f"s{i}") for i, c in enumerate(shared)])
        parts = []
        for i, c in enumerate(shared):
            parts += [F.lit(c), F.col(f"s{i}")]
        return sums.select(F.stack(F.lit(len(shared)), *parts).alias("column_name", f"sum_{tag}"))

    both = side(a, "a").join(side(b, "b"), "column_name")
    return both.withColumn("delta", F.col("sum_b") - F.col("sum_a"))


def diff_samples(joined: DataFrame, key: Sequence[str], condition: Column, n: int = rules.DIFF_SAMPLES) -> DataFrame:
    """A few differing rows for a reader, smallest keys first."""
    return joined.filter(condition).orderBy(*[_c(k) for k in key]).limit(n)


def diff_verdict(
    a: DataFrame,
    b: DataFrame,
    key: Sequence[str],
    atol: float = rules.DIFF_ATOL,
    rtol: float = rules.DIFF_RTOL,
) -> DataFrame:
    """One row: row counts by side, failing columns and totals, schema match, and the verdict."""
    compared = _compared(a, b, key)
    counts = checked_counts(a, b, key, compared, atol, rtol)
    return verdict(counts, compared, set(a.columns) == set(b.columns), atol, rtol)


# -- comparison by digests --------------------------------------------------


def bucket_digests(df: DataFrame, key: Sequence[str], compared: dict[str, bool], buckets: int) -> DataFrame:
    """One row per bucket of keys: its rows, a digest of them that no order changes, and its totals.

    A row's digest covers its key and compared values, with blank text as
    null. A bucket's is the sum of its rows' first hash, in two limbs, and the
    XOR of their second. Each task emits at most ``buckets`` rows.
    """
    normal = diff_key_normalise(df, key)
    values = []
    for c, numeric in compared.items():
        x = _c(c).cast("double" if numeric else "string")
        values.append(x if numeric else F.when(F.trim(x) != "", x))
    # The place of each null goes in as well, since a hash passes over nulls.
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values]) if values else F.lit("")
    hashes = [F.xxhash64(F.lit(seed), *[_c(k) for k in key], nulls, *values) for seed in (1, 2)]
    rows = normal.select(
        F.pmod(F.xxhash64(*[_c(k) for k in key]), F.lit(buckets)).alias("bucket"),
        hashes[0].alias("h1"),
        hashes[1].alias("h2"),
        *[_c(c).alias(f"v{i}") for i, (c, numeric) in enumerate(compared.items()) if numeric],
    )
    return rows.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.sum(F.shiftright("h1", 32)).alias("high"),
        F.sum(F.col("h1").bitwiseAND(F.lit((1 << 32) - 1))).alias("low"),
        F.bit_xor("h2").alias("mix"),
        *[F.sum(f"v{i}").alias(f"s{i}") for i, numeric in enumerate(compared.values()) if numeric],
    )


def digest_verdict(
    a: DataFrame,
    b: DataFrame,
    key: Sequence[str],
    atol: float = rules.DIFF_ATOL,
    rtol: float = rules.DIFF_RTOL,
    buckets: int = 4096,
) -> DataFrame:
    """The row of ``diff_verdict``, pairing only the rows of buckets whose digests differ.

    Both tables are reduced to at most ``buckets`` digests before anything is
    shuffled; equal tables end there. Rows of a bucket with equal digests are
    equal row for row, so a key that repeats in it pairs equal rows and is not
    refused; in buckets that differ it is.
    """
    compared = _compared(a, b, key)
    numbers = [i for i, numeric in enumerate(compared.values()) if numeric]
    sides = []
    for tag, df in (("a", a), ("b", b)):
        digests = bucket_digests(df, key, compared, buckets)
        sides.append(digests.select("bucket", *[_c(c).alias(f"{c}_{tag}") for c in digests.columns if c != "bucket"]))
    same = F.lit(True)
    for part in ("n", "high", "low", "mix"):
        same = same & F.col(f"{part}_a").eqNullSafe(F.col(f"{part}_b"))
    met = stage_table(sides[0].join(sides[1], "bucket", "full_outer").withColumn("same", same), "digests")
    totals = met.agg(
        F.count(F.when(~F.col("same"), 1)).alias("differing"),
        F.coalesce(F.sum(F.when(F.col("same"), F.col("n_a"))), F.lit(0)).alias("equal_rows"),
        *[F.coalesce(F.sum(f"s{i}_{t}"), F.lit(0)).cast("double").alias(f"{t}{i}") for i in numbers for t in "ab"],
    ).first()

    def changed(df: DataFrame) -> DataFrame:
        # At most ``buckets`` numbers, whatever the tables hold.
        listed = F.broadcast(met.filter(~F.col("same")).select("bucket"))
        normal = diff_key_normalise(df.select(*[_c(k) for k in key], *[_c(c) for c in compared]), key)
        bucket = F.pmod(F.xxhash64(*[_c(k) for k in key]), F.lit(buckets))
        return normal.withColumn("__bucket", bucket).join(listed.toDF("__bucket"), "__bucket", "left_semi").drop("__bucket")

    if totals["differing"]:
        found = checked_counts(changed(a), changed(b), key, compared, atol, rtol).first().asDict()
    else:
        found = dict.fromkeys([*PRESENCE, *[f"d{i}" for i in range(len(compared))]], 0)
    found["both"] += totals["equal_rows"]
    found |= {f"{t}{i}": totals[f"{t}{i}"] for i in numbers for t in "ab"}
    fields = [T.StructField(n, T.DoubleType() if n[0] in "ab" and n[1:].isdigit() else T.LongType()) for n in found]
    counts = a.sparkSession.createDataFrame([tuple(found.values())], T.StructType(fields))
    return verdict(counts, compared, set(a.columns) == set(b.columns), atol, rtol)


def compare_tables(
    a: DataFrame,
    b: DataFrame,
    key: Sequence[str] | None = None,
    atol: float = rules.DIFF_ATOL,
    rtol: float = rules.DIFF_RTOL,
) -> dict[str, DataFrame]:
    """The whole comparison from one staged grouping; refuses a key that does not identify rows."""
    key = diff_key_detect(a.columns, b.columns, key)
    joined = diff_rows(a, b, key)
    compared = _compared(a, b, key)
    counts = stage_table(diff_counts(joined, compared, atol, rtol), "diff_counts")
    keys = [_c(k) for k in key]
    out = {
        "schema": diff_schema(a, b),
        "columns": column_report(counts, compared),
        "only_in_a": diff_samples(joined, key, F.col("presence") == "left_only").select(*keys),
        "only_in_b": diff_samples(joined, key, F.col("presence") == "right_only").select(*keys),
        "verdict": verdict(counts, compared, set(a.columns) == set(b.columns), atol, rtol),
    }
    for c, numeric in compared.items():
        x, y = _c(f"{c}__a"), _c(f"{c}__b")
        unequal = (F.col("presence") == "both") & ~values_equal(x, y, numeric, atol, rtol)
        out[f"differing:{c}"] = diff_samples(joined, key, unequal).select(*keys, x.alias("A"), y.alias("B"))
    return out
