"""URL filters by a temporal list join.

A list is a history of dated entries, each adding a pattern to a list or taking
it off. The history of a pattern becomes validity intervals; an as-of join
evaluates every capture against the entries active on its fetch date. Patterns
are hosts with everything below them (``domain``) or a host with a first path
segment (``prefix``).

Captures are first reduced to distinct (host, segment, date) cases, so a host
that holds a third of all captures meets its entries once a date, not once a
row; verdicts then go back to the captures. Column functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factorfall.session import stage_table

FAR = "9999-12-31"
# Lists whose entries exempt what they match; all others block.
EXEMPTING = ("allow",)

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"
_SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def located(captures: DataFrame, url: str = "url") -> DataFrame:
    """The captures with host (lower case, no user or port) and segment; null where the URL has none."""
    host = F.lower(F.regexp_extract(captures[url], _HOST, 1))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    segment = F.regexp_extract(captures[url], _SEGMENT, 1)
    return captures.withColumns(
        {"host": F.when(F.length(host) > 0, host), "segment": F.when(F.length(segment) > 0, segment)}
    )


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list, kind, pattern, valid_from, valid_to) from entries (list, kind, pattern, dated, action).

    ``add`` opens, ``remove`` closes; an add of what is listed goes on with it.
    Of entries of one date, the last is the removal. Equal entries count once,
    entries with a null in any column do not count. The end is exclusive.
    """
    history = entries.select("list", "kind", "pattern", "dated", "action").dropna().distinct()
    # Distinct first: at most two rows for each pattern and date meet in a window.
    in_order = W.partitionBy("list", "kind", "pattern").orderBy("dated", "action")
    until = F.coalesce(F.lead("dated").over(in_order), F.to_date(F.lit(FAR)))
    return (
        history.withColumn("valid_to", until)
        .filter("action = 'add' AND valid_to > dated")
        .select("list", "kind", "pattern", F.col("dated").alias("valid_from"), "valid_to")
    )


def candidates(cases: DataFrame) -> DataFrame:
    """(host, segment, fetched_on) with every pattern that could match it; depth is its number of parts."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), n),
        lambda k: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, n - k + 1, k), ".").alias("pattern"), k.alias("depth")),
    )
    prefix = F.struct(F.lit("prefix").alias("kind"), F.concat_ws("/", "host", "segment").alias("pattern"), (n + 1).alias("depth"))
    every = F.when(F.col("segment").isNull(), suffixes).otherwise(F.concat(suffixes, F.array(prefix)))
    return cases.filter("host IS NOT NULL").select("host", "segment", "fetched_on", F.explode(every).alias("p")).select(
        "host", "segment", "fetched_on", "p.*"
    )


def verdicts(cases: DataFrame, intervals: DataFrame) -> DataFrame:
    """For each case with an active entry: n_active, decided_by and blocked.

    The entry with the most parts decides; of equal ones an exempting list,
    then the first list by name.
    """
    active = candidates(cases).join(intervals, ["kind", "pattern"])
    active = active.filter("fetched_on >= valid_from AND fetched_on < valid_to")
    exempt = F.col("list").isin(*EXEMPTING)
    order = F.struct((-F.col("depth")).alias("depth"), F.when(exempt, 0).otherwise(1).alias("blocks"), "list", "pattern")
    first = active.groupBy("host", "segment", "fetched_on").agg(F.count("*").alias("n_active"), F.min(order).alias("first"))
    return first.select(
        "host", "segment", "fetched_on", "n_active",
        F.concat_ws(":", "first.list", "first.pattern").alias("decided_by"),
        (F.col("first.blocks") == 1).alias("blocked"),
    )


def filter_urls(captures: DataFrame, entries: DataFrame, page_id: str = "page_id", url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """One row per capture: page_id, url, host, fetched_on, n_active, decided_by, blocked.

    A URL without a host, or a capture without a date, matches no entry and is
    not blocked. Repeated captures give repeated rows. Empty captures give no
    rows; an empty list blocks nothing. Other columns are not read. The join
    back has no hint: a hot case is split by adaptive execution.
    """
    mine = located(captures.select(captures[page_id].alias("page_id"), captures[url].alias("url"), captures[fetched].cast("date").alias("fetched_on")))
    mine = stage_table(mine, "captures")
    cases = mine.filter("host IS NOT NULL AND fetched_on IS NOT NULL").groupBy("host", "segment", "fetched_on").agg(F.count("*").alias("n")).drop("n")
    found = verdicts(cases, validity(entries)).select(
        F.col("host").alias("v_host"), F.col("segment").alias("v_segment"), F.col("fetched_on").alias("v_on"), "n_active", "decided_by", "blocked"
    )
    same = (mine["host"] == F.col("v_host")) & (mine["fetched_on"] == F.col("v_on")) & mine["segment"].eqNullSafe(F.col("v_segment"))
    return mine.join(found, same, "left").select(
        "page_id", "url", "host", "fetched_on",
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        "decided_by",
        F.coalesce("blocked", F.lit(False)).alias("blocked"),
    )


# The given pages carry no fetch date and no list, so the query derives both
# from page ids and hosts: digits of a digest choose dates and list histories.
_DAYS = 360
FIRST_DAY = "2024-01-01"


def _digits(text: str, at: int) -> str:
    return f"CAST(conv(substr(md5({text}), {at}, 6), 16, 10) AS INT)"


def dated_captures(pages: DataFrame) -> DataFrame:
    """page_id, url and a fetch date."""
    key = "concat(CAST(page_id AS STRING), ':', url)"
    return pages.select("page_id", "url", F.expr(f"date_add(DATE '{FIRST_DAY}', {_digits(key, 1)} % {_DAYS})").alias("fetched_on"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """Up to five entries for every host, parent domain of two labels or more, and host with segment that occurs."""
    places = located(pages.select("url")).groupBy("host", "segment").agg(F.count("*").alias("n"))
    patterns = candidates(places.withColumn("fetched_on", F.lit(None).cast("date"))).filter("depth > 1").select("kind", "pattern").distinct()
    numbered = patterns.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    numbered = numbered.withColumn("key", F.expr("concat(kind, ':', pattern, ':', CAST(k AS STRING))"))
    return numbered.filter(F.expr(f"{_digits('key', 1)} % 3 = 0")).select(
        F.expr(f"element_at(array('adult', 'allow', 'malware', 'spam'), 1 + {_digits('key', 7)} % 4)").alias("list"),
        "kind",
        "pattern",
        F.expr(f"date_add(DATE '{FIRST_DAY}', {_digits('key', 13)} % {_DAYS})").alias("dated"),
        F.expr(f"CASE WHEN {_digits('key', 19)} % 4 < 3 THEN 'add' ELSE 'remove' END").alias("action"),
    )
