"""Host-level quality rules.

Each document is counted once; rule failures are added up by host, failure
rates are shrunk towards the corpus rate with a beta prior estimated from the
hosts themselves, and the verdict on a host goes back to its documents.

Rows: one per document, repeated rows included. A null text has no words. A
null host is a host of its own. Empty tables give no rows. Columns of the input
other than the id, text and host are neither read nor returned, so their names
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall.llm.common import WHITE, raw_text
from factorfall.session import stage_table

# A document fails a rule beyond these.
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30
WORD_LENGTHS = (3, 10)
SYMBOLS = b"#*$%&|<>"

RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repetitive": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words",
    "symbol_heavy": f"100 * n_symbols > {SYMBOL_PERCENT} * word_chars",
    "repeated_lines": f"100 * n_dup_lines > {DUP_LINE_PERCENT} * n_lines",
    "odd_words": f"word_chars < {WORD_LENGTHS[0]} * n_words OR word_chars > {WORD_LENGTHS[1]} * n_words",
}
# A host fails a rule when its shrunk rate is above REJECT; from WATCH on, and
# WATCH_TIMES the corpus rate, its documents that fail the rule go.
REJECT, WATCH, WATCH_TIMES = 0.5, 0.25, 2.0

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more in the list."""
    n = len(words)
    if n < 4:
        return 0
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, size = np.fromiter((code[w] for w in words), dtype=np.int64, count=n), len(code)
    # Pairs are renumbered, so the key of a triple stays below n * size.
    pair = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)[1].astype(np.int64)
    _, window, times = np.unique(pair * size + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def text_counts(raw: bytes) -> tuple[int, ...]:
    """The COUNTS of one text."""
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    white = sum(raw.count(bytes([c])) for c in WHITE)
    return (
        len(words),
        len(raw.decode("utf-8", "replace")) - white,
        sum(raw.count(bytes([c])) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_counts(raw.as_py()) for raw in batch.column("raw")]
        columns = list(zip(*found)) if found else [()] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *[pa.array(c, pa.int64()) for c in columns]],
            names=["doc_id", "host", *COUNTS],
        )


def document_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, the counts and one flag per rule."""
    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"), docs[host].cast("string").alias("host"), raw_text(docs, text).alias("raw")
    )
    schema = "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(_count_batches, schema).withColumns({r: F.expr(rule) for r, rule in RULES.items()})


def host_verdicts(counts: DataFrame) -> DataFrame:
    """One row per host: documents, shrunk failure rate of each rule, rejected and watched rules.

    The prior is beta(p / rho - p, ...): p is the corpus rate of the rule, rho
    the intra-host correlation of failures by the analysis-of-variance moment
    estimator over all hosts, kept within 1e-6 and 1 - 1e-6. One host, or rates
    that differ no more than chance, give a strong prior.
    """
    hosts = counts.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(f"f_{r}") for r in RULES]
    )
    hosts = stage_table(hosts, "hosts")
    prior = hosts.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("total"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        *[F.sum(f"f_{r}").alias(f"t_{r}") for r in RULES],
        *[F.sum(F.col(f"f_{r}").cast("double") * F.col(f"f_{r}") / F.col("n")).alias(f"s_{r}") for r in RULES],
    )
    rates = {}
    for r in RULES:
        p = F.col(f"t_{r}") / F.col("total")
        spread = p * (1 - p)
        between = F.col(f"s_{r}") - F.col("total") * p * p
        room = spread * (F.col("total") - F.col("squares") / F.col("total") - (F.col("k") - 1))
        rho = F.when(room > 0, (between - spread * (F.col("k") - 1)) / room).otherwise(0.0)
        rates[f"p_{r}"] = p
        rates[f"strength_{r}"] = 1 / F.least(F.greatest(rho, F.lit(1e-6)), F.lit(1 - 1e-6)) - 1
    # The prior is one row, whatever the number of hosts.
    prior = prior.select(*[c.alias(name) for name, c in rates.items()]).first().asDict()
    joined = hosts.withColumns({name: F.lit(value).cast("double") for name, value in prior.items()})
    shrunk = {
        f"rate_{r}": (F.col(f"f_{r}") + F.col(f"p_{r}") * F.col(f"strength_{r}")) / (F.col("n") + F.col(f"strength_{r}"))
        for r in RULES
    }
    joined = joined.withColumns(shrunk)
    watch = {
        f"watch_{r}": (F.col(f"rate_{r}") > WATCH) & (F.col(f"rate_{r}") > WATCH_TIMES * F.col(f"p_{r}")) for r in RULES
    }
    reject = F.lit(False)
    for r in RULES:
        reject = reject | (F.col(f"rate_{r}") > REJECT)
    return joined.withColumns({**watch, "host_rejected": reject}).select(
        "host", "n", *shrunk, *watch, "host_rejected"
    )


def host_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: its counts, base_failed, host_rejected and kept.

    Texts are read once; the counts are staged. The host table is joined
    without a hint: below the broadcast threshold no document moves, beyond it
    adaptive execution splits a hot host.
    """
    counts = stage_table(document_counts(docs, doc_id, text, host), "document-counts")
    hosts = host_verdicts(counts).withColumnRenamed("host", "__host")
    rows = counts.join(hosts, counts["host"].eqNullSafe(hosts["__host"]), "left")
    own = F.lit(False)
    for r in RULES:
        own = own | (F.col(f"watch_{r}") & F.col(r))
    base = F.col("few_words") | F.col("repetitive")
    return rows.select(
        "doc_id",
        *COUNTS[:5],
        base.alias("base_failed"),
        "host_rejected",
        (~base & ~F.col("host_rejected") & ~own).alias("kept"),
    )
