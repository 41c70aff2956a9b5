"""Mixing sources to target weights.

Source token shares are raised to an exponent between 0 and 1 and normalised.
Lowering the exponent evens the sources out: entropy rises, and small sources
are repeated more often. The exponent is bisected, over a fixed grid, to the
largest that reaches a target entropy; where that would repeat a source beyond
a limit, to the smallest that keeps the limit. The weights become token budgets,
and a budget is realised as epochs: whole ones, and one that is cut. In each
epoch the blocks of a source come in an order of their own, the documents of a
block likewise.

Per source the realisation is one row (whole epochs, the block and the document
the cut falls on), so each document is placed by its own row and that one; texts
are not shuffled as long as the table of sources is below the broadcast
threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factorfall.llm.common import WORD
from factorfall.session import stage_table

GRID = 20  # the exponent is a multiple of 1 / 2^GRID
ENTROPY_RATIO = 0.95  # of the largest entropy, that of equal weights
REPEAT_LIMIT = 3.0
BLOCK_DOCS = 256
# Beyond this many blocks of a source, blocks grow instead: neither the blocks of
# a source nor the documents of a block become too many to be put in order.
MOST_BLOCKS = 65_536
SEED = 17


def n_tokens(text: str) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _order(*parts: Column | str) -> Column:
    """A pseudo-random order key, the same on every run and engine."""
    return F.md5(F.concat_ws(":", *parts))


def source_shares(tokens: DataFrame) -> DataFrame:
    """Documents, tokens and blocks of each source that has tokens (source, tokens)."""
    sums = tokens.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("tokens").alias("source_tokens"))
    return sums.withColumn("n_blocks", F.least(F.ceil(F.col("n_docs") / BLOCK_DOCS).cast("long"), F.lit(MOST_BLOCKS).cast("long")))


def exponent(shares: DataFrame, entropy_ratio: float = ENTROPY_RATIO, repeat_limit: float = REPEAT_LIMIT) -> float:
    """The mixing exponent; 1 for fewer than two sources.

    Each round halves the bracket five times at once: one aggregation of the
    staged sources gives the entropy at 31 inner points.
    """
    positive = shares.filter("source_tokens > 0")
    n, total, least, most = positive.agg(F.count("*"), F.sum("source_tokens"), F.min("source_tokens"), F.max("source_tokens")).first()
    if n < 2:
        return 1.0
    share = F.col("source_tokens") / F.lit(float(total))
    target, low, high = entropy_ratio * math.log(n), 0, 1 << GRID

    def entropies(points: list[int]) -> list[float]:
        sums = []
        for a in (p / (1 << GRID) for p in points):
            raised = F.pow(share, F.lit(a))
            sums += [F.sum(raised), F.sum(raised * F.log(share))]
        row = positive.agg(*sums).first()
        return [math.log(row[2 * i]) - p / (1 << GRID) * row[2 * i + 1] / row[2 * i] for i, p in enumerate(points)]

    # Entropy falls as the exponent rises; exponent 0 always reaches the target.
    if entropies([high])[0] >= target:
        low = high
    while high - low > 1:
        step = max(1, (high - low) // 32)
        points = [p for p in range(low + step, high, step)][:31]
        reached = [p for p, h in zip(points, entropies(points)) if h >= target]
        low = max([low, *reached])
        high = min([high, *[p for p in points if p > low]])
    # With the largest source seen once, the smallest is seen (most / least) ^ (1 - exponent) times.
    spread = math.log(most / least)
    if spread > 0 and (1 - low / (1 << GRID)) * spread > math.log(repeat_limit):
        low = min(1 << GRID, math.ceil((1 - math.log(repeat_limit) / spread) * (1 << GRID)))
    return low / (1 << GRID)


def budgets(shares: DataFrame, power: float, budget_tokens: int | None = None) -> DataFrame:
    """The sources with weight, budget, whole epochs and the tokens of the epoch that is cut.

    Without a budget the whole is as large as it takes to see every document at
    least once: the source that would be seen least is seen exactly once. Only the
    reported weight is rounded: a source may be smaller than its last digit.
    """
    total = float(shares.agg(F.sum("source_tokens")).first()[0] or 0)
    if not total:
        return shares.select("*", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("budget"), F.lit(1).cast("long").alias("epochs"), F.lit(0).cast("long").alias("cut_tokens"))
    raised = F.when(F.col("source_tokens") > 0, F.pow(F.col("source_tokens") / F.lit(total), F.lit(power))).otherwise(0.0)
    scale = float(shares.agg(F.sum(raised)).first()[0])
    exact = raised / F.lit(scale)
    weighted = shares.withColumn("weight", F.round(exact, 9))
    some, whole = F.col("source_tokens") > 0, budget_tokens is None
    if whole:
        budget_tokens = math.ceil(shares.filter(some).agg(F.max(F.col("source_tokens") / exact)).first()[0])
    budget = F.round(exact * F.lit(float(budget_tokens)), 0).cast("long")
    if whole:
        budget = F.greatest(budget, F.col("source_tokens"))
    weighted = weighted.withColumn("budget", budget)
    # A source without tokens costs nothing: it is seen once.
    return weighted.withColumns(
        {
            "epochs": F.when(some, F.expr("budget DIV source_tokens")).otherwise(1),
            "cut_tokens": F.when(some, F.expr("budget % source_tokens")).otherwise(0),
        }
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Rows of (doc_id, source, n_blocks, epochs) with their block and its and their order in the cut epoch."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    block = F.conv(F.substring(_order(F.lit("block"), key), 1, 12), 16, 10).cast("long") % F.col("n_blocks")
    rows = rows.withColumn("block", block)
    return rows.withColumns(
        {"block_order": block_order(F.col("epochs")), "doc_order": doc_order(F.col("epochs"))}
    )


def block_order(epoch: Column) -> Column:
    return _order(F.lit(str(SEED)), epoch.cast("string"), F.coalesce("source", F.lit("-")), F.col("block").cast("string"))


def doc_order(epoch: Column) -> Column:
    return _order(F.lit(str(SEED)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))


def cuts(tokens: DataFrame, planned: DataFrame) -> DataFrame:
    """Per source: the order of the block the cut falls on and of the last document taken from it.

    Blocks before it are taken whole. Documents of equal order are taken
    together or not at all.
    """
    rows = tokens.join(planned.withColumnRenamed("source", "p_source"), tokens["source"].eqNullSafe(F.col("p_source"))).drop("p_source")
    rows = _placed(rows.filter("cut_tokens > 0"))
    blocks = rows.groupBy("source", "block", "block_order", "cut_tokens").agg(F.sum("tokens").alias("block_tokens"))
    # One row a block: a source of n documents has n / BLOCK_DOCS.
    up_to = W.partitionBy("source").orderBy("block_order", "block")
    blocks = blocks.withColumn("after", F.sum("block_tokens").over(up_to)).withColumn("before", F.col("after") - F.col("block_tokens"))
    edge = blocks.filter("before <= cut_tokens AND after > cut_tokens").groupBy("source").agg(
        F.min(F.struct("block_order", "block", "before", "cut_tokens")).alias("e")
    )
    edge = edge.select(F.col("source").alias("e_source"), F.col("e.block").alias("e_block"), F.col("e.block_order").alias("edge_order"), (F.col("e.cut_tokens") - F.col("e.before")).alias("room"))
    within = rows.join(edge, rows["source"].eqNullSafe(F.col("e_source")) & (rows["block"] == F.col("e_block")))
    running = F.sum("tokens").over(W.partitionBy("source", "block").orderBy("doc_order"))
    last = within.withColumn("running", running).filter("running <= room").groupBy("source").agg(F.max("doc_order").alias("last_order"))
    last = last.withColumnRenamed("source", "l_source")
    return edge.join(last, F.col("e_source").eqNullSafe(F.col("l_source")), "left").select(
        F.col("e_source").alias("c_source"), "edge_order", F.coalesce("last_order", F.lit("")).alias("last_order")
    )


def mixed(
    docs: DataFrame, entropy_ratio: float = ENTROPY_RATIO, repeat_limit: float = REPEAT_LIMIT, budget_tokens: int | None = None,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The documents as often as their source's budget has them.

    All columns of ``docs`` and, prefixed ``mix_``: tokens, weight, epoch (from
    0), block, block_order, doc_order; the mixture is read in the order of
    (epoch, block_order, doc_order) within a source. A null source is a source
    of its own. Texts without words cost nothing and come with their block;
    repeated rows are drawn together. An empty table gives no rows.
    """
    counted = docs.withColumns(
        {"mix_doc": docs[doc_id].cast("long"), "mix_source": docs[source].cast("string"), "mix_tokens": n_tokens(text)}
    )
    tokens = counted.select(F.col("mix_doc").alias("doc_id"), F.col("mix_source").alias("source"), F.col("mix_tokens").alias("tokens"))
    tokens = stage_table(tokens, "mix-tokens")
    shares = stage_table(source_shares(tokens), "mix-shares")
    planned = stage_table(budgets(shares, exponent(shares, entropy_ratio, repeat_limit), budget_tokens), "mix-budgets")
    cut = cuts(tokens, planned)
    plan = planned.join(cut, planned["source"].eqNullSafe(F.col("c_source")), "left").drop("c_source")
    plan = stage_table(plan.select(*[F.col(c).alias(f"p_{c}") for c in plan.columns]), "mix-plan")
    rows = counted.join(plan, F.col("mix_source").eqNullSafe(F.col("p_source")))
    # Names of the input must not clash with those the order keys are made of.
    own = [c for c in counted.columns if c not in ("mix_doc", "mix_source")]
    rows = rows.select(F.struct(*own).alias("row"), F.col("mix_doc").alias("doc_id"), F.col("mix_source").alias("source"), *[F.col(f"p_{c}").alias(c) for c in ("n_blocks", "epochs", "weight", "edge_order", "last_order", "cut_tokens")])
    rows = _placed(rows)
    partly = F.when(F.col("cut_tokens") == 0, False).when(F.col("edge_order").isNull(), True).otherwise(
        (F.col("block_order") < F.col("edge_order"))
        | (F.col("block_order") == F.col("edge_order")) & (F.col("doc_order") <= F.col("last_order"))
    )
    times = F.col("epochs") + F.when(partly, 1).otherwise(0)
    rows = rows.withColumn("times", times).filter("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    return rows.select(
        *[F.col("row")[c].alias(c) for c in own if c != "mix_tokens"],
        F.col("row")["mix_tokens"].alias("mix_tokens"),
        F.col("weight").alias("mix_weight"),
        F.col("epoch").alias("mix_epoch"),
        F.col("block").alias("mix_block"),
        block_order(F.col("epoch")).alias("mix_block_order"),
        doc_order(F.col("epoch")).alias("mix_doc_order"),
    )
