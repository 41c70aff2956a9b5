"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is an n-gram model of order 3 over words, trained on all trusted texts.
A word is a run of letters and digits or a run of signs; in scripts written
without spaces each character is one. Texts are cut into words once. The n-grams
then go through Spark in rounds, those with one middle word in one round, so that
only a round's are on disk: dealt out by context for their counts, then by end for
the continuations, in blocks of arrays (``ngram_blocks``). Bits are summed by text;
nothing that grows with the corpus is held in one place.

Below the words lies a model of their spelling: n-grams of order 4 over character
classes (a to z, other letters, digits, white space, sentence punctuation, other
signs and a begin mark, 32 in all), likewise from all trusted texts. It gives a
word that no trusted text has its probability, each class shared evenly by its
characters. Its table of 32^4 costs goes to every executor.

A trusted document is scored as if its own text had not been counted: an n-gram or
context no other trusted text has is unseen to it. A document's perplexity is held
against a quantile of the trusted documents' own, taken for its language.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall.llm import ngram_blocks as blocks
from factorfall.llm.common import broadcast_if_small, raw_text, shuffles_removed, small_batches
from factorfall.session import remove_staged, stage_table

ORDER = 4
CLASSES = 32
QUANTILE = 0.995
# A language with fewer trusted documents is held against all of them.
MIN_TRUSTED = 50
_BEGIN, _OTHER_LETTER, _DIGIT, _SPACE, _STOP, _SIGN = 31, 26, 27, 28, 29, 30


def _class_table() -> np.ndarray:
    table = np.full(256, _SIGN, dtype=np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(26)
    table[ord("A") : ord("Z") + 1] = np.arange(26)
    table[ord("0") : ord("9") + 1] = _DIGIT
    table[list(b" \t\n\x0b\x0c\r")] = _SPACE
    table[list(b".,;:?!'\"()-")] = _STOP
    table[0x80:0xC0] = 255  # inside a character
    table[0xC0:] = _OTHER_LETTER
    return table


_TABLE = _class_table()


def symbols(raw: bytes) -> np.ndarray:
    """Classes of the text's characters; runs of white space are one, and none at the start."""
    found = _TABLE[np.frombuffer(raw, dtype=np.uint8)]
    found = found[found != 255]
    space = found == _SPACE
    return found[~(space & np.concatenate([[True], space[:-1]]))] if len(found) else found


def ngram_codes(raw: bytes) -> np.ndarray:
    """The code of each character's n-gram, begin marks before the first; the last symbol is lowest."""
    padded = np.concatenate([np.full(ORDER - 1, _BEGIN, dtype=np.int64), symbols(raw).astype(np.int64)])
    codes = np.zeros(len(padded) - ORDER + 1, dtype=np.int64)
    for i in range(ORDER):
        codes = codes * CLASSES + padded[i : len(padded) - ORDER + 1 + i]
    return codes


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES**ORDER, dtype=np.int64)  # 8 MB a task
    for batch in batches:
        for raw in batch.column("raw"):
            codes = ngram_codes(raw.as_py())
            np.add.at(total, codes, 1) if len(codes) < 4096 else np.add(total, np.bincount(codes, minlength=len(total)), out=total)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])


def ngram_counts(trusted: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n) over all the texts."""
    rows = trusted.select(raw_text(trusted, text).alias("raw"))
    return rows.mapInArrow(_count_batches, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    ones = counts.agg(*[F.sum(F.when(F.col("n") == i, 1).otherwise(0)) for i in range(1, 5)]).first()
    return _from_counts([float(x or 0) for x in ones])


def _from_counts(n: list[float]) -> list[float]:
    """D1, D2 and D3+ from counts of counts, kept within 0 and their count."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), i - 0.1) if n[i - 1] else i / 2 for i in range(1, 4)]


def model(counts: DataFrame) -> list[DataFrame]:
    """For each order from 1: (gram, p) of seen n-grams; from order 2 also backoff of their contexts.

    The highest order uses counts, lower ones the number of distinct symbols
    seen before. A seen n-gram has p = (c - D(c)) / c(context) + backoff(context) *
    p(lower order).
    """
    tables: dict[int, DataFrame] = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram") % CLASSES**order
        tables[order] = tables[order + 1].select(suffix.alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    for order in tables:
        tables[order] = stage_table(tables[order], f"grams-{order}")
    out: list[DataFrame] = []
    for order in range(1, ORDER + 1):
        d = _discounts(tables[order])
        n = F.col("n")
        discount = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        rows = tables[order].select("gram", "n", F.floor(F.col("gram") / CLASSES).alias("context"), discount.alias("d"))
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("d").alias("freed"))
        rows = rows.join(contexts, "context")
        backoff = F.col("freed") / F.col("total")
        if order == 1:
            lower = F.lit(1.0 / CLASSES)
        else:
            below = out[-1].select(F.col("gram").alias("low"), F.col("p").alias("p_low"))
            rows = rows.join(below, F.col("gram") % CLASSES ** (order - 1) == F.col("low"))
            lower = F.col("p_low")
        p = (n - F.col("d")) / F.col("total") + backoff * lower
        out.append(stage_table(rows.select("gram", "context", p.alias("p"), backoff.alias("backoff")), f"probabilities-{order}"))
    return out


def dense_costs(tables: list[DataFrame]) -> np.ndarray:
    """-log2 p for every n-gram code: CLASSES ** ORDER numbers, however much text was counted."""
    p = np.full(CLASSES, 1.0 / CLASSES)
    for order, table in enumerate(tables, 1):
        seen = table.select("gram", "context", "p", "backoff").toPandas()
        n_contexts = CLASSES ** (order - 1)
        backoff = np.ones(n_contexts)
        backoff[seen["context"].to_numpy()] = seen["backoff"].to_numpy()
        shorter = np.arange(n_contexts) % max(1, n_contexts // CLASSES)  # without its first symbol
        dense = (backoff[:, None] * p.reshape(-1, CLASSES)[shorter]).ravel()
        dense[seen["gram"].to_numpy()] = seen["p"].to_numpy()
        p = dense
    return (-np.log2(np.maximum(p, 1e-12))).astype(np.float32)


_WORD = re.compile(rb"[a-z0-9_\x80-\xff]+|[^a-z0-9_\x80-\xff\x20\x09-\x0D]+")
# Thai, Lao, kana and Chinese characters: written without spaces.
_UNSPACED = re.compile("([\u0e00-\u0eff\u3000-\u9fff\U00020000-\U0003ffff])")
# Bits that tell a character of a class from the others.
_WITHIN = np.zeros(256)
_WITHIN[_DIGIT], _WITHIN[_STOP], _WITHIN[_SIGN], _WITHIN[_OTHER_LETTER] = np.log2([10, 11, 85, 1_111_936])
# Tokens of a round of the word model and of one task of it, at the largest number of rounds.
ROUND_TOKENS = 4_000_000
SHARD_TOKENS = 600_000
MAX_ROUNDS = 16
# Bytes of text in a block of tokens.
BLOCK_BYTES = 12 << 20
_TOKENS = "words binary, spelled binary, low binary, high binary, sizes binary, keys binary, good binary, n long"

def words(raw: bytes) -> list[bytes]:
    if raw.isascii():
        return _WORD.findall(raw.lower())
    return _WORD.findall(_UNSPACED.sub(r" \1 ", raw.decode("utf-8", "replace").lower()).encode())


def spelling_bits(found: list[bytes], costs: np.ndarray) -> np.ndarray:
    """-log2 of the probability that each word is spelled so, its end included."""
    if not found:
        return np.zeros(0)
    stream = _TABLE[np.frombuffer(b"   " + b"   ".join(found) + b" ", dtype=np.uint8)]
    stream = stream[stream != 255].astype(np.int64)
    codes = np.zeros(len(stream) - ORDER + 1, dtype=np.int64)
    for i in range(ORDER):
        codes = codes * CLASSES + stream[i : len(codes) + i]
    last, before = stream[ORDER - 1 :], stream[ORDER - 2 : -1]
    # Of the white space after a word, the first is its end; what follows is only context.
    bits = np.where((last == _SPACE) & (before == _SPACE), 0.0, costs[codes] + _WITHIN[last])
    return np.add.reduceat(bits, np.flatnonzero((last != _SPACE) & (before == _SPACE)))


def _token_blocks(batches: Iterator[pa.RecordBatch], costs) -> Iterator[pa.RecordBatch]:
    """The texts of a batch as places in the list of their words."""
    for batch in batches:
        place: defaultdict[bytes, int] = defaultdict()
        place.default_factory = place.__len__  # a new word gets the next number
        texts = [np.zeros(0, dtype=np.uint32)]
        for raw in batch.column("raw"):
            found = words(raw.as_py())
            texts.append(np.fromiter(map(place.__getitem__, found), dtype=np.uint32, count=len(found)))
        tokens, sizes = np.concatenate(texts), np.array([len(x) for x in texts[1:]], dtype=np.int64)
        hashes = np.array([xxhash.xxh64_intdigest(w) - (1 << 63) for w in place], dtype=np.int64)
        spelled = spelling_bits(list(place), costs.value).astype(np.float32)
        keys, good = (np.asarray(batch.column(x).to_numpy(zero_copy_only=False)) for x in ("key", "good"))
        # Compressed apart, the upper bytes take little room.
        low, high = tokens.astype(np.uint16), blocks.narrow(tokens >> 16)
        columns = [hashes, spelled, low, high, sizes, keys.astype(np.int64), good.astype(bool)]
        arrays = [pa.array([blocks.pack(x)], pa.binary()) for x in columns]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array([len(tokens)], pa.int64())], names=[x.split()[0] for x in _TOKENS.split(", ")])


def _common_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that are at least one in a thousand of a block's; how often."""
    for batch in batches:
        for block in batch.to_pylist():
            n = np.bincount(blocks.block_tokens(block))
            common = np.flatnonzero(n * 1000 >= max(1, block["n"]))
            yield pa.RecordBatch.from_arrays([pa.array(blocks.unpack(block["words"])[common]), pa.array(n[common])], names=["word", "n"])


def _text_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(blocks.unpack(block[x])) for x in ("keys", "good", "sizes")], names=["key", "good", "n"])


def _plan(tokens: DataFrame) -> blocks.Plan:
    total = tokens.agg(F.sum("n")).first()[0] or 0
    rounds = min(MAX_ROUNDS, 1 + total // ROUND_TOKENS)
    shards = 1 + total // rounds // SHARD_TOKENS
    # Words that are half a task's n-grams or more: at most two for each task.
    common = tokens.mapInArrow(_common_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = common.filter(F.col("n") * (2 * rounds * shards) >= max(total, 1)).collect()
    return blocks.make_plan(rounds, shards, [(r["word"], r["n"]) for r in found], total)


def word_counts(tokens: DataFrame, plan: blocks.Plan) -> DataFrame:
    """COUNTS of ``ngram_blocks`` over all trusted texts."""
    parts = blocks.make_plan(-(-plan.rounds // 4), 2 * plan.shards, [], 1)
    counted = []
    for number in range(parts.rounds):
        rows = tokens.mapInArrow(lambda batches, number=number: blocks.block_rows(batches, parts, number, True), blocks.ENTRIES)
        rows = rows.groupBy("shard").applyInArrow(blocks.count_rows, blocks.COUNTS)
        counted.append(stage_table(_added(rows), "word-counts"))
    total = stage_table(_added(reduce(DataFrame.unionByName, counted)), "word-counts")
    for rows in counted:
        remove_staged(rows)
    return total


def _added(counts: DataFrame) -> DataFrame:
    sums = [F.sum(x).alias(x) for x in ("x1", "x2", "x3", "x4")]
    return counts.groupBy("kind", "word").agg(*sums, F.min("lo").alias("lo"), F.max("hi").alias("hi"))


class WordModel(NamedTuple):
    """Values of single words as last ones and as contexts, discounts of order 2 and 3, weight of the spelling."""

    last: DataFrame
    context: DataFrame
    d2: list[float]
    d3: list[float]
    w1: float


def word_model(counts: DataFrame, plan: blocks.Plan) -> WordModel:
    """Of order 1 all there is; of orders 2 and 3 what the n-grams with one context or end do not tell themselves."""
    of = {r["kind"]: [float(r[f"x{i}"]) for i in range(1, 5)] for r in counts.filter(F.col("kind") >= blocks.ORDER_2).collect()}
    d3, d2 = (_from_counts(of.get(kind, [0.0] * 4)) for kind in (blocks.ORDER_3, blocks.ORDER_2))
    last = counts.filter(F.col("kind") == blocks.LAST)
    d1 = _discounts(last.select(F.col("x1").alias("n")))
    n = F.col("x1")
    d = F.when(n == 1, d1[0]).when(n == 2, d1[1]).otherwise(d1[2])
    total, freed = last.agg(F.sum("x1").cast("double"), F.sum(d)).first()
    lone = (F.col("lo") == F.col("hi")).alias("lone")
    last = last.select("word", ((n - d) / F.lit(total or 1.0)).cast("float").alias("x"), F.lit(0).cast("float").alias("y"), lone)
    w2 = (F.col("x1") * d2[0] + F.col("x2") * d2[1] + F.col("x3") * d2[2]) / F.col("x4")
    context = counts.filter(F.col("kind") == blocks.CONTEXT).select("word", w2.cast("float").alias("x"), F.col("x4").cast("float").alias("y"), lone)
    values = [
        stage_table(x.mapInArrow(lambda batches, by_round=by_round: blocks.value_rows(batches, plan, by_round), blocks.VALUES), name)
        for x, name, by_round in ((last, "word-last", False), (context, "word-context", True))
    ]
    return WordModel(*values, d2, d3, freed / total if total else 1.0)


def word_bits(tokens: DataFrame, model: WordModel, plan: blocks.Plan) -> DataFrame:
    """key, good and bits of the texts, round by round; a round's n-grams are gone before the next but one."""
    d2, d3, w1 = model.d2, model.d3, model.w1
    sums, before = [], None
    for number in range(plan.rounds):
        rows = tokens.mapInArrow(lambda batches, number=number: blocks.block_rows(batches, plan, number, False), blocks.ENTRIES)
        context = model.context.filter(F.col("round") == number)
        rows = rows.groupBy("shard").cogroup(context.groupBy("shard")).applyInArrow(
            lambda entries, values: blocks.context_rows(entries, values, plan, d3), blocks.FORWARDED
        )
        if before is not None:
            remove_staged(before)
        before = rows = stage_table(rows, "word-rows")
        ends = rows.filter("c IS NOT NULL").drop("bits").groupBy("shard").cogroup(model.last.groupBy("shard")).applyInArrow(
            lambda entries, values: blocks.end_rows(entries, values, plan, d2, w1), blocks.SUMS
        )
        done = rows.filter("c IS NULL").select("shard", "keys", "good", "bits").unionByName(ends)
        sums.append(stage_table(done.groupBy("shard").applyInArrow(lambda x: blocks.summed(x, plan.shards), blocks.SUMS), "word-sums"))
    return reduce(DataFrame.unionByName, sums).groupBy("shard").applyInArrow(blocks.text_rows, "key long, good boolean, bits double")


def scored(
    docs: DataFrame, ids: DataFrame, costs: np.ndarray, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """doc_id, lang, n_symbols (words), perplexity (per word; null for a text without words).

    ``ids`` has the trusted t_id. Rows of one text are left out of the model together.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(costs)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[lang].cast("string").alias("lang"), raw_text(docs, text).alias("raw"))
    rows = rows.withColumn("key", F.xxhash64("raw")).join(ids.withColumn("in", F.lit(True)), F.col("doc_id") == F.col("t_id"), "left")
    rows = rows.withColumn("good", F.col("in").isNotNull())
    with small_batches(spark, BLOCK_BYTES):
        tokens = stage_table(rows.select("raw", "key", "good").mapInArrow(lambda batches: _token_blocks(batches, held), _TOKENS), "word-tokens")
    plan = _plan(tokens)
    counts = word_counts(tokens, plan)
    fitted = word_model(counts, plan)
    remove_staged(counts)
    bits = word_bits(tokens, fitted, plan)
    # Equal texts are summed together.
    sizes = tokens.mapInArrow(_text_sizes, "key long, good boolean, n long").groupBy("key", "good")
    sizes = sizes.agg(F.sum("n").alias("n"), F.count("*").alias("copies"))
    per_text = stage_table(bits.join(sizes, ["key", "good"]), "word-bits")
    per_text = per_text.select("key", "good", F.expr("n DIV copies").alias("n"), F.round(F.col("bits") / F.col("n"), 9).alias("rate"))
    found = rows.drop("raw").join(per_text, ["key", "good"], "left")
    return found.select(
        "doc_id", "lang", F.coalesce("n", F.lit(0).cast("long")).alias("n_symbols"), F.pow(F.lit(2.0), F.col("rate")).alias("perplexity")
    )


def quality_by_perplexity(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE,
    doc_id: str = "doc_id", text: str = "text", lang: str = "lang", trusted: str = "quality",
) -> DataFrame:
    """One row per document: doc_id, lang, n_symbols, perplexity, threshold, kept.

    Trusted are documents whose label is 1 in any row of ``labels``. A
    document is kept up to its language's threshold; an empty, blank or null text
    has no perplexity and is not kept. A null language, or one with fewer than
    MIN_TRUSTED trusted documents, is held against the quantile of all trusted
    ones; with no trusted text at all there is no threshold and every document
    with text is kept. Repeated rows give repeated rows and count as often in
    the model, but a trusted text is held against the others only. Empty tables give no rows. Other columns are not read.
    """
    with shuffles_removed(docs.sparkSession):
        ids = labels.filter(F.col(trusted) == 1).select(labels[doc_id].cast("long").alias("t_id")).distinct()
        ids = broadcast_if_small(stage_table(ids, "trusted-ids"), 8)
        good = docs.join(ids, docs[doc_id].cast("long") == F.col("t_id"), "left_semi")
        costs = dense_costs(model(stage_table(ngram_counts(good, text), "gram-counts")))
        found = stage_table(scored(docs, ids, costs, doc_id, text, lang), "perplexities")
        known = found.join(ids, F.col("doc_id") == F.col("t_id"), "left_semi").filter("perplexity IS NOT NULL")
        limit = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
        by_lang = known.groupBy("lang").agg(F.count("*").alias("n_trusted"), limit.alias("own")).filter(F.col("n_trusted") >= MIN_TRUSTED)
        # One row a language, so documents of a common language stay where they are.
        by_lang = broadcast_if_small(stage_table(by_lang.select(F.col("lang").alias("l_lang"), "own"), "limits"), 64)
        overall = F.lit(known.agg(limit).first()[0]).cast("double")  # one number
    joined = found.join(by_lang, F.col("lang") == F.col("l_lang"), "left")
    threshold = F.coalesce(F.col("own"), overall)
    return joined.select(
        "doc_id", "lang", "n_symbols", "perplexity", threshold.alias("threshold"),
        F.coalesce(F.col("perplexity") <= threshold, threshold.isNull() & F.col("perplexity").isNotNull(), F.lit(False)).alias("kept"),
    )
