"""Spelling variants: words one edit from a much more frequent word take its form.

The words make a trie with paths of single children pressed into one edge, so that
its levels are branchings and not characters, however long a word is. An edge row
says its level, node (the text up to there), label, the count of the word that ends
below it and the characters that can follow. A frontier of states (word, position,
node, edits) is joined with the edges of one level after the other. A state without
an edit goes along its word and, at every node, tries the replaced, inserted or
deleted character that each other child would need; a state with an edit only follows
its word. A state that ends its word at a node where a word ends, with one edit, is a
pair of neighbours.

Two words part at a node, and what they share is before or behind the edit. So every
word is in the trie twice, as it is and backwards, under a mark for either, and edits
are tried in the second half of each only: near the root, where a node has very many
words and children, nothing branches. A word backwards drops neighbours whose first
half is its own, as it has them forwards: each pair is reached once from either side.

States are the larger side of an equi-join whose other side has at most as many rows
a node as there are letters; adaptive execution splits a node that holds many.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall.llm.common import raw_text
from factorfall.session import stage_table

SHORTEST = 5
LEAST = 3
SLIP = 97
TIMES = 2
# Distinct words held by one task before it hands them on.
HELD_WORDS = 500_000
FORWARDS, BACKWARDS = "<", ">"
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)  # A-Z are lowered before


def slipped(run: str, key: int, slip: int = SLIP) -> str:
    """The run as it is read in the document whose prefix has the crc32 ``key``: one in ``slip`` lacks a character."""
    h = zlib.crc32(run.encode(), key)
    if h % slip:
        return run
    return run[: h % len(run)] + run[h % len(run) + 1 :]


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw")):
            key = zlib.crc32(b"%s:" % doc_id.encode())
            # bytes: A-Z only
            for run, n in Counter(_RUN.findall(raw.as_py().lower().decode("utf-8", "replace"))).items():
                word = slipped(run, key)
                if len(word) >= SHORTEST:
                    total[word] += n
            if len(total) > HELD_WORDS:
                yield rows()
                total.clear()
    if total:
        yield rows()


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(word, n) of the words that occur at least ``least`` times."""
    rows = docs.select(F.coalesce(docs[doc_id].cast("string"), F.lit("")).alias("doc_id"), raw_text(docs, text).alias("raw"))
    counted = rows.mapInArrow(_word_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least)


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words as paths (text, n, cuts) and the edges (level, node, label, near_n, following).

    A node is where texts part or one ends; ``cuts`` are the lengths of a text's
    nodes. ``near_n`` is the count of a text that ends below an edge, ``following``
    what may come then. Prefixes are compared by hash to find the nodes; two that
    share a hash only cut an edge in two.
    """
    forwards = words.select(F.concat(F.lit(FORWARDS), "word").alias("text"), "n")
    texts = forwards.unionByName(words.select(F.concat(F.lit(BACKWARDS), F.reverse("word")).alias("text"), "n"))
    ends = texts.select("text", F.explode(F.expr("sequence(1, length(text))")).alias("at"))
    prefixes = ends.select("text", "at", F.expr("xxhash64(substr(text, 1, at))").alias("prefix"), F.expr("substr(text, at + 1, 1)").alias("next"))
    parting = prefixes.groupBy("prefix").agg(F.min("next").alias("low"), F.max("next").alias("high")).filter("low != high").select("prefix")
    inner = prefixes.join(parting, "prefix").groupBy(F.col("text").alias("__text")).agg(F.collect_set("at").alias("inner"))
    cuts = F.expr("array_sort(array_union(array(0, length(text)), coalesce(inner, array())))")
    paths = stage_table(texts.join(inner, F.col("text") == F.col("__text"), "left").select("text", "n", cuts.alias("cuts")), "trie-paths")
    steps = paths.select("text", "n", "cuts", F.explode(F.expr("sequence(0, size(cuts) - 2)")).alias("level"))
    steps = steps.select("text", "n", "level", F.expr("cuts[level]").alias("a"), F.expr("cuts[level + 1]").alias("b"))
    edges = steps.groupBy(F.expr("substr(text, 1, a)").alias("node"), F.expr("substr(text, a + 1, b - a)").alias("label")).agg(
        F.min("level").alias("level"), F.max(F.when(F.col("b") == F.length("text"), F.col("n"))).alias("near_n")
    )
    edges = stage_table(edges, "trie-edges")
    following = edges.groupBy(F.col("node").alias("child")).agg(F.concat_ws("", F.collect_set(F.substring("label", 1, 1))).alias("following"))
    edges = edges.join(following, F.concat("node", "label") == F.col("child"), "left")
    return paths, edges.select("level", "node", "label", "near_n", F.coalesce("following", F.lit("")).alias("following"))


def _unedited(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States without an edit, one edge further; at an own node of the second half also with one."""
    met = states.join(edges, states["node"] == edges["from"]).withColumns(
        {"at": F.length("node"), "size": F.length("label"), "left": F.length("text") - F.length("node")}
    )
    own = "substr(text, at + 1, size) = label"
    tried = f"at >= half AND NOT {own} AND substr(text, at + 1, 1) != substr(label, 1, 1)"
    changed = "left >= size AND substr(text, at + 2, size - 1) = substr(label, 2)"
    longer = "left >= size - 1 AND substr(text, at + 1, size - 1) = substr(label, 2)"
    shorter = "left > size AND substr(text, at + 2, size) = label"
    met = met.filter(f"{own} OR {tried} AND ({changed} OR {longer} OR {shorter})")
    ways = {0: (own, 0), 1: (f"{own} AND left = size + 1", 1), 2: (f"{tried} AND {changed}", 0), 3: (f"{tried} AND {longer}", -1), 4: (f"{tried} AND {shorter}", 1)}
    reached = [f"if({way}, named_struct('end', at + size + {more}, 'edits', {min(k, 1)}), null)" for k, (way, more) in ways.items()]
    met = met.withColumn("reached", F.explode(F.expr(f"filter(array({', '.join(reached)}), x -> x IS NOT NULL)")))
    return met.withColumns({"end": F.col("reached.end"), "edits": F.col("reached.edits")})


def _edited(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States with an edit, along the one edge that can continue their text."""
    states = states.withColumn("next", F.expr("substr(text, at + 1, 1)"))
    met = states.join(edges, (states["node"] == edges["from"]) & (states["next"] == F.substring(edges["label"], 1, 1)))
    return met.filter("substr(text, at + 1, length(label)) = label").withColumn("end", F.expr("at + length(label)"))


def _going(met: DataFrame) -> DataFrame:
    """The new states that have ended at a neighbour or can go on."""
    ended = "edits = 1 AND end = length(text)"
    on = "if(edits = 0, following != '', end < length(text) AND instr(following, substr(text, end + 1, 1)) > 0)"
    met = met.filter(f"if({ended}, there_n IS NOT NULL, {on})")
    return met.select(
        "text", "n", "half", F.concat("node", "label").alias("node"), F.col("end").alias("at"), "edits", F.expr(f"if({ended}, there_n, null)").alias("near_n")
    )


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for all pairs of ``words`` (word, n) that are exactly one edit apart."""
    paths, edges = trie(words)
    edges = stage_table(edges, "trie", partition_by="level")
    deepest = edges.agg(F.max("level")).first()[0]
    # A text starts at its last node in the first half; up to there it goes alone.
    half = F.expr("CAST(1 + (length(text) - 1) DIV 2 AS INT)")
    starts = paths.withColumn("half", half).withColumn("passed", F.expr("filter(cuts, c -> c <= half)")).select(
        "text", "n", "half", F.expr("substr(text, 1, array_max(passed))").alias("node"), F.expr("size(passed) - 1").alias("level")
    )
    starts = stage_table(starts, "trie-starts", partition_by="level")
    states, found = None, words.sparkSession.createDataFrame([], "text string, n long, near string, near_n long")
    for level in range(0 if deepest is None else deepest + 1):
        here = edges.filter(F.col("level") == level).select(F.col("node").alias("from"), "label", F.col("near_n").alias("there_n"), "following")
        plain = starts.filter(F.col("level") == level).select("text", "n", "half", "node")
        if states is not None:
            going = states.filter(F.col("near_n").isNull())
            plain = plain.unionByName(going.filter("edits = 0").select("text", "n", "half", "node"))
        met = _going(_unedited(plain, here))
        if states is not None:
            met = met.unionByName(_going(_edited(going.filter("edits = 1"), here)))
        states = stage_table(met, "frontier")
        found = found.unionByName(states.filter(F.col("near_n").isNotNull()).select("text", "n", F.col("node").alias("near"), "near_n"))
    back = F.col("text").startswith(BACKWARDS)
    word, near = (F.when(back, F.reverse(F.expr(f"substr({c}, 2)"))).otherwise(F.expr(f"substr({c}, 2)")).alias(a) for c, a in (("text", "word"), ("near", "near")))
    pairs = found.select(back.alias("back"), word, "n", near, "near_n")
    return pairs.filter("NOT (back AND left(word, length(word) DIV 2) = left(near, length(word) DIV 2))").drop("back")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following forms ends. Every step doubles, and counts at least double along forms."""
    reached = stage_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        further = reached.join(on, F.col("root") == F.col("__word"), "left")
        further = further.select("word", F.coalesce("__root", "root").alias("root"), F.col("__root").isNotNull().alias("moved"))
        further = stage_table(further, "roots")
        reached = further.select("word", "root")
        if further.filter("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per word: word, form, root, n, n_near and form_n.

    A word is a run of Latin letters of five characters or more, as ``slipped``
    reads it, found at least ``least`` times. Its form is the neighbour of
    largest count (of equal ones the smallest in code-point order) if that is
    ``times`` the word's or more, else null; its root is where forms lead, the
    word itself if nowhere. Null and empty texts have no words, a null id reads
    as empty, repeated rows count each, texts and runs of any length are read
    whole. An empty table gives no rows; other columns are not read.
    """
    words = stage_table(word_counts(docs, doc_id, text, least), "words")
    best = neighbours(words).groupBy(F.col("word").alias("__word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    named = words.join(best, F.col("word") == F.col("__word"), "left").withColumn("form_n", -F.col("best.less"))
    chosen = F.col("form_n") >= times * F.col("n")
    named = named.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n")
    )
    named = stage_table(named, "forms")
    ends = roots(named.filter(F.col("form").isNotNull())).withColumnsRenamed({"word": "__word"})
    return named.join(ends, F.col("word") == F.col("__word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
