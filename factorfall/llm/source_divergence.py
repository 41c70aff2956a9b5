"""Source divergence audit: how far the sources of a language are apart in the terms they use.

Texts are cut into terms by byte, a batch at once: matching expressions row by row cost
two thirds of the query.

Each language keeps the terms that enough of its documents hold (`CountVectorizer`'s
minDF, and its vocabSize at the largest integer, so that no term is cut).
`CountVectorizer.fit` would gather the whole vocabulary in the driver; here it is an
aggregation that stays in a table. The table's size is measured, and one
`CountVectorizerModel` is made for every ``SLICE_BYTES`` of it: nearly always one,
and otherwise as many as it takes, each turning the documents into exact sparse
vectors over its slice. The vectors are added up by (language, source) and entry,
sparse and in whole numbers (`Summarizer.sum` is a mean times a weight, in floating
point and dense). Sources are compared pair by pair in cells of some sources and
some terms: a cell corrects what the pair would differ by if neither had any term.

All amounts are whole numbers: a term's share is 1 + floor(10^9 (n + 5) / (N + 5 V)).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factorfall.llm.common import raw_text, small_batches
from factorfall.session import stage_table

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
# By byte: its lower case, 0 between terms. All bytes of a character beyond ASCII belong to terms.
_LOWER = np.zeros(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] = _LOWER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LOWER[0x80:] = np.arange(0x80, 0x100)
# Texts cut into terms at once.
PIECE_BYTES = 4 << 20
# Of rows handed to a Python worker at once, where a task has one worker and where it has two. The
# JVM and the workers hold several batches of a task, and the workers many times a batch in arrays.
COUNT_BATCH_BYTES = 4 << 20
SUM_BATCH_BYTES = 1 << 20
MIN_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP_TERMS = 50
# Of vocabulary in one model, on the driver and in each executor; an entry is its text and some 64 bytes.
SLICE_BYTES = 64 << 20
# Sums held by one task before it hands them on.
HELD_SUMS = 500_000
# Sources and terms of a cell, on average.
CELL_SOURCES = 64
CELL_TERMS = 512


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, cut where their texts exceed ``PIECE_BYTES``; a longer text is a piece of its own."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("raw")).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def terms_of(raw: pa.Array) -> pa.ListArray:
    """The terms of each text (UTF-8 bytes), in order and repeated, as ``TERM`` matches them."""
    raw = raw.cast(pa.large_binary())
    rows = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    held = raw.buffers()[2]
    low = _LOWER[np.frombuffer(held, dtype=np.uint8)[rows[0] : rows[-1]]] if held else _LOWER[:0]
    rows = rows - rows[0]
    inside = low != 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    firsts = rows[:-1][rows[:-1] < len(low)]
    start[firsts] = inside[firsts]
    ends = np.searchsorted(np.flatnonzero(start), rows).astype(np.int32)
    kept = low[inside]
    cuts = np.append(np.flatnonzero(start[inside]), len(kept)).astype(np.int32)
    flat = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(kept))
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in _pieces(batches):
        columns = [piece.column("lang"), piece.column("source"), terms_of(piece.column("raw"))]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "terms"])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): how many texts of a piece hold the term."""
    for piece in _pieces(batches):
        terms = terms_of(piece.column("raw"))
        if not len(terms.values):
            continue
        coded, langs = terms.values.dictionary_encode(), piece.column("lang").dictionary_encode()
        size = len(coded.dictionary)
        text = np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy()))
        text, code = np.divmod(np.unique(text * size + coded.indices.to_numpy()), size)
        key, n = np.unique(langs.indices.to_numpy()[text].astype(np.int64) * size + code, return_counts=True)
        lang, code = np.divmod(key, size)
        columns = [langs.dictionary.take(pa.array(lang)), coded.dictionary.take(pa.array(code)), pa.array(n)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "term", "n"])


def document_texts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source and raw (UTF-8) of every row; nulls read as empty."""
    names = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    return docs.select(*names, raw_text(docs, text).alias("raw"))


def document_terms(texts: DataFrame) -> DataFrame:
    """lang, source and the terms of every row, in order and repeated."""
    return texts.mapInArrow(_term_batches, "lang string, source string, terms array<string>")


def vocabulary(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) held by at least ``min_docs`` documents of the language."""
    held = texts.select("lang", "raw").mapInArrow(_document_counts, "lang string, term string, n long")
    return held.groupBy("lang", "term").agg(F.sum("n").alias("n_docs")).filter(F.col("n_docs") >= min_docs).drop("n_docs")


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of sparse vectors (lang, source, vector) by group and entry."""
    groups: dict[tuple[str, str], int] = {}
    keys, counts, held = [], [], 0

    def summed() -> tuple[np.ndarray, np.ndarray]:
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), dtype=np.int64)
        np.add.at(total, inverse, np.concatenate(counts))
        return key, total

    def rows() -> pa.RecordBatch:
        key, total = summed()
        names = list(groups)
        at = key >> 32
        columns = [pa.array([names[g][i] for g in at], pa.string()) for i in range(2)]
        columns += [pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(total)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "at", "n"])

    for batch in batches:
        vector = batch.column("vector")
        indices, values = vector.field("indices"), vector.field("values")
        lengths = np.diff(indices.offsets.to_numpy())
        names = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        group = np.fromiter((groups.setdefault(g, len(groups)) for g in names), dtype=np.int64, count=batch.num_rows)
        keys.append(np.repeat(group, lengths) << 32 | indices.flatten().to_numpy().astype(np.int64))
        counts.append(values.flatten().to_numpy().astype(np.int64))
        held += len(keys[-1])
        if held > HELD_SUMS:
            key, total = summed()
            if len(key) > HELD_SUMS // 2:
                keys, counts = [key], [total]
                yield rows()
                key, total, groups = key[:0], total[:0], {}
            keys, counts, held = [key], [total], len(key)
    if held:
        yield rows()


def group_sums(terms: DataFrame, kept: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(lang, source, term, n) of the kept terms that a group holds; ``kept`` is a staged vocabulary."""
    spark = terms.sparkSession
    size = kept.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    slices = -(-size // slice_bytes)
    found = spark.createDataFrame([], "lang string, source string, term string, n long")
    for i in range(slices):
        mine = kept.filter(F.pmod(F.xxhash64("term"), F.lit(slices)) == i).select("term").distinct()
        words = [r["term"] for r in mine.collect()]
        if not words:
            continue
        model = CountVectorizerModel.from_vocabulary(words, inputCol="terms", outputCol="vector")
        entries = pa.table({"__at": pa.array(range(len(words)), pa.int32()), "term": pa.array(words, pa.string())})
        entries = stage_table(spark.createDataFrame(entries), "vocabulary-slice")
        sums = model.transform(terms).select("lang", "source", "vector")
        sums = sums.mapInArrow(_sum_batches, "lang string, source string, at int, n long")
        sums = sums.groupBy("lang", "source", "at").agg(F.sum("n").alias("n"))
        named = sums.join(entries, F.col("at") == F.col("__at")).select("lang", "source", "term", "n")
        found = found.unionByName(named)
    # A term that another language keeps is in the model as well.
    return found.join(kept, ["lang", "term"], "left_semi").select("lang", "source", "term", "n")


def _share(n: str | Column, total: str, size: str) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 size)), exact for any counts; null where nothing is kept."""
    n = F.col(n) if isinstance(n, str) else n
    above = (n.cast("decimal(19,0)") + F.lit(PRIOR).cast("decimal(19,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    below = F.nullif(F.col(total) + PRIOR * F.col(size), F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell, a cell's sources (without a term) first and by name; one cell is held at a time."""
    cell, sources, entries = None, [], []

    def pairs() -> pa.RecordBatch:
        lang, _, left, right = cell
        row = {s: i for i, (s, _, _) in enumerate(sources)}
        base = np.array([b for _, _, b in sources], dtype=np.int64)
        column: dict[str, int] = {}
        at = [(row[s], column.setdefault(t, len(column)), p) for s, t, p in entries]
        shares = np.repeat(base[:, None], len(column), axis=1)
        if at:
            i, j, p = (np.array(x) for x in zip(*at))
            shares[i, j] = p
        blocks = np.array([b for _, b, _ in sources])
        nth = np.arange(len(sources))
        found: tuple[list, list, list] = ([], [], [])
        for i, (name, block, mine) in enumerate(sources):
            # Within a block each pair once; between blocks only pairs across.
            others = nth[i + 1 :] if left == right else nth[blocks == right] if block == left else nth[:0]
            if len(others):
                more = np.abs(shares[others] - shares[i]).sum(axis=1) - len(column) * np.abs(base[others] - mine)
                found[0].extend([name] * len(others))
                found[1].extend(sources[o][0] for o in others)
                found[2].extend(more.tolist())
        columns = [pa.array([lang] * len(found[0]), pa.string()), pa.array(found[0], pa.string()), pa.array(found[1], pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found[2], pa.int64())], names=["lang", "source", "item", "more"])

    names = ("lang", "terms", "left", "right", "source", "block", "term", "share")
    for batch in batches:
        for *key, source, block, term, share in zip(*[batch.column(c).to_pylist() for c in names]):
            if key != cell:
                if cell:
                    yield pairs()
                cell, sources, entries = key, [], []
            if term is None:
                sources.append((source, block, share))
            else:
                entries.append((source, term, share))
    if cell:
        yield pairs()


def _cells(rows: DataFrame) -> DataFrame:
    """Every row in the cells of its block with each block; needs block, blocks and terms."""
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return other.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")})


def source_pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language.

    ``groups`` has lang, source, total and size (of the vocabulary), ``shares``
    lang, source, term and p of the terms that the group holds.
    """
    based = groups.withColumn("base", F.coalesce(_share(F.lit(0), "total", "size"), F.lit(0)))
    counted = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    based = based.join(counted, "lang").withColumns(
        {
            "blocks": F.ceil(F.col("n_sources") / CELL_SOURCES),
            "term_blocks": F.greatest(F.lit(1), F.ceil(F.col("size") / CELL_TERMS)),
        }
    )
    based = stage_table(based.withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))), "divergence-bases")
    every = based.withColumn("terms", F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)))
    held = shares.join(based.select("lang", "source", "block", "blocks", "term_blocks"), ["lang", "source"])
    held = held.withColumn("terms", F.pmod(F.xxhash64("term"), F.col("term_blocks")))
    key = ["lang", "terms", "left", "right"]
    columns = [*key, "source", "block", "term", "share"]
    sources = _cells(every.withColumns({"term": F.lit(None).cast("string"), "share": F.col("base")})).select(*columns)
    entries = _cells(held.withColumn("share", F.col("p"))).select(*columns)
    cells = sources.unionByName(entries).repartition(*key).sortWithinPartitions(*key, F.col("term").asc_nulls_first(), "source")
    parts = cells.mapInArrow(_pair_batches, "lang string, source string, item string, more long")
    more = parts.groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))
    mine = based.select("lang", "source", "size", "base")
    other = based.select("lang", F.col("source").alias("item"), F.col("base").alias("other"))
    pairs = more.join(mine, ["lang", "source"]).join(other, ["lang", "item"]).select(
        "lang", "source", "item", (F.col("more") + F.col("size") * F.abs(F.col("base") - F.col("other"))).alias("value")
    )
    pairs = stage_table(pairs, "divergence-pairs")
    return pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """lang, source, part, item, value and rank: the other sources of the language by distance, and the terms a source has too many of.

    Part ``pair`` has every other source of the language, by the sum of the
    absolute differences of the shares of all kept terms; part ``term`` the
    ``top_terms`` terms whose share exceeds the language's most. Ranks go by
    value, then by item in UTF-8 order, so ties have one order. Null text, lang
    and source read as empty; a group without terms has the shares of zero
    counts; a language that keeps no term has pairs of value 0. Repeated rows
    count each. Whole texts are read. An empty table gives no rows; other
    columns are not read.
    """
    texts = document_texts(docs, text, lang, source)
    with small_batches(docs.sparkSession, COUNT_BATCH_BYTES):
        kept = stage_table(vocabulary(texts, min_docs), "divergence-vocabulary")
    with small_batches(docs.sparkSession, SUM_BATCH_BYTES):
        counts = stage_table(group_sums(document_terms(texts), kept, slice_bytes), "divergence-counts")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("size"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = stage_table(groups.na.fill(0, ["total", "size"]), "divergence-groups")
    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", _share("n", "total", "size").alias("p"))
    shares = stage_table(shares, "divergence-shares")

    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("size").alias("size"))
    common = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(whole, "lang")
    common = common.select("lang", "term", _share("n", "total", "size").alias("q"))
    over = shares.join(common, ["lang", "term"]).filter("p > q")
    over = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    pairs = source_pairs(groups, shares).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    ordered = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = over.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(ordered)).unionByName(over)
