"""Near-duplicate vectors of a label, found with a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest of at most ``PIVOTS`` reference
directions, nearest first. Every (label, pivot) has an inverted list of the vectors that have it
in their description. Two vectors are candidates when they share ``SHARED`` pivots
or more; they meet in the list of the first of these, in pivot order, and are
verified there by their cosine in double precision. A list of more than ``LIST``
vectors is cut by a second and then a third pivot; one that is still longer is
compared block by block. So no list is held whole, no pair is left out for a list's
size and none is looked at twice. A list hands on, for each vector, the number of
its links and the smallest vector of its connected part, never the pairs.

The reference directions come from a sample of ``SAMPLE`` vectors, those of smallest
hash, passing over ones close to a direction already chosen; missing ones are random.
Where few dimensions leave no room for so many, there are fewer. All vectors are
indexed. By simulation a pair at a cosine of 0.93 shares three of eight pivots in 99 %
of cases (2 to 256 dimensions, even directions; 95 % around a common mean), one at 0.98
practically always, and unlike vectors of 64 dimensions in 0.3 %.

Equal vectors of a label enter the index once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall.llm.simhash_bktree import components
from factorfall.session import stage_table

COSINE = 0.93
PIVOTS, NEAREST, SHARED = 256, 8, 3
SAMPLE = 4096
LIST = 2048
SEED = 42
# Two directions are not closer than this.
APART = 0.75
_WORDS = PIVOTS // 64
_ROWS_AT_ONCE = 256


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def reference_directions(sample: np.ndarray, dimensions: int) -> np.ndarray:
    """At most ``PIVOTS`` directions that are apart, from the sample's vectors in order, then at random; ``NEAREST`` at least."""
    chosen, n = np.empty((PIVOTS, dimensions)), 0
    anywhere = unit(np.random.default_rng(SEED).normal(size=(8 * PIVOTS, dimensions)))
    for vector in np.concatenate([unit(sample), anywhere]) if len(sample) else anywhere:
        if n < PIVOTS and (n == 0 or (chosen[:n] @ vector).max() < APART):
            chosen[n] = vector
            n += 1
    more = max(NEAREST - n, 0)
    chosen[n : n + more] = anywhere[:more]
    return chosen[: n + more]


def describe(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The nearest pivots of each row, nearest first; of equally near ones the first."""
    return np.argsort(-(unit(vectors) @ directions.T), axis=1, kind="stable")[:, :NEAREST]


def _matrix(column: pa.ListArray, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dimensions)


def _describe_batches(batches: Iterator[pa.RecordBatch], fitted: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    known = dict(fitted)
    for batch in batches:
        sizes = np.array(batch.column("size"))
        for size in np.unique(sizes).tolist():
            part = batch.filter(pa.array(sizes == size))
            if size not in known:
                known[size] = reference_directions(np.empty((0, size)), size)
            for at in range(0, part.num_rows, 4096):
                rows = part.slice(at, 4096)
                found = np.sort(describe(_matrix(rows.column("vector"), size), known[size]), axis=1).astype(np.int32)
                pivots = pa.ListArray.from_arrays(np.arange(0, found.size + 1, NEAREST, dtype=np.int32), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([rows.column(c) for c in ("key", "group", "n")] + [pivots], names=["key", "group", "n", "pivots"])


def _masks(pivots: np.ndarray) -> np.ndarray:
    """Descriptions as bits, ``_WORDS`` words a row."""
    masks = np.zeros((len(pivots), _WORDS), dtype=np.uint64)
    for at in range(pivots.shape[1]):
        np.bitwise_or.at(masks, (np.arange(len(pivots)), pivots[:, at] >> 6), np.uint64(1) << (pivots[:, at] & 63).astype(np.uint64))
    return masks


def _firsts(shared: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Of which rows of shared pivots the pivots of ``head`` are the first, with ``SHARED`` or more in all."""
    up_to = np.zeros(_WORDS, dtype=np.uint64)
    last = int(head[-1])
    up_to[: last >> 6] = ~np.uint64(0)
    up_to[last >> 6] = np.uint64((2 << (last & 63)) - 1 & 0xFFFFFFFFFFFFFFFF)
    mine = _masks(head[None, :])[0]
    return ((shared & up_to) == mine).all(axis=1) & (np.bitwise_count(shared).sum(axis=1) >= SHARED)


def list_links(vectors: np.ndarray, pivots: np.ndarray, weights: np.ndarray, sides: np.ndarray, head: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, part) of the members of a list: linked vectors by weight, and the first member of the connected part.

    ``head`` holds the list's pivots. Members of side 0 and 1 are two blocks,
    compared with each other only; a list in one piece has side 2 throughout.
    """
    units, masks = unit(vectors), _masks(pivots)
    links, part = np.zeros(len(vectors), dtype=np.int64), np.arange(len(vectors))
    left = np.flatnonzero(sides != 1)
    right = np.flatnonzero(sides != 0)
    for at in range(0, len(left), _ROWS_AT_ONCE):
        rows = left[at : at + _ROWS_AT_ONCE]
        a, b = np.nonzero(units[rows] @ units[right].T >= cosine - 1e-9)
        a, b = rows[a], right[b]
        if len(sides) and sides[0] == 2:
            a, b = a[a < b], b[a < b]
        # The product's last digits depend on the block; the pair's own sum decides near the limit.
        exact = np.einsum("ij,ij->i", units[a], units[b]) >= cosine
        a, b = a[exact], b[exact]
        first = _firsts(masks[a] & masks[b], head)
        a, b = a[first], b[first]
        np.add.at(links, a, weights[b])
        np.add.at(links, b, weights[a])
        found, starts = np.unique(a, return_index=True)
        for row, others in zip(found, np.split(b, starts[1:])):
            names = np.unique(part[np.append(others, row)])
            if len(names) > 1:
                part[np.isin(part, names)] = names[0]
    return links, part


def _link_batches(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by list and blocks; one list or pair of blocks is held at a time."""
    held, rows = None, []

    def linked() -> pa.RecordBatch:
        members = pa.Table.from_batches(rows)
        heads = np.array(members.column("head")[0].as_py())
        size = members.column("size")[0].as_py()
        keys = np.array(members.column("key"))
        pivots = members.column("pivots").combine_chunks().flatten().to_numpy().reshape(-1, NEAREST)
        links, part = list_links(
            _matrix(members.column("vector").combine_chunks(), size), pivots, np.array(members.column("n")), np.array(members.column("side")), heads, cosine
        )
        some = links > 0
        least = {}
        for name, key in zip(part[some].tolist(), keys[some].tolist()):
            least[name] = min(key, least.get(name, key))
        roots = np.array([least[name] for name in part[some].tolist()], dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(roots), pa.array(links[some])], names=["a", "b", "links"])

    for batch in batches:
        lists = list(zip(*[batch.column(c).to_pylist() for c in ("list", "left", "right")]))
        at = 0
        while at < len(lists):
            end = at
            while end < len(lists) and lists[end] == lists[at]:
                end += 1
            if lists[at] != held:
                if held is not None:
                    yield linked()
                held, rows = lists[at], []
            rows.append(batch.slice(at, end - at))
            at = end
    if held is not None:
        yield linked()


def links(vectors: DataFrame, cosine: float = COSINE, longest: int = LIST) -> DataFrame:
    """(a, b, links) for distinct ``vectors`` (key, group, size, vector, n) that share a list with a linked one.

    b is the smallest key of a's connected part in that list, links the linked
    vectors found there, by ``n``.
    """
    spark = vectors.sparkSession
    sample = vectors.select("size", "vector", F.xxhash64("key", F.lit(SEED)).alias("at")).orderBy("at").limit(SAMPLE).collect()
    fitted = {}
    for size in sorted({r["size"] for r in sample}):
        fitted[size] = reference_directions(np.array([r["vector"] for r in sample if r["size"] == size], dtype=float), size)
    described = vectors.mapInArrow(lambda b: _describe_batches(b, fitted), "key long, group long, n long, pivots array<int>")
    described = stage_table(described, "descriptions")
    # A list of t pivots holds what can share SHARED: as many pivots must follow.
    last = NEAREST - SHARED + 1
    members = described.select("key", "group", "n", "pivots", F.posexplode(F.slice("pivots", 1, last)).alias("at", "pivot"))
    members = members.select("key", "group", "n", "pivots", "at", F.array("pivot").alias("head"))
    found = spark.createDataFrame([], "a long, b long, links long")
    for depth in range(1, SHARED + 1):
        sizes = members.groupBy("group", "head").agg(F.count("*").alias("members")).filter("members > 1")
        rows = stage_table(members.join(sizes, ["group", "head"]), "pivot-lists")
        chosen = rows if depth == SHARED else rows.filter(F.col("members") <= longest)
        blocks = F.ceil(F.col("members") / F.lit(longest // 2))
        chosen = chosen.withColumn("blocks", F.when(F.col("members") <= longest, F.lit(1)).otherwise(blocks).cast("int"))
        chosen = chosen.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        chosen = chosen.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        chosen = chosen.withColumns(
            {
                "left": F.least("block", "other"),
                "right": F.greatest("block", "other"),
                "side": F.when(F.col("block") == F.col("other"), 2).otherwise((F.col("block") > F.col("other")).cast("int")),
                "list": F.xxhash64("group", "head"),
            }
        )
        chosen = chosen.drop("group").join(vectors.select("key", "size", "vector"), "key")
        chosen = chosen.repartition("list", "left", "right").sortWithinPartitions("list", "left", "right", "key")
        chosen = chosen.select("list", "left", "right", "side", "key", "n", "head", "pivots", "size", "vector")
        found = found.unionByName(chosen.mapInArrow(lambda b: _link_batches(b, cosine), "a long, b long, links long"))
        if depth == SHARED:
            break
        longer = rows.filter(F.col("members") > longest)
        if longer.isEmpty():
            break
        longer = longer.withColumn("then", F.explode(F.sequence(F.col("at") + 1, F.lit(NEAREST - SHARED + depth))))
        members = longer.select(
            "key", "group", "n", "pivots", F.col("then").alias("at"), F.concat("head", F.array(F.col("pivots")[F.col("then")])).alias("head")
        )
    return found


def near_vectors(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, longest: int = LIST
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id and kept.

    n_links is the number of other rows linked directly, component_id the
    smallest vec_id that links reach, the row's own included, and kept says
    that this is the row's own. Linked are rows of an equal, not null label
    whose vectors have as many components and a cosine of ``cosine`` or more.
    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing. Repeated rows and equal vectors link with each other; a
    null vec_id names no component unless all its ids are null, and is kept
    then only. An empty table gives no rows; other columns are not read.
    """
    usable = F.col("label").isNotNull() & F.exists("vector", lambda x: x != 0)
    usable &= F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    every = rows.select(rows[vec_id].cast("long").alias("vec_id"), rows[label].alias("label"), rows[vector].cast("array<double>").alias("vector"))
    every = every.withColumn("key", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "vector")))
    keyed = every.filter(F.col("key").isNotNull())
    distinct = keyed.groupBy("key").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    distinct = distinct.select("key", "first_id", "n", F.size("vector").alias("size"), F.xxhash64("label", F.size("vector")).alias("group"), "vector")
    distinct = stage_table(distinct, "distinct-vectors")
    found = stage_table(links(distinct.select("key", "group", "size", "vector", "n"), cosine, longest), "vector-links")
    parts = components(found.select("a", "b"))
    linked = found.groupBy(F.col("a").alias("__a")).agg(F.sum("links").alias("links"))
    named = distinct.select("key", "first_id", "n").join(linked, F.col("key") == F.col("__a"), "left").join(parts, F.col("key") == F.col("node"), "left")
    named = stage_table(named.select("key", "first_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "key").alias("root")), "named-vectors")
    first = named.groupBy(F.col("root").alias("__root")).agg(F.min("first_id").alias("component_id"))
    by_key = named.join(first, F.col("root") == F.col("__root")).select(F.col("key").alias("__key"), "n_links", "component_id")
    out = every.select("vec_id", "key").join(by_key, F.col("key") == F.col("__key"), "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
