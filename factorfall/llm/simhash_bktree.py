"""SimHash near-duplicates found with BK-trees.

Fingerprints that differ in at most two of 64 bits agree on one of any three
blocks the bits are cut into. So a fingerprint goes to three shards, one for
each block value, and every linked pair meets in one of them. A shard with more
than ``SHARD`` members is cut again by its remaining bits, in three blocks each
time, until the shard is small enough: the bits that are left bound the number
of distinct fingerprints, so this ends after at most six cuts however the
fingerprints are spread. In each shard a BK-tree, children keyed by
their Hamming distance to the parent, is filled one fingerprint at a time; each
one first follows the edges within the radius to find its links. A shard gives
its connected parts as stars, never all pairs.

Copies share a fingerprint, which enters the trees once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorfall.llm.common import broadcast_if_small, raw_text
from factorfall.session import stage_table

RADIUS = 2
SHINGLE = 3
SEED = 42
# Members of one shard, and so of one tree.
SHARD = 2048
HASHED_AT_ONCE = 65_536


def fingerprint(raw: bytes) -> int:
    """Signed 64-bit SimHash of one text; 0 when it has no words."""
    words = raw.lower().split()  # bytes: A-Z only
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)])))
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), HASHED_AT_ONCE):
        part = shingles[at : at + HASHED_AT_ONCE]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in part), dtype="<u8", count=len(part))
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(shingles), bitorder="little").view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(raw.as_py()) for raw in batch.column("raw")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp of every row."""
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), raw_text(docs, text).alias("raw"))
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, fp long")


class BKTree:
    """Distinct integers under Hamming distance."""

    def __init__(self) -> None:
        self.root: list | None = None  # [value, {distance: child}]

    def link(self, value: int, radius: int = RADIUS) -> list[int]:
        """Members within the radius of ``value``, which then becomes a member."""
        if self.root is None:
            self.root = [value, {}]
            return []
        near, open_nodes = [], [self.root]
        while open_nodes:
            member, children = open_nodes.pop()
            distance = (member ^ value).bit_count()
            if distance <= radius:
                near.append(member)
            for edge in range(max(distance - radius, 1), distance + radius + 1):
                if edge in children:
                    open_nodes.append(children[edge])
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            if distance == 0:
                return near
            if distance not in node[1]:
                node[1][distance] = [value, {}]
                return near
            node = node[1][distance]


def shard_stars(values: Iterable[int]) -> list[tuple[int, int]]:
    """(value, smallest value of its connected part) for members that are not the smallest.

    Values are signed; distances are taken on their 64 bits.
    """
    tree, parent = BKTree(), {}

    def top(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for value in values:
        parent[value] = value
        for other in tree.link(value & 0xFFFFFFFFFFFFFFFF):
            a, b = top(value), top(other - (1 << 64) if other >> 63 else other)
            parent[max(a, b)] = min(a, b)
    return [(v, top(v)) for v in parent if top(v) != v]


def _star_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; one shard is held at a time."""
    shard, members = None, []

    def stars(values: list[int]) -> pa.RecordBatch:
        pairs = shard_stars(values)
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in range(2)], names=["a", "b"]
        )

    for batch in batches:
        for key in zip(*[batch.column(c).to_pylist() for c in ("mask", "value", "fp")]):
            if key[:2] != shard:
                if len(members) > 1:
                    yield stars(members)
                shard, members = key[:2], []
            members.append(key[2])
    if len(members) > 1:
        yield stars(members)


def _cut(bits: list[int]) -> list[int]:
    """Three masks that share out the bits."""
    size, rest = divmod(len(bits), 3)
    ends = [0, size, 2 * size + (rest > 1), len(bits)]
    return [sum(1 << b for b in bits[ends[i] : ends[i + 1]]) for i in range(3)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(fps: DataFrame, shard: int = SHARD) -> DataFrame:
    """Star edges (a, b), b < a, whose connected parts are those of all links between distinct ``fp``."""
    spark = fps.sparkSession
    members = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    masks, found = [0], spark.createDataFrame([], "a long, b long")
    while True:
        cuts = {m: [m | c for c in _cut([b for b in range(64) if not m >> b & 1])] for m in masks}
        children = F.create_map(
            *[x for m, c in cuts.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in c]))]
        )
        members = members.select("fp", F.explode(children[F.col("mask")]).alias("mask"))
        members = members.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = members.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1")
        # Shards of one member drop out here; a hot shard's rows are split by adaptive execution.
        rows = stage_table(members.join(sizes, ["mask", "value"]).select("fp", "mask", "value", "n"), "shards")
        small = rows.filter(F.col("n") <= shard).repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
        found = found.unionByName(small.select("mask", "value", "fp").mapInArrow(_star_batches, "a long, b long"))
        members = rows.filter(F.col("n") > shard).select("fp", "mask")
        # Three masks at first, and three for each that has a hot shard: few, as cuts are.
        masks = [r["mask"] & (1 << 64) - 1 for r in members.select("mask").distinct().collect()]
        if not masks:
            return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected part, for every node of ``edges`` (a, b).

    Alternating large-star and small-star steps. Both are joins with the
    minimum of a node's neighbours, so a node with very many neighbours is
    aggregated map-side first and its rows may be split in the join.
    """
    edges = stage_table(edges.select("a", "b").filter("a != b").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low)
        edges = stage_table(small.filter("a != b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        seen = now


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, fingerprint (hex) and component_id.

    component_id is the smallest doc_id that links reach, the document's own
    included. Null and empty texts have fingerprint 0 and link like any other.
    Repeated rows give repeated rows; a null doc_id never names a component
    unless all its ids are null. An empty table gives no rows. Other columns
    are not read.
    """
    prints = stage_table(fingerprints(docs, doc_id, text), "fingerprints")
    distinct = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    parts = components(links(distinct.select("fp")))
    rooted = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stage_table(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Only fingerprints outside singleton parts can be renamed, but all get a row: one join for all.
    by_fp = rooted.join(named, "root").select(F.col("fp").alias("__fp"), "component_id")
    return prints.join(by_fp, prints["fp"] == F.col("__fp")).select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, the one whose id names it; all columns.

    Rows without an id stay. Where several rows carry the id that names a
    component, the smallest of them by text, then by the other columns, stays.
    """
    found = near_duplicates(docs, doc_id, text).filter(F.col("doc_id").isNotNull())
    found = stage_table(found.groupBy("doc_id", "component_id").agg(F.count("*").alias("n")), "components")
    per_id = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.sum("n").alias("n"))
    marks = stage_table(per_id.filter("doc_id != component_id OR n > 1"), "marks")
    gone = marks.filter("doc_id != component_id").select(F.col("doc_id").alias("__id"))
    again = marks.filter("doc_id = component_id").select(F.col("doc_id").alias("__id"))
    mine = docs[doc_id].cast("long") == F.col("__id")
    left = docs.join(broadcast_if_small(gone, 8), mine, "left_anti")
    if again.isEmpty():
        return left
    again = broadcast_if_small(again, 8)
    others = [c for c in docs.columns if c not in (doc_id, text)]
    one = left.join(again, mine, "left_semi").groupBy(doc_id).agg(F.min(F.struct(text, *others)).alias("__row"))
    one = one.select(*[c if c == doc_id else F.col("__row")[c].alias(c) for c in docs.columns])
    return left.join(again, mine, "left_anti").unionByName(one)
