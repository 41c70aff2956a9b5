import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from factorfall.llm import simhash_bktree as m


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{id: component} from (id, fingerprint) rows, all pairs."""
    parent = {f: f for _, f in prints}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= 2:
            parent[top(a)] = top(b)
    first = {}
    for i, f in prints:
        first[top(f)] = min(first.get(top(f), i), i)
    return {i: first[top(f)] for i, f in prints}


def test_fingerprint_equals_the_engine_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert row["h"] & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    expected, prints = plain_components(rows), dict(rows)
    found = m.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == expected[r["doc_id"]]


@pytest.mark.parametrize("shard", [64, 2048])
def test_dense_shards_are_cut_without_losing_links(spark, shard):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {base}
    for _ in range(400):  # a crowd within a few bits of each other
        v = base
        for b in rng.sample(range(64), rng.randint(0, 5)):
            v ^= 1 << b
        values.add(v)
    values |= {rng.getrandbits(64) for _ in range(100)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["node"]: r["root"] for r in m.components(m.links(fps, shard)).collect()}
    expected = plain_components([(v, v & (1 << 64) - 1) for v in signed])
    by_part, by_plain = {}, {}
    for v in signed:
        by_part.setdefault(roots.get(v, v), set()).add(v)
        by_plain.setdefault(expected[v], set()).add(v)
    assert sorted(map(sorted, by_part.values())) == sorted(map(sorted, by_plain.values()))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)], "a long, b long")
    assert {r["root"] for r in m.components(edges).collect()} == {0}


def test_odd_rows(spark, odd_docs):
    found = [(r["doc_id"], r["component_id"], r["fingerprint"]) for r in m.near_duplicates(odd_docs).collect()]
    assert len(found) == 8
    assert {c for i, c, f in found if f == "0" * 16} == {2}  # null, empty and blank texts
    kept = m.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 4, 7]


def test_empty(spark, odd_docs):
    none = odd_docs.filter("1 = 0")
    assert m.near_duplicates(none).count() == 0
    assert m.keep_one(none).count() == 0
