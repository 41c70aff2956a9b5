import math

import numpy as np
import pytest

from factorfall.llm import pivot_dedup as m

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=m.COSINE):
    """{vec_id: (n_links, component_id)} of (vec_id, vector, label) by all pairs of a label."""
    usable = [
        (i, np.array(v, dtype=float), (label, len(v)))
        for i, v, label in rows
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = {i: set() for i, _, _ in rows}
    for group in {g for _, _, g in usable}:
        members = [(i, v / np.abs(v).max()) for i, v, g in usable if g == group]
        x = np.array([v for _, v in members])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= cosine)):
            if a != b:
                links[members[a][0]].add(members[b][0])
    found = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        found[i] = (len(links[i]), min(seen))
    return found


def result(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}
    assert len(found) == len(rows)
    return found


def families(seed, n, dimensions, copies, low):
    """Vectors in families around a middle, members at cosines from ``low`` to 1 of it."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        middle = m.unit(rng.normal(size=(1, dimensions)))[0]
        for _ in range(copies):
            away = rng.normal(size=dimensions)
            away -= away @ middle * middle
            c = rng.uniform(low, 1)
            rows.append((len(rows), (c * middle + math.sqrt(1 - c * c) * m.unit(away[None])[0]).tolist(), k % 3))
    return rows


def test_whole_table(spark, table):
    vectors = table("embeddings")
    assert result(m.near_vectors(vectors)) == brute([tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()])


@pytest.mark.parametrize("longest", [m.LIST, 16, 4])
def test_any_list_length_gives_the_same(spark, longest):
    """Lists cut by further pivots and compared in blocks; one family is larger than a list may be."""
    rows = families(1, 40, 32, 3, 0.97) + [(1000 + i, v, 7) for i, v, _ in families(2, 1, 32, 60, 0.985)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    rounded = [tuple(r) for r in vectors.collect()]
    assert result(m.near_vectors(vectors, longest=longest)) == brute(rounded)


def test_recall_at_the_limit(spark):
    """Families of cosines around the limit: of all links at 0.93 or more at least 98 % are found, and none below."""
    rows = [tuple(r) for r in spark.createDataFrame(families(3, 400, 64, 2, 0.93), SCHEMA).collect()]
    expected, found = brute(rows), result(m.near_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert all(found[i][0] <= n for i, (n, _) in expected.items())
    assert sum(n for n, _ in found.values()) >= 0.98 * sum(n for n, _ in expected.values()) > 0


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1),
        (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [1e30, 0.0], 1), (11, [1e-30, 0.0], 1), (12, [-1.0, 0.0], 1), (13, [1.0, 0.0, 0.0], 1), (14, [1.0, -0.0], 2), (15, [1.0, 0.0], 2),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'c' AS key", "1 AS n", "2 AS size", "'g' AS root", "0 AS node", "3 AS n_links", "4 AS pivots")
    assert result(m.near_vectors(vectors)) == brute(rows)
    assert m.near_vectors(vectors.limit(0)).collect() == []
    again = spark.createDataFrame([(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 2)], SCHEMA)
    found = sorted(tuple(r) for r in m.near_vectors(again).fillna(-1).collect())
    assert found == [(-1, 0, -1, True), (-1, 2, 5, False), (5, 0, 5, True), (5, 2, 5, True), (5, 2, 5, True)]


def test_copies_of_one_vector(spark):
    rows = [(i, [0.6, 0.8] if i % 3 else [float(i + 1), -1.0], 1) for i in range(300)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert result(m.near_vectors(vectors)) == brute([tuple(r) for r in vectors.collect()])
