
import numpy as np
import pytest
import zlib

from factorfall.llm import toxicity as m


def test_label_model_recovers_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.15
    rates = [(0.02, 0.6), (0.01, 0.4), (0.05, 0.5), (0.02, 0.3), (0.03, 0.5), (0.01, 0.45)]
    votes = np.stack([rng.random(6000) < np.where(y, b, a) for a, b in rates], axis=1).astype(float)
    votes = np.hstack([votes, votes[:, :1], votes[:, :1]])  # the first voter three times
    posterior, estimates = m.label_model(votes)
    assert ((posterior > 0.5) == y).mean() > 0.93
    for j, (a, b) in enumerate(rates):
        assert abs(estimates["rates"][0, j] - a) < 0.05 and abs(estimates["rates"][1, j] - b) < 0.15
    assert estimates["weight"][0] < 0.5 < estimates["weight"][1]
    assert estimates["correlation"][0, 6] > 0.9


def test_linear_classifier_fits_soft_targets():
    rng = np.random.default_rng(1)
    votes = (rng.random((3000, 6)) < 0.3).astype(float)
    target = 1 / (1 + np.exp(-(votes @ np.array([3, 2, 0, -1, 4, 0]) - 2)))
    w = m.linear_classifier(votes, target, 1e-3)
    assert np.allclose(w, [3, 2, 0, -1, 4, 0, -2], atol=0.05)


def test_held_out_rows(spark, table):
    found = m.toxicity(table("documents"), table("labels")).collect()
    assert len(found) == table("documents").count()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)


@pytest.fixture(scope="module")
def larger(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    found = m.toxicity(read("documents"), read("labels"))
    return found.join(read("labels"), "doc_id").filter("held_out").select("predicted", "toxic", "score").collect()


def test_held_out_accuracy(larger):
    tp = sum(r["predicted"] and r["toxic"] for r in larger)
    fp = sum(r["predicted"] and not r["toxic"] for r in larger)
    fn = sum(not r["predicted"] and r["toxic"] for r in larger)
    assert tp / (tp + fp) > 0.95 and tp / (tp + fn) > 0.78, (tp, fp, fn)


def test_labels_of_the_held_out_part_have_no_influence(spark, table):
    docs, labels = table("documents"), table("labels")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    score = lambda x: sorted((r["doc_id"], round(r["score"], 9)) for r in m.toxicity(docs, x).collect())
    assert score(labels) == score(flipped)


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (4, 0)], "doc_id long, toxic int").selectExpr("*", "'x' AS text", "1 AS raw")
    assert m.toxicity(odd_docs, labels).count() == 8
    assert m.toxicity(odd_docs, labels.filter("1 = 0")).count() == 8
    assert m.toxicity(odd_docs.filter("1 = 0"), labels).count() == 0
    kept = m.without_toxic(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == 8


def test_voters_fire_on_words_and_beginnings():
    voters = m.Voters([b"=idiot", b"^clow", "^ré".encode()])
    assert voters.fired("An IDIOT! clowns; réou".encode()) == [0, 1, 2]
    assert voters.fired(b"idiots clow r") == []
    assert voters.fired(b"") == []


def test_share_of_lexicon_words_votes():
    voters = m.Voters([b"=idiot", b"^clow"])
    first = len(voters.terms) + len(m.PATTERNS)
    shares, distinct = len(m.SHARES), len(m.DISTINCT)
    assert voters.votes(b"idiot " + b"x " * 9) == [0, *range(first, first + shares)]
    assert voters.votes(b"idiot " + b"x " * 999) == [0]
    many = voters.votes(b"idiot clown clowns clowning clowned " + b"x " * 99_995)
    assert many == [0, 1, *range(first + shares, first + shares + distinct)]
    assert voters.votes(b"") == [] and voters.votes(b"ordinary words") == []


def test_nested_terms_speak_once(spark):
    toxic = [(f"grumf{c} and so on", 1) for c in "abcdefgh"]
    clean = [(f"grum and {c} so on", 0) for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = spark.createDataFrame(toxic + clean, "text string, toxic int").selectExpr("CAST(text AS BINARY) AS raw", "toxic")
    assert m.lexicon(rows) == [b"^grumf"]


def test_long_words_are_terms_and_fire(spark):
    for word in ("grumf" * 12, "дурак" * 5):
        toxic = [(f"{word} {c} {c}q and on", 1) for c in "abcdefgh"]
        clean = [(f"{word[:8]} and {c} so on", 0) for c in "abcdefghijklmnopqrstuvwxyz"]
        rows = spark.createDataFrame(toxic + clean, "text string, toxic int").selectExpr("CAST(text AS BINARY) AS raw", "toxic")
        chosen = m.lexicon(rows)
        assert b"=" + word.encode() in chosen
        assert m.Voters(chosen).fired(word.encode()) == [chosen.index(b"=" + word.encode())]


def test_terms_come_from_all_labelled_rows(spark):
    """One labelled row makes the votes; the lexicon still knows the others."""
    rows = [(i, f"grumf {i} and {i}x words" if i % 4 == 0 else f"plain {i} and {i}y words") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 4 = 0 AS INT) AS toxic")
    assert b"=grumf" in m.fit(docs, labels, fit_rows=1)[0].terms


def test_votes_and_scores_by_hand():
    """Scores of the batches against votes found by plain looking and weights added up."""
    import pyarrow as pa

    voters = m.Voters([b"=idiot", b"^clow"])
    weights = np.linspace(-1, 2, voters.size + 1)
    texts = [b"", b"idiot", b"a clown, an IDIOT and idiots", b"clow", b"x " * 500 + b"idiot"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts)], names=["doc_id", "raw"])
    found = [s for b in m._score_batches(iter([batch]), voters, weights) for s in b.column("score").to_pylist()]
    for raw, score in zip(texts, found):
        tokens = "".join(c if c.isalpha() else " " for c in raw.decode().lower()).split()
        hit = [t for t in tokens if t == "idiot" or t.startswith("clow") and t != "clow"]
        votes = [any(t == "idiot" for t in hit), any(t != "idiot" for t in hit), *[p.search(raw) is not None for p in m.PATTERNS.values()]]
        votes += [bool(hit) and len(hit) / len(tokens) >= s for s in m.SHARES] + [len(set(hit)) >= d for d in m.DISTINCT]
        assert np.isclose(score, 1 / (1 + np.exp(-(weights[:-1][votes].sum() + weights[-1]))))
