import math
import random
import re
from collections import Counter, defaultdict

from factorfall.llm import source_mixing as m


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


def corpus(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def realised(df):
    return [(r["doc_id"], r["source"], r["mix_epoch"], r["mix_tokens"], r["mix_block_order"], r["mix_doc_order"]) for r in df.collect()]


def tokens_by_source(rows):
    total = Counter()
    for _, text, source in rows:
        total[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text))
    return total


def test_exponent_meets_the_entropy(spark):
    rows, docs = corpus(spark, {"a": 600, "b": 60, "c": 40, "d": 50})
    total = tokens_by_source(rows)
    shares = m.source_shares(docs.select("source", m.n_tokens("text").alias("tokens")))
    a = m.exponent(shares, 0.9, 1e9)

    def h(x):
        raised = [(n / sum(total.values())) ** x for n in total.values()]
        return entropy([r / sum(raised) for r in raised])

    assert h(a) >= 0.9 * math.log(4) > h(a + 2 / (1 << m.GRID))
    assert m.exponent(shares, 0.0, 1e9) == 1.0
    limited = m.exponent(shares, 1.0, 2.0)
    assert abs((max(total.values()) / min(total.values())) ** (1 - limited) - 2) < 1e-4


def test_budgets_are_realised(spark):
    sizes = {"a": 900, "b": 90, "c": 40, None: 30}
    rows, docs = corpus(spark, sizes)
    total = tokens_by_source(rows)
    drawn = realised(m.mixed(docs, 0.97, 4.0))
    got, seen = Counter(), defaultdict(Counter)
    for doc_id, source, epoch, tokens, *_ in drawn:
        got[source] += tokens
        seen[source][doc_id] += 1
    plan = {r["source"]: r for r in m.budgets(m.source_shares(docs.select("source", m.n_tokens("text").alias("tokens"))), m.exponent(m.source_shares(docs.select("source", m.n_tokens("text").alias("tokens"))), 0.97, 4.0)).collect()}
    for source, n in total.items():
        # Within one document of the budget, never over it.
        assert plan[source]["budget"] - 30 <= got[source] <= plan[source]["budget"]
        times = seen[source].values()
        assert max(times) - min(times) <= 1 and max(times) <= 5 and min(times) >= 1
    assert len({d for d, *_ in drawn}) == len(rows)
    # An epoch is a permutation: no document twice in it.
    assert max(Counter((d, e) for d, _, e, *_ in drawn).values()) == 1


def test_cut_epoch_takes_blocks_in_their_order(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_DOCS", 8)
    rows, docs = corpus(spark, {"a": 300, "b": 100})
    drawn = realised(m.mixed(docs, 0.0, 1e9, budget_tokens=2500))
    total, size = tokens_by_source(rows), {i: len(t.split()) for i, t, _ in rows}
    for source in total:
        mine = {d: (b, o) for d, s, e, _, b, o in drawn if s == source and e == 0}
        everyone = m.mixed(docs.filter(f"source = '{source}'"), 0.0, 1e9)
        order = {r["doc_id"]: (r["mix_block_order"], r["mix_doc_order"]) for r in everyone.filter("mix_epoch = 0").collect()}
        ranked = sorted(order, key=order.get)
        taken = [d for d in ranked if d in mine]
        assert set(taken) == set(ranked[: len(taken)])
        budget = round(2500 * total[source] / sum(total.values()))
        spent = sum(size[d] for d in taken)
        assert spent <= budget + 1 and spent + 31 > budget


def test_odd_rows(spark, odd_docs):
    drawn = m.mixed(odd_docs)
    assert [c for c in drawn.columns if not c.startswith("mix_")] == odd_docs.columns
    assert Counter(r["doc_id"] for r in drawn.filter("mix_epoch = 0").collect()) == Counter([1, 1, 2, 3, 4, None, 6, 7])
    assert m.mixed(odd_docs.filter("1 = 0")).count() == 0
    assert m.mixed(odd_docs.filter("doc_id = 3")).count() == 1  # a source without tokens


def test_sources_below_the_last_digit_of_a_weight(spark):
    shares = spark.createDataFrame([("a", 1, 8_000_000_000, 1), ("b", 1, 1, 1), ("c", 1, 2, 1)], "source string, n_docs long, source_tokens long, n_blocks long")
    found = {r["source"]: r for r in m.budgets(shares, m.exponent(shares)).collect()}
    for tokens, source in ((8_000_000_000, "a"), (1, "b"), (2, "c")):
        seen = found[source]["epochs"] + found[source]["cut_tokens"] / tokens
        assert 1 <= seen <= m.REPEAT_LIMIT + 0.5 / tokens, found[source]
