import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np

from factorfall.llm import kneser_ney as m


def plain_model(texts):
    """Interpolated modified Kneser-Ney with dictionaries; returns p(symbol, context)."""
    grams = {m.ORDER: Counter()}
    for t in texts:
        s = (m._BEGIN,) * (m.ORDER - 1) + tuple(m.symbols(t.encode()).tolist())
        grams[m.ORDER].update(s[i : i + m.ORDER] for i in range(len(s) - m.ORDER + 1))
    for n in range(m.ORDER - 1, 0, -1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    discounts, contexts = {}, {}
    for n, c in grams.items():
        r = Counter(c.values())
        y = r[1] / (r[1] + 2 * r[2]) if r[1] else 0.5
        discounts[n] = [min(max(i - (i + 1) * y * r[i + 1] / r[i], 0.1), i - 0.1) if r[i] else i / 2 for i in (1, 2, 3)]
        contexts[n] = defaultdict(list)
        for g, k in c.items():
            contexts[n][g[:-1]].append(k)

    def p(context, symbol):
        n = len(context) + 1
        lower = p(context[1:], symbol) if n > 1 else 1 / m.CLASSES
        seen = contexts[n].get(context)
        if not seen:
            return lower
        d = lambda k: discounts[n][min(k, 3) - 1]
        k = grams[n].get(context + (symbol,), 0)
        return (k - d(k) if k else 0) / sum(seen) + sum(map(d, seen)) / sum(seen) * lower

    return p


def test_probabilities_against_dictionaries(spark, table):
    texts = [r["text"][:400] for r in table("documents").limit(25).collect()] + ["", "a", "  "]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    costs = m.dense_costs(m.model(m.ngram_counts(docs)))
    p = plain_model(texts)
    rng = np.random.default_rng(0)
    seen = np.concatenate([m.ngram_codes(t.encode()) for t in texts])
    for code in [*rng.choice(seen, 150).tolist(), *rng.integers(0, m.CLASSES**m.ORDER, 150).tolist()]:
        gram = tuple(code // m.CLASSES ** (m.ORDER - 1 - i) % m.CLASSES for i in range(m.ORDER))
        assert abs(2.0 ** -costs[code] - p(gram[:-1], gram[-1])) < 1e-5
    for context in rng.choice(seen, 20) // m.CLASSES:  # distributions add up
        assert abs((2.0 ** -costs[context * m.CLASSES : (context + 1) * m.CLASSES].astype(float)).sum() - 1) < 1e-3


def test_junk_is_less_likely_and_clean_documents_stay(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    found = m.quality_by_perplexity(read("documents"), read("labels"))
    assert found.count() == read("documents").count()
    shares = {r["quality"]: r["k"] for r in found.join(read("labels"), "doc_id").groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "k").collect()}
    kept = {r["quality"]: r["count"] / shares[r["quality"]] for r in found.filter("kept").join(read("labels"), "doc_id").groupBy("quality").count().collect()}
    assert kept[1] > 0.98 and kept[0] < 0.6, kept


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (4, 1), (None, 1), (7, None)], "doc_id long, quality int").selectExpr("*", "'x' AS lang", "1 AS perplexity")
    rows = m.quality_by_perplexity(odd_docs, labels).collect()
    assert len(rows) == 8
    assert {r["doc_id"] for r in rows if r["perplexity"] is None} == {2, 3, 6}
    assert not any(r["kept"] for r in rows if r["perplexity"] is None)
    none = m.quality_by_perplexity(odd_docs, labels.filter("1 = 0")).collect()
    assert sum(r["kept"] for r in none) == 5
    assert m.quality_by_perplexity(odd_docs.filter("1 = 0"), labels).count() == 0


def test_symbols():
    assert m.symbols("aB  é1,%\n".encode()).tolist() == [0, 1, m._SPACE, m._OTHER_LETTER, m._DIGIT, m._STOP, m._SIGN, m._SPACE]
    assert len(m.ngram_codes(b"")) == 0


def plain_bits(texts, costs, own, text):
    """Bits of a text under the word model with dictionaries; ``own`` leaves the text itself out."""
    grams, texts_with = {3: Counter()}, defaultdict(set)
    for t in texts:
        w = [None, None, *m.words(t.encode())]
        grams[3].update(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        for i in range(len(w) - 2):
            for g in (tuple(w[i : i + 3]), tuple(w[i + 1 : i + 3]), (w[i + 2],)):
                texts_with[g].add(t)
                texts_with["context", g[:-1]].add(t)
    for n in (2, 1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    discounts, contexts = {}, {}
    for n, c in grams.items():
        r = Counter(c.values())
        y = r[1] / (r[1] + 2 * r[2]) if r[1] else 0.5
        discounts[n] = [min(max(i - (i + 1) * y * r[i + 1] / r[i], 0.1), i - 0.1) if r[i] else i / 2 for i in (1, 2, 3)]
        contexts[n] = defaultdict(list)
        for g, k in c.items():
            contexts[n][g[:-1]].append(k)

    def p(g):
        lower = p(g[1:]) if len(g) > 1 else 2.0 ** -m.spelling_bits([g[-1]], costs)[0]
        seen, k = contexts[len(g)].get(g[:-1]), grams[len(g)].get(g, 0)
        if not seen or own and len(g) > 1 and texts_with["context", g[:-1]] == {text}:
            return lower
        d = lambda k: discounts[len(g)][min(k, 3) - 1]
        if own and texts_with[g] == {text}:
            k = 0
        return (k - d(k) if k else 0) / sum(seen) + sum(map(d, seen)) / sum(seen) * lower

    w = [None, None, *m.words(text.encode())]
    return -sum(np.log2(p(tuple(w[i : i + 3]))) for i in range(len(w) - 2)), len(w) - 2


def test_words_against_dictionaries(spark, table):
    texts = [r["text"][:300] for r in table("documents").limit(20).collect()] + ["Мир и труд. Мир и май!", "мир и труд и май"]
    texts.append(texts[0])
    fresh = ["Труд и мир", "кщзф ыъйц", texts[1][:100] + " zzqx", texts[0]]
    rows = [(i, t, "en") for i, t in enumerate(texts + fresh)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = spark.createDataFrame([(i,) for i in range(len(texts))], "t_id long")
    costs = m.dense_costs(m.model(m.ngram_counts(docs.filter(f"doc_id < {len(texts)}"))))
    found = {r["doc_id"]: r for r in m.scored(docs, ids, costs).collect()}
    assert len(found) == len(rows)
    for i, t, _ in rows:
        bits, n = plain_bits(texts, costs, i < len(texts), t)
        assert found[i]["n_symbols"] == n
        assert abs(np.log2(found[i]["perplexity"]) - bits / n) < 1e-4, t


def test_words_and_their_order_count(spark):
    """Character classes cannot tell these apart."""
    clean = ["мир труд май", "труд май мир и мир труд май", "мир труд май и труд"] * 3
    rows = [(i, f"{t} {i}", "ru") for i, t in enumerate(clean)] + [(90, "рим дурт йам", "ru"), (91, "май труд мир", "ru"), (92, "мир труд май", "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    found = {r["doc_id"]: r["perplexity"] for r in m.quality_by_perplexity(docs, labels).collect()}
    assert found[92] < found[91] < found[90]


def test_words():
    assert m.words("Don't СТОП! 東京 a_1".encode()) == [w.encode() for w in ("don", "'", "t", "стоп", "!", "東", "京", "a_1")]


def test_shuffles_go_and_only_unseen_ngrams_keep_their_words(spark, odd_docs, monkeypatch):
    """The files of every step stayed until the driver's garbage was collected, and every row kept its words."""
    folders = [Path(str(d)) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for f in d.glob("*/shuffle_*.data")}
    staged, stage = {}, m.stage_table

    def kept(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(m, "stage_table", kept)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(name)
    m.quality_by_perplexity(odd_docs, spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int"))
    ends = time.time() + 20
    while files() - before and time.time() < ends:  # they are removed in the background
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(name) == setting
    rows = staged["word-rows"].collect()
    assert {(r["bits"] is None, r["a"] is None, r["c"] is None, r["spelled"] is None) for r in rows} == {(True, False, False, False), (False, True, True, True)}


def test_rounds_and_shards_against_dictionaries_and_one_round_on_disk(spark, table, monkeypatch):
    """All n-grams went through Spark at once, with 40 bytes each, and their tables stayed."""
    monkeypatch.setattr(m, "ROUND_TOKENS", 200)
    monkeypatch.setattr(m, "SHARD_TOKENS", 100)
    monkeypatch.setattr(m, "MAX_ROUNDS", 5)
    staged, stage = [], m.stage_table

    def kept(df, name):
        found = stage(df, name)
        if name == "word-rows":
            staged.append([Path(f.removeprefix("file:")) for f in found.inputFiles()])
        return found

    monkeypatch.setattr(m, "stage_table", kept)
    texts = [r["text"][:300] for r in table("documents").limit(12).collect()] + ["the the the of the", "", "a", "one of the two"]
    texts.append(texts[0])
    fresh = [texts[1][:100] + " zzqx", "the of the, " * 30, texts[0]]
    rows = [(i, t, "en") for i, t in enumerate(texts + fresh)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = spark.createDataFrame([(i,) for i in range(len(texts))], "t_id long")
    costs = m.dense_costs(m.model(m.ngram_counts(docs.filter(f"doc_id < {len(texts)}"))))
    found = {r["doc_id"]: r for r in m.scored(docs, ids, costs).collect()}
    assert len(found) == len(rows)
    for i, t, _ in rows:
        bits, n = plain_bits(texts, costs, i < len(texts), t)
        assert found[i]["n_symbols"] == n
        assert found[i]["perplexity"] is None if not n else abs(np.log2(found[i]["perplexity"]) - bits / n) < 1e-4, t
    assert len(staged) == 5 and all(staged)
    assert [any(f.exists() for f in files) for files in staged] == [False] * 4 + [True]


def test_a_plan_deals_out_every_word_and_spreads_common_ones():
    words = np.arange(1, 20_001, dtype=np.int64) * 7919
    plan = m.blocks.make_plan(4, 3, [(int(words[0]), 5000), (int(words[5]), 4000)], 29_000)
    load = np.bincount(plan.round_of(words), weights=np.where(np.arange(20_000) == 0, 5000, np.where(np.arange(20_000) == 5, 4000, 1)), minlength=4)
    assert load.max() < 1.1 * load.mean()
    assert set(plan.shard_of(np.full(200, words[0]), words[:200])) == {0, 1, 2}
    assert len(set(plan.shard_of(np.full(200, words[1]), words[:200]))) == 1


def test_counts_go_before_the_rounds_and_a_round_has_only_its_own_middle_words(spark, table, monkeypatch):
    """Counts of words stayed on disk, values of all middle words went through every round, and rows kept first words."""
    monkeypatch.setattr(m, "ROUND_TOKENS", 200)
    monkeypatch.setattr(m, "MAX_ROUNDS", 3)
    staged, stage, left, plans = {}, m.stage_table, [], []

    def kept(df, name):
        if name == "word-rows":
            left.append(sum(Path(f).exists() for f in staged["counts"]))
        found = staged[name] = stage(df, name)
        if name == "word-counts":
            staged.setdefault("counts", []).extend(f.removeprefix("file:") for f in found.inputFiles())
        return found

    plan = m._plan
    monkeypatch.setattr(m, "stage_table", kept)
    monkeypatch.setattr(m, "_plan", lambda tokens: plans.append(plan(tokens)) or plans[0])
    docs = table("documents").limit(12)
    ids = docs.selectExpr("CAST(doc_id AS long) AS t_id")
    m.scored(docs, ids, m.dense_costs(m.model(m.ngram_counts(docs))))
    assert staged["counts"] and left == [0, 0, 0]
    for r in staged["word-context"].collect():
        words = m.blocks.unpack(r["words"])
        assert set(plans[0].round_of(words[~plans[0].is_hot(words)])) <= {r["round"]}
    for r in staged["word-rows"].filter("c IS NOT NULL").collect():
        assert m.blocks.unpack(r["a"]).dtype == bool
        assert len(m.blocks.unpack(r["words"])) == len(set(m.blocks.unpack(r["c"]).tolist()))


def test_rows_keep_the_order_of_texts_and_only_last_words_their_spelling():
    """Every word had its spelling in every row, and n-grams came in no order, so that nothing of them could be compressed."""
    texts = [b"one two three one two three one two", b"four two five", b"", b"six one two"]

    class Costs:
        value = np.ones(m.CLASSES**m.ORDER, dtype=np.float32)

    batch = m.pa.RecordBatch.from_pydict({"raw": texts, "key": [5, 6, 7, 8], "good": [True] * 4})
    block = next(m._token_blocks(iter([batch]), Costs))
    plan = m.blocks.make_plan(1, 1, [], 1)
    (row,) = m.pa.Table.from_batches(m.blocks.block_rows(iter([block]), plan, 0, False)).to_pylist()
    of = {x: m.blocks.unpack(row[x]) for x in ("words", "spelled", "c", "doc", "k", "keys")}
    assert sum(of["k"]) == sum(len(m.words(t)) for t in texts)  # one n-gram a word
    assert (np.diff(of["keys"][of["doc"]]) != 0).sum() <= 5  # first words of texts together, then text by text
    assert set(np.flatnonzero(of["spelled"])) == set(of["c"].tolist()) and len(of["words"]) > len(set(of["c"].tolist()))
    back = m.blocks._read_entries(m.pa.Table.from_pylist([row, {**row, "spelled": m.blocks.pack(of["spelled"] * 0)}]))
    assert (back["spelled"][back["c"]] > 0).all()
