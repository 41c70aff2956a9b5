import random
import re
from collections import Counter

import pytest

from factorfall.llm import host_rules as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def check(df, texts):
    rows = df.collect()
    assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(map(str, (i for i, _ in texts)))
    by_id = dict(texts)
    for r in rows:
        counts = plain(by_id[r["doc_id"]])
        assert tuple(r[c] for c in m.COUNTS[:5]) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["base_failed"] and r["kept"])
    return rows


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = check(m.host_rules(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(r["kept"] != r["base_failed"] for r in rows)  # no host here is bad


def test_odd_rows(spark, odd_docs):
    check(m.host_rules(odd_docs), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert m.host_rules(odd_docs.filter("1 = 0")).count() == 0


def test_repeated_words():
    rng = random.Random(4)
    for _ in range(300):
        words = [rng.choice("ab c d".split()) for _ in range(rng.randint(0, 14))]
        assert m.repeated_words([w.encode() for w in words]) == plain(" ".join(words))[4]


def test_verdicts_and_shrinkage(spark):
    rng = random.Random(6)
    prose = lambda: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randint(0, 999)) for _ in range(60))
    signs = lambda: " ".join(f"{w}%%%%" for w in prose().split())
    rows = []
    for host in range(30):
        rows += [(f"good{host}", prose()) for _ in range(20)]
    rows += [("bad", signs()) for _ in range(40)] + [("bad", prose()) for _ in range(5)]
    rows += [("mixed", signs()) for _ in range(16)] + [("mixed", prose()) for _ in range(24)]
    rows += [("tiny", signs())]
    df = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in m.host_rules(df).collect()}
    for i, (host, text) in enumerate(rows):
        r = found[i]
        if host == "bad":
            assert r["host_rejected"] and not r["kept"]
        elif host == "mixed":  # watched: its own failures go, the rest stays
            assert not r["host_rejected"] and r["kept"] == ("%" not in text)
        elif host.startswith("good"):
            assert r["kept"]
    hosts = {r["host"]: r for r in m.host_verdicts(m.document_counts(df)).collect()}
    # One failing document of one is pulled further towards the corpus than forty of 45.
    assert hosts["tiny"]["rate_symbol_heavy"] < hosts["bad"]["rate_symbol_heavy"] + 0.15
    assert hosts["tiny"]["rate_symbol_heavy"] < 1
