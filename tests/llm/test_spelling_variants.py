import re
import zlib
from collections import Counter, defaultdict

import pytest

from factorfall.llm import spelling_variants as m


def brute(rows, least=3, times=2):
    """(word, form, root, n, n_near, form_n) from words that share a text with one character out."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least}
    near, gaps = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            gaps[i, w[:i] + "_" + w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in gaps.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= times * n[w]:
            form[w] = best
    found = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        found.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return found


def rows_of(df):
    rows = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table(spark, table):
    docs = table("documents")
    expected = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows_of(m.spelling_variants(docs)) == expected and sum(e[1] is not None for e in expected) > 100


def test_edits_in_every_place(spark):
    """First, middle and last characters, runs of one letter, ties, chains, accents and words inside words."""
    words = {"harbour": 40, "harbor": 9, "arbour": 4, "harbours": 4, "harbout": 4, "xarbour": 4, "hharbour": 4, "harrbour": 3, "aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24,
             "naïve": 3, "naive": 7, "naÏve": 9, "straße": 3, "strasse": 6, "zebra": 5, "zebras": 10, "zebrax": 10, "other": 3, "unrelated": 3}
    texts = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = m.spelling_variants(docs)
    assert rows_of(found) == brute(texts)
    by_word = {r["word"]: r for r in found.collect()}
    assert by_word["zebra"]["form"] == "zebras" and by_word["aaaaa"]["root"] == "aaaaaaaa" and by_word["arbour"]["form"] == "harbour"


def test_odd_rows(spark, odd_docs):
    long = "x" * 30_000
    more = [(9, f"{long} {long}y {long}y"), (9, long), (9, f"{long} {long}y {long}y {long}y"), (None, "A row WITHOUT an id: without without")]
    docs = odd_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(m.spelling_variants(docs)) == brute(rows)
    assert rows_of(m.spelling_variants(odd_docs.limit(0))) == set()
    blank = spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")
    assert rows_of(m.spelling_variants(blank)) == set()


@pytest.mark.parametrize("least", [1, 2])
def test_dense_words(spark, least):
    """Every word of two letters over five places: all levels branch, most pairs have ties."""
    words = [f"{i:05b}".translate({48: "a", 49: "b"}) for i in range(32)] + [f"{i:06b}".translate({48: "a", 49: "b"}) for i in range(64)]
    texts = [(i, " ".join([w] * (1 + i % 7))) for i, w in enumerate(words)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows_of(m.spelling_variants(docs, least=least)) == brute(texts, least)
