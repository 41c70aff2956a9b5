import re
from collections import Counter, defaultdict

import pytest

from factorfall.llm import source_divergence as m

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def brute(rows, min_docs, top=m.TOP_TERMS):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    found = set()

    def ranked(lang, source, part, items, most):
        order = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
        found.update((lang, source, part, item, value, i) for i, (item, value) in enumerate(order, 1))

    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * v) for t in kept}

        q, p = shares(whole), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            ranked(lang, s, "pair", [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s], None)
            ranked(lang, s, "term", [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]], top)
    return found


def result(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("slice_bytes, sources, terms", [(m.SLICE_BYTES, m.CELL_SOURCES, m.CELL_TERMS), (4000, 3, 16)])
def test_whole_table(spark, table, monkeypatch, slice_bytes, sources, terms):
    """The same from one model and cell and from many."""
    monkeypatch.setattr(m, "CELL_SOURCES", sources)
    monkeypatch.setattr(m, "CELL_TERMS", terms)
    docs = table("documents")
    expected = brute([(r["text"], r["lang"], r["source"]) for r in docs.collect()], 10)
    found = result(m.source_divergence(docs, min_docs=10, slice_bytes=slice_bytes))
    assert found == expected and {x[2] for x in found} == {"pair", "term"}


def test_odd_rows(spark, odd_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd_docs.collect()]
    for min_docs in (1, 2, 30):
        assert result(m.source_divergence(odd_docs, min_docs=min_docs, top_terms=3)) == brute(rows, min_docs, 3)
    assert result(m.source_divergence(odd_docs.limit(0))) == set()


def test_ties_go_by_utf8_and_sums_by_task_are_whole(spark, monkeypatch):
    monkeypatch.setattr(m, "HELD_SUMS", 8)
    texts = ["Öl öl zoo Zoo ärger 中文 \U0001f600 a-b_c`d{e\x7ff @[x]", "zoo ärger q", None, "", "alpha beta gamma alpha"]
    rows = [(t, lang, source) for t in texts for lang in ("de", None) for source in ("s1", "s2", None, "ß")]
    rows += [("only here", "de", "s1")] * 4
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert result(m.source_divergence(docs, min_docs=2)) == brute(rows, 2)


@pytest.mark.parametrize("piece", [1, 40, 1 << 20])
def test_terms_by_byte_equal_the_expression(monkeypatch, piece):
    import pyarrow as pa

    monkeypatch.setattr(m, "PIECE_BYTES", piece)
    texts = ["", "AbC", "abc", "x", "", "".join(map(chr, range(0x180))), "Öl ÖL\U0001f600a-b_c`d{e\x7ff @[x]", " ", "ends\n", " z", "東京1東", ""]
    raw = pa.array([t.encode() for t in ["cut off", *texts, "cut off"]]).slice(1, len(texts))
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * len(texts)), pa.array(["s"] * len(texts)), raw], names=["lang", "source", "raw"])
    found = [t for out in m._term_batches(iter([batch])) for t in out.column("terms").to_pylist()]
    expected = [re.findall(m.TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) for t in texts]
    assert found == expected
    counts = Counter()
    for out in m._document_counts(iter([batch])):
        counts.update({(r["lang"], r["term"]): r["n"] for r in out.to_pylist()})
    assert counts == Counter(("l", t) for terms in expected for t in set(terms))


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    """Several batches of each task are held at a time; they came as large as Spark's 64 MB."""
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([str(batch.nbytes)]), pa.array([1])], names=["lang", "term", "n"])

    staged, stage = {}, m.stage_table

    def kept(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(m, "_document_counts", sizes)
    monkeypatch.setattr(m, "stage_table", kept)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 1000, 1, 1).selectExpr("repeat('words of a text ', 2500) AS text", "'en' AS lang", "'s' AS source")
    m.source_divergence(docs, min_docs=1)
    found = [int(r["term"]) for r in staged["divergence-vocabulary"].collect()]
    assert found and max(found) <= 6 << 20, found
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
