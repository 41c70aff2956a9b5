import hashlib
import re

import pytest

from factorfall.llm import secret_scan as m

PLAIN = {
    "assign": (r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}


def plain(text):
    spans = []
    for i, (kind, (pattern, group, least)) in enumerate(PLAIN.items()):
        spans += [(x.start(), i, x.end(), kind) for x in re.finditer(pattern, text or "") if len(x[group]) >= least]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)]


def check(found, texts):
    assert len(found) == len(texts)
    for r in found:
        spans = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), texts[r["doc_id"]]
        for kind in PLAIN:
            assert r[f"n_{kind}"] == sum(s.startswith(kind + ":") for s in spans)
        assert set(spans) <= set(r["spans"].split(",") if r["spans"] else [])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_base_on_the_whole_table(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    check(m.secret_digest(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


TRICKY = [
    "password: token = abcdef12",
    "PassWord='abcdefg' token:token=123456 secret = x",
    "api_key=abcdef apikey: abcdef API_KEY=\"zzzzzzzz\"",
    "\U0001f600 token=abcdef\U0001f600 password=abcdef",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "AKIAxAKIA" + "C" * 30,
    "0" * 23 + "g" + "a" * 24 + "G" + "f" * 50,
    "token = \"" + "0123456789abcdef" * 3 + "\"",
    "", "tokſen toKen=abcdef Key", "password=password=password=", "token=\ntoken=abcdef", None,
    " ".join(f"token=value{i}" for i in range(300)),
]


def test_base_on_tricky_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    check(m.secret_digest(docs).collect(), dict(enumerate(TRICKY)))


def spans_of(spark, text, scope=m.SCOPE):
    row = m.secret_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"), scope).first()
    return {(s["kind"], text[s["start"] : s["end"]]) for s in row["spans"]}


def test_weak_parts_need_a_partner(spark):
    alone = "user = alice and nothing more"
    assert spans_of(spark, alone) == set()
    assert spans_of(spark, "pwd=abc1 on its own") == set()
    assert spans_of(spark, "host: db.example.com") == set()
    # A name and an address are not complementary.
    assert spans_of(spark, "user=alice host: db.example.com") == set()
    assert spans_of(spark, "user=alice pwd=abc1") == {("account", "user=alice"), ("short", "pwd=abc1")}
    assert spans_of(spark, "pwd=abc1 at https://db.example.com:99/x") == {
        ("short", "pwd=abc1"), ("endpoint", "https://db.example.com:99")
    }
    # A strong secret is a partner and stays what it is.
    assert spans_of(spark, "user=alice token=abcdefgh") == {("account", "user=alice"), ("assign", "token=abcdefgh")}


@pytest.mark.parametrize("gap", [0, 1, 17, 18, 19, 20, 21, 22, 39, 40, 41, 60])
def test_scope_is_exact(spark, gap):
    text = "x" * 7 + " user=alice" + " " * gap + " pwd=abc1"
    assert bool(spans_of(spark, text, 20)) == (gap + 1 <= 20)


def test_links_against_all_pairs(spark):
    import random

    rng = random.Random(3)
    bits = ["user=bob", "pwd=abc1", "host: a.example.com", "token=abcdefgh", "word", "https://h.example.org"]
    texts = ["".join(rng.choice(bits) + " " * rng.randint(1, 90) for _ in range(40)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in m.secret_spans(docs, 50).collect():
        text = texts[r["doc_id"]]
        parts = [("assign", x) for x in re.finditer(r"token=\w+", text)] + [("account", x) for x in re.finditer("user=bob", text)]
        parts += [("short", x) for x in re.finditer("pwd=abc1", text)]
        parts += [("endpoint", x) for x in re.finditer(r"host: a.example.com|https://h.example.org", text)]
        role = m.ROLE
        expected = {
            (k, x.start(), x.end())
            for k, x in parts
            if k == "assign" or any(
                role[k] != role[o] and "secret" in (role[k], role[o]) and y.start() <= x.end() + 50 and y.end() >= x.start() - 50
                for o, y in parts
            )
        }
        assert {tuple(s) for s in r["spans"]} == expected


def test_odd_rows(spark, odd_docs):
    assert m.secret_digest(odd_docs).count() == 8
    assert m.redact(odd_docs).columns == odd_docs.columns
    assert sorted(map(str, m.redact(odd_docs).collect())) == sorted(map(str, odd_docs.collect()))
    assert m.secret_digest(odd_docs.filter("1 = 0")).count() == 0


def test_redact(spark):
    docs = spark.createDataFrame([(1, "a token=abcdefgh b user=al1 c"), (1, "clean"), (2, None)], "doc_id long, text string")
    assert sorted(str(r["text"]) for r in m.redact(docs).collect()) == ["None", "a [SECRET] b [SECRET] c", "clean"]


KEY = "wJalrXUtnFEMI/K7MDENG+bPxRfiCYEXAMPLEKEY"
ACCESS = "AKIA" + "Z" * 16


@pytest.mark.parametrize("name", ["aws_secret_access_key", "secret_key", "access_key", "accountKey", "private_key", "AWS-Secret-Key", "db_pass", "auth_key"])
def test_compound_names_are_linked(spark, name):
    part = f"{name} = {KEY}"
    found = spans_of(spark, f"{ACCESS} {part}")
    assert ("access", ACCESS) in found and ("named", part) in found
    assert spans_of(spark, f"id {name} = abcd1 alone") == set()
    docs = spark.createDataFrame([(1, f'{ACCESS} "{name}": "{KEY}" end')], "doc_id long, text string")
    assert KEY[:12] not in m.redact(docs).first()["text"]


def test_unnamed_secrets_are_linked(spark):
    assert spans_of(spark, f"{ACCESS}\n{KEY}\n") == {("access", ACCESS), ("unnamed", KEY)}
    assert spans_of(spark, f"nothing near {KEY}") == set()
    assert spans_of(spark, f"{ACCESS} {'plainwordsonly' * 3} see https://e.org/{KEY}") == {("access", ACCESS)}


def test_password_in_an_address_is_linked(spark):
    text = "use postgres://bob:hunter2!x@db.example.com/main now"
    assert ("userinfo", "postgres://bob:hunter2!x@") in spans_of(spark, text)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert m.redact(docs).first()["text"] == "use [SECRET]db.example.com/main now"


def test_new_kinds_equal_the_sql(spark, tmp_path):
    import duckdb

    from factorfall.llm.checking_sql import checking_sql

    texts = [f"{ACCESS} aws_secret_access_key = {KEY}", f"{ACCESS}\n{KEY}", "redis://:pw12@h.example.com x", f"é {ACCESS} http://a.bc/{KEY} {KEY}=="]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    expected = {r["doc_id"]: r["spans"] for r in con.execute(checking_sql()["op8_secret_scan"]).df().to_dict("records")}
    assert {r["doc_id"]: r["spans"] for r in m.secret_digest(docs).collect()} == expected
