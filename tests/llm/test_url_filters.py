import datetime as dt
import random

from pyspark.sql import functions as F

from factorfall.llm import url_filters as m

D = dt.date


def filtered(spark, captures, entries):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_on date").selectExpr("*", "'x' AS host", "1 AS list", "'k' AS kind")
    e = spark.createDataFrame(entries, "list string, kind string, pattern string, dated date, action string")
    return m.filter_urls(c, e)


def plain(captures, entries):
    """Every capture against the whole history, one entry at a time."""
    entries = {e for e in entries if None not in e}
    out = []
    for page, url, on in captures:
        host = segment = None
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = min([rest.find(x) for x in "/?#" if x in rest], default=len(rest))
            host = rest[:end].lower().rsplit("@", 1)[-1].split(":")[0] or None
            path = rest[end + 1 :] if rest[end : end + 1] == "/" else ""
            segment = path.split("/")[0].split("?")[0].split("#")[0] or None
        labels = host.split(".") if host else []
        patterns = {("domain", ".".join(labels[i:])): len(labels) - i for i in range(len(labels))}
        if host and segment:
            patterns["prefix", f"{host}/{segment}"] = len(labels) + 1
        active = []
        for (kind, pattern), depth in patterns.items():
            for name in {e[0] for e in entries}:
                past = sorted(e[3:] for e in entries if e[:3] == (name, kind, pattern) and on and e[3] <= on)
                if past and past[-1][1] == "add":
                    active.append((-depth, name not in m.EXEMPTING, name, pattern))
        best = min(active, default=None)
        out.append((page, host, len(active), best and f"{best[2]}:{best[3]}", bool(best and best[1])))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["page_id"], r["host"], r["n_active"], r["decided_by"], r["blocked"]) for r in df.collect()), key=str)


def test_against_the_whole_history(spark):
    rng = random.Random(8)
    day = lambda: D(2024, 1, 1) + dt.timedelta(rng.randint(0, 40))
    hosts = ["a.example.com", "b.a.example.com", "example.com", "c.example.org", "A.Example.com:80", "u@c.example.org"]
    captures = [(i, f"https://{rng.choice(hosts)}{rng.choice(['', '/', '/x', '/x/y', '/y?q', '?q=/x', '#/x'])}", day()) for i in range(300)]
    patterns = [("domain", h) for h in ("a.example.com", "example.com", "com", "c.example.org")] + [("prefix", "a.example.com/x"), ("prefix", "c.example.org/y")]
    entries = [(rng.choice(["allow", "spam", "adult"]), *rng.choice(patterns), day(), rng.choice(["add", "add", "remove"])) for _ in range(120)]
    assert rows(filtered(spark, captures, entries)) == plain(captures, entries)


def test_odd_rows(spark):
    captures = [(1, None, D(2024, 1, 1)), (2, "", D(2024, 1, 1)), (3, "no host", D(2024, 1, 1)), (4, "http://x.com/a", None), (5, "http://x.com/a", D(2024, 1, 2)), (5, "http://x.com/a", D(2024, 1, 2)), (None, "HTTP://X.COM", D(2024, 1, 1)), (6, "http://" + "a." * 200 + "com", D(2024, 1, 1))]
    entries = [("spam", "domain", "x.com", D(2024, 1, 2), "add"), ("spam", "domain", "x.com", D(2024, 1, 2), "add"), (None, "domain", "x.com", D(2024, 1, 1), "add"), ("spam", "domain", None, D(2024, 1, 1), "add"), ("spam", "domain", "x.com", None, "remove")]
    assert rows(filtered(spark, captures, entries)) == plain(captures, entries)
    assert filtered(spark, [], entries).count() == 0
    assert not any(r["blocked"] for r in filtered(spark, captures, []).collect())


def test_removal_on_the_same_day_wins(spark):
    e = [("spam", "domain", "x.com", D(2024, 1, 1), a) for a in ("remove", "add")]
    assert m.validity(spark.createDataFrame(e, "list string, kind string, pattern string, dated date, action string")).count() == 0


def test_registered_query_blocks_and_exempts(spark, table):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = m.filter_urls(m.dated_captures(pages), m.dated_entries(pages))
    n, blocked, listed = found.agg(F.count("*"), F.sum(F.col("blocked").cast("int")), F.sum((F.col("n_active") > 0).cast("int"))).first()
    assert n == pages.count() and 0 < blocked < listed < n
