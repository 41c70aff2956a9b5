"""Secret scans with multipart credential linking.

Strong kinds are reported on their own. Weak parts (an account name, a short
secret, one under a longer name or without any, user and password in an address, a
service address) say little alone; they are reported when a
complementary part stands within ``SCOPE`` characters of them. Parts of one text
meet in an interval join over cells of the text: a cell is as long as the scope,
a part is in the cells its scope touches, so a cell holds few parts however long
the text or however many of them it has. The join is a semi join: a part comes
out once, not once per partner.

Column functions only. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorfall.session import stage_table


def either_case(word: str) -> str:
    """The letters of an ASCII pattern in either case, and in no other spelling."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGNED = "[\"']?\\x20*[:=]\\x20*[\"']?"

# The strong kinds. The last group of a match must have this many characters.
STRONG = {
    "assign": (
        "(" + "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
        + _ASSIGNED + "([A-Za-z0-9+/_.=-]+)",
        2, 6,
    ),
    "access": ("AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
}
_SCHEME = "[A-Za-z][A-Za-z0-9+.-]{0,30}://"
_KEY_WORDS = "|".join(map(either_case, ("password", "passwd", "pwd", "secret", "token", "api_?key", "credential")))
# Weak parts and what they need nearby.
WEAK = {
    "account": (
        "(" + "|".join(map(either_case, ("username", "user", "login", "account", "client_id", "access_id"))) + ")"
        + _ASSIGNED + "([A-Za-z0-9+/_.@-]+)",
        2, 3,
    ),
    "short": (
        "(" + "|".join(map(either_case, ("password", "passwd", "pass", "pwd", "secret", "token", "api_?key", "auth", "credential")))
        + ")" + _ASSIGNED + "([A-Za-z0-9+/_.=-]+)",
        2, 4,
    ),
    "endpoint": (
        "([A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9._-]+(:[0-9]+)?"
        "|(" + "|".join(map(either_case, ("host", "hostname", "server", "endpoint"))) + ")" + _ASSIGNED + "[A-Za-z0-9._-]+(:[0-9]+)?)",
        0, 8,
    ),
    # A key word as part of a longer name. Words of a name are bounded, so that long runs cost no square.
    "named": (
        "([A-Za-z0-9_-]{1,64}(" + _KEY_WORDS + "|[_-]" + either_case("pass") + "|[_-]" + either_case("auth") + ")[A-Za-z0-9_-]{0,64}"
        + "|(" + _KEY_WORDS + "|" + either_case("auth") + "[_-])[A-Za-z0-9_-]{1,64}"
        + "|(" + "|".join(map(either_case, ("access", "account", "private", "signing", "shared", "storage", "encryption"))) + ")[_-]?" + either_case("key") + ")"
        + _ASSIGNED + "([A-Za-z0-9+/_.=-]+)",
        5, 4,
    ),
    # A run in mixed case. An address takes its characters first: its path is no secret.
    "unnamed": (
        _SCHEME + "[^\\x20\\x09-\\x0D\"'<>]*"
        "|([A-Za-z0-9+/_-]{0,64}([a-z][0-9+/_-]{0,8}[A-Z]|[A-Z][0-9+/_-]{0,8}[a-z])[A-Za-z0-9+/_-]{16,}={0,2})",
        1, 32,
    ),
    "userinfo": (_SCHEME + "([^\\x20\\x09-\\x0D/@:?#\"'<>]*:[^\\x20\\x09-\\x0D/@\"'<>]+)@", 1, 3),
}
# What a text with a match must have, quicker to look for: a key word with the rest of a name and a sign, a long run.
NEEDS = {
    "named": "(" + _KEY_WORDS + "|" + "|".join(map(either_case, ("pass", "auth", "key"))) + ")[A-Za-z0-9_-]{0,65}[\"']?\\x20*[:=]",
    "unnamed": "[A-Za-z0-9+/_-]{30}",
}
KINDS = [*STRONG, *WEAK]
ROLE = {"assign": "secret", "hex": "secret", "short": "secret", "access": "identifier", "account": "identifier", "endpoint": "endpoint"}
ROLE |= {"named": "secret", "unnamed": "secret", "userinfo": "secret"}
SCOPE = 200
_SPAN = "array<struct<kind:string, start:int, end:int>>"


def matches(text: Column, kind: str, pattern: str, group: int, least: int, where: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as spans of (kind, start, end); none outside ``where``.

    The text between matches and the matches themselves alternate, so their
    lengths give the positions. A match whose group is too short drops out after
    it has taken its characters.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(gaps.alias("gap"), F.transform(found, F.length).alias("size"), F.transform(checked, F.length).alias("least"))
    # The last gap has no match after it; its row is cut off.
    rows = F.slice(rows, 1, F.size(found))
    start = F.struct(F.lit(0).alias("end"), F.expr(f"CAST(array() AS {_SPAN})").alias("spans"))

    def step(seen: Column, row: Column) -> Column:
        at = seen["end"] + row["gap"]
        end = at + row["size"]
        span = F.struct(F.lit(kind).alias("kind"), at.alias("start"), end.alias("end"))
        spans = F.when(row["least"] >= least, F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"])
        return F.struct(end.alias("end"), spans.alias("spans"))

    none = F.expr(f"CAST(array() AS {_SPAN})")
    asked = text.rlike(pattern)
    if kind in NEEDS:
        asked = text.rlike(NEEDS[kind]) & asked
    if where is not None:
        asked = where & asked
    return F.when(asked, F.aggregate(rows, start, step, lambda s: s["spans"])).otherwise(none)


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, a key of the row's content, its strong spans and its weak parts; texts are read once.

    A weak secret is reported only beside a name or an address, so it is looked
    for only in texts that have one.
    """
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), body.alias("body"))
    kinds = {**STRONG, **WEAK}
    late = [k for k in WEAK if ROLE[k] == "secret"]
    rows = rows.withColumns({f"k_{k}": matches(F.col("body"), k, *p) for k, p in kinds.items() if k not in late})
    named = [F.size(f"k_{k}") > 0 for k in kinds if ROLE[k] != "secret"]
    rows = rows.withColumn("named", reduce(Column.__or__, named))
    return rows.withColumns({f"k_{k}": matches(F.col("body"), k, *kinds[k], F.col("named")) for k in late}).select(
        "doc_id",
        F.sha2("body", 256).alias("content"),
        F.concat(*[F.col(f"k_{k}") for k in STRONG]).alias("strong"),
        F.concat(*[F.col(f"k_{k}") for k in WEAK]).alias("weak"),
    )


def linked_parts(rows: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with a complementary part in their scope: doc_id, content and the spans.

    A part's scope runs from ``scope`` characters before it to ``scope`` after
    it. Texts that occur again under the same id count once.
    """
    parts = rows.filter(F.size("weak") > 0).select(
        "doc_id", "content", F.explode(F.concat("strong", "weak")).alias("span")
    )
    role = F.create_map(*[F.lit(x) for k in KINDS for x in (k, ROLE[k])])
    parts = parts.select("doc_id", "content", "span.*").distinct().withColumn("role", role[F.col("kind")])
    near = parts.filter(F.col("kind").isin(*WEAK)).select(
        "*", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))).alias("cell")
    )
    other = parts.select(
        *[F.col(c).alias(f"o_{c}") for c in parts.columns],
        F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("o_cell"),
    )
    apart = (F.col("o_start") <= F.col("end") + scope) & (F.col("o_end") >= F.col("start") - scope)
    # A secret needs a name or an address; a name or an address needs a secret.
    complementary = (F.col("role") != F.col("o_role")) & ((F.col("role") == "secret") | (F.col("o_role") == "secret"))
    same = (F.col("content") == F.col("o_content")) & (F.col("cell") == F.col("o_cell"))
    linked = near.join(other, F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & same & apart & complementary, "left_semi")
    span = F.struct("kind", "start", "end")
    # At most the parts of one text, which the text itself bounds.
    return linked.groupBy("doc_id", "content").agg(F.collect_set(span).alias("linked"))


def _ordered(spans: Column) -> Column:
    """Spans by start, then by kind as listed."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_spans(docs: DataFrame, scope: int = SCOPE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, base (strong spans) and spans (with the linked weak parts), in order.

    A null or empty text has no spans. Repeated rows give equal rows; a null
    doc_id is an id like any other. An empty table gives no rows. Other columns
    are not read. A weak part that covers the same characters as a strong span
    is the strong span and is not reported twice.
    """
    rows = stage_table(scanned(docs, doc_id, text), "secret-parts")
    # A short secret that already is an assignment with the same place is no part of its own.
    own = F.expr("filter(weak, w -> NOT exists(strong, s -> s.start = w.start AND s.end = w.end))")
    rows = rows.withColumn("weak", F.when(F.size("weak") > 0, own).otherwise(F.col("weak")))
    linked = linked_parts(rows, scope).select(F.col("doc_id").alias("l_id"), F.col("content").alias("l_content"), "linked")
    joined = rows.join(linked, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("content") == F.col("l_content")), "left")
    none = F.expr(f"CAST(array() AS {_SPAN})")
    return joined.select(
        "doc_id",
        "content",
        _ordered(F.col("strong")).alias("base"),
        _ordered(F.concat("strong", F.coalesce("linked", none))).alias("spans"),
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    found = secret_spans(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, STRONG), F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[SECRET]", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every reported span replaced by ``mark``; columns as they were.

    Overlapping spans are replaced as one. A null text stays null.
    """
    found = secret_spans(docs, scope, doc_id, text).filter(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias("__id"), F.col("content").alias("__content"), F.col("spans").alias("__spans"))
    # Same id and same text have the same spans.
    found = found.dropDuplicates(["__id", "__content"])
    body = F.col(text) if isinstance(text, str) else text
    match = docs[doc_id].cast("long").eqNullSafe(F.col("__id")) & (F.sha2(docs[text].cast("string"), 256) == F.col("__content"))
    joined = docs.join(found, match, "left")

    def step(seen: Column, span: Column) -> Column:
        kept = F.when(
            span["start"] >= seen["at"],
            F.concat(seen["out"], body.substr(seen["at"] + 1, span["start"] - seen["at"]), F.lit(mark)),
        ).otherwise(seen["out"])
        return F.struct(F.greatest(seen["at"], span["end"]).alias("at"), kept.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate("__spans", start, step, lambda s: F.concat(s["out"], body.substr(s["at"] + 1, F.length(body))))
    clean = F.when(F.col("__spans").isNull(), body).otherwise(cut)
    return joined.select(*[clean.alias(c) if c == text else docs[c] for c in docs.columns])
