"""Toxicity by weak supervision.

Voters are words and word beginnings that stand out in texts labelled toxic, a
few patterns of abuse, and how much of a text that lexicon makes up: a word
beginning met once in a long text says little, one word in fifty says a lot.
Each says yes or nothing on a text. A generative label
model treats the true label as hidden: it estimates how often each voter fires
on toxic and on other texts, and how voters hang together beyond that; voters
that repeat each other count less. The annotation of a learning row is one more
voter, with error rates of its own. The posteriors are the targets of a linear
classifier over the votes alone, which scores every document.

Only label model and classifier work on a sample, of at most ``FIT_ROWS`` texts;
terms are counted over all labelled texts outside the held-out part, scores come
from all documents. No label of the held-out part is read, and no label is an input of a
score.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorfall.llm.common import broadcast_if_small, raw_text
from factorfall.session import stage_table

FIT_ROWS = 20_000
VOTERS = 256
# Likelihood-ratio statistic below which a word does not stand out.
LEAST_EVIDENCE = 20.0
PREFIXES = range(3, 9)
# Voters on the lexicon as a whole: its share of a text's words, and its distinct words there.
SHARES = (0.004, 0.008, 0.0125, 0.02)
DISTINCT = (2, 3, 5)
THRESHOLD = 0.7
HELD_OUT = 1
# Least shingle hashes that near copies agree on.
SKETCHED = 4
# Terms counted in one task before they are handed on.
TERMS_HELD = 500_000

# ASCII letters to lower case, other ASCII to a blank; bytes of other characters stay.
_LETTERS = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
# Patterns of abuse that no single word shows.
PATTERNS = {
    "shouting": re.compile(rb"(?:\b[A-Z]{2,}\b[^\w\n]*){4,}!"),
    "masked word": re.compile(rb"\b[A-Za-z]{1,3}[*@#$]{2,}[A-Za-z]*\b"),
    "you are a": re.compile(rb"\b(?:you(?:'| a)re|u r|du bist|tu es|eres)\b[^.\n]{0,20}\b(?:an?|so|ein|un|une|tan)\b", re.I),
    "go away": re.compile(rb"\b(?:shut up|get lost|go to hell|halt die|ferme la|vete a)\b", re.I),
    "calls": re.compile(rb"[!?]{3,}"),
}


def words(raw: bytes) -> list[bytes]:
    """The text's words in lower case, repeats included."""
    if not raw.isascii():
        raw = raw.decode("utf-8", "replace").lower().encode()
    return raw.translate(_LETTERS).split()


def terms(raw: bytes) -> Counter:
    """Words (marked ``=``) and their beginnings (``^``) of one text, with the distinct words that have them.

    The empty term stands for all distinct words.
    """
    found: Counter = Counter()
    for word in set(words(raw)):
        found[b""] += 1
        found[b"=" + word] += 1
        letters = word.decode("utf-8", "replace")
        found.update(b"^" + letters[:n].encode() for n in PREFIXES if n < len(letters))
    return found


def _sketch(raw: bytes) -> int:
    """A hash of the least hashes of the text's 5-word shingles: near copies mostly share it, texts with one passage in common do not."""
    seen = raw.lower().split()
    shingles = {b" ".join(seen[i : i + 5]) for i in range(max(1, len(seen) - 4))}
    least = heapq.nsmallest(SKETCHED, map(xxhash.xxh64_intdigest, shingles))
    return xxhash.xxh64_intdigest(str(least)) >> 1


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_sketch(raw.as_py()) for raw in batch.column("raw")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "sketch"])


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts: tuple[Counter, Counter] = (Counter(), Counter())
    distinct: tuple[Counter, Counter] = (Counter(), Counter())

    def rows() -> pa.RecordBatch:
        every = list(texts[0].keys() | texts[1].keys())
        columns = [pa.array([c[t] for t in every], pa.int64()) for c in (*texts, *distinct)]
        for c in (*texts, *distinct):
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(every, pa.binary()), *columns], names=["term", "a", "b", "words_a", "words_b"])

    for batch in batches:
        for raw, toxic in zip(batch.column("raw"), batch.column("toxic").to_pylist()):
            found = terms(raw.as_py())
            texts[toxic].update(found.keys())
            distinct[toxic].update(found)
            if sum(map(len, texts)) > TERMS_HELD:
                yield rows()
    yield rows()


def learning_labels(labels: DataFrame) -> DataFrame:
    """The labelled ids outside the held-out part; (l_id, toxic).

    Ids with several labels are toxic if one says so; null labels do not count.
    """
    some = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    return some.groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def lexicon(sample: DataFrame, voters: int = VOTERS) -> list[bytes]:
    """The terms with the strongest evidence of standing out in toxic texts, one text of each group of near copies.

    A term must stand out by the texts that have it. Of terms of which one
    begins with the other, the one that stands out most by its distinct words
    speaks for all; the longest, where several stand out alike. At most
    ``voters`` terms are chosen, of the 16 times as many that stand out most: a
    size of the model, which the matrix of votes depends on.
    """
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    counts = sample.select("raw", "toxic").mapInArrow(_term_batches, "term binary, a long, b long, words_a long, words_b long")
    counts = counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("a", "b", "words_a", "words_b")])
    counts = stage_table(counts.filter("b >= 3 OR term = X''"), "toxicity-terms")
    every = counts.filter("term = X''").first()
    if every is None or not every["words_a"] or not every["words_b"]:
        return []

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    rate = (F.col("a") + F.col("b")) / (n0 + n1)
    by_texts = (
        part(F.col("a"), n0 * rate) + part(F.col("b"), n1 * rate)
        + part(n0 - F.col("a"), n0 * (1 - rate)) + part(n1 - F.col("b"), n1 * (1 - rate))
    )
    share = (F.col("words_a") + F.col("words_b")) / (every["words_a"] + every["words_b"])
    by_words = part(F.col("words_a"), every["words_a"] * share) + part(F.col("words_b"), every["words_b"] * share)
    # Only words that speak for toxicity, and rarely stand elsewhere.
    counts = counts.filter(F.col("term") != F.lit(b"")).filter(F.col("b") * n0 > 8 * F.col("a") * n1)
    counts = counts.filter(by_texts >= LEAST_EVIDENCE).withColumn("evidence", by_words)
    chosen: list[bytes] = []
    for r in counts.orderBy(F.col("evidence").desc(), F.length("term").desc(), "term").limit(16 * voters).select("term").collect():
        letters = bytes(r["term"])[1:]
        if not any(letters.startswith(c[1:]) or c[1:].startswith(letters) for c in chosen):
            chosen.append(bytes(r["term"]))
    return chosen[:voters]


@dataclass
class Voters:
    """Votes of a text: one per term, one per pattern, one per share and number of lexicon words."""

    terms: list[bytes]

    def __post_init__(self) -> None:
        self.whole = {t[1:]: i for i, t in enumerate(self.terms) if t[:1] == b"="}
        self.starts = {t[1:]: i for i, t in enumerate(self.terms) if t[:1] == b"^"}
        self.lengths = sorted({len(t) for t in self.starts})
        self.size = len(self.terms) + len(PATTERNS) + len(SHARES) + len(DISTINCT)

    def _hits(self, tokens: list[bytes]) -> dict[bytes, int]:
        """Lexicon words among the tokens, each with its term."""
        seen = set(tokens)
        hits = {w: self.whole[w] for w in self.whole.keys() & seen}
        for n in self.lengths:
            hits.update({w: self.starts[w[:n]] for w in seen if w[:n] in self.starts and len(w) > n})
        return hits

    def _of_patterns(self, raw: bytes) -> list[int]:
        return [len(self.terms) + i for i, p in enumerate(PATTERNS.values()) if p.search(raw)]

    def fired(self, raw: bytes) -> list[int]:
        """Terms and patterns that the text has."""
        return sorted({*self._hits(words(raw)).values(), *self._of_patterns(raw)})

    def votes(self, raw: bytes) -> list[int]:
        """All that say yes on the text."""
        tokens = words(raw)
        hits = self._hits(tokens)
        found = {*hits.values(), *self._of_patterns(raw)}
        if hits:
            at = len(self.terms) + len(PATTERNS)
            share = sum(1 for w in tokens if w in hits) / len(tokens)
            found.update(at + i for i, least in enumerate(SHARES) if share >= least)
            at += len(SHARES)
            found.update(at + i for i, least in enumerate(DISTINCT) if len(hits) >= least)
        return sorted(found)


def _vote_batches(batches: Iterator[pa.RecordBatch], voters: Voters) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fired = [voters.votes(raw.as_py()) for raw in batch.column("raw")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(fired, pa.list_(pa.int32())), batch.column("toxic")], names=["fired", "toxic"]
        )


def label_model(votes: np.ndarray, told: np.ndarray | None = None, rounds: int = 50) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Posterior of the hidden label for each row of 0/1 votes, and the estimates behind it.

    Expectation maximisation for the rates of firing given either label (a
    voter's accuracy). ``told`` are the rows' annotations, a voter that is taken
    to err in at least one of a hundred rows. A voter's weight is 1 / (1 + the sum of its correlations
    above 0.1 with other voters within the labels), re-estimated as posteriors
    settle: k copies of one voter count about as much as one.
    """
    n, m = votes.shape
    posterior = np.where(votes.any(axis=1) if told is None else told == 1, 0.9, 0.02)
    weight = np.ones(m)
    correlation = np.eye(m)
    for step in range(rounds):
        rates = []
        for p in (1 - posterior, posterior):
            rates.append(np.clip((votes.T @ p + 0.05) / (p.sum() + 1.0), 1e-5, 1 - 1e-5))
        prior = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        if step % 10 == 5:
            expected = np.outer(1 - posterior, rates[0]) + np.outer(posterior, rates[1])
            rest = votes - expected
            spread = np.sqrt((rest * rest).sum(axis=0) + 1e-9)
            correlation = (rest.T @ rest) / np.outer(spread, spread)
            above = np.where(correlation > 0.1, correlation, 0.0)
            np.fill_diagonal(above, 0.0)
            weight = 1 / (1 + above.sum(axis=1))
        fires, silent = np.log(rates[1] / rates[0]), np.log((1 - rates[1]) / (1 - rates[0]))
        logit = np.log(prior / (1 - prior)) + votes @ (weight * fires) + (1 - votes) @ (weight * silent)
        if told is not None:
            says = [np.clip((told @ p + 0.05) / (p.sum() + 1.0), 0.01, 0.99) for p in (1 - posterior, posterior)]
            logit += np.where(told == 1, np.log(says[1] / says[0]), np.log((1 - says[1]) / (1 - says[0])))
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior, {"rates": np.stack(rates), "correlation": correlation, "weight": weight}


def linear_classifier(votes: np.ndarray, target: np.ndarray, ridge: float = 0.2, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps; the last weight is the intercept."""
    x = np.hstack([votes, np.ones((len(votes), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = -2.0
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (target - p) - penalty * w
        curve = (x.T * (p * (1 - p))) @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, voters: int = VOTERS) -> tuple[Voters, np.ndarray]:
    """The voters and the classifier's weights.

    Terms are counted over all labelled texts; at most ``fit_rows`` of them, in
    an order that their content fixes, make the matrix of votes.
    """
    chosen = broadcast_if_small(stage_table(learning_labels(labels), "learning-labels"), 16)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), raw_text(docs).alias("raw"))
    rows = rows.join(chosen, F.col("doc_id") == F.col("l_id")).select("doc_id", "raw", "toxic")
    rows = rows.mapInArrow(_sketch_batches, "doc_id long, raw binary, toxic int, sketch long")
    # One text of each group, reduced in each task first.
    single = rows.groupBy("sketch", "toxic").agg(F.min(F.struct("doc_id", "raw")).alias("r")).select("sketch", "toxic", "r.raw")
    single = stage_table(single, "toxicity-single")
    panel = Voters(lexicon(single, voters))
    # Bounded by fit_rows keys, so it may always be broadcast.
    some = stage_table(single.select("sketch", "toxic").orderBy(F.xxhash64("sketch"), "sketch", "toxic").limit(fit_rows), "toxicity-sample")
    sample = single.join(F.broadcast(some), ["sketch", "toxic"], "left_semi")
    votes = sample.select("raw", "toxic").mapInArrow(lambda b: _vote_batches(b, panel), "fired array<int>, toxic int")
    rows = sorted((r["fired"], r["toxic"]) for r in votes.collect())  # at most fit_rows short lists, in an order of their own
    if not panel.terms:
        return panel, np.append(np.zeros(panel.size), -4.0)
    matrix = np.zeros((len(rows), panel.size))
    for i, (found, _) in enumerate(rows):
        matrix[i, found] = 1
    posterior, _ = label_model(matrix, np.array([toxic for _, toxic in rows]))
    return panel, linear_classifier(matrix, posterior)


def _score_batches(batches: Iterator[pa.RecordBatch], voters: Voters, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        logits = [weights[voters.votes(raw.as_py())].sum() + weights[-1] for raw in batch.column("raw")]
        scores = 1 / (1 + np.exp(-np.clip(np.array(logits, dtype=np.float64), -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from the threshold on).

    Null and empty texts fire no voter and get the base score. A null doc_id is
    not held out. Repeated rows give equal rows. Without labels of both kinds
    there is no lexicon and every text gets a low base score. Empty tables give
    no rows. Other columns are not read.
    """
    voters, weights = fit(docs, labels, fit_rows)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), raw_text(docs).alias("raw"))
    found = rows.mapInArrow(lambda b: _score_batches(b, voters, weights), "doc_id long, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold; all columns, one pass over the texts once fitted.

    Null and empty texts have the base score and stay, repeated rows share their
    fate, long texts are scored whole, other columns are not read. Empty tables
    give no rows.
    """
    voters, weights = fit(docs, labels)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        logits = [weights[voters.votes(t.encode() if t is not None else b"")].sum() + weights[-1] for t in texts]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(logits, dtype=np.float64), -30, 30))))

    return docs.filter(score(docs["text"].cast("string")) < threshold)
