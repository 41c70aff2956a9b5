"""Word n-grams in blocks: the steps that the word model of ``kneser_ney`` runs in Spark's tasks.

A row holds many n-grams, each column one array as bytes: hashes of the words in it, and for
every n-gram the places of its three words (a, b, c) and of its text among them, and how often
the text has it (k). Spark deals the rows out by shard; each step takes the rows of one shard.

All n-grams with one middle word are in one round. In a round they are first dealt out by their
context (a, b), then by their end (b, c). A step also gets the values of single words, b's at
first, then c's; so a shard follows from that word alone, but for the very common ones, whose
n-grams go to all shards and their values with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

NO_WORD = 0
ENTRIES = "shard int, words binary, spelled binary, a binary, b binary, c binary, doc binary, k binary, keys binary, good binary"
VALUES = "round int, shard int, words binary, x binary, y binary, lone binary"
# Of a only whether it is the first with its n-gram in trusted texts; the middle words, which b counts, are apart.
FORWARDED = ENTRIES + ", share binary, w binary, middle binary, w2 binary, total2 binary, lone2 binary, bits binary"
SUMS = "shard int, keys binary, good binary, bits binary"
COUNTS = "kind int, word long, x1 long, x2 long, x3 long, x4 long, lo long, hi long"
# Kinds of COUNTS: of counts of n-grams of order 3 and 2, of a word as the last one, of a word as a context.
ORDER_3, ORDER_2, LAST, CONTEXT = 3, 2, 1, 0
# Odd numbers that tell the first, second and third word of an n-gram apart, and its text.
_PLACES = tuple(np.int64(x) for x in (0x1E3779B97F4A7C15, 0x3F58476D1CE4E5B9, 0x14D049BB133111EB))
_TEXT = np.int64(0x2545F4914F6CDD1D)
_MOST = np.iinfo(np.int64)


def pack(values: np.ndarray) -> bytes:
    return values.tobytes() + values.dtype.char.encode()


def unpack(raw: bytes) -> np.ndarray:
    kind = np.dtype(raw[-1:].decode())
    return np.frombuffer(raw, kind, (len(raw) - 1) // kind.itemsize)


def narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the fewest bytes."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def mixed(*words: np.ndarray) -> np.ndarray:
    """One number for several, in their order."""
    total = np.zeros(len(words[0]), dtype=np.uint64)
    for w in words:
        total = (total ^ w.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(32)
    return total.view(np.int64)


def coded(*words: np.ndarray) -> np.ndarray:
    """One number for several words, in their order; each is given by its ``mixed`` number."""
    return sum(x * number for x, number in zip(words, _PLACES))


class Plan(NamedTuple):
    """Which round and shard n-grams belong to; ``hot`` are the very common words, in order."""

    rounds: int
    shards: int
    hot: np.ndarray
    hot_round: np.ndarray
    ends: np.ndarray  # the share of the other words in the rounds up to each

    def is_hot(self, words: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(words), dtype=bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)] == words

    def round_of(self, words: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ends, (mixed(words).view(np.uint64) >> np.uint64(11)).astype(np.float64) / (1 << 53), "right")
        at = np.minimum(at, self.rounds - 1)
        found = self.is_hot(words)
        at[found] = self.hot_round[np.searchsorted(self.hot, words[found])]
        return at

    def shard_of(self, word: np.ndarray, other: np.ndarray) -> np.ndarray:
        number = mixed(word, np.where(self.is_hot(word), other, 1))
        return (number.view(np.uint64) % np.uint64(self.shards)).astype(np.int64)

    def shard_at(self, words: np.ndarray, at: np.ndarray, others: np.ndarray, other: np.ndarray) -> np.ndarray:
        """``shard_of`` for places in lists of words."""
        found = self.shard_of(words, words)[at]
        hot = np.flatnonzero(self.is_hot(words)[at])
        found[hot] = self.shard_of(words[at[hot]], others[other[hot]])
        return found


def make_plan(rounds: int, shards: int, common: list[tuple[int, int]], total: int) -> Plan:
    """Rounds of about the same size: a common word goes to the lightest, the others share what is left."""
    load, rounds_of = np.zeros(rounds), {}
    for word, n in sorted(common, key=lambda x: (-x[1], x[0])):
        rounds_of[word] = int(load.argmin())
        load[rounds_of[word]] += n
    room = np.maximum(total / rounds - load, 0) + 1
    hot = np.array(sorted(rounds_of), dtype=np.int64)
    return Plan(rounds, shards, hot, np.array([rounds_of[w] for w in hot.tolist()], dtype=np.int64), np.cumsum(room / room.sum()))


def grouped(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts equal numbers side by side, where each group begins in it, and the group of each number."""
    order = np.argsort(numbers)
    ordered = numbers[order]
    new = np.ones(len(numbers), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    group = np.empty(len(numbers), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


def _groups(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if cuts[s] < cuts[s + 1]:
            yield s, order[cuts[s] : cuts[s + 1]]


def _used(size: int, *places: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The places that occur at all, and the given ones counted among them."""
    seen = np.zeros(size, dtype=bool)
    for x in places:
        seen[x] = True
    used = np.flatnonzero(seen)
    at = np.empty(size, dtype=np.uint32)
    at[used] = np.arange(len(used), dtype=np.uint32)
    kind = narrow(at[used[-1:]]).dtype
    return used, [pack(at[x].astype(kind)) for x in places]


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])
    return pa.Table.from_pylist(rows, fields)


def _entry_rows(g: dict, shard: np.ndarray, shards: int) -> Iterator[dict]:
    """ENTRIES, one row a shard; only last words have their spelling."""
    for s, at in _groups(shard, shards):
        words, places = _used(len(g["word"]), g["a"][at], g["b"][at], g["c"][at])
        last = np.zeros(len(g["word"]), dtype=bool)
        last[g["c"][at]] = True
        spelled = g["spelled"][words]
        spelled[~last[words]] = 0
        yield {"shard": s, "words": pack(g["word"][words]), "spelled": pack(spelled), **dict(zip("abc", places)), **_text_columns(g, at)}


def _forwarded_rows(g: dict, shard: np.ndarray, shards: int, columns: dict, middle: dict) -> Iterator[dict]:
    """FORWARDED n-grams, one row a shard; ``columns`` has more values of n-grams, ``middle`` of words as middle ones."""
    for s, at in _groups(shard, shards):
        (words, (c,)), (between, (b,)) = (_used(len(g["word"]), g[x][at]) for x in "cb")
        yield {
            "shard": s, "words": pack(g["word"][words]), "spelled": pack(g["spelled"][words]), "b": b, "c": c, **_text_columns(g, at),
            **{name: pack(x[at]) for name, x in columns.items()}, "middle": pack(g["word"][between]), **{name: pack(x[between]) for name, x in middle.items()},
        }


def _text_columns(g: dict, at: np.ndarray) -> dict:
    docs, doc = _used(len(g["key"]), g["doc"][at])
    return {"doc": doc[0], "k": pack(narrow(g["k"][at])), "keys": pack(g["key"][docs]), "good": pack(g["good"][docs])}


def block_tokens(block: dict) -> np.ndarray:
    tokens = unpack(block["low"]).astype(np.int32)
    tokens |= unpack(block["high"]).astype(np.int32) << 16
    return tokens


def _block_grams(block: dict, plan: Plan, number: int, only_good: bool) -> dict:
    """The distinct n-grams of each text of a tokenized block that are in this round."""
    word = np.append(unpack(block["words"]), NO_WORD)
    begin = len(word) - 1
    tokens, sizes, good = block_tokens(block), unpack(block["sizes"]), unpack(block["good"])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    here = plan.round_of(word) == number
    at = np.flatnonzero(here[tokens])  # of the middle word
    doc = np.searchsorted(ends, at, "right")
    kept = at + 1 < ends[doc]
    if only_good:
        kept &= good[doc]
    at, doc = at[kept], doc[kept]
    a, b, c = np.where(at == starts[doc], begin, tokens[at - 1]), tokens[at], tokens[at + 1]
    if here[begin]:  # the first words of texts
        first = np.flatnonzero((sizes > 0) & good if only_good else sizes > 0)
        mark = np.full(len(first), begin)
        a, b, c, doc = (np.concatenate(x) for x in ((mark, a), (mark, b), (tokens[starts[first]], c), (first, doc)))
    numbers = mixed(word)
    order, begins, _ = grouped(coded(numbers[a], numbers[b], numbers[c]) + doc * _TEXT)
    times = np.zeros(len(order), dtype=np.int64)
    times[order[begins]] = np.diff(np.append(begins, len(order)))
    first = np.flatnonzero(times)  # in the order of the texts: their numbers then take little room
    k = times[first]
    # Counting needs no spelling.
    spelled = np.zeros(len(word), dtype=np.uint8) if only_good else np.append(unpack(block["spelled"]), np.float32(0))
    return {
        "word": word, "spelled": spelled, "a": a[first], "b": b[first], "c": c[first],
        "doc": doc[first], "k": k, "key": unpack(block["keys"]), "good": good,
    }


def block_rows(batches: Iterator[pa.RecordBatch], plan: Plan, number: int, only_good: bool) -> Iterator[pa.RecordBatch]:
    """ENTRIES of one round: of trusted texts by end (b, c) to be counted, or of all texts by context (a, b)."""
    for batch in batches:
        for block in batch.to_pylist():
            g = _block_grams(block, plan, number, only_good)
            word = g["word"]
            if only_good:
                numbers = mixed(word)
                shard = (coded(numbers[g["b"]], numbers[g["c"]]).view(np.uint64) % np.uint64(plan.shards)).astype(np.int64)
            else:
                shard = plan.shard_at(word, g["b"], word, g["a"])
            yield from _table(list(_entry_rows(g, shard, plan.shards)), ENTRIES).to_batches()


def value_rows(batches: Iterator[pa.RecordBatch], plan: Plan, by_round: bool) -> Iterator[pa.RecordBatch]:
    """VALUES of words by shard; very common words go to each. Those of middle words only in their round, else round 0."""
    for batch in batches:
        word = np.asarray(batch.column("word"))
        columns = {"words": word} | {x: np.asarray(batch.column(x).to_numpy(zero_copy_only=False)) for x in ("x", "y", "lone")}
        hot = np.flatnonzero(plan.is_hot(word))
        other = np.flatnonzero(~plan.is_hot(word))
        shard = plan.shard_of(word[other], word[other])
        shard, at = np.concatenate([shard, np.repeat(np.arange(plan.shards), len(hot))]), np.concatenate([other, np.tile(hot, plan.shards)])
        if by_round:
            shard += plan.round_of(word)[at] * plan.shards
        rows = [
            {"round": s // plan.shards, "shard": s % plan.shards, **{n: pack(x[at[i]]) for n, x in columns.items()}}
            for s, i in _groups(shard, plan.shards * (plan.rounds if by_round else 1))
        ]
        yield from _table(rows, VALUES).to_batches()


def _read(table: pa.Table, lists: dict, columns: tuple = ()) -> dict:
    """The n-grams of all rows. ``lists`` names lists of words, the places in each and more values of its words.

    A word is once in its list, in order; texts are those of the rows one after another.
    """
    rows = lambda name: [unpack(x) for x in table.column(name).to_pylist()]
    g = {name: np.concatenate(rows(name)) for name in ("k", "good", *columns)}
    g["k"] = g["k"].astype(np.float64)  # the bytes have no sign
    docs, keys = rows("doc"), rows("keys")
    n = [len(x) for x in docs]
    after = lambda found: np.repeat(np.cumsum([0, *map(len, found[:-1])]).astype(np.int32), n)
    g["doc"], g["key"] = np.concatenate(docs) + after(keys), np.concatenate(keys)
    for name, (places, values) in lists.items():
        words = rows(name)
        start = after(words)
        g[name], first, at = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
        g |= {x: at[np.concatenate(rows(x)) + start] for x in places}
        for x in values:  # what only some rows know is 0 in the others
            given = np.concatenate(rows(x))
            g[x] = given[first]
            g[x][at[given != 0]] = given[given != 0]
    return g


def _lone(group: np.ndarray, size: int, key: np.ndarray) -> np.ndarray:
    """Whether all rows of a group are of one text."""
    one, several = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=bool)
    one[group] = key
    several[group[key != one[group]]] = True
    return ~several


def discounted(n: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3).astype(np.int64)]


def _read_entries(entries: pa.Table) -> dict:
    g = _read(entries, {"words": (("a", "b", "c"), ("spelled",))})
    return g | {"word": g["words"]}


def _grams_and_ends(g: dict, first: str, second: str) -> tuple:
    """Groups of n-grams and of two of their words: first rows, group of each row, pair of each group, number of pairs."""
    numbers = mixed(g["word"])
    order, begins, gram = grouped(coded(*(numbers[g[x]] for x in "abc")))
    at = order[begins]
    order, begins, pair = grouped(coded(numbers[g[first][at]], numbers[g[second][at]]))
    return at, gram, at[order[begins]], pair


def _word_counts(word: np.ndarray, key: np.ndarray, by: np.ndarray, columns: list[np.ndarray], kind: int) -> list[pa.Array]:
    """COUNTS of one kind: ``columns`` by the word of each pair (``by``), first and last key by that of each row (``word``)."""
    order, begins, _ = grouped(word)
    words, ordered = word[order[begins]], key[order]
    lo, hi = np.minimum.reduceat(ordered, begins), np.maximum.reduceat(ordered, begins)
    several = lo != hi  # which ones does not matter
    lo[several], hi[several] = _MOST.min, _MOST.max
    place = np.searchsorted(words, by)
    sums = [np.bincount(place, weights=x, minlength=len(words)).astype(np.int64) for x in columns]
    return [np.full(len(words), kind, dtype=np.int32), words, *sums, lo, hi]


def count_rows(entries: pa.Table) -> pa.Table:
    """COUNTS of a shard of trusted n-grams that holds all with an end (b, c), if any."""
    g = _read_entries(entries)
    at, gram, pair_at, pair = _grams_and_ends(g, "b", "c")
    n3 = np.bincount(gram, weights=g["k"]).astype(np.int64)
    n2 = np.bincount(pair)
    out = []
    for kind, n in ((ORDER_3, n3), (ORDER_2, n2)):
        counts = [np.array([np.count_nonzero(n == i)]) for i in range(1, 5)]
        out.append([np.array([kind], dtype=np.int32), np.zeros(1, dtype=np.int64), *counts, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)])
    key, none = g["key"][g["doc"]], np.zeros(len(n2))
    out.append(_word_counts(g["word"][g["c"]], key, g["word"][g["c"][pair_at]], [none + 1, none, none, none], LAST))
    out.append(_word_counts(g["word"][g["b"]], key, g["word"][g["b"][pair_at]], [n2 == 1, n2 == 2, n2 > 2, n2], CONTEXT))
    names = [x.split()[0] for x in COUNTS.split(", ")]
    return pa.table({name: np.concatenate(x) for name, x in zip(names, zip(*out))})


def _values_of(word: np.ndarray, values: pa.Table) -> dict:
    """Values x, y and lone of words, and whether they have any; of words in order, each once."""
    rows = {name: np.concatenate([np.zeros(0, t), *map(unpack, values.column(name).to_pylist())]) for name, t in (("words", "q"), ("x", "d"), ("y", "d"), ("lone", "?"))}
    found = {"known": np.zeros(len(word), dtype=bool), "x": np.zeros(len(word)), "y": np.zeros(len(word)), "lone": np.zeros(len(word), dtype=bool)}
    if len(rows["words"]):
        order = np.argsort(rows["words"])
        there = order[np.minimum(np.searchsorted(rows["words"][order], word), len(order) - 1)]
        found["known"] = known = rows["words"][there] == word
        for name in ("x", "y", "lone"):
            found[name][known] = rows[name][there[known]]
    return found


def _sum_rows(g: dict, bits: np.ndarray, shards: int) -> list[dict]:
    """Bits by text, dealt out by text."""
    out = []
    total = np.bincount(g["doc"], weights=bits, minlength=len(g["key"]))
    for flag in (False, True):
        here = g["good"] == flag
        order, begins, group = grouped(g["key"][here])
        keys = g["key"][here][order[begins]]
        sums = np.bincount(group, weights=total[here], minlength=len(keys))
        for s, i in _groups((keys.view(np.uint64) % np.uint64(shards)).astype(np.int64), shards):
            out.append({"shard": s, "keys": pack(keys[i]), "good": pack(np.full(len(i), flag)), "bits": pack(sums[i])})
    return out


def context_rows(entries: pa.Table, values: pa.Table, plan: Plan, d3: list[float]) -> pa.Table:
    """FORWARDED rows of a shard that holds all n-grams with a context (a, b).

    The probability of an n-gram is share + w * that of its end. Where the share is 0, log w is
    counted at once, in the rows that have only ``bits``. ``values`` has w2 and total2 of b.
    """
    if not entries.num_rows:
        return _table([], FORWARDED)
    g = _read_entries(entries)
    at, gram, _, pair = _grams_and_ends(g, "a", "b")
    good = g["good"][g["doc"]]
    key = g["key"][g["doc"]]
    n3 = np.bincount(gram, weights=g["k"] * good, minlength=len(at))
    d = discounted(n3, d3)
    total, freed = np.bincount(pair, weights=n3), np.bincount(pair, weights=d)
    w3 = np.where(total > 0, freed / np.maximum(total, 1), 1.0)
    lone = _lone(gram[good], len(at), key[good])
    w3_own = np.where(_lone(pair[gram[good]], len(total), key[good]), 1.0, w3)
    share = ((n3 - d) / np.maximum(total[pair], 1))[gram]
    own = good & lone[gram]
    share[own] = 0
    w = np.where(own, w3_own[pair][gram], w3[pair][gram])
    bits = np.where(share == 0, -np.log2(w) * g["k"], 0.0)
    w[share == 0] = 1
    # One row of each n-gram that trusted texts have.
    of, good_rows = np.full(len(at), -1), np.flatnonzero(good)
    of[gram[good_rows]] = good_rows
    first = np.zeros(len(gram), dtype=bool)
    first[of[of >= 0]] = True
    b = _values_of(g["word"], values)
    columns = {"a": first, "share": share.astype(np.float32), "w": w.astype(np.float32)}
    middle = {"w2": np.where(b["known"], b["x"], 1.0).astype(np.float32), "total2": b["y"].astype(np.float32), "lone2": b["lone"]}
    shard = plan.shard_at(g["word"], g["c"], g["word"], g["b"])
    return _table([*_forwarded_rows(g, shard, plan.shards, columns, middle), *_sum_rows(g, bits, plan.shards)], FORWARDED)


def end_rows(entries: pa.Table, values: pa.Table, plan: Plan, d2: list[float], w1: float) -> pa.Table:
    """SUMS of a shard that holds all n-grams with an end (b, c); ``values`` has the share of c."""
    if not entries.num_rows:
        return _table([], SUMS)
    g = _read(entries, {"words": (("c",), ("spelled",)), "middle": (("b",), ("w2", "total2", "lone2"))}, ("a", "share", "w"))
    order, begins, pair = grouped(coded(mixed(g["middle"])[g["b"]], mixed(g["words"])[g["c"]]))
    pair_at = order[begins]
    good = g["good"][g["doc"]]
    key = g["key"][g["doc"]]
    n2 = np.bincount(pair, weights=g["a"])
    last = _values_of(g["words"], values)
    b, c = g["b"][pair_at], g["c"][pair_at]
    share2 = (n2 - discounted(n2, d2)) / np.maximum(g["total2"][b], 1)
    w2, share1, spelled = g["w2"][b].astype(np.float64), last["x"][c], g["spelled"][c].astype(np.float64)
    lone = _lone(pair[good], len(n2), key[good])

    def log_p2(share2: np.ndarray, w2: np.ndarray, share1: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            log_p1 = np.where(share1 > 0, np.log2(share1 + w1 * np.exp2(-spelled)), np.log2(w1) - spelled)
        return np.where(share2 > 0, np.log2(share2 + w2 * np.exp2(log_p1), where=share2 > 0, out=np.zeros(len(share2))), np.log2(w2) + log_p1)

    usual = log_p2(share2, w2, share1)
    alone = log_p2(np.where(lone, 0.0, share2), np.where(lone & g["lone2"][b], 1.0, w2), np.where(last["lone"][c], 0.0, share1))
    log_end = np.where(good, alone[pair], usual[pair])
    share, w = g["share"].astype(np.float64), g["w"].astype(np.float64)
    known = share > 0
    bits = -g["k"] * np.where(known, np.log2(share + w * np.exp2(log_end), where=known, out=np.zeros(len(share))), log_end)
    return _table(_sum_rows(g, bits, plan.shards), SUMS)


def sum_rows(sums: pa.Table) -> dict:
    """Bits by text over all rows of a shard of SUMS: key, good, bits."""
    key, good, bits = (np.concatenate([unpack(x) for x in sums.column(name).to_pylist()]) for name in ("keys", "good", "bits"))
    return {"key": key, "good": good, "doc": np.arange(len(key)), "bits": bits}


def summed(sums: pa.Table, shards: int) -> pa.Table:
    g = sum_rows(sums)
    return _table(_sum_rows(g, g["bits"], shards), SUMS)


def text_rows(sums: pa.Table) -> pa.Table:
    """key, good and bits of each text, one row each and flag."""
    rows = [(unpack(x["keys"]), unpack(x["good"]), unpack(x["bits"])) for x in summed(sums, 1).to_pylist()]
    return pa.table({name: np.concatenate(x) for name, x in zip(("key", "good", "bits"), zip(*rows))})
