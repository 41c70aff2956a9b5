import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from factorfall.llm import packing as m


@pytest.fixture(scope="module")
def plain_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(m.default_vocabulary())
    return lambda texts: [[*e.ids, 1] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check_packing(rows, capacity):
    """Gapless, whole sequences; returns their number."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, plain_ids, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = m.pack_documents(docs).collect()
    expected = {}
    for doc_id, ids in zip(texts, plain_ids(list(texts.values()))):
        for piece, start in enumerate(range(0, len(ids), 4096)):
            cut = ids[start : start + 4096]
            expected[doc_id, piece] = (start, len(cut), zlib.crc32(np.array(cut, dtype="<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    assert len(rows) == len(expected)
    n, total = check_packing(rows, 4096), sum(x[1] for x in expected.values())
    assert n <= math.ceil(total / 4096) + 1


def exact_bins(lengths, capacity):
    """The least number of sequences, by search over sets that hold the longest piece."""
    best = len(lengths)

    def place(left, used):
        nonlocal best
        if used + math.ceil(sum(left) / capacity) >= best:
            return
        if not left:
            best = used
            return
        first, rest = left[0], left[1:]

        def fill(chosen, room, at):
            place([x for i, x in enumerate(rest) if i not in chosen], used + 1)
            last = None
            for i in range(at, len(rest)):
                if rest[i] <= room and rest[i] != last:
                    last = rest[i]
                    fill(chosen | {i}, room - rest[i], i + 1)

        fill(frozenset(), capacity - first, 0)

    place(sorted(lengths, reverse=True), 0)
    return best


@pytest.mark.parametrize("seed", range(60))
def test_fixed_sets_are_in_some_best_packing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 30])
    lengths = [rng.randint(2, capacity) for _ in range(rng.randint(1, 9))]
    fixed, rest = m.dominant_sets(Counter(lengths), capacity)
    n_fixed, left = sum(t for t, _ in fixed), [x for x, n in rest.items() for _ in range(n)]
    used = Counter(left)
    for times, chain in fixed:
        size = 0
        while chain:
            chain, length, each = chain
            used[length] += times * each
            size += length * each
        assert size <= capacity
    assert used == Counter(lengths)
    assert n_fixed + exact_bins(left, capacity) == exact_bins(lengths, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_equals_one_at_a_time(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 64): rng.randint(1, 30) for _ in range(25)}
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in rooms if r >= length]
            room = min(fits) if fits else 64
            if fits:
                rooms.remove(room)
            rooms.append(room - length)
    sets, got = m.best_fit(counts, 64), Counter()
    for times, chain in sets:
        size = 0
        while chain:
            chain, length, each = chain
            got[length] += times * each
            size += length * each
        assert size <= 64
    assert got == Counter(counts) and sum(t for t, _ in sets) == len(rooms)


def test_odd_rows(spark, odd_docs):
    rows = m.pack_documents(odd_docs, with_ids=True).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, None, 6, 7}
    assert [r["length"] for r in rows if r["doc_id"] == 2] == [1]
    assert max(r["length"] for r in rows) == 4096
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
    check_packing(rows, 4096)
    assert m.pack_documents(odd_docs.filter("1 = 0")).count() == 0


def test_chunks_are_exact_on_odd_texts(plain_ids, monkeypatch):
    texts = ["Don't STOP!! a--b... x y z", "näive ΣΑΣ İI", "é K $$$9 1234", "it's'll we'Ve", "<|x|> a<b>c", "\u0000\x1c\x85​ mid", "", "  ", "café, é!!", "áb, a' 's 'S s'"]
    encoder = m.tokenizer(m.default_vocabulary())
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in encoder.ids([t.encode() for t in texts])]
    assert got == [ids[:-1] for ids in plain_ids(texts)]
    monkeypatch.setattr(m, "REMEMBERED", 4)  # forgets all the time
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in encoder.ids([t.encode() for t in texts])]
    assert got == [ids[:-1] for ids in plain_ids(texts)]


@pytest.mark.parametrize("token", ["<|endoftext|>", "<|startoftext|>"])
def test_added_tokens_are_kept_whole(plain_ids, token):
    forms = [token, token.upper(), token.title()]
    texts = [f"{a}{t}{b}" for t in forms for a in ("", "Word ", "Word", "a!") for b in ("", "x", "X!", "...", " End.", f"{token}?", f" {token.upper()}")]
    encoder = m.ChunkTokenizer(m.default_vocabulary())
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in encoder.ids([t.encode() for t in texts])]
    assert got == [ids[:-1] for ids in plain_ids(texts)]
