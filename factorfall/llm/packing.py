"""Best-fit packing after dominance reduction.

Documents become token ids with an end mark; only those longer than a sequence
are cut. What decides a packing is how many pieces have each length, a table of
at most ``capacity`` rows however many documents there are. On that table the
driver first fixes sets that provably are in some best packing (dominance
criterion of Martello and Toth for sets of up to three pieces), then places the
remaining lengths best-fit, longest first, whole runs of equal pieces at once.
The resulting plan says, for each length, which pieces by rank go to which
sequences; ranks are counted in buckets, so that no length gathers in one task.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factorfall.llm.common import raw_text
from factorfall.session import stage_table

CAPACITY = 4096
END_ID = 1
# Bytes of chunks remembered in one Python worker, each counted as itself, its ids and ``ENTRY``; past
# that the table is emptied before the next batch.
REMEMBERED = 160 << 20
ENTRY = 170
# Pieces of one length and bucket, on average over evenly spread lengths.
BUCKET_ROWS = 50_000
MIN_BUCKETS = 64
# The vocabulary's text pattern ends a run of letters before other signs.
_TAIL = re.compile(rb"(.*[a-z])([!-/:-@\[-`{-~]+)", re.S)


def _parts(chunk: bytes) -> tuple[bytes, ...]:
    tail = _TAIL.fullmatch(chunk)
    return tail.groups() if tail else (chunk,)


class ChunkTokenizer:
    """Token ids of texts, with the ids of chunks between ASCII white space remembered.

    For a vocabulary that drops white space and lower-cases, ids of a text are
    those of its chunks one after the other, and those of a chunk are those of
    its letters followed by those of its trailing ASCII punctuation. Added tokens
    are matched before that, on the text as written: a chunk with one, in either
    case, is tokenized whole and unchanged.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.spaced = re.compile(b"|".join(re.escape(a) for a in added if a.split() != [a]) or rb"(?!)")

    def _chunks(self, text: bytes) -> list[bytes]:
        """Chunks as they are held; those with an added token end in a space, which keeps them whole."""
        low = text.lower()  # bytes: A-Z only
        if self.added is None or not self.added.search(low):
            return low.split()
        if self.spaced.search(low):
            return [text + b" "]
        return [c + b" " if self.added.search(c.lower()) else c.lower() for c in text.split()]

    def _learn(self, chunks: list[bytes]) -> None:
        """Hold the chunks, and the parts of those with trailing signs."""
        known = self.known
        cut = {c: parts for c in chunks if len(parts := _parts(c)) > 1}
        new = {part for c in chunks for part in cut.get(c, (c,))}.difference(known)
        found = dict(zip(new, self._encoded(list(new))))
        known.update(found)
        whole = {c: b"".join([known[part] for part in parts]) for c, parts in cut.items()}
        known.update(whole)
        self.held += sum(len(c) + len(ids) + ENTRY for part in (found, whole) for c, ids in part.items())

    def _encoded(self, chunks: list[bytes]) -> Iterator[bytes]:
        # A batch of texts, each one chunk: the library keeps their ids apart.
        for at in range(0, len(chunks), 4096):
            texts = [c.decode("utf-8", "replace") for c in chunks[at : at + 4096]]
            for encoded in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                yield np.array(encoded.ids, dtype="<u4").tobytes()

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without the end mark."""
        chunked = [self._chunks(t) for t in texts]
        known, every = self.known, {c for chunks in chunked for c in chunks}
        missing = [c for c in every if c not in known]
        if missing and self.held > REMEMBERED:
            known.clear()
            self.held, missing = 0, list(every)
        self._learn(missing)
        return [b"".join(map(known.__getitem__, chunks)) for chunks in chunked]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ChunkTokenizer:
    """One per Python worker."""
    return ChunkTokenizer(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    end = np.array([END_ID], dtype="<u4").tobytes()
    encoder = tokenizer(path or default_vocabulary())
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            rows = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.ids(part.column("raw").to_pylist())):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    cut = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, piece, start, len(cut) // 4, zlib.crc32(cut), cut))
            columns = list(zip(*rows))
            arrays = [pa.array(columns[i], pa.int32() if i == 1 else pa.int64()) for i in range(5)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(columns[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Each document's ids cut at the capacity: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    ``vocabulary`` is the path of a tokenizer file that every executor can
    read; none means the installed word vocabulary.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), raw_text(docs, text).alias("raw"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(lambda batches: _pieces(batches, vocabulary, capacity, with_ids), schema)


Chain = tuple  # ((((), length, times), length, times), ...): a sequence's pieces


class _Lengths:
    """Counts by length with the largest length up to a bound at hand."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.counts = {k: n for k, n in counts.items() if n > 0}
        self.sorted = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            del self.sorted[bisect.bisect_left(self.sorted, length)]

    def largest(self, room: int) -> int:
        """Largest length within the room; 0 if none."""
        at = bisect.bisect_right(self.sorted, room)
        return self.sorted[at - 1] if at else 0

    def smallest_sum(self, n: int) -> int:
        """Sum of the n smallest pieces; of fewer, if fewer are left: unbounded."""
        total = 0
        for length in self.sorted:
            used = min(n, self.counts[length])
            total, n = total + used * length, n - used
            if not n:
                return total
        return 1 << 60


def dominant_sets(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, Chain]], dict[int, int]]:
    """Sets that some best packing contains, as (times, set), and the counts that remain.

    For a piece i with room r beside it: alone, if nothing fits. With the
    largest piece k that fits, if k fills r, if no two others fit together, or
    if at most two fit and no such pair is longer than k. With k and h, h the
    largest up to r / 2, if at most two fit and k + h is within r: then any
    pair has its longer piece within k and its shorter within h.
    """
    left, fixed = _Lengths(counts), []
    changed = True
    while changed:
        changed = False
        for i in reversed(list(left.sorted)):
            while i in left.counts:
                n_i = left.counts[i]
                left.take(i, n_i)  # partners are looked for among the others first
                room, k = capacity - i, left.largest(capacity - i)
                twin = 2 * i <= capacity and n_i > 1 and i >= k
                if not k and not twin:
                    fixed.append((n_i, ((), i, 1)))
                    changed = True
                    break
                if twin:
                    # The largest partner is one of the same length.
                    if 2 * i == capacity or 3 * i > capacity and left.smallest_sum(2) > room and (not left.sorted or i + left.sorted[0] > room):
                        fixed.append((n_i // 2, ((), i, 2)))
                        if n_i % 2:
                            left.counts[i] = 1
                            bisect.insort(left.sorted, i)
                        changed = True
                        continue
                    left.counts[i] = n_i
                    bisect.insort(left.sorted, i)
                    break
                best: list[int] | None = None
                # The remaining pieces of length i do not fit beside i unless 2 i <= capacity; then nothing is claimed but k = r.
                if k == room:
                    best = [k]
                elif 2 * i > capacity:
                    if left.smallest_sum(2) > room:
                        best = [k]
                    elif left.smallest_sum(3) > room:
                        h = left.largest(room // 2)
                        if k + h <= room and (h != k or left.counts[k] > 1):
                            best = [k, h]
                        elif left.largest(room - left.sorted[0]) + h <= k:
                            best = [k]
                if best is None:
                    left.counts[i] = n_i
                    bisect.insort(left.sorted, i)
                    break
                need = {p: best.count(p) for p in best}
                times = min(n_i, *[left.counts[p] // q for p, q in need.items()])
                chain: Chain = ((), i, 1)
                for p, q in need.items():
                    chain = (chain, p, q)
                    left.take(p, times * q)
                fixed.append((times, chain))
                changed = True
                if n_i > times:
                    left.counts[i] = n_i - times
                    bisect.insort(left.sorted, i)
    return fixed, dict(left.counts)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, Chain]]:
    """Best-fit, longest first, as (times, set): each piece goes where the least room is left that holds it."""
    groups: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, times: int, chain: Chain) -> None:
        if times:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append([times, chain])

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                times, chain = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, chain = capacity, ()
                times = -(-n // (capacity // length))
            each = room // length
            full = min(times, n // each)
            put(room - each * length, full, (chain, length, each))
            n -= full * each
            times -= full
            if times and n:  # fewer than one full load is left
                put(room - n * length, 1, (chain, length, n))
                times, n = times - 1, 0
            if chain:
                put(room, times, chain)
    return [(times, chain) for room in rooms for times, chain in groups[room]]


def slots(sets: list[tuple[int, Chain]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, pieces a sequence, offset of the first), by rank."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, chain in sets:
        parts = []
        while chain:
            chain, length, each = chain
            parts.append((length, each))
        offset = 0
        for length, each in reversed(parts):
            rank = ranks.get(length, 0)
            found.setdefault(length, []).append((rank, sequence, each, offset))
            ranks[length] = rank + times * each
            offset += length * each
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in found.items()}


def _place(batches: Iterator[pa.RecordBatch], plan: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths, ranks = (np.asarray(batch.column(c), dtype=np.int64) for c in ("length", "rank"))
        sequence, offset = np.zeros_like(ranks), np.zeros_like(ranks)
        for length in np.unique(lengths):
            at, rows = np.flatnonzero(lengths == length), plan[int(length)]
            slot = rows[np.searchsorted(rows[:, 0], ranks[at], side="right") - 1]
            nth = ranks[at] - slot[:, 0]
            sequence[at] = slot[:, 1] + nth // slot[:, 2]
            offset[at] = slot[:, 3] + nth % slot[:, 2] * length
        keep = [i for i, name in enumerate(batch.schema.names) if name != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in keep], pa.array(sequence), pa.array(offset)],
            names=[*[batch.schema.names[i] for i in keep], "sequence_id", "offset"],
        )


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset; read twice, so staged ones."""
    by_length = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    fixed, rest = dominant_sets(by_length, capacity)
    plan = slots(fixed + best_fit(rest, capacity))
    buckets = max(MIN_BUCKETS, sum(by_length.values()) // BUCKET_ROWS)
    bucketed = cut.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = bucketed.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = W.partitionBy("length").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = W.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = bucketed.withColumn("__nth", F.row_number().over(within)).join(sizes, ["length", "__bucket"])
    ranked = ranked.select(*cut.columns, (F.col("__before") + F.col("__nth") - 1).alias("rank"))
    kinds = ", ".join(f"{c} {t}" for c, t in cut.dtypes)
    return ranked.mapInArrow(lambda batches: _place(batches, plan), f"{kinds}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A null or empty text is a document of its end mark alone. Repeated rows are
    packed as often as they occur; equal pieces are interchangeable. A null
    doc_id stays null. An empty table gives no rows. Other columns are not
    read.
    """
    return pack(stage_table(pieces(docs, capacity, vocabulary, with_ids, doc_id, text), "pieces"), capacity)
