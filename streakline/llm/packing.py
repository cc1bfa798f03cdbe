"""Best-fit packing of tokenised documents by a linear grouping scheme.

Piece lengths are whole numbers up to the capacity, so the driver only sees a
histogram of them.  Large lengths are put in groups of equal cardinality and
rounded up to the longest of their group; the few sizes that result are packed
by configurations (column generation over a linear program).  Actual
lengths then take the places of the rounded ones, and the small lengths and the
configurations' remainders are best-fitted into what is left.  The plan says
which ranks of which length go where; the rows find their place from it
in parallel, without ever meeting in one task.
"""

from __future__ import annotations

import itertools
import math
import os
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streakline.llm.tables import small_side, stored
from streakline.llm.textblocks import LOWER, WHITE, blocks, column_bytes, word_hashes, word_spans

CAPACITY = 2048
END_ID = 0
#: Lengths over a share of the capacity are large; each of these shares is planned, and the plan with the fewest sequences holds.
LARGE_SHARES = (1 / 4, 1 / 3, 1 / 2)
GROUPS = 40
#: Rows of one length are ranked in parts of about so many rows.
RANK_ROWS = 200_000
#: Distinct words a task keeps the ids of; a full store is emptied and filled anew.
KEPT_WORDS = 1_000_000
#: Words encoded at once; their encodings hold far more than the ids.
ENCODED_WORDS = 2048


#: Byte classes: white space, letters (and all of any multi-byte character), digits, other ASCII.
KIND = np.full(256, 3, np.uint8)
KIND[WHITE] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
KIND[0x30:0x3A] = 2


def _pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans the tokenizer never joins: words, and within plain ASCII words runs of letters, single digits and runs of other signs."""
    starts, ends, row = word_spans(data, offsets, ~WHITE)
    if len(starts) == 0:
        return starts, ends, row
    kind = KIND[data]
    whole = np.add.reduceat((data >= 0x80) | (data == 0x27) | (data == 0x7C), starts) > 0  # apostrophes join "'s"; | occurs in special tokens
    cut = np.concatenate(([False], (kind[1:] != kind[:-1]) | (kind[1:] == 2))) & (kind > 0)
    inner = np.flatnonzero(cut)
    word = np.searchsorted(starts, inner, "right") - 1
    inner = inner[(word >= 0) & ~whole[word] & (inner < ends[word]) & (inner != starts[word])]
    first = np.zeros(len(data), bool)
    first[starts] = first[inner] = True
    begin = np.flatnonzero(first)
    word = np.searchsorted(starts, begin, "right") - 1
    return begin, np.minimum(np.append(begin[1:], len(data)), ends[word]), row[word]


class WordIds:
    """Token ids of the pieces that :func:`_pretokens` cuts; each distinct one is encoded once.

    Valid for a tokenizer that drops white space and matches letter runs, single digits and runs of other signs.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self._empty()

    @classmethod
    def of_worker(cls, vocabulary: str) -> WordIds:
        """The one that earlier tasks of this Python worker have filled, or a new one."""
        store = sys.modules.setdefault("streakline_worker_store", types.ModuleType("streakline_worker_store"))
        if vocabulary not in store.__dict__:
            store.__dict__[vocabulary] = cls(vocabulary)
        return store.__dict__[vocabulary]

    def _empty(self):
        self.key = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)
        self.at = np.zeros(0, np.int32)  # of a word's bytes
        self.length = np.zeros(0, np.int32)
        self.bytes = np.zeros(0, np.uint8)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of the encoded words, one after the other."""
        sizes, pools = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for k in range(0, len(words), ENCODED_WORDS):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words[k : k + ENCODED_WORDS], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            pools.append(np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(sizes), np.concatenate(pools)

    def _learn(self, keys: np.ndarray, data: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> None:
        raw, spans = data.tobytes(), list(zip(bounds[which].tolist(), bounds[which + 1].tolist()))
        size, pool = self._encode([raw[a:b].decode() for a, b in spans])
        start = len(self.pool) + np.cumsum(size) - size
        length = bounds[which + 1] - bounds[which]
        byte_at = len(self.bytes) + np.cumsum(length) - length
        self.pool = np.concatenate((self.pool, pool))
        self.bytes = np.concatenate((self.bytes, np.frombuffer(b"".join(raw[a:b] for a, b in spans), np.uint8)))
        order = np.argsort(keys)
        at = np.searchsorted(self.key, keys[order])
        for name, values in (("key", keys), ("start", start), ("size", size), ("at", byte_at), ("length", length)):
            old = getattr(self, name)
            setattr(self, name, np.insert(old, at, values[order].astype(old.dtype)))

    def _ids_of(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start, size) of the ids of distinct words, whose bytes stand one after the other.

        Words are remembered by a hash, and compared by their bytes: should two share one, the words are encoded as they are.
        """
        keys = word_hashes(data, bounds[:-1], bounds[1:])
        alone = len(np.unique(keys)) == len(keys)
        if alone:
            at, new = self._find(keys)
            if len(self.key) + new.sum() > KEPT_WORDS:
                self._empty()
                at, new = self._find(keys)
            if new.any():
                self._learn(keys[new], data, bounds, np.flatnonzero(new))
                at, _ = self._find(keys)
            length = np.diff(bounds)
            if (self.length[at] == length).all():
                source = np.repeat(self.at[at] - bounds[:-1], length) + np.arange(bounds[-1])
                if (self.bytes[source] == data).all():
                    return self.pool, self.start[at], self.size[at]
        raw = data.tobytes()
        size, pool = self._encode([raw[a:b].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
        return pool, np.cumsum(size) - size, size

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys in the store, and which of them are new."""
        at = np.searchsorted(self.key, keys)
        new = np.ones(len(keys), bool)
        there = at < len(self.key)
        new[there] = self.key[at[there]] != keys[there]
        return at, new

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, each row closed by END_ID, and the offset of each row."""
        n_rows = len(offsets) - 1
        if b"<|" not in data.tobytes():  # special tokens are the only strings that depend on case
            data = LOWER[data]
        starts, ends, row = _pretokens(data, offsets)
        words = pa.Array.from_buffers(
            pa.binary(), len(starts),
            [None, pa.py_buffer(np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[~WHITE[data]]))],
        ).dictionary_encode()
        distinct, word = words.dictionary, words.indices.to_numpy()
        pool, start, size = self._ids_of(*column_bytes(distinct)) if len(distinct) else (np.zeros(0, np.uint32), *np.zeros((2, 0), np.int64))
        size, start = size[word].astype(np.int64), start[word]
        source = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        per_row = np.bincount(row, size, n_rows).astype(np.int64) + 1
        bounds = np.concatenate(([0], np.cumsum(per_row)))
        ids = np.full(bounds[-1], END_ID, np.uint32)
        ids[np.arange(len(source)) + np.repeat(row, size)] = pool[source]
        return ids, bounds


def _pieces(vocabulary: str, capacity: int):
    def run(batches):
        words = WordIds.of_worker(vocabulary)
        for rows, data, offsets in blocks(batches, "text"):
            ids, bounds = words.encode(data, offsets)
            n = np.diff(bounds)
            pieces = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, n[row] - start)
            view = memoryview(ids.astype("<u4")).cast("B")
            at = bounds[:-1][row] + start
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def tokenised_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each run of ``capacity`` tokens of each document (null text: only the end id)."""
    id_type = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _pieces(vocabulary, capacity), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    )


def group_up(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Linear grouping: (length, count) runs, longest first, in at most ``groups`` groups of equal cardinality."""
    each = max(1, math.ceil(sum(counts.values()) / groups))
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if room == 0:
                out.append([])
                room = each
            take = min(left, room)
            out[-1].append((length, take))
            left -= take
            room -= take
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 4000) -> list[tuple[np.ndarray, float]]:
    """(copies of each size, how often) of a linear program that covers ``demand`` with the fewest bins."""
    size, need = np.array(sizes), np.array(demand, float)
    m = len(size)
    basis = np.diag(capacity // size).astype(float)
    inverse = np.diag(1.0 / (capacity // size))
    for _ in range(rounds):
        worth = inverse.sum(axis=0)  # duals: every bin costs one
        column = _best_configuration(size, worth, capacity)
        if column @ worth <= 1 + 1e-7:
            break
        amount, step = inverse @ need, inverse @ column
        limit = np.full(m, np.inf)
        limit[step > 1e-9] = np.maximum(amount[step > 1e-9], 0) / step[step > 1e-9]
        out = int(limit.argmin())
        if not np.isfinite(limit[out]):
            break
        basis[:, out] = column
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
    amount = np.linalg.solve(basis, need)
    return [(basis[:, k].astype(int), float(amount[k])) for k in range(m) if amount[k] > 1e-9]


def _best_configuration(size: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: the copies of each size of most worth that fit."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    order = np.argsort(size, kind="stable")
    by_size, by_worth = size[order], worth[order]
    fits = np.searchsorted(by_size, np.arange(capacity + 1), "right")
    for c in range(int(by_size[0]), capacity + 1):
        value = by_worth[: fits[c]] + best[c - by_size[: fits[c]]]
        k = int(value.argmax())
        if value[k] > best[c - 1]:
            best[c], pick[c] = value[k], order[k]
        else:
            best[c] = best[c - 1]
    out, c = np.zeros(len(size)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
            continue
        out[pick[c]] += 1
        c -= size[pick[c]]
    return out


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> list[tuple[int, list[int]]]:
    """(how many sequences, lengths in each of them) that place every counted length once."""
    plans = [_plan(counts, capacity, groups, share) for share in LARGE_SHARES]
    return min(plans, key=lambda bins: sum(count for count, _ in bins))


def _plan(counts: dict[int, int], capacity: int, groups: int, large_share: float) -> list[tuple[int, list[int]]]:
    left = {n: c for n, c in counts.items() if c > 0}
    bins: list[tuple[int, list[int]]] = []
    if full := left.pop(capacity, 0):
        bins.append((full, [capacity]))
    large = {n: c for n, c in left.items() if n > capacity * large_share}
    open_bins: dict[int, list[tuple[int, list[int]]]] = {}

    def put(count: int, lengths: list[int]) -> None:
        if count:
            open_bins.setdefault(capacity - sum(lengths), []).append((count, lengths))

    if large:
        members = group_up(large, groups)
        sizes = [max(n for n, _ in group) for group in members]
        demand = [sum(c for _, c in group) for group in members]
        for column, times in configurations(sizes, demand, capacity):
            slots = [g for g, copies in enumerate(column.tolist()) for _ in range(copies)]
            times = math.floor(times + 1e-6)
            while times and slots:
                # actual lengths substitute rounded ones for as long as no slot's run of equal lengths ends;
                # a slot whose group has run out (the column covers more than the demand) stays empty
                wanted: dict[tuple[int, int], int] = {}
                lengths = []
                for g in slots:
                    run = next((i for i, (_, c) in enumerate(members[g]) if c > wanted.get((g, i), 0)), None)
                    if run is not None:
                        wanted[g, run] = wanted.get((g, run), 0) + 1
                        lengths.append(members[g][run][0])
                if not lengths:
                    break
                n = min([times, *(members[g][run][1] // k for (g, run), k in wanted.items())])
                for (g, run), k in wanted.items():
                    length, c = members[g][run]
                    members[g][run] = (length, c - n * k)
                    left[length] -= n * k
                for g in set(slots):
                    members[g] = [(length, c) for length, c in members[g] if c]
                put(n, lengths)
                times -= n
    # best fit, longest first: the tightest room that takes the length, filled as often as it fits
    for length in sorted(left, reverse=True):
        rest = left[length]
        while rest:
            room = min((r for r in open_bins if r >= length), default=None)
            if room is None:
                copies = min(capacity // length, rest)
                put(rest // copies, [length] * copies)
                put(1, [length] * (rest % copies)) if rest % copies else None
                rest = 0
                continue
            count, lengths = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
            copies = room // length
            filled = min(count, rest // copies)
            put(filled, lengths + [length] * copies)
            rest -= filled * copies
            count -= filled
            if count and 0 < rest < copies:
                put(1, lengths + [length] * rest)
                rest, count = 0, count - 1
            put(count, lengths)
    return bins + [b for same in open_bins.values() for b in same]


def _cells(bins: list[tuple[int, list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted cell keys (length, first rank), and sequence and offset of each cell's first rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in bins:
        offset = 0
        for length in lengths:
            rows.append(((length << 44) + used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + count
            offset += length
        sequence += count
    rows.sort()
    key, seq, off = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
    return key, seq, off


def _place(cells, names):
    key, sequence, offset = cells

    def run(batches):
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            wanted = (column["length"].to_numpy() << 44) + column["rank"].to_numpy()
            cell = np.searchsorted(key, wanted, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(column[n] for n in names), pa.array(sequence[cell] + wanted - key[cell]), pa.array(offset[cell])],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (a stored table with doc_id, piece, length) with sequence_id and offset.

    Every sequence holds at most ``capacity`` tokens, its pieces lie one after the
    other from 0, and equal rows take different places.  No rows give no rows.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    cells = _cells(plan(counts, capacity, groups))
    parts = max(16, math.ceil(sum(counts.values()) / RANK_ROWS))
    spread = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per length and part: as many as the parts and lengths allow, whatever a length's rows
    offsets = (
        spread.groupBy("length", "part").agg(F.count("*").alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    ranked = (
        spread.withColumn("inside", F.row_number().over(inside))
        .join(small_side(offsets, parts * len(counts), 24), ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("inside") - 1)
        .drop("part", "inside", "before")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema]
    return ranked.mapInArrow(_place(cells, pieces.columns), ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text, anything else), cut what is longer than ``capacity`` and pack the pieces.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece.  Null and empty texts are the closing id alone;
    null and repeated ids are documents like any other; a long text is as many pieces as it needs; no rows give none.
    """
    return pack(stored(tokenised_pieces(docs, vocabulary, capacity), "pieces"), capacity, groups)
