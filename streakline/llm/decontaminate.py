"""Benchmark decontamination over a distributed positional inverted index.

The index is document-partitioned: every segment (a row of the stored table)
holds all token postings of a few thousand documents -- a sorted term table and,
per term, the ascending word slots where it occurs.  Slots number the words of
the segment's documents in a row with one unused slot between documents, so
subtracting a term's offset in a phrase from its postings gives candidate
starts that can be intersected as plain sorted lists.

A phrase is looked up from its rarest term in the segment: that term's
offset-adjusted list is intersected with the next rarest and so on, ending
early when nothing is left.  Proximity looks around the rarest term's postings
in the same way.  Query items are read in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streakline.llm.tables import stored
from streakline.llm.textblocks import BASE, LOWER, SpanHash, blocks, column_bytes, row_bounds, word_spans

WINDOW_WORDS = 13
#: A document is contaminated when at least one word in so many is inside a window.
HIT_SHARE = 20
SEGMENT_BYTES = 256 << 10
#: Bytes of query texts compiled at once; more are answered in several passes over the index.
QUERY_BYTES = 8 << 20

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
SECOND_BASE = 0xD6E8FEB86659FD93

SEGMENT = "segment long, {ids}, n_words binary, term binary, check binary, postings binary, slots binary"


def _words(data: np.ndarray, offsets: np.ndarray):
    """Two independent hashes (62 and 32 bits, see SpanHash) and the row of each word."""
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets, WORD)
    one = SpanHash(data, BASE)(starts, ends)  # released before the second one is made
    return one, SpanHash(data, SECOND_BASE)(starts, ends).astype(np.uint32), row


def _index(batches):
    for rows, data, offsets in blocks(batches, "text", SEGMENT_BYTES):
        one, two, row = _words(data, offsets)
        n_words = np.diff(row_bounds(row, rows.num_rows))
        slot = np.arange(len(row)) + row  # one unused slot after each document
        slot = slot.astype(np.uint16 if len(row) + rows.num_rows <= 1 << 16 else np.uint32)
        order = np.argsort(one, kind="stable")
        if ((one[order][1:] == one[order][:-1]) & (two[order][1:] != two[order][:-1])).any():
            order = np.lexsort((slot, two, one))  # two words share the first hash: keep their lists apart
        one, two, slot = one[order], two[order], slot[order]
        changes = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        last = np.flatnonzero(np.append(changes, True)) if len(one) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([0], pa.int64()),
                pa.array([rows.column(0).to_pylist()], pa.list_(rows.column(0).type)),
                *(
                    pa.array([x.tobytes()], pa.binary())
                    for x in (n_words.astype(np.uint32), one[last], two[last], np.diff(last, prepend=-1).astype(np.uint32), slot)
                ),
            ],
            names=["segment", "doc_ids", "n_words", "term", "check", "postings", "slots"],
        )


def build_index(docs: DataFrame) -> DataFrame:
    """Stored positional index of every word of ``docs`` (doc_id, text, anything else); null text has no words."""
    ids = f"doc_ids array<{dict(docs.dtypes)['doc_id']}>"
    segments = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_index, SEGMENT.format(ids=ids))
    return stored(segments.withColumn("segment", F.monotonically_increasing_id()), "index")


class Segment:
    """One segment of the index, with the two query forms."""

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.n_words = read("n_words", np.uint32).astype(np.int64)
        self.first_slot = np.cumsum(self.n_words + 1) - (self.n_words + 1)
        self.term, self.check = read("term", np.uint64), read("check", np.uint32)
        self.end = np.cumsum(read("postings", np.uint32).astype(np.int64))
        self.slots = read("slots", np.uint16 if self.n_words.sum() + len(self.n_words) <= 1 << 16 else np.uint32)

    def ranges(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last posting of each term (an empty range for absent ones)."""
        if len(self.term) == 0:
            return np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
        begin = np.concatenate(([0], self.end[:-1]))
        at = np.searchsorted(self.term, one)
        found = np.zeros(len(one), bool)
        place = np.minimum(at, len(self.term) - 1)
        for step in range(len(self.term)):  # more than one step only where words share the first hash
            probe = np.minimum(at + step, len(self.term) - 1)
            same = (self.term[probe] == one) & (at + step < len(self.term)) & ~found
            if not same.any():
                break
            hit = same & (self.check[probe] == two)
            place[hit] = probe[hit]
            found |= hit
        return np.where(found, begin[place], 0), np.where(found, self.end[place], 0)

    def document(self, slot: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first_slot, slot, "right") - 1

    def phrase(self, lists: list[tuple[int, int]]) -> np.ndarray:
        """Start slots of the phrase whose k-th term has postings ``lists[k]``."""
        order = sorted(range(len(lists)), key=lambda k: lists[k][1] - lists[k][0])
        a, b = lists[order[0]]
        starts = self.slots[a:b].astype(np.int64) - order[0]
        for k in order[1:]:
            if len(starts) == 0:
                break
            a, b = lists[k]
            own = self.slots[a:b]
            at = np.minimum(np.searchsorted(own, starts + k), len(own) - 1)
            starts = starts[own[at] == starts + k]
        return starts

    def near(self, lists: list[tuple[int, int]], slop: int) -> np.ndarray:
        """Slots of the rarest term that have every other term within ``slop`` words in the same document."""
        order = sorted(lists, key=lambda ab: ab[1] - ab[0])
        a, b = order[0]
        anchors = self.slots[a:b].astype(np.int64)
        doc = self.document(anchors)
        low = np.maximum(anchors - slop, self.first_slot[doc])
        high = np.minimum(anchors + slop, self.first_slot[doc] + self.n_words[doc] - 1)
        keep = np.ones(len(anchors), bool)
        for a, b in order[1:]:
            own = self.slots[a:b]
            keep &= np.searchsorted(own, low) < np.searchsorted(own, high, "right")
        return anchors[keep]


class Queries:
    """Compiled query items: vocabulary hashes and, per distinct phrase, its term numbers and items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int | None):
        data, offsets = column_bytes(pa.array([text for _, text in items], pa.large_string()))
        one, two, row = _words(data, offsets)
        pairs, number = np.unique(np.stack((one, two.astype(np.uint64)), axis=1), axis=0, return_inverse=True)
        self.one, self.two = pairs[:, 0].copy(), pairs[:, 1].astype(np.uint32)
        number, bounds = number.ravel(), row_bounds(row, len(items))
        phrases: dict[tuple[int, ...], set[str]] = {}
        for (name, _), a, b in zip(items, bounds[:-1].tolist(), bounds[1:].tolist()):
            words = number[a:b].tolist()
            size = len(words) if window is None else min(window, len(words))
            for k in range(len(words) - size + 1 if words else 0):
                phrases.setdefault(tuple(words[k : k + size]), set()).add(name or "")
        self.phrases = list(phrases)
        self.items = [sorted(x) for x in phrases.values()]
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(words) for words in phrases}:
            which = [k for k, words in enumerate(self.phrases) if len(words) == size]
            self.by_size[size] = np.array(which), np.array([self.phrases[k] for k in which])

    def present(self, segment: Segment):
        """(number of the phrase, posting ranges of its terms) for the phrases whose every term occurs in the segment."""
        a, b = segment.ranges(self.one, self.two)
        have = b > a
        for which, terms in self.by_size.values():
            for k in which[have[terms].all(axis=1)].tolist():
                words = self.phrases[k]
                yield k, list(zip(a[list(words)].tolist(), b[list(words)].tolist()))


def _query_blocks(items: DataFrame, query_bytes: int) -> list[DataFrame]:
    """(name, text) parts of bounded size, by hash of the name."""
    named = items.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text"))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / query_bytes))
    return [named.filter(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == k) if n > 1 else named for k in range(n)]


def _segments(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            yield row, Segment(row)


def _phrase_rows(queries: Queries, id_type: pa.DataType):
    def run(batches):
        for row, segment in _segments(batches):
            ids, places, names, sizes = [], [], [], []
            for k, lists in queries.present(segment):
                starts = segment.phrase(lists)
                for d, s in zip(segment.document(starts).tolist(), starts.tolist()):
                    for name in queries.items[k]:
                        ids.append(row["doc_ids"][d])
                        places.append(s - int(segment.first_slot[d]))
                        names.append(name)
                        sizes.append(len(lists))
            if ids:
                yield _rows(pa.array(ids, id_type), names, places, sizes)

    return run


def _near_rows(queries: Queries, id_type: pa.DataType, slop: int):
    def run(batches):
        for row, segment in _segments(batches):
            ids, places, names, sizes = [], [], [], []
            for k, lists in queries.present(segment):
                anchors = segment.near(list(dict.fromkeys(lists)), slop)
                for d, s in zip(segment.document(anchors).tolist(), anchors.tolist()):
                    for name in queries.items[k]:
                        ids.append(row["doc_ids"][d])
                        places.append(s - int(segment.first_slot[d]))
                        names.append(name)
                        sizes.append(slop)
            if ids:
                yield _rows(pa.array(ids, id_type), names, places, sizes)

    return run


def _rows(ids, names, places, sizes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(sizes, pa.int64())],
        names=["doc_id", "item_id", "word", "size"],
    )


def _id_type(index: DataFrame) -> pa.DataType:
    """Arrow type of doc_id: a segment's ids alone do not tell it, as all may be null."""
    return to_arrow_type(index.schema["doc_ids"].dataType.elementType)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _matches(index: DataFrame, items: DataFrame, window: int | None, query_bytes: int, rows) -> DataFrame:
    id_type = dict(index.dtypes)["doc_ids"][len("array<") : -1]
    schema = f"doc_id {id_type}, item_id string, word long, size long"
    parts = []
    for block in _query_blocks(items, query_bytes):
        queries = Queries([(r["name"], r["text"]) for r in block.collect()], window)
        parts.append(index.mapInArrow(rows(queries, _id_type(index)), schema))
    return _union(parts)


def phrase_matches(index: DataFrame, items: DataFrame, window: int | None = None, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Exact occurrences of each item's windows (``None``: of the whole item): doc_id, item_id, word (from 0), size in words."""
    return _matches(index, items, window, query_bytes, _phrase_rows)


def proximity_matches(index: DataFrame, items: DataFrame, slop: int, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Places of an item's locally rarest word with all its other words within ``slop`` words: doc_id, item_id, word, size (the slop)."""
    return _matches(index, items, None, query_bytes, lambda queries, id_type: _near_rows(queries, id_type, slop))


def _judged(queries: Queries, id_type: pa.DataType, hit_share: int):
    """Verdicts in one pass, so that a task needs one Python worker."""
    return lambda batches: _verdicts(hit_share)(_hits(queries, id_type)(batches))


def _hits(queries: Queries, id_type: pa.DataType, every: bool = True):
    """Per document (``every`` one, or those hit): its words, the word spans hit (flat starts and ends) and the items that hit it."""

    def run(batches):
        for row, segment in _segments(batches):
            n = len(segment.n_words)
            spans: list[list[int]] = [[] for _ in range(n)]
            names: list[set[str]] = [set() for _ in range(n)]
            for k, lists in queries.present(segment):
                starts = segment.phrase(lists)
                for d, s in zip(segment.document(starts).tolist(), starts.tolist()):
                    at = s - int(segment.first_slot[d])
                    spans[d] += (at, at + len(lists))
                    names[d].update(queries.items[k])
            shown = [d for d in range(n) if every or spans[d]]
            if not shown:
                continue
            place = pa.StructArray.from_arrays([pa.array([row["segment"]] * len(shown), pa.int64()), pa.array(shown, pa.int32())], ["segment", "ordinal"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["doc_ids"][d] for d in shown], id_type), pa.array(segment.n_words[shown]),
                    pa.array([spans[d] for d in shown], pa.list_(pa.int64())), pa.array([sorted(names[d]) for d in shown], pa.list_(pa.string())), place,
                ],
                names=["doc_id", "n_words", "spans", "items", "row"],
            )

    return run


def _verdicts(hit_share: int):
    def run(batches):
        for batch in batches:
            n_hit, n_items, digest = [], [], []
            for spans, items in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                covered, reach = 0, 0
                for a, b in sorted(zip(spans[::2], spans[1::2])):
                    covered += max(0, b - max(a, reach))
                    reach = max(reach, b)
                items = sorted(set(items))
                n_hit.append(covered)
                n_items.append(len(items))
                digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            n_words = batch.column(1).to_pylist()
            dirty = [h > 0 and hit_share * h >= n for h, n in zip(n_hit, n_words)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
                    pa.array(digest, pa.string()), pa.array(dirty, pa.bool_()), batch.column(4),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "row"],
            )

    return run


def contamination(
    index: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, hit_share: int = HIT_SHARE, query_bytes: int = QUERY_BYTES
) -> DataFrame:
    """One row per indexed document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, row.

    ``items`` has item_id and text.  Words inside any occurrence of a window of
    ``window`` item words (the whole item when it is shorter; none when it has no
    words) are hit; ``contaminated`` when ``hit_share * n_hit >= n_words`` and
    some word is hit.  ``row`` is (segment, ordinal), the document's place in the index.
    A null item_id is named by the empty string; without items nothing is hit.
    Null and empty texts have no words and are not hit; repeated rows are judged one by one; long texts are searched whole; other columns are not read.
    Words are told apart by 94 bits of two hashes.
    """
    id_type = dict(index.dtypes)["doc_ids"][len("array<") : -1]
    place = "row struct<segment: bigint, ordinal: int>"
    hits = f"doc_id {id_type}, n_words long, spans array<long>, items array<string>, {place}"
    verdicts = f"doc_id {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, {place}"
    query_blocks = _query_blocks(items, query_bytes)
    compiled = (Queries([(r["name"], r["text"]) for r in block.collect()], window) for block in query_blocks)
    if len(query_blocks) == 1:
        return index.mapInArrow(_judged(next(compiled), _id_type(index), hit_share), verdicts)
    # one block after the other, so that the driver and the tasks hold one at a time; after the first only documents that are hit make rows
    found = _union([stored(index.mapInArrow(_hits(queries, _id_type(index), k == 0), hits), "hits") for k, queries in enumerate(compiled)]).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"),
    )
    return found.select("doc_id", "n_words", "spans", "items", "row").mapInArrow(_verdicts(hit_share), verdicts)
