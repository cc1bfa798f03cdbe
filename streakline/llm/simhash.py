"""SimHash near-dedup with deletion-variant signatures.

Fingerprints at most three bits apart are cut into two segments, so that one
segment of any linked pair differs by at most one bit.
Each segment is indexed once per bit with that bit left out (a one-wildcard
variant); two segments at most one bit apart share a variant.  Distinct
fingerprints that meet in a variant are verified on all 64 bits.  A variant's
members yield a spanning forest of their links, never all pairs, and
components follow from the forests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.components import components
from streakline.llm.tables import partitions_for, stored
from streakline.llm.textblocks import LOWER, WHITE, blocks, mix, row_bounds, word_spans

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Two segments: of two fingerprints at most three bits apart, one segment differs in at most one bit.
SEGMENT_BITS = 32
#: A variant with more members is split by the bits that it leaves open.
MEMBERS = 20_000
VARIANTS_PER_PARTITION = 2_000_000


def _fingerprints(shingle_words: int):
    def run(batches):
        for rows, data, offsets in blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(block_fingerprints(data, offsets, shingle_words).view(np.int64))],
                names=["row_id", "doc_id", "fp"],
            )

    return run


def block_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle_words: int) -> np.ndarray:
    """SimHash of each row: bit set when set in over half of the shingles' XXH64."""
    n_rows = len(offsets) - 1
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets, ~WHITE)
    out = np.zeros(n_rows, np.uint64)
    if len(starts) == 0:
        return out
    # words of the block, one space after each
    length = ends - starts
    at = np.concatenate(([0], np.cumsum(length + 1)))
    joined = np.full(at[-1], 0x20, np.uint8)
    place = np.repeat(starts - at[:-1], length)
    target = np.arange(len(place)) + np.repeat(np.arange(len(length)), length)
    joined[target] = data[target + place]
    view = joined.tobytes()
    bounds = row_bounds(row, n_rows)
    count = np.diff(bounds)
    shingles = np.where(count > 0, np.maximum(count - shingle_words + 1, 1), 0)
    first = np.repeat(bounds[:-1], shingles) + np.arange(shingles.sum()) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = np.minimum(first + shingle_words, np.repeat(bounds[1:], shingles))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(view[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist())), np.uint64, len(first)
    )
    full = shingles > 0
    begin = (np.cumsum(shingles) - shingles)[full]
    # 8 bits at a time keeps the unpacked bits small
    ones = np.empty((len(begin), 64), np.int64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        bits = np.unpackbits(octets[:, k : k + 1], axis=1, bitorder="little")
        ones[:, 8 * k : 8 * k + 8] = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    major = 2 * ones > shingles[full][:, None]
    out[full] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _variants():
    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            slot = 0
            for first in (0, SEGMENT_BITS):
                part = (fp >> np.uint64(first)) & np.uint64((1 << SEGMENT_BITS) - 1)
                for bit in range(SEGMENT_BITS):
                    key = (part & ~np.uint64(1 << bit)) | np.uint64(slot << 32)
                    slot += 1
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], names=["key", "fp"])

    return run


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (smallest member reached, member) that join exactly the members linked within ``fps`` (distinct)."""
    left = np.sort(fps)
    roots, nodes = [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= max_bits
            if near.any():
                hit, left = left[near], left[~near]
                roots.append(np.full(len(hit), root))
                nodes.append(hit)
                queue.extend(hit)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *roots]), np.concatenate([none, *nodes])


def _links(max_bits: int, most: int | None):
    """Sorted (key, fp) rows to edges (a, b) of each key's forest; members of a key with over ``most`` come out as (key, fp)."""

    def run(batches):
        key_left, fp_left, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None

        def out(a, b, key=None):
            n = len(a)
            keys = pa.nulls(n, pa.int64()) if key is None else pa.array(np.full(n, key), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), keys], names=["a", "b", "key"]
            )

        def groups(key, fp):
            start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(start, len(key)))
            for d in (1, 2, 3):  # up to four members: at most six candidate pairs
                i = np.concatenate([start[size == m] + k for m in (2, 3, 4) for k in range(m - d)] or [start[:0]])
                i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits]
                if len(i):
                    yield out(fp[i], fp[i + d])
            for s, m in zip(start[size > 4].tolist(), size[size > 4].tolist()):
                a, b = forest(fp[s : s + m], max_bits)
                if len(a):
                    yield out(a, b)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = np.concatenate((key_left, batch.column(0).to_numpy()))
            fp = np.concatenate((fp_left, batch.column(1).to_numpy().view(np.uint64)))
            if hot is not None:
                same = int(np.searchsorted(key, hot, "right"))
                yield out(fp[:same], fp[:same], hot)
                key, fp = key[same:], fp[same:]
                if len(key) == 0:
                    key_left, fp_left = key, fp
                    continue
                hot = None
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield from groups(key[:last], fp[:last])
            key_left, fp_left = key[last:], fp[last:]
            if most is not None and len(key_left) > most:
                hot = key_left[0]
                yield out(fp_left, fp_left, hot)
                key_left, fp_left = key_left[:0], fp_left[:0]
        if len(key_left):
            yield from groups(key_left, fp_left)

    return run


#: Low bits of a split variant's key: whose segment it is of (1), rounds of splitting (3), the piece chosen in each (2 each).
PATH = (1 << 12) - 1
ROUNDS = 4


def _open_bits(path: int) -> np.ndarray:
    """Bits of a fingerprint on which members of a variant with this path may still differ, the wildcard aside."""
    bits = np.arange(32) + (32 if path & 1 else 0)  # a variant of the low segment leaves the high one open
    for r in range(path >> 1 & 7):
        bits = np.delete(bits, np.array_split(np.arange(len(bits)), 4)[path >> (4 + 2 * r) & 3])
    return bits


def _split(first: bool):
    """Members of a hot variant, once for each quarter of the open bits: differing in three bits at most, two linked members agree on one."""

    def run(batches):
        for batch in batches:
            key, fp = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().view(np.uint64)
            path = ((key >> np.uint64(32)) < 32).astype(np.int64) if first else (key & np.uint64(PATH)).astype(np.int64)
            for p in np.unique(path).tolist():
                own, rounds = path == p, p >> 1 & 7
                for c, piece in enumerate(np.array_split(_open_bits(p), 4)):
                    value = fp[own] & np.uint64(sum(1 << int(b) for b in piece))
                    name = mix(mix(key[own] + np.uint64(c)) ^ value) & ~np.uint64(PATH)
                    further = (p & 1) | (rounds + 1) << 1 | (p >> 4 & 0xFF) << 4 | c << (4 + 2 * rounds)
                    yield pa.RecordBatch.from_arrays([pa.array((name | np.uint64(further)).view(np.int64)), pa.array(fp[own].view(np.int64))], names=["key", "fp"])

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, members: int = MEMBERS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fps`` (fp) that connect exactly those within ``max_bits`` of each other.

    A variant of over ``members`` fingerprints is split by quarters of the bits that it leaves open, again and again; after ROUNDS of
    it at most 2**12 fingerprints agree on all that is fixed, so every group is bounded.
    """
    spark = fps.sparkSession
    parts = partitions_for(spark, fps.count() * 64, VARIANTS_PER_PARTITION)
    made, edges = fps.select("fp").mapInArrow(_variants(), "key long, fp long"), None
    for turn in range(ROUNDS + 1):
        found = stored(
            made.repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(_links(max_bits, members if turn < ROUNDS else None), "a long, b long, key long"),
            "links",
        )
        here = found.filter("key is null").select("a", "b")
        edges = here if edges is None else edges.union(here)
        hot = found.filter("key is not null").select("key", F.col("a").alias("fp"))
        if hot.isEmpty():
            break
        made = hot.mapInArrow(_split(turn == 0), "key long, fp long")
    return edges.distinct()


def simhash_components(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, members: int = MEMBERS, row_id: str | None = None
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, anything else): doc_id, fingerprint (16 hex digits), component_id, kept, row_id.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, the document itself included.  Null and empty
    texts have fingerprint zero and link like any other.  A null doc_id names a
    component only when no other is in it.  One row of each component has
    ``kept`` true: its smallest doc_id, of repeated rows the first.  ``row_id``
    is the unique bigint column of that name of ``docs``, or else numbers the
    rows of the one scan that ``docs`` is read in.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments find links of up to 3 bits")
    id_type = dict(docs.dtypes)["doc_id"]
    printed = stored(
        docs.select((F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id"), "doc_id", F.col("text").cast("string").alias("text"))
        .mapInArrow(_fingerprints(shingle_words), f"row_id long, doc_id {id_type}, fp long"),
        "simhash",
    )
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row_id")
    distinct = stored(printed.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    root = components(links(distinct, max_bits, members)).select(F.col("node").alias("fp"), "root")
    named = stored(distinct.join(root, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    return (
        printed.join(named.join(least, "root").select("fp", "least"), "fp")
        .select(
            "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"),
            (F.col("row_id") == F.col("least.row_id")).alias("kept"), "row_id",
        )
    )
