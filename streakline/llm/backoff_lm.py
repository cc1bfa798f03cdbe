"""Stupid-backoff scores of documents under the corpus, computed as joins with n-gram count tables.

Documents are stored once as compressed parts of blocks, so that every later scan
finds the same blocks; one that a scan cuts in two is put together again.  Each block explodes into its distinct n-grams of
every order, pre-aggregated and partitioned by hash into buckets.  A bucket adds
up the counts of its n-grams over all blocks -- its share of the count table --
and joins them back to the n-grams that each block asked for.  A last shuffle
brings a block's counts and documents together, where scores are summed per
document.  Rows carry sorted arrays of n-grams, not single ones: an n-gram
costs about four bytes of shuffle and a frequent one is a single entry per block.

By default a document's own n-grams are taken off the counts, so that it is scored under the
rest of the corpus and backoff has something to do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streakline.llm.tables import partitions_for, stored
from streakline.llm.textblocks import LOWER, WHITE, blocks, mix, row_bounds, word_hashes, word_spans

ORDER = 3
ALPHA = 0.4
#: Bytes of text per block, and of the corpus per bucket of the count tables.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
#: Bits of an n-gram's hash within its bucket, which holds about a million n-grams of an order: at any size of the
#: corpus about one in two million shares its key, and so its count, with another.
KEY_BITS = 40


class Block:
    """Words of consecutive documents and their n-grams."""

    def __init__(self, block: int, ids: list, counts: np.ndarray, words: np.ndarray):
        self.block, self.ids, self.n_words, self.words = block, ids, counts, words
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)

    def ngrams(self, order: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Last word of every n-gram of ``order`` words, and the n-gram's key: bucket, then hash."""
        last = np.flatnonzero(self.place >= order - 1)
        key = mix(self.words[last] + np.uint64(order))
        for back in range(1, order):
            key = mix(key * np.uint64(3) + self.words[last - back])
        bucket = (key & np.uint64((1 << 24) - 1)) % np.uint64(n_buckets)
        return last, (bucket << np.uint64(KEY_BITS)) | (key >> np.uint64(64 - KEY_BITS))


def _pack(rows: pa.RecordBatch) -> bytes:
    """Rows as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpack(part: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(part).read_next_batch()


def _hashed(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each row (doc_id, text), and the hashes of all of them."""
    counts, words = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for part, data, offsets in blocks([rows], "text"):
        low = LOWER[data]
        starts, ends, row = word_spans(low, offsets, ~WHITE)
        counts.append(np.bincount(row, minlength=part.num_rows))
        words.append(word_hashes(low, starts, ends))
    return np.concatenate(counts), np.concatenate(words)


def _blocks(batches) -> Iterator[Block]:
    """Blocks, or the parts of them that a task meets, out of rows (block, rows)."""
    counts, words, now = [], [], None
    for batch in batches:
        for name, part in zip(*(c.to_pylist() for c in batch.columns)):
            if now != name:
                if counts:
                    yield Block(now, [], np.concatenate(counts), np.concatenate(words))
                counts, words, now = [], [], name
            n, hashes = _hashed(_unpack(part))
            counts.append(n)
            words.append(hashes)
    if counts:
        yield Block(now, [], np.concatenate(counts), np.concatenate(words))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, of four bytes where they fit."""
    step = np.diff(keys, prepend=np.uint64(0))
    kind = np.uint32 if len(step) == 0 or step.max() < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + step.astype(kind).tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, f"u{packed[0]}", offset=1).astype(np.uint64))


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in a byte each; those of 255 and more follow in eight."""
    large = counts >= 255
    return len(counts).to_bytes(4, "little") + np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype(np.int64).tobytes()


def unpack_counts(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    counts = np.frombuffer(packed, np.uint8, n, 4).astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed, np.int64, offset=4 + n)
    return counts


def _asked(order: int, n_buckets: int):
    """Distinct n-grams of each block with their counts, a row for each order and bucket."""

    def run(batches):
        for block in _blocks(batches):
            for n in range(1, order + 1):
                key, counts = np.unique(block.ngrams(n, n_buckets)[1], return_counts=True)
                bucket = key >> np.uint64(KEY_BITS)
                edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(key) else np.zeros(0, np.int64)
                inside = key & np.uint64((1 << KEY_BITS) - 1)
                spans = list(zip(edge.tolist(), np.append(edge[1:], len(key)).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[edge].astype(np.int32)), pa.array(np.full(len(edge), n, np.int32)),
                        pa.array(np.full(len(edge), block.block, np.int64)),
                        pa.array([pack_sorted(inside[a:b]) for a, b in spans], pa.binary()),
                        pa.array([pack_counts(counts[a:b]) for a, b in spans], pa.binary()),
                    ],
                    names=["bucket", "order", "block", "keys", "counts"],
                )

    return run


def _answered(batches):
    """Rows sorted by bucket and order: each block's n-grams get their counts over all blocks."""

    def answer(bucket, order, rows):
        keys = [unpack_sorted(r[1]) for r in rows]
        counts = [unpack_counts(r[2]) for r in rows]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts)).astype(np.int64)[place]
        at = np.cumsum([0, *map(len, keys)])
        parts: dict[int, list[int]] = {}  # of each block, more than one when a scan cut it
        for k, r in enumerate(rows):
            parts.setdefault(r[0], []).append(k)
        answers = []
        for own in parts.values():
            found = np.concatenate([total[at[k] : at[k + 1]] for k in own])
            if len(own) > 1:
                found = found[np.unique(np.concatenate([keys[k] for k in own]), return_index=True)[1]]
            answers.append(pack_counts(found))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(parts), pa.int64()), pa.array([order] * len(parts), pa.int32()), pa.array([bucket] * len(parts), pa.int32()),
                pa.array(answers, pa.binary()),
            ],
            names=["block", "order", "bucket", "packed"],
        )

    now, held = None, []
    for batch in batches:
        for bucket, order, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if now != (bucket, order):
                if held:
                    yield answer(*now, held)
                now, held = (bucket, order), []
            held.append(row)
    if held:
        yield answer(*now, held)


def _scores(block: Block, count: dict[int, np.ndarray], order: int, n_buckets: int, total: int, alpha: float, leave_one_out: bool) -> np.ndarray:
    """Summed log scores of the block's documents; ``count[n]`` are the corpus counts of its distinct n-grams by key."""
    found = []  # of each word, the count of the n-gram that it ends, for n = 1, 2, ..
    for n in range(1, order + 1):
        last, key = block.ngrams(n, n_buckets)
        distinct, number = np.unique(key, return_inverse=True)
        if len(distinct) != len(count.get(n, ())):
            raise RuntimeError("a block met other documents than before")
        counts = np.zeros(len(block.words), np.int64)
        if len(last):
            own = 0
            if leave_one_out:
                pair = block.doc[last].astype(np.int64) << 32 | number
                _, which, times = np.unique(pair, return_inverse=True, return_counts=True)
                own = times[which]
            counts[last] = count[n][number] - own
        found.append(counts)
    rest = np.maximum(total - block.n_words * leave_one_out, 1)[block.doc]
    context = np.minimum(block.place, order - 1)
    score = np.full(len(block.words), np.nan)
    for n in range(order, 0, -1):
        open_ = np.isnan(score) & (context >= n - 1) & (found[n - 1] > 0)
        at = np.flatnonzero(open_)
        below = found[n - 2][at - 1] if n > 1 else rest[at]
        score[at] = np.log(found[n - 1][at]) - np.log(below) + (context[at] + 1 - n) * math.log(alpha)
    unseen = np.isnan(score)
    score[unseen] = (context[unseen] + 1) * math.log(alpha) - np.log(rest[unseen])
    return np.bincount(block.doc, score, len(block.n_words))


def _summed(id_type: pa.DataType, order: int, n_buckets: int, total: int, alpha: float, leave_one_out: bool):
    """Rows of a block -- counts by order and bucket, then documents -- to a score for each document."""

    def settle(block, counts, parts):
        count = {n: np.concatenate([unpack_counts(c) for _, c in sorted(found)]) for n, found in counts.items()}
        rows = pa.Table.from_batches([_unpack(p) for p in parts]).combine_chunks().to_batches()[0]
        whole = Block(block, [], *_hashed(rows))
        for n in range(1, order + 1):
            count.setdefault(n, np.zeros(0, np.int64))
        score = _scores(whole, count, order, n_buckets, total, alpha, leave_one_out)
        return pa.RecordBatch.from_arrays([rows.column(0).cast(id_type), pa.array(whole.n_words), pa.array(score)], names=["doc_id", "n_words", "log_score"])

    def run(batches):
        now, counts, parts = None, {}, []
        for batch in batches:
            for block, n, bucket, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if now != block:
                    if parts:
                        yield settle(now, counts, parts)
                    now, counts, parts = block, {}, []
                if n:
                    counts.setdefault(n, []).append((bucket, packed))
                else:
                    parts.append(packed)
        if parts:
            yield settle(now, counts, parts)

    return run


def _named(batches):
    """The documents in compressed parts of blocks of about BLOCK_BYTES; a block is named by its first row."""
    name, size = None, 0
    for rows, data, offsets in blocks(batches, "text"):
        first = rows.column(0)[0].as_py()
        name = first if name is None else name
        starts, _, _ = word_spans(data, offsets, ~WHITE)
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([x], pa.int64()) for x in (name, first, len(data), len(starts))),
                pa.array([_pack(pa.RecordBatch.from_arrays(rows.columns[1:], names=["doc_id", "text"]))], pa.binary()),
            ],
            names=["block", "first", "bytes", "words", "rows"],
        )
        size += len(data)
        if size >= BLOCK_BYTES:
            name, size = None, 0


def backoff_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, leave_one_out: bool = True) -> DataFrame:
    """doc_id, n_words, log_score (natural, summed over the words), mean_log_score for each row of ``docs`` (doc_id, text, anything else).

    Words are runs of non-white-space, ASCII letters in lower case.  A word is
    scored with as many words before it as there are, up to ``order - 1``; each
    step back costs a factor ``alpha``, and a word that the rest of the corpus
    does not have counts as one occurrence a step below single words.  Null and
    empty texts have no words, score 0 and no mean.  ``docs`` is read
    once, and stored in blocks.  N-grams are told apart by hashes (see KEY_BITS).
    A row of the shuffles holds a block's n-grams of one bucket; however many blocks and buckets there are, rows are never more than n-grams.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", F.col("text").cast("string").alias("text"))
    id_type = dict(rows.dtypes)["doc_id"]
    # the parts are compressed already
    named = stored(rows.mapInArrow(_named, "block long, first long, bytes long, words long, rows binary"), "blocks", "uncompressed")
    size, total = named.agg(F.sum("bytes"), F.sum("words")).first()
    n_buckets = max(16, math.ceil((size or 0) / BUCKET_BYTES))
    # a bucket's n-grams and a block's documents come from about as many bytes of text, so tasks stay as they are however large the corpus
    parts = partitions_for(docs.sparkSession, n_buckets, 1)
    answers = (
        named.select("block", "rows").mapInArrow(_asked(order, n_buckets), "bucket int, order int, block long, keys binary, counts binary")
        .repartition(parts, "bucket").sortWithinPartitions("bucket", "order")
        .mapInArrow(_answered, "block long, order int, bucket int, packed binary")
    )
    both = answers.withColumn("first", F.lit(-1).cast("long")).union(named.select("block", F.lit(0), F.lit(0), "rows", "first"))
    scored = (
        both.repartition(parts, "block").sortWithinPartitions("block", "first").drop("first")
        .mapInArrow(
            _summed(to_arrow_type(rows.schema["doc_id"].dataType), order, n_buckets, total or 0, alpha, leave_one_out),
            f"doc_id {id_type}, n_words long, log_score double",
        )
    )
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
