"""Quality classifier by importance resampling with hashed n-gram generative models.

A text is a set of hashed n-grams: words, word-initial character n-grams and
pairs of word shapes (capitals, signs, repetition).  Every model is a smoothed
multinomial over the buckets.  The *target* is what labelled rows call good;
*raw* text is a mixture of the target, of the whole corpus without the target's rows, and of the unwanted kinds
among the labelled rows, each smoothed towards the counts of the whole corpus.  The importance
weight of a text is the ratio target / raw of its likelihoods, and the documents
kept are the Gumbel top-k of the log weights: a sample without replacement in
proportion to the weights.  By default k is the number of documents that are
more likely target than not.  Text of an unwanted kind that no label has is still rarer in the target
than in the corpus, and loses weight by that.

What a bucket says of two kinds is shrunk by how sure it is: the log of the ratio moves towards 0 by its
own error, and counts less the nearer the two counts are to chance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.tables import stored
from streakline.llm.textblocks import LOWER, WHITE, SpanHash, blocks, mix, word_spans

BUCKETS = 1 << 20
#: Counts travel in vectors of so many buckets.
SLICE = 1 << 12
#: Labelled rows of each kind that the models are fitted on, at most (those with the smallest hash of doc_id).
LABELLED_ROWS = 12_000
#: Strength of the corpus in a kind's smoothed model, in documents per bucket.
PRIOR = 0.5
#: Share of raw text that is taken to be of no labelled kind: it has the model of the whole corpus.
RAW_SHARE = 0.05
#: Standard errors of a log ratio that it is shrunk by.
CAUTION = 1.0
#: A difference of so many standard errors, or a log ratio of such a size, has half its weight; both fall with the fourth power.
HALF_SIGNIFICANT, HALF_EFFECT = 2.5, 2.0
#: Bytes of the word-initial character n-grams.
PREFIX_BYTES = (4, 5, 6, 7, 8)
#: A word and its beginnings say much the same, so each of them has this share of a vote.
WORD_SHARE = 0.2
#: Kinds of labelled rows; the first is the target.
KINDS = ("good", "toxic", "poor")
#: Weights are raised to 1 / TEMPERATURE before sampling; 1 samples by the plain ratio.
TEMPERATURE = 0.25
SEED = 1
#: Keys that the search for the k-th largest may fetch at once.
FEW_KEYS = 5_000

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def block_features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct n-grams of each text of a block; shape pairs have the upper half of the buckets."""
    lower = LOWER[data]
    hashed = SpanHash(lower)
    starts, ends, row = word_spans(data, offsets, LETTER)
    word = hashed(starts, ends)
    opening, opening_row = [], []
    for n in PREFIX_BYTES:
        longer = np.flatnonzero(ends - starts > n)
        opening.append(hashed(starts[longer], starts[longer] + n, seed=n))
        opening_row.append(row[longer])

    starts, ends, shape_row = word_spans(data, offsets, ~WHITE)
    token = hashed(starts, ends)
    next_pair = np.flatnonzero(shape_row[1:] == shape_row[:-1])
    repeat = np.zeros(len(starts), bool)
    repeat[next_pair + 1] = token[next_pair + 1] == token[next_pair]
    head, second = data[starts], data[np.minimum(starts + 1, ends - 1)]
    tail, before = data[ends - 1], data[np.maximum(ends - 2, starts)]
    capital = lambda b: (b >= 0x41) & (b <= 0x5A)
    bits = (
        np.where(LETTER[tail], 0, tail), ~LETTER[before], np.where(LETTER[head], 0, head), capital(head), capital(second), repeat,
    )
    shape = np.zeros(len(starts), np.uint64)
    for value, width in zip(bits, (8, 1, 8, 1, 1, 1)):
        shape = (shape << np.uint64(width)) | value.astype(np.uint64)
    shapes = mix((shape[next_pair] << np.uint64(20)) | shape[next_pair + 1] | np.uint64(1 << 60))
    half = np.uint64(buckets // 2)
    words = mix(np.concatenate((word, *opening))) % half
    key = np.concatenate((
        (np.concatenate((row, *opening_row)).astype(np.uint64) << np.uint64(32)) | words,
        (shape_row[next_pair].astype(np.uint64) << np.uint64(32)) | (shapes % half + half),
    ))
    key.sort()
    key = key[np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]]
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def block_sketches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Smallest hash of three words in a row of each text (of its words when it has fewer): near copies mostly share it."""
    lower = LOWER[data]
    starts, ends, row = word_spans(data, offsets, LETTER)
    word = SpanHash(lower)(starts, ends)
    three = np.flatnonzero(row[2:] == row[:-2])
    out = np.full(len(offsets) - 1, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(out, row, mix(word) | np.uint64(1 << 63))
    np.minimum.at(out, row[three], mix(word[three] * np.uint64(3) + word[three + 1] * np.uint64(7) + word[three + 2]) >> np.uint64(1))
    return out


def _sketches(batches):
    for rows, data, offsets in blocks(batches, "text"):
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(block_sketches(data, offsets).view(np.int64))], names=["doc_id", "kind", "sketch"]
        )


def _counts(buckets: int):
    """Documents per bucket: of all rows (kind -1) and of the labelled ones, as vectors of SLICE buckets."""

    def run(batches):
        count = {-1: np.zeros(buckets, np.int64)}
        for rows, data, offsets in blocks(batches, "text"):
            row, bucket = block_features(data, offsets, buckets)
            count[-1] += np.bincount(bucket, minlength=buckets)
            kinds = rows.column(0).fill_null(-1).to_numpy()
            for kind in np.unique(kinds[kinds >= 0]).tolist():
                own = np.bincount(bucket[kinds[row] == kind], minlength=buckets)
                count[kind] = count.get(kind, 0) + own
        for kind, vector in count.items():
            for at in range(0, buckets, SLICE):
                yield _vector(kind, at, vector[at : at + SLICE])

    return run


def _vector(kind: int, at: int, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind], pa.int32()), pa.array([at], pa.int32()), pa.array([n.astype(np.int64).tobytes()], pa.binary())],
        names=["kind", "at", "n"],
    )


def _added(batches):
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for kind, at, n in zip(*(c.to_pylist() for c in batch.columns)):
            total[kind, at] = total.get((kind, at), 0) + np.frombuffer(n, np.int64)
    for (kind, at), n in total.items():
        yield _vector(kind, at, n)


def _doubt(x: np.ndarray, half: float) -> np.ndarray:
    """0 for nothing, 1/2 at ``half``, 1 for much more."""
    x = np.minimum(np.abs(x) / half, 1e6) ** 4
    return x / (1 + x)


def log_ratios(raw: np.ndarray, target: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Per bucket, the log of other / target, shrunk by how sure and how large it is."""
    p_raw = (raw + 1e-3) / (raw + 1e-3).sum()
    n, m = max(other.sum(), 1), max(target.sum(), 1)
    pooled = (other + target) / (n + m) + 1e-15
    z = (other / n - target / m) / np.sqrt(pooled * (1 / n + 1 / m))
    ratio = np.log((other + PRIOR) / (n * p_raw + PRIOR)) - np.log((target + PRIOR) / (m * p_raw + PRIOR))
    error = np.sqrt(1 / (other + 0.5) + 1 / (target + 0.5))
    ratio = np.sign(ratio) * np.maximum(0, np.abs(ratio) - CAUTION * error)
    ratio *= _doubt(z, HALF_SIGNIFICANT)
    ratio *= _doubt(ratio, HALF_EFFECT)
    ratio[: len(ratio) // 2] *= WORD_SHARE
    return ratio


def _weights(buckets: int, shares: np.ndarray, ratios: list[np.ndarray]):
    """Log weight, probability of the target and Gumbel key of each row."""

    def run(batches):
        for rows, data, offsets in blocks(batches, "text"):
            row, bucket = block_features(data, offsets, buckets)
            # log of (share * likelihood / target's likelihood) of each kind of the mixture
            parts = np.stack([np.zeros(rows.num_rows), *(np.bincount(row, r[bucket], rows.num_rows) for r in ratios)])
            log_weight = -np.logaddexp.reduce(parts + np.log(shares)[:, None], axis=0)
            noise = (rows.column(2).to_numpy().view(np.uint64) >> np.uint64(11)).astype(float) / 2.0**53
            gumbel = -np.log(-np.log(np.clip(noise, 1e-300, 1 - 2.0**-53)))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), rows.column(1), pa.array(log_weight),
                    pa.array(np.minimum(1.0, shares[0] * np.exp(log_weight))), pa.array(log_weight / TEMPERATURE + gumbel),
                ],
                names=["row_id", "doc_id", "log_weight", "p_target", "sample_key"],
            )

    return run


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value (1 <= k <= rows): ranges are counted ever finer until few values are left to fetch."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0  # values over `high`
    while low < high:
        inside = df.filter(F.col(column).between(low, high))
        width = (high - low) / 256
        if low + width <= low or inside.count() <= FEW_KEYS:
            # few values, or all within the last digits of a double
            for value, n in inside.groupBy(column).count().orderBy(F.col(column).desc()).limit(FEW_KEYS).collect():
                above += n
                if above >= k:
                    return value
        cell = F.least(F.floor((F.col(column) - low) / width), F.lit(255)).cast("int").alias("cell")
        cells = inside.groupBy(cell).agg(F.count("*").alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).collect()
        for c in sorted(cells, key=lambda c: -c["cell"]):
            if above + c["n"] >= k:
                low, high = c["a"], c["b"]
                break
            above += c["n"]
    return low


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, kind) of at most ``rows`` labelled documents of each kind without near copies, and the labels of each kind.

    A document is toxic when any of its label rows says so, else poor when any
    says quality 0, else good; null labels are left out.
    """
    kinds = (
        labels.filter("doc_id is not null and (quality is not null or toxic is not null)")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
        .select("doc_id", F.expr("CASE WHEN toxic = 1 THEN 1 WHEN quality = 0 THEN 2 WHEN quality = 1 THEN 0 END").alias("kind"))
        .filter("kind is not null")
    )
    share = {r["kind"]: r["n"] for r in kinds.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    parts = [kinds.filter(F.col("kind") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in range(len(KINDS))]
    some = stored(parts[0].union(parts[1]).union(parts[2]), "labelled")
    id_type = dict(docs.dtypes)["doc_id"]
    sketched = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(some), "doc_id")  # at most len(KINDS) * rows ids
        .select("doc_id", "kind", "text").mapInArrow(_sketches, f"doc_id {id_type}, kind int, sketch long")
    )
    single = sketched.groupBy("kind", "sketch").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "kind").distinct()
    return stored(single, "sample"), share


def importance_weights(
    docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, buckets: int = BUCKETS, row_id: str | None = None
) -> DataFrame:
    """Stored row_id, doc_id, log_weight, p_target, sample_key for every row of ``docs`` (doc_id, text, anything else).

    Null text is empty and has the weight of a text without n-grams.  Kinds
    without labelled rows are no part of the mixture; without target rows every
    weight is 1.  Long texts count whole.  Repeated rows are rows of their own; those with one doc_id
    share their noise, and so their key where their texts are equal.  An empty table gives no rows.  ``row_id`` is the unique bigint column of that
    name of ``docs``, or else numbers the rows of the scan that weighs them.
    """
    rows = docs.select(
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id"), "doc_id", F.xxhash64("doc_id", F.lit(SEED)).alias("noise"),
        F.col("text").cast("string").alias("text"),
    )
    sample, share = labelled_sample(docs, labels, labelled_rows)
    counted = (
        rows.join(F.broadcast(sample), "doc_id", "left").select("kind", "text").mapInArrow(_counts(buckets), "kind int, at int, n binary")
        .repartition("kind", "at").mapInArrow(_added, "kind int, at int, n binary")
    )
    vectors = {k: np.zeros(buckets) for k in range(-1, len(KINDS))}
    for kind, at, n in counted.collect():  # (1 + len(KINDS)) * buckets numbers, whatever the corpus
        vectors[kind][at : at + SLICE] = np.frombuffer(n, np.int64)
    present = [k for k in range(1, len(KINDS)) if share.get(k) and share.get(0)]
    shares = np.array([share.get(0, 1), *(share[k] for k in present)], float)
    shares /= shares.sum()
    ratios = [log_ratios(vectors[-1], vectors[0], vectors[k]) for k in present]
    if share.get(0):
        shares = np.array([*(shares * (1 - RAW_SHARE)), RAW_SHARE])
        ratios.append(log_ratios(vectors[-1], vectors[0], vectors[-1] - vectors[0]))
    id_type = dict(docs.dtypes)["doc_id"]
    return stored(
        rows.mapInArrow(
            _weights(buckets, shares, ratios),
            f"row_id long, doc_id {id_type}, log_weight double, p_target double, sample_key double",
        ),
        "weights",
    )


def resample(weights: DataFrame, keep: float | None = None) -> DataFrame:
    """``weights`` with ``kept``: the Gumbel top-k, for k a share ``keep`` of the rows or (``None``) the rows more likely target than not.

    Rows tied with the k-th key are all kept; no rows give no rows.
    """
    n, implied = weights.agg(F.count("*"), F.count_if(F.col("p_target") >= 0.5)).first()
    k = implied if keep is None else min(n, round(keep * n))
    threshold = kth_largest(weights, "sample_key", k) if k else float("inf")
    return weights.withColumn("kept", F.col("sample_key") >= F.lit(threshold))
