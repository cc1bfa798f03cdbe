"""Exact dedup by composable polynomial fingerprints.

Each text is normalised (white-space runs become one space), its bytes are cut
into chunks, and every chunk gets a polynomial hash modulo three primes.  A
chunk's hash is shifted by ``base ** (its start)`` and the shifted hashes add
up to the text's fingerprint, so chunks of a huge text are hashed independently
and combine in any order (:func:`combine`).  Rows with equal fingerprints are
then compared chunk by chunk with the row that stays; rows that differ after all
(a collision) are grouped again among themselves until none is left.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.tables import numbered_texts, small_side, stored
from streakline.llm.textblocks import blocks, one_space

#: Primes under 2**31: a product of two residues fits a signed 64-bit integer.
PRIMES = (2147483647, 2147483629, 2147483587)
BASE = 1000003
CHUNK_BYTES = 1 << 15
#: Members of a group that are compared with one copy of the row that stays; larger groups are salted.
MEMBERS_PER_SALT = 500

FINGERPRINT = ["f0", "f1", "f2", "n_bytes"]


def chunk_hashes(data: np.ndarray, starts: np.ndarray, prime: int) -> np.ndarray:
    """Hash of each chunk ``data[starts[i]:starts[i + 1]]`` (none empty, none longer than CHUNK_BYTES): ``sum(byte * BASE**i) % prime``."""
    if len(starts) == 0:
        return np.zeros(0, np.int64)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    power = np.array(_powers(min(CHUNK_BYTES, int(place.max()) + 1), prime), np.uint64)
    # a byte (8 bits) times a residue (31 bits), summed over 2**15 bytes, stays under 2**64
    return (np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[place], starts) % np.uint64(prime)).astype(np.int64)


def _powers(n: int, prime: int) -> list[int]:
    out, x = [], 1
    for _ in range(n):
        out.append(x)
        x = x * BASE % prime
    return out


def combine(left: tuple[int, int], right: tuple[int, int], prime: int) -> tuple[int, int]:
    """(hash, length) of a concatenation from those of its parts."""
    (h, n), (g, m) = left, right
    return (h + g * pow(BASE, n, prime)) % prime, n + m


def _fingerprints(primes: tuple[int, ...], chunk_bytes: int):
    def run(batches):
        for rows, data, offsets in blocks(batches, "text"):
            data, offsets = one_space(data, offsets)
            length = np.diff(offsets)
            chunks = -(-length // chunk_bytes)
            row = np.repeat(np.arange(len(length)), chunks)
            number = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
            starts = offsets[:-1][row] + number * chunk_bytes
            columns = []
            for prime in primes:
                total = np.zeros(len(length), np.int64)
                shift = np.array(_shifts(int(chunks.max(initial=0)), chunk_bytes, prime), np.int64)
                shifted = chunk_hashes(data, starts, prime) * shift[number] % prime
                np.add.at(total, row, shifted)
                columns.append(pa.array(total % prime, pa.int64()))
            view = data.tobytes()
            digest = [hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), *columns, pa.array(length, pa.int64()), pa.array(digest, pa.binary())],
                names=["row_id", "doc_id", "f0", "f1", "f2", "n_bytes", "digest"],
            )

    return run


def _shifts(n: int, chunk_bytes: int, prime: int) -> list[int]:
    step, out, x = pow(BASE, chunk_bytes, prime), [], 1
    for _ in range(n):
        out.append(x)
        x = x * step % prime
    return out


def _chunks(chunk_bytes: int, label: str):
    """Rows (row_id, f0, f1, f2, n_bytes, salt) + text become one row per chunk; an empty text has one empty chunk."""

    def run(batches):
        for rows, data, offsets in blocks(batches, "text"):
            data, offsets = one_space(data, offsets)
            view = data.tobytes()
            index, number, piece = [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                for k, at in enumerate(range(a, max(b, a + 1), chunk_bytes)):
                    index.append(i)
                    number.append(k)
                    piece.append(view[at : min(b, at + chunk_bytes)])
            rows = rows.select([c for c in rows.schema.names if c != "text"]).take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(number, pa.int32()), pa.array(piece, pa.binary())],
                names=[*rows.schema.names, "chunk", label],
            )

    return run


def exact_groups(
    docs: DataFrame, primes: tuple[int, int, int] = PRIMES, chunk_bytes: int = CHUNK_BYTES, members_per_salt: int = MEMBERS_PER_SALT,
    row_id: str | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, anything else): doc_id, keep_id, group_size, kept, text_sha256, row_id.

    Null text counts as empty, and empty texts are equal to each other.  Of
    equal texts the row with the smallest doc_id stays (a null doc_id sorts
    last); of repeated rows with that same doc_id exactly one has ``kept``
    true.  ``row_id`` tells repeated rows apart: it is the unique bigint column of that
    name of ``docs``, a stored table, which is then read several times; without one ``docs`` is read
    once, numbered and stored.
    """
    if chunk_bytes > CHUNK_BYTES:
        raise ValueError(f"chunk_bytes over {CHUNK_BYTES} could overflow a chunk's sum")
    rows = numbered_texts(docs, row_id)
    id_type = dict(rows.dtypes)["doc_id"]
    printed = stored(
        rows.mapInArrow(
            _fingerprints(tuple(primes), chunk_bytes),
            f"row_id long, doc_id {id_type}, f0 long, f1 long, f2 long, n_bytes long, digest binary",
        ),
        "fingerprints",
    )
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row_id")
    done, open_rows = [], printed
    while True:
        # the round of a group: its first open row is the one that stays, and the others are held against it
        groups = open_rows.groupBy(*FINGERPRINT).agg(F.count("*").alias("n"), F.min(order).alias("first"))
        several = stored(
            groups.filter("n > 1").select(*FINGERPRINT, "n", F.col("first.row_id").alias("first_row")), "groups"
        )
        n_groups = several.count()
        if n_groups == 0:
            done.append(open_rows.select("row_id", F.col("row_id").alias("keep_row")))
            break
        members = stored(
            open_rows.join(small_side(several, n_groups, 64), FINGERPRINT, "left").select(
                "row_id", *FINGERPRINT, "n", "first_row",
                F.pmod(F.xxhash64("row_id"), F.ceil(F.col("n") / members_per_salt)).alias("salt"),
            ),
            "members",
        )
        in_groups = members.filter("n is not null")
        n_members = in_groups.count()
        text = rows.select("row_id", "text").join(small_side(in_groups.drop("n"), n_members, 72), "row_id")
        kinds = {f.name: f.dataType.simpleString() for f in text.schema}
        # the copy of the first row that each salt needs
        first = (
            text.filter("row_id = first_row")
            .join(several.select("first_row", "n"), "first_row")
            .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n") / members_per_salt) - 1)))
            .select("first_row", "salt", "text")
            .mapInArrow(_chunks(chunk_bytes, "kept_bytes"), "first_row long, salt long, chunk int, kept_bytes binary")
        )
        others = (
            text.filter("row_id <> first_row")
            .select("row_id", "first_row", "salt", "text")
            .mapInArrow(_chunks(chunk_bytes, "own_bytes"), f"row_id long, first_row long, salt {kinds['salt']}, chunk int, own_bytes binary")
        )
        compared = stored(
            others.join(first, ["first_row", "salt", "chunk"], "left")
            .groupBy("row_id", "first_row")
            .agg(F.every(F.coalesce(F.col("own_bytes") == F.col("kept_bytes"), F.lit(False))).alias("same")),
            "compared",
        )
        equal = compared.filter("same").select("row_id", F.col("first_row").alias("keep_row"))
        heads = several.select(F.col("first_row").alias("row_id"), F.col("first_row").alias("keep_row"))
        alone = members.filter("n is null").select("row_id", F.col("row_id").alias("keep_row"))
        done += [alone, heads, equal]
        left = compared.filter(~F.col("same")).select("row_id")
        if left.isEmpty():
            break
        open_rows = stored(printed.join(left, "row_id", "left_semi"), "open")
    keep = done[0]
    for part in done[1:]:
        keep = keep.unionByName(part)
    keep = stored(keep, "keep")
    sizes = (
        keep.groupBy("keep_row").agg(F.count("*").alias("group_size"))
        .join(printed.select(F.col("row_id").alias("keep_row"), F.col("doc_id").alias("keep_id")), "keep_row")
    )
    return (
        printed.select("row_id", "doc_id", "digest")
        .join(keep, "row_id")
        .join(sizes, "keep_row")
        .select(
            "doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"), "row_id",
        )
    )
