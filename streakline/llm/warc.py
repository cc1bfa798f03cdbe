"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Reading splits the files at the record magic, which may as well occur inside a
payload.  The files are read once: each task stores its split in pieces, rows
with their place in it and their candidates -- places after a magic -- with the offset of the
successor that the candidate's Content-Length implies, chains within the piece
contracted.  What is left is a small table of
pieces' entries and exits; pointer jumping from each file's start keeps
the entries that are reachable.  A last pass walks every stored piece from its verified
entry, so magic inside a payload never starts a record; a payload that
contains it is put together again.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streakline.llm.tables import BROADCAST_BYTES, small_side, stored
from streakline.session import scratch_path

MAGIC = "WARC/1.1\r\n"
BREAK = b"\r\n\r\n"
#: Bytes of a stored piece of a split (a row, read whole by one task); a longer part of a record is a piece of its own.
PIECE_BYTES = 256 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Control characters, blanks and angle brackets, which would end a header field or its value.
ESCAPED = {c: f"%{c:02X}" for c in (*range(0x21), 0x3C, 0x3E, 0x7F)}


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, fields: list[tuple[str, str]], block: str) -> str:
    """Text of a record without its last line feed, which the text writer adds."""
    head = "".join(f"{name}: {value}\r\n" for name, value in [("WARC-Type", kind), *fields])
    return f"{MAGIC}{head}Content-Length: {len(block.encode())}\r\n\r\n{block}\r\n\r"


def _records(date: str):
    def run(batches):
        fields = [("WARC-Record-ID", "<urn:x-page:info>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
        yield pa.RecordBatch.from_arrays([pa.array([_record("warcinfo", fields, "format: WARC File Format 1.1\r\n")])], names=["value"])
        for batch in batches:
            out = []
            for page, uri, html, refers in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (html or "").encode()
                fields = [("WARC-Record-ID", f"<urn:x-page:{'' if page is None else page}>"), ("WARC-Date", date)]
                if uri is not None:
                    fields.append(("WARC-Target-URI", uri.translate(ESCAPED)))
                fields.append(("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"))
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                if refers is None:
                    fields.append(("Content-Type", "application/http; msgtype=response"))
                    out.append(_record("response", fields, http + (html or "")))
                else:
                    fields += [
                        ("WARC-Refers-To", f"<urn:x-page:{refers}>"), ("WARC-Profile", PROFILE),
                        ("Content-Type", "application/http; msgtype=response"),
                    ]
                    out.append(_record("revisit", fields, http))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    return run


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row of ``pages`` (page_id, url, html, anything else) in files under ``path``.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the
    largest page_id is a response and the others revisit it; repeated rows with
    that page_id are all responses, and so are rows with a null page_id.  Null
    html is an empty payload; a null url has no target header.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("same", F.sha2("html", 256))
    large = keyed.filter(F.octet_length("html") >= min_bytes).select("same", "page_id")
    groups = stored(
        large.groupBy("same").agg(F.count("*").alias("n"), F.max("page_id").alias("largest")).filter("n > 1").drop("n"), "payloads"
    )
    refers = F.when(F.col("page_id") < F.col("largest"), F.col("largest")).cast("string")
    (
        keyed.join(small_side(groups, groups.count(), 96), "same", "left")
        .select(F.col("page_id").cast("string").alias("page"), "url", "html", refers.alias("refers"))
        .mapInArrow(_records(date), "value string").write.option("lineSep", "\n").text(path)
    )


def _needed(text: bytes) -> int | None:
    """Bytes from a record's first header to its end, as its Content-Length says; None when that is no record header."""
    head = text.find(BREAK)
    if head < 0:
        return None
    for line in text[:head].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        if name.strip().lower() == b"content-length":
            value = value.strip()
            return head + 4 + int(value) + 4 if value.isdigit() and len(value) < 16 else None
    return None


def _splits(batches):
    """(file, split, values) rows of a partition, split by split in the order of the file, values in pieces."""
    for batch in batches:
        files, starts, values = (batch.column(k) for k in range(3))
        edge = 0
        keys = list(zip(files.to_pylist(), starts.to_pylist()))
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[edge]:
                yield (*keys[edge], values.slice(edge, k - edge), batch.slice(edge, k - edge))
                edge = k


def _pieces(batches):
    """Splits as rows of about PIECE_BYTES: place within the split, bytes, values, and their candidates.

    A candidate is a place after a magic (``starts``) with how far the chain from there leads beyond the
    piece (``exits``), both counted from the split's first row.
    """

    def settled(file, split, first, values, needs):
        places = [first]
        for v in values:
            places.append(places[-1] + len(v.encode()) + len(MAGIC))
        end = places.pop()
        exits = {}
        for place, need in zip(reversed(places), reversed(needs)):
            after = None if need is None else place + need + len(MAGIC)
            # within the piece the chain goes on from a candidate or is broken
            exits[place] = after if after is None or after >= end else exits.get(after)
        return end, pa.RecordBatch.from_arrays(
            [
                pa.array([file]), pa.array([split], pa.int64()), pa.array([first], pa.int64()), pa.array([end - first], pa.int64()),
                pa.array([places], pa.list_(pa.int64())), pa.array([[exits[p] for p in places]], pa.list_(pa.int64())),
                pa.array([values], pa.list_(pa.string())),
            ],
            names=["file", "split", "place", "bytes", "starts", "exits", "values"],
        )

    now, first, held, needs, size = None, 0, [], [], 0
    for file, split, values, _ in _splits(batches):
        if now != (file, split):
            if held:
                yield settled(*now, first, held, needs)[1]
            now, first, held, needs, size = (file, split), 0, [], [], 0
        for value in values.to_pylist():
            text = value.encode()
            held.append(value)
            needs.append(_needed(text))
            size += len(text)
            if size >= PIECE_BYTES:
                first, out = settled(*now, first, held, needs)
                yield out
                held, needs, size = [], [], 0
    if held:
        yield settled(*now, first, held, needs)[1]


def _walk(batches):
    """Rows of verified records: key (the record's successor offset), place of the part, text, and whether it is the whole record."""
    for batch in batches:
        for file, values, place, expected in zip(*(c.to_pylist() for c in batch.columns)):
            out = []
            for value in values:
                text = value.encode()
                if expected is not None and place <= expected:
                    need = None
                    if place == expected:
                        need = _needed(text)
                        expected = None if need is None else place + need + len(MAGIC)
                    if expected is not None and place >= len(MAGIC):
                        out.append((file, expected, place, value, need is not None and need == len(text)))
                place += len(text) + len(MAGIC)
            part = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(part, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))],
                names=["file", "next", "place", "text", "whole"],
            )


def _parsed(batches):
    for batch in batches:
        out = []
        for text in batch.column(0).to_pylist():
            raw = text.encode()
            head, _, rest = raw.partition(BREAK)
            field = {}
            for line in head.decode().split("\r\n"):
                name, _, value = line.partition(":")
                field[name.strip().lower()] = value.strip()
            if len(rest) != int(field["content-length"]) + 4 or not rest.endswith(BREAK):
                continue  # cut off at the end of the file
            http, _, payload = rest[:-4].partition(BREAK)
            page = lambda name: (field.get(name, "")[len("<urn:x-page:") : -1]) or None
            kind = field.get("warc-type")
            if kind == "revisit":
                size = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
                digest = field.get("warc-payload-digest", "").removeprefix("sha1:")
                payload = None
            elif kind == "response":
                size, digest = len(payload), payload_digest(payload)
            else:
                size = digest = payload = None
            out.append((page("warc-record-id"), kind, field.get("warc-target-uri"), size, digest, page("warc-refers-to"), payload))
        part = list(zip(*out)) or [[]] * 7
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(part, kinds)],
            names=["page_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "payload"],
        )


def _reachable(candidates: DataFrame) -> DataFrame:
    """Stored (file, at): the starts of records at which a chain enters a piece, and where the chains end, by pointer jumping from each file's start."""
    heads = candidates.select("file").distinct().withColumn("at", F.lit(len(MAGIC)).cast("bigint"))
    targets = candidates.select("file", F.col("exit").alias("at")).filter("at is not null").union(heads).distinct()
    jump = stored(
        candidates.withColumn("at", F.col("start")).join(targets, ["file", "at"]).filter("exit is not null").select("file", "at", "exit"), "jump"
    )
    reach, n = stored(heads, "reach"), 0
    while True:
        step = reach.join(jump, ["file", "at"]).select("file", F.col("exit").alias("at"))
        reach = stored(reach.union(step).distinct(), "reach")
        if reach.count() == n:
            return reach
        n = reach.count()
        onward = jump.select("file", F.col("at").alias("exit"), F.col("exit").alias("further"))
        jump = stored(
            jump.join(onward, ["file", "exit"], "left").select("file", "at", F.coalesce("further", "exit").alias("exit")), "jump"
        )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``: page_id, record_type, url, payload_bytes, payload_digest, refers_to (strings), payload.

    Digest and size of a response are those of the payload read; a revisit
    carries those of the payload it refers to.  A broken or cut-off record ends
    its file, as it does for a reader from the start.
    """
    rows = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )
    pieces = stored(  # whole rows, numbered once: however they are scanned later, a piece is read by one task
        rows.mapInArrow(
            _pieces, "file string, split long, place long, bytes long, starts array<long>, exits array<long>, values array<string>"
        ).withColumn("piece", F.monotonically_increasing_id()),
        "pieces", "zstd",
    )
    before = Window.partitionBy("file").orderBy("split", "place").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(  # offset of each split's first row
        pieces.select("file", "split", "place", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")).filter("place = 0").drop("place"),
        "splits",
    )
    n_splits, n_pieces = bases.count(), pieces.count()
    based = pieces.select("piece", "file", "split", "place", "starts", "exits").join(small_side(bases, n_splits, 200), ["file", "split"])
    candidates = stored(
        based.select("file", "base", F.explode(F.arrays_zip("starts", "exits")).alias("c"))
        .select("file", (F.col("base") + F.col("c.starts")).alias("start"), (F.col("base") + F.col("c.exits")).alias("exit")),
        "chain",
    )
    reach = _reachable(candidates)
    # the first reachable offset at or after each piece's first row
    onward = Window.partitionBy("file").orderBy(F.col("at").desc(), F.col("piece").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    entries = stored(
        reach.select("file", "at", F.lit(None).cast("bigint").alias("piece"))
        .union(based.select("file", (F.col("base") + F.col("place")).alias("at"), "piece"))
        .withColumn("expected", F.last(F.when(F.col("piece").isNull(), F.col("at")), ignorenulls=True).over(onward))
        .filter("piece is not null").select("piece", F.col("at").alias("base"), "expected"),
        "entries",
    )
    if n_pieces * 40 <= BROADCAST_BYTES:
        entries = F.broadcast(entries)
    parts = pieces.select("piece", "file", "values").join(entries, "piece").select("file", "values", "base", "expected").mapInArrow(
        _walk, "file string, next long, place long, text string, whole boolean"
    )
    texts = F.sort_array(F.collect_list(F.struct("place", "text")))
    rejoined = (
        parts.filter(~F.col("whole")).groupBy("file", "next").agg(texts.alias("texts"))
        .select(F.concat_ws(MAGIC, F.col("texts.text")).alias("text"))
    )
    return parts.filter("whole").select("text").union(rejoined).mapInArrow(
        _parsed,
        "page_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary",
    ).filter("record_type in ('response', 'revisit')")


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read their records back, ids as in ``pages``."""
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path, min_bytes)
    kind = dict(pages.dtypes)["page_id"]
    return read_warc(pages.sparkSession, path).withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
