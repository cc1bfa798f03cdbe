"""Operators that read rows more than once must not depend on how a scan is split or ordered."""

from __future__ import annotations

import random
import tempfile

import brute
import corpus_pipeline
import pyarrow as pa
import pytest
import streakline.llm.backoff_lm as lm
import streakline.llm.warc as warc
from streakline.llm import exact_dedup, tables
from streakline.llm.exact_dedup import exact_groups
from streakline.llm.suffix_dedup import remove_repeats
from test_text_operators import warc_rows

SPLIT = "spark.sql.files.maxPartitionBytes"


def rows_of_text(n=900):
    rng = random.Random(3)
    some = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(60)) for _ in range(n // 2)]
    return [(i, some[rng.randrange(len(some))]) for i in range(n)]


def many_groups(spark):
    """A table of few files with many row groups, so that a smaller split size cuts them."""
    path = f"{tempfile.mkdtemp(prefix='streakline-split-')}/t"
    docs = spark.createDataFrame(rows_of_text(), "doc_id long, text string").coalesce(2)
    docs.write.option("parquet.block.size", 4096).option("parquet.page.size.row.check.min", 10).option("parquet.block.size.row.check.min", 10).parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def split(spark):
    old = spark.conf.get(SPLIT)
    yield lambda size: spark.conf.set(SPLIT, size)
    spark.conf.set(SPLIT, old)


def test_splits_differ(spark, split):
    docs = many_groups(spark)
    split("128m")
    few = docs.rdd.getNumPartitions()
    split("8k")
    assert spark.read.parquet(docs.inputFiles()[0].rsplit("/", 1)[0]).rdd.getNumPartitions() > few


@pytest.mark.parametrize("stage", ["quality", "exact_dedup", "near_dedup", "decontaminate"])
def test_stage_read_in_other_splits_than_judged(spark, split, monkeypatch, stage):
    """The split size changes after every table that is stored."""
    sizes = ["8k", "128m", "3k"]
    real = tables.stored

    def changing(*args, **kwargs):
        out = real(*args, **kwargs)
        sizes.append(sizes.pop(0))
        split(sizes[0])
        return out

    sf = "/root/testdata/sf0.001"
    docs = many_groups(spark)
    split("128m")
    want = sorted(tuple(r) for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, sf).collect())
    for module in (tables, exact_dedup, corpus_pipeline):
        monkeypatch.setattr(module, "stored", changing)
    got = sorted(tuple(r) for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, sf).collect())
    if stage == "exact_dedup":
        assert {i for i, _ in got} == {i for i, v in brute.exact(rows_of_text()).items() if v[2]}
    assert got == want


def shuffled(docs):
    """``docs`` in another order in every scan, as when other splits are dealt to its tasks."""

    def run(batches):
        table = pa.Table.from_batches(list(batches), schema)
        order = list(range(table.num_rows))
        random.SystemRandom().shuffle(order)
        yield from table.take(pa.array(order, pa.int64())).combine_chunks().to_batches()

    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string")


def test_exact_dedup_of_rows_in_changing_order(spark):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(shuffled(many_groups(spark))).collect()}
    assert got == {i: tuple(v[:3]) for i, v in brute.exact(rows_of_text()).items()}


def test_suffix_dedup_of_rows_in_changing_order(spark):
    kept = lambda docs: sorted((r["doc_id"], bytes(r["kept"])) for r in remove_repeats(docs, 40).collect())
    assert kept(shuffled(many_groups(spark))) == kept(many_groups(spark))


@pytest.mark.parametrize("block", [20_000, 8 << 20])
def test_backoff_of_rows_in_changing_order(spark, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    got = {r["doc_id"]: r["log_score"] for r in lm.backoff_scores(shuffled(many_groups(spark))).collect()}
    want = brute.backoff(rows_of_text(), 3, 0.4, True)
    assert got == {i: pytest.approx(score, rel=1e-9, abs=1e-9) for i, (_, score) in want.items()}


def test_backoff_of_blocks_cut_by_scans():
    """A block whose rows two tasks read: its parts' n-grams are answered together."""
    rows = [(7, "a b c a b"), (7, "b c d"), (7, "c a b c"), (9, "a b")]
    packed = lambda text: lm._pack(pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"]))
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array([packed(r[1]) for r in part])], names=["block", "rows"])
    answers = []
    for cuts in ([rows], [rows[:1], rows[1:2], rows[2:]]):
        asked = [r for part in cuts for b in lm._asked(3, 2)([batch(part)]) for r in b.to_pylist()]
        asked.sort(key=lambda r: (r["bucket"], r["order"]))
        table = pa.Table.from_pylist(asked, pa.schema([("bucket", pa.int32()), ("order", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))
        answers.append(sorted((r["bucket"], r["order"], r["block"], lm.unpack_counts(r["packed"]).tolist()) for b in lm._answered(table.to_batches()) for r in b.to_pylist()))
    assert answers[0] == answers[1]


@pytest.mark.parametrize("build,read,piece", [("128m", "20000", 256 << 10), ("20000", "128m", 256 << 10), ("50000", "7000", 3000)])
def test_warc_read_in_other_splits_than_verified(spark, split, monkeypatch, build, read, piece):
    monkeypatch.setattr(warc, "PIECE_BYTES", piece, raising=False)
    rows = warc_rows()
    split(build)
    records = warc.archive(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, file string").coalesce(2))
    split(read)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records.collect()), key=str)
    assert got == brute.warc(rows, 0)
