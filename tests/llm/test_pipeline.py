from __future__ import annotations

import os
import tempfile

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from streakline.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def folder(spark, docs):
    """A folder with these documents and the other tables of the smallest input."""
    path = tempfile.mkdtemp(prefix="streakline-pipe-")
    docs.write.parquet(f"{path}/documents.parquet")
    for table in ("labels", "benchmark", "pages", "conversations"):
        os.symlink(f"{SF}/{table}.parquet", f"{path}/{table}.parquet")
    return path


def stages(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{path}/stage{k}")
        docs = spark.read.parquet(f"{path}/stage{k}")
        out.append(docs)
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_against_brute_force(spark):
    path = folder(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    documents, kept, exact, near, clean, packed = stages(spark, path)
    assert all(df.columns == documents.columns for df in (kept, exact, near, clean))
    assert set(kept.collect()) <= set(documents.collect()) and kept.count() > 0.5 * documents.count()
    assert {i for i, _ in texts(exact)} == {i for i, v in brute.exact(texts(kept)).items() if v[2]}
    rows = sorted(texts(exact))
    root = brute.linked([brute.simhash(t) for _, t in rows])
    assert {i for i, _ in texts(near)} == {rows[k][0] for k in set(root)}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {i for i, v in brute.contamination(texts(near), items).items() if v[4]}
    assert {i for i, _ in texts(clean)} == {i for i, _ in texts(near)} - dirty
    pieces = brute.pieces(texts(clean), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packed.collect()} == pieces
    assert corpus_pipeline.run(spark, path).count() == len(pieces)


def test_stages_with_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " "), (3, " "), (None, "a b c"), (None, "a b c"), (4, "a b c"), (5, "word " * 30_000), (6, "x y z w")]
    docs = spark.createDataFrame([(i, t, None, None, None, "x", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row_id string, kept int")
    path = folder(spark, docs)
    result = stages(spark, path)
    assert all(df.columns == docs.columns for df in result[:5])
    assert len(result[1].collect()) == 9 and len(result[2].collect()) == 5
    assert sorted(i for i, _ in texts(result[2])) == [1, 3, 4, 5, 6]
    assert {i for i, _ in texts(result[3])} == {1, 4, 5, 6}
    assert result[5].count() >= 4


def test_stages_with_empty_table(spark):
    path = folder(spark, spark.read.parquet(f"{SF}/documents.parquet").filter("false"))
    assert [df.count() for df in stages(spark, path)] == [0] * 6


def test_registered_queries(spark):
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    from oracle_compare import compare, duck

    sf = "/root/testdata/sf0.01"
    same, detail = compare(QUERIES[name](spark, sf).drop("row_id"), duck(sf), ORACLE_SQL[name])
    assert same, detail
