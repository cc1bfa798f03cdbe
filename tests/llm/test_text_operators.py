from __future__ import annotations

import random
import tempfile

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute
import streakline.llm.backoff_lm as lm
import streakline.llm.warc as warc
from streakline.llm.decontaminate import build_index, contamination, phrase_matches, proximity_matches
from streakline.llm.packing import group_up, pack_documents, plan
from streakline.llm.suffix_dedup import deep_shallow, remove_repeats

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def stored(df):
    path = f"{tempfile.mkdtemp(prefix='streakline-llm-')}/t"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and long texts, signs, repeated rows, a null id, columns that clash with helper names."""
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Ab c9 é"), (5, "AB C9 é"), (5, "AB C9 é"), (6, "x " * 40_000), (7, "y" * 70_000), (8, "<|endoftext|> it's 3.14"),
            (9, "=" + "̸" + " <|ENDOFTEXT|>"), (None, "Ab c9 é")]
    columns = "row_id string, length string, text_ string, gram string, term string, block string, part string"
    return stored(spark.createDataFrame([(i, t, *["x"] * 7) for i, t in rows], f"doc_id long, text string, {columns}").repartition(3))


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# benchmark decontamination


def test_contamination(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    more = spark.createDataFrame([(900, "the of"), (901, "###"), (902, None), (903, "Re"), (None, "the the the"), (905, "Re")], "item_id long, text string")
    items = items.union(more)
    index = build_index(docs)
    want = brute.contamination(pairs(docs), [(r["item_id"], r["text"]) for r in items.collect()])
    for size in (8 << 20, 3000):  # one pass over the index, and several
        rows = contamination(index, items, query_bytes=size).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows} == want


def test_phrases_and_proximity(spark):
    rows = [(1, "a b c a b"), (2, "b a"), (3, "c x x x a"), (4, None)]
    index = build_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    items = spark.createDataFrame([("q", "A b"), ("r", "c a"), ("s", "zz a")], "item_id string, text string")
    assert sorted((r["doc_id"], r["item_id"], r["word"], r["size"]) for r in phrase_matches(index, items).collect()) == [
        (1, "q", 0, 2), (1, "q", 3, 2), (1, "r", 2, 2)]
    near = {(r["doc_id"], r["item_id"]) for r in proximity_matches(index, items, 2).collect()}
    assert near == {(1, "q"), (2, "q"), (1, "r")}
    assert (3, "r") in {(r["doc_id"], r["item_id"]) for r in proximity_matches(index, items, 4).collect()}


def test_contamination_odd(spark, docs, odd):
    items = spark.createDataFrame([(1, "ab C9")], "item_id long, text string")
    rows = contamination(build_index(odd), items).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"]) for r in rows) == [
        (0, 3, 2), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 3, 2), (5, 3, 2), (5, 3, 2), (6, 40_000, 0), (7, 1, 0), (8, 5, 0), (9, 2, 0)]
    assert contamination(build_index(docs.filter("false")), items).collect() == []
    nothing = contamination(build_index(odd), items.filter("false")).collect()
    assert len(nothing) == 11 and not any(r["contaminated"] or r["n_items"] for r in nothing)


# suffix-array dedup


def runs(df, length, contexts=30_000):
    return sorted(
        ((r["doc_id"], r["n_bytes"], [(x["start"], x["end"]) for x in r["removed"]], bytes(r["kept"])) for r in remove_repeats(df, length, contexts).collect()),
        key=str,
    )


@pytest.mark.parametrize("length,contexts", [(400, 30_000), (60, 30_000), (400, 1)])
def test_repeats(docs, length, contexts):
    want = brute.repeats(pairs(docs), length)
    assert runs(docs, length, contexts) == sorted(((i, n, r, k) for i, (n, r, k) in want.items()), key=str)


@pytest.mark.parametrize("length,contexts", [(40, 30_000), (13, 30_000), (40, 2)])
def test_repeats_of_dense_strings(spark, length, contexts):
    rng = random.Random(2)
    made = lambda: "".join(rng.choice("ab\0é") for _ in range(rng.randint(0, 60)))
    parts = [made() for _ in range(6)]
    rows = [(i, "".join(rng.choice(parts) + rng.choice(["", made()]) for _ in range(rng.randint(0, 5)))) for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, "a" * 300), (1003, "ab" * 100), (1004, "ab" * 100)]
    df = stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    want = brute.repeats(rows, length)
    assert runs(df, length, contexts) == sorted(((i, n, r, k) for i, (n, r, k) in want.items()), key=str)


def test_repeats_of_another_length_are_counted(docs, odd):
    for table in (docs, odd):
        got = remove_repeats(table, 400, also=(60, 200)).collect()
        plain = sorted(((r["doc_id"], bytes(r["kept"])) for r in remove_repeats(table, 400).collect()), key=str)
        assert sorted(((r["doc_id"], bytes(r["kept"])) for r in got), key=str) == plain
        if table is docs:
            for other in (60, 200):
                want = {i: sum(b - a for a, b in runs) for i, (_, runs, _) in brute.repeats(pairs(docs), other).items()}
                assert {r["doc_id"]: r[f"n_repeated_{other}"] for r in got} == want


def test_repeats_odd(docs, odd):
    got = {r["doc_id"]: r for r in remove_repeats(odd).collect()}
    assert len(got) == 10 and got[1]["n_bytes"] == 0 and got[6]["kept"] == b"" and got[7]["kept"] == b""
    assert bytes(got[4]["kept"]).decode() == "Ab c9 é"
    assert remove_repeats(docs.filter("false")).collect() == []


def test_deep_shallow_orders_suffixes():
    import numpy as np

    rng = random.Random(0)
    strings = [bytes(rng.choice(b"\0ab") for _ in range(rng.randint(0, 90))) for _ in range(300)]
    strings += [b"a" * k for k in range(70)] + [b"a" * 50] * 3
    group = np.array([rng.randint(0, 4) for _ in strings])
    order, common = deep_shallow(strings, group)
    last = None
    for k, c in zip(order.tolist(), common.tolist()):
        if last is None or group[last] != group[k]:
            assert c == -1
        else:
            a, b = strings[last], strings[k]
            assert a <= b
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert c == n
        last = k


# packing


def places(rows):
    seen = {}
    for r in rows:
        seen.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in seen.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    return len(seen)


def test_packing(docs):
    rows = pack_documents(docs, VOCABULARY).collect()
    want = brute.pieces(pairs(docs), Tokenizer.from_file(VOCABULARY))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert places(rows) <= -(-sum(r["length"] for r in rows) // 2048) * 1.02 + 1


def test_packing_odd(docs, odd):
    rows = pack_documents(odd, VOCABULARY).collect()
    places(rows)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = [(i, k, v) for i, t in pairs(odd) for (_, k), v in brute.pieces([(i, t)], tokenizer).items()]
    assert sorted(((r["doc_id"], r["piece"], (r["start"], r["length"], r["ids_crc32"])) for r in rows), key=str) == sorted(want, key=str)
    assert pack_documents(docs.filter("false"), VOCABULARY).collect() == []


def test_plan_places_every_length():
    rng = random.Random(5)
    for _ in range(20):
        counts = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(rng.randint(1, 40))}
        placed = {}
        for n, lengths in plan(counts, 100, groups=6):
            assert n > 0 and sum(lengths) <= 100
            for length in lengths:
                placed[length] = placed.get(length, 0) + n
        assert placed == counts


def test_groups_have_equal_cardinality():
    groups = group_up({90: 5, 80: 3, 70: 4}, 4)
    assert [sum(c for _, c in g) for g in groups] == [3, 3, 3, 3]
    assert groups[1] == [(90, 2), (80, 1)]


# WARC


def warc_rows():
    rng = random.Random(1)
    parts = ["WARC/1.1\r\n", "Content-Length: 5\r\n", "\r\n\r\n", "WARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n", "é", "x" * 50, "\r", "\n", "\0"]
    rows = [(i, rng.choice([None, "http://a/ b\r\nx: y", "u"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(200)]
    return rows + [(None, "u", "q"), (7, "u", "dup"), (7, "u", "dup"), (8, None, None), (9, None, ""), (900, "b", "WARC/1.1\r\n" * 3000), (901, "b", "y" * 200_000)]


@pytest.mark.parametrize("min_bytes,split,limit", [(0, "128m", None), (30, "50000", None), (0, "50000", 0)])
def test_warc_round_trip(spark, monkeypatch, min_bytes, split, limit):
    if limit is not None:  # as if there were too many splits to broadcast
        monkeypatch.setattr(warc, "BROADCAST_BYTES", limit)
    rows = warc_rows()
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, file string").coalesce(2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.archive(pages, min_bytes).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == brute.warc(rows, min_bytes)
    texts = {}
    for i, _, h in rows:
        texts.setdefault(i, set()).add((h or "").encode())
    assert all(bytes(r["payload"]) in texts[r["page_id"]] for r in got if r["payload"] is not None)


def test_warc_empty(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# language model


@pytest.mark.parametrize("order,alone,block", [(3, True, 8 << 20), (2, False, 8 << 20), (3, True, 50_000)])
def test_backoff(docs, odd, monkeypatch, order, alone, block):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    some = stored(docs.select("doc_id", "text").filter("doc_id % 2 = 0").repartition(3))
    rows = lm.backoff_scores(some, order, 0.4, alone).collect()
    want = brute.backoff(pairs(some), order, 0.4, alone)
    assert len(rows) == len(want)
    for r in rows:
        n, score = want[r["doc_id"]]
        assert r["n_words"] == n and r["log_score"] == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_backoff_odd(docs, odd):
    rows = lm.backoff_scores(odd).collect()
    assert len(rows) == 11
    assert all(r["log_score"] == 0 and r["mean_log_score"] is None for r in rows if r["doc_id"] in (1, 2, 3))
    assert lm.backoff_scores(docs.filter("false")).collect() == []


def test_phrase_far_into_a_long_document(spark):
    """More words than two bytes can number."""
    docs = spark.createDataFrame([(1, "x " * 70_000 + "some phrase here"), (2, "some phrase there")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([("p", "some phrase here"), ("q", "phrase there")], "item_id string, text string")
    rows = phrase_matches(build_index(docs), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["word"]) for r in rows) == [(1, "p", 70_000), (2, "q", 1)]


@pytest.mark.parametrize("kind", ["int", "long", "string"])
@pytest.mark.parametrize("query_bytes", [8 << 20, 60])
def test_long_document_with_null_id(spark, kind, query_bytes):
    """The only document of its segment has a null id, and ids need not be bigints."""
    phrase = " ".join(f"w{k}" for k in range(13))
    rows = [(None, "word " * 80_000 + phrase), (4, phrase), (5, "nothing of it")]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string").selectExpr(f"CAST(doc_id AS {kind}) AS doc_id", "text").coalesce(1))
    items = spark.createDataFrame([("a", phrase), ("b", "other words " * 10)], "item_id string, text string")
    index = build_index(docs)
    found = contamination(index, items, query_bytes=query_bytes)
    assert dict(found.dtypes)["doc_id"] == dict(docs.dtypes)["doc_id"]
    four = "4" if kind == "string" else 4
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["contaminated"]) for r in found.collect()} == {
        None: (80_013, 13, False), four: (13, 13, True), "5" if kind == "string" else 5: (3, 0, False),
    }
    for matches in (phrase_matches(index, items, 13, query_bytes), proximity_matches(index, items.filter("item_id = 'a'"), 13)):
        assert {(r["doc_id"]) for r in matches.collect()} == {None, four}
