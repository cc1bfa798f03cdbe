"""Prefix counts against encoding every prefix anew."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import streakline.llm.token_counts as token_counts
from streakline.llm.queries import op11_prefix_tokens
from streakline.llm.token_counts import PART, PrefixCounter, _counts_of, _parts, count_at, longest_prefix, prefix_table, token_count

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SIGNS = [
    "abcdefghijklmnopqrstuvwxyz", "aaab'srtvemldABCxyz ", "éèàñüßçœ aeiou'", "0123456789abc .,!?-", "<|>endoftextstartoftext",
    "̧́̈aeoEn ẞİı", "日本語ひらがなカタカナ漢字", "각각한", "กขคุ่น้ำ",
    "\x1c\x1d\x1e\x1f\x85\xa0 　​ a'b\t\n", "\U0001f600\U0001f468‍\U0001f469 x",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def brute(tokenizer, text):
    return [len(tokenizer.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]


def random_text(rnd, n):
    signs = rnd.choice(SIGNS) + rnd.choice(SIGNS)
    text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, n)))
    at = rnd.randint(0, len(text))
    return text[:at] + rnd.choice(["", "", "", "<|endoftext|>", "<|startoftext|>"]) + text[at:]


def test_counts_of_strange_texts(tokenizer):
    rnd, counter = random.Random(3), PrefixCounter(VOCABULARY)
    for _ in range(1500):
        text = random_text(rnd, 25)
        assert [0, *counter.counts(text)] == brute(tokenizer, text), repr(text)


def test_counts_of_joined_vocabulary(tokenizer):
    rnd, counter = random.Random(4), PrefixCounter(VOCABULARY)
    pieces = sorted(tokenizer.get_vocab())
    for _ in range(1500):
        text = "".join(rnd.choice(pieces).replace("</w>", rnd.choice(["", " "])) for _ in range(rnd.randint(1, 5)))
        assert [0, *counter.counts(text)] == brute(tokenizer, text), repr(text)


def test_blocks_of_texts(tokenizer, monkeypatch):
    """Pieces are solved together, and remembered: small memories and short pre-tokens give the same counts."""
    rnd = random.Random(8)
    ascii_ = "".join(map(chr, range(128)))
    for kept, pairs, together in ((300_000, 1_000_000, 256), (40, 300, 5)):
        for name, value in (("KEPT_PIECES", kept), ("KEPT_PAIRS", pairs), ("TOGETHER", together)):
            monkeypatch.setattr(token_counts, name, value)
        counter = PrefixCounter(VOCABULARY)
        for _ in range(12):
            texts = [random_text(rnd, 30) for _ in range(40)] + ["".join(rnd.choice(ascii_) for _ in range(rnd.randint(0, 30))) for _ in range(40)]
            raw = [t.encode() for t in texts]
            counts, bounds = counter.block(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
            for k, text in enumerate(texts):
                assert [0, *counts[bounds[k] : bounds[k + 1]].tolist()] == brute(tokenizer, text), repr(text)


def test_parts_hold_any_step():
    counts = np.array([1, 2, 3, 400, 401, 100, 101, 5, 5, 1000])
    bounds = np.array([0, 0, 7, 7, 9, 10, 10])
    rows = _parts(counts, bounds).to_pylist()
    expected = [[0], [0, 1, 2, 3, 400, 401, 100, 101], [0], [0, 5, 5], [0, 1000], [0]]
    expected = [[0], [0, *counts[:7]], [0], [0, *counts[7:9]], [0, 1000], [0]]
    for parts, counts_of_row in zip(rows, expected):
        joined = np.concatenate([_counts_of(p) for p in parts])
        assert joined.tolist() == counts_of_row
        for p in parts:
            part = _counts_of(p)
            assert p["low"] == part.min() and p["last"] == part[-1] and p["first"] == next(iter([p["first"]]))
        assert [p["first"] for p in parts][0] == 0


def test_table_answers_every_prefix(spark, tokenizer):
    rnd = random.Random(9)
    texts = [None, "", " \t ", "a", "<|endoftext|>", *(random_text(rnd, 40) for _ in range(60)), "word <|endoftext|> 'tis " * 6000, "x" * (PART + 5)]
    rows = [(None if k == 3 else k // 2, t, "parts", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, parts string, n_bytes int")
    table = prefix_table(docs, VOCABULARY)
    found = {}
    for r in table.withColumn("tokens", token_count()).collect():
        counts = np.concatenate([_counts_of(p) for p in r["parts"]])
        assert len(counts) == r["n_chars"] + 1 and r["tokens"] == counts[-1]
        found.setdefault((r["doc_id"], r["n_bytes"], r["n_chars"]), []).append(counts.tolist())
    assert sum(map(len, found.values())) == len(texts)
    for doc_id, text, *_ in rows:
        mine = found[doc_id, len((text or "").encode()), len(text or "")]
        if len(text or "") < 100:
            assert brute(tokenizer, text or "") in mine
        else:
            ends = [len(tokenizer.encode(text[:k], add_special_tokens=False).ids) for k in (0, 1, 777, len(text) - 1, len(text))]
            assert ends in [[c[0], c[1], c[777], c[-2], c[-1]] for c in mine]

    budget = 7
    answers = longest_prefix(table, budget).selectExpr("*", "n_chars div 2 as half", "cast(null as int) as none")
    for r in count_at(count_at(answers, "half"), "none", "nothing").collect():
        counts = np.concatenate([_counts_of(p) for p in r["parts"]])
        assert r["kept_chars"] == max(k for k, n in enumerate(counts) if n <= budget)
        assert r["tokens_at"] == counts[r["half"]] and r["nothing"] is None


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert prefix_table(docs, VOCABULARY).collect() == []


def test_query_counts_whole_texts(spark, tokenizer):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op11_prefix_tokens(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 2048)
