"""Words and strings that collide under polynomials modulo a power of two, whatever the base."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import streakline.llm.backoff_lm as lm
import streakline.llm.packing as packing
from streakline.llm.decontaminate import build_index, contamination
from streakline.llm.packing import WordIds, pack_documents
from streakline.llm.resampling import block_features
from streakline.llm.suffix_dedup import remove_repeats
from streakline.llm.textblocks import PRIME, SpanHash, powers

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LENGTHS = [1 << k for k in range(8, 14)]


def thue_morse(n: int) -> tuple[str, str]:
    word = "".join("ab"[k.bit_count() & 1] for k in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", LENGTHS)
def test_span_hashes(n):
    data = np.frombuffer("".join(thue_morse(n)).encode(), np.uint8)
    one, two = SpanHash(data)(np.array([0, n]), np.array([n, 2 * n]))
    assert one != two


def test_span_hashes_are_those_of_the_string():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 4, 5000).astype(np.uint8)
    start, size = rng.integers(0, 4000, 3000), rng.integers(0, 12, 3000)
    hashed = SpanHash(data)(start, start + size)
    seen = {}
    for a, n, h in zip(start.tolist(), size.tolist(), hashed.tolist()):
        assert seen.setdefault(data[a : a + n].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)
    assert powers(5, 40).tolist() == [pow(5, k, PRIME) for k in range(40)]


def colliding():
    rows, k = [], 0
    for n in LENGTHS:
        for word in thue_morse(n):
            rows.append((k, f"{word} end"))
            k += 1
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_contamination(spark):
    rows = colliding()
    items = [(n, thue_morse(n)[0]) for n in LENGTHS]
    got = contamination(build_index(frame(spark, rows)), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute.contamination(rows, items)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got} == want
    assert sum(r["contaminated"] for r in got) == len(LENGTHS)


def test_packing(spark):
    rows = colliding()
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in pack_documents(frame(spark, rows), VOCABULARY).collect()}
    assert got == brute.pieces(rows, Tokenizer.from_file(VOCABULARY))


def test_packing_compares_bytes(monkeypatch):
    """Hashes of few values: most words share one with another, in their block or in the store."""
    real = packing.word_hashes
    monkeypatch.setattr(packing, "word_hashes", lambda data, starts, ends, seed=0: real(data, starts, ends, seed) % np.uint64(60))
    tokenizer, words, rng = Tokenizer.from_file(VOCABULARY), WordIds(VOCABULARY), random.Random(1)
    for _ in range(40):
        texts = ["".join(rng.choice("abc é,1 '|<>") for _ in range(rng.randint(0, 30))) for _ in range(3)]
        raw = [t.encode() for t in texts]
        ids, bounds = words.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_backoff(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 4000)
    rows = colliding() * 1 + [(100 + k, t) for k, (_, t) in enumerate(colliding()[::3])]
    got = lm.backoff_scores(frame(spark, rows)).collect()
    want = brute.backoff(rows, lm.ORDER, lm.ALPHA, True)
    for r in got:
        assert (r["n_words"], r["log_score"]) == (want[r["doc_id"]][0], pytest.approx(want[r["doc_id"]][1], rel=1e-9))


def test_features():
    for n in LENGTHS:
        raw = [w.encode() for w in thue_morse(n)]
        row, bucket = block_features(np.frombuffer(b"".join(raw), np.uint8), np.array([0, n, 2 * n]), 1 << 30)
        assert set(bucket[row == 0]) != set(bucket[row == 1])


def test_repeats_of_long_strings(spark):
    rows = [(k, f"{w}{'' if k % 3 else 'x'}") for k, (_, t) in enumerate(colliding()) for w in [t.removesuffix(" end")] if len(w) <= 4096]
    rows += [(50, rows[-1][1] + "tail")]
    got = {r["doc_id"]: (r["n_bytes"], [(x["start"], x["end"]) for x in r["removed"]], bytes(r["kept"])) for r in remove_repeats(frame(spark, rows), 1200).collect()}
    assert got == brute.repeats(rows, 1200)
