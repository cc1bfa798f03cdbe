"""Dual-tree search and the conversation trie against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
import streakline.llm.prefix_trie as trie
import streakline.llm.ranked_search as search
from streakline.llm.queries import ORACLE_SQL, op12_dual_tree_search, op13_prefix_trie
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def words(rnd, n, alphabet):
    return " ".join(rnd.choice(alphabet) for _ in range(n))


@pytest.fixture(scope="module")
def searched(spark):
    """Common and rare words, groups of copies (one of them large), odd texts, null and repeated ids."""
    rnd = random.Random(11)
    common, rare = ["the", "of", "Und", "ça"], [f"w{i}" for i in range(300)]
    texts = [words(rnd, rnd.randint(0, 60), common + rnd.sample(rare, 12)) for _ in range(700)]
    texts += [texts[3]] * 40 + [texts[5], texts[7]] * 3 + [None, "", "  \t", "####", "THE the The", "w1 " * 9000, "x" * 50_000, "a_b-c w1\x00w2"]
    docs = [(None if i % 97 == 0 else i % 640, t) for i, t in enumerate(texts)]
    items = [(i if i % 9 else None, words(rnd, 12, common + rare)) for i in range(40)]
    items += [(5, docs[3][1]), (900, None), (901, "## -"), (902, "nowhere"), (903, "the the the the"), (903, "the the the the")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id int, text string, item string, score int").repartition(5)
    asked = spark.createDataFrame([(*d, "x") for d in items], "item_id long, text string, doc_id string")
    return docs, items, frame, asked


def test_search_finds_the_best(searched):
    docs, items, frame, asked = searched
    assert as_rows(search.ranked_search(frame, asked)) == sorted(brute.ranked(docs, items), key=repr)


def test_search_in_several_item_blocks(searched):
    docs, items, frame, asked = searched
    assert len(search._item_blocks(asked.withColumn("row_id", search.F.monotonically_increasing_id()), 900)) > 2
    assert as_rows(search.ranked_search(frame, asked, 3, item_bytes=900)) == sorted(brute.ranked(docs, items, 3), key=repr)


def test_search_of_nothing(spark, searched):
    _, _, frame, asked = searched
    assert search.ranked_search(frame.limit(0), asked).collect() == []
    assert search.ranked_search(frame, asked.limit(0)).collect() == []
    assert search.ranked_search(frame, asked.filter("item_id = 900")).collect() == []


def test_trees_prune_and_bound():
    """Bounds are never below a score below them, and few of the scores are computed where documents differ."""
    rnd = np.random.default_rng(2)
    n_docs, n_terms = 3000, 400
    doc = np.repeat(np.arange(n_docs), 6)
    term = (doc // 50 * 6 + rnd.integers(0, 8, len(doc))) % n_terms
    pairs, first = np.unique(doc * n_terms + term, return_index=True)
    doc, term = doc[first], term[first]
    worth = rnd.integers(1, 10**9, len(doc))
    items = [tuple(np.unique(rnd.integers(k * 6, k * 6 + 8, 5) % n_terms, return_counts=True)) for k in range(50)]
    tree, docs, best = search.ItemTree(items, np.bincount(term, minlength=n_terms)), search.DocTree(n_docs, doc, term, worth), search.Best(len(items), 5)
    scored = search.dual_search(tree, docs, pa.array(np.arange(n_docs)), best)
    dense = np.zeros((n_docs, n_terms), np.int64)
    dense[doc, term] = worth
    for i, (terms, repeats) in enumerate(items):
        scores = dense[:, terms] @ repeats
        order = np.lexsort((np.arange(n_docs), -scores))[:5]
        assert [(-s, d) for s, _, d in best.found[i]] == [(scores[d], d) for d in order if scores[d] > 0]
    assert scored < 0.2 * n_docs * len(items)
    whole = np.arange(-(-n_docs // search.DOC_FAN))
    _, members = docs.sums(0, whole, np.arange(n_terms), np.ones(n_terms, np.int64))
    nodes, bounds = docs.sums(1, np.arange(-(-len(whole) // search.DOC_FAN)), np.arange(n_terms), np.ones(n_terms, np.int64))
    assert all(bounds[n] >= members[n * search.DOC_FAN : (n + 1) * search.DOC_FAN].max() for n in nodes)


def test_sums_beyond_floating_point():
    tree = search.DocTree(2, np.array([0, 0, 1]), np.array([0, 1, 1]), np.array([1, (1 << 55) + 1, 1 << 55]))
    found, sums = tree.sums(0, np.array([0]), np.array([0, 1]), np.array([1, 1]))
    assert sorted(sums.tolist()) == [1 << 55, (1 << 55) + 2] and len(found) == 2


def test_search_query_against_sql(spark):
    ok, info = compare(op12_dual_tree_search(spark, SF), duck(SF), ORACLE_SQL["op12_dual_tree_search"])
    assert ok, info


CONVERSATIONS = "conv_id long, turn int, role string, text string, place string, digest string, key string, n int"


def conversations(rnd, n):
    """Few distinct turns, so that starts are shared; copies, absent bases, null and repeated turns, long conversations."""
    rows = []
    for c in [*range(n), 250, 399, 1207, -5, -120, -100]:
        size = rnd.choice([1, 1, 2, 3, 5, 8, 13])
        rows += [(c, t, rnd.choice(["user", "assistant"]) if rnd.random() < 0.2 else ("user", "assistant")[t % 2], rnd.choice(["hi", "ok", "é" * 5])) for t in range(size)]
    rows += [(c, t, "user", "same") for c in (7, 8, 9) for t in range(70)] + [(8, 70, "user", "more"), (9, 70, None, None)]
    rows += [(600 + c, t, "user", "copy") for c in range(30) for t in range(9)]
    rows += [(800 + c, t, "user", f"{c}" if t == 63 else "full") for c in range(3) for t in range(64 + c)]  # whole segments and their end
    rows += [(3, None, "system", "first"), (3, 0, "user", "tie"), (3, 0, "user", "tie"), (4, None, None, None), (None, 1, "user", "nobody"), (701, 2, "ab", "c"), (702, 2, "a", "bc")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("segment", "span"), [(256, 1024), (8, 4)])
def test_trie(spark, monkeypatch, segment, span):
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "SPAN", span)
    rows = conversations(random.Random(6), 60)
    frame = spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], CONVERSATIONS).repartition(4)
    turns, members = trie.with_shared_starts(trie.ordered_turns(frame))
    got = as_rows(trie.prefix_trie(turns, members))
    assert got == sorted(brute.trie(brute.shared_starts(rows)), key=repr)


def test_trie_without_shared_starts(spark):
    rows = conversations(random.Random(8), 30)
    frame = spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], CONVERSATIONS)
    turns = trie.ordered_turns(frame)
    built = brute.shared_starts(rows, most=1)
    assert as_rows(trie.prefix_trie(turns, turns.select("conv_id").distinct())) == sorted(brute.trie(built), key=repr)


def test_trie_of_nothing_and_of_the_root_alone(spark):
    frame = spark.createDataFrame([], CONVERSATIONS)
    turns, members = trie.with_shared_starts(trie.ordered_turns(frame))
    assert trie.prefix_trie(turns, members).collect() == []
    alone = spark.createDataFrame([(5,), (12,)], "conv_id long")
    assert as_rows(trie.prefix_trie(turns, alone)) == [(5, 0, None, 2, 0, 1, 0, brute.sha("5,12"))]


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op13_prefix_trie(spark, SF)
    assert as_rows(got) == sorted(brute.trie(brute.shared_starts(rows)), key=repr)
    ok, info = compare(got, duck(SF), ORACLE_SQL["op13_prefix_trie"])
    assert ok, info
