from __future__ import annotations

import numpy as np
import pytest

import brute
from streakline.llm import exact_dedup, simhash
from streakline.llm.components import components
from streakline.llm.exact_dedup import chunk_hashes, combine, exact_groups
from streakline.llm.simhash import links, simhash_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def odd(spark, name):
    """Null and empty texts, repeated rows, a null id, a long text, columns that clash with helper names."""
    long = "word " * 30_000
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n", None), (4, "x  y", "c"), (5, "x\ty", "c"), (5, "x\ty", "c"), (None, "x y", "d"),
            (6, long, "e"), (7, long + "z", "e"), (8, long, "f"), (9, "é\x00ü", "g"), (10, "é\x00ü", "g")]
    return spark.createDataFrame(rows, f"doc_id long, text string, {name} string").repartition(3, "doc_id")


def test_exact_equals_brute_force(docs, texts):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_groups(docs).collect()}
    assert got == brute.exact(texts)


def test_colliding_fingerprints_are_told_apart(docs, texts):
    weak = exact_groups(docs, primes=(3, 1, 1), chunk_bytes=100, members_per_salt=7)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in weak.collect()}
    assert got == brute.exact(texts)


@pytest.mark.parametrize("name", ["row_id", "f0", "n", "salt"])
def test_exact_odd_rows(spark, name):
    rows = exact_groups(odd(spark, name)).collect()
    assert len(rows) == 12
    same = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in rows}
    assert same[1] == same[2] == (1, 2) and same[3] == (3, 1)
    assert same[4] == same[5] == same[None] == (4, 4)
    assert same[6] == same[8] == (6, 2) and same[7] == (7, 1) and same[10] == (9, 2)
    assert sum(r["kept"] for r in rows) == 6  # repeated rows: one of each group stays


def test_exact_empty_table(spark, docs):
    assert exact_groups(docs.filter("false")).collect() == []


def test_chunk_hashes_combine():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 1000).astype(np.uint8)
    for prime in exact_dedup.PRIMES:
        whole = int(chunk_hashes(data, np.array([0]), prime)[0]), 1000
        cuts = np.array([0, 1, 300, 301, 999])
        parts = [(int(h), int(n)) for h, n in zip(chunk_hashes(data, cuts, prime), np.diff(np.append(cuts, 1000)))]
        left = parts[0]
        for part in parts[1:]:
            left = combine(left, part, prime)
        assert left == whole
        right = combine(combine(parts[0], parts[1], prime), combine(combine(parts[2], parts[3], prime), parts[4], prime), prime)
        assert right == whole


def test_chunk_bytes_bound(docs):
    with pytest.raises(ValueError):
        exact_groups(docs, chunk_bytes=1 << 20)


def test_simhash_equals_brute_force(docs, texts):
    values = [brute.simhash(t) for _, t in texts]
    root = brute.linked(values)
    want = {i: (f"{v:016x}", texts[root[k]][0]) for k, ((i, _), v) in enumerate(zip(texts, values))}
    rows = simhash_components(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want
    assert {r["doc_id"] for r in rows if r["kept"]} == {c for _, c in want.values()}


@pytest.mark.parametrize("name", ["fp", "first", "key", "root"])
def test_simhash_odd_rows(spark, name):
    rows = simhash_components(odd(spark, name)).collect()
    assert len(rows) == 12
    of = {r["doc_id"]: r for r in rows}
    assert {of[i]["fingerprint"] for i in (1, 2, 3)} == {"0" * 16}
    assert {of[i]["component_id"] for i in (1, 2, 3)} == {1}
    assert {of[i]["component_id"] for i in (4, 5, None)} == {4}
    assert sum(r["kept"] for r in rows) == len({r["component_id"] for r in rows})


def test_simhash_empty_table(docs):
    assert simhash_components(docs.filter("false")).collect() == []


def test_shingles_of_few_words():
    from streakline.llm.simhash import block_fingerprints

    cases = ["A b", "one", "", "a b c d", "a  b\nc", "É x Y z É x Y z"]
    raw = [c.encode() for c in cases]
    offsets = np.cumsum([0, *map(len, raw)])
    got = block_fingerprints(np.frombuffer(b"".join(raw), np.uint8), offsets, 3)
    assert [int(x) for x in got] == [brute.simhash(c) for c in cases]


@pytest.mark.parametrize("members", [simhash.MEMBERS, 40, 5])
def test_links_in_dense_groups(spark, members):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 3)
    values = {int(centres[i % 3]) ^ sum({1 << int(b) for b in rng.integers(0, [12, 64, 30][i % 3], rng.integers(0, 5))}) for i in range(500)}
    values = sorted(values)
    signed = {int(np.uint64(v).astype(np.int64)): i for i, v in enumerate(values)}
    edges = links(spark.createDataFrame([(s,) for s in signed], "fp long"), 3, members).collect()
    assert all((values[signed[e["a"]]] ^ values[signed[e["b"]]]).bit_count() <= 64 for e in edges)
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        a, b = find(signed[e["a"]]), find(signed[e["b"]])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(values))] == brute.linked(values)


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_variant_of_many_unlinked_fingerprints(spark):
    """50,000 fingerprints of one variant, four bits or more apart but for planted pairs: every round of splitting is used."""
    rng = np.random.default_rng(7)
    data = rng.permutation(1 << 26)[:50_000].astype(np.uint64)
    high, at = np.zeros(len(data), np.uint64), 0
    check = np.zeros(len(data), np.uint64)
    for place in range(1, 32):  # extended Hamming code: 26 data bits on the places that are no powers of two
        if place & (place - 1):
            bit = data >> np.uint64(at) & np.uint64(1)
            high |= bit << np.uint64(place)
            check ^= bit * np.uint64(place)
            at += 1
    for k in range(5):
        high |= (check >> np.uint64(k) & np.uint64(1)) << np.uint64(1 << k)
    high |= np.bitwise_count(high).astype(np.uint64) & np.uint64(1)
    assert np.bitwise_count(high[:300, None] ^ high[None, :300])[~np.eye(300, dtype=bool)].min() >= 4
    fps = high << np.uint64(32) | np.uint64(77)
    planted = [(int(fps[k]), int(fps[k]) ^ (1 << 40) ^ (1 << 3) ^ (1 << int(rng.integers(41, 64)))) for k in range(0, 50_000, 5_000)]
    every = np.unique(np.concatenate((fps, np.array([b for _, b in planted], np.uint64))))
    edges = links(spark.createDataFrame([(int(x),) for x in every.view(np.int64)], "fp long"), 3, 500)
    parent = {int(x): int(x) for x in every}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges.collect():
        parent[root(a % (1 << 64))] = root(b % (1 << 64))
    groups = {}
    for x in parent:
        groups.setdefault(root(x), []).append(x)
    joined = [g for g in groups.values() if len(g) > 1]
    for a, b in planted:
        assert root(a) == root(b)
    for g in joined:  # whatever is joined hangs together by links of three bits at most
        near = {g[0]}
        while True:
            more = {y for y in g if any((x ^ y).bit_count() <= 3 for x in near)} - near
            if not more:
                break
            near |= more
        assert near == set(g)
