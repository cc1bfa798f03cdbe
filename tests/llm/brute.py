"""Plain single-process versions that the operators are held against."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def exact(rows):
    """{doc_id: (keep_id, group_size, kept, sha)} for distinct ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return {i: (min(v), len(v), i == min(v), sha(k)) for k, v in groups.items() for i in v}


def simhash(text: str | None, n: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values: list[int], max_bits: int = 3) -> list[int]:
    """Index of the first member of each value's component."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window: int = 13):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = defaultdict(set)
    for i, t in items:
        words = BENCH_WORD.findall(lower(t))
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if words else 0):
            windows[tuple(words[k : k + n])].add("" if i is None else str(i))
    out = {}
    for i, t in docs:
        words, hit, names = BENCH_WORD.findall(lower(t)), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if (found := windows.get(tuple(words[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    names |= found
        out[i] = (len(words), len(hit), len(names), sha(",".join(sorted(names))), bool(hit) and 20 * len(hit) >= len(words))
    return out


def repeats(docs, n: int):
    """{doc_id: (n_bytes, removed runs, kept bytes)}"""
    seen = Counter()
    for _, t in docs:
        b = (t or "").encode()
        seen.update(b[k : k + n] for k in range(len(b) - n + 1))
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                gone[k : k + n] = [True] * n
        runs, at = [], 0
        while at < len(b):
            end = at
            while end < len(b) and gone[end]:
                end += 1
            if end > at:
                runs.append((at, end))
            at = max(end, at + 1)
        out[i] = (len(b), runs, bytes(x for x, g in zip(b, gone) if not g))
    return out


def pieces(docs, tokenizer, capacity: int = 2048):
    """{(doc_id, piece): (start, length, crc)}"""
    out = {}
    for i, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            out[i, k // capacity] = (k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    return out


def warc(rows, min_bytes: int = 0):
    """(page_id, bytes, digest, record type, refers to) of each row (page_id, url, html)."""
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        largest = max((x for x in groups[b] if x is not None), default=None)
        revisit = len(b) >= min_bytes and i is not None and largest != i
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), digest, "revisit" if revisit else "response", largest if revisit else None))
    return sorted(out, key=str)


def backoff(docs, order: int, alpha: float, leave_one_out: bool):
    """{doc_id: (n_words, log score)}"""
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", lower(t))) for i, t in docs]

    def grams(w):
        return Counter(tuple(w[k : k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1))

    count, total = Counter(), sum(len(w) for _, w in words)
    for _, w in words:
        count.update(grams(w))
    out = {}
    for i, w in words:
        own = grams(w) if leave_one_out else {}
        of = lambda x: count[x] - own.get(x, 0)  # noqa: E731,B023
        rest, score = max(total - len(w) * leave_one_out, 1), 0.0
        for k in range(len(w)):
            context = min(k, order - 1)
            for n in range(context + 1, 0, -1):
                x = tuple(w[k - n + 1 : k + 1])
                if of(x) > 0:
                    score += math.log(of(x) / (of(x[:-1]) if n > 1 else rest)) + (context + 1 - n) * math.log(alpha)
                    break
            else:
                score += (context + 1) * math.log(alpha) - math.log(rest)
        out[i] = (len(w), score)
    return out


def ranked(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] by scoring every document for every item."""
    terms = {}
    for i, (doc_id, text) in enumerate(docs):
        terms[i] = Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text)))
    n = sum(1 for t in terms.values() if t)
    total = sum(sum(t.values()) for t in terms.values())
    df = Counter(t for words in terms.values() for t in words)
    out = []
    for item_id, text in items:
        words = Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text)))
        scores = []
        for i, (doc_id, _) in enumerate(docs):
            score = 0
            for t, repeats in words.items():
                if tf := terms[i][t]:
                    m = 100 - 75 + (75 * sum(terms[i].values()) * n) // total
                    score += repeats * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return out


def shared_starts(rows, every=100, most=6):
    """{conv_id: [(role, text)]} of conversations rebuilt on the starts of others."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(c - int(math.fmod(c, every)), [])[:h] + v[h:])
    return built


def trie(built):
    """[(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)]"""
    nodes = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[built[c][:d]].append(c)
    children, leaves, saved = Counter(p[:-1] for p in nodes if p), Counter(), Counter()
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return [
        (m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], sha(",".join(str(c) for c in m if len(built[c]) == len(p))))
        for p, m in nodes.items()
    ]
