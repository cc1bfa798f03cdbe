"""Exact token counts of every prefix of every text, by dynamic programming over the byte-pair encoding.

The encoding of a symbol string is the only sequence of tokens that each encode
to themselves and whose neighbours no merge would have joined.  So the last
token of every prefix follows from the last tokens of shorter prefixes, and one
pass over a word gives the count at each of its prefixes: ``count(i) =
count(i - len(last token)) + 1``.  A prefix that ends inside a word ends that word, so its
last token carries the end-of-word mark; two tables, with and without it, are
filled side by side.

Words repeat, so each distinct piece is solved once per worker, and a block of
texts gets its counts by gathering.  A text's counts are kept as one signed byte
a code point (the step from one prefix to the next) in parts that state their
own first count: truncation and budget questions read the table, never the tokenizer.
"""

from __future__ import annotations

import json
import os
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streakline.llm.packing import KIND
from streakline.llm.tables import free_name
from streakline.llm.textblocks import LOWER, WHITE, blocks, word_spans

#: Most code points in one part of a text's table.
PART = 1 << 16
#: Distinct pieces and neighbour pairs a worker remembers; a full memory is emptied and filled anew.
KEPT_PIECES = 300_000
KEPT_PAIRS = 1_000_000
#: Longest pre-token (bytes) that is solved together with others; a longer one is solved by itself.
TOGETHER = 256

_PARTS = pa.list_(pa.struct([("first", pa.int64()), ("before", pa.int64()), ("last", pa.int64()), ("low", pa.int64()), ("steps", pa.binary())]))
_PARTS_SQL = "array<struct<first: bigint, before: bigint, last: bigint, low: bigint, steps: binary>>"
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _bytes_of_signs() -> dict[str, int]:
    """The byte each sign of a byte-level vocabulary stands for: printable bytes are themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the pieces that never share a pre-token, together all bytes but white space.

    Words are cut between two ASCII signs of different kinds (letters, digits, others) and between digits, unless
    an apostrophe (which takes up letters after it) or a bar (of a special token) occurs.  Other characters may change their neighbours, so nothing is cut beside them.
    """
    starts, ends, row = word_spans(data, offsets, ~WHITE)
    if len(starts) == 0:
        return starts, ends, row
    kind, ascii_ = KIND[data], data < 0x80
    whole = np.add.reduceat((data == 0x27) | (data == 0x7C), starts) > 0
    cut = np.concatenate(([False], (kind[1:] != kind[:-1]) | (kind[1:] == 2)))
    cut[1:] &= ascii_[1:] & ascii_[:-1] & (kind[1:] > 0) & (kind[:-1] > 0)
    inner = np.flatnonzero(cut)
    word = np.searchsorted(starts, inner, "right") - 1
    first = np.zeros(len(data), bool)
    first[starts] = first[inner[~whole[word] & (inner < ends[word])]] = True
    begin = np.flatnonzero(first)
    word = np.searchsorted(starts, begin, "right") - 1
    return begin, np.minimum(np.append(begin[1:], len(data)), ends[word]), row[word]


class PrefixCounter:
    """Counts at every prefix for a byte-level BPE vocabulary with an end-of-word mark and no other affixes."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not self.mark or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("a byte-level BPE vocabulary with an end-of-word mark is needed")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self._load(model["vocab"], model["merges"])
        self.simple: dict[str, str | None] = {}
        self._forget()

    @classmethod
    def of_worker(cls, vocabulary: str) -> PrefixCounter:
        """The one that earlier tasks of this Python worker have filled, or a new one."""
        store = sys.modules.setdefault("streakline_prefix_store", types.ModuleType("streakline_prefix_store"))
        if vocabulary not in store.__dict__:
            store.__dict__[vocabulary] = cls(vocabulary)
        return store.__dict__[vocabulary]

    def _load(self, vocab: dict[str, int], merges: list) -> None:
        sign = _bytes_of_signs()
        n = max(vocab.values()) + 1
        self.left, self.right, self.rank = [-1] * n, [-1] * n, [-1] * n
        self.merge: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            self.merge[x, y] = r
            self.left[made], self.right[made], self.rank[made] = x, y, r
        self.pairs, self.pair_apart = np.zeros(0, np.int64), np.zeros(0, bool)
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        specials = set(self.specials)
        for text, token in vocab.items():
            if text in specials:
                continue
            ends = text.endswith(self.mark) and text != self.mark
            body = text[: -len(self.mark)] if ends else text
            if self._encodes_itself(token):
                (self.final if ends else self.inner)["".join(chr(sign[c]) for c in body)] = token
        self.longest = max(map(len, (*self.inner, *self.final)))
        # all tokens in one trie of bytes: edges (node * 256 + byte) in order, and what ends at each node
        nodes, edges = {"": 0}, []
        for text in sorted({*self.inner, *self.final}):
            for k in range(len(text)):
                if text[: k + 1] not in nodes:
                    nodes[text[: k + 1]] = len(nodes)
                    edges.append((nodes[text[:k]] * 256 + ord(text[k]), len(nodes) - 1))
        edges.sort()
        self.edge, self.edge_to = (np.array(e, np.int64) for e in zip(*edges))
        self.node_inner, self.node_final = np.full(len(nodes), -1, np.int64), np.full(len(nodes), -1, np.int64)
        for at, tokens in ((self.node_inner, self.inner), (self.node_final, self.final)):
            for text, token in tokens.items():
                at[nodes[text]] = token

    def _encodes_itself(self, token: int) -> bool:
        """Whether nothing is merged across the token's own seam before the merge that makes it."""
        return self.rank[token] < 0 or self._first_crossing(self.left[token], self.right[token]) == self.rank[token]

    def _first_crossing(self, a: int, b: int) -> int | None:
        """The rank of the merge that joins a symbol of ``a`` to one of ``b``, if there is one when ``a b`` is encoded.

        The symbols at the seam are the right edge of ``a`` and the left edge of ``b`` at each stage.  A
        pair of them merges if both still stand at its rank; at equal ranks the left one of two merges goes first.
        """
        best, merge, rank = None, self.merge, self.rank
        x, x_gone = a, 1 << 60
        while x >= 0:
            y, y_gone = b, 1 << 60
            while y >= 0:
                r = merge.get((x, y))
                if r is not None and r < x_gone and r <= y_gone and (best is None or r < best):
                    best = r
                y_gone, y = rank[y], self.left[y]
            x_gone, x = rank[x], self.right[x]
        return best

    def _all_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge joins a[i] and b[i], for each i."""
        asked, place = np.unique(a << 20 | b, return_inverse=True)
        at = np.searchsorted(self.pairs, asked)
        new = np.ones(len(asked), bool)
        there = at < len(self.pairs)
        new[there] = self.pairs[at[there]] != asked[there]
        if new.any():
            found = np.array([self._first_crossing(key >> 20, key & 0xFFFFF) is None for key in asked[new].tolist()])
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs, self.pair_apart = asked[~new], self.pair_apart[at[~new]]
                at = np.searchsorted(self.pairs, asked)
            self.pairs, self.pair_apart = np.insert(self.pairs, at[new], asked[new]), np.insert(self.pair_apart, at[new], found)
            at = np.searchsorted(self.pairs, asked)
        return self.pair_apart[at][place]

    def _runs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Counts at every byte of many pre-tokens at once: all their first bytes, then all their second bytes, and so on."""
        n = len(data)
        place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
        room = np.repeat(offsets[1:], np.diff(offsets))
        found = []  # (end, start, token) of every token in the text, with and without the end mark
        start, node = np.arange(n), np.zeros(n, np.int64)
        for m in range(self.longest):
            key = node * 256 + data[start + m]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            alive = self.edge[at] == key
            start, node = start[alive], self.edge_to[at[alive]]
            found.append((start + m, start, self.node_inner[node], self.node_final[node]))
            longer = start + m + 1 < room[start]
            start, node = start[longer], node[longer]
            if len(start) == 0:
                break
        end, start, inner, final = (np.concatenate(x) for x in zip(*found))
        count, last, out = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for tokens in (inner, final):
            is_token = np.flatnonzero(tokens >= 0)
            is_token = is_token[np.argsort(place[end[is_token]], kind="stable")]
            e, s, t = end[is_token], start[is_token], tokens[is_token]
            first = place[s] == 0
            if tokens is inner:  # one place after the other, since a last token needs those before it
                bounds = np.searchsorted(place[e], np.arange(place.max() + 2)) if n else np.zeros(1, np.int64)
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    fits = first[a:b].copy()
                    more = np.flatnonzero(~fits)
                    fits[more] = self._all_apart(last[s[a:b][more] - 1], t[a:b][more])
                    ok_e, ok_s = e[a:b][fits], s[a:b][fits]
                    count[ok_e] = np.where(first[a:b][fits], 0, count[ok_s - 1]) + 1
                    last[ok_e] = t[a:b][fits]
            else:
                fits = first.copy()
                more = np.flatnonzero(~fits)
                fits[more] = self._all_apart(last[s[more] - 1], t[more])
                out[e[fits]] = np.where(first[fits], 0, count[s[fits] - 1]) + 1
        return out

    def _run(self, text: str) -> list[int]:
        """Counts at every prefix (1 .. n symbols) of one pre-token, whose UTF-8 bytes are the characters of ``text``."""
        count, last, out = [0], [-1], []
        inner, final = self.inner, self.final
        apart = lambda a, b: self._first_crossing(a, b) is None
        for j in range(1, len(text) + 1):
            ended = here = None
            for i in range(j - 1, max(-1, j - 1 - self.longest), -1):
                part = text[i:j]
                if ended is None:
                    token = final.get(part)
                    if token is not None and (i == 0 or apart(last[i], token)):
                        ended = count[i] + 1
                if here is None:
                    token = inner.get(part)
                    if token is not None and (i == 0 or apart(last[i], token)):
                        here = token
                        count.append(count[i] + 1)
                        last.append(token)
                if ended is not None and here is not None:
                    break
            out.append(ended)
        return out

    def _pretoken(self, text: str) -> list[int]:
        """Counts at every code point of a normalised pre-token."""
        if text in _CONTRACTIONS:  # cut short it is an apostrophe and letters
            return [1, *(1 + n for n in self._pretoken(text[1:-1])), self._run(text)[-1]]
        raw = text.encode()
        counts = self._run(raw.decode("latin-1"))
        return counts if len(raw) == len(text) else [n for k, n in enumerate(counts) if k + 1 == len(raw) or raw[k + 1] & 0xC0 != 0x80]

    def _simple(self, char: str) -> str | None:
        """What ``char`` is normalised to where that is one character whatever stands around it, else None."""
        known = self.simple.get(char, "")
        if known == "":
            import unicodedata

            one = self.tokenizer.normalizer.normalize_str(char)
            alone = len(one) == 1 and unicodedata.combining(char) == 0 and unicodedata.combining(one) == 0
            # vowels and finals of Hangul and a few signs without a combining class join the character before them
            alone = alone and not 0x1100 <= ord(char) < 0x1200 and not unicodedata.category(char).startswith("M")
            known = self.simple[char] = one if alone else None
        return known

    def _ordinary(self, text: str) -> list[int]:
        """Counts at every code point of ``text``, in which no special token is recognised."""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        signs = [self._simple(c) for c in text]
        if None not in signs:
            out, total, at = [], 0, 0
            plain = "".join(signs)
            for _, (a, b) in split(plain):
                out += [total] * (a - at)
                out += [total + n for n in self._pretoken(plain[a:b])]
                total, at = out[-1], b
            return out + [total] * (len(plain) - at)
        # characters that change their neighbours: the prefixes since the last cut between pre-tokens are encoded as they are
        normal = self.tokenizer.normalizer.normalize_str
        out, total, start = [], 0, 0
        for k in range(1, len(text) + 1):
            pieces = split(normal(text[start:k]))
            out.append(total + sum(self._run(normal(text[start:k])[a:b].encode().decode("latin-1"))[-1] for _, (a, b) in pieces))
            settled = k < len(text) and signs[k] is not None and signs[k - 1] is not None
            if settled and (signs[k - 1].isspace() or signs[k - 1].isalpha() and not signs[k].isalpha()):
                total, start = out[-1], k
        return out

    def counts(self, text: str) -> list[int]:
        """Counts at every code point of ``text``."""
        out, total, start = [], 0, 0
        while True:
            found = [(at, s) for s in self.specials if (at := text.find(s, start)) >= 0]
            if not found:
                return out + [total + n for n in self._ordinary(text[start:])]
            at, special = min(found)
            end = at + len(special)
            cut = self._ordinary(text[start : end - 1])  # until its last character it is ordinary text
            out += [total + n for n in cut]
            total += (cut[at - start - 1] if at > start else 0) + 1
            out.append(total)
            start = end

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _plain(self, piece: bytes) -> bytes | None:
        """The normalised bytes of a piece that is a single pre-token of characters that leave each other alone, as many as it has; else None."""
        if len(piece) > TOGETHER:
            return None
        if piece.isascii():
            return None if b"'" in piece or b"|" in piece else piece.lower()
        signs = [self._simple(c) for c in piece.decode()]
        if None in signs or not (plain := "".join(signs)).isalpha():
            return None
        return plain.encode()

    def _learn(self, new: list[bytes]) -> None:
        """Solve ``new`` pieces and add them to the memory, in order."""
        plain = [self._plain(p) for p in new]
        together = [p for p in plain if p is not None]
        sizes = np.fromiter(map(len, together), np.int64, len(together))
        data = np.frombuffer(b"".join(together), np.uint8)
        counts = self._runs(data, np.concatenate(([0], np.cumsum(sizes)))) if len(data) else np.zeros(0, np.int64)
        last_byte = np.append((data[1:] & 0xC0) != 0x80, True)[: len(data)]  # of a character
        solved = counts[last_byte]
        shared = np.array([p is not None for p in plain], bool)
        alone = [self.counts(p.decode()) for p, together_ in zip(new, shared) if not together_]
        size = np.zeros(len(new), np.int64)
        if len(data):
            size[shared] = np.add.reduceat(last_byte, np.cumsum(sizes) - sizes, dtype=np.int64)
        size[~shared] = [len(c) for c in alone]
        begin = np.zeros(len(new), np.int64)
        begin[shared] = np.cumsum(size[shared]) - size[shared]
        begin[~shared] = len(solved) + np.cumsum(size[~shared]) - size[~shared]
        self.begin = np.concatenate((self.begin, begin + len(self.pool)))
        self.size = np.concatenate((self.size, size))
        self.pool = np.concatenate((self.pool, solved.astype(np.int32), *(np.array(c, np.int32) for c in alone)))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))

    @staticmethod
    def _occurs(data: np.ndarray, text: str) -> bool:
        return text.encode() in memoryview(data).tobytes()

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count at every code point of a block's rows, one row after the other, and the rows' bounds in it."""
        if not any(self._occurs(data, s) for s in self.specials):  # special tokens are the only strings that depend on case
            data = LOWER[data]
        starts, ends, row = pieces(data, offsets)
        head = (data & 0xC0) != 0x80
        bounds = np.concatenate(([0], np.cumsum(head)))[offsets]
        if len(starts) == 0:
            return np.zeros(bounds[-1], np.int64), bounds
        lengths = ends - starts
        word_byte = ~WHITE[data]
        ids = pa.Array.from_buffers(
            pa.binary(), len(starts),
            [None, pa.py_buffer(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[word_byte]))],
        ).dictionary_encode()
        distinct = ids.dictionary.to_pylist()
        if len(self.known) + len(distinct) > KEPT_PIECES:
            self._forget()
        known = self.known
        if new := [p for p in distinct if p not in known]:
            self._learn(new)
        numbers = np.fromiter((known[p] for p in distinct), np.int64, len(distinct))
        number = numbers[ids.indices.to_numpy()]
        size, begin = self.size[number], self.begin[number]
        total = self.pool[begin + size - 1].astype(np.int64)
        before = np.concatenate(([0], np.cumsum(total)))
        first = np.searchsorted(row, np.arange(len(offsets)))  # the first piece of each row
        base = before[:-1] - before[first][row]
        out = np.empty(bounds[-1], np.int64)
        in_word = word_byte[head]
        inside = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out[in_word] = np.repeat(base, size) + self.pool[inside]
        white = np.flatnonzero(head & ~word_byte)
        white_row = np.searchsorted(offsets, white, "right") - 1
        out[~in_word] = before[np.searchsorted(starts, white)] - before[first][white_row]
        return out, bounds


def _parts(counts: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One list of parts per row: first prefix, its count, the last and the lowest count, and the steps in between."""
    n_rows = len(bounds) - 1
    row = np.repeat(np.arange(n_rows), np.diff(bounds))
    place = np.arange(len(counts)) - bounds[:-1][row]
    step = np.diff(counts, prepend=0)
    head = bounds[:-1][np.diff(bounds) > 0]
    step[head] = counts[head]
    wide = np.abs(step) > 127
    cut = np.flatnonzero((place % PART == 0) & (place > 0) | wide)
    # every row begins with a part from its empty prefix on; a part at a cut starts with the prefix that ends there
    begins = np.sort(np.concatenate((bounds[:-1], cut)), kind="stable")
    of = np.concatenate((np.arange(n_rows), row[cut]))[np.argsort(np.concatenate((bounds[:-1], cut)), kind="stable")]
    at_cut = np.ones(len(begins), bool)
    at_cut[np.searchsorted(of, np.arange(n_rows))] = False
    ends = np.append(begins[1:], len(counts))
    ends[np.append(of[1:] != of[:-1], True)] = bounds[1:]
    first = np.where(at_cut, begins - bounds[:-1][of] + 1, 0)
    padded = np.append(counts, 0)
    before = np.where(at_cut, padded[begins], 0)
    last = np.where(ends > begins, padded[np.maximum(ends, 1) - 1], before)
    low = np.minimum(before, np.minimum.reduceat(np.append(counts, np.iinfo(np.int64).max), begins)) if len(counts) else before
    low = np.where(ends > begins, low, before)
    steps_from = begins + at_cut
    keep = np.ones(len(counts), bool)
    keep[begins[at_cut]] = False
    flat = pa.Array.from_buffers(
        pa.binary(), len(begins),
        [None, pa.py_buffer(np.concatenate(([0], np.cumsum(np.maximum(ends - steps_from, 0)))).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(step[keep].astype(np.int8)))],
    )
    items = pa.StructArray.from_arrays([pa.array(first), pa.array(before), pa.array(last), pa.array(low), flat], fields=list(_PARTS.value_type))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n_rows + 1)).astype(np.int32)), items)


def prefix_table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_chars and ``parts``, the exact token counts of all prefixes of ``text``, for each row of ``docs``.

    A part has the prefix it starts with (``first``, in code points), that prefix's count (``before``), one
    signed byte for each longer one (``steps``), its ``last`` count and its lowest (``low``).  A step that
    a byte cannot hold starts a new part.  Null text is empty, with the single prefix 0; null and repeated ids
    are rows like any other; columns beside doc_id and text are not read; an empty table gives no rows.  A long text is one row
    with as many parts as it needs.  A word with characters that
    alter their neighbours (combining marks) is encoded anew at each of its prefixes; all others take time linear in their length.
    """
    id_field = docs.schema["doc_id"]
    id_type = to_arrow_type(id_field.dataType)

    def run(batches):
        counter = PrefixCounter.of_worker(vocabulary)
        for rows, data, offsets in blocks(batches, "text"):
            counts, bounds = counter.block(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(id_type), pa.array(np.diff(offsets)), pa.array(np.diff(bounds)), _parts(counts, bounds)],
                names=["doc_id", "n_bytes", "n_chars", "parts"],
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_field.dataType.simpleString()}, n_bytes long, n_chars long, parts {_PARTS_SQL}"
    )


def token_count(parts: str = "parts") -> Column:
    """Tokens of the whole text, from a row of the table."""
    return F.element_at(parts, -1)["last"]


def _counts_of(part: dict) -> np.ndarray:
    """Counts at prefixes ``first``, ``first + 1``, ..."""
    return part["before"] + np.concatenate(([0], np.cumsum(np.frombuffer(part["steps"], np.int8), dtype=np.int64)))


def _asked(table: DataFrame, question, out: str, kind: str, *reads: str) -> DataFrame:
    """``table`` with ``question(parts, *reads)`` of each row as column ``out``; the rows' other columns go along."""
    out = free_name(table.columns, out)

    def run(batches):
        for batch in batches:
            at = [batch.schema.get_field_index(c) for c in ("parts", *reads)]
            values = [question(*(batch.column(i)[k].as_py() for i in at)) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], names=[*batch.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return table.mapInArrow(run, f"{fields}, `{out}` {kind}")


def count_at(table: DataFrame, length: str, out: str = "tokens_at") -> DataFrame:
    """Tokens of each row's prefix of ``length`` code points (null: null; beyond the text: the whole text), from the table alone."""

    def question(parts, n):
        if n is None:
            return None
        part = next(p for p in reversed(parts) if p["first"] <= max(n, 0))
        counts = _counts_of(part)
        return int(counts[min(max(n, 0) - part["first"], len(counts) - 1)])

    return _asked(table, question, out, "long", length)


def longest_prefix(table: DataFrame, budget: int, out: str = "kept_chars") -> DataFrame:
    """Code points of each row's longest prefix of at most ``budget`` tokens, from the table alone.

    Counts can fall as a prefix grows (a longer word may need fewer tokens), so the longest one need not be the first to reach the budget.
    """

    def question(parts):
        part = next(p for p in reversed(parts) if p["low"] <= budget)
        return int(part["first"] + np.flatnonzero(_counts_of(part) <= budget)[-1])

    return _asked(table, question, out, "long")
