"""Suffix-array dedup: bytes covered by a long string that also starts somewhere else are removed.

Every string of ``length`` bytes is assigned to its *anchor*, the place within it
of the gram with the smallest hash (the leftmost of ties).  Equal strings have
their anchors at equal offsets, so only strings whose anchors begin with the
same gram need comparing.  An anchor's *context* is the text that the strings
assigned to it span.

Anchors are grouped by gram.  Contexts that occur twice as a whole are settled
by counting.  The distinct ones of a group are sorted twice as suffixes, to the
right of the anchor and (reversed) to the left, by deep-shallow sorting: multikey
quicksort over eight-byte letters to a shallow depth, then blind tries order the
groups that are still tied.  The common prefixes of neighbours tell which
strings of a context occur in another: those equal on both sides of the anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.tables import numbered, numbered_texts, small_side, stored
from streakline.llm.textblocks import SpanHash, blocks

LENGTH = 400
#: Depth in bytes to which groups are sorted by multikey quicksort; blind tries take over there.
SHALLOW = 32
#: Distinct contexts of one gram that a task sorts; the strings of larger groups are counted by their hashes.
GROUP_CONTEXTS = 30_000
#: Contexts sorted together in a task.
SORT_CONTEXTS = 8_000
BLOCK_BYTES = 1 << 19
SECOND_BASE = 0xC2B2AE3D27D4EB4F
#: What a row of a join side that holds runs or contexts, and each of them, takes in memory at most.
RUN_BYTES = 64
#: Largest such side that is broadcast, since the other one holds the texts; beyond it the texts are shuffled.
LARGEST_SIDE = 192 << 20

CLASS = ["gram", "context", "rel", "span"]


def gram_bytes(length: int) -> int:
    return max(1, length // 6)


def block_anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """(row, anchor, first and last start of its strings, gram hash, context hash) of each anchor, places within the row."""
    gram = gram_bytes(length)
    width = length - gram + 1
    size = np.diff(offsets)
    has = np.flatnonzero(size >= length)
    empty = np.zeros(0, np.int64)
    if len(has) == 0:
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hashed = SpanHash(data)
    place = np.arange(len(data) - gram + 1)
    order = (hashed(place, place + gram) & np.uint64(0xFFFFFFFF << 32)) | place.astype(np.uint64)
    least = _sliding_min(order, width)
    count = size[has] - length + 1
    first = offsets[:-1][has]
    row = np.repeat(has, count)
    start = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])))
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(start)) - 1
    row, anchor, low, high = row[at], anchor[at], start[at], start[last]
    base = offsets[:-1][row]
    return row, anchor - base, low - base, high - base, hashed(anchor, anchor + gram), hashed(low, high + length)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from block-wise running minima of both directions."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _anchors(length: int):
    def run(batches):
        for rows, data, offsets in blocks(batches, "text", BLOCK_BYTES):
            row, anchor, low, high, gram, context = block_anchors(data, offsets, length)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(row)), pa.array(low.astype(np.int32)), pa.array(gram.view(np.int64)),
                    pa.array(context.view(np.int64)), pa.array((anchor - low).astype(np.int32)), pa.array((high - low).astype(np.int32)),
                ],
                names=["row_id", "low", *CLASS],
            )

    return run


class BlindTrie:
    """Patricia trie that holds branching depths only; a string is compared once, with the leaf a blind descent finds."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: int | tuple[int, dict[int, object]] | None = None

    def _letter(self, k: int, depth: int) -> int:
        s = self.strings[k]
        return s[depth] if depth < len(s) else -1  # the end sorts before every byte

    def insert(self, k: int) -> None:
        if self.root is None:
            self.root = k
            return
        node = self.root
        while not isinstance(node, int):
            depth, children = node
            letter = self._letter(k, depth)
            node = children[letter] if letter in children else next(iter(children.values()))
        common = common_prefix(self.strings[k], self.strings[node])
        above, node = None, self.root
        while not isinstance(node, int) and node[0] < common:
            letter = self._letter(k, node[0])
            above, node = (node[1], letter), node[1][letter]
        if not isinstance(node, int) and node[0] == common:
            node[1][self._letter(k, common)] = k
            return
        leaf = node
        while not isinstance(leaf, int):
            leaf = next(iter(leaf[1].values()))
        branch = (common, {self._letter(leaf, common): node, self._letter(k, common): k})
        if above is None:
            self.root = branch
        else:
            above[0][above[1]] = branch

    def ordered(self) -> tuple[list[int], list[int]]:
        """Strings in order, and the common prefix of each with the one before it."""
        order: list[int] = []
        common: list[int] = []
        stack = [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if isinstance(node, int):
                order.append(node)
                common.append(shared)
            else:
                depth, children = node
                letters = sorted(children)
                for i in range(len(letters) - 1, -1, -1):
                    stack.append((children[letters[i]], depth if i else shared))
        return order, common


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:  # halving on memory comparisons
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def deep_shallow(strings: list[bytes], group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within each group (groups ascending), and each one's common prefix with the one before (-1 at a group's first)."""
    n = len(strings)
    depth = -(-shallow // 8) * 8
    table = np.zeros((n, depth), np.uint8)
    size = np.array([len(s) for s in strings], np.int64)
    for i, s in enumerate(strings):
        head = s[:depth]
        table[i, : len(head)] = np.frombuffer(head, np.uint8)
    letters = table.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    tied = group[order].astype(np.int64)
    common = np.full(n, -1, np.int64)
    common[1:][tied[1:] == tied[:-1]] = depth
    # multikey quicksort, one eight-byte letter at a time, all tied groups at once
    active = np.arange(n)
    for k in range(letters.shape[1]):
        same = np.concatenate((tied[active][1:] == tied[active][:-1], [False])) if len(active) else np.zeros(0, bool)
        same = same | np.concatenate(([False], same[:-1])) if len(active) else same
        active = active[same]
        if len(active) == 0:
            break
        own = order[active]
        by = np.lexsort((size[own], letters[own, k], tied[active]))
        order[active] = own[by]
        own = order[active]
        letter = letters[own, k]
        differ = np.flatnonzero((tied[active][1:] == tied[active][:-1]) & (letter[1:] != letter[:-1])) + 1
        apart = letter[differ] ^ letter[differ - 1]
        common[active[differ]] = 8 * k + sum((apart >> np.uint64(64 - 8 * b) == 0).astype(np.int64) for b in range(1, 8))
        step = np.zeros(n, np.int64)
        step[active[differ]] = 1
        tied = np.cumsum(np.concatenate(([1], (tied[1:] != tied[:-1]).astype(np.int64))) | step)
    common[1:] = np.minimum(common[1:], np.minimum(size[order][1:], size[order][:-1]))
    # what is tied to the shallow depth goes through blind tries
    start = np.flatnonzero(np.concatenate(([True], tied[1:] != tied[:-1]))) if n else np.zeros(0, np.int64)
    for a, b in zip(start.tolist(), np.append(start[1:], n).tolist()):
        if b - a < 2:
            continue
        trie = BlindTrie(strings)
        copies: dict[bytes, list[int]] = {}
        for k in order[a:b].tolist():
            copies.setdefault(strings[k], []).append(k)
        for same in copies.values():
            trie.insert(same[0])
        sequence, shared = trie.ordered()
        at = a
        for k, c in zip(sequence, shared):
            for i, copy in enumerate(copies[strings[k]]):
                order[at] = copy
                if i or at > a:
                    common[at] = len(strings[copy]) if i else c
                at += 1
    return order, common


def repeated_starts(contexts: list[bytes], group: np.ndarray, rel: np.ndarray, span: np.ndarray, length: int) -> np.ndarray:
    """Table (context, start): whether the string at that start of the context also occurs in another context of its group."""
    n = len(contexts)
    right = [c[r : r + length] for c, r in zip(contexts, rel.tolist())]
    left = [c[:r][::-1] for c, r in zip(contexts, rel.tolist())]
    order_r, common_r = deep_shallow(right, group)
    order_l, common_l = deep_shallow(left, group)
    out = np.zeros((n, int(span.max()) + 1), bool)
    label_r, label_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(int(rel.max()) + 1):  # bytes of a string to the left of the anchor
        start = rel - o
        own = np.flatnonzero((start >= 0) & (start <= span))
        if len(own) < 2:
            continue
        label_r[order_r] = np.cumsum(common_r < length - o)
        label_l[order_l] = np.cumsum(common_l < o)
        key = label_r[own] * (n + 1) + label_l[own]
        by = np.argsort(key, kind="stable")
        equal = np.diff(key[by]) == 0
        hit = np.zeros(len(own), bool)
        hit[by[1:][equal]] = hit[by[:-1][equal]] = True
        out[own[hit], start[own[hit]]] = True
    return out


def _sorted_groups(length: int):
    """Contexts sorted by gram to (class, first start, last start) ranges of strings that occur in other contexts of the gram."""

    def settle(rows: pa.Table):
        grams = rows.column("gram").to_numpy()
        group = np.concatenate(([0], np.cumsum(grams[1:] != grams[:-1])))
        rel, span = rows.column("rel").to_numpy().astype(np.int64), rows.column("span").to_numpy().astype(np.int64)
        table = repeated_starts(rows.column("bytes").to_pylist(), group, rel, span, length)
        edge = np.diff(np.pad(table, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, first = np.nonzero(edge == 1)
        _, last = np.nonzero(edge == -1)
        picked = rows.select(["row_id", "low"]).take(pa.array(who))
        low = picked.column("low").to_numpy().astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [picked.column("row_id").combine_chunks(), pa.array(low + first), pa.array(low + last - 1 + length)], names=["row_id", "a", "b"]
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < SORT_CONTEXTS:
                continue
            rows = pa.Table.from_batches(held)
            grams = rows.column("gram").to_numpy()
            whole = int(np.searchsorted(grams, grams[-1]))  # the last group may go on
            if whole:
                yield from _portions(rows.slice(0, whole), grams[:whole], settle)
            held = rows.slice(whole).combine_chunks().to_batches()
            n = len(grams) - whole
        if n:
            rows = pa.Table.from_batches(held)
            yield from _portions(rows, rows.column("gram").to_numpy(), settle)

    return run


def _portions(rows: pa.Table, grams: np.ndarray, settle):
    """Whole groups, about SORT_CONTEXTS contexts at a time."""
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    a = 0
    while a < len(grams):
        k = np.searchsorted(first, a + SORT_CONTEXTS, "right")
        b = int(first[k - 1]) if k and first[k - 1] > a else int(first[k]) if k < len(first) else len(grams)
        if len(grams) - a <= SORT_CONTEXTS:
            b = len(grams)
        yield settle(rows.slice(a, b - a))
        a = b


def _fetch(length: int):
    """Documents with the contexts asked of them to one row per context."""

    def run(batches):
        for rows, data, offsets in blocks(batches, "text"):
            view = data.tobytes()
            wanted = rows.column(rows.schema.get_field_index("wanted")).to_pylist()
            out = [
                (row, w["low"], w["gram"], w["rel"], w["span"], view[o + w["low"] : o + w["low"] + w["span"] + length])
                for row, o, ws in zip(rows.column(0).to_pylist(), offsets[:-1].tolist(), wanted)
                for w in ws
            ]
            for k in range(0, len(out), 20_000):
                part = list(zip(*out[k : k + 20_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0], pa.int64()), *(pa.array(part[i], t) for i, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.int32()), (4, pa.int32()), (5, pa.binary())))],
                    names=["row_id", "low", "gram", "rel", "span", "bytes"],
                )

    return run


def _string_hashes(length: int):
    """Every string of each context: two hashes and where it is."""

    def run(batches):
        for batch in batches:
            for row, low, span, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                data = np.frombuffer(text, np.uint8)
                start = np.arange(span + 1)
                one, two = SpanHash(data)(start, start + length), SpanHash(data, SECOND_BASE)(start, start + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(np.full(span + 1, row)), pa.array(low + start)],
                    names=["one", "two", "row_id", "a"],
                )

    return run


def repeated_spans(rows: DataFrame, length: int = LENGTH, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """Byte spans (row_id, a, b) whose union is what repeated strings of ``length`` bytes cover in ``rows`` (row_id long, text)."""
    anchors = stored(
        rows.select("row_id", "text").mapInArrow(_anchors(length), "row_id long, low int, gram long, context long, rel int, span int"),
        "anchors",
    )
    classes = anchors.groupBy(*CLASS).agg(F.count("*").alias("n"), F.min(F.struct("row_id", "low")).alias("first"))
    per_gram = classes.groupBy("gram").agg(F.count("*").alias("contexts"), F.count_if(F.col("n") == 1).alias("single"))
    # grams that occur once are most of them, and settled
    several = stored(classes.join(per_gram.filter("contexts > 1 or single = 0"), "gram"), "classes")
    whole = several.filter("n > 1").select(*CLASS)
    spans = [
        anchors.join(small_side(whole, whole.count(), 40), CLASS, "left_semi")
        .select("row_id", F.col("low").cast("bigint").alias("a"), (F.col("low") + F.col("span") + length).cast("bigint").alias("b"))
    ]
    asked = several.filter("contexts > 1 and single > 0").select("first.*", "gram", "rel", "span", "contexts", "n")
    by_row = stored(
        asked.groupBy("row_id").agg(F.collect_list(F.struct("low", "gram", "rel", "span")).alias("wanted"), F.count("*").alias("m")), "asked"
    )
    n_rows, n_asked = by_row.agg(F.count("*"), F.sum("m")).first()
    if n_rows:
        contexts = (
            rows.select("row_id", "text").join(small_side(by_row.drop("m"), 1, RUN_BYTES * (n_rows + n_asked), LARGEST_SIDE), "row_id")
            .select("row_id", "wanted", "text").mapInArrow(_fetch(length), "row_id long, low int, gram long, rel int, span int, bytes binary")
        )
        hot = several.filter((F.col("contexts") > group_contexts) & (F.col("single") > 0)).select("gram").distinct()
        hot = stored(hot, "hot")
        if hot.isEmpty():
            ordinary = contexts
        else:
            contexts = stored(contexts, "contexts")
            ordinary = contexts.join(hot, "gram", "left_anti")
            strings = stored(
                contexts.join(hot, "gram", "left_semi").select("row_id", "low", "span", "bytes")
                .mapInArrow(_string_hashes(length), "one long, two long, row_id long, a long"),
                "strings",
            )
            twice = strings.groupBy("one", "two").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
            spans.append(strings.join(twice, ["one", "two"], "left_semi").select("row_id", "a", (F.col("a") + length).alias("b")))
        spans.append(
            ordinary.select("row_id", "low", "gram", "rel", "span", "bytes").repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(_sorted_groups(length), "row_id long, a long, b long")
        )
    out = spans[0]
    for part in spans[1:]:
        out = out.unionByName(part)
    return out


def _merged(batches):
    """Spans of each row (row_id, starts, ends) to its maximal runs."""
    for batch in batches:
        runs = []
        for starts, ends in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            a, b = np.array(starts), np.array(ends)
            by = np.argsort(a, kind="stable")
            a, reach = a[by], np.maximum.accumulate(b[by])
            first = np.flatnonzero(np.concatenate(([True], a[1:] > reach[:-1])))
            runs.append([{"start": x, "end": y} for x, y in zip(a[first].tolist(), reach[np.append(first[1:], len(a)) - 1].tolist())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["row_id", "runs"]
        )


def _removed(batches):
    for rows, data, offsets in blocks(batches, "text"):
        view = data.tobytes()
        found, kept = [], []
        for a, b, runs in zip(offsets[:-1].tolist(), offsets[1:].tolist(), rows.column(rows.schema.get_field_index("runs")).to_pylist()):
            at, parts = 0, []
            for run in runs or []:
                parts.append(view[a + at : a + run["start"]])
                at = run["end"]
            found.append(runs or [])
            kept.append(b"".join([*parts, view[a + at : b]]))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(0), pa.array(np.diff(offsets)),
                pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()), *rows.columns[3:],
            ],
            names=["doc_id", "n_bytes", "removed", "kept", *rows.schema.names[3:]],
        )


def _runs(rows: DataFrame, length: int, group_contexts: int) -> DataFrame:
    """Stored maximal runs (row_id, runs) of the bytes that repeated strings of ``length`` bytes cover."""
    return stored(
        repeated_spans(rows, length, group_contexts).groupBy("row_id").agg(F.collect_list("a").alias("starts"), F.collect_list("b").alias("ends"))
        .mapInArrow(_merged, "row_id long, runs array<struct<start: bigint, end: bigint>>"),
        "runs",
    )


def _with_runs(rows: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    n_rows, n_runs = runs.agg(F.count("*"), F.sum(F.size("runs"))).first()
    return rows.join(small_side(runs, 1, RUN_BYTES * (n_rows + (n_runs or 0)), LARGEST_SIDE), "row_id", how)


def _cut_out(length: int):
    """The runs of at least ``length`` bytes as rows of their own, with where they begin."""

    def run(batches):
        for rows, data, offsets in blocks(batches, "text"):
            view = data.tobytes()
            cut = [
                (row, r["start"], view[o + r["start"] : o + r["end"]])
                for row, o, runs in zip(rows.column(0).to_pylist(), offsets[:-1].tolist(), rows.column(rows.schema.get_field_index("runs")).to_pylist())
                for r in runs
                if r["end"] - r["start"] >= length
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in cut], pa.int64()), pa.array([c[1] for c in cut], pa.int64()), pa.array([c[2] for c in cut], pa.binary())],
                names=["whole_id", "start", "text"],
            )

    return run


def _runs_by_length(rows: DataFrame, lengths: list[int], group_contexts: int) -> dict[int, DataFrame]:
    """:func:`_runs` for each length.  A repeated string lies inside a run of any shorter length, and so does the string it repeats:
    after the shortest length only the runs of the one before are looked at.
    """
    out, pieces = {}, None
    for k, length in enumerate(lengths):
        if pieces is None:
            out[length] = _runs(rows, length, group_contexts)
        else:
            found = _runs(pieces, length, group_contexts)
            moved = F.transform("runs", lambda r: F.struct((r["start"] + F.col("start")).alias("start"), (r["end"] + F.col("start")).alias("end")))
            back = found.join(pieces.select("row_id", "whole_id", "start"), "row_id").select(F.col("whole_id").alias("row_id"), "start", moved.alias("runs"))
            out[length] = stored(back.groupBy("row_id").agg(F.flatten(F.array_sort(F.collect_list(F.struct("start", "runs")))["runs"]).alias("runs")), "runs")
        if k + 1 < len(lengths):
            whole, longer = rows.select("row_id", "text"), F.exists("runs", lambda r: r["end"] - r["start"] >= lengths[k + 1])
            cut = _with_runs(whole, out[length].filter(longer), "inner").select("row_id", "runs", "text")
            cut = cut.mapInArrow(_cut_out(lengths[k + 1]), "whole_id long, start long, text binary")
            pieces = numbered(cut, "row_id")
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, group_contexts: int = GROUP_CONTEXTS, also: tuple[int, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, anything else): doc_id, n_bytes, removed (maximal byte runs), kept (the other bytes).

    A byte goes when a string of ``length`` bytes that covers it also starts
    anywhere else, in the same or another row; repeated rows repeat each other's
    strings.  Null text is empty.  ``docs`` is read once, numbered and stored.
    For each length in ``also`` a column ``n_repeated_<length>`` says how many bytes strings of that length would remove;
    nothing is removed by it.
    """
    rows = numbered_texts(docs)
    by_length = _runs_by_length(rows, sorted({length, *also}), group_contexts)
    runs = by_length[length]
    for other in also:
        covered = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, run: n + run["end"] - run["start"])
        runs = runs.join(by_length[other].select("row_id", covered.alias(f"n_repeated_{other}")), "row_id", "full")
    if also:
        runs = stored(runs, "all-runs")
    id_type = dict(docs.dtypes)["doc_id"]
    counts = [F.coalesce(f"n_repeated_{other}", F.lit(0).cast("bigint")).alias(f"n_repeated_{other}") for other in also]
    return (
        _with_runs(rows, runs, "left")
        .select("doc_id", "runs", "text", *counts)
        .mapInArrow(
            _removed,
            f"doc_id {id_type}, n_bytes long, removed array<struct<start: bigint, end: bigint>>, kept binary" + "".join(f", n_repeated_{o} long" for o in also),
        )
    )
