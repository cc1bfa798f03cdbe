"""Ranked lexical search of many items at once by dual trees over items and documents.

One pass over the documents keeps what the items' terms need: per document its
number of terms and the occurrences of item terms, in rows of whole text blocks.  Corpus figures (documents, terms,
document frequencies) are sums over these rows.  The search then reads the rows, and
each task builds a tree over its documents, whose nodes hold the largest
worth of every term below them, and a tree over the items, whose nodes hold the largest repeats.
The product of two nodes bounds every score between their members.  Pairs of nodes whose bound is below the
weakest k-th score of the node's items are dropped, batch by batch; what is
left when both trees end are exact scores.  Tasks hand over k documents an item, and a
window over items puts them in order.

Scores are whole numbers; bounds are sums of whole numbers, so nothing is lost to rounding.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streakline.llm.tables import numbered, stored
from streakline.llm.textblocks import LOWER, blocks, row_bounds, word_spans

K = 10
#: Bytes of text per row of the index, and of item text searched in one go (a longer item is one by itself).
BLOCK_BYTES = 4 << 20
ITEM_BYTES = 2 << 20
#: Documents in one tree; children of a node of documents and of items.
TREE_DOCS = 8192
DOC_FAN = 16
ITEM_FAN = 4
#: Sums below this are exact in floating point.
EXACT = 1 << 53

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def block_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of a block's rows, in order, and the row of each."""
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets, WORD)
    # between two terms there is at least one other byte or the end of a row, so the term bytes stand in order
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[WORD[data]]))])
    return terms, row


def _index_rows(vocabulary: list[bytes], id_type: pa.DataType):
    def run(batches):
        known = pa.array(vocabulary, pa.binary())
        for rows, data, offsets in blocks(batches, "text", BLOCK_BYTES):
            terms, row = block_terms(data, offsets)
            n_terms = np.diff(row_bounds(row, len(offsets) - 1))
            at = pc.index_in(terms, value_set=known)
            hit = pc.is_valid(at).to_numpy(zero_copy_only=False)
            term = pc.drop_null(at).to_numpy().astype(np.int64)
            pairs, tf = np.unique(row[hit] * len(vocabulary) + term, return_counts=True)
            doc, term = np.divmod(pairs, max(len(vocabulary), 1))
            docs, doc = np.unique(doc, return_inverse=True)
            df_term, df = np.unique(term, return_counts=True)
            ids = rows.column(0).cast(id_type).take(pa.array(docs))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int((n_terms > 0).sum())], pa.int64()), pa.array([int(n_terms.sum())], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([n_terms[docs].astype("<i8").tobytes()], pa.binary()),
                    pa.array([doc.astype("<i4").tobytes()], pa.binary()), pa.array([term.astype("<i4").tobytes()], pa.binary()),
                    pa.array([tf.astype("<i4").tobytes()], pa.binary()),
                    pa.array([df_term.tolist()], pa.list_(pa.int32())), pa.array([df.tolist()], pa.list_(pa.int64())),
                ],
                names=["n_docs", "n_terms", "doc_ids", "lengths", "docs", "terms", "tfs", "df_terms", "dfs"],
            )

    return run


@dataclass
class Corpus:
    """What scores need to know of all documents: their number, their terms, and a weight for each of the items' terms."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    def worth(self, length: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """What each (document, term) adds to a score, per repeat of the term in the item."""
        m = 100 - 75 + (75 * length * self.n_docs) // self.n_terms
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class ItemTree:
    """Nodes over the items of one search: [members, terms, largest repeats, children], the root first."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], df: np.ndarray):
        # items that share their most frequent terms (their language, say) stand together
        order = sorted((i for i, (terms, _) in enumerate(items) if len(terms)), key=lambda i: tuple(items[i][0][np.argsort(-df[items[i][0]], kind="stable")][:8].tolist()))
        level = [([i], *items[i], []) for i in order]
        while len(level) > 1:
            level = [self._over(level[k : k + ITEM_FAN]) for k in range(0, len(level), ITEM_FAN)]
        self.root = level[0] if level else None

    @staticmethod
    def _over(nodes: list) -> tuple:
        if len(nodes) == 1:
            return nodes[0]
        terms, place = np.unique(np.concatenate([n[1] for n in nodes]), return_inverse=True)
        most = np.zeros(len(terms), np.int64)
        np.maximum.at(most, place, np.concatenate([n[2] for n in nodes]))
        return [i for n in nodes for i in n[0]], terms, most, nodes


class DocTree:
    """Levels of (term, node) maxima over some documents, from the documents themselves (level 0) to one root."""

    def __init__(self, n_docs: int, doc: np.ndarray, term: np.ndarray, worth: np.ndarray):
        # documents whose worthiest term is the same stand together
        rise = np.lexsort((worth, doc))
        last = np.searchsorted(doc[rise], np.arange(n_docs), "right") - 1
        self.order = np.lexsort((-worth[rise][last], term[rise][last]))
        place = np.empty(n_docs, np.int64)
        place[self.order] = np.arange(n_docs)
        node, n = place[doc], n_docs
        sort = np.lexsort((node, term))
        node, term, worth = node[sort], term[sort], worth[sort]
        self.levels = [(n, term * n + node, node, worth)]
        while n > 1:
            n = -(-n // DOC_FAN)
            node = node // DOC_FAN
            head = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (term[1:] != term[:-1]))))
            node, term, worth = node[head], term[head], np.maximum.reduceat(worth, head)
            self.levels.append((n, term * n + node, node, worth))

    def sums(self, level: int, parents: np.ndarray, terms: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, bounds) of the children at ``level`` of the nodes ``parents`` above it that hold any of ``terms``."""
        n, key, node, worth = self.levels[level]
        low = np.minimum(parents * DOC_FAN, n) if level < len(self.levels) - 1 else parents
        high = np.minimum(low + DOC_FAN, n)
        first = np.searchsorted(key, (terms[:, None] * n + low).ravel())
        size = np.searchsorted(key, (terms[:, None] * n + high).ravel()) - first
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        each = np.repeat(np.repeat(repeats, len(parents)), size)
        touched, place = np.unique(node[at], return_inverse=True)
        value = worth[at] * each
        if len(value) == 0 or float(value.max()) * len(value) < EXACT:
            return touched, np.bincount(place, value, len(touched)).astype(np.int64)
        out = np.zeros(len(touched), np.int64)
        np.add.at(out, place, value)
        return touched, out


class Best:
    """The k best documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.found: list[list[tuple]] = [[] for _ in range(n_items)]  # (-score, id is null, id), best first
        self.weakest = np.zeros(n_items, np.int64)  # the k-th best score, 0 until there are k

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        new = [(-s, i is None, 0 if i is None else i) for s, i in zip(scores.tolist(), ids)]
        self.found[item] = sorted(self.found[item] + new)[: self.k]
        if len(self.found[item]) == self.k:
            self.weakest[item] = -self.found[item][-1][0]


def dual_search(items: ItemTree, docs: DocTree, ids: pa.Array, best: Best) -> int:
    """Fill ``best`` with what the documents of one tree add; returns the number of scores that were computed."""
    rank = np.empty(len(ids), np.int64)
    rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    scored = 0

    def score(item: int, terms, repeats, parents) -> None:
        nonlocal scored
        found, scores = docs.sums(0, parents, terms, repeats)
        scored += len(found)
        keep = (scores >= best.weakest[item]) & (scores > 0)
        found, scores = docs.order[found[keep]], scores[keep]
        top = np.lexsort((rank[found], -scores))[: best.k]
        if len(top):
            best.add(item, scores[top], ids.take(pa.array(found[top])).to_pylist())

    def visit(node, level: int, parents: np.ndarray) -> None:
        """``parents`` are nodes of ``level + 1`` (of the top itself, at the top)."""
        members, terms, repeats, children = node
        if level == 0 and not children:
            return score(members[0], terms, repeats, parents)
        found, bounds = docs.sums(level, parents, terms, repeats)
        keep = (bounds >= best.weakest[members].min()) & (bounds > 0)
        found, bounds = found[keep], bounds[keep]
        if len(found) == 0:
            return None
        if level == 0:  # documents against several items: go on with their parents that are left
            for child in children:
                visit(child, 0, np.unique(found // DOC_FAN))
        elif children:
            for child in children:
                visit(child, level - 1, found)
        else:  # the most promising nodes raise the item's k-th score before the others are looked at
            first = np.argsort(-bounds, kind="stable")
            ahead = 1 + best.k // DOC_FAN
            visit(node, level - 1, np.sort(found[first[:ahead]]))
            rest = first[ahead:][bounds[first[ahead:]] >= best.weakest[members[0]]]
            if len(rest):
                visit(node, level - 1, np.sort(found[rest]))
        return None

    if items.root is not None:
        visit(items.root, len(docs.levels) - 1, np.zeros(1, np.int64))
    return scored


def _search_rows(items: list[tuple[np.ndarray, np.ndarray]], df: np.ndarray, corpus: Corpus, k: int, id_type: pa.DataType):
    def run(batches):
        tree, best, waiting, n_waiting = ItemTree(items, df), Best(len(items), k), [], 0

        def search():
            at = np.cumsum([0, *(len(w[0]) for w in waiting)])
            doc = np.concatenate([w[2] + a for w, a in zip(waiting, at)])
            length, term, tf = (np.concatenate([w[j] for w in waiting]) for j in (1, 3, 4))
            worth = corpus.worth(length[doc], term, tf)
            dual_search(tree, DocTree(int(at[-1]), doc, term, worth), pa.concat_arrays([w[0] for w in waiting]), best)

        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column(0)[r].values
                if ids is None or len(ids) == 0:
                    continue
                arrays = [np.frombuffer(batch.column(j)[r].as_py(), kind).astype(np.int64) for j, kind in ((1, "<i8"), (2, "<i4"), (3, "<i4"), (4, "<i4"))]
                waiting.append((ids, *arrays))
                n_waiting += len(ids)
                if n_waiting >= TREE_DOCS:
                    search()
                    waiting, n_waiting = [], 0
        if waiting:
            search()
        out = [(i, None if null else d, -s) for i, found in enumerate(best.found) for s, null, d in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], id_type), pa.array([o[2] for o in out], pa.int64())],
            names=["item", "doc_id", "score"],
        )

    return run


def _item_blocks(items: DataFrame, item_bytes: int) -> list[DataFrame]:
    """``items`` in blocks of at most ``item_bytes`` of text; a longer item is alone in its block."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(64)
    total = items.agg(F.sum(size)).first()[0] or 0
    n = math.ceil(total / item_bytes)
    while n > 1:
        block = F.pmod(F.xxhash64("row_id", F.lit(n)), F.lit(n))
        largest = items.groupBy(block).agg(F.sum(size).alias("size"), F.count("*").alias("rows")).filter(f"size > {item_bytes} and rows > 1").limit(1)
        if largest.count() == 0:
            return [items.filter(block == b) for b in range(n)]
        n *= 2
    return [items] if n else []


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, *, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest scores above 0 for each row of ``items`` (item_id, text).

    Equal scores rank by ascending doc_id, null ids last.  Null and empty texts have no terms:
    such documents are not counted and such items find nothing.  Every row of ``docs`` is a document and every row of
    ``items`` an item of its own, whatever their ids; repeated rows rank side by side.  Long texts are
    read whole.  Other columns are not read; an empty table on either side gives no rows.
    Items beyond ``item_bytes`` of text are searched in several passes over the documents, so the driver and the tasks hold one such block at a time.
    """
    spark, doc_id, item_id = docs.sparkSession, docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    id_type = to_arrow_type(doc_id)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    items = numbered(items.select("item_id", F.col("text").cast("string").alias("text")), "row_id")
    results = [_search_block(docs, block, k, id_type) for block in _item_blocks(items, item_bytes)]
    if not results:
        return spark.createDataFrame([], f"item_id {item_id.simpleString()}, rank int, doc_id {doc_id.simpleString()}, score long")
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out


def _search_block(docs: DataFrame, items: DataFrame, k: int, id_type: pa.DataType) -> DataFrame:
    asked = items.select("row_id", "text").orderBy("row_id").collect()  # bounded by item_bytes
    text = [(r["text"] or "").encode() for r in asked]
    terms, row = block_terms(np.frombuffer(b"".join(text), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in text]))).astype(np.int64))
    coded = terms.dictionary_encode()
    code, bounds = coded.indices.to_numpy().astype(np.int64), row_bounds(row, len(text))
    queries = [np.unique(code[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]
    vocabulary = coded.dictionary.to_pylist()

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    index = stored(
        docs.mapInArrow(
            _index_rows(vocabulary, id_type),
            f"n_docs long, n_terms long, doc_ids array<{doc_id}>, lengths binary, docs binary, terms binary, tfs binary, df_terms array<int>, dfs array<long>",
        ),
        "search-index", "zstd",
    )
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    held = index.select(F.explode(F.arrays_zip("df_terms", "dfs")).alias("t")).groupBy("t.df_terms").agg(F.sum("t.dfs").alias("df"))
    for term, n in held.collect():  # at most one row for each of the items' terms
        df[term] = n
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    found = index.select("doc_ids", "lengths", "docs", "terms", "tfs").mapInArrow(
        _search_rows(queries, df, Corpus(n_docs, n_terms, weights), k, id_type), f"item int, doc_id {doc_id}, score long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = items.sparkSession.createDataFrame([(i, r["row_id"]) for i, r in enumerate(asked)], "item int, row_id long")
    return ranked.join(F.broadcast(items.select("row_id", "item_id").join(F.broadcast(names), "row_id")), "item").select("item_id", "rank", "doc_id", "score")
