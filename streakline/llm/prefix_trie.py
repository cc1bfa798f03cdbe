"""Prefix trie of conversations by fixed-length block hashing.

A conversation's turns are cut into blocks of BLOCK turns.  Each block has a digest, and chained digests name
everything before it, so conversations meet first by whole blocks: those with the
same beginning and the same next block are one *variant*, with a number of members and a smallest one.
Where a beginning has a single variant, all its members share the block's
turns and the nodes inside follow from it.  Only where sibling variants diverge
are turn boundaries refined: their inner prefixes are grouped, with the
variants' sums, never with single conversations.

Figures of whole subtrees are sums over members.  A leaf counts for its smallest
member, and a node's savings count for the node's smallest member, so a
second pass over the variants adds them up whatever the depth.  A
conversation of any length is chained in segments, and segments of segments; no group that a task collects is larger than a fixed bound.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.llm.tables import stored
from streakline.operators import ordinal

#: Turns per block; items chained in one group (a multiple of BLOCK for turns).
BLOCK = 4
SEGMENT = 256
#: Places whose savings are added up in one window.
SPAN = 1024
#: Ids (2 ** bits) in one piece of a list of conversations.
PIECE_BITS = 8


def _root() -> Column:
    """The name of the empty beginning."""
    return F.unhex(F.lit("00" * 32))


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1, by turn, null first; equal turns by role and text), digest and chars (code points of the text) of each turn.

    Null role or text is empty.  Rows without a conv_id belong to no conversation and are left out.
    """
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # the role's length keeps "ab", "c" apart from "a", "bc"
    content = _digest(F.octet_length("role").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("role").cast("binary"), F.col("text").cast("binary"))
    placed = ordinal(rows, ("turn", "role", "text"), ("conv_id",), col="place")
    return placed.select("conv_id", F.col("place").cast("bigint").alias("place"), content.alias("digest"), F.char_length("text").cast("bigint").alias("chars"))


def with_shared_starts(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns and all conversations: conversation c starts with the first h turns of c - c % every, then has its own after its first h.

    h is crc32 of c in decimal, modulo ``most``.  A conversation without any turn left is still one.
    """
    turns = stored(turns, "turns")
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    plan = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    start = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = stored(plan.join(start, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "starts")
    heads = turns.filter(F.col("place") < most).select(F.col("conv_id").alias("base"), "place", "digest", "chars")
    taken = plan.join(heads, "base").filter("place <= taken").select("conv_id", "place", "digest", "chars")
    own = turns.join(plan, "conv_id").filter("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "chars")
    return taken.union(own), plan.select("conv_id")


def _chained(items: Column) -> Column:
    """Digests of the first 0, 1, ... all of ``items``, each from the one before."""
    link = lambda seen, item: F.concat(seen, F.array(_digest(F.element_at(seen, -1), item)))
    return F.aggregate(items, F.array(_root()), link)


def _names(segments: DataFrame) -> DataFrame:
    """conv_id, seg, before, after: names of all that stands before, and up to the end of, each segment (conv_id, seg, total)."""
    runs = segments.groupBy("conv_id", F.expr(f"seg div {SEGMENT}").alias("over")).agg(F.array_sort(F.collect_list(F.struct("seg", "total"))).alias("items"))
    runs = runs.withColumn("chain", _chained(F.transform("items", lambda i: i["total"])))
    if runs.agg(F.max("over")).first()[0]:
        runs = stored(runs, "segment-chains")
        above = _names(runs.select("conv_id", F.col("over").alias("seg"), F.element_at("chain", -1).alias("total")))
        runs, full = runs.join(above.withColumnsRenamed({"seg": "over"}), ["conv_id", "over"]), SEGMENT
    else:  # the only one of its conversation: nothing stands before it, and no longer segment names its end
        runs, full = runs.withColumns({"before": _root(), "after": _root()}), -1
    name = lambda i: _named(F.col("chain"), i, F.lit(full), F.col("before"), F.col("after"))
    one = F.posexplode(F.col("items")).alias("i", "item")
    return runs.select("conv_id", "chain", "before", "after", one).select(
        "conv_id", F.col("item.seg").alias("seg"), name(F.col("i")).alias("before"), name(F.col("i") + 1).alias("after"))


def _named(chain: Column, i: Column, full: Column, before: Column, after: Column) -> Column:
    """The name of the first ``i`` links of a segment together with all that stands before it; a full segment ends in ``after``."""
    return F.when(i == 0, before).when(i == full, after).otherwise(_digest(before, F.element_at(chain, (i + 1).cast("int"))))


def _blocks(turns: DataFrame) -> DataFrame:
    """conv_id, b, turns (at most BLOCK), digest, before and after: each block with the names of all before it and up to its end."""
    segments = turns.groupBy("conv_id", F.expr(f"(place - 1) div {SEGMENT}").alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("t"))
    cut = F.transform(F.sequence(F.lit(0), F.expr(f"(size(t) - 1) div {BLOCK}")), lambda j: F.slice("t", j * BLOCK + 1, F.lit(BLOCK)))
    joined = lambda block: F.aggregate(block, F.lit(b""), lambda all_, turn: F.concat(all_, turn["digest"]))
    segments = segments.withColumn("blocks", F.transform(cut, lambda block: F.struct(block.alias("turns"), _digest(joined(block)).alias("digest")))).drop("t")
    segments = stored(segments.withColumn("chain", _chained(F.transform("blocks", lambda block: block["digest"]))), "block-chains", "zstd")
    names = _names(segments.select("conv_id", "seg", F.element_at("chain", -1).alias("total")))
    name = lambda j: _named(F.col("chain"), j, F.lit(SEGMENT // BLOCK), F.col("before"), F.col("after"))
    one = F.posexplode("blocks").alias("j", "block")
    return segments.join(names, ["conv_id", "seg"]).select("conv_id", "seg", "chain", "before", "after", one).select(
        "conv_id", (F.col("seg") * (SEGMENT // BLOCK) + F.col("j")).alias("b"), "block.turns", "block.digest",
        name(F.col("j")).alias("before"), name(F.col("j") + 1).alias("after"))


def _key(i: Column) -> Column:
    """The name of a block's first ``i`` turns together with all that stands before the block."""
    inner = F.aggregate(F.slice("turns", F.lit(1), i), F.col("before"), lambda all_, turn: F.concat(all_, turn["digest"]))
    return F.when(i == 0, F.col("before")).when(i == BLOCK, F.col("after")).otherwise(_digest(inner))


def _variants(blocks: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """One row per beginning and next block, with ``sums`` over the conversations that have both."""
    return blocks.groupBy("b", "before", "digest", "turns", "after").agg(*[c.alias(k) for k, c in sums.items()])


def _nodes(variants: DataFrame, lone: DataFrame, merge: dict[str, Column]) -> DataFrame:
    """One row per node inside the blocks: key, parent_key, depth, chars and the variants' sums.

    ``lone`` names the beginnings with a single variant; inside it every prefix is a node.  Elsewhere equal prefixes of the siblings are merged.
    """
    one = F.posexplode("turns").alias("i", "turn")
    inside = variants.join(lone.select("before", F.lit(1).alias("lone")), "before", "left").select("lone", "before", "turns", "after", *merge, one)
    inside = inside.select(
        "lone", _key(F.col("i") + 1).alias("key"), _key(F.col("i")).alias("parent_key"), F.col("turn.place").alias("depth"), F.col("turn.chars").alias("chars"), *merge)
    same = ["key", "parent_key", "depth", "chars"]
    refined = inside.filter("lone is null").groupBy(*same).agg(*[c.alias(k) for k, c in merge.items()])
    return inside.filter("lone is not null").select(*same, *merge).union(refined)


def _list_digests(ends: DataFrame) -> DataFrame:
    """key and the SHA-256 of its conv_ids (ascending, in decimal, comma-joined); a key's pieces are streamed in order, never held."""
    pieces = ends.groupBy("key", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("key", "piece", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))

    def run(batches):
        key = found = None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if found is not None:
                        out.append((key, found.hexdigest()))
                    key, found = k, hashlib.sha256(ids.encode())
                else:
                    found.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], names=["key", "ends_sha256"])
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([found.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    return pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of ``members`` (conv_id, each once) by their ``turns`` (conv_id, place from 1 without gaps, digest, chars).

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  Members without turns belong to the root alone; without members there are no nodes.
    Turns are equal when their digests (SHA-256 of role and text) are.
    """
    blocks = stored(_blocks(turns), "blocks", "zstd")
    variants = stored(_variants(blocks, {"n": F.count("*"), "conv_id": F.min("conv_id")}), "variants", "zstd")
    lone = stored(variants.groupBy("before").agg(F.count("*").alias("variants")).filter("variants = 1").select("before"), "lone")
    nodes = _nodes(variants, lone, {"n": F.sum("n"), "conv_id": F.min("conv_id")})
    nodes = nodes.select("key", "parent_key", "depth", "chars", F.col("n").cast("bigint").alias("n"), "conv_id")
    root = members.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).filter("n > 0").select(
        _root().alias("key"), F.lit(None).cast("binary").alias("parent_key"), F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("chars"), "n", "conv_id")
    nodes = stored(nodes.union(root), "nodes", "zstd")
    children = nodes.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("saves", (F.col("n") - 1) * F.col("chars")).withColumn("span", F.expr(f"depth div {SPAN}"))
    # what a node's smallest member saves above the node is not in the node's subtree
    along = Window.partitionBy("conv_id", "span").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    nodes = stored(nodes.withColumn("above", F.coalesce(F.sum("saves").over(along), F.lit(0))), "node-sums", "zstd")
    spans = nodes.groupBy("conv_id", "span").agg(F.sum("saves").alias("saves"))
    spans = spans.select("conv_id", "span", F.sum("saves").over(Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)).alias("higher"))

    # a node's own savings and leaves, put down to its smallest member and added up over every beginning of that member
    worth = stored(nodes.groupBy("conv_id").agg(F.sum("saves").alias("saves"), F.count_if(F.col("n_children") == 0).alias("leaves")), "worth")
    sums = {"saves": F.sum("saves"), "leaves": F.sum("leaves")}
    below = _nodes(_variants(blocks.join(worth, "conv_id"), sums), lone, sums).select("key", "saves", "leaves")
    all_ = worth.agg(*[c.alias(k) for k, c in sums.items()]).select(_root().alias("key"), "saves", "leaves")
    below = below.union(all_).withColumnsRenamed({"saves": "sum_saves", "leaves": "n_leaves"})

    last = turns.groupBy("conv_id").agg(F.max("place").alias("size"))
    ended = F.when(F.col("size").isNull(), _root()).otherwise(_key(F.size("turns")))
    final = blocks.select("conv_id", "turns", "before", "after", F.expr(f"b * {BLOCK} + size(turns)").alias("size"))
    ends = members.join(last, "conv_id", "left").join(final, ["conv_id", "size"], "left").select("conv_id", ended.alias("key"))

    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(below, "key").join(_list_digests(ends), "key", "left").join(parents, "parent_key", "left").join(spans, ["conv_id", "span"])
    return out.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("n_leaves").cast("bigint").alias("n_leaves"),
        (F.col("sum_saves") - F.col("above") - F.coalesce("higher", F.lit(0))).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
