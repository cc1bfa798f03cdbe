"""Registered queries of the operators in this subpackage, each over its whole table, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.llm.backoff_lm import backoff_scores
from streakline.llm.chat import events_of, format_chats, read_back
from streakline.llm.decontaminate import build_index, contamination
from streakline.llm.exact_dedup import exact_groups
from streakline.llm.html_text import extract
from streakline.llm.packing import pack_documents
from streakline.llm.prefix_trie import ordered_turns, prefix_trie, with_shared_starts
from streakline.llm.ranked_search import ranked_search
from streakline.llm.resampling import importance_weights, resample
from streakline.llm.simhash import simhash_components
from streakline.llm.suffix_dedup import remove_repeats
from streakline.llm.tables import short_batches, stored
from streakline.llm.token_counts import prefix_table, token_count
from streakline.llm.warc import archive


TOKEN_LIMIT = 2048


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``run`` under short Arrow batches, its result stored, so that the session is as before when the result is read."""

    @wraps(run)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        with short_batches(spark):
            return stored(run(spark, sf_dir), run.__name__, "zstd")

    return query


@_query
def op1_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(importance_weights(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))).drop("row_id")


#: Says what the template's control strings say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@_query
def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], rows.columns)
    rows = rows.union(more.select(*(F.col(c).cast(rows.schema[c].dataType) for c in rows.columns)))
    return read_back(format_chats(events_of(rows)))


@_query
def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_read(spark, sf_dir, "pages"))


@_query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_read(spark, sf_dir, "documents")).drop("row_id")


@_query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_read(spark, sf_dir, "documents")).drop("row_id")


@_query
def op6_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(_read(spark, sf_dir, "documents"))


@_query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(_read(spark, sf_dir, "documents"))
    return contamination(index, _read(spark, sf_dir, "benchmark")).drop("row")


#: Bytes of about fifty words: repeats of this length are counted beside those that are removed.
PASSAGE_BYTES = 300


@_query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_read(spark, sf_dir, "documents"), also=(PASSAGE_BYTES,))
    length = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, run: n + run["end"] - run["start"])
    return kept.select(
        "doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.col(f"n_repeated_{PASSAGE_BYTES}").alias("n_repeated"),
    )


@_query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@_query
def op11_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stored(prefix_table(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")), "prefix-counts", "zstd")
    return table.select("doc_id", "n_bytes", token_count().alias("n_tokens"), (token_count() > TOKEN_LIMIT).alias("over_limit"))


@_query
def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = with_shared_starts(ordered_turns(_read(spark, sf_dir, "conversations")))
    return prefix_trie(stored(turns, "rebuilt"), members)


QUERIES = {
    "op1_resampling": op1_resampling,
    "op2_chat": op2_chat,
    "op3_html": op3_html,
    "op4_simhash": op4_simhash,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_backoff_lm": op6_backoff_lm,
    "op7_decontaminate": op7_decontaminate,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
    "op11_prefix_tokens": op11_prefix_tokens,
    "op12_dual_tree_search": op12_dual_tree_search,
    "op13_prefix_trie": op13_prefix_trie,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE_SQL = {
    # a turn is <s>[INST]role[/INST]text</s> and a line feed: 21 characters, and one more for each < and [ in role and text
    "op2_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
               CAST(sum(21 + 2 * length(r || t) - length(replace(replace(r || t, '<', ''), '[', ''))) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id
    """,
    "op5_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM plain WINDOW same AS (PARTITION BY t)
    """,
    "op7_decontaminate": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
        item_windows AS (
            SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT item, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0))
        ),
        doc_windows AS (
            SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
        ),
        hits AS (SELECT doc_id, i, n, item FROM doc_windows JOIN item_windows USING (g, n)),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN named ON named.doc_id = d.doc_id
    """,
    # base32 of a SHA-1: five hexadecimal digits are four letters
    "op10_warc": r"""
        WITH p AS (
            SELECT page_id, url, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest FROM pages
        )
        SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((CAST('0x' || substr(sha1(h), CAST(k // 4 AS INTEGER) * 5 + 1, 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) + 1, 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to, url
        FROM p
    """,
    "op12_dual_tree_search": rf"""
        WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
        n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
        q AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        w AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, total WHERE term IN (SELECT term FROM q) GROUP BY term
        ),
        worth AS (
            SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))) AS worth
            FROM tf JOIN w USING (term) JOIN n USING (doc_id), total
        ),
        scores AS (SELECT item_id, doc_id, CAST(sum(repeats * worth) AS BIGINT) AS score FROM q JOIN worth USING (term) GROUP BY ALL),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT * FROM ranked WHERE rank <= 10
    """,
    # a node is a list of (role, text); crc32 of the decimal conv_id, bit by bit
    "op13_prefix_trie": r"""
        WITH own AS (
            SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns,
                   xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
                       lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        built AS (
            SELECT own.c, list_concat(coalesce(base.turns, [])[:own.h], own.turns[own.h + 1:]) AS turns
            FROM own LEFT JOIN own AS base ON base.c = own.c - own.c % 100
        ),
        starts AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS depth FROM built),
        nodes AS (
            SELECT depth, turns[:depth] AS path, min(c) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(turns) = depth), '')) AS ends_sha256
            FROM starts GROUP BY ALL
        ),
        children AS (SELECT depth - 1 AS depth, path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        known AS (
            SELECT nodes.*, coalesce(n_children, 0) AS n_children, parent.conv_id AS parent_conv_id,
                   CASE WHEN nodes.depth > 0 THEN (nodes.n_convs - 1) * length(nodes.path[nodes.depth].t) ELSE 0 END AS saves
            FROM nodes LEFT JOIN children USING (depth, path)
            LEFT JOIN (SELECT depth + 1 AS depth, path AS above, conv_id FROM nodes) AS parent ON parent.depth = nodes.depth AND parent.above = nodes.path[:nodes.depth - 1]
        ),
        below AS (
            SELECT up AS depth, path[:up] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saves) AS BIGINT) AS saved_tokens
            FROM (SELECT path, n_children, saves, unnest(range(0, depth + 1)) AS up FROM known) GROUP BY ALL
        )
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        FROM known JOIN below USING (depth, path)
    """,
}
