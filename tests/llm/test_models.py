from __future__ import annotations

import math
import hashlib
import html
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from streakline.llm import chat
from streakline.llm.chat import escape, events_of, format_chats, read_back, unescape
from streakline.llm.html_text import extract, features, labelled, labelled_pages, parse, trained
from streakline.llm.queries import CONTROL_TEXT, op2_chat
from streakline.llm.resampling import RAW_SHARE, block_features, importance_weights, kth_largest, labelled_sample, log_ratios, resample

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# quality classifier


@pytest.fixture(scope="module")
def weights(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fitted = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(10)) < 7)
    return importance_weights(docs, fitted), labels.join(fitted, "doc_id", "left_anti")


def test_held_out_labels(weights):
    table, held_out = weights
    rows = resample(table).join(held_out, "doc_id").collect()
    share = lambda keep: np.mean([r["kept"] for r in rows if keep(r)])
    assert share(lambda r: r["quality"] == 1 and not r["toxic"]) > 0.95
    assert share(lambda r: r["toxic"]) < 0.1
    assert share(lambda r: r["quality"] == 0) < 0.05


def test_held_out_labels_of_a_small_table(spark):
    """40 toxic and 30 poor labels to learn from."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fitted = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(10)) < 7)
    rows = resample(importance_weights(docs, fitted)).join(labels.join(fitted, "doc_id", "left_anti"), "doc_id").collect()
    share = lambda keep: np.mean([r["kept"] for r in rows if keep(r)])
    assert share(lambda r: r["quality"] == 1 and not r["toxic"]) > 0.95
    assert share(lambda r: r["toxic"]) < 0.5  # 15 rows; 0.22 over eight such splits
    assert share(lambda r: r["quality"] == 0) < 0.1


def test_weights_are_ratios_of_the_models(spark):
    """Every weight again, bucket by bucket, from sets of buckets and plain counts."""
    rng = np.random.default_rng(3)
    words = {0: "sun sea tree Hill road".split(), 1: "bad worse vile".split(), 2: "zz qq 11 ;;".split()}
    kinds = [0] * 40 + [1] * 12 + [2] * 12
    texts = [" ".join(rng.choice([*words[0], *words[k]], 12)) for k in kinds]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labelled = [k for k in range(64) if k % 3]
    labels = spark.createDataFrame([(k, int(kinds[k] != 2), int(kinds[k] == 1)) for k in labelled], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in importance_weights(docs, labels, buckets=1 << 12).collect()}
    sample = {r["doc_id"]: r["kind"] for r in labelled_sample(docs, labels)[0].collect()}

    raw_texts = [t.encode() for t in texts]
    row, bucket = block_features(np.frombuffer(b"".join(raw_texts), np.uint8), np.cumsum([0, *map(len, raw_texts)]), 1 << 12)
    sets = [sorted(bucket[row == k].tolist()) for k in range(64)]
    count = lambda keep: [sum(b in s for k, s in enumerate(sets) if keep(k)) for b in range(1 << 12)]
    raw, target = count(lambda k: True), count(lambda k: sample.get(k) == 0)
    others = [count(lambda k, kind=kind: sample.get(k) == kind) for kind in (1, 2)] + [[a - b for a, b in zip(raw, target)]]
    share = [sum(kinds[k] == kind for k in labelled) / len(labelled) * (1 - RAW_SHARE) for kind in (0, 1, 2)] + [RAW_SHARE]
    ratios = [log_ratios(np.array(raw, float), np.array(target, float), np.array(o, float)) for o in others]
    for k, s in enumerate(sets):
        mixture = share[0] + sum(p * math.exp(sum(r[b] for b in s)) for p, r in zip(share[1:], ratios))
        assert got[k]["log_weight"] == pytest.approx(-math.log(mixture), rel=1e-9, abs=1e-9)
        assert got[k]["p_target"] == pytest.approx(min(1, share[0] / mixture), rel=1e-9)


def test_unlabelled_kinds_lose_weight(spark):
    """No label says so, but the corpus has words that the target does not."""
    rng = np.random.default_rng(5)
    text = lambda words: " ".join(rng.choice(words, 30))
    usual, strange = "sun sea tree hill road wind rain".split(), "krk grz plk vrt".split()
    rows = [(k, text(usual)) for k in range(400)] + [(k, text(usual[:2] + strange)) for k in range(400, 480)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    weights = {r["doc_id"]: r["log_weight"] for r in importance_weights(docs, labels, buckets=1 << 12).collect()}
    assert min(weights[k] for k in range(400)) > max(weights[k] for k in range(400, 480))


def test_top_k(weights):
    table, _ = weights
    keys = sorted((r["sample_key"] for r in table.select("sample_key").collect()), reverse=True)
    for k in (1, 17, len(keys) // 2, len(keys)):
        assert kth_largest(table, "sample_key", k) == keys[k - 1]
    assert resample(table, 0.25).filter("kept").count() == round(len(keys) * 0.25)


def test_kth_largest_with_ties(spark):
    df = spark.range(20_000).select((F.col("id") % 3).cast("double").alias("x"))
    assert [kth_largest(df, "x", k) for k in (1, 6666, 6667, 20_000)] == [2.0, 2.0, 1.0, 0.0]


def test_resampling_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "good text"), (3, "good text"), (None, "more"), (4, "z" * 100_000)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, kind string, row_id string")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (4, None, None), (9, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.filter("false")):
        got = resample(importance_weights(docs, some)).collect()
        assert len(got) == 6 and all(r["log_weight"] is not None and r["kept"] is not None for r in got)
    assert all(r["kept"] for r in got)  # without labels every weight is 1
    assert resample(importance_weights(docs.filter("false"), labels)).collect() == []


def test_ratios_need_significance():
    raw = np.array([1000.0, 1000, 10, 0])
    same = log_ratios(raw, np.array([400.0, 400, 4, 0]), np.array([100.0, 100, 1, 0]))
    assert not same.any()
    apart = log_ratios(raw, np.array([400.0, 1, 4, 0]), np.array([1.0, 100, 1, 0]))
    assert apart[0] < 0 < apart[1] and apart[3] == 0


def test_features_are_distinct_per_row():
    raw = "idiot, Idiot idiot".encode()
    row, bucket = block_features(np.frombuffer(raw + raw, np.uint8), np.array([0, len(raw), 2 * len(raw), 2 * len(raw)]), 1 << 16)
    first, second = bucket[row == 0].tolist(), bucket[row == 1].tolist()
    assert first == second and len(set(first)) == len(first) and not (row == 2).any()


# chat formatting


def wanted(conversations):
    out = {}
    for c, turns in conversations.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def result(rows):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_query_formats_all_conversations(spark):
    turns = defaultdict(list)
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-1] = [("user", CONTROL_TEXT), ("assistant", CONTROL_TEXT)]
    assert result(op2_chat(spark, SF).collect()) == wanted(turns)


@pytest.mark.parametrize("part_chars", [chat.PART_CHARS, 20])
def test_events_fold(spark, monkeypatch, part_chars):
    monkeypatch.setattr(chat, "PART_CHARS", part_chars)
    rng = random.Random(4)
    parts = ["<s>[INST]", "[/INST]", "</s>\n", "<", "\\", "[", "a", "é", "<\\", "x" * 40]
    events, final = [], {}
    for c in [*range(40), None]:
        messages = []
        for seq in range(1, rng.randint(2, 26)):
            text, kind = "".join(rng.choice(parts) for _ in range(rng.randint(0, 4))), rng.random()
            if kind < 0.3 or not messages:
                messages.append([100 + seq, rng.choice(["user", "assistant", "sys[<"]), ""])
                events.append((c, messages[-1][0], seq, "start", messages[-1][1], None))
            elif kind < 0.75:
                messages[-1][2] += text
                events.append((c, messages[-1][0], seq, "delta", None, text))
            elif kind < 0.87:
                message = rng.choice(messages)
                message[2] = text
                events.append((c, message[0], seq, "edit", None, text))
            else:
                i = rng.randrange(len(messages))
                messages[i][2] = text
                del messages[i + 1 :]
                events.append((c, messages[i][0], seq, "regenerate", None, text or None))
        final[c] = [(m[1], m[2]) for m in messages]
    rng.shuffle(events)
    df = spark.createDataFrame([(*e, "x") for e in events], "conv_id long, message long, seq long, kind string, role string, text string, place string")
    assert result(read_back(format_chats(df)).collect()) == wanted(final)


def test_chat_odd_rows(spark):
    long = "<s>" + "ab[" * 50_000
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, 0, "assistant", "n"), (2, None, "assistant", long), (2, 5, "user", "")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn int, role string, text string, message string")
    got = result(read_back(format_chats(events_of(df))).collect())
    assert got == wanted({1: [("user", ""), ("", "x"), ("", "x")], None: [("assistant", "n")], 2: [("assistant", long), ("user", "")]})
    assert read_back(format_chats(events_of(df.filter("false")))).collect() == []


def test_message_without_start(spark):
    rows = [(1, 7, 1, "delta", None, "a"), (1, 7, 2, "edit", None, "b"), (1, 7, 3, "delta", None, "c")]
    df = spark.createDataFrame(rows, "conv_id long, message long, seq long, kind string, role string, text string")
    assert result(read_back(format_chats(df)).collect()) == wanted({1: [("", "bc")]})


def test_escape_is_reversible():
    rng = random.Random(0)
    for _ in range(300):
        text = "".join(rng.choice(["<", "\\", "[", "</s>", "[INST]", "a", "<\\", "\n"]) for _ in range(rng.randint(0, 12)))
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]"))


# HTML extraction


@pytest.fixture(scope="module")
def model():
    return trained()


def test_held_out_pages(model):
    right = total = 0
    for page, blocks in labelled_pages(200, seed=99):
        nodes, states = labelled(page, blocks)
        odds, _, _ = model.messages(nodes)
        for node, s, y in zip(nodes, odds, states):
            if node.text is not None:
                total += 1
                right += (s > 0) == bool(y)
    assert right / total > 0.98


def test_messages_equal_enumeration(model):
    """Marginals of a small tree against the sum over all states."""
    nodes = parse("<div class=ad><p>One two three.</p><p><a href=x>four</a></p></div><article><p>Five six.</p></article>")
    features(nodes)
    n = len(nodes)
    unary = [sum(model.weight.get(f, 0.0) for f in node.features) for node in nodes]
    mass = np.zeros(n)
    total = 0.0
    for states in range(1 << n):
        bit = lambda k: states >> k & 1  # noqa: E731,B023
        score = sum(unary[k] for k in range(n) if bit(k))
        score += sum(model.edge["c" if nodes[k].text is None else "t"][2 * bit(nodes[k].parent) + bit(k)] for k in range(1, n))
        total += np.exp(score)
        mass += np.array([bit(k) for k in range(n)]) * np.exp(score)
    odds, _, _ = model.messages(nodes)
    assert np.allclose(1 / (1 + np.exp(-np.array(odds))), mass / total)


TEXT = "Than in ofblethti the and thwhst onhaha the inly. Thatble eroure ndin erontihe anheblewh."


@pytest.mark.parametrize("part", [
    "<aside>BAD {}</aside>", "<div class='cookie-notice'>BAD {}</div>", "<section id=comments><h2>BAD</h2><div class=comment><p>BAD {}</p></div></section>",
    "<header><h1>BAD site</h1></header>", "<div id=sidebar><p>BAD {}</p></div>", "<form action=x><label>BAD name <input></label></form>",
    "<div class=ad>BAD {}</div>", "<nav><ul><li><a href=x>BAD</a></li><li><a href=y>BAD</a></li></ul></nav>", "<footer>&copy; BAD {}</footer>",
    "<script>var BAD='</p>'</script><style>p{{BAD}}</style><!-- BAD -->",
])
def test_parts_outside_the_article(model, part):
    part = part.format(TEXT)
    got = model.main_text(f"<html><body>{part}<article><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p></article></body></html>")
    assert got == f"Head\n\n{TEXT}\n\n{TEXT}"


def test_blocks_and_references(model):
    page = "<article><h1> A &amp;\n B&eacute; </h1><p>one<br>two <b>three<p>four &lt;x&gt; &#39;q&#39;<ul><li>five<li>six</ul><p>cut &copy"
    assert model.main_text(page) == "A & Bé\n\none two three\n\nfour <x> 'q'\n\nfive\n\nsix\n\ncut ©"


def test_extract_rows(spark, model):
    rows = [(1, "u", None, 5), (2, None, "", 5), (None, "u", "<p", 5), (3, "u", "<article><p>Some words here.</p></article>", 5), (3, "u", "<article><p>Some words here.</p></article>", 5),
            (4, "u", "<article>" + "<p>Some words here again.</p>" * 5000 + "</article>", 5), (5, "u", "<div>" * 3000 + "deep", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract(pages, model).collect()
    assert len(got) == 7 and all(r["n_chars"] == len(r["text"]) for r in got)
    of = {r["page_id"]: r["text"] for r in got}
    assert of[1] == of[2] == of[None] == "" and of[3] == "Some words here." and of[4].count("again") == 5000
    assert extract(pages.filter("false"), model).collect() == []


def test_articles_of_the_table(spark, model):
    """The table's pages have one article each, of h1 and p, cut off now and then."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in pages.join(extract(pages, model).select("page_id", "text"), "page_id").collect():
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r["html"], re.S)[1]
        blocks = [html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))) for b in re.split("</?p>|</?h1>", article)]
        blocks = [re.sub(r"[\x20\x09-\x0D]+", " ", b).strip(" ") for b in blocks]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


HEADS = ["<head><title>t</title>", "<head><meta charset=utf-8><style>p {}</style><script>x</script>", "<head><head><title>t</title>\n", "<head><template><p>no</p></template>"]


@pytest.mark.parametrize("head", HEADS)
@pytest.mark.parametrize("body", ["<body>", "", "</head><body>", "\n <body class=x>"])
@pytest.mark.parametrize("article", ["<p>One.</p><p>Two.</p>", "One.<p>Two.", "<hr>One.<div>Two.</div>", "<b>One.</b><p>Two."])
def test_head_without_end_tag(head, body, article):
    page = f"<!doctype html><html>{head}{body}{article}"
    assert [n.text for n in parse(page) if n.text is not None] == ["One.", "Two."]
