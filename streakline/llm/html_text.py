"""Main text of web pages by a tree-structured graphical model over the DOM.

A page becomes a tree of containers and text blocks.  Every node is content or
not; unary potentials come from features of the node (its tag, names, link
density, length), pairwise potentials connect parent and child.  Sum-product
messages pass upward and downward once, which is exact on a tree, and give each
block's marginal.  Potentials are trained by maximum likelihood on labelled
pages, with the same messages supplying the expected counts.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Text up to the end tag, markup or not.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Never page text.
SKIPPED = RAW | frozenset("template svg math object audio video canvas select button option head datalist".split())
#: Start tags that an open head may hold; any other one ends it, as text does.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
BLOCK = frozenset(
    "html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table caption thead tbody tfoot tr td th ul hr".split()
)
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("html body caption thead tbody tfoot tr td th legend".split())
#: Start tags that end an open element of the listed kinds, up to a boundary element.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
}
TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""", re.S
)
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
WHITE = re.compile(r"[\x20\x09-\x0D]+")


class Node:
    __slots__ = ("tag", "names", "parent", "text", "linked", "blocks", "children", "features")

    def __init__(self, tag: str, names: tuple[str, ...], parent: int):
        self.tag, self.names, self.parent = tag, names, parent
        self.text: str | None = None  # of a text block
        self.linked = 0
        self.blocks = 0
        self.children = 0


def _name_parts(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes and "hidden" not in attributes:
        return ()
    out = []
    for key, value in NAMES.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "style":
            out += ["hidden"] if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) else []
        elif key.endswith("hidden"):
            out += ["hidden"] if value.lower() != "false" else []
        else:
            out += [p.lower() for p in NAME_PART.findall(value)]
    return tuple(dict.fromkeys(out))


def parse(page: str) -> list[Node]:
    """Containers and text blocks of a page in order, each after its parent; node 0 is the root.

    A container that holds nothing but one run of text is that text's block.
    Comments, scripts, styles and controls are no text.  Unclosed, stray and
    cut-off tags are taken as browsers do, without the rarer repairs.
    """
    nodes = [Node("root", (), -1)]
    stack: list[tuple[str, int]] = [("root", 0)]  # open elements and their container node
    run: list[str] = []
    linked = 0
    links = 0
    skip_from = 0  # stack height at which skipped text began

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = WHITE.sub(" ", "".join(run)).strip(" ")
            if text:
                holder = stack[-1][1]
                node = Node("text", (), holder)
                node.text, node.linked = text, linked
                nodes[holder].children += 1
                nodes.append(node)
            run = []
        linked = 0

    def pop_to(height: int) -> None:
        nonlocal links, skip_from
        while len(stack) > height:
            tag, _ = stack[-1]
            if tag in BLOCK:
                flush()
            if tag == "a":
                links -= 1
            stack.pop()
        if skip_from >= len(stack):
            skip_from = 0

    def end_head() -> None:
        while stack[-1][0] == "head":
            pop_to(len(stack) - 1)

    def text(part: str) -> None:
        nonlocal linked
        if stack[-1][0] == "head" and WHITE.sub("", part):
            end_head()
        if part and not skip_from:
            part = html.unescape(part) if "&" in part else part
            run.append(part)
            if links:
                linked += len(part.strip())

    at = 0
    while True:
        match = TOKEN.search(page, at)
        if match is None:
            text(page[at:])
            break
        if match.start() > at:
            text(page[at : match.start()])
        at = match.end()
        closing, tag, attributes = match.groups()
        if tag is None:
            continue
        if not attributes.endswith(">"):
            break  # the page ends within a tag
        tag = tag.lower()
        if closing:
            if tag in ("html", "body", "br"):
                end_head()
                continue
            for height in range(len(stack) - 1, 0, -1):
                if stack[height][0] == tag:
                    pop_to(height)
                    break
                if tag not in BLOCK and stack[height][0] in BLOCK:
                    break  # a stray inline end tag closes no block
            continue
        if tag not in IN_HEAD:
            end_head()
        if tag in VOID:
            if tag == "br":
                text(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in ("html", "body"):
            continue
        if tag in ENDS_P:
            for height in range(len(stack) - 1, 0, -1):
                if stack[height][0] == "p":
                    pop_to(height)
                    break
                if stack[height][0] in ("td", "th", "table", "button", "caption", "object"):
                    break
        if tag in ENDS:
            kinds, edges = ENDS[tag]
            closed = None
            for height in range(len(stack) - 1, 0, -1):
                if stack[height][0] in edges:
                    break
                if stack[height][0] in kinds:
                    closed = height
            if closed:
                pop_to(closed)
        if tag in BLOCK:
            flush()
            node = Node(tag, _name_parts(attributes), stack[-1][1])
            nodes[stack[-1][1]].children += 1
            nodes.append(node)
            stack.append((tag, len(nodes) - 1))
        else:
            stack.append((tag, stack[-1][1]))
            if tag == "a":
                links += 1
        if tag in SKIPPED and not skip_from:
            skip_from = len(stack) - 1
        if attributes.endswith("/>") and tag in ("svg", "math"):
            pop_to(len(stack) - 1)
    pop_to(1)
    flush()
    return _collapsed(nodes)


def _collapsed(nodes: list[Node]) -> list[Node]:
    """Without empty containers, and with a container of a single text block merged into it."""
    keep = [n.text is not None for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        if keep[k]:
            keep[nodes[k].parent] = True
    place: dict[int, int] = {}
    out: list[Node] = []
    for k, node in enumerate(nodes):
        if k and not keep[k]:
            continue
        node.parent = place.get(node.parent, -1)
        above = out[node.parent] if node.parent > 0 else None
        if node.text is not None and above is not None and above.children == 1 and above.text is None and node.parent == len(out) - 1:
            above.text, above.linked = node.text, node.linked
            place[k] = node.parent
            continue
        place[k] = len(out)
        out.append(node)
    for node in reversed(out):
        if node.text is not None:
            node.blocks += 1
        if node.parent >= 0:
            up = out[node.parent]
            up.blocks += node.blocks
    return out


def _bucket(n: int) -> int:
    return min(n.bit_length(), 10)


def features(nodes: list[Node]) -> None:
    size = [len(n.text) if n.text is not None else 0 for n in nodes]
    linked = [n.linked for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        size[nodes[k].parent] += size[k]
        linked[nodes[k].parent] += linked[k]
    for k, node in enumerate(nodes):
        share = min(4, 4 * linked[k] // max(size[k], 1))
        kind = "t" if node.text is not None else "c"
        out = [f"{kind}:{node.tag}", f"{kind}l:{share}", f"{kind}s:{_bucket(size[k])}", kind]
        out += [f"n:{p}" for p in node.names]
        if node.parent >= 0:
            out.append(f"{nodes[node.parent].tag}>{node.tag}")
        if node.text is not None:
            ends = node.text[-1] in ".!?…\"”»:"
            out.append(f"e:{ends}:{min(_bucket(size[k]), 7)}")
            if "©" in node.text or "\xae" in node.text:
                out.append("copyright")
        else:
            out.append(f"b:{min(node.blocks, 4)}")
        node.features = out


def _logaddexp(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


class Model:
    """Potentials: weight of each feature for content, and four log potentials per edge kind (parent state, child state)."""

    def __init__(self):
        self.weight: dict[str, float] = {}
        # states (parent, child) 00, 01, 10, 11; a block's and a container's edge
        self.edge = {"t": [0.0, 0.0, 0.0, 0.0], "c": [0.0, 0.0, 0.0, 0.0]}

    def messages(self, nodes: list[Node]) -> tuple[list[float], list[float], list[float]]:
        """(log odds of each node, upward odds of each node, odds of its parent without it)."""
        weight = self.weight.get
        up = [sum([weight(f, 0.0) for f in n.features]) for n in nodes]
        sent = [0.0] * len(nodes)
        for k in range(len(nodes) - 1, 0, -1):  # upward
            e = self.edge["c" if nodes[k].text is None else "t"]
            s = up[k]
            sent[k] = _logaddexp(e[2], e[3] + s) - _logaddexp(e[0], e[1] + s)
            up[nodes[k].parent] += sent[k]
        total, above = up[:], [0.0] * len(nodes)
        for k in range(1, len(nodes)):  # downward
            e = self.edge["c" if nodes[k].text is None else "t"]
            above[k] = t = total[nodes[k].parent] - sent[k]
            total[k] = up[k] + _logaddexp(e[1], e[3] + t) - _logaddexp(e[0], e[2] + t)
        return total, up, above

    def fit(self, pages: list[tuple[list[Node], list[int]]], rounds: int = 40, rate: float = 0.5, decay: float = 1e-4) -> Model:
        """Maximum likelihood by adaptive gradient steps; ``pages`` are trees with the state of each node."""
        square: dict[object, float] = {}
        for _ in range(rounds):
            for nodes, states in pages:
                total, up, above = self.messages(nodes)
                step: dict[object, float] = {}
                for k, (node, y) in enumerate(zip(nodes, states)):
                    p = 1 / (1 + math.exp(-max(-30.0, min(30.0, total[k]))))
                    for f in node.features:
                        step[f] = step.get(f, 0.0) + y - p
                    if k:
                        kind = "c" if node.text is None else "t"
                        e = self.edge[kind]
                        logs = (e[0], e[1] + up[k], e[2] + above[k], e[3] + up[k] + above[k])
                        top = max(logs)
                        mass = [math.exp(x - top) for x in logs]
                        seen = 2 * states[node.parent] + y
                        for j in range(4):
                            step[kind, j] = step.get((kind, j), 0.0) + (j == seen) - mass[j] / sum(mass)
                for f, g in step.items():
                    old = self.edge[f[0]][f[1]] if isinstance(f, tuple) else self.weight.get(f, 0.0)
                    g -= decay * old
                    square[f] = square.get(f, 1e-8) + g * g
                    new = old + rate * g / math.sqrt(square[f])
                    if isinstance(f, tuple):
                        self.edge[f[0]][f[1]] = new
                    else:
                        self.weight[f] = new
        return self

    def main_text(self, page: str | None) -> str:
        nodes = parse(page or "")
        features(nodes)
        total, _, _ = self.messages(nodes)
        return "\n\n".join(n.text for n, s in zip(nodes, total) if n.text is not None and s > 0)


def labelled(page: str, blocks: Iterable[str]) -> tuple[list[Node], list[int]]:
    """Tree of a page and its states, given the texts of its content blocks: a container is content when a block in it is."""
    nodes = parse(page)
    features(nodes)
    wanted = set(blocks)
    states = [int(n.text is not None and n.text in wanted) for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        states[nodes[k].parent] |= states[k]
    return nodes, states


# Names that pages give to their parts.
PART_NAMES = {
    "nav": "nav navbar menu navigation breadcrumb breadcrumbs topnav tabs pagination pager skip toc".split(),
    "header": "header masthead banner top site-header page-header branding logo topbar hero".split(),
    "footer": "footer site-footer page-footer bottom colophon copyright legal credits foot".split(),
    "sidebar": "sidebar side aside rail related widget widgets secondary column-right recommended popular trending tags archive".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe paywall toast announcement warning message disclaimer".split(),
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner-ad adsense commercial teaser outbrain".split(),
    "comments": "comments comment discussion replies reply disqus respond commentlist reader-comments feedback responses thread reviews".split(),
    "form": "form search searchform login signup contact subscribe-form poll".split(),
    "share": "share social sharing follow buttons tools meta byline print author-box".split(),
}
CONTENT_NAMES = "article content main post entry story body text article-body post-content entry-content main-content page-content prose".split()
PART_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}


def labelled_pages(n: int, seed: int = 7) -> list[tuple[str, list[str]]]:
    """Made pages with the blocks of their article: the labelled set the model is trained on."""
    rng = random.Random(seed)
    return [_made_page(rng) for _ in range(n)]


def _made_page(rng: random.Random) -> tuple[str, list[str]]:
    def words(a: int, b: int) -> str:
        return " ".join("".join(rng.choice("ae io ou st re an th en er on".split()) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(a, b)))

    def sentence(a: int = 3, b: int = 18) -> str:
        return words(a, b).capitalize() + rng.choice(["."] * 8 + ["!", "?", ""])

    def sentences(a: int, b: int) -> str:
        return " ".join(sentence() for _ in range(rng.randint(a, b)))

    def junk() -> str:  # articles of poor text are articles, too
        sign = rng.choice(["%%%", "!!", " |", "###", ""])
        return " ".join(w.upper() + sign if sign == "!!" else w + sign for w in words(5, 60).split())

    content: list[str] = []

    def kept(tag: str, text: str, close: bool = True) -> str:
        if rng.random() < 0.03:
            text = f"{text} \u00a9 {words(1, 2)}" if rng.random() < 0.5 else f"{words(1, 2)} \u00a9"
        content.append(text)
        inner = f"<b>{text}<br>" if rng.random() < 0.15 else f"<em>{text}</em>" if rng.random() < 0.1 else text
        return f"<{tag}>{inner}" + (f"</{tag}>" if close and rng.random() < 0.9 else "" if tag in ("p", "li") else f"</{tag}>")

    def links(a: int, b: int) -> str:
        item = rng.choice(["li", "li", "span", "p"])
        made = "".join(f'<{item}><a href="/x">{words(1, 4)}</a></{item}>' for _ in range(rng.randint(a, b)))
        return f"<ul>{made}</ul>" if item == "li" else made

    def named(role: str, inner: str) -> str:
        tag = PART_TAGS.get(role, "div") if rng.random() < 0.6 else rng.choice(["div", "section", "div"])
        bare = tag == PART_TAGS.get(role) and rng.random() < 0.5
        name = rng.choice(PART_NAMES[role])
        name = name + rng.choice(["", "", "-box", "-1", " clearfix", "-wrapper", "_inner"])
        return f"<{tag}{'' if bare else rng.choice([' class=', ' id=', ' class='])}{'' if bare else chr(34) + name + chr(34)}>{inner}</{tag}>"

    def part(role: str) -> str:
        prose = sentences(1, 4) if rng.random() < 0.6 else "".join(f"<p>{sentences(1, 3)}</p>" for _ in range(rng.randint(1, 3)))
        if rng.random() < 0.2:  # any part may hold plain prose
            return named(role, prose)
        if role == "nav":
            if rng.random() < 0.15:
                return f'<ul class="{rng.choice(PART_NAMES[role])}">' + "".join(f"<li>{words(1, 3)}</li>" for _ in range(rng.randint(2, 7))) + "</ul>"
            return named(role, links(2, 9))
        if role == "header":
            return named(role, rng.choice([f"<h1>{words(1, 4)}</h1>", f"<a href='/'>{words(1, 3)}</a>", f"<div>{words(1, 3)}</div>"]) + rng.choice(["", f"<p>{sentence()}</p>", links(2, 6)]))
        if role == "footer":
            return named(role, rng.choice(["&copy; ", "&copy; 2020 ", ""]) + words(1, 3) + rng.choice(["", " &middot; ", ". "]) + sentences(1, 2) + rng.choice(["", links(2, 5)]))
        if role == "sidebar":
            return named(role, f"<h3>{words(1, 4)}</h3>" + rng.choice([links(3, 8), prose, links(1, 3) + prose]))
        if role == "comments":
            one = lambda: f"<div class='{rng.choice(['comment', 'reply', 'c'])}'>{rng.choice(['', f'<b>{words(1, 2)}</b> '])}{rng.choice([sentences(1, 5), f'<p>{sentences(1, 5)}</p>'])}</div>"
            return named(role, rng.choice(["", f"<h2>{words(1, 3)}</h2>"]) + "".join(one() for _ in range(rng.randint(1, 5))))
        if role == "form":
            return named(role, f"<label>{words(1, 4)}</label><input name=q><p>{sentence()}</p><button>{words(1, 2)}</button>")
        if role == "share":
            return named(role, rng.choice([links(2, 5), words(2, 6)]))
        return named(role, prose + rng.choice(["", links(1, 2), f"<button>{words(1, 2)}</button>"]))

    def article() -> str:
        out = []
        if rng.random() < 0.85:
            head = kept(rng.choice(["h1", "h1", "h2"]), words(2, 10))
            out.append(f"<header>{head}</header>" if rng.random() < 0.1 else head)
        for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            kind = rng.random()
            if kind < 0.68:
                out.append(kept("p", rng.choice([sentences(1, 7), sentences(1, 7), sentences(1, 1), junk()])))
            elif kind < 0.76:
                out.append(kept(rng.choice(["h2", "h3"]), words(1, 8)))
            elif kind < 0.84:
                out.append("<ul>" + "".join(kept("li", rng.choice([sentence(2, 14), words(1, 3)])) for _ in range(rng.randint(1, 5))) + "</ul>")
            elif kind < 0.88:
                out.append("<blockquote>" + kept("p", sentences(1, 4)) + "</blockquote>")
            elif kind < 0.91:
                out.append("<table><tr>" + "".join(kept("td", words(1, 5)) for _ in range(rng.randint(1, 4))) + "</tr></table>")
            elif kind < 0.94:
                out.append("<figure><img src=x>" + kept("figcaption", sentence()) + "</figure>")
            elif kind < 0.96:
                out.append(kept("div", sentences(1, 4)))
            else:
                out.append(part(rng.choice(list(PART_NAMES))))
        if rng.random() < 0.2:
            out.insert(rng.randint(1, len(out)) if out else 0, part(rng.choice(["ad", "share", "sidebar", "notice", "comments", "form"])))
        return "".join(out)

    body = article()
    kind = rng.random()
    if kind < 0.45:
        body = f"<article>{body}</article>"
    elif kind < 0.6:
        body = f"<main>{rng.choice([body, f'<article>{body}</article>'])}</main>"
    elif kind < 0.85:
        body = f'<div {rng.choice(["class", "id"])}="{rng.choice(CONTENT_NAMES)}">{body}</div>'
    else:
        body = f"<div>{body}</div>"
    busy = rng.choice([0.0, 0.15, 0.4, 0.6])
    before = [part(r) for r in ("header", "nav", "notice", "ad", "form", "sidebar") if rng.random() < busy]
    after = [part(r) for r in ("share", "comments", "sidebar", "ad", "nav", "form", "notice") if rng.random() < busy]
    if rng.random() < 2 * busy:
        after.append(part("footer"))
    rng.shuffle(before)
    if rng.random() < 0.25:
        body = f'<div class="{rng.choice(["wrapper", "container", "page", "row", "site"])}">{body}{part("sidebar") if rng.random() < 0.5 else ""}</div>'
    page = "".join([*before, body, *after])
    return f"<!DOCTYPE html><html><head><title>{words(1, 6)}</title><script>var a='</p>';</script></head><body>{page}</body></html>", content


def trained(pages: list[tuple[str, list[str]]] | None = None) -> Model:
    """Model fitted on labelled pages (html, texts of the content blocks); by default on made ones."""
    return Model().fit([labelled(page, blocks) for page, blocks in pages or labelled_pages(TRAINING_PAGES)], rounds=ROUNDS)


#: Bounds of the training set and of its passes.
TRAINING_PAGES, ROUNDS = 1200, 25


@cache
def _usual() -> Model:
    """The default model, fitted once in a process."""
    return trained()


def _texts(model: Model):
    def run(batches):
        for batch in batches:
            texts = [model.main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text (content blocks joined by two line feeds, empty if none), n_chars for each row of ``pages`` (page_id, url, html, anything else).

    Null html is an empty page, and so is one without any block: its text is empty.  Every row is a page of its own, whatever
    its id; pages are read whole, each in one task; an empty table gives no rows.
    The default model is fitted on TRAINING_PAGES made pages, on the driver, once in a process.
    """
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(
        _texts(model or _usual()), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
