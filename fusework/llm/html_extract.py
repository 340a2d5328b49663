"""Main text of web pages by a graphical model over the DOM tree.

Every element is a node that is content or not. A node has observed features (tag, words of class, id
and role, share of linked text, length of text); each child depends on its parent. The tables are counted on
labelled pages, fixed ones and several hundred that are written by rules. Messages go up from the leaves and down from the root (sum-product on the tree), which
gives every node its marginal probability of being content; a block of text is kept if its node is
content. Work and memory per page are linear in its nodes.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame

from fusework.llm.labelled_pages import PAGES, written_pages
from fusework.llm.textbatch import bounded_batches, send

# Fixed values of HTML: elements without an end tag, without text of the page, and inside a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style noscript template head title iframe object svg math canvas audio video datalist button select textarea".split()
)
HEAD_PARTS = frozenset("head title meta link base script style noscript template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend summary".split())
RAW = frozenset("script style title textarea iframe noscript".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# Start tags that end an open element of these kinds, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"[\s ]+")
PART = re.compile(r"[A-Z]?[a-z]+")
LABELLED = (*PAGES, *written_pages(300))


@dataclass
class Node:
    tag: str
    parent: int
    words: frozenset = frozenset()
    label: int | None = None
    text: int = 0  # characters below
    linked: int = 0  # of these, within links
    heading: list = field(default_factory=list)  # texts of headings up to two levels below
    after: str = ""  # an article or main element among the earlier siblings
    pieces: list = field(default_factory=list)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """(nodes in document order, blocks of text with their node). Node 0 stands for the page.

    Block elements and line breaks end a block. Unclosed and stray tags are put up with, as browsers do: a page or
    fragment with any element has an html and a body element, whether they are written or not.
    """
    nodes, stack = [Node("page", -1)], [0]
    links, special = 0, {"html": 0, "body": 0}
    titles: list[int] = []  # places of the open headings in the stack
    last_text: dict[int, str] = {}  # of each node, the kind of article that a child of it was
    blocks: list[tuple[int, list[str]]] = []
    at, unseen, opened = 0, 0, True

    def add(raw: str, literal: bool = False) -> None:
        nonlocal opened
        if unseen or not raw:
            return
        text = raw if literal else html.unescape(raw)
        if opened or not blocks:
            if not text.strip():
                return
            block = next(n for n in reversed(stack) if nodes[n].tag not in INLINE)
            blocks.append((block, []))
            opened = False
        blocks[-1][1].append(text)
        size = len("".join(text.split()))
        node = nodes[stack[-1]]
        node.text += size
        node.linked += size * (links > 0)
        if titles and size:
            # a heading speaks for its parent and the element above
            for above in stack[max(0, titles[-1] - 2) : titles[-1]]:
                if len(nodes[above].heading) < 8:
                    nodes[above].heading.append(text)

    def close_to(depth: int) -> None:
        nonlocal unseen, opened, links
        for n in stack[depth:]:
            unseen -= nodes[n].tag in UNSEEN
            links -= nodes[n].tag == "a"
            opened |= nodes[n].tag not in INLINE
        del stack[depth:]
        while titles and titles[-1] >= depth:
            titles.pop()

    def open_element(tag: str, words: frozenset, label: int | None) -> None:
        nonlocal links
        parent = stack[-1]
        nodes.append(Node(tag, parent, words, label, after=last_text.get(parent, "")))
        if tag in ("article", "main"):
            last_text[parent] = tag
        stack.append(len(nodes) - 1)
        links += tag == "a"
        if tag in HEADINGS:
            titles.append(len(stack) - 1)

    end = len(page)
    while at < end:
        match = TOKEN.search(page, at)
        if not match:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        name = match[2]
        if name is None:
            if match[0].startswith("<![CDATA["):
                add(match[0][9:].removesuffix("]]>"), True)
            continue
        tag = name.lower()
        if match[1]:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if nodes[stack[k]].tag == tag), 0)
            if depth:
                if tag in special:
                    continue  # what comes after the end of the body is part of it
                close_to(depth)
            elif tag == "p":
                opened = True
            continue
        if tag not in INLINE:
            opened = True
        if tag in VOID:
            continue
        if tag in CLOSES:
            kinds, fence = CLOSES[tag]
            while len(stack) > 1 and nodes[stack[-1]].tag not in fence:
                depth = next((k for k in range(len(stack) - 1, 0, -1) if nodes[stack[k]].tag in kinds | fence), 0)
                if not depth or nodes[stack[depth]].tag in fence:
                    break
                close_to(depth)
        elif tag in ENDS_P:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if nodes[stack[k]].tag not in INLINE), 0)
            if depth and nodes[stack[depth]].tag == "p":
                close_to(depth)
        attributes = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(match[3])} if match[3].strip() else {}
        label = {"0": 0, "1": 1}.get(attributes.get("data-content"))  # pages use the attribute for text of their own too
        words = frozenset(
            w.lower() for a in ("class", "id", "role", "itemprop", "aria-label") if a in attributes for w in PART.findall(attributes[a])
        )
        if "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", ""):
            words |= {"hidden"}
        if match[3].endswith("/") and tag in ("svg", "path"):
            continue
        if tag in special and special[tag]:
            node = nodes[special[tag]]
            node.words, node.label = node.words | words, node.label if label is None else label
            continue
        if tag != "html" and not special["html"]:
            open_element("html", frozenset(), None)
            special["html"] = stack[-1]
        if tag not in ("html", "body", "frameset") and tag not in HEAD_PARTS and not special["body"] and not unseen:
            open_element("body", frozenset(), None)
            special["body"] = stack[-1]
        open_element(tag, words, label)
        if tag in special:
            special[tag] = stack[-1]
        unseen += tag in UNSEEN
        if tag in RAW:
            close = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = close.start() if close else end
    if len(nodes) == 1:
        nodes[0].tag = "text"  # no element at all
    elif special["body"] == len(nodes) - 1:
        nodes[-1].tag = "text"  # none but the body
    for k in range(len(nodes) - 1, 0, -1):
        node, parent = nodes[k], nodes[nodes[k].parent]
        parent.text += node.text
        parent.linked += node.linked
    texts = [(n, SPACE.sub(" ", "".join(parts)).strip()) for n, parts in blocks]
    return nodes, [(n, t) for n, t in texts if t]


def features(node: Node) -> list[str]:
    """What is observed at a node, as names."""
    share = 0 if not node.linked else 1 + min(3, int(4 * node.linked / max(1, node.text)))
    size = sum(node.text >= least for least in (1, 25, 100))
    titles = frozenset(w.lower() for w in PART.findall(" ".join(node.heading).lower())) if node.tag not in ("html", "body") else ()
    return [
        f"tag {node.tag}", f"linked {share}", f"size {size}", f"after {node.after}", *sorted(f"word {w}" for w in node.words),
        *sorted(f"title {w}" for w in titles if len(w) > 2),
    ]


@dataclass
class TreeModel:
    """Log potentials of a node's features, and tables of child given parent by their tags."""

    root: float
    node: dict[str, float]
    edge: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    def table(self, parent: str, child: str):
        """P(child | parent) by both tags where they were labelled, else by the parent's, else for any."""
        return self.edge.get(f"{parent} {child}") or self.edge.get(parent) or self.edge[""]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability that each node is content: messages upward, then downward."""
        n = len(nodes)
        own = [1.0] * n  # odds of the evidence at and below a node
        up = [(1.0, 1.0)] * n
        tables = [self.table(nodes[max(0, x.parent)].tag, x.tag) for x in nodes]
        for k in range(n):
            own[k] = sum(self.node.get(f, 0.0) for f in features(nodes[k]))
        below = [(0.0, x) for x in own]  # log of (not content, content)
        for k in range(n - 1, 0, -1):
            no, yes = below[k]
            edge = tables[k]
            top = max(no, yes)
            a, b = exp(no - top), exp(yes - top)
            message = tuple(top + log(edge[p][0] * a + edge[p][1] * b) for p in (0, 1))
            up[k] = message
            p = nodes[k].parent
            below[p] = (below[p][0] + message[0], below[p][1] + message[1])
        whole = [(0.0, 0.0)] * n
        whole[0] = (below[0][0] + log(1 - self.root), below[0][1] + log(self.root))
        for k in range(1, n):
            p = nodes[k].parent
            # the parent without what this child told it
            no, yes = whole[p][0] - up[k][0], whole[p][1] - up[k][1]
            top = max(no, yes)
            a, b = exp(no - top), exp(yes - top)
            edge = tables[k]
            down = [log(a * edge[0][c] + b * edge[1][c]) for c in (0, 1)]
            whole[k] = (below[k][0] + down[0], below[k][1] + down[1])
            top = max(whole[k])
            whole[k] = (whole[k][0] - top, whole[k][1] - top)
        return [1 / (1 + exp(min(500.0, max(-500.0, no - yes)))) for no, yes in whole]


def train(pages: list[str]) -> TreeModel:
    """Counts the tables on pages whose elements carry data-content="1" or "0".

    An element without the mark has its parent's label; the page itself is content if it is text only. Counts are
    smoothed; a feature that no labelled page has tells nothing.
    """
    seen: dict[str, Counter] = {}
    edges: dict[str, dict[tuple[int, int], float]] = {}
    totals, roots = Counter(), Counter()
    for page in pages:
        nodes, _ = parse(page)
        label = [0] * len(nodes)
        for k, node in enumerate(nodes):
            label[k] = node.label if node.label is not None else label[node.parent] if k else int(node.tag == "text")
            totals[label[k]] += 1
            for f in features(node):
                seen.setdefault(f, Counter())[label[k]] += 1
            if k:
                for name in ("", nodes[node.parent].tag, f"{nodes[node.parent].tag} {node.tag}"):
                    edges.setdefault(name, {}).setdefault((label[node.parent], label[k]), 0)
                    edges[name][label[node.parent], label[k]] += 1
            else:
                roots[label[k]] += 1
    potentials = {}
    for f, c in seen.items():
        weight = 1.0 if f.startswith(("tag", "word", "title", "after")) else 0.3  # sizes of nested nodes repeat each other
        potentials[f] = weight * (log((c[1] + 0.3) / (totals[1] + 0.6)) - log((c[0] + 0.3) / (totals[0] + 0.6)))
    tables = {}
    base = {(p, c): (edges[""].get((p, c), 0) + 0.5) / (sum(edges[""].get((p, x), 0) for x in (0, 1)) + 1) for p in (0, 1) for c in (0, 1)}
    for name in sorted(edges, key=lambda x: x.count(" ")):
        counts, wider = edges[name], tables.get(name.split(" ")[0], tables.get(""))
        tables[name] = tuple(
            tuple(
                (counts.get((p, c), 0) + 2 * (wider[p][c] if wider else base[p, c])) / (sum(counts.get((p, x), 0) for x in (0, 1)) + 2)
                for c in (0, 1)
            ) for p in (0, 1)
        )
    return TreeModel((roots[1] + 0.5) / (sum(roots.values()) + 1), potentials, tables)


def extract(page: str, model: TreeModel) -> str:
    """The blocks of text whose node is rather content than not, joined by line feeds."""
    nodes, blocks = parse(page)
    if not blocks:
        return ""
    content = model.marginals(nodes)
    return "\n".join(text for node, text in blocks if content[node] > 0.5)


def extract_pages(pages: DataFrame, labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``; NULL html is an empty page.

    Empty pages have an empty text. Repeated rows give repeated rows, an empty table an empty one; other columns don't matter, and
    very long pages take time in proportion.

    ``labelled`` are the pages the model is trained on, on the driver: a fixed set.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    receive = send(spark, train(list(labelled)))
    key = pages.schema["page_id"].dataType.simpleString()

    def work(batches):
        model = receive()
        for batch in batches:
            texts = [extract(page or "", model) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(work, f"page_id {key}, url string, text string, n_chars bigint")
