"""HTML extraction: exact marginals, fragments, long pages, comments without names, odd rows."""

import itertools
import random
from math import exp, log

import pytest
from pyspark.sql import functions as F

from fusework.llm import html_extract as H

P = "The river rose again in the night, and by morning the lower road was under water from the mill to the bridge. "
CASES = {
    "an unclosed fragment": (f"<article><p>{P * 82}", (P * 82).strip()),
    "one very long paragraph": (f"<p>{P * 10_000}", (P * 10_000).strip()),
    "a fragment with a link": (f"<article><h1>T</h1><p>{P}</p><p>{P}<a href=/>map here</a></p></article>", f"T\n{P.strip()}\n{P}map here"),
    "bare paragraphs": (f"<p>{P}</p><p>{P}</p>", f"{P.strip()}\n{P.strip()}"),
    "named comments": (
        f"<html><body><article><h1>T</h1><p>{P}</p></article><section class='comments'><h2>Comments</h2><p>reader text</p></section></body></html>",
        f"T\n{P.strip()}"),
    "comments without a name": (
        f"<html><body><article><h1>T</h1><p>{P}</p></article><section><h2>Comments</h2><p>reader text that is a little longer</p></section></body></html>",
        f"T\n{P.strip()}"),
    "a button": (f"<article><h1>T</h1><p>{P}</p><button>Click me</button><p>{P}</p></article>", f"T\n{P.strip()}\n{P.strip()}"),
    "a form around the page": (
        f"<body><form id=aspnet><div class=menu><a href=/>Home</a></div><div class=content><h1>A</h1><p>{P * 4}</p><p>{P}</p></div></form></body>",
        f"A\n{(P * 4).strip()}\n{P.strip()}"),
    "only text": ("Only text, no tags", "Only text, no tags"),
    "a link around much": (f"<article><p>{P}</p><a href=/><div><div><div><div><span>{P}</span></div></div></div></div></a></article>", None),
}


@pytest.fixture(scope="module")
def model():
    return H.train(list(H.LABELLED))


@pytest.mark.parametrize("name", CASES)
def test_cases(model, name):
    page, want = CASES[name]
    assert H.extract(page, model) == want if want is not None else H.extract(page, model).startswith(P.strip())


def test_links_count_at_any_depth():
    nodes, _ = H.parse("<body><a href=/><div><div><div><div><div><b>ten letters</b></div></div></div></div></div></a></body>")
    assert nodes[0].linked == nodes[0].text == 10


def test_marginals_equal_enumeration(model):
    rng = random.Random(3)
    tags = ["div", "p", "article", "section", "nav", "h2", "ul", "li", "aside"]
    for _ in range(12):
        nodes = [H.Node("page", -1, text=rng.randint(0, 300))]
        for k in range(1, rng.randint(2, 12)):
            words = frozenset(rng.sample(["menu", "content", "comment", "ad"], rng.randint(0, 2)))
            nodes.append(H.Node(rng.choice(tags), rng.randrange(k), words, text=rng.randint(0, 300), linked=rng.choice([0, 5])))
        own = [sum(model.node.get(f, 0.0) for f in H.features(x)) for x in nodes]
        total, yes = 0.0, [0.0] * len(nodes)
        for labels in itertools.product((0, 1), repeat=len(nodes)):
            weight = log(model.root if labels[0] else 1 - model.root) + sum(x for x, label in zip(own, labels) if label)
            for k in range(1, len(nodes)):
                p = nodes[k].parent
                weight += log(model.table(nodes[p].tag, nodes[k].tag)[labels[p]][labels[k]])
            total += exp(weight)
            for k, label in enumerate(labels):
                yes[k] += exp(weight) * label
        assert all(abs(m - y / total) < 1e-9 for m, y in zip(model.marginals(nodes), yes))


def test_held_out_pages(model):
    """Pages written with another seed: nearly all blocks are told apart."""
    right = wrong = 0
    for page in H.written_pages(120, seed=77):
        nodes, blocks = H.parse(page)
        label = [0] * len(nodes)
        for k, node in enumerate(nodes):
            label[k] = node.label if node.label is not None else label[node.parent] if k else int(node.tag == "text")
        content = model.marginals(nodes)
        for node, _ in blocks:
            if (content[node] > 0.5) == bool(label[node]):
                right += 1
            else:
                wrong += 1
    assert right + wrong > 1000 and right / (right + wrong) > 0.97


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "   "), (None, "u", f"<p>{P}</p>"), (3, "u", f"<p>{P}</p>"), (3, "u", f"<p>{P}</p>"),
            (4, "u", "<" * 3000), (5, "u", "<div>" * 3000 + P + "</div>" * 10), (6, "u", "<script>if (a < b) { '</p>' }"), (7, "u", f"<body>{P * 20_000}")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    found = H.extract_pages(df).collect()
    assert [r.page_id for r in found].count(3) == 3 and len(found) == len(rows)
    assert all(r.n_chars == len(r.text) for r in found)
    texts = {r.page_id: r.text for r in found if r.page_id != 3}
    assert texts[1] == texts[2] == texts[6] == "" and texts[None] == P.strip() and texts[7] == (P * 20_000).strip()
    assert H.extract_pages(df.limit(0)).collect() == []
