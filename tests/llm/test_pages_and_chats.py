import hashlib
import html
import itertools
import math
import random
import re
from collections import defaultdict

import pytest

from postloom.llm import chat, dom, extraction

TESTDATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def weights():
    return extraction.fit(extraction.labelled_pages(120), epochs=8)


def test_articles_of_the_table(spark):
    pages = spark.read.parquet(f"{TESTDATA}/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    got = {r.page_id: r for r in extraction.extract(pages).collect()}
    assert len(got) == len(sources)
    right = 0
    for i, source in sources.items():
        inside = re.search(r"<article>(.*?)</article>", source, re.S)[1].replace("<br>", " ")
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside))
        right += got[i].text == "\n\n".join(b for b in blocks if b)
        assert got[i].n_chars == len(got[i].text)
    assert right >= 0.98 * len(sources)


def test_other_layouts(weights):
    wrong = total = 0
    for source in extraction.labelled_pages(150, seed=77):
        nodes = dom.parse(source)
        own = extraction.Extractor(weights)
        tree = extraction.tree_of(nodes, own.places)
        marginals = extraction.propagate(tree.parents, *extraction.potentials(tree, own.node, own.pair))
        for x, m, y in zip(nodes, marginals, extraction.labels(nodes)):
            if not x.tag:
                total += len(x.text)
                wrong += len(x.text) * ((m >= 0.5) != y)
    assert wrong <= 0.03 * total


def test_marginals_are_those_of_all_labellings():
    r = random.Random(3)
    parents = [-1, 0, 0, 1, 1, 2, 5]
    own = [r.gauss(0, 2) for _ in parents]
    pair = [tuple(r.gauss(0, 1) for _ in range(4)) for _ in parents]
    weight, total = [0.0] * len(parents), 0.0
    for y in itertools.product((0, 1), repeat=len(parents)):
        w = math.exp(sum(o * k for o, k in zip(own, y)) + sum(pair[i][2 * y[parents[i]] + y[i]] for i in range(1, len(y))))
        total += w
        weight = [a + w * k for a, k in zip(weight, y)]
    got, both = extraction.propagate(parents, own, pair, pairwise=True)
    assert all(abs(g - w / total) < 1e-9 for g, w in zip(got, weight))
    assert all(abs(both[i][1] + both[i][3] - got[i]) < 1e-9 for i in range(1, len(parents)))


def test_awkward_pages(spark, weights):
    rows = [
        (1, None, None), (2, "u", ""), (3, "u", "plain text only"), (4, "u", "<p>cut <a href='x"), (5, "u", "<" * 5000), (6, "u", "<div>" * 3000 + "deep"),
        (7, "u", "<script>var t='</p>';</script><!-- no end"), (None, "u", "<article><p>One &amp; two, and some more words here.</p></article>"),
        (8, "u", "<article><p>One &am two&nbsp;\n three.</p><p>Four words are here.</p></article>"), (8, "u", "<article><p>One &am two&nbsp;\n three.</p><p>Four words are here.</p></article>"),
        (9, "u", "<article><p>" + "Long words, many of them. " * 40_000 + "</p></article>"),
    ]
    df = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = defaultdict(list)
    for r in extraction.extract(df).collect():
        got[r.page_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert [got[k][0].text for k in (1, 2, 7)] == [""] * 3
    assert got[5][0].text in ("", "<" * 5000)  # no markup, so text
    assert got[None][0].text == "One & two, and some more words here."
    assert [r.text for r in got[8]] == ["One &am two three.\n\nFour words are here."] * 2
    assert got[9][0].n_chars > 1_000_000
    assert extraction.extract(df.where("false")).count() == 0


def test_broken_markup():
    nodes = dom.parse("<ul><li>a<li>b <b>c</ul><p>d<p>e<br>f<table><tr><td>g<td>h</table><SCRIPT>x<p></SCRIPT>i<!-- j --></p>k")
    assert [n.text for n in nodes if not n.tag] == ["a", "b c", "d", "e f", "g", "h", "i", "k"]


def test_elements_without_an_end():
    text = lambda source: [n.text for n in dom.parse(source) if not n.tag]
    for tag in ("svg", "select", "object", "video", "audio", "canvas", "template", "math"):
        assert text(f"<div><p>One <{tag}>two</p><p>three</p></div><p>four") == ["One two", "three", "four"], tag
        assert text(f"<p>One <{tag}/>two</p><p>three") == ["One two", "three"], tag
    assert text("<p>Let <math><mi>x</mi> <mo>=</mo> <mn>2</mn></math> be</p><p>so <svg><text>no</text></svg>it is") == ["Let x = 2 be", "so it is"]
    assert text("<p>One</p><script>two</p><p>three") == ["One"]


def test_long_conversation_in_bounded_steps(spark):
    rows = [(7, t, "assistant" if t % 3 else "user", f"t{t}") for t in range(20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(df).first()
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_mask] == [r[3] for r in rows if r[2] == "assistant"]


def digests(turns):
    """What the contract says, straight from the rows."""
    said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns)
    loss = "".join(text or "" for _, role, text in turns if role == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations(spark):
    r = random.Random(1)
    bits = ["\\", "#", "<", ":", ": ", "### ", "</part>", "</turn>\n", "\\b", "\\l", "\\h", "\\c", "a", "é", "\n", " ", "assistant", "🙂"]
    text = lambda: "".join(r.choice(bits) for _ in range(r.randint(0, 12)))
    rows = []
    for conversation in range(60):
        for turn in range(r.randint(1, 9)):
            rows.append((conversation, turn, r.choice(["user", "assistant", "system", "a: b", "</turn>\n"]), text()))
    rows += [(900, 0, None, "x"), (900, 1, "assistant", None), (900, None, "user", "first"), (900, 1, "assistant", "tie"), (None, 0, "user", "q")]
    rows += [(901, 5, "assistant", "same"), (901, 5, "assistant", "same"), (902, 0, "user", "y" * 200_000)]
    rows += [(903, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(900)]
    df = spark.createDataFrame([(*x, "p", 1) for x in rows], "conv_id long, turn long, role string, text string, formatted string, turns int").repartition(4)
    by = defaultdict(list)
    for c, t, role, said in rows:
        by[c].append((t, role, said))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or "")
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in chat.conversation_digests(df).collect()}
    assert got == {c: digests(sorted(turns, key=key)) for c, turns in by.items()}
    assert chat.conversation_digests(df.where("false")).count() == 0


def test_neighbouring_turns_share_a_block(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(df).first()
    assert row.formatted == "### user: a</part>b</turn>\n### assistant: c</turn>\n"
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_mask] == ["c"]


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet(f"{TESTDATA}/conversations.parquet")
    plan = chat.conversation_digests(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
