import html as entities
import re

import pandas as pd
import pytest

from tidemark.llm import extraction
from tidemark.llm.labelled_pages import PAGES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return extraction.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def article(page):
    """Blocks between the article tags, which every page of the table has."""
    inner = re.search(r"(?s)<article>(.*?)(</article>|$)", re.sub(r"(?s)<!--.*?-->", "", page))[1]
    blocks = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\0", inner))).split("\0")
    return "\n".join(" ".join(entities.unescape(b).split()) for b in blocks if b.strip())


def test_extracts_the_articles(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = extraction.main_text(pages, model).select("html", "text").toPandas()
    assert (got.text == got.html.map(article)).mean() > 0.99


def test_left_out_layouts():
    right = total = 0
    sample = pd.read_parquet(f"{SF}/pages.parquet").html.head(30).tolist()
    for k, page in enumerate(PAGES):
        model = extraction.train([*(PAGES[:k] + PAGES[k + 1:]) * 2, *sample], rounds=40)
        nodes = extraction.tree(page, marks=True)
        for n, y, p in zip(nodes, extraction.labelled(nodes), extraction.marginals(nodes, model)):
            if n.tag == "#text":
                right += (p > 0.5) == y
                total += 1
    assert right / total > 0.88


def test_marginals_match_enumeration(model):
    import itertools
    import math
    nodes = extraction.tree("<body><nav><p>Home</p></nav><article><p>A sentence here.</p></article></body>")
    feats = [extraction.features(n, nodes) for n in nodes]
    weight, total = [0.0] * len(nodes), 0.0
    for states in itertools.product((0, 1), repeat=len(nodes)):
        s = sum(model.unary.get(f, 0.0) for y, fs in zip(states, feats) if y for f in fs)
        s += sum(model.edge[extraction.kind(n)][states[n.parent]][y] for n, y in zip(nodes, states) if n.parent >= 0)
        total += math.exp(s)
        for i, y in enumerate(states):
            weight[i] += y * math.exp(s)
    for got, want in zip(extraction.marginals(nodes, model), weight):
        assert got == pytest.approx(want / total, abs=1e-9)


def test_cases(spark, model):
    long_page = "<html><body><nav><a href='/'>Home</a></nav><article>" + "<p>One more sentence of the long story.</p>" * 20000 + "</article></body></html>"
    rows = [(1, None), (2, ""), (3, "<article><h1>T</h1><p>Fish &amp; chips&nbsp;are \n good, it is said&#33;</p><script>x<y</script></article>"),
            (4, "<article><p>Cut off in the middle of this sentence &am"), (5, long_page), (5, long_page), (6, "<<<>>> </p></div> <!-- x"),
            (7, "<script>only('code')</script><style>p{}</style>")]
    df = spark.createDataFrame([(i, h, "old", 1) for i, h in rows], "page_id int, html string, text string, found int")
    out = extraction.main_text(df, model)
    assert sorted(out.columns) == sorted(df.columns)
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert got[1] == got[2] == got[7] == ""
    assert got[3] == "T\nFish & chips are good, it is said!"
    assert got[4] == "Cut off in the middle of this sentence &am"
    assert got[5].count("\n") == 19999
    assert extraction.main_text(df.limit(0), model).count() == 0


@pytest.mark.parametrize("markup", [
    "<svg><svg></svg></svg>", "<object><object>x</object></object>", "<template><template><p>x</p></template></template>",
    "<svg><g><title>x</title><svg><path/></svg></g></svg>", "<select><option>x<option>y</select>",
    "<datalist><option value=a><option value=b></datalist>", "<div><datalist><option>x<div>y</div>z</datalist></div>",
    "<select><optgroup><option>x<optgroup><option>y</optgroup></select>"])
def test_text_after_unseen_markup_is_read(markup):
    nodes = extraction.tree(f"<html><body><p>Before.</p>{markup}<p>After.</p></body></html>")
    assert [n.text for n in nodes if n.tag == "#text"] == ["Before.", "After."]


@pytest.mark.parametrize("start", ["<p>", "<div class=x>", "", "<a href=x>", "<body><p>", "</head><body>"])
def test_head_ends_without_its_end_tag(start):
    head = "<head><meta charset=utf-8><title>T</title><style>p{}</style><noscript><p>x</p></noscript><script>y</script>\n"
    nodes = extraction.tree(f"<html>{head}{start}Text.<p>More.")
    assert [n.text for n in nodes if n.tag == "#text"] == ["Text.", "More."]


def test_copies_of_a_page_are_one_training_page(spark, monkeypatch):
    page = "<html><body><article><p>{}</p></article></body></html>"
    df = spark.createDataFrame([(page.format("Copied."),)] * 300 + [(page.format(f"Page {i}."),) for i in range(30)], "html string")
    seen = []
    monkeypatch.setattr(extraction, "train", lambda pages: seen.extend(pages))
    extraction.fit(df, sample=40)
    own = seen[2 * len(PAGES):]
    assert len(own) == len(set(own)) == 31


@pytest.mark.parametrize("value", ["chart", "1", "", "0.5", None])
def test_crawled_pages_do_not_label_themselves(spark, value):
    mark = "data-y" if value is None else f'data-y="{value}"'
    html = f"<html><body><nav {mark}><a href=/>Home</a></nav><article><p>A sentence that is read.</p></article></body></html>"
    assert {n.mark for n in extraction.tree(html)} == {None}
    assert extraction.labelled(extraction.tree(html)) == extraction.labelled(extraction.tree(html.replace(mark, "")))
    model = extraction.fit(spark.createDataFrame([(html,)], "html string"))
    assert extraction.extract(html, model) == "A sentence that is read."


@pytest.mark.parametrize("element", ["script", "style", "title", "textarea", "iframe", "noscript"])
def test_a_slash_does_not_close_elements_of_text(element):
    nodes = extraction.tree(f"<body><p>Before.</p><{element} src='x' />alert(1) is <b>not</b> read</{element}><p>After.</p></body>")
    assert [n.text for n in nodes if n.tag == "#text"] == ["Before.", "After."]


@pytest.mark.parametrize("markup", ["<svg/>", "<svg><path d='x'/><style/><title/></svg>", "<canvas/>", "<br/>", "<img src=x />", "<object/>", "<div/>"])
def test_text_after_a_slash_is_read(markup):
    nodes = extraction.tree(f"<body><p>Before.</p>{markup}<p>After.</p></body>")
    assert [n.text for n in nodes if n.tag == "#text"] == ["Before.", "After."]


@pytest.mark.parametrize("opening", ["<div class=x>", "<b>", "<div><p>text", "<li>", "<section><ul><li>", "<table><tr><td>", "<a href=x>word "])
def test_deep_pages_take_linear_time(model, opening):
    import time
    begun = time.process_time()
    page = "<body>" + opening * 100_000 + "The end of it.</x></y>" * 3
    assert "The end of it." in " ".join(n.text for n in extraction.tree(page))
    extraction.extract(page, model)
    assert time.process_time() - begun < 60


def test_nearest_names_and_landmark_match_a_walk():
    import random
    rnd = random.Random(1)
    for _ in range(60):
        page = "".join(rnd.choice(["<div>", "<div class=menu>", "<nav>", "<article id=a>", "<main>", "</div>", "</nav>", "</article>", "text ", "<p>"])
                       for _ in range(60))
        nodes = extraction.tree(page)
        for n in nodes:
            if n.tag != "#text":
                continue
            want, up, named = [], nodes[n.parent], False
            while up.parent >= 0:
                if up.hints and not named:
                    named = True
                    want += [f"below name {h}" for h in up.hints]
                if up.tag in extraction.CONTENT_MARKS or up.tag in extraction.OTHER_MARKS:
                    want.append(f"below {up.tag}")
                    break
                up = nodes[up.parent]
            assert [f for f in extraction.features(n, nodes) if f.startswith("below")] == want
