import time
import re
from html import unescape

import numpy as np
import pytest

from tributary.llm import boosting, html_extract
from tributary.llm.html_dom import events, parse, plain_text
from tributary.llm.queries import op7_html_extract


def tree(html):
    page = parse(html)

    def show(i):
        node = page.nodes[i]
        return node.tag + ("(" + " ".join(map(show, node.children)) + ")" if node.children else "")

    return show(0)


def test_trees():
    assert tree("<ul><li>a<li><p>b<p>c<li>d</ul>x") == "#page(ul(li li(p p) li))"
    assert tree("<p>a<b>c<br><p>d</p></div>e") == "#page(p(b(br)) p)"
    assert tree("<table><tr><td>a<td>b<tr><td>c</table>") == "#page(table(tr(td td) tr(td)))"
    assert tree("<html><head><title>a</title></head><body><div/>x<img src='a>b'>") == "#page(html(head(title) body(div img)))"
    assert tree("<!-- <p> --><!doctype html><script>if (a<b) '</p>'</script><p>x</p>") == "#page(script p)"
    assert tree("a < b <3 <") == "#page" and tree("") == "#page" and tree("<p>x<a href='") == "#page(p)"


def test_plain_text():
    assert plain_text("<title>t</title><body><p>a &amp; b&nbsp; <b>c</b>d</p>\n<p>e<br>f &copy &am</p><script>x</script>") == (
        "a & b cd\ne f © &am")
    assert plain_text("") == plain_text("<p></p><!-- x") == ""
    assert "".join(v for k, v, _ in events("a<b>c</b>d<e")) .startswith("a")


def test_trees_learn():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(4000, 5))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] < -0.2)).astype(float)
    model = boosting.fit(rows[:3000], labels[:3000], trees=80, depth=3)
    assert ((model.logits(rows[3000:]) > 0) == labels[3000:]).mean() > 0.95
    for none in (boosting.fit(np.zeros((0, 3)), np.zeros(0)), boosting.fit(rows, np.ones(4000))):
        assert len(none.logits(rows)) == 4000
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).logits(rows)[0] < 0


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return html_extract.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


PARAGRAPH = "It was a long day on the road, and the people of the town had gone to see what was left of the old mill. "


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>Some title</title>{head}<style>p{{x:y}}</style></head><body>{body}</body></html>"


MENU = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Home", "News", "Sport", "About us"))
ARTICLE = "<h1>The old mill</h1>" + "".join(f"<p>{k} {PARAGRAPH * 2}</p>" for k in "ABC") + "<p>Short &amp; sweet.</p>"
EXPECTED = ["The old mill", *(f"{k} {PARAGRAPH * 2}".strip() for k in "ABC"), "Short & sweet."]
LAYOUTS = {
    "plain": f"<nav><ul>{MENU}</ul></nav><article>{ARTICLE}</article><footer>(c) Us</footer>",
    "main": f"<header><h2>Site</h2><p>{PARAGRAPH}</p></header><main>{ARTICLE}</main><aside><p>{PARAGRAPH}</p></aside>",
    "comments": f"<article>{ARTICLE}</article><div class='comments'><h3>2 comments</h3><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>",
    "inside": f"<article>{ARTICLE}<div class='ad'>{PARAGRAPH}</div><form><p>{PARAGRAPH}</p><input></form></article>",
    "cookie": f"<div id='cookie-notice'><p>{PARAGRAPH}</p></div><article>{ARTICLE}</article><script>var a='<p>b</p>'</script>",
    "divs": f"<div class='menu'><ul>{MENU}</ul></div><div class='content'>{ARTICLE}</div><div class='sidebar'><p>{PARAGRAPH}</p></div>"
            "<div class='footer'>(c) Us</div>",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(model, layout):
    assert html_extract.main_texts([page(LAYOUTS[layout])], model)[0].split("\n") == EXPECTED


def test_decoding_is_consistent(model):
    pages = [parse(page(x)) for x in LAYOUTS.values()]
    for p in pages:
        rows = html_extract.features(p)
        kept = html_extract.decode(p, model.logits(rows), rows, html_extract.Settings())
        assert all(kept[n.parent] for n, k in zip(p.nodes, kept) if k and n.parent >= 0)


def test_edge_cases(spark, model):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "just text", "x"), (None, "u", page(LAYOUTS["plain"]), "x"),
            (4, "u", "<div>" * 3000 + "deep", "x"), (4, "u", "<p>&#0;&#xD800;&bogus; <", "x"),
            (5, "u", page(f"<article>{('<p>' + PARAGRAPH) * 5000}</article>"), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_extract.extracted(df, model).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    by = {r["page_id"]: r["text"] for r in out}
    assert by[1] == by[2] == "" and by[None].split("\n") == EXPECTED
    assert by[5].split("\n") == [PARAGRAPH.strip()] * 5000
    assert html_extract.report(df.limit(0)).count() == 0
    assert html_extract.report(df.where("page_id IN (1, 2, 3)")).count() == 3


def unmarked(k):
    body = "".join(f"<p>{k} {j} {PARAGRAPH * 2}</p>" for j in range(3 + k % 4))
    name = ("content", "story", "x1", "page-body")[k % 4]
    return page(f"<div class='menu'><ul>{MENU}</ul></div><div class='{name}'><h1>Title {k}</h1>{body}</div>"
                f"<div class='sidebar'><p>{PARAGRAPH}</p></div><div class='footer'><p>(c) Us, {k}</p></div>"), [
        f"Title {k}", *(f"{k} {j} {PARAGRAPH * 2}".strip() for j in range(3 + k % 4))]


@pytest.mark.parametrize("marked", [0, 1])
def test_tables_that_mark_few_or_no_articles(spark, marked):
    made = [unmarked(k) for k in range(1000 if marked else 60)]
    rows = [(k, f"u{k}", html) for k, (html, _) in enumerate(made)]
    rows += [(-k, f"m{k}", page(LAYOUTS["plain"])) for k in range(1, marked + 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r["page_id"]: r["text"].split("\n") for r in html_extract.report(df).collect()}
    assert all(out[k] == want for k, (_, want) in enumerate(made))
    assert all(out[-k] == EXPECTED for k in range(1, marked + 1))


def decoded_slowly(p, logits, rows, settings):
    """The best sum over all subtrees that hold the root, by listing them; -inf for what is hidden."""
    n = len(p.nodes)
    own, hidden = (rows[:, html_extract.NAMES.index(x)] for x in ("own_log", "hidden_above"))
    gain = [float("-inf") if hidden[i] else float(np.clip(logits[i], -6, 6)) * (1 + own[i] if own[i] > 0 else settings.container)
            for i in range(n)]
    best = 0.0
    for mask in range(1 << n):
        kept = [mask >> i & 1 for i in range(n)]
        if all(not k or i == 0 or kept[p.nodes[i].parent] for i, k in enumerate(kept)):
            best = max(best, sum(g for g, k in zip(gain, kept) if k))
    return best, gain


def test_decoding_against_all_subtrees():
    rng, settings = np.random.default_rng(4), html_extract.Settings()
    for html in ("<div><p>a</p><p>b<b>c</b></p><script>x</script></div><div>d<ul><li>e</ul></div>", "<p>x", "",
                 "<main><div hidden><p>a</p></div><div><div><p>b</p></div></div></main><p>c</p>"):
        p = parse(html)
        rows = html_extract.features(p)
        for _ in range(20):
            logits = rng.normal(size=len(p.nodes)) * 4
            best, gain = decoded_slowly(p, logits, rows, settings)
            kept = html_extract.decode(p, logits, rows, settings)
            assert sum(g for g, k in zip(gain, kept) if k) == pytest.approx(best)


def test_query_against_the_markup(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    out = op7_html_extract(spark, sf_dir).collect()
    assert len(out) == len(pages)
    same = 0
    for r in out:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1|h2|li|ul)>", inner)]
        same += r["text"] == "\n".join(b for b in blocks if b)
    assert same >= 0.99 * len(out)


def test_unclosed_tags_take_linear_time():
    start = time.monotonic()
    for tail in ("<img " + 'a="" ' * 10_000, "<img " + "a='x' " * 10_000, "<a " * 50_000, '<a b="' * 20_000, "<a b=" * 20_000,
                 "<p " + "= " * 50_000, '<p a="' + "x" * 100_000, "</p " + 'q"' * 20_001):
        for page in (tail, "<p>some text here</p>" + tail, tail + "<p>b</p>"):
            list(events(page))
    assert time.monotonic() - start < 20
    # A quote that is never closed does not swallow its tag.
    assert [e[:2] for e in events('<p a="x>some</p>')] == [("open", "p"), ("text", "some"), ("close", "p")]
    assert [e[:2] for e in events('<p a="x>y">some')] == [("open", "p"), ("text", "some")]
