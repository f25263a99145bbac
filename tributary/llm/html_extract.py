"""Main text of pages: gradient-boosted trees over the elements of the page, decoded as a tree.

Every element gets features: text, link and markup density of its subtree, tokens of its attributes and
those above it, depth, place, and what its siblings are like. The trees give it the log-odds of being
main text. The kept elements are the subtree, from the root down, with the highest sum of log-odds: an
element under a dropped one is never kept, and one with kept descendants is never dropped.

There are no labelled pages, so the trees learn from pages that mark themselves up: an element counts as
main text if it is in an article, outside menus, notices and the like. Each sampled page is also seen
with its own boilerplate of other kinds put in, and with the telling tags and attributes taken away, so
that density and place are learned too. The sample is about ``sample_pages`` pages (by a hash of url and
page) of those that hold such marks, at most ``page_nodes`` elements of each; whole pages are parsed. If
fewer pages hold marks, it is filled up from the others, whose main text is taken to be the element that
holds most running text of its own or its children, without notices and the like.

Null and empty pages have no text, neither have pages without an element. Rows are independent.
"""

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import boosting
from tributary.llm.html_dom import BLOCKS, HIDDEN, Page, blocks_text, parse

# What elements and attributes of pages are called.
BAD_TAGS = frozenset("nav footer aside form button menu dialog fieldset label input search".split())
GOOD_TAGS = frozenset("article main".split())
BAD_TOKENS = frozenset("""
ad ads advert advertisement advertisements advertising adbox sponsor sponsored sponsors promo promotion promoted banner
menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toc sitemap topbar toolbar
footer foot bottom header masthead sidebar side rail aside widget widgets related recommended recommendations trending popular
cookie cookies consent gdpr notice notices alert popup modal overlay dialog disclaimer
comment comments reply replies discussion disqus respond reader readers
share sharing social follow subscribe subscription newsletter signup login search form tags tagcloud meta byline
""".split())
GOOD_TOKENS = frozenset("article articlebody content main post entry story body text maincontent page prose".split())

NAMES = (
    "p li a heading cell inline list container semantic_good header text_log own_log link_share tag_density sentence_share "
    "comma_share word_length bad_self good_self bad_above good_above good_gap header_above hidden_above depth place share_of_page "
    "siblings same_siblings sibling_text sibling_links parent_text"
).split()


@dataclass(frozen=True)
class Settings:
    sample_pages: int = 240
    page_nodes: int = 400
    trees: int = 40
    depth: int = 4
    container: float = 0.3  # weight of an element without text of its own


def tokens(attrs: dict[str, str]) -> set[str]:
    text = " ".join(attrs.get(k, "") for k in ("class", "id", "role", "itemprop", "aria-label", "data-component"))
    return set(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", text).lower())) if text.strip() else set()


def _hidden(tag: str, attrs: dict[str, str]) -> bool:
    return tag in HIDDEN or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get(
        "style", "").replace(" ", "").lower()


def features(page: Page, tags: list[str] | None = None, words: list[set[str]] | None = None) -> np.ndarray:
    """A row for each element. ``tags`` and ``words`` replace those of the page."""
    nodes = page.nodes
    n = len(nodes)
    tags = tags or [x.tag for x in nodes]
    words = words or [tokens(x.attrs) for x in nodes]
    own, text, links, marks, stops, commas, count = (np.zeros(n) for _ in range(7))
    hidden = [False] * n
    for i, x in enumerate(nodes):
        hidden[i] = x.parent >= 0 and hidden[x.parent] or _hidden(tags[i], x.attrs)
        if hidden[i]:
            continue
        s = " ".join("".join(x.own).split())
        own[i] = text[i] = len(s)
        stops[i] = s.count(". ") + s.count("! ") + s.count("? ") + s.endswith((".", "!", "?"))
        commas[i], count[i], marks[i] = s.count(","), s.count(" ") + (len(s) > 0), 1
    link = [False] * n
    for i, x in enumerate(nodes):
        link[i] = x.parent >= 0 and link[x.parent] or tags[i] == "a"
        links[i] = own[i] if link[i] else 0
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        for values in (text, links, marks, stops, commas, count):
            values[up] += values[i]
    bad = [len(words[i] & BAD_TOKENS) + (tags[i] in BAD_TAGS) for i in range(n)]
    good = [len(words[i] & GOOD_TOKENS) + (tags[i] in GOOD_TAGS) for i in range(n)]
    bad_above, good_above, gap, header_above = [0] * n, [0] * n, [0] * n, [0] * n
    out = np.zeros((n, len(NAMES)))
    before, total = 0.0, max(text[0], 1.0)
    sibling = {}
    for i, x in enumerate(nodes):
        up, tag = x.parent, tags[i]
        if up >= 0:
            bad_above[i], good_above[i] = bad_above[up] + bad[up], good_above[up] + good[up]
            gap[i] = gap[up] + 1 if good_above[i] else 0
            if bad[up]:
                gap[i] = 0
            header_above[i] = header_above[up] + (tags[up] == "header")
            if up not in sibling:
                kids = nodes[up].children
                sibling[up] = (len(kids), text[kids].mean(), (links[kids].sum() / max(text[kids].sum(), 1.0)),
                               {t: sum(tags[k] == t for k in kids) for t in {tags[k] for k in kids}})
            siblings, mean, near_links, same = sibling[up]
        else:
            siblings, mean, near_links, same = 1, text[0], links[0] / total, {tag: 1}
        t = max(text[i], 1.0)
        out[i] = (
            tag == "p", tag == "li", tag == "a", len(tag) == 2 and tag[0] == "h" and tag[1].isdigit(), tag in ("td", "th"),
            tag not in BLOCKS, tag in ("ul", "ol", "dl", "table"), tag in ("div", "section", "body"), tag in GOOD_TAGS,
            tag == "header", np.log1p(text[i]), np.log1p(own[i]), links[i] / t, 100 * marks[i] / t, 100 * stops[i] / t,
            100 * commas[i] / t, text[i] / max(count[i], 1.0), bad[i], good[i], bad_above[i], good_above[i], gap[i], header_above[i],
            hidden[i], x.depth, before / total, text[i] / total, siblings, same[tag] / siblings, np.log1p(mean), near_links,
            np.log1p(text[up] if up >= 0 else text[0]),
        )
        before += own[i]
    return out.astype(np.float32).astype(float)  # as exact as what the trees learn from


#: Holds for every page with an article of its own, before it is parsed.
MARKS = r"(?i)<(article|main)|articlebody|role\s*=\s*[\"']?(main|article)"


def densest(page: Page, outside: list[bool]) -> int:
    """The element that holds most text outside links, of its own or of its children and their inline elements."""
    nodes = page.nodes
    held, block = [0] * len(nodes), list(range(len(nodes)))
    for i, x in enumerate(nodes):
        if x.parent >= 0 and x.tag not in BLOCKS:
            block[i] = block[x.parent]
        size = len(" ".join("".join(x.own).split()))
        if outside[i] or x.tag == "a" or not size:
            continue
        held[block[i]] += size
        if (up := nodes[block[i]].parent) >= 0:
            held[block[up]] += size
    return max(range(len(nodes)), key=held.__getitem__)


def self_marked(page: Page, by_text: bool = False) -> list[bool] | None:
    """Whether each element is main text by the page's own markup, or else by its text; None if neither tells."""
    nodes, marked, found = page.nodes, [], False
    inside, outside = [False] * len(nodes), [False] * len(nodes)
    for i, x in enumerate(nodes):
        above_in, above_out = (inside[x.parent], outside[x.parent]) if x.parent >= 0 else (False, False)
        words = tokens(x.attrs)
        inside[i] = above_in or x.tag in GOOD_TAGS or "articlebody" in words or x.attrs.get("role") in ("main", "article")
        own_header = x.tag == "header" and not inside[i]
        outside[i] = above_out or x.tag in BAD_TAGS or own_header or bool(words & BAD_TOKENS) and x.tag not in (
            "body", "html", *GOOD_TAGS) or _hidden(x.tag, x.attrs)
        found |= inside[i]
        marked.append(inside[i] and not outside[i])
    if not found:
        if not by_text:
            return None
        top = densest(page, outside)
        for i, x in enumerate(nodes):
            inside[i] = i == top or x.parent >= 0 and inside[x.parent]
            marked[i] = inside[i] and not outside[i]
    for i in range(len(nodes) - 1, 0, -1):  # what holds main text is no boilerplate
        if marked[i] and nodes[i].parent >= 0:
            marked[nodes[i].parent] = True
    return marked


SNIPPETS = (
    '<div class="comments"><h3>Comments</h3><div class="comment"><p>{0}</p></div><div class="comment"><p>{1}</p></div></div>',
    '<section id="comments"><ol><li><p>{0}</p></li><li>{1}</li></ol></section>',
    '<aside class="sidebar"><h2>Related</h2><ul><li><a href="#">{0}</a></li><li><a href="#">{1}</a></li></ul></aside>',
    '<div class="sidebar"><p>{0}</p><p>{1}</p></div>', '<div id="cookie-notice"><p>{0}</p><button>OK</button></div>',
    '<div class="notice">{0}</div>', '<form action="#"><label>{0}</label><input name="q"><p>{1}</p></form>',
    '<div class="advert"><p>{0}</p></div>', '<div class="share-buttons"><a href="#">{0}</a><a href="#">{1}</a></div>',
    '<div class="newsletter-signup"><p>{0}</p></div>', '<header><h1>{0}</h1><p>{1}</p></header>',
    '<div class="related-posts"><h3>{0}</h3><p>{1}</p></div>', '<footer><p>{0}</p><p>{1}</p></footer>',
    '<div class="menu"><ul><li><a href="#">{0}</a></li><li><a href="#">{1}</a></li></ul></div>',
)
KEEPERS = ("<ul><li>{0}</li><li>{1}</li></ul>", "<blockquote><p>{0}</p></blockquote>", "<div><p>{0}</p><p>{1}</p></div>",
           "<h2>{0}</h2><p>{1}</p>", "<section><h3>{0}</h3><p>{1} <a href='#'>{0}</a> {1}</p></section>",
           "<table><tr><td>{0}</td><td>{1}</td></tr></table>", "<p>{0}</p>", "<pre>{0}</pre>")


def lessons(html: str, limit: int) -> list[tuple[np.ndarray, list[bool]]]:
    """Features and labels of a page and its variants."""
    page = parse(html)
    by_text = re.search(MARKS, html) is None
    if self_marked(page, by_text) is None:
        return []
    rng = random.Random(sha256(html.encode("utf-8", "surrogatepass")).digest())
    texts = [" ".join(t.split()) for _, _, t in page.parts if len(t.split()) > 2] or ["some text here"]
    pieces = [w[:rng.choice((20, 60, 200, 600))].replace("<", " ").replace(">", " ") for w in texts]

    def filled(snippet: str) -> str:
        return snippet.format(rng.choice(pieces), rng.choice(pieces))

    longer = html
    for end in ("</article>", "</main>"):
        if end in longer:
            inner = "".join(map(filled, rng.sample(KEEPERS, 3) + rng.sample(SNIPPETS, 2)))
            outer = "".join(map(filled, rng.sample(SNIPPETS, 4)))
            longer = longer.replace(end, inner + end + outer, 1)
            break
    start = re.search(r"<(article|main)[\s>]", longer)
    if start:
        before = "".join(map(filled, rng.sample(SNIPPETS, 3)))
        longer = longer[:start.start()] + before + longer[start.start():]
    out = []
    for text in (html, longer):
        tree = page if text is html else parse(text)
        marked = self_marked(tree, by_text)
        tags, words = [x.tag for x in tree.nodes], [tokens(x.attrs) for x in tree.nodes]
        bare = ["div" if t in GOOD_TAGS else t for t in tags]
        named = [w | ({rng.choice(sorted(GOOD_TOKENS))} if t in GOOD_TAGS else set()) for t, w in zip(tags, words)]
        turned = [{"nav": "menu", "footer": "footer", "aside": "sidebar", "header": "header"}.get(t) for t in tags]
        for some_tags, some_words in (
            (tags, words),
            (["div" if t else b for t, b in zip(turned, bare)], [w | ({t} if t else set()) for t, w in zip(turned, named)]),
            (bare, words),
        ):
            rows = features(tree, some_tags, some_words)
            use = [i for i in range(len(rows)) if not rows[i][NAMES.index("hidden_above")] and rows[i][NAMES.index("text_log")] > 0]
            use = use if len(use) <= limit else sorted(rng.sample(use, limit))
            out.append((rows[use], [marked[i] for i in use]))
    return out


TEACHERS = 16  # tasks that parse the sample


def fit(pages: DataFrame, settings: Settings = Settings(), html_col: str = "html", key_col: str = "url") -> boosting.Trees:
    rows = pages.select(F.col(html_col).cast("string").alias("html"), F.xxhash64(F.col(key_col), F.col(html_col)).alias("key"))
    rows = rows.where("html IS NOT NULL").withColumn("marks", F.col("html").rlike(MARKS))
    sizes = {r["marks"]: r["count"] for r in rows.groupBy("marks").count().collect()}
    wanted = {True: settings.sample_pages, False: max(0, settings.sample_pages - sizes.get(True, 0))}
    limit = F.coalesce(*[F.when(F.col("marks") == marks, int((1 << 30) * min(1.0, wanted[marks] / n)))
                         for marks, n in sizes.items()], F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                for number, (some, marked) in enumerate(lessons(html.as_py(), settings.page_nodes)):
                    out.append((key, number, some.astype("<f4").tobytes(), np.array(marked, np.uint8).tobytes()))
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["key", "number", "rows", "marked"])

    # About ``sample_pages`` pages, so what comes to the driver is bounded by the settings; spread over tasks to be parsed.
    chosen = rows.where(F.pmod("key", F.lit(1 << 30)) < limit).select("key", "html").repartition(TEACHERS, "key", "html")
    found = sorted(chosen.distinct().mapInArrow(
        run, "key long, number int, rows binary, marked binary").collect(), key=lambda r: (r["key"], r["number"]))
    if not found:
        return boosting.fit(np.zeros((0, len(NAMES))), np.zeros(0))
    table = np.concatenate([np.frombuffer(r["rows"], "<f4").reshape(-1, len(NAMES)) for r in found]).astype(float)
    labels = np.concatenate([np.frombuffer(r["marked"], np.uint8) for r in found]).astype(float)
    return boosting.fit(table, labels, settings.trees, settings.depth)


def decode(page: Page, logits: np.ndarray, rows: np.ndarray, settings: Settings) -> np.ndarray:
    """Which elements are kept: the subtree from the root with the highest sum."""
    own = rows[:, NAMES.index("own_log")]
    gain = np.clip(logits, -6, 6) * np.where(own > 0, 1 + own, settings.container)
    gain[rows[:, NAMES.index("hidden_above")] > 0] = -np.inf
    best = gain.copy()
    for i in range(len(best) - 1, 0, -1):
        if best[i] > 0:
            best[page.nodes[i].parent] += best[i]
    kept = np.zeros(len(best), bool)
    kept[0] = best[0] > 0
    for i in range(1, len(best)):
        kept[i] = kept[page.nodes[i].parent] and best[i] > 0
    return kept


def main_texts(pages: list[str | None], model: boosting.Trees, settings: Settings = Settings()) -> list[str]:
    """The main text of each page; the elements of all pages are judged at once."""
    parsed = [parse(html or "") for html in pages]
    rows = [features(page) for page in parsed]
    logits = model.logits(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for page, some in zip(parsed, rows):
        kept = decode(page, logits[at:at + len(some)], some, settings)
        at += len(some)
        out.append(blocks_text([(block, text) for node, block, text in page.parts if kept[node]]))
    return out


PAGES_AT_ONCE = 64


def extracted(pages: DataFrame, model: boosting.Trees, settings: Settings = Settings(), id_col: str = "page_id",
              url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``, one row per page."""
    names = ["page_id", "url", "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                some = batch.slice(at, PAGES_AT_ONCE)
                texts = main_texts(some.column(2).to_pylist(), model, settings)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def report(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return extracted(pages, fit(pages, settings), settings)
