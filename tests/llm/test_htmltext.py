from html.parser import HTMLParser

import duckdb
import pytest
from framelake.llm import htmltext

STORY = "The house was at the end of the road and it had been there for as long as anyone in the town could remember, with its door to the sea and the garden that was his."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";x(0);</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad 0 --><div class="ad">Buy the best of the best.</div>
<article><h1>A title</h1><p><b>{STORY}</b><br>Second&nbsp;line &amp; more</p><p>Short.<aside>Side notes</aside></p><div class="share">Share it</div><ul><li>One</li><li>Two</li></ul></article>
<section id="comments"><p>{STORY}</p></section><footer>&copy; us</footer></body></html>"""


def test_marked_article():
    assert htmltext.main_text(PAGE) == "\n".join(["A title", STORY + " Second line & more", "Short.", "One", "Two"])


def test_two_passes_without_a_marked_article():
    page = f"<div><a href=x>Menu</a> <a href=y>More</a></div><p>{STORY} {STORY}</p><p>A short one</p><p>{STORY} {STORY}</p><p>tiny</p><div>x1 y2 z3 q4 v5 lorem ipsum dolor amet consectetur adipiscing elit sed eiusmod tempor</div>"
    assert htmltext.main_text(page) == "\n".join([f"{STORY} {STORY}", "A short one", f"{STORY} {STORY}"])


def test_headings_captions_and_headers():
    page = f'<body><header><h1>Site</h1></header><div class="page-header">Name</div><h2>Title</h2><p>{STORY} {STORY}</p><h3>Comments</h3><div class="comments"><p>{STORY}</p></div></body>'
    assert htmltext.main_text(page) == f"Title\n{STORY} {STORY}"
    page = f'<main><div class="post-header"><h1>T</h1></div><figure><img><figcaption>cap</figcaption></figure><p>{STORY}</p><p class="notice">n</p></main>'
    assert htmltext.main_text(page) == f"T\ncap\n{STORY}"


def test_broken_markup():
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<") == ""
    assert htmltext.main_text("<article><p>open <b>end") == "open end"
    assert htmltext.main_text("<article><p title='a>b'>x < y</p><!-- never closed <p>z") == "x < y"
    assert htmltext.main_text("<article><p>a<p>b<p>c") == "a\nb\nc"


def test_query_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, t int"
    rows = [(1, "u", PAGE, "x", 1, 1), (2, None, None, None, 1, 1), (None, "v", "", None, 1, 1), (1, "u", PAGE, "x", 1, 1), (4, "w", "<article>" + "<p>word</p>" * 50_000, None, 1, 1)]
    out = htmltext.extract(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 5 and all(r["n_chars"] == len(r["text"]) for r in out)
    assert {r["page_id"]: r["n_chars"] for r in out}[4] == 5 * 50_000 - 1
    assert htmltext.extract(spark.createDataFrame([], schema)).count() == 0


def test_ordinary_pages_keep_their_article():
    article = f"<article><p>{STORY}</p></article>"
    for before in ("<script>for(i=0;i<n;i++){}</script>", "<style>a<b</style>", '<svg width="1"/>', "<object data='x'/>", "<math/>", '<script src="x"/></script>'):
        assert htmltext.main_text(f"<body>{before}{article}</body>") == STORY
    for attributes in ('style="overflow:hidden"', 'title="hidden role=search"', 'data-id="comments"', 'class="no-sidebar"', 'class="page has-sidebar"', 'class="sidebar"', 'id="menu-page"'):
        assert htmltext.main_text(f"<body><div {attributes}>{article}</div></body>") == STORY
    assert htmltext.main_text(f"<div {'title=x hidden'}>{article}</div>") == "" == htmltext.main_text(f"<nav>{article}</nav>")
    assert htmltext.main_text(f"{article}<div id=comments><article><p>A comment.</p></article></div>") == STORY


def test_layout_classes_raw_tags_and_quotes():
    two = f"<p>{STORY} {STORY}</p><p>{STORY} {STORY}</p>"
    text = f"{STORY} {STORY}\n{STORY} {STORY}"
    for page in (
        f'<div class="content has-sidebar">{two}</div>',
        f'<div class="content has-sidebar"><article>{two}</article></div>',
        f'<head><title>never ends<body><article>{two}</article>',
        f"<title>never ends<article>{two}</article><svg><title>x</title></svg>",
        f'<script>never ends<article>{two}</article>',
        f"<p class=x title=it's>{STORY} {STORY}<p data-x=\"a'b>c\">{STORY} {STORY}",
        f'<article><p class="market-share">{STORY} {STORY}</p><div class="sharing">Share</div><p>{STORY} {STORY}</p></article>',
        f'<div>{two}</div><article>A teaser for another page.</article>',
        f'<div class="siteFooter">{two}</div><div>{two}</div>',
    ):
        assert htmltext.main_text(page) == text
    for icon in ('<svg class="i"/>', "<iframe src=x />", "<object/>"):
        assert htmltext.main_text(f"<article><p>Before</p>{icon}<p>After</p></article>") == "Before\nAfter"


def test_text_without_spaces_is_judged_by_length_and_links():
    prose = "\u4e2d\u6587\u6bb5\u843d" * 105
    assert htmltext.main_text(f"<div><a href=x>\u9996\u9875</a></div><div>{prose}</div>") == prose
    russian = " ".join(["\u0434\u043e\u043c"] * 100)
    assert htmltext.main_text(f"<ul><li><a href=x>{russian}</a></li></ul><p>{russian}</p>") == russian


TWO = f"<h1>Title</h1><p>{STORY} {STORY}</p><p>{STORY} {STORY}</p>"
TEXT = f"Title\n{STORY} {STORY}\n{STORY} {STORY}"
MENU = '<nav><a href=x>Home</a></nav><div class="menu">Menu</div>'


@pytest.mark.parametrize("open_, close", [
    ("<form action=x>", "</form>"), ('<form><div id="aspnet">', "</div></form>"), ('<div id="page" class="menu-closed">', "</div>"), ('<div class="sidebar-right">', "</div>"),
    ('<div class="post comments-open">', "</div>"), ('<div class="post comments-open"><div class="sidebar-right"><form>', "</form></div></div>"),
])
def test_wrapped_pages_keep_their_text(open_, close):
    inner = f'{MENU}%s<section id="comments"><p>{STORY} {STORY}</p></section><aside><p>{STORY} {STORY}</p></aside><footer>{STORY} {STORY}</footer>'
    for body in (TWO, f"<article>{TWO}</article>"):
        assert htmltext.main_text(f"<body>{open_}{inner % body}{close}</body>") == TEXT
    # the mark counts where the page has its text elsewhere
    for body in (f"<div>{TWO}</div>", f"<article>{TWO}</article>"):
        assert htmltext.main_text(f'<body>{body}{open_}<p>{STORY} {STORY}</p>{close}</body>') == TEXT


def test_deeply_wrapped_pages_take_linear_time():
    assert htmltext.main_text('<div class="menu-x">' * 20_000 + TWO) == TEXT


def test_adverts_and_unseen_parts_of_an_article():
    for part in (
        '<div class="google-ad">Buy it now</div>', '<div class="adsbygoogle">Buy it now</div>', '<div style="color:red; display:none">Not seen</div>', '<ol class="commentlist"><li>Nice one</li></ol>',
        '<p><span class="advertisement">Buy <span>it</span> now</span></p>', '<p><span style="visibility: hidden">Not seen</span></p>', "<p><b hidden>Not seen</b></p>",
    ):
        assert htmltext.main_text(f"<article>{TWO}{part}<p>{STORY}</p></article>") == f"{TEXT}\n{STORY}"
    assert htmltext.main_text(f'<article><p>{STORY} <span class="promo">Buy it<p>{STORY}</article>') == f"{STORY}\n{STORY}"
    assert htmltext.main_text(f'<article><p>{STORY}</p><pre><span class="token comment"># kept</span> x</pre></article>') == f"{STORY}\n# kept x"


def test_link_lists_in_an_article():
    links = "".join(f"<li><a href=/{k}>Another story {k}</a></li>" for k in range(3))
    assert htmltext.main_text(f"<article>{TWO}<h3>More stories</h3><ul>{links}</ul><p>{STORY}</p><h3>End</h3></article>") == f"{TEXT}\n{STORY}\nEnd"
    names = "Alpha 1, Beta 2, Gamma 3, Delta 4, Epsilon 5, Zeta 6, Eta 7, Theta 8, Iota 9, Kappa 10"
    # without stop words a block goes by its neighbours
    assert htmltext.main_text(f"<article>{TWO}<ul>{links}</ul><p>{names}</p><ul>{links}</ul></article>") == TEXT
    assert htmltext.main_text(f"<article>{TWO}<p>{names}</p><ul>{links}</ul></article>") == f"{TEXT}\n{names}"
    assert htmltext.main_text(f"<article>{TWO}<p><a href=x>One source</a></p><p>Short.</p></article>") == f"{TEXT}\nOne source\nShort."
    assert htmltext.main_text(f"<article><ul>{links}</ul></article>").count("\n") == 2


def test_short_paragraphs_without_an_article():
    said = [f"It was {k} in the hall, and he was not with her." for k in range(30)]
    page = f"<body>{MENU}<ul><li>Red 1</li><li>Blue 2</li></ul><hr>{''.join(f'<p>{x}</p>' for x in said)}</body>"
    assert set(said) <= set(htmltext.main_text(page).split("\n"))
    assert htmltext.main_text("<ul>" + "".join(f"<li>Model {k} 4 GB black</li>" for k in range(30)) + "</ul>") == ""


class Plain(HTMLParser):
    """The article's blocks by the standard library's parser, for pages that mark all their boilerplate by tag or class."""

    BLOCK = set("article h1 h2 h3 p ul li div section blockquote table tr td aside figure figcaption header form".split())
    SKIP = set("nav aside form footer script style".split())

    def __init__(self):
        super().__init__()
        self.blocks, self.now, self.inside, self.skip = [], [], False, []

    def cut(self):
        text = " ".join("".join(self.now).split())
        self.blocks += [text] if text else []
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag == "br":
            self.now.append("\n")
        if tag in self.BLOCK:
            self.cut()
        if self.skip or tag in self.SKIP or set((dict(attrs).get("class") or "").split()) & {"ad", "comments", "share"}:
            if tag not in htmltext.VOID:
                self.skip.append(tag)

    def handle_endtag(self, tag):
        if tag in self.BLOCK:
            self.cut()
        if self.skip and self.skip[-1] == tag:
            self.skip.pop()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.now.append(data)


@pytest.fixture(scope="module")
def real_pages():
    path = "/root/testdata/sf0.01/pages.parquet"
    try:
        return [r[0] for r in duckdb.sql(f"SELECT html FROM '{path}'").fetchall()]
    except duckdb.IOException:
        pytest.skip("no test data")


def test_a_plain_second_implementation_agrees(real_pages):
    for page in real_pages:
        plain = Plain()
        plain.feed(page)
        plain.cut()
        assert htmltext.main_text(page) == "\n".join(plain.blocks)


def test_every_block_is_classified(real_pages):
    """The first pass decides long blocks of the article, the second one the short ones."""
    seen = set()
    for page in real_pages:
        for b in htmltext.classified(page):
            assert b.label in ("good", "bad")
            seen.add((b.inside, b.first, b.label))
    assert {(True, "good", "good"), (True, "short", "good"), (False, "bad", "bad")} <= seen
