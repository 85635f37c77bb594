"""Main text: planted layouts, the bundled pages, template induction."""

import html
import random
import re
import time

import pytest

wrapper = pytest.importorskip("cohortlens.llm.wrapper")


def text(page):
    return wrapper.main_text(wrapper.Page(page), set())


def test_layout():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>x";</script><style>p{}</style></head><body class="nav">
    <header><h1>Site</h1></header><nav><ul><li><a>Menu</a></ul></nav><div id="cookie-notice">We use cookies</div>
    <article><header><h1>Title &amp; more</h1></header><p>First <b>bold</b>\n text&nbsp;here.<p>Second<br>line &lt;tag&gt; a < b
    <div class="ad banner">Buy</div><ul><li>one<li>two</ul><form><input>Name</form><!-- <p>no</p> --><p title="a>b">Quoted</p>
    <section class="comments"><p>Reader says</p></section></article><aside>Side</aside><footer>&copy; X</footer></body></html>"""
    assert text(page) == "Title & more\nFirst bold text here.\nSecond line <tag> a < b\none\ntwo\nQuoted"


def test_odd_markup():
    assert text("") == "" and text("plain text") == "plain text" and text("<") == "<" and text("<p") == "<p"
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text("<script>never closed <p>x") == "" and text("<p>a</b></div></p>b") == "a\nb"
    assert text("<main><p>m</p></main><p>out</p>") == "m" and text("<p>&#x41;&eacute;&xyzzy;</p>") == "Aé&xyzzy;"
    long = " ".join(f"w{i}" for i in range(100_000))
    assert text(f"<article><p>{long}</p></article>") == long


def test_align_is_order_and_ancestry_preserving():
    a = ["#", [["x", [["p", [], []], ["q", [], []]], []], ["y", [], []]], []]
    b = ["#", [["z", [], []], ["x", [["q", [], []]], []], ["y", [], []]], []]
    assert wrapper.align(a, b) == {0: 0, 1: 2, 3: 3, 4: 4}


def test_induction_removes_constant_nodes(spark):
    rows = []
    for i in range(40):
        body = "".join(f"<p>Paragraph {i} number {k} of the story.</p>" for k in range(4))
        rows.append((i, "http://blog.example.com/%d" % i, f"<body><div><span>My Blog</span></div><div><h2>Story {i}</h2>{body}</div><div>All rights reserved</div></body>"))
        marked = f"<article><h1>Story {i}</h1>{body}<div>Thanks for reading our stories</div></article>"
        rows.append((100 + i, "http://news.example.com/%d" % i, f"<body>{marked}</body>"))
        rows.append((200 + i, "http://copies.example.com/", "<article><h1>Same</h1><p>Same story.</p></article>"))
        rows.append((300 + i, "http://near.example.com/", f"<article><h1>Same</h1><p>Same story.</p><p>More.</p><p>{i}</p></article>"))
    rows += [(400, "http://blog.example.com/0", None), (401, None, "<p>no host</p>"), (402, "http://alone.example.com/", "<div>Alone</div>"), rows[0], (None, "u", "")]
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, host string").repartition(4)
    out = wrapper.extract(df).collect()
    assert len(out) == len(rows) and all(r["host"] == "own" and r["n_chars"] == len(r["text"]) for r in out)
    got = {r["page_id"]: r["text"] for r in out}
    for i in range(40):
        story = f"Story {i}\n" + "\n".join(f"Paragraph {i} number {k} of the story." for k in range(4))
        assert got[i] == story and got[100 + i] == story
        assert got[200 + i] == "Same\nSame story." and got[300 + i] == f"Same\nSame story.\nMore.\n{i}"
    assert (got[400], got[401], got[402], got[None]) == ("", "no host", "Alone", "")


def test_induction_over_several_layouts(spark):
    """Two layouts in equal parts, some error pages, body classes that vary by page; nothing is marked."""
    rows, wanted = [], {}
    for i in range(24):
        body = "".join(f"<p>Paragraph {i} number {k} of the story.</p>" for k in range(4))
        story = f"Story {i}\n" + "\n".join(f"Paragraph {i} number {k} of the story." for k in range(4))
        a = f"<div class='top'><p>Front page</p></div><div><h2>Story {i}</h2>{body}</div><div><p>All rights reserved</p></div>"
        b = f"<section><div><h2>Story {i}</h2>{body}</div><div><p>Write to the editor</p></div></section>"
        extra = "".join(f"<div class='c{chr(97 + i)}{k}'></div>" for k in range(i % 3))  # layouts of few pages
        rows.append((i, f"http://two.example.com/{i}", f"<body class='slug{chr(97 + i)}' id='x{i}y'>{b if i % 2 else a}{extra}</body>"))
        wanted[i] = story
    rows += [(100 + i, f"http://two.example.com/e{i}", f"<body><center>Error {i}</center></body>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == wanted | {100 + i: f"Error {i}" for i in range(3)}


def test_near_copies_without_marks(spark):
    """Pages of which nearly all are near copies keep their shared paragraphs; what other pages have too is template."""
    shared = [f"Shared paragraph number {k} of the notice that was copied." for k in range(4)]
    rows, wanted = [], {}

    def add(n, host, blocks, foot=""):
        rows.append((n, f"http://{host}.example.com/{n}", "<body><div>" + "".join(f"<p>{b}</p>" for b in blocks) + f"</div>{foot}</body>"))
        wanted[n] = "\n".join(blocks)
    for i in range(12):
        add(i, "unmarked", [*shared, f"Only page {i} says so."])
        add(100 + i, "whole", shared if i < 10 else [f"Text {i}."], f"<hr><img src='{i}'>")  # all blocks are shared
    foot = "<section><p>All rights reserved</p></section>"
    for i in range(120):
        add(200 + i, "mixed", [*shared, f"Copy {i}."], foot)
    for i in range(24):  # near copies of another text, found once the first ones count as one page
        add(400 + i, "mixed", [f"Another text, of which copies stand here too, part {k}." for k in range(4)] + [f"Other {i}."], foot)
    for i in range(5):
        add(500 + i, "mixed", [f"Page {i} has paragraph {k} of its own." for k in range(4)], foot)
    out = wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert {r["page_id"]: r["text"] for r in out} == wanted


def test_bundled_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in wrapper.extract(df).collect()}
    for r in df.collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_empty_table(spark):
    assert wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_marks_are_whole_names_in_their_own_attributes():
    body = "<p>First words.</p><p>Second words.</p>"
    for wrap in ('<div class="content has-sidebar">', '<div class="no-sidebar">', '<div title="the hidden truth">', "<div data-x='class=ad'>", '<div title=" id=footer ">',
                 '<div class="advice">', '<section id="related-work">', '<div class="share-price">', '<div data-role="navigation">', '<div class="below-navbar">'):
        close = "</" + wrap[1:].split()[0] + ">"
        assert text(f"<article>{wrap}{body}{close}</article>") == "First words.\nSecond words.", wrap
        assert text(f"{wrap}<article>{body}</article>{close}") == "First words.\nSecond words.", wrap
    for wrap in ('<div class="site-nav">', "<div class=sidebar-left>", '<div class="x Cookie-Notice">', '<section id="comments">', '<div class="comment-list">', '<div hidden>',
                 '<div role="Navigation ">', '<div class="top_ad">', '<div class="related-posts">', '<article class="comment">', '<article class="story promo">'):
        close = "</" + wrap[1:].split()[0].rstrip(">") + ">"
        assert text(f"<article>{body}{wrap}<p>Not this.</p>{close}</article>") == "First words.\nSecond words.", wrap
    assert text('<article class="comment"><p>Reader.</p></article><article><p>Story.</p></article><article class="comment"><p>Other.</p></article>') == "Story."
    assert text('<body class="comment nav"><main id="menu"><p>Story.</p></main></body>') == "Story."


def test_inline_marks():
    assert text('<article><p>One <span class="advert">Buy <b>now</b> <span>here</span>!</span>two.</p><p>Three</p></article>') == "One two.\nThree"
    assert text('<article><p>One <span class="advert">never closed</p><p>Two</p></article>') == "One\nTwo"
    assert text('<article><a class="ad"><div>Buy</div><p>it</p></a><p>Two</p></article>') == "Two"
    assert text('<article><p>x<img class="ad">y<br class="ad">z</p></article>') == "xy z"


def test_references_end_at_tags():
    assert text("<p>AT&<b>amp;</b> T&amp;<i>lt;</i> &am<!-- x -->p; a&amp;b</p>") == "AT&amp; T&lt; &amp; a&b"


def plain_align(a, b):
    """The most matched nodes, by the textbook recursion."""
    if a[0] != b[0]:
        return 0
    best = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for p, c in enumerate(a[1]):
        for q, d in enumerate(b[1]):
            best[p + 1][q + 1] = max(best[p][q] + plain_align(c, d), best[p][q + 1], best[p + 1][q])
    return 1 + best[-1][-1]


@pytest.mark.parametrize("most_cells", [1 << 20, 3])
def test_align_is_optimal(monkeypatch, most_cells):
    rng = random.Random(5)
    monkeypatch.setattr(wrapper, "MOST_CELLS", most_cells)

    def tree(depth):
        return [rng.choice("xy") if depth < 4 else "#", [tree(depth - 1) for _ in range(rng.randint(0, 5))] if depth else [], []]

    def flat(t, parent, out):
        out.append((t[0], parent))
        me = len(out) - 1
        for c in t[1]:
            flat(c, me, out)
        return out

    for _ in range(150):
        a, b = tree(4), tree(4)
        got = wrapper.align(a, b)
        fa, fb = flat(a, -1, []), flat(b, -1, [])
        assert len(got) == plain_align(a, b)
        assert all(fa[i][0] == fb[j][0] and (i == 0 or got[fa[i][1]] == fb[j][1]) for i, j in got.items())
        pairs = sorted(got.items())
        assert all(x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def test_align_of_long_pages_is_fast():
    page = lambda n, k: wrapper.Page("<article>" + "".join(f"<h2>t{i}</h2><p>words {i}</p>" + ("<ul><li>x</li></ul>" if i % k == 0 else "") for i in range(n)) + "</article>").tree
    start = time.time()
    assert len(wrapper.align(page(5000, 7), page(5000, 5))) > 10_000
    assert time.time() - start < 4
