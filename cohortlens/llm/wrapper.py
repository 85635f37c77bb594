"""HTML main text by wrapper induction.

1. Every page becomes a tree of its block-level nodes; runs of equal siblings (list items, paragraphs) are one
   repeated node. Navigation, headers outside the article, footers, sidebars, notices, adverts, forms,
   scripts, styles and comment sections are known by tag, role, class or id and never content.
2. Pages of a host with the same containers outside the article are a layout. A page is aligned by simple tree
   matching with the reference page of its layout, or of the host's largest one if its own has too few pages;
   besides, nodes of all the host's pages with the same path of labels are one node. A text that stands at
   such a node on most of the distinct pages that have the node is constant.
3. Constant nodes are template, varying slots are content: blocks of the marked article (else of the marked
   main part, else of the whole body) that are not constant. If a large part of a page's words
   (or of a marked article's blocks) is constant, the page is a near copy of others. All near copies of a host count
   as one page, and the induction is repeated until it finds no more of them; a marked article of that kind stays whole.

Only trees (tags and text hashes) are shuffled for the induction; a host's pages are dealt to many groups,
each with a copy of its reference tree, and stream through one at a time.

Defined results: null or empty html gives an empty text; a null url has an empty host; a host with fewer than
``LEAST_PAGES`` distinct pages has no template; copies of a page count once in the induction and get equal texts; repeated
rows are kept; an empty table gives no rows. White space in a block becomes one space, blocks are joined by one newline in page order.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.urls import split_url
from cohortlens.session import materialize

LEAST_PAGES, CONSTANT_SHARE, COPY_SHARE, COPY_WORDS = 5, 0.8, 0.3, 0.6
GROUP_PAGES = 512  # pages of a host aligned in one group
CONTAINERS = {"#", "html", "body", "main", "article", "section", "div", "header", "hgroup", "center"}  # what makes a layout
MOST_DEPTH = 64  # deeper nodes stand under their ancestor of that depth
#: Names of HTML.
RAW = ("script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes", "template", "noscript", "svg", "math", "object", "select", "button")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"html", "head", "body", "address", "article", "aside", "blockquote", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "legend", "li", "main", "menu",
         "nav", "ol", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: A start tag ends an open element of the second kind (up to the third as its limit).
ENDS = {"li": ("li", {"ul", "ol", "menu"}), "dd": ("dd dt", {"dl"}), "dt": ("dd dt", {"dl"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
        "tr": ("tr", {"table"}), "option": ("option", {"select"})}
#: What marks a part that is not the article. Words stand for whole class names or ids; a part of a hyphenated one
#: counts as its first part (``PREFIXES``) or its last (``SUFFIXES``), unless another part denies it (``DENIALS``).
OUTSIDE_TAGS = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "search"}
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
COMMENT_WORDS = {"comments", "comment", "commentlist", "comment-list", "comments-area", "reader-comments", "user-comments", "respond", "disqus", "replies"}
ADVERT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "ad-slot", "ad-banner", "ad-box", "ad-unit",
                "ad-container", "ad-wrapper", "ad-label"}
OUTSIDE_WORDS = COMMENT_WORDS | ADVERT_WORDS | {
    "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "newsletter", "subscribe", "sidebar", "widget", "menu", "nav",
    "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "share", "sharing", "social", "related", "recommended", "pagination",
    "login", "signup", "toolbar", "skip", "skip-link", "related-posts", "related-articles", "related-stories", "related-links", "share-buttons", "share-links",
    "share-bar", "social-links", "social-media", "social-share"}
PREFIXES = {"advert", "adverts", "advertisement", "cookie", "cookies", "gdpr", "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs",
            "footer", "masthead", "comments", "commentlist", "disqus", "newsletter", "popup", "pagination", "toolbar"}
SUFFIXES = PREFIXES | {"ad", "ads", "advertising", "banner", "consent", "notice", "modal", "widget"}
DENIALS = {"has", "have", "no", "non", "not", "without", "with", "is", "below", "above", "before", "after", "hide", "show"}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _is_mark(word: str) -> bool:
    """Whether a class name or id tells a part that is not the article."""
    if word in OUTSIDE_WORDS:
        return True
    parts = re.split(r"[-_]+", word)
    return len(parts) > 1 and not DENIALS & set(parts) and (parts[0] in PREFIXES or parts[-1] in SUFFIXES)


@lru_cache(maxsize=4096)
def _mark(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """(label in the tree, outside the article, marked as the main part) of a start tag. Attributes are read one after
    another, so that nothing within a value counts as one; of equal names the first holds."""
    seen: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(attributes):
        seen.setdefault(name.lower(), "".join(values))
    marks = [w for name in ("class", "id") for w in seen.get(name, "").lower().split()]
    role = seen.get("role", "").strip().lower()
    if tag in ("html", "body", "main"):
        outside = False
    elif tag == "article":  # also what readers and advertisers write may stand in one
        outside = any(w in COMMENT_WORDS or w in ADVERT_WORDS for w in marks)
    else:
        outside = any(map(_is_mark, marks))
    outside = outside or tag in OUTSIDE_TAGS or role in OUTSIDE_ROLES or "hidden" in seen
    words = {w for m in marks for w in re.split(r"[^a-z0-9]+", m)} - {""}
    named = [] if tag in ("html", "body") else sorted(w for w in words if not w.isdigit())  # theirs vary by page
    return ".".join([tag, *named]), outside, role == "main"


class Page:
    """A parsed page. ``blocks``: (text, 0 plain, 1 in the main part, 2 in the article) of what may be content, in page order;
    ``tree``: [label, children, numbers of own blocks]."""

    def __init__(self, text: str):
        self.blocks: list[tuple[str, int]] = []
        self.tree: list = ["#", [], []]
        stack = [("#", self.tree, False, 0)]  # tag, node, outside, part
        pieces: list[str] = []
        unseen: list = []  # of an inline element that is outside the article: its tag, how often it is open, size of the stack

        def add(text: str) -> None:
            if not unseen:  # references do not go on over a tag
                pieces.append(entities.unescape(text) if "&" in text else text)

        def flush() -> None:
            if pieces:
                _, node, outside, part = stack[-1]
                if not outside:
                    whole = " ".join("".join(pieces).split())
                    if whole:
                        node[2].append(len(self.blocks))
                        self.blocks.append((whole, part))
                pieces.clear()

        at, n = 0, len(text)
        while at < n:
            m = TOKEN.search(text, at)
            if m is None:
                add(text[at:])
                break
            if m.start() > at:
                add(text[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            end, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
            if tag in RAW:
                if not end and not attributes.rstrip().endswith("/"):
                    close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(text, at)
                    at = close.end() if close else n
                continue
            if tag == "br":
                pieces.append(" ")
            if tag not in BLOCK:
                if unseen:
                    if tag == unseen[0]:
                        unseen[1] += -1 if end else 1
                        if not unseen[1]:
                            unseen.clear()
                elif not end and tag not in VOID and attributes and not attributes.rstrip().endswith("/") and _mark(tag, attributes)[1]:
                    unseen[:] = [tag, 1, len(stack)]
                continue
            flush()
            if tag in VOID:
                continue
            if end:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                if unseen and len(stack) < unseen[2]:  # its block has ended
                    unseen.clear()
                continue
            if any(s[0] == "p" for s in stack[-3:]):  # a block ends an open paragraph
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        del stack[i:]
                        break
            if tag in ENDS:
                own, limit = ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in limit:
                        break
                    if stack[i][0] in own.split():
                        del stack[i:]
                        break
            label, outside, is_main = _mark(tag, attributes)
            _, parent, above, part = stack[-1]
            if unseen and len(stack) < unseen[2]:
                unseen.clear()
            outside = above or outside or bool(unseen) or (tag == "header" and part < 2)
            part = max(part, 2 if tag == "article" else 1 if tag == "main" or is_main else 0)
            if outside or len(stack) > MOST_DEPTH:
                node = parent
            elif parent[1] and parent[1][-1][0] == label and not parent[1][-1][1] and tag not in ("article", "main", "div", "section"):
                node = parent[1][-1]  # a run of equal siblings is one repeated node
            else:
                node = [label, [], []]
                parent[1].append(node)
            stack.append((tag, node, outside, part))
        flush()


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _own(page: Page) -> dict[int, int]:
    """block -> words, of the blocks that main_text takes from."""
    part = max((p for _, p in page.blocks), default=0)
    return {i: text.count(" ") + 1 for i, (text, p) in enumerate(page.blocks) if p == part}


def skeleton(page: Page) -> str:
    """The tree with numbered nodes and text hashes: [label, children, [[block, hash, words if it may be content], ...]]."""
    own = _own(page)

    def plain(node: list) -> list:
        return [node[0], [plain(c) for c in node[1]], [[b, _hash(page.blocks[b][0]), own.get(b, 0)] for b in node[2]]]
    return json.dumps(plain(page.tree), separators=(",", ":"))


class _Shapes:
    """Numbers for the distinct shapes of trees: (label, shapes of the children, nodes)."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.of: list[tuple[str, tuple[int, ...], int]] = []

    def add(self, tree: list) -> int:
        """The shape of a tree; children before parents, without recursion."""
        done: list[int] = []
        todo = [(tree, False)]
        while todo:
            node, ready = todo.pop()
            if not ready:
                todo.append((node, True))
                todo += [(c, False) for c in reversed(node[1])]
                continue
            n = len(node[1])
            own = tuple(done[len(done) - n:])
            del done[len(done) - n:]
            key = (node[0], own)
            if key not in self.number:
                self.number[key] = len(self.of)
                self.of.append((node[0], own, 1 + sum(self.of[c][2] for c in own)))
            done.append(self.number[key])
        return done[0]


def align(a: list, b: list) -> dict[int, int]:
    """Simple tree matching of tree ``a`` with tree ``b``: node number of a (preorder) -> node number of b, so that
    labels are equal, order and ancestry are kept, and the number of matched nodes is the largest.

    Subtrees of the same shape are compared once. Of two lists of children the common beginning and end match as they
    are (never worse than any other match of theirs); the rest takes one vector step a child."""
    shapes = _Shapes()
    first, second = shapes.add(a), shapes.add(b)
    known: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def match(x: int, y: int) -> int:
        """The most nodes that match, roots included."""
        if shapes.of[x][0] != shapes.of[y][0]:
            return 0
        if x == y:
            return shapes.of[x][2]
        if (x, y) not in known:
            pairs = children(shapes.of[x][1], shapes.of[y][1])
            known[x, y] = 1 + sum(match(shapes.of[x][1][i], shapes.of[y][1][j]) for i, j in pairs), pairs
        return known[x, y][0]

    def children(xs: tuple[int, ...], ys: tuple[int, ...]) -> list[tuple[int, int]]:
        head = 0
        while head < min(len(xs), len(ys)) and xs[head] == ys[head]:
            head += 1
        tail = 0
        while tail < min(len(xs), len(ys)) - head and xs[-1 - tail] == ys[-1 - tail]:
            tail += 1
        ends = [(i, i) for i in range(head)] + [(len(xs) - k, len(ys) - k) for k in range(tail, 0, -1)]
        xs, ys = xs[head:len(xs) - tail], ys[head:len(ys) - tail]
        if xs and ys:
            right, column = np.unique(np.array(ys), return_inverse=True)
            left, row = np.unique(np.array(xs), return_inverse=True)
            weights = np.array([[match(int(x), int(y)) for y in right] for x in left], dtype=np.int64)[:, column]
            ends += [(head + i, head + j) for i, j in _best_pairs(weights, row.tolist(), 0, 0)]
        return sorted(ends)

    out: dict[int, int] = {}
    if not match(first, second):
        return out
    todo = [(first, 0, second, 0)]
    while todo:
        x, i, y, j = todo.pop()
        out[i] = j
        xs, ys = shapes.of[x][1], shapes.of[y][1]
        at, to = _starts(shapes, xs, i), _starts(shapes, ys, j)
        pairs = zip(range(len(xs)), range(len(xs)), strict=True) if x == y else known[x, y][1]
        todo += [(xs[p], at[p], ys[q], to[q]) for p, q in pairs if match(xs[p], ys[q])]
    return out


def _starts(shapes: _Shapes, children: tuple[int, ...], number: int) -> list[int]:
    """The preorder numbers of the children of node ``number``."""
    out, at = [], number + 1
    for c in children:
        out.append(at)
        at += shapes.of[c][2]
    return out


MOST_CELLS = 1 << 20  # of a table of scores that is held whole


def _best_pairs(weights: np.ndarray, rows: list[int], top: int, left: int) -> list[tuple[int, int]]:
    """The pairs (row, column) in rising order with the largest total of ``weights[rows[row]][column]``. A table over
    MOST_CELLS is cut in two at the column through which a best path goes (Hirschberg's method), so memory is bounded."""
    n, m = len(rows), weights.shape[1]

    def forward(ws: np.ndarray, order: list[int], keep: list | None = None) -> np.ndarray:
        last = np.zeros(m + 1, dtype=np.int64)
        for r in order:
            new = last.copy()
            np.maximum.accumulate(np.maximum(last[1:], last[:-1] + ws[r]), out=new[1:])
            last = new
            if keep is not None:
                keep.append(last)
        return last

    if not n or not m:
        return []
    if n > 1 and n * m > MOST_CELLS:
        half = n // 2
        up, down = forward(weights, rows[:half]), forward(weights[:, ::-1], rows[:half - 1:-1])
        cut = int((up + down[::-1]).argmax())
        return _best_pairs(weights[:, :cut], rows[:half], top, left) + _best_pairs(weights[:, cut:], rows[half:], top + half, left + cut)
    best = [np.zeros(m + 1, dtype=np.int64)]
    forward(weights, rows, best)
    out, p, q = [], n, m
    while p and q:
        w = weights[rows[p - 1]][q - 1]
        if w and best[p][q] == best[p - 1][q - 1] + w:
            out.append((top + p - 1, left + q - 1))
            p, q = p - 1, q - 1
        elif best[p][q] == best[p - 1][q]:
            p -= 1
        else:
            q -= 1
    return out[::-1]


def _numbered(node: list, number: int, sizes: dict[int, int]) -> list[tuple[list, int]]:
    out, at = [], number + 1
    for c in node[1]:
        out.append((c, at))
        at += sizes[id(c)]
    return out


def _sizes(tree: list) -> dict[int, int]:
    """Nodes of every subtree, by the identity of its root."""
    order, todo = [], [tree]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node[1]
    out: dict[int, int] = {}
    for node in reversed(order):
        out[id(node)] = 1 + sum(out[id(c)] for c in node[1])
    return out


def layout(tree: list) -> int:
    """Of the paths of containers, as a set, down to the article or main part: what the text holds does not count."""
    paths, todo = set(), [(tree, 0)]
    while todo:
        node, above = todo.pop()
        tag = node[0].split(".")[0]
        if tag in CONTAINERS:
            paths.add(path := _hash(f"{above}/{node[0]}"))
            if tag not in ("article", "main"):
                todo += [(c, path) for c in node[1]]
    return _hash(" ".join(map(str, sorted(paths))))


def _trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for page in map(Page, batch["html"]):
            own = _own(page)
            rows.append((layout(page.tree), sum(own.values()), len(own), any(p for _, p in page.blocks), skeleton(page)))
        out = pd.DataFrame(rows, columns=["layout", "words", "own", "marked", "tree"])
        yield pd.concat([batch[["host", "k"]].reset_index(drop=True), out], axis=1)


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (host, layout, salt, is_page, k, tree), the reference first: (host, k, node, block, hash, words).

    ``node`` stands for a node of the reference or for a path of labels; one without text gives block -1."""
    key, first, reference = None, None, None
    for batch in batches:
        out = []
        for h, lay, is_page, k, tree in zip(batch["host"], batch["layout"], batch["is_page"], batch["k"], batch["tree"], strict=True):
            if not is_page:
                key, first, reference = (h, lay), k, json.loads(tree)
            elif (h, lay) == key:
                own = json.loads(tree)
                nodes = align(own, reference)
                todo, empty, sizes = [(own, 0, 0)], set(), _sizes(own)
                while todo:
                    node, i, above = todo.pop()
                    path = _hash(f"{above}/{node[0]}")
                    same = [path, _hash(f"{first}:{nodes[i]}")] if i in nodes else [path]
                    out += [(h, k, at, block, text, words) for block, text, words in node[2] for at in same]
                    if not node[2]:
                        empty.update(same)
                    todo += [(c, j, path) for c, j in _numbered(node, i, sizes)]
                out += [(h, k, at, -1, 0, 0) for at in empty]
        yield pd.DataFrame(out, columns=["host", "k", "node", "block", "hash", "words"]).astype({c: "int64" for c in ("k", "node", "block", "hash", "words")})


def induce(pages: DataFrame) -> DataFrame:
    """(host, html, k) -> (k, constant): the numbers of the blocks of page content ``k`` that are its host's template.

    ``k`` stands for the pair of host and html, so that copies count once."""
    trees = materialize(pages.where("host != '' and length(html) > 0").select("host", "k", "html").mapInPandas(_trees, "host string, k long, layout long, words long, own long, marked boolean, tree string")
                        .dropDuplicates(["k"]), "wrapper-trees")
    layouts = trees.groupBy("host", "layout").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    hosts = layouts.groupBy("host").agg(F.sum("n").alias("pages"), F.min(F.struct(-F.col("n"), "k", "layout")).alias("most")).where(F.col("pages") >= LEAST_PAGES)
    # Pages of small layouts go with the host's largest one.
    layouts = layouts.join(hosts, "host").withColumn("goal", F.when(F.col("n") >= LEAST_PAGES, F.col("layout")).otherwise(F.col("most.layout")))
    layouts = materialize(layouts.select("host", "layout", "goal", "n", F.when(F.col("layout") == F.col("most.layout"), F.col("most.k")).otherwise(F.col("k")).alias("first")), "wrapper-layouts")
    goals = layouts.groupBy("host", "goal").agg(F.ceil(F.sum("n") / GROUP_PAGES).cast("int").alias("salts"))
    goals = goals.join(layouts.where("layout = goal").select("host", "goal", "first"), ["host", "goal"])
    references = goals.join(trees.select("k", "tree"), F.col("first") == F.col("k")).select(
        "host", F.col("goal").alias("layout"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("is_page"), "k", "tree")
    own = trees.join(layouts.select("host", "layout", "goal").join(goals.select("host", "goal", "salts"), ["host", "goal"]), ["host", "layout"]).select(
        "host", F.col("goal").alias("layout"), F.pmod("k", F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("is_page"), "k", "tree")
    rows = references.unionByName(own).repartition("host", "layout", "salt").sortWithinPartitions("host", "layout", "salt", "is_page")
    blocks = materialize(rows.mapInPandas(_aligned, "host string, k long, node long, block long, hash long, words long"), "wrapper-blocks")
    copies = None
    while True:  # each round but the last finds more near copies
        units = blocks.withColumn("copy", F.lit(False))
        if copies is not None:
            units = blocks.join(copies.withColumn("copy", F.lit(True)), "k", "left").withColumn("copy", F.coalesce("copy", F.lit(False)))
        n = F.count_distinct(F.when(~F.col("copy"), F.col("k"))) + F.max(F.col("copy").cast("int"))
        texts = units.where("block >= 0").groupBy("host", "node", "hash").agg(n.alias("n")).where(F.col("n") >= CONSTANT_SHARE * LEAST_PAGES)
        having = units.groupBy("host", "node").agg(n.alias("having")).where(F.col("having") >= LEAST_PAGES)
        constant = texts.join(having, ["host", "node"]).where(F.col("n") >= CONSTANT_SHARE * F.col("having")).select("host", "node", "hash")
        found = blocks.where("block >= 0").join(constant, ["host", "node", "hash"]).groupBy("k").agg(F.collect_set(F.struct("block", "words")).alias("found"))
        found = materialize(found, "wrapper-constant")
        same = F.aggregate("found", F.lit(0).cast("long"), lambda acc, x: acc + x["words"])
        n_same = F.size(F.filter("found", lambda x: x["words"] > 0))
        more = found.join(trees.select("k", F.col("words").alias("all"), "own", "marked"), "k").where(
            (F.col("all") > 0) & ((same >= COPY_WORDS * F.col("all")) | (F.col("marked") & (n_same > COPY_SHARE * F.col("own"))))).select("k")
        more = materialize(more if copies is None else more.join(copies, "k", "left_anti"), "wrapper-copies")
        if more.isEmpty():
            return found.select("k", F.col("found.block").alias("constant"))
        copies = more if copies is None else copies.unionByName(more)


def main_text(page: Page, constant: set[int]) -> str:
    """The content blocks of a page, given its template's blocks."""
    part = max((p for _, p in page.blocks), default=0)
    own = [i for i, (_, p) in enumerate(page.blocks) if p == part]
    varying = [i for i in own if i not in constant]
    if part and len(own) - len(varying) > COPY_SHARE * len(own):
        varying = own
    return "\n".join(page.blocks[i][0] for i in varying)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [main_text(Page(h), set(c) if c is not None else set()) if h else "" for h, c in zip(batch.pop("__html"), batch.pop("__constant"), strict=True)]
        batch["text"], batch["n_chars"] = texts, [len(t) for t in texts]
        yield batch


def extract(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``df`` without ``html``, with text and n_chars (code points)."""
    keep = [c for c in df.columns if c not in (html, "text", "n_chars")]
    host, _ = split_url(F.col(url))
    rows = df.select(*keep, F.coalesce(F.col(html), F.lit("")).alias("__html"), host.alias("__host"))
    rows = rows.withColumn("__k", F.xxhash64("__host", "__html"))
    template = materialize(induce(rows.select(F.col("__host").alias("host"), F.col("__html").alias("html"), F.col("__k").alias("k"))), "wrapper-template")
    rows = rows.drop("__host").join(template.withColumnsRenamed({"k": "__k", "constant": "__constant"}), "__k", "left").drop("__k")
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep]
    return rows.mapInPandas(_extract, ", ".join([*schema, "text string", "n_chars long"]))
