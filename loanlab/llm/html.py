"""Operator 10: main-text extraction by gradient-boosted trees over DOM nodes.

A page is parsed into block elements and text blocks (runs of inline content).  Each node has
features of its subtree (text, link and tag density, share of the page), its attribute tokens and
those of its ancestors, its depth and its siblings.  Boosted trees (Spark ML, fitted once on a bounded
sample) give the probability that a node holds main text.  Decoding is hierarchical: going up
the tree, a subtree is either dropped whole or its root is kept and its children choose for
themselves, whichever has the higher likelihood; so nothing is kept inside a dropped node, and no
node is kept without its ancestors.

Training rows come from ``SAMPLE`` pages at most (drawn by hash of page_id) whose article is marked by
its tag, from a fixed sample page, and from re-skinned variants of both (containers renamed or
stripped of their marks; menus, notices, forms, sidebars and reader comments put around or inside).

Defined results: null or empty html, or a page without main text: empty text, 0 characters;
unclosed and misnested tags are closed as browsers close them; text outside any tag is a block;
repeated rows are returned as often as they occur; the parameters do not depend on other columns.
"""
from __future__ import annotations

import bisect
import html as entity
import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.llm.text import map_arrow, reliable, values

SAMPLE = 120
TREES, LEVELS = 12, 4

_ATTRS = r"""(?:"[^"]*"|'[^']*'|[^>"'])*"""
_RAW = "script|style|noscript|template|title|textarea|select|svg|iframe|button"   # their content is no text
_MARK = re.compile(rf"""<!--.*?(?:-->|\Z)|<({_RAW})\b{_ATTRS}>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRS})>|<[!?][^>]*>""", re.S | re.I)
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_RAW_NAME = re.compile(rf"(?:{_RAW})\Z", re.I)
_EDGE = re.compile(r"""[>"']""")
_ATTR = re.compile(r"""(class|id|role|data-gold)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Element names and attribute tokens that HTML authors use.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ()}
BAD_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
GOOD_TAGS = frozenset("article main".split())
BAD_TOKENS = frozenset("ad ads advert advertisement advertising banner breadcrumb breadcrumbs button buttons comment comments consent cookie cookies copyright credits disclaimer disqus discussion feedback footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager pagination popup popular privacy promo promoted promotion recommended related replies reply respond search share sharing shares sidebar sidenav signup social sponsor sponsored subscribe tags toolbar topbar tracking widget widgets".split())
GOOD_TOKENS = frozenset("article articlebody body blog content entry main maintext post story text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "parent", "kids", "text", "chars", "links", "tags", "tokens", "gold", "stops", "lead")

    def __init__(self, tag, parent, tokens=(), gold=None):
        self.tag, self.parent, self.tokens, self.gold = tag, parent, tokens, gold
        self.kids, self.text, self.chars, self.links, self.tags, self.stops = [], None, 0, 0, 1, 0
        self.lead = tag in GOOD_TAGS or tag == "h1"  # or holds such an element


class _Ends:
    """Where a tag whose attributes start at a place ends: the first ``>`` outside quotes (None: nowhere).

    All answers are made at once, from the right; asked for only when a tag without an end was met, so that pages with
    many of them stay linear."""

    def __init__(self, page: str):
        self.at = [m.start() for m in _EDGE.finditer(page)]
        self.end: list[int | None] = [None] * (len(self.at) + 1)
        after = {'"': len(self.at), "'": len(self.at)}  # the place after the next quote of each kind
        for i in range(len(self.at) - 1, -1, -1):
            c = page[self.at[i]]
            if c == ">":
                self.end[i] = self.at[i]
            else:
                self.end[i] = self.end[after[c]]
                after[c] = i + 1

    def of(self, place: int) -> int | None:
        return self.end[bisect.bisect_left(self.at, place)]


def marks(page: str):
    """(text, closing, tag, attributes) in page order: a piece of text alone, or a tag; comments, declarations and the content
    of raw elements are left out.  A tag without an end is text.  Linear in the page."""
    pos, last, ends = 0, page.rfind(">"), None
    while pos < len(page):
        at = page.find("<", pos)
        if at < 0:
            yield page[pos:], None, None, None
            return
        if at > pos:
            yield page[pos:at], None, None, None
        pos = at
        if at > last:   # no tag ends any more, nor does a comment
            comment = page.find("<!--", at)
            yield page[at:comment if comment >= 0 else len(page)], None, None, None
            return
        name = _NAME.match(page, at)
        if name and ends is not None:
            stop = ends.of(name.end())
            if stop is None:
                yield "<", None, None, None
                pos = at + 1
            elif not name[1] and _RAW_NAME.match(name[2]):
                close = re.compile(rf"</{name[2]}\s*>", re.I).search(page, stop + 1)
                pos = close.end() if close else len(page)
            else:
                yield None, bool(name[1]), name[2].lower(), page[name.end():stop]
                pos = stop + 1
            continue
        m = _MARK.match(page, at)
        if m is None:
            if name:
                ends = _Ends(page)
                continue
            yield "<", None, None, None
            pos = at + 1
            continue
        if m[3]:
            yield None, bool(m[2]), m[3].lower(), m[4]
        pos = m.end()


def parse(page: str) -> Node:
    """Block tree of a page; text blocks are leaves with tag ``#text``."""
    root = Node("#root", None)
    stack, block = [root], []         # open blocks; current inline run
    where = defaultdict(list)         # places of each tag on the stack
    inline = Counter()                # open inline tags

    def flush():
        if block:
            s = " ".join(entity.unescape("".join(x for x, _ in block)).split())
            if s:
                leaf = Node("#text", stack[-1])
                leaf.text, leaf.chars = s, len(s)
                total = sum(len(x) for x, _ in block) or 1
                leaf.links = int(len(s) * sum(len(x) for x, a in block if a) / total)
                leaf.stops = sum(s.count(c) for c in ".,;:!?")
                stack[-1].kids.append(leaf)
            block.clear()

    def close(at: int):
        flush()
        for node in stack[at:]:
            where[node.tag].pop()
        del stack[at:]
        inline.clear()

    def top(tags) -> int:
        """Place of the innermost open block with one of these tags; 0 if there is none."""
        return max((where[t][-1] for t in tags if where[t]), default=0)

    for text, closing, tag, attributes in marks(page):
        if text is not None:
            block.append((text, inline["a"] > 0))
            continue
        if closing:
            if tag in INLINE:
                if inline[tag]:
                    inline[tag] -= 1
                continue
            at = top((tag,))
            if at:
                close(at)
            elif tag == "p":
                flush()
            continue
        if tag in INLINE:
            if tag == "br":
                block.append((" ", False))
            elif tag not in VOID:
                inline[tag] += 1
            continue
        if tag in CLOSES_P and (at := top(("p",))):
            close(at)
        if tag in SAME and (at := top(SAME[tag])) > top(SCOPE[tag]):
            close(at)
        flush()
        if tag in VOID or tag in ("html", "body", "head"):
            if tag == "body":
                close(1)
            continue
        tokens, gold = (), None
        if attributes:
            found = []
            for name, v in _ATTR.findall(attributes):
                if name == "data-gold":
                    gold = v.strip("\"'") == "1"
                else:
                    found += [t.lower() for t in _WORD.findall(v)]
            tokens = tuple(found)
        node = Node(tag, stack[-1], tokens, gold)
        stack[-1].kids.append(node)
        where[tag].append(len(stack))
        stack.append(node)
    flush()
    return root


FEATURES = 18


def features(root: Node) -> tuple[list[Node], np.ndarray]:
    """Nodes in page order (parents first) and their features."""
    order, todo = [], [(root, 0)]
    depth = {}
    while todo:
        node, d = todo.pop()
        depth[id(node)] = d
        order.append(node)
        todo.extend((k, d + 1) for k in reversed(node.kids))
    for node in reversed(order):
        for k in node.kids:
            node.chars += k.chars
            node.links += k.links
            node.tags += k.tags
            node.stops += k.stops
            node.lead |= k.lead
    whole = max(1, root.chars)
    path, rows = {}, np.zeros((len(order), FEATURES))
    place = {}
    for node in order:
        for i, k in enumerate(node.kids):
            place[id(k)] = i
    for r, node in enumerate(order):
        up = path[id(node.parent)] if node.parent is not None else (0, 0, 0, 0, 0)
        bad_tag, good_tag = node.tag in BAD_TAGS, node.tag in GOOD_TAGS
        bad, good = sum(t in BAD_TOKENS for t in node.tokens), sum(t in GOOD_TOKENS for t in node.tokens)
        if (bad_tag or bad) and node.lead and node.chars > 0.6 * whole:
            bad_tag, bad = False, 0  # a page-wide wrapper, not a box of the page
        sign = -1 if bad_tag or bad or up[4] < 0 else 1 if good_tag or good else up[4]
        path[id(node)] = now = (up[0] + bad_tag, up[1] + good_tag, up[2] + bad, up[3] + good, sign)
        kin = node.parent.kids if node.parent is not None else [node]
        rows[r] = (*now, bad_tag + (bad > 0), np.log1p(node.chars), node.links / max(1, node.chars), node.chars / whole, np.log1p(node.chars / node.tags),
                   depth[id(node)], place.get(id(node), 0) / len(kin), len(kin), sum(k.chars for k in kin) / len(kin) if len(kin) <= 64 else node.parent.chars / len(kin),
                   node.tag in HEADINGS, node.tag == "p" or (node.parent is not None and node.parent.tag == "p"), node.tag in ("ul", "ol", "li", "table"), node.stops / max(1, node.chars))
    return order, rows


def decoded(order: list[Node], p: np.ndarray) -> list[str]:
    """Text blocks of the most likely consistent labelling."""
    yes, no = np.log(np.clip(p, 1e-6, 1)).tolist(), np.log(np.clip(1 - p, 1e-6, 1)).tolist()
    at = {id(n): i for i, n in enumerate(order)}
    drop, best = [0.0] * len(order), [0.0] * len(order)
    for i in range(len(order) - 1, -1, -1):
        kids = [at[id(k)] for k in order[i].kids]
        drop[i] = no[i] + sum(drop[k] for k in kids)
        kept = yes[i] + sum(best[k] for k in kids)
        best[i] = max(drop[i], kept)
        yes[i] = kept
    out, todo = [], [0]
    while todo:
        i = todo.pop()
        if i and yes[i] < drop[i]:  # the root only holds the page
            continue
        if order[i].text:
            out.append(order[i].text)
        todo.extend(at[id(k)] for k in reversed(order[i].kids))
    return out


def probability(trees, x: np.ndarray) -> np.ndarray:
    """Of main text, from (weight, feature, threshold, left, right, value) trees."""
    margin = np.zeros(len(x))
    every = np.arange(len(x))
    for weight, feature, threshold, left, right, value in trees:
        at = np.zeros(len(x), np.int64)
        for _ in range(LEVELS):
            at = np.where(x[every, feature[at]] <= threshold[at], left[at], right[at])
        margin += weight * value[at]
    return 1 / (1 + np.exp(-2 * margin))


SEED = "<html><body><nav><ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("home", "news", "about", "contact")) + \
    "</ul></nav><article><h1>A heading of the page</h1>" + "<p>Some plain sentences, one after another, make up the text of this page. They are long enough to be prose.</p>" * 5 + \
    "</article><footer>All rights reserved.</footer></body></html>"


def variants(page: str, seed: int) -> list[str]:
    """The page with its article marked as gold, as it is and re-skinned."""
    m = re.search(r"<article\b[^>]*>", page)
    if not m or page.count("<article") != 1 or "data-gold" in page:
        return []
    rng = random.Random(seed)
    end = page.find("</article>", m.end())
    end = len(page) if end < 0 else end
    before, inner, after = page[:m.start()], page[m.end():end], page[end:].replace("</article>", "", 1)
    bad = lambda: rng.choice(sorted(BAD_TOKENS))
    lines = re.findall(r"<p>([^<]{1,400})", inner) or ["a line of text"]
    box = lambda: rng.choice([f'<div class="{bad()}">%s</div>', f'<section id="{bad()}"><h3>Title</h3>%s</section>', "<aside>%s</aside>", "<form>%s</form>", "<header>%s</header>", f'<ul class="{bad()}"><li>%s</li></ul>', f'<div class="x-{bad()} y"><p>%s</p></div>']) % f"<p>{rng.choice(lines)}</p>"
    out = [f'{before}<article data-gold="1">{inner}</article>{after}']
    for opened, shut in (('<div class="%s" data-gold="1">' % rng.choice(["post-content", "entry", "story", "article-body", "content"]), "</div>"), ('<main data-gold="1">', "</main>"), ('<div class="wrap"><div data-gold="1">', "</div></div>")):
        b, a, i = before, after, inner
        if rng.random() < 0.6:
            b, a = (x.replace("<nav>", f'<div class="{bad()}">').replace("</nav>", "</div>").replace("<footer>", f'<div id="{bad()}">').replace("</footer>", "</div>") for x in (b, a))
        wrapped = [x.replace(">", ' data-gold="0">', 1) for x in (box(), box(), box())]
        if rng.random() < 0.5:
            i += wrapped[2]
        out.append(b + wrapped[0] + opened + i + shut + wrapped[1] + a)
    return out


def _examples(batches):
    """Features and gold labels of the nodes of the sample's variants."""
    for b in batches:
        rows, gold = [], []
        for i, v in zip(b.column(0).to_pylist(), values(b.column(1))):
            for page in variants(v.decode("utf-8", "replace") if v else "", i or 0):
                order, x = features(parse(page))
                label = {}
                for n in order:
                    label[id(n)] = n.gold if n.gold is not None else label[id(n.parent)] if n.parent is not None else False
                for n in reversed(order):  # an element that holds gold text is gold, too
                    if n.kids and not label[id(n)]:
                        label[id(n)] = any(label[id(k)] for k in n.kids)
                rows.append(x)
                gold += [float(label[id(n)]) for n in order]
        x = np.concatenate(rows) if rows else np.zeros((0, FEATURES))
        yield pa.RecordBatch.from_arrays([*[pa.array(x[:, c]) for c in range(FEATURES)], pa.array(gold, pa.float64())], names=[f"f{c}" for c in range(FEATURES)] + ["label"])


def train(pages: DataFrame, sample: int = SAMPLE) -> bytes:
    """Boosted trees as numpy arrays, fitted on a bounded sample of ``pages`` (page_id, html)."""
    spark = pages.sparkSession
    pages = pages.where("html is not null and page_id is not null")
    n = max(1, pages.select("page_id").count())
    drawn = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) < min(1.0, sample / n) * (1 << 20)).limit(4 * sample)
    fixed = spark.createDataFrame([(i, SEED) for i in range(-12, 0)], "page_id long, html string")
    both = drawn.select(F.col("page_id").cast("long").alias("page_id"), "html").union(fixed).repartition(4, "page_id")
    rows = map_arrow(both, _examples, ", ".join(f"f{c} double" for c in range(FEATURES)) + ", label double")
    rows = reliable(VectorAssembler(inputCols=[f"f{c}" for c in range(FEATURES)], outputCol="x").transform(rows).select("x", "label"))
    fitted = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=LEVELS, stepSize=0.3, maxBins=32, seed=7).fit(rows)
    trees = []
    for tree, weight in zip(fitted.trees, fitted.treeWeights):
        feature, threshold, left, right, value = [], [], [], [], []

        def add(node):
            i = len(feature)
            inner = node.getClass().getSimpleName() == "InternalNode"
            feature.append(node.split().featureIndex() if inner else 0)
            threshold.append(node.split().threshold() if inner else np.inf)
            left.append(i)
            right.append(i)
            value.append(node.prediction())
            if inner:
                left[i] = add(node.leftChild())
                right[i] = add(node.rightChild())
            return i

        add(tree._call_java("rootNode"))
        trees.append((weight, np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value)))
    return pickle.dumps(trees)


def extracted(page: str, trees) -> str:
    order, x = features(parse(page))
    return "\n\n".join(decoded(order, probability(trees, x)))


def extract(pages: DataFrame, model: bytes) -> DataFrame:
    """page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a few KB

    def run(batches):
        trees = pickle.loads(shared.value)
        for b in batches:
            out = []
            held, size = [], 0

            def score():
                if held:
                    p = probability(trees, np.concatenate([x for _, x in held]))
                    at = 0
                    for order, x in held:
                        out.append("\n\n".join(decoded(order, p[at:at + len(x)])))
                        at += len(x)
                    held.clear()

            for v in values(b.column(2)):
                held.append(features(parse(v.decode("utf-8", "replace") if v else "")))
                size += len(v or b"")
                if size > 1 << 20:
                    score()
                    size = 0
            score()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_arrow(pages.select("page_id", "url", "html"), run, f"page_id {kind}, url string, text string, n_chars long")


def train_and_extract(pages: DataFrame) -> DataFrame:
    return extract(pages, train(pages))
