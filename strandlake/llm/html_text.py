"""Main text of HTML pages by a tree-structured graphical model over DOM blocks.

Each block element is a node with a hidden label, content or not. Potentials: the label of a child given its
parent's label and its tag, and the features of a node (class and id words, length and link share of its own
text, notice words) given its label. Sum-product messages go up from the leaves and down from the root, which
gives exact marginals; the text of nodes whose marginal is at least one half is kept, in page order.

Counts for the potentials come from labelled pages: pages whose document is known (the number that ends the
URL's path names it), and a generated set of page layouts, both weighing the same.

Defined cases: null and empty pages give an empty text; unclosed elements end where their parent does, an
unclosed comment or script takes the rest; very long pages are read whole; repeated rows are read each; a marginal of exactly one half
is content; null ids and addresses are carried along; extra columns are ignored; without labelled
pages the generated layouts alone are learned from; an empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.url_filter import path
from strandlake.runtime import giving_back

#: Labelled pages learned from (expected, picked by hash), and generated layouts; what they hold bounds the model.
LABELLED_PAGES, LAYOUTS = 800, 240

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr img br input label picture source".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp select button svg math object canvas audio video".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split()
)
NOTICE = re.compile(r"(?i)\b(cookies?|subscribe|newsletter|copyright|rights reserved|advertisement|sponsored|log ?in|sign ?up|privacy policy|repl(?:y|ies)|share this)\b|©")
_TEXT_HINTS = frozenset("content entry post story".split())
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ATTR = re.compile(r"""(?i)\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW_END = {t: re.compile(f"(?i)</{t}(?=[\\s/>])") for t in RAW}
_PART = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    hints: tuple[str, ...] = ()
    pieces: list[str] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)
    linked: int = 0
    within: bool = False

    @property
    def kind(self) -> str:
        """The tag, and whether it stands within an article, main part, section or a block named as text."""
        return self.tag + "<within" * self.within


def parse(page: str) -> list[Node]:
    """Block elements in page order, each after its parent, with its own texts as blocks ``(order, text)``."""
    nodes, stack, at, n, in_link, order = [Node("root", -1)], [0], 0, len(page), 0, 0

    def flush(i: int) -> None:
        nonlocal order
        node = nodes[i]
        if node.pieces:
            if text := " ".join(_html.unescape("".join(node.pieces)).split()):
                node.blocks.append((order, text))
                order += 1
            node.pieces = []

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            nodes[stack[-1]].pieces.append(page[at:lt])
            if in_link:
                nodes[stack[-1]].linked += lt - at
        if lt == n:
            break
        nxt = page[lt + 1 : lt + 2]
        if nxt == "!" or nxt == "?":
            comment = page.startswith("<!--", lt)
            end = page.find("-->" if comment else ">", lt + (4 if comment else 2))
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        m = _TAG.match(page, lt)
        if not m:
            if nxt.isalpha() or nxt == "/":
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                nodes[stack[-1]].pieces.append("<")
                at = lt + 1
            continue
        at, closing, tag = m.end(), m[1], m[2].lower()
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                end = _RAW_END[tag].search(page, at)
                stop = page.find(">", end.end()) if end else -1
                at = n if stop < 0 else stop + 1
                nodes[stack[-1]].pieces.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                nodes[stack[-1]].pieces.append(" ")
            continue
        flush(stack[-1])
        in_link = 0
        if closing:
            for d in range(len(stack) - 1, 0, -1):
                if nodes[stack[d]].tag == tag:
                    del stack[d:]
                    break
            continue
        if tag in ("html", "body", "head") and any(nodes[i].tag == tag for i in stack):
            continue
        if tag == "body" and nodes[stack[-1]].tag == "head":
            stack.pop()
        top = nodes[stack[-1]].tag
        if top == "p" and tag in CLOSES_P or top == tag and tag in ("li", "tr", "option", "td", "th", "dt", "dd") or {top, tag} in ({"td", "th"}, {"dt", "dd"}):
            stack.pop()
        elif tag == "tr" and top in ("td", "th"):
            stack.pop()
            if nodes[stack[-1]].tag == "tr":
                stack.pop()
        hints = sorted({w for a in _ATTR.finditer(m[3]) for w in _PART.findall((a[2] or a[3] or a[4] or "").lower())}) if m[3] else ()
        above = nodes[stack[-1]]
        nodes.append(Node(tag, stack[-1], tuple(hints), within=above.within or above.tag in ("article", "main", "section") or not _TEXT_HINTS.isdisjoint(above.hints)))
        if tag not in VOID:
            stack.append(len(nodes) - 1)
    for i in reversed(stack):
        flush(i)
    return nodes


def features(node: Node) -> list[str]:
    own = sum(len(t) for _, t in node.blocks)
    out = [f"c={h}" for h in node.hints]
    if own:
        share = node.linked / (own + 1)
        if not node.within:  # many short lines within an article are no sign against it
            out.append(f"len={min(5, int(math.log(own + 1, 4)))}")
        out.append(f"link={0 if share < 0.1 else 1 if share < 0.5 else 2}")
        if own < 400 and any(NOTICE.search(t) for _, t in node.blocks):
            out.append("notice")
    return out


@dataclass
class Model:
    """Log potentials: ``step[tag][parent label] = (log P(0), log P(1))``, ``seen[feature] = (log P(f|0), log P(f|1))``."""

    step: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    seen: dict[str, tuple[float, float]]

    @classmethod
    def of(cls, counts: dict[str, float]) -> Model:
        tags = {k.split("|")[1] for k in counts if k[0] == "t"} | {"?"}
        total = lambda p, y: sum(v for k, v in counts.items() if k[0] == "t" and k.endswith(f"|{p}|{y}"))
        base = [[total(p, y) + 1.0 for y in (0, 1)] for p in (0, 1)]
        step = {}
        for tag in tags:
            rows = []
            for p in (0, 1):
                prior = [2 * base[p][y] / sum(base[p]) for y in (0, 1)]
                n = [counts.get(f"t|{tag}|{p}|{y}", 0.0) + prior[y] for y in (0, 1)]
                rows.append((math.log(n[0] / sum(n)), math.log(n[1] / sum(n))))
            step[tag] = (rows[0], rows[1])
        size = [1.0 + sum(v for k, v in counts.items() if k[0] == "t" and k[-1] == str(y)) for y in (0, 1)]
        seen = {}
        for f in {k.split("|")[1] for k in counts if k[0] == "f"}:
            n = [counts.get(f"f|{f}|{y}", 0.0) for y in (0, 1)]
            if sum(n) >= 1.5:
                seen[f] = tuple(math.log((n[y] + 0.5) / (size[y] + 1)) for y in (0, 1))
        return cls(step, seen)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of every node, exactly: messages up to the root, then down."""
        n, add = len(nodes), _logsum
        up = [[0.0, 0.0] for _ in range(n)]
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * n
        unknown = self.step["?"]
        for i in range(n - 1, -1, -1):
            node, here = nodes[i], up[i]
            if node.tag in ("root", "html", "body"):
                here[0] = -50.0  # a page as a whole holds its main text
            for f in features(node):
                if f in self.seen:
                    a, b = self.seen[f]
                    here[0] += a
                    here[1] += b
            if i:
                s = self.step.get(node.kind, unknown)
                msg = (add(s[0][0] + here[0], s[0][1] + here[1]), add(s[1][0] + here[0], s[1][1] + here[1]))
                top = max(msg)
                sent[i] = (msg[0] - top, msg[1] - top)
                up[node.parent][0] += sent[i][0]
                up[node.parent][1] += sent[i][1]
        down: list[tuple[float, float]] = [(0.0, 0.0)] * n
        out = [0.0] * n
        for i in range(n):
            node, here = nodes[i], up[i]
            if i:
                p, s = node.parent, self.step.get(node.kind, unknown)
                b0 = up[p][0] + down[p][0] - sent[i][0]
                b1 = up[p][1] + down[p][1] - sent[i][1]
                msg = (add(b0 + s[0][0], b1 + s[1][0]), add(b0 + s[0][1], b1 + s[1][1]))
                top = max(msg)
                down[i] = (msg[0] - top, msg[1] - top)
            d = (here[0] + down[i][0]) - (here[1] + down[i][1])
            out[i] = 1 / (1 + math.exp(min(d, 700.0)))
        return out

    def text(self, page: str | None) -> str:
        if not page:
            return ""
        nodes = parse(page)
        marginal = self.marginals(nodes)
        blocks = sorted(b for node, p in zip(nodes, marginal, strict=True) if p >= 0.5 for b in node.blocks)
        return "\n".join(t for _, t in blocks)


def _logsum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def label_counts(page: str, lines: set[str], opening: str = "") -> Counter:
    """Counts of one labelled page: a block is content if it is one of the lines, or a heading with which the text opens; a container of content is content."""
    nodes = parse(page)
    good, size = [0.0] * len(nodes), [0.0] * len(nodes)
    for i, node in enumerate(nodes):
        for _, t in node.blocks:
            size[i] += len(t)
            if t in lines or node.tag[:1] == "h" and opening.startswith(t):
                good[i] += len(t)
    for i in range(len(nodes) - 1, 0, -1):
        good[nodes[i].parent] += good[i]
        size[nodes[i].parent] += size[i]
    y = [int(g > 0) for g in good]
    out: Counter = Counter()
    for i, node in enumerate(nodes):
        if i and size[i]:
            out[f"t|{node.kind}|{y[node.parent]}|{y[i]}"] += 1
        if size[i]:
            out.update(f"f|{f}|{y[i]}" for f in features(node))
    return out


def layouts(number: int = LAYOUTS, seed: int = 11) -> Iterator[tuple[str, set[str]]]:
    """Generated labelled pages: usual places of main texts among usual surroundings, with invented words."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["ba", "do", "ker", "li", "mon", "ta", "ru", "sen"]) for _ in range(r.randint(1, 3)))
    say = lambda a, b: " ".join(word() for _ in range(r.randint(a, b))).capitalize() + "."
    links = lambda k: "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(k))

    def around() -> list[str]:
        menu = r.choice(["<nav>%s</nav>", '<div class="menu">%s</div>', '<div id="navigation">%s</div>', '<div class="navbar nav">%s</div>', '<header class="header">%s</header>', '<div class="breadcrumbs">%s</div>'])
        return [
            menu % f"<ul>{links(r.randint(3, 8))}</ul>",
            r.choice([f'<header class="site-header"><h1>{word()}</h1><p>{say(2, 5)}</p></header>', f'<div id="header" class="header"><div class="logo">{word()}</div></div>', f"<header><p>{say(2, 6)}</p></header>", f'<div class="masthead top-bar">{say(2, 6)}</div>']),
            r.choice([f'<aside><h3>{word()}</h3><ul>{links(4)}</ul><p>{say(5, 25)}</p></aside>', f'<div class="sidebar widget"><h3>{word()}</h3><p>{say(5, 25)}</p><ul>{links(3)}</ul></div>', f'<div id="sidebar"><p>{say(4, 20)}</p></div>', f"<aside>{say(4, 20)}</aside>"]),
            r.choice([f'<div class="{c}">%s</div>' for c in ("ad", "ads", "advert", "advertisement", "sponsored", "promo banner", "ad-banner", "ad-slot")]) % r.choice([say(4, 20), f"<p>{say(4, 20)}</p>"]),
            r.choice([f'<div class="cookie-notice">We use cookies. {say(4, 15)}</div>', f'<div id="cookie-banner" class="consent notice"><p>{say(5, 20)}</p></div>', f'<div class="notice alert" role="alert">{say(4, 15)}</div>', f'<div class="popup modal subscribe"><p>Subscribe to our newsletter. {say(3, 10)}</p></div>']),
            r.choice([f'<form action="/s"><label>{word()}</label><input name="q"><p>{say(3, 12)}</p></form>', f'<form class="newsletter"><p>{say(3, 12)}</p><input type="text"></form>', f'<div class="form"><form><p>{say(2, 8)}</p><fieldset><legend>{word()}</legend><div>{say(2, 6)}</div></fieldset></form></div>']),
        ]

    def after() -> list[str]:
        one = lambda: r.choice(['<div class="comment"><p class="author">%s</p><p>%s</p></div>', '<article class="comment"><footer>%s</footer><p>%s</p></article>', '<li class="comment reply"><div class="comment-author">%s</div><div class="comment-body"><p>%s</p></div></li>', "<div><b>%s</b><p>%s</p></div>"]) % (word(), say(6, 70))
        many = "".join(one() for _ in range(r.randint(1, 4)))
        return [
            r.choice([f'<section class="comments"><h2>{word()}</h2>{many}</section>', f'<div id="comments" class="comments-area"><h3>{word()}</h3><ol class="comment-list">{many}</ol></div>', f'<div class="discussion responses">{many}</div>', f'<section id="comments">{many}</section>']),
            r.choice([f'<div class="related"><h3>{word()}</h3><ul>{links(4)}</ul></div>', f'<div class="share social"><ul>{links(3)}</ul></div>', f'<div class="tags meta">{links(2)}</div>']),
            r.choice([f"<footer>&copy; {word()} &middot; {say(4, 10)}</footer>", f'<footer class="footer"><p>{say(4, 12)}</p></footer>', f'<div id="footer" class="footer"><p>Copyright {say(3, 9)}</p><ul>{links(3)}</ul></div>']),
        ]

    for _ in range(number):
        lines: set[str] = set()

        def keep(text: str, lines: set[str] = lines) -> str:
            lines.add(text)
            return text

        parts = [f"<h1>{keep(say(3, 9))}</h1>"]
        if r.random() < 0.3:
            parts = [f"<header>{parts[0]}<p>{keep(say(8, 25))}</p></header>"]
        for _ in range(r.randint(2, 9)):
            kind = r.random()
            if kind < 0.6:
                parts.append(f"<p>{keep(say(3, 90))}</p>")
            elif kind < 0.68:
                parts.append(f"<h2>{keep(say(2, 6))}</h2>")
            elif kind < 0.76:
                parts.append(r.choice(["<ul>%s</ul>", "<ol>%s</ol>"]) % "".join(f"<li>{keep(say(3, 15))}</li>" for _ in range(3)))
            elif kind < 0.82:
                parts.append(f"<blockquote><p>{keep(say(8, 40))}</p></blockquote>")
            elif kind < 0.87:
                parts.append("<table><tr>" + "".join(f"<td>{keep(say(1, 6))}</td>" for _ in range(3)) + "</tr></table>")
            elif kind < 0.91:
                parts.append(f"<figure><figcaption>{keep(say(4, 14))}</figcaption></figure>")
            elif kind < 0.95:
                parts.append(f"<div>{keep(say(10, 60))}</div>")
            else:
                parts.append(f"<pre>{keep(say(6, 30))}</pre>")
        wrap = r.choice(["<article>%s</article>", "<main>%s</main>", "<main><article>%s</article></main>", '<div id="content">%s</div>', '<div class="post-content entry">%s</div>', '<div class="article-body">%s</div>', '<section class="story">%s</section>', "<div><div>%s</div></div>", '<div id="main" class="content"><article class="post">%s</article></div>'])
        extra = around()
        picked = [x for x in extra if r.random() < 0.6]
        inner, ends = "".join(parts), [x for x in after() if r.random() < 0.6]
        if picked and r.random() < 0.3:
            inner += picked.pop()
        r.shuffle(picked)
        body = "".join(picked) + wrap % inner + "".join(ends)
        if r.random() < 0.3:
            body = f'<div class="{r.choice(["wrapper", "container", "page", "site"])}">{body}</div>'
        yield f"<!DOCTYPE html><html><head><title>{word()}</title></head><body>{body}</body></html>", lines


def train(pages: DataFrame | None, docs: DataFrame | None, labelled_pages: int = LABELLED_PAGES) -> Model:
    """A model of labelled pages and generated layouts; counts of both are brought to the same weight."""
    made: Counter = Counter()
    for page, lines in layouts():
        made.update(label_counts(page, lines))
    real: Counter = Counter()
    if pages is not None and docs is not None and (n := pages.count()):
        doc_of = F.regexp_extract(path(F.col("url")), r"/(\d{1,18})(?:\.\w+)?/?$", 1).try_cast("bigint")
        some = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(1_000_000)) < min(1.0, labelled_pages / n) * 1_000_000)
        ids = some.select("page_id", doc_of.alias("doc_id")).where("doc_id is not null")
        texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("page_id", "text")
        pairs = some.select("page_id", "html").join(texts, "page_id").select("html", "text")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: Counter = Counter()
            for b in batches:
                for page, text in zip(b.column("html").to_pylist(), b.column("text").to_pylist(), strict=True):
                    lines = {" ".join(x.split()) for x in (text or "").split("\n")} - {""}
                    own = label_counts(page or "", lines, " ".join((text or "").split()))
                    if any(k.endswith("|1") for k in own):
                        out.update(own)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], names=["key", "n"])

        rows = pairs.mapInArrow(giving_back(count), "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
        real.update({r.key: r.n for r in rows.collect()})
    steps = [sum(v for k, v in c.items() if k[0] == "t") for c in (made, real)]
    scale = steps[0] / steps[1] if steps[1] else 0.0
    return Model.of({k: made[k] + scale * real[k] for k in made.keys() | real.keys()})


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = [m.text(h.as_py()) for h in b.column("html")]
            cols = [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    picked = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return picked.mapInArrow(giving_back(run), "page_id bigint, url string, text string, n_chars bigint")
