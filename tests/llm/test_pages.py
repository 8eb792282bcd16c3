from __future__ import annotations

import itertools
import math

from strandlake.llm import html_text, url_filter
from strandlake.llm.queries import URL_RULES


def test_parse_and_text():
    m = html_text.train(None, None)
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>
    <div class="ad">Buy this now, it is cheap and good for you.</div><article><h1>A  title</h1><p><b>First &amp; only<br>line.<br><p>Second
    line &copy; here &#233;<ul><li>one<li>two</ul><!-- no --><form><p>Your name and mail</p></form></article>
    <section class="comments"><h2>Comments</h2><div class="comment"><p>I think that this is a very long comment about the whole text above.</p></div></section>
    <aside class="sidebar"><p>More of it</p></aside><footer>&copy; 2024 somebody</footer></body></html>"""
    assert m.text(page) == "A title\nFirst & only line.\nSecond line © here é\none\ntwo"
    assert m.text(None) == "" and m.text("") == "" and m.text("<script>x") == "" and m.text("<!-- x") == ""
    assert m.text("<p>a < b and c &lt; d") == "a < b and c < d"
    assert m.text("<article><p>" + "x " * 50_000 + "</p></article>") == " ".join(["x"] * 50_000)


def test_marginals_by_enumeration():
    m = html_text.train(None, None)
    page = '<body><div class="content"><p>Some words of a text that goes on for a while, as texts do.</p><ul><li><a href="#">x</a></li></ul></div><div class="ad">Buy</div></body>'
    nodes = html_text.parse(page)
    unknown = m.step["?"]

    def weight(y):
        w = 0.0
        for i, node in enumerate(nodes):
            if node.tag in ("root", "html", "body") and not y[i]:
                w -= 50
            w += sum(m.seen[f][y[i]] for f in html_text.features(node) if f in m.seen)
            if i:
                w += m.step.get(node.kind, unknown)[y[node.parent]][y[i]]
        return math.exp(w)

    every = [(y, weight(y)) for y in itertools.product((0, 1), repeat=len(nodes))]
    total = sum(w for _, w in every)
    for i, p in enumerate(m.marginals(nodes)):
        assert abs(p - sum(w for y, w in every if y[i]) / total) < 1e-9


def test_generated_layouts_and_frames(spark):
    m = html_text.train(None, None)
    good = sum(set(m.text(p).split("\n")) == lines for p, lines in html_text.layouts(60, seed=5))
    assert good >= 48
    rows = [(1, "http://x/en/1", "<article><p>Text one is here</p></article>", "z"), (1, "http://x/en/1", "<article><p>Text one is here</p></article>", "z"), (None, None, None, "z"), (2, "u", "", "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = html_text.extract(df, m).collect()
    assert sorted((r.text, r.n_chars) for r in out) == [("", 0), ("", 0), ("Text one is here", 16), ("Text one is here", 16)]
    docs = spark.createDataFrame([(1, "Text one is here")], "doc_id bigint, text string")
    assert html_text.train(df, docs).text(rows[0][2]) == "Text one is here"
    assert html_text.extract(df.limit(0), m).count() == 0


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    best = (None, None)
    for verdict, rule in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best[0] is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *best


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/7?x=1#y", "https://example.com", "https://example.com?q=/en/", "x://com/en/", "http://b.net/de/8", "http://example.net/de/81", "http://org/es/1", "http://xorg/es/1", "HTTP://É.COM/en/7", "a://b://c/d", "http://x.example.com/en/6#f/en/7", "http://casino-win.example.org/fr/3"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(3, urls[3], "x", "y"), (None, urls[4], "x", "y")], "page_id bigint, url string, host string, rule string")
    labelled = [(f"http://{'casino-win' if i % 2 else 'site' + str(i % 7)}.example.org/fr/{i}", bool(i % 2)) for i in range(200)]
    index = url_filter.mine(spark.createDataFrame(labelled, "url string, blocked boolean"))
    got = url_filter.judge(df, URL_RULES, index).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        if r.page_id is None:
            continue
        host, path, rule, verdict = by_hand(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), urls[r.page_id]
        if rule:
            assert r.verdict == verdict
    own = {r.page_id: r for r in got}
    assert own[14].verdict == "block" and own[14].mined_rule and own[0].verdict == "allow"
    nothing = url_filter.mine(spark.createDataFrame([], "url string, blocked boolean"))
    assert {r.verdict for r in url_filter.judge(df, [], nothing).collect()} == {"allow"}
    assert url_filter.judge(df.limit(0), URL_RULES, index).count() == 0


def test_mined_rules_against_counts(spark):
    rows = [(f"http://h{i % 5}.example.com/en/{i}?k{i % 2}=1", i % 5 == 1 and i % 2 == 1) for i in range(400)]
    index = url_filter.mine(spark.createDataFrame(rows, "url string, blocked boolean"))
    rules = [r for x in index.by_token.values() for r in x]
    assert rules
    for items, confidence, support in rules:
        have = [b for u, b in rows if items <= set(url_filter.tokens(u))]
        assert support == sum(have) and abs(confidence - sum(have) / len(have)) < 1e-12 and confidence >= url_filter.LEAST_CONFIDENCE
    assert all(bool(index.match(url_filter.tokens(u))) == b for u, b in rows)


def test_rules_from_labels_alone(spark, monkeypatch):
    """All rules by brute force: every set of tokens, from the labels of the pages' documents and nothing else."""
    monkeypatch.setattr(url_filter, "LEAST_ROWS", 6)
    hosts, folders = ["casino-win", "ads", "plain", "garden"], ["en", "de", "fr"]
    pages = [(i, f"https://{hosts[i % 4]}.example/{folders[i % 3]}/{i}") for i in range(240)] + [(900, None), (901, "no scheme"), (902, "https://ads.example/en/")]
    labels = [(i, int(i % 5 > 0), int(i % 4 == 2 and i % 3 == 1 or i % 4 == 3)) for i in range(0, 200)] + [(3, None, 1), (None, 1, 1)]
    p, y = spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    bad = {}
    for i, quality, toxic in labels:
        if i is not None:
            bad[i] = bad.get(i, False) or toxic == 1 or quality == 0
    rows = [(frozenset(url_filter.tokens(u)), bad[i]) for i, u in pages if i in bad]
    labelled = url_filter.labelled_urls(p, y)
    assert sorted((sorted(url_filter.tokens(x.url)), x.blocked) for x in labelled.collect()) == sorted((sorted(t), b) for t, b in rows)
    index = url_filter.mine(labelled)
    sets: dict[frozenset, tuple[int, int]] = {}
    for items, b in rows:
        for k in range(1, len(items) + 1):
            for c in itertools.combinations(sorted(items), k):
                n, m = sets.get(frozenset(c), (0, 0))
                sets[frozenset(c)] = (n + 1, m + b)
    sure = {c: m / n for c, (n, m) in sets.items() if m >= 6 and m / n >= url_filter.LEAST_CONFIDENCE}
    found = {items: confidence for own in index.by_token.values() for items, confidence, _ in own}
    assert found and all(abs(sure[c] - confidence) < 1e-12 for c, confidence in found.items())
    for items, _ in rows:  # the surest of all rules that match is what the index finds
        best = max((s for c, s in sure.items() if c <= items), default=None)
        hit = index.match(sorted(items))
        assert (hit is None) == (best is None) and (hit is None or abs(hit[1] - best) < 1e-12)
    none = url_filter.mine(url_filter.labelled_urls(p, y.select("doc_id", "quality", (y.doc_id * 0).cast("int").alias("toxic")).where("quality = 1")))
    assert none.by_token == {}  # words that look unwanted are not


def test_rules_from_whole_urls(spark):
    """Telling tokens in a fifth folder, a last segment, a ninth and a long query name; many tokens that always come together."""
    long = "q" * 60
    tails = ["a/b/c/d/casino/{}", "a/{}-jackpot.html", "a/{}?" + "&".join(f"p{i}=1" for i in range(8)) + "&evil=1", f"a/{{}}?{long}bad=1"]
    fine = ["a/b/c/d/garden/{}", "a/{}-flower.html", "a/{}?" + "&".join(f"p{i}=1" for i in range(8)) + "&kind=1", f"a/{{}}?{long}good=1"]
    many = "&".join(f"m{i:02}=1" for i in range(40))
    rows = [(f"https://h.example/{t.format(i)}", bad) for bad, ts in ((True, tails), (False, fine)) for t in ts for i in range(60)]
    rows += [(f"https://h.example/x/{i}?{many}", True) for i in range(60)]
    index = url_filter.mine(spark.createDataFrame(rows, "url string, blocked boolean"))
    new = [(f"https://h.example/{t.format(999)}", bad) for bad, ts in ((True, tails), (False, fine)) for t in ts] + [("https://h.example/x/999?m31=1", True)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(new)], "page_id bigint, url string")
    got = {x.page_id: x.verdict == "block" for x in url_filter.judge(pages, [], index).collect()}
    assert got == {i: bad for i, (_, bad) in enumerate(new)}


def test_long_urls(spark):
    tail = "/".join(f"f{i}" for i in range(20_000))
    rows = [(f"https://h.example/{'bad' if i % 2 else 'good'}/{i}", bool(i % 2)) for i in range(100)]
    index = url_filter.mine(spark.createDataFrame(rows, "url string, blocked boolean"))
    pages = spark.createDataFrame([(1, f"https://h.example/{tail}/bad/7"), (2, f"https://h.example/{tail}/good/7")], "page_id bigint, url string")
    assert {x.page_id: x.verdict for x in url_filter.judge(pages, [], index).collect()} == {1: "block", 2: "allow"}


def test_every_class_word_counts():
    words = " ".join(f"a{c}" for c in "abcdefghijklmnop")
    nodes = html_text.parse(f'<html><body><div class="{words} story"><p id="one">text</p></div><div class="{words} sidebar"><p>more</p></div></body></html>')
    hints = [n.hints for n in nodes if n.tag == "div"]
    assert "story" in hints[0] and "sidebar" in hints[1] and all(len(h) == 17 for h in hints)
    assert [n.within for n in nodes if n.tag == "p"] == [True, False]
