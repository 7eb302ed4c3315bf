"""Site style trees: what importance decides beside marks, and its numbers against plain loops."""

import math
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerbeam.llm import style_tree

PAGES = "page_id bigint, url string, html string"


def texts(spark, pages, host="a.example.com"):
    df = spark.createDataFrame([(k, f"http://{host}/{k}", p) for k, p in enumerate(pages)], PAGES)
    return [r["text"] for r in style_tree.extract(df).orderBy("page_id").collect()]


@pytest.mark.parametrize("name", ["share-price", "comment-on-trade", "related-work", "notice-of-change", "x1"])
def test_articles_in_doubtful_names_stay(spark, name):
    page = "<body><nav>m</nav><article><h1>Title {0}</h1><div class='{1}'><p>text of page {0} alone</p></div></article><footer>f {0}</footer></body>"
    assert texts(spark, [page.format(k, name) for k in range(40)]) == [f"Title {k}\ntext of page {k} alone" for k in range(40)]


@pytest.mark.parametrize("name", ["share-price", "x1"])
def test_repeated_branches_go_by_name_or_not(spark, name):
    page = "<body><article><h1>Title {0}</h1><p>own text {0}</p><div class='{1}'><p>the same everywhere</p></div></article></body>"
    assert texts(spark, [page.format(k, name) for k in range(20)]) == [f"Title {k}\nown text {k}" for k in range(20)]


@pytest.mark.parametrize(
    "noise",
    ["<section class=comments><p>{}</p></section>", "<div class='reader-comments'><p>{}</p></div>", "<div id=comment-list-12>{}</div>", "<aside>{}</aside>", "<div class='related-posts'>{}</div>",
     "<div class=cookieNotice>{}</div>", "<div class='ad-slot top'>{}</div>", "<div class='share-buttons'>{}</div>", "<form>{}</form>", "<div role=complementary>{}</div>"],
)
def test_clear_marks_in_articles_go_whatever_they_say(spark, noise):
    """Reader comments and adverts differ from page to page as articles do; the mark decides, even if they are longer."""
    page = "<body><article><h1>Title {0}</h1><p>own text {0}</p>" + noise.format("said on page {0} " * 5) + "</article></body>"
    assert texts(spark, [page.format(k) for k in range(30)]) == [f"Title {k}\nown text {k}" for k in range(30)]


def test_lists_of_links_in_an_article_stay(spark):
    """Links say nothing against a list in a main part that differs from page to page; beside an unmarked body they do."""
    links = "<ul><li><a href=x>source {0} of many</a><li><a href=y>another of {0}</a></ul>"
    page = "<body><article><h1>Title {0}</h1><p>own text {0}</p>" + links + "</article></body>"
    assert texts(spark, [page.format(k) for k in range(12)])[5] == "Title 5\nown text 5\nsource 5 of many\nanother of 5"
    page = "<body>" + links + "<div class=x><h1>Title {0}</h1><p>" + "own text {0} " * 9 + "</p></div></body>"
    assert texts(spark, [page.format(k) for k in range(12)])[5] == "Title 5\n" + " ".join(["own text 5"] * 9)


def test_a_clear_mark_around_all_there_is_is_overruled(spark):
    """Pages whose words are nearly all in an aside, which differs from page to page; beside a longer body the same aside goes."""
    body = " ".join(f"word{i} of page {{0}}" for i in range(20))
    page = "<body><aside class=z><h1>Title {0}</h1><p>" + body + "</p></aside><div class=y>Welcome</div></body>"
    assert texts(spark, [page.format(k) for k in range(20)])[7] == f"Title 7\n{body.format(7)}"
    page = "<body><aside class=z><p>a few words on {0}</p></aside><div class=y><p>" + body + "</p></div></body>"
    assert texts(spark, [page.format(k) for k in range(20)])[7] == body.format(7)


def test_rotating_banners_go(spark):
    """Twenty banners on forty pages, without a mark: no page has one of its own."""
    page = "<body><div class=x9>{1} is the one to buy</div><div class=x><p>own text of page {0}</p></div></body>"
    assert texts(spark, [page.format(k, f"Brand{k % 20}") for k in range(40)]) == [f"own text of page {k}" for k in range(40)]


@pytest.mark.parametrize(("n", "stays"), [(1, True), (2, True), (3, False), (5, False)])
def test_small_hosts(spark, n, stays):
    """Two pages that are alike say little, three enough."""
    page = "<body><div class=top>Welcome to our site</div><div class=x><p>own text {0}, which differs</p></div></body>"
    assert texts(spark, [page.format(k) for k in range(n)]) == [("Welcome to our site\n" if stays else "") + f"own text {k}, which differs" for k in range(n)]


def test_hosts_of_copies_keep_their_text(spark):
    assert set(texts(spark, ["<body><div><h2>T</h2><p>the same page</p></div></body>"] * 8)) == {"T\nthe same page"}


def neutral(pages):
    """Without any mark: other tags and names, told apart only by where they stand and what they hold."""
    html = F.regexp_replace(F.regexp_replace("html", "</(nav|footer|article)>", "</div>"), "<(nav|footer|article)>", "<div class=q$1q>")
    return pages.withColumn("html", F.regexp_replace(html, 'class="ad"', 'class="x1"'))


def test_the_tree_finds_articles_without_marks(spark):
    """On the given pages with all marks taken out, links, place and repeats tell menus, adverts and footers from articles."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    marked = {r["page_id"]: r["text"] for r in style_tree.extract(pages).collect()}
    bare = neutral(pages)
    found = {r["page_id"]: r["text"] for r in style_tree.extract(bare).collect()}
    by_marks = {r["page_id"]: style_tree.Page(r["html"]).text() for r in bare.collect()}
    hosts = {r["host"] for r in pages.groupBy(style_tree.host_of(F.col("url")).alias("host")).count().where("count > 3").collect()}
    large = [r["page_id"] for r in pages.withColumn("host", style_tree.host_of(F.col("url"))).collect() if r["host"] in hosts]
    assert len(large) > 150 and all(found[p] == marked[p] for p in large)
    assert all(by_marks[p] != marked[p] for p in marked)


def plain_importance(pages):
    """Node -> importance by plain loops over one host's pages, and the parents."""
    S = style_tree
    parsed = [S.Page(p, "h") for p in pages]
    nodes = {}
    for q in parsed:
        nodes |= q.nodes
    info = {}
    for n, (_, mark) in nodes.items():
        mine = [q for q in parsed if n in q.nodes]
        own = [[t for t, at, _ in q.blocks if at == n] for q in mine]
        said = ["\n".join(x) for x in own if x]
        words = [sum(len(t.split()) for t in x) for x in own]
        d = {"mark": mark, "pages": len(mine), "own": sum(words), "linked": sum(min(q.links[n], w) for q, w in zip(mine, words))}
        d["around"] = sum(sum(len(t.split()) for t, _, _ in q.blocks) for q in mine)
        d["free"] = sum(w for q, w in zip(mine, words) if not q.has_content)
        styles = [" ".join(q.styles.get(n, ())) for q in mine]
        m = len(mine)
        d["presentation"] = 1.0 if m == 1 else sum(-styles.count(s) / m * math.log(styles.count(s) / m, m) for s in set(styles))
        d["content"] = None
        if said:
            k = len(said)
            differ = 1.0 if k == 1 else (1 - sum(math.log(said.count(s), k) for s in set(said)) / len(set(said))) * sum(said.count(s) == 1 for s in said) / k
            d["content"] = (k * differ + S.PRIOR) / (k + S.PRIOR)
        info[n] = d
    below = lambda n: [c for c, (p, _) in nodes.items() if p == n]
    words = lambda n: info[n]["own"] - info[n]["linked"] + sum(words(c) for c in below(n))
    within = lambda n: n in info and (info[n]["mark"] == 1 or within(nodes[n][0]))
    headed = lambda n: info[n]["mark"] == 2 or any(headed(c) for c in below(n))
    weight, here = {}, [n for n in below(0) if info[n]["mark"] != S.CLEAR]
    while here and not any(d["mark"] == 1 for d in info.values()):
        main = max(here, key=words)
        if words(main) < S.MOST * sum(map(words, here)) or not any(map(words, below(main))):
            break
        weight |= {n: min(1.0, S.BESIDE * words(n) / max(info[n]["around"], 1)) for n in here if n != main and not headed(n)}
        here = [n for n in below(main) if info[n]["mark"] != S.CLEAR]
    out = {}

    def visit(n):
        d = info[n]
        parts = [(info[c]["pages"], visit(c)) for c in below(n)]
        if d["content"] is not None:
            parts.append((d["pages"], d["content"] * (1 - (0 if within(n) else d["linked"] / max(d["own"], 1)))))
        inner = sum(p * x for p, x in parts) / sum(p for p, _ in parts) if parts else 0.0
        x = max([S.PRESENTATION * d["presentation"] + (1 - S.PRESENTATION) * inner, *(x for _, x in parts)])
        if d["mark"] == S.CLEAR:
            x *= S.NOISE * d["free"] / max(d["around"], 1)
        elif d["mark"] == S.DOUBTFUL:
            x *= S.DOUBT * min(1.0, S.BESIDE * words(n) / max(d["around"], 1))
        elif d["mark"] < S.DOUBTFUL:
            x *= S.DOUBT
        out[n] = max(x * weight.get(n, 1.0), S.CONTENT if d["mark"] == 1 else 0.0)
        return out[n]

    for n in below(0):
        visit(n)
    return out


def test_importance_against_plain_loops(spark, monkeypatch):
    """All nodes of random sites, whatever marks, links, repeats and depths they have."""
    monkeypatch.setattr(style_tree, "FEW", 1)  # no node is summed into the one above it
    for seed in range(4):
        draw = random.Random(seed)
        pages = []
        for k in range(9):
            parts = ["<nav><a href=x>home</a> <a href=y>news</a></nav>"] if draw.random() < 0.8 else []
            for name in ("top", "ad-slot", "share-price", "box", "related-posts", "side"):
                if draw.random() < 0.7:
                    text = draw.choice(["the same", f"own words of page {k}", f"turn {k % 3}", "<a href=z>a link</a> and more", f"<h2>Head {k}</h2>", f"<ul><li>one {k}<li><a href=q>two</a></ul>"])
                    parts.append(f"<div class='{name}'><p>{text}</p></div>")
            inner = "".join(parts) + f"<div class=body><p>{' '.join(draw.choice('abcdefgh') * 3 for _ in range(20))}</p><div class='comment-on-x'>said {k}</div></div>"
            pages.append(f"<body><article>{inner}</article></body>" if seed == 3 else f"<body><div class=wrap>{inner}</div><footer>made {k}</footer></body>")
        df = spark.createDataFrame([(p, "h") for p in pages], "html string, host string")
        got = style_tree.importance(style_tree.tree(df).toPandas())
        want = plain_importance(pages)
        assert set(got) == set(want)
        assert all(math.isclose(got[n], want[n], abs_tol=1e-9) for n in want), seed


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<a b="x>y" c=\'z\'>t', "t"), ('<p a="x>t</p><p>u', "t\nu"), ("<p a='x>t</p><p b=\"1\">u", "t\nu"), ('<p a="x><p b=">">t', "\">t"), ('<p a="1"b="2>t</p><p c=3>u</p>', "t\nu"), ('<p a="', ""),
    ],
)
def test_quotes_that_are_never_closed(page, want):
    assert style_tree.Page(page).text() == want


def test_many_broken_tags_follow_one_rule():
    """The hundredth tag with an open quote is read like the first."""
    page = "".join(f"<p x='{k}' y=\">t{k}</p>" for k in range(101))
    pieces = style_tree.Page(page).text().split("\n")
    alone = [style_tree.Page(f"<p x='{k}' y=\">t{k}</p>").text() for k in range(101)]
    assert pieces[-1] == alone[-1] and re.fullmatch("t100", pieces[-1])


def test_names():
    clear = {"comments", "reader-comments", "comment-list-3", "cookieNotice", "ad", "ads-top", "share-buttons", "related-posts", "main-nav", "menu-items", "newsletterSignupForm", "footer2", "related-stories", "promo-offer", "ad-leaderboard", "share-on-facebook"}
    doubtful = {"share-price", "comment-on-trade", "related-work", "notice-of-change", "notice-of-change-box"}
    for names, mark in ((clear, style_tree.CLEAR), (doubtful, style_tree.DOUBTFUL), ({"has-sidebar", "content", "commentary", "address"}, 0)):
        assert {n: style_tree._named_noise([n], True)[1] for n in names} == dict.fromkeys(names, mark)
    assert pd.Series(sorted(style_tree.PLACES)).is_unique
