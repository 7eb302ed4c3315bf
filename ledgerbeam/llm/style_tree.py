"""Main text of web pages by site style trees.

The pages of a host are merged to one tree: a node stands for all elements that
share the chain of tags, ids and classes from the root, digits in names aside.
For every node, with m pages that have it, grouped sums give

* the entropy of its presentation styles (the tags below it, in order), base m;
* for its own text, one minus the mean over distinct texts of log_m(pages with
  that text), times the share of pages whose text no other page has: 0 if all
  pages say the same or take turns with a few texts, 1 if every page says
  something else.  Few pages tell little, so this is drawn to 1 with the weight
  of ``PRIOR`` pages: two pages that are alike leave it above ``LEAST``, three
  don't;
* its words, those in links, and those of the pages that have it.

Bottom-up the first two make a node's importance: presentation and the mean of
the nodes below it, or the text's share where it has text of its own, outside main
parts less the share of its words that are links.  Branches below ``LEAST`` are noise and are
cut from each page; that list is all that decides what a page loses.

Evidence other than entropy weighs this importance, and importance can overrule
each kind of it:

* Clear marks of noise (navigation, header, footer, aside, form, advert, notice
  and comment markup, hidden elements) multiply it by ``NOISE`` and the branch's
  share of the words of pages without a main part; such a branch stays where a
  page's words are nearly all in it.  Branches with one kind of clear mark are
  one node of the host, whatever is above them.
* Names that hold a word of noise among others (share-price, comment-on-trade)
  multiply it by ``DOUBT``, outside main parts also by place; inside one such a
  branch stays if its texts differ from page to page.
* Place: where most words of a branch are in one of the containers in it, the
  main one is looked for there; what lies beside it and has no headings is
  multiplied by ``BESIDE`` times its share of the page's words, at most 1.
* What a page marks as its article or main part has ``CONTENT`` importance at
  least, but the branches in it are judged like all others, so boilerplate
  repeated in every article goes; only a part without any important branch, an
  article repeated all over a host, is kept as it is.  The same holds for a
  host in which nothing is important.

A page yields its main part alone unless more words are left outside it, as
with a teaser card beside an unmarked body; then it yields both.

Size.  Counts are summed in the tasks before they are shuffled, 40 bytes a
distinct text at most.  Unmarked nodes on fewer than ``FEW`` pages can't come
below ``LEAST`` by their own texts; they are summed into the node above them
before the tree of a host comes to one task.  That tree so grows with the host's
templates, not with its pages or their ids.  The list of noise is stored, and
Spark joins it by broadcast only below its own size threshold.  A page is read
in time that is linear in its length; in a tag with a quote that is never closed
quotes count for nothing.

Nulls: a null html is an empty page with empty text; pages with a null url, or
none with a host, count as one host.  Null ids are kept, repeated rows are
treated one by one.  An empty table gives an empty result.  Other columns are
not returned.
"""

from __future__ import annotations

import html as markup
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_dir

LEAST = 0.25
PRIOR, FEW = 0.9, 3
NOISE = 0.3
DOUBT = 0.5
BESIDE = 3.0
CONTENT = 0.8
#: A container with this share of a branch's words is its main one.
MOST = 0.6
#: Weight of a node's own presentation against the nodes below it.
PRESENTATION = 0.1
#: Distinct counts that a task holds before it passes them on.
HELD = 200_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg canvas select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that never hold main text.
NOISE_TAGS = frozenset("head nav footer aside form menu button dialog label fieldset audio video map".split()) | RAW
CONTENT_TAGS = frozenset(("article", "main"))
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Parts of class and id names, between hyphens, underscores and changes of case.
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer comments comment disqus respond share sharing social related recommended pagination pager".split()
)
#: Parts of names that say where or in what something stands; after a part that marks noise they leave the mark clear.
PLACES = frozenset(
    "all also area article author avatar bar block blog body bottom box button card carousel cell center close closed col column container content count counter desktop email end entry "
    "facebook feed field fixed floating foot form frame full gallery grid group head heading header hero hidden holder home icon image img inline inner input item label large layer leaderboard "
    "left like link list load logo main meta mid middle mobile module more native new next now offer on outer page pane panel part place player policy post prev previous rail read reader reading "
    "reply respond right row section short side site skyscraper slot small space square static sticky stack story strip tab table tablet teaser text this thread ticker tile title toggle tool top "
    "twitter unit up us user video view website wide wrap wrapper you zone".split()
)
#: Parts of names that mark noise outside main parts only; in an article they may hold its title.
OUTER_NAMES = frozenset("header masthead banner toolbar widget".split())
#: First parts of names that tell of a page's state, not of what an element holds.
STATES = frozenset("has with without no not is show hide js wp enable enabled".split())
#: Elements that are never noise by name.
FRAMES = frozenset("html body main".split())
#: Elements that an opening tag of the same group closes.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table body html article section main div td th nav aside footer header form blockquote".split())

#: A tag; with an unclosed quote only the second form matches, where quotes count for nothing.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)")
STOP = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"(?<![a-zA-Z_:-])([a-zA-Z_:-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
DIGITS = re.compile("[0-9]+")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def host_of(url):
    """The host of a Column of addresses, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


CLEAR, DOUBTFUL = -1, -2
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _named_noise(names: list[str], inside: bool) -> tuple[str, int]:
    """The first part of a name that marks noise, or nothing, and whether the mark is clear: it ends the name, or is followed by
    places alone."""
    wanted, doubt = NOISE_NAMES if inside else NOISE_NAMES | OUTER_NAMES, ""
    for name in names:
        parts = [p.lower() for p in NAME_PART.findall(name)]
        if parts and parts[0] not in STATES:
            for k, p in enumerate(parts):
                if p in wanted:
                    if all(len(x) < 2 or x in wanted or x in PLACES or x.removesuffix("s") in PLACES or x.endswith("ies") and x[:-3] + "y" in PLACES for x in parts[k + 1 :]):
                        return p, CLEAR
                    doubt = doubt or p
    return doubt, DOUBTFUL if doubt else 0


def _marks(tag: str, attrs: str, inside: bool) -> tuple[str, str, int]:
    """The style (ids and classes) of an opening tag, the kind of noise it is marked as, if any, and its mark: CLEAR, DOUBTFUL, 1 for
    content, 2 for headings, 0; inside: within a main part."""
    kind, mark = (tag, CLEAR) if tag in NOISE_TAGS else ("", 1 if tag in CONTENT_TAGS else 2 if tag in HEADINGS else 0)
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return "", kind, mark
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)}
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    role = found.get("role", "").lower()
    style = DIGITS.sub("#", " ".join(sorted(names)))
    if kind:
        return style, kind, mark
    if tag not in FRAMES:
        kind, named = _named_noise(names, inside)
        if named == CLEAR:
            return style, kind, named
    if role in NOISE_ROLES:
        return style, role, CLEAR
    if (
        found.get("aria-hidden") == "true"
        or "display:none" in found.get("style", "").replace(" ", "").lower()
        or re.search(r"(?:^|\s)hidden(?:\s|$|/)", attrs)
    ):
        return style, "hidden", CLEAR
    if tag in CONTENT_TAGS or role == "main" or found.get("itemprop", "").lower() == "articlebody":
        return style, "", 1
    return style, "", DOUBTFUL if kind else mark


class _Tags:
    """Tags of a text.  A walk over quotes that comes to one that is never closed is remembered, so no stretch is walked twice."""

    def __init__(self, text: str):
        self.text, self.dead, self.last = text, set(), {q: text.rfind(q) for q in "\"'"}

    def _closed(self, at: int) -> bool:
        """Whether the tag whose attributes begin at at ends with all quotes closed."""
        seen = []
        while m := STOP.search(self.text, at):
            if m[0] == ">":
                return True
            if m.start() >= self.last[m[0]]:
                break
            at = self.text.find(m[0], m.end()) + 1
            if at in self.dead:
                break
            seen.append(at)
        else:
            return True
        self.dead.update(seen)
        return False

    def match(self, at: int):
        """The tag at at; where a quote in it is never closed, quotes count for nothing."""
        if not self.dead and (m := TAG.match(self.text, at)):
            return m
        m = LOOSE.match(self.text, at)
        if not m or not self._closed(m.start(3)):
            self.dead.add(-1)
            return m
        return TAG.match(self.text, at)


class _Open(NamedTuple):
    """An open element."""

    tag: str
    node: int
    noise: bool  # in a branch marked as noise
    content: bool  # in a main part
    block: int  # the node that its text belongs to
    buffer: list  # its block's text so far; branches of noise have their own
    p: int  # place of the paragraph that the next block closes, if any


class Page:
    """One pass over a page: its nodes, for the tree, and its text blocks."""

    def __init__(self, text: str, host: str = ""):
        from xxhash import xxh64_intdigest

        self.key = lambda parent, style: xxh64_intdigest(f"{host}\n{parent}\n{style}") >> 1
        #: node -> (parent, mark); a node comes after its parent
        self.nodes: dict[int, tuple[int, int]] = {}
        self.styles: dict[int, list[str]] = {}
        #: node -> words in links
        self.links: Counter = Counter()
        #: (text, node, in content)
        self.blocks: list[tuple[str, int, bool]] = []
        self.has_content = False
        self._parse(text)

    def _parse(self, text: str) -> None:
        stack = [_Open("", 0, False, False, 0, [], 0)]
        count: Counter = Counter()
        tags, at, pos = _Tags(text), 0, 0

        def flush(e: _Open) -> None:
            if e.buffer:
                words = " ".join(markup.unescape("".join(e.buffer)).split())
                e.buffer.clear()
                if words:
                    self.blocks.append((words, e.block, e.content))

        def pop(k: int) -> None:
            while len(stack) > k:
                e = stack.pop()
                count[e.tag] -= 1
                if e.noise and not stack[-1].noise:
                    flush(e)

        def close(tags, until) -> None:
            if not any(count[t] for t in tags):
                return
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in tags:
                    flush(stack[-1])
                    pop(k)
                    return
                if stack[k].tag in until:
                    return

        while (lt := text.find("<", pos)) >= 0:
            c, m = text[lt + 1 : lt + 2], None
            if "a" <= c.lower() <= "z" or c == "/" and text[lt + 2 : lt + 3].isalpha():
                if not (m := tags.match(lt)):
                    pos = lt + 1
                    continue
                end = m.end()
            elif text.startswith("<!--", lt):
                end = text.find("-->", lt + 4) + 3
                end = end if end > 2 else len(text)
            elif c and c in "!?/":
                end = text.find(">", lt) + 1 or len(text)
            else:
                pos = lt + 1
                continue
            if lt > at:
                stack[-1].buffer.append(text[at:lt])
                if count["a"]:
                    self.links[stack[-1].block] += len(text[at:lt].split())
            at = pos = end
            if not m:
                continue
            tag = m[2].lower()
            if m[1]:
                if count[tag] > 0:
                    k = len(stack) - 1
                    while stack[k].tag != tag:
                        k -= 1
                    if tag in BLOCKS:
                        flush(stack[-1])
                    pop(k)
                if tag == "br":
                    stack[-1].buffer.append(" ")
                continue
            if tag in BLOCKS:
                flush(stack[-1])
                if stack[-1].p:
                    pop(stack[-1].p)
                    flush(stack[-1])
            if tag in SIBLINGS:
                close(SIBLINGS[tag], SCOPE - {"td", "th"} if tag == "tr" else SCOPE)
            if tag in VOID:
                if tag == "br":
                    stack[-1].buffer.append(" ")
                continue
            if tag in RAW:
                ended = re.compile(f"</{re.escape(tag)}[^>]*(?:>|$)", re.I).search(text, at)
                at = pos = ended.end() if ended else len(text)
                continue
            above = stack[-1]
            style, kind, mark = _marks(tag, m[3], above.content)
            if tag == "header" and not above.content and not kind:
                kind, mark = tag, CLEAR
            is_content = mark == 1
            node, content, block, buffer = above.node, above.content, above.block, above.buffer
            if not above.noise:
                if kind:  # one node for all such branches of the host
                    node = block = self.key(0, f"!{tag} {kind}")
                    self.nodes.setdefault(node, (0, CLEAR))
                    buffer = []
                elif is_content or tag in BLOCKS:
                    node = self.key(above.node, f"{tag} {style}")
                    # a doubtful mark inside a main part is told from one outside
                    mark = 0 if is_content and content else DOUBTFUL - 1 if mark == DOUBTFUL and content else mark
                    self.nodes.setdefault(node, (above.node, mark))
                    block = node if tag in BLOCKS else block
                if kind or is_content or tag in BLOCKS:
                    self.styles.setdefault(above.node, []).append(tag)
                if is_content and not kind:
                    content = self.has_content = True
            p = len(stack) if tag == "p" else 0 if tag in SCOPE else above.p
            count[tag] += 1
            stack.append(_Open(tag, node, above.noise or bool(kind), content, block, buffer, p))
        if at < len(text):
            stack[-1].buffer.append(text[at:])
        while stack[-1].noise:
            pop(len(stack) - 1)
        flush(stack[-1])

    def text(self, noise: frozenset | set | None = None) -> str:
        """The blocks that aren't below a node of noise, one line each; noise None: the marks alone decide."""
        low: dict[int, bool] = {0: False}
        for node, (parent, mark) in self.nodes.items():
            low[node] = low[parent] or (mark == CLEAR if noise is None else node in noise)
        left = [(t, content) for t, node, content in self.blocks if not low[node]]
        if self.has_content:
            inside, outside = (sum(t.count(" ") + 1 for t, content in left if content == side) for side in (True, False))
            if outside <= inside:
                left = [x for x in left if x[1]]
        return "\n".join(t for t, _ in left)


NODE, STYLE, TEXT, WORDS = 0, 1, 2, 3
#: Features of WORDS: a node's own, those in links, and those that can overrule a clear mark; words of the pages that have it.
OWN, LINKED, FREE, AROUND = 0, 1, 2, 3


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each node, style and text of a node: the number of pages that have it; nodes by whether they hold text."""
    from xxhash import xxh64_intdigest

    held: Counter = Counter()

    def frame() -> pd.DataFrame:
        rows = [(*k, v) for k, v in held.items()]
        held.clear()
        return pd.DataFrame(rows, columns=["host", "node", "parent", "mark", "kind", "feature", "pages"])

    for pdf in batches:
        for text, host in zip(pdf["html"], pdf["host"], strict=True):
            page = Page(text if isinstance(text, str) else "", host)
            texts: dict[int, list[str]] = {}
            size: Counter = Counter()
            for words, node, _ in page.blocks:
                size[node] += words.count(" ") + 1
                if node:
                    texts.setdefault(node, []).append(words)
            around = size.total()
            full = set(texts)
            for node, (parent, _) in reversed(page.nodes.items()):
                if node in full:
                    full.add(parent)
            for node, (parent, mark) in page.nodes.items():
                held[(host, node, parent, mark, NODE, int(node in full))] += 1
                for feature, n in ((OWN, size[node]), (LINKED, min(page.links[node], size[node])), (FREE, 0 if page.has_content else size[node]), (AROUND, around)):
                    if n:
                        held[(None, node, -1, NO_MARK, WORDS, feature)] += n
                held[(None, node, -1, NO_MARK, STYLE, xxh64_intdigest(" ".join(page.styles.get(node, ()))) >> 1)] += 1
                if node in texts:
                    held[(None, node, -1, NO_MARK, TEXT, xxh64_intdigest("\n".join(texts[node])) >> 1)] += 1
            if len(held) > HELD:
                yield frame()
    if held:
        yield frame()


#: Less than any mark.
NO_MARK = -9
COUNTS = "host string, node bigint, parent bigint, mark int, kind int, feature bigint, pages bigint"


def tree(pages: DataFrame) -> DataFrame:
    """The merged trees: host, node, parent, mark, pages, presentation (entropy), content (importance of its own text, null without any),
    and words: own, linked, free and around, as OWN to AROUND.

    Unmarked nodes on fewer than FEW pages are summed into those above them: rare (their pages), rare_sum (of pages
    times importance) and rare_max.
    """
    counts = pages.select("html", "host").mapInPandas(_counts, COUNTS)
    counts = counts.groupBy("node", "kind", "feature").agg(F.sum("pages").alias("c"), F.max("host").alias("host"), F.max("parent").alias("parent"), F.max("mark").alias("mark"))
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
    log = F.log(F.col("c").cast("double"))
    words = lambda feature: F.coalesce(F.sum(F.when((F.col("kind") == WORDS) & (F.col("feature") == feature), F.col("c"))), F.lit(0))
    by = counts.groupBy("node").agg(
        F.max("host").alias("host"), F.max("parent").alias("parent"), F.max("mark").alias("mark"), of(NODE, F.col("c")).alias("pages"),
        F.max(F.when(F.col("kind") == NODE, F.col("feature"))).alias("full"),
        of(STYLE, F.col("c") * log).alias("styles"), of(TEXT, log).alias("logs"), of(TEXT, F.lit(1)).alias("texts"),
        of(TEXT, (F.col("c") == 1).cast("int")).alias("single"), of(TEXT, F.col("c")).alias("with_text"),
        words(OWN).alias("own"), words(LINKED).alias("linked"), words(FREE).alias("free"), words(AROUND).alias("around"),
    )
    m = F.col("with_text").cast("double")
    base, entropy_base = F.log(F.greatest(F.lit(2.0), F.col("pages").cast("double"))), F.log(F.greatest(F.lit(2.0), m))
    differ = F.when(m > 1, (1 - F.col("logs") / F.col("texts") / entropy_base) * F.col("single") / m).otherwise(F.lit(1.0))
    by = cut(by.select(
        "host", "node", "parent", "mark", "pages", F.when(F.col("full") == 1, 1.0).otherwise(PRESENTATION).alias("alone"),
        F.when(F.col("pages") > 1, (base - F.col("styles") / F.col("pages")) / base).otherwise(F.lit(1.0)).alias("presentation"),
        F.when(F.col("texts") > 0, (m * differ + PRIOR) / (m + PRIOR)).alias("content"), "own", "linked", "free", "around",
    ))
    rare = (F.col("pages") < FEW) & F.col("mark").isin(0, 2)
    sums = by.where(rare).groupBy(F.col("parent").alias("of")).agg(
        F.sum("pages").alias("rare"), F.sum(F.col("pages") * F.col("alone")).alias("rare_sum"), F.max("alone").alias("rare_max")
    )
    return by.where(~rare).join(sums, F.col("node") == F.col("of"), "left").drop("of", "alone").na.fill(0, ["rare", "rare_sum", "rare_max"])


def _beside(rows: dict, below: dict[int, list[int]], words: dict[int, int], headed: dict[int, bool]) -> dict[int, float]:
    """The weight by place of branches that lie beside the main one: BESIDE times their share of their pages' words."""
    out: dict[int, float] = {}
    here = [n for n, r in rows.items() if r.parent not in rows and r.mark != CLEAR]
    while here:
        total = sum(words[n] for n in here)
        main = max(here, key=lambda n: words[n])
        if words[main] < MOST * total or not any(words[n] for n in below.get(main, ())):
            break
        for n in here:
            if n != main and not headed[n]:
                out[n] = min(1.0, BESIDE * words[n] / max(rows[n].around, 1))
        here = [n for n in below[main] if rows[n].mark != CLEAR]
    return out


def importance(nodes: pd.DataFrame) -> dict[int, float]:
    """Importance of every node of one host's tree, from the leaves up, weighed by marks and place."""
    rows = {r.node: r for r in nodes.itertuples()}
    below: dict[int, list[int]] = {}
    for r in rows.values():
        below.setdefault(r.parent, []).append(r.node)
    out: dict[int, float] = {}
    todo = [n for n, r in rows.items() if r.parent not in rows]
    order = []
    while todo:
        n = todo.pop()
        order.append(n)
        todo += below.get(n, [])
    inside: set[int] = set()
    for n in order:
        if rows[n].mark == 1 or rows[n].parent in inside:
            inside.add(n)
    words: dict[int, int] = {}
    headed: dict[int, bool] = {}
    for n in reversed(order):
        words[n] = int(rows[n].own - rows[n].linked) + sum(words[k] for k in below.get(n, ()))
        headed[n] = rows[n].mark == 2 or any(headed[k] for k in below.get(n, ()))
    # main parts that are marked say where the text is
    place = {} if any(r.mark == 1 for r in rows.values()) else _beside(rows, below, words, headed)

    def all_important(n: int) -> None:
        todo = [n]
        while todo:
            k = todo.pop()
            if rows[k].mark != CLEAR:
                out[k] = 1.0
                todo += below.get(k, ())

    for n in reversed(order):
        r = rows[n]
        parts = [(rows[k].pages, out[k]) for k in below.get(n, ())]
        if r.content == r.content and r.content is not None:
            parts.append((r.pages, float(r.content) * (1 - (0 if n in inside else r.linked / max(r.own, 1)))))
        total, best = r.rare + sum(p for p, _ in parts), max((x for _, x in parts), default=0.0)
        inner = (r.rare_sum + sum(p * x for p, x in parts)) / total if total else 0.0
        # a node stays if it has any important branch
        x = max(PRESENTATION * float(r.presentation) + (1 - PRESENTATION) * inner, best, r.rare_max)
        if r.mark == CLEAR:
            x *= NOISE * r.free / max(r.around, 1)
        elif r.mark <= DOUBTFUL:
            x *= DOUBT * (1.0 if r.mark < DOUBTFUL else min(1.0, BESIDE * words[n] / max(r.around, 1)))
        out[n] = x * place.get(n, 1.0)
        if r.mark == 1:
            if out[n] < LEAST:  # wholly repeated: nothing in it tells the article from the rest, so the mark decides
                all_important(n)
            out[n] = max(out[n], CONTENT)
    tops = [n for n in order if rows[n].parent not in rows]
    if all(out[n] < LEAST for n in tops):  # wholly repeated, without a main part
        for n in tops:
            all_important(n)
    return out


def noise(nodes: DataFrame) -> DataFrame:
    """host and its noise: the nodes of little importance whose parents are important."""

    def of_host(pdf: pd.DataFrame) -> pd.DataFrame:
        parent = dict(zip(pdf["node"], pdf["parent"], strict=True))
        found = importance(pdf)
        low = {n for n, x in found.items() if not x >= LEAST}
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "noise": [[n for n in low if parent[n] not in low]]})

    return nodes.groupBy("host").applyInPandas(of_host, "host string, noise array<bigint>")


def extract(pages: DataFrame, hook=None) -> DataFrame:
    """page_id, url, text, n_chars; hook, if given, changes the list of noise (host, noise) before it is used."""
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), host_of(F.col("url")).alias("host"), "html")
    where = f"{shared_dir(pages.sparkSession)}/style-tree-{uuid.uuid4().hex}"
    low = noise(tree(rows))
    (low if hook is None else hook(low)).write.parquet(where)
    low = pages.sparkSession.read.parquet(where)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, frozenset] = {}  # of the hosts of one batch
        for pdf in batches:
            known.clear()
            texts = []
            for text, host, low in zip(pdf["html"], pdf["host"], pdf["noise"], strict=True):
                if host not in known:
                    known[host] = frozenset(() if low is None else low.tolist())
                texts.append(Page(text if isinstance(text, str) else "", host).text(known[host]))
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts})

    joined = rows.join(low, "host", "left").select("page_id", "url", "host", "html", "noise")
    return joined.mapInPandas(run, "page_id string, url string, text string").withColumn("page_id", F.col("page_id").cast("bigint")).withColumn("n_chars", F.char_length("text").cast("bigint"))
