import base64
import hashlib
import html as markup
import io
import random
import re
import struct
import time
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerbeam.llm import chat, language_id, queries, style_tree, warc_zip
from tests.conftest import SMALL

PAGES = "page_id bigint, url string, html string"
ODD = [(1, "http://h.example.com/a", "aa"), (2, "http://h.example.com/b", "aa"), (3, None, None), (None, "u", "aa"), (5, "u\r\nX: y", ""), (2**60 + 1, "u", "é" * 50_000), (7, "u", "b"), (7, "u", "b")]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ODD, PAGES)


def test_archives_round_trip(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/a"
    manifest = warc_zip.write(pages.withColumn("payload", F.lit(1)), folder)
    rows = warc_zip.read(manifest, folder).collect()
    assert sorted(str(r["page_id"]) for r in rows) == sorted(str(p) for p, _, _ in ODD)
    last = {}
    for page, _, text in ODD:
        last[text or ""] = max(last.get(text or "", -1), -1 if page is None else page)
    html = {p: (t or "").encode() for p, _, t in ODD}
    for r in rows:
        raw = html[r["page_id"]]
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        if r["page_id"] == last[raw.decode()]:
            assert r["record_type"] == "response" and r["refers_to"] is None and bytes(r["payload"]) == raw
        else:
            assert r["record_type"] == "revisit" and r["refers_to"] == last[raw.decode()]
    for m in manifest.collect():
        with zipfile.ZipFile(m["archive"]) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}


def test_payload_of_very_many_pages(spark, tmp_path):
    """One payload in most rows, many archives' parts: each record is read once, and by more than one task."""
    rows = spark.range(12_000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("same").alias("html"))
    manifest = warc_zip.write(rows.coalesce(1), f"file://{tmp_path}/many")
    assert all(m["marks"] == sorted(set(m["marks"])) and len(m["marks"]) == -(-m["records"] // warc_zip.READ_RECORDS) + 1 for m in manifest.collect())
    read = warc_zip.read(manifest, f"file://{tmp_path}/many", payloads=False)
    assert read.rdd.getNumPartitions() > 1
    got = read.groupBy("record_type", "refers_to").count().orderBy("count").collect()
    assert read.select("page_id").distinct().count() == 12_000 and got[-1]["refers_to"] == 11_999 and got[-1]["count"] == 10_799 and got[-2]["count"] == 1201


def test_least_and_empty(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/b"
    rows = warc_zip.read(warc_zip.write(pages, folder, least=3), folder).collect()
    assert {r["record_type"] for r in rows} == {"response"}
    none = warc_zip.write(pages.limit(0), f"file://{tmp_path}/c")
    assert none.count() == 0 and warc_zip.read(none, folder).count() == 0


@pytest.mark.parametrize("force64", [False, True])
def test_directories_by_the_standard_library(force64):
    out = io.BytesIO()
    z = warc_zip.ZipWriter(out, force64)
    for name, data in (("a/ü", b"hello"), ("empty", b"")):
        z.begin(name)
        z.data(data)
        z.end()
    z.close()
    found = warc_zip.directory(out, z.at)
    for name, data in (("a/ü", b"hello"), ("empty", b"")):
        at, n = found[name]
        assert out.getvalue()[at : at + n] == data and zipfile.ZipFile(out).read(name) == data
    with pytest.raises(ValueError):
        warc_zip.directory(io.BytesIO(out.getvalue()[:-30]), z.at - 30)


def test_foreign_archives():
    """Deflated members are left out, comments and prefixed data are handled."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("deflated", b"x" * 100, zipfile.ZIP_DEFLATED)
        z.writestr("stored", b"abc")
        z.comment = b"some comment PK\5\6"
    found = warc_zip.directory(out, len(out.getvalue()))
    assert list(found) == ["stored"] and out.getvalue()[found["stored"][0] :][:3] == b"abc"
    with out as f:
        assert struct.unpack("<I", f.getvalue()[:4])[0] == 0x04034B50


HEAD = "<html><head><title>t</title><style>p{}</style><script>var x='</p>';</script></head><body>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<nav>m</nav><div class='ad'>buy</div><article><h1>T &amp; U</h1><p><b>one\n two<br><p>three</article><footer>f</footer>", "T & U\none two\nthree"),
        ("<header>top</header><div id=main>Hello <b>wor</b>ld<p>para <a href=x>link</a> tail<ul><li>one<li>two</ul><form>f<input></form></div><section class=comments>c</section>", "Hello world\npara link tail\none\ntwo"),
        ("<main><article><header><h1>T</h1></header><p>a<aside>no</aside><p>b</article><div class='reader-comments'><article>c</article></div></main>", "T\na\nb"),
        ("<article><p>a<!-- no <p> --> b<noscript>n</noscript></p><table><tr><td>1<td>2</table><p hidden>h</p><div class=cookieNotice>c</div></article>", "a b\n1\n2"),
        ("<article><p>1 < 2 &lt; 3 &copy; &#x41;&nbsp;</p>", "1 < 2 < 3 © A"),
        ("<div role=navigation>x</div><p>y", "y"),
        ("", ""),
        ("<div class='page has-sidebar no-comments'><main class='banner-shown'><div class='entry-header'><h1>T</h1></div><p>a <math>x</math></main><div class=header>h</div></div>", "T\na x"),
        ('<p title="open>x</p><p>y', "x\ny"),
        ("<p>a<b>b</b><i>c</i> <span class='ad'>d</span>e<!-- <p> -->f", "abc ef"),
    ],
)
def test_pages(page, want):
    assert style_tree.Page(HEAD + page).text() == want


def test_tree_finds_repeated_branches(spark):
    """Unmarked text that all pages of a host share goes, text that differs stays; another host keeps the same text."""
    page = "<body><div class=top>Welcome to our site</div><div class=x><p>{}</p></div></body>"
    rows = [(k, "http://a.example.com/", page.format(f"own text {k}")) for k in range(12)] + [(100, "http://b.example.com/", page.format("other"))]
    out = {r["page_id"]: r["text"] for r in style_tree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[3] == "own text 3" and out[100] == "Welcome to our site\nother"


def test_articles_repeated_on_a_host_stay(spark):
    rows = [(k, "http://a.example.com/", "<article><p>same for all</article>") for k in range(10)]
    assert {r["text"] for r in style_tree.extract(spark.createDataFrame(rows, PAGES)).collect()} == {"same for all"}


def test_tree_decides_inside_and_beside_main_parts(spark):
    """Boilerplate repeated in every article goes; a teaser card doesn't hide an unmarked body."""
    page = "<body><article><h1>Title {0}</h1><p>own text {0}</p><div class=z1>Read us every day</div></article></body>"
    card = "<body><article class=teaser><p>card {0}</p></article><div class=x><p>body text of page {0}, longer than the card</p></div></body>"
    rows = [(k, "http://a.example.com/", page.format(k)) for k in range(12)] + [(100 + k, "http://b.example.com/", card.format(k)) for k in range(12)]
    out = {r["page_id"]: r["text"] for r in style_tree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[3] == "Title 3\nown text 3" and out[103] == "card 3\nbody text of page 3, longer than the card"


def test_extraction_query_by_a_plain_version(spark):
    got = {r["page_id"]: r for r in queries.op6_html_extraction(spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        blocks = [" ".join(markup.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert got[p["page_id"]]["text"] == want and got[p["page_id"]]["n_chars"] == len(want)


def test_the_tree_decides_on_the_table(spark):
    """Without the list of noise, menus, adverts and footers come into the texts of pages whose article is the lesser part."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("html", F.regexp_replace("html", "</?article>", ""))
    empty = lambda low: low.withColumn("noise", F.array().cast("array<bigint>"))
    with_list = {r["page_id"]: r["text"] for r in style_tree.extract(pages).collect()}
    without = {r["page_id"]: r["text"] for r in style_tree.extract(pages, empty).collect()}
    assert all(without[p] != t and len(without[p]) > len(t) for p, t in with_list.items())
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert with_list == {r["page_id"]: r["text"] for r in style_tree.extract(pages).collect()}


@pytest.mark.parametrize("piece", ['<a "x', "<a 'x", "<div>", "<b>", "</x><b>", "<p><b>", "<script>", "<!--", "<", "</", "<a b=", "<li><b>", "<span class=ad>", "<div a" + "a" * 200, "&amp"])
def test_long_broken_pages_take_linear_time(piece):
    began = time.process_time()
    page = style_tree.Page(piece * (1_000_000 // len(piece)), "h")
    page.text(), page.text(set())
    assert time.process_time() - began < 30


def test_ids_of_pages_do_not_grow_the_tree(spark):
    """Ids that only one page has, by number or by name, leave a tree of the templates; the text in them stays."""
    page = "<body><div id=post-{0}><div class={1}><p>own text {0}</p></div></div><div class=top>Welcome</div></body>"
    rows = [(k, "http://a.example.com/", page.format(k, "n" + chr(97 + k % 26) * (k // 26 + 1))) for k in range(60)]
    df = spark.createDataFrame(rows, PAGES)
    assert style_tree.tree(df.withColumn("host", style_tree.host_of(F.col("url")))).count() < 6
    assert {r["text"] for r in style_tree.extract(df).collect()} == {f"own text {k}" for k in range(60)}


def test_extraction_edges(spark, pages):
    out = style_tree.extract(pages.withColumns({"host": F.lit(1), "text": F.lit(2), "noise": F.lit(3)})).collect()
    assert len(out) == len(ODD) and all(r["text"] is not None for r in out)
    assert style_tree.extract(pages.limit(0)).count() == 0


CONV = "conv_id bigint, turn bigint, role string, text string"
TALK = [
    (1, 0, "system", "be <|x|> <!!| good"), (1, 1, "user", "a b c"), (1, 2, "assistant", "x " * 30), (1, 3, "user", "q"), (1, 4, "assistant", None), (1, 5, "user", "z " * 50),
    (1, 6, "assistant", "<|im_end|>ok\n"), (1, 6, "assistant", "<|im_end|>ok\n"), (2, None, "us\ner<|", "<!|<|im_start|>assistant\n"), (2, 1, "assistant", "<|im_end|>"), (None, None, None, None), (3, 0, "assistant", ""),
]


@pytest.mark.parametrize(("budget", "history"), [(20, 10), (1, 0), (10_000, 500)])
def test_chat_round_trip(spark, budget, history):
    rows = spark.createDataFrame(TALK, CONV).withColumns({"window": F.lit(1), "loss": F.lit(2)})
    made = chat.windows(rows, budget, history)
    read = chat.read_back(made).collect()
    for conv in {t[0] for t in TALK}:
        want = sorted(((t[1] if t[1] is not None else -1), t[2] or "", t[3] or "") for t in TALK if t[0] == conv)
        own = sorted((r for r in read if r["conv_id"] == conv), key=lambda r: r["window"])
        assert [(t["role"], t["text"]) for r in own for t in r["turns"]] == [(r, x) for _, r, x in want]
        assert [x for r in own for x in r["targets"]] == [x for _, r, x in want if r == "assistant"]
        if conv == 1:
            assert all(r["formatted"].startswith("<|im_start|>system\n") for r in own)
        assert all(r["formatted"].count("<|im_end|>") == r["formatted"].count("<|im_start|>") for r in own)
    assert "Python" not in made._jdf.queryExecution().toString()


def test_history_is_repeated_and_masked(spark):
    made = {r["window"]: r for r in chat.windows(spark.createDataFrame(TALK[:5], CONV), 200, 130).collect()}
    last = made[max(made)]
    assert len(made) > 1 and last["repeated"] >= 2 and len(last["loss"]) == 1


def written(role, text):
    """The bytes of a turn as it is written."""
    return len(f"<|im_start|>{role}\n{text}<|im_end|>\n".encode())


@pytest.mark.parametrize("system", [0, 300, 950, 2000])
def test_windows_keep_the_budget(spark, system):
    """Only windows of a single turn that doesn't fit beside the system turn are larger than the budget."""
    rng = random.Random(system)
    rows = [(1, 0, "system", "s" * system)] if system else []
    rows += [(1, k, "user" if k % 2 else "assistant", "w" * rng.choice([1, 30, 90, 300, 1000, 1500])) for k in range(1, 200)]
    made = chat.windows(spark.createDataFrame(rows, CONV)).collect()
    opened = written(*rows[0][2:]) if system else 0
    over = 0
    for r in made:
        turns = re.findall(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", r["formatted"], re.S)
        size = len(r["formatted"].encode())
        assert size == sum(written(*t) for t in turns)
        own = [t for t in turns[r["repeated"] :] if t[0] != "system"]
        assert size <= 1024 or len(own) == 1 and opened + written(*own[0]) > 1024 or not own and opened > 1024
        over += size > 1024
    assert over < len(made) or system > 900
    assert system or over == sum(written(*t[2:]) > 1024 for t in rows)


@pytest.mark.parametrize("kind", ["english", "code", "chinese", "mixed"])
def test_windows_keep_the_budget_in_ids(spark, kind):
    """In the ids of the given tokenizers no window of several turns has more than the budget."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from ledgerbeam.llm import byte_bpe

    rng = random.Random(5)
    code = "for i in range(10):\n    x[i] += f(y, {'k': i}) // 2  # <|x|>\n"
    chinese = "今天天气很好我们去公园散步然后回家吃饭看书"
    english = "The quick brown fox jumps over the lazy dog, and thonrest ablently. "
    draw = {"english": lambda: english, "code": lambda: code, "chinese": lambda: "".join(rng.choice(chinese) for _ in range(20)), "mixed": lambda: rng.choice([english, code, chinese, "😀é\x00\u200b"])}[kind]
    rows = [(1, 0, "system", draw())] + [(1, k, "user" if k % 2 else "assistant", "".join(draw() for _ in range(rng.choice([1, 1, 2, 3, 8])))) for k in range(1, 150)]
    made = chat.windows(spark.createDataFrame(rows, CONV)).collect()
    tokenizer, merge = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), byte_bpe.merger(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    several = [r["formatted"] for r in made if r["formatted"].count("<|im_start|>") > 2]
    assert len(several) > 10
    for text in several:
        assert len(tokenizer.encode(text, add_special_tokens=False).ids) <= 1024
        assert sum(len(merge(w)) for w in byte_bpe.splitter(public_tokenizers.PATTERN)(text)) <= 1024


def test_known_sizes_fill_windows(spark):
    """With the tokens of each turn at hand, windows hold that many."""
    rows = [(1, k, "user", f"turn {k}", 100 if k % 2 else None) for k in range(40)]
    made = chat.windows(spark.createDataFrame(rows, CONV + ", n int"), 1024, 0, size="n").orderBy("window").collect()
    held = [sum(104 if int(t) % 2 else 4 for t in re.findall(r"\nturn (\d+)<", r["formatted"])) for r in made]
    assert max(held) <= 1024 and sum(held) == 20 * 108 and len(made) <= 4


def test_long_conversations_take_linear_time(spark):
    took = []
    for n in (20_000, 80_000):
        df = spark.range(n).selectExpr("1 AS conv_id", "id AS turn", "'user' AS role", "'a b c' AS text")
        began = time.monotonic()
        assert chat.windows(df).count() > n * 7 / 1100
        took.append(time.monotonic() - began)
    assert took[1] < 8 * took[0] + 10


def test_chat_of_nothing(spark):
    assert chat.windows(spark.createDataFrame([], CONV)).count() == 0


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.select("doc_id", "text", "lang"), per_language=40)
    none = F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", F.col("lang").alias("truth"), none.alias("declared"), F.col("source").alias("host"), none.alias("suffix"), none.alias("path_lang"))
    got = language_id.identify(rows, model).collect()
    assert sum(r["lang"] == r["truth"] for r in got) >= 0.99 * len(got) and all(0 < r["probability"] <= 1 for r in got)


def test_every_labelled_language_is_in_the_model(spark):
    """More languages than 64, the last of them with the fewest rows."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k: letters[k % 26] * 2 + letters[k // 26] + "qz"
    rows = [(100 * k + j, f"{word(k)} " * 5, f"l{k:02}") for k in range(70) for j in range(2 if k < 69 else 1)]
    langs, logs = language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert langs == [f"l{k:02}" for k in range(70)] and logs.shape[0] == 70
    assert all(logs[:, language_id.trigrams(f"{word(k)} " * 5)].sum(1).argmax() == k for k in range(70))


def test_evidence_decides_without_text(spark):
    """An empty page takes the language its declaration and host speak for; a clear text overrides both."""
    model = (["de", "en"], language_id.np.log(language_id.np.full((2, language_id.SLOTS), 1.0 / language_id.SLOTS, "float32")))
    slots = language_id.trigrams("der die und das")
    model[1][0, slots] += 8
    en = language_id.trigrams("the and of with")
    model[1][1, en] += 8
    rows = [(k, "the and of with", "en", "en.example.com", "com", "en") for k in range(20)] + [(k, "der die und das", "de", "de.example.org", "org", "de") for k in range(20, 40)]
    rows += [(40, "", "de", "de.example.org", "org", None), (41, None, None, None, None, None), (42, "the and of with", "de", "de.example.org", "org", "de")]
    df = spark.createDataFrame(rows, "page_id int, text string, declared string, host string, suffix string, path_lang string").withColumns({"lang": F.lit("x"), "p": F.lit(1), "row": F.lit(1)})
    got = {r["page_id"]: r for r in language_id.identify(df, model).collect()}
    assert len(got) == 43 and got[40]["lang"] == "de" and got[42]["lang"] == "en" and got[41]["lang"] in ("de", "en")
    assert language_id.identify(df.limit(0), model).count() == 0 and language_id.identify(df, None).where("lang is null").count() == 43


def fused(rows, langs, logs):
    """The posteriors of rows (text, declared, host, suffix, path_lang), by loops."""
    n, soft = len(langs), lambda x: np.exp(x - np.max(x)) / np.exp(x - np.max(x)).sum()
    like = []
    for text, *_ in rows:
        total = sum((logs[:, s].astype(float) for s in language_id.trigrams(text)), np.zeros(n))
        like.append(np.maximum(language_id.TRUST * (total - total.max()), -language_id.MOST))
    p = [soft(x) for x in like]
    code = lambda c: c if c is None or c in langs else "other"
    values = [(code(r[1]), code(r[4]), r[3]) for r in rows]
    domain = lambda h: ".".join((h or "").split(".")[-3:])
    base = (sum(p) + 1 / n) / (len(rows) + 1)
    out = []
    for k, r in enumerate(rows):
        near = [x for x, q in zip(p, rows) if domain(q[2]) == domain(r[2])]
        own = [x for x, q in zip(p, rows) if q[2] == r[2]]
        up = (sum(near) + language_id.PSEUDO * base) / (len(near) + language_id.PSEUDO)
        score = like[k] + np.log((np.maximum(0, sum(own) - p[k]) + language_id.PSEUDO * up) / (len(own) - 1 + language_id.PSEUDO))
        for j in range(3):
            if values[k][j] is not None:
                by = {}
                for x, v in zip(p, values):
                    if v[j] is not None:
                        by[v[j]] = by.get(v[j], 0) + x
                score = score + np.log((by[values[k][j]] + 0.5) / (sum(by.values()) + 0.5 * len(by)))
        out.append(soft(score))
    return out


def test_fusion_by_loops(spark):
    rng = random.Random(3)
    speech = {"de": "der die und das nicht mit".split(), "en": "the and of with not is".split(), "fr": "le la et les des une".split()}
    langs, logs = language_id.train(spark.createDataFrame([(k, " ".join(rng.choices(speech[x], k=9)), x) for k, x in enumerate(list(speech) * 6)], "doc_id int, text string, lang string"))
    rows = []
    for _ in range(60):
        x = rng.choice(langs)
        pick = lambda *values: rng.choice(values)
        host = pick(None, f"{x}.a.example.com", f"w.{x}.b.example.org", "mixed.example.net")
        rows.append((pick("", " ".join(rng.choices(speech[x], k=rng.randrange(1, 9)))), pick(None, x, "xx"), host, host and host[-3:], pick(None, None, x)))
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "page_id int, text string, declared string, host string, suffix string, path_lang string")
    wanted = fused(rows, langs, logs)
    for r in language_id.identify(df, (langs, logs)).collect():
        want = wanted[r["page_id"]]
        assert r["lang"] == langs[int(want.argmax())] and np.isclose(r["probability"], want.max())


def test_unclosed_markup_takes_linear_time(spark):
    for piece in ("<script", "<!-- ", "<a ", "<style>x"):
        df = spark.createDataFrame([(1, None, piece * 100_000)], PAGES)
        began = time.monotonic()
        language_id.of_pages(df).collect()
        assert time.monotonic() - began < 20


def test_pages_evidence(spark):
    rows = [(1, "https://m.x.example.de/fr/1?a", '<html class=a lang="FR"><script>x</script><p>Bonjour</p>'), (2, None, None)]
    got = {r["page_id"]: r for r in language_id.of_pages(spark.createDataFrame(rows, PAGES)).collect()}
    assert (got[1]["declared"], got[1]["host"], got[1]["suffix"], got[1]["path_lang"], got[1]["text"].split()) == ("fr", "m.x.example.de", "de", "fr", ["Bonjour"])
    assert (got[2]["declared"], got[2]["host"], got[2]["text"]) == (None, None, "")


def test_queries_are_whole(spark):
    assert queries.op1_language_id(spark, SMALL).count() == 250
    got = queries.op9_chat_formatting(spark, SMALL).toPandas().set_index("conv_id")
    talk = pd.read_parquet(f"{SMALL}/conversations.parquet").sort_values(["conv_id", "turn"])
    assert set(got.index) == {-1, *talk.conv_id}
    for conv, g in talk.groupby("conv_id"):
        lines = "".join(f"{r}\n{t}\n" for r, t in zip(g.role, g.text))
        assert got.loc[conv].n_turns == len(g) and got.loc[conv].turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert got.loc[conv].loss_chars == sum(len(t) for r, t in zip(g.role, g.text) if r == "assistant")
