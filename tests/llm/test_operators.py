"""Brute-force comparisons, round trips, held-out accuracy and edge cases of every operator."""

from __future__ import annotations

import hashlib
import html
import pickle
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_helpers import DOCS, SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitline.llm import chat, common, html_text, imatch, jaccard, langid, mixing, packing, topk, toxicity, warc

LONG = "word " * 30_000
ODD = [(1, None), (2, ""), (3, "a b c d e f g"), (3, "a b c d e f g"), (4, "!!! ... 123"), (None, "a b c d e f g"), (None, None), (5, LONG), (6, "one"), (7, "ONE")]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# -- 1: top-k


def brute_top(vectors, k):
    rows = [(i, np.floor(np.array(v, np.float64) * 1024).astype(int)) for i, v in vectors]
    return [sorted(((-int(q @ c), j) for j, c in rows if j != i))[:k] for i, q in rows]


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.2, (300, 24)).astype(np.float32)
    base[50:120] = base[0]  # a very common vector
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(base)]
    df = topk.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    got = {}
    for r in topk.top_k(df, df, 7).collect():
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    want = brute_top(rows, 7)
    assert {q: [x[1:] for x in sorted(v)] for q, v in got.items()} == {i: want[i] for i in range(300)}


def test_search_stops_early_only_on_proof():
    rng = np.random.default_rng(2)
    m = np.floor(rng.standard_t(2, (4096, 32)) * 100).astype(np.int64)
    index = topk.Index(np.arange(4096), m)
    for own in range(0, 4096, 400):
        ids, scores = index.search(m[own], own, 10)
        full = m @ m[own]
        full[own] = -(1 << 60)
        best = np.lexsort((np.arange(4096), -full))[:10]
        assert list(ids) == list(best) and list(scores) == list(full[best])


def test_search_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 1.0]), (6, [])]
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(map(tuple, topk.search_report(df).collect()))
    sq = 1024 * 1024
    assert got == [(0, 1, 5, sq), (0, 2, 5, sq), (0, 3, 100, sq // 2), (0, 4, 6, 0), (100, 1, 0, sq // 2), (100, 2, 5, sq // 2), (100, 3, 5, sq // 2), (100, 4, 6, 0)]
    assert topk.search_report(df.limit(0)).collect() == []


# -- 2: Jaccard join


def brute_classes(rows):
    def grams(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        k = min(5, len(w))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()

    sets = [grams(t) for _, t in rows]
    n = len(rows)
    links, label = [0] * n, list(range(n))
    pairs = [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    for _ in range(n):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j], key=lambda x: rows[x][0])
    return sorted((rows[i][0], rows[label[i]][0], links[i]) for i in range(n))


def near_corpus(seed, copies):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(20):
        base = rng.choices(words, k=rng.randint(3, 120))
        for _ in range(rng.choice([1, 1, 2, 4])):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append(" ".join(t))
    base = rng.choices(words, k=150)
    for _ in range(copies):  # one large group of near copies, with exact copies among them
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append(" ".join(t))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "FEW", 3)
    rows = near_corpus(3, 70)
    got = jaccard.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_classes(rows)


def test_join_links_rows_without_an_id(spark, docs_of):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:-1], "other"])
    far = [f"v{i}" for i in range(60)]
    rows = [(None, " ".join(words)), (9, near), (None, " ".join(far)), (None, " ".join(far)), (None, " ".join([*far[:-1], "other"]))]
    got = sorted(map(tuple, jaccard.near_classes(docs_of(rows)).collect()), key=str)
    assert got == sorted([(None, 9, 1), (9, 9, 1), (None, None, 2), (None, None, 2), (None, None, 2)], key=str)


@pytest.mark.parametrize("few", [3, 500])
def test_join_of_ids_with_several_texts(spark, monkeypatch, few):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "FEW", few)
    rng = random.Random(few)
    texts = [t for _, t in near_corpus(5, 60)]
    rows = [(rng.randint(0, 25), t) for t in texts] + [(i, t) for i in range(25) for t in rng.choice([(None,), (None, None, "!"), ()])]
    rows += rng.choices(rows, k=40)  # repeated rows
    for _ in range(2):
        rng.shuffle(rows)
        got = jaccard.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(map(tuple, got.collect())) == brute_classes(rows)


def test_one_document_of_each_class_is_kept(spark, docs_of):
    v, w = ([f"{c}{i}" for i in range(60)] for c in "vw")
    text = lambda words, *end: " ".join([*words[: len(words) - len(end)], *end])
    # Id 5 represents the class of v and has a text in the class of id 3; id 8 holds two near texts; ids are missing.
    rows = [(3, text(w)), (5, text(w, "x")), (5, text(v)), (6, text(v, "x")), (7, text(v, "y"))]
    rows += [(8, "a b c d e f g h i j k l m n o p q r s t"), (8, "a b c d e f g h i j k l m n o p q r s z"), (8, None), (8, None)]
    rows += [(None, "only rows without an id have this text")] * 30 + [(None, text(v, "z")), (None, "!"), (None, "!")]
    kept = jaccard.keep_first(docs_of(rows)).select("doc_id", "text").collect()
    kept = sorted(((r.doc_id, r.text) for r in kept), key=str)
    (eight,) = [r for r in kept if r[0] == 8 and r[1]]
    assert eight in rows
    assert kept == sorted([(3, text(w)), (5, text(v)), eight, (8, None), (None, "only rows without an id have this text"), (None, "!"), (None, "!")], key=str)


def test_bands_meet_the_target_recall():
    bands, rows = jaccard.bands_for()
    assert 1 - (1 - jaccard.THRESHOLD**rows) ** bands >= jaccard.RECALL
    assert bands * rows <= jaccard.MAX_HASHES


def test_join_edge_cases(spark, docs_of):
    got = sorted(map(tuple, jaccard.near_classes(docs_of(ODD)).collect()), key=str)
    assert sorted(got, key=str) == sorted(
        [(1, 1, 0), (2, 2, 0), (3, 3, 2), (3, 3, 2), (4, 4, 0), (None, 3, 2), (None, None, 0), (5, 5, 0), (6, 6, 1), (7, 6, 1)], key=str
    )
    assert jaccard.near_classes(docs_of(ODD).limit(0)).collect() == []
    kept = jaccard.keep_first(docs_of(ODD))
    assert kept.columns == docs_of(ODD).columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 6]


# -- 3: toxicity


def test_machine_learns_a_pair_that_sums_cannot():
    """Insult alone and group alone are harmless; only together they are toxic."""
    rng = np.random.default_rng(0)
    texts, y = [], []
    for _ in range(1500):
        insult, group = (int(x) for x in rng.random(2) < 0.4)
        words = list(rng.choice(["lorem", "ipsum", "dolor", "amet", "sit"], 6)) + ["idiots"] * insult + ["strangers"] * group
        rng.shuffle(words)
        texts.append(" ".join(words))
        y.append(int(insult and group))
    model = toxicity.fit([toxicity.text_features(t, {}) for t in texts[:1000]], np.array(y[:1000]))
    score = toxicity.Scorer(model)
    assert np.mean([(score(t) >= 0.5) == v for t, v in zip(texts[1000:], y[1000:], strict=True)]) > 0.98
    both, one, other = score("lorem idiots strangers"), score("lorem idiots"), score("lorem strangers")
    assert both > 0.7 and one < 0.3 and other < 0.3


def test_machine_learns_a_pair_whose_members_tell_nothing():
    """Either word alone is toxic, both or none are not: each word's rate is the base rate."""
    rng = np.random.default_rng(3)
    texts, y = [], []
    for _ in range(2000):
        a, b = (int(x) for x in rng.random(2) < 0.5)
        words = list(rng.choice(["lorem", "ipsum", "dolor", "amet", "sit"], 6)) + ["idiots"] * a + ["strangers"] * b
        rng.shuffle(words)
        texts.append(" ".join(words))
        y.append(a ^ b)
    model = toxicity.fit([toxicity.text_features(t, {}) for t in texts[:1400]], np.array(y[:1400]))
    score = toxicity.Scorer(model)
    assert np.mean([(score(t) >= 0.5) == v for t, v in zip(texts[1400:], y[1400:], strict=True)]) > 0.97


def test_draws_do_not_vanish_at_any_size():
    for n in (10, 12_000, 10**9, 5 * 10**10, 10**14):
        share = (common.hash_limit(48_000, n) + (1 << 63)) / (1 << 64)
        assert abs(share * n - min(n, 48_000)) <= 1


def test_an_id_with_most_rows_does_not_flood_training(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    text = lambda bad: " ".join(rng.choices(words, k=12) + ["idiots"] * bad)
    labels = [(i, i % 2) for i in range(600)]
    hot = next(i for i in range(600) if zlib.crc32(str(i).encode()) % 3 != 1 and i % 2 == 0)
    rows = [(i, text(t)) for i, t in labels] + [(hot, text(0)) for _ in range(3000)] + [(None, "w1 w2")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([*labels, *labels], "doc_id long, toxic int"), sample=300)
    scorer = toxicity.Scorer(pickle.loads(model))
    assert scorer(text(1)) > 0.7 > 0.3 > scorer(text(0))
    # The draw holds at most so many rows, and few of the hot id: half of the rest is toxic.
    assert 0.3 < scorer.model["rate"] < 0.6


def test_toxicity_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.predictions(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)


def test_toxicity_edge_cases(spark, docs_of):
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] + [(3, None), (None, 1), (4, 5)], "doc_id long, toxic int")
    docs = docs_of(ODD)
    rows = toxicity.predictions(docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.predictions(docs.limit(0), labels).collect() == []
    assert {r.score for r in toxicity.predictions(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.keep_clean(docs, labels.limit(0)).columns == docs.columns


# -- 4: HTML


def test_html_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header class=top>Site name</header>
    <nav><ul><li><a href="/x">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div><aside>Side</aside><!-- <p>no</p> -->
    <article><h1>Head &amp; line</h1><p>First&nbsp;para <b>bold</b><br>next<p>Second  one</p><script>var a="</p>";</script>
    <form><p>Your mail</p><input></form><section class="comments"><p>Nice post</p></section></article><div class="ad">Buy</div>
    <footer>&copy; me</footer></body></html>"""
    assert html_text.main_text(page) == "Head & line First para bold next Second one"
    plain = "<body><ul><li><a href=1>Home</a><li><a href=2>More</a></ul>" + "<p>" + "A long sentence of the text. " * 5 + "<p>Short.<p>" + "Another long sentence. " * 5 + "</body>"
    assert html_text.main_text(plain) == " ".join(["A long sentence of the text. " * 5 + "Short. " + "Another long sentence. " * 5]).strip().replace("  ", " ")
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p>") == html_text.main_text("<script>x") == ""


def test_html_equals_the_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = html_text.page_texts(pages).join(pages.select("page_id", "html"), "page_id").collect()
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split()) and r.n_chars == len(r.text)


def test_html_body_beside_teaser_articles():
    teasers = "".join(f'<article><h2><a href="/{i}">Teaser {i}</a></h2><p>What the other story {i} is about.</p><a href="/{i}">Read more</a></article>' for i in range(4))
    body = ["A headline", *(f"Paragraph {i} " + "tells what happened. " * 12 for i in range(5)), "The end."]
    want = " ".join(" ".join(body).split())
    first, last = ("".join(f"<p>{t}</p>" for t in part) for part in (body[:3], body[3:]))
    for page in (teasers + f"<div>{first}{last}</div>", f"<div>{first}</div>{teasers}<div>{last}</div>", f"<main>{first}{teasers}{last}</main>", f"<div>{first}{last}</div>" + teasers):
        assert html_text.main_text(f"<html><body><nav><a href=1>Menu</a></nav>{page}<footer>Me</footer></body></html>") == want
    # Long text outside an article that holds most of the page is kept as well.
    outside = "Text that stands beside the article. " * 5
    assert html_text.main_text(f"<article>{first}{last}</article><div>{outside}</div>") == f"{want} {outside.strip()}"
    # Boilerplate inside an article doesn't part it, and a short page has a text.
    assert html_text.main_text(f"<article>{first}<aside><p>a<p>b<p>c<p>d</aside><p>Short.</p></article>").endswith("Short.")
    assert html_text.main_text("<article><p>Hi</p></article>") == html_text.main_text("<p>Hi</p>") == "Hi"


def test_html_of_the_given_pages_without_article_tags(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        bare = re.sub(r"</?article>", "", r.html)
        assert bare != r.html and html_text.main_text(bare) == html_text.main_text(r.html) != ""


def test_html_noise_names_and_inline_noise():
    text = "A long sentence of the text. " * 12
    want = text.strip()
    for name in ("content with-sidebar", "content-with-sidebar", "no-menu", "sidebar", "widget main"):
        assert html_text.main_text(f'<body><div class="{name}"><p>{text}</div><div class="site-footer">Me</div></body>') == want
    assert html_text.main_text(f'<article><header class="entry-header"><h1>Title</h1></header><p>{text}</article>') == f"Title {want}"
    for name in ("sidebar", "widget left-sidebar", "main-nav", "cookie-notice", "ad_box", "comments-12"):
        assert html_text.main_text(f'<body><div class="{name}"><p>Other text of the page.</div><p>{text}</body>') == want
    for noise in ("<button>Press</button>", "<textarea>Type</textarea>", "<noscript>No script</noscript>", "<svg><text>Icon</text></svg>", '<span class="ad">Buy</span>'):
        assert html_text.main_text(f"<p>{text}{noise}<p>Next.") == f"{want} Next."
        assert html_text.main_text(f"<p>{noise}{text}<p>Next.") == f"{want} Next."


NOISE = "comments reader-comments user-comments article-comments comment-thread commentlist disqus disqus_thread userComments replies newsletter-signup ad-slot adSlot cookie-notice notice sponsored promo-box related-posts"


@pytest.mark.parametrize("name", NOISE.split())
def test_html_without_comments_adverts_and_notices_of_any_length(name):
    text = "A long sentence of the text. " * 9
    more = "".join(f"<p>Comment {i}: this reader says quite a lot about it, at length.</p>" for i in range(40))
    for page in (
        f'<article><p>{text}</article><div class="{name}">{more}</div>',
        f'<article><p>{text}</p><section id="{name}">{more}</section></article>',
        f'<article><p>{text}</article><section class="wide {name}"><article>{more}</article><article>{more}</article></section>',
        f'<div class="page"><p>{text}</div><div class="{name} x">{more}</div>',
        f'<main><div class="{name}"><p>One.</div><p>{text}</main>',
    ):
        assert html_text.main_text(f"<body>{page}<footer>Me</footer></body>") == text.strip(), page[:60]


def test_html_names_around_the_article():
    text = ("A long sentence of the text. " * 9).strip()
    for name in ("layout-sidebar", "modal-open", "has-comments", "social-page", "nav-wrapper", "commentary"):
        assert html_text.main_text(f'<div class="{name}"><div class="menu">Go</div><article><p>{text}</article></div>') == text, name
    assert html_text.main_text(f'<article class="related-story"><p>{text}</article><aside>Other</aside>') == text
    assert html_text.main_text(f'<article><p>{text}</article><article class="comment"><p>{text}</article>') == text


def test_html_edge_cases(spark):
    df = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", "<p>" + "x " * 60_000, 2)], "page_id long, url string, html string, text int")
    rows = html_text.page_texts(df).collect()
    assert sorted(r.n_chars for r in rows) == [0, 0, 119_999]
    assert html_text.page_texts(df.limit(0)).collect() == []


# -- 5: chat

CONTROL = st.text(alphabet="<>/s[]INST\\ a\n", max_size=25)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "</s>", "[INST]\\"]), CONTROL), min_size=1, max_size=60))
def test_chat_round_trip_of_any_text(spark, turns):
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows)
    got = formatted.select(chat.parse(formatted["formatted"]).alias("turns"), "formatted", "loss_spans").first()
    assert [tuple(t) for t in got.turns] == turns
    (digest,) = chat.read_back(formatted).collect()
    loss = "".join(t for r, t in turns if r == "assistant")
    assert digest.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert (digest.loss_chars, digest.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_edge_cases(spark):
    rows = [(None, 0, "user", "x", 1), (1, None, None, None, 1), (1, 0, "assistant", "é😀" * 40_000, 1), (1, 0, "assistant", "b", 1), (1, 0, "assistant", "b", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got[1].n_turns == 4 and got[1].loss_chars == 80_002 and got[None].n_turns == 1 and got[None].loss_chars == 0
    empty = chat.read_back(chat.format_conversations(chat.with_planted(df.limit(0)))).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in empty] == [(-1, 2, 21)]


def test_chat_spans_name_the_texts(spark):
    turns = [(f"role{i % 3}" if i % 3 else "assistant", ("é</s>" if i % 5 else "") + "x" * (i % 7)) for i in range(3 * chat.RUN + 5)]
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows)
    (got,) = formatted.select("formatted", "loss_spans", chat.masked_texts(formatted["formatted"], formatted["loss_spans"]).alias("texts")).collect()
    want = [t for r, t in turns if r == "assistant"]
    assert got.texts == want
    cut = [got.formatted[s.start - 1 : s.start - 1 + s.length] for s in got.loss_spans]
    assert [t.replace("\\", "") for t in cut] == want


def test_chat_is_linear_in_the_turns(spark):
    def seconds(n):
        one = spark.range(n).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('text ', id, ' </s> of some words') as text")
        at = time.perf_counter()
        (row,) = chat.read_back(chat.format_conversations(one)).collect()
        assert row.n_turns == n
        return time.perf_counter() - at

    seconds(1000)
    assert seconds(64_000) < 4 * seconds(16_000) + 5  # a quadratic fold takes about sixteen times as long


# -- 6: WARC


def digest_of(text):
    import base64

    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_rejects_magic_inside_payloads(spark, monkeypatch, tmp_path):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:visitline:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(1, "u\r\nX: 1", "<p>é</p>"), (2, None, None), (3, "", ""), (4, "u", fake + fake), (5, "u", "tail WARC/1.0\r\n"), (6, "u", "<p>é</p>"), (7, "u", "x" * 70_000 + fake), (None, "u", "n"), (8, "u", fake * 30)]
    pages += [(i, "u", f"page {i} " + (fake if i % 7 == 0 else "") + "y" * (i * 13 % 700)) for i in range(100, 200)]
    df = spark.createDataFrame([(*p, 5) for p in pages], "page_id long, url string, html string, digest int").coalesce(1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits, also inside records
    try:
        got = sorted((tuple(r) for r in warc.round_trip(df).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    top = {}
    for i, _, h in pages:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = [
        (i, len((h or "").encode()), digest_of(h), "response" if i is None or top[h or ""] == i else "revisit", None if i is None or top[h or ""] == i else top[h or ""])
        for i, _, h in pages
    ]
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.limit(0)).collect() == []


# -- 7: packing


def test_warc_does_not_depend_on_how_files_are_split(spark, monkeypatch, tmp_path):
    """Files are split otherwise for every read; payloads with magics inside are joined again all the same."""
    fake = warc.MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc" + warc.END
    rows = [(i, "u", f"<p>{i}" + (fake + "x" * (i % 50)) * (i % 4) + "tail" * 30) for i in range(400)] + [(1000, "u", fake * 20), (1001, "u", fake * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    sizes = iter([700, 5000, 64, 300_000, 999] * 20)
    keep = warc._pieces

    def pieces(session, path):
        session.conf.set("spark.sql.files.maxPartitionBytes", next(sizes))
        session.conf.set("spark.sql.files.openCostInBytes", "0")
        return keep(session, path)

    monkeypatch.setattr(warc, "_pieces", pieces)
    try:
        got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages.coalesce(2)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: (len(h), "revisit" if i == 1000 else "response", 1001 if i == 1000 else None) for i, _, h in rows}


def test_encoder_equals_the_tokenizer(documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    encode = packing.Encoder(packing.tokenizer_path())
    texts = [r.text for r in documents.limit(60).collect()]
    texts += ["", "It's I'LL don'T we'VE 12ab3 ½ ªº", "<|endoftext|> x <|startoftext|>", "İstanbul é \x1c a\x85b c", "naïve Ŀ ŉ ſ'ſ", "a\tb\n\nc  d"]
    rng = random.Random(5)
    texts += ["".join(rng.choices("aB'sTl \t\n.,!é ÀÿžŽ0-9\xa0\xadİK", k=40)) for _ in range(300)]
    for text in texts:
        assert encode(text) == t.encode(text, add_special_tokens=False).ids, text


def test_encoder_keeps_no_long_words():
    encode = packing.Encoder(packing.tokenizer_path())
    text = "tree " + "x" * 100_000 + " tree"
    assert encode(text) == encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert list(encode.words) == ["tree"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4096), max_size=200))
def test_best_fit_and_bound(lengths):
    x = np.array(lengths, np.int64)
    bins = packing.best_fit_decreasing(x)
    n = bins.max() + 1 if len(x) else 0
    assert packing.lower_bound(x) <= n
    assert not len(x) or np.bincount(bins, weights=x).max() <= 4096


def test_bound_certifies_known_cases():
    assert packing.lower_bound(np.array([2049] * 10)) == 10
    assert packing.lower_bound(np.array([1366] * 10)) == 5
    assert packing.lower_bound(np.array([4096, 1, 1])) == 2


def test_packed_documents(spark, docs_of, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    rng = random.Random(9)
    rows = [*ODD, *((100 + i, "tree " * rng.randint(0, 3000)) for i in range(150))]
    got = packing.packed_documents(docs_of(rows)).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    want = {}
    for d, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want.setdefault((d, p, at, len(part), zlib.crc32(part.tobytes())), []).append(1)
    have = {}
    for r in got:
        have.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert have == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    bound = packing.lower_bound(np.array([r.length for r in got]))
    assert packing.corpus_bound(packing.packed_documents(docs_of(rows))) == bound >= -(-total // 4096)
    assert bound <= len(sequences) <= bound * 1.08 + 1  # groups of 40 pieces only
    assert packing.packed_documents(docs_of(rows).limit(0)).collect() == []


def test_exchanges_go_on_while_they_save(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 30)
    rng = random.Random(0)
    pieces = spark.createDataFrame([(i, rng.randint(900, 2600)) for i in range(3000)], "uid long, length long")
    sequences = lambda df: df.select("sequence_id").distinct().count()
    packed = packing.pack(pieces)
    assert sequences(packed) < sequences(packing.pack(pieces, 3))
    fill = packed.join(pieces, "uid").groupBy("sequence_id").agg({"length": "sum", "uid": "count"}).collect()
    assert sum(r["count(uid)"] for r in fill) == 3000 and max(r["sum(length)"] for r in fill) <= 4096
    assert packing.corpus_bound(pieces) <= sequences(packed) and packed.where("group_bins < group_bound").count() == 0


def test_groups_certify_their_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    rng = random.Random(4)
    pieces = spark.createDataFrame([(i, rng.randint(1, 900)) for i in range(1200)], "uid long, length long")
    rows = packing.pack(pieces).join(pieces, "uid").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.sequence_id >> 20, []).append(r)
    certified = [g for g in groups.values() if g[0].group_bins == g[0].group_bound]
    assert certified
    for g in certified:
        assert packing.lower_bound(np.array([r.length for r in g])) == len({r.sequence_id for r in g}) == g[0].group_bins


# -- 8: mixing


def test_mix(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 60), None, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(2000)] + [(3000, "x", None, "tiny"), (3001, None, None, "none"), (None, "y", None, "a"), (5, "again", None, "a")]
    docs = docs_of(rows)
    report = mixing.mix_report(docs).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight, target, free = {s: i % 3 + 1 for i, s in enumerate(order)}, {}, set(order)
    total = sum(sizes.values())
    while True:
        rest = total - sum(target.values())
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] >= 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            free.discard(s)
    target |= {s: level * weight[s] for s in free}
    taken = {}
    for r in report:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source] and r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 31 for s in order)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.selectExpr("sum(size(split(trim(text), ' ')))").first()[0] == sum(taken.values())
    assert sorted(map(tuple, mixing.mix_report(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, report), key=str)
    assert mixing.mix_report(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["one text of six words here", None])
def test_mix_rows_of_one_id_or_none_are_taken_one_by_one(spark, docs_of, text):
    rng = random.Random(4)
    of = lambda: text or "w " * rng.randint(1, 9)
    rows = [(i, "w w w w", None, "b") for i in range(300)] + [(None, of(), None, "a") for _ in range(400)] + [(7, of(), None, None) for _ in range(400)]
    docs = docs_of(rows)
    report = mixing.mix_report(docs).collect()
    assert len(report) == len(rows)
    for s in ("a", "b", None):
        mine = [r for r in report if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 5 and all(r.taken <= 3 * r.size for r in mine)
    words = lambda rs: sorted(((r.doc_id, r.source, r.taken) for r in rs), key=str)
    assert words(mixing.mix_report(docs.repartition(5)).collect()) == words(report)
    taken = sum(r.taken for r in report)
    assert mixing.mix(docs).selectExpr("sum(size(split(trim(text), ' ')))").first()[0] == taken


# -- 9: language ID


def test_language_held_out(spark, documents):
    found = langid.predictions(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in found)


def test_language_edge_cases(spark, docs_of):
    rows = [(i, t, "en" if i and i % 2 else None) for i, t in ODD]
    got = langid.predictions(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 4)} == {"und"}
    assert langid.predictions(docs_of(rows).limit(0)).collect() == []
    assert {r.lang_pred for r in langid.predictions(docs_of(ODD)).collect()} == {"und"}  # no label at all
    assert langid.keep_known(docs_of(rows)).columns == docs_of(rows).columns


def test_gradients_of_the_network(monkeypatch):
    """The trained network separates bytes that only a convolution tells apart."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(["ab", "ba"] if y == 0 else ["aabb", "bbaa"], 80)) for y in (0, 1) for _ in range(60)]
    x = np.concatenate([langid.windows(t)[0][:1] for t in texts])
    model = langid.fit(x, np.repeat([0, 1], 60), ["p", "q"])
    langs, _ = langid.predict(model, texts)
    assert np.mean([a == b for a, b in zip(langs, ["p"] * 60 + ["q"] * 60, strict=True)]) > 0.95


# -- 10: I-Match


def test_imatch(spark, documents):
    rows = sorted(((r.doc_id, r.text) for r in documents.collect()), reverse=True)
    got = {r.doc_id: r for r in imatch.fingerprints(documents).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for i, (d, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)]
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[1][:half]
        assert got[d].n_chars == len(text) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        by_text.setdefault(text, set()).add(got[d].fingerprint)
        a, b = ([f[k : k + 8] for k in range(0, 256, 8)] for f in (got[d].fingerprint, got[nxt[0]].fingerprint))
        either = sum(x != "-" * 8 or y != "-" * 8 for x, y in zip(a, b, strict=True))
        assert got[d].near_next == pytest.approx(sum(x == y != "-" * 8 for x, y in zip(a, b, strict=True)) / either)
    assert all(len(f) == 1 for f in by_text.values())
    assert np.mean([r.near_edited for r in got.values()]) > 3 * np.mean([r.near_next for r in got.values()])


def signed_hash(text):
    """Spark's ``xxhash64`` of a text."""
    return np.array([xxhash.xxh64_intdigest(text.encode(), 42)], np.uint64).view(np.int64)[0].item()


def plain_fingerprint(text, lexicon, subsets=imatch.SUBSETS):
    distinct = set(re.findall(r"[^\W_]+", text.lower()))
    used = distinct & lexicon or distinct
    parts = [sorted(t for t in used if signed_hash(t) % subsets == i) for i in range(subsets)]
    lines = [" ".join(f"{i:03d}_{t}" for t in p) for i, p in enumerate(parts)]
    return "".join(f"{signed_hash(f' {x}') % (1 << 64):X}".zfill(8)[:8].lower() if x else "-" * 8 for x in lines)


def plain_lexicon(texts):
    seen = Counter(t for text in texts for t in set(re.findall(r"[^\W_]+", text.lower())))
    return {t for t, n in seen.items() if imatch.LOW * len(texts) - 1e-6 <= n <= imatch.HIGH * len(texts) + 1e-6}


def plain_imatch(rows):
    """``(doc_id, edited text, fingerprint, edited fingerprint, the next one's)`` of ``(doc_id, text)`` rows."""
    rows = [(d, t or "") for d, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, signed_hash(r[1])), reverse=True)
    lexicon = plain_lexicon([t for _, t in rows])
    out = []
    for (d, text), (_, after) in zip(rows, [*rows[1:], *rows[:1]], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((d, hashlib.sha256(edited.encode()).hexdigest(), *(plain_fingerprint(t, lexicon) for t in (text, edited))))
    return sorted(out, key=str)


def imatch_rows(df):
    return sorted(((r.doc_id, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in df.collect()), key=str)


def test_imatch_equals_a_plain_version(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert imatch_rows(imatch.fingerprints(documents)) == plain_imatch(rows)


@pytest.mark.parametrize("limit", [200, 4000, 1 << 28])
def test_imatch_of_hot_ids_and_rows(spark, limit):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randint(0, 60)}" for _ in range(rng.randint(0, 40)))
    rows = [(i * 3 - 60, text()) for i in range(60)]
    rows += [(7, text()) for _ in range(60)] + [(None, text()) for _ in range(40)]  # one id, no id
    rows += [(11, "the same row again and again")] * 50 + [(None, "nameless copies of a row")] * 30 + [(-2, None)] * 3
    rows += [((1 << 63) - 1, "largest id"), (-(1 << 63), "smallest id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert imatch_rows(imatch.fingerprints(df, limit)) == plain_imatch(rows)


def test_imatch_blocks_part_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RUN", 7)
    rows = [(1, f"text {i} " * 20) for i in range(90)] + [(2, "x " * 50)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", imatch.order_key(F.col("doc_id"), F.col("text")))
    bounds, full = imatch.block_bounds(docs.select("_key", F.octet_length("text").cast("long").alias("_bytes")), 1000)
    assert len(bounds) > 10 and len(full) == 1
    once = imatch.merge_copies(docs, full)
    assert sorted(r.copies for r in once.collect()) == [1] * 90 + [40]
    block, _ = imatch._find(F.col("_key"), bounds)
    assert max(r["count"] for r in once.groupBy(block.alias("b")).count().collect()) <= 12
    assert imatch.expand(once).groupBy("doc_id").count().where("doc_id = 2").first()["count"] == 40


def test_imatch_edge_cases(spark, docs_of):
    got = imatch.fingerprints(docs_of(ODD)).collect()
    assert len(got) == len(ODD)
    assert {r.n_chars for r in got if r.doc_id in (1, 2)} == {0}
    assert len({r.fingerprint for r in got if r.doc_id == 3}) == 1
    assert imatch.fingerprints(docs_of(ODD).limit(0)).collect() == []
    (one,) = imatch.fingerprints(docs_of([(9, "alone in the table")])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"alone in alone in ").hexdigest()


assert DOCS
