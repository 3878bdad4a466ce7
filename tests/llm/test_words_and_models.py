"""Parts that need no Spark: hashing of words, coders, plans, models."""

import re
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tradewind.llm import codec, exact, pages, pii, toxicity
from tradewind.llm.packing import Plan, cut, place
from tradewind.llm.tagger import Tagger
from tradewind.llm.tokens import Encoder, public_path
from tradewind.llm.words import shingle_sets

texts = st.text(alphabet="aAbBcC éß\n\t\x0b.,", max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=12))
def test_shingle_sets_are_the_sets_of_shingles(rows):
    seen: dict = {}
    for text, got in zip(rows, shingle_sets(pa.array(rows, pa.string())), strict=True):
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        want = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        assert len(got) == len(want)
        assert seen.setdefault(frozenset(want), got.tobytes()) == got.tobytes()
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=200))
def test_rice_coding_round_trip(values):
    values = np.sort(np.array(values, np.uint64))
    assert (exact.rice_decode(exact.rice_encode(values)) == values).all()


def test_rice_coding_is_near_the_entropy():
    values = np.sort(np.random.default_rng(1).integers(0, 2**63, 20_000, dtype=np.uint64))
    assert 8 * len(exact.rice_encode(values)) / 20_000 < 63 - np.log2(20_000) + 2.2


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 30_000])
@pytest.mark.parametrize("kinds", [1, 2, 300, 49_408])
def test_range_coder_round_trip(n, kinds):
    rng = np.random.default_rng(n + kinds)
    ids = rng.integers(0, kinds, n)
    ids[n // 2:] = ids[:n - n // 2]
    lengths = np.array([n // 3, 0, n - n // 3])
    block = codec.encode(np.array([5, codec.NO_ID, 7]), lengths, ids)
    doc_ids, got_lengths, got = codec.decode(block)
    assert (got == ids).all() and (got_lengths == lengths).all() and doc_ids.tolist() == [5, codec.NO_ID, 7]


def test_range_coder_learns_and_notices_damage():
    ids = np.tile(np.arange(50), 4000)
    block = codec.encode(np.array([1]), np.array([len(ids)]), ids)
    assert 8 * len(block) / len(ids) < 2
    bad = bytearray(block)
    bad[len(bad) // 2] ^= 1
    for broken in (bytes(bad), block[:-1], b"", b"TWI1"):
        with pytest.raises(ValueError):
            codec.decode(broken)


ODD = ["", "  a  b \n\n c  d　x  ", "it's  we'LL <|endoftext|> x<|endoftext|>\n\ny", "é́ ́e  \t\n x", "a\x1c b\x85 c \r\n d",
       "日本 語 \n 字 ", "123 456\n\n 789  ", "Ȩ́ Σας ΑΣ x", "trail  ", "\n", "a   b", "One, two. Three\nfour, 'five' .six", "a.b c,,d e. .f"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_have_the_ids_of_whole_texts(name):
    coder = Encoder(public_path(name))
    coder.KEPT = 8  # also over a store begun anew
    for text in ODD:
        assert coder.encode(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, text
    assert coder.encode(None).tolist() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_packing_plan_is_a_packing(case):
    limit, sizes = case
    plan = Plan({s: sizes.count(s) for s in set(sizes)}, limit)
    if not sizes:
        assert plan.sequences == 0
        return
    rank = np.array([sizes[:i].count(s) for i, s in enumerate(sizes)])
    length = np.array(sizes, np.int64)
    sequence, offset = place(plan.table(), length, rank)
    for q in range(plan.sequences):
        at = 0
        for o, n in sorted(zip(offset[sequence == q], length[sequence == q], strict=True)):
            assert o == at
            at += n
        assert 0 < at <= limit
    assert sequence.max() == plan.sequences - 1


def _fewest(sizes, limit, rooms=()):
    if not sizes:
        return len(rooms)
    best, tried = 99, set()
    for i, r in enumerate(rooms):
        if r >= sizes[0] and r not in tried:
            tried.add(r)
            best = min(best, _fewest(sizes[1:], limit, (*rooms[:i], r - sizes[0], *rooms[i + 1:])))
    return min(best, _fewest(sizes[1:], limit, (*rooms, limit - sizes[0])))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=7))
def test_reduction_loses_nothing(sizes):
    """What the reduction fixes and an optimal packing of the rest are together optimal."""
    plan = Plan.__new__(Plan)
    plan.limit, plan.left, plan.used = 12, np.bincount(sizes or [0], minlength=13).astype(np.int64), np.zeros(13, np.int64)
    plan.left[0] = 0
    plan.segments, plan.sequences = [], 0
    plan._reduce()
    rest = [s for s in range(12, 0, -1) for _ in range(int(plan.left[s]))]
    assert plan.sequences + _fewest(rest, 12) == _fewest(sorted(sizes, reverse=True), 12)


def test_pieces_are_whole_but_for_the_first():
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)] and cut(3, 4) == [(0, 3)] and cut(4, 4) == [(0, 4)]


PATTERNS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                    "[0-9]([\x20-]?[0-9])+", "\\+[0-9][\x20().0-9-]+[0-9]")]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a1.@-_ +()é0%\n", max_size=40))
def test_base_spans_are_those_of_the_patterns(text):
    want = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 16 <= len(digits) <= 19 and pii.luhn(digits) or kind == 3 and 8 <= len(digits) <= 15):
                want.append((kind, *m.span()))
    assert pii.base_spans(text) == want


def test_long_parts_of_addresses():
    zeros = "0" * 5000
    assert pii.base_spans(f"{zeros}1.2.{zeros}.4 x") == [(1, 0, 10_006)]
    assert pii.base_spans(f"1.2.3.{'9' * 5000}") == []


def test_patterns_take_time_in_proportion():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1 " * 150_000, "@" * 100_000, "+1" * 100_000):
        pii.base_spans(text)


def test_windows_cover_every_stretch():
    text = "x" * 500 + "1" * 300 + "y" * 100 + "@" + "z" * 10
    covered = {i for a, b in pii.stretches(text) for w in pii.windows(a, b) for i in range(w, min(w + pii.SIZE, b))}
    assert {i for i, c in enumerate(text) if c in "1@"} <= covered


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    model = Tagger(3, hidden=4)
    x, y = rng.integers(0, 129, (3, 7)), rng.integers(0, 3, (3, 7))
    _, g = model.gradients(x, y)
    for name, value in model.p.items():
        at = tuple(rng.integers(0, s) for s in value.shape)
        at = (x[1, 2], at[1]) if name.startswith("in") else at
        old, ends = value[at], []
        for step in (1e-5, -1e-5):
            value[at] = old + step
            ends.append(model.gradients(x, y)[0])
        value[at] = old
        assert abs((ends[0] - ends[1]) / 2e-5 - g[name][at]) < 1e-6


def test_tagger_learns_spans_and_adds_what_the_patterns_miss():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        number = f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"
        rows.append((i, f"word {'ab ' * int(rng.integers(1, 9))}{number} other 4.0 words", None))
    windows = []
    for _, text, _ in rows:
        for a, b in pii.stretches(text):
            windows += [(text[w:w + pii.SIZE], pii._tags(w, pii.base_spans(text))) for w in pii.windows(a, b)]
    from tradewind.llm.tagger import symbols
    model = Tagger(9)
    losses = model.fit(symbols([w for w, _ in windows], pii.SIZE), np.array([t for _, t in windows]), steps=90)
    assert losses[-1] < losses[0] / 5
    test = [t.replace("word", "wort") for _, t, _ in rows[:40]]
    found = pii.added_spans(test, model.light(), [[] for _ in test])
    assert sum(f == [s for s in pii.base_spans(t)] for f, t in zip(found, test, strict=True)) >= 36
    assert pii.added_spans(["version 4.0 of 2024"], model, [[]]) == [[]]


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\n\nb"), ("<article>", ""),
    ("<body><article><h1>x</h1></article></body>", "x"), ("<div>" * 3000 + "deep" + "</div>" * 7, "deep"),
    ("<p>a &amp; b&nbsp;c\n d<br>e</p>", "a & b c d e"), ("<<>> 5 < 6", "<<>> 5 < 6"), ("<script>var a='</p>'", ""),
])
def test_small_pages(page, text):
    assert pages.main_text(page) == text


def test_page_without_article_element():
    page = """<html><body><div class="menu"><a href=1>Home</a></div><header>Site</header><div id="wrap"><div class="sidebar">side
    <p>text here</p></div><div class="post"><h1>Title</h1><p>First paragraph with a good deal of words, &amp; more of them; &lt;ok&gt;.</p>
    <p>Second <a href=x>link</a> paragraph with words and words and words.</p><ul><li>one item<li>two item</ul></div>
    <section id="comments"><p>Reader comment long long long long long long long long</p></section></div><footer>foot</footer>"""
    assert pages.main_text(page) == ("Title\n\nFirst paragraph with a good deal of words, & more of them; <ok>.\n\n"
                                     "Second link paragraph with words and words and words.\n\none item\n\ntwo item")


def test_pages_with_articles_are_whole():
    long = "Words of a long paragraph that says a good deal, and more of it."
    many = f"<p>{long}</p>"
    page = f"<body><main><h1>Title</h1><article>{many * 3}</article><article>{many * 2}<p>End.</p></article></main></body>"
    assert pages.main_text(page) == "\n\n".join(["Title", *[long] * 5, "End."])
    page = f"<body><article><h1>One</h1>{many * 3}</article><article><h1>Two</h1><div>{many * 2}</div></article></body>"
    assert pages.main_text(page) == "\n\n".join(["One", *[long] * 3, "Two", *[long] * 2])
    page = f"<body><div><article>{many * 2}</article></div><div>{many * 3}</div></body>"  # text beside the article
    assert pages.main_text(page) == "\n\n".join([long] * 5)


@pytest.mark.parametrize("part", [
    '<section id="side-effects"><p>kept</p></section>', '<h2 id="search-and-rescue">kept</h2>', '<p id="notice-periods">kept</p>',
    '<section id="social-impact">kept</section>', '<section id="commentary">kept</section>', '<p class="social-impact">kept</p>',
    '<div data-id="menu" data-class="ad">kept</div>', '<figure><figcaption>kept</figcaption></figure>',
    '<p title="a hidden valley">kept</p>', '<p class="hidden md:block">kept</p>', "<p title='class=\"ad\"'>kept</p>",
    '<p title="display: none">kept</p>', '<div class="post-header">kept</div>',
])
def test_article_text_is_kept(part):
    assert pages.main_text(f"<body><article><p>one</p>{part}<p>two</p></article></body>") == "one\n\nkept\n\ntwo"
    assert "kept" in pages.main_text(f"<body><main><p>one</p>{part}<p>two</p></main></body>")


@pytest.mark.parametrize("part", [
    '<div class="x ad">gone</div>', '<div class="share-buttons">gone</div>', '<p hidden>gone</p>', '<p HIDDEN="">gone</p>',
    '<p aria-hidden=true>gone</p>', '<p style="color:red; display : none">gone</p>', '<div role="navigation">gone</div>',
    '<div id="comments">gone</div>', "<p class='advert'>gone</p>", '<article class="comment"><p>gone</p></article>',
    '<section id="comments">gone</section>', '<ol id="comment-list"><li>gone</ol>', '<form><p>gone</p></form>', '<aside>gone</aside>', '<div class=cookie-banner>gone</div>',
])
def test_boilerplate_in_an_article_goes(part):
    assert pages.main_text(f"<body><article><p>one</p>{part}<p>two</p></article></body>") == "one\n\ntwo"


def test_forms_that_wrap_the_page_stay():
    long = "Words of a long paragraph that says a good deal, and more of it."
    assert pages.main_text(f"<body><form id=f><div><p>{long}</p><p>{long}</p></div></form></body>") == f"{long}\n\n{long}"
    assert pages.main_text(f"<body><form><article><p>{long}</p></article><p>Name</p></form></body>").startswith(long)
    assert pages.main_text(f"<body><div><p>{long}</p><p>{long}</p></div><form><p>Your name</p></form></body>") == f"{long}\n\n{long}"


def test_broken_quotes_and_tags():
    assert pages.main_text("<p>one</p><p title='x>two</p><p>three</p>") == "one\n\ntwo\n\nthree"
    assert pages.main_text("<p>one <b") == "one <b"
    assert pages.main_text('<p title="a > b">one</p>') == "one"


@pytest.mark.parametrize("part", ['<a "', "<a \"'>", "<svg>", "<div></section>", "<b><p>", "<!-", "<a '>\"", "<form>", "</p "])
def test_hostile_pages_take_time_in_proportion(part):
    import time
    pages.main_text(part * 2000)
    spent = []
    for n in (20_000, 80_000):
        at = time.process_time()
        pages.main_text(part * n)
        spent.append(time.process_time() - at)
    assert spent[1] < 9 * spent[0] + 0.5


def test_toxicity_shares_subwords_and_finds_single_words():
    rng = np.random.default_rng(4)
    clean = ["the", "quick", "river", "stone", "walks", "under", "green", "light"]
    bad = ["grimblat", "grimblot", "grimblut"]
    rows = []
    for i in range(300):
        words = rng.choice(clean, 60).tolist()
        if i % 4 == 0:
            words[int(rng.integers(60))] = bad[i % 3]
        rows.append((i, int(i % 4 == 0), "\n".join(" ".join(words[k:k + 5]) for k in range(0, 60, 5))))
    model = toxicity.fit(rows)
    score = lambda t: float(model.probability(toxicity.Scorer(model).worst([t]))[0])
    assert score("the quick river walks under grimblit stone " + "green light " * 40) > 0.5  # a spelling never seen
    assert score("green stone walks " * 30) < 0.3 and 0 <= score("") <= 1
    assert (toxicity.fit(rows[::-1]).weight == model.weight).all()
    assert toxicity.fit([]).probability(np.zeros(1))[0] < 1e-6


def test_toxicity_held_out_accuracy(sf_dir):
    import duckdb
    if not Path("/root/testdata/sf0.1").exists():
        pytest.skip("no test tables")
    rows = duckdb.sql(f"select doc_id, text, toxic from '/root/testdata/sf0.1/labels.parquet' join "
                      "'/root/testdata/sf0.1/documents.parquet' using (doc_id)").df()
    held = rows["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    sample = next(iter(toxicity._sample_windows([rows[~held]])))
    model = toxicity.fit([tuple(r) for r in sample.itertuples(index=False)])
    test = rows[held]
    found = model.probability(toxicity.Scorer(model).worst(test["text"].tolist())) >= 0.3
    toxic = (test["toxic"] == 1).to_numpy()
    assert toxic.sum() > 0
    assert (found & toxic).sum() >= 0.9 * toxic.sum()      # recall
    assert (found & toxic).sum() >= 0.8 * found.sum()      # precision


def test_toxicity_scores_equal_a_plain_computation():
    rows = [(i, i % 2, "\n".join(f"w{i} good day to {j}" if i % 2 == 0 or j else "you grimblat fool go away" for j in range(4))) for i in range(60)]
    model = toxicity.fit(rows)
    text = "Hello there, you GRIMBLATS fool; what a day! " * 3

    def logit(word):
        bucket, _ = toxicity.features([word])
        return model.weight[bucket].mean()

    words = [w.lower() for w in toxicity._WORD.findall(text)]
    windows = [np.mean([logit(w) for w in words[i:i + toxicity.WINDOW]]) for i in range(len(words) - toxicity.WINDOW + 1)]
    assert toxicity.Scorer(model).worst([text])[0] == pytest.approx(max(windows) + model.bias)


def test_toxicity_sample_is_bounded_in_characters(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 1000)
    docs = spark.createDataFrame([(i, "word " * (30 if i else 5000)) for i in range(200)] + [(None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1)], "doc_id bigint, toxic int")
    rows = toxicity.training_rows(docs, labels).collect()
    assert 0 < sum(len(r["windows"]) for r in rows) <= 2000
    got = docs.select(toxicity.held_out(F.col("doc_id")).alias("h"), "doc_id").where("doc_id is null").first()
    assert got.h is False


def test_toxicity_trains_on_all_windows_of_long_texts(spark):
    rng = np.random.default_rng(5)
    clean = ["the", "quick", "river", "stone", "walks", "under", "green", "light"]
    texts = []
    for i in range(120):
        words = rng.choice(clean, 3000).tolist()
        if i % 2:
            words[7 + 5 * (i % 3)] = "grimblat"  # in a window that an even pick of 200 of 600 leaves out
        texts.append((i, " ".join(words), i % 2))
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in texts], "doc_id bigint, toxic int")
    rows = toxicity.training_rows(docs, labels).collect()
    assert {len(r["windows"].split("\n")) for r in rows} == {600}
    assert all(("grimblat" in r["windows"]) == bool(r["toxic"]) for r in rows)


def test_a_block_sends_each_fingerprint_once():
    rows = pd.DataFrame({"block": [1] * 5000 + [2] * 2, "fp": [7] * 4999 + [-9, 5, -9]})
    sent = pd.concat([exact._send(1)((b,), rows[rows["block"] == b]) for b in (1, 2)])
    assert [len(exact.rice_decode(c)) for c in sent["coded"]] == [2, 2]
    answers = exact._answer((0,), sent)
    marked = [exact._mark(1)((b,), rows[rows["block"] == b].assign(doc_id=1), answers[answers["block"] == b]) for b in (1, 2)]
    assert [sorted(set(m["fp"])) for m in marked] == [[-9, 7], [-9]] and [len(m) for m in marked] == [5000, 1]
