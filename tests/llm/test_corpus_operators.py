"""The corpus operators on small tables against brute force, with the odd rows each must stand."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.functions.storage import fresh_path
from tradewind.llm import exact, idfile, lines, lookup, mixing, neardup, packing, pages, pii, quality, toxicity
from tradewind.llm.components import components
from tradewind.llm.tokens import public_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _words(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _set(text):
    w = _words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _corpus():
    """A crowd of near copies, exact copies, a passage that many share, short, empty, null and repeated rows."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 4))
    base, passage = [word() for _ in range(80)], " ".join(word() for _ in range(25))
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.integers(0, 80, rng.integers(0, 4)):
            own[k] = word()
        rows.append(" ".join(own) + ("\n" + passage if i % 3 == 0 else ""))
    rows += [" ".join(word() for _ in range(rng.integers(3, 60))) + "\n" + passage for _ in range(60)]
    rows += [passage] * 20 + [passage.upper() + "  "] * 3 + ["one two", "One  two", "one", "a b c d", "a b c d e", "a b c d e e e e"]
    rows += ["", None, " \n\t ", None, "x " * 3000, "x " * 3001, "x"]
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(rows)]
    return [*rows, (5, rows[5][1], "en", "s1", 3), (None, passage, "en", "s0", 1), (None, "quite alone", "en", "s0", 1)]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(_corpus(), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _components(rows):
    sets = collections.defaultdict(set)
    for i, t, *_ in rows:
        sets[i].add(_set(t))
    ids = sorted(i for i in sets if i is not None)
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in ids:
        for j in ids:
            if i < j and any(s and t and 100 * len(s & t) >= 75 * len(s | t) for s in sets[i] for t in sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i in ids}, sets


@pytest.mark.parametrize("heavy", [0, 40, 1 << 16])
def test_near_copies(corpus, heavy, monkeypatch):
    monkeypatch.setattr(neardup, "HEAVY", heavy)
    want, sets = _components(_corpus())
    got = neardup.find(corpus).collect()
    assert len(got) == len(_corpus())
    by_set = {s: want[i] for i, some in sets.items() if i is not None for s in some if s}
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]] and r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}
        elif r["n_shingles"] > 1:
            assert r["component_id"] == by_set[max((s for s in sets[None]), key=len)]
        else:
            assert r["component_id"] is None


def test_near_copies_of_nothing(corpus, empty):
    assert neardup.find(empty).collect() == [] and neardup.drop(empty).columns == empty.columns
    kept = neardup.drop(corpus).collect()
    want, _ = _components(_corpus())
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted([i for i, c in want.items() if i == c] + [5] * (want[5] == 5))


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 60)] + [(3, 3), (60, 7), (900, 800)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 61)} | {800: 800, 900: 800}


def test_lookups(corpus, spark):
    some = spark.createDataFrame([(3,), (5,), (None,), (10**9,)], "doc_id bigint")
    ids = [i for i, *_ in _corpus()]
    assert sorted(r[0] for r in lookup.only_wanted(corpus, some).select("doc_id").collect()) == [3, 5, 5]
    rest = lookup.without(corpus, some)
    assert rest.count() == len(ids) - 3 and rest.columns == corpus.columns
    assert lookup.without(corpus, some.limit(0)).count() == len(ids)


def test_exact_copies(corpus, empty):
    groups = collections.defaultdict(list)
    for i, t, *_ in _corpus():
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), float("inf") if i is None else i))
    want = collections.Counter()
    for norm, rows in groups.items():
        keep = min(rows)[1]
        for _, i in rows:
            i, k = (None if x == float("inf") else x for x in (i, keep))
            want[(i, k, len(rows), i == k, hashlib.sha256(norm.encode()).hexdigest())] += 1
    assert collections.Counter(tuple(r) for r in exact.find(corpus).collect()) == want
    assert exact.find(empty).collect() == []
    kept = exact.drop(corpus)
    assert kept.columns == corpus.columns
    texts = [re.sub("[\x20\x09-\x0d]", "", r["text"] or "") for r in kept.where("doc_id is not null").collect()]
    assert len(texts) == len(set(texts)) and set(texts) | {"quitealone"} == set(groups)


def _ids(name, end, rows):
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(public_path(name))
    return [(i, np.array([*coder.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for i, t, *_ in rows]


def test_id_files(spark, corpus, empty):
    path = fresh_path(spark, "ids")
    idfile.write(corpus, path, block=3000)
    want, at, sums = {}, 0, collections.Counter()
    for i, ids in sorted(_ids(idfile.VOCABULARY, 1, _corpus()), key=lambda x: (x[0] is not None, x[0])):
        sums[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
        want.setdefault(i, at)
        at += len(ids)
    got = idfile.index(spark, path).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sums
    assert {i: min(r["start"] for r in got if r["doc_id"] == i) for i in want} == want
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    back = {(r["doc_id"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in idfile.read(spark, path).collect()}
    assert back == {(i, c) for i, _, c in sums}
    path = fresh_path(spark, "ids")
    idfile.write(empty, path)
    assert idfile.index(spark, path).collect() == []


def test_packing(corpus, empty):
    got = packing.pack(corpus, limit=64, with_ids=True).collect()
    docs, rows = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        docs[r["doc_id"]].append(r)
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    for i, ids in _ids(packing.VOCABULARY, 0, _corpus()):
        if i not in (None, 5):
            own = sorted(docs[i], key=lambda r: r["piece"])
            assert sum((r["ids"] for r in own), []) == ids.tolist() and [r["piece"] for r in own] == list(range(-(-len(ids) // 64)))
            assert [r["start"] for r in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
            assert all(r["length"] == 64 for r in own[1:])
    for places in rows.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 64
    total = sum(r["length"] for r in got)
    assert len(rows) <= 1.05 * total / 64 + 1
    assert packing.pack(empty).collect() == []
    full = packing.sequences(corpus, limit=64).collect()
    assert len(full) == len(rows) and all(len(r["ids"]) == sum(n for _, n in rows[r["sequence_id"]]) for r in full)


def _removed(rows):
    """Brute force over all pairs of lines."""
    found = [(float("inf") if i is None else i, k, tuple(_words(x))) for i, t, *_ in rows
             for k, x in enumerate((t or "").split("\n")) if _words(x)]
    first = {}
    for i, k, w in found:
        first[w] = min(first.get(w, (i, k)), (i, k))
    sets = {w: _set(" ".join(w)) for w in first}
    earliest = {w: min(first[v] for v in first if 100 * len(sets[w] & sets[v]) >= 75 * len(sets[w] | sets[v])) for w in first}
    return {i: (sum(f[0] == i for f in found), sorted(k for j, k, w in found if j == i and (i, k) != earliest[w])) for i in
            {float("inf") if r[0] is None else r[0] for r in rows}}


@pytest.mark.parametrize("often", [2, 50])
def test_line_removal(corpus, empty, often, monkeypatch):
    monkeypatch.setattr(lines, "COMMON_LINES", often)
    want = _removed(_corpus())
    got = lines.find(corpus).collect()
    assert len(got) == len(want)
    for r in got:
        n, gone = want[float("inf") if r["doc_id"] is None else r["doc_id"]]
        assert (r["n_lines"], r["n_removed"], r["removed"]) == (n, len(gone), ",".join(map(str, gone))), r
    assert lines.find(empty).collect() == []


def test_cleaned_texts(corpus):
    want = _removed(_corpus())
    for r in lines.clean(corpus).where("doc_id is not null and doc_id <> 5").collect():
        text = _corpus()[r["doc_id"]][1]
        gone = want[r["doc_id"]][1]
        assert r["text"] == (text if not gone else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone))


def test_cleaned_rows_that_share_an_id(spark):
    rows = [(1, "one old line"), (2, "One OLD line\nnew words here"), (2, "only in this row\nand this too"), (2, None),
            (None, "one old line"), (None, "stays too")]
    got = lines.clean(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = [(1, "one old line"), (2, "new words here"), (2, "only in this row\nand this too"), (2, None), (None, ""), (None, "stays too")]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped, target = sum(sizes.values()), set(), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / max(1, sum(weight[x] for x in free)) for s in order}
        over = {s for s in free if target[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def test_mixing(spark, corpus, empty):
    got = mixing.mix(corpus).collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for i, t, _, s, _ in _corpus():
        sizes[s] += len(_words(t))
    want = _targets(sizes)
    assert len(got) == len(_corpus())
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= mixing.BLOCK + 1 for s in want)
    assert sorted(map(str, mixing.mix(corpus).collect())) == sorted(map(str, got))
    small = spark.createDataFrame([(1, "a b", "en", "big", 1)] + [(k, "w " * 50, "en", s, 1) for k, s in enumerate("xyz", 2)], SCHEMA)
    assert {r["source"]: r["target"] for r in mixing.mix(small).collect()} == pytest.approx(_targets({"big": 2, "x": 50, "y": 50, "z": 50}))
    assert mixing.mix(empty).collect() == [] and mixing.copies(empty).collect() == []
    copies = mixing.copies(corpus)
    assert copies.columns == corpus.columns
    n = collections.Counter()
    for r in copies.collect():
        n[r["source"]] += len(_words(r["text"]))
    longest = max(len(_words(t)) for _, t, *_ in _corpus())
    assert all(abs(n[s] - want[s]) <= longest / 2 + mixing.BLOCK for s in want)


def test_seats_are_the_highest_quotients(spark):
    rng = np.random.default_rng(3)
    cases = [(rng.integers(1, 1000, 12).astype(float), int(rng.integers(1, 400))) for _ in range(3)]
    cases += [(np.array([100.0] + [0.6] * 200), 220), (np.array([0.0, 5.0, 5.0, 0.0]), 3), (np.full(50, 2.0), 20), (np.array([7.0, 1.0]), 0),
              (np.array([1e6] + [1.0] * 30), 400)]
    for claims, seats in cases:
        parts = spark.createDataFrame([(0, float(c), k, seats) for k, c in enumerate(claims)], "g int, claim double, tie int, seats bigint")
        got = {r["tie"]: r["quota"] for r in mixing.apportion(parts, ["g"], "claim", "seats").collect()}
        quotients = sorted(((c / (2 * k - 1), -i) for i, c in enumerate(claims) if c for k in range(1, seats + 1)), reverse=True)[:seats]
        assert [got[i] for i in range(len(claims))] == [sum(-q[1] == i for q in quotients) for i in range(len(claims))]


def test_seats_of_many_shards(spark):
    claims = np.random.default_rng(8).integers(0, 50, 5000).astype(float)
    for seats in (7, 2600, 130_000):
        parts = spark.createDataFrame([(0, float(c), k, seats) for k, c in enumerate(claims)], "g int, claim double, tie int, seats bigint")
        got = {r["tie"]: r["quota"] for r in mixing.apportion(parts, ["g"], "claim", "seats").collect()}
        k = np.arange(1, 150)
        quotient = np.round(claims[:, None] / (2 * k - 1), 12)
        order = np.lexsort((np.repeat(np.arange(5000), len(k)), -quotient.ravel()))[:seats]
        want = np.bincount(order // len(k), minlength=5000)
        assert sum(got.values()) == seats and [got[i] for i in range(5000)] == want.tolist()


def test_quality(spark, corpus, empty):
    got = {(r["doc_id"], r["n_words"]): r for r in quality.judge(corpus).collect()}
    for i, t, *_ in _corpus():
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        windows = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for j in range(5)}
        own = [x for x in (t or "").split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
        r = got[(i, len(w))]
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(own) - len(set(own)), len(covered))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
    assert quality.judge(empty).collect() == []
    hosts = [(i, f"{i} " * 40 if h == "bad" and i % 10 else " ".join(f"w{i}x{k}" for k in range(30)), "en", h, 1)
             for i in range(120) for h in ("bad", "good", None)]
    rows = quality.judge(spark.createDataFrame(hosts, SCHEMA)).collect()
    assert not any(r["kept"] for r in rows if r["host"] == "bad") and all(r["kept"] for r in rows if r["host"] != "bad")
    rates = {r["host"]: r["host_rate"] for r in rows}
    assert rates["good"] < rates["bad"] < 0.9 + 1e-9 and rates["good"] > 0


def test_personal_data(spark, corpus, empty):
    tagger = pii.train(corpus, steps=5)
    assert tagger is None or tagger
    odd = spark.createDataFrame([(1, "x@y.zz and 10.0.0.1 " + "w " * 50_000 + "+1 (222) 555-0199"), (2, None), (3, ""), (1, "a@b.c")],
                                "doc_id bigint, text string")
    got = pii.find(odd, None).collect()
    assert [(r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in got] == [(1, 1, 0, 1), (0,) * 4, (0,) * 4, (1, 0, 0, 0)]
    assert got[0]["spans"] == "email:0:6,ip:11:19,phone:100020:100037" and got[1]["spans"] == ""
    assert got[0]["base_sha256"] == hashlib.sha256(got[0]["spans"].encode()).hexdigest()
    assert pii.find(empty, None).collect() == [] and pii.train(empty) is None


def test_toxicity(spark, corpus, empty):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(1, 0, 0), (None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(corpus, labels)
    got = toxicity.score(corpus.withColumn("score", F.lit("mine")), model)
    assert got.columns == [*corpus.columns, "score", "predicted"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.collect())
    none = toxicity.train(corpus, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(corpus, none).collect()} == {0}
    assert toxicity.score(empty, model).collect() == []
    held = [r[0] for r in corpus.where("doc_id is not null").where(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()]
    assert set(held) == {i for i, *_ in _corpus() if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}


def test_pages(spark):
    rows = [(1, "u", "<body><p>x</p></body>"), (1, None, None), (None, "v", "")]
    got = pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert [tuple(r) for r in got] == [(1, "u", "x", 1), (1, None, "", 0), (None, "v", "", 0)]


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        path = fresh_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > 0 and sizes[4] >= sizes[3] > 0
