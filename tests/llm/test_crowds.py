"""Near copies around one text, and texts a little too far from it: whole links, without listing a crowd's pairs."""

import random

from tradewind.llm import neardup


def _crowd(members, strays, words=150, seed=3):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]

    def edited(edits):
        out = list(base)
        for i in range(edits):
            out[8 + 16 * i + draw.randrange(6)] = f"v{draw.randrange(10**6)}"
        return " ".join(out)

    texts = [" ".join(base)] + [edited(2) for _ in range(members)] + [edited(5 + k % 4) for k in range(strays)]
    texts += [texts[members + 1 + k] + f" end{k}" for k in range(0, strays, 7)]  # strays that do have a link
    return list(enumerate(texts))


def _components(rows):
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids[a + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {i: root(i) for i in ids}


def test_strays_of_a_crowd_do_not_meet_it(spark, monkeypatch):
    kept, plain = {}, neardup.stored

    def stored(df, label):
        kept[label] = out = plain(df, label)
        return out

    monkeypatch.setattr(neardup, "stored", stored)
    rows = _crowd(members=120, strays=60)
    got = {r.doc_id: r.component_id for r in neardup.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == _components(rows)
    assert kept["open-shingles"].count() > 1000  # they do share shingles of their prefixes
    assert kept["candidates"].count() < 60 * 120 // 10


def test_links_outside_the_hub_are_found(spark):
    """Two texts that are near each other but not near the common one, of several sizes."""
    draw = random.Random(9)
    rows = []
    for words in (12, 30, 75, 200):
        base = [f"b{words}x{k}" for k in range(words)]
        for far in range(6):
            own = list(base)
            for i in draw.sample(range(words), max(1, words // 16)):
                own[i] = f"{far}n{draw.randrange(10**6)}"
            rows.append(" ".join(own))
            for _ in range(3):
                near = list(own)
                near[draw.randrange(words)] = f"m{draw.randrange(10**6)}"
                rows.append(" ".join(near[draw.randrange(3):]))
    rows = list(enumerate(rows))
    got = {r.doc_id: r.component_id for r in neardup.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == _components(rows)
