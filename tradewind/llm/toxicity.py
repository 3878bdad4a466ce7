"""Toxicity: bags of subword embeddings averaged into a linear softmax, trained jointly in numpy.

A word is a bag of hashed character 3- to 5-grams (with its edges) and of itself, so a misspelling shares most of its
vectors with the word. A window of WINDOW words is the mean of its words, a softmax over two classes is learned on the
windows together with the vectors, and a text is as toxic as its worst window; two numbers fitted on the training rows
turn that logit into a probability.

Defined results: null and empty texts score like a text whose window has the zero vector; a table without labels of
both kinds gives every text the share of toxic labels (0 without any label). Several labels of one document count as
toxic if one is. Repeated rows are scored one by one. A row without an id is scored, and not held out.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tradewind.llm.words import small

WINDOW = 5
BUCKETS = 1 << 16
DIM = 12
GRAMS = (3, 4, 5)
#: Bounds of the training sample: documents of each class, and characters of each class (of the rows in hash order those
#: that fit together). Of these documents all windows are read, and all are scored in every round.
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_CHARS = 2500, 5000, 10_000_000
#: Windows that a round of gradient steps draws: of each class in the first, and clean ones beside the worst ones later.
FIRST_STEPS, MORE_STEPS = 40_000, 20_000
#: Words whose grams are handled at a time.
WORDS = 20_000
_WORD = re.compile(r"\w+")
_seeded = np.random.default_rng(7)
_PLACE = _seeded.integers(1, 2**63, max(GRAMS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character grams of ``words`` and the index of the word each belongs to."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends = np.repeat(np.cumsum(lengths), lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(codes))
    found, owners = [], []
    for n in GRAMS:
        starts = at[at + n <= ends]
        h = np.full(len(starts), n * 2654435761, np.uint64)
        for k in range(n):
            h = (h + codes[starts + k]) * _PLACE[k]
            h ^= h >> np.uint64(29)
        found.append(h)
        owners.append(owner[starts])
    firsts = np.cumsum(lengths) - lengths
    step = codes * ((at - firsts[owner]).astype(np.uint64) * _PLACE[0] + _PLACE[1])
    found.append(np.add.reduceat(step ^ (step >> np.uint64(31)), firsts) if len(words) else np.zeros(0, np.uint64))
    owners.append(np.arange(len(words)))
    return ((np.concatenate(found) * _PLACE[2]) >> np.uint64(48)).astype(np.int64) % BUCKETS, np.concatenate(owners)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class Model:
    """``weight``: what each bucket adds to a window's logit (its vector times the softmax layer)."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float

    def word_logits(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        bucket, owner = features(words)
        return np.bincount(owner, self.weight[bucket], len(words)) / np.bincount(owner, minlength=len(words))

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -40, 40)))


def window_means(values: np.ndarray) -> np.ndarray:
    """Means of all runs of WINDOW values; of all values where there are fewer."""
    if len(values) <= WINDOW:
        return np.array([values.mean() if len(values) else 0.0])
    total = np.concatenate(([0.0], np.cumsum(values)))
    return (total[WINDOW:] - total[:-WINDOW]) / WINDOW


class Scorer:
    """Worst window of each text; logits of words are kept from batch to batch, up to KEPT words."""

    KEPT = 200_000

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def worst(self, texts) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            words = words_of(text)
            known = self.known
            new = [w for w in set(words) if w not in known]
            if new:
                if len(known) > self.KEPT:
                    known.clear()
                    new = list(set(words))
                known.update(zip(new, self.model.word_logits(new).tolist(), strict=True))
            out[i] = window_means(np.fromiter(map(known.__getitem__, words), float, len(words))).max()
        return out + self.model.bias


def _sample_windows(batches):
    """All non-overlapping windows of each row of the training sample."""
    for rows in batches:
        out = []
        for doc_id, text, toxic in zip(rows["doc_id"], rows["text"], rows["toxic"], strict=True):
            words = words_of(text)
            out.append((doc_id, toxic, "\n".join(" ".join(words[i:i + WINDOW]) for i in range(0, len(words), WINDOW))))
        yield pd.DataFrame(out, columns=["doc_id", "toxic", "windows"])


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, windows) of a bounded sample of the labelled documents outside the held-out quarter, chosen by
    a hash of the id."""
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("toxic") == c).orderBy(*by_hash).limit(n) for c, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    chosen = chosen[0].unionByName(chosen[1])  # at most TOXIC_ROWS + CLEAN_ROWS pairs of numbers
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = texts.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.sha2("text", 256)))).where("_n = 1")
    # at most TOXIC_ROWS and CLEAN_ROWS rows of two numbers to a window
    sizes = one.select("doc_id", "toxic", F.coalesce(F.length("text"), F.lit(0)).alias("_size"))
    upto = F.sum("_size").over(Window.partitionBy("toxic").orderBy(*by_hash).rowsBetween(Window.unboundedPreceding, 0))
    fit_in = sizes.withColumn("_upto", upto).where(F.col("_upto") <= SAMPLE_CHARS).select("doc_id")
    return (one.join(F.broadcast(fit_in), "doc_id", "left_semi").select("doc_id", "text", "toxic")
            .mapInPandas(_sample_windows, "doc_id bigint, toxic int, windows string"))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(rows: list[tuple[int, int, str]], seed: int = 11) -> Model:
    """Train on (doc_id, toxic, windows). Rows are put into id order first, so the order they come in doesn't matter."""
    rows = sorted(rows)
    toxic = np.array([r[1] for r in rows], float)
    prior = float(toxic.mean()) if len(rows) else 0.0
    if not len(rows) or not 0 < prior < 1:
        shift = float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9)))
        return Model(np.zeros(BUCKETS), 0.0, 0.0, shift, prior)
    vocabulary: dict[str, int] = {}
    windows, doc = array("i"), array("i")
    for i, (_, _, text) in enumerate(rows):
        for line in text.split("\n"):
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in line.split(" ") if w]
            windows.extend(ids + [-1] * (WINDOW - len(ids)))
            doc.append(i)
    windows, doc = np.array(windows, np.int32).reshape(-1, WINDOW), np.array(doc, np.int32)
    words, parts, counts = list(vocabulary), [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
    for a in range(0, len(words), WORDS):  # a few words at a time: their grams take a hundred times the room of what is kept
        chunk = words[a:a + WORDS]
        of, owner = features(chunk)
        parts.append(of[np.argsort(owner, kind="stable")].astype(np.uint16))
        counts.append(np.bincount(owner, minlength=len(chunk)))
    bucket, count = np.concatenate(parts), np.concatenate(counts)
    first = np.cumsum(count) - count
    rng = np.random.default_rng(seed)
    vectors = (rng.random((BUCKETS, DIM)) - 0.5) / DIM
    layer, bias = np.zeros((DIM, 2)), np.zeros(2)
    seen, seen_layer, seen_bias = np.full(BUCKETS, 1e-3), np.full((DIM, 2), 1e-3), np.full(2, 1e-3)

    def grams(words):
        n = count[words]
        spot = np.repeat(first[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return bucket[spot], n

    def train(some, goal, rate):
        nonlocal layer, bias
        for at in np.array_split(rng.permutation(some), max(1, len(some) // 256)):
            w = windows[at]
            words, place = np.unique(w, return_inverse=True)
            place = place.reshape(w.shape)
            real = words >= 0
            ids, n = grams(words[real])
            means = np.zeros((len(words), DIM))
            if len(ids):
                means[real] = np.add.reduceat(vectors[ids], np.cumsum(n) - n) / n[:, None]
            size = np.maximum((w >= 0).sum(1), 1)[:, None]
            bag = means[place].sum(1) / size
            z = bag @ layer + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = p - np.stack([1 - goal[at], goal[at]], 1)
            to_bag = g @ layer.T / size
            dl, db = bag.T @ g, g.sum(0)
            seen_layer[:] += dl**2
            seen_bias[:] += db**2
            layer = layer - rate * dl / np.sqrt(seen_layer)
            bias = bias - rate * db / np.sqrt(seen_bias)
            if len(ids):
                to_word = np.zeros((len(words), DIM))
                np.add.at(to_word, place, to_bag[:, None, :].repeat(WINDOW, 1))
                to_gram = np.repeat(to_word[real] / n[:, None], n, axis=0)
                used, where = np.unique(ids, return_inverse=True)
                step = np.zeros((len(used), DIM))
                np.add.at(step, where, to_gram)
                seen[used] += (step**2).mean(1)
                vectors[used] -= rate * step / np.sqrt(seen[used])[:, None]

    def logits():
        per_gram = vectors @ (layer[:, 1] - layer[:, 0])
        per_word = np.zeros(len(vocabulary) + 1)  # the last stands for no word
        for a in range(0, len(count), WORDS):
            b = min(a + WORDS, len(count))
            own = bucket[first[a]:first[b - 1] + count[b - 1]]
            per_word[a:b] = np.add.reduceat(per_gram[own], first[a:b] - first[a]) / count[a:b]
        return per_word[windows].sum(1) / np.maximum((windows >= 0).sum(1), 1) + bias[1] - bias[0]

    goal = toxic[doc]
    clean, bad = np.flatnonzero(goal == 0), np.flatnonzero(goal == 1)
    some = lambda a, n: rng.permutation(a)[:n]
    train(np.concatenate([some(bad, FIRST_STEPS), some(clean, FIRST_STEPS)]), goal, 0.3)
    for _ in range(3):  # a toxic document need not be so in every window: its worst ones are, and clean ones never
        z = logits()
        order = np.lexsort((-z, doc))
        rank = np.arange(len(order)) - np.searchsorted(doc[order], doc[order])
        top = order[rank < 2]
        hard = top[goal[top] == 0]
        train(np.concatenate([top[goal[top] == 1], hard, some(clean, MORE_STEPS)]), goal, 0.3)
    z = logits()
    worst = np.full(len(rows), -np.inf)
    np.maximum.at(worst, doc, z)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # logistic regression on the worst window, a little pulled to slope 1
        p = 1 / (1 + np.exp(-np.clip(slope * worst + shift, -40, 40)))
        s = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((p - toxic) * worst).sum() + (slope - 1), (p - toxic).sum()])
        hess = np.array([[(s * worst**2).sum() + 1, (s * worst).sum()], [(s * worst).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        slope, shift = slope - np.clip(step[0], -1, 1), shift - np.clip(step[1], -1, 1)
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]), float(slope), float(shift), prior)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit([tuple(r) for r in training_rows(docs, labels).collect()])


def score(docs: DataFrame, model: Model, threshold: float = 0.3, column: str = "text",
          names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Every column of ``docs`` and the two of ``names``; columns of these names are replaced."""
    kept = [c for c in docs.columns if c not in names]
    docs = docs.select(*kept)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in small(batches):
            worst = scorer.worst(batch.column(column).to_pylist())
            p = shared.value.probability(worst)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())],
                names=[*batch.schema.names, *names])

    out = StructType([*docs.schema.fields, StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])
    return docs.mapInArrow(run, out)
