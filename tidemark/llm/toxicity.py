"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its hashed parts (the word itself and its character n-grams with
boundary marks), a bag is the mean of its words, and a two-class softmax stands on the bag. Embeddings
and softmax are trained together in numpy, so a misspelling never seen still shares most n-grams with
its origin. A document is as toxic as its worst passage: labels mark documents, so training starts from
whole documents and then alternates between picking the passage of ``BAG_WORDS`` words with the highest
score in each document and training on those passages. Because the softmax is linear in the words, a
text is scored exactly at every passage by a running mean of one number per word.

Training reads at most ``SAMPLE_DOCS`` labelled documents of each class and ``SAMPLE_CHARS`` characters,
picked by hash order; a document above ``DOC_CHARS`` characters is left out of training (never of
scoring). A fifth of them calibrates the score. Labels, language, source and id are no inputs.

Defined results: a NULL, empty or wordless text scores as the calibrated bias alone. Labels that are
NULL, other than 0 or 1, or contradictory for one doc_id are not learnt from; repeated labels and
documents count once each. Without labels of both classes the score is the share of label 1 (0.0
without labels). Repeated rows repeat, and other columns are untouched.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frames import arrow_column, forget_others, local_table, ship_package
from tidemark.operators.keysets import own_exchange
from tidemark.session import cut_lineage

SAMPLE_DOCS = 2000
SAMPLE_CHARS = 10_000_000
DOC_CHARS = 40_000
BAG_WORDS = 4
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
DIM = 8
GRAMS = (3, 4, 5)
THRESHOLD = 0.7
KNOWN_WORDS = 200_000
TOKEN = re.compile(r"[^\W_]+")


def parts(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, one after the other, and the number of each word's.

    A word's parts are itself and its character n-grams between boundary marks, hashed by a polynomial
    over the code points.
    """
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32)
    points = points.astype(np.uint64)
    ends = np.cumsum(lengths)
    powers = np.full(max(int(lengths.max(initial=0)), max(GRAMS)), 0x9E3779B97F4A7C15, np.uint64)
    powers[:1] = 1
    powers = np.multiply.accumulate(powers)
    place = np.arange(len(points)) - np.repeat(ends - lengths, lengths)
    room = np.repeat(lengths, lengths) - place
    owners = np.repeat(np.arange(len(words)), lengths)
    found = [np.add.reduceat(points * powers[place], ends - lengths) if len(words) else points]
    owner = [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(room >= n)
        found.append(sum(points[at + k] * powers[k] for k in range(n)) + np.uint64(n))
        owner.append(owners[at])
    hashes = np.concatenate(found)
    hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    buckets = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.bincount(owner, minlength=len(words))


@dataclass
class Model:
    """``margins`` is one number per bucket: embedding times the difference of the softmax rows."""

    margins: np.ndarray
    bias: float
    slope: float
    shift: float
    constant: float | None = None
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def learn_words(self, words: set[str]) -> None:
        """Look up the margins of words not met before."""
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if new:
            buckets, counts = parts(new)
            begins = np.cumsum(counts) - counts
            means = np.add.reduceat(self.margins[buckets], begins) / counts
            self.known.update(zip(new, means.tolist(), strict=True))

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """Score of every text by its worst passage."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        worst = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            words = TOKEN.findall(text.lower()) if text else []
            if words:
                try:
                    values = [self.known[w] for w in words]
                except KeyError:
                    self.learn_words(set(words))
                    values = [self.known[w] for w in words]
                worst[i] += passages(np.array(values)).max()
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -500, 500)))


def passages(values: np.ndarray) -> np.ndarray:
    """Bag means of every ``BAG_WORDS`` neighbouring words; a word repeated in its bag counts once.

    ``values`` are word margins; equal margins within a bag are taken as the same word.
    """
    width = min(BAG_WORDS, len(values))
    n = len(values) - width + 1
    sums = np.zeros(n)
    for at in range(width):
        here = values[at : at + n]
        again = np.zeros(n, bool)
        for before in range(at):
            again |= here == values[before : before + n]
        sums += np.where(again, 0.0, here)
    return sums / BAG_WORDS


class Trainer:
    """Joint training of bucket embeddings and softmax by Adagrad on bags of words."""

    def __init__(self, texts: Sequence[str], seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        index: dict[str, int] = {}
        self.docs = [
            np.array([index.setdefault(w, len(index)) for w in TOKEN.findall(t.lower())], np.int32)
            for t in texts
        ]
        # In pieces, as the tables of all n-grams at once would be many times the result.
        words = list(index)
        found = [parts(words[i : i + 20_000]) for i in range(0, max(1, len(words)), 20_000)]
        self.buckets = np.concatenate([b.astype(np.int32) for b, _ in found])
        self.counts = np.concatenate([c for _, c in found])
        self.begins = np.concatenate(([0], np.cumsum(self.counts)))
        self.table = self.rng.normal(0, 1 / DIM, (BUCKETS, DIM))
        self.head = np.zeros((2, DIM))
        self.bias = np.zeros(2)
        self.seen = [np.full((BUCKETS, DIM), 1e-6), np.full((2, DIM), 1e-6), np.full(2, 1e-6)]

    def margins(self) -> np.ndarray:
        return self.table @ (self.head[1] - self.head[0])

    def word_values(self) -> np.ndarray:
        """Margin of every word of the sample."""
        if not len(self.counts):
            return np.zeros(0)
        return np.add.reduceat(self.margins()[self.buckets], self.begins[:-1]) / self.counts

    def step(
        self, bags: list[np.ndarray], labels: np.ndarray, rate: float, width: int = 0
    ) -> None:
        words = np.concatenate(bags)
        sizes = np.array([len(b) for b in bags])
        counts = self.counts[words]
        ends = np.cumsum(counts)
        where = np.repeat(self.begins[words] - (ends - counts), counts) + np.arange(ends[-1])
        buckets = self.buckets[where]
        share = np.repeat(1 / (np.repeat(sizes.clip(width), sizes) * counts), counts)
        owner = np.repeat(np.repeat(np.arange(len(bags)), sizes), counts)
        first = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(bags)))[:-1]))
        means = np.add.reduceat(self.table[buckets] * share[:, None], first)
        logits = means @ self.head.T + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = p.copy()
        error[np.arange(len(bags)), labels] -= 1
        error /= len(bags)
        back = (error @ self.head) * len(bags) ** 0.5
        used, place = np.unique(buckets, return_inverse=True)
        grad = np.stack(
            [np.bincount(place, back[owner, j] * share, len(used)) for j in range(DIM)], axis=1
        )
        self.seen[0][used] += grad**2
        self.table[used] -= rate * grad / np.sqrt(self.seen[0][used])
        for k, (value, slope) in enumerate(
            ((self.head, error.T @ means), (self.bias, error.sum(0))), start=1
        ):
            self.seen[k] += slope**2
            value -= rate * slope / np.sqrt(self.seen[k])

    def epoch(
        self, bags: list[np.ndarray], labels: np.ndarray, rate: float, width: int = 0, batch: int = 128
    ) -> None:
        order = self.rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            self.step([bags[i] for i in chosen], labels[chosen], rate, width)


def fit(texts: Sequence[str], labels: Sequence[int], steps: int = 500, seed: int = 7) -> Model:
    """Train on (text, 0 or 1); a fifth of the texts calibrates."""
    labels = np.asarray(labels, np.int64)
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.0
        return Model(np.zeros(BUCKETS), 0.0, 1.0, 0.0, constant=share)
    work = Trainer(texts, seed)
    usable = np.array([len(d) > 0 for d in work.docs])
    aside = np.arange(len(labels)) % 5 == 4
    train = np.flatnonzero(usable & ~aside)
    if len(train) == 0 or labels[train].min() == labels[train].max():
        aside, train = np.zeros(len(labels), bool), np.flatnonzero(usable)
    if len(train):
        batches = -(-len(train) // 128)
        # Whole documents first, drawn as up to 256 of their words a pass.
        for _ in range(max(2, steps // (10 * batches))):
            bags = [work.rng.choice(work.docs[i], min(256, len(work.docs[i])), replace=False) for i in train]
            work.epoch(bags, labels[train], 0.3)
        for _ in range(max(5, steps // (2 * batches))):
            values, bags, marks = work.word_values(), [], []
            for i in train:
                doc = work.docs[i]
                means = passages(values[doc])
                bags.append(np.unique(doc[(at := int(means.argmax())) : at + BAG_WORDS]))
                marks.append(labels[i])
                if labels[i] == 0:
                    at = int(work.rng.integers(len(means)))
                    bags.append(np.unique(doc[at : at + BAG_WORDS]))
                    marks.append(0)
            work.epoch(bags, np.array(marks), 0.3, BAG_WORDS)
    bias = float(work.bias[1] - work.bias[0])
    values = work.word_values()
    worst = np.array([passages(values[d]).max() if len(d) else 0.0 for d in work.docs]) + bias
    known = np.flatnonzero(aside) if aside.any() and np.ptp(labels[aside]) else np.arange(len(labels))
    slope, shift = calibrate(worst[known], labels[known])
    return Model(work.margins(), bias, slope, shift)


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label on the margin by Newton steps, with a weak pull to slope 1."""
    x = np.stack([margins, np.ones_like(margins)], 1)
    w, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (p - labels) + 0.1 * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> dict[int, int]:
    """Label of each document of the bounded sample; ids and lengths reach the driver, texts don't."""
    clean = (
        labels.select("doc_id", "toxic")
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("low"), F.max("toxic").alias("toxic"))
        .filter("low = toxic")
        .select(F.col("doc_id").alias("_id"), "toxic")
    )
    here = own_exchange(docs.select(F.col("doc_id").alias("_doc")).distinct())
    known = cut_lineage(clean.join(here, F.col("_id") == F.col("_doc"), "left_semi"))
    picked = {
        row["_id"]: row["toxic"]
        for kind in (0, 1)
        for row in known.filter(F.col("toxic") == kind)
        .orderBy(F.xxhash64(F.col("_id"), F.lit("sample")), "_id")
        .limit(SAMPLE_DOCS)
        .collect()
    }
    lengths = of_documents(docs, sorted(picked), F.length("text").alias("n")).collect()
    # Both classes in turn, in hash order, as far as the characters go.
    rank = {0: 0, 1: 0}
    turns = []
    longest = {r["doc_id"]: r["n"] for r in lengths}
    for doc_id, kind in picked.items():
        if doc_id in longest:
            turns.append((rank[kind], kind, doc_id))
            rank[kind] += 1
    chosen, left = {}, SAMPLE_CHARS
    for _, kind, doc_id in sorted(turns):
        if longest[doc_id] <= left:
            chosen[doc_id] = kind
            left -= longest[doc_id]
    return chosen


def of_documents(docs: DataFrame, ids: list[int], value: Column) -> DataFrame:
    """doc_id and a value of the smallest usable text of each listed document; the list is bounded."""
    wanted = local_table(docs.sparkSession, {"_id": (ids, pa.int64())})
    return (
        docs.select("doc_id", "text")
        .join(wanted, F.col("doc_id") == F.col("_id"))
        .filter(F.length("text").between(1, DOC_CHARS))
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
        .select("doc_id", value)
    )


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample, in one task: the driver gets the model alone, and a lost executor costs a retry."""
    chosen = training_sample(docs, labels)
    if not chosen:
        return fit([], [])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        rows = sorted(row for b in batches for row in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True))
        model = fit([text for _, text in rows], [chosen[i] for i, _ in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    ship_package(docs.sparkSession)
    texts = of_documents(docs, sorted(chosen), F.col("text")).repartition(1)
    return pickle.loads(texts.mapInArrow(fitted, "model binary").first()["model"])


def toxicity(text: str | Column, model: Model) -> Column:
    """Score of a text, 0 to 1."""
    return arrow_column(
        lambda texts: pa.array(model.scores(texts), pa.float64()), "double", text
    )


def score_toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = model or train(docs, labels)
    scored = docs.select("doc_id", toxicity(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
