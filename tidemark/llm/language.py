"""Language identification by a bidirectional gated recurrent network over bytes.

The UTF-8 text is cut into pieces of ``SPAN`` bytes. In each, one recurrent network reads from the left and
one from the right; at every byte a softmax over both states labels that position, and the document's
probabilities are the positions' log-probabilities averaged over all of its letters' bytes and normalised.
Training is backpropagation through time with Adam, in numpy; every position of a training piece bears its
document's language.

Training reads at most ``SAMPLE_DOCS`` documents of each language, picked by hash order, and ``SAMPLE_SPANS``
pieces of them. Scoring reads every byte of every text. Language, source and id are no inputs.

Defined results: ``lang_pred`` is ``und`` with score 0.0 for a NULL text or one without a letter, and for all
texts if there is nothing to learn from. Learnt are the ``LANGUAGES`` commonest values of ``lang``. With one learnt language every other text is of it with score
1.0. Ties go to the language first in code-point order. Repeated rows repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.frames import arrow_column, local_table

SAMPLE_DOCS = 400
SAMPLE_SPANS = 24_000
# Languages learnt, the commonest ones; a text of another gets the nearest of these.
LANGUAGES = 512
SPAN = 64
HIDDEN = 8
BATCH = 256
STEPS = 450
RATE = 0.02
LANES = 2048
UNKNOWN = "und"
# Bytes of ASCII letters and of every multi-byte character; digits, marks and spaces tell no language.
SPEAKS = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def gate(x: np.ndarray) -> np.ndarray:
    """Piecewise linear sigmoid."""
    return np.clip(0.25 * x + np.float32(0.5), 0, 1)


class Direction:
    """A gated recurrent layer over bytes: update and reset gates, then the candidate."""

    def __init__(self, rng: np.random.Generator) -> None:
        self.table = rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32)
        self.recur = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)).astype(np.float32)
        self.table[:, :HIDDEN] -= 1

    def states(self, codes: np.ndarray) -> np.ndarray:
        """(steps, HIDDEN, lanes) for codes of (steps, lanes); lanes are last, so that passes run along them."""
        out = np.empty((len(codes), HIDDEN, codes.shape[1]), np.float32)
        # The gates' slope and offset go into the weights.
        table, recur = self.table.copy(), np.ascontiguousarray(self.recur.T)
        table[:, : 2 * HIDDEN] = 0.25 * table[:, : 2 * HIDDEN] + 0.5
        recur[: 2 * HIDDEN] *= 0.25
        h = np.zeros(out.shape[1:], np.float32)
        for t, code in enumerate(codes):
            a = np.ascontiguousarray(table.take(code, axis=0).T)
            b = recur @ h
            gates, n = a[: 2 * HIDDEN], a[2 * HIDDEN :]
            gates += b[: 2 * HIDDEN]
            np.clip(gates, 0, 1, out=gates)
            b[2 * HIDDEN :] *= gates[HIDDEN:]
            n += b[2 * HIDDEN :]
            np.tanh(n, out=n)
            n -= h
            n *= gates[:HIDDEN]
            h = np.add(h, n, out=out[t])
        return out

    def trace(self, codes: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """States and gates of every step, for training."""
        h, steps = np.zeros((codes.shape[1], HIDDEN), np.float32), []
        for code in codes:
            a, b = self.table[code], h @ self.recur
            z = gate(a[:, :HIDDEN] + b[:, :HIDDEN])
            r = gate(a[:, HIDDEN : 2 * HIDDEN] + b[:, HIDDEN : 2 * HIDDEN])
            c = b[:, 2 * HIDDEN :]
            n = np.tanh(a[:, 2 * HIDDEN :] + r * c)
            new = h + z * (n - h)
            steps.append((h, z, r, c, n, new))
            h = new
        return steps

    def backward(self, codes: np.ndarray, steps: list, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and recurrence from those of the states, back through time."""
        grad_table, grad_recur = np.zeros_like(self.table), np.zeros_like(self.recur)
        dh, into = np.zeros_like(above[0]), []
        for t in range(len(codes) - 1, -1, -1):
            h, z, r, c, n, _ = steps[t]
            dh = dh + above[t]
            dn = dh * z * (1 - n * n)
            dz = dh * (n - h) * (0.25 * ((z > 0) & (z < 1)))
            dr = dn * c * (0.25 * ((r > 0) & (r < 1)))
            db = np.concatenate((dz, dr, dn * r), 1)
            into.append((codes[t], np.concatenate((dz, dr, dn), 1)))
            grad_recur += h.T @ db
            dh = dh * (1 - z) + db @ self.recur.T
        codes_of = np.concatenate([x for x, _ in into])
        slopes = np.concatenate([x for _, x in into])
        for j in range(slopes.shape[1]):
            grad_table[:, j] = np.bincount(codes_of, slopes[:, j], 256)
        return grad_table, grad_recur


class Network:
    """Two directions and the softmax over both states."""

    def __init__(self, languages: Sequence[str], seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.languages = list(languages)
        self.ahead, self.back = Direction(rng), Direction(rng)
        self.head = np.zeros((2 * HIDDEN, len(languages)), np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(steps, languages, lanes) for codes of (steps, lanes)."""
        head = np.ascontiguousarray(self.head.T)
        logits = head[:, :HIDDEN] @ self.ahead.states(codes)
        logits += head[:, HIDDEN:] @ self.back.states(codes[::-1])[::-1]
        logits += self.bias[:, None]
        logits -= logits.max(1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(1, keepdims=True))
        return logits

    def train(self, codes: np.ndarray, labels: np.ndarray, seed: int = 6) -> None:
        """Adam over random batches of (pieces, SPAN) byte codes."""
        rng = np.random.default_rng(seed)
        weights = [self.ahead.table, self.ahead.recur, self.back.table, self.back.recur, self.head, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, STEPS + 1):
            chosen = rng.integers(len(codes), size=BATCH)
            x, y = np.ascontiguousarray(codes[chosen].T), labels[chosen]
            ahead, back = self.ahead.trace(x), self.back.trace(x[::-1])
            states = np.concatenate(
                (np.stack([s[-1] for s in ahead]), np.stack([s[-1] for s in back])[::-1]), 2
            )
            logits = states @ self.head + self.bias
            p = np.exp(logits - logits.max(2, keepdims=True))
            p /= p.sum(2, keepdims=True)
            p[:, np.arange(BATCH), y] -= 1
            p *= SPEAKS[x][:, :, None] / np.float32(max(1, SPEAKS[x].sum()))
            above = p @ self.head.T
            grads = [
                *self.ahead.backward(x, ahead, above[:, :, :HIDDEN]),
                *self.back.backward(x[::-1], back, above[::-1, :, HIDDEN:]),
                np.einsum("tbh,tbl->hl", states, p, optimize=True),
                p.sum((0, 1)),
            ]
            rate = RATE * min(1.0, step / 20) * (1 - 0.9 * step / STEPS)
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    def document_scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """(texts, languages) of pooled probabilities; rows of texts without a letter are NaN."""
        out = np.full((len(texts), len(self.languages)), np.nan)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not known:
            return out
        raw = [texts[i].encode() for i in known]
        sums = np.zeros((len(known), len(self.languages)))
        lengths = np.array([len(r) for r in raw])
        flat = np.frombuffer(b"".join(raw), np.uint8)
        begins = np.cumsum(lengths) - lengths
        counts = -(-lengths // SPAN)
        owner = np.repeat(np.arange(len(known)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = begins[owner] + nth * SPAN
        size = np.minimum(lengths[owner] - nth * SPAN, SPAN)
        # Pieces of equal length run together, so that no step is spent on padding.
        order = np.argsort(size, kind="stable")
        edges = np.flatnonzero(np.diff(size[order], prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(order)), strict=True):
            for at in range(a, b, LANES):
                lane = order[at : min(at + LANES, b)]
                codes = flat[start[lane] + np.arange(size[lane[0]])[:, None]]
                found = self.log_probabilities(codes)
                found *= SPEAKS[codes][:, None]
                for j, piece in enumerate(found.sum(0)):
                    sums[:, j] += np.bincount(owner[lane], piece, len(known))
        heard = np.add.reduceat(SPEAKS[flat].astype(np.int64), begins)
        pooled = sums / np.maximum(heard, 1)[:, None]
        p = np.exp(pooled - pooled.max(1, keepdims=True))
        out[known] = p / p.sum(1, keepdims=True)
        return out


def fit(texts: Sequence[str], languages: Sequence[str], seed: int = 8) -> Network:
    """A trained network for texts and their languages."""
    names = sorted(set(languages))
    network = Network(names)
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    usable = [i for i, r in enumerate(raw) if len(r) >= 1]
    if len(names) < 2 or not usable:
        return network
    rng = np.random.default_rng(seed)
    number = {n: i for i, n in enumerate(names)}
    by_language: dict[str, list[int]] = {}
    for i in usable:
        by_language.setdefault(languages[i], []).append(i)
    codes, labels = [], []
    for name in sorted(by_language):
        mine = by_language[name]
        for i in rng.choice(mine, max(1, SAMPLE_SPANS // len(names))):
            at = int(rng.integers(max(1, len(raw[i]) - SPAN + 1)))
            codes.append(np.resize(raw[i][at : at + SPAN], SPAN))
            labels.append(number[name])
    network.train(np.stack(codes), np.array(labels))
    return network


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame) -> tuple[list[str], list[str]]:
    """Texts and languages of the bounded sample. Pieces of each text are cut in the tasks.

    Of each chosen document at most ``8 * SPAN`` bytes around a hashed place reach the driver, so its memory
    is bounded by languages, documents and pieces, whatever the texts' lengths.
    """
    # Texts are read for the chosen documents alone, once.
    usable = docs.select("doc_id", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    # The commonest languages are learnt, a bounded number, so their sizes are broadcast and no row is dealt by
    # language. A hash threshold per language leaves about twice the documents wanted, so that the ranking below
    # meets few rows however common a language is; small languages keep all of theirs.
    counted = usable.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_all"))
    sizes = F.broadcast(counted.orderBy(F.desc("_all"), "_lang").limit(LANGUAGES))
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("lang")), F.col("_all")) < 2 * SAMPLE_DOCS
    order = W.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id"), F.lit("lang order")), "doc_id")
    chosen = (
        usable.join(sizes, F.col("lang") == F.col("_lang"))
        .filter(drawn)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= SAMPLE_DOCS)
    )
    picked = sorted((r["doc_id"], r["lang"]) for r in chosen.select("doc_id", "lang").distinct().collect())
    # At most SAMPLE_DOCS ids a language.
    ids = local_table(
        docs.sparkSession,
        {"_id": ([i for i, _ in picked], pa.int64()), "_lang": ([x for _, x in picked], pa.string())},
    )
    length = 8 * SPAN
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - length + 1, F.lit(1))) + 1
    rows = (
        docs.select("doc_id", "lang", "text")
        .join(ids, (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
        .filter(F.length("text") > 0)
        .select("doc_id", "lang", F.substr("text", place.cast("int"), F.lit(length)).alias("part"))
        # One part a document, also where many rows share its id.
        .groupBy("doc_id", "lang")
        .agg(F.min("part").alias("part"))
        .collect()
    )
    rows = sorted((r["doc_id"], r["lang"], r["part"]) for r in rows)
    return [r[2] for r in rows], [r[1] for r in rows]


def language(text: str | Column, network: Network) -> Column:
    """struct<lang, score> of a text."""

    def batch(texts: list[str | None]) -> pa.Array:
        if not network.languages:
            scores = np.zeros((len(texts), 0))
            best, missing = np.zeros(len(texts), int), np.ones(len(texts), bool)
        else:
            scores = network.document_scores(texts)
            missing = np.isnan(scores[:, 0])
            best = np.where(missing, 0, np.nan_to_num(scores).argmax(1))
        names = [UNKNOWN if m else network.languages[b] for m, b in zip(missing, best, strict=True)]
        values = [0.0 if m else float(scores[i, b]) for i, (m, b) in enumerate(zip(missing, best, strict=True))]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())], ["lang", "score"])

    return arrow_column(batch, "struct<lang:string,score:double>", text)


def identify_languages(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    network = network or fit(*training_sample(docs))
    found = docs.select("doc_id", language(F.col("text"), network).alias("f"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("f.lang").alias("lang_pred"),
        F.col("f.score").alias("score"),
    )
