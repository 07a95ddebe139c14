"""Quality rules by robust multivariate outliers.

Each text gives exact counts and from them a vector of transformed statistics. Per language and source a
minimum-covariance-determinant estimate (the mean and covariance of the ``CORE`` share of rows lying
closest together) is found by concentration steps, and a document is rejected if its squared
Mahalanobis distance exceeds ``CUTOFF``.

Statistics are integers (``1 / STEP`` of the transformed value), so all sums are exact and reruns agree.
A concentration step is one grouped aggregation: rows fall into distance classes (``CLASSES`` per
doubling), each class of a group keeps its count, sums and products, and the classes up to the core's
share give the next mean and covariance. Only these sums meet in one place, never rows; a group of any
size costs its classes.

Every group has an estimate of its own, whatever its size. Few rows say little about a covariance, so a
group of language and source takes ``PRIOR_ROWS`` pseudo-rows of its language's covariance to its core, a
language those of all rows', and all rows those of the quartile spreads. The centre stays the group's own
but for ``CENTRE_ROWS`` pseudo-rows of the parent's, by which the odd one of very few rows is told. Both
weights fall smoothly with the core's rows.

Defined results: NULL text has no words and fails the base rule, as does every text of fewer than
``MIN_WORDS`` words. NULL language or source is a group of its own. Rows that fail the base rule
take no part in the estimates and are not kept. Repeated rows count and repeat.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.frames import arrow_column, ship_package
from tidemark.operators.keysets import own_exchange
from tidemark.session import cut_lineage

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
STEP = 1024
CORE = 0.75
STEPS = 4
CLASSES = 8
# No verdict reads it; tests/llm sets it.
MIN_GROUP = 200
PRIOR_ROWS = 200
CENTRE_ROWS = 1
CUTOFF = 32.0
# Words of an average text mixed in, so that short texts do not stand out by chance.
PRIOR = 40
# Least standard deviation of each statistic, in its own unit.
STATISTICS = {
    "symbols": 0.06,
    "word_length": 0.05,
    "capitals": 0.025,
    "dup_lines": 0.15,
    "repeats": 0.2,
    "marks": 0.05,
    "variety": 0.015,
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BASE = "struct<" + ",".join(f"{c}:long" for c in COUNTS) + ",x:array<int>>"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in some window of ``WINDOW`` words that is found twice or more."""
    if len(words) <= WINDOW:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.uint64)
    n = len(ids) - WINDOW + 1
    hashes = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n]
    ordered = np.argsort(hashes, kind="stable")
    same = hashes[ordered[1:]] == hashes[ordered[:-1]]
    if not same.any():
        return 0
    shared = np.unique(np.concatenate((ordered[1:][same], ordered[:-1][same])))
    # Equal hashes are settled by the words themselves.
    windows = ids[shared[:, None] + np.arange(WINDOW)]
    _, kind, times = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    found = shared[times[kind.reshape(-1)] > 1]
    if not len(found):
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def base_counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and lines, capitals, letters, marks, kinds."""
    if not text:
        return (0,) * 10
    # bytes.split() cuts at exactly the six ASCII white-space characters.
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    letters = Counter(text)
    count = lambda test: sum(n for c, n in letters.items() if test(c))
    return (
        len(words),
        len(text) - sum(letters[c] for c in SPACES),
        sum(letters[c] for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        count(str.isupper),
        count(str.isalpha),
        sum(letters[c] for c in ".,;:!?"),
        len(set(words)),
    )


def statistics(counts: np.ndarray) -> np.ndarray:
    """Transformed statistics, in ``1 / STEP``, of rows of ``base_counts``."""
    n, chars, symbols, dup, repeat, lines, capitals, letters, marks, kinds = counts.T.astype(float)
    more = n + PRIOR
    columns = [
        np.sqrt(symbols / more),
        np.log((chars + 6 * PRIOR) / more),
        np.sqrt((capitals + 0.03 * 5 * PRIOR) / (letters + 5 * PRIOR)),
        np.sqrt(dup / (lines + 5)),
        np.sqrt(repeat / more),
        np.sqrt((marks + 0.2 * PRIOR) / more),
        np.log(kinds + PRIOR) / np.log(more + 1),
    ]
    return np.rint(np.stack(columns, 1) * STEP).astype(np.int32)


def measured(text: str | Column) -> Column:
    """struct of the exact counts and the statistic vector ``x``."""

    def batch(texts: list[str | None]) -> pa.Array:
        counts = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 10)
        x = statistics(counts)
        vectors = pa.ListArray.from_arrays(
            pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel(), pa.int32())
        )
        return pa.StructArray.from_arrays(
            [pa.array(counts[:, i]) for i in range(len(COUNTS))] + [vectors], [*COUNTS, "x"]
        )

    return arrow_column(batch, BASE, text)


def fails_base(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat * 100 > REPEAT_PERCENT * n_words)


P = len(STATISTICS)
X = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
LEVELS = 3


def group_key(level: int) -> Column:
    """Name of a row's group: 0 language and source, 1 language, 2 all."""
    lang, source = (F.to_json(F.struct(F.col(c).alias("v"))) for c in ("lang", "source"))
    return F.concat_ws(" ", F.lit(str(level)), *[lang, source][: 2 - level])


def first_estimate(rows: DataFrame) -> DataFrame:
    """Coordinate-wise medians and quartile spreads of each group, from counts of values."""
    fine = 8
    seen = (
        rows.select("g", F.posexplode(F.array(*X)).alias("i", "x"))
        .groupBy("g", "i", F.floor(F.col("x") / fine).alias("v"))
        .agg(F.count("*").alias("n"))
    )
    order = W.partitionBy("g", "i").orderBy("v")
    # Detached, or Spark would deal the partial counts by the window's coarser keys.
    placed = own_exchange(seen).select(
        "g", "i", "v", F.sum("n").over(order).alias("upto"), F.sum("n").over(W.partitionBy("g", "i")).alias("all")
    )
    at = lambda share: F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("v") * fine + fine / 2))
    quartiles = placed.groupBy("g", "i").agg(at(0.25).alias("low"), at(0.5).alias("mid"), at(0.75).alias("high"))
    spread = F.create_map(*[x for i, s in enumerate(STATISTICS.values()) for x in (F.lit(i), F.lit(s * STEP))])
    scale = F.greatest((F.col("high") - F.col("low")) / 1.349, spread[F.col("i")])
    per_group = quartiles.groupBy("g").agg(
        *[F.max(F.when(F.col("i") == i, F.col("mid"))).alias(f"m{i}") for i in range(P)],
        *[F.max(F.when(F.col("i") == i, 1 / (scale * scale))).alias(f"c{i}_{i}") for i in range(P)],
    )
    return per_group.select(
        "g",
        *[f"m{i}" for i in range(P)],
        *[F.col(f"c{i}_{j}") if i == j else F.lit(0.0).alias(f"c{i}_{j}") for i, j in PAIRS],
    )


def distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its group's estimate."""
    d = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(X)]
    terms = [(1 if i == j else 2) * F.col(f"c{i}_{j}") * d[i] * d[j] for i, j in PAIRS]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def moments(n: int, sums: list[int], products: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of ``n`` rows."""
    second = np.zeros((P, P))
    for (i, j), value in zip(PAIRS, products, strict=True):
        # Exact integers up to the division, so no cancellation.
        exact = (int(value) * int(n) - int(sums[i]) * int(sums[j])) / (int(n) * int(n))
        second[i, j] = second[j, i] = exact
    return np.array(sums, float) / n, second


def invert(chains: list[list[dict]]) -> pa.Array:
    """Mean and inverse of the covariance, widened by the least deviations, of the last group of each chain.

    A chain leads from all rows to the group. Each link is drawn towards the one before it, the first one's
    covariance towards its quartile spreads.
    """
    floors = np.array(list(STATISTICS.values())) * STEP
    out = []
    for chain in chains:
        centre, cov = None, np.diag(1 / np.array(chain[0]["t"]))
        for link in chain:
            n = link["n"]
            mean, second = moments(n, link["s"], link["q"])
            cov = (n * second + PRIOR_ROWS * cov) / (n + PRIOR_ROWS)
            centre = mean if centre is None else (n * mean + CENTRE_ROWS * centre) / (n + CENTRE_ROWS)
        inverse = np.linalg.inv(cov + np.diag(floors**2))
        out.append([*centre, *(inverse[i, j] for i, j in PAIRS)])
    return pa.array(out, pa.list_(pa.float64()))


def concentrate(rows: DataFrame, estimate: DataFrame, spreads: DataFrame) -> DataFrame:
    """One concentration step: the estimate from the ``CORE`` share of rows nearest to the last one.

    ``spreads`` has the inverse squares ``t`` of each group's quartile spreads.
    """
    near = rows.join(own_exchange(estimate.withColumnRenamed("g", "_g")), F.col("g") == F.col("_g"))
    nearness = F.floor(F.log2(F.greatest(distance(), F.lit(2.0**-10))) * CLASSES)
    classes = (
        near.select("g", "up", *X, nearness.alias("class"))
        .groupBy("g", "up", "class")
        .agg(
            F.count("*").alias("n"),
            *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
            *[F.sum(F.col(X[i]).cast("long") * F.col(X[j])).alias(f"q{i}_{j}") for i, j in PAIRS],
        )
    )
    upto = W.partitionBy("g").orderBy("class")
    # Detached, or Spark would deal the partial sums of all classes by the group alone.
    core = own_exchange(classes).select(
        "*",
        (F.sum("n").over(upto) - F.col("n")).alias("_before"),
        F.sum("n").over(W.partitionBy("g")).alias("_all"),
    ).filter(F.col("_before") < CORE * F.col("_all"))
    totals = core.groupBy("g", "up").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(f"s{i}") for i in range(P)]).alias("s"),
        F.array(*[F.sum(f"q{i}_{j}") for i, j in PAIRS]).alias("q"),
    )
    spread = own_exchange(spreads.withColumnRenamed("g", "_g"))
    links = cut_lineage(
        own_exchange(totals)
        .join(spread, F.col("g") == F.col("_g"))
        .select("g", "up", F.struct("n", "s", "q", "t").alias("link0"))
    )
    chains = links
    for level in range(1, LEVELS):
        above = links.select(
            F.col("g").alias("_above"), F.col("up").alias("_next"), F.col("link0").alias(f"link{level}")
        )
        chains = chains.join(own_exchange(above), F.col("up") == F.col("_above"), "left").select(
            "g", F.col("_next").alias("up"), *(f"link{k}" for k in range(level + 1))
        )
    ship_package(rows.sparkSession)
    inverse = F.arrow_udf(_invert_batch, "array<double>")
    names = [*(f"m{i}" for i in range(P)), *(f"c{i}_{j}" for i, j in PAIRS)]
    chain = F.array_compact(F.array(*(f"link{k}" for k in reversed(range(LEVELS)))))
    solved = chains.select("g", inverse(chain).alias("e"))
    return solved.select("g", *[F.col("e")[k].alias(name) for k, name in enumerate(names)])


def _invert_batch(chains: pa.Array) -> pa.Array:
    return invert(chains.to_pylist())


def estimates(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimate of each group ``g`` of rows ``x0 …``.

    ``up`` names the group's parent, whose rows are there too; without that column no group has one.
    """
    if "up" not in rows.columns:
        rows = rows.withColumn("up", F.lit(None).cast("string"))
    estimate = cut_lineage(first_estimate(rows))
    spreads = estimate.select("g", F.array(*(f"c{i}_{i}" for i in range(P))).alias("t"))
    for _ in range(STEPS):
        estimate = cut_lineage(concentrate(rows, estimate, spreads))
    return estimate


def measured_rows(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, key, the counts, x0 … and base_failed; the compact working table."""
    found = docs.select(
        "doc_id", "lang", "source", row_key().alias("key"), measured(F.col("text")).alias("f")
    )
    return cut_lineage(
        found.select(
            "doc_id", "lang", "source", "key",
            *[F.col(f"f.{c}") for c in COUNTS],
            *[F.col("f.x")[i].alias(x) for i, x in enumerate(X)],
            fails_base(F.col("f.n_words"), F.col("f.n_repeat_words")).alias("base_failed"),
        )
    )


def row_key() -> Column:
    return F.xxhash64("text", "lang", "source")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, key, counts, base_failed, distance, kept for every row of documents."""
    work = measured_rows(docs)
    ups = [*(group_key(level) for level in range(1, LEVELS)), F.lit(None).cast("string")]
    levels = [F.struct(group_key(i).alias("g"), up.alias("up")) for i, up in enumerate(ups)]
    usable = work.filter(~F.col("base_failed"))
    rows = cut_lineage(usable.select(*X, F.explode(F.array(*levels)).alias("l")).select("l.g", "l.up", *X))
    estimate = own_exchange(estimates(rows))
    # A row that failed the base rule may stand in a group without usable rows and takes the next one's.
    fitted = work
    for level in range(LEVELS):
        named = estimate.select(*(F.col(c).alias(f"_{level}_{c}") for c in estimate.columns))
        fitted = fitted.join(named, group_key(level) == F.col(f"_{level}_g"), "left")
    chosen = [
        F.coalesce(*(F.col(f"_{level}_{c}") for level in range(LEVELS))).alias(c) for c in estimate.columns if c != "g"
    ]
    result = fitted.select(*work.columns, *chosen).select(
        "doc_id", "key", *COUNTS, "base_failed", distance().alias("distance")
    )
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return result.withColumn("kept", kept)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    rejected = own_exchange(
        judge(docs)
        .filter("NOT kept")
        .select(
            F.col("doc_id").isNull().alias("_no_id"), F.coalesce("doc_id", F.lit(0)).alias("_id"),
            F.col("key").alias("_key"),
        )
        .distinct()
    )
    same = (
        (F.col("doc_id").isNull() == F.col("_no_id"))
        & (F.coalesce("doc_id", F.lit(0)) == F.col("_id"))
        & (row_key() == F.col("_key"))
    )
    return docs.join(rejected, same, "left_anti")
