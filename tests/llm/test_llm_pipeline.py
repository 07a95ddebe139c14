"""Every pipeline stage against a slow version of it, each on what its predecessor kept."""

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_llm_queries import slow_components, slow_counts, slow_fingerprint

import corpus_pipeline
from tidemark.llm import quality, toxicity
from tidemark.llm.queries import MIXING_SQL

GROUP = 25


def slow_estimate(x):
    """Quartile start and concentration steps over distance classes, row by row."""
    floors = np.array(list(quality.STATISTICS.values())) * quality.STEP
    middle, spread = [], []
    for column, floor in zip(x.T, floors, strict=True):
        values = sorted(int(v) // 8 * 8 + 4 for v in column)
        at = lambda share: values[int(np.ceil(share * len(values))) - 1]  # noqa: E731, B023
        middle.append(at(0.5))
        spread.append(max((at(0.75) - at(0.25)) / 1.349, floor))
    mean, inverse = np.array(middle, float), np.diag(1 / np.array(spread) ** 2)
    for _ in range(quality.STEPS):
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        classes = np.floor(np.log2(np.maximum(d, 2.0**-10)) * quality.CLASSES)
        before = np.array([(classes < c).sum() for c in classes])
        core = x[before < quality.CORE * len(x)].astype(float)
        mean, inverse = core.mean(0), np.linalg.inv(np.cov(core.T, bias=True) + np.diag(floors**2))
    return mean, inverse


def slow_kept(rows):
    """Ids of the documents that the quality stage keeps."""
    counts = np.array([quality.base_counts(r["text"]) for r in rows])
    x = quality.statistics(counts).astype(float)
    passed = [not (c[0] < 20 or 100 * c[4] > 30 * c[0]) for c in (slow_counts(r["text"]) for r in rows)]
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        if passed[i]:
            for name in ((r["lang"], r["source"]), r["lang"], "all"):
                groups[name].append(i)
    estimates = {n: slow_estimate(x[m]) for n, m in groups.items() if len(m) >= GROUP}
    kept = set()
    for i, r in enumerate(rows):
        if passed[i]:
            name = next((n for n in ((r["lang"], r["source"]), r["lang"], "all") if n in estimates), None)
            mean, inverse = estimates[name] if name else (x[i], np.eye(quality.P))
            if (x[i] - mean) @ inverse @ (x[i] - mean) <= quality.CUTOFF:
                kept.add(r["doc_id"])
    return kept


def test_stages(spark, small, monkeypatch):
    import public_tokenizers
    import sentencepiece

    monkeypatch.setattr(quality, "MIN_GROUP", GROUP)
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality rules", "SimHash near-dedup", "mixing to target weights", "SentencePiece encoding",
    ]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    rows = docs.collect()

    def follow(name, docs):
        out = stages[name](spark, docs, small)
        stored = spark.createDataFrame(out.collect(), out.schema)
        return stored, stored.collect()

    model = toxicity.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    scores = model.scores([r["text"] for r in rows])
    docs, after = follow("toxicity", docs)
    assert docs.columns == columns
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r, s in zip(rows, scores, strict=True) if s < 0.7}

    rows = after
    docs, after = follow("quality rules", docs)
    assert docs.columns == columns
    assert {r["doc_id"] for r in after} == slow_kept(rows) and len(after) < len(rows)

    rows = after
    docs, after = follow("SimHash near-dedup", docs)
    found = slow_components([(r["doc_id"], slow_fingerprint(r["text"])) for r in rows])
    assert docs.columns == columns
    assert sorted(r["doc_id"] for r in after) == sorted(set(found.values()))

    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    taken = {r[0]: (r[1], r[4]) for r in connection.execute(MIXING_SQL).fetchall()}
    docs, after = follow("mixing to target weights", docs)
    assert docs.columns == columns
    assert Counter(r["doc_id"] for r in after) == {i: t // n for i, (n, t) in taken.items() if t}

    rows = after
    _, after = follow("SentencePiece encoding", docs)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = Counter((r["doc_id"], tuple(library.encode(r["text"]))) for r in rows)
    assert Counter((r["doc_id"], tuple(r["pieces"])) for r in after) == expected


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_documents(spark, small, name, stage):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    assert stage(spark, docs, small).collect() == []


def test_odd_columns_and_rows(spark, small):
    """Columns of any name pass through; NULL and empty texts and repeated rows have defined results."""
    texts = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x")]
    rows = [(i, t, None, "s", 1, "dot", 2) for i, t in texts]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, size long")
    clean = corpus_pipeline.drop_toxic(spark, odd, small)
    assert clean.columns == odd.columns and clean.count() == len(rows)
    assert corpus_pipeline.drop_low_quality(spark, odd, small).collect() == []
    single = corpus_pipeline.drop_near_duplicates(spark, odd, small)
    assert single.columns == odd.columns and sorted((r["text"] or "") for r in single.collect()) == ["", "a b c", "x"]
    mixed = corpus_pipeline.mix(spark, odd, small)
    assert mixed.columns == odd.columns and {r["text"] for r in mixed.collect()} <= {"a b c", "x"}
    encoded = corpus_pipeline.encode(spark, odd, small).collect()
    assert len(encoded) == len(rows) and all(r["n_pieces"] == 0 for r in encoded if r["doc_id"] in (1, 2))
