"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib
from math import floor

from hypothesis import given, settings, strategies as st

from tidemark.llm import runs
from tidemark.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, found string, runs string"


def slow_runs(words):
    """Runs by definition: for each period, stretches of equal words that no smaller period explains."""
    size, found = len(words), {}
    for period in range(1, size // 3 + 1):
        at = 0
        while at + period < size:
            if words[at] != words[at + period]:
                at += 1
                continue
            start = at
            while at + period < size and words[at] == words[at + period]:
                at += 1
            length = at + period - start
            if length >= max(24, 3 * period):
                found.setdefault((start, length), period)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def slow_collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def check(words):
    found, text = runs.collapse(words)
    assert found == slow_runs(words)
    assert text.split() == slow_collapsed(words, found)


@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=9), st.integers(1, 9)), max_size=9))
@settings(max_examples=150, deadline=None)
def test_random_repeats(parts):
    check([w for unit, times in parts for w in unit * times])


@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=160))
@settings(max_examples=60, deadline=None)
def test_two_letters(words):
    check(words)


def test_words_of_recursion():
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(9):
        a, b = b, b + a
    check(b)
    check(b * 3 + [b"x"] + b * 4)
    check([b"a"] * 500)
    random.seed(3)
    unit = [b"w%d" % random.randrange(900) for _ in range(150)]
    check(unit + unit[:40] + [b"-"] + unit * 3 + unit[:70] + [b"-"] + unit)


def test_long_stretch_of_one_word():
    found, text = runs.collapse([b"la"] * 200_000)
    assert found == [(0, 200_000, 1)] and text == b"la"


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, small).collect()}
    assert len(rows) == len(docs)
    planted = 0
    for d in docs:
        words = (d["text"] or "").encode().split()
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + floor((n - a) / (3 + g % 8))
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            planted += 1
        if n > 4000:
            continue
        found = slow_runs(words)
        row = rows[d["doc_id"]]
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert row["n_runs"] == len(found)
        assert (row["start"], row["length"], row["period"]) == (best or (None, None, None))
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        text = "".join(f"{s},{m},{p}\n" for s, m, p in found)
        assert row["runs_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        rest = b" ".join(slow_collapsed(words, found))
        assert row["collapsed_sha256"] == hashlib.sha256(rest).hexdigest()
    assert planted > 5 and any(r["n_runs"] for r in rows.values())


def test_odd_rows(spark):
    verse = " ".join(f"v{i}" for i in range(9))
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, verse), (5, f"{verse} " * 4), (5, f"{verse} " * 4), (None, "é ß " * 30),
             (6, "x" * 300_000), (7, "\x1c " * 24)]
    odd = spark.createDataFrame([(i, t, None, None, None, "f", "r") for i, t in texts], DOCS).repartition(3)
    rows = odd.select("doc_id", "text", runs.periodic_runs("text").alias("out")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = (r["text"] or "").encode().split()
        found = slow_runs(words)
        assert [tuple(x) for x in r["out"]["runs"]] == found
        assert r["out"]["collapsed"].encode().split() == slow_collapsed(words, found)
    assert odd.limit(0).select(runs.periodic_runs("text").alias("out")).collect() == []
