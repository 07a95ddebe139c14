"""Shards and manifest against plain Python, and odd rows."""

import hashlib
import heapq
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings, strategies as st

from tidemark.llm import manifest, shards
from tidemark.llm.places import placed
from tidemark.llm.queries import QUERIES
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string, place string, n string, path string"
ODD = [(1, "one"), (2, None), (3, ""), (4, "é" * 5000), (5, "one"), (5, "one"), (5, "two\nlines"), (None, None), (None, "x")]


def odd_frame(spark):
    rows = [(i, t, [None, "en"][k % 2], [None, "a", "b", ""][k % 4], k, 1, "s", "p", "n", "q") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def lpt_loads(sizes, n):
    heap = [(0, j) for j in range(n)]
    for s in sorted(sizes, reverse=True):
        load, j = heap[0]
        heapq.heapreplace(heap, (load + s, j))
    return [load for load, _ in sorted(heap, key=lambda x: x[1])]


@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 1500)), max_size=6), st.integers(1, 7))
@settings(max_examples=60, deadline=None)
def test_schedule_is_lpt(classes, n):
    groups = Counter()
    for size, count in classes:
        groups[size] += count
    spans = shards.schedule(groups.items(), n)
    loads, places = [0] * n, defaultdict(list)
    for size, low, high, shard in spans:
        loads[shard] += size * (high - low)
        places[size] += range(low, high)
    assert loads == lpt_loads([s for s, k in groups.items() for _ in range(k)], n)
    assert all(sorted(places[s]) == list(range(k)) for s, k in groups.items())


def check_shards(docs, rows):
    assert len(docs) == len(rows)
    groups, home = Counter(), {}
    for d in docs:
        groups[d["text"] or ""] += len((d["text"] or "").encode()) + 1
    want = Counter((d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in docs)
    assert want == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    loads, slots = [0] * 16, defaultdict(list)
    for r in rows:
        assert home.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
    assert loads == lpt_loads(groups.values(), 16)
    for found in slots.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found)))
        ids = [-1 if i is None else i for _, i in found]
        assert ids == sorted(ids)


def test_shards(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = QUERIES["op12_sharding"](spark, small).collect()
    check_shards(docs, rows)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_shards_of_odd_rows(spark):
    odd = odd_frame(spark)
    check_shards(odd.collect(), shards.shard_documents(odd).collect())
    assert shards.shard_documents(odd.limit(0)).collect() == []


def test_hot_group_and_many_equal_sizes(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.lpad(F.col("id").cast("string"), 6, "0")).alias("text")
    )
    check_shards(docs.collect(), shards.shard_documents(docs).collect())


def test_placed(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"), F.lit(1).alias("n"))
    rows = rows.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    found = defaultdict(list)
    for r in placed(rows.drop("n"), "g", ["x"]).collect():
        found[r["g"]].append((r["place"], r["x"], r["n"]))
    for got in found.values():
        got.sort()
        assert [p for p, _, _ in got] == list(range(len(got)))
        assert [x for _, x, _ in got] == sorted(x for _, x, _ in got) and {n for _, _, n in got} == {len(got)}


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(d, text=None):
    values = [d["doc_id"], d["source"], d["lang"], d["n_chars"], d["text"] if text is None else text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """(root, siblings of each node as (left, right) lists)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(at):
            low = i - i % 3
            paths[k].append((level[low:i], level[i + 1 : low + 3]))
        level = [sha(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], paths


def slow_manifest(docs):
    groups = defaultdict(list)
    for d in docs:
        groups[d["source"]].append(d)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    key = lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d))
    trees = {s: climb([leaf(d) for d in sorted(groups[s], key=key)]) for s in names}
    root, above = climb([trees[s][0] for s in names])
    for s, upper in zip(names, above, strict=True):
        subroot, paths = trees[s]
        for d, path in zip(sorted(groups[s], key=key), paths, strict=True):
            whole = path + upper
            node = leaf(d)
            if zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0 and d["doc_id"] is not None and d["text"] is not None:
                node = leaf(d, d["text"].replace("\n", ""))
            for left, right in whole:
                node = sha(*left, node, *right)
            yield d["doc_id"], leaf(d), subroot, root, sha(*(x for left, right in whole for x in left + right)), node, node == root


def test_manifest(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = QUERIES["op13_manifest"](spark, small)
    assert sorted(slow_manifest(docs)) == sorted(map(tuple, rows.collect()))


def test_manifest_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(manifest, "STEPS", 1)
    monkeypatch.setattr(manifest, "BLOCK", 3)
    rows = [(k, f"t\n{k}", None, f"s{k % 40}" if k % 3 else "hot", k) for k in range(400)] + [(7, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, manifest.leaf_of(text=F.replace("text", F.lit("\n"), F.lit(""))))
    listed = manifest.manifest(docs, changed=changed)
    folded = manifest.fold(F.coalesce("changed", "leaf"), F.col("path"))
    got = listed.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof_text(F.col("path")).cast("binary"), 256), folded, folded == F.col("root"))
    assert sorted(slow_manifest(docs.collect())) == sorted(map(tuple, got.collect()))


def test_manifest_of_odd_rows(spark):
    odd = odd_frame(spark)
    got = manifest.manifest(odd)
    rows = got.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof_text(F.col("path")).cast("binary"), 256), manifest.fold(F.col("leaf"), F.col("path"))).collect()
    want = sorted((tuple(r)[1:5] for r in slow_manifest(odd.collect())), key=repr)
    assert sorted((tuple(r)[1:5] for r in rows), key=repr) == want
    assert all(r[5] == r["root"] for r in rows)
    assert manifest.manifest(odd.limit(0)).collect() == []
    alone = odd.filter("text = 'two\nlines'")
    assert [r["leaf"] for r in manifest.manifest(alone).collect()] == [r["root"] for r in manifest.manifest(alone).collect()]
