"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import (
    counts,
    idcoder,
    idfiles,
    language,
    mixing,
    pieces,
    quality,
    simhash,
    topk,
    toxicity,
    urls,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, p long, _row string"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
RUN = "x" * 50_000


@pytest.fixture(scope="module")
def odd(spark):
    """Every kind of odd document. ``size``, ``p`` and ``_row`` clash with working columns."""
    texts = [
        (1, "the quick brown fox jumps over the lazy dog and runs far away from here today ok fine so be it"),
        (2, None), (3, ""), (4, " \t\n"), (5, "one"), (6, LONG), (7, RUN), (8, "12 34 !!"),
        (9, "the quick brown fox jumps over the lazy dog and runs far away from here today ok fine so be it"),
        (9, "the quick brown fox jumps over the lazy dog and runs far away from here today ok fine so be it"),
        (9, "another version of the ninth document which shares its id with the others, and has its own words"),
        (None, "nameless text one two three four five six seven"), (None, None),
        (10, "naïve ▁ 漢字 🤣 \x00 <s> </s> <|endoftext|> ½ é"),
    ]
    rows = [(i, t, [None, "en", "fr"][n % 3], [None, "a", "b"][n % 3], 7, 8, 9, "r") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (9, 1, 1), (None, 0, 1), (5, None, None), (5, 1, 5)], "doc_id long, quality int, toxic int")


def test_toxicity(odd, none, labels):
    rows = toxicity.score_toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    same = {r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}
    assert len(same) == 1
    assert toxicity.score_toxicity(none, labels).collect() == []
    unlabelled = toxicity.score_toxicity(odd, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in unlabelled} == {(0.0, 0)}


def test_repeats_count_once_in_their_own_bag():
    rng = np.random.default_rng(3)
    samples = [np.array([5.0, 5, 1, 1.5, 2])] + [rng.integers(-3, 4, rng.integers(1, 12)).astype(float) for _ in range(200)]
    for values in samples:
        width = min(toxicity.BAG_WORDS, len(values))
        bags = [sum(set(values[i : i + width].tolist())) for i in range(len(values) - width + 1)]
        assert np.allclose(toxicity.passages(values), np.array(bags) / toxicity.BAG_WORDS)


def test_toxicity_learns_subwords():
    rng = np.random.default_rng(2)
    plain = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"], 30)) for _ in range(80)]
    bad = [t + " " + w for t, w in zip(plain[:40], ["grobnikant", "grobnikast"] * 20, strict=True)]
    model = toxicity.fit([*plain, *bad], [0] * 80 + [1] * 40)
    unseen, clean = model.scores(["alpha beta grobnikarl gamma delta", "gamma beta alpha delta omega"])
    assert unseen > 0.7 > clean


def test_gradients_of_the_toxicity_step():
    """One step lowers the loss of its own batch."""
    work = toxicity.Trainer(["aa bb cc", "dd ee ff"], 1)
    bags, marks = [work.docs[0], work.docs[1]], np.array([0, 1])

    def loss():
        values = [work.table[np.concatenate([work.buckets[work.begins[w] : work.begins[w + 1]] for w in b])].mean(0) for b in bags]
        logits = np.array(values) @ work.head.T + work.bias
        return float(np.mean(np.log(np.exp(logits).sum(1)) - logits[[0, 1], marks]))

    before = loss()
    for _ in range(20):
        work.step(bags, marks, 0.1)
    assert loss() < before / 2


def test_language(odd, none):
    rows = language.identify_languages(odd).collect()
    assert len(rows) == odd.count()
    silent = [r for r in rows if r["doc_id"] in (2, 3, 4, 8)]
    assert {(r["lang_pred"], r["score"]) for r in silent} == {("und", 0.0)}
    assert all(r["lang_pred"] in ("en", "fr") for r in rows if r["doc_id"] in (1, 6, 7))
    assert language.identify_languages(none).collect() == []
    nothing = language.identify_languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}


def test_backpropagation_through_time():
    """Analytic gradients of one direction against differences."""
    rng = np.random.default_rng(0)
    layer = language.Direction(rng)
    layer.table, layer.recur = layer.table.astype(float), layer.recur.astype(float)
    codes = rng.integers(97, 100, (5, 3))
    above = rng.normal(size=(5, 3, language.HIDDEN))
    value = lambda: float((np.stack([s[-1] for s in layer.trace(codes)]) * above).sum())
    table, recur = layer.backward(codes, layer.trace(codes), above)
    for weights, slopes, at in ((layer.table, table, (98, 3)), (layer.table, table, (97, 20)), (layer.recur, recur, (2, 17)), (layer.recur, recur, (1, 1))):
        old, eps = weights[at], 1e-6
        weights[at] = old + eps
        up = value()
        weights[at] = old - eps
        down = value()
        weights[at] = old
        assert abs((up - down) / (2 * eps) - slopes[at]) < 1e-4
    fast = language.Direction(rng)
    states = np.stack([s[-1] for s in fast.trace(codes)])
    assert np.allclose(fast.states(codes).transpose(0, 2, 1), states, atol=1e-5)


def test_simhash(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r["component_id"] for r in rows if r["doc_id"] in (2, 3, 4)} == {2}
    assert [r["component_id"] for r in rows if r["doc_id"] == 9].count(1) == 2
    nameless = [r for r in rows if r["doc_id"] is None]
    assert sorted(str(r["component_id"]) for r in nameless) == ["2", "None"]
    assert simhash.near_duplicates(none).collect() == []


def test_one_document_of_each_group(odd, none):
    kept = simhash.distinct_documents(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted((r["doc_id"] or 0) for r in rows) == [0, 1, 2, 5, 6, 7, 8, 9, 10]
    assert {r["size"] for r in rows} == {8} and {r["_row"] for r in rows} == {"r"}
    assert next(r for r in rows if r["doc_id"] == 9)["text"].startswith("another")
    assert simhash.distinct_documents(none).collect() == []


def test_hot_buckets_are_tiled(spark, monkeypatch):
    """Thousands of prints that agree in most blocks, in tiles of 64, against brute force."""
    monkeypatch.setattr(simhash, "TILE_ROWS", 64)
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 1)[0]
    flips = rng.integers(0, 64, (600, 6))
    prints = [int(centre)]
    for line in flips:
        value = int(centre)
        for b in line[: int(rng.integers(1, 7))]:
            value ^= 1 << int(b)
        prints.append(value - (1 << 64) if value >= 1 << 63 else value)
    prints = sorted(set(prints)) + [int(x) for x in rng.integers(0, 1 << 63, 300)]
    table = spark.createDataFrame(list(enumerate(prints)), "doc_id long, p long")
    found = {r["doc_id"]: r["component_id"] for r in simhash.components(table).collect()}
    wide = np.array(prints).view(np.uint64)
    parent = np.arange(len(wide))
    for i in range(len(wide)):
        near = np.flatnonzero(np.bitwise_count(wide[:i] ^ wide[i]) <= 4)
        parent = simhash.merge(parent, np.full(len(near), i), near)
    assert [found[i] for i in range(len(prints))] == parent.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=2, max_size=150), st.integers(1, 5))
def test_block_choices_lose_no_link(bits, blocks_more):
    """Two prints within the radius share a key whatever the number of blocks."""
    blocks = simhash.RADIUS + blocks_more
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    differing = {b % 64 for b in bits[: simhash.RADIUS]}
    hit = {i for i in range(blocks) for b in differing if edges[i] <= b < edges[i + 1]}
    assert blocks - len(hit) >= blocks - simhash.RADIUS


def test_pieces(spark, odd, none):
    rows = pieces.encode_documents(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[2]["pieces"] is None and by_id[2]["n_pieces"] == 0 and by_id[2]["round_trip"] is None
    assert by_id[3]["pieces"] == [] and by_id[3]["round_trip"]
    assert all(r["round_trip"] for r in rows if r["pieces"] is not None)
    texts = odd.select(pieces.encoded("text").alias("e"), "text").select(pieces.decoded("e.ids").alias("back"), "text")
    assert all((r["text"] or "").replace("▁", " ") == (r["back"] or "") for r in texts.collect())
    assert pieces.encode_documents(none).collect() == []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeinorst  \n\t▁.,!é漢字🤣\x00<>THE012ñß"), max_size=30))
def test_pieces_agree_with_the_library(text):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    machine = pieces.transducer(pieces.MODEL)
    assert machine.encode(text).tolist() == library.encode(text)
    assert machine.decode(machine.encode(text)) == machine.expected(text)


def test_words_with_marks_are_encoded_once():
    """A word of letters goes through the library once, whatever single mark stands behind it."""
    machine, passed = idfiles.Encoder(idfiles.TOKENIZER), []
    library = machine.tokenizer

    class Recorder:
        def encode(self, x, **options):
            passed.extend(x if options.get("is_pretokenized") else [])
            return library.encode(x, **options)

        def __getattr__(self, name):
            return getattr(library, name)

    machine.tokenizer = Recorder()
    texts = ["Thing, thing. Thing. Othering; don't. é. x!y ., 1.", "thing. other: other", None, ""]
    found = [ids.tolist() for ids in machine.encode(texts)]
    assert found == [library.encode(t or "", add_special_tokens=False).ids + [idfiles.END_ID] for t in texts]
    assert sorted(c for c in passed if c[:-1].isalpha() and c.isascii()) == []


def test_letters_beyond_ascii_capitals_and_runs_of_marks_cost_no_second_encoding():
    """Words of Latin-1 letters go through the library once, whatever their case and the marks behind them."""
    machine, passed, plain = idfiles.Encoder(idfiles.TOKENIZER), [], []

    class Recorder:
        def __init__(self, library, seen):
            self.library, self.seen = library, seen

        def encode(self, x, **options):
            self.seen.extend(x)
            return self.library.encode(x, **options)

        def encode_batch_fast(self, x, **options):
            self.seen.extend(w for text in x for w in text.split())
            return self.library.encode_batch_fast(x, **options)

    library = machine.tokenizer
    machine.tokenizer = Recorder(library, passed)
    machine.plain = Recorder(getattr(machine, "plain", None), plain)
    texts = ["Été été. ÉTÉ!! été&&& Straße straße,### STRASSE", "ÉTÉ***\nstraße Ñandú. ñandú", "<|endoftext|> ÉTÉ", " "]
    found = [ids.tolist() for ids in machine.encode(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids + [idfiles.END_ID] for t in texts]
    assert not [c for c in passed if c[:1].isalpha()]
    assert sorted(plain) == sorted(["été", "straße", "strasse", "ñandú"])


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.text(alphabet=st.sampled_from("abTHEreÉéßµªſİΣσKÅ字  \n\t'.,!&*<|>_-\\\"12ñ\u0300\u0308\u0331\u0338🤣\x00"), max_size=30)
        | st.sampled_from(["<|endoftext|>", "a<|startoftext|>.", "<|ENDOFTEXT|> B", "H\u0331 J\u030c T\u0308", None]),
        max_size=4,
    )
)
def test_ids_agree_with_the_library(texts):
    machine = idfiles.encoder(idfiles.TOKENIZER)
    found = [ids.tolist() for ids in machine.encode(texts)]
    assert found == [
        machine.tokenizer.encode(t or "", add_special_tokens=False).ids + [idfiles.END_ID] for t in texts
    ]


def test_the_path_search_weighs_few_pairs(monkeypatch):
    """Only pairs near the path are weighed, not every pair of pieces that the text holds."""
    machine, asked = pieces.transducer(pieces.MODEL), []
    monkeypatch.setattr(machine, "pairs", {})
    monkeypatch.setattr(machine, "weigh", lambda left, right: asked.append(1) or machine.agree(left, right))
    path = machine.shortest_path("▁internationalisation▁of▁neighbouring▁considerations")
    assert len(asked) <= 2 * len(path) // 4


def test_urls(spark):
    schema = "page_id long, url string, html string, host string, rule int"
    rows = [
        (1, None), (2, ""), (3, "no scheme/casino/x"), (4, "HTTP://WWW.Example.ORG/es/1?q"), (5, "x://a.org"),
        (6, "x://a.org/"), (7, "x://b.com/de/"), (7, "x://b.com/de/"), (8, "x://cheap-pills.net/a"),
        (9, "x://notcheap-pills.net/a"), (10, "x://h.net/casino/"), (11, "x://health.net/viagra"),
        (12, "x://shop.net/viagra"), (13, "x://example.org/en/12#f"), (None, "x://z.net/?sessionid=3"),
        (14, "x://org/" + "a" * 30_000), (15, "x://f.net/setup.exe"), (16, "x://y.net/axxxbporny"),
    ]
    pages = spark.createDataFrame([(i, u, "h", "clash", 5) for i, u in rows], schema)
    found = sorted(urls.filter_urls(pages).collect(), key=lambda r: (r["page_id"] or 0, r["path"]))
    by_id = {r["page_id"]: (r["host"], r["path"][:10], r["rule"], r["verdict"]) for r in found}
    assert len(found) == len(rows)
    assert by_id == {
        None: ("z.net", "/", None, "block"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"),
        3: ("", "", None, "block"), 4: ("www.example.org", "/es/1", "example.org/es/", "block"),
        5: ("a.org", "", None, "allow"), 6: ("a.org", "/", "org/", "allow"), 7: ("b.com", "/de/", "com/de/", "block"),
        8: ("cheap-pills.net", "/a", None, "block"), 9: ("notcheap-pills.net", "/a", None, "allow"),
        10: ("h.net", "/casino/", None, "block"), 11: ("health.net", "/viagra", None, "allow"),
        12: ("shop.net", "/viagra", None, "block"), 13: ("example.org", "/en/12", "example.org/en/1", "block"),
        14: ("org", "/aaaaaaaaa", "org/", "allow"), 15: ("f.net", "/setup.exe", None, "block"),
        16: ("y.net", "/axxxbporn", None, "block"),
    }
    assert urls.filter_urls(pages.limit(0)).collect() == []
    assert urls.filter_urls(pages, patterns=[]).filter("verdict = 'block'").count() == 4


def test_url_rules_meet_their_tokens():
    """Every match of a rule holds the rule's literal tokens as whole tokens."""
    import re

    samples = ["x://a.cheap-pills.net/", "x://q.net/casino/", "x://q.net/a-casino.b", "x://q.net/b?sessionid=2", "x://q/wp-login.php"]
    for rule in urls.PATTERN_RULES:
        _, regex, tokens = urls.compile_rule(rule)
        for url in samples:
            if re.search(regex, url):
                assert set(tokens) <= set(re.split(urls.TOKEN_GAP, url))


def test_url_rules_at_hyphens(spark):
    """A word of a rule counts at the hyphens of a host's label, and only as a whole token."""
    spam = ["casino-lux.biz/a", "a.adult-k.net/", "big-bets.net/x", "betting-q.io/", "ads-q.info/", "ads.q.info/p"]
    clean = ["casinos.net/", "alphabets.org.uk/", "adults.info/", "loads-q.info/", "q.net/ads-team", "big-betterment.io/"]
    pages = spark.createDataFrame(list(enumerate("http://" + u for u in spam + clean)), "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages).collect()}
    assert [found[i] for i in range(len(found))] == ["block"] * len(spam) + ["allow"] * len(clean)


def test_quality(odd, none):
    rows = quality.judge(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["n_words"] == 0 and by_id[2]["base_failed"] and not by_id[2]["kept"]
    assert by_id[6]["n_words"] == 60_000 and by_id[7]["word_chars"] == 50_000
    kept = quality.kept_documents(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in rows if r["kept"])
    assert quality.judge(none).collect() == [] and quality.kept_documents(none).collect() == []


def test_quality_estimate_against_numpy(spark):
    """Concentration steps on whole groups against the same steps in numpy."""
    rng = np.random.default_rng(9)
    x = np.rint(rng.normal(0, 60, (1500, quality.P)) + 500).astype(int)
    x[:150] += 900
    table = spark.createDataFrame([("g", *map(int, r)) for r in x], "g string, " + ", ".join(f"{c} int" for c in quality.X))
    found = quality.estimates(table).collect()[0]
    floors = np.array(list(quality.STATISTICS.values())) * quality.STEP
    mean, inverse = np.median(x, 0), np.diag(1 / np.maximum(60, floors) ** 2)
    for _ in range(quality.STEPS + 2):
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        core = x[d <= np.quantile(d, quality.CORE)]
        mean, inverse = core.mean(0), np.linalg.inv(np.cov(core.T, bias=True) + np.diag(floors**2))
    assert np.allclose([found[f"m{i}"] for i in range(quality.P)], mean, atol=6)
    assert abs(found["c0_0"] / inverse[0, 0] - 1) < 0.2


def invented(rng, n, low, high, share):
    """Texts of 80 to 160 words of ``low`` to ``high`` letters; a share of the words is capitalised."""
    words = ["".join(rng.choice(list("aeiorstnlmdk"), rng.integers(low, high + 1))) for _ in range(400)]
    pick = lambda: [w.capitalize() if rng.random() < share else w for w in rng.choice(words, rng.integers(8, 13))]
    return ["\n".join(" ".join(pick()) + "." for _ in range(rng.integers(10, 13))) for _ in range(n)]


@pytest.mark.parametrize("common", [60, 400])
def test_quality_of_small_groups(spark, common):
    """No number of rows switches a rule: a rare language is its own norm, and small tables are judged."""
    rng = np.random.default_rng(4)
    texts = [("aa", f"s{i % 4}", t) for i, t in enumerate(invented(rng, common, 2, 8, 0.1))]
    texts += [("zz", f"s{i % 4}", t) for i, t in enumerate(invented(rng, 12, 13, 19, 0))]
    texts.append(("yy", "s0", invented(rng, 1, 9, 13, 0)[0]))
    junk = [" ".join(f"{rng.integers(1 << 20)}#$%&|<>*" for _ in range(90)) for _ in range(2)]
    texts += [("aa", "s0", junk[0]), ("zz", "s1", junk[1])]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(texts)], "doc_id long, lang string, source string, text string")
    rejected = {r["doc_id"] for r in quality.judge(docs).collect() if not r["kept"]}
    assert rejected == {len(texts) - 2, len(texts) - 1}


def test_id_files(spark, odd, none, folder):
    rows = idfiles.id_files(odd, folder + "/ids").collect()
    assert len(rows) == odd.count()
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] or 0 for r in ordered] == sorted(r["doc_id"] or 0 for r in rows)
    assert ordered[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered[:-1], ordered[1:], strict=True))
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert idfiles.id_files(none, folder + "/none").collect() == []


def test_damaged_block_is_named(spark, odd, folder):
    idfiles.write_ids(odd.filter("doc_id = 6"), folder + "/ids")
    item = spark.read.parquet(folder + "/ids").collect()[0].asDict()
    raw = bytearray(item["payload"])
    raw[len(raw) // 2] ^= 8
    with pytest.raises(ValueError, match="block"):
        idfiles.read_blocks(item | {"payload": bytes(raw)})
    assert len(idfiles.read_blocks(item)) == item["n_ids"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60) | st.integers(0, 65535), min_size=1, max_size=300), min_size=1, max_size=6))
def test_coder_round_trip(blocks):
    lanes = sorted((np.array(b) for b in blocks), key=len, reverse=True)
    raw, digits = idcoder.encode(lanes)
    back = idcoder.decode(raw, digits, np.array([len(x) for x in lanes]))
    assert all((a == b).all() for a, b in zip(lanes, back, strict=True))


def test_blocks_stand_alone():
    rng = np.random.default_rng(1)
    lanes = [rng.zipf(1.4, 900) % 5000 for _ in range(3)]
    raw, digits = idcoder.encode(lanes)
    alone, own = idcoder.encode([lanes[1]])
    begin = 2 * int(digits[0])
    assert own[0] == digits[1] and alone == raw[begin : begin + 2 * int(digits[1])]


def test_any_damaged_bit_is_told_by_wrong_ids():
    """Damage in heads as well as behind them gives other ids or none, never an error."""
    rng = np.random.default_rng(3)
    lanes = [rng.zipf(1.4, size) % 5000 for size in (120, 90, 7)]
    raw, digits = idcoder.encode(lanes)
    changed = 0
    for at in range(8 * len(raw)):
        broken = bytearray(raw)
        broken[at // 8] ^= 1 << at % 8
        back = idcoder.decode(bytes(broken), digits, np.array([len(x) for x in lanes]))
        changed += not all(a.shape == b.shape and (a == b).all() for a, b in zip(lanes, back, strict=True))
    # The last bits of a coder's digits and a byte of padding may tell nothing.
    assert changed >= 0.95 * 8 * len(raw)


def test_mixing(odd, none, spark):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix_sources(odd).collect()), key=repr)
    assert mixing.mix_sources(none).collect() == [] and mixing.mixed_documents(none).collect() == []
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.filter("text IS NULL").count() == 0
    wordless = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert {(r["target"], r["taken"]) for r in mixing.mix_sources(wordless).collect()} == {(0.0, 0)}


def test_repeated_rows_share_the_edge(spark):
    """One source of equal rows: exactly as many as the target asks for, to half a document."""
    rows = [(5, "same text here", "a", "_x")] * 90 + [(6, "b b b", "b", "_x")] * 10
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, key string").repartition(4)
    found = mixing.mix_sources(docs).collect()
    for source in ("a", "b"):
        mine = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 1.5


def test_token_counts(odd, none):
    rows = counts.count_tokens(odd).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [tuple(r)[1:] for r in by_id[2]] == [(0, 0, 0, 0, 0)]
    assert [tuple(r)[1:] for r in by_id[3]] == [(0, 0, 0, 0, 0)]
    assert len(by_id[4]) == 1 and sum(r["n_tokens"] for r in by_id[7]) > 1000
    assert counts.count_tokens(none).collect() == []


def test_crossing_tokens_go_to_the_larger_part():
    tokens, crossing = counts.allocate(np.array([3, 7, 8, 14]), np.array([0, 5, 6, 7, 14]))
    # [3, 7) has two bytes in the first section; [8, 14) lies in the last.
    assert tokens.tolist() == [2, 0, 0, 2] and crossing.tolist() == [1, 0, 0, 0]


def test_top_k(spark):
    schema = "vec_id long, embedding array<float>, score int, rank string"
    rng = np.random.default_rng(3)
    vectors = [(i, [float(v) for v in rng.normal(size=4)], 1, "c") for i in range(0, 60)]
    vectors += [(100, [0.5, 0.5, 0.5, 0.5], 1, "c")] * 2 + [(7, None, 1, "c"), (None, [1.0] * 4, 1, "c")]
    vectors += [(200, [1.0, None, 1.0, 1.0], 1, "c"), (201, [float("nan")] * 4, 1, "c"), (202, [float("inf")] * 4, 1, "c")]
    vectors += [(300, [1.0, 2.0], 1, "c"), (301, [1.0, 2.0], 1, "c"), (302, [1.0, 2.0], 1, "c"), (400, [], 1, "c")]
    table = spark.createDataFrame(vectors, schema).repartition(3)
    found = topk.top_k(table).collect()
    good = [(i, np.floor(1024 * np.array(v, np.float32).astype(float))) for i, v, _, _ in vectors if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    expected = []
    for n, (i, v) in enumerate(good):
        if i % 100 == 0:
            others = [(-int(v @ w), j) for m, (j, w) in enumerate(good) if m != n and len(w) == len(v)]
            expected += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(others)[:10], start=1)]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert topk.top_k(table.limit(0)).collect() == []


def test_large_products_are_exact():
    a = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, 5]])
    assert topk.products(*a, (2**40 + 1) * (2**20 + 1))[0, 0] == (2**40 + 1) * (2**20 + 1) + 15
    assert topk.products(a[0] * 2**20, a[1] * 2**20, 2**101)[0, 0] == 2**63 - 1


def test_more_languages_than_are_learnt(spark, monkeypatch):
    """The commonest languages are learnt, fewer pieces than languages are no error, and every row gets an answer."""
    monkeypatch.setattr(language, "LANGUAGES", 3)
    monkeypatch.setattr(language, "SAMPLE_SPANS", 2)
    monkeypatch.setattr(language, "STEPS", 3)
    rows = [(i, f"word{i} text of it", f"l{i % 4 if i < 40 else i}", None, 1, 1, 1, "r") for i in range(60)]
    found = language.identify_languages(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == 60 and {r["lang_pred"] for r in found} <= {"l0", "l1", "l2", "l3"}
    assert len({r["lang_pred"] for r in found} - {"und"}) <= 3
