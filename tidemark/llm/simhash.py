"""SimHash near-duplicates with bit-sliced comparison.

**Fingerprint.** A-Z is lower-cased, words are cut at ASCII white space, and every 4-word shingle (repeats
included, joined by a space; the whole sequence if it is shorter) is hashed by XXH64 with seed 42. A bit
is set where over half the hashes have it. No words: fingerprint zero, linked like any other.

**Links.** Fingerprints within ``RADIUS`` bits are linked, and a document's component is named by the
smallest doc_id in it. Equal fingerprints are one entry from the start. Of ``blocks`` bit blocks at least
``blocks - RADIUS`` agree in a linked pair, so an entry is filed under every choice of that many blocks
and no link is missed; the number of blocks grows with the table, so that keys stay selective. A
bucket above ``TILE_ROWS`` entries is cut into chunks, and each pair of chunks is a tile of its own.

**Bit slices.** In a tile, 64 entries form a word per bit position. One query bit against a word gives the
differing lanes of 64 entries; carry-save counters (ones, twos, fours) add them up, and a word drops out as
soon as all its lanes exceed the radius. A tile yields a spanning star of its links, never all pairs.

**Components** by alternating large-star and small-star rounds over links between fingerprints, written
to the checkpoint folder after each round.

Defined results: NULL text has no words; a NULL doc_id keeps its row and names no component unless all
its members are NULL; repeated rows share a component and repeat. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.frames import WORD_RE_BYTES, arrow_column, ship_package
from tidemark.operators.keysets import own_exchange
from tidemark.session import cut_lineage

SHINGLE = 4
RADIUS = 4
TILE_ROWS = 4096
SEED = 42
LANES = 64
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
# Cells (query and 64 lanes) compared in one go: 32 MB of counters.
CELLS = 1 << 20
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None) -> list[int]:
    words = WORD_RE_BYTES.findall(text.encode().lower()) if text else []
    if not words:
        return []
    if len(words) < SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    runs = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    return [xxhash.xxh64_intdigest(run, SEED) for run in runs]


def fingerprint(text: str | None) -> int:
    hashes = np.array(shingle_hashes(text), np.uint64)
    if not len(hashes):
        return 0
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        # Little-endian bytes and bits: column b is bit b.
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(text: str | Column) -> Column:
    """The fingerprint as a signed long."""

    def batch(texts: list[str | None]) -> pa.Array:
        return pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return arrow_column(batch, "long", text)


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes: (words, 64) where bit lane of [word, b] is bit b of entry 64 * word + lane."""
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, LANES, 8), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)[:, :, 0]


def near_lanes(queries: np.ndarray, planes: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cells with a hit, their hit lanes) for cells of one query and one plane word each.

    ``skip`` marks lanes that do not count. Words are dropped once no lane is within the radius.
    """
    alive, over = np.arange(len(queries)), skip.copy()
    ones, twos, fours = (np.zeros(len(queries), np.uint64) for _ in range(3))
    for bit in range(64):
        mine = np.uint64(0) - ((queries[alive] >> np.uint64(bit)) & np.uint64(1))
        add = planes[alive, bit] ^ mine
        carry = ones & add
        ones ^= add
        add = twos & carry
        twos ^= carry
        over |= fours & add
        fours ^= add
        # Above four: four and something. Once over, always over.
        over |= fours & (ones | twos)
        if bit % 8 == 7 and bit >= 15:
            keep = over != ALL
            if not keep.all():
                alive, over = alive[keep], over[keep]
                ones, twos, fours = ones[keep], twos[keep], fours[keep]
    return alive, ~over


def merge(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels (smallest place of each set) after joining the given places."""
    while len(left):
        a, b = labels[left], labels[right]
        differ = a != b
        if not differ.any():
            return labels
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped
    return labels


def links_of_tiles(tile: np.ndarray, side: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among whole tiles.

    ``tile`` numbers the tiles in order. ``side`` is 2 for the entries of a tile within one chunk, else 0
    and 1 for its two chunks, in order; then only entries of different chunks are compared.
    """
    starts = np.flatnonzero(np.diff(tile, prepend=tile[0] - 1) != 0)
    side = side.copy()
    ends = np.append(starts[1:], len(tile))
    # Where a hash joins two tiles of different kinds, all of their entries meet.
    mixed = side[ends - 1] != side[starts]
    for a, b in zip(starts[mixed & (side[ends - 1] == 2)], ends[mixed & (side[ends - 1] == 2)], strict=True):
        side[a:b] = 2
    # The entries that stand in lanes: the second chunk, or all.
    first_lane = starts + np.array([int((side[a:b] == 0).sum()) for a, b in zip(starts, ends, strict=True)], int)
    lanes = ends - first_lane
    words = -(-lanes // LANES)
    base = np.concatenate(([0], np.cumsum(words)))
    slot = np.full(int(base[-1]) * LANES, -1)
    for i in range(len(starts)):
        slot[base[i] * LANES : base[i] * LANES + lanes[i]] = np.arange(first_lane[i], ends[i])
    padded = np.where(slot >= 0, prints[slot], 0).astype(np.uint64)
    planes = planes_of(padded)
    vacant = np.packbits((slot < 0).reshape(-1, LANES), axis=1, bitorder="little").view(np.uint64)[:, 0]
    # The entries that query: the first chunk, or all.
    asking = np.where(side[starts] == 2, ends, first_lane) - starts
    labels = np.arange(len(prints))
    cells = asking * words
    group = np.repeat(np.arange(len(starts)), cells)
    nth = np.arange(len(group)) - np.repeat(np.cumsum(cells) - cells, cells)
    who = starts[group] + nth // np.maximum(words[group], 1)
    word = base[group] + nth % np.maximum(words[group], 1)
    # An entry need not meet lanes before its own place.
    useful = (side[who] == 0) | (slot[np.minimum(word * LANES + LANES - 1, len(slot) - 1)] > who) | (
        slot[np.minimum(word * LANES + LANES - 1, len(slot) - 1)] < 0
    )
    who, word = who[useful], word[useful]
    for at in range(0, len(who), CELLS):
        w, q = word[at : at + CELLS], who[at : at + CELLS]
        hit, found = near_lanes(prints[q], planes[w], vacant[w])
        for part in range(0, len(hit), 1 << 14):
            mask = np.unpackbits(
                found[part : part + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            cell, lane = np.nonzero(mask)
            cell = hit[part : part + (1 << 14)][cell]
            labels = merge(labels, q[cell], slot[w[cell] * LANES + lane])
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    return linked, labels[linked]


def links_in_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (tile, side, print) sorted by tile and side; a tile may span batches."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        tile, side, prints = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(tile):
            return
        number = np.cumsum(np.diff(tile, prepend=tile[0]) != 0)
        a, b = links_of_tiles(number, side, prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(prints[a]), pa.array(prints[b])], schema=LINK)

    for batch in batches:
        new = tuple(np.asarray(batch.column(i)) for i in range(3))
        # All but the last tile of what is here is whole.
        cut = int(np.searchsorted(new[0], new[0][-1])) if len(new[0]) else 0
        if cut or (held and len(new[0]) and held[-1][0][-1] != new[0][0]):
            yield from flush([*held, tuple(x[:cut] for x in new)])
            held = [tuple(x[cut:] for x in new)]
        else:
            held.append(new)
    if held:
        yield from flush(held)


def blocks_for(entries: int) -> int:
    """Blocks so that a key of ``blocks - RADIUS`` of them has about as many values as entries."""
    blocks = RADIUS + 1
    while 2 ** (64 * (blocks - RADIUS) // blocks) * 64 < entries and blocks < 2 * RADIUS:
        blocks += 1
    return blocks


def block_keys(print_col: Column, blocks: int) -> Column:
    """Array of (choice, bits): one key per choice of ``blocks - RADIUS`` blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    keys = [
        F.xxhash64(print_col.bitwiseAND(F.lit(signed(sum(chosen)))), F.lit(i))
        for i, chosen in enumerate(combinations(masks, blocks - RADIUS))
    ]
    return F.array(*keys)


def link_prints(entries: DataFrame, blocks: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``p``; they span every component of the radius.

    Keys are hashes of the blocks. Two keys that share a hash share a bucket, which costs comparisons
    and loses nothing.
    """
    filed = entries.select("p", F.explode(block_keys(F.col("p"), blocks)).alias("key"))
    crowded = (
        filed.groupBy("key")
        .count()
        .filter(F.col("count") > TILE_ROWS)
        .select(F.col("key").alias("_key"), F.ceil(F.col("count") / TILE_ROWS).alias("chunks"))
    )
    spread = filed.join(own_exchange(crowded), F.col("key") == F.col("_key"), "left").withColumn(
        "chunks", F.coalesce("chunks", F.lit(1).cast("long"))
    )
    mine = F.pmod(F.xxhash64("p", F.lit(1)), F.col("chunks"))
    tiles = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda other: F.struct(
            F.xxhash64("key", F.least("mine", other), F.greatest("mine", other)).alias("tile"),
            F.when(F.col("mine") == other, 2).when(F.col("mine") < other, 0).otherwise(1).alias("side"),
        ),
    )
    placed = spread.withColumn("mine", mine).select("p", F.explode(tiles).alias("t"))
    # Two tiles with one hash would mix sides; 2 (all with all) for both keeps that exact, see links.
    dealt = placed.select("t.tile", "t.side", "p").repartition("tile").sortWithinPartitions("tile", "side")
    ship_package(entries.sparkSession)
    return dealt.mapInArrow(links_in_partition, "a long, b long").filter("a <> b")


def star_rounds(links: DataFrame) -> DataFrame:
    """(p, root) for every linked fingerprint except the roots themselves."""
    edges = cut_lineage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        # Large star: every larger neighbour of u goes to u's smallest neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
        low = own_exchange(low.select("_u", F.least("_u", "m").alias("m")))
        large = (
            both.join(low, F.col("u") == F.col("_u"))
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Small star: u and its smaller neighbours go to the smallest of them.
        low = own_exchange(large.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m")))
        small = large.join(low, F.col("u") == F.col("_u")).select(
            F.explode(
                F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
            ).alias("e")
        )
        edges = cut_lineage(small.select("e.*").filter("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == before:
            return edges.select(F.col("u").alias("p"), F.col("v").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, p (fingerprint as a long), root (of its component), component_id per row."""
    text = F.col(text_col)
    prints = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text).alias("text_hash"),
            fingerprints(text).alias("p"),
        )
    )
    return components(prints)


def components(prints: DataFrame) -> DataFrame:
    """``prints`` (doc_id, p and any others) with the root and the smallest doc_id of each component."""
    entries = cut_lineage(prints.groupBy("p").agg(F.min("doc_id").alias("first")))
    roots = star_rounds(link_prints(entries, blocks_for(entries.count())))
    roots = own_exchange(roots.withColumnRenamed("p", "_p"))
    rooted = entries.join(roots, F.col("p") == F.col("_p"), "left").select(
        "p", "first", F.coalesce("root", "p").alias("root")
    )
    names = own_exchange(
        rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("component_id"))
    )
    named = rooted.join(names, F.col("root") == F.col("_root")).select(
        F.col("p").alias("_p"), "root", "component_id"
    )
    return prints.join(own_exchange(named), F.col("p") == F.col("_p")).drop("_p")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One document of each component with all its columns: the smallest doc_id, then text hash.

    A component without any doc_id keeps one of its rows as well. Rows of the same id and text leave one.
    """
    found = near_duplicates(docs)
    kept = (
        found.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("k"))
        .select(
            F.col("k.no_id").alias("_no_id"),
            F.coalesce("k.doc_id", F.lit(0)).alias("_id"),
            F.col("k.text_hash").alias("_hash"),
        )
    )
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    keyed = docs.select(row.alias("row")).select(
        "row",
        F.col("row.doc_id").isNull().alias("no_id"),
        F.coalesce("row.doc_id", F.lit(0)).alias("id"),
        F.xxhash64("row.text").alias("hash"),
    )
    # The first of equal rows is taken before the shuffle that the join then shares.
    order = W.partitionBy("no_id", "id", "hash").orderBy(F.xxhash64("row"))
    once = keyed.withColumn("rank", F.row_number().over(order)).filter("rank = 1")
    same = (F.col("no_id") == F.col("_no_id")) & (F.col("id") == F.col("_id")) & (F.col("hash") == F.col("_hash"))
    return once.join(kept, same, "left_semi").select("row.*")
