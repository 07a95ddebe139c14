"""Shards of near equal bytes by longest-processing-time scheduling.

Documents of equal text form a group that stays together. The groups, largest first, each go to the shard that
is least loaded then, the smaller number on a tie: the rule of Graham's LPT, kept in a heap of loads.

Groups of equal size are interchangeable, so the schedule is made from the sizes and how many groups have each,
and says how many of them every shard gets. That summary is all that reaches the driver: for B bytes in all it
has at most sqrt(2 B) entries, as different sizes add up. For a size that very many groups share, the heap's picks are
counted instead of made: they are the smallest of the loads that would arise. Which group of a size goes
where follows from its place among them by digest, so the result is that of LPT over single groups.

A group's size is the sum over its copies, so one that holds a third of all rows fills a shard by itself.
It is counted by partial sums, its documents meet their shard in a join that AQE splits, and the documents of a
shard are numbered over many tasks.

Defined results: a NULL text has no bytes, is an empty text here, and has size 1. Repeated rows are documents of
their own and have slots of their own. ``slot`` counts from 0 in each shard by doc_id, NULL first, then by digest.
An empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import local_table
from tidemark.llm.places import placed
from tidemark.operators.keysets import own_exchange
from tidemark.session import cut_lineage

SHARDS = 16
# Groups of one size whose picks are counted rather than made.
COUNTED = 512


def counted(loads: list[int], size: int, groups: int) -> list[int]:
    """How many of ``groups`` groups of equal size LPT gives to each shard.

    A shard of load l is picked at the loads l, l + size, l + 2 size, …; the picks are the ``groups`` smallest of all.
    """

    def below(limit: int) -> list[int]:
        return [max(0, -((load - limit) // size)) for load in loads]

    low, high = min(loads), max(loads) + size * groups
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(below(middle)) <= groups else (low, middle - 1)
    taken = below(low)
    left = groups - sum(taken)
    for shard, load in enumerate(loads):
        if left and load + taken[shard] * size == low:
            taken[shard] += 1
            left -= 1
    return taken


def schedule(sizes: Iterable[tuple[int, int]], shards: int = SHARDS) -> list[tuple[int, int, int, int]]:
    """(size, first place, place behind the last, shard) from (size, groups of that size)."""
    heap = [(0, shard) for shard in range(shards)]
    spans = []
    for size, groups in sorted(sizes, reverse=True):
        taken = [0] * shards
        if groups > COUNTED:
            loads = [load for _, load in sorted((shard, load) for load, shard in heap)]
            taken = counted(loads, size, groups)
            heap = [(load + size * k, shard) for shard, (load, k) in enumerate(zip(loads, taken, strict=True))]
            heapq.heapify(heap)
        else:
            for _ in range(groups):
                load, shard = heap[0]
                heapq.heapreplace(heap, (load + size, shard))
                taken[shard] += 1
        at = 0
        for shard, k in enumerate(taken):
            if k:
                spans.append((size, at, at + k, shard))
                at += k
    return spans


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, digest, shard and slot of every document."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    compact = cut_lineage(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("digest"),
        )
    )
    groups = compact.groupBy("digest").agg(F.sum("size").alias("weight"))
    ranked = placed(groups, "weight", ["digest"])
    sizes = ranked.groupBy("weight").agg(F.count("*").alias("groups")).toArrow()
    spans = schedule(zip(sizes["weight"].to_pylist(), sizes["groups"].to_pylist(), strict=True), shards)
    columns = list(zip(*spans, strict=True)) or [()] * 4
    names = (("_weight", pa.int64()), ("_from", pa.int64()), ("_to", pa.int64()), ("shard", pa.int32()))
    plan = local_table(docs.sparkSession, {
        name: (list(values), kind) for (name, kind), values in zip(names, columns, strict=True)
    })
    inside = (F.col("weight") == F.col("_weight")) & (F.col("place") >= F.col("_from")) & (F.col("place") < F.col("_to"))
    homes = ranked.join(plan, inside).select(F.col("digest").alias("_digest"), "shard")
    housed = compact.join(own_exchange(homes), F.col("digest") == F.col("_digest")).drop("_digest")
    return placed(housed, "shard", ["doc_id", "digest"]).select(
        "doc_id", "size", "text_crc32", "digest", "shard", F.col("place").alias("slot")
    )
