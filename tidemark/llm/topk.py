"""Exact top-k inner-product search in tiles.

Vectors are turned into integers (``floor(scale * x)``) and packed into shards of ``SHARD_ROWS`` rows,
queries into blocks of ``QUERY_ROWS``. Shards stay where they are, ``GROUP_SHARDS`` to a group; the query
blocks visit every group. A task multiplies one block with one shard, keeps each query's best ``k`` of
that tile, and the lists meet in a tree: ``FAN_IN`` groups at a time until one list per query is left.
Products are exact: float64 matrix products while every sum stays below 2**53, int64 below 2**63,
Python integers beyond, clamped to the range of a long.

Defined results: vectors that are NULL, or hold a NULL or non-finite component, take no part, neither
do rows with a NULL id. Vectors of different lengths are not comparable and do not meet. A query's
candidates are all rows but its own; a repeated row is its own query and a candidate of its twins.
Ties go to the smaller vec_id. Components too large for a long after scaling are clamped to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.llm.frames import empty_like, ship_package
from tidemark.session import cut_lineage

SHARD_ROWS = 4096
QUERY_ROWS = 1024
GROUP_SHARDS = 16
FAN_IN = 64
SCALE = 1024

TILE = "dim int, n long, low long, high long, ids binary, rows binary, cells binary"
FOUND = "query_row long, query_id long, vec_id long, score long"
RESULT = "query_id long, rank int, vec_id long, score long"
TILE_ARROW = pa.schema(
    [("dim", pa.int32()), *((c, pa.int64()) for c in ("n", "low", "high")),
     *((c, pa.binary()) for c in ("ids", "rows", "cells"))]
)
FOUND_ARROW = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "vec_id", "score")])


def tile(ids: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
    """One packed tile. ``cells`` is (rows, dim) of int64."""
    low, high = (int(cells.min()), int(cells.max())) if cells.size else (0, 0)
    values = [cells.shape[1], len(ids), low, high, ids.tobytes(), rows.tobytes(), cells.tobytes()]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(values, TILE_ARROW, strict=True)], schema=TILE_ARROW
    )


class Packer:
    """Collects rows by dimension and gives full tiles back."""

    def __init__(self, size: int) -> None:
        self.size, self.held = size, {}

    def add(self, ids: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        dim = cells.shape[1]
        held = self.held.setdefault(dim, [])
        held.append((ids, rows, cells))
        if sum(len(x[0]) for x in held) >= self.size:
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            full = len(whole[0]) // self.size * self.size
            for at in range(0, full, self.size):
                yield tile(*(x[at : at + self.size] for x in whole))
            self.held[dim] = [tuple(x[full:] for x in whole)]

    def rest(self) -> Iterator[pa.RecordBatch]:
        for held in self.held.values():
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            if len(whole[0]):
                yield tile(*whole)


def shards(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Packed shards with a number each."""
    sound = F.forall(
        F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    chosen = (
        vectors.select(
            F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
        )
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
        .filter(sound)
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, seen = Packer(SHARD_ROWS), 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1)
            flat = values.flatten().to_numpy(zero_copy_only=False)
            ends = np.asarray(values.offsets)
            ends = ends - ends[0]
            whole = np.floor(flat * scale)
            # The largest double below 2**63 keeps the conversion defined.
            whole = np.clip(whole, -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64)
            lengths = np.diff(ends)
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                cells = whole[(ends[at][:, None] + np.arange(dim)).ravel()].reshape(len(at), dim)
                yield from packer.add(ids[at], seen + at, cells)
            seen += len(ids)
        yield from packer.rest()

    ship_package(vectors.sparkSession)
    packed = chosen.mapInArrow(pack, TILE)
    # The upper bits of the id are the partition; 20 bits are room for 2**32 rows of it.
    place = F.monotonically_increasing_id()
    shard = F.shiftleft(F.shiftright(place, 33), 20) + place.bitwiseAND(F.lit((1 << 33) - 1))
    return packed.withColumn("shard", shard)


def query_blocks(packed: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, packed into blocks; rows carry (shard, place)."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(QUERY_ROWS)
        for batch in batches:
            for item in batch.to_pylist():
                ids = np.frombuffer(item["ids"], np.int64)
                at = np.flatnonzero(ids % every == 0)
                cells = np.frombuffer(item["cells"], np.int64).reshape(len(ids), item["dim"])[at]
                yield from packer.add(ids[at], item["shard"] * SHARD_ROWS + at, cells)
        yield from packer.rest()

    return packed.mapInArrow(choose, TILE)


def products(queries: np.ndarray, cells: np.ndarray, largest: int) -> np.ndarray:
    bound = largest * max(1, queries.shape[1])
    if bound < 1 << 53:
        return (queries.astype(np.float64) @ cells.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return queries @ cells.T
    exact = queries.astype(object) @ cells.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best_of_tile(item: dict, k: int) -> pa.RecordBatch:
    """Each query's best ``k`` rows of one shard, its own row left out."""
    get = lambda name: np.frombuffer(item[name], np.int64)
    query_ids, query_rows, ids = get("q_ids"), get("q_rows"), get("ids")
    queries = get("q_cells").reshape(len(query_ids), item["dim"])
    cells = get("cells").reshape(len(ids), item["dim"])
    largest = max(abs(item["q_low"]), abs(item["q_high"])) * max(abs(item["low"]), abs(item["high"]))
    scores = products(queries, cells, largest)
    own = query_rows - item["shard"] * SHARD_ROWS
    found = []
    for i, line in enumerate(scores):
        if len(line) > k + 1:
            # One more than k, as the query's own row may be among them; ties at the edge all stay.
            at = np.flatnonzero(line >= np.partition(line, -k - 1)[-k - 1])
        else:
            at = np.arange(len(line))
        at = at[at != own[i]] if 0 <= own[i] < len(ids) else at
        at = at[np.lexsort((ids[at], ~line[at]))][:k]
        found.append((np.full(len(at), query_rows[i]), np.full(len(at), query_ids[i]), ids[at], line[at]))
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=FOUND_ARROW)


def best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each group; Spark drops the others before the shuffle as well."""
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    every: int = 100,
    scale: int = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    packed = cut_lineage(shards(vectors, id_col, vector_col, scale))
    blocks = cut_lineage(query_blocks(packed, every))
    n_shards = packed.count()
    if not n_shards:
        return empty_like(vectors, RESULT)
    groups = -(-n_shards // GROUP_SHARDS)
    grouped = packed.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)))
    visiting = blocks.select(
        *(F.col(c).alias(c if c == "dim" else f"q_{c}") for c in blocks.columns)
    ).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    tiles = grouped.join(visiting, ["group", "dim"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups_of = batch.column("group")
            for i in range(batch.num_rows):
                item = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                out = best_of_tile(item, k)
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(np.full(out.num_rows, groups_of[i].as_py()), pa.int64())],
                    names=[*out.schema.names, "group"],
                )

    found = tiles.mapInArrow(multiply, f"{FOUND}, group long")
    while groups > 1:
        found = best(found, ["query_row", "group"], k).drop("rank")
        found = found.withColumn("group", F.floor(F.col("group") / FAN_IN))
        groups = -(-groups // FAN_IN)
    return best(found, ["query_row"], k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
