"""Mix sources to target weights: whole epochs first, then Efraimidis-Spirakis sampling of the rest.

Sources weigh 3, 1, 2 in turn in code-point order (NULL last) and share ``share`` times all words. A
target stops at ``cap`` times the source's size; what it leaves goes to the others by weight until
none is above. A source whose target is ``e`` sizes and a remainder gives each document ``e`` times and
then draws documents without replacement: each has the key ``-ln(u) / w`` with ``u`` from an MD5 of its id
and text and ``w = words / (words + symbols)`` as quality weight, and documents are taken in key order
while the one at the budget's edge still fits by half. Documents are taken whole, so a source's
taken words differ from its target by at most half of one document.

No source is sorted in one place. Keys are cut into buckets of about ``BUCKET_ROWS`` documents, bucket
sums locate the edge, and only the bucket that holds it is ordered. Rows with the edge's own key
(repeated rows) are numbered per partition of the written working table and offset by partition sums.

Defined results: a NULL text has size 0; a document or source without words gets 0; an empty table
gives an empty result; repeated rows are drawn one by one; NULL ids and NULL sources are ordinary
values. Ties of the key go by doc_id, then by row. Reruns agree as multisets of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.frames import WORD
from tidemark.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BUCKET_ROWS = 4096
SYMBOLS = "[#*$%&|<>]"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def sampling_key(doc_id: Column, text: Column, size: Column) -> Column:
    """Exponential key, scaled by the quality weight; the smallest keys are taken first."""
    digest = F.md5(F.concat_ws("|", doc_id.cast("string"), text))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    symbols = F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0))
    return -F.log(u) * (size + symbols) / F.greatest(size, F.lit(1))


def targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: int) -> DataFrame:
    """source, source_size, n_docs, target from one row per source.

    Sources are numbered in code-point order by a range sort. Each pass gives the words that capped
    sources leave to the others; one row per pass reaches the driver.
    """
    from tidemark.operators.scd import assign_keys

    numbered = assign_keys(
        sizes.withColumn("_last", F.col("source").isNull()), "_no", ["_last", "source"], 0
    )
    turn = (F.col("_no") % len(weights)).cast("int")
    weighed = cut_lineage(
        numbered.withColumn(
            "weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long")
        ).drop("_no", "_last")
    )
    total = weighed.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    wanted, level, capped = share * total, None, -1
    is_capped = lambda at: F.col("weight") * F.lit(at) > cap * F.col("source_size")
    while True:
        over = is_capped(level) if level is not None else F.lit(False)
        now = weighed.agg(
            F.coalesce(F.sum(F.when(over, 1)), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(over, cap * F.col("source_size"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("rest"),
        ).first()
        if now["n"] == capped or not now["rest"]:
            break
        capped, level = now["n"], (wanted - now["full"]) / now["rest"]
    level = level or 0.0
    return weighed.select(
        "source",
        "source_size",
        "n_docs",
        F.when(is_capped(level), (cap * F.col("source_size")).cast("double"))
        .otherwise(F.col("weight") * F.lit(level))
        .alias("target"),
    )


def bucket(key: Column, n_docs: Column) -> Column:
    """Place of a key among about ``n_docs / BUCKET_ROWS`` equally likely ranges."""
    count = F.ceil(n_docs / BUCKET_ROWS)
    return F.floor((1 - F.exp(-key)) * count)


def edges(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: epochs, and the last key and id taken in the fractional draw.

    ``edge_key`` is NULL where the draw takes nothing; rows below (edge_key, edge_id) are all taken, of
    rows equal to it the first ``edge_rows``.
    """
    from tidemark.operators.keysets import own_exchange

    plan = own_exchange(
        sources.select(
            F.col("source").alias("_source"),
            "n_docs",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0)
            .alias("epochs"),
            (
                F.col("target")
                - F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                .otherwise(0)
                * F.col("source_size")
            ).alias("budget"),
        )
    )
    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "bucket", bucket(F.col("key"), F.col("n_docs"))
    )
    upto = W.partitionBy("source").orderBy("bucket")
    sums = (
        placed.groupBy("source", "bucket", "epochs", "budget")
        .agg(F.sum("size").alias("n"))
        .withColumn("before", F.sum("n").over(upto) - F.col("n"))
    )
    # The last bucket that begins below the budget holds the edge: every earlier one fits whole.
    edge = (
        sums.filter(F.col("before") < F.col("budget"))
        .groupBy(F.col("source").alias("_s"), "budget")
        .agg(F.max("bucket").alias("_b"), F.max_by("before", "bucket").alias("before"))
    )
    inside = sized.join(plan.drop("budget"), F.col("source").eqNullSafe(F.col("_source")))
    inside = inside.withColumn("bucket", bucket(F.col("key"), F.col("n_docs"))).join(
        own_exchange(edge), F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b"))
    )
    # Repeated rows count as one entry with a multiplicity, so a hot one does not fill a window.
    tied = inside.groupBy("source", "key", "doc_id", "size", "before", "budget").agg(
        F.count("*").alias("copies")
    )
    order = W.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_first(), "size")
    begin = F.col("before") + F.sum(F.col("size") * F.col("copies")).over(order) - (
        F.col("size") * F.col("copies")
    )
    # Copy number j (from 0) is taken while 2 * (begin + j * size) + size <= 2 * budget.
    fitting = F.when(
        F.col("size") > 0,
        F.floor((2 * F.col("budget") - 2 * F.col("begin") - F.col("size")) / (2 * F.col("size"))) + 1,
    ).otherwise(F.when(F.col("begin") <= F.col("budget"), F.col("copies")).otherwise(0))
    last = (
        tied.withColumn("begin", begin)
        .withColumn("rows", F.least(fitting, F.col("copies")).cast("long"))
        .filter("rows > 0")
        .groupBy(F.col("source").alias("_s"))
        .agg(
            F.max_by(
                F.struct("key", "doc_id", "size", "rows"),
                F.struct("key", F.col("doc_id").isNotNull(), "doc_id", "size"),
            ).alias("last")
        )
    )
    # Nothing of the edge bucket may fit while earlier buckets do: they end below the budget.
    earlier = edge.select("_s", "_b")
    return (
        plan.join(earlier, F.col("_source").eqNullSafe(F.col("_s")), "left")
        .drop("_s")
        .join(last, F.col("_source").eqNullSafe(F.col("_s")), "left")
        .select(
            "_source",
            "epochs",
            F.col("n_docs").alias("_n_docs"),
            F.col("_b").alias("edge_bucket"),
            F.col("last.key").alias("edge_key"),
            F.col("last.doc_id").alias("edge_id"),
            F.col("last.size").alias("edge_size"),
            F.col("last.rows").alias("edge_rows"),
        )
    )


def place_to_edge() -> tuple[Column, Column]:
    """(row lies before the edge, row equals the edge) for rows joined with ``edges``."""
    here = bucket(F.col("key"), F.col("_n_docs"))
    edge = F.col("edge_bucket")
    known = F.col("edge_key").isNotNull()
    mine = F.struct(F.col("key"), F.col("doc_id").isNotNull(), F.col("doc_id"), F.col("size"))
    last = F.struct(F.col("edge_key"), F.col("edge_id").isNotNull(), F.col("edge_id"), F.col("edge_size"))
    before = edge.isNotNull() & ((here < edge) | ((here == edge) & known & (mine < last)))
    same = edge.isNotNull() & (here == edge) & known & (mine == last)
    return F.coalesce(before, F.lit(False)), F.coalesce(same, F.lit(False))


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size, key: the compact working table."""
    return (
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("_t")
        )
        .withColumn("size", word_count(F.col("_t")))
        .select("doc_id", "source", "size", sampling_key(F.col("doc_id"), F.col("_t"), F.col("size")).alias("key"))
    )


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(working rows, one row per source with its target, one row per source with its edge)."""
    sized = cut_lineage(sized_rows(docs, id_col, text_col, source_col))
    sizes = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    sources = cut_lineage(targets(sizes, weights, share, cap))
    return sized, sources, cut_lineage(edges(sized, sources))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row."""
    from tidemark.operators.keysets import own_exchange

    sized, sources, edge = plan_mix(docs, **options)
    known = own_exchange(
        sources.join(edge, F.col("source").eqNullSafe(F.col("_source")))
        .drop("source", "n_docs")
    )
    before, same = place_to_edge()
    # Stable since the working table is written: the upper bits are the partition.
    rows = sized.withColumn("_row", F.monotonically_increasing_id())
    placed = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).select(
        *sized.columns, "_row", "source_size", "target", "epochs", "edge_rows",
        before.alias("before"), same.alias("same"),
    )
    ties = placed.filter("same").withColumn("_part", F.shiftright("_row", 33))
    per_part = ties.groupBy("source", "_part").agg(F.count("*").alias("n"))
    offsets = per_part.withColumn(
        "offset",
        F.sum("n").over(W.partitionBy("source").orderBy("_part")) - F.col("n"),
    ).select(F.col("source").alias("_s"), F.col("_part").alias("_p"), "offset")
    within = F.row_number().over(W.partitionBy("source", "_part").orderBy("_row"))
    resolved = (
        ties.withColumn("_no", within)
        .join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
        .withColumn("drawn", F.col("_no") + F.col("offset") <= F.col("edge_rows"))
    )
    picked = placed.filter("NOT same").withColumn("drawn", F.col("before"))
    columns = ["doc_id", "source", "size", "source_size", "target", "epochs", "drawn"]
    taken = F.col("size") * (F.col("epochs") + F.col("drawn").cast("long"))
    return (
        picked.select(*columns)
        .unionByName(resolved.select(*columns))
        .select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Rows that equal the edge's row in id and text are kept or left together, as the smaller error asks.
    """
    from tidemark.operators.keysets import own_exchange

    id_col, text_col, source_col = (
        options.get(k, d) for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))
    )
    sized, _, edge = plan_mix(docs, **options)
    copies = sized.groupBy("source", "key", "doc_id", "size").agg(F.count("*").alias("copies"))
    alone = edge.join(
        copies.withColumnsRenamed({"source": "_s", "doc_id": "_d", "key": "_k", "size": "_z"}),
        F.col("_source").eqNullSafe(F.col("_s"))
        & (F.col("edge_key") == F.col("_k"))
        & F.col("edge_id").eqNullSafe(F.col("_d"))
        & (F.col("edge_size") == F.col("_z")),
        "left",
    ).select(*edge.columns, (2 * F.col("edge_rows") >= F.col("copies")).alias("edge_taken"))
    before, same = place_to_edge()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    keyed = docs.select(row.alias("_row"), F.col(f"`{text_col}`").alias("_t"),
                        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"))
    keyed = keyed.withColumn("size", word_count(F.col("_t"))).withColumn(
        "key", sampling_key(F.col("doc_id"), F.col("_t"), F.col("size"))
    )
    times = F.col("epochs") + (before | (same & F.coalesce("edge_taken", F.lit(False)))).cast("long")
    return (
        keyed.drop("_t")
        .join(own_exchange(alone), F.col("source").eqNullSafe(F.col("_source")))
        .select("_row", F.when(F.col("size") > 0, times).otherwise(0).alias("times"))
        .filter("times > 0")
        .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_copy"))
        .select("_row.*")
    )
