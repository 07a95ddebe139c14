"""As-of lookups for long histories: versions and staged rows on one timeline per business key.

Both are put in order of (business key, time), range-partitioned, so that a key with millions of versions and rows
lies over many tasks. In each partition the last version before a row is the running last value; what a key had
reached when a partition begins is carried over from the partitions before. Carried are only keys that lie in more
than one partition, at most one end and one beginning for each. No row meets all versions of its key, and nothing
about the stage or the dimension is put into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.operators.keysets import own_exchange
from tidemark.operators.lookups import UNKNOWN_KEY, Versions
from tidemark.session import cut_lineage


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    """The rows by range of ``order``, with their partition ``part`` and place ``at``; stored, so that both stay."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(placed.withColumn("at", F.monotonically_increasing_id())).withColumn("part", F.shiftright("at", 33))


def disjoint_versions(dim: DataFrame, v: Versions) -> DataFrame:
    """bk, vf, vt, key: every version cut back to what follows the latest end before it, the earliest start first.

    The same intervals as ``lookups.effective_versions`` gives, without a window over a whole key.
    """
    versions = dim.select(
        _q(v.business_key).alias("bk"), _q(v.valid_from).alias("vf"), _q(v.valid_to).alias("vt"), _q(v.key).alias("key")
    ).filter("bk IS NOT NULL AND vf < vt")
    rows = _in_order(versions, "bk", "vf", "key")
    ends = rows.groupBy("bk", "part").agg(F.max("vt").alias("reached"))
    key = W.partitionBy("bk").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        F.col("bk").alias("_bk"), F.col("part").alias("_part"), F.max("reached").over(key).alias("carried")
    ).filter("carried IS NOT NULL")
    earlier = W.partitionBy("part", "bk").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    inside = rows.withColumn("before", F.max("vt").over(earlier))
    met = (F.col("bk") == F.col("_bk")) & (F.col("part") == F.col("_part"))
    cut = inside.join(own_exchange(carried), met, "left").withColumn("vf", F.greatest("vf", "before", "carried"))
    return cut.filter("vf < vt").select("bk", "vf", "vt", "key")


def lookup_key_merged(
    stage: DataFrame,
    dim: DataFrame,
    v: Versions,
    business_key: str,
    ts: str,
    out: str,
    default: int = UNKNOWN_KEY,
) -> DataFrame:
    """Add ``out`` as ``lookups.lookup_key_asof`` does: the same keys by another plan."""
    columns = [c for c in stage.columns if c != out]
    moment = dim.schema[v.valid_from].dataType
    version = F.struct("key", "vt")
    events = disjoint_versions(dim, v).select(
        "bk", F.col("vf").alias("moment"), F.lit(1).alias("kind"), version.alias("version"),
    ).unionByName(
        stage.select(
            _q(business_key).alias("bk"), _q(ts).cast(moment).alias("moment"), F.lit(0).alias("kind"),
            F.struct(*map(_q, columns)).alias("row"),
        ),
        allowMissingColumns=True,
    )
    # A version holds behind its start, so rows at that moment stand before it.
    rows = _in_order(events, "bk", "moment", "kind")
    ends = rows.filter("kind = 1").groupBy("bk", "part").agg(F.max_by("version", "at").alias("reached"))
    # A key's partitions, whether or not they hold a version of it.
    parts = rows.groupBy("bk", "part").agg(F.count("*").alias("_n")).filter("bk IS NOT NULL")
    known = parts.join(ends.withColumnsRenamed({"bk": "_b", "part": "_p"}), (F.col("bk") == F.col("_b")) & (F.col("part") == F.col("_p")), "left")
    key = W.partitionBy("bk").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = known.select(
        F.col("bk").alias("_bk"), F.col("part").alias("_part"),
        F.last("reached", ignorenulls=True).over(key).alias("carried"),
    ).filter("carried IS NOT NULL")
    so_far = W.partitionBy("part", "bk").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    inside = rows.withColumn("last", F.last("version", ignorenulls=True).over(so_far)).filter("kind = 0")
    met = (F.col("bk") == F.col("_bk")) & (F.col("part") == F.col("_part"))
    found = inside.join(own_exchange(carried), met, "left").withColumn("last", F.coalesce("last", "carried"))
    holds = F.when(F.col("moment") <= F.col("last.vt"), F.col("last.key"))
    key_type = dim.schema[v.key].dataType
    return found.select("row.*", F.coalesce(holds, F.lit(default).cast(key_type)).alias(out))
