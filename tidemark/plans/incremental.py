"""The staged incremental run: open a load, apply the batch, publish, close the load.

Dimensions are published before facts, then the lineage, and the cutoff last. A crash in between
leaves the load open; the next run resumes it under the same lineage key. Facts and snapshots are
replaced, so repeating them is harmless; a dimension that already carries the key is not applied twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions.temporal import Instant
from tidemark.operators import loads, lookups, scd, segments, tableops, timeline
from tidemark.operators.lookups import Versions
from tidemark.session import cut_lineage
from tidemark.sources import sinks
from tidemark.sources.external import extract_changes

LAYERS = ("dimension", "fact", "integration")
LINEAGE, CUTOFF = "integration.lineage", "integration.etl_cutoff"


@dataclass(frozen=True)
class Dimension:
    load_name: str
    table: str
    business_key: str
    key: str

    @property
    def versions(self) -> Versions:
        return Versions(self.business_key, self.key)


# Load names, tables and key columns.
CITY = Dimension("City", "dimension.city", "WWI City ID", "City Key")
CUSTOMER = Dimension("Customer", "dimension.customer", "WWI Customer ID", "Customer Key")
STOCK_ITEM = Dimension("Stock Item", "dimension.stock_item", "WWI Stock Item ID", "Stock Item Key")
EMPLOYEE = Dimension("Employee", "dimension.employee", "WWI Employee ID", "Employee Key")
DIMENSIONS = (CITY, CUSTOMER, STOCK_ITEM)
SALE, HOLDING = "Sale", "Stock Holding"
SALE_TABLE, HOLDING_TABLE = "fact.sale", "fact.stock_holding"
SALE_PARTITION, SALE_KEY, INVOICE = "Invoice Date Key", "Sale Key", "WWI Invoice ID"
SALE_LOOKUPS = (
    ("WWI City ID", "City Key", CITY),
    ("WWI Customer ID", "Customer Key", CUSTOMER),
    ("WWI Bill To Customer ID", "Bill To Customer Key", CUSTOMER),
    ("WWI Stock Item ID", "Stock Item Key", STOCK_ITEM),
    ("WWI Salesperson ID", "Salesperson Key", EMPLOYEE),
)
MODIFIED = "Last Modified When"


def _top(df: DataFrame, key: str) -> int:
    return df.agg(F.coalesce(F.max(F.col(f"`{key}`")), F.lit(0))).first()[0]


@dataclass
class Incremental:
    spark: SparkSession
    root: str
    now: Instant
    prefix: str = ""

    def name(self, table: str) -> str:
        return self.prefix + table

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def publish(self, table: str, df: DataFrame) -> DataFrame:
        return sinks.refresh(df, self.name(table), self.root)

    def prepare(self) -> None:
        """Create the layers and, on first use, empty bookkeeping tables."""
        sinks.create_layers(self.spark, self.root, LAYERS, self.prefix)
        for table, schema in ((LINEAGE, schemas.LOADS), (CUTOFF, schemas.CUTOFFS)):
            if not sinks.table_exists(self.spark, self.name(table)):
                self.publish(table, self.spark.createDataFrame([], schema))

    def begin(
        self, load_name: str, cutoff: Instant, applied: Callable[[int], bool] = lambda key: False
    ) -> int:
        """Lineage key of the open load of a table; a load left open by a crash is resumed.

        A resumed load takes the cutoff asked for now, as its batch is read up to that. If its first
        batch is already in the table (``applied``), another cutoff is an error: finish that load with
        its own cutoff first.
        """
        loads.get_cutoff(self.read(CUTOFF), load_name)
        lineage = self.read(LINEAGE)
        key = loads.open_key(lineage, load_name).first()["lineage_key"]
        if key is None:
            opened = loads.open_load(lineage, load_name, cutoff, self.now)
            return loads.require_open_key(self.publish(LINEAGE, opened), load_name)
        if not loads.has_cutoff(lineage, key, cutoff):
            if applied(key):
                raise RuntimeError(
                    f"load {key} of {load_name!r} is applied up to its own cutoff; "
                    f"finish it with that one before asking for {cutoff}"
                )
            self.publish(LINEAGE, loads.restamp(lineage, key, cutoff))
        return key

    def finish(self, key: int) -> None:
        lineage, cutoffs = loads.close_load(self.read(LINEAGE), self.read(CUTOFF), key, self.now)
        lineage = self.publish(LINEAGE, lineage)
        self.publish(CUTOFF, loads.advance_cutoff(self.read(CUTOFF), lineage, key))

    def dimension(self, d: Dimension, stage: DataFrame, cutoff: Instant) -> None:
        applied = lambda key: bool(scd.already_applied(self.read(d.table), key).collect())
        key = self.begin(d.load_name, cutoff, applied)
        dim = self.read(d.table)
        if not applied(key):
            rows = scd.staged_rows(dim.drop(segments.SEGMENT), stage, key).drop(d.key)
            first = [d.business_key, "Valid From"]
            order = first + [c for c in rows.columns if c not in first]
            numbered = scd.assign_keys(rows, d.key, order, _top(dim, d.key) + 1)
            typed = numbered.withColumn(d.key, F.col(f"`{d.key}`").cast(dim.schema[d.key].dataType))
            if segments.SEGMENT in dim.columns:
                self.publish_segments(d, dim, segments.batch_rows(dim, stage, typed, d.business_key))
            else:
                self.publish(d.table, scd.close_off(dim, stage, d.business_key).unionByName(typed))
        self.finish(key)

    def publish_segments(self, d: Dimension, dim: DataFrame, rows: DataFrame) -> None:
        """Replace the open segment and the months in which the batch ends versions, in one edit of the catalog."""
        # Catalog metadata: one value per touched partition.
        touched = sorted({row[0] for row in segments.touched_segments(rows).collect()} | {segments.OPEN})
        after = segments.next_segments(dim, rows, touched)
        sinks.refresh_partitions(after, self.name(d.table), self.root, segments.SEGMENT, touched)

    def segment(self, d: Dimension) -> None:
        """Store a dimension by open and closed segments from now on; its last rewrite as a whole.

        The segmented table is complete beside the old one before it takes over the name.
        """
        dim = self.read(d.table)
        if segments.SEGMENT not in dim.columns:
            beside = f"{self.name(d.table)}__segmented"
            self.spark.sql(f"DROP TABLE IF EXISTS {beside}")
            sinks.refresh_partitions(segments.with_segment(dim), beside, self.root, segments.SEGMENT, [])
            sinks.take_over(self.spark, beside, self.name(d.table))

    def sale_keys(self, stage: DataFrame) -> DataFrame:
        """Resolve all keys; a dimension used twice is prepared once and stored, one with a long history put on a timeline."""
        out, ready = stage, {}
        first = stage.agg(F.min(MODIFIED).alias("at")).first()["at"]
        for business_key, key, d in SALE_LOOKUPS:
            if d.table not in ready:
                dim = self.read(d.table)
                if segments.SEGMENT in dim.columns and first is not None:
                    dim = segments.reaching(dim, F.lit(first))
                if lookups.longest_history(dim, d.versions) > lookups.LONG_HISTORY:
                    ready[d.table] = dim
                else:
                    prepared = lookups.prepare_versions(dim, d.versions)
                    ready[d.table] = replace(prepared, rows=cut_lineage(prepared.rows))
            versions = ready[d.table]
            if isinstance(versions, DataFrame):
                out = timeline.lookup_key_merged(out, versions, d.versions, business_key, MODIFIED, key)
            else:
                out = lookups.lookup_prepared(out, versions, business_key, MODIFIED, key)
        return out

    def sale(self, stage: DataFrame, cutoff: Instant) -> None:
        """Resolve keys, then rewrite only the invoice dates that lose or gain rows."""
        key = self.begin(SALE, cutoff)
        fact = self.read(SALE_TABLE)
        resolved = self.sale_keys(stage).withColumn("Lineage Key", F.lit(key))
        columns = [c for c in fact.columns if c != SALE_KEY]
        rows = resolved.select(
            *(F.col(f"`{c}`").cast(fact.schema[c].dataType).alias(c) for c in columns)
        )
        order = [INVOICE, *(c for c in columns if c != INVOICE)]
        numbered = scd.assign_keys(rows, SALE_KEY, order, _top(fact, SALE_KEY) + 1)
        numbered = numbered.withColumn(
            SALE_KEY, F.col(f"`{SALE_KEY}`").cast(fact.schema[SALE_KEY].dataType)
        )
        dates = tableops.touched_partitions(
            tableops.near_keys(fact, numbered, INVOICE), numbered, INVOICE, SALE_PARTITION
        )
        # Catalog metadata: one value per touched partition.
        touched = [
            row[0] for row in dates.select(F.col(f"`{SALE_PARTITION}`").cast("string")).collect()
        ]
        if None in touched:
            raise ValueError(f"a staged sale has no {SALE_PARTITION!r}")
        in_reach = F.col(f"`{SALE_PARTITION}`").isin(
            *(F.lit(d).cast(fact.schema[SALE_PARTITION].dataType) for d in touched)
        )
        after = tableops.replace_by_key(fact.filter(in_reach), numbered, INVOICE)
        sinks.refresh_partitions(
            after, self.name(SALE_TABLE), self.root, SALE_PARTITION, touched, find_by=INVOICE
        )
        self.finish(key)

    def holding(self, stage: DataFrame, cutoff: Instant) -> None:
        key = self.begin(HOLDING, cutoff)
        fact = self.read(HOLDING_TABLE)
        resolved = lookups.lookup_key_latest(
            stage,
            self.read(STOCK_ITEM.table),
            STOCK_ITEM.versions,
            STOCK_ITEM.business_key,
            STOCK_ITEM.key,
        )
        self.publish(HOLDING_TABLE, tableops.snapshot_replace(fact, resolved, key))
        self.finish(key)


def run_incremental(
    spark: SparkSession,
    stage: dict[str, DataFrame],
    root: str,
    cutoff: Instant,
    now: Instant,
    prefix: str = "",
) -> None:
    """Apply staged frames, keyed by load name, to the published warehouse tables."""
    run = Incremental(spark, root, now, prefix)
    run.prepare()
    for d in DIMENSIONS:
        if d.load_name in stage:
            run.dimension(d, stage[d.load_name], cutoff)
    if SALE in stage:
        run.sale(stage[SALE], cutoff)
    if HOLDING in stage:
        run.holding(stage[HOLDING], cutoff)



def run_changes(
    spark: SparkSession,
    sources: Mapping[str, tuple[DataFrame, str]],
    root: str,
    cutoff: Instant,
    now: Instant,
    prefix: str = "",
) -> None:
    """The run that drives itself: read each source's changes since its stored cutoff, then apply them.

    ``sources`` gives, by load name, the source and its change time. A load takes the rows after its own
    last cutoff up to ``cutoff``, which becomes the next one when the load is closed.
    """
    cutoffs = Incremental(spark, root, now, prefix).read(CUTOFF)
    stage = {
        name: extract_changes(df, changed, loads.get_cutoff(cutoffs, name), cutoff)
        for name, (df, changed) in sources.items()
    }
    run_incremental(spark, stage, root, cutoff, now, prefix)
