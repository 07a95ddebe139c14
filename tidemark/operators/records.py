"""Validation of JSON records: a contract is a table of rules, a record is opened into rows that meet it.

``record_nodes`` turns a record into one row per value: the number of its rule, its JSON type, the value, and for an
object the names of its members. ``rule_table`` writes a contract as a small table with one rule per place. Both meet
in a join on that number; what a rule forbids is said by its row. A contract's places and the shapes of good objects
of plain members are written into the opening of records, so that such objects cost one test. An object's rule lists the members it asks for and those it allows: absent and unknown ones are set
differences with the names at hand, and nothing has to be made up for what is not there.

A record is parsed once. Nothing is shuffled before the violations, and of those only distinct ones.

Numbers: an integer is a number without a fraction, ``1.0`` as well, as in JSON Schema. Ranges are tested on the
number itself, however large; one that the target's type cannot hold is a violation of its own.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark import schemas
from tidemark.operators.backlog import TARGET_PATTERN
from tidemark.operators.keysets import own_exchange


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"
    required: bool = False
    nullable: bool = False
    enum: tuple[str, ...] = ()
    pattern: str | None = None
    min_length: int | None = None
    minimum: int | None = None
    maximum: int | None = None
    min_items: int | None = None
    item_kind: str | None = None
    items: tuple["Field", ...] = ()
    properties: tuple["Field", ...] = ()
    closed: bool = True


@dataclass(frozen=True)
class Contract:
    name: str
    schema: str
    fields: tuple[Field, ...] = field(default=())


# What the integer types of a target hold.
HOLDS = {"int": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1)}
BIGINT = HOLDS["bigint"]
NUMBER = "decimal(38,0)"
ROOT = "$"
# Types of plain members, and the shapes of an object that are listed at most.
PLAIN, MOST_SHAPES = {"string": "STRING", "boolean": "BOOLEAN", "integer": "BIGINT"}, 16
# Ways to break a rule besides lacking members; the last of them is an unknown member.
WAYS = 9
# ``pos`` and ``last``: numbers of the rule and of the last one inside it. ``known`` is NULL for an open object.
RULES = (
    f"parent string, name string, path string, pos int, last int, label string, kind string, nullable boolean, "
    f"enum array<string>, pattern string, min_length int, minimum {NUMBER}, maximum {NUMBER}, lowest {NUMBER}, "
    f"highest {NUMBER}, min_items int, required array<struct<name:string,pos:int>>, known array<string>, unknown string"
)


def _type_of(schema: T.DataType | None, name: str) -> T.DataType | None:
    """Type of a member in the target's schema."""
    if isinstance(schema, T.ArrayType):
        schema = schema.elementType
    return schema[name].dataType if isinstance(schema, T.StructType) and name in schema.names else None


def contract_rules(contract: Contract) -> list[dict]:
    """The rules of a contract, one per place, in the order of its fields."""
    rules: list[dict] = []

    def decimal(value: int | None) -> Decimal | None:
        return None if value is None else Decimal(value)

    def rule(
        f: Field, parent: str | None, name: str | None, label: str, inside: Sequence[Field], closed: bool, target: T.DataType | None
    ) -> None:
        path = ROOT if parent is None else f"{parent}[]" if name is None else f"{parent}.{name}"
        prefix = f"{label}." if label else ""
        low, high = HOLDS.get(target.simpleString(), (None, None)) if target and f.kind == "integer" else (None, None)
        own = {
            "parent": parent, "name": name, "path": path, "pos": len(rules), "label": label, "kind": f.kind,
            "nullable": f.nullable, "enum": list(f.enum) or None, "pattern": f.pattern, "min_length": f.min_length,
            "minimum": decimal(f.minimum), "maximum": decimal(f.maximum), "lowest": decimal(low),
            "highest": decimal(high), "min_items": f.min_items, "required": [],
            "known": [i.name for i in inside] if closed else None,
            # Elements of an array are not told apart, so unknown members inside them are not named.
            "unknown": None if "[]" in label else f"{prefix}unknown: ",
        }
        rules.append(own)
        if f.items or f.item_kind:
            element = Field("", f.item_kind or "object")
            rule(element, path, None, f"{label}[]", f.items, bool(f.items), target)
        for i in inside:
            if i.required:
                own["required"].append((i.name, len(rules)))
            rule(i, path, i.name, f"{prefix}{i.name}", i.properties, bool(i.properties) and i.closed, _type_of(target, i.name))
        own["last"] = len(rules) - 1

    rule(Field("", "object"), None, None, "", contract.fields, True, T.StructType.fromDDL(contract.schema))
    return rules


def rule_table(spark: SparkSession, contract: Contract) -> DataFrame:
    """The contract as a table, one row per place: a local relation, whose bytes Spark knows."""
    schema = T.StructType.fromDDL(RULES)
    rules = [{**r, "required": [{"name": n, "pos": p} for n, p in r["required"]]} for r in contract_rules(contract)]
    return spark.createDataFrame(pa.Table.from_pylist(rules, to_arrow_schema(schema)), schema)


def _steps(rules: Sequence[dict], level: int) -> Column:
    """Number of the rule that a value of this level has, by the number of its container's rule and its own name."""
    up, name, found = F.col(f"place{level - 1}"), F.col(f"k{level}"), F.lit(None).cast("int")
    for r in reversed(rules):
        inside = [c for c in rules if c["parent"] == r["path"]]
        if not inside or _level(r) != level - 1:
            continue
        # An element of an array has no name. A map stays short in generated code, however many members it has.
        named = [F.lit(x) for c in inside if c["name"] is not None for x in (c["name"], c["pos"])]
        step = F.try_element_at(F.create_map(*named), name) if named else F.lit(None).cast("int")
        for c in inside:
            if c["name"] is None:
                step = F.when(name.isNull(), F.lit(c["pos"])).otherwise(step)
        found = F.when(up == r["pos"], step).otherwise(found)
    return F.when(F.col(f"p{level}").isNotNull(), found)


def _level(rule: dict) -> int:
    """How deep a place lies."""
    return rule["path"].count(".") + rule["path"].count("[]")


def _clean(rules: Sequence[dict], level: int) -> Column:
    """Whether the values of this level are objects of plain members that break no rule, told by their shape.

    The shapes of a rule are the types of its members, with optional ones absent and nullable ones null. A value of
    another shape may be good as well (``1.0`` for an integer); it is opened, and the rules decide.
    """
    place, value, clean = F.col(f"place{level}"), F.col(f"v{level}"), F.lit(False)
    for r in rules:
        inside = [c for c in rules if c["parent"] == r["path"]]
        plain = all(c["kind"] in PLAIN and (c["name"] or "").isidentifier() and c["name"].isascii() for c in inside)
        if r["kind"] != "object" or r["known"] is None or not inside or not plain or _level(r) != level:
            continue
        required = {name for name, _ in r["required"]}
        inside = sorted(inside, key=lambda c: c["name"])
        types = [
            [PLAIN[c["kind"]], *(["VOID"] if c["nullable"] else []), *([None] if c["name"] not in required else [])]
            for c in inside
        ]
        bounds = [c[b] for c in inside for b in ("minimum", "maximum", "lowest", "highest") if c[b] is not None]
        if math.prod(map(len, types)) > MOST_SHAPES or any(not BIGINT[0] <= b <= BIGINT[1] for b in bounds):
            continue
        shapes = [
            "OBJECT<" + ", ".join(f"{c['name']}: {t}" for c, t in zip(inside, chosen, strict=True) if t) + ">"
            for chosen in itertools.product(*types)
        ]
        # Spark may read members ahead of the test of the shape, and looking for one that is absent is slow: of other
        # values there is nothing to read.
        shaped = F.when((place == r["pos"]) & F.schema_of_variant(value).isin(shapes), value)
        good = shaped.isNotNull()
        for c in inside:
            text, number = (F.try_variant_get(shaped, f"$.{c['name']}", kind) for kind in ("string", "bigint"))
            # What a bigint holds needs no test.
            low = max((x for x in (c["minimum"], c["lowest"]) if x is not None and x > BIGINT[0]), default=None)
            high = min((x for x in (c["maximum"], c["highest"]) if x is not None and x < BIGINT[1]), default=None)
            tests = [
                text.isin(c["enum"]) if c["enum"] else None,
                F.regexp(text, F.lit(c["pattern"])) if c["pattern"] else None,
                F.length(text) >= c["min_length"] if c["min_length"] is not None else None,
                number >= F.lit(int(low)) if low is not None else None,
                number <= F.lit(int(high)) if high is not None else None,
            ]
            for test in tests:
                if test is not None:
                    good = good & F.coalesce(test, F.lit(True))
        clean = clean | good
    return clean


def record_nodes(texts: DataFrame, rules: Sequence[dict], *keys: str, column: str = "record") -> DataFrame:
    """keys, place, value, kind, names (of an object's members), items (of an array) of each value that has a rule.

    ``place`` is the number of the value's rule. Containers that have a rule are opened, other values stay closed,
    however large. Objects that are good by their shape are left out with all that lies inside them.

    Each level is a lateral explode of the level above. A value stands in the rows of all that lies inside it, and
    is taken from the first of them.
    """
    spark = texts.sparkSession
    containers = [r for r in rules if r["kind"] in ("object", "array")]
    depth = max(map(_level, containers)) + 1

    def left(rows: DataFrame, level: int) -> DataFrame:
        """Without the places of what is good."""
        return rows.withColumn(f"place{level}", F.when(~_clean(rules, level), F.col(f"place{level}")))

    rows = left(texts.select(*keys, F.try_parse_json(F.col(column)).alias("v0"), F.lit(0).alias("place0")), 0)
    for level in range(1, depth + 1):
        up = level - 1
        opened = F.when(F.col(f"place{up}").isin([r["pos"] for r in containers]), F.col(f"v{up}"))
        inside = spark.tvf.variant_explode_outer(F.col(f"open{up}").outer()).toDF(f"p{level}", f"k{level}", f"v{level}")
        rows = rows.withColumn(f"open{up}", opened).lateralJoin(inside).drop(f"open{up}")
        rows = left(rows.withColumn(f"place{level}", _steps(rules, level)), level)

    def node(level: int) -> Column:
        value, within = F.col(f"v{level}"), range(level + 1, depth + 1)
        first = F.col(f"place{level}").isNotNull()
        for i in within:
            first = first & (F.coalesce(f"p{i}", F.lit(0)) == 0)
        kind = F.schema_of_variant(value)
        if within:
            below = F.col(f"p{level + 1}").isNotNull()
            # A container that was opened and holds something need not be looked through once more.
            kind = F.when(~below, kind).when(F.col(f"k{level + 1}").isNull(), "ARRAY").otherwise("OBJECT")
        return F.when(first, F.struct(F.col(f"place{level}").alias("place"), value.alias("value"), kind.alias("kind")))

    nodes = rows.select(*keys, F.explode(F.array(*map(node, range(depth + 1)))).alias("_node"))
    # Only names and places are asked for, so what lies inside is not copied.
    named = F.map_keys(F.try_variant_get("value", "$", "map<string,struct<>>"))
    listed = F.size(F.try_variant_get("value", "$", "array<struct<>>"))
    return nodes.filter("_node IS NOT NULL").select(*keys, "_node.*").withColumns({
        "names": F.when(F.col("kind").startswith("OBJECT"), named),
        "items": F.when(F.col("kind").startswith("ARRAY"), listed),
    })


def _number() -> Column:
    """Number of an integer."""
    kind, real = F.col("kind"), F.try_variant_get("value", "$", "double")
    # What no decimal holds is beyond every range.
    number = F.coalesce(F.try_variant_get("value", "$", NUMBER), (F.signum(real) * F.lit(1e37)).cast(NUMBER))
    fraction = kind.startswith("DECIMAL") | kind.startswith("DOUBLE") | kind.startswith("FLOAT")
    return F.when(kind == "BIGINT", number).when(fraction, F.when(real % 1 == 0, number))


def _asked_text() -> Column:
    """Text of a value where a rule asks for it."""
    asked = F.coalesce(F.col("enum").isNotNull() | F.col("pattern").isNotNull() | F.col("min_length").isNotNull(), F.lit(False))
    return F.when(asked, F.try_variant_get("value", "$", "string"))


def _broken() -> Column:
    """Whether a value breaks the rule of its place, in few words.

    Spark takes this test into the join's generated code. The JVM compiles no method above 8,000 bytes, and lambdas
    are interpreted, so it holds neither messages nor lambdas; ``_violations`` says what is broken.
    """
    kind, wanted, text, number = F.col("kind"), F.col("_kind"), _asked_text(), F.col("number")
    fits = F.when(wanted == "integer", number.isNotNull()).otherwise(kind.startswith(F.upper(wanted)))
    wrong = ~F.coalesce(fits, F.lit(False)) & ~(F.col("nullable") & F.coalesce(kind == "VOID", F.lit(False)))
    lacking = F.size(F.array_except(F.col("required")["name"], F.col("names")))
    return (
        wrong
        | ~F.array_contains("enum", text)
        | ~F.regexp(text, F.col("pattern"))
        | (F.length(text) < F.col("min_length"))
        | (number < F.col("_least"))
        | (number > F.col("_most"))
        | (F.col("items") < F.col("min_items"))
        | (F.size(F.array_except("names", "known")) > 0)
        | (lacking > 0)
    )


def _violations() -> Column:
    """What a value breaks, by the way in which it does: ``_at`` has the places of the ways.

    An entry is NULL where nothing is broken.
    """
    label, kind, wanted = F.col("label"), F.col("kind"), F.col("_kind")
    text, number = _asked_text(), F.col("number")
    whole = number.isNotNull()
    fits = (
        F.when(wanted == "array", kind.startswith("ARRAY"))
        .when(wanted == "object", kind.startswith("OBJECT"))
        .when(wanted == "integer", whole)
        .when(wanted == "boolean", kind == "BOOLEAN")
        .otherwise(kind == "STRING")
    )
    wrong = ~F.coalesce(fits, F.lit(False)) & ~(F.col("nullable") & F.coalesce(kind == "VOID", F.lit(False)))
    extra = F.array_except("names", "known")
    said = lambda suffix: F.concat(label, F.lit(suffix))
    steps = [
        F.when(wrong, F.when(label == "", "not a JSON object").otherwise(said(": type"))),
        F.when(~F.array_contains("enum", text), said(": not allowed")),
        F.when(~F.regexp(text, F.col("pattern")), said(": pattern")),
        F.when(F.length(text) < F.col("min_length"), said(": too short")),
        F.when(number < F.col("minimum"), F.concat(said(": below "), F.col("minimum").cast("string"))),
        F.when(number > F.col("maximum"), F.concat(said(": above "), F.col("maximum").cast("string"))),
        F.when((number < F.col("lowest")) | (number > F.col("highest")), said(": outside its type")),
        F.when(F.col("items") < F.col("min_items"), said(": too few items")),
    ]
    # Behind all that lies inside the object; of objects that end together the inner one first.
    unknown = F.coalesce(F.concat("unknown", F.array_join(F.sort_array(extra), ",")), said(": unknown"))
    steps.append(F.when(F.size(extra) > 0, unknown))
    prefix = F.when(label == "", "").otherwise(F.concat(label, F.lit(".")))
    missing = F.transform("required", lambda r: F.when(
        ~F.array_contains("names", r["name"]), F.concat(prefix, r["name"], F.lit(": missing"))
    ))
    return F.concat(F.array(*steps), F.coalesce(missing, F.array().cast("array<string>")))


def _at(way: Column) -> Column:
    """Place of an entry of ``_violations``, packed."""
    pos, zero = F.col("pos"), F.lit(0)
    lacking = F.element_at("required", F.greatest(way - (WAYS - 1), F.lit(1)))["pos"]
    place = lambda pos, step, inner: F.struct(pos.alias("pos"), step.alias("step"), inner.alias("inner"))
    return _packed(
        F.when(way < WAYS - 1, place(pos, way + 1, zero))
        .when(way == WAYS - 1, place(F.col("last"), F.lit(WAYS), -pos))
        .otherwise(place(lacking, zero, zero))
    )


def spread(texts: DataFrame) -> DataFrame:
    """The same rows in as many tasks as there are cores, if they come from fewer files.

    Opening a record costs far more than moving its text, and a file of one array is read by one task. Rows of many
    files stay where they are.
    """
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.repartition(cores) if 0 < len(texts.inputFiles()) < cores else texts


def broken_rules(texts: DataFrame, contract: Contract, *keys: str, column: str = "record") -> DataFrame:
    """keys, violation, place: the distinct violations of the records under a key; ``place`` orders them.

    A text that is NULL or cannot be read is no JSON object. Rows of one key count as one record's.
    """
    rules = rule_table(texts.sparkSession, contract).withColumnRenamed("kind", "_kind").withColumns({"_least": F.greatest("minimum", "lowest"), "_most": F.least("maximum", "highest")})
    # Whatever the keys are called, they stay apart from the working columns.
    named = texts.select(F.struct(*(F.col(f"`{k}`") for k in keys)).alias("_keys"), F.col(f"`{column}`").alias("_text"))
    nodes = record_nodes(spread(named), contract_rules(contract), "_keys", column="_text").withColumn("number", _number())
    # Few values break their rule, and only they reach the list of ways.
    found = nodes.join(rules, F.col("place") == F.col("pos")).filter(_broken()).select(
        "_keys", "pos", "last", "required", F.posexplode(_violations()).alias("_way", "violation")
    )
    return (
        found.filter("violation IS NOT NULL")
        .select("_keys", "violation", _at(F.col("_way")).alias("_at"))
        .groupBy("_keys", "violation")
        .agg(F.min("_at").alias("_at"))
        .select("_keys.*", "violation", _unpacked(F.col("_at")).alias("place"))
    )


def _packed(place: Column) -> Column:
    """A place as one number of the same order, whose least is kept in a hash table; of structs it would need a sort."""
    at = {name: place[name].cast("bigint") for name in ("pos", "step", "inner")}
    return F.shiftleft(at["pos"], 36) + F.shiftleft(at["step"], 28) + (F.lit(2**28 - 1) + at["inner"])


def _unpacked(at: Column) -> Column:
    rest = at.bitwiseAND(F.lit(2**28 - 1))
    return F.struct(
        F.shiftright(at, 36).cast("int").alias("pos"),
        F.shiftright(at, 28).bitwiseAND(F.lit(255)).cast("int").alias("step"),
        (rest - F.lit(2**28 - 1)).cast("int").alias("inner"),
    )


def possible_places(contract: Contract) -> list[tuple[int, int, int]]:
    """Every ``place`` that a violation of the contract can have, in order; as many as it has demands."""
    places = []
    for r in contract_rules(contract):
        asked = [True, r["enum"], r["pattern"], r["min_length"], r["minimum"], r["maximum"], r["lowest"], r["min_items"]]
        places += [(r["pos"], step, 0) for step, wanted in enumerate(asked, 1) if wanted is not None]
        places += [(pos, 0, 0) for _, pos in r["required"]]
        if r["known"] is not None:
            places.append((r["last"], len(asked) + 1, -r["pos"]))
    return sorted(places)


def validate_records(df: DataFrame, contract: Contract, column: str = "record") -> DataFrame:
    """Add ``parsed`` (typed struct) and ``violations`` (empty for a good record).

    A field of another type than its contract's is NULL in ``parsed``. What a text breaks depends on the text alone, so
    violations are found by the text's digest and joined to all rows that hold it.
    """
    shape = T.StructType.fromDDL(contract.schema)
    digest = F.coalesce(F.md5(F.col(column).cast("binary")), F.lit(""))
    texts = df.select(digest.alias("_digest"), F.col(column).alias("_text"))
    # One value per place a violation can have, so nothing is collected and the order is given.
    at = lambda place: F.col("place") == F.struct(*map(F.lit, place))
    listed = [F.max(F.when(at(place), F.col("violation"))) for place in possible_places(contract)]
    broken = (
        broken_rules(texts, contract, "_digest", column="_text")
        .groupBy(F.col("_digest").alias("_of"))
        .agg(F.array_compact(F.array(*listed)).alias("_violations"))
    )
    typed = df.withColumns({"_variant": F.try_parse_json(F.col(column)), "_digest": digest}).withColumn(
        "parsed",
        F.struct(
            *(
                F.try_variant_get(F.col("_variant"), f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
                for f in shape.fields
            )
        ),
    )
    none = F.array().cast("array<string>")
    return typed.join(own_exchange(broken), F.col("_digest") == F.col("_of"), "left").select(
        *(f"`{c}`" for c in df.columns), "parsed", F.coalesce("_violations", none).alias("violations")
    )


def violation_rows(checked: DataFrame, *keys: str) -> DataFrame:
    """One row per violation of a record."""
    return checked.select(*keys, F.explode_outer("violations").alias("violation")).filter(
        "violation IS NOT NULL"
    )


def split_records(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = F.size("violations") == 0
    return checked.filter(good).drop("violations"), checked.filter(~good)


# The five contracts. Field names, enums, patterns and ranges are fixed values.
UUID = "^[0-9a-fA-F-]{36}$"



def context_contract(host_field: str = "workspace_host") -> Contract:
    """The run context; the field that holds the workspace URL is named by the caller."""
    return Contract("context", schemas.context_record(host_field), (
        Field("run_id", required=True, pattern=UUID),
        Field("source_type", enum=("sqlserver", "mysql")),
        Field("foreign_catalog", required=True, min_length=1),
        Field("uc_catalog", required=True, min_length=1),
        Field("source_database"),
        Field("legacy_proc_schema"),
        Field("scoped_tables", "array", item_kind="string"),
        Field(host_field, required=True),
        Field("max_retries", "integer", required=True, minimum=0, maximum=5),
        Field("attempt", "integer", minimum=0),
        Field("demo_mode", "boolean"),
        Field("routines_skipped_reason", nullable=True),
    ))


def convert_contract(pattern: str = TARGET_PATTERN) -> Contract:
    """A conversion result; where target paths may lie is the caller's choice, as for the backlog."""
    return Contract("convert_result", schemas.CONVERT_RESULT, (
        Field("item_id", required=True, min_length=1),
        Field("legacy_proc", required=True, min_length=1),
        Field("target_path", required=True, pattern=pattern),
        Field("status", required=True, enum=("draft", "review", "final", "blocked")),
        Field("notes", required=True),
        Field("patterns_used", "array", required=True, item_kind="string"),
    ))


CONVERT_RESULT = convert_contract()
BACKLOG_ITEM = Contract(
    "migration_backlog",
    schemas.BACKLOG_RECORD,
    (
        Field("item_id", required=True),
        Field("legacy_proc", required=True),
        Field("classification", required=True, enum=("get", "migrate", "other")),
        Field("reads", required=True),
        Field("writes", required=True),
        Field("target_layer", required=True, enum=("silver", "gold", "n/a")),
        Field("target_path", required=True),
        Field("priority", required=True, enum=("high", "medium", "low")),
        Field("risk_flags", required=True),
        Field(
            "status",
            required=True,
            enum=("pending", "in_progress", "converted", "tested", "done", "blocked"),
        ),
    ),
)
RECONCILE_REPORT = Contract(
    "reconcile_report",
    schemas.RECONCILE_REPORT,
    (
        Field("run_id", required=True),
        Field(
            "checks",
            "array",
            required=True,
            min_items=1,
            items=(
                Field("check_id", required=True),
                Field("table", required=True),
                Field("expected", required=True),
                Field("actual", required=True),
                Field("delta", required=True),
                Field("result", required=True, enum=("pass", "fail")),
            ),
        ),
        Field(
            "summary",
            "object",
            required=True,
            properties=(
                Field("passed", "integer", required=True, minimum=0),
                Field("failed", "integer", required=True, minimum=0),
                Field("total", "integer", required=True, minimum=1),
            ),
        ),
    ),
)
MANIFEST = Contract(
    "migration_manifest",
    schemas.MANIFEST_RECORD,
    (
        Field("run_id", required=True, pattern=UUID),
        Field("gate", required=True, enum=("pass", "fail")),
        Field(
            "blockers",
            "array",
            required=True,
            items=(
                Field("id", required=True),
                Field("message", required=True),
                Field("backlog_item_id"),
            ),
        ),
        Field(
            "converted_artifacts",
            "array",
            required=True,
            items=(
                Field("legacy_proc", required=True),
                Field("target_path", required=True),
                Field("status", required=True, enum=("draft", "review", "final")),
            ),
        ),
        Field("attempt", "integer", required=True, minimum=0),
        Field(
            "summary",
            "object",
            closed=False,
            properties=tuple(
                Field(name, "integer")
                for name in (
                    "backlog_total",
                    "backlog_converted",
                    "tables_total",
                    "tables_landed",
                    "procs_total",
                    "procs_converted",
                    "reconcile_passed",
                    "reconcile_failed",
                    "agent_events_recorded",
                )
            ),
        ),
    ),
)
CONTRACTS = {
    c.name: c for c in (context_contract(), CONVERT_RESULT, BACKLOG_ITEM, RECONCILE_REPORT, MANIFEST)
}
