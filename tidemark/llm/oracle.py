"""SQL of the operators whose statements are made up of parts."""

from __future__ import annotations

# CRC-32 table (reversed polynomial) from its rule, as a list with the entry of byte b at b + 1.
CRC_TABLE = (
    "(SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce(range(8), lambda c, x: "
    "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) AS bytes(i)))"
)


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, beside a table with a column ``crc``."""
    values = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    reduced = f"list_reduce({values}, lambda c, x: xor(c >> 8, crc[1 + (xor(c, x) & 255)]), 4294967295)"
    return f"xor({reduced}, 4294967295)"


SHARDING_SQL = f"""
WITH RECURSIVE crcs AS MATERIALIZED {CRC_TABLE}, texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), sized AS MATERIALIZED (
  SELECT doc_id, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS size, {crc32_sql("text")} AS text_crc32,
         md5(text) AS digest FROM texts, crcs
), grouped AS MATERIALIZED (
  SELECT digest, weight, row_number() OVER (ORDER BY weight DESC, digest) - 1 AS k,
         row_number() OVER (PARTITION BY weight ORDER BY digest) AS place
  FROM (SELECT digest, CAST(sum(size) AS BIGINT) AS weight FROM sized GROUP BY digest)
), dealt(k, loads, weight, shard) AS (
  SELECT CAST(0 AS BIGINT), list_transform(range(16), lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT), -1
  UNION ALL
  SELECT d.k + 1, list_transform(range(1, 17), lambda j: d.loads[j] + CASE WHEN j = least_loaded THEN g.weight ELSE 0 END),
         g.weight, CAST(least_loaded AS INTEGER) - 1
  FROM (SELECT *, list_position(loads, list_min(loads)) AS least_loaded FROM dealt) AS d JOIN grouped AS g ON g.k = d.k
), homes AS (
  SELECT weight, shard, row_number() OVER (PARTITION BY weight ORDER BY shard) AS place FROM dealt WHERE shard >= 0
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, digest) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sized JOIN grouped USING (digest) JOIN homes USING (weight, place)
"""


def manifest_sql(levels: int = 12, source_levels: int = 6, fan: int = 3) -> str:
    """Trees of up to ``fan ** levels`` rows a source and ``fan ** source_levels`` sources.

    ``s<l>`` are the nodes of a source's level l, ``t<l>`` those of the tree over sources: (tree, i, n nodes, h).
    A tree of one node repeats it on the levels above.
    """

    def field(name: str) -> str:
        return f"coalesce(octet_length(encode(CAST({name} AS VARCHAR))) || ':' || CAST({name} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    def climb(name: str, count: int) -> list[str]:
        return [
            f"{name}{k + 1} AS MATERIALIZED (SELECT tree, i // {fan} AS i, (n + {fan - 1}) // {fan} AS n, "
            f"CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h "
            f"FROM {name}{k} GROUP BY tree, i // {fan}, n)"
            for k in range(count)
        ]

    def siblings(name: str, count: int) -> list[str]:
        run = "PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN"
        aside = lambda frame: f"CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER ({run} {frame}), '') END"
        return [
            f"{name}x{k} AS MATERIALIZED (SELECT tree, i, n, {aside('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l, "
            f"{aside('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r FROM {name}{k})"
            for k in range(count)
        ]

    steps = [("s", k, "p.tree", "p.i") for k in range(levels)] + [("t", k, "0", "p.t") for k in range(source_levels)]
    folds, before = [], "start"
    for name, k, tree, i in steps:
        after = f"f_{name}{k}"
        folds.append(
            f"{after} AS MATERIALIZED (SELECT p.* REPLACE (p.proof || x.l || x.r AS proof, "
            f"CASE WHEN x.n = 1 THEN p.node ELSE sha256(x.l || p.node || x.r) END AS node) "
            f"FROM {before} AS p JOIN {name}x{k} AS x ON x.tree IS NOT DISTINCT FROM {tree} AND x.i = {i} // {fan**k})"
        )
        before = after
    parts = [
        f"crcs AS MATERIALIZED {CRC_TABLE}",
        f"leaves AS MATERIALIZED (SELECT doc_id, source AS tree, {leaf('text')} AS leaf, "
        f"CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS changed "
        f"FROM documents, crcs)",
        "numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
        "count(*) OVER (PARTITION BY tree) AS n FROM leaves)",
        "s0 AS MATERIALIZED (SELECT tree, i, n, leaf AS h FROM numbered)",
        *climb("s", levels),
        f"roots AS MATERIALIZED (SELECT tree AS source, h, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS t, "
        f"count(*) OVER () AS n FROM s{levels})",
        "t0 AS MATERIALIZED (SELECT 0 AS tree, t AS i, n, h FROM roots)",
        *climb("t", source_levels),
        *siblings("s", levels),
        *siblings("t", source_levels),
        "start AS MATERIALIZED (SELECT d.*, roots.h AS subroot, roots.t AS t, coalesce(d.changed, d.leaf) AS node, '' AS proof "
        "FROM numbered AS d JOIN roots ON roots.source IS NOT DISTINCT FROM d.tree)",
        *folds,
    ]
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, g.h AS root, sha256(proof) AS proof_sha256, "
        f"node AS folded_root, node = g.h AS verified FROM {before}, t{source_levels} AS g"
    )
