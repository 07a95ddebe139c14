"""The registered queries of the training-data operators and their SQL, where SQL can say them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import (
    counts,
    idfiles,
    language,
    manifest,
    mixing,
    pieces,
    quality,
    runs,
    shards,
    simhash,
    topk,
    toxicity,
    urls,
)
from tidemark.llm.frames import WORD, arrow_column
from tidemark.llm.oracle import SHARDING_SQL, manifest_sql


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_languages(table(spark, folder, "documents"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    hexed = F.lower(F.lpad(F.hex("p"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_documents(table(spark, folder, "documents"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(table(spark, folder, "pages"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder, "documents"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "distance")


def op8_id_files(spark: SparkSession, folder: str) -> DataFrame:
    return idfiles.id_files(table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.count_tokens(table(spark, folder, "documents"))


def id_hash(doc_id: str = "doc_id") -> Column:
    """Unsigned CRC-32 of the decimal id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def with_planted_period(text: Column, h: Column) -> Column:
    """The text; where ten divides ``h``, its words repeat with a period from some word on."""

    def planted(text: str | None, h: int | None) -> str | None:
        words = (text or "").encode().split()
        if h is None or h % 10 or not words:
            return text
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        unit = words[a : a + p]
        return b" ".join(words[:a] + (unit * ((n - a) // p + 1))[: n - a]).decode()

    def batch(texts: list[str | None], hashes: list[int | None]) -> pa.Array:
        return pa.array(map(planted, texts, hashes), pa.string())

    return arrow_column(batch, "string", text, h)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    text = with_planted_period(F.col("text"), id_hash())
    found = docs.select("doc_id", runs.periodic_runs(text).alias("found")).select("doc_id", "found.*")
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] - best["length"] * run["period"]
        # The runs come by start and period, so the first of equals stays.
        return F.when(best.isNull() | (more > 0), run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, better)
    digests = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    milli = F.expr("1000 * best.length div best.period")
    return digests.select(
        "doc_id", "n_runs", "best.*", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    dealt = shards.shard_documents(table(spark, folder, "documents"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    changed = F.when(id_hash() % 2 == 0, manifest.leaf_of(text=F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    listed = manifest.manifest(docs, changed=changed)
    folded = manifest.fold(F.coalesce("changed", "leaf"), F.col("path"))
    return listed.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(manifest.proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_toxicity": op2_toxicity,
    "op3_language": op3_language,
    "op4_simhash": op4_simhash,
    "op5_pieces": op5_pieces,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_id_files": op8_id_files,
    "op9_mixing": op9_mixing,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sharding": op12_sharding,
    "op13_manifest": op13_manifest,
}

TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def url_sql() -> str:
    compiled = [urls.compile_rule(p) for p in urls.PATTERN_RULES]
    any_of = lambda kind: " OR ".join(
        f"regexp_matches(url, {quoted(regex)})" for verdict, regex, _ in compiled if verdict == kind
    )
    cases = "".join(
        f"    WHEN (host = {quoted(host)} OR ends_with(host, {quoted('.' + host)}))"
        f" AND starts_with(path, {quoted(path)}) THEN {quoted(host + path + ' ' + verdict)}\n"
        for verdict, host, path in sorted(urls.HOST_RULES, key=lambda r: -len(r[1] + r[2]))
    )
    return f"""
WITH cut AS (
  SELECT page_id, translate(url, '{urls.UPPER}', '{urls.LOWER}') AS url,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), ruled AS (
  SELECT page_id, url, host, path, CASE
{cases}    END AS found
  FROM parts
)
SELECT page_id, host, path, split_part(found, ' ', 1) AS rule,
       CASE WHEN found IS NOT NULL THEN split_part(found, ' ', 2)
            WHEN ({any_of("block")}) AND NOT ({any_of("allow")}) THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
"""


MIXING_SQL = f"""
WITH counted AS (
  SELECT doc_id, source, md5(concat_ws('|', CAST(doc_id AS VARCHAR), text)) AS digest,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '{WORD}')) END AS size,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '{mixing.SYMBOLS}')) END AS symbols
  FROM documents
), keyed AS (
  SELECT doc_id, source, CAST(size AS BIGINT) AS size,
         -ln((CAST(CAST('0x' || substr(digest, 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
           * (size + symbols) / greatest(size, 1) AS key
  FROM counted
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, CAST((list_value(3, 1, 2))[
           1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS w
  FROM keyed GROUP BY source
), stepped AS (
  SELECT *, 1.5 * sum(s) OVER () AS wanted,
         coalesce(sum(2 * s) OVER (ORDER BY 2.0 * s / w, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done,
         sum(w) OVER (ORDER BY 2.0 * s / w, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM sources
), level AS (
  SELECT arg_min((wanted - done) / rest, 2.0 * s / w) FILTER (WHERE (wanted - done) / rest <= 2.0 * s / w) AS level
  FROM stepped
), aimed AS (
  SELECT source, s, CASE WHEN w * level > 2 * s THEN CAST(2 * s AS DOUBLE) ELSE w * level END AS target
  FROM sources, level
), epoched AS (
  SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS epochs FROM aimed
), walked AS (
  SELECT k.doc_id, k.size, e.s, e.target, e.epochs,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size
           ROWS UNBOUNDED PRECEDING) - k.size AS before
  FROM keyed k JOIN epoched e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, s AS source_size, target,
       CAST(size * (epochs + CASE WHEN 2 * before + size <= 2 * (target - epochs * s) THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM walked
"""

ORACLE = {
    "op1_top_k": TOP_K_SQL,
    "op6_url_filter": url_sql(),
    "op9_mixing": MIXING_SQL,
    "op12_sharding": SHARDING_SQL,
    "op13_manifest": manifest_sql(),
}
