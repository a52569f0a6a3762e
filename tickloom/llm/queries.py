"""One query per operator, over the whole of its table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    conversations, html_text, licences, mixing, packing, periodic_runs, pieces, quality, simhash,
    token_counts, token_files, toxicity, weighted_sampling,
)
from tickloom.llm.common import importable, table
from tickloom.session import checkpointed, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where there is one."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(importable(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return build

    return register


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_weighted_sampling")
def op2_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return weighted_sampling.fingerprinted(table(spark, sf_dir, "documents"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies, with a checksum of its ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@query("op4_html_text")
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "distance"
    )


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's ids, as read back from the files."""
    path = scratch_path(spark, "tokens")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer, path)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, trained on two of three folds."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    score = toxicity.scores(F.col("text"), model)
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int")
    )


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.counted(table(spark, sf_dir, "documents"), path)


def _licence_sql() -> str:
    """The scan in DuckDB's SQL, from the same tables of phrases and rules."""
    cases = " ".join(
        f"WHEN contains(s, '{phrase}') THEN '{name};'" for name, phrase in licences.SENTENCES
    )
    left = "ids"
    for name, sequence in licences.RULES:
        left = f"regexp_replace({left}, '{licences.rule_pattern(sequence)}', '<{name}>;', 'g')"
    telltale, speaks = f"(?i){licences.TELLTALE}", licences.SPEAKS
    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, text FROM documents
    ), cut AS (
      SELECT r, unnest(list_filter(string_split(
               regexp_replace(translate(text, chr(1), ' '), '{licences.ENDS}', '\\1' || chr(1), 'g'), chr(1)),
               lambda x: regexp_matches(x, '{telltale}'))) AS s,
             generate_subscripts(list_filter(string_split(
               regexp_replace(translate(text, chr(1), ' '), '{licences.ENDS}', '\\1' || chr(1), 'g'), chr(1)),
               lambda x: regexp_matches(x, '{telltale}')), 1) AS i
      FROM d WHERE regexp_matches(text, '{telltale}')
    ), normal AS (
      SELECT r, i, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS s FROM cut
    ), named AS (
      SELECT r, i, CASE {cases} WHEN regexp_matches(s, '{speaks}') THEN 'other;' ELSE '' END AS id
      FROM normal
    ), joined AS (
      SELECT d.r, doc_id, coalesce(string_agg(id, '' ORDER BY i), '') AS ids
      FROM d LEFT JOIN named USING (r) GROUP BY d.r, doc_id
    ), ruled AS (
      SELECT doc_id, ids, {left} AS rest FROM joined
    )
    SELECT doc_id,
           coalesce((SELECT string_agg(l, ',' ORDER BY p) FROM (
             SELECT l, min(p) AS p FROM (
               SELECT unnest(regexp_extract_all(rest, '<([^>]+)>', 1)) AS l,
                      generate_subscripts(regexp_extract_all(rest, '<([^>]+)>', 1), 1) AS p)
             GROUP BY l)), '') AS licences,
           CAST(length(ids) - length(replace(ids, ';', '')) AS BIGINT)
             - CAST(len(regexp_extract_all(ids, 'other;')) AS BIGINT) AS n_known,
           CAST(len(regexp_extract_all(ids, 'other;')) AS BIGINT) AS n_unknown,
           CAST(len(list_filter(string_split(rest, ';'),
             lambda x: x <> '' AND x <> 'other' AND x[1] <> '<')) AS BIGINT) AS n_loose
    FROM ruled
    """


@query("op9_licence_scan", _licence_sql())
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    return licences.scanned(table(spark, sf_dir, "documents"))


@query(
    "op10_weighted_mix",
    r"""
    WITH d AS (
      SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
             CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
      FROM documents
    ), per AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
    ), weighed AS (
      SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM per
    ), levels AS (
      SELECT *, row_number() OVER o AS nth,
        (CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS BIGINT)
         - 2 * CAST(coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
        / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
      FROM weighed
      WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST)
    ), chosen AS (
      SELECT level FROM levels WHERE level * weight <= 2 * source_size ORDER BY nth LIMIT 1
    ), t AS (
      SELECT source, source_size,
             least(chosen.level * weight, CAST(2 * source_size AS DOUBLE)) AS target
      FROM levels, chosen
    ), ahead AS (
      SELECT d.*, CAST(coalesce(sum(size) OVER (
               PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM d
    )
    SELECT a.doc_id, a.size, t.source_size, t.target,
           CAST(greatest(least(CAST(floor(target) AS BIGINT) - before, size), 0)
              + greatest(least(CAST(floor(target) AS BIGINT) - before - t.source_size, size), 0)
              AS BIGINT) AS taken
    FROM ahead a JOIN t ON a.source IS NOT DISTINCT FROM t.source
    """,
)
def op10_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target and words taken of every document."""
    return mixing.taken(table(spark, sf_dir, "documents"))


@query("op11_piece_ids")
def op11_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encoded(table(spark, sf_dir, "documents"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees",
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, without sentence ends, repeated or of another role."""

    def spaced(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    place = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")
    kind = F.crc32(place) % 20
    text = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate(spaced("text"), ".!?", ""))
        .otherwise(spaced("text"))
    )
    return rows.where(kind != 0).select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of every conversation after damage."""
    original = table(spark, sf_dir, "conversations")
    rows = damaged(original)
    found = checkpointed(conversations.judged(rows))
    digests = conversations.joined_digests(rows, found)
    ids = original.select("conv_id").distinct()
    for other in (found, digests):
        other = other.withColumnRenamed("conv_id", "__conv")
        ids = ids.join(other, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").drop("__conv")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.select(
        "conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document, the rest of every tenth one repeating from some word on."""
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document and what is left without their repetitions, as digests."""

    def line(run):
        return F.format_string("%d,%d,%d\n", run["start"], run["length"], run["period"])

    return periodic_runs.with_runs(table(spark, sf_dir, "documents"), planted).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col("longest")[c].alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("longest.length") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
