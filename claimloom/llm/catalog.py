"""The registered queries of the text operators and their SQL twins.

Each query runs its operator over the whole table and derives digest columns from the operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    exact,
    fingerprint,
    html,
    langid,
    license,
    lm,
    mixing,
    packing,
    quality,
    simhash,
    trie,
    warc,
    whitening,
)
from claimloom.llm.common import text_or_empty

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_in_buckets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "bucket",
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents"), hash_all=True).withColumnRenamed(
        "full_hash", "text_sha256"
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint.as_string(F.col("fingerprint")).alias("fingerprint"),
        fingerprint.as_string(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(table(spark, sf_dir, "documents")).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", F.size("span_langs").alias("n_spans")
    )


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark is the target, so a low score tells of text like its items: to be looked at for leaks, not to be chosen."""
    return lm.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents")).withColumns(
        {"base_labels": F.array_join("base_labels", ","), "labels": F.array_join("labels", ",")}
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length(text_or_empty("text")).cast("long")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return warc.round_trip(pages).select(
        F.col("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "fault",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over the documents; the last one's sequences with digests of their ids."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_mixing,
        op3_quality,
        op4_exact_dedup,
        op5_fingerprints,
        op6_language,
        op7_lm_scores,
        op8_simhash,
        op9_licenses,
        op10_main_text,
        op11_whitening,
        op12_prefix_trie,
        op13_warc,
        pipeline,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _mixing_sql() -> str:
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHT_CYCLE))
    most = mixing.MAX_EPOCHS
    return f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE (rank - 1) % {len(mixing.WEIGHT_CYCLE)} {weights} END AS weight,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         {most} * CAST(source_size AS DOUBLE) AS most
  FROM sources
), stops AS (
  SELECT *, most <= (total - coalesce(sum(most) OVER (ORDER BY source_size * {most} / weight, rank
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (ORDER BY source_size * {most} / weight, rank
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * weight AS stopped
  FROM weighted
), shared AS (
  SELECT *, sum(CASE WHEN stopped THEN most ELSE 0.0 END) OVER () AS stopped_size,
         sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER () AS free_weight
  FROM stops
), targets AS (
  SELECT source, source_size,
         CASE WHEN stopped THEN most ELSE weight * ((total - stopped_size) / free_weight) END AS target
  FROM shared
), placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS words,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source,
       CASE WHEN source_size = 0 THEN 0
            ELSE size * (words // source_size) + greatest(0, least(start + size, words % source_size) - start)
       END AS taken
FROM placed
"""


def _licenses_sql() -> str:
    places, labels = [], []
    for phrase, label in license.PHRASES.items():
        words = phrase.split()
        test = " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(words, 1))
        places.append(f"CASE WHEN {test} THEN '{label}' END")
        labels.append(label)
    notices = ",\n    ".join(
        f"('{label}', {_quoted(license.plain_words(notice))})"
        for label, group in license.NOTICES.items()
        for notice in group
    )
    separators = license._BETWEEN_WORDS
    first = " , ".join(places)
    return f"""
WITH normal AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array({_LOWER}, '{separators}'), lambda w: w <> '') AS words
  FROM documents
), spots AS (
  SELECT row, i, coalesce({first}) AS label
  FROM (SELECT row, words, unnest(range(len(words))) AS i FROM normal)
), base AS (
  SELECT row, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS labels
  FROM spots WHERE label IS NOT NULL GROUP BY row
), blocks AS (
  SELECT row, unnest(string_split(text, chr(10))) AS block FROM normal
  UNION ALL
  SELECT row, block FROM (SELECT row, unnest(regexp_split_to_array(text, '\\n[\\x20\\t\\r]*\\n')) AS block FROM normal)
  WHERE contains(block, chr(10))
), sets AS (
  SELECT row, list_distinct(list_filter(regexp_split_to_array(
    translate(block, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{separators}'), lambda w: w <> '')) AS words
  FROM blocks
), notices(label, words) AS (VALUES
    {notices}
), matches AS (
  SELECT s.row, n.label, len(list_intersect(s.words, n.words)) / len(n.words) AS containment
  FROM sets s, notices n
  WHERE len(s.words) >= 4 AND len(list_intersect(s.words, n.words)) >= ceil({license.THRESHOLD} * len(n.words) - 1e-9)
), found AS (
  SELECT row, list(DISTINCT label) AS labels, max(containment) AS containment FROM matches GROUP BY row
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(b.n_base, 0) AS BIGINT) AS n_base,
       b.first_word, b.last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
       CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(f.containment, 0)::DOUBLE END AS score
FROM normal d LEFT JOIN base b USING (row) LEFT JOIN found f USING (row)
"""


ORACLE: dict[str, str] = {
    "op2_mixing": _mixing_sql(),
    "op4_exact_dedup": f"""
WITH hashed AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, text_sha256,
       doc_id IS NOT DISTINCT FROM keep_id
       AND row_number() OVER (PARTITION BY text_sha256, doc_id) = 1 AS kept
FROM hashed JOIN groups USING (text_sha256)
""",
    "op9_licenses": _licenses_sql(),
}
