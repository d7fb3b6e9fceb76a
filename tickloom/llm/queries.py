"""One registered query per operator, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    discriminant,
    filter_audit,
    fm_index,
    hmm,
    jaccard,
    kneser_ney,
    merkle,
    outliers,
    packing,
    pii,
    splitters,
    token_files,
    weak_labels,
)
from .common import shared_folder, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op2_token_files(spark, sf_dir):
    path = shared_folder(spark)
    docs = _table(spark, sf_dir, "documents")
    token_files.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.read_tokens(spark, path)


def op3_decontamination(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fm_index.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contamination.*").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_toxicity(spark, sf_dir):
    return weak_labels.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_near_duplicates(spark, sf_dir):
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return outliers.quality_rules(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark, sf_dir):
    return discriminant.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_personal_data(spark, sf_dir):
    return pii.find_personal_data(_table(spark, sf_dir, "documents")).drop("found")


def op9_language_model(spark, sf_dir):
    return hmm.language_model_scores(_table(spark, sf_dir, "documents"))


def op10_sharding(spark, sf_dir):
    return splitters.shards(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_language_id(spark, sf_dir):
    return kneser_ney.languages(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest_digests(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_token_files,
        op3_decontamination,
        op4_toxicity,
        op5_near_duplicates,
        op6_quality_rules,
        op7_quality_classifier,
        op8_personal_data,
        op9_language_model,
        op10_sharding,
        op11_filter_audit,
        op12_language_id,
        op13_merkle_manifest,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TOKENS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

# Where SQL can say the same; the others are tested against plain versions in tests/llm.
SQL = {
    "op11_filter_audit": filter_audit.AUDIT_SQL,
    "op13_merkle_manifest": merkle.MANIFEST_SQL,
    "op3_decontamination": f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item, list_slice(w, i, i + least(13, len(w)) - 1) AS phrase
  FROM items, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i) WHERE len(w) > 0
), docs AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), lengths AS (
  SELECT DISTINCT len(phrase) AS n FROM windows
), places AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS phrase
  FROM docs, lengths, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n
), found AS (
  SELECT doc_id, i, n, item FROM places JOIN windows USING (phrase)
), hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM found, unnest(range(i, i + n)) AS t(k) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op5_near_duplicates": f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {_TOKENS} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + least(5, len(w)) - 1) AS shingle
  FROM docs, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)""",
}
