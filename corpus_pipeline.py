"""Documents to packed training sequences, stage by stage, each by an operator of `tickloom.llm`."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import discriminant, fm_index, jaccard, packing, pii
from tickloom.llm.common import fresh, held_out, one_label, saved, ship


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    It learns from the labels of documents that the operator's query does not
    hold out, as they are in `docs`. Rows are scored one by one; a NULL text is
    scored as an empty one.
    """
    ship(spark)
    labels = one_label(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    model = discriminant.train(docs, labels, ~held_out(F.col("doc_id"), 3, 1))
    name = fresh(docs, "score")
    scored = docs.withColumn(name, discriminant.score(F.coalesce(F.col("text"), F.lit("")), model))
    return scored.filter(F.col(name) >= 0.5).drop(name)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id.

    Of rows that share a doc_id one stays, the first by text. Rows without
    doc_id belong to no group and stay. No other text moves than those kept.
    """
    ship(spark)
    groups = jaccard.near_duplicates(docs)
    chosen = groups.filter(F.col("doc_id") == F.col("component_id"))
    several = chosen.groupBy("doc_id").agg((F.count("doc_id") > 1).alias("several"))
    several = saved(several.withColumnRenamed("doc_id", "kept_id"))
    ids = several.select("kept_id").hint("merge")
    kept = docs.join(ids, docs["doc_id"] == ids["kept_id"], "left_semi")
    repeated = several.filter("several").select("kept_id")
    single = kept.join(repeated, kept["doc_id"] == repeated["kept_id"], "left_anti")
    first = kept.join(repeated, kept["doc_id"] == repeated["kept_id"], "left_semi").select(
        "doc_id", F.struct(F.col("text").isNotNull().alias("given"), *docs.columns).alias("row")
    )
    first = first.groupBy("doc_id").agg(F.min("row").alias("row"))
    first = first.select(*[F.col("row")[c].alias(c) for c in docs.columns])
    nameless = docs.filter(F.col("doc_id").isNull())
    return single.unionByName(first).unionByName(nameless)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark passages."""
    ship(spark)
    name = fresh(docs, "contamination")
    found = fm_index.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(~F.col(name)["contaminated"]).drop(name)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in brackets; n_chars follows the text."""
    ship(spark)
    redacted = docs.withColumn("text", pii.redacted(F.col("text"), pii.train(docs)))
    length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
    return redacted.withColumn("n_chars", F.when(F.col("text").isNotNull(), length).otherwise(F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence of at most 2048 tokens."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", hide_personal_data),
    ("best-fit packing", pack),
]

# The first stage is a trained classifier, so SQL cannot give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
