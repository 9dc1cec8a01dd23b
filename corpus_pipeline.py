"""From raw documents to token files: language, near duplicates, benchmark passages, source mix, tokens.

Every stage works on all that the stage before kept; its result is written as Parquet in the
shared folder and read again, so a lost executor never reaches back beyond one stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentilake.llm.common import fold, stash, work_path
from sentilake.llm.decontamination import without_leaks
from sentilake.llm.language_id import fit_languages, language_udf
from sentilake.llm.mixing import mix_sources, word_count
from sentilake.llm.near_duplicates import one_of_each_class
from sentilake.llm.token_files import read_token_files, token_digest, write_token_files

LEAST_POSTERIOR = 0.5
ARROW_BATCH = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small Arrow batches from here on, as a stage runs after its function has returned.

    A batch is held by executor and worker at once, and what it took stays with both.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those whose best language is not likelier than all others together.

    The model learns from labelled documents of two of three folds; a document's own label
    does not count. Without any labelled document nothing is known and all are dropped.
    """
    bound_batches(spark)
    model = fit_languages(docs.where(fold("doc_id", 3) != 1).select("text", "lang"))
    judged = language_udf(spark, model)(F.col("text"))
    return docs.where((judged["lang_pred"] != "und") & (judged["score"] >= LEAST_POSTERIOR))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every near-duplicate class: the one with the least doc_id."""
    return one_of_each_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item."""
    bound_batches(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources come near their target weights.

    The mix takes some of a document's words once, twice or not at all; the document is written as
    often as that share says, rounded up or down by a hash so that sums stay near. Documents
    that agree in source, id and size share their part equally.
    """
    taken, _, _ = mix_sources(docs)
    parts = stash(taken.where("size > 0").groupBy(
        F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.col("size").alias("_size")).agg(
        (F.avg("taken") / F.first("size")).alias("_share")), "pipeline-parts")
    columns = docs.columns
    sized = docs.withColumn("_words", word_count(F.col("text")))
    u = F.pmod(F.xxhash64(F.lit(41), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    joined = sized.join(parts, sized["source"].eqNullSafe(parts["_source"]) & sized["doc_id"].eqNullSafe(parts["_id"]) & (
        sized["_words"] == parts["_size"]))
    times = F.floor(F.col("_share") + u).cast("int")
    return joined.withColumn("_times", times).where("_times > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files and return what they hold of each document, read back."""
    path = work_path(spark, "pipeline-tokens")
    write_token_files(docs, path)
    return token_digest(read_token_files(spark, path))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix),
          ("tokens", tokens)]
ORACLE_SQL = None  # learned scores, sampled candidates and a tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
