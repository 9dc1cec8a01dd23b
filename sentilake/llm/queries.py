"""The queries of the training-data operators."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.sharding import shuffle_into_shards
    dealt = shuffle_into_shards(table(spark, sf, "documents").select("doc_id", "text"), 8)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return dealt.select(
        "row.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.mixing import mix_sources
    taken, _, _ = mix_sources(table(spark, sf, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.quality_rules import quality_verdicts
    return quality_verdicts(table(spark, sf, "documents"))


@query
def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.secret_scan import scan_secrets
    return scan_secrets(table(spark, sf, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked")


@query
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.common import fold
    from sentilake.llm.language_id import fit_languages, identify_languages
    docs = table(spark, sf, "documents")
    model = fit_languages(docs.where(fold("doc_id", 3) != 1).select("text", "lang"))
    return identify_languages(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op6_token_files(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.common import work_path
    from sentilake.llm.token_files import read_token_files, token_digest, write_token_files
    path = work_path(spark, "tokens")
    write_token_files(table(spark, sf, "documents"), path)
    return token_digest(read_token_files(spark, path))


@query
def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.decontamination import find_leaks
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op5_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.near_duplicates import near_duplicate_classes
    return near_duplicate_classes(table(spark, sf, "documents")).select(
        "doc_id", "class_id", "text_id", "n_links", "copies")


@query
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.common import fold
    from sentilake.llm.toxicity import fit_toxicity, labelled_texts, score_toxicity
    docs = table(spark, sf, "documents")
    model = fit_toxicity(labelled_texts(docs, table(spark, sf, "labels").where(fold("doc_id", 5) != 0)))
    return score_toxicity(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op4_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.pii import find_personal_data
    return find_personal_data(table(spark, sf, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.periodic_runs import collapse_runs
    runs = collapse_runs(with_periodic_tails(table(spark, sf, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    return runs.withColumn("_long", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_long.back")).alias("start"), F.col("_long.length").alias("length"),
        (-F.col("_long.less")).alias("period"),
        F.expr("1000 * _long.length div -_long.less").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_periodic_tails(documents: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by its hash repeats a stretch of its words to its end.

    A null id hashes as empty text.
    """
    from sentilake.llm.common import WORD
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    cut = documents.select("doc_id", "text", h.alias("_h")).withColumn("_g", F.floor(F.col("_h") / 10)).withColumn(
        "_words", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))))
    cut = cut.withColumn("_n", F.size("_words")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    rest = F.col("_n") - F.col("_a")
    cut = cut.withColumn("_p", (1 + F.floor(rest / (3 + F.col("_g") % 8))).cast("int"))
    repeated = F.slice(F.flatten(F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), F.ceil(rest / F.col("_p")).cast("int"))),
                       F.lit(1), rest)
    tailed = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), repeated), " ")
    return cut.select("doc_id", F.when(F.col("_n") > 0, tailed).otherwise(F.col("text")).alias("text"))


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
             ("block", "com", "/de/")]


@query
def op12_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.url_filter import judge_urls
    return judge_urls(table(spark, sf, "pages"), URL_RULES)


@query
def op13_source_audit(spark: SparkSession, sf: str) -> DataFrame:
    from sentilake.llm.source_audit import audit_sources
    return audit_sources(table(spark, sf, "documents"))
