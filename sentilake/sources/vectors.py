"""Word-vector files and document-vector outputs."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentilake.functions.text import NOT_SPACE, parse_vector


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(token, vec) from lines `word f f f ...`; a repeated word keeps its last line."""
    lines = spark.read.text(path).select(
        F.regexp_extract_all("value", F.lit(f"{NOT_SPACE}+"), F.lit(0)).alias("w"),
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                 F.monotonically_increasing_id()).alias("at"))
    parsed = lines.where(F.size("w") > 1).select(
        F.element_at("w", 1).alias("token"), "at",
        F.transform(F.slice("w", F.lit(2), F.size("w") - 1), lambda x: x.cast("float")).alias("vec"))
    return parsed.groupBy("token").agg(F.max_by("vec", "at").alias("vec"))


def join_vector(col: str = "vec") -> Column:
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")


def write_vectors(df: DataFrame, prefix: str, vec: str = "vec", mode: str = "error") -> None:
    """Two outputs: CSV with a comma-joined `embedding` column, and JSON records."""
    rest = [c for c in df.columns if c != vec]
    joined = df.select(*rest, join_vector(vec).alias("embedding"))
    joined.write.mode(mode).csv(f"{prefix}_csv", header=True, escape='"')
    df.select(*rest, F.col(vec).alias("embedding")).write.mode(mode).json(f"{prefix}_json")


def parse_vectors(df: DataFrame, col: str = "embedding", name: str = "vec") -> DataFrame:
    """Comma strings to arrays; columns that are arrays already pass through."""
    if df.schema[col].dataType.typeName() == "array":
        return df.withColumn(name, F.col(col).cast("array<double>"))
    return df.withColumn(name, parse_vector(F.col(col)))
